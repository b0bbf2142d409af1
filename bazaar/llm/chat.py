"""Tool calls of chats: linked to their results, ordered, validated and serialised.

Calls and results are joined by conversation and identifier. Calls that use
the result of another one come after it (their depth is one more than that of
the deepest call they need). Arguments are checked against the tool's schema,
and each link is written as canonical JSON: sorted keys, no white space. One
row holds one link or message, so a long conversation is never gathered.
Column expressions, joins and groupings only.

No message is lost: one test, whether a text parses as calls or as a result,
decides what it is, and whatever is neither is an answer or a plain message
with its whole text. A repeated identifier links once; the other rows of it
come out as ``repeated``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.llm.storage import forget, stored

#: For each tool its parameters: kind (string, integer, number, boolean, object, array or enum:a|b) and whether they must be given.
Schemas = Mapping[str, Mapping[str, tuple[str, bool]]]
_FORMS = {
    "integer": r"^-?[0-9]+$",
    "number": r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$",
    "boolean": r"^(true|false)$",
}
_NESTED = {"object": "OBJECT<", "array": "ARRAY<"}
_CALLS = "struct<content: string, tool_calls: array<struct<id: string, name: string, arguments: map<string, string>, needs: array<string>>>>"
_RESULT = "struct<tool_call_id: string, content: string>"


def _calls() -> Column:
    """The calls of an assistant's text, or NULL if it makes none."""
    parsed = F.when((F.col("role") == "assistant") & F.ltrim("text").startswith("{"), F.from_json("text", _CALLS))
    calls = F.filter(parsed["tool_calls"], lambda c: c.isNotNull())
    return F.when((F.size(calls) > 0) & (F.size(calls) == F.size(parsed["tool_calls"])), calls)


def _result() -> Column:
    """The result in a text of role tool, or NULL if it names no call."""
    parsed = F.when(F.col("role") == "tool", F.from_json("text", _RESULT))
    return F.when(parsed["tool_call_id"].isNotNull(), parsed)


def tool_calls(messages: DataFrame) -> DataFrame:
    """Calls that assistants' texts of the form {"tool_calls": [{"id", "name", "arguments", "needs"}]} make."""
    rows = messages.where(_calls().isNotNull()).select("conv_id", "turn", F.explode(_calls()).alias("c"))
    return rows.select(
        "conv_id", "turn", F.col("c.id").alias("call_id"), F.col("c.name").alias("name"),
        F.col("c.arguments").alias("arguments"), F.col("c.needs").alias("needs"),
    )


def tool_results(messages: DataFrame) -> DataFrame:
    """Results: texts of role tool, {"tool_call_id", "content"}."""
    rows = messages.where(_result().isNotNull()).select("conv_id", "turn", _result().alias("r"))
    return rows.select("conv_id", "turn", F.col("r.tool_call_id").alias("call_id"), F.col("r.content").alias("content"))


def _problems(schemas: Schemas) -> Column:
    """What is wrong with a call's arguments: the first problem, or null."""
    known = F.lit("unknown tool")
    for name, parameters in schemas.items():
        checks = [F.lit(None).cast("string")]
        for parameter, (kind, needed) in sorted(parameters.items()):
            value = F.col("arguments")[parameter]
            if needed:
                checks.append(F.when(value.isNull(), F.lit(f"missing {parameter}")))
            if kind in _FORMS:
                checks.append(F.when(~value.rlike(_FORMS[kind]), F.lit(f"{parameter} is no {kind}")))
            elif kind in _NESTED:
                shape = F.coalesce(F.schema_of_variant(F.try_parse_json(value)), F.lit(""))
                checks.append(F.when(value.isNotNull() & ~shape.startswith(_NESTED[kind]), F.lit(f"{parameter} is no {kind}")))
            elif kind.startswith("enum:"):
                checks.append(F.when(~value.isin(kind[5:].split("|")), F.lit(f"{parameter} is none of {kind[5:]}")))
        names = F.array(*map(F.lit, parameters)) if parameters else F.array().cast("array<string>")
        extra = F.array_min(F.array_except(F.coalesce(F.map_keys("arguments"), F.array().cast("array<string>")), names))
        checks.append(F.when(extra.isNotNull(), F.concat(F.lit("unexpected "), extra)))
        known = F.when(F.col("name") == name, F.coalesce(*checks)).otherwise(known)
    return known


def _number(value: Column) -> Column:
    """One form for each number: whole ones without fraction, exponent or leading zeros."""
    double = value.cast("double")
    whole = F.when((F.abs(double) < 1e15) & (double == F.floor(double)), double.cast("bigint").cast("string"))
    integer = F.when(value.rlike(_FORMS["integer"]), value.try_cast("decimal(38,0)").cast("string"))
    finite = F.when(F.abs(double) < float("inf"), double.cast("string"))
    return F.coalesce(integer, whole, finite, value)


def _arguments_json(schemas: Schemas) -> Column:
    """Arguments as a JSON object with sorted keys; numbers, truth values, objects and arrays as such, others as strings."""

    def of(*kinds: str) -> Column:
        named = [F.concat(F.lit(n + "\n"), F.lit(p)) for n, ps in schemas.items() for p, (k, _) in ps.items() if k in kinds]
        return F.array(*named) if named else F.array().cast("array<string>")

    def entry(e: Column) -> Column:
        place, value = F.concat(F.col("name"), F.lit("\n"), e["key"]), e["value"]
        nested = F.to_json(F.try_parse_json(value))
        shown = (
            F.when(F.array_contains(of("boolean"), place) & value.rlike(_FORMS["boolean"]), value)
            .when(F.array_contains(of("integer", "number"), place) & value.rlike(_FORMS["number"]), _number(value))
            .when(F.array_contains(of("object", "array"), place) & nested.isNotNull(), nested)
            .otherwise(_quoted_value(value))
        )
        return F.concat(_quoted_value(e["key"]), F.lit(":"), shown)

    entries = F.transform(F.array_sort(F.map_entries("arguments")), entry)
    return F.concat(F.lit("{"), F.coalesce(F.array_join(entries, ","), F.lit("")), F.lit("}"))


def _quoted_value(text: Column) -> Column:
    whole = F.to_json(F.array(text))
    return F.substring(whole, F.lit(2), F.length(whole) - 2)


def _depths(calls: DataFrame) -> DataFrame:
    """``conv_id, call_id, depth`` of the calls that need others; -1 for those in or behind a cycle.

    Each round settles the calls whose needs are settled, so there are as many
    rounds as the deepest chain is long. Needs of unknown calls are ignored.
    """
    spark = calls.sparkSession
    keys = ["conv_id", "call_id"]
    some = calls.where("size(needs) > 0").select(*keys, F.explode(F.array_distinct("needs")).alias("need"))
    known = calls.select("conv_id", F.col("call_id").alias("need"))
    open_edges = stored(some.join(known, ["conv_id", "need"], "left_semi"), "needs")
    settled, depth = None, 0
    while not open_edges.isEmpty():
        waiting = open_edges.select(*keys).distinct()
        blocked = open_edges.join(waiting.withColumnRenamed("call_id", "need"), ["conv_id", "need"], "left_semi")
        blocked = blocked.select(*keys).distinct()
        depth += 1
        ready = stored(waiting.join(blocked, keys, "left_anti").withColumn("depth", F.lit(depth)), "depths")
        if ready.isEmpty():
            ready = waiting.withColumn("depth", F.lit(-1))
            return ready if settled is None else settled.union(ready)
        settled = ready if settled is None else settled.union(ready)
        rest = stored(open_edges.join(ready, keys, "left_anti"), "needs")
        forget(spark, open_edges)
        open_edges = rest
    return settled if settled is not None else calls.limit(0).select(*keys, F.lit(0).alias("depth"))


def linked(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """``conv_id, call_id, turn, result_turn, status, depth, valid, problem, json`` of every call and lone result.

    ``calls`` has (conv_id, turn, call_id, name, arguments map<string,string>,
    needs array<string>), ``results`` (conv_id, turn, call_id, content). Of
    several calls or results of one identifier the earliest is linked (ties by
    content), each other one is a row of status ``repeated``. Status else:
    linked, early (the result stands before its call), unanswered or orphan (a
    result without a call). Null conversations or identifiers link to nothing:
    their calls are unanswered, their results orphans. Other columns are not
    read; empty tables give an empty result.
    """
    keys = ["conv_id", "call_id"]
    calls = calls.select(*keys, F.struct("turn", "name", F.to_json("arguments").alias("a"), "needs").alias("c"))
    results = results.select(*keys, F.struct("turn", "content").alias("r"))
    more_calls, more_results = _repeated(calls, "c"), _repeated(results, "r")
    calls = _opened(calls.groupBy(*keys).agg(F.min("c").alias("c")))
    results = results.groupBy(*keys).agg(F.min("r").alias("r"))
    both = calls.join(results, keys, "full").join(_depths(calls), keys, "left")
    has_call, has_result = F.col("name").isNotNull() | F.col("needs").isNotNull(), F.col("r").isNotNull()
    status = (
        F.when(~has_call, "orphan").when(~has_result, "unanswered")
        .when(F.col("r.turn") < F.col("turn"), "early").otherwise("linked")
    )
    both = both.select(
        *keys, "turn", F.col("r.turn").alias("result_turn"), status.alias("status"),
        F.when(has_call, F.coalesce("depth", F.lit(0))).alias("depth"),
        F.when(has_call, _problems(schemas)).alias("problem"), "name", "arguments",
        F.col("r.content").alias("content"), has_call.alias("has_call"),
    )
    once = both.select(
        *keys, "turn", "result_turn", "status", "depth",
        F.when(F.col("has_call"), F.col("problem").isNull()).alias("valid"), "problem", _link_json(schemas).alias("json"),
    )
    none = lambda kind: F.lit(None).cast(kind)
    again = _opened(more_calls).select(*keys, "turn", none("bigint").alias("result_turn"), "name", "arguments", none("string").alias("content"), F.lit(True).alias("has_call"))
    lone = more_results.select(
        *keys, none("bigint").alias("turn"), F.col("r.turn").alias("result_turn"), none("string").alias("name"),
        none("map<string,string>").alias("arguments"), F.col("r.content").alias("content"), F.lit(False).alias("has_call"),
    )
    rest = again.union(lone).select(
        *keys, "turn", "result_turn", F.lit("repeated").alias("status"), none("int").alias("depth"), none("boolean").alias("valid"),
        none("string").alias("problem"), _link_json(schemas).alias("json"),
    )
    return once.unionByName(rest)


def _opened(calls: DataFrame) -> DataFrame:
    """Calls with the fields of their struct ``c`` as columns."""
    return calls.select(
        "conv_id", "call_id", F.col("c.turn").alias("turn"), F.col("c.name").alias("name"),
        F.coalesce(F.from_json("c.a", "map<string,string>"), F.create_map().cast("map<string,string>")).alias("arguments"),
        F.coalesce("c.needs", F.array().cast("array<string>")).alias("needs"),
    )


def _repeated(rows: DataFrame, column: str) -> DataFrame:
    """All rows of a key but one of its least: equal rows are counted first, so a hot key is not gathered."""
    keys = ["conv_id", "call_id"]
    counted = rows.groupBy(*keys, column).agg(F.count("*").alias("n"))
    least = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min(column).alias("least"), F.count("*").alias("all")).where(F.col("all") > 1)
    same = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & F.col("call_id").eqNullSafe(F.col("_call_id"))
    copies = F.col("n") - F.col(column).eqNullSafe(F.col("least")).cast("int")
    return counted.join(least, same).where(copies > 0).select(*keys, column, F.explode(F.sequence(F.lit(1), copies)).alias("_copy")).drop("_copy")


def _link_json(schemas: Schemas) -> Column:
    or_null = lambda x: F.coalesce(x, F.lit("null"))
    return F.concat(
        F.lit('{"arguments":'), F.when(F.col("has_call"), _arguments_json(schemas)).otherwise(F.lit("null")),
        F.lit(',"call_id":'), or_null(F.when(F.col("call_id").isNotNull(), _quoted_value(F.col("call_id")))),
        F.lit(',"conv_id":'), or_null(F.col("conv_id").cast("string")),
        F.lit(',"name":'), or_null(F.when(F.col("name").isNotNull(), _quoted_value(F.col("name")))),
        F.lit(',"result":'), or_null(F.when(F.col("content").isNotNull(), _quoted_value(F.col("content")))),
        F.lit("}"),
    )


def exchanges(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Plain chats as calls and results: a user's turn asks, the assistant's next turn answers it."""
    name = lambda turn: F.concat_ws(":", F.col("conv_id").cast("string"), turn.cast("string"))
    asks = messages.where("role = 'user'").select(
        "conv_id", "turn", name(F.col("turn")).alias("call_id"), F.lit("reply").alias("name"),
        F.create_map(F.lit("prompt"), F.col("text")).alias("arguments"), F.array().cast("array<string>").alias("needs"),
    )
    answers = messages.where((F.col("role") == "assistant") & _calls().isNull()).select(
        "conv_id", "turn", name(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content")
    )
    return asks, answers


def formatted(messages: DataFrame, schemas: Schemas) -> DataFrame:
    """All of a chat table as linked calls: tool calls and results, plain exchanges, and other messages.

    Messages of other roles (system, null), tool messages that name no call, and
    what an assistant says beside calls (``content``) have status ``message`` and
    their role and text as JSON; repeated ones stay. An assistant's text that
    does not parse as calls, or holds none, is a plain answer. See ``linked`` for
    the rest.
    """
    asks, answers = exchanges(messages)
    calls = asks.unionByName(tool_calls(messages))
    results = answers.unionByName(tool_results(messages))
    schemas = {"reply": {"prompt": ("string", True)}, **schemas}
    other = F.coalesce(~F.col("role").isin("user", "assistant", "tool"), F.lit(True)) | ((F.col("role") == "tool") & _result().isNull())
    beside = F.from_json("text", _CALLS)["content"]
    rest = messages.where(other).select("conv_id", "turn", "role", "text")
    rest = rest.union(messages.where(_calls().isNotNull() & beside.isNotNull()).select("conv_id", "turn", "role", beside.alias("text")))
    or_null = lambda x: F.coalesce(x, F.lit("null"))
    text = lambda c: or_null(F.when(F.col(c).isNotNull(), _quoted_value(F.col(c))))
    json = F.concat(
        F.lit('{"conv_id":'), or_null(F.col("conv_id").cast("string")), F.lit(',"role":'), text("role"),
        F.lit(',"text":'), text("text"), F.lit(',"turn":'), or_null(F.col("turn").cast("string")), F.lit("}"),
    )
    others = rest.select(
        "conv_id", F.lit(None).cast("string").alias("call_id"), "turn", F.lit(None).cast("bigint").alias("result_turn"),
        F.lit("message").alias("status"), F.lit(None).cast("int").alias("depth"), F.lit(None).cast("boolean").alias("valid"),
        F.lit(None).cast("string").alias("problem"), json.alias("json"),
    )
    return linked(calls, results, schemas).unionByName(others)
