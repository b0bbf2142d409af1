"""One query for each operator, over whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.llm import (
    alignment,
    bpe,
    chat,
    conversations,
    decontaminate,
    knn,
    licenses,
    line_dedup,
    near_dedup,
    pii,
    quality,
    substrings,
    training_order,
)
from bazaar.session import work_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: The folder of tokenizer files for a run without the public_tokenizers package.
TOKENIZER_FOLDER = "/opt/tokenizers"
#: The key of the pseudonyms and of the training order in these queries; a deployment gives its own.
KEY = b"bazaar example key"
ORDER_KEY = 20_240_229
#: Tools whose calls op6 checks (chats of the test tables call none).
TOOLS = {
    "search": {"query": ("string", True), "limit": ("integer", False)},
    "convert": {"amount": ("number", True), "currency": ("string", True)},
}


def query(name: str, sql: str | None = None):
    def keep(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql.strip()
        return function

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    try:
        import public_tokenizers
    except ImportError:
        return f"{TOKENIZER_FOLDER}/{name}"
    return public_tokenizers.path(name)


def tokenizer_file() -> str:
    return tokenizer_path("word_bpe_49k.json")


@query("op1_near_duplicates")
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query(
    "op2_top_k",
    """
    WITH v AS (
        SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
        FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0
          AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
    ), s AS (
        SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
    ), r AS (
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id, score FROM s
    )
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
    """,
)
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = knn.quantised(table(spark, sf_dir, "embeddings"))
    return knn.top_k(vectors.where("id % 20 = 0"), vectors, 20)


@query(
    "op3_substring_dedup",
    r"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+') AS w FROM documents),
    starts AS (SELECT r, unnest(range(0, greatest(len(w) - 34, 0))) AS s, w FROM d),
    windows AS (SELECT r, s, array_to_string(w[s + 1 : s + 35], ' ') AS t FROM starts),
    again AS (SELECT t FROM windows GROUP BY t HAVING count(*) > 1),
    gone AS (SELECT DISTINCT r, unnest(range(s, s + 35)) AS p FROM windows WHERE t IN (SELECT t FROM again)),
    marks AS (SELECT r, list(p) AS ps FROM gone GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
           sha256(array_to_string(CASE WHEN ps IS NULL THEN w ELSE
               [w[i + 1] FOR i IN range(0, len(w)) IF NOT list_contains(ps, i)] END, ' ')) AS kept_sha256
    FROM d LEFT JOIN marks USING (r)
    """,
)
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query(
    "op4_decontamination",
    r"""
    WITH d AS (
        SELECT DISTINCT doc_id, array_to_string(w[s + 1 : s + 5], ' ') AS g FROM (
            SELECT doc_id, w, unnest(range(0, greatest(len(w) - 4, 0))) AS s FROM (
                SELECT doc_id, regexp_extract_all(lower(text), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents))
    ), b AS (
        SELECT DISTINCT item_id, array_to_string(w[s + 1 : s + 5], ' ') AS g FROM (
            SELECT item_id, w, unnest(range(0, greatest(len(w) - 4, 0))) AS s FROM (
                SELECT item_id, regexp_extract_all(lower(text), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark))
    ), sizes AS (SELECT item_id, count(*) AS n FROM b GROUP BY item_id),
    hits AS (SELECT doc_id, item_id, count(*) AS m FROM d JOIN b USING (g) GROUP BY doc_id, item_id)
    SELECT doc_id, item_id, m / n AS containment FROM hits JOIN sizes USING (item_id) WHERE m / n >= 0.8
    """,
)
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _license_sql() -> str:
    """Every place of every phrase and template, tried one by one."""
    listed = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    columns = []
    for phrase, label in licenses.BASE.items():
        own = phrase.split()
        columns.append(
            f"[s FOR s IN range(0, greatest(len(w) - {len(own) - 1}, 0)) IF w[s + 1 : s + {len(own)}] = {listed(own)}] AS \"b_{label}\""
        )
    for i, (_, template, mandatory) in enumerate(licenses.TEMPLATES):
        own, must = template.split(), mandatory.split()
        at = next(j for j in range(len(own)) if own[j : j + len(must)] == must)
        same = " + ".join(f"CAST(coalesce(s + {j} > 0 AND w[s + {j}] = '{x}', false) AS INTEGER)" for j, x in enumerate(own, 1 - at))
        columns.append(
            f"coalesce(list_max([({same}) / {len(own)}.0::DOUBLE FOR s IN range(0, len(w)) "
            f"IF w[s + 1 : s + {len(must)}] = {listed(must)}]), 0.0) AS s_{i}"
        )
    base = [f'CASE WHEN len("b_{x}") > 0 THEN \'{x}\' END' for x in licenses.BASE.values()]
    least = licenses.LEAST_COVERAGE
    more = [f"CASE WHEN s_{i} >= {least} THEN '{label}' END" for i, (label, _, _) in enumerate(licenses.TEMPLATES)]
    scores = ", ".join(f"CASE WHEN s_{i} >= {least} THEN s_{i} ELSE 0.0 END" for i in range(len(licenses.TEMPLATES)))
    every = " || ".join(f'"b_{x}"' for x in licenses.BASE.values())
    joined = lambda xs: f"coalesce(array_to_string(list_sort(list_distinct([{', '.join(xs)}])), ','), '')"
    return rf"""
    WITH d AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{licenses._UPPER}', '{licenses._LOWER}'),
            '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents
    ), f AS (SELECT doc_id, len(w) AS n, {", ".join(columns)} FROM d), e AS (SELECT *, {every} AS places FROM f)
    SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base,
        CAST(list_min(places) AS BIGINT) AS first_word, CAST(list_max(places) AS BIGINT) AS last_word,
        {joined(base)} AS base_labels, {joined(base + more)} AS labels,
        CAST(CASE WHEN len(places) > 0 THEN 1.0 ELSE greatest({scores}) END AS DOUBLE) AS score
    FROM e
    """


@query("op5_license_scan", _license_sql())
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(table(spark, sf_dir, "documents"))


@query(
    "op6_chat_format",
    """
    WITH asks AS (SELECT conv_id, turn, conv_id || ':' || turn AS call_id, text FROM conversations WHERE role = 'user'),
    answers AS (SELECT conv_id, turn, conv_id || ':' || (turn - 1) AS call_id, text FROM conversations WHERE role = 'assistant'),
    both_sides AS (
        SELECT coalesce(a.conv_id, r.conv_id) AS conv_id, coalesce(a.call_id, r.call_id) AS call_id, a.turn AS turn,
               r.turn AS result_turn, a.call_id IS NOT NULL AS has_call, r.call_id IS NOT NULL AS has_result,
               a.text AS prompt, r.text AS content
        FROM asks a FULL JOIN answers r ON a.conv_id = r.conv_id AND a.call_id = r.call_id
    )
    SELECT conv_id, call_id, turn, result_turn,
           CASE WHEN NOT has_call THEN 'orphan' WHEN NOT has_result THEN 'unanswered' ELSE 'linked' END AS status,
           CASE WHEN has_call THEN 0 END AS depth, CASE WHEN has_call THEN prompt IS NOT NULL END AS valid,
           CASE WHEN has_call AND prompt IS NULL THEN 'missing prompt' END AS problem,
           '{"arguments":' || CASE WHEN has_call THEN '{"prompt":' || CAST(to_json(prompt) AS VARCHAR) || '}' ELSE 'null' END
           || ',"call_id":' || CAST(to_json(call_id) AS VARCHAR) || ',"conv_id":' || conv_id
           || ',"name":' || CASE WHEN has_call THEN '"reply"' ELSE 'null' END
           || ',"result":' || coalesce(CAST(to_json(content) AS VARCHAR), 'null') || '}' AS json
    FROM both_sides
    UNION ALL
    SELECT conv_id, NULL, turn, NULL, 'message', NULL, NULL, NULL,
           '{"conv_id":' || conv_id || ',"role":' || CAST(to_json(role) AS VARCHAR) || ',"text":'
           || CAST(to_json(text) AS VARCHAR) || ',"turn":' || turn || '}'
    FROM conversations WHERE role IS NULL OR role NOT IN ('user', 'assistant', 'tool')
    """,
)
def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted(table(spark, sf_dir, "conversations"), TOOLS)


@query("op7_pseudonyms")
def pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pseudonyms(table(spark, sf_dir, "documents"), KEY)
    return found.select("doc_id", "text", F.size("kinds").alias("n_values"), F.array_join("kinds", ",").alias("kinds"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    coded = bpe.encode_decode(docs, tokenizer_file())
    ids = F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary")
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op8_bpe")
def bpe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


@query("op9_quality")
def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model).select(
        "doc_id",
        quality.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@query("op10_training_order")
def training_order_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark, "training-order")
    ranks = tokenizer_path("byte_bpe_50k.tiktoken")
    training_order.materialise(table(spark, sf_dir, "documents"), path, ORDER_KEY, ranks)
    found = training_order.sequences(spark, path)
    return found.select("slot", "number", "doc_id", "skip", "n_tokens", "shard", "at", F.crc32("tokens").alias("crc32"))


@query("op11_token_alignment")
def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    return alignment.link_statistics(table(spark, sf_dir, "documents"), *files)


@query("op12_conversation_repair")
def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired(conversations.damaged(table(spark, sf_dir, "conversations")), "dropped")


@query(
    "op13_line_dedup",
    r"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    l AS (SELECT r, unnest(range(len(lines))) AS i, unnest(lines) AS line FROM d),
    k AS (SELECT r, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    bad AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
    kept AS (SELECT r, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS t FROM k WHERE key NOT IN (SELECT key FROM bad) GROUP BY r)
    SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - coalesce(n, 0) AS BIGINT) AS n_dropped,
           sha256(coalesce(t, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (r)
    """,
)
def line_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.without_repeated_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
