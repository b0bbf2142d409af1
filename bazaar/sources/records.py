"""Records of delimited text files, also where quoted cells hold line breaks: one splittable read.

A file is read in splits, and a split does not know whether it begins inside a
quoted cell. So every line is parsed twice as it streams by, once for each state
the split may begin in; that leaves two short notes at each line (its state and
the number of its record, for either beginning). The lines are dealt by split
once. From there a table of one row a split says what a split does to the state
and how many records it begins; running over the splits of a file, it tells
where each really begins; and every line takes the notes that hold. A line that is a record of its own is
done. Only lines of records with line breaks are grouped again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
#: Lines that leave a task as one row.
_CHUNK = 2000
_LONG = ("at", "before0", "before1", "after0", "after1", "record0", "record1")
#: Of every line: its number in the split; then, for a split that begins outside quotes (0) or inside (1), the state
#: before and after it (1 inside), and the number of its record in the split (-1 for one that began earlier).
_ROWS = T.ArrayType(
    T.StructType([*[T.StructField(c, T.LongType(), False) for c in _LONG], T.StructField("line", T.StringType(), False)]), False
)
_NOTED = T.StructType(
    [T.StructField("path", T.StringType(), False), T.StructField("block", T.LongType(), False), T.StructField("rows", _ROWS, False)]
)


def leaves_open(line: Column, sep: str = ",") -> Column:
    """Whether a line, read from the start of a record, ends inside a quoted cell.

    A quote opens a cell only where the cell begins; doubled quotes stand for
    one; what follows a closing quote belongs to the cell.
    """
    start = f"(^|{re.escape(sep)})"
    rest = F.regexp_replace(line, f'{start}{_QUOTED}"', "$1")
    return F.contains(line, F.lit('"')) & rest.rlike(f'{start}"')


def _note(paths: np.ndarray, blocks: np.ndarray, ends: tuple[np.ndarray, np.ndarray], carry: dict) -> np.ndarray:
    """Notes of the lines of one batch; ``carry`` holds the state of the split that goes on."""
    n = len(blocks)
    new = np.ones(n, bool)
    new[1:] = (blocks[1:] != blocks[:-1]) | (paths[1:] != paths[:-1])
    new[0] = carry.get("split") != (paths[0], blocks[0])
    first = np.flatnonzero(new)
    group = np.cumsum(new)  # 0: the split that goes on
    begin = np.zeros(len(first) + 1, np.int64)
    begin[1:] = first
    place = np.arange(n)
    fixed = ends[0] == ends[1]  # the state after the line does not depend on the one before
    swaps = np.concatenate([[0], np.cumsum(ends[0] & ~ends[1])])
    last = np.maximum.accumulate(np.where(fixed, place, -1))
    out = np.empty((n, 7), np.int64)
    out[:, 0] = place - begin[group] + np.where(group == 0, carry.get("lines", 0), 0)
    for start in (0, 1):
        origin = np.where(group == 0, carry.get("state", (0, 1))[start], start).astype(bool)
        since = np.maximum(last, -1)
        known = since >= begin[group]
        base = np.where(known, ends[0][np.maximum(since, 0)], origin)
        flips = swaps[1:] - swaps[np.where(known, since + 1, begin[group])]
        after = base ^ (flips % 2 == 1)
        before = np.empty(n, bool)
        before[1:] = after[:-1]
        before[0] = origin[0]
        before[first] = bool(start)
        records = np.cumsum(~before)
        earlier = np.concatenate([[0], records])[begin[group]]
        out[:, 1 + start], out[:, 3 + start] = before, after
        out[:, 5 + start] = records - earlier - 1 + np.where(group == 0, carry.get("records", (0, 0))[start], 0)
    carry["split"] = (paths[-1], blocks[-1])
    carry["lines"] = int(out[-1, 0]) + 1
    carry["state"] = (int(out[-1, 3]), int(out[-1, 4]))
    carry["records"] = (int(out[-1, 5]) + 1, int(out[-1, 6]) + 1)
    return out


def _noted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    carry: dict = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        path, block, line, ends0, ends1 = batch.columns
        codes = path.dictionary_encode()
        names = np.array(codes.dictionary.to_pylist(), object)[codes.indices.to_numpy()]
        blocks = block.to_numpy()
        ends = tuple(x.to_numpy(zero_copy_only=False).astype(bool) for x in (ends0, ends1))
        notes = _note(names, blocks, ends, carry)
        cuts = np.flatnonzero((blocks[1:] != blocks[:-1]) | (names[1:] != names[:-1])) + 1
        cuts = np.unique(np.concatenate([cuts, np.arange(0, batch.num_rows, _CHUNK)]))
        long = [pa.field(c, pa.int64(), False) for c in _LONG]
        rows = pa.StructArray.from_arrays(
            [*[pa.array(notes[:, i]) for i in range(len(_LONG))], line], fields=[*long, pa.field("line", pa.string(), False)]
        )
        bounds = pa.array(np.append(cuts, batch.num_rows).astype(np.int32))
        kind = pa.list_(pa.field("element", rows.type, False))
        heads = pa.array(cuts)
        yield pa.record_batch(
            [path.take(heads), block.take(heads), pa.ListArray.from_arrays(bounds, rows, type=kind)],
            schema=pa.schema([pa.field("path", pa.string(), False), pa.field("block", pa.int64(), False), pa.field("rows", kind, False)]),
        )


def read_records(
    spark: SparkSession, paths: list[str] | str, sep: str = ",", glob: str | None = None, quoted: bool = True
) -> DataFrame:
    """(path, row_no, record): the records of text files, numbered from 0 in each file.

    Lines end with LF or CRLF; line breaks inside a quoted cell stay as they
    are. A quote that is never closed makes the rest of its file one record. With
    ``quoted=False`` every line is a record. A byte order mark is taken off.
    Nothing runs while the plan is built.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    block = F.col("_metadata.file_block_start")
    lines = reader.text(paths).select(
        F.coalesce("_metadata.file_path", F.lit("")).alias("path"),
        F.coalesce(block, F.lit(0).cast("bigint")).alias("block"),
        F.coalesce("value", F.lit("")).alias("line"),
    )
    ends = (leaves_open(F.col("line"), sep), leaves_open(F.concat(F.lit('"'), "line"), sep) | ~F.contains("line", F.lit('"')))
    if not quoted:
        ends = (F.lit(False), F.lit(False))
    dealt = lines.select("*", *[x.alias(f"ends{i}") for i, x in enumerate(ends)]).mapInArrow(_noted, _NOTED)
    dealt = dealt.repartition("path", "block")
    rows = dealt.join(_beginnings(dealt), ["path", "block"]).select("path", "block", "state", "earlier", F.explode_outer("rows").alias("row"))
    real = lambda name: F.when(F.col("state") == 0, F.col(f"row.{name}0")).otherwise(F.col(f"row.{name}1"))
    lines = rows.select(
        "path", "block", "row.at", "row.line", (F.col("earlier") + real("record")).alias("row_no"),
        (real("before") + real("after") == 0).alias("whole"),
    )
    parts = lines.where(~F.col("whole")).groupBy("path", "row_no").agg(F.array_sort(F.collect_list(F.struct("block", "at", "line"))).alias("parts"))
    joined = F.array_join(F.transform("parts", lambda x: x["line"]), "\n")
    records = lines.where("whole").select("path", "row_no", F.col("line").alias("record"))
    records = records.union(parts.select("path", "row_no", joined))
    text = F.regexp_replace("record", "\r\\z", "")
    return records.select("path", "row_no", F.when(F.col("row_no") == 0, F.ltrim(text, F.lit("\ufeff"))).otherwise(text).alias("record"))


def _beginnings(dealt: DataFrame) -> DataFrame:
    """``state`` in which each split really begins, and the number of records that begin ``earlier`` in its file."""
    last = F.element_at("rows", -1)
    ends = dealt.groupBy("path", "block").agg(F.max(F.struct(*[last[c].alias(c) for c in _LONG])).alias("end"))
    splits = ends.select(
        "path", "block", F.col("end.after0").alias("to0"), F.col("end.after1").alias("to1"),
        (F.col("end.record0") + 1).alias("n0"), (F.col("end.record1") + 1).alias("n1"),
    )
    upto = Window.partitionBy("path").orderBy("block")
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    marked = splits.withColumn("swaps", F.sum(F.when((F.col("to0") == 1) & (F.col("to1") == 0), 1).otherwise(0)).over(upto))
    marked = marked.withColumn("fixed", F.when(F.col("to0") == F.col("to1"), F.struct(F.col("to0").alias("to"), "swaps")))
    marked = marked.withColumn("since", F.last("fixed", ignorenulls=True).over(before))
    passed = F.coalesce(F.max("swaps").over(before), F.lit(0)) - F.coalesce("since.swaps", F.lit(0))
    marked = marked.withColumn("state", (F.coalesce("since.to", F.lit(0)) + passed) % 2)
    begun = F.when(F.col("state") == 0, F.col("n0")).otherwise(F.col("n1"))
    counted = marked.withColumn("n", begun)
    return counted.select("path", "block", "state", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))


def record_cells(record: Column, sep: str = ",", null_quoted: bool = True) -> Column:
    """Cells of a record: quoted cells without their quotes, doubled quotes once, empty cells NULL.

    Without ``null_quoted`` an empty cell in quotes is an empty text.
    """
    mark = re.escape(sep)
    cell = rf'{mark}({_QUOTED}(?:"[^{mark}]*+|\z)|[^{mark}]*+)'  # no match is empty, so none hides the next
    found = F.regexp_extract_all(F.concat(F.lit(sep), record), F.lit(cell), F.lit(1))

    def plain(cell: Column) -> Column:
        inner = F.replace(F.regexp_extract(cell, f"^{_QUOTED.replace('"', '"(', 1)})", 1), F.lit('""'), F.lit('"'))
        tail = F.regexp_replace(cell, f'^{_QUOTED}"?', "")
        text = F.concat(inner, tail)
        return F.when(cell.startswith('"'), F.nullif(text, F.lit("")) if null_quoted else text).otherwise(F.nullif(cell, F.lit("")))

    return F.transform(found, plain)
