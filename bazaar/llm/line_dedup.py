"""Line dedup: two Bloom filters pick the lines that may repeat, only those shuffle for an exact count.

1. Every task keeps two Bloom filters over the keys of its lines: seen once and
   seen twice. Filters of two tasks join as once = a | b and twice = a2 | b2 |
   (a & b), so a key of two documents is in the second filter for certain.
   Tasks send their filters as compressed blocks, which are joined in two
   levels; the size of a filter is a parameter and not that of the data.
2. Keys in the second filter are counted exactly: one row for each key and part
   of a task, 128 bits and a count, summed by Spark. What the filter lets through
   by chance counts one document and ends here.
3. Lines of the confirmed keys go (or all but their first occurrence). Where
   the confirmed keys fit a checked bound they are sent to the tasks; beyond it
   the places of the suspected lines are joined with them.

More distinct lines than a filter can tell apart make more suspects, never
another result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.llm import kernels
from bazaar.llm.storage import stored

MIN_DOCUMENTS = 10
#: Bits of each filter: 16 MB in a task, and of the second one on the driver.
FILTER_BITS = 1 << 27
#: Confirmed keys that are sent to every task: about 25 MB there.
BROADCAST_KEYS = 1 << 18
_BLOCK_BITS = 1 << 19
_SALTS = 32
_FLUSH = 200_000
_WHITE = b" \t\n\x0b\x0c\r"


def line_key(line: bytes, least: int = 1) -> bytes | None:
    """128 bits of the stripped line with A-Z lower-cased, or None for a key of fewer than ``least`` code points."""
    key = line.strip(_WHITE).lower()
    if len(key) < least or least > 1 and len(key.decode()) < least:
        return None
    return xxhash.xxh3_128_digest(key)


def _texts(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _positions(keys: list[bytes], bits: int) -> np.ndarray:
    """Two bit numbers for each key."""
    return np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2) & np.uint64(bits - 1)


def _has(filter_: np.ndarray, places: np.ndarray) -> np.ndarray:
    return ((filter_[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def _set(filter_: np.ndarray, places: np.ndarray) -> None:
    places = places.ravel()
    np.bitwise_or.at(filter_, places >> np.uint64(3), np.uint8(1) << (places & np.uint64(7)).astype(np.uint8))


def _filters(docs: DataFrame, least: int, bits: int) -> DataFrame:
    """``block``, ``salt`` and the compressed blocks ``once`` and ``twice`` of every task's filters."""
    block = min(bits, _BLOCK_BITS) // 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for part in kernels.slices(batch, "text"):
                counts: dict[bytes, int] = {}
                for text in _texts(part.column(0)):
                    for key in {line_key(x, least) for x in text.split(b"\n")}:
                        if key is not None:
                            counts[key] = counts.get(key, 0) + 1
                if counts:
                    places = _positions(list(counts), bits)
                    again = np.fromiter(counts.values(), np.int64, len(counts)) > 1
                    _set(twice, places[again | _has(once, places)])
                    _set(once, places)
        rows = [
            (i, zlib.compress(once[at : at + block].tobytes(), 1), zlib.compress(twice[at : at + block].tobytes(), 1))
            for i, at in enumerate(range(0, bits // 8, block))
            if once[at : at + block].any()
        ]
        salt = TaskContext.get().partitionId() % _SALTS
        yield _blocks([(i, salt, a, b) for i, a, b in rows])

    return docs.select("text").mapInArrow(run, "block int, salt int, once binary, twice binary")


def _blocks(rows: list[tuple]) -> pa.RecordBatch:
    block, salt, once, twice = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.record_batch(
        [pa.array(block, pa.int32()), pa.array(salt, pa.int32()), pa.array(once, pa.binary()), pa.array(twice, pa.binary())],
        names=["block", "salt", "once", "twice"],
    )


def _joined(blocks: DataFrame, *keys: str) -> DataFrame:
    """One row for each value of the keys: its filters joined as they stream by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, once, twice = None, None, None
        packed = lambda x: zlib.compress(x.tobytes(), 1)
        for batch in batches:
            for row in batch.to_pylist():
                a, b = (np.frombuffer(zlib.decompress(row[c]), np.uint8) for c in ("once", "twice"))
                if at is not None and all(at[k] == row[k] for k in keys):
                    twice = twice | b | once & a
                    once = once | a
                else:
                    if at is not None:
                        yield _blocks([(at["block"], at["salt"], packed(once), packed(twice))])
                    at, once, twice = row, a, b
        if at is not None:
            yield _blocks([(at["block"], at["salt"], packed(once), packed(twice))])

    return (
        blocks.repartition(*keys).sortWithinPartitions(*keys)
        .mapInArrow(run, "block int, salt int, once binary, twice binary")
    )


def repeat_filter(docs: DataFrame, least: int = 1, bits: int = FILTER_BITS) -> np.ndarray:
    """The filter of keys that more than one row of ``docs`` (column ``text``) may hold: bits / 8 bytes."""
    joined = _joined(_joined(_filters(docs, least, bits), "block", "salt"), "block")
    size = min(bits, _BLOCK_BITS) // 8
    out = np.zeros(bits // 8, np.uint8)
    for row in joined.select("block", "twice").toArrow().to_pylist():
        out[row["block"] * size : (row["block"] + 1) * size] = np.frombuffer(zlib.decompress(row["twice"]), np.uint8)
    return out


def _confirmed(docs: DataFrame, twice, least: int, bits: int, min_documents: int) -> DataFrame:
    """``key``, ``n`` (documents) and ``first`` (id and line number of its first occurrence) of the exact repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bytes, list] = {}

        def rows() -> pa.RecordBatch:
            n, ids, lines = zip(*found.values(), strict=True) if found else ((), (), ())
            return pa.record_batch(
                [pa.array(list(found), pa.binary()), pa.array(n, pa.int64()), pa.array(ids, pa.int64()), pa.array(lines, pa.int64())],
                names=["key", "n", "doc_id", "line"],
            )

        for batch in batches:
            for part in kernels.slices(batch, "text"):
                held, owners, places = [], [], []
                for i, text in enumerate(_texts(part.column(1))):
                    first: dict[bytes, int] = {}
                    for line, own in enumerate(text.split(b"\n")):
                        if (key := line_key(own, least)) is not None:
                            first.setdefault(key, line)
                    held += first
                    places += first.values()
                    owners += [i] * len(first)
                if held:
                    ids = part.column(0).to_pylist()
                    for x in np.flatnonzero(_has(twice.value, _positions(held, bits))).tolist():
                        key, id_, line = held[x], ids[owners[x]], places[x]
                        if (row := found.get(key)) is None:
                            found[key] = [1, id_, line]
                        else:
                            row[0] += 1
                            if _before(id_, line, row[1], row[2]):
                                row[1:] = id_, line
                if len(found) > _FLUSH:
                    yield rows()
                    found.clear()
        yield rows()

    return (
        docs.mapInArrow(run, "key binary, n bigint, doc_id bigint, line bigint")
        .groupBy("key")
        .agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "line")).alias("first"))
        .where(F.col("n") >= min_documents)
    )


def _before(id_: int | None, line: int, other: int | None, other_line: int) -> bool:
    """The order of places: null ids first, then ids, then lines (as Spark orders structs)."""
    return (id_ is not None, id_ or 0, line) < (other is not None, other or 0, other_line)


def _rewritten(docs: DataFrame, goes: Callable[[pa.RecordBatch, list[list[bytes]]], list[set[int]]]) -> DataFrame:
    """Texts without the lines that ``goes`` names for each of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in kernels.slices(batch, "text"):
                split = [text.split(b"\n") for text in _texts(part.column(1))]
                gone = goes(part, split)
                kept = [
                    b"\n".join([x for i, x in enumerate(lines) if i not in out] if out else lines)
                    for lines, out in zip(split, gone, strict=True)
                ]
                yield pa.record_batch(
                    [
                        part.column(0), pa.array(kept, pa.binary()).cast(pa.string()),
                        pa.array([len(x) for x in split], pa.int64()), pa.array([len(x) for x in gone], pa.int64()),
                    ],
                    names=["doc_id", "text", "n_lines", "n_dropped"],
                )

    return docs.mapInArrow(run, "doc_id bigint, text string, n_lines bigint, n_dropped bigint")


def without_repeated_lines(
    docs: DataFrame, min_documents: int = MIN_DOCUMENTS, least: int = 1, keep_first: bool = False,
    filter_bits: int = FILTER_BITS, broadcast_keys: int = BROADCAST_KEYS,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """``doc_id``, ``text`` (lines that stay), ``n_lines`` (before) and ``n_dropped`` of every row.

    A line's key is the line without white space at both ends and with A-Z
    lower-cased; keys of at least ``least`` code points that stand in
    ``min_documents`` rows or more lose all their lines. With ``keep_first`` the
    occurrence of the smallest id (null ids first) and line stays; rows that
    share this id each keep it. A null or empty text is one empty line; each row
    is a document, repeated rows and rows with a null id too; other columns are
    not read; an empty table gives an empty result. ``filter_bits`` is a power of
    two. At least two documents must be asked for.
    """
    if min_documents < 2:
        raise ValueError("a repeated line stands in two documents at least")
    if filter_bits < 8 or filter_bits & (filter_bits - 1):
        raise ValueError("the bits of a filter are a power of two, 8 at least")
    spark = docs.sparkSession
    docs = docs.select(docs[id_column].cast("bigint").alias("doc_id"), docs[text_column].cast("string").alias("text"))
    twice = spark.sparkContext.broadcast(repeat_filter(docs, least, filter_bits))
    confirmed = stored(_confirmed(docs, twice, least, filter_bits, min_documents), "repeated-lines")
    if confirmed.count() <= broadcast_keys:
        known = spark.sparkContext.broadcast({r["key"]: r["first"] for r in confirmed.select("key", "first").toArrow().to_pylist()})

        def goes(part: pa.RecordBatch, split: list[list[bytes]]) -> list[set[int]]:
            out, repeated = [], known.value
            for id_, lines in zip(part.column(0).to_pylist(), split, strict=True):
                gone = set()
                for i, line in enumerate(lines):
                    first = repeated.get(line_key(line, least))
                    if first is not None and not (keep_first and first["doc_id"] == id_ and first["line"] == i):
                        gone.add(i)
                out.append(gone)
            return out

        return _rewritten(docs, goes)
    marks = _places(docs, twice, least, filter_bits).join(confirmed, "key")
    if keep_first:
        marks = marks.where(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("line") == F.col("first.line"))))
    marks = marks.groupBy("doc_id", "digest").agg(F.collect_set("line").alias("lines"))
    marks = marks.select(F.col("doc_id").alias("of"), F.col("digest").alias("of_digest"), "lines")
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (_digest() == F.col("of_digest"))
    return _rewritten(
        docs.join(marks, same, "left").select("doc_id", "text", "lines"),
        lambda part, split: [set(x or ()) for x in part.column(2).to_pylist()],
    )


def _digest() -> Column:
    return F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))


def _places(docs: DataFrame, twice, least: int, bits: int) -> DataFrame:
    """``key``, and where it stands, of every suspected line: ``doc_id``, ``digest`` of the text, ``line``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in kernels.slices(batch, "text"):
                texts = _texts(part.column(1))
                keys, owners, lines = [], [], []
                for i, text in enumerate(texts):
                    for line, own in enumerate(text.split(b"\n")):
                        if (key := line_key(own, least)) is not None:
                            keys.append(key)
                            owners.append(i)
                            lines.append(line)
                if not keys:
                    continue
                found = np.flatnonzero(_has(twice.value, _positions(keys, bits))).tolist()
                digests = [hashlib.md5(text).digest() for text in texts]
                rows = pa.array([owners[x] for x in found], pa.int64())
                yield pa.record_batch(
                    [
                        pa.array([keys[x] for x in found], pa.binary()), part.column(0).take(rows),
                        pa.array(digests, pa.binary()).take(rows), pa.array([lines[x] for x in found], pa.int64()),
                    ],
                    names=["key", "doc_id", "digest", "line"],
                )

    return docs.mapInArrow(run, "key binary, doc_id bigint, digest binary, line bigint")
