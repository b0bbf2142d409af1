"""Substring dedup: seeds from winnowed anchors, extended both ways to maximal repeats.

A window is LENGTH consecutive words. In each window the least hash of its
SEED-word runs (the leftmost of equals) is its anchor, so equal windows have
equal anchors at the same place. Only anchors that stand in several places are
followed: every place is joined with the first place of its anchor and the
match is extended both ways, as far as the windows of that anchor are the same;
neighbouring matches make up maximal repeats. Windows that differ from those of
the first place can only equal windows that differ too, and these (few) meet by
their own hash. The result is exact: a window is repeated if and only if its
words also start anywhere else.

Every text is shuffled twice (once to cut out the windows of its repeated
anchors, once to cut out the repeats), anchors and windows as hashes only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm import kernels
from bazaar.llm.storage import forget, stored

LENGTH = 35
SEED = 8
_PLACE_BITS = np.uint64(26)
_PLACE = np.uint64((1 << 26) - 1)


class _Windows:
    """Anchors of all windows of a chunk of texts."""

    def __init__(self, column: pa.Array, length: int):
        data, offsets = kernels.text_bytes(column)
        starts, ends, self.first = kernels.spans(data, offsets, kernels.SOLID)
        self.words = kernels.span_hashes(data, starts, ends)
        runs = kernels.grams(self.words, SEED)
        width = length - SEED + 1
        n = len(runs) - width + 1
        if n <= 0:
            self.windows = self.anchor = np.zeros(0, np.int64)
            self.runs = runs
            return
        if len(runs) >> int(_PLACE_BITS):
            raise ValueError("a text has more than 67 million words")
        least = runs & ~_PLACE | np.arange(len(runs), dtype=np.uint64)
        span = 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[: n], least[width - span :][:n])
        whole = kernels.inside_text(self.first, length, n)
        self.windows = np.flatnonzero(whole)
        self.anchor = (least[:n][whole] & _PLACE).astype(np.int64)
        self.runs = runs


def _anchors(docs: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in kernels.slices(batch, "text"):
                found = _Windows(part.column(2), length)
                if not len(found.anchor):
                    continue
                place = found.anchor[np.concatenate([[True], found.anchor[1:] != found.anchor[:-1]])]
                text = np.searchsorted(found.first, place, "right") - 1
                rows = pa.array(text)
                yield pa.record_batch(
                    [
                        part.column(0).take(rows),
                        part.column(1).take(rows),
                        pa.array((place - found.first[text]).astype(np.int32)),
                        pa.array(found.runs[place].view(np.int64)),
                    ],
                    names=["k1", "k2", "place", "anchor"],
                )

    return docs.select("k1", "k2", "text").mapInArrow(run, "k1 bigint, k2 bigint, place int, anchor bigint")


def _contexts(docs: DataFrame, seeds: DataFrame, length: int) -> DataFrame:
    """For each seed the hashes of the windows that it is the anchor of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in kernels.slices(batch, "text", 1_000_000):
                found = _Windows(part.column(2), length)
                seeds = part.column(3)
                counts = np.diff(np.asarray(seeds.offsets))
                flat = seeds.flatten().to_numpy(zero_copy_only=False)
                text = np.repeat(np.arange(part.num_rows), counts)
                place = (flat >> 1) + found.first[text]
                low = np.searchsorted(found.anchor, place)
                high = np.searchsorted(found.anchor, place, "right")
                starts = found.windows[low]  # every seed is the anchor of a window
                ends = np.cumsum(high - low)
                every = np.repeat(starts - ends + (high - low), high - low) + np.arange(ends[-1])
                hashes = kernels.span_hashes(found.words, every, every + length)
                rows = pa.array(text)
                yield pa.record_batch(
                    [
                        pa.array(found.runs[place].view(np.int64)),
                        part.column(0).take(rows),
                        part.column(1).take(rows),
                        pa.array((place - found.first[text]).astype(np.int32)),
                        pa.array((starts - found.first[text]).astype(np.int32)),
                        pa.BinaryArray.from_buffers(
                            pa.binary(), len(ends),
                            [None, pa.py_buffer(np.concatenate([[0], ends * 8]).astype(np.int32)), pa.py_buffer(hashes)],
                        ),
                        pa.array((flat & 1) == 1),
                    ],
                    names=["anchor", "k1", "k2", "place", "start", "hashes", "head"],
                )

    grouped = seeds.groupBy("k1", "k2").agg(F.collect_list(F.expr("place * 2L + int(head)")).alias("seeds"))
    grouped = grouped.select("k1", "k2", F.array_sort(F.array_distinct("seeds")).alias("seeds"))
    return (
        docs.select("k1", "k2", "text").dropDuplicates(["k1", "k2"]).join(grouped, ["k1", "k2"])
        .select("k1", "k2", "text", "seeds")
        .mapInArrow(run, "anchor bigint, k1 bigint, k2 bigint, place int, start int, hashes binary, head boolean")
    )


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All hashes of a binary column and their bounds."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return np.frombuffer(data.tobytes(), np.uint64), (offsets - offsets[0]).astype(np.int64) // 8


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare the windows of each place with those of the first place of the same anchor."""
    for batch in batches:
        col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        num = {n: col[n].to_numpy(zero_copy_only=False) for n in col if "hashes" not in n}
        mine, a = _flat(col["hashes"])
        theirs, b = _flat(col["o_hashes"])
        count, their_count = np.diff(a), np.diff(b)
        row = np.repeat(np.arange(len(count)), count)
        nth = np.arange(len(mine)) - a[row]
        shift = (num["o_place"] - num["o_start"]) - (num["place"] - num["start"])
        at = nth + shift[row]
        ok = (at >= 0) & (at < their_count[row])
        same = np.zeros(len(mine), bool)
        same[ok] = mine[ok] == theirs[b[row[ok]] + at[ok]]
        begin = same & ~np.concatenate([[False], same[:-1] & (row[1:] == row[:-1])])[: len(same)]
        finish = same & ~np.concatenate([same[1:] & (row[1:] == row[:-1]), [False]])[: len(same)]
        i, j = np.flatnonzero(begin), np.flatnonzero(finish)
        r, size = row[i], (j - i + 1).astype(np.int32)
        my_start = (num["start"][r] + nth[i]).astype(np.int32)
        their_start = (num["o_start"][r] + at[i]).astype(np.int32)
        rest = np.flatnonzero(~same)
        q = row[rest]
        take = {n: lambda rows, n=n: col[n].take(pa.array(rows)) for n in ("k1", "k2", "o_k1", "o_k2")}
        none32, none64 = lambda n: pa.nulls(n, pa.int32()), lambda n: pa.nulls(n, pa.int64())
        names = ["k1", "k2", "start", "n", "window", "o_k1", "o_k2", "o_start"]
        yield pa.record_batch([take["k1"](r), take["k2"](r), pa.array(my_start), pa.array(size), none64(len(r)), take["o_k1"](r), take["o_k2"](r), pa.array(their_start)], names=names)
        _, once = np.unique(np.stack([r * 0 + np.unique(num["anchor"][r], return_inverse=True)[1], their_start, size]), axis=1, return_index=True)
        s = r[once]
        yield pa.record_batch([take["o_k1"](s), take["o_k2"](s), pa.array(their_start[once]), pa.array(size[once]), none64(len(s)), take["k1"](s), take["k2"](s), pa.array(my_start[once])], names=names)
        yield pa.record_batch([take["k1"](q), take["k2"](q), pa.array((num["start"][q] + nth[rest]).astype(np.int32)), none32(len(q)), pa.array(mine[rest].view(np.int64)), none64(len(q)), none64(len(q)), none32(len(q))], names=names)


def repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Repeats by document key: ``k1, k2, start, n`` (n windows from word start) and one other place of each."""
    anchors = stored(_anchors(docs, length), "anchors")
    occurrence = F.xxhash64("k1", "k2", "place")
    several = anchors.groupBy("anchor").agg(F.count("*").alias("n"), F.min(occurrence).alias("least")).where("n > 1")
    seeds = anchors.join(several, "anchor").select("k1", "k2", "place", (occurrence == F.col("least")).alias("head"))
    contexts = stored(_contexts(docs, seeds, length), "contexts")
    forget(docs.sparkSession, anchors)
    heads = contexts.where("head").dropDuplicates(["anchor"]).select(
        "anchor", *[F.col(c).alias(f"o_{c}") for c in ("k1", "k2", "place", "start", "hashes")]
    )
    found = (
        contexts.where("NOT head").join(heads, "anchor")
        .select("anchor", "k1", "k2", "place", "start", "hashes", "o_k1", "o_k2", "o_place", "o_start", "o_hashes")
        .mapInArrow(_extend, "k1 bigint, k2 bigint, start int, n int, window bigint, o_k1 bigint, o_k2 bigint, o_start int")
    )
    found = stored(found, "matches")
    forget(docs.sparkSession, contexts)
    single = found.where("window IS NOT NULL").select("k1", "k2", "start", "window")
    again = single.groupBy("window").agg(F.count("*").alias("m"), F.min(F.xxhash64("k1", "k2", "start")).alias("least")).where("m > 1")
    single = single.join(again, "window").select(
        "k1", "k2", "start", F.lit(1).alias("n"), *[F.lit(None).cast(t).alias(c) for c, t in (("o_k1", "bigint"), ("o_start", "int"))]
    )
    return found.where("window IS NULL").select("k1", "k2", "start", "n", "o_k1", "o_start").union(single)


def without_repeats(
    docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` and ``repeats`` of every row.

    Words are runs of anything but ASCII white space. Each word that a repeated
    window of ``length`` words covers is removed; ``kept`` joins the others by
    one space; ``repeats`` lists the maximal runs of removed words as (start,
    length). A null or empty text has no words. Two rows of the same id and text
    repeat each other. A null id stays null. Other columns are not read. An
    empty table gives an empty result.
    """
    docs = docs.select(docs[id_column].cast("bigint").alias("doc_id"), docs[text_column].alias("text")).withColumns(
        {"k1": F.coalesce("doc_id", F.lit(-1)), "k2": F.xxhash64("doc_id", "text")}
    )
    found = repeats(docs, length)
    twice = docs.groupBy("k1", "k2").count().where("count > 1")
    cover = found.select("k1", "k2", F.expr("start * 4294967296L + n").alias("span"))
    cover = cover.union(twice.select("k1", "k2", F.lit(-1).cast("bigint")))
    cover = cover.groupBy("k1", "k2").agg(F.collect_set("span").alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, all_spans = (batch.column(i) for i in range(3))
            words_of, kept, removed, runs = [], [], [], []
            for text, own in zip(texts, all_spans, strict=True):
                words = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()
                words_of.append(len(words))
                if not own.is_valid:
                    kept.append(b" ".join(words))
                    removed.append(0)
                    runs.append([])
                    continue
                marks = np.zeros(len(words) + 1, np.int64)
                for span in own.values.to_pylist():
                    start, n = (0, len(words) - length + 1) if span == -1 else (span >> 32, span & 0xFFFFFFFF)
                    if n > 0:
                        marks[start] += 1
                        marks[start + n - 1 + length] -= 1
                gone = np.cumsum(marks[:-1]) > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                runs.append([{"start": int(a), "length": int(b - a)} for a, b in edges.reshape(-1, 2)])
                removed.append(int(gone.sum()))
                kept.append(b" ".join([words[i] for i in np.flatnonzero(~gone).tolist()]))
            yield pa.record_batch(
                [
                    ids,
                    pa.array(words_of, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array(runs, pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))),
                ],
                names=["doc_id", "n_words", "n_removed", "kept", "repeats"],
            )

    return (
        docs.join(cover, ["k1", "k2"], "left").select("doc_id", "text", "spans")
        .mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept string, repeats array<struct<start:int,length:int>>")
    )
