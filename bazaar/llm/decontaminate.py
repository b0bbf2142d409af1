"""Benchmark decontamination: MinHash containment search, partitioned by item size.

A short test item inside a long document has a tiny Jaccard similarity with
it, so signatures of whole documents can't find it. What bears the search is
the item's own MinHash sketch: a document that holds a share c of the item's
shingles holds each sketch element with probability c. Items are partitioned by
their number of shingles; each partition has a sketch size and the least number
of hits at which a contained item is missed with probability below 1e-6. Small
items are sketched whole. Documents with enough hits are verified by exact
containment over all shingles. Documents are only scanned, never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm import kernels

SHINGLE = 5
CONTAINMENT = 0.8
SKETCH = 24
#: Items are searched for in blocks whose texts have about so many bytes together; a block is what tasks are sent.
BLOCK_BYTES = 8_000_000
_FILTER_BITS = 20


def least_hits(size: int, containment: float) -> int:
    """Hits in a sketch of ``size`` elements below which a contained item falls with probability under 1e-6."""
    below, hits = 0.0, 0
    while True:
        below += math.comb(size, hits) * containment**hits * (1 - containment) ** (size - hits)
        if below > 1e-6:
            return max(1, hits)
        hits += 1


class ItemIndex:
    """Sketches and shingle sets of a block of items."""

    def __init__(self, texts: pa.Array, containment: float):
        of, hashes, _, first = kernels.shingles(texts, SHINGLE)
        long_enough = np.diff(first)[of] >= SHINGLE  # shorter items have no shingle of five words
        of, hashes = of[long_enough], hashes[long_enough]
        order = np.lexsort((hashes, of))
        of, hashes = of[order], hashes[order]
        new = np.ones(len(of), bool)
        new[1:] = (of[1:] != of[:-1]) | (hashes[1:] != hashes[:-1])
        self.item, self.hash = of[new], hashes[new]
        self.bounds = np.searchsorted(self.item, np.arange(len(texts) + 1))
        sizes = np.diff(self.bounds)
        # partitions by size: up to SKETCH shingles (sketched whole), then one for each doubling
        partition = np.ceil(np.log2(np.maximum(sizes, 1) / SKETCH)).clip(0).astype(int)
        whole = np.ceil(sizes * containment - 1e-9).astype(int)
        sampled = {p: least_hits(SKETCH, containment) for p in np.unique(partition) if p}
        self.needed = np.where(partition == 0, whole, [sampled.get(p, 0) for p in partition])
        rank = np.arange(len(self.item)) - self.bounds[self.item]  # hashes are in order within an item
        keep = rank < SKETCH
        order = np.argsort(self.hash[keep], kind="stable")
        self.sketch_hash, self.sketch_item = self.hash[keep][order], self.item[keep][order]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self.sketch_hash >> np.uint64(64 - _FILTER_BITS)] = True
        self.containment = containment

    def search(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, item and containment of all pairs at or above the threshold."""
        texts, hashes, _, _ = kernels.shingles(column, SHINGLE)
        near = np.flatnonzero(self.filter[hashes >> np.uint64(64 - _FILTER_BITS)])
        low = np.searchsorted(self.sketch_hash, hashes[near])
        high = np.searchsorted(self.sketch_hash, hashes[near], "right")
        hit = high > low
        near, low, count = near[hit], low[hit], (high - low)[hit]
        none = np.zeros(0, np.int64)
        if not len(near):
            return none, none, none.astype(float)
        place = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
        found = np.unique(np.stack([np.repeat(texts[near], count), self.sketch_item[place], place]), axis=1)
        pairs, hits = np.unique(found[:2], axis=1, return_counts=True)
        pairs = pairs[:, hits >= self.needed[pairs[1]]]
        shares = np.zeros(pairs.shape[1])
        own = np.unique(pairs[0])
        order = np.argsort(texts, kind="stable")
        bounds = np.searchsorted(texts[order], own), np.searchsorted(texts[order], own, "right")
        sets = {t: hashes[order[a:b]] for t, a, b in zip(own.tolist(), *bounds, strict=True)}
        for i, (text, item) in enumerate(pairs.T.tolist()):
            wanted = self.hash[self.bounds[item] : self.bounds[item + 1]]
            shares[i] = np.isin(wanted, sets[text]).mean()
        good = shares >= self.containment - 1e-12
        return pairs[0][good], pairs[1][good], shares[good]


def _blocks(items: DataFrame, id_column: str, text_column: str) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Ids and texts of the items, in blocks of bounded size."""
    items = items.select(items[id_column].cast("bigint").alias("id"), items[text_column].alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / BLOCK_BYTES))
    for i in range(n):
        block = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == i).orderBy("id", "text").toArrow()
        if block.num_rows:
            columns = block.combine_chunks().to_batches()[0]
            yield columns.column(0), columns.column(1)


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    containment: float = CONTAINMENT,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """``doc_id``, ``item_id`` and ``containment`` of every document that holds an item.

    Containment is the share of the item's distinct five-word shingles that
    the document has too; words are lower-cased runs of letters and digits.
    Items of fewer than five words (also null and empty ones) are never found.
    A null document id stays null; repeated rows give their pairs each; other
    columns are not read; empty tables give an empty result.
    """
    spark = docs.sparkSession
    docs = docs.select(docs[id_column].cast("bigint").alias("doc_id"), docs[text_column].alias("text"))
    schema = "doc_id bigint, item_id bigint, containment double"
    result = spark.createDataFrame([], schema)
    for ids, texts in _blocks(items, item_id_column, item_text_column):
        index = spark.sparkContext.broadcast((ids, ItemIndex(texts, containment)))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            ids, search = index.value
            for batch in batches:
                for part in kernels.slices(batch, "text"):
                    rows, found, shares = search.search(part.column(1))
                    yield pa.record_batch(
                        [part.column(0).take(pa.array(rows)), ids.take(pa.array(found)), pa.array(shares)],
                        names=["doc_id", "item_id", "containment"],
                    )

        result = result.union(docs.mapInArrow(run, schema))
    return result


def decontaminated(
    docs: DataFrame,
    items: DataFrame,
    containment: float = CONTAINMENT,
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """The rows of ``docs``, with all columns, that hold no item (see ``contaminated``). No row is moved."""
    spark = docs.sparkSession
    for _, texts in _blocks(items, item_id_column, item_text_column):
        index = spark.sparkContext.broadcast(ItemIndex(texts, containment))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in kernels.slices(batch, text_column):
                    rows, _, _ = index.value.search(part.column(part.schema.get_field_index(text_column)))
                    keep = np.ones(part.num_rows, bool)
                    keep[rows] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
