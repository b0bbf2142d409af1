"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

Every symbol (a hashed word, or the shape of a word) has a random index vector
with one nonzero component. A symbol's vector is the sum of the index vectors
of the words around all its occurrences in the whole corpus, which tasks add up
to a table of fixed size. A text is pooled to the means and deviations of its
words' vectors. The network is fitted on at most SAMPLE labelled rows and its
probabilities are calibrated by a temperature on a part that it has not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm import kernels

#: The most labelled rows that the network is fitted on (those with the least hash of their id).
SAMPLE = 20_000
THRESHOLD = 0.3
WORDS, SHAPES, SIZE = 8192, 128, 32
HIDDEN = 32
_PARTS = 64
_KIND = np.full(256, 3, np.uint8)  # other
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_KIND[0x30:0x3A] = 2
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True


def symbols(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word and shape symbol of every run of letters, digits or other marks, and words before each text."""
    data, offsets = kernels.text_bytes(column)
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    kind = _KIND[data]
    cut = np.ones(len(data) + 1, bool)
    cut[1:-1] = kind[1:] != kind[:-1]
    cut[offsets] = True
    bounds = np.flatnonzero(cut)
    solid = kind[bounds[:-1]] != 0
    starts, ends = bounds[:-1][solid], bounds[1:][solid]
    lower = np.where(_UPPER[data], data | 0x20, data)
    words = (kernels.span_hashes(lower, starts, ends) >> np.uint64(64 - 13)).astype(np.int64)
    length = np.minimum(np.log2(ends - starts).astype(np.int64), 4)
    shapes = ((kind[starts].astype(np.int64) * 2 + _UPPER[data[starts]]) * 2 + _UPPER[data[ends - 1]]) * 5 + length
    return words, shapes + WORDS, np.searchsorted(starts, offsets)


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """The place and the sign of the nonzero component of every symbol."""
    x = kernels.mix(np.arange(1, WORDS + SHAPES + 1, dtype=np.uint64))
    return (x % np.uint64(SIZE)).astype(np.int64), np.where(x >> np.uint64(63), 1.0, -1.0)


def _narrow(table: np.ndarray) -> np.ndarray:
    """In 32 bits where they do."""
    return table.astype(np.int32) if not len(table) or np.abs(table).max() < 1 << 31 else table


def _wide(raw: bytes) -> np.ndarray:
    short = (WORDS + SHAPES) // _PARTS * SIZE * 4
    return np.frombuffer(raw, np.int32 if len(raw) == short else np.int64).astype(np.int64)


def _context_sums(docs: DataFrame) -> DataFrame:
    """Each task's sums of index vectors, as ``part``s of the table of all symbols."""
    rows = (WORDS + SHAPES) // _PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sign = _index_vectors()
        total = np.zeros((WORDS + SHAPES) * SIZE)
        for batch in batches:
            for part in kernels.slices(batch, "text", 1_000_000):
                words, shapes, first = symbols(part.column(0))
                text = kernels.owner(first)
                for step in (1, 2):
                    same = text[step:] == text[:-step]
                    for mine, near in ((slice(step, None), slice(None, -step)), (slice(None, -step), slice(step, None))):
                        for of in (words, shapes):
                            row = of[mine][same] * SIZE
                            for seen in (words, shapes):
                                other = seen[near][same]
                                total += np.bincount(row + place[other], sign[other], len(total))
        table = _narrow(total.astype(np.int64)).reshape(_PARTS, rows * SIZE)
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        yield pa.record_batch(
            [
                pa.array(np.arange(_PARTS, dtype=np.int32)),
                pa.array(np.full(_PARTS, task % 32, np.int32)),
                pa.array([x.tobytes() for x in table], pa.binary()),
            ],
            names=["part", "salt", "sums"],
        )

    return docs.select("text").mapInArrow(run, "part int, salt int, sums binary")


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up the tables of a partition, part by part."""
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for part, salt, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            table = _wide(raw)
            sums[part, salt] = sums[part, salt] + table if (part, salt) in sums else table
    if sums:
        yield pa.record_batch(
            [
                pa.array([k[0] for k in sums], pa.int32()),
                pa.array([k[1] for k in sums], pa.int32()),
                pa.array([_narrow(x).tobytes() for x in sums.values()], pa.binary()),
            ],
            names=["part", "salt", "sums"],
        )


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The vector of every symbol over all texts: centred and of length one. The table's size is fixed."""
    schema = "part int, salt int, sums binary"
    some = _context_sums(docs).repartition("part", "salt").mapInArrow(_added, schema)
    every = some.withColumn("salt", F.lit(0)).repartition("part").mapInArrow(_added, schema)
    total = np.zeros((_PARTS, (WORDS + SHAPES) // _PARTS * SIZE))
    for part, _, raw in every.toLocalIterator():
        total[part] += _wide(raw)
    table = total.reshape(WORDS + SHAPES, SIZE)
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    table = np.divide(table, norm, out=np.zeros_like(table), where=norm > 0)
    table[:WORDS] -= table[:WORDS].mean(0)
    table[WORDS:] -= table[WORDS:].mean(0)
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    return np.divide(table, norm, out=np.zeros_like(table), where=norm > 0).astype(np.float32)


def pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Means and deviations of word vectors and means of shape vectors; zeros for a text without words."""
    words, shapes, first = symbols(column)
    out = np.zeros((len(column), 3 * SIZE), np.float32)
    some = np.flatnonzero(np.diff(first))
    if not len(some):
        return out
    begin, n = first[some], np.diff(first)[some][:, None]
    of = vectors[words]
    mean = np.add.reduceat(of, begin) / n
    square = np.add.reduceat(of * of, begin) / n
    out[some, :SIZE] = mean
    out[some, SIZE : 2 * SIZE] = np.sqrt(np.maximum(square - mean * mean, 0))
    out[some, 2 * SIZE :] = np.add.reduceat(vectors[shapes], begin) / n
    return out


@dataclass
class Model:
    """Word vectors and network; ``constant`` replaces the network where there is nothing to fit."""

    vectors: np.ndarray
    shift: np.ndarray | None = None
    scale: np.ndarray | None = None
    layers: tuple = ()
    temperature: float = 1.0
    constant: float | None = None

    def logits(self, features: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        hidden = np.maximum((features - self.shift) / self.scale @ w1 + b1, 0)
        return hidden @ w2 + b2

    def scores(self, column: pa.Array) -> np.ndarray:
        """A probability for each text."""
        if self.constant is not None:
            return np.full(len(column), self.constant)
        logits = self.logits(pooled(column, self.vectors)).astype(np.float64) / self.temperature
        return 1 / (1 + np.exp(-np.clip(logits, -50, 50)))


def _loss(logits: np.ndarray, labels: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - labels * logits))


def fit(features: np.ndarray, labels: np.ndarray, vectors: np.ndarray, epochs: int = 60) -> Model:
    """The network, by Adam on four fifths of the rows; the temperature on the rest. Deterministic."""
    n = len(labels)
    if n < 10 or labels.min() == labels.max():
        return Model(vectors, constant=float((labels.sum() + 1) / (n + 2)))
    rng = np.random.default_rng(7)
    order = rng.permutation(n)
    held, own = order[: n // 5], order[n // 5 :]
    shift = features[own].mean(0)
    scale = features[own].std(0) + 1e-4
    x, y = ((features - shift) / scale).astype(np.float32), labels.astype(np.float32)
    weights = [
        rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
        rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(()),
    ]
    weights = [w.astype(np.float32) for w in weights]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    best, best_loss, step, waited = [w.copy() for w in weights], np.inf, 0, 0
    for _ in range(epochs if n > 5000 else 4 * epochs):
        for rows in np.array_split(rng.permutation(own), max(1, len(own) // 128)):
            w1, b1, w2, b2 = weights
            raw = x[rows] @ w1 + b1
            hidden = np.maximum(raw, 0)
            error = (1 / (1 + np.exp(-(hidden @ w2 + b2))) - y[rows]) / len(rows)
            back = error[:, None] * w2 * (raw > 0)
            slopes = [x[rows].T @ back + 1e-4 * w1, back.sum(0), hidden.T @ error + 1e-4 * w2, error.sum()]
            step += 1
            for i, slope in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope * slope
                move = first[i] / (1 - 0.9**step) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
                weights[i] = (weights[i] - 2e-3 * move).astype(np.float32)
        w1, b1, w2, b2 = weights
        loss = _loss(np.maximum(x[held] @ w1 + b1, 0) @ w2 + b2, y[held])
        if loss < best_loss - 1e-5:
            best, best_loss, waited = [w.copy() for w in weights], loss, 0
        else:
            waited += 1
            if waited >= 12:
                break
    model = Model(vectors, shift, scale, tuple(best))
    logits = model.logits(features[held])
    grid = np.exp(np.linspace(np.log(0.5), np.log(8), 60))
    model.temperature = float(grid[np.argmin([_loss(logits / t, y[held]) for t in grid])])
    return model


def train(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_column: str = "doc_id", text_column: str = "text"
) -> Model:
    """Word vectors of all texts and a network fitted on labelled ones whose crc32 remainder by 5 is not 0.

    Rows of a null quality or id are no labels; several labels of one document
    count by their mean. With fewer than ten labelled rows, or only one label,
    the score is the smoothed share of label 1.
    """
    spark = docs.sparkSession
    docs = docs.select(docs[id_column].cast("bigint").alias("doc_id"), docs[text_column].alias("text"))
    vectors = word_vectors(docs)
    known = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .where(~held_out("doc_id"))
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    )
    table = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).toArrow()
    order = np.argsort(table["doc_id"].to_numpy())
    ids, marks = table["doc_id"].to_numpy()[order], table["label"].to_numpy()[order]
    if not len(ids):
        return fit(np.zeros((0, 3 * SIZE), np.float32), np.zeros(0), vectors)
    shared = spark.sparkContext.broadcast((ids, vectors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = shared.value
        for batch in batches:
            own = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(ids, own), len(ids) - 1)
            few = batch.filter(pa.array((ids[at] == own) & np.asarray(batch.column(0).is_valid())))
            for part in kernels.slices(few, "text", 500_000):
                features = pooled(part.column(1), vectors)
                yield pa.record_batch(
                    [part.column(0), pa.array([x.tobytes() for x in features], pa.binary())], names=["doc_id", "features"]
                )

    rows = docs.mapInArrow(run, "doc_id bigint, features binary").dropDuplicates(["doc_id"]).orderBy("doc_id").toArrow()
    found = rows["doc_id"].to_numpy()
    features = np.frombuffer(b"".join(rows["features"].to_pylist()), np.float32).reshape(-1, 3 * SIZE)
    return fit(features, marks[np.searchsorted(ids, found)].astype(np.float64), vectors)


def held_out(id_column: str):
    return F.crc32(F.col(id_column).cast("string")) % 5 == 0


def scored(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` of every row.

    Null and empty texts are scored too (as a text without words); a null id
    stays null; repeated rows are scored each; other columns are not read; an
    empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in kernels.slices(batch, "text", 500_000):
                yield pa.record_batch(
                    [part.column(0), pa.array(shared.value.scores(part.column(1)), pa.float64())], names=["doc_id", "score"]
                )

    docs = docs.select(docs[id_column].cast("bigint").alias("doc_id"), docs[text_column].alias("text"))
    return docs.mapInArrow(run, "doc_id bigint, score double")


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, whose score reaches the threshold. No row is moved."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in kernels.slices(batch, text_column, 500_000):
                score = shared.value.scores(part.column(part.schema.get_field_index(text_column)))
                yield part.filter(pa.array(score >= threshold))

    return docs.mapInArrow(run, docs.schema)
