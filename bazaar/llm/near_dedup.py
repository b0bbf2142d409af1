"""Near duplicates: improved consistent weighted sampling over TF-IDF shingles.

1. One pass counts in how many texts each shingle feature stands (features are
   shingle hashes modulo a fixed number, so the table of weights is bounded).
2. One pass draws consistent weighted samples of every text and hashes them in
   bands. Texts with the same words are one representative from here on.
3. Every member of a band's bucket is compared with the bucket's first member,
   by the weighted Jaccard similarity of the whole texts.
4. Members of a bucket that are still in different components are compared
   pairwise where the distances to the first member (a metric) and the samples
   allow a similarity above the threshold. Texts that are left at this step get
   more samples, since many of their pairs may lie close to the threshold (a
   similarity at it has fewer samples in common than asked for with probability
   0.001).
5. Components of the verified links are the classes.

The weight of a shingle in a text is its count times its inverse document
frequency, which is scaled to 1..2 and rounded to an eighth of an octave.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm import kernels
from bazaar.llm.components import components
from bazaar.llm.storage import bounded_batches, release, stored

SHINGLE = 5
SIMILARITY = 0.8
FEATURES = 1 << 18
BANDS, ROWS = 20, 5  # at a similarity of 0.8 a pair shares no band with probability 4e-4, at 0.9 with 1e-8
FINE = 7 * 49  # samples of texts that stars of buckets leave apart
_SIGMAS = 3.25  # standard deviations of the share of common samples
_DRAWS = 1 << 16
_SHIFT = np.float32(128)  # makes every score positive, so its bits order like it
_HASH_BITS = np.uint64(44)
_draw_tables: list[np.ndarray] = []


def _uniform(stream: int, n: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on the stream alone."""
    with np.errstate(over="ignore"):
        x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(stream * 7919 + 1)
        return (kernels.mix(kernels.mix(x)) >> np.uint64(11)).astype(np.float64) / 2.0**53 + 1e-17


def draw_tables() -> list[np.ndarray]:
    """1 / r, r, ln c and b of the draws, from Gamma(2, 1), Gamma(2, 1) and the unit interval.

    Three fields of 16 bits of a shingle's own hash for a function pick r, c and
    b, so a function has 2^48 distinct draws and all functions share the tables.
    """
    if not _draw_tables:
        u = [_uniform(i, _DRAWS) for i in range(5)]
        r, c, b = -np.log(u[0] * u[1]), -np.log(u[2] * u[3]), u[4]
        _draw_tables[:] = [x.astype(np.float32) for x in (1 / r, r, np.log(c), b)]
    return _draw_tables


def weighted_shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, 44-bit hash and count of the distinct shingles of each text, in order."""
    texts, hashes, _, _ = kernels.shingles(column, SHINGLE)
    keys = np.sort(texts.astype(np.uint64) << _HASH_BITS | hashes >> np.uint64(64 - 44))
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(keys)))
    keys = keys[first]
    return (keys >> _HASH_BITS).astype(np.int64), keys & np.uint64((1 << 44) - 1), counts


def _features(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(FEATURES - 1)).astype(np.int64)


def _document_frequencies(docs: DataFrame) -> DataFrame:
    """Texts per feature; each task adds its own up first. Feature -1 counts the texts with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, texts_seen = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for part in kernels.slices(batch, "text"):
                texts, hashes, _ = weighted_shingles(part.column(0))
                counts += np.bincount(_features(hashes), minlength=FEATURES)
                texts_seen += len(np.unique(texts))
        used = np.flatnonzero(counts)
        if texts_seen:
            yield pa.record_batch(
                [pa.array(np.append(used, -1), pa.int32()), pa.array(np.append(counts[used], texts_seen), pa.int64())],
                names=["feature", "n"],
            )

    return docs.select("text").mapInArrow(run, "feature int, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))


def idf_levels(docs: DataFrame) -> np.ndarray:
    """The weight level of every feature: 8 log2(1 + scaled idf), at most FEATURES bytes on the driver."""
    table = _document_frequencies(docs).toArrow().to_pandas()
    counts = np.zeros(FEATURES, np.float64)
    known = table[table.feature >= 0]
    counts[known.feature.to_numpy()] = known.n.to_numpy()
    total = float(table[table.feature < 0].n.sum())
    idf = np.log((1 + total) / (1 + np.minimum(counts, total))) / np.log(max(2.0, 1 + total))
    return np.rint(8 * np.log2(1 + idf)).astype(np.uint8)


def _drawn(
    texts: np.ndarray, hashes: np.ndarray, counts: np.ndarray, level_of: np.ndarray, n: int
) -> tuple[np.ndarray, np.ndarray]:
    """Where each text's shingles begin, and its first ``n`` samples.

    Improved consistent weighted sampling with the exact weight w of a shingle:
    t = floor(ln w / r + b), and the shingle with the least ln c - r (t - b + 1)
    is the sample, together with its t, which the score determines.
    """
    inverse, shape, scale, offset = draw_tables()
    weight = (np.log(counts) + np.log(2.0) / 8 * level_of[_features(hashes)]).astype(np.float32)
    first = np.flatnonzero(np.concatenate([[True], texts[1:] != texts[:-1]]))
    samples = np.empty((len(first), n), np.uint32)
    halves = np.empty((len(hashes), 2), "<u4")  # of the number to minimise: the shingle's own hash below its score
    whole = halves.view("<u8")[:, 0]
    score, step, place = np.empty(len(hashes), np.float32), np.empty(len(hashes), np.float32), np.empty(len(hashes), np.int64)
    with np.errstate(over="ignore"):
        odd = kernels.mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)
        spread = kernels.mix(hashes.copy())
        for k in range(n):
            own = spread * odd[k]
            fields = own.view("<u2").reshape(-1, 4)
            place[:] = fields[:, 3]
            b = offset[fields[:, 1]]
            np.multiply(weight, inverse[place], out=score)
            score += b
            np.floor(score, out=step)
            step -= b
            step += np.float32(1)
            step *= shape[place]
            np.subtract(scale[fields[:, 2]], step, out=score)
            score += _SHIFT
            halves[:, 1] = score.view(np.uint32)
            halves[:, 0] = own >> np.uint64(8)
            samples[:, k] = kernels.mix(np.minimum.reduceat(whole, first)) & np.uint64(0xFFFFFFFF)
    return first, samples


def _fine_samples(docs: DataFrame, ids: DataFrame, levels) -> DataFrame:
    """``rep`` and ``fine``: seven bits of each of ``FINE`` samples, seven samples in a number; NULL for an id of several rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in kernels.slices(batch, "text", 500_000):
                texts, hashes, counts = weighted_shingles(part.column(1))
                if len(texts):
                    first, samples = _drawn(texts, hashes, counts, levels.value, FINE)
                    packed = np.zeros((len(first), FINE // 7, 8), np.uint8)
                    packed[:, :, :7] = (samples & np.uint32(0x7F)).reshape(len(first), -1, 7)
                    packed = packed.view(np.int64)[:, :, 0]
                    bounds = pa.array(np.arange(len(first) + 1) * packed.shape[1], pa.int32())
                    yield pa.record_batch(
                        [
                            part.column(0).take(pa.array(texts[first])),
                            pa.ListArray.from_arrays(bounds, pa.array(packed.ravel())),
                        ],
                        names=["rep", "fine"],
                    )

    wanted = docs.join(ids, docs.id == ids.rep, "left_semi").select("id", "text")
    return (
        wanted.mapInArrow(run, "rep bigint, fine array<bigint>")
        .groupBy("rep").agg(F.when(F.count("*") == 1, F.first("fine")).alias("fine"))
    )


def _signatures(docs: DataFrame, levels) -> DataFrame:
    """``id``, 128 bits of the words, and the samples of every text with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level_of = levels.value
        for batch in batches:
            for part in kernels.slices(batch, "text", 500_000):
                texts, hashes, counts = weighted_shingles(part.column(1))
                if not len(texts):
                    continue
                first, samples = _drawn(texts, hashes, counts, level_of, BANDS * ROWS)
                _, _, words, bounds = kernels.shingles(part.column(1), 1)
                rows = texts[first]
                with np.errstate(over="ignore"):
                    place = np.arange(len(words), dtype=np.uint64) - np.repeat(bounds[:-1], np.diff(bounds)).astype(np.uint64)
                    wide = kernels.mix(words + place * np.uint64(0x9E3779B97F4A7C15))
                    begin = bounds[rows]
                    one = np.add.reduceat(wide, begin)
                    two = np.add.reduceat(kernels.mix(wide ^ np.uint64(0x5851F42D4C957F2D)), begin)
                yield pa.record_batch(
                    [
                        part.column(0).take(pa.array(rows)),
                        pa.array(one.view(np.int64)),
                        pa.array(two.view(np.int64)),
                        pa.array([x.tobytes() for x in samples], pa.binary()),
                    ],
                    names=["id", "key1", "key2", "samples"],
                )

    return docs.select("id", "text").mapInArrow(run, "id bigint, key1 bigint, key2 bigint, samples binary")


def weighted_jaccard(left: pa.Array, right: pa.Array, level_of: np.ndarray) -> np.ndarray:
    """Of the texts in the same rows: the sum of least weights over the sum of greatest."""
    sums, sides = [], []
    for column in (left, right):
        texts, hashes, counts = weighted_shingles(column)
        weights = counts * np.exp2(level_of[_features(hashes)] / 8.0)
        sums.append(np.bincount(texts, weights, minlength=len(left)))
        sides.append((texts.astype(np.uint64) << _HASH_BITS | hashes, weights))
    (a, wa), (b, wb) = sides
    if not len(a) or not len(b):
        return np.zeros(len(left))
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    same = b[at] == a
    shared = np.bincount((a[same] >> _HASH_BITS).astype(np.int64), np.minimum(wa[same], wb[at[same]]), len(left))
    total = sums[0] + sums[1] - shared
    return np.divide(shared, total, out=np.zeros(len(left)), where=total > 0)


def _verified(pairs: DataFrame, docs: DataFrame, levels) -> DataFrame:
    """Pairs (a, b) of ids with the similarity of their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in kernels.slices(batch, "text_a", 500_000):
                found = weighted_jaccard(part.column(2), part.column(3), levels.value)
                yield pa.record_batch([part.column(0), part.column(1), pa.array(found)], names=["a", "b", "similarity"])

    one = docs.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    two = docs.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return (
        pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b")
        .mapInArrow(run, "a bigint, b bigint, similarity double")
    )


def near_duplicates(
    docs: DataFrame, similarity: float = SIMILARITY, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id``, ``class_id`` (smallest id of the class) and ``n_links`` of each document.

    Links are the verified pairs of different texts; ``n_links`` counts those of
    the document's text. Documents of the same words are in one class without a
    link. Texts without words (null, empty, punctuation) are alone in their
    class. Texts of one to four words have one shingle of all of them. Rows
    with a null id take no part; several rows of one id are one document, which
    joins the classes of all its texts. Other columns are not read. An empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(docs[id_column].cast("bigint").alias("id"), docs[text_column].alias("text")).where("id IS NOT NULL")
    levels = spark.sparkContext.broadcast(idf_levels(docs))
    signed = stored(_signatures(docs, levels), "signatures")
    groups = signed.groupBy("key1", "key2").agg(F.min("id").alias("rep"))
    members = stored(signed.join(groups, ["key1", "key2"]).select("id", "rep", "key1", "key2"), "members")
    reps = signed.join(
        members.where("id = rep").select("id", "key1", "key2").distinct(), ["id", "key1", "key2"]
    ).dropDuplicates(["id", "key1", "key2"])
    part = 4 * ROWS
    bands = stored(
        reps.select(
            F.col("id").alias("rep"),
            F.posexplode(
                F.array(*[F.xxhash64(F.expr(f"substring(samples, {i * part + 1}, {part})")) for i in range(BANDS)])
            ).alias("band", "bucket"),
        ),
        "bands",
    )
    first = bands.groupBy("band", "bucket").agg(F.min("rep").alias("head"), F.count("*").alias("n")).where("n > 1")
    buckets = stored(bands.join(first.drop("n"), ["band", "bucket"]), "buckets")
    stars = buckets.where("rep <> head").select(F.col("rep").alias("a"), F.col("head").alias("b")).distinct()
    compared = stored(_verified(stars, docs, levels), "compared")
    release(spark, bands)
    same = members.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    links = compared.where(F.col("similarity") >= similarity).select("a", "b")
    roots = components(links)

    # Members of a bucket that its first member does not join: the most alike pairs first, since their
    # links leave few components for the rest.
    far = compared.select(F.col("a").alias("rep"), F.col("b").alias("head"), (1 - F.col("similarity")).alias("far"))
    every, high, sampled = links, FINE + 1, None
    for below in (0, _SIGMAS):
        low = int(_expected(FINE, similarity, below))
        near = stored(_placed(buckets, far, roots), "placed")
        placed = stored(_apart(near), "apart")
        if sampled is None:  # a later pass has no other texts, since components only grow
            ids = stored(placed.select("rep").distinct(), "apart-ids")
            own = reps.withColumnRenamed("id", "rep").join(ids, "rep", "left_semi")
            own = own.groupBy("rep").agg(F.when(F.count("*") == 1, F.first("samples")).alias("samples"))
            sampled = stored(own.join(_fine_samples(docs, ids, levels), "rep", "left"), "sampled")
        others = stored(placed.join(sampled, "rep"), "unlike")
        rest = stored(_unlike(others, similarity, low, high).distinct(), "rest")
        release(spark, near, placed, others)
        if not rest.isEmpty():
            more = stored(_verified(rest, docs, levels).where(F.col("similarity") >= similarity), "more")
            every = every.union(more.select("a", "b"))
            release(spark, rest, roots)
            roots = components(every)
        high = low
    release(spark, ids, sampled, signed, buckets, roots)
    roots = components(every.union(same))
    degree = (
        every.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("n"))
    )
    linked = members.join(degree, "rep").groupBy("id").agg(F.sum("n").alias("n_links"))
    return (
        docs.select("id").distinct()
        .join(roots, "id", "left").join(linked, "id", "left")
        .select(
            F.col("id").alias("doc_id"),
            F.coalesce("root", "id").alias("class_id"),
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        )
    )


def _expected(samples: int, similarity: float, sigmas: float) -> float:
    """Common samples of a pair at the similarity, less some standard deviations."""
    return samples * similarity - sigmas * (samples * similarity * (1 - similarity)) ** 0.5


def _placed(buckets: DataFrame, far: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of buckets with their component and their distance to the first member."""
    return (
        buckets.join(roots.select(F.col("id").alias("rep"), "root"), "rep", "left")
        .withColumn("root", F.coalesce("root", "rep"))
        .join(far, ["rep", "head"], "left")
    )


def _apart(placed: DataFrame) -> DataFrame:
    """Members, other than the first, of buckets whose texts are in different components."""
    heads = placed.where("rep = head").select("band", "bucket", F.col("root").alias("head_root"))
    placed = placed.where("rep <> head").join(heads, ["band", "bucket"])
    split = placed.where("root <> head_root").select("band", "bucket").distinct()
    return placed.join(split, ["band", "bucket"], "left_semi")


def _unlike(placed: DataFrame, similarity: float, low: int, high: int) -> DataFrame:
    """Pairs of one bucket in different components that may be as alike as asked.

    Both differ from the first member by distances that are no further apart
    than the similarity allows (its complement is a metric), share at least
    ``low`` and fewer than ``high`` samples. An id of several texts has no
    samples to judge by; its pairs come in the first pass. A pair that shares several buckets comes from the first of them only:
    there it was compared already if one of it is the first member, and a bound
    that fails in one bucket rules it out in all. The conditions are part of
    the join.
    """
    others = placed.where("root <> head_root").select(
        *[F.col(c).alias(f"x_{c}") for c in ("band", "bucket", "rep", "root", "far", "samples", "fine")]
    )
    agreed = _agreement("x_fine", "fine").between(low, high - 1)
    near = (
        (F.col("x_band") == F.col("band")) & (F.col("x_bucket") == F.col("bucket")) & (F.col("x_root") != F.col("root"))
        & ((F.col("root") == F.col("head_root")) | (F.col("x_rep") < F.col("rep")))
        & (F.abs(F.col("x_far") - F.col("far")) <= 1 - similarity + 1e-9)
        & ~F.coalesce(_shares_earlier_band("x_samples", "samples", "x_band"), F.lit(False))
        & F.coalesce(agreed, F.lit(high > FINE))
    )
    return others.join(placed, near).select(F.least("x_rep", "rep").alias("a"), F.greatest("x_rep", "rep").alias("b"))


def _shares_earlier_band(one: str, two: str, band: str):
    """Whether two texts share a bucket in a band before ``band``."""
    part, shared = 4 * ROWS, F.lit(False)
    for i in range(BANDS - 1):
        same = F.expr(f"substring({one}, {i * part + 1}, {part})") == F.expr(f"substring({two}, {i * part + 1}, {part})")
        shared = shared | ((F.col(band) > i) & same)
    return shared


def _agreement(one: str, two: str):
    """How many fine samples two texts share: seven bits each, so adding 0x7F carries where they differ."""
    differ = F.lit(0)
    for i in range(FINE // 7):
        x = F.col(one)[i].bitwiseXOR(F.col(two)[i]) + F.lit(0x7F7F7F7F7F7F7F)
        differ = differ + F.bit_count(x.bitwiseAND(F.lit(0x80808080808080)))
    return F.lit(FINE) - differ


def deduplicated(docs: DataFrame, similarity: float = SIMILARITY, id_column: str = "doc_id", text_column: str = "text"):
    """The rows of ``docs`` that remain when one document of each class stays: its smallest id.

    All columns are kept, whatever they are called. Rows with a null id stay. Of
    several rows with the id that stays, one does.
    """
    classes = near_duplicates(docs, similarity, id_column, text_column)
    own, gone, twice = (_unused(docs, name) for name in ("id", "gone", "twice"))
    key = docs[id_column].cast("bigint").alias(own)
    dropped = classes.where("class_id <> doc_id").select(F.col("doc_id").alias(own), F.lit(True).alias(gone))
    repeated = docs.select(key).groupBy(own).agg(F.count("*").alias(twice)).where(F.col(own).isNotNull() & (F.col(twice) > 1))
    marks = stored(dropped.join(repeated.withColumn(twice, F.lit(True)), own, "full"), "marks")
    release(docs.sparkSession)
    rows = docs.select("*", key).join(marks, own, "left").where(F.col(gone).isNull())
    once = rows.where(F.col(twice).isNull())
    more = rows.where(F.col(twice)).dropDuplicates([own])
    return once.unionByName(more).select(*[f"`{c}`" for c in docs.columns])


def _unused(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name
