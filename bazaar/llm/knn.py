"""Exact top-k search: a Voronoi kNN join for inner products.

Vectors are assigned to the cell of their nearest pivot; each cell is stored
with its radius. A query is first answered within its own cell, which gives a
lower bound of its k-th score. By Cauchy-Schwarz a cell with pivot p and radius
r holds no score above q.p + |q| r, so a group of queries needs only the cells
whose bound reaches the group's lower bounds. Cells are cut into blocks of
bounded size; a task takes one group of queries and some blocks, keeps a
running top k and hands on k rows a query at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm.storage import stored

#: Pivots: the vectors with the least hash. Their number bounds the summaries (pivots and radii) that tasks are sent.
PIVOTS = 64
BLOCK = 2048
GROUP = 512
_EXACT = 2.0**52


def quantised(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = 64) -> DataFrame:
    """``id`` and ``v`` = floor(scale * component) as doubles; vectors that are null or hold a null, NaN or infinity are left out."""
    x = vectors[vector_column].cast("array<double>").alias("x")
    rows = vectors.select(vectors[id_column].cast("bigint").alias("id"), x).where("size(x) > 0")
    rows = rows.where(~F.exists("x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    return rows.select("id", F.transform("x", lambda x: F.floor(F.lit(scale) * x).cast("double")).alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products, exact: in doubles where no sum can leave their integers, else in Python integers."""
    if not queries.size or not rows.size:
        return np.zeros((len(queries), len(rows)), np.int64)
    if np.abs(queries).max() * np.abs(rows).max() * queries.shape[1] < _EXACT:
        return (queries @ rows.T).astype(np.int64)
    as_integers = np.vectorize(int, otypes=[object])
    return as_integers(queries).dot(as_integers(rows).T)


def _packed(rows: DataFrame, pivots: np.ndarray, size: int, salts: int) -> DataFrame:
    """Rows of (cell, block of at most ``size`` vectors)."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = shared.value
        square = (pivots * pivots).sum(1)
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                part = batch.slice(at, 8192)
                v = _matrix(part.column(1))
                near = np.argmin(square[None] - 2 * (v @ pivots.T), axis=1) if len(v) else np.zeros(0, int)
                far = np.sqrt(((v - pivots[near]) ** 2).sum(1))
                yield pa.record_batch(
                    [pa.array(near, pa.int32()), part.column(0), pa.array([x.tobytes() for x in v], pa.binary()), pa.array(far)],
                    names=["cell", "id", "v", "far"],
                )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, ids, vectors, far = -1, [], [], 0.0

        def block() -> pa.RecordBatch:
            return pa.record_batch(
                [pa.array([cell], pa.int32()), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                 pa.array([b"".join(vectors)], pa.binary()), pa.array([far]), pa.array([ids], pa.list_(pa.int64()))],
                names=["cell", "ids", "matrix", "radius", "members"],
            )

        for batch in batches:
            for c, i, v, f in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if ids and (c != cell or len(ids) >= size):
                    yield block()
                    ids, vectors, far = [], [], 0.0
                cell = c
                ids.append(i)
                vectors.append(v)
                far = max(far, f)
        if ids:
            yield block()

    cells = rows.mapInArrow(assign, "cell int, id bigint, v binary, far double")
    cells = cells.repartition("cell", F.pmod(F.xxhash64("id"), F.lit(salts))).sortWithinPartitions("cell", "id")
    return cells.mapInArrow(pack, "cell int, ids binary, matrix binary, radius double, members array<bigint>")


def _solve(pairs: DataFrame, k: int) -> DataFrame:
    """The k best of each query over the blocks it is paired with; each task sums up what it has read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, queries, matrix, best = None, None, None, []

        def result() -> pa.RecordBatch:
            rows = [(q, i, s) for q, top in zip(queries.tolist(), best, strict=True) for s, i in top]
            return pa.record_batch(
                [pa.array([r[j] for r in rows], pa.int64()) for j in range(3)], names=["query_id", "vec_id", "score"]
            )

        for batch in batches:
            for row in range(batch.num_rows):
                g, q_ids, q_matrix, ids, block = (batch.column(j)[row].as_py() for j in range(5))
                if g != group:
                    if group is not None:
                        yield result()
                    group, queries = g, np.frombuffer(q_ids, np.int64)
                    matrix = np.frombuffer(q_matrix).reshape(len(queries), -1)
                    best = [[] for _ in range(len(queries))]
                own = np.frombuffer(ids, np.int64)
                scores = _products(matrix, np.frombuffer(block).reshape(len(own), -1))
                for i in range(len(queries)):
                    line = scores[i]
                    if len(line) > k + 1:  # the k-th best here and all its ties, one more for the query itself
                        rows = np.flatnonzero(line >= np.partition(line, len(line) - k - 1)[len(line) - k - 1])
                    else:
                        rows = np.arange(len(line))
                    found = [(int(line[r]), int(own[r])) for r in rows if own[r] != queries[i]]
                    best[i] = sorted(best[i] + found, key=lambda x: (-x[0], x[1]))[:k]
        if group is not None:
            yield result()

    pairs = pairs.select("group_id", "q_ids", "q_matrix", "ids", "matrix")
    pairs = pairs.sortWithinPartitions("group_id")
    return pairs.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    window = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k greatest inner products of every query, ties to the smaller id.

    Both inputs are (id, v) of ``quantised``; all vectors have the same number
    of components. A query's own id is no candidate. Null ids take no part;
    several vectors of one id are one candidate, with its best score. Fewer
    candidates than k give fewer rows; empty inputs give an empty result.
    """
    spark = vectors.sparkSession
    vectors = stored(vectors.where("id IS NOT NULL").dropDuplicates(["id", "v"]), "vectors")
    picked = vectors.orderBy(F.xxhash64("id"), "id").limit(PIVOTS).toArrow()
    if not picked.num_rows:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    pivots = _matrix(picked["v"].combine_chunks())
    count = vectors.count()
    salts = max(1, math.ceil(count / len(pivots) / BLOCK))
    blocks = stored(_packed(vectors, pivots, BLOCK, salts).drop("members"), "blocks")
    groups = _packed(queries.where("id IS NOT NULL").dropDuplicates(["id", "v"]), pivots, GROUP, 1)
    groups = groups.select(
        F.xxhash64("cell", "ids").alias("group_id"), F.col("cell").alias("q_cell"), F.col("ids").alias("q_ids"),
        F.col("matrix").alias("q_matrix"), "members",
    )
    groups = stored(groups, "groups")
    radius = np.full(len(pivots), -1.0)
    for row in blocks.groupBy("cell").agg(F.max("radius").alias("r")).toLocalIterator():
        radius[row.cell] = row.r
    own = stored(_solve(groups.join(blocks, groups.q_cell == blocks.cell), k), "own")
    bounds = _best(own, k).groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("n"))
    bounds = bounds.where(F.col("n") >= k)
    shared = spark.sparkContext.broadcast((pivots, radius))

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, radius = shared.value
        for batch in batches:
            out = []
            for g, cell, ids, raw, own_ids, least in zip(*(batch.column(j).to_pylist() for j in range(6)), strict=True):
                q_ids = np.frombuffer(ids, np.int64)
                matrix = np.frombuffer(raw).reshape(len(q_ids), -1)
                known = dict(zip(own_ids, least, strict=True))
                low = np.array([known.get(i, -np.inf) for i in q_ids.tolist()], np.float64)
                high = matrix @ pivots.T + np.linalg.norm(matrix, axis=1)[:, None] * radius
                high += 1e-9 * (np.abs(high) + 1)
                use = (high >= low[:, None]).any(0) & (radius >= 0)
                use[cell] = False
                out += [(g, int(c)) for c in np.flatnonzero(use)]
            yield pa.record_batch(
                [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int32())], names=["group_id", "cell"]
            )

    members = groups.select("group_id", F.explode("members").alias("query_id"))
    lists = members.join(bounds, "query_id").groupBy("group_id").agg(
        F.collect_list("query_id").alias("own_ids"), F.collect_list("least").alias("least")
    )  # at most GROUP queries
    empty = F.array().cast("array<bigint>")
    pairs = (
        groups.join(lists, "group_id", "left")
        .select("group_id", "q_cell", "q_ids", "q_matrix", F.coalesce("own_ids", empty).alias("a"), F.coalesce("least", empty).alias("b"))
        .mapInArrow(needed, "group_id bigint, cell int")
    )
    rest = _solve(pairs.join(blocks, "cell").join(groups, "group_id").repartition("group_id", F.pmod(F.xxhash64("ids"), F.lit(8))), k)
    every = own.union(rest).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return _best(every, k).select("query_id", "rank", "vec_id", "score")

