"""Training-order materialisation: every sequence in its global slot of fixed-stride shards.

1. Each task encodes its texts to token ids and fills sequences with them, text
   after text with an end mark between, so that only the last sequence of a
   task is short. Sequences are stored once, compressed; from there on nothing
   depends on reading the documents again.
2. Sequences are counted by task (one number each comes to the driver), so each
   has a running number. A keyed Feistel permutation with cycle-walking maps
   this to its slot in training order: a bijection that needs no sort key, no
   shared state and no shuffle buffer.
3. Sequences go straight to the task that holds their range of slots, are sorted
   there and written by Spark's writer, several shards a task, one folder a
   shard. This is done in rounds, each for a part of the slots, so that only a
   part of all sequences is on its way at a time. Every record has the same
   length, so a reader finds slot s in shard s // per_shard at byte
   (s % per_shard) * stride, and resumes wherever it stopped.
"""

from __future__ import annotations

import base64
import gc
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.llm import kernels
from bazaar.llm.feistel import permute_all
from bazaar.llm.storage import bounded_batches, forget
from bazaar.session import work_folder

LENGTH = 1024
PER_SHARD = 8192
#: Shards that one task writes at most, and parts in which the slots are written.
TASK_SHARDS = 8
ROUNDS = 4
#: Record: running number, id of the document its first token is from, that token's place in the text, number of
#: tokens; then the tokens and a line feed.
HEADER = np.dtype([("number", "<i8"), ("doc_id", "<i8"), ("skip", "<i4"), ("n", "<i4")])
NO_ID = -(1 << 63)
#: Fixed value: how the byte-level vocabulary cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ROWS = 256
_loaded: dict[int, object] = {}


def encoding(content: bytes):
    """The encoder of a file of ranks, once in each Python worker."""
    import tiktoken

    key = hash(content)
    if key not in _loaded:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}
        _loaded.clear()
        _loaded[key] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _loaded[key]


def _vocabulary_size(content: bytes) -> int:
    return 1 + max(int(line.split()[1]) for line in content.splitlines())


def _filled(docs: DataFrame, content, mark: int, length: int) -> DataFrame:
    """``task``, ``seq``, ``doc_id``, ``skip`` and ``ids`` (16 bits each) of all sequences, filled across texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, task = encoding(content.value), TaskContext.get().partitionId()
        held: list[np.ndarray] = []  # tokens that are not in a sequence yet, from the text in which the first stands
        starts, owners = [], []  # where texts begin in the stream of tokens, and whose they are
        at = begin = seq = 0  # ends of the stream, and of its sequences

        def cut(whole: bool) -> pa.RecordBatch:
            nonlocal held, begin, seq, starts, owners
            tokens = np.concatenate(held) if held else np.zeros(0, np.uint16)
            n = len(tokens) // length if whole else -(-len(tokens) // length)
            first = begin + np.arange(n) * length
            text = np.searchsorted(np.array(starts, np.int64), first, "right") - 1
            bounds = np.minimum(np.arange(n + 1) * length, len(tokens)) * 2
            out = pa.record_batch(
                [
                    pa.array(np.full(n, task, np.int32)), pa.array(seq + np.arange(n)),
                    pa.array(np.array(owners, np.int64)[text] if n else np.zeros(0, np.int64)),
                    pa.array((first - np.array(starts, np.int64)[text]).astype(np.int32) if n else np.zeros(0, np.int32)),
                    pa.BinaryArray.from_buffers(
                        pa.binary(), n, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(tokens[: int(bounds[-1]) // 2].tobytes())]
                    ),
                ],
                names=["task", "seq", "doc_id", "skip", "ids"],
            )
            held, begin, seq = [tokens[int(bounds[-1]) // 2 :]], begin + int(bounds[-1]) // 2, seq + n
            keep = max(0, int(np.searchsorted(np.array(starts, np.int64), begin, "right")) - 1)
            starts, owners = starts[keep:], owners[keep:]
            return out

        for batch in batches:
            for part in kernels.slices(batch, "text"):
                for id_, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if not text:
                        continue
                    ids = own.encode_ordinary(text)
                    ids.append(mark)
                    held.append(np.array(ids, np.uint16))
                    starts.append(at)
                    owners.append(NO_ID if id_ is None else id_)
                    at += len(ids)
                if at - begin >= _ROWS * length:
                    yield cut(True)
        yield cut(True)
        yield cut(False)

    return docs.mapInArrow(run, "task int, seq bigint, doc_id bigint, skip int, ids binary")


def materialise(
    docs: DataFrame, path: str, key: int, ranks_file: str, length: int = LENGTH, per_shard: int = PER_SHARD,
    rounds: int = ROUNDS, id_column: str = "doc_id", text_column: str = "text",
) -> None:
    """Write the token ids of all texts below ``path``, as shards in training order with a layout file.

    ``ranks_file`` is a byte-level vocabulary (token in base 64 and rank in a
    line) of fewer than 65,536 tokens, read on the driver; the end mark is the
    first id after them. A sequence has ``length`` tokens; the last one of a task
    may have fewer and is padded with end marks. Null and empty texts have no
    tokens and no end mark; a null id is written as NO_ID; repeated rows are
    written each; other columns are not read; an empty table writes only the
    layout.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(ranks_file, "rb") as file:
        content = file.read()
    mark = _vocabulary_size(content)
    if mark > 0xFFFF:
        raise ValueError("the vocabulary needs more than 16 bits an id")
    docs = docs.select(docs[id_column].cast("bigint").alias("doc_id"), docs[text_column].cast("string").alias("text"))
    kept = work_folder(spark, "sequences")
    _filled(docs, spark.sparkContext.broadcast(content), mark, length).write.option("compression", "zstd").parquet(kept)
    filled = spark.read.schema("task int, seq bigint, doc_id bigint, skip int, ids binary").parquet(kept)
    sizes = {row.task: row.n for row in filled.groupBy("task").agg(F.count("*").alias("n")).collect()}
    starts, total = np.zeros(max(sizes, default=-1) + 1, np.int64), 0
    for task in sorted(sizes):
        starts[task], total = total, total + sizes[task]
    layout = {
        "sequences": total, "length": length, "per_shard": per_shard, "stride": HEADER.itemsize + 2 * length + 1,
        "bytes_per_token": 2, "end_mark": mark,
    }
    spark.createDataFrame([(json.dumps(layout, sort_keys=True),)], "value string").coalesce(1).write.text(f"{path}/layout")
    shards = -(-total // per_shard)
    for i in range(rounds if total else 0):
        low, high = shards * i // rounds, shards * (i + 1) // rounds
        if low < high:
            _write_shards(filled, f"{path}/shards", starts, total, key, layout, low, high)
            gc.collect()  # a round's shuffle files go when nothing refers to them any more
            spark._jvm.System.gc()
    forget(spark, filled)


def _write_shards(filled: DataFrame, path: str, starts, total: int, key: int, layout: dict, low: int, high: int) -> None:
    """Write the shards from ``low`` to ``high`` (exclusive)."""
    spark = filled.sparkSession
    places = spark.sparkContext.broadcast(starts)
    per_shard, length, mark = layout["per_shard"], layout["length"], layout["end_mark"]
    stride = layout["stride"]
    wanted = max(-(-(high - low) // TASK_SHARDS), min(high - low, spark.sparkContext.defaultParallelism))
    each = -(-(high - low) // wanted)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            number = places.value[batch.column("task").to_numpy()] + batch.column("seq").to_numpy()
            slots = permute_all(number, total, key)
            shard = slots // per_shard
            mine = np.flatnonzero((shard >= low) & (shard < high))
            head = np.zeros(len(mine), HEADER)
            head["number"] = number[mine]
            for name in ("doc_id", "skip"):
                head[name] = batch.column(name).to_numpy()[mine]
            bodies = batch.column("ids").take(pa.array(mine)).to_pylist()
            head["n"] = [len(b) // 2 for b in bodies]
            records = [packed.compress(h.tobytes() + b) for h, b in zip(head, bodies, strict=True)]
            yield pa.record_batch(
                [pa.array(((shard[mine] - low) // each).astype(np.int32)), pa.array(slots[mine]), pa.array(records, pa.binary())],
                names=["part", "slot", "packed"],
            )

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = zstandard.ZstdDecompressor()
        padding = np.full(length, mark, "<u2").tobytes()
        for batch in batches:
            records = [opened.decompress(x) for x in batch.column("packed").to_pylist()]
            values = [x + padding[: stride - 1 - len(x)] for x in records]
            slots = batch.column("slot").to_numpy()
            yield pa.record_batch(
                [pa.array((slots // per_shard).astype(np.int32)), batch.column("slot"), pa.array(values, pa.binary())],
                names=["shard", "slot", "record"],
            )

    (
        filled.mapInArrow(place, "part int, slot bigint, packed binary")
        .repartitionById(-(-(high - low) // each), F.col("part"))
        .select("slot", "packed")
        .mapInArrow(unpack, "shard int, slot bigint, record binary")
        .sortWithinPartitions("shard", "slot")
        .select("shard", F.col("record").cast("string").alias("value"))
        .write.mode("append").partitionBy("shard").option("lineSep", "\n").text(path)
    )


def sequences(spark: SparkSession, path: str, from_slot: int = 0) -> DataFrame:
    """``slot, number, doc_id, skip, n_tokens, tokens, shard, at`` of all records from a slot on.

    The rows of a shard come together and in order of slots; shards before the
    slot's own are not read. ``tokens`` holds 16 bits an id.
    """
    layout = json.loads(spark.read.text(f"{path}/layout").first().value)
    schema = "slot bigint, number bigint, doc_id bigint, skip int, n_tokens int, tokens binary, shard int, at bigint"
    if not layout["sequences"]:
        return spark.createDataFrame([], schema)
    stride, per_shard = layout["stride"], layout["per_shard"]
    files = spark.read.format("binaryFile").load(f"{path}/shards").where(F.col("shard") >= from_slot // per_shard)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                records = np.frombuffer(content.as_buffer(), np.uint8).reshape(-1, stride)
                slots = shard * per_shard + np.arange(len(records))
                keep = slots >= from_slot
                records, slots = records[keep], slots[keep]
                head = np.ascontiguousarray(records[:, : HEADER.itemsize]).view(HEADER)[:, 0]
                bodies = [r[HEADER.itemsize : HEADER.itemsize + 2 * n].tobytes() for r, n in zip(records, head["n"].tolist(), strict=True)]
                ids = pa.array(head["doc_id"], mask=head["doc_id"] == NO_ID)
                yield pa.record_batch(
                    [pa.array(slots), pa.array(head["number"]), ids, pa.array(head["skip"]), pa.array(head["n"]),
                     pa.array(bodies, pa.binary()), pa.array(np.full(len(slots), shard, np.int32)), pa.array((slots % per_shard) * stride)],
                    names=["slot", "number", "doc_id", "skip", "n_tokens", "tokens", "shard", "at"],
                )

    return files.select("shard", "content").mapInArrow(unpack, schema)
