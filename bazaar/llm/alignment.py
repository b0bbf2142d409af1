"""Cross-tokenizer alignment: byte groups of two tokenizers by diagonal run skipping, and corpus-wide link counts.

Both tokenizers cut a text into byte ranges; offsets where a token of each ends
cut the text into groups. Where the two agree token by token, their arrays of
ends are equal at a fixed shift of the index. ``runs`` probes such a stretch
with slices of doubling length, jumps it, resolves the next irregular group
step by step, and goes on with the new shift.

1. A text falls apart at blanks that follow a letter or sign: neither tokenizer
   has a token across such a place (for the second this is looked up in its
   vocabulary). A task encodes and aligns every distinct segment once and puts
   texts together from them. Where a vocabulary has such tokens, whole texts are the segments.
2. Every text gets its groups, and the distinct linked id pairs with how often
   each is linked; this table is written once.
3. Spark counts the texts of every pair. Where the counts fit a checked bound
   they are sent to the tasks; beyond it the pairs are joined with them.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.llm import kernels
from bazaar.llm.storage import stored

PART_BYTES = 2_000_000
#: Segments, and bytes of them, that a task remembers.
CACHED_SEGMENTS = 300_000
CACHED_BYTES = 32_000_000
#: Pairs whose counts are sent to every task: 13 bytes each.
BROADCAST_PAIRS = 1 << 21
_SLICE = 8
_ENCODED = 1000  # segments that a library gets at once
_SMALL_GROUP = 4096  # token pairs
#: Fixed values of the byte-level alphabet: bytes that stand for themselves; the others follow from 256 on.
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_loaded: dict[int, tuple[ByteLevel, Pieces]] = {}


class ByteLevel:
    """Tokenizer A: a byte-level vocabulary file of the tokenizers library."""

    def __init__(self, content: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_str(content.decode())
        self.own.encode_special_tokens = True  # their strings in a text are plain text
        self.own.no_padding()
        self.own.no_truncation()
        letters = {chr(b): b for b in _PLAIN}
        letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}
        self.bytes = [b""] * self.own.get_vocab_size(with_added_tokens=True)
        for token, i in self.own.get_vocab(with_added_tokens=True).items():
            if set(token) <= set(letters):
                self.bytes[i] = bytes(letters[c] for c in token)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.own.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces:
    """Tokenizer B: a sentencepiece model, which puts a blank before a text itself."""

    def __init__(self, content: bytes):
        import sentencepiece

        self.own = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.bytes, self.whole_texts = [], False
        for i in range(self.own.get_piece_size()):
            piece = self.own.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.own.is_byte(i) else piece.replace("▁", " ").encode())
            self.whole_texts |= "▁" in piece.lstrip("▁")

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts, each without its first blank; a blank alone is the piece of it (the library puts none before nothing)."""
        blank = self.own.piece_to_id("▁")
        return [ids or [blank] for ids in self.own.encode([x[1:] for x in texts], num_threads=1)]


class _Tokens:
    """The tokens of many segments in a row: ids, their bytes' ends, and the number of each segment's."""

    def __init__(self, tokenizer: ByteLevel | Pieces, strings: list[str]):
        ids: list[int] = []
        counts = []
        for at in range(0, len(strings), _ENCODED):
            for own in tokenizer.encode(strings[at : at + _ENCODED]):
                ids += own
                counts.append(len(own))
        self.counts = np.array(counts, np.int64)
        self.ids = np.array(ids, np.int64)
        parts = list(map(tokenizer.bytes.__getitem__, ids))
        self.sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        self.joined = b"".join(parts)
        self.owner = np.repeat(np.arange(len(strings)), self.counts)

    def fits(self, texts: list[bytes]) -> np.ndarray:
        """Whether the bytes of each segment's tokens are its own."""
        ends = np.concatenate([[0], np.cumsum(self.sizes)])[np.concatenate([[0], np.cumsum(self.counts)])].tolist()
        return np.array([self.joined[x:y] == text for x, y, text in zip(ends[:-1], ends[1:], texts, strict=True)], bool)

    def keep(self, segments: np.ndarray) -> None:
        kept = segments[self.owner]
        self.ids, self.sizes, self.owner = self.ids[kept], self.sizes[kept], self.owner[kept]


def tokenizers(a: bytes, b: bytes) -> tuple[ByteLevel, Pieces]:
    """The parsed files, once in each Python worker."""
    key = hash((a, b))
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = ByteLevel(a), Pieces(b)
    return _loaded[key]


def runs(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Tokens of each side in the groups that end arrays ``a`` and ``b`` (with equal last ends) cut.

    Returns for every group the number of tokens before its end, for a and for b.
    """
    ends_a: list[int] = []
    ends_b: list[int] = []
    i = j = 0
    n = len(a)
    while i < n:
        width = _SLICE
        while a[i : i + width] == b[j : j + width] and i < n:  # the stretch goes on at this shift
            stop = min(i + width, n)
            ends_a.extend(range(i + 1, stop + 1))
            ends_b.extend(range(j + 1, j + stop - i + 1))
            j += stop - i
            i = stop
            width *= 2
        if i >= n:
            break
        while width > 1:  # its end lies within the last slice
            width //= 2
            if a[i : i + width] == b[j : j + width]:
                ends_a.extend(range(i + 1, i + width + 1))
                ends_b.extend(range(j + 1, j + width + 1))
                i += width
                j += width
        x, y = a[i], b[j]
        while x != y:  # one irregular group; j - i is the new shift after it
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        i += 1
        j += 1
        ends_a.append(i)
        ends_b.append(j)
    return ends_a, ends_b


def _segment_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where texts begin, and blanks that follow a visible ASCII character or a two-byte one that is no white space."""
    solid = (data > 0x20) & (data < 0x7F)
    solid[1:] |= (data[1:] >= 0x80) & (data[:-1] >= 0xC3) & (data[:-1] <= 0xDF)
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = (data[1:] == 0x20) & solid[:-1]
    cut[offsets] = True
    return np.flatnonzero(cut[:-1])


class Aligner:
    """Encodes and aligns texts; keeps the segments it has met up to a bound of memory."""

    def __init__(self, a: ByteLevel, b: Pieces):
        self.a, self.b = a, b
        self.base = 2 * len(a.bytes)  # an id with what follows it: for a at 2 id, for b from here on
        words = [f"{i}{end}" for i in range(len(a.bytes)) for end in ",|"]
        self.words = pa.array(words + [f"{i}{end}" for i in range(len(b.bytes)) for end in ",;"])
        self.forget()

    def forget(self) -> None:
        none = np.zeros(0, np.int64)
        self.known, self.place = np.zeros(0, np.uint64), none
        self.sizes = np.zeros((0, 4), np.int64)  # tokens of a, tokens of b, groups, links; -1 where bytes differ
        self.groups = pa.array([], pa.string())
        self.pairs, self.times = none, none
        self.pair_ends = np.zeros(1, np.int64)
        self.held = 0

    def _learn(self, texts: list[bytes], hashes: np.ndarray) -> None:
        strings = [x.decode() for x in texts]
        a, b = _Tokens(self.a, strings), _Tokens(self.b, strings)
        fits = a.fits(texts) & b.fits(texts)
        a.keep(fits)
        b.keep(fits)
        # a segment's end is an end of both, so no group spans two
        to_a, to_b = (np.array(x, np.int64) for x in runs(np.cumsum(a.sizes).tolist(), np.cumsum(b.sizes).tolist()))
        from_a, from_b = (np.concatenate([[0], x[:-1]]) if len(x) else x for x in (to_a, to_b))
        owner, n_a, n_b = a.owner[from_a], to_a - from_a, to_b - from_b
        n = len(texts)
        sizes = np.stack(
            [
                np.bincount(a.owner, minlength=n), np.bincount(b.owner, minlength=n), np.bincount(owner, minlength=n),
                np.rint(np.bincount(owner, n_a * n_b, n)).astype(np.int64),
            ],
            axis=1,
        )
        sizes[~fits] = -1
        written = self._written(a, b, to_a, to_b, from_b, n_a, n_b, n)
        segment, pairs, times = _segment_pairs(a.ids, b.ids, from_a, from_b, n_a, n_b, owner)
        base = len(self.sizes)
        self.sizes = np.concatenate([self.sizes, sizes])
        self.groups = pa.concat_arrays([self.groups, written])
        self.pairs = np.concatenate([self.pairs, pairs])
        self.times = np.concatenate([self.times, times])
        self.pair_ends = np.concatenate([self.pair_ends, self.pair_ends[-1] + np.cumsum(np.bincount(segment, minlength=n))])
        known = np.concatenate([self.known, hashes])
        place = np.concatenate([self.place, base + np.arange(n)])
        order = np.argsort(known)
        self.known, self.place = known[order], place[order]
        self.held += sum(map(len, texts))

    def _written(self, a: _Tokens, b: _Tokens, to_a, to_b, from_b, n_a, n_b, n: int) -> pa.Array:
        """The groups of every segment as text, each group with a semicolon after it."""
        tokens = np.empty(len(a.ids) + len(b.ids), np.int64)
        last = np.zeros(len(a.ids), bool)
        last[to_a - 1] = True
        tokens[np.arange(len(a.ids)) + np.repeat(from_b, n_a)] = 2 * a.ids + last
        last = np.zeros(len(b.ids), bool)
        last[to_b - 1] = True
        tokens[np.arange(len(b.ids)) + np.repeat(to_a, n_b)] = self.base + 2 * b.ids + last
        counts = np.bincount(a.owner, minlength=n) + np.bincount(b.owner, minlength=n)
        bounds = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
        return pc.binary_join(pa.ListArray.from_arrays(bounds, self.words.take(pa.array(tokens))), "")

    def align(self, column: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """Of each text: sizes (a, b, groups, links) and its groups as text; then its distinct pairs, how
        often each is linked, and the bounds of the texts in both."""
        data, offsets = kernels.text_bytes(pc.binary_join_element_wise(" ", pc.fill_null(column, ""), ""))
        empty = np.diff(offsets) == 1
        starts = offsets[:-1] if self.b.whole_texts else _segment_starts(data, offsets)
        ends = np.append(starts[1:], len(data))
        first = np.searchsorted(starts, offsets)
        hashes = kernels.span_hashes(data, starts, ends)
        if len(self.groups) > CACHED_SEGMENTS or self.held > CACHED_BYTES:
            self.forget()
        distinct, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.known, distinct), max(len(self.known) - 1, 0))
        new = self.known[at] != distinct if len(self.known) else np.ones(len(distinct), bool)
        if new.any():
            raw = data.tobytes()
            rows = sample[new]
            self._learn([raw[x:y] for x, y in zip(starts[rows].tolist(), ends[rows].tolist(), strict=True)], distinct[new])
        places = self.place[np.searchsorted(self.known, distinct)][which]
        sizes = self.sizes[places]
        texts = len(offsets) - 1
        wrong = np.bincount(kernels.owner(first)[sizes[:, 0] < 0], minlength=texts) > 0
        wrong |= empty
        total = np.zeros((texts, 4), np.int64)
        owner = kernels.owner(first)
        kept = ~wrong[owner]
        for c in range(4):
            total[:, c] = np.bincount(owner[kept], sizes[kept, c], texts)
        every = pa.ListArray.from_arrays(pa.array(first, pa.int32()), self.groups.take(pa.array(places)))
        groups = pc.if_else(pa.array(wrong), "", pc.utf8_rtrim(pc.binary_join(every, ""), ";"))
        # segments of each text with their number, then the pairs of these
        keys, seen = np.unique(owner[kept] << 32 | places[kept], return_counts=True)
        text, place = keys >> 32, keys & 0xFFFFFFFF
        n = self.pair_ends[place + 1] - self.pair_ends[place]
        begin = np.cumsum(n) - n
        index = np.repeat(self.pair_ends[place] - begin, n) + np.arange(int(n.sum()))
        pair, times, text = self.pairs[index], self.times[index] * np.repeat(seen, n), np.repeat(text, n)
        text, pair, times = _summed(text, pair, times)
        return total, groups, pair, times, np.searchsorted(text, np.arange(texts + 1))


def _segment_pairs(ids_a, ids_b, from_a, from_b, n_a, n_b, owner) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct id pairs of each segment's groups, in order of segments, with how often each is linked."""
    small = n_a * n_b <= _SMALL_GROUP
    n = (n_a * n_b)[small]
    ends = np.cumsum(n)
    group = np.repeat(np.flatnonzero(small), n)
    k = np.arange(int(n.sum())) - np.repeat(ends - n, n)
    pairs = [ids_a[from_a[group] + k // n_b[group]] << 32 | ids_b[from_b[group] + k % n_b[group]]]
    segments, times = [owner[group]], [np.ones(len(group), np.int64)]
    for g in np.flatnonzero(~small).tolist():  # a long group: its distinct ids, not its tokens, are paired
        x, many_x = np.unique(ids_a[from_a[g] : from_a[g] + n_a[g]], return_counts=True)
        y, many_y = np.unique(ids_b[from_b[g] : from_b[g] + n_b[g]], return_counts=True)
        pairs.append((x[:, None] << 32 | y).ravel())
        times.append((many_x[:, None] * many_y).ravel())
        segments.append(np.full(len(x) * len(y), owner[g]))
    return _summed(np.concatenate(segments), np.concatenate(pairs), np.concatenate(times))


def _summed(owner: np.ndarray, pair: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, pair) in order, with the sums of times."""
    order = np.lexsort((pair, owner))
    owner, pair, times = owner[order], pair[order], times[order]
    head = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (owner[1:] != owner[:-1]))) if len(pair) else np.zeros(0, np.int64)
    return owner[head], pair[head], np.add.reduceat(times, head) if len(head) else times


_ROW = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint"


def aligned(
    docs: DataFrame, byte_level_file: str, piece_file: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Groups and links of each row's text: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``groups`` (``a1,a2|b1;a3|b2,b3``), and ``pairs`` (id of a << 32 | id of b) with ``times``.

    The first tokenizer encodes a blank and the text, the second the text (and
    adds a blank). Special strings are plain text. Null and empty texts, and
    texts whose tokens do not join to the blank and the text byte for byte (a
    text with U+2581, say), have no tokens: zeros and empty values. A null id
    stays null, repeated rows are aligned each, other columns are not read, an
    empty table gives an empty result. Both files are read on the driver; their
    size does not depend on the data.
    """
    with open(byte_level_file, "rb") as one, open(piece_file, "rb") as two:
        files = docs.sparkSession.sparkContext.broadcast((one.read(), two.read()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*tokenizers(*files.value))
        for batch in batches:
            for part in kernels.slices(batch, "text", PART_BYTES):
                total, groups, pairs, times, bounds = aligner.align(part.column(1))
                bounds = pa.array(bounds, pa.int32())
                yield pa.record_batch(
                    [
                        part.column(0), *[pa.array(total[:, c]) for c in range(4)], groups,
                        pa.ListArray.from_arrays(bounds, pa.array(pairs)),
                        pa.ListArray.from_arrays(bounds, pa.array(times)),
                    ],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"],
                )

    return docs.select(docs[id_column].cast("bigint").alias("doc_id"), docs[text_column].cast("string").alias("text")).mapInArrow(
        run, f"doc_id bigint, {_ROW}, groups string, pairs array<bigint>, times array<bigint>"
    )


def pair_counts(links: DataFrame) -> DataFrame:
    """``pair``, ``n`` (rows that hold it linked) and ``best`` (no pair of its first id has more)."""
    counts = stored(links.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pair-counts")
    token = F.shiftright("pair", 32)
    most = counts.groupBy(token.alias("token")).agg(F.max("n").alias("most"))
    return counts.join(most, token == F.col("token")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def link_statistics(
    docs: DataFrame, byte_level_file: str, piece_file: str, id_column: str = "doc_id", text_column: str = "text",
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """``doc_id``, the sizes of ``aligned``, ``n_best``, ``count_sum`` and ``groups_sha256`` of each row.

    The count of an id pair is the number of rows, of the whole table, that hold
    it linked. ``count_sum`` adds it up over the links of a row; ``n_best`` counts
    the links whose count is the highest of their first id's pairs. A row
    without tokens has zeros and an empty digest. Edge cases as in ``aligned``.
    """
    spark = docs.sparkSession
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    sizes = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    found = aligned(docs, byte_level_file, piece_file, id_column, text_column)
    links = stored(
        found.select(F.monotonically_increasing_id().alias("row"), *sizes, digest.alias("groups_sha256"), "pairs", "times"),
        "links",
    )
    counts = stored(pair_counts(links), "pair-best")
    kept = [*sizes, "n_best", "count_sum", "groups_sha256"]
    if counts.count() > broadcast_pairs:
        each = links.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", "x.pairs", "x.times")
        sums = (
            each.join(counts, each.pairs == counts.pair).groupBy("row")
            .agg(F.sum(F.col("times") * F.col("n")).alias("count_sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"))
        )
        zero = {"count_sum": 0, "n_best": 0}
        return links.join(sums, "row", "left").fillna(zero, ["count_sum", "n_best"]).select(kept)
    table = counts.toArrow()
    order = pc.sort_indices(table["pair"])
    known = spark.sparkContext.broadcast(tuple(table[c].take(order).to_numpy() for c in ("pair", "n", "best")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = known.value
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times").flatten().to_numpy()
            at = np.searchsorted(pair, pairs.flatten().to_numpy())
            row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(pairs).to_numpy())
            sums = []
            for value in (np.where(best[at], times, 0), n[at] * times) if len(at) else (times, times):
                total = np.zeros(batch.num_rows, np.int64)
                np.add.at(total, row, value)
                sums.append(pa.array(total))
            columns = dict(zip(batch.schema.names, batch.columns, strict=True)) | dict(zip(("n_best", "count_sum"), sums, strict=True))
            yield pa.record_batch([columns[c] for c in kept], names=kept)

    schema = T.StructType([T.StructField(c, T.StringType() if c == "groups_sha256" else T.LongType()) for c in kept])
    return links.drop("row").mapInArrow(run, schema)

