"""BPE encoding and decoding with a pair occurrence index.

The words that a part of a partition holds are encoded once each. An index
maps every pair with a merge rule to all positions where it stands; active
ranks are applied in ascending order, each to all its positions at once, and
the lists of the neighbouring pairs are updated. A text is then put together
from its words, so no merge runs twice for a word of the part.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from bazaar.llm import kernels

PART_BYTES = 2_000_000
CACHED_WORDS = 150_000
#: Fixed values of the byte-level alphabet: bytes that stand for themselves; the others follow from 256 on.
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: Suffixes that are words of their own.
_SUFFIXES = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
_classes: list[np.ndarray] = []
_loaded: dict[int, Vocabulary] = {}


def _character_classes() -> np.ndarray:
    """0 white space, 1 letter, 2 number, 3 other, for every code point."""
    if not _classes:
        table = np.full(0x110000, 3, np.uint8)
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        for kind, pattern in ((0, r"\s+"), (1, r"\p{L}+"), (2, r"\p{N}+")):
            for run in regex.finditer(pattern, every):
                table[ord(run[0][0]) : ord(run[0][-1]) + 1] = kind
        _classes.append(table)
    return _classes[0]


class Vocabulary:
    """A word-end BPE vocabulary file: ids, merge rules and special strings."""

    def __init__(self, content: bytes):
        file = json.loads(content)
        ids: dict[str, int] = file["model"]["vocab"]
        suffix = file["model"]["end_of_word_suffix"]
        letters = {b: chr(b) for b in _PLAIN}
        letters |= {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in letters)}
        self.first = np.array([ids[letters[b]] for b in range(256)], np.int64)
        self.last = np.array([ids[letters[b] + suffix] for b in range(256)], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in file["model"]["merges"]]
        left, right = (np.array([ids[p[i]] for p in pairs], np.int64) for i in (0, 1))
        self.left, self.right = left, right
        self.merged = np.array([ids["".join(p)] for p in pairs], np.int64)
        keys = left << 32 | right
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.tokens = [""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in [*ids.items(), *self.special.items()]:
            self.tokens[i] = token
        made = np.full(len(self.tokens), -1)
        made[self.merged] = np.arange(len(pairs))
        ranks = np.arange(len(pairs))
        if len(np.unique(self.merged)) < len(pairs) or (made[left] >= ranks).any() or (made[right] >= ranks).any():
            raise ValueError("a merge rule uses a token that a later rule makes; ranks can't be applied in order")
        self.splitter = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair's rule, or -1."""
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.order[at], -1)


def vocabulary(content: bytes) -> Vocabulary:
    """The parsed file, once in each Python worker."""
    key = hash(content)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Vocabulary(content)
    return _loaded[key]


def merge_words(words: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in a row, and the number of ids of each."""
    sizes = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(words), np.uint8)
    symbols = vocab.first[data]
    symbols[ends - 1] = vocab.last[data[ends - 1]]
    n = len(symbols)
    following = np.arange(1, n + 1)
    following[ends - 1] = -1
    preceding = np.arange(-1, n - 1)
    preceding[ends - sizes] = -1
    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def add(ranks: np.ndarray, places: np.ndarray) -> None:
        known = ranks >= 0
        ranks, places = ranks[known], places[known]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, places = ranks[order], places[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        for rank, part in zip(ranks[np.concatenate([[0], cuts])].tolist(), np.split(places, cuts), strict=True):
            if rank in index:
                index[rank].append(part)
            else:
                index[rank] = [part]
                heapq.heappush(active, rank)

    places = np.flatnonzero(following >= 0)
    add(vocab.rank(symbols[places], symbols[places + 1]), places)
    while active:
        rank = heapq.heappop(active)
        lists = index.pop(rank)
        a, b, made = int(vocab.left[rank]), int(vocab.right[rank]), int(vocab.merged[rank])
        places = np.unique(np.concatenate(lists)) if len(lists) > 1 or a == b else lists[0]
        after = following[places]
        places = places[(symbols[places] == a) & (after >= 0) & (symbols[after] == b)]
        if a == b:  # aaa: the left pair goes first, its second letter is then used up
            kept, taken = [], -1
            for place in places.tolist():
                if place != taken:
                    kept.append(place)
                    taken = int(following[place])
            places = np.array(kept, np.int64)
        if not len(places):
            continue
        gone = following[places]
        after = following[gone]
        symbols[places] = made
        symbols[gone] = -1
        following[places] = after
        has = after >= 0
        preceding[after[has]] = places[has]
        before = preceding[places]
        left = before[before >= 0]
        starts = np.concatenate([left, places[has]])
        add(vocab.rank(symbols[starts], symbols[following[starts]]), starts)
    alive = symbols >= 0
    counts = np.add.reduceat(alive, ends - sizes) if len(words) else np.zeros(0, np.int64)
    return symbols[alive], counts


def normalise(text: str) -> str:
    """NFC and lower case of each character (no final sigma)."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return text.lower()


def split_words(pieces: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Joined pieces, starts and ends of their words, hashes of the words, and words before each piece.

    A word is a suffix of the fixed list, a run of letters, one number character or a run of others.
    """
    joined = "".join(pieces)
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    if not len(codes):
        none = np.zeros(0, np.int64)
        return joined, none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    kind = _character_classes()[codes]
    cut = np.ones(len(codes) + 1, bool)
    cut[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    cut[offsets] = True
    quote = np.flatnonzero((codes == 0x27) & cut[:-1])
    for at in quote.tolist():
        end = int(offsets[np.searchsorted(offsets, at, "right")])
        for suffix in _SUFFIXES:
            if joined.startswith(suffix, at, end):
                cut[at + 1] = False
                cut[at + len(suffix)] = True
                if len(suffix) == 3:
                    cut[at + 2] = False
                break
    bounds = np.flatnonzero(cut)
    solid = kind[bounds[:-1]] != 0
    starts, ends = bounds[:-1][solid], bounds[1:][solid]
    return joined, starts, ends, kernels.span_hashes(codes, starts, ends), np.searchsorted(starts, offsets)


class Encoder:
    """Encodes lists of texts; keeps the words it has met up to a bound of memory."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.place = np.zeros(0, np.int64)
        special = list(self.vocab.special.items())  # they stand first and are found by their place only
        self.texts = [token for token, _ in special]
        self.flat = np.array([i for _, i in special], np.int32)
        self.starts = np.arange(len(special))
        self.counts = np.ones(len(special), np.int64)

    def _learn(self, words: list[str], hashes: np.ndarray) -> None:
        ids, counts = merge_words([w.encode() for w in words], self.vocab)
        tokens = list(map(self.vocab.tokens.__getitem__, ids.tolist()))
        ends = np.cumsum(counts)
        base = len(self.texts)
        self.texts += [" ".join(tokens[a:b]) for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
        self.starts = np.concatenate([self.starts, len(self.flat) + ends - counts])
        self.flat = np.concatenate([self.flat, ids.astype(np.int32)])
        self.counts = np.concatenate([self.counts, counts])
        known = np.concatenate([self.known, hashes])
        place = np.concatenate([self.place, base + np.arange(len(words))])
        order = np.argsort(known)
        self.known, self.place = known[order], place[order]

    def words(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each word of the pieces its place in the list of known words, and words before each piece."""
        joined, starts, ends, hashes, first = split_words(pieces)
        if not len(starts):
            return np.zeros(0, np.int64), first
        distinct, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.texts) > CACHED_WORDS:
            self.forget()
        at = np.minimum(np.searchsorted(self.known, distinct), max(len(self.known) - 1, 0))
        new = self.known[at] != distinct if len(self.known) else np.ones(len(distinct), bool)
        if new.any():
            rows = sample[new]
            self._learn(
                [joined[a:b] for a, b in zip(starts[rows].tolist(), ends[rows].tolist(), strict=True)], distinct[new]
            )
        return self.place[np.searchsorted(self.known, distinct)][which], first

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """All ids in a row, their bounds, and the decoded texts. Special strings in a text are special tokens."""
        pieces: list[str] = []
        before: list[int] = []  # of each piece after the first of its text: the place of the special token before it
        heads: list[int] = []
        splitter, place = self.vocab.splitter, {token: i for i, token in enumerate(self.vocab.special)}
        for text in texts:
            heads.append(len(pieces))
            at = 0
            if splitter is not None:
                for found in splitter.finditer(text):
                    pieces.append(normalise(text[at : found.start()]))
                    before.append(place[found[0]])
                    at = found.end()
            pieces.append(normalise(text[at:] if at else text))
            before.append(-1)
        places, first = self.words(pieces)
        after = np.flatnonzero(np.array(before) >= 0)  # pieces that a special token follows
        places = np.insert(places, first[after + 1], np.array(before, np.int64)[after])
        first = first + np.searchsorted(after, np.arange(len(first)))
        bounds = first[[*heads, len(pieces)]]
        counts = self.counts[places]
        ends = np.cumsum(counts)
        ids = self.flat[np.repeat(self.starts[places] - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)]
        get, some, cuts = self.texts.__getitem__, places.tolist(), bounds.tolist()
        decoded = [" ".join(map(get, some[a:b])) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return ids, np.concatenate([[0], ends])[bounds], decoded


def encode_decode(
    docs: DataFrame, tokenizer_file: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id``, ``ids`` (array of int) and ``decoded`` for every row.

    The file is read on the driver and sent to the tasks; its size does not
    depend on the data. A null or empty text has no ids and an empty decoded
    text; a null id stays null; repeated rows are encoded each; other columns
    are not read; an empty table gives an empty result.
    """
    with open(tokenizer_file, "rb") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    schema = "doc_id bigint, ids array<int>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary(content.value))
        for batch in batches:
            for part in kernels.slices(batch, "text", PART_BYTES):
                ids, bounds, decoded = encoder.encode([x or "" for x in part.column(1).to_pylist()])
                yield pa.record_batch(
                    [
                        part.column(0),
                        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())),
                        pa.array(decoded, pa.string()),
                    ],
                    names=["doc_id", "ids", "decoded"],
                )

    return docs.select(docs[id_column].cast("bigint").alias("doc_id"), docs[text_column].alias("text")).mapInArrow(run, schema)
