"""Token alignment against a plain version with both libraries on whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

from bazaar.llm import alignment, queries

FILES = queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path("piece_bpe_32k.model")
PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def plain(texts):
    """Tokens of whole texts, cuts as common offsets, links as all pairs of a group."""
    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    letters = {chr(x): x for x in PLAIN} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in PLAIN)}
    rows = []
    for text in texts:
        text = text or ""
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [b.id_to_piece(i)]]
        if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            rows.append([])
            continue
        ends = []
        for parts in (bytes_a, bytes_b):
            at, own = 0, []
            for part in parts:
                at += len(part)
                own.append(at)
            ends.append(own)
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = defaultdict(lambda: ([], []))
        for side, ids in enumerate((ids_a, ids_b)):
            at = 0
            for i, end in zip(ids, ends[side], strict=True):
                while end > cuts[at]:
                    at += 1
                groups[at][side].append(i)
        rows.append([groups[k] for k in sorted(groups)])
    links = [[(x, y) for left, right in row for x in left for y in right] for row in rows]
    counts = Counter(pair for row in links for pair in set(row))
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for row, own in zip(rows, links, strict=True):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in row)
        out.append((
            sum(len(x) for x, _ in row), sum(len(y) for _, y in row), len(row), len(own),
            sum(counts[p] == best[p[0]] for p in own), sum(counts[p] for p in own),
            hashlib.sha256(text.encode()).hexdigest() if text else "",
        ))
    return out


def odd_texts(seed, n):
    draw = random.Random(seed)
    parts = ["the", "The", " ", "  ", "\n", "\t", " ", "　", " ", "\u0085", "é", "naïve", "ﬁ", "日本語", "🙂", "👩‍👩‍👧", "123", "4567", "don't", "...", "</s>", "<s>",
             "<unk>", "<|endoftext|>", "<0x41>", "internationalization", "x" * 30, "   ", "a b", ".\n\n", "ß", "\x00", "\x1c", "Ω", "م", "क्षि"]
    texts = ["".join(draw.choice(parts) + draw.choice(["", " ", ""]) for _ in range(draw.randint(1, 40))) for _ in range(n)]
    return texts + [None, "", " ", "  ", "\n", "▁", "a▁b c", "a ▁", "word " * 3000, "aaaa" * 3000, " " * 500, *texts[:5]]


def rows_of(spark, texts, broadcast_pairs):
    docs = spark.createDataFrame([(i, t, 1, "p") for i, t in enumerate(texts)], "doc_id bigint, text string, n_a int, pairs string")
    found = alignment.link_statistics(docs.repartition(3), *FILES, broadcast_pairs=broadcast_pairs)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return [tuple(r)[1:] for r in found.orderBy("doc_id").collect()]


@pytest.mark.parametrize("broadcast_pairs", [alignment.BROADCAST_PAIRS, 0])
def test_odd_texts(spark, broadcast_pairs):
    texts = odd_texts(1, 300)
    assert rows_of(spark, texts, broadcast_pairs) == plain(texts)


def test_documents(spark, sf):
    docs = queries.table(spark, sf, "documents").orderBy("doc_id").collect()
    found = [tuple(r)[1:] for r in queries.token_alignment(spark, sf).orderBy("doc_id").collect()]
    assert found == plain([r.text for r in docs])


def test_whole_texts_where_pieces_cross_blanks():
    """The same groups when nothing is known of the places where a text falls apart."""
    import pyarrow as pa

    with open(FILES[0], "rb") as one, open(FILES[1], "rb") as two:
        a, b = alignment.tokenizers(one.read(), two.read())
    texts = pa.array(odd_texts(2, 60))
    parts = alignment.Aligner(a, b).align(texts)
    b.whole_texts = True
    try:
        whole = alignment.Aligner(a, b).align(texts)
    finally:
        b.whole_texts = False
    assert parts[1].equals(whole[1])
    assert all((x == y).all() for i, (x, y) in enumerate(zip(parts, whole, strict=True)) if i != 1)


def test_runs_against_common_ends():
    draw = random.Random(3)
    for _ in range(500):
        n = draw.choice([1, 5, 60, 700])
        a, b = (sorted({n, *draw.sample(range(1, n + 1), draw.randint(0, n))}) for _ in range(2))
        if draw.random() < 0.5:
            b = sorted({n, *[x for x in a if draw.random() < 0.95]})
        common = [x for x in a if x in set(b)]
        assert alignment.runs(a, b) == ([a.index(x) + 1 for x in common], [b.index(x) + 1 for x in common])
    assert alignment.runs([], []) == ([], [])


def test_null_ids_repeats_and_empty(spark):
    docs = spark.createDataFrame([(None, "same text"), (1, "same text"), (1, "same text"), (2, None)], "doc_id bigint, text string")
    rows = alignment.link_statistics(docs, *FILES).collect()
    assert [r.count_sum for r in rows if r.doc_id != 2] == [3 * rows[0].n_links] * 3 and rows[0].n_links > 0
    assert [tuple(r)[1:] for r in rows if r.doc_id == 2] == [(0, 0, 0, 0, 0, 0, "")]
    assert alignment.link_statistics(docs.limit(0), *FILES).collect() == []
