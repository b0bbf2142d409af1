"""Corpus operators against brute force on small tables with every awkward row."""

import collections
import hashlib
import itertools
import json
import random
import re
import zlib

import numpy as np
import pytest

from bazaar.llm import (
    bpe,
    chat,
    components,
    decontaminate,
    feistel,
    knn,
    licenses,
    near_dedup,
    pii,
    quality,
    queries,
    substrings,
    training_order,
)
from bazaar.llm.storage import stored

SCHEMA = "doc_id bigint, text string, score double, k1 string, n_words string, class_id string"


def words(seed, n, vocabulary=4000):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


BASE = words(1, 200)
EDITED = [*BASE[:100], "changed", *BASE[101:]]
ROWS = [
    (1, " ".join(BASE)),
    (2, " ".join(BASE)),
    (3, " ".join(EDITED)),
    (4, " ".join(words(2, 300))),
    (5, " ".join([*words(3, 80), *BASE[20:80], *words(4, 500)])),
    (6, ""),
    (7, None),
    (8, "one two three"),
    (9, "One two, three!"),
    (None, " ".join(BASE)),
    (None, None),
    (10, "same row"),
    (10, "same row"),
    (11, "x " * 5000),
    (12, "Zoë said: it's 12½<|endoftext|>! ΣΣ\n\tend"),
    (13, ".,;"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 0.5, "k", "n", "c") for i, t in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def key(row):
    return tuple((x is not None, x) for x in row)


def test_near_duplicates(docs):
    found = {r.doc_id: (r.class_id, r.n_links) for r in near_dedup.near_duplicates(docs).collect()}
    assert len(found) == 13
    assert found[1][0] == found[2][0] == found[3][0] == 1 and found[3][1] == 1
    assert found[8][0] == found[9][0] == 8
    assert {i for i, (c, _) in found.items() if c == i} == {1, 4, 5, 6, 7, 8, 10, 11, 12, 13}


@pytest.mark.parametrize("size, seed", [(400, 1), (4000, 2), (17000, 3)])
def test_samples_of_long_texts(size, seed):
    """The share of common samples is the weighted Jaccard similarity at every length."""
    import pyarrow as pa

    level, rng = np.full(near_dedup.FEATURES, 4, np.uint8), random.Random(seed)
    shared = [f"s{rng.randrange(10**9)}" for _ in range(int(size * 0.8 / 0.9))]
    pair = pa.array([" ".join([*shared, *[f"{x}{rng.randrange(10**9)}" for _ in range(size - len(shared))]]) for x in "ab"])
    texts, hashes, counts = near_dedup.weighted_shingles(pair)
    _, samples = near_dedup._drawn(texts, hashes, counts, level, 1000)
    (true,) = near_dedup.weighted_jaccard(pair.slice(0, 1), pair.slice(1, 1), level)
    assert abs((samples[0] == samples[1]).mean() - true) < 4 * (true * (1 - true) / 1000) ** 0.5


def test_near_duplicates_of_heavy_and_long_texts(spark):
    """Shingles repeated hundreds of times, and texts of 20,000 words: no link at or above the threshold is lost."""
    import pyarrow as pa

    rng, rows = random.Random(9), []
    for group in range(4):
        chorus = " ".join(" ".join(f"g{group}r{i}x{j}" for j in range(5)) for i in range(10) for _ in range(300))
        rows += [f"{chorus} " + " ".join(f"own{rng.randrange(10**9)}" for _ in range(300)) for _ in range(3)]
    for group in range(3):
        base = words(200 + group, 20_000, 10**6)
        for changes in (0, 150, 300):
            text = list(base)
            for at in rng.sample(range(len(text)), changes):
                text[at] = f"new{rng.randrange(10**9)}"
            rows.append(" ".join(text))
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string").repartition(3)
    level = near_dedup.idf_levels(docs.select("doc_id", "text"))
    pairs = [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if a // 3 == b // 3]
    close = near_dedup.weighted_jaccard(*(pa.array([rows[p[i]] for p in pairs]) for i in (0, 1)), level)
    assert (close >= 0.8).sum() > 15
    found = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs).collect()}
    for (a, b), similarity in zip(pairs, close, strict=True):
        assert similarity < 0.8 or found[a] == found[b], (a, b, similarity)
    assert len(set(found.values())) >= 7


def test_deduplicated_keeps_columns_of_any_name(spark):
    rows = [(1, "a b c d e f", "x", 1, True), (2, "a b c d e f", "y", 2, False), (3, "other words here", "z", 3, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, id string, gone int, twice boolean")
    assert sorted(map(tuple, near_dedup.deduplicated(docs).collect())) == [rows[0], rows[2]]


def test_near_duplicates_keep_one_row(docs):
    kept = [r.doc_id for r in near_dedup.deduplicated(docs).collect()]
    assert sorted(kept, key=lambda i: i or 0) == [None, None, 1, 4, 5, 6, 7, 8, 10, 11, 12, 13]
    assert near_dedup.deduplicated(docs).columns == docs.columns


def test_near_duplicates_lose_no_link(spark):
    """Every pair of different texts at or above the threshold is in one class, and no class joins others."""
    rng = random.Random(5)
    rows = []
    for group in range(30):
        base = words(100 + group, 120)
        for copy in range(4):
            text = list(base)
            for _ in range(rng.randrange(4)):
                text[rng.randrange(len(text))] = f"new{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    import pyarrow as pa

    level = near_dedup.idf_levels(docs.select("doc_id", "text"))
    pairs = [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if a // 4 == b // 4]
    left, right = (pa.array([rows[p[i]][1] for p in pairs]) for i in (0, 1))
    close = near_dedup.weighted_jaccard(left, right, level)
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), s in zip(pairs, close, strict=True):
        if s >= 0.8:
            low, high = sorted((top(a), top(b)))
            parent[high] = low
    found = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs).collect()}
    assert sum(close >= 0.8) > 30
    assert found == {i: top(i) for i in range(len(rows))}


def test_weighted_jaccard_is_exact():
    import pyarrow as pa

    level = np.full(near_dedup.FEATURES, 8, np.uint8)  # all weights two
    a, b = "a b c d e f g a b c d e", "a b c d e f x"
    grams = lambda t: collections.Counter(zip(*[t.split()[i:] for i in range(5)], strict=False))
    x, y = grams(a), grams(b)
    expected = sum((x & y).values()) / sum((x | y).values())
    assert near_dedup.weighted_jaccard(pa.array([a]), pa.array([b]), level)[0] == pytest.approx(expected)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7), (200, None)]
    found = components.components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert {r.id: r.root for r in found.collect()} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def test_top_k(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.normal(size=6)]) for i in range(400)]
    rows += [(400 + i, rows[0][1]) for i in range(50)] + [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (None, rows[1][1])]
    rows += [(902, [float("nan")] * 6), (903, [float("inf")] * 6), (3, rows[3][1])]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<double>, id string")
    vectors = knn.quantised(table)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in knn.top_k(vectors.where("id % 20 = 0"), vectors, 20).collect())
    own = {i: np.floor(64 * np.array(v)).astype(int) for i, v in rows if i is not None and i < 900}
    expected = []
    for q in (i for i in own if i % 20 == 0):
        order = sorted((-int(own[q] @ own[i]), i) for i in own if i != q)[:20]
        expected += [(q, n + 1, i, -s) for n, (s, i) in enumerate(order)]
    assert got == sorted(expected)
    nothing = vectors.where("false")
    assert knn.top_k(nothing, nothing).count() == 0


def test_exact_products_of_large_numbers():
    big = np.array([[2.0**31, 3.0]])
    assert knn._products(big, big).tolist() == [[2**62 + 9]]


def brute_repeats(rows, length):
    pattern = re.compile(rb"[^\x20\x09-\x0D]+")
    texts = [(i, pattern.findall((t or "").encode())) for i, t in rows]
    seen = collections.Counter(b" ".join(w[s : s + length]) for _, w in texts for s in range(len(w) - length + 1))
    for i, w in texts:
        gone = set()
        for s in range(len(w) - length + 1):
            if seen[b" ".join(w[s : s + length])] > 1:
                gone.update(range(s, s + length))
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        yield i, len(w), len(gone), kept.decode()


@pytest.mark.parametrize("seed", [None, 1, 2])
def test_substrings(spark, docs, seed):
    rows = ROWS
    if seed:  # few words, so that windows repeat in many ways
        rng = random.Random(seed)
        rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(400)))) for i in range(12)]
        shared = words(9, 90)
        rows += [(50 + i, " ".join([*words(60 + i, 20), *shared[i : 60 + i], *words(80 + i, 20)])) for i in range(12)]
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in substrings.without_repeats(docs).collect()]
    assert sorted(got, key=key) == sorted(brute_repeats(rows, 35), key=key)
    row = substrings.without_repeats(docs).where("n_removed > 0").first()
    assert sum(x.length for x in row.repeats) == row.n_removed


def test_decontamination(spark, docs):
    items = [(1, " ".join(BASE[20:80])), (2, " ".join([*BASE[20:70], *words(77, 12)])), (3, "one two three"), (4, None),
             (5, " ".join([*BASE[20:50], *words(78, 50)])), (None, " ".join(words(2, 300)[10:40]))]
    table = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, doc_id string")
    shingles = lambda t: {tuple(w[j : j + 5]) for w in [(t or "").split()] for j in range(len(w) - 4)}
    expected = [
        (d, i) for d, t in ROWS for i, q in items if shingles(q) and len(shingles(q) & shingles(t)) / len(shingles(q)) >= 0.8
    ]
    got = [(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, table).collect()]
    assert sorted(got, key=key) == sorted(expected, key=key) and (5, 1) in got
    dirty = collections.Counter({(d, t) for d, t in ROWS for i, q in items if shingles(q) and len(shingles(q) & shingles(t)) / len(shingles(q)) >= 0.8})
    kept = [(r.doc_id, r.text) for r in decontaminate.decontaminated(docs, table).collect()]
    assert sorted(kept, key=key) == sorted([r for r in ROWS if r not in dirty], key=key)
    blocks = decontaminate.BLOCK_BYTES
    try:  # many blocks find the same
        decontaminate.BLOCK_BYTES = 200
        again = [(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, table).collect()]
    finally:
        decontaminate.BLOCK_BYTES = blocks
    assert sorted(again, key=key) == sorted(got, key=key)


def test_licenses(spark):
    rows = [
        (1, "x CC BY 4.0, cc-by; Licensed under CC BY-NC 4.0."), (2, "This work is licensed under the GNU General Public License, version 3."),
        (3, "Released under the MIT License."), (4, None), (5, ""), (None, "All Rights\nReserved all rights reserved"),
        (6, "allrights reserved éall rights reserved licence"), (7, "MIT license"), (7, "MIT license"),
    ]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, n_words string")
    got = {r.doc_id: tuple(r)[1:] for r in licenses.licenses(docs).collect()}
    assert got[1] == (14, 3, 1, 9, "cc-by", "cc-by,cc-by-nc-4.0", 1.0)
    assert got[2][4:6] == ("gpl", "gpl,gpl-3.0") and got[3][1:] == (0, None, None, "", "mit", 1.0)
    assert got[4] == got[5] == (0, 0, None, None, "", "", 0.0)
    assert got[None][:5] == (6, 2, 0, 3, "reserved")
    assert got[6] == (6, 0, None, None, "", "", 0.0) and got[7][4:] == ("", "", 0.0)


def test_chat(spark):
    call = lambda *cs: json.dumps({"tool_calls": [dict(zip(("id", "name", "arguments", "needs"), c, strict=True)) for c in cs]})
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", call(("a", "search", {"query": "x", "limit": "3"}, []), ("b", "search", {"limit": "z"}, ["a"]))),
        (1, 2, "tool", json.dumps({"tool_call_id": "a", "content": "found \"it\""})), (1, 3, "tool", json.dumps({"tool_call_id": "q", "content": "?"})),
        (1, 4, "assistant", call(("c", "none", {}, ["d"]), ("d", "none", {}, ["c"]))), (2, 0, "system", "be kind"), (2, 1, "user", None),
        (2, 2, "assistant", "ok"), (None, 0, "user", "lost"), (3, 1, None, None),
    ]
    table = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, json string")
    got = {(r.conv_id, r.call_id): r for r in chat.formatted(table, queries.TOOLS).collect()}
    assert got[1, "a"].status == "linked" and got[1, "a"].depth == 0 and got[1, "a"].valid
    assert got[1, "a"].json == '{"arguments":{"limit":3,"query":"x"},"call_id":"a","conv_id":1,"name":"search","result":"found \\"it\\""}'
    assert got[1, "b"].depth == 1 and got[1, "b"].status == "unanswered" and got[1, "b"].problem == "limit is no integer" or got[1, "b"].problem == "missing query"
    assert got[1, "c"].depth == got[1, "d"].depth == -1 and got[1, "c"].problem == "unknown tool"
    assert got[1, "q"].status == "orphan" and got[1, "q"].valid is None
    assert got[2, "2:1"].status == "linked" and got[2, "2:1"].problem == "missing prompt"
    assert got[2, None].status == "message" and json.loads(got[2, None].json) == {"conv_id": 2, "role": "system", "text": "be kind", "turn": 0}
    assert got[3, None].status == "message"
    assert all(json.loads(r.json) is not None for r in got.values())


def test_no_message_is_lost(spark):
    """Every message, or every call of it, is in exactly one row: malformed, empty, mixed and repeated ones too."""
    draw = random.Random(4)
    call = lambda i, **more: {"id": i, "name": "search", "arguments": {"query": f"q{draw.random()}"}, "needs": [], **more}
    texts = [
        '{"tool_calls": [', '{"tool_calls": []}', '{ "tool_calls": [null]}', '{"other": 1}', "{", "plain", "", None,
        json.dumps({"tool_calls": [call("a"), call("b")]}), json.dumps({"content": "beside", "tool_calls": [call("a")]}),
        ' { "tool_calls" : [' + json.dumps(call("c")) + "]}", "no json", json.dumps({"tool_call_id": "a", "content": "r"}),
        json.dumps({"tool_call_id": "z", "content": None}), json.dumps({"content": "nameless"}),
    ]
    rows = [
        (draw.choice([1, 2, None]), draw.choice([0, 1, 2, 3, None]), draw.choice(["user", "assistant", "tool", "system", None]), draw.choice(texts))
        for _ in range(400)
    ]
    want = collections.Counter()
    for conv, turn, role, text in rows:
        try:
            parsed = json.loads(text) if text and text.lstrip().startswith("{") else None
        except ValueError:
            parsed = None
        calls = (parsed or {}).get("tool_calls") or []
        if role == "assistant" and calls and None not in calls:
            want.update((conv, turn, "call", c["arguments"]["query"]) for c in calls)
            if parsed.get("content") is not None:
                want[conv, turn, "message", parsed["content"]] += 1
        elif role == "tool" and parsed and parsed.get("tool_call_id") is not None:
            want[conv, turn, "result", parsed.get("content")] += 1
        else:
            want[conv, turn, {"user": "call", "assistant": "result"}.get(role, "message"), text] += 1
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    got = collections.Counter()
    for r in chat.formatted(table, queries.TOOLS).collect():
        body = json.loads(r.json)
        if r.status == "message":
            got[r.conv_id, r.turn, "message", body["text"]] += 1
            continue
        if body["arguments"] is not None:
            (said,) = body["arguments"].values() or (None,)
            got[r.conv_id, r.turn, "call", said] += 1
        if r.status in ("linked", "early", "orphan") or r.status == "repeated" and body["arguments"] is None:
            got[r.conv_id, r.result_turn, "result", body["result"]] += 1
    assert got == want


def test_arguments_of_all_kinds(spark):
    schemas = {"t": {"n": ("number", False), "i": ("integer", False), "o": ("object", False), "l": ("array", False), "e": ("enum:x|y", False)}}
    cases = [
        ({"n": 1.0, "i": "007", "o": {"b": [1, {"a": None}], "a": "x"}, "l": [2, 1], "e": "y"}, None,
         '{"e":"y","i":7,"l":[2,1],"n":1,"o":{"a":"x","b":[1,{"a":null}]}}'),
        ({"n": "1e2", "i": "-0"}, None, '{"i":0,"n":100}'),
        ({"n": 0.5, "o": [1]}, "o is no object", '{"n":0.5,"o":[1]}'),
        ({"l": {"a": 1}}, "l is no array", '{"l":{"a":1}}'),
        ({"e": "z"}, "e is none of x|y", '{"e":"z"}'),
    ]
    rows = [(i, 0, "assistant", json.dumps({"tool_calls": [{"id": "a", "name": "t", "arguments": c[0]}]})) for i, c in enumerate(cases)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    for r in chat.formatted(table, schemas).collect():
        _, problem, shown = cases[r.conv_id]
        assert r.problem == problem and r.json.startswith(f'{{"arguments":{shown},"call_id":"a"')


def test_pii():
    text = (
        "mail jo.do.34@mail7.example.com ip 97.51.17.173 or 999.1.1.1 card 4532015112830366 and 4532-0151-1283-0366 "
        "tel +1 (017) 555-7713 born 1984-02-29, 31.12.1999 not 2001-13-40; iban DE89 3704 0044 0532 0130 00 ssn 123-45-6789 v 980791"
    )
    new, kinds = pii.rewrite(text, b"k")
    assert kinds == ["email", "ip", "number", "number", "phone", "date", "date", "iban", "ssn"]
    for gone in ("jo.do.34", "97.51.17.173", "4532015112830366", "555-7713", "1984-02-29", "31.12.1999", "3704 0044", "123-45-6789"):
        assert gone not in new
    for kept in ("@mail7.example.com", "999.1.1.1", "2001-13-40", "980791", "+1 ("):
        assert kept in new
    assert len(new) == len(text) or re.sub(r"\d+(\.\d+){3}", "", new) != text
    one, two = re.search(r"card (\d{16}) and ([\d-]{19})", new).groups()
    assert one == two.replace("-", "") and pii.luhn(one[:-1]) == int(one[-1])
    assert pii.rewrite(text, b"k")[0] == new != pii.rewrite(text, b"other")[0]


def test_pseudonyms(spark, docs, empty):
    got = [(r.doc_id, r.text) for r in pii.pseudonymised(docs, b"k").collect()]
    assert sorted(got, key=key) == sorted(ROWS, key=key)
    assert pii.pseudonymised(empty, b"k").count() == 0 == pii.pseudonyms(empty, b"k").count()
    assert pii.pseudonyms(docs, b"k").count() == len(ROWS)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 4097])
def test_feistel_is_a_permutation(n):
    assert sorted(feistel.permute(i, n, b"key") for i in range(min(n, 1000))) == sorted({feistel.permute(i, n, b"key") for i in range(min(n, 1000))})
    assert sorted(feistel.permute_all(np.arange(n), n, 5).tolist()) == list(range(n))


def test_bpe_is_the_library(docs, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer_file())
    rows = bpe.encode_decode(docs, queries.tokenizer_file()).collect()
    texts = collections.Counter(
        (i, tuple(library.encode(t or "", add_special_tokens=False).ids)) for i, t in ROWS
    )
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in rows) == texts
    assert all(r.decoded == library.decode(r.ids, skip_special_tokens=False) for r in rows)
    assert bpe.encode_decode(empty, queries.tokenizer_file()).count() == 0


def test_bpe_odd_texts():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer_file())
    with open(queries.tokenizer_file(), "rb") as file:
        encoder = bpe.Encoder(bpe.vocabulary(file.read()))
    texts = [" it's we've I'LL ''s !'s 'street 12³½ a<|endoftext|>b <|startoftext|>", "aaaa aaa aaaaaaa AAAA!!??", "日本語", "'d's''", "<|end",
             "İx ﬁ à́b", "\U0001f600\U0001f600", " \x85\x1c​ "]
    ids, bounds, decoded = encoder.encode(texts)
    for i, text in enumerate(texts):
        own = ids[bounds[i] : bounds[i + 1]].tolist()
        assert own == library.encode(text, add_special_tokens=False).ids
        assert decoded[i] == library.decode(own, skip_special_tokens=False)


def test_quality(spark, docs, empty):
    rng = random.Random(4)
    good = [(i, " ".join(rng.choice(["the", "of", "and", "river", "stone", "light", "walks", "near"]) for _ in range(60))) for i in range(200)]
    bad = [(200 + i, " ".join(rng.choice(["the%%%", "of$$$", "WIN!!", "CLICK!!"]) for _ in range(60))) for i in range(200)]
    table = spark.createDataFrame(good + bad, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i < 200), 0, "x") for i in range(400)] + [(None, 1, 0, "x"), (3, None, 0, "x")], "doc_id bigint, quality int, toxic int, text string")
    model = quality.train(table, labels)
    scores = {r.doc_id: r.score for r in quality.scored(table, model).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(scores[i] >= 0.3) == (i < 200) for i in held]) > 0.97
    every = quality.scored(docs, model).collect()
    assert len(every) == len(ROWS) and all(0 <= r.score <= 1 for r in every)
    assert quality.accepted(docs, model).columns == docs.columns
    nothing = quality.train(empty, labels.limit(0))
    assert nothing.constant == 0.5 and quality.scored(empty, nothing).count() == 0


def test_training_order(spark, docs, empty, tmp_path):
    """The ids, put in order of running numbers and cut at end marks, decode to the texts; strides and slots hold."""
    ranks = queries.tokenizer_path("byte_bpe_50k.tiktoken")
    training_order.materialise(docs, f"file://{tmp_path}/a", key=5, ranks_file=ranks, length=64, per_shard=16, rounds=3)
    rows = training_order.sequences(spark, f"file://{tmp_path}/a").collect()
    assert sorted(r.slot for r in rows) == sorted(r.number for r in rows) == list(range(len(rows)))
    assert [r.slot for r in rows] != [r.number for r in rows]
    layout = json.loads(spark.read.text(f"file://{tmp_path}/a/layout").first().value)
    assert layout["bytes_per_token"] == 2 and layout["end_mark"] == 50256
    tokens, starts = [], {}
    for r in sorted(rows, key=lambda r: r.number):
        ids = np.frombuffer(r.tokens, "<u2").tolist()
        assert len(ids) == r.n_tokens <= 64
        starts[len(tokens)] = (r.doc_id, r.skip)
        tokens += ids
    with open(ranks, "rb") as file:
        own = training_order.encoding(file.read())
    texts, begin, place = [], 0, {}
    for at, token in enumerate(tokens):
        if token == layout["end_mark"]:
            place |= {n: (len(texts), n - begin) for n in range(begin, at + 1)}
            texts.append(own.decode(tokens[begin:at]))
            begin = at + 1
    assert begin == len(tokens)
    assert collections.Counter(texts) == collections.Counter(t for _, t in ROWS if t)
    for at, (doc_id, skip) in starts.items():
        assert place[at][1] == skip and (doc_id, texts[place[at][0]]) in ROWS
    assert sum(r.n_tokens < 64 for r in rows) <= docs.rdd.getNumPartitions()
    later = training_order.sequences(spark, f"file://{tmp_path}/a", from_slot=21).collect()
    assert sorted(r.slot for r in later) == list(range(21, len(rows)))
    for shard in sorted((tmp_path / "a/shards").glob("shard=*")):
        (file,) = shard.glob("part-*")
        number = int(shard.name.partition("=")[2])
        count = min(16, len(rows) - 16 * number)
        content = file.read_bytes()
        assert len(content) == count * layout["stride"]
        for r in rows:  # a reader that knows the slot alone
            if r.shard == number:
                head = training_order.HEADER.itemsize
                assert content[r.at + head : r.at + head + 2 * r.n_tokens] == bytes(r.tokens)
    training_order.materialise(empty, f"file://{tmp_path}/b", key=5, ranks_file=ranks)
    assert training_order.sequences(spark, f"file://{tmp_path}/b").count() == 0


def test_empty_tables(spark, empty):
    items = spark.createDataFrame([], "item_id bigint, text string")
    chats = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert near_dedup.near_duplicates(empty).count() == 0 == near_dedup.deduplicated(empty).count()
    assert substrings.without_repeats(empty).count() == 0
    assert decontaminate.contaminated(empty, items).count() == 0 == decontaminate.decontaminated(empty, items).count()
    assert licenses.licenses(empty).count() == 0 == chat.formatted(chats, queries.TOOLS).count()


def test_digest_of_queries(spark, sf):
    row = queries.QUERIES["op8_bpe"](spark, sf).orderBy("doc_id").first()
    coded = bpe.encode_decode(queries.table(spark, sf, "documents"), queries.tokenizer_file()).orderBy("doc_id").first()
    assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, coded.ids)).encode()).hexdigest()
    assert row.decoded_sha256 == hashlib.sha256(coded.decoded.encode()).hexdigest()
