"""Line dedup against a plain version, on both ways of looking the repeated lines up."""

import random
from collections import defaultdict

import pytest

from bazaar.llm import line_dedup

WHITE = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id bigint, text string, lines int, key string, n bigint, block int"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain(rows, min_documents, least, keep_first):
    """Counts of keys over rows, then each row's lines one by one."""
    key = lambda line: lower(line.strip(WHITE))
    held, first = defaultdict(set), {}
    for r, (id_, text, *_) in enumerate(rows):
        for i, line in enumerate((text or "").split("\n")):
            if len(key(line)) >= least:
                held[key(line)].add(r)
                place = (id_ is not None, id_ or 0, i)
                first[key(line)] = min(first.get(key(line), place), place)
    out = []
    for id_, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [
            x for i, x in enumerate(lines)
            if len(held.get(key(x), ())) < min_documents or keep_first and first[key(x)] == (id_ is not None, id_ or 0, i)
        ]
        out.append((id_, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def made(seed):
    """Few and many copies of lines, blanks, nulls, repeated rows and ids, one very long text."""
    draw = random.Random(seed)
    line = lambda: draw.choice(["Home", " home\t", "İ", "é", "É", "", "  ", "a" * draw.randint(1, 40), f"own {draw.random()}", " x"])
    rows = [(i if draw.random() > 0.1 else None, "\n".join(line() for _ in range(draw.randint(0, 12)))) for i in range(150)]
    rows += rows[:5] + [(3, "other\nhome"), (None, None), (None, ""), (7, None), (999, "\n" * 3000 + "HOME\n" * 2000 + "word " * 20_000)]
    return [(*row, 1, "k", 2, 3) for row in rows]


@pytest.mark.parametrize(
    "broadcast_keys, keep_first, bits, documents, least",
    [(line_dedup.BROADCAST_KEYS, False, 1 << 20, 10, 1), (0, False, 64, 10, 1), (line_dedup.BROADCAST_KEYS, True, 64, 2, 3), (0, True, 1 << 20, 2, 3)],
)
def test_against_plain(spark, broadcast_keys, keep_first, bits, documents, least):
    rows = made(1)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = line_dedup.without_repeated_lines(docs, documents, least, keep_first, bits, broadcast_keys)
    assert found.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    assert sorted(map(tuple, found.collect()), key=repr) == plain(rows, documents, least, keep_first)


def test_filter_lets_only_suspects_through(spark):
    """Once-seen lines stay out of the second filter, twice-seen ones never do."""
    docs = spark.createDataFrame([(f"own {i}\nshared {i % 500}",) for i in range(1000)], "text string").repartition(4)
    twice = line_dedup.repeat_filter(docs, 1, 1 << 20)
    has = lambda texts: line_dedup._has(twice, line_dedup._positions([line_dedup.line_key(x.encode()) for x in texts], 1 << 20))
    assert has([f"shared {i}" for i in range(500)]).all()
    assert has([f"own {i}" for i in range(1000)]).sum() < 20


def test_empty_and_refused(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert line_dedup.without_repeated_lines(empty).collect() == []
    with pytest.raises(ValueError):
        line_dedup.without_repeated_lines(empty, 1)
    with pytest.raises(ValueError):
        line_dedup.without_repeated_lines(empty, filter_bits=100)
