"""Licence scan with a positional index of rare words, in column expressions only.

The lexicon is all words of the licence templates. Document frequencies of its
words over the whole corpus give their IDF. Every template is indexed by its
rarest words, each with its offset in the template. A text is read once: where
index words stand, their positions minus offsets are the places at which the
template may start; places that all index words agree on (or, for base phrases,
all places of the rarest word) are verified word by word. Template labels need
their mandatory phrase at its offset and enough of the words around it. Nothing
is shuffled but the counts of the lexicon's words.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Base phrases and labels (fixed values of the contract).
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Templates: label, words, mandatory phrase (fixed values: opening words of public licences and usual notices).
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "permission is hereby granted"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa"),
    ("bsd", "redistribution and use in source and binary forms with or without modification", "redistribution and use"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
)
LEAST_COVERAGE = 0.6
INDEX_WORDS = 2
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lexicon() -> list[str]:
    """All words that templates and base phrases can be indexed by: those of the phrases that must stand."""
    return sorted({w for text in [*BASE, *(must for _, _, must in TEMPLATES)] for w in text.split()})


def document_frequencies(docs: DataFrame, text_column: str = "text") -> dict[str, int]:
    """Texts that hold each word of the lexicon; one row for each word comes to the driver."""
    own = F.filter(F.split(F.lower(docs[text_column]), _GAP), lambda w: w.isin(lexicon()))
    found = docs.select(F.explode(F.array_distinct(own)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return {row.word: row.n for row in found.collect()}


def cues() -> list[str]:
    """Words of which one stands in every text that a phrase or template can stand in: the longest of each phrase that must stand."""
    return sorted({max(text.split(), key=lambda w: (len(w), w)) for text in [*BASE, *(must for _, _, must in TEMPLATES)]})


def _cue(text: Column) -> Column:
    lower, found = F.lower(text), F.lit(False)
    for cue in cues():
        own = lower.contains(cue)
        if len(cue) < 4:  # short ones are in many words
            own = own & lower.rlike(f"(?<![0-9a-z]){cue}(?![0-9a-z])")
        found = found | own
    return found


def _words(text: Column) -> Column:
    return F.filter(F.split(text, _GAP), lambda w: w != "")


def _whole(words: Column, phrase: list[str], at: int = 0) -> Callable[[Column], Column]:
    """Whether a phrase stands ``at`` words after a start."""

    def test(start: Column) -> Column:
        out = F.lit(True)
        for j, w in enumerate(phrase):
            out = out & F.coalesce(F.get(words, start + (at + j)) == w, F.lit(False))
        return out

    return test


def _share(words: Column, template: list[str]) -> Callable[[Column], Column]:
    """The share of a template's words that stand in their places."""

    def value(start: Column) -> Column:
        total = F.lit(0)
        for j, w in enumerate(template):
            total = total + F.coalesce((F.get(words, start + j) == w).cast("int"), F.lit(0))
        return total / F.lit(float(len(template)))

    return value


def _starts(words: Column, word: str, offset: int, size: int) -> Column:
    """Where a phrase of ``size`` words may start, seen from one of its words."""
    return F.filter(_starts_from(words, word, offset), lambda x: (x >= 0) & (x + size <= F.size(words)))


def _rarest(phrase: list[str], counts: Mapping[str, int], n: int) -> list[tuple[str, int]]:
    """The n words of highest IDF with their offsets (ties by offset)."""
    order = sorted(range(len(phrase)), key=lambda i: (counts.get(phrase[i], 0), i))
    return [(phrase[i], i) for i in order[:n]]


def licenses(
    docs: DataFrame, counts: Mapping[str, int] | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` of every row.

    Words are runs of ASCII letters (lower-cased) and digits and non-ASCII
    characters. ``n_base`` counts the places of the base phrases, ``first_word``
    and ``last_word`` are their least and greatest start (null if none). A
    template's label needs its mandatory phrase and LEAST_COVERAGE of its words
    in their places; ``score`` is the best coverage (1 for a base phrase, 0 for
    no label). A null text counts as empty; a null id stays null; repeated rows
    are scanned each; other columns are not read; an empty table gives an empty
    result. ``counts`` takes document frequencies found before.
    """
    counts = document_frequencies(docs, text_column) if counts is None else counts
    rows = docs.select(docs[id_column].alias("doc_id"), F.coalesce(docs[text_column], F.lit("")).alias("text"))
    text = F.col("text")
    rows = rows.select(
        "doc_id",
        F.size(_words(text)).alias("n_words"),
        F.when(_cue(text), _words(F.translate(text, _UPPER, _LOWER))).alias("words"),
    )
    words = F.col("words")
    none = F.array().cast("array<int>")
    found = {}
    for phrase, label in BASE.items():
        own = phrase.split()
        (word, offset), = _rarest(own, counts, 1)
        found[f"base_{label}"] = F.coalesce(
            F.filter(_starts(words, word, offset, len(own)), _whole(words, own)), none
        )
    shares = {}
    for i, (_, template, mandatory) in enumerate(TEMPLATES):
        own, must = template.split(), mandatory.split()
        at = next(j for j in range(len(own)) if own[j : j + len(must)] == must)
        index = [(w, j + at) for w, j in _rarest(must, counts, INDEX_WORDS)]
        places = _starts_from(words, *index[0])
        for w, j in index[1:]:
            places = F.array_intersect(places, _starts_from(words, w, j))
        places = F.filter(places, _whole(words, must, at))
        shares[f"share_{i}"] = F.coalesce(F.array_max(F.transform(places, _share(words, own))), F.lit(0.0))
    rows = rows.select("doc_id", "n_words", *[c.alias(n) for n, c in {**found, **shares}.items()])
    every = F.concat(*[F.col(n) for n in found])
    base = F.array(*[F.when(F.size(f"base_{x}") > 0, F.lit(x)) for x in BASE.values()])
    enough = [(F.col(f"share_{i}") >= LEAST_COVERAGE, label, F.col(f"share_{i}")) for i, (label, _, _) in enumerate(TEMPLATES)]
    more = F.array(*[F.when(ok, F.lit(label)) for ok, label, _ in enough])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(F.array_compact(labels))), ",")
    best = F.greatest(*[F.when(ok, x).otherwise(0.0) for ok, _, x in enough])
    return rows.select(
        "doc_id",
        F.col("n_words").cast("bigint").alias("n_words"),
        F.size(every).cast("bigint").alias("n_base"),
        F.array_min(every).cast("bigint").alias("first_word"),
        F.array_max(every).cast("bigint").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, more)).alias("labels"),
        F.when(F.size(every) > 0, 1.0).otherwise(best).alias("score"),
    )


def _starts_from(words: Column, word: str, offset: int) -> Column:
    """Places relative to one word of a template, also before the text's start (a notice may be cut)."""
    return F.filter(F.transform(words, lambda w, i: F.when(w == word, i - offset)), lambda x: x.isNotNull())
