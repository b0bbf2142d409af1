"""Report headers: normalisation styles, bilingual vocabularies, positional names."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.operators.contracts import ContractError

# The replacement steps of each report family, (pattern, text),
# applied in order. Patterns stay in the subset shared by Java, Python and RE2.
HEADER_STYLES: dict[str, list[tuple[str, str]]] = {
    "plain": [(" ", "_"), ("[^_a-z0-9]", "")],
    "slash_or": [(" ", "_"), ("/", "_atau_"), ("[()]", "")],
    "brackets": [(" ", "_"), ("[()]", "")],
    "marks": [(" ", "_"), ("[().,]", "")],
    "slash_marks": [(" ", "_"), ("[()./]", "")],
    "slash_marks_dash": [(" ", "_"), ("[()./]", ""), ("-", "_")],
    "stream": [(" ", "_"), ("-", "_"), ("[()]", ""), ("[+]_", ""), ("rp", "_rp")],
    "percent_word": [(" ", "_"), ("%", "persentase_"), ("-", "_")],
    "seo": [(" [(]seo[)]", ""), (" -", ""), (" ", "_")],
    "collapse": [(" [(]rp[)]", ""), (" ", "_"), ("[^_a-z0-9]", ""), ("__", "_")],
    "metric": [(" [(]rp[)]", ""), ("[^a-z0-9]+", "_"), ("^_|_$", "")],
    "words": [("[^a-z0-9]+", "_"), ("^_|_$", "")],
}


def normalize_header(name: str, style: str = "plain") -> str:
    """One header text to a column name."""
    if style == "camel":
        return re.sub(r"([a-z])([A-Z])", r"\1_\2", name.strip()).lower()
    name = name.strip().lower()
    for pattern, text in HEADER_STYLES[style]:
        name = re.sub(pattern, text, name)
    return name


def header_expression(header: Column, style: str = "plain") -> Column:
    """The same rule on a column of header texts."""
    if style == "camel":
        return F.lower(F.regexp_replace(F.trim(header), "([a-z])([A-Z])", "$1_$2"))
    out = F.lower(F.trim(header))
    for pattern, text in HEADER_STYLES[style]:
        out = F.regexp_replace(out, pattern, text)
    return out


def normalize_headers(df: DataFrame, style: str = "plain") -> DataFrame:
    names = [normalize_header(n, style) for n in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ContractError(f"headers collide after normalisation: {twice}")
    return df.toDF(*names)


def rename_synonyms(df: DataFrame, *vocabularies: dict[str, str], style: str | None = None) -> DataFrame:
    """Headers of any language to one vocabulary.

    Several present headers for one target give the first non-null value, in
    vocabulary order. Headers in no vocabulary are normalised by ``style``, or
    stay as they are.
    """
    target_of: dict[str, str] = {}
    for vocabulary in vocabularies:
        for source, target in vocabulary.items():
            target_of.setdefault(source, target)
    rank = {source: i for i, source in enumerate(target_of)}
    plain = {name: name.strip() for name in df.columns}
    groups: dict[str, list[str]] = {}
    for name in df.columns:
        other = normalize_header(plain[name], style) if style else plain[name]
        groups.setdefault(target_of.get(plain[name], other), []).append(name)
    out = []
    for target, names in groups.items():
        names.sort(key=lambda n: rank.get(plain[n], len(rank)))
        columns = [F.col(f"`{n}`") for n in names]
        out.append((F.coalesce(*columns) if len(columns) > 1 else columns[0]).alias(target))
    return df.select(*out)


def rename_positional(df: DataFrame, names: list[str]) -> DataFrame:
    if len(names) != len(df.columns):
        raise ContractError(f"{len(df.columns)} columns found, {len(names)} expected")
    return df.toDF(*names)
