"""Payloads that nobody declared: VARIANT values, the schema of a whole load, and its drift."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.functions.nested import flat_name


@dataclass(frozen=True)
class Leaf:
    """One value of a document: its path of keys, and its type (None where it differs between rows)."""

    keys: tuple[str, ...]
    kind: T.DataType | None

    @property
    def name(self) -> str:
        return flat_name(list(self.keys))

    @property
    def path(self) -> str:
        return "$" + "".join("['" + k.replace("\\", "\\\\").replace("'", "\\'") + "']" for k in self.keys)


def load_schema(df: DataFrame, column: str) -> T.StructType:
    """The schema of all documents of a load, whatever row a field is in: one aggregation, one row of text.

    Text that is no JSON object adds nothing. A field with several types is VARIANT.
    """
    value = F.try_parse_json(column)
    shape = df.where(F.schema_of_variant(value).startswith("OBJECT<")).agg(F.schema_of_variant_agg(value).alias("shape")).first()[0]
    if shape is None or not shape.startswith("OBJECT<"):
        return T.StructType([])
    return T._parse_datatype_string(re.sub(r"\bOBJECT<", "STRUCT<", shape))


def leaves(schema: T.StructType, before: tuple[str, ...] = ()) -> list[Leaf]:
    """All values below nested objects; arrays are values."""
    out = []
    for field in schema.fields:
        keys = (*before, field.name)
        if isinstance(field.dataType, T.StructType) and field.dataType.fields:
            out += leaves(field.dataType, keys)
        else:
            plain = isinstance(field.dataType, (T.LongType, T.DoubleType, T.DecimalType, T.BooleanType, T.StringType))
            out.append(Leaf(keys, field.dataType if plain else None))
    return out


def leaf_value(document: Column, leaf: Leaf) -> Column:
    """The leaf as its type; arrays, and fields of several types, as text (JSON where it is no plain text)."""
    if leaf.kind is not None:
        kind = "double" if isinstance(leaf.kind, T.DecimalType) else leaf.kind.simpleString()
        return F.try_variant_get(document, leaf.path, kind)
    value = F.try_variant_get(document, leaf.path, "variant")
    text = F.coalesce(F.try_variant_get(document, leaf.path, "string"), F.to_json(value))
    return F.when(~F.is_variant_null(value), text)


def flatten_variant(df: DataFrame, column: str, schema: T.StructType | None = None) -> DataFrame:
    """A column for each value of the documents, named by its path; the other columns stay.

    ``schema`` is that of the load (``load_schema``) or the one a table has
    already. Documents that are no JSON objects have NULLs.
    """
    found = leaves(load_schema(df, column) if schema is None else schema)
    parsed = df.withColumn("_document", F.try_parse_json(column))
    kept = [F.col(f"`{c}`") for c in df.columns if c != column]
    return parsed.select(*kept, *[leaf_value(F.col("_document"), leaf).alias(leaf.name) for leaf in found])


def drift(known: T.StructType, found: T.StructType) -> list[tuple[str, str | None, str | None]]:
    """(column, type before, type now) of every value that is new, gone or of another type; None where it is not."""
    shown = lambda schema: {x.name: x.kind.simpleString() if x.kind else "mixed" for x in leaves(schema)}
    old, new = shown(known), shown(found)
    return [(n, old.get(n), new.get(n)) for n in sorted({*old, *new}) if old.get(n) != new.get(n)]
