"""Contracts: declared columns and types, and conformance of messy data to them."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.functions import text as X

# Contract type words. A time of day is kept as text HH:mm:ss.
CONTRACT_TYPES = {
    "STRING": T.StringType(),
    "INTEGER": T.LongType(),
    "INT64": T.LongType(),
    "FLOAT": T.DoubleType(),
    "FLOAT64": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "BOOL": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "DATETIME": T.TimestampNTZType(),
    "TIME": T.StringType(),
}


class ContractError(ValueError):
    """Raised when data cannot be made to fit a contract."""


def contract(fields: list[dict] | dict[str, str]) -> T.StructType:
    """List form ``[{name, type, mode, fields}]`` or map form ``{name: type}``."""
    if isinstance(fields, dict):
        fields = [{"name": name, "type": kind} for name, kind in fields.items()]
    return T.StructType([T.StructField(f["name"], _field_type(f), True) for f in fields])


def _field_type(field: dict) -> T.DataType:
    kind = field["type"].upper()
    if kind in ("RECORD", "STRUCT"):
        inner: T.DataType = contract(field["fields"])
    elif kind in CONTRACT_TYPES:
        inner = CONTRACT_TYPES[kind]
    else:
        raise ContractError(f"unknown contract type {kind} for {field['name']}")
    return T.ArrayType(inner) if field.get("mode", "").upper() == "REPEATED" else inner


def parse_boolean(text: Column) -> Column:
    """true/false/1/0 in any case; anything else is NULL."""
    word = F.lower(F.trim(text))
    return F.when(word.isin("true", "1"), True).when(word.isin("false", "0"), False)


def _tolerant(column: Column, source: T.DataType, target: T.DataType) -> Column:
    if source == target:
        return column
    if isinstance(source, (T.StructType, T.ArrayType)) and not isinstance(target, T.StringType):
        return column.cast(target)
    if not isinstance(source, T.StringType):
        return F.to_json(column) if isinstance(source, (T.StructType, T.ArrayType)) else column.try_cast(target)
    if isinstance(target, T.LongType):
        return X.int_from_float_text(column)
    if isinstance(target, T.DoubleType):
        return X.to_number(column)
    if isinstance(target, T.BooleanType):
        return parse_boolean(column)
    return F.trim(column).try_cast(target)


def cast_null_on_error(df: DataFrame, schema: T.StructType, extra: tuple[str, ...] = ()) -> DataFrame:
    """Typed columns; a value that does not fit becomes NULL."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *extra, *[_tolerant(F.col(f.name), have[f.name], f.dataType).alias(f.name) for f in schema.fields]
    )


def cast_strict(df: DataFrame, schema: T.StructType, extra: tuple[str, ...] = ()) -> DataFrame:
    """Typed columns; the job fails on the first value that does not fit."""
    return df.select(*extra, *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def zero_on_error(text: Column, target: str = "double", money: bool = False) -> Column:
    """Numeric garbage and missing values become 0."""
    number = X.parse_money(text) if money else X.to_number(text)
    return F.coalesce(number.cast(target), F.lit(0).cast(target))


def conform(df: DataFrame, schema: T.StructType, defaults: dict[str, object] | None = None) -> DataFrame:
    """Exactly the contract's columns, in its order, in its types.

    Extra columns are dropped; missing ones get their default or a typed NULL.
    """
    defaults = defaults or {}
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            (
                _tolerant(F.col(f.name), have[f.name], f.dataType)
                if f.name in have
                else F.lit(defaults.get(f.name)).cast(f.dataType)
            ).alias(f.name)
            for f in schema.fields
        ]
    )


def add_if_missing(df: DataFrame, allowed: dict[str, str]) -> DataFrame:
    """Add only the listed optional columns (name: type) where they are absent."""
    absent = {n: F.lit(None).cast(t) for n, t in allowed.items() if n not in df.columns}
    return df.withColumns(absent) if absent else df


def validate_columns(df: DataFrame, expected: list[str], optional: list[str] = ()) -> DataFrame:
    """Accept the expected header multiset, repair absent optional columns, else reject."""
    found, wanted = Counter(df.columns), Counter(expected)
    if found == wanted:
        return df.select(*expected)
    unknown = found - wanted
    missing = wanted - found
    if unknown or set(missing) - set(optional):
        raise ContractError(
            f"headers changed: unknown {sorted(unknown)}, missing {sorted(set(missing) - set(optional))}"
        )
    return add_if_missing(df, {n: "string" for n in missing}).select(*expected)


def drop_array_columns(df: DataFrame) -> DataFrame:
    """Leave out every list-valued column."""
    return df.drop(*[f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)])


def stringify(df: DataFrame, columns: list[str], list_sep: str | None = ",") -> DataFrame:
    """Columns to text: lists joined by ``list_sep`` (JSON when None), records as JSON."""
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def as_text(name: str) -> Column:
        kind = kinds[name]
        if isinstance(kind, T.ArrayType) and list_sep is not None:
            return F.array_join(F.col(name).cast("array<string>"), list_sep)
        if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
            return F.to_json(F.col(name))
        return F.col(name).cast("string")

    return df.withColumns({name: as_text(name) for name in columns})


def nullify_columns(df: DataFrame, words: tuple[str, ...] = X.MISSING_WORDS) -> DataFrame:
    """Sentinel words in text columns and NaN in floating columns become NULL."""
    out = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            column = X.nullify(column, words)
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.when(~F.isnan(column), column)
        out.append(column.alias(field.name))
    return df.select(*out)


def tag(df: DataFrame, **values: object) -> DataFrame:
    """Literal columns such as store, folder or load time; the clock is an argument."""
    return df.withColumns(
        {name: value if isinstance(value, Column) else F.lit(value) for name, value in values.items()}
    )
