"""Nested JSON: flatten, explode, pick, default, back to text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flat_name(path: list[str], sep: str = "__") -> str:
    """Column name of a nested path: own ``__`` dropped, joined, lower case."""
    return sep.join(part.replace("__", "") for part in path).lower()


def struct_leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    """Paths of all non-struct fields, depth first, arrays kept whole."""
    leaves: list[tuple[str, ...]] = []
    for field in schema.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, T.StructType):
            leaves += struct_leaves(field.dataType, here)
        else:
            leaves.append(here)
    return leaves


def flatten_json(df: DataFrame, struct_column: str, sep: str = "__", keep: tuple[str, ...] = ()) -> DataFrame:
    """One column per leaf of a struct column, in a single projection."""
    schema = df.schema[struct_column].dataType
    root = F.col(struct_column)
    picked = []
    for path in struct_leaves(schema):
        value = root
        for part in path:
            value = value.getField(part)
        picked.append(value.alias(flat_name(list(path), sep)))
    return df.select(*keep, *picked)


def flatten_struct_columns(df: DataFrame, columns: list[str], renames: dict[str, str] | None = None) -> DataFrame:
    """Replace struct columns by their fields; ``renames`` maps a field to its new name."""
    renames = renames or {}
    out = []
    for field in df.schema.fields:
        if field.name in columns:
            out += [
                F.col(field.name).getField(inner).alias(renames.get(f"{field.name}.{inner}", inner))
                for inner in field.dataType.fieldNames()
            ]
        else:
            out.append(F.col(field.name))
    return df.select(*out)


def discover_schema(df: DataFrame, json_column: str) -> str:
    """DDL-like schema of all payloads, found by one distributed aggregate."""
    parsed = F.try_parse_json(F.col(json_column))
    return df.select(F.schema_of_variant_agg(parsed)).first()[0]


def explode_rows(
    df: DataFrame, array: Column, keep: list[str], name: str = "item", position: str | None = None
) -> DataFrame:
    """One row per array element, with its 0-based position when asked for.

    A plain explode makes Spark add "array is not empty" filters below it, which
    compute the array again; for arrays parsed or matched out of large texts that
    is most of the work. The outer form adds none, and dropping the rows without a
    position leaves exactly the elements.
    """
    rows = df.select(*keep, F.posexplode_outer(array).alias("_at", name)).filter(F.col("_at").isNotNull())
    out = [*keep, F.col("_at").alias(position), name] if position else [*keep, name]
    return rows.select(*out)


def explode_items(df: DataFrame, items: Column, keep: list[str], inner: str | None = None) -> DataFrame:
    """One row per array element; its fields (or those of ``inner``) become columns."""
    rows = explode_rows(df, items, keep, "_item")
    return rows.select(*keep, f"_item.{inner}.*" if inner else "_item.*")


def explode_nested(df: DataFrame, outer: Column, inner: str, keep: list[str]) -> DataFrame:
    """One row per element of an array inside an array of structs."""
    both = F.flatten(F.transform(outer, lambda s: s.getField(inner)))
    return explode_items(df, both, keep)


def find_element(items: Column, attribute: str, value: str) -> Column:
    """First element whose attribute equals the value, else NULL."""
    hits = F.filter(items, lambda x: x.getField(attribute) == value)
    return F.try_element_at(hits, F.lit(1))


def null_struct(data_type: T.StructType) -> Column:
    """A struct whose fields are all NULL."""
    return F.struct(
        *[
            (null_struct(f.dataType) if isinstance(f.dataType, T.StructType) else F.lit(None).cast(f.dataType)).alias(
                f.name
            )
            for f in data_type.fields
        ]
    )


def fill_null_record(column: Column, data_type: T.StructType) -> Column:
    """An absent record becomes a record of NULL fields."""
    return F.coalesce(column.cast(data_type), null_struct(data_type))


def optional_field(df: DataFrame, struct_column: str, field: str, data_type: str) -> Column:
    """Field of a struct column, or a typed NULL where the schema lacks it."""
    struct = df.schema[struct_column].dataType if struct_column in df.columns else None
    if struct is not None and field in struct.fieldNames():
        return F.col(struct_column).getField(field).cast(data_type)
    return F.lit(None).cast(data_type)


def json_default(payload: Column, path: str, default: str) -> Column:
    """Value at a JSON path, or the default where the key is missing."""
    return F.coalesce(F.get_json_object(payload, path), F.lit(default))


def edge_list(df: DataFrame, owner: str, post: str, tagged: Column) -> DataFrame:
    """(owner, post, tagged) rows of an array of tagged names."""
    named = df.select(F.col(owner).alias("owner"), F.col(post).alias("post"), tagged.alias("_tagged"))
    return explode_rows(named, F.col("_tagged"), ["owner", "post"], "tagged")


def widget_cells(df: DataFrame, widgets: Column, data_key: str, keep: list[str]) -> DataFrame:
    """Cells of the table widget with the given key: (…, row_no, col_no, value).

    A widget is ``struct<data_key, rows array<struct<columns array<struct<value>>>>>``.
    """
    from bazaar.functions.html import strip_tags

    found = F.filter(widgets, lambda w: w.getField("data_key") == data_key)
    rows = explode_rows(explode_rows(df, found, keep, "_w"), F.col("_w.rows"), keep, "_r", "row_no")
    cells = explode_rows(rows, F.col("_r.columns"), [*keep, "row_no"], "_c", "col_no")
    return cells.select(*keep, "row_no", "col_no", strip_tags(F.col("_c.value")).alias("value"))
