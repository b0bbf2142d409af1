"""Catalogue payload feeds: JSON documents to contract rows, declared like report feeds."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.functions import nested as J
from bazaar.functions import numbers as N
from bazaar.functions import text as X
from bazaar.operators import contracts as C
from bazaar.sources.payloads import parse_payload


@dataclass(frozen=True)
class PayloadFeed:
    """Where the items of a document are and how a field is treated.

    ``items`` is the path to the item array, ``inner`` the record inside an
    item. ``flatten`` turns nested records into ``a__b`` columns. Fields whose
    name starts with ``price`` are scaled when ``scale_prices``; ``positive_only``
    leaves zero and negative ones alone. ``joined`` lists become comma text,
    ``texts`` become JSON text, ``unfold`` records become columns, ``images``
    get the image address in front.
    """

    items: str
    inner: str | None = None
    flatten: bool = False
    scale_prices: bool = False
    positive_only: bool = False
    images: tuple[str, ...] = ()
    always_null: tuple[str, ...] = ()
    joined: tuple[str, ...] = ()
    texts: tuple[str, ...] = ()
    unfold: tuple[str, ...] = ()
    renames: dict[str, str] = field(default_factory=dict)


# Paths and fields of the catalogue payloads.
PAYLOAD_FEEDS: dict[str, PayloadFeed] = {
    "catalogue_search": PayloadFeed(
        items="items", inner="item_basic", scale_prices=True, positive_only=True, images=("image",)
    ),
    "catalogue_recommended": PayloadFeed(
        items="data.sections[0].data.item", scale_prices=True, images=("image",), texts=("size_chart",),
        always_null=("spl_repayment_label_text", "spl_repayment_label_repayment", "exclusive_price_info"),
    ),
    "catalogue_list_items": PayloadFeed(items="mods.listItems", flatten=True),
    "catalogue_products": PayloadFeed(
        items="data.products", joined=("images", "categoryIdHierarchy", "categoryNameHierarchy"),
        unfold=("price", "review", "storeClosingInfo", "badge", "soldRangeCount"),
        renames={
            "id": "productId", "name": "productName",
            "soldRangeCount.id": "soldRangeCountId", "soldRangeCount.en": "soldRangeCountEn",
        },
    ),
    "mall_reviews": PayloadFeed(items="data.ratings", unfold=("detailed_rating",)),
}


def _at(doc: str, path: str) -> Column:
    """Column at a dotted path with optional [index] steps; absent steps are NULL."""
    out = F.col(doc)
    for step in path.split("."):
        name, _, index = step.partition("[")
        out = out.getField(name)
        if index:
            out = F.get(out, F.lit(int(index.rstrip("]"))))
    return out


def shape_payload(
    payloads: DataFrame,
    feed: PayloadFeed,
    payload_schema: str | T.StructType,
    schema: T.StructType,
    image_base: str = "",
    **tags: object,
) -> DataFrame:
    """Payload documents (column ``payload``) to contract rows.

    Keys outside ``payload_schema`` are ignored, missing ones are NULL, absent
    records become records of NULL fields.
    """
    docs = parse_payload(payloads, "payload", payload_schema)
    rows = J.explode_items(docs, _at("doc", feed.items), [], inner=feed.inner)
    rows = rows.withColumnsRenamed({k: v for k, v in feed.renames.items() if "." not in k})
    if feed.joined:
        rows = C.stringify(rows, [c for c in feed.joined if c in rows.columns])
    if feed.texts:
        rows = C.stringify(rows, [c for c in feed.texts if c in rows.columns], list_sep=None)
    if feed.unfold:
        rows = J.flatten_struct_columns(rows, list(feed.unfold), feed.renames)
    if feed.flatten:
        rows = J.flatten_json(rows.select(F.struct("*").alias("doc")), "doc")
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    changed: dict[str, Column] = {}
    for name, kind in kinds.items():
        if feed.scale_prices and name.startswith("price") and isinstance(kind, T.NumericType):
            changed[name] = N.scale_price(F.col(name), feed.positive_only)
        if name in feed.images:
            changed[name] = X.url_prefix(image_base, F.col(name))
        if name in feed.always_null:
            changed[name] = F.lit(None).cast(kind)
    shaped = C.conform(C.tag(rows.withColumns(changed) if changed else rows, **tags), schema)
    records = {
        f.name: J.fill_null_record(F.col(f.name), f.dataType)
        for f in schema.fields
        if isinstance(f.dataType, T.StructType)
    }
    return shaped.withColumns(records) if records else shaped


def shape_brands(payloads: DataFrame, payload_schema: str, base: str) -> DataFrame:
    """Shops of all brand groups with their address."""
    docs = parse_payload(payloads, "payload", payload_schema)
    rows = J.explode_nested(docs, F.col("doc.data.brands"), "brand_ids", [])
    return rows.withColumn("brand_url", X.url_prefix(base, F.col("username")))


def shape_layout(payloads: DataFrame, payload_schema: str, schema: T.StructType, **tags: object) -> DataFrame:
    """Basic info and product content of one page layout side by side."""
    layout = parse_payload(payloads, "payload", payload_schema).select(F.col("doc.data.pdpGetLayout").alias("l"))
    content = F.get(J.find_element(F.col("l.components"), "name", "product_content").getField("data"), F.lit(0))
    both = layout.select(F.col("l.basicInfo").alias("basic"), content.alias("content"))
    basic = J.struct_leaves(both.schema["basic"].dataType)
    extra = [p for p in J.struct_leaves(both.schema["content"].dataType) if p not in basic]
    rows = both.select(
        *[_leaf("basic", p) for p in basic if p != ("__typename",)],
        *[_leaf("content", p) for p in extra if p != ("__typename",)],
    )
    return C.conform(C.tag(rows, **tags), schema)


def _leaf(root: str, path: tuple[str, ...]) -> Column:
    value = F.col(root)
    for part in path:
        value = value.getField(part)
    return value.alias(J.flat_name(list(path)))
