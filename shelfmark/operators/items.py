"""A main-table row and its child arrays as one item record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.columns import (
    as_text,
    backtick,
    column,
    column_type,
    literal_text,
    price_field,
    text_field,
    updated_at_field,
)
from shelfmark.operators.relations import array_column
from shelfmark.plans.spec import ResourceSpec

# What a missing field becomes.
DEFAULT_TITLE = ""
DEFAULT_CURRENCY = "USD"
DEFAULT_CATEGORY = ""
DEFAULT_STATUS = "ACTIVE"

ITEM_COLUMNS = (
    "externalId",
    "title",
    "price",
    "currency",
    "category",
    "status",
    "images",
    "attributes",
    "updatedAt",
)


def _attributes(spec: ResourceSpec, df: DataFrame) -> Column:
    """Mapped columns and un-pictured relations; a relation wins over a column's name."""
    values = {}
    for name, expression in spec.attributes.items():
        literal = literal_text(expression)
        if literal is None:
            values[name] = column(df, expression)
        elif literal:
            values[name] = F.lit(literal)
    for name, relation in spec.relations.items():
        if not relation.image_url_field:
            values[name] = F.col(backtick(array_column(name)))
    if not values:
        return F.create_map().cast("map<string,string>")
    return F.struct(*(value.alias(name) for name, value in values.items()))


def item_columns(spec: ResourceSpec, df: DataFrame) -> list[Column]:
    """The item's columns over ``df``, which holds main columns and child arrays."""
    pictured = [name for name, r in spec.relations.items() if r.image_url_field]
    if pictured:
        images = F.col(backtick(array_column(pictured[-1])))
    else:
        images = F.array().cast("array<string>")
    identity = as_text(column(df, spec.id_column), column_type(df, spec.id_column))
    return [
        F.coalesce(identity, F.lit("")).alias("externalId"),
        text_field(df, spec.fields.get("title"), DEFAULT_TITLE).alias("title"),
        price_field(df, spec.fields.get("price")).alias("price"),
        text_field(df, spec.fields.get("currency"), DEFAULT_CURRENCY).alias("currency"),
        text_field(df, spec.fields.get("category"), DEFAULT_CATEGORY).alias("category"),
        text_field(df, spec.fields.get("status"), DEFAULT_STATUS).alias("status"),
        images.alias("images"),
        _attributes(spec, df).alias("attributes"),
        updated_at_field(df, spec.updated_at_column).alias("updatedAt"),
    ]


def item_json(items: DataFrame) -> Column:
    """The item as a JSON record, nulls kept. Parts of a split item say which they are."""
    record = F.struct(*ITEM_COLUMNS)
    numbered = F.struct(*ITEM_COLUMNS, "part", "parts")
    keep_nulls = {"ignoreNullFields": "false"}
    return F.when(F.col("parts") > 1, F.to_json(numbered, keep_nulls)).otherwise(
        F.to_json(record, keep_nulls)
    )
