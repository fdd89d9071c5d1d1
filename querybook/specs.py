"""Resource specs over the driver's tables."""

from __future__ import annotations

from dataclasses import replace

from querybook.registry import Tables
from shelfmark import Catalog, FilterSpec, RelationSpec, ResourceSpec

LINE_FLAGS = RelationSpec("lineitem", "l_orderkey", {"flag": "l_returnflag"}, flatten="flag")
LINES = RelationSpec(
    "lineitem",
    "l_partkey",
    {"order": "l_orderkey", "line": "l_linenumber", "flag": "l_returnflag"},
    reference_key="p_partkey",
)
PICTURES = RelationSpec("pages", "page_id", {"url": "url"}, image_url_field="url")
LABELS = RelationSpec("labels", "doc_id", {"quality": "quality", "toxic": "toxic"})

ORDERS = ResourceSpec(
    table="orders",
    id_column="o_orderkey",
    updated_at_column="o_orderdate",
    base_filter="o_orderstatus = 'O' OR o_orderstatus = 'F'",
    fields={
        "externalId": "o_orderkey",
        "title": "o_orderpriority",
        "price": "o_totalprice",
        "currency": "'USD'",
        "category": "'order'",
        "status": "o_orderstatus",
    },
    filterable_columns={
        "minPrice": FilterSpec("o_totalprice", "gte"),
        "maxPrice": FilterSpec("o_totalprice", "lte"),
    },
)
ALL_ORDERS = replace(ORDERS, base_filter=None)
ORDERS_WITH_FLAGS = replace(ORDERS, relations={"flags": LINE_FLAGS})
ALL_ORDERS_WITH_FLAGS = replace(ALL_ORDERS, relations={"flags": LINE_FLAGS})

PART = ResourceSpec(
    table="part",
    id_column="p_partkey",
    fields={"title": "p_name", "price": "p_retailprice", "category": "p_type"},
    attributes={"brand": "p_brand", "size": "p_size"},
    searchable_columns=("p_name", "p_brand"),
    filterable_columns={
        "brand": FilterSpec("p_brand", "string"),
        "size": FilterSpec("p_size", "number"),
        "minSize": FilterSpec("p_size", "gte"),
    },
)
PART_WITH_LINES = replace(PART, relations={"lines": LINES})

DOCUMENTS = ResourceSpec(
    table="documents",
    id_column="doc_id",
    fields={"title": "source", "category": "lang"},
    searchable_columns=("text",),
    filterable_columns={"lang": FilterSpec("lang", "string")},
    relations={"images": PICTURES, "labels": LABELS},
)

SUPPLIER = ResourceSpec(
    table="supplier",
    id_column="s_suppkey",
    fields={"title": "s_name", "price": "s_acctbal"},
)


def catalog(spec: ResourceSpec, tables: Tables) -> Catalog:
    children = tables.named(r.table for r in spec.relations.values())
    return Catalog(spec, getattr(tables, spec.table), children)
