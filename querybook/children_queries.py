"""Parents with their children."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from querybook.registry import Book
from querybook.specs import (
    ALL_ORDERS,
    ALL_ORDERS_WITH_FLAGS,
    DOCUMENTS,
    LINE_FLAGS,
    ORDERS_WITH_FLAGS,
    PART_WITH_LINES,
    catalog,
)
from shelfmark import PageRequest, RelationSpec

BOOK = Book()

FILTERED_LINES = RelationSpec(
    "lineitem",
    "l_orderkey",
    {"quantity": "l_quantity"},
    filter="l_returnflag = 'R' OR l_returnflag = 'A'",
)


def _joined(array: str):
    return F.array_join(F.array_sort(array), "|")


@BOOK.add("""
    SELECT o_orderkey, coalesce(string_agg(l_returnflag, '|' ORDER BY l_returnflag), '') AS flags
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def children_flatten(tables):
    items = catalog(ALL_ORDERS_WITH_FLAGS, tables).items()
    key = F.col("externalId").cast("bigint").alias("o_orderkey")
    return items.select(key, _joined("attributes.flags").alias("flags"))


@BOOK.add("""
    SELECT o_orderkey, count(l_orderkey) AS n_children, coalesce(sum(l_quantity), 0) AS qty
    FROM orders LEFT JOIN lineitem
      ON l_orderkey = o_orderkey AND (l_returnflag = 'R' OR l_returnflag = 'A')
    GROUP BY o_orderkey""")
def children_filtered(tables):
    spec = replace(ALL_ORDERS, relations={"lines": FILTERED_LINES})
    lines = F.col("attributes.lines")
    total = F.aggregate(lines, F.lit(0.0), lambda sum_, line: sum_ + line["quantity"])
    return catalog(spec, tables).items().select(
        F.col("externalId").cast("bigint").alias("o_orderkey"),
        F.size(lines).cast("bigint").alias("n_children"),
        total.alias("qty"),
    )


@BOOK.add("""
    SELECT p_partkey, coalesce(string_agg(l_orderkey || ':' || l_linenumber || l_returnflag, '|'
           ORDER BY l_orderkey, l_linenumber, l_returnflag), '') AS lines
    FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey""")
def children_nested(tables):
    line = F.transform("attributes.lines", lambda x: F.concat(x["order"], F.lit(":"), x["line"], x["flag"]))
    return catalog(PART_WITH_LINES, tables).items().select(
        F.col("externalId").cast("bigint").alias("p_partkey"),
        F.array_join(line, "|").alias("lines"),
    )


@BOOK.add("""
    SELECT doc_id, coalesce(string_agg(url, '|' ORDER BY url), '') AS images
    FROM documents LEFT JOIN pages ON page_id = doc_id AND url <> '' GROUP BY doc_id""")
def children_images(tables):
    items = catalog(DOCUMENTS, tables).items()
    key = F.col("externalId").cast("bigint").alias("doc_id")
    return items.select(key, _joined("images").alias("images"))


@BOOK.add("""
    SELECT doc_id, (SELECT count(*) FROM labels l WHERE l.doc_id = d.doc_id) AS n_labels,
           (SELECT count(*) FROM pages WHERE page_id = d.doc_id) AS n_pages
    FROM documents d""")
def multi_relation(tables):
    return catalog(DOCUMENTS, tables).items().select(
        F.col("externalId").cast("bigint").alias("doc_id"),
        F.size("attributes.labels").cast("bigint").alias("n_labels"),
        F.size("images").cast("bigint").alias("n_pages"),
    )


FLAGS_SQL = """coalesce((SELECT string_agg(l_returnflag, '|' ORDER BY l_returnflag)
                         FROM lineitem WHERE l_orderkey = o_orderkey), '') AS flags"""


@BOOK.add(f"""
    WITH pg AS (SELECT * FROM orders WHERE o_orderstatus <> 'P'
                ORDER BY o_orderdate DESC NULLS LAST, o_orderkey LIMIT 50)
    SELECT CAST(o_orderkey AS VARCHAR) AS external_id, o_totalprice AS price, {FLAGS_SQL} FROM pg""")
def catalog_page_with_children(tables):
    spec = replace(ORDERS_WITH_FLAGS, base_filter="o_orderstatus <> 'P'")
    page = catalog(spec, tables).page(PageRequest.parse(spec, {"pageSize": "50"}))
    flags = _joined("attributes.flags").alias("flags")
    return page.select(F.col("externalId").alias("external_id"), "price", flags)


@BOOK.add(f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS external_id, o_totalprice AS price, {FLAGS_SQL}
    FROM orders WHERE o_orderdate >= TIMESTAMP '2001-06-01 00:00:00'""")
def items_updated_since(tables):
    """Few parents out of many: their children are cut down before they are grouped."""
    spec = replace(ALL_ORDERS, relations={"flags": LINE_FLAGS})
    request = PageRequest.parse(spec, {"updatedSince": "2001-06-01T00:00:00Z"})
    items = catalog(spec, tables).items(request)
    flags = _joined("attributes.flags").alias("flags")
    return items.select(F.col("externalId").alias("external_id"), "price", flags)


@BOOK.add("""
    SELECT o_orderkey, count(l_orderkey) AS n_children,
           coalesce(string_agg(l_linenumber || l_returnflag, '|' ORDER BY l_linenumber, l_returnflag), '') AS lines
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def children_split_parts(tables):
    """Groups of more than four children go into parts; joined in order these are the sorted array."""
    relation = RelationSpec("lineitem", "l_orderkey", {"line": "l_linenumber", "flag": "l_returnflag"})
    spec = replace(ALL_ORDERS, relations={"lines": relation})
    split = catalog(spec, tables)
    split.array_rows = 4
    parts = F.sort_array(F.collect_list(F.struct("part", "attributes.lines")))
    joined = F.flatten(F.transform(parts, lambda part: part["lines"]))
    lines = F.transform(joined, lambda line: F.concat(line["line"], line["flag"]))
    return split.items().groupBy(F.col("externalId").cast("bigint").alias("o_orderkey")).agg(
        F.size(joined).cast("bigint").alias("n_children"), F.array_join(lines, "|").alias("lines")
    )


@BOOK.add("""
    SELECT CAST(o_orderkey AS VARCHAR) AS external_id, l_quantity AS quantity
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    WHERE o_orderstatus = 'P' AND (l_returnflag = 'R' OR l_returnflag = 'A')""")
def children_rows(tables):
    """Children as rows, whose form no group's size changes."""
    spec = replace(ALL_ORDERS, relations={"lines": FILTERED_LINES}, base_filter="o_orderstatus = 'P'")
    rows = catalog(spec, tables).child_rows("lines")
    return rows.select(F.col("externalId").alias("external_id"), "child.quantity")


@BOOK.add(f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS external_id, {FLAGS_SQL} FROM orders WHERE o_orderstatus = 'P'""")
def items_base_filtered(tables):
    """Items that the base filter shows, with all of their children."""
    spec = replace(ALL_ORDERS, relations={"flags": LINE_FLAGS}, base_filter="o_orderstatus = 'P'")
    items = catalog(spec, tables).items()
    return items.select(F.col("externalId").alias("external_id"), _joined("attributes.flags").alias("flags"))
