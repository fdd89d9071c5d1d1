"""Filter, search, sort, page, export and look up."""

from __future__ import annotations

from pyspark.sql import functions as F

from querybook.registry import Book
from querybook.specs import (
    ALL_ORDERS,
    DOCUMENTS,
    ORDERS,
    PART,
    PART_WITH_LINES,
    SUPPLIER,
    catalog,
)
from shelfmark import PageRequest
from shelfmark.functions.predicates import compare, where
from shelfmark.operators import lookup
from shelfmark.operators.items import item_json
from shelfmark.operators.rankindex import RankIndex
from shelfmark.operators.textindex import TextIndex
from shelfmark.plans.request import Condition
from shelfmark.session import new_path
from shelfmark.streaming.extract import changed_since

BOOK = Book()

ORDER_ITEM_SQL = """
    CAST(o_orderkey AS VARCHAR) AS external_id, o_orderpriority AS title, o_totalprice AS price,
    'USD' AS currency, 'order' AS category, o_orderstatus AS status,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%gZ') AS updated_at"""
ORDER_ITEM = [
    "externalId AS external_id",
    "title",
    "price",
    "currency",
    "category",
    "status",
    "updatedAt AS updated_at",
]


@BOOK.add(f"""
    SELECT {ORDER_ITEM_SQL} FROM orders
    WHERE (o_orderstatus = 'O' OR o_orderstatus = 'F')
      AND o_totalprice >= 1000 AND o_totalprice <= 400000
    ORDER BY o_orderdate DESC NULLS LAST, o_orderkey LIMIT 20 OFFSET 40""")
def catalog_page(tables):
    params = {"page": "3", "filter.minPrice": "1000", "filter.maxPrice": "400000"}
    return catalog(ORDERS, tables).page(PageRequest.parse(ORDERS, params)).selectExpr(*ORDER_ITEM)


@BOOK.add("""
    SELECT p_partkey, p_name FROM part
    ORDER BY p_retailprice ASC NULLS LAST, p_partkey LIMIT 100 OFFSET 0""")
def catalog_page_asc(tables):
    params = {"sortBy": "p_retailprice", "sortDirection": "asc", "pageSize": "100"}
    page = catalog(PART, tables).page_rows(PageRequest.parse(PART, params))
    return page.select("p_partkey", "p_name")


@BOOK.add(f"""
    SELECT {ORDER_ITEM_SQL} FROM orders
    ORDER BY o_orderdate DESC NULLS LAST, o_orderkey LIMIT 100 OFFSET 11900""")
def catalog_page_deep(tables):
    params = {"page": "120", "pageSize": "100"}
    page = catalog(ALL_ORDERS, tables).page(PageRequest.parse(ALL_ORDERS, params))
    return page.selectExpr(*ORDER_ITEM)


@BOOK.add(f"""
    SELECT {ORDER_ITEM_SQL} FROM orders
    ORDER BY o_orderdate DESC NULLS LAST, o_orderkey LIMIT 100 OFFSET 11900""")
def catalog_page_indexed(tables):
    """The same deep page from a stored order of all rows, opened again after it was written."""
    shown, path = catalog(ALL_ORDERS, tables), new_path(tables.spark, "order-index")
    request = PageRequest.parse(ALL_ORDERS, {"page": "120", "pageSize": "100"})
    shown.index_pages(path, request)
    return shown.indexed_page(RankIndex.open(tables.spark, path), request).selectExpr(*ORDER_ITEM)


@BOOK.add("""
    SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) AS rank FROM orders""")
def ranks_indexed(tables):
    """The rank of every row, read from a stored order."""
    index = catalog(ALL_ORDERS, tables).index_pages(new_path(tables.spark, "order-index"))
    return index.ranked().select("o_orderkey", "rank")


def _matching_parts(tables, params, *columns):
    return catalog(PART, tables).rows(PageRequest.parse(PART, params)).select(*columns)


@BOOK.add("SELECT p_partkey, p_brand FROM part WHERE p_brand = 'Brand#7'")
def filter_string(tables):
    return _matching_parts(tables, {"filter.brand": "Brand#7"}, "p_partkey", "p_brand")


@BOOK.add("SELECT p_partkey, p_size FROM part WHERE p_size = 7")
def filter_number(tables):
    return _matching_parts(tables, {"filter.size": "7"}, "p_partkey", "p_size")


@BOOK.add("SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice > 950 AND p_retailprice < 1000")
def filter_strict(tables):
    part = tables.part
    above = compare(part, Condition("p_retailprice", ">", 950))
    below = compare(part, Condition("p_retailprice", "<", 1000))
    return where(part, None, above, below).select("p_partkey", "p_retailprice")


@BOOK.add("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 1000.5 AND o_totalprice <= 90000")
def filter_bounds(tables):
    params = {"filter.minPrice": "1000.5", "filter.maxPrice": "90000", "filter.unknown": "x"}
    rows = catalog(ALL_ORDERS, tables).rows(PageRequest.parse(ALL_ORDERS, params))
    return rows.select("o_orderkey", "o_totalprice")


@BOOK.add("""
    SELECT p_partkey, p_name, p_brand FROM part
    WHERE p_size >= 10 AND (p_name ILIKE '%RE%' OR p_brand ILIKE '%RE%')""")
def search_multi(tables):
    params = {"search": "RE", "filter.minSize": "10"}
    return _matching_parts(tables, params, "p_partkey", "p_name", "p_brand")


@BOOK.add("SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%r_d%' OR p_brand ILIKE '%r_d%'")
def search_wildcard(tables):
    return _matching_parts(tables, {"search": "r_d"}, "p_partkey", "p_name")


def _found_by_index(tables, spec, params, block_rows):
    """Rows of a search from an index that was written and opened again."""
    shown, path = catalog(spec, tables), new_path(tables.spark, "text-index")
    shown.index_text(path, block_rows)
    return shown.indexed_rows(TextIndex.open(tables.spark, path), PageRequest.parse(spec, params))


@BOOK.add("""
    SELECT p_partkey, p_name, p_brand FROM part
    WHERE p_size >= 10 AND (p_name ILIKE '%RE%' OR p_brand ILIKE '%RE%')""")
def search_indexed(tables):
    """The search of two columns, by an index of runs of characters."""
    found = _found_by_index(tables, PART, {"search": "RE", "filter.minSize": "10"}, 200)
    return found.select("p_partkey", "p_name", "p_brand")


@BOOK.add("SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%r_d%' OR p_brand ILIKE '%r_d%'")
def search_wildcard_indexed(tables):
    return _found_by_index(tables, PART, {"search": "r_d"}, 200).select("p_partkey", "p_name")


@BOOK.add("SELECT doc_id, source FROM documents WHERE text ILIKE '%benchmark%' AND lang = 'en'")
def search_text_indexed(tables):
    """A rare run of characters in long texts."""
    found = _found_by_index(tables, DOCUMENTS, {"search": "benchmark", "filter.lang": "en"}, 50)
    return found.select("doc_id", "source")


@BOOK.add("SELECT doc_id, source FROM documents WHERE text ILIKE '%tion%' AND lang = 'en'")
def search_text(tables):
    request = PageRequest.parse(DOCUMENTS, {"search": "tion", "filter.lang": "en"})
    return catalog(DOCUMENTS, tables).rows(request).select("doc_id", "source")


@BOOK.add("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01 00:00:00'")
def updated_since(tables):
    request = PageRequest.parse(ALL_ORDERS, {"updatedSince": "2001-01-01T00:00:00Z"})
    return catalog(ALL_ORDERS, tables).rows(request).select("o_orderkey", "o_orderdate")


@BOOK.add("""
    SELECT count(*) AS total, CAST(2 AS INTEGER) AS page, CAST(20 AS INTEGER) AS page_size,
           CAST(ceil(count(*) / 20.0) AS BIGINT) AS total_pages
    FROM orders WHERE o_totalprice >= 100000""")
def page_summary(tables):
    request = PageRequest.parse(ALL_ORDERS, {"page": "2", "filter.minPrice": "100000"})
    return catalog(ALL_ORDERS, tables).summary(request)


@BOOK.add("""
    SELECT CAST(p_partkey AS VARCHAR) AS external_id, p_name AS title, p_retailprice AS price,
           'USD' AS currency, p_type AS category, 'ACTIVE' AS status,
           p_brand AS attr_brand, p_size AS attr_size
    FROM part""")
def catalog_export(tables):
    return catalog(PART, tables).items().select(
        F.col("externalId").alias("external_id"), "title", "price", "currency", "category",
        "status", F.col("attributes.brand").alias("attr_brand"),
        F.col("attributes.size").alias("attr_size"),
    )


@BOOK.add("""
    SELECT CAST(p_partkey AS VARCHAR) AS external_id, p_retailprice AS price, p_brand AS brand,
           p_size AS size, CAST(NULL AS VARCHAR) AS updated_at,
           CAST((SELECT count(*) FROM lineitem WHERE l_partkey = p_partkey) AS INTEGER) AS n_lines
    FROM part""")
def items_json(tables):
    """Items as JSON records and read back from them."""
    items = catalog(PART_WITH_LINES, tables).items()
    parsed = F.from_json(
        item_json(items),
        "externalId string, price double, updatedAt string, "
        "attributes struct<brand:string,size:int,lines:array<struct<order:bigint>>>",
    )
    return items.select(parsed.alias("r")).select(
        F.col("r.externalId").alias("external_id"),
        "r.price",
        "r.attributes.brand",
        "r.attributes.size",
        F.col("r.updatedAt").alias("updated_at"),
        F.size("r.attributes.lines").alias("n_lines"),
    )


@BOOK.add("""
    SELECT o_orderkey, row_number() OVER w AS rank,
           CAST((row_number() OVER w - 1) // 100 + 1 AS BIGINT) AS page
    FROM orders WINDOW w AS (ORDER BY o_orderdate DESC NULLS LAST, o_orderkey)""")
def all_pages(tables):
    request = PageRequest.parse(ALL_ORDERS, {"pageSize": "100"})
    return catalog(ALL_ORDERS, tables).all_pages(request).select("o_orderkey", "rank", "page")


@BOOK.add("""
    SELECT CAST(p_partkey AS VARCHAR) AS external_id, p_name AS title, p_retailprice AS price,
           (SELECT count(*) FROM lineitem WHERE l_partkey = p_partkey) AS n_lines
    FROM part WHERE p_partkey = 7""")
def item_by_id(tables):
    item = catalog(PART_WITH_LINES, tables).item("7")
    lines = F.size("attributes.lines").cast("bigint").alias("n_lines")
    return item.select(F.col("externalId").alias("external_id"), "title", "price", lines)


@BOOK.add("""
    SELECT CAST(user_id AS VARCHAR) AS id, count(*) AS requests, any_value(s_name) AS title,
           CAST(CASE WHEN any_value(s_suppkey) IS NULL THEN 404 ELSE 200 END AS INTEGER) AS status
    FROM events LEFT JOIN supplier ON s_suppkey = user_id GROUP BY user_id""")
def bulk_lookup(tables):
    """Every event asks for a supplier by its user's number; many ask for the same one."""
    answers = catalog(SUPPLIER, tables).lookup(tables.events.select("user_id"))
    return answers.select("id", "requests", "title", F.col("status_code").alias("status"))


@BOOK.add("""
    SELECT CAST(l_orderkey AS VARCHAR) AS id, count(*) AS requests, min(p_name) AS title,
           min(p_brand) AS brand,
           CAST((SELECT count(*) FROM lineitem x WHERE x.l_partkey = l.l_orderkey) AS INTEGER)
               * CASE WHEN min(p_partkey) IS NULL THEN NULL ELSE 1 END AS n_lines
    FROM lineitem l LEFT JOIN part ON p_partkey = l_orderkey GROUP BY l_orderkey""")
def bulk_lookup_with_children(tables):
    """As many ids as there are orders, most of them no part's."""
    answers = catalog(PART_WITH_LINES, tables).lookup(tables.lineitem.select("l_orderkey"))
    found = F.col("attributes").isNotNull()
    return answers.select(
        "id", "requests", "title", "attributes.brand",
        F.when(found, F.size("attributes.lines")).alias("n_lines"),
    )


@BOOK.add("""
    SELECT CAST(user_id AS VARCHAR) AS id, count(*) AS requests
    FROM events ANTI JOIN supplier ON s_suppkey = user_id GROUP BY user_id""")
def lookup_misses(tables):
    return lookup.misses(catalog(SUPPLIER, tables), tables.events.select("user_id"))


@BOOK.add("""
    SELECT max(o_orderdate) AS high_water, count(*) AS n FROM orders
    WHERE o_orderdate >= TIMESTAMP '2001-07-01 00:00:00'""")
def incremental_extract(tables):
    return changed_since(tables.orders, ALL_ORDERS, "2001-07-01T00:00:00Z").mark


@BOOK.add("""
    SELECT TIMESTAMP '2101-01-01 00:00:00' AS high_water, count(*) AS n FROM orders
    WHERE o_orderdate >= TIMESTAMP '2101-01-01 00:00:00'""")
def incremental_extract_nothing_new(tables):
    """Where nothing has changed the mark stays."""
    return changed_since(tables.orders, ALL_ORDERS, "2101-01-01T00:00:00Z").mark


@BOOK.add("""
    WITH mark AS (SELECT max(o_orderdate) AS since FROM orders WHERE o_orderstatus = 'P'
                  AND o_orderdate < TIMESTAMP '2001-06-15 00:00:00')
    SELECT o_orderkey, o_orderdate FROM orders CROSS JOIN mark m
    WHERE o_orderdate >= m.since AND NOT (o_orderdate = m.since AND o_orderstatus = 'P')""")
def incremental_extract_again(tables):
    """A pull from a mark leaves out what an earlier pull already had at the mark."""
    orders = tables.orders
    pending = orders.where("o_orderstatus = 'P' AND o_orderdate < TIMESTAMP_NTZ '2001-06-15'")
    mark = pending.agg(F.max("o_orderdate")).first()[0]
    pulled = changed_since(pending, ALL_ORDERS, "1992-01-01T00:00:00Z").rows
    again = changed_since(orders, ALL_ORDERS, mark.isoformat(), pulled).rows
    return again.select("o_orderkey", "o_orderdate")
