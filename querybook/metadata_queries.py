"""Profiles, keys found from the data, and schema matching over all tables."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import functions as F

from querybook.registry import Book
from shelfmark import Catalog, ResourceSpec
from shelfmark.operators import dependencies, matching, profile, sketches
from shelfmark.session import new_path
from shelfmark.sources import metadata

BOOK = Book()

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Keys as the tables' owner would declare them, by column names without the prefix.
PRIMARY_KEYS = {
    "region": "regionkey", "nation": "nationkey", "customer": "custkey", "supplier": "suppkey",
    "part": "partkey", "orders": "orderkey", "events": "event_id", "documents": "doc_id",
    "embeddings": "vec_id", "pages": "page_id", "benchmark": "item_id", "labels": "doc_id",
}
FOREIGN_KEYS = [
    ("lineitem", "orderkey", "orders", "orderkey"),
    ("lineitem", "partkey", "part", "partkey"),
    ("lineitem", "suppkey", "supplier", "suppkey"),
    ("orders", "custkey", "customer", "custkey"),
    ("customer", "nationkey", "nation", "nationkey"),
    ("supplier", "nationkey", "nation", "nationkey"),
    ("nation", "regionkey", "region", "regionkey"),
    ("labels", "doc_id", "documents", "doc_id"),
    ("pages", "page_id", "documents", "doc_id"),
]


def _bare(tables):
    """All tables, their columns without the one-letter prefix."""
    return {
        name: df.toDF(*(re.sub("^[a-z]_", "", c) for c in df.columns))
        for name, df in tables.named(TABLES).items()
    }


def _columns(tables):
    """Column metadata with declared keys, and the counts observed in the data."""
    columns = profile.profiled_columns(_bare(tables), frozenset(PRIMARY_KEYS.items()), False)
    return columns.drop("approx_distinct")


def _declared_references(tables):
    return tables.spark.createDataFrame(
        FOREIGN_KEYS, "from_table string, from_column string, to_table string, to_column string"
    )


def _union(template: str, names=TABLES) -> str:
    return " UNION ALL ".join(template.format(t=name) for name in names)


def _pairs(keys) -> str:
    return ", ".join(f"('{table}', '{column}')" for table, column in keys.items())


FILLED_SQL = _union(
    "SELECT '{t}' AS table_name, column_name, filled, (SELECT count(*) FROM {t}) AS row_count "
    "FROM (UNPIVOT (SELECT count(COLUMNS(*)) FROM {t}) ON COLUMNS(*) INTO NAME column_name VALUE filled)"
)
# Columns by bare name, with what they hold and whether they are declared a key.
COLUMNS_SQL = f"""
    filled AS ({FILLED_SQL}),
    cols AS (
        SELECT c.table_name, CAST(c.ordinal_position AS INTEGER) AS ordinal,
               regexp_replace(c.column_name, '^[a-z]_', '') AS column_name,
               c.data_type = 'VARCHAR' AS is_text,
               c.data_type IN ('BIGINT', 'INTEGER', 'DOUBLE') AS is_number,
               f.filled, f.row_count,
               (c.table_name, regexp_replace(c.column_name, '^[a-z]_', ''))
                   IN ({_pairs(PRIMARY_KEYS)}) AS is_key
        FROM information_schema.columns c
        JOIN filled f ON f.table_name = c.table_name AND f.column_name = c.column_name
        WHERE c.table_name IN ({", ".join(f"'{t}'" for t in TABLES)}))"""
# Names that mean a field or attribute.
FIELD_CASES = """
    CASE WHEN regexp_matches(column_name, '^(title|name|product_?name|listing_?name)$', 'i') THEN 'title'
         WHEN regexp_matches(column_name, '^(price|cost|amount|sale_?price)$', 'i') THEN 'price'
         WHEN regexp_matches(column_name, '^(category|type|product_?type)$', 'i') THEN 'category'
         WHEN regexp_matches(column_name, '^(status|state|listing_?status)$', 'i') THEN 'status'
         WHEN regexp_matches(column_name, '^(description|desc|details|body)$', 'i') THEN 'description'
         WHEN is_key OR regexp_matches(column_name, '(Id|_id|At|_at)$') THEN NULL
         WHEN regexp_matches(column_name, 'make|brand|manufacturer', 'i') THEN 'make'
         WHEN regexp_matches(column_name, 'model', 'i') THEN 'model' END"""
MAPPED_SQL = f"{COLUMNS_SQL}, mapped AS (SELECT *, {FIELD_CASES} AS target FROM cols)"


@BOOK.add(f"SELECT table_name, column_name, filled, row_count FROM ({FILLED_SQL})")
def column_profile(tables):
    counts = profile.column_profile(tables.named(TABLES), distinct=False)
    return counts.select("table_name", "column_name", "filled", "row_count")


@BOOK.add(None)
def column_profile_distinct(tables):
    """With the estimated distinct counts, which no other engine need agree with."""
    return profile.column_profile(tables.named(TABLES))


SKETCHED = ("customer", "orders", "lineitem", "events", "documents")
DISTINCT_SQL = _union(
    "SELECT '{t}' AS table_name, a.column_name, (SELECT count(*) FROM {t}) AS row_count, a.n AS filled, b.d AS distinct_count FROM "
    "(UNPIVOT (SELECT count(COLUMNS(*)) FROM {t}) ON COLUMNS(*) INTO NAME column_name VALUE n) a JOIN "
    "(UNPIVOT (SELECT count(DISTINCT COLUMNS(*)) FROM {t}) ON COLUMNS(*) INTO NAME column_name VALUE d) b "
    "ON a.column_name = b.column_name",
    SKETCHED,
)


def _exact_distinct(name, df):
    """Distinct values of every column, by one count over all columns' hashes."""
    pairs = ", ".join(f"'{c}', CASE WHEN {c} IS NOT NULL THEN xxhash64({c}) END" for c in df.columns)
    values = df.selectExpr(f"stack({len(df.columns)}, {pairs}) AS (column_name, value)").distinct()
    counts = values.groupBy("column_name").agg(F.count("value").alias("distinct_count"))
    return counts.select(F.lit(name).alias("table_name"), "*")


@BOOK.add(f"SELECT *, true AS is_close FROM ({DISTINCT_SQL})")
def sketched_profile(tables):
    """Profiles merged from sketches of each file, with the exact distinct counts and whether the estimates are within 4% of them."""
    spark, found = tables.spark, []
    for name, df in tables.named(SKETCHED).items():
        source, folder = f"{tables.folder}/{name}.parquet", new_path(spark, f"sketches-{name}")
        sketches.refresh(spark, source, folder)
        exact = _exact_distinct(name, df)
        found.append(sketches.sketched_profile(spark, source, folder).join(exact, "column_name"))
    close = F.abs(F.col("approx_distinct") - F.col("distinct_count")) <= 0.04 * F.col("distinct_count")
    rows = reduce(lambda a, b: a.unionByName(b), found)
    return rows.select("table_name", "column_name", "row_count", "filled", "distinct_count", close.alias("is_close"))


@BOOK.add("""
    WITH numbers AS (
        SELECT unnest(['event_id', 'user_id', 'value']) AS column_name,
               unnest([CAST(event_id AS DOUBLE), CAST(user_id AS DOUBLE), value]) AS value FROM events)
    SELECT column_name, count(*) AS row_count, count(value) AS filled, true AS first_read_part, true AS second_read_rest,
           true AS is_median
    FROM numbers GROUP BY column_name""")
def sketches_refreshed(tables):
    """Medians of a table that grew between two refreshes, and whether the ranks they stand for hold within 2% in all its rows."""
    spark, events = tables.spark, tables.events
    source, folder = new_path(spark, "growing"), new_path(spark, "growing-sketches")
    early = F.coalesce(F.col("ts") < F.lit("2024-01-20").cast("timestamp"), F.lit(True))
    events.where(early).write.parquet(source)
    first = sketches.refresh(spark, source, folder)
    files = len(spark.read.parquet(source).inputFiles())
    events.where(~early).write.mode("append").parquet(source)
    second = sketches.refresh(spark, source, folder)
    rest = len(spark.read.parquet(source).inputFiles()) - files
    merged = sketches.sketched_profile(spark, source, folder).where("quantiles IS NOT NULL")
    values = events.selectExpr("stack(3, 'event_id', double(event_id), 'user_id', double(user_id), 'value', value) AS (column_name, v)")
    median = F.col("quantiles")[0]
    ranks = values.join(F.broadcast(merged), "column_name").groupBy("column_name", "row_count", "filled").agg(
        F.count_if(F.col("v") < median).alias("below"), F.count_if(F.col("v") <= median).alias("up_to"), F.count("v").alias("n")
    )
    holds = (F.col("below") <= 0.52 * F.col("n")) & (F.col("up_to") >= 0.48 * F.col("n"))
    return ranks.select(
        "column_name", "row_count", "filled", F.lit(first == files).alias("first_read_part"),
        F.lit(second == rest and rest > 0).alias("second_read_rest"), holds.alias("is_median"),
    )


@BOOK.add(
    "SELECT table_name, column_name, n = d AND n = r AS is_key FROM ("
    + _union(
        "SELECT '{t}' AS table_name, a.column_name, a.n, b.d, (SELECT count(*) FROM {t}) AS r FROM "
        "(UNPIVOT (SELECT count(COLUMNS(*)) FROM {t}) ON COLUMNS(*) INTO NAME column_name VALUE n) a JOIN "
        "(UNPIVOT (SELECT count(DISTINCT COLUMNS(*)) FROM {t}) ON COLUMNS(*) INTO NAME column_name VALUE d) b "
        "ON a.column_name = b.column_name"
    )
    + ")"
)
def candidate_keys(tables):
    keys = profile.candidate_keys(tables.named(TABLES))
    return keys.select("table_name", "column_name", "is_key")


@BOOK.add("""
    SELECT 'lineitem.l_orderkey -> orders.o_orderkey' AS fk, count(*) AS orphans
    FROM (SELECT DISTINCT l_orderkey FROM lineitem) ANTI JOIN orders ON l_orderkey = o_orderkey
    UNION ALL
    SELECT 'events.event_id -> orders.o_orderkey', count(*)
    FROM (SELECT DISTINCT event_id FROM events) ANTI JOIN orders ON event_id = o_orderkey""")
def inclusion_dependency(tables):
    pairs = [("lineitem", "l_orderkey"), ("events", "event_id")]
    found = profile.orphan_counts(
        tables.named(["lineitem", "events", "orders"]), pairs, "orders", "o_orderkey"
    )
    source = F.concat_ws(".", "from_table", "from_column")
    target = F.concat_ws(".", "to_table", "to_column")
    return found.select(F.concat_ws(" -> ", source, target).alias("fk"), "orphans")


def _values_sql(template: str) -> str:
    """A query over the texts of all values, by row and column, of each table."""
    return _union(template.replace("{values}", "(UNPIVOT (SELECT row_number() OVER () AS _r, CAST(COLUMNS(*) AS VARCHAR) FROM {t}) "
                                   "ON COLUMNS(* EXCLUDE _r) INTO NAME c VALUE v)"))  # fmt: skip


@BOOK.add(
    "SELECT table_name, x || ',' || y AS columns FROM ("
    + _values_sql("""
        SELECT '{t}' AS table_name, a.c AS x, b.c AS y FROM {values} a JOIN {values} b ON a._r = b._r AND a.c < b.c
        WHERE a.c IN (SELECT c FROM {values} GROUP BY c HAVING count(*) = (SELECT count(*) FROM {t}) AND count(DISTINCT v) < count(*))
          AND b.c IN (SELECT c FROM {values} GROUP BY c HAVING count(*) = (SELECT count(*) FROM {t}) AND count(DISTINCT v) < count(*))
        GROUP BY a.c, b.c HAVING count(DISTINCT (a.v, b.v)) = count(*)""")
    + ")"
)
def composite_keys(tables):
    """Every pair of columns that is a key while neither is one."""
    keys = dependencies.composite_keys(tables.named(TABLES), width=2)
    return keys.select("table_name", F.concat_ws(",", "columns").alias("columns"))


KIND_SQL = """CASE k WHEN 'INTEGER' THEN 'whole' WHEN 'BIGINT' THEN 'whole' ELSE k END"""


@BOOK.add(
    "WITH kinds AS ("
    + _union("SELECT '{t}' AS t, c, k FROM (UNPIVOT (SELECT any_value(typeof(COLUMNS(*))) FROM {t}) ON COLUMNS(*) INTO NAME c VALUE k)")
    + "), held AS ("
    + _values_sql("SELECT DISTINCT '{t}' AS t, c, v FROM {values}")
    + f"""), named AS (SELECT t, c, {KIND_SQL} AS k, v FROM held JOIN kinds USING (t, c) WHERE k NOT LIKE '%[]'),
    sizes AS (SELECT t, c, count(*) AS n FROM named GROUP BY t, c)
    SELECT a.t AS from_table, a.c AS from_column, b.t AS to_table, b.c AS to_column
    FROM named a JOIN named b ON a.k = b.k AND a.v = b.v AND (a.t, a.c) <> (b.t, b.c) JOIN sizes s ON s.t = a.t AND s.c = a.c
    GROUP BY a.t, a.c, b.t, b.c HAVING count(*) = max(s.n)"""
)
def inclusions(tables):
    """Columns all of whose values occur in another column, whatever their names."""
    return dependencies.inclusions(tables.named(TABLES))


def _reference_sql(child: str, column: str, parent: str, key: str) -> str:
    return f"""
        SELECT '{child}' AS from_table, '{column}' AS from_column, '{parent}' AS to_table,
               '{key}' AS to_column
        WHERE NOT EXISTS (SELECT 1 FROM {child} ANTI JOIN {parent} ON {child}.{column} = {parent}.{key}
                          WHERE {child}.{column} IS NOT NULL)
          AND (SELECT count({key}) = count(DISTINCT {key}) FROM {parent})"""


@BOOK.add(
    " UNION ALL ".join(
        _reference_sql(*each)
        for each in [
            ("lineitem", "l_orderkey", "orders", "o_orderkey"),
            ("lineitem", "l_partkey", "part", "p_partkey"),
            ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
            ("orders", "o_custkey", "customer", "c_custkey"),
            ("customer", "c_nationkey", "nation", "n_nationkey"),
            ("supplier", "s_nationkey", "nation", "n_nationkey"),
            ("nation", "n_regionkey", "region", "r_regionkey"),
            ("labels", "doc_id", "documents", "doc_id"),
            ("documents", "doc_id", "labels", "doc_id"),
        ]
    )
)
def foreign_keys(tables):
    return profile.inspect(tables.named(TABLES)).foreign_keys


@BOOK.add(_union("SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"))
def table_sizes(tables):
    return metadata.by_size(metadata.row_counts(tables.named(TABLES)))


@BOOK.add("SELECT 'lineitem' AS table_name, count(*) AS row_count FROM lineitem")
def estimated_rows(tables):
    return metadata.estimated_rows(tables.spark, "lineitem", tables.lineitem)


@BOOK.add("SELECT 'lineitem' AS table_name, count(*) AS row_count, true AS inside, true AS near FROM lineitem")
def sampled_rows(tables):
    """The true count of a table in files of uneven size, and whether the estimate from some of them states it in its interval."""
    folder = new_path(tables.spark, "many-files")
    lines = tables.lineitem.select("l_orderkey", "l_shipdate", "l_extendedprice")
    uneven = F.floor(F.sqrt(F.pmod(F.xxhash64("l_orderkey"), F.lit(48 * 48)))).cast("int")
    lines.repartitionByRange(48, uneven).write.parquet(folder)
    found = metadata.sampled_rows(tables.spark, "lineitem", folder, files=12)
    counted = metadata.row_counts({"lineitem": tables.spark.read.parquet(folder)})
    both = found.withColumnRenamed("row_count", "estimate").unionByName(counted, allowMissingColumns=True)
    both = both.groupBy("table_name").agg(*(F.max(c).alias(c) for c in ("row_count", "estimate", "low", "high")))
    return both.select(
        "table_name", "row_count", F.col("row_count").between(F.col("low"), F.col("high")).alias("inside"),
        (F.abs(F.col("estimate") / F.col("row_count") - 1) < 0.2).alias("near"),
    )


@BOOK.add(f"""
    WITH {MAPPED_SQL}
    SELECT table_name, column_name, target,
           CASE WHEN target IN ('make', 'model') THEN 'attribute' ELSE 'field' END AS mapping_type,
           CASE WHEN target IN ('make', 'model') THEN 'medium' ELSE 'high' END AS confidence,
           filled, row_count
    FROM mapped WHERE target IS NOT NULL""")
def field_mappings(tables):
    found = matching.field_mappings(_columns(tables))
    return found.select(
        "table_name", "column_name", "target", "mapping_type", "confidence", "filled", "row_count"
    )


@BOOK.add(f"""
    WITH {COLUMNS_SQL}
    SELECT table_name, arg_min(column_name, ordinal) FILTER (is_key) AS id_column,
           CAST(NULL AS VARCHAR) AS updated_at_column, max(row_count) AS row_count
    FROM cols GROUP BY table_name""")
def role_columns(tables):
    columns = _columns(tables)
    sizes = columns.groupBy("table_name").agg(F.max("row_count").alias("row_count"))
    roles = matching.role_columns(columns).join(sizes, "table_name")
    return roles.select("table_name", "id_column", "updated_at_column", "row_count")


@BOOK.add(f"""
    WITH {COLUMNS_SQL}
    SELECT table_name, column_name, 'high' AS confidence, filled FROM cols
    -- Fixed values: names worth searching.
    WHERE is_text AND NOT is_key AND (regexp_matches(column_name, 'make|model|brand|manufacturer', 'i')
       OR regexp_matches(column_name, '^(title|name|product_?name|listing_?name|description|desc|details|body)$', 'i'))""")
def searchable_columns(tables):
    found = matching.searchable_columns(_columns(tables))
    return found.select("table_name", "column_name", "confidence", "filled")


@BOOK.add(f"""
    WITH {MAPPED_SQL},
    named AS (SELECT *, CASE WHEN column_name IN ('retailprice', 'size', 'lang') THEN column_name
                             ELSE target END AS name FROM mapped)
    SELECT table_name, column_name, name AS filter_name,
           CASE WHEN is_number THEN 'number' ELSE 'string' END AS filter_type,
           'medium' AS confidence, filled
    FROM named
    WHERE name IS NOT NULL AND NOT is_key AND NOT regexp_matches(column_name, '(Id|_id|At|_at)$')
      AND (is_number OR (is_text AND lower(name) NOT IN ('title', 'description', 'desc', 'details', 'body')))
    """)
def filterable_columns(tables):
    """Filters over mapped columns and over three that were chosen as attributes."""
    columns = _columns(tables)
    chosen = columns.where(F.col("column_name").isin("retailprice", "size", "lang"))
    found = matching.filterable_columns(columns, chosen)
    return found.select(
        "table_name", "column_name", "filter_name", "filter_type", "confidence", "filled"
    )


REFERENCES_SQL = ", ".join(str(each) for each in FOREIGN_KEYS)


@BOOK.add(f"""
    WITH {COLUMNS_SQL},
    refs(from_table, from_column, to_table, to_column) AS (VALUES {REFERENCES_SQL}),
    found AS (
        SELECT to_table AS table_name, from_table AS child_table, from_column AS foreign_key,
               bool_or(regexp_matches(column_name, 'url$|^image|^photo|^picture|^thumbnail|^src$', 'i')) AS pictured,
               count(*) AS width, max(row_count) AS child_rows
        FROM refs JOIN cols ON table_name = from_table GROUP BY ALL)
    SELECT table_name, child_table, foreign_key, child_rows,
           CASE WHEN pictured THEN 'images' WHEN width <= 5 THEN 'features' ELSE 'generic' END AS relation_type,
           CASE WHEN pictured THEN 'high' WHEN width <= 5 THEN 'medium' ELSE 'low' END AS confidence
    FROM found""")
def relation_suggestions(tables):
    columns = _columns(tables)
    sizes = columns.groupBy(F.col("table_name").alias("child_table")).agg(
        F.max("row_count").alias("child_rows")
    )
    found = matching.relation_suggestions(columns, _declared_references(tables))
    return found.join(sizes, "child_table")


@BOOK.add(f"""
    WITH {MAPPED_SQL}
    SELECT table_name, column_name, filled FROM mapped
    WHERE target IS NULL AND NOT is_key AND NOT regexp_matches(column_name, '(Id|_id|At|_at)$')""")
def unmapped_columns(tables):
    return matching.unmapped_columns(_columns(tables)).select("table_name", "column_name", "filled")


@BOOK.add(f"WITH {COLUMNS_SQL} SELECT table_name, column_name, filled FROM cols WHERE is_text AND NOT is_key")
def text_candidates(tables):
    return matching.text_candidates(_columns(tables)).select("table_name", "column_name", "filled")


@BOOK.add(f"""
    WITH {MAPPED_SQL}
    SELECT table_name, coalesce(arg_min(column_name, ordinal) FILTER (is_key), 'id') AS id_column,
           arg_max(column_name, ordinal) FILTER (target = 'title') AS title_column,
           arg_max(column_name, ordinal) FILTER (target = 'make') AS make_column,
           CASE WHEN table_name = 'documents' THEN 'images|labels'
                WHEN table_name IN ('customer', 'nation') THEN
                    CASE table_name WHEN 'customer' THEN '' ELSE 'customer|supplier' END
                WHEN table_name = 'region' THEN 'nation'
                ELSE '' END AS relations,
           max(row_count) AS row_count
    FROM mapped GROUP BY table_name""")
def resource_specs(tables):
    columns = _columns(tables)
    specs = matching.resource_specs(columns, _declared_references(tables))
    sizes = columns.groupBy("table_name").agg(F.max("row_count").alias("row_count"))

    def value(path: str):
        return F.get_json_object("spec", path)

    relations = F.from_json(value("$.relations"), "map<string,struct<table:string>>")
    names = F.array_join(F.array_sort(F.map_keys(relations)), "|")
    return specs.join(sizes, "table_name").select(
        "table_name",
        value("$.idColumn").alias("id_column"),
        value("$.fields.title").alias("title_column"),
        value("$.attributes.make").alias("make_column"),
        F.coalesce(names, F.lit("")).alias("relations"),
        "row_count",
    )


@BOOK.add("""
    SELECT CAST(doc_id AS VARCHAR) AS external_id, coalesce(url, '') AS images,
           (SELECT count(*) FROM labels l WHERE l.doc_id = d.doc_id) AS n_labels
    FROM documents d LEFT JOIN pages ON page_id = doc_id""")
def matched_catalog_items(tables):
    """Items by the spec that matching assembled for a table, keys found from the data."""
    names = ["documents", "labels", "pages"]
    frames = tables.named(names)
    found = profile.inspect(frames)
    pages = ("pages", "page_id", "documents", "doc_id")
    declared = tables.spark.createDataFrame([pages], found.foreign_keys.schema)
    specs = matching.resource_specs(found.columns, found.foreign_keys.unionAll(declared))
    spec = ResourceSpec.from_json(specs.where("table_name = 'documents'").first()["spec"])
    # The URL is kept as the image; the page's own key is both its key and its reference.
    items = Catalog(spec, frames["documents"], frames).items()
    return items.select(
        F.col("externalId").alias("external_id"),
        F.array_join("images", "|").alias("images"),
        F.size("attributes.labels").cast("bigint").alias("n_labels"),
    )


def _renamed(tables):
    """Given tables under names that the rules know: every role, filter and kind of relation occurs."""
    orders, lines, parts = tables.orders, tables.lineitem, tables.part
    return {
        "Listings": orders.selectExpr(
            "o_orderkey AS id", "o_custkey AS ownerId", "o_orderpriority AS Title", "concat('d', o_custkey) AS description",
            "o_totalprice AS price", "'EUR' AS currency_code", "o_orderstatus AS listingStatus", "o_custkey % 3 <> 0 AS is_active",
            "CASE WHEN o_custkey % 5 = 0 THEN o_orderdate END AS deletedAt", "o_orderdate AS updated_at",
            "CAST(year(o_orderdate) AS int) AS production_year", "concat('c', o_custkey % 4) AS Colour",
        ),
        "photos": lines.selectExpr("concat(l_orderkey, '-', l_linenumber) AS id", "l_orderkey AS listing_id", "concat('/p/', l_partkey) AS imageUrl", "l_shipdate AS taken_at"),
        "features": lines.selectExpr("l_orderkey AS listing_id", "l_returnflag AS featureLabel", "l_quantity AS Amount"),
        "visits": lines.selectExpr("l_orderkey AS listing_id", "l_partkey AS a", "l_suppkey AS b", "l_tax AS c", "l_discount AS d", "l_shipdate AS e"),
        "cars": parts.selectExpr(
            "p_partkey AS carKey", "p_name AS model", "p_brand AS manufacturer", "p_type AS fuel_kind", "p_size AS horsepower",
            "p_retailprice AS cost", "p_size AS km", "current_date() AS lastUpdated", "true AS Visible",
        ),
    }


RENAMED_KEYS = [("Listings", "id"), ("photos", "id"), ("cars", "carKey")]
RENAMED_REFERENCES = [(child, "listing_id", "Listings", "id") for child in ("photos", "features", "visits")]


def _renamed_specs(tables):
    frames = _renamed(tables)
    columns = metadata.table_columns(frames, frozenset(RENAMED_KEYS))
    kind = "from_table string, from_column string, to_table string, to_column string"
    return frames, matching.resource_specs(columns, tables.spark.createDataFrame(RENAMED_REFERENCES, kind))


# What the rules give for the renamed tables, spec by spec.
RENAMED_SPECS = {
    "Listings": (
        "orders",
        '{"table":"Listings","baseFilter":"is_active = true AND \\"deletedAt\\" IS NULL","idColumn":"id","updatedAtColumn":"updated_at",'
        '"fields":{"externalId":"id","title":"\\"Title\\"","price":"price","currency":"currency_code","status":"\\"listingStatus\\"",'
        '"description":"description"},"attributes":{"year":"production_year","color":"\\"Colour\\""},'
        '"searchableColumns":["\\"Title\\"","description"],"filterableColumns":{"minPrice":{"column":"price","type":"gte"},'
        '"maxPrice":{"column":"price","type":"lte"},"currency":{"column":"currency_code","type":"string"},'
        '"status":{"column":"\\"listingStatus\\"","type":"string"},"year":{"column":"production_year","type":"number"},'
        '"color":{"column":"\\"Colour\\"","type":"string"}},"relations":{"features":{"table":"features","foreignKey":"listing_id",'
        '"referenceKey":"id","fields":{"featureLabel":"\\"featureLabel\\"","Amount":"\\"Amount\\""},"flatten":"featureLabel"},'
        '"images":{"table":"photos","foreignKey":"listing_id","referenceKey":"id","fields":{"imageUrl":"\\"imageUrl\\"",'
        '"taken_at":"taken_at"},"imageUrlField":"imageUrl"}}}',
    ),
    "cars": (
        "part",
        '{"table":"cars","baseFilter":"\\"Visible\\" = true","idColumn":"carKey","updatedAtColumn":"lastUpdated",'
        '"fields":{"externalId":"carKey","price":"cost"},"attributes":{"make":"manufacturer","model":"model","mileage":"km",'
        '"fuelType":"fuel_kind","enginePower":"horsepower"},"searchableColumns":["model","manufacturer"],'
        '"filterableColumns":{"model":{"column":"model","type":"string"},"make":{"column":"manufacturer","type":"string"},'
        '"fuelType":{"column":"fuel_kind","type":"string"},"enginePower":{"column":"horsepower","type":"number"},'
        '"minPrice":{"column":"cost","type":"gte"},"maxPrice":{"column":"cost","type":"lte"},"mileage":{"column":"km","type":"number"}}}',
    ),
    "features": (
        "lineitem",
        '{"table":"features","idColumn":"id","fields":{"externalId":"id","price":"\\"Amount\\""},'
        '"filterableColumns":{"minPrice":{"column":"\\"Amount\\"","type":"gte"},"maxPrice":{"column":"\\"Amount\\"","type":"lte"}}}',
    ),
    "photos": ("lineitem", '{"table":"photos","idColumn":"id","fields":{"externalId":"id"}}'),
    "visits": ("lineitem", '{"table":"visits","idColumn":"id","fields":{"externalId":"id"}}'),
}


@BOOK.add(
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{spec}' AS spec, count(*) AS row_count FROM {table}"
        for name, (table, spec) in RENAMED_SPECS.items()
    )
)
def renamed_specs(tables):
    """Whole specs of tables in which every rule fires, with the rows that each would show the catalog."""
    frames, specs = _renamed_specs(tables)
    return specs.join(metadata.row_counts(frames), "table_name")


@BOOK.add("""
    SELECT CAST(o_orderkey AS VARCHAR) AS external_id, o_orderpriority AS title, o_totalprice AS price, 'EUR' AS currency,
           o_orderstatus AS status, CAST(year(o_orderdate) AS INT) AS production_year, 'c' || (o_custkey % 4) AS color,
           (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS n_images,
           (SELECT coalesce(string_agg(l_returnflag, '|' ORDER BY l_returnflag), '') FROM lineitem WHERE l_orderkey = o_orderkey) AS features
    FROM orders WHERE o_custkey % 3 <> 0 AND o_custkey % 5 <> 0""")
def renamed_items_exported(tables):
    """Items by a spec that was written, read back and used, written out as item records and read again."""
    spark = tables.spark
    frames, specs = _renamed_specs(tables)
    written, out = new_path(spark, "specs"), new_path(spark, "items")
    matching.write_specs(specs, written)
    texts = spark.read.text(written).where(F.get_json_object("value", "$.table") == "Listings")
    spec = ResourceSpec.from_json(texts.first()["value"])
    Catalog(spec, frames["Listings"], frames).export(out, "json")
    kind = (
        "externalId string, title string, price double, currency string, status string, images array<string>, "
        "attributes struct<year:int,color:string,features:array<string>>"
    )
    item = spark.read.text(out).select(F.from_json("value", kind).alias("i"))
    return item.select(
        F.col("i.externalId").alias("external_id"), "i.title", "i.price", "i.currency", "i.status",
        F.col("i.attributes.year").alias("production_year"), "i.attributes.color",
        F.size("i.images").cast("long").alias("n_images"), F.array_join("i.attributes.features", "|").alias("features"),
    )
