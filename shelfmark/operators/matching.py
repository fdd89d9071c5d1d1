"""From column metadata to resource specs, for every table of a catalog at once.

All functions take the ``columns`` frame (``sources.metadata.COLUMNS_SCHEMA``); columns
beyond those, such as observed counts, are passed through. A table's columns are grouped
here, which a schema bounds, never its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import names
from shelfmark.sources.metadata import COLUMNS_SCHEMA

_BASE = [part.split()[0] for part in COLUMNS_SCHEMA.split(", ")]


def _name() -> Column:
    return F.col("column_name")


def _type() -> Column:
    return F.col("data_type")


def _key() -> Column:
    return F.col("is_primary_key")


def _observed(columns: DataFrame) -> list[str]:
    return [c for c in columns.columns if c not in _BASE]


def field_mappings(columns: DataFrame) -> DataFrame:
    """The field or attribute each column means; columns that mean none are left out.

    Several columns may have one target. ``rule`` and ``ordinal`` give the order of the
    suggestions, in which the last column of a target is the one a spec takes.
    """
    mapped = columns.withColumn("mapping", names.mapping(_name(), _key()))
    return mapped.where("mapping IS NOT NULL").select(
        "table_name",
        "ordinal",
        "column_name",
        "mapping.target",
        F.col("mapping.kind").alias("mapping_type"),
        "mapping.confidence",
        "mapping.rule",
        *_observed(columns),
    )


def role_columns(columns: DataFrame) -> DataFrame:
    """Each table's id, updated-at, published and soft-delete column; null where it has
    none. The first column in the table's order is taken."""

    def first(test: Column) -> Column:
        return F.min(F.when(test, F.struct("ordinal", "column_name")))["column_name"]

    return columns.groupBy("table_name").agg(
        F.coalesce(first(_key()), first(_name() == "id")).alias("id_column"),
        first(names.matches(_name(), names.UPDATED_AT)).alias("updated_at_column"),
        first(names.matches(_name(), names.PUBLISHED)).alias("published_column"),
        first(names.matches(_name(), names.SOFT_DELETED)).alias("soft_delete_column"),
    )


def searchable_columns(columns: DataFrame) -> DataFrame:
    """Text columns, keys apart, with a name worth searching."""
    named = names.matches(_name(), names.SEARCHABLE)
    found = columns.where(~_key() & names.is_text(_type()) & named)
    return found.select(
        "table_name", "ordinal", "column_name", F.lit("high").alias("confidence"),
        *_observed(columns),
    )


def filterable_columns(columns: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """Filters over mapped columns: a range for a numeric price, a number for other
    numbers, equality for text that is not free text.

    ``extra`` (``table_name, column_name``) adds columns as attributes of their own name.
    """
    mapped = columns.withColumn("name", names.mapping(_name(), _key())["target"])
    if extra is not None:
        chosen = extra.select("table_name", "column_name", F.lit(True).alias("_extra")).distinct()
        mapped = mapped.join(chosen, ["table_name", "column_name"], "left")
        own_name = F.when(F.col("_extra"), _name()).otherwise(F.col("name"))
        mapped = mapped.withColumn("name", own_name)
    usable = mapped.where(~_key() & ~names.is_plumbing(_name()) & F.col("name").isNotNull())

    def filters(*each: tuple[Column, str, str]) -> Column:
        return F.array(
            *(
                F.struct(
                    F.lit(number).alias("place"),
                    name.alias("filter_name"),
                    F.lit(kind).alias("filter_type"),
                    F.lit(confidence).alias("confidence"),
                )
                for number, (name, kind, confidence) in enumerate(each)
            )
        )

    number, name = names.is_numeric(_type()), F.col("name")
    text = names.is_text(_type()) & ~F.lower(name).isin(names.FREE_TEXT)
    price = filters((F.lit("minPrice"), "gte", "high"), (F.lit("maxPrice"), "lte", "high"))
    suggested = (
        F.when(number & (name == "price"), price)
        .when(number, filters((name, "number", "medium")))
        .when(text, filters((name, "string", "medium")))
    )
    return usable.withColumn("filter", F.explode(suggested)).select(
        "table_name", "ordinal", "column_name", "filter.*", *_observed(columns)
    )


def relation_suggestions(columns: DataFrame, foreign_keys: DataFrame) -> DataFrame:
    """Child tables of every table, by the foreign keys that point at it: images if a
    column looks like one, features if the child has few columns, else generic."""
    joined = foreign_keys.join(columns, F.col("from_table") == F.col("table_name"))
    grouped = joined.groupBy("to_table", "from_table", "from_column").agg(
        F.bool_or(names.matches(_name(), names.IMAGE)).alias("pictured"),
        F.count_distinct("column_name").alias("width"),
    )
    pictured, few = F.col("pictured"), F.col("width") <= 5
    kind = F.when(pictured, "images").when(few, "features").otherwise("generic")
    sure = F.when(pictured, "high").when(few, "medium").otherwise("low")
    return grouped.select(
        F.col("to_table").alias("table_name"),
        F.col("from_table").alias("child_table"),
        F.col("from_column").alias("foreign_key"),
        kind.alias("relation_type"),
        sure.alias("confidence"),
    )


def unmapped_columns(columns: DataFrame) -> DataFrame:
    """Columns left for a choice by hand: no mapping, no role, no reference, no time."""
    left = columns.join(
        field_mappings(columns).select("table_name", "column_name"),
        ["table_name", "column_name"],
        "left_anti",
    )
    roles = role_columns(columns).select("table_name", "id_column", "updated_at_column")
    taken = (_name() == F.coalesce("id_column", F.lit("id"))) | (
        _name() == F.coalesce("updated_at_column", F.lit(""))
    )
    left = left.join(roles, "table_name").where(~taken & ~names.is_plumbing(_name()))
    return left.select("table_name", "ordinal", "column_name", *_observed(columns))


def text_candidates(columns: DataFrame) -> DataFrame:
    """Text columns, keys apart, that could be searched."""
    found = columns.where(names.is_long_text(_type()) & ~_key())
    return found.select("table_name", "ordinal", "column_name", *_observed(columns))


def resource_specs(columns: DataFrame, foreign_keys: DataFrame) -> DataFrame:
    """One row per table: its name and the spec assembled for it, as JSON.

    Every suggestion is taken but relations of low confidence. Where several columns or
    relations have one target, the last wins.
    """
    columns = columns.select(*_BASE)
    roles = role_columns(columns).withColumn("id_column", F.coalesce("id_column", F.lit("id")))
    rules = field_mappings(columns).groupBy("table_name", "mapping_type", "target", "rule")
    rules = rules.agg(F.max_by(names.quoted(_name()), "ordinal").alias("column"))

    def mapped(kind: str) -> Column:
        of_kind = F.when(F.col("mapping_type") == kind, F.struct("rule", "target", "column"))
        return _as_map(F.collect_list(of_kind), "target", "column")

    fields = rules.groupBy("table_name").agg(
        mapped("field").alias("fields"), mapped("attribute").alias("attributes")
    )
    searchable = searchable_columns(columns).join(
        text_candidates(columns).select("table_name", "column_name"),
        ["table_name", "column_name"],
        "left_semi",
    )
    searchable = searchable.groupBy("table_name").agg(
        F.sort_array(F.collect_list(F.struct("ordinal", names.quoted(_name()).alias("c"))))["c"]
        .alias("searchable")
    )
    filters = (
        filterable_columns(columns)
        .groupBy("table_name", "filter_name")
        .agg(
            F.min(F.struct("ordinal", "place")).alias("place"),
            F.max_by(
                F.struct(names.quoted(_name()).alias("column"), F.col("filter_type").alias("type")),
                F.struct("ordinal", "place"),
            ).alias("filter"),
        )
        .groupBy("table_name")
        .agg(
            _as_map(
                F.collect_list(F.struct("place", "filter_name", "filter")), "filter_name", "filter"
            ).alias("filters")
        )
    )
    assembled = roles
    for part in (fields, searchable, filters, _relations(columns, foreign_keys, roles)):
        assembled = assembled.join(part, "table_name", "left")
    base_filter = F.concat_ws(
        " AND ",
        F.concat(names.quoted(F.col("published_column")), F.lit(" = true")),
        F.concat(names.quoted(F.col("soft_delete_column")), F.lit(" IS NULL")),
    )
    external = F.create_map(F.lit("externalId"), F.col("id_column"))
    spec = F.struct(
        F.col("table_name").alias("table"),
        F.nullif(base_filter, F.lit("")).alias("baseFilter"),
        F.col("id_column").alias("idColumn"),
        F.col("updated_at_column").alias("updatedAtColumn"),
        F.coalesce(F.map_concat(external, F.col("fields")), external).alias("fields"),
        _unless_empty("attributes").alias("attributes"),
        F.col("searchable").alias("searchableColumns"),
        F.col("filters").alias("filterableColumns"),
        F.col("relations").alias("relations"),
    )
    return assembled.select("table_name", F.to_json(spec).alias("spec"))


def _as_map(entries: Column, key: str, value: str) -> Column:
    """Collected structs, in their order, as a map."""
    return F.map_from_entries(
        F.transform(F.sort_array(entries), lambda e: F.struct(e[key], e[value]))
    )


def _unless_empty(column: str) -> Column:
    return F.when(F.cardinality(F.col(column)) > 0, F.col(column))


def _relations(columns: DataFrame, foreign_keys: DataFrame, roles: DataFrame) -> DataFrame:
    """Each table's relations as a map, named ``images`` or by the child table."""
    suggested = relation_suggestions(columns, foreign_keys).where("confidence <> 'low'")
    child = columns.withColumnRenamed("table_name", "child_table")
    kept = (_name() != F.col("foreign_key")) & ~_key()

    def first(pattern: str, kind: str) -> Column:
        fits = (F.col("relation_type") == kind) & names.matches(_name(), pattern)
        return F.min(F.when(fits, F.struct("ordinal", "column_name")))["column_name"]

    field = F.struct("ordinal", "column_name", names.quoted(_name()).alias("quoted"))
    described = (
        suggested.join(child, "child_table")
        .groupBy("table_name", "child_table", "foreign_key", "relation_type")
        .agg(
            _as_map(F.collect_list(F.when(kept, field)), "column_name", "quoted").alias("fields"),
            first(names.URL, "images").alias("imageUrlField"),
            first(names.LABEL, "features").alias("flatten"),
        )
        .join(roles.select("table_name", "id_column"), "table_name")
    )
    pictured = F.col("relation_type") == "images"
    relation = F.struct(
        F.col("child_table").alias("table"),
        names.quoted(F.col("foreign_key")).alias("foreignKey"),
        F.col("id_column").alias("referenceKey"),
        "fields",
        "imageUrlField",
        "flatten",
    )
    order = F.struct("child_table", "foreign_key")
    named = described.groupBy(
        "table_name",
        F.when(pictured, F.lit("images")).otherwise(F.col("child_table")).alias("name"),
    ).agg(F.min(order).alias("place"), F.max_by(relation, order).alias("relation"))
    entries = F.array_sort(F.collect_list(F.struct("place", "name", "relation")), _by_place)
    pairs = F.transform(entries, lambda e: F.struct(e["name"], e["relation"]))
    return named.groupBy("table_name").agg(F.map_from_entries(pairs).alias("relations"))


def _by_place(left: Column, right: Column) -> Column:
    """Order of collected relations, which hold maps and so have no order of their own."""
    before, after = left["place"] < right["place"], left["place"] > right["place"]
    return F.when(before, -1).when(after, 1).otherwise(0)


def write_specs(specs: DataFrame, folder: str) -> None:
    """Write the assembled specs, one JSON record per table and line."""
    specs.select(F.col("spec").alias("value")).write.text(folder)
