"""What the data says about columns: counts, candidate keys and references."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.columns import INTEGRAL, TEXT, backtick, sql_string
from shelfmark.operators.relations import BROADCAST_ROWS
from shelfmark.session import store
from shelfmark.sources.metadata import Metadata, row_counts, table_columns

# One value in so many, by hash, is looked at before a column is counted whole. All copies of a
# value are among them or none, so one repeat there proves that the column is no key.
RESIDUE = 1024
_PLACE = "table_name string, ordinal int, column_name string"


def column_profile(tables: Mapping[str, DataFrame], distinct: bool = True) -> DataFrame:
    """Rows, non-null and (estimated) distinct values of every column, one pass a table.

    Every aggregate keeps a fixed-size state per task, so a pass shuffles one row a task.
    """
    return reduce(
        DataFrame.unionAll, [_table_profile(name, df, distinct) for name, df in tables.items()]
    )


def _table_profile(name: str, df: DataFrame, distinct: bool) -> DataFrame:
    counts, rows = ["count(1) AS row_count"], []
    for place, f in enumerate(df.schema, start=1):
        counts.append(f"count({backtick(f.name)}) AS filled_{place}")
        estimated = distinct and not isinstance(f.dataType, (T.MapType, T.VariantType))
        estimate = f"approx_count_distinct({backtick(f.name)})" if estimated else "null"
        counts.append(f"CAST({estimate} AS bigint) AS distinct_{place}")
        described = f"{place}, {sql_string(f.name)}, {sql_string(f.dataType.simpleString())}"
        rows.append(f"{described}, filled_{place}, distinct_{place}")
    unpivoted = f"stack({len(rows)}, {', '.join(rows)})"
    return df.selectExpr(*counts).selectExpr(
        f"{sql_string(name)} AS table_name",
        f"{unpivoted} AS (ordinal, column_name, data_type, filled, approx_distinct)",
        "row_count",
    )


def profiled_columns(
    tables: Mapping[str, DataFrame], key_columns=frozenset(), distinct: bool = True
) -> DataFrame:
    """Column metadata together with the profile's counts, stored: matching reads it many
    times, the tables are read once."""
    counts = column_profile(tables, distinct).drop("column_name", "data_type")
    columns = table_columns(tables, key_columns).join(counts, ["table_name", "ordinal"])
    return store(columns.coalesce(1), "columns")


def candidate_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """For every column, whether it has no nulls and no value twice.

    Three passes that shuffle next to nothing disprove most columns: by a null, by a repeat of the value with
    the greatest hash, which finds columns with few values, and by a repeat in a hash residue of what is left by
    then. No estimate decides: what is left after them is counted exactly, each with a shuffle of
    that one column or, for long values, of its hash.
    """
    spark = next(iter(tables.values())).sparkSession
    filled = reduce(DataFrame.unionAll, [_filled(name, df) for name, df in tables.items()]).collect()
    greatest = {(r["table_name"], r["ordinal"]): r["greatest"] for r in filled if r["filled"] == r["row_count"]}
    for step in (_greatest_repeats, _residue_repeats):
        tried = [found for name, df in tables.items() if (found := step(name, df, greatest)) is not None]
        for row in reduce(DataFrame.unionAll, tried).collect() if tried else []:
            del greatest[row["table_name"], row["ordinal"]]
    known, exact, texts = [], [], []
    for name, df in tables.items():
        for ordinal, f in enumerate(df.schema, start=1):
            place = (name, ordinal, f.name)
            if (name, ordinal) not in greatest:
                known.append((*place, False))
                continue
            values = df.select(_comparable(f).alias("value"))
            long = (*TEXT, T.BinaryType, T.ArrayType, T.StructType, T.MapType, T.VariantType)
            if isinstance(f.dataType, long):
                texts.append((place, values))
            else:
                exact.append(_exact_key(values, place))

    repeated = {}
    if texts:
        hashes = [_repeated_hashes(v).withColumn("number", F.lit(i)) for i, (_, v) in enumerate(texts)]
        hashes = store(reduce(DataFrame.unionAll, hashes), "repeated-hashes")
        repeated = dict(hashes.groupBy("number").count().collect())
    for number, (place, values) in enumerate(texts):
        if number not in repeated:
            known.append((*place, True))
            continue
        own = hashes.where(F.col("number") == number).select("_hash")
        if repeated[number] <= BROADCAST_ROWS:
            own = F.broadcast(own)
        hashed = values.withColumn("_hash", F.xxhash64("value"))
        exact.append(_exact_key(hashed.join(own, "_hash", "left_semi").drop("_hash"), place))
    return reduce(DataFrame.unionAll, [*exact, spark.createDataFrame(known, f"{_PLACE}, is_key boolean")])


def _comparable_sql(field: T.StructField) -> str:
    """A column's values, or their JSON where they can't be compared."""
    value = backtick(field.name)
    if isinstance(field.dataType, T.MapType):
        value = f"array_sort(transform(map_entries({value}), entry -> to_json(entry)))"
    held = field.dataType.simpleString()
    return f"to_json(struct({value} AS value))" if "map<" in held or "variant" in held else value


def _comparable(field: T.StructField) -> Column:
    return F.expr(_comparable_sql(field))


def _filled(name: str, df: DataFrame) -> DataFrame:
    """Rows, filled rows and the greatest hash of every column."""
    counts, rows = ["count(1) AS row_count"], []
    for ordinal, f in enumerate(df.schema, start=1):
        counts.append(f"count({backtick(f.name)}) AS filled_{ordinal}")
        counts.append(f"max(xxhash64({_comparable_sql(f)})) AS greatest_{ordinal}")
        rows.append(f"{ordinal}, filled_{ordinal}, greatest_{ordinal}")
    unpivoted = f"stack({len(rows)}, {', '.join(rows)}) AS (ordinal, filled, greatest)"
    return df.selectExpr(*counts).selectExpr(f"{sql_string(name)} AS table_name", unpivoted, "row_count")


def _open(name: str, df: DataFrame, greatest: Mapping[tuple[str, int], int]) -> list[tuple[int, str, int | None]]:
    """Place, values and greatest hash of the columns that may still be keys; none of an empty table is tried."""
    return [
        (ordinal, _comparable_sql(f), greatest[name, ordinal])
        for ordinal, f in enumerate(df.schema, start=1)
        if greatest.get((name, ordinal)) is not None
    ]


def _greatest_repeats(name: str, df: DataFrame, greatest: Mapping[tuple[str, int], int]) -> DataFrame | None:
    """Columns with two values of the greatest hash; two hashes, of 128 bits together, name a value. Aggregates without groups."""
    counts, rows = [], []
    for ordinal, value, most in _open(name, df, greatest):
        second = f"CASE WHEN xxhash64({value}) = CAST('{most}' AS BIGINT) THEN xxhash64(1, {value}) END"
        counts += [f"count({second}) AS rows_{ordinal}", f"min({second}) = max({second}) AS one_{ordinal}"]
        rows.append(f"{ordinal}, rows_{ordinal}, one_{ordinal}")
    if not rows:
        return None
    unpivoted = f"stack({len(rows)}, {', '.join(rows)}) AS (ordinal, held, one)"
    return df.selectExpr(*counts).selectExpr(f"{sql_string(name)} AS table_name", unpivoted).where("held > 1 AND one").select("table_name", "ordinal")


def _residue_repeats(name: str, df: DataFrame, greatest: Mapping[tuple[str, int], int]) -> DataFrame | None:
    """Columns that hold a value twice among those looked at. Two hashes, of 128 bits together, name a value."""
    looked = [
        f"CASE WHEN pmod(xxhash64({value}), {RESIDUE}) = 0 THEN struct({ordinal} AS ordinal, xxhash64({value}) AS a, xxhash64(1, {value}) AS b) END"
        for ordinal, value, _ in _open(name, df, greatest)
    ]
    if not looked:
        return None
    found = df.selectExpr(f"explode(array_compact(array({', '.join(looked)}))) AS each")
    twice = found.groupBy("each.ordinal", "each.a", "each.b").count().where("count > 1")
    return twice.select(F.lit(name).alias("table_name"), "ordinal").distinct()


def _repeated_hashes(values: DataFrame) -> DataFrame:
    """Hashes that occur twice: those of all values that repeat, and nothing of a key but
    rare collisions. Long values need comparing only where eight bytes do not tell."""
    hashed = values.select(F.xxhash64("value").alias("_hash"))
    return hashed.groupBy("_hash").count().where("count > 1").select("_hash")


def _exact_key(values: DataFrame, place: tuple[str, int, str]) -> DataFrame:
    table, ordinal, column = place
    return values.groupBy("value").count().selectExpr(
        f"{sql_string(table)} AS table_name",
        f"{ordinal} AS ordinal",
        f"{sql_string(column)} AS column_name",
        "coalesce(max(count), 1) = 1 AS is_key",
    )


def primary_keys(candidates: DataFrame) -> DataFrame:
    """Each table's first candidate key."""
    first = F.min(F.struct("ordinal", "column_name")).alias("first")
    grouped = candidates.where("is_key").groupBy("table_name").agg(first)
    return grouped.select("table_name", "first.column_name")


def foreign_keys(tables: Mapping[str, DataFrame], keys: Mapping[str, str]) -> DataFrame:
    """References found in the data: every value of the column is a key of the other table.

    ``keys`` holds each table's key column. Only columns that are named like a key and
    have its type are tested. All columns that may refer to one key are tested together:
    their distinct values, tagged, meet the key's values in one join.
    """
    named = defaultdict(list)
    for to_table, key in keys.items():
        for name in _reference_names(to_table, key, tables[to_table].columns):
            named[name].append(to_table)
    pairs = defaultdict(list)
    for from_table, df in tables.items():
        for f in df.schema:
            name = bare_name(f.name, df.columns)
            others = [t for t in named.get(name, ()) if t != from_table]
            own = keys.get(from_table)
            if own and name == "parent" + bare_name(own, df.columns):  # a row's parent in its own table
                others.append(from_table)
            for to_table in others:
                if _same_kind(f.dataType, tables[to_table].schema[keys[to_table]].dataType):
                    pairs[to_table].append((from_table, f.name))
    tested = [_orphans(tables, found, table, keys[table]) for table, found in pairs.items()]
    if not tested:
        spark = next(iter(tables.values())).sparkSession
        return spark.createDataFrame(
            [], "from_table string, from_column string, to_table string, to_column string"
        )
    found = reduce(DataFrame.unionAll, tested)
    return found.where("values > 0 AND orphans = 0").drop("values", "orphans")


def orphan_counts(
    tables: Mapping[str, DataFrame], pairs: list[tuple[str, str]], to_table: str, to_column: str
) -> DataFrame:
    """How many distinct values of each (table, column) are no value of the key."""
    return _orphans(tables, pairs, to_table, to_column)


def _orphans(tables, pairs, to_table: str, to_column: str) -> DataFrame:
    kind = tables[to_table].schema[to_column].dataType
    values = reduce(
        DataFrame.unionAll,
        [
            tables[table].select(
                F.lit(table).alias("from_table"),
                F.lit(name).alias("from_column"),
                F.col(backtick(name)).cast(_widest(kind)).alias("value"),
            )
            for table, name in pairs
        ],
    )
    values = values.where("value IS NOT NULL").distinct()
    key = F.col(backtick(to_column)).cast(_widest(kind)).alias("key")
    known = tables[to_table].select(key).distinct()  # grouped as the join needs it
    joined = values.join(known, F.col("value") == F.col("key"), "left")
    return joined.groupBy("from_table", "from_column").agg(
        F.lit(to_table).alias("to_table"),
        F.lit(to_column).alias("to_column"),
        F.count(F.lit(1)).alias("values"),
        F.count_if(F.col("key").isNull()).alias("orphans"),
    )


def _widest(kind: T.DataType) -> T.DataType:
    return T.LongType() if isinstance(kind, INTEGRAL) else kind


def _same_kind(kind: T.DataType, other: T.DataType) -> bool:
    return kind == other or any(
        isinstance(kind, kinds) and isinstance(other, kinds) for kinds in (INTEGRAL, TEXT)
    )


def _reference_names(table: str, key: str, columns: list[str]) -> set[str]:
    """Names of columns that may refer to a key: its own, unless that is a mere ``id``, and
    the table's with it."""
    name, owner = bare_name(key, columns), _letters(table)
    return {owner + name, owner.removesuffix("s") + name} | ({name} - {"id"})


def bare_name(name: str, columns: list[str]) -> str:
    """A column's name without a prefix that all the table's columns share."""
    prefix = re.match(r"[A-Za-z]+_", name)
    if prefix and len(columns) > 1 and all(c.startswith(prefix.group()) for c in columns):
        name = name[prefix.end() :]
    return _letters(name)


def _letters(name: str) -> str:
    return name.lower().replace("_", "")


def inspect(tables: Mapping[str, DataFrame]) -> Metadata:
    """Metadata of tables without declared constraints, keys found from the data."""
    candidates = primary_keys(candidate_keys(tables)).collect()
    keys = {row["table_name"]: row["column_name"] for row in candidates}
    return Metadata(
        row_counts(tables),
        table_columns(tables, frozenset(keys.items())),
        foreign_keys(tables, keys),
    )
