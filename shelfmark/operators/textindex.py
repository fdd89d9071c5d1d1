"""Text search that reads few files: which runs of one to three characters stand in which blocks of rows.

A pattern with wildcards can only match where every run of its literal pieces occurs, so blocks that lack
one are not read. What is left is tested by the search itself; the index never decides.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfmark.functions.columns import TEXT, backtick, column_name
from shelfmark.functions.predicates import like_pattern

BLOCK = "_block"
#: Characters of the longest run that is indexed.
GRAM = 3
#: Rows of a block, and the most blocks that a scan is given as a list; more are joined.
BLOCK_ROWS, MOST_LISTED = 100_000, 10_000

_ROW_BITS, _BLOCK_BITS = 33, 20


def _text(df: DataFrame, name: str) -> Column:
    """A column as a search compares it."""
    value = F.col(backtick(name))
    return F.lower(value if isinstance(df.schema[name].dataType, TEXT) else value.cast("string"))


def runs(text: str) -> set[str]:
    """The longest indexed runs of a text: all of three characters, or the text itself if it has fewer."""
    size = min(GRAM, len(text))
    return {text[i : i + size] for i in range(len(text) - size + 1)} if text else set()


def required(pattern: str) -> set[str]:
    """The runs that a text must hold to match a LIKE pattern, whose ``%`` and ``_`` may be escaped."""
    pieces, escaped = [""], False
    for char in pattern:
        if not escaped and char == "\\":
            escaped = True
        elif not escaped and char in "%_":
            pieces.append("")
        else:
            pieces[-1] += char
            escaped = False
    return set().union(*map(runs, pieces))


@dataclass(frozen=True)
class TextIndex:
    """Rows in folders by block, and for each column the blocks that each run of characters is in."""

    rows: DataFrame
    postings: DataFrame
    columns: tuple[str, ...]
    blocks: int

    @classmethod
    def build(cls, rows: DataFrame, columns: Iterable[str], path: str, block_rows: int = BLOCK_ROWS) -> TextIndex:
        """Write ``rows`` to ``path`` in blocks, as they come, and index the ``columns``.

        Each task makes the distinct runs of its own blocks, and only those are shuffled. They are
        sorted by run and block, so a run of all blocks is many tasks' and a lookup reads few row groups.
        """
        if BLOCK in rows.columns:
            raise ValueError(f"the rows have a column called {BLOCK} already")
        spark, names = rows.sparkSession, [column_name(rows.schema, c) for c in columns]
        place = F.monotonically_increasing_id()
        numbered = rows.withColumn("_id", place)
        in_part = F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
        block = F.shiftleft(F.shiftright("_id", _ROW_BITS), _BLOCK_BITS) + F.floor(in_part / block_rows)
        blocked = numbered.withColumn(BLOCK, block.cast("long")).drop("_id")
        blocked.write.partitionBy(BLOCK).parquet(f"{path}/rows")
        stored = spark.read.schema(blocked.schema).parquet(f"{path}/rows")
        found = []
        for name in names:
            text = _text(stored, name)
            every = F.concat(*(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)) for n in range(1, GRAM + 1)))
            found.append(stored.where(text.isNotNull()).select(F.lit(name).alias("column"), F.explode(F.array_distinct(every)).alias("run"), BLOCK))
        postings = reduce(DataFrame.unionAll, found).distinct() if found else spark.createDataFrame([], f"column string, run string, {BLOCK} long")
        order = ("run", "column", BLOCK)
        postings.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(f"{path}/postings")
        count = stored.select(BLOCK).distinct().count()
        said = json.dumps({"schema": blocked.schema.jsonValue(), "columns": names, "blocks": count})
        spark.createDataFrame([(said,)], "value string").coalesce(1).write.text(f"{path}/about")
        return cls.open(spark, path)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> TextIndex:
        said = json.loads(spark.read.text(f"{path}/about").first()[0])
        rows = spark.read.schema(StructType.fromJson(said["schema"])).parquet(f"{path}/rows")
        return cls(rows, spark.read.parquet(f"{path}/postings"), tuple(said["columns"]), said["blocks"])

    def candidates(self, searches: Mapping[str, str]) -> DataFrame | None:
        """The blocks that may match any of the searches (a value by column); None if all may, because a search
        is of wildcards alone or its column isn't indexed."""
        spark, found = self.rows.sparkSession, []
        for column, value in searches.items():
            name = column_name(self.rows.schema, column)
            pattern = spark.range(1).select(F.lower(F.lit(like_pattern(value)))).first()[0]
            needed = sorted(required(pattern))
            if not needed or name not in self.columns:
                return None
            own = self.postings.where((F.col("column") == name) & F.col("run").isin(needed))
            held = own.groupBy(BLOCK).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(needed))
            found.append(held.select(BLOCK))
        return reduce(DataFrame.unionAll, found).distinct() if found else None

    def cut(self, searches: Mapping[str, str]) -> DataFrame:
        """The rows of all blocks that may match; other blocks are not listed. The search is still to be applied."""
        blocks = self.candidates(searches)
        if blocks is None:
            return self.rows.drop(BLOCK)
        listed = [row[0] for row in blocks.limit(MOST_LISTED + 1).collect()]
        if len(listed) <= MOST_LISTED:
            return self.rows.where(F.col(BLOCK).isin(listed)).drop(BLOCK)
        return self.rows.join(blocks, BLOCK, "left_semi").drop(BLOCK)
