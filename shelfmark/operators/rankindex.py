"""A stored order of rows: sorted once, and any page of it read from the few row groups that hold it."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.ranking import sorted_by

#: Which range of the order a row is in, and its 0-based place there.
RANGE, PLACE = "_range", "_place"
#: Bytes of a row group in memory: what a page in the middle of a range reads at least.
GROUP_BYTES = 1 << 20

_ROW_BITS = 33


@dataclass(frozen=True)
class RankIndex:
    """Rows in order, in a folder for each range, and how many rows come before each range.

    ``about`` says what was ordered, and how; who reads pages from it compares that first.
    """

    rows: DataFrame
    starts: tuple[tuple[int, int, int], ...]
    about: str

    @property
    def total(self) -> int:
        return sum(size for _, _, size in self.starts)

    @classmethod
    def build(
        cls, rows: DataFrame, keys: list[tuple[str, bool]], path: str, about: Mapping | None = None, group_bytes: int = GROUP_BYTES
    ) -> RankIndex:
        """Sort ``rows`` by ``keys`` in parallel, write them to ``path`` and open what was written.

        Each range is one folder of files that are sorted by place. Nothing is ranked by one task:
        the ranks follow from the sizes of the ranges, of which there are as many as partitions.
        """
        if clash := {RANGE, PLACE} & {c.lower() for c in rows.columns}:
            raise ValueError(f"the rows have columns called {sorted(clash)} already")
        order, spark = sorted_by(keys), rows.sparkSession
        ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        numbered = ranged.withColumn("_id", F.monotonically_increasing_id())
        placed = numbered.withColumns(
            {RANGE: F.shiftright("_id", _ROW_BITS), PLACE: F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))}
        ).drop("_id")
        # The writer wants the rows of a folder together; so sorted they stay in order.
        placed = placed.sortWithinPartitions(RANGE, PLACE)
        writer = placed.write.option("parquet.block.size", group_bytes).option("parquet.page.row.count.limit", 1000)
        writer.partitionBy(RANGE).parquet(f"{path}/rows")
        schema = placed.schema
        stored = spark.read.schema(schema).parquet(f"{path}/rows")
        sizes, before = [], 0
        for number, size in sorted(stored.groupBy(RANGE).agg(F.count(F.lit(1))).collect()):
            sizes.append((number, before, size))
            before += size
        starts = spark.createDataFrame(sizes, "number long, before long, size long").coalesce(1)
        starts.write.parquet(f"{path}/starts")
        said = json.dumps({"about": about or {}, "schema": schema.jsonValue()}, sort_keys=True)
        spark.createDataFrame([(said,)], "value string").coalesce(1).write.text(f"{path}/about")
        return cls.open(spark, path)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> RankIndex:
        """What ``build`` has written to ``path``; reads a row for each range, and no row of the table."""
        from pyspark.sql.types import StructType

        said = json.loads(spark.read.text(f"{path}/about").first()[0])
        rows = spark.read.schema(StructType.fromJson(said["schema"])).parquet(f"{path}/rows")
        starts = spark.read.parquet(f"{path}/starts").orderBy("number").collect()
        return cls(rows, tuple(map(tuple, starts)), json.dumps(said["about"], sort_keys=True))

    def cut(self, offset: int, limit: int) -> DataFrame:
        """Rows ``offset`` to ``offset + limit`` in order. Other ranges are not listed, other row groups not read."""
        inside = F.lit(False)
        for number, before, size in self.starts:
            first, last = max(offset, before) - before, min(offset + limit, before + size) - before
            if first < last:
                inside |= (F.col(RANGE) == number) & F.col(PLACE).between(first, last - 1)
        return self.rows.where(inside).orderBy(RANGE, PLACE).limit(limit).drop(RANGE, PLACE)

    def ranked(self, rank: str = "rank") -> DataFrame:
        """All rows with their 1-based rank."""
        starts = self.rows.sparkSession.createDataFrame([s[:2] for s in self.starts], f"{RANGE} long, _before long")
        found = self.rows.join(F.broadcast(starts), RANGE)
        return found.withColumn(rank, F.col("_before") + F.col(PLACE) + 1).drop(RANGE, PLACE, "_before")
