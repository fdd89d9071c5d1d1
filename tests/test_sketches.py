"""Sketches by file: what is read again, what is forgotten, and how near the estimates are."""

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import sketches


def merged(spark, source, folder, **named):
    return {r["column_name"]: r for r in sketches.sketched_profile(spark, source, folder, **named).collect()}


@pytest.fixture
def places(tmp_path):
    return str(tmp_path / "table"), str(tmp_path / "sketches")


def test_only_new_files_are_read(spark, places):
    source, folder = places
    spark.range(0, 20_000, 1, 4).withColumn("half", F.col("id") % 10_000).write.parquet(source)
    with pytest.raises(ValueError, match="4 files"):
        sketches.sketched_profile(spark, source, folder)
    assert [sketches.refresh(spark, source, folder) for _ in range(2)] == [4, 0]
    spark.range(10_000, 40_000, 1, 3).withColumn("half", F.lit(None).cast("long")).write.mode("append").parquet(source)
    assert sketches.refresh(spark, source, folder) == 3
    found = merged(spark, source, folder, ranks=(0.0, 0.5, 1.0))
    assert found["id"]["row_count"] == found["id"]["filled"] == 50_000 and found["half"]["filled"] == 20_000
    # Values that both parts hold are counted once.
    assert found["id"]["approx_distinct"] == pytest.approx(40_000, rel=0.03)
    assert found["half"]["approx_distinct"] == pytest.approx(10_000, rel=0.03)
    least, middle, most = found["id"]["quantiles"]
    assert (least, most) == (0, 39_999)
    true = spark.read.parquet(source).where(F.col("id") <= middle).count() / 50_000
    assert true == pytest.approx(0.5, abs=0.02)


def test_replaced_and_removed_files_are_forgotten(spark, places):
    source, folder = places
    spark.range(0, 1_000, 1, 1).write.parquet(source)
    sketches.refresh(spark, source, folder)
    spark.range(5_000, 5_300, 1, 2).write.mode("overwrite").parquet(source)
    assert sketches.refresh(spark, source, folder) == 2
    found = merged(spark, source, folder, ranks=(0.0,))["id"]
    assert (found["row_count"], found["filled"], found["quantiles"]) == (300, 300, [5_000])


def test_a_file_read_by_two_refreshes_counts_once(spark, places, tmp_path):
    source, folder = places
    spark.range(0, 1_000, 1, 1).write.parquet(source)
    sketches.refresh(spark, source, folder)
    other = str(tmp_path / "other")
    sketches.refresh(spark, source, other)
    spark.read.parquet(other).write.mode("append").parquet(folder)
    assert merged(spark, source, folder)["id"]["row_count"] == 1_000


def test_all_kinds_of_columns(spark, places):
    source, folder = places
    rows = [(None, "a b", [1, 2], {"x": 1}, 0.5, "f1"), (1, "", None, None, float("nan"), "f2"), (None, "a b", [1, 2], {}, None, None)]
    kinds = "`odd name` int, text string, list array<int>, map map<string,int>, _file double, file string"
    spark.createDataFrame(rows, kinds).coalesce(1).write.parquet(source)
    sketches.refresh(spark, source, folder)
    found = merged(spark, source, folder)
    assert {c: (r["row_count"], r["filled"], r["approx_distinct"]) for c, r in found.items()} == {
        "odd name": (3, 1, 1), "text": (3, 3, 2), "list": (3, 2, 1), "map": (3, 2, 0), "_file": (3, 2, 2), "file": (3, 2, 2),
    }
    assert found["text"]["quantiles"] is None and found["odd name"]["quantiles"] == [1]


def test_empty_tables(spark, places):
    source, folder = places
    spark.createDataFrame([], "a int, b string").coalesce(1).write.parquet(source)
    assert sketches.refresh(spark, source, folder) <= 1
    assert sketches.refresh(spark, source, folder) == 0
    assert merged(spark, source, folder) == {}


def test_no_row_of_the_table_is_read_for_a_profile(spark, places, plan):
    source, folder = places
    spark.range(100).write.parquet(source)
    sketches.refresh(spark, source, folder)
    text = plan(sketches.sketched_profile(spark, source, folder))
    assert "Scan binaryFile" in text and "content" not in text
    locations = [line for line in text.splitlines() if line.startswith("Location")]
    assert len(locations) == 2 and sum(folder in line for line in locations) == 1
