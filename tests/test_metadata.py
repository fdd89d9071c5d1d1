import pytest
from pyspark.sql import functions as F

from shelfmark.operators import profile
from shelfmark.sources import metadata, readers


@pytest.fixture
def frames(spark):
    """The catalog frames of a database with a two-column key and a self-reference."""
    constraint = "constraint_name string, table_schema string, table_name string, constraint_type string"
    usage = (
        "constraint_name string, table_schema string, table_name string, column_name string, "
        "ordinal_position int, position_in_unique_constraint int"
    )
    return {
        "tables": spark.createDataFrame(
            [("car", 100.0), ("image", -1.0), ("pair", 7.0)], "table_name string, estimate float"
        ),
        "columns": spark.createDataFrame(
            [
                ("car", 2, "title", "text", "YES"), ("car", 1, "id", "integer", "NO"),
                ("car", 3, "parent_id", "integer", "YES"), ("image", 1, "a", "integer", "NO"),
                ("image", 2, "b", "integer", "NO"), ("pair", 1, "x", "integer", "NO"),
                ("pair", 2, "y", "integer", "NO"),
            ],
            "table_name string, ordinal_position int, column_name string, data_type string, is_nullable string",
        ),
        "table_constraints": spark.createDataFrame(
            [
                ("car_pk", "public", "car", "PRIMARY KEY"), ("pair_pk", "public", "pair", "PRIMARY KEY"),
                ("image_fk", "public", "image", "FOREIGN KEY"), ("car_fk", "public", "car", "FOREIGN KEY"),
            ],
            constraint,
        ),
        "key_column_usage": spark.createDataFrame(
            [
                ("car_pk", "public", "car", "id", 1, None), ("pair_pk", "public", "pair", "x", 1, None),
                ("pair_pk", "public", "pair", "y", 2, None), ("image_fk", "public", "image", "b", 1, 1),
                ("image_fk", "public", "image", "a", 2, 2), ("car_fk", "public", "car", "parent_id", 1, 1),
            ],
            usage,
        ),
        "referential_constraints": spark.createDataFrame(
            [("image_fk", "public", "pair_pk", "public"), ("car_fk", "public", "car_pk", "public")],
            "constraint_name string, table_schema string, unique_constraint_name string, unique_constraint_schema string",
        ),
    }


def test_declared_metadata(frames):
    found = metadata.in_order(metadata.from_catalog(frames))
    assert [tuple(r) for r in found.tables.collect()] == [("car", 100), ("image", 0), ("pair", 7)]
    columns = found.columns.where("table_name = 'car'").collect()
    assert [(r.column_name, r.nullable, r.is_primary_key) for r in columns] == [
        ("id", False, True), ("title", True, False), ("parent_id", True, False),
    ]
    assert [tuple(r) for r in found.foreign_keys.collect()] == [
        ("car", "parent_id", "car", "id"), ("image", "a", "pair", "y"), ("image", "b", "pair", "x"),
    ]
    assert [r.table_name for r in metadata.by_size(found.tables).collect()] == ["car", "pair", "image"]


@pytest.fixture
def tables(spark):
    car = spark.createDataFrame(
        [(1, "a", "x", None), (2, "b", "x", 1.0), (3, "c", "x", 2.0)],
        "id int, title string, kind string, score double",
    )
    image = spark.createDataFrame(
        [(10, 1, "u"), (11, 1, "v"), (12, 3, "w"), (13, None, "z")], "id int, carId bigint, url string"
    )
    orphan = spark.createDataFrame([(1, 1), (2, 99)], "id int, car_id int")
    return {"car": car, "image": image, "orphan": orphan}


def test_profile(tables):
    rows = {(r.table_name, r.column_name): r for r in profile.column_profile(tables).collect()}
    assert rows["car", "score"].filled == 2 and rows["car", "score"].row_count == 3
    assert rows["car", "kind"].approx_distinct == 1 and rows["image", "carId"].ordinal == 2
    assert rows["car", "title"].data_type == "string"


def test_keys_found_from_the_data(tables):
    keys = {(r.table_name, r.column_name) for r in profile.candidate_keys(tables).collect() if r.is_key}
    assert keys == {
        ("car", "id"), ("car", "title"), ("image", "id"), ("image", "url"), ("orphan", "id"),
        ("orphan", "car_id"),
    }
    found = profile.inspect(tables)
    assert [tuple(r) for r in found.foreign_keys.collect()] == [("image", "carId", "car", "id")]
    flagged = found.columns.where("is_primary_key").collect()
    assert {(r.table_name, r.column_name) for r in flagged} == {
        ("car", "id"), ("image", "id"), ("orphan", "id"),
    }
    assert {tuple(r) for r in found.tables.collect()} == {("car", 3), ("image", 4), ("orphan", 2)}


def test_one_repeated_value_is_seen(spark):
    frame = spark.range(20_000).select(
        F.when(F.col("id") == 777, 5).otherwise(F.col("id")).alias("nearly"),
        F.format_string("t%d", F.when(F.col("id") == 777, 5).otherwise(F.col("id"))).alias("text"),
        F.format_string("t%d", "id").alias("unique"),
        F.col("id"),
    )
    keys = {r.column_name: r.is_key for r in profile.candidate_keys({"t": frame}).collect()}
    assert keys == {"nearly": False, "text": False, "unique": True, "id": True}


def test_bare_names():
    columns = ["l_orderkey", "l_partkey"]
    assert profile.bare_name("l_orderkey", columns) == "orderkey"
    assert profile.bare_name("doc_id", ["doc_id", "text"]) == "docid"


def test_estimates_come_from_statistics(spark):
    frame = spark.range(50)
    frame.write.mode("overwrite").saveAsTable("estimated")
    assert tuple(metadata.estimated_rows(spark, "estimated").first()) == ("estimated", 50)
    spark.sql("ANALYZE TABLE estimated COMPUTE STATISTICS")
    frame.write.mode("append").format("parquet").save(
        spark.sql("DESCRIBE TABLE EXTENDED estimated").where("col_name = 'Location'").first()[1]
    )
    assert tuple(metadata.estimated_rows(spark, "estimated").first()) == ("estimated", 50)
    assert "estimated" in metadata.catalog_tables(spark)
    spark.sql("DROP TABLE estimated")


def test_readers(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    assert readers.read_tables(spark, str(tmp_path), ["t"])["t"].count() == 3
    spark.range(4).write.mode("overwrite").saveAsTable("readable")
    assert readers.read_table(spark, "table", "readable").count() == 4
    spark.sql("DROP TABLE readable")
    with pytest.raises(ValueError, match="unknown kind"):
        readers.read_table(spark, "mysql", "t")


def test_jdbc_options():
    options = readers.jdbc_options(
        "jdbc:x", table="Car", partition_column="id", bounds=(0, 1000), partitions=8, user="u"
    )
    assert options["sessionInitStatement"] == "SET default_transaction_read_only = ON"
    assert (options["dbtable"], options["numPartitions"], options["upperBound"]) == ("Car", "8", "1000")
    assert "dbtable" not in readers.jdbc_options("jdbc:x", query="SELECT 1")
    for bad in ({}, {"table": "a", "query": "b"}, {"table": "a", "partition_column": "id"}):
        with pytest.raises(ValueError):
            readers.jdbc_options("jdbc:x", **bad)


def test_a_table_may_refer_to_itself(spark):
    tree = spark.createDataFrame([(1, None), (2, 1), (3, 1)], "id int, parent_id int")
    other = spark.createDataFrame([(1, 1), (2, 1)], "id int, parent_id int")
    keys = {"tree": "id", "other": "id"}
    found = {tuple(r) for r in profile.foreign_keys({"tree": tree, "other": other}, keys).collect()}
    assert found == {("tree", "parent_id", "tree", "id"), ("other", "parent_id", "other", "id")}
    counted = profile.orphan_counts({"tree": tree, "many": other.select("parent_id")}, [("tree", "parent_id")], "many", "parent_id")
    assert [(r["values"], r["orphans"]) for r in counted.collect()] == [(1, 0)]


def test_keys_are_disproved_by_values_alone(spark):
    """Half of the values differ, one is there twice, maps are compared."""
    frame = spark.range(5000).selectExpr(
        "id", "if(id = 4999, 0, id) AS once_more", "id % 3 AS few", "map(id, 1) AS held", "map(id % 7, 1) AS held_twice",
        "repeat(cast(id as string), 2) AS text", "if(id = 1, '22', cast(id as string)) AS text_twice", "nullif(id, 7) AS hole",
    )
    keys = {r.column_name for r in profile.candidate_keys({"t": frame}).collect() if r.is_key}
    assert keys == {"id", "held", "text"}


@pytest.mark.parametrize("seed", range(3))
def test_sampled_rows_state_the_true_count(spark, tmp_path, seed):
    rows = spark.range(30_000).select("id", F.sha2(F.concat(F.lit(seed), "id"), 256).alias("text"))
    rows.repartitionByRange(40, F.sqrt(F.col("id"))).write.parquet(str(tmp_path / "t"))
    found = metadata.sampled_rows(spark, "t", str(tmp_path / "t"), files=10).first()
    assert found.table_name == "t" and (found.files, found.read) == (40, 10)
    assert 0 < found.low <= 30_000 <= found.high < 60_000 and found.low <= found.row_count <= found.high
    whole = metadata.sampled_rows(spark, "t", str(tmp_path / "t"), files=40).first()
    assert whole.low == whole.row_count == whole.high == 30_000


def test_sampled_rows_of_one_file_and_of_none(spark, tmp_path):
    spark.range(7).coalesce(1).write.parquet(str(tmp_path / "one"))
    assert metadata.sampled_rows(spark, "t", str(tmp_path / "one")).first()[1:4] == (7, 7, 7)
    (tmp_path / "none").mkdir()
    assert metadata.sampled_rows(spark, "t", str(tmp_path / "none")).first()[1:4] == (0, 0, 0)
