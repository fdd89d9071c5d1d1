"""Cases that went wrong once."""

import json

import pytest

from shelfmark import Catalog, FilterSpec, PageRequest, RelationSpec, ResourceSpec
from shelfmark.sources import requestlog
from shelfmark.streaming.extract import changed_since


def test_every_log_line_is_an_entry_or_in_quarantine(spark, tmp_path):
    lines = [
        json.dumps({"ts": "2026-01-01T00:00:00.000Z", "path": "/a"}),
        '{"ts":"2026-01-01T00:00:00.000Z","query":"str","path":"/q"}',
        "{}", '{"user":"x"}', "{bad", "null", "5", '"text"', "[1]", '[{"ts":"2026"}]',
    ]
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a.json").write_text("\n".join([*lines, "", "  "]) + "\n")
    raw = requestlog.read_raw(spark, str(tmp_path / "log"))
    kept, broken = requestlog.entries(raw).count(), {r.line for r in requestlog.quarantine(raw).collect()}
    assert kept == 3 and broken == set(lines) - {lines[0], "{}", '{"user":"x"}'}


def test_a_page_with_children_keeps_its_order(spark):
    spec = ResourceSpec(
        table="main", id_column="id", fields={"title": "name"}, attributes={"price": "price"},
        relations={"tags": RelationSpec("tag", "main_id", {"tag": "tag"}, flatten="tag")},
    )
    main = spark.createDataFrame([(i, f"n{i}", (i * 37) % 101) for i in range(200)], "id long, name string, price int")
    tags = spark.createDataFrame([(i % 200, f"t{i}") for i in range(500)], "main_id long, tag string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        request = PageRequest(page_size=50, sort_by="price", ascending=True)
        items = Catalog(spec, main, {"tag": tags}).page(request).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    prices = [i.attributes.price for i in items]
    assert len(prices) == 50 and prices == sorted(prices)


def test_an_item_with_a_map_attribute(spark):
    spec = ResourceSpec(table="main", id_column="id", fields={}, attributes={"props": "props"})
    main = spark.createDataFrame([(1, {"a": "b"}), (1, {"a": "a"})], "id long, props map<string,string>")
    assert Catalog(spec, main, {}).item("1").collect()[0].attributes.props == {"a": "a"}


def test_ranked_rows_do_not_lose_a_column(spark):
    spec = ResourceSpec(table="main", id_column="id", fields={}, attributes={"rank": "rank"})
    main = spark.createDataFrame([(1, 5)], "id long, rank int")
    with pytest.raises(ValueError, match="rank"):
        Catalog(spec, main, {}).all_pages()


def test_decimal_bounds_reach_the_scan(spark, tmp_path, plan):
    spark.sql("SELECT CAST(id AS BIGINT) id, CAST(id AS DECIMAL(15,2)) p FROM range(10)").write.parquet(str(tmp_path / "m"))
    main = spark.read.parquet(str(tmp_path / "m"))
    spec = ResourceSpec(table="main", id_column="id", fields={}, filterable_columns={"min": FilterSpec("p", "gte")})
    catalog = Catalog(spec, main, {})
    rows = catalog.rows(catalog.request({"filter.min": "4.5"}))
    assert "GreaterThanOrEqual(p,4.50)" in plan(rows) and rows.count() == 5


def test_a_mark_stays_where_nothing_has_changed(spark):
    main = spark.sql("SELECT 1L id, TIMESTAMP_NTZ '2026-01-01' t")
    spec = ResourceSpec(table="main", id_column="id", fields={}, updated_at_column="t")
    mark = changed_since(main, spec, "2026-02-01T00:00:00Z").mark.first()
    assert (str(mark.high_water), mark.n) == ("2026-02-01 00:00:00", 0)
    with pytest.raises(ValueError, match="mark"):
        changed_since(main, spec, "")
