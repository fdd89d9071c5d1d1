import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shelfmark import Catalog, FilterSpec, PageRequest, RelationSpec, ResourceSpec
from shelfmark.functions.predicates import like_pattern
from shelfmark.operators.items import item_json

CAR = ResourceSpec(
    table="Car",
    id_column="id",
    updated_at_column="updatedAt",
    fields={
        "externalId": "id",
        "title": "title",
        "price": "price",
        "currency": "'KRW'",
        "category": "'car'",
    },
    attributes={"makeEn": '"makeEn"', "year": "year"},
)


@pytest.fixture
def car(spark):
    rows = [("123", "2024 Hyundai Sonata", 15000000, "Hyundai", 2024, datetime(2026, 1, 15, 10))]
    return spark.createDataFrame(
        rows, "id string, title string, price bigint, makeEn string, year int, updatedAt timestamp"
    ).withColumn("unused", F.lit("x"))


def one(df):
    (row,) = df.collect()
    return row


def test_a_row_becomes_an_item(car):
    item = one(Catalog(CAR, car).items())
    assert item.externalId == "123" and item.title == "2024 Hyundai Sonata"
    assert item.price == 15000000.0 and item.currency == "KRW" and item.category == "car"
    assert item.status == "ACTIVE" and item.images == []
    assert item.attributes.asDict() == {"makeEn": "Hyundai", "year": 2024}
    assert item.updatedAt == "2026-01-15T10:00:00.000Z"
    assert (item.part, item.parts) == (0, 1)


def test_required_columns(car):
    assert Catalog(CAR, car).columns == ["id", "updatedAt", "title", "price", "makeEn", "year"]


def test_no_updated_at_column(car):
    spec = ResourceSpec("Car", "id", {"title": "title"})
    assert one(Catalog(spec, car).items()).updatedAt is None


def test_images_and_features(spark, car):
    images = spark.createDataFrame(
        [("123", "http://img2.jpg"), ("123", "http://img1.jpg"), ("123", ""), ("123", None),
         (None, "http://img3.jpg"), ("9", "http://img4.jpg")],
        "carId string, url string",
    )
    features = spark.createDataFrame(
        [("123", "ABS"), ("123", "Airbag"), ("123", ""), ("123", None)],
        "carId string, featureName string",
    )
    spec = ResourceSpec(
        "Car",
        "id",
        {"title": "title"},
        relations={
            "images": RelationSpec("Image", '"carId"', {"url": "url"}, image_url_field="url"),
            "features": RelationSpec(
                "CarFeatures", '"carId"', {"name": '"featureName"'}, flatten="name"
            ),
        },
    )
    catalog = Catalog(spec, car, {"Image": images, "CarFeatures": features})
    for items in (catalog.items(), catalog.page(), catalog.item("123")):
        item = one(items)
        assert item.images == ["http://img1.jpg", "http://img2.jpg"]
        assert item.attributes.features == ["", "ABS", "Airbag"]


def test_flatten_of_numbers_is_empty_and_relation_wins_over_attribute(spark, car):
    child = spark.createDataFrame([("123", 7)], "carId string, n int")
    spec = ResourceSpec(
        "Car",
        "id",
        {},
        attributes={"tags": "year"},
        relations={"tags": RelationSpec("c", "carId", {"n": "n"}, flatten="n")},
    )
    assert one(Catalog(spec, car, {"c": child}).items()).attributes.tags == []


def test_last_image_relation_wins(spark, car):
    child = spark.createDataFrame([("123", "a", "b")], "carId string, x string, y string")
    spec = ResourceSpec(
        "Car",
        "id",
        {},
        relations={
            "one": RelationSpec("c", "carId", {"x": "x"}, image_url_field="x"),
            "two": RelationSpec("c", "carId", {"y": "y"}, image_url_field="y"),
        },
    )
    assert one(Catalog(spec, car, {"c": child}).items()).images == ["b"]


def test_missing_values_take_defaults(spark):
    rows = [("1", "1.5"), ("2", None), ("3", "abc"), (None, "")]
    frame = spark.createDataFrame(rows, "id string, price string")
    spec = ResourceSpec("t", "id", {"price": "price", "title": "''", "status": "id"})
    found = {r.externalId: r for r in Catalog(spec, frame).items().collect()}
    assert {k: r.price for k, r in found.items()} == {"1": 1.5, "2": 0.0, "3": None, "": None}
    assert found["1"].title == "" and found["1"].currency == "USD"
    assert found[""].status == "ACTIVE" and found["2"].status == "2"


def test_whole_floats_as_text(spark):
    frame = spark.createDataFrame([(10.0, 1.5), (12345678.0, None)], "id double, t double")
    spec = ResourceSpec("t", "id", {"title": "t"})
    found = {(r.externalId, r.title) for r in Catalog(spec, frame).items().collect()}
    assert found == {("10", "1.5"), ("12345678", "")}


def test_updated_at_kinds(spark):
    frame = spark.sql(
        "SELECT 1 AS id, TIMESTAMP_NTZ '2026-01-02 03:04:05.678999' AS n, "
        "TIMESTAMP '2026-01-02 03:04:05.678999' AS t, DATE '2026-01-02' AS d, 'x' AS s, '' AS e"
    )

    def updated(column):
        spec = ResourceSpec("t", "id", {}, updated_at_column=column)
        return one(Catalog(spec, frame).items()).updatedAt

    assert updated("n") == updated("t") == "2026-01-02T03:04:05.678Z"
    assert updated("d") == "2026-01-02T00:00:00.000Z"
    assert (updated("s"), updated("e")) == ("x", None)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert updated("n") == updated("t") == "2026-01-02T03:04:05.678Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
@pytest.mark.parametrize(
    "since, found",
    [
        ("2026-01-02T00:00:00Z", 2), ("2026-01-02T00:00:00.001Z", 1), ("2026-01-02", 2),
        ("2026-01-02T02:00:00+02:00", 2), ("2026-01-02T00:00:00-01:00", 1),
        ("2026-01-02T00:00:00", 2), ("never", 0),
    ],
)
def test_updated_since_is_inclusive_and_reads_offsets(spark, zone, since, found):
    frame = spark.sql(
        "SELECT id, TIMESTAMP_NTZ '2026-01-01' + make_dt_interval(id) AS t FROM range(3)"
    )
    spec = ResourceSpec("t", "id", {}, updated_at_column="t")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        request = PageRequest.parse(spec, {"updatedSince": since})
        assert Catalog(spec, frame).rows(request).count() == found
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_unknown_columns_are_refused_before_any_job(car):
    for spec in (
        ResourceSpec("Car", "id", {"title": "nope"}),
        ResourceSpec("Car", "id", {"title": '"TITLE"'}),
        ResourceSpec("Car", "id", {}, filterable_columns={"x": FilterSpec("nope", "string")}),
    ):
        with pytest.raises(ValueError, match="no column"):
            Catalog(spec, car)
    with pytest.raises(ValueError, match="no column"):
        Catalog(CAR, car).page(PageRequest.parse(CAR, {"sortBy": "id; DROP TABLE x"}))
    with pytest.raises(ValueError, match="no source"):
        Catalog(ResourceSpec("t", "id", {}, relations={"r": RelationSpec("c", "k", {"a": "a"})}), car)


PRODUCT = ResourceSpec(
    table="products",
    id_column="id",
    updated_at_column="updatedAt",
    fields={"title": "name", "price": "price", "currency": "'USD'", "category": "'item'"},
    searchable_columns=("name",),
    filterable_columns={"category": FilterSpec("category", "string")},
)


@pytest.fixture
def products(spark):
    return spark.createDataFrame(
        [
            ("1", "Widget", 9.99, "a", "2026-01-01T00:00:00Z"),
            ("2", "Gadget", 19.99, "b", "2026-01-02T00:00:00Z"),
        ],
        "id string, name string, price double, category string, updatedAt string",
    )


def test_page_and_summary(products):
    catalog = Catalog(PRODUCT, products)
    assert [r.title for r in catalog.page().collect()] == ["Gadget", "Widget"]
    assert one(catalog.summary()).asDict() == {
        "total": 2, "page": 1, "page_size": 20, "total_pages": 1,
    }
    past = PageRequest.parse(PRODUCT, {"page": "9", "search": "WID"})
    assert catalog.page(past).count() == 0
    assert one(catalog.summary(past)).total == 1
    none = PageRequest.parse(PRODUCT, {"filter.category": "zzz"})
    assert one(catalog.summary(none)).asDict() == {
        "total": 0, "page": 1, "page_size": 20, "total_pages": 0,
    }
    since = PageRequest.parse(PRODUCT, {"updatedSince": "2026-01-02T00:00:00Z"})
    assert [r.externalId for r in catalog.page(since).collect()] == ["2"]


def test_single_item(products):
    catalog = Catalog(PRODUCT, products)
    assert one(catalog.item("2")).title == "Gadget"
    assert catalog.item("999").count() == 0


def test_base_filter_is_one_whole(spark):
    frame = spark.createDataFrame(
        [(1, 1, 0, 5), (2, 0, 1, 5), (3, 0, 1, 9), (4, 0, 0, 5)], "id int, a int, b int, c int"
    )
    spec = ResourceSpec(
        "t", "id", {}, base_filter='"a" = 1 OR b = 1',
        filterable_columns={"c": FilterSpec("c", "number")},
    )
    catalog = Catalog(spec, frame)
    rows = catalog.items(PageRequest.parse(spec, {"filter.c": "5"})).collect()
    assert {r.externalId for r in rows} == {"1", "2"}
    assert catalog.item("4").count() == 0 and catalog.item("3").count() == 1
    assert catalog.item("zz").count() == 0


def test_string_filter_on_other_types(spark):
    frame = spark.createDataFrame([(1, 7), (2, 8)], "id int, n bigint")
    spec = ResourceSpec("t", "id", {}, filterable_columns={"n": FilterSpec("n", "string")})
    catalog = Catalog(spec, frame)

    def ids(value):
        return [r.externalId for r in catalog.items(PageRequest.parse(spec, {"filter.n": value})).collect()]

    assert ids("7") == ["1"] and ids("zz") == []


@pytest.mark.parametrize(
    "value, expected",
    [
        ("re", {"RED", "red"}),
        ("r_d", {"RED", "red", "r_d", "r%d"}),
        (r"r\_d", {"r_d"}),
        (r"r\%d", {"r%d"}),
        (r"r\ed", {"RED", "red"}),
        (r"\\", {"back\\slash"}),
        ("É", {"école"}),
    ],
)
def test_search_wildcards(spark, value, expected):
    values = ["RED", "red", "r_d", "r%d", "back\\slash", "école"]
    frame = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "id int, v string")
    spec = ResourceSpec("t", "id", {"title": "v"}, searchable_columns=("v",))
    rows = Catalog(spec, frame).items(PageRequest.parse(spec, {"search": value})).collect()
    assert {r.title for r in rows} == expected


def test_like_pattern():
    assert like_pattern(r"a\x") == "%ax%"
    assert like_pattern("a\\") == "%a\\%"


def test_json_keeps_nulls(products, tmp_path):
    catalog = Catalog(ResourceSpec("p", "id", {"title": "name"}), products)
    items = catalog.items()
    record = json.loads(one(items.where("externalId = '1'").select(item_json(items))).asDict().popitem()[1])
    assert record == {
        "externalId": "1", "title": "Widget", "price": 0.0, "currency": "USD", "category": "",
        "status": "ACTIVE", "images": [], "attributes": {}, "updatedAt": None,
    }
    catalog.export(str(tmp_path / "json"), "json")
    catalog.export(str(tmp_path / "parquet"))
    spark = products.sparkSession
    assert spark.read.text(str(tmp_path / "json")).count() == 2
    assert spark.read.parquet(str(tmp_path / "parquet")).count() == 2
