import json

import pytest

from shelfmark import Catalog, ResourceSpec
from shelfmark.operators import matching
from shelfmark.sources.metadata import COLUMNS_SCHEMA


@pytest.fixture
def columns(spark):
    """Column metadata from ``name:type`` texts, ``*`` marking a key."""

    def build(**tables):
        rows = []
        for table, text in tables.items():
            for place, part in enumerate(text.split(", "), start=1):
                name, _, kind = part.partition(":")
                rows.append((table, place, name.strip("*"), kind or "text", True, "*" in name))
        return spark.createDataFrame(rows, COLUMNS_SCHEMA)

    return build


@pytest.fixture
def references(spark):
    def build(*rows):
        schema = "from_table string, from_column string, to_table string, to_column string"
        return spark.createDataFrame(list(rows), schema)

    return build


def mapped(frame):
    return {r.column_name: (r.target, r.mapping_type, r.confidence) for r in frame.collect()}


def test_fields(columns):
    found = mapped(matching.field_mappings(columns(
        t="*id:integer, title, price:numeric, description, category"
    )))
    assert found == {
        name: (name, "field", "high") for name in ("title", "price", "description", "category")
    }


def test_attributes(columns):
    found = mapped(matching.field_mappings(columns(
        t="*id:integer, makeEn, year:integer, color, kilometers:integer, transmission, horsepower, 4wd"
    )))
    assert {k: v[0] for k, v in found.items()} == {
        "makeEn": "make", "year": "year", "color": "color", "kilometers": "mileage",
        "transmission": "transmission", "horsepower": "enginePower", "4wd": "drivetrain",
    }
    assert {v[1:] for v in found.values()} == {("attribute", "medium")}


def test_references_and_times_are_no_attributes(columns):
    frame = columns(t="*id:integer, tenantId, makeId, model_id, createdAt, updatedAt, fuel_at, *model")
    assert mapped(matching.field_mappings(frame)) == {}


def test_a_column_has_its_first_target(columns):
    frame = columns(t="brandModel, modelYear, model_year, makeType, Type, STATUS, *name")
    found = {k: v[0] for k, v in mapped(matching.field_mappings(frame)).items()}
    assert found == {
        "brandModel": "make", "modelYear": "model", "model_year": "model", "makeType": "make",
        "Type": "category", "STATUS": "status", "name": "title",
    }


@pytest.mark.parametrize(
    "text, column, expected",
    [
        ("*uuid:uuid, id:integer", "id_column", "uuid"),
        ("id:integer, name", "id_column", "id"),
        ("foo, bar", "id_column", None),
        ("id, updatedAt:timestamp, createdAt:timestamp", "updated_at_column", "updatedAt"),
        ("id, modified_at:timestamp", "updated_at_column", "modified_at"),
        ("id, lastUpdated, changed_at", "updated_at_column", "lastUpdated"),
        ("id, name", "updated_at_column", None),
        ("published:boolean", "published_column", "published"),
        ("is_active:boolean, visible:boolean", "published_column", "is_active"),
        ("name", "published_column", None),
        ("deletedAt:timestamp", "soft_delete_column", "deletedAt"),
        ("x, archived_at:timestamp, deleted_at:timestamp", "soft_delete_column", "archived_at"),
    ],
)
def test_roles(columns, text, column, expected):
    assert matching.role_columns(columns(t=text)).first()[column] == expected


def test_searchable(columns):
    def names(text):
        return [r.column_name for r in matching.searchable_columns(columns(t=text)).collect()]

    assert names(
        "*id:integer, title, makeEn:character varying, modelEn:VARCHAR(20), price:numeric, year:integer"
    ) == ["title", "makeEn", "modelEn"]
    assert names("*id:integer, price:numeric, year:integer") == []
    assert names("*id:text, title") == ["title"]


def filters(frame, extra=None):
    return {
        (r.column_name, r.filter_name, r.filter_type, r.confidence)
        for r in matching.filterable_columns(frame, extra).collect()
    }


def test_filterable(columns, spark):
    assert filters(columns(t="*id:integer, price:decimal(10,2)")) == {
        ("price", "minPrice", "gte", "high"), ("price", "maxPrice", "lte", "high"),
    }
    assert filters(columns(t="*id:integer, year:integer, fuelType:character varying")) == {
        ("year", "year", "number", "medium"), ("fuelType", "fuelType", "string", "medium"),
    }
    assert filters(columns(t="*id, title, description, tenantId, createdAt, price:text")) == {
        ("price", "price", "string", "medium")
    }
    extra = spark.createDataFrame([("t", "color"), ("t", "size"), ("t", "flag")], "table_name string, column_name string")
    assert filters(columns(t="*id, color:character varying, size:int, flag:boolean"), extra) == {
        ("color", "color", "string", "medium"), ("size", "size", "number", "medium"),
    }


def test_relations(columns, references):
    frame = columns(
        Car="*id:integer",
        Image="*id:integer, carId:integer, url",
        CarFeature="*id:integer, carId:integer, name",
        Wide="*id, carId, a, b, c, d",
    )
    links = references(
        ("Image", "carId", "Car", "id"), ("CarFeature", "carId", "Car", "id"),
        ("Wide", "carId", "Car", "id"), ("Gone", "carId", "Car", "id"),
    )
    found = matching.relation_suggestions(frame, links).collect()
    assert {(r.child_table, r.foreign_key, r.relation_type, r.confidence) for r in found} == {
        ("Image", "carId", "images", "high"), ("CarFeature", "carId", "features", "medium"),
        ("Wide", "carId", "generic", "low"),
    }
    assert matching.relation_suggestions(frame, references()).count() == 0


def test_unmapped_and_text_candidates(columns):
    frame = columns(t="*key:int, title, notes, updated_at, tenant_id, size:int", u="id, note:char")
    names = {(r.table_name, r.column_name) for r in matching.unmapped_columns(frame).collect()}
    assert names == {("t", "notes"), ("t", "size"), ("u", "note")}
    names = {(r.table_name, r.column_name) for r in matching.text_candidates(frame).collect()}
    assert names == {("t", "title"), ("t", "notes"), ("t", "updated_at"), ("t", "tenant_id"), ("u", "id")}


@pytest.fixture
def meta_multi(columns, references):
    frame = columns(
        Car="*id:integer, title, name, makeEn, brand, price:numeric, year:int, isActive:boolean, "
        "deletedAt:timestamp, updatedAt:timestamp, ownerId:int",
        Image="*id:integer, carId:integer, url, alt",
        Photo="*id:integer, carId:integer, src",
        Feature="*id:integer, carId:integer, featureName, value, extra",
        Wide="*id:integer, carId:integer, a, b, c, d",
        Bare="carId:integer",
    )
    links = references(
        ("Image", "carId", "Car", "id"), ("Photo", "carId", "Car", "id"),
        ("Feature", "carId", "Car", "id"), ("Wide", "carId", "Car", "id"),
        ("Car", "ownerId", "Car", "id"), ("Bare", "carId", "Car", "id"),
    )
    return frame, links


def test_specs(meta_multi, tmp_path):
    specs = matching.resource_specs(*meta_multi)
    found = {r.table_name: json.loads(r.spec) for r in specs.collect()}
    car = found["Car"]
    assert car["table"] == "Car" and car["idColumn"] == "id" and car["updatedAtColumn"] == "updatedAt"
    assert car["baseFilter"] == '"isActive" = true AND "deletedAt" IS NULL'
    assert car["fields"] == {"externalId": "id", "title": "name", "price": "price"}
    assert list(car["fields"]) == ["externalId", "title", "price"]
    assert car["attributes"] == {"make": "brand", "year": "year"}
    assert car["searchableColumns"] == ["title", "name", '"makeEn"', "brand"]
    assert car["filterableColumns"] == {
        "make": {"column": "brand", "type": "string"},
        "minPrice": {"column": "price", "type": "gte"},
        "maxPrice": {"column": "price", "type": "lte"},
        "year": {"column": "year", "type": "number"},
    }
    assert set(car["relations"]) == {"images", "Feature", "Bare"}
    assert car["relations"]["images"] == {
        "table": "Photo", "foreignKey": '"carId"', "referenceKey": "id", "fields": {"src": "src"},
        "imageUrlField": "src",
    }
    assert car["relations"]["Feature"] == {
        "table": "Feature", "foreignKey": '"carId"', "referenceKey": "id",
        "fields": {"featureName": '"featureName"', "value": "value", "extra": "extra"},
        "flatten": "featureName",
    }
    assert car["relations"]["Bare"]["fields"] == {}
    assert found["Bare"] == {"table": "Bare", "idColumn": "id", "fields": {"externalId": "id"}}
    assert ResourceSpec.from_dict(car).relations["images"].image_url_field == "src"
    matching.write_specs(specs, str(tmp_path / "specs"))
    assert specs.sparkSession.read.json(str(tmp_path / "specs")).count() == len(found)


def test_a_matched_spec_runs(spark, meta_multi):
    spec = ResourceSpec.from_json(
        matching.resource_specs(*meta_multi).where("table_name = 'Car'").first().spec
    )
    car = spark.sql(
        "SELECT 1 AS id, 't' AS title, 'n' AS name, 'm' AS makeEn, 'b' AS brand, 5 AS price, 2020 AS year, "
        "true AS isActive, CAST(NULL AS timestamp) AS deletedAt, TIMESTAMP '2026-01-01' AS updatedAt, 1 AS ownerId"
    )
    children = {
        "Photo": spark.sql("SELECT 1 AS id, 1 AS carId, 'p.jpg' AS src"),
        "Feature": spark.sql("SELECT 1 AS id, 1 AS carId, 'ABS' AS featureName, 'v' AS value, '' AS extra"),
        "Bare": spark.sql("SELECT 1 AS carId"),
    }
    (item,) = Catalog(spec, car, children).items().collect()
    assert (item.title, item.price, item.images) == ("n", 5.0, ["p.jpg"])
    assert item.attributes.make == "b" and item.attributes.Feature == ["ABS"]
