from decimal import Decimal

import pytest

from shelfmark import FilterSpec, LogRequest, PageRequest, RelationSpec, ResourceSpec
from shelfmark.plans.request import Condition, number, page_number, page_size

SPEC = ResourceSpec(
    table="Car",
    id_column="id",
    updated_at_column="updatedAt",
    fields={"externalId": "id", "title": "title"},
    searchable_columns=("title", '"makeEn"'),
    filterable_columns={
        "year": FilterSpec("year", "number"),
        "make": FilterSpec('"makeEn"', "string"),
        "minPrice": FilterSpec("price", "gte"),
        "maxPrice": FilterSpec("price", "lte"),
    },
)


def test_defaults():
    request = PageRequest.parse(SPEC, {})
    assert (request.page, request.page_size, request.offset) == (1, 20, 0)
    assert (request.sort_by, request.ascending) == ("updatedAt", False)
    assert request.conditions == ()


@pytest.mark.parametrize(
    "text, page, size",
    [
        (None, 1, 20), ("3", 3, 3), ("0", 1, 20), ("-5", 1, 1), ("200", 200, 100),
        ("12abc", 12, 12), ("x", 1, 20), (" 7 ", 7, 7), ("", 1, 20),
    ],
)
def test_page_and_size(text, page, size):
    assert page_number(text) == page
    assert page_size(text) == size


def test_search_is_a_condition_per_column():
    request = PageRequest.parse(SPEC, {"search": "Hyundai"})
    assert request.conditions == (
        Condition("title", "ILIKE", "Hyundai"),
        Condition('"makeEn"', "ILIKE", "Hyundai"),
    )


@pytest.mark.parametrize(
    "params, expected",
    [
        ({"filter.make": "Toyota"}, [Condition('"makeEn"', "=", "Toyota")]),
        ({"filter.year": "2024"}, [Condition("year", "=", 2024)]),
        (
            {"filter.minPrice": "10000", "filter.maxPrice": "50000"},
            [Condition("price", ">=", 10000), Condition("price", "<=", 50000)],
        ),
        ({"filter.make": "", "filter.other": "1", "search": ""}, []),
    ],
)
def test_filters(params, expected):
    assert PageRequest.parse(SPEC, params).conditions == tuple(expected)


def test_a_filter_that_is_no_number_is_refused():
    with pytest.raises(ValueError, match="not a number"):
        PageRequest.parse(SPEC, {"filter.year": "abc"})


@pytest.mark.parametrize(
    "text, value", [("7", 7), ("7.0", 7), ("7.5", Decimal("7.5")), ("1e3", 1000), (" -2 ", -2), (".5", Decimal(".5"))]
)
def test_numbers(text, value):
    assert number(text) == value and type(number(text)) is type(value)


@pytest.mark.parametrize("text", ["nan", "inf", "1_000", "0x10", "1,5", ""])
def test_not_numbers(text):
    with pytest.raises(ValueError):
        number(text)


def test_updated_since_needs_a_column():
    since = {"updatedSince": "2026-01-01T00:00:00Z"}
    assert PageRequest.parse(SPEC, since).updated_since == "2026-01-01T00:00:00Z"
    bare = ResourceSpec(table="t", id_column="id", fields={})
    assert PageRequest.parse(bare, since).updated_since is None
    assert PageRequest.parse(bare, {}).sort_by == "id"


@pytest.mark.parametrize("direction, ascending", [("asc", True), ("ASC", False), ("desc", False)])
def test_sort(direction, ascending):
    request = PageRequest.parse(SPEC, {"sortBy": "price", "sortDirection": direction})
    assert (request.sort_by, request.ascending) == ("price", ascending)


def test_log_request():
    assert LogRequest.parse({}).page_size == 50
    request = LogRequest.parse({"page": "2", "pageSize": "500", "since": "2026"})
    assert (request.page, request.page_size, request.offset, request.since) == (2, 100, 100, "2026")


RAW = {
    "table": "Car",
    "idColumn": "id",
    "updatedAtColumn": "updatedAt",
    "baseFilter": "published = true",
    "fields": {"title": "title"},
    "attributes": {"year": "year"},
    "searchableColumns": ["title"],
    "filterableColumns": {"year": {"column": "year", "type": "number"}},
    "relations": {
        "images": {
            "table": "Image",
            "foreignKey": '"carId"',
            "referenceKey": "id",
            "fields": {"url": "url"},
            "imageUrlField": "url",
            "filter": "type = 'gallery'",
        }
    },
}


def test_spec_from_dict():
    spec = ResourceSpec.from_dict(RAW)
    assert spec.filterable_columns["year"] == FilterSpec("year", "number")
    assert spec.relations["images"] == RelationSpec(
        "Image", '"carId"', {"url": "url"}, "id", "url", None, "type = 'gallery'"
    )


@pytest.mark.parametrize(
    "change",
    [
        {"table": ""},
        {"idColumn": None},
        {"fields": None},
        {"fields": {"title": 3}},
        {"filterableColumns": {"year": {"column": "year", "type": "like"}}},
        {"relations": {"images": {"table": "Image", "foreignKey": "x", "fields": {"a": "a"}}}},
        {"searchableColumns": [1]},
    ],
)
def test_bad_specs_are_refused(change):
    with pytest.raises(ValueError):
        ResourceSpec.from_dict(RAW | change)


def test_pages_are_clamped_however_they_are_made():
    request = PageRequest(page=-3, page_size=10**6)
    assert (request.page, request.page_size) == (1, 100)
