"""The catalog: one main table and its children, seen through a resource spec."""

from __future__ import annotations

import json
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from shelfmark.functions.columns import as_text, backtick, column, column_name, column_type, literal_text
from shelfmark.functions.predicates import compare, select_rows, where
from shelfmark.operators import lookup as lookups
from shelfmark.operators.items import item_columns, item_json
from shelfmark.operators.rankindex import RankIndex
from shelfmark.operators.ranking import cut_page, order_by, rank_rows, sortable, sorted_by
from shelfmark.operators.relations import (
    ARRAY_ROWS,
    PART,
    PARTS,
    children_of,
    children_of_page,
    with_children,
)
from shelfmark.operators.textindex import BLOCK_ROWS, TextIndex
from shelfmark.plans.request import Condition, PageRequest
from shelfmark.plans.spec import RelationSpec, ResourceSpec
from shelfmark.session import store

# The item fields a spec may map a column to.
ITEM_FIELDS = ("title", "price", "currency", "category", "status")


class Catalog:
    """Queries over ``main``, enriched from ``children`` (by table name)."""

    def __init__(
        self,
        spec: ResourceSpec,
        main: DataFrame,
        children: Mapping[str, DataFrame] | None = None,
        array_rows: int = ARRAY_ROWS,
    ):
        self.spec = spec
        self.main = main
        self.children = dict(children or {})
        self.array_rows = array_rows
        self.relations = _shown_relations(spec)
        self.columns = self._required_columns()
        missing = {r.table for r in spec.relations.values()} - self.children.keys()
        if missing:
            raise ValueError(f"no source for child tables {sorted(missing)}")
        declared = [f.column for f in spec.filterable_columns.values()]
        for reference in [*declared, *spec.searchable_columns]:
            column_name(main.schema, reference)

    @property
    def spark(self) -> SparkSession:
        return self.main.sparkSession

    def _required_columns(self) -> list[str]:
        """The main-table columns an item is made of, each once."""
        spec = self.spec
        mapped = [spec.fields[f] for f in ITEM_FIELDS if f in spec.fields]
        references = [
            spec.id_column,
            *([spec.updated_at_column] if spec.updated_at_column else []),
            *(e for e in [*mapped, *spec.attributes.values()] if literal_text(e) is None),
            *(r.reference_key for r in self.relations.values() if r.reference_key),
        ]
        return list(dict.fromkeys(column_name(self.main.schema, r) for r in references))

    def request(self, params: Mapping[str, str] | None = None) -> PageRequest:
        return PageRequest.parse(self.spec, params)

    def rows(self, request: PageRequest | None = None) -> DataFrame:
        """All main rows a request matches, unsorted and unpaged."""
        return select_rows(self.main, self.spec, request or self.request())

    def _ordered(self, request: PageRequest):
        """The matching rows, narrowed to item and sort columns, and the sort columns."""
        keys = order_by(self.main, request.sort_by, request.ascending, self.spec.id_column)
        columns = list(dict.fromkeys([*self.columns, *(name for name, _ in keys)]))
        return self.rows(request).select(*self._quoted(columns)), keys

    def page_rows(self, request: PageRequest) -> DataFrame:
        """The main rows of one page, in order."""
        rows, keys = self._ordered(request)
        return cut_page(rows, keys, request.offset, request.page_size)

    def _about(self, request: PageRequest) -> dict:
        """What the order of a request's rows hangs on, whatever its page."""
        return {
            "table": self.spec.table, "id": self.spec.id_column, "base": self.spec.base_filter,
            "conditions": [str(c) for c in request.conditions], "since": request.updated_since,
            "sort": request.sort_by, "ascending": request.ascending, "columns": self.columns,
        }

    def index_pages(self, path: str, request: PageRequest | None = None) -> RankIndex:
        """Order the rows of a request once and keep them in ``path``, for pages and ranks of any depth.

        It shows the table as it was; ``RankIndex.open`` opens it again.
        """
        request = request or self.request()
        rows, keys = self._ordered(request)
        return RankIndex.build(rows, keys, path, self._about(request))

    def indexed_page(self, index: RankIndex, request: PageRequest | None = None) -> DataFrame:
        """As ``page``, from an index of the same rows and order: a deep page costs what the first one does."""
        request = request or self.request()
        if index.about != json.dumps(self._about(request), sort_keys=True):
            raise ValueError("the index is of another request")
        rows = index.cut(request.offset, request.page_size)
        return self._local_items(rows) if self.relations else self.items_of(rows)

    def index_text(self, path: str, block_rows: int = BLOCK_ROWS) -> TextIndex:
        """Keep the main rows in ``path``, in blocks, with an index of the searchable columns. It shows the table as it was."""
        return TextIndex.build(self.main, self.spec.searchable_columns, path, block_rows)

    def indexed_rows(self, index: TextIndex, request: PageRequest) -> DataFrame:
        """As ``rows``, of the table as it was indexed; a search reads only blocks that hold all of its runs of characters."""
        searches = {c.column: str(c.value) for c in request.conditions if c.operator == "ILIKE"}
        return select_rows(index.cut(searches), self.spec, request)

    def indexed_summary(self, index: RankIndex, request: PageRequest | None = None) -> DataFrame:
        """As ``summary``, from the sizes that the index knows."""
        request = request or self.request()
        pages = -(-index.total // request.page_size)
        return self.spark.createDataFrame(
            [(index.total, request.page, request.page_size, pages)], "total long, page int, page_size int, total_pages long"
        )

    def page(self, request: PageRequest | None = None) -> DataFrame:
        """One page of items with their children.

        The page itself is at most ``MAX_PAGE_SIZE`` rows: it is cut once and kept as a
        local relation, so that its keys can be pushed into the scans of the children.
        """
        rows = self.page_rows(request or self.request())
        return self._local_items(rows) if self.relations else self.items_of(rows)

    def item(self, id: str) -> DataFrame:
        """The item with an id, no row if there is none or the base filter hides it."""
        same = compare(self.main, Condition(self.spec.id_column, "=", id))
        rows = where(self.main, self.spec.base_filter, same).select(*self._quoted(self.columns))
        return self._local_items(rows.orderBy(*sortable(rows)).limit(1))

    def _local_items(self, rows: DataFrame) -> DataFrame:
        """Items of a bounded number of rows, in their order, each relation cut to their children."""
        page = rows.toArrow()
        cut = {}
        for name, relation in self.relations.items():
            reference = column_name(rows.schema, relation.reference_key or self.spec.id_column)
            keys = {key for key in page.column(reference).to_pylist() if key is not None}
            kind = rows.schema[reference].dataType
            cut[name] = children_of_page(relation, self._child(name), sorted(keys), kind)
        place = "position"
        while place in rows.columns:
            place += "_"
        page = page.append_column(place, pa.array(range(page.num_rows), pa.int32()))
        local = self.spark.createDataFrame(page, StructType([*rows.schema, StructField(place, IntegerType())]))
        items = self.items_of(local, cut, keep={place: place})
        return items.orderBy(place, "part").drop(place)

    @staticmethod
    def _quoted(columns: list[str]) -> list[str]:
        return [backtick(c) for c in columns]

    def summary(self, request: PageRequest | None = None) -> DataFrame:
        """Total, page, page size and page count of a request, from the same rows."""
        request = request or self.request()
        return page_summary(self.rows(request), request.page, request.page_size)

    def items(self, request: PageRequest | None = None) -> DataFrame:
        """Every matching item with its children, unpaged and unsorted.

        The rows of a request with conditions are kept in the shared folder, and only
        their children are grouped. With a base filter alone a filter of the parents' keys is built
        and drops most other children where they are read.
        """
        request = request or self.request()
        rows = self.rows(request).select(*self._quoted(self.columns))
        if not self.relations or not (request.conditions or request.updated_since):
            return self.items_of(rows, filtered=bool(self.spec.base_filter))
        rows = store(rows, "narrowed")
        return self.items_of(rows, narrowed=True)

    def child_rows(self, relation: str, request: PageRequest | None = None) -> DataFrame:
        """The children of every matching item as rows: ``externalId`` and ``child``, one row each.

        Holds what the arrays of ``items`` hold together, in a form that no group's size changes.
        """
        rows = self.rows(request)
        id_column, found = self.spec.id_column, self.spec.relations[relation]
        identity = F.coalesce(as_text(column(rows, id_column), column_type(rows, id_column)), F.lit(""))
        return children_of(rows, found, self._child(relation), id_column, identity)

    def all_pages(self, request: PageRequest | None = None) -> DataFrame:
        """Every matching row with its rank and the page it is on."""
        request = request or self.request()
        rows, keys = self._ordered(request)
        if clash := {"rank", "page"} & {c.lower() for c in rows.columns}:
            raise ValueError(f"the rows have columns called {sorted(clash)} already")
        page = F.expr(f"(rank - 1) div {request.page_size} + 1").cast("bigint")
        return rank_rows(rows, sorted_by(keys)).withColumn("page", page)

    def lookup(self, ids: DataFrame) -> DataFrame:
        """The answer for every distinct id in ``ids`` (one column)."""
        return lookups.lookup(self, ids)

    def export(self, path: str, format: str = "parquet", request: PageRequest | None = None):
        """Write every matching item; ``json`` writes one item record per line."""
        items = self.items(request)
        if format == "json":
            items.select(item_json(items).alias("value")).write.text(path)
        else:
            items.write.format(format).save(path)

    def _child(self, name: str) -> DataFrame:
        return self.children[self.spec.relations[name].table]

    def items_of(
        self,
        rows: DataFrame,
        children: Mapping[str, DataFrame] | None = None,
        keep: Mapping[str, str] | None = None,
        narrowed: bool = False,
        filtered: bool = False,
    ) -> DataFrame:
        """Main rows as items, with ``children`` by relation (default: the whole child
        tables) and the main columns ``keep`` names. ``narrowed`` rows are a stored part
        of the main table, ``filtered`` ones a part by a filter."""
        sources = children or {name: self._child(name) for name in self.relations}
        enriched = with_children(
            rows, self.relations, sources, self.spec.id_column, self.array_rows, narrowed, filtered
        )
        kept = [F.col(backtick(c)).alias(alias) for alias, c in (keep or {}).items()]
        parts = [F.col(PART).alias("part"), F.col(PARTS).alias("parts")]
        return enriched.select(*kept, *item_columns(self.spec, enriched), *parts)


def _shown_relations(spec: ResourceSpec) -> dict[str, RelationSpec]:
    """The relations an item shows: of several image relations only the last."""
    pictured = [name for name, r in spec.relations.items() if r.image_url_field]
    return {n: r for n, r in spec.relations.items() if n not in pictured[:-1]}


def page_summary(rows: DataFrame, page: int, page_size: int) -> DataFrame:
    total = F.count(F.lit(1))
    return rows.agg(
        total.alias("total"),
        F.lit(page).alias("page"),
        F.lit(page_size).alias("page_size"),
        F.ceil(total / page_size).cast("bigint").alias("total_pages"),
    )
