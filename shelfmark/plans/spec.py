"""Declarative mapping of one main table and its children to catalog items."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

FILTER_KINDS = ("string", "number", "gte", "lte")


def _required(raw: Mapping, key: str, where: str) -> str:
    value = raw.get(key)
    if not isinstance(value, str) or not value:
        raise ValueError(f"{where}: '{key}' must be a non-empty string")
    return value


def _optional(raw: Mapping, key: str, where: str) -> str | None:
    value = raw.get(key)
    if value is not None and not isinstance(value, str):
        raise ValueError(f"{where}: '{key}' must be a string")
    return value


def _strings(raw: Mapping, key: str, where: str, needed: bool = False) -> dict[str, str]:
    value = raw.get(key)
    if value is None and not needed:
        return {}
    if not isinstance(value, Mapping) or not all(isinstance(v, str) for v in value.values()):
        raise ValueError(f"{where}: '{key}' must map names to strings")
    return dict(value)


@dataclass(frozen=True)
class FilterSpec:
    """A request parameter that filters on ``column``."""

    column: str
    kind: str

    def __post_init__(self):
        if not self.column:
            raise ValueError("a filter needs a column")
        if self.kind not in FILTER_KINDS:
            raise ValueError(f"unknown filter type '{self.kind}', use one of {FILTER_KINDS}")


@dataclass(frozen=True)
class RelationSpec:
    """A one-to-many child table. ``fields`` maps an alias to an SQL expression."""

    table: str
    foreign_key: str
    fields: Mapping[str, str]
    reference_key: str | None = None
    image_url_field: str | None = None
    flatten: str | None = None
    filter: str | None = None

    def __post_init__(self):
        if not self.table or not self.foreign_key:
            raise ValueError("a relation needs a table and a foreign key")

    @property
    def picked_field(self) -> str | None:
        """The one field kept as a plain string array, if the relation has one."""
        return self.image_url_field or self.flatten


@dataclass(frozen=True)
class ResourceSpec:
    """What a catalog is: its table, its keys and how columns become item fields."""

    table: str
    id_column: str
    fields: Mapping[str, str]
    updated_at_column: str | None = None
    base_filter: str | None = None
    attributes: Mapping[str, str] = field(default_factory=dict)
    searchable_columns: tuple[str, ...] = ()
    filterable_columns: Mapping[str, FilterSpec] = field(default_factory=dict)
    relations: Mapping[str, RelationSpec] = field(default_factory=dict)

    def __post_init__(self):
        if not self.table or not self.id_column:
            raise ValueError("a resource needs a table and an id column")

    @classmethod
    def from_dict(cls, raw: Mapping) -> ResourceSpec:
        """Read the camelCase form that specs are stored in."""
        table = _required(raw, "table", "resource")
        searchable = raw.get("searchableColumns") or []
        if not all(isinstance(c, str) for c in searchable):
            raise ValueError("resource: 'searchableColumns' must be strings")
        filters = {
            name: FilterSpec(_required(f, "column", f"filter {name}"), f.get("type"))
            for name, f in (raw.get("filterableColumns") or {}).items()
        }
        relations = {
            name: RelationSpec(
                table=_required(r, "table", f"relation {name}"),
                foreign_key=_required(r, "foreignKey", f"relation {name}"),
                reference_key=_required(r, "referenceKey", f"relation {name}"),
                fields=_strings(r, "fields", f"relation {name}", needed=True),
                image_url_field=_optional(r, "imageUrlField", f"relation {name}"),
                flatten=_optional(r, "flatten", f"relation {name}"),
                filter=_optional(r, "filter", f"relation {name}"),
            )
            for name, r in (raw.get("relations") or {}).items()
        }
        return cls(
            table=table,
            id_column=_required(raw, "idColumn", "resource"),
            fields=_strings(raw, "fields", "resource", needed=True),
            updated_at_column=_optional(raw, "updatedAtColumn", "resource"),
            base_filter=_optional(raw, "baseFilter", "resource"),
            attributes=_strings(raw, "attributes", "resource"),
            searchable_columns=tuple(searchable),
            filterable_columns=filters,
            relations=relations,
        )

    @classmethod
    def from_json(cls, text: str) -> ResourceSpec:
        return cls.from_dict(json.loads(text))
