"""Requests: textual parameters made into typed values, with defaults and clamps."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from decimal import Decimal

from shelfmark.plans.spec import ResourceSpec

# Page sizes.
DEFAULT_PAGE_SIZE = 20
DEFAULT_LOG_PAGE_SIZE = 50
MAX_PAGE_SIZE = 100

_LEADING_INT = re.compile(r"\s*([+-]?\d+)")
_NUMBER = re.compile(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?")


def _whole(text: str | int | None, default: int) -> int:
    """The integer a text starts with; ``default`` for none and for zero."""
    found = _LEADING_INT.match(str(text)) if text is not None else None
    return (int(found.group(1)) if found else 0) or default


def page_number(text: str | int | None) -> int:
    return max(1, _whole(text, 1))


def page_size(text: str | int | None, default: int = DEFAULT_PAGE_SIZE) -> int:
    return min(MAX_PAGE_SIZE, max(1, _whole(text, default)))


def number(text: str | int | float) -> int | float | Decimal:
    """A filter value as a number: an int where it is whole, else exact where a decimal column can hold
    it, so that the column is compared with a literal of its type and the predicate reaches the scan."""
    stripped = str(text).strip()
    if not _NUMBER.fullmatch(stripped):
        raise ValueError(f"'{text}' is not a number")
    exact = Decimal(stripped)
    if exact == exact.to_integral_value() and abs(exact) < 2**63:
        return int(exact)
    digits = exact.as_tuple()
    return exact if digits.exponent >= -38 and len(digits.digits) <= 38 and exact.adjusted() < 20 else float(exact)


@dataclass(frozen=True)
class Condition:
    """``operator`` is one of ``= > < >= <= ILIKE``; ILIKE conditions are OR-ed."""

    column: str
    operator: str
    value: str | int | float | Decimal


@dataclass(frozen=True)
class PageRequest:
    """One catalog request against a spec."""

    conditions: tuple[Condition, ...] = ()
    updated_since: str | None = None
    page: int = 1
    page_size: int = DEFAULT_PAGE_SIZE
    sort_by: str = ""
    ascending: bool = False

    def __post_init__(self):
        object.__setattr__(self, "page", max(1, self.page))
        object.__setattr__(self, "page_size", min(MAX_PAGE_SIZE, max(1, self.page_size)))

    @property
    def offset(self) -> int:
        return (self.page - 1) * self.page_size

    @classmethod
    def parse(cls, spec: ResourceSpec, params: Mapping[str, str] | None = None) -> PageRequest:
        params = params or {}
        conditions = []
        for name, declared in spec.filterable_columns.items():
            value = params.get(f"filter.{name}")
            if value is None or value == "":
                continue
            operator = {"gte": ">=", "lte": "<="}.get(declared.kind, "=")
            typed = value if declared.kind == "string" else number(value)
            conditions.append(Condition(declared.column, operator, typed))
        if params.get("search"):
            conditions += [
                Condition(column, "ILIKE", params["search"]) for column in spec.searchable_columns
            ]
        return cls(
            conditions=tuple(conditions),
            updated_since=(params.get("updatedSince") or None) if spec.updated_at_column else None,
            page=page_number(params.get("page")),
            page_size=page_size(params.get("pageSize")),
            sort_by=params.get("sortBy") or spec.updated_at_column or spec.id_column,
            ascending=params.get("sortDirection") == "asc",
        )


@dataclass(frozen=True)
class LogRequest:
    """One request against the request log."""

    since: str | None = None
    page: int = 1
    page_size: int = DEFAULT_LOG_PAGE_SIZE

    def __post_init__(self):
        object.__setattr__(self, "page", max(1, self.page))
        object.__setattr__(self, "page_size", min(MAX_PAGE_SIZE, max(1, self.page_size)))

    @property
    def offset(self) -> int:
        return (self.page - 1) * self.page_size

    @classmethod
    def parse(cls, params: Mapping[str, str] | None = None) -> LogRequest:
        params = params or {}
        return cls(
            since=params.get("since") or None,
            page=page_number(params.get("page")),
            page_size=page_size(params.get("pageSize"), DEFAULT_LOG_PAGE_SIZE),
        )
