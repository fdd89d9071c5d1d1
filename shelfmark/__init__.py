"""Catalog query and mapping engine on Spark DataFrames."""

from shelfmark.catalog import Catalog
from shelfmark.plans.request import LogRequest, PageRequest
from shelfmark.plans.spec import FilterSpec, RelationSpec, ResourceSpec

__all__ = [
    "Catalog",
    "FilterSpec",
    "LogRequest",
    "PageRequest",
    "RelationSpec",
    "ResourceSpec",
]
