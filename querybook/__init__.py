"""Registered queries over the driver's tables, each with the SQL it must agree with."""

from querybook import catalog_queries, children_queries, log_queries, metadata_queries
from querybook.registry import Query


def all_queries() -> dict[str, Query]:
    found = {}
    for module in (catalog_queries, children_queries, log_queries, metadata_queries):
        found |= module.BOOK.queries
    return found
