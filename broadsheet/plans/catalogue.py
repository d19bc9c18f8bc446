"""All registered queries of the library."""

from __future__ import annotations

from broadsheet.plans import issue_queries, layout_queries, page_queries, reader_queries, text_queries, work_queries
from broadsheet.plans.registry import Query

MODULES = (text_queries, issue_queries, layout_queries, page_queries, reader_queries, work_queries)


def queries() -> dict[str, Query]:
    return {name: f for m in MODULES for name, f in m.register.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.register.sql.items()}
