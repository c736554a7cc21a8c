"""All queries of the library's own operators, and their SQL."""

from __future__ import annotations

from frameloom.plans import file_queries, image_queries, long_queries, record_queries, score_queries


def queries() -> dict:
    return score_queries.QUERIES | record_queries.QUERIES | image_queries.QUERIES | long_queries.QUERIES | file_queries.QUERIES


def oracle_sql() -> dict[str, str]:
    return score_queries.SQL | record_queries.SQL | image_queries.SQL | long_queries.SQL | file_queries.SQL
