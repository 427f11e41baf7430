"""Every query of the library by name, with the SQL that checks it where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from harrow.plans import brief_queries, log_queries, page_queries, record_queries, source_queries

_ALL = page_queries.QUERIES | record_queries.QUERIES | log_queries.QUERIES | brief_queries.QUERIES | source_queries.QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run for name, (run, _) in _ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _ALL.items() if sql}
