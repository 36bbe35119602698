"""Registry of the named queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sightline.plans import consensus, deliveries, files_and_streams, phrases, relations

Query = Callable[[SparkSession, str], DataFrame]
_MODULES = [consensus, relations, phrases, deliveries, files_and_streams]


def queries() -> dict[str, Query]:
    return {f.__name__: f for m in _MODULES for f in m.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in _MODULES for k, v in m.SQL.items()}
