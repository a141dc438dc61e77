"""Registered queries of the core operators, with the SQL that defines each result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import corpus, listings, records, streams

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {**corpus.QUERIES, **records.QUERIES, **listings.QUERIES, **streams.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {**corpus.SQL, **records.SQL, **listings.SQL, **streams.SQL}
