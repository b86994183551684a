"""Registration of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (load) -> DataFrame under its own name; ``load(name)`` reads a table."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def uniform(seed: str, key: str) -> str:
    """SQL for the seeded uniform number of a key."""
    return f"(('0x' || substr(sha256('{seed}|' || {key}), 1, 8))::BIGINT / 4294967296.0)"


#: SQL for the stripped text of ``x``.
STRIP = "trim({0}, ' ' || chr(10) || chr(9) || chr(13))"
