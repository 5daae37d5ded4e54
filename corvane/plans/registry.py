"""Name -> (builder, SQL) for every query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

_builders: dict[str, Builder] = {}
_sql: dict[str, str] = {}


def plan(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    """Registers a builder; ``sql`` is the same result for another engine."""

    def keep(builder: Builder) -> Builder:
        _builders[name] = builder
        if sql is not None:
            _sql[name] = sql
        return builder

    return keep


def queries() -> dict[str, Builder]:
    return dict(_builders)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")
