"""Registered queries: every operator on the driver's tables, with its SQL form beside it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


class Tables:
    """The tables of one folder, read when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function of Tables under a name."""

    def add(f):
        _QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            _SQL[name] = sql
        return f

    return add


def _load() -> None:
    from abundara.plans import files, more, profiles, relational, statistics  # noqa: F401  they register on import


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-gene abundances: fractional, unique and redistributed, length-normalised and scaled."""
    return queries()["profile_gene"](spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
