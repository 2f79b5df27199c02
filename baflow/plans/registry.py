"""Registry of named queries: a Spark callable and, where SQL can say it, a DuckDB twin.

Double columns listed in ``doubles`` are rounded to 6 digits on both sides (FIXTURES.md §2: exact
percentiles and sums differ in the last bit between engines).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from baflow.plans.fixture_sql import with_views


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    doubles: tuple[str, ...] = field(default_factory=tuple)
    headline: bool = False


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, doubles=(), ctes=None, headline: bool = False):
    def deco(fn):
        full = with_views(sql, ctes) if sql else None
        REGISTRY[name] = Query(name, fn, full, tuple(doubles), headline)
        return fn
    return deco


def round6(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols}) if cols else df


def spark_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    q = REGISTRY[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from baflow.session import ship_package
        ship_package(spark)
        return round6(q.build(spark, sf_dir), q.doubles)
    return run


def oracle_query(name: str) -> str | None:
    q = REGISTRY[name]
    if q.sql is None:
        return None
    if not q.doubles:
        return q.sql
    repl = ", ".join(f"round({c}, 6) AS {c}" for c in q.doubles)
    return f"SELECT * REPLACE ({repl}) FROM (\n{q.sql}\n) AS q"
