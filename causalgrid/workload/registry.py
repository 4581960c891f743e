"""The list of runnable queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from causalgrid.session import pin_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

MODULES = ("cleaning", "validation", "sources", "sinks", "joins", "rollups", "series", "features", "scoring", "models", "landing")


def query(sql: str | None = None, doubles: str = "", digits: int = 6):
    """Register a query under its function's name.

    Doubles are rounded and timestamps are given without zone, so that results can be compared
    by value; the SQL is wrapped to round the columns listed in ``doubles`` the same way.
    """

    def register(fn):
        key = fn.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            pin_utc(spark)
            return comparable(fn(spark, sf_dir), digits)

        run.__name__, run.__doc__ = key, fn.__doc__
        if key in QUERIES:
            raise ValueError(f"two queries are called {key}")
        QUERIES[key] = run
        if sql is not None:
            rounds = ", ".join(f"round({c} + {nudge(digits)!r}, {digits}) + 0.0 as {c}" for c in doubles.split())
            ORACLE[key] = f"select * replace ({rounds}) from ({sql})" if rounds else sql
        return fn

    return register


def nudge(digits: int) -> float:
    """Moves exact halves, which two engines may round to different sides, off the edge."""
    return 10.0 ** -(digits + 3)


def comparable(df: DataFrame, digits: int) -> DataFrame:
    def one(name: str, kind: str) -> str:
        c = f"`{name}`"
        if kind == "double":
            # + 0.0 turns a negative zero into zero
            return f"round({c} + double({nudge(digits)!r}), {digits}) + 0D as {c}"
        return f"cast({c} as timestamp_ntz) as {c}" if kind == "timestamp" else c

    return df.selectExpr(*[one(n, k) for n, k in df.dtypes])


def load_all() -> None:
    for module in MODULES:
        import_module(f"causalgrid.workload.{module}")
