"""Joins by key in which NULL is a key like any other, and broadcasts behind a check of their size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from causalgrid.session import materialize

#: Rows of a side that may be sent to every executor; a row here is a key and some numbers.
FEW = 50_000


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``left`` with the other columns of ``right``; keys come from ``left``."""
    theirs = right.withColumnsRenamed({k: f"_their_{k}" for k in keys})
    same: Column = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_their_{k}")) for k in keys])
    joined = left.join(theirs, same, how)
    return joined.drop(*[f"_their_{k}" for k in keys])


def with_facts(left: DataFrame, facts: DataFrame, keys: Sequence[str], few: int = FEW) -> DataFrame:
    """``left`` with the columns of ``facts``, a table of one row a key: broadcast where it has few rows, so that ``left`` is not moved.

    Its rows are counted first; ``facts`` is written once and read for the count and the join.
    """
    stored = materialize(facts, "facts")
    return null_safe_join(left, F.broadcast(stored) if stored.count() <= few else stored, keys)
