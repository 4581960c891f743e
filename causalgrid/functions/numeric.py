"""Number hygiene: NULL is the only kind of missing value inside this library."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Bounds for every feature.
CLIP_LOWER, CLIP_UPPER = -1e9, 1e9


def finite(c: Column) -> Column:
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def clipped(c: Column, lower: float = CLIP_LOWER, upper: float = CLIP_UPPER) -> Column:
    # least and greatest skip NULL, which would turn a missing value into a bound
    return F.when(c.isNotNull(), F.greatest(F.least(c, F.lit(upper)), F.lit(lower)))


def sanitised(c: Column, lower: float = CLIP_LOWER, upper: float = CLIP_UPPER, fill: float | None = None) -> Column:
    out = clipped(finite(c), lower, upper)
    return out if fill is None else F.coalesce(out, F.lit(fill))


def sanitised_sql(name: str, lower: float = CLIP_LOWER, upper: float = CLIP_UPPER, fill: float | None = None) -> str:
    """``sanitised`` as SQL: for tables with a hundred such columns, text is quicker to hand over."""
    c = f"`{name}`"
    within = f"greatest(least({c}, double({upper!r})), double({lower!r}))"
    out = f"if(not isnan({c}) and abs({c}) != double('Infinity'), {within}, null)"
    return out if fill is None else f"coalesce({out}, double({fill!r}))"


def ratio(a: Column, b: Column) -> Column:
    """``a / b``; NULL where ``b`` is zero."""
    return F.try_divide(a, b)


def double_columns(df: DataFrame) -> list[str]:
    return [c for c, kind in df.dtypes if kind in ("double", "float")]


def sanitise(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    lower: float = CLIP_LOWER,
    upper: float = CLIP_UPPER,
    fill: float | None = None,
    observe: Observation | None = None,
) -> DataFrame:
    """Infinity to NULL, then clip, then fill, for all given or all floating-point columns.

    With ``observe`` the number of values touched by each step is counted on the way.
    """
    chosen = [c for c in (columns if columns is not None else double_columns(df)) if c in df.columns]
    if observe is not None and chosen:
        df = df.observe(observe, *_counts(chosen, lower, upper))
    return df.selectExpr(*[f"{sanitised_sql(c, lower, upper, fill)} as `{c}`" if c in chosen else f"`{c}`" for c in df.columns])


def _counts(columns: Sequence[str], lower: float, upper: float) -> list[Column]:
    def total(test) -> Column:
        return sum((F.count_if(test(F.col(c))) for c in columns[1:]), F.count_if(test(F.col(columns[0]))))

    inf = float("inf")
    return [
        total(lambda c: F.abs(c) == inf).alias("infinite"),
        total(lambda c: ((c < lower) | (c > upper)) & (F.abs(c) != inf) & ~F.isnan(c)).alias("clipped"),
        total(lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == inf)).alias("missing"),
    ]


def sanitise_counts(df: DataFrame, columns: Sequence[str], lower: float = CLIP_LOWER, upper: float = CLIP_UPPER) -> DataFrame:
    return df.agg(*_counts(list(columns), lower, upper))
