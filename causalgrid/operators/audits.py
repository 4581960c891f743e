"""Counts and rates that tell whether the data can be trusted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from causalgrid.operators.chunks import CHUNK, POS, Grid, chunk_edges
from causalgrid.operators.keys import null_safe_join


def coverage(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ("zone",), warn_below: float = 80.0) -> DataFrame:
    """Per key and column: share of known values, rows before the first one, and a warning."""
    stats = df.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        *[F.count(c).alias(f"k_{c}") for c in columns],
        *[F.min(F.when(F.col(c).isNotNull(), F.col("timestamp_utc"))).alias(f"f_{c}") for c in columns],
    )
    entry = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"k_{c}").alias("known"), F.col(f"f_{c}").alias("first_known_utc")) for c in columns])
    long = stats.select(*by, "n_rows", F.inline(entry))
    pct = 100.0 * F.col("known") / F.col("n_rows")
    return long.select(*by, "column", "first_known_utc", pct.alias("coverage_pct"), (pct < warn_below).alias("is_low"))


def rows_before_first(df: DataFrame, column: str, by: Sequence[str] = ("zone",)) -> DataFrame:
    """How many rows of a key lie before its first known value."""
    first = df.groupBy(*by).agg(F.min(F.when(F.col(column).isNotNull(), F.col("timestamp_utc"))).alias("_first"))
    counted = df.groupBy(*by, "timestamp_utc").agg(F.count("*").alias("_n"))
    joined = counted.join(F.broadcast(first) if not by else first, list(by), "left")
    early = F.col("_first").isNull() | (F.col("timestamp_utc") < F.col("_first"))
    return joined.groupBy(*by).agg(F.coalesce(F.sum(F.when(early, F.col("_n"))), F.lit(0)).alias("rows_before_first"))


def gap_audit(df: DataFrame, grid: Grid) -> DataFrame:
    """Steps of more than one and a half units, the largest step, and the rows a full grid lacks.

    Copies of a timestamp are counted together first, and all times of one step of the grid become one row: its first and last time and the
    longest way between two. Steps are taken inside chunks of such rows, so data finer than the grid makes no chunk longer; the step into a
    chunk comes from the edge of the ones before.
    """
    placed = grid.placed(df.groupBy(*grid.keys, grid.ts).agg(F.count("*").alias("_copies")))
    here = Window.partitionBy(*grid.keys, CHUNK, POS).orderBy(grid.ts)
    micros = F.unix_micros(F.col(grid.ts))
    ways = placed.withColumn("_inside", micros - F.lag(micros).over(here))
    per_step = ways.groupBy(*grid.keys, CHUNK, POS).agg(
        F.sum("_copies").alias("_copies"), F.count("*").alias("_times"), F.max("_inside").alias("_inside"), F.min(micros).alias("_first"), F.max(micros).alias("_last")
    )
    edges = chunk_edges(per_step, grid.keys, before={"_edge": F.col("_last")})
    w = Window.partitionBy(*grid.keys, CHUNK).orderBy(POS)
    joined = null_safe_join(per_step, edges, [*grid.keys, CHUNK], "left")
    before = F.col("_first") - F.coalesce(F.lag("_last").over(w), F.col("_edge"))
    steps = joined.withColumn("_before", before)
    unit = grid.step_micros
    return steps.groupBy(*grid.keys).agg(
        F.sum("_copies").alias("n_rows"),
        F.count_if(F.col("_before") / unit > 1.5).alias("n_gaps"),
        (F.max(F.greatest("_before", "_inside")) / unit).alias("largest_gap_h"),
        (F.floor((F.max("_last") - F.min("_first")) / unit) + 1 - F.sum("_times")).alias("implicit_gap_hours"),
    )


def flag_rates(df: DataFrame, flags: Sequence[str], by: Sequence[str] = ("zone",), warn_above: float = 5.0) -> DataFrame:
    """Per key: how many rows carry each flag, in percent."""
    rate = {f: 100.0 * F.avg(F.coalesce(F.col(f), F.lit(False)).cast("double")) for f in flags}
    out = df.groupBy(*by).agg(F.count("*").alias("n_rows"), *[r.alias(f"{f}_pct") for f, r in rate.items()])
    if "is_quarantined" in flags:
        out = out.withColumn("is_high", F.col("is_quarantined_pct") > warn_above)
    return out


def unmapped_codes(zoned: DataFrame, code: str = "kommunkod", zone: str = "bidding_zone") -> DataFrame:
    """Codes without a zone and how many rows they hold."""
    return zoned.where(F.col(zone).isNull()).groupBy(code).agg(F.count("*").alias("n_rows"))


def ingest_report(parsed: DataFrame, reason: str = "reject_reason", different: Sequence[str] = ()) -> DataFrame:
    """Accepted and rejected records by reason; ``accepted`` is the row without a reason.

    Of ``different`` columns, such as municipality and quarter, the number of values follows.
    """
    counts = [F.countDistinct(c).alias(f"n_{c}") for c in different]
    return parsed.groupBy(F.coalesce(reason, F.lit("accepted")).alias("outcome")).agg(F.count("*").alias("n"), *counts)


def rate_changes(rates: DataFrame, on: str = "effective_date_utc", value: str = "policy_rate_pct") -> DataFrame:
    """Dates on which the national rate differs from the one before.

    The last rate of a day counts, so the single ordered window has a row per calendar day at most.
    """
    of_day = rates.groupBy(F.to_date(on)).agg(F.max(F.struct(on, value)).alias("_last"))
    daily = of_day.select(F.col("_last")[on].alias(on), F.col("_last")[value].alias(value))
    before = F.lag(value).over(Window.orderBy(on))
    changed = daily.withColumn("previous_rate_pct", before).where(F.col("previous_rate_pct") != F.col(value))
    return changed.withColumn("delta_pct", F.col(value) - F.col("previous_rate_pct"))


def rate_summary(rates: DataFrame, value: str = "policy_rate_pct") -> DataFrame:
    return rates.agg(
        F.count("*").alias("n_observations"),
        F.min("effective_date_utc").alias("first_utc"),
        F.max("effective_date_utc").alias("last_utc"),
        F.min(value).alias("min_rate_pct"),
        F.max(value).alias("max_rate_pct"),
    )
