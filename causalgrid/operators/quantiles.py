"""Exact quantiles per key without gathering a key's values in one place.

A sketch per key proposes splitters; exact counts between splitters tell which stretch holds the
wanted rank; only those stretches are ranked, each on its own. The sketch decides how much work
there is, never what comes out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from causalgrid.operators.keys import null_safe_join, with_facts
from causalgrid.session import materialize

STRETCHES = 128


def exact_quantiles(df: DataFrame, value: str, quantiles: Mapping[str, float], by: Sequence[str] = ("zone",)) -> DataFrame:
    """One row per key with a column per quantile, linear between the two nearest ranks.

    Equal values are counted together before anything is ranked. NULL values are left out; a NULL key is a key.
    """
    by = list(by)
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    counted = materialize(counted, "counted")  # read by the sketch, the counts and the ranks
    steps = [i / STRETCHES for i in range(1, STRETCHES)]
    splitters = counted.groupBy(*by).agg(F.percentile_approx("_v", steps, 10_000).alias("_split"))
    # one row per key on the right: sent to the values where keys are few, so that a hot key's values stay where they are
    placed = with_facts(counted, splitters, by).select(
        *by, "_v", "_n", F.size(F.filter("_split", lambda s: s < F.col("_v"))).alias("_stretch")
    )
    per_stretch = placed.groupBy(*by, "_stretch").agg(F.sum("_n").alias("_rows"))
    order, whole = Window.partitionBy(*by).orderBy("_stretch"), Window.partitionBy(*by)
    before = F.coalesce(F.sum("_rows").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    located = per_stretch.select(*by, "_stretch", "_rows", before.alias("_before"), F.sum("_rows").over(whole).alias("_total"))

    wanted = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(q)).alias("q")) for n, q in quantiles.items()])
    rank = (F.col("_total") - 1) * F.col("q")
    targets = located.select("*", F.inline(wanted)).select("*", F.floor(rank).alias("_lo"), F.ceil(rank).alias("_hi"), rank.alias("_rank"))
    ends = F.array_distinct(F.array("_lo", "_hi"))
    targets = targets.withColumn("_at", F.explode(ends))
    targets = targets.where((F.col("_at") >= F.col("_before")) & (F.col("_at") < F.col("_before") + F.col("_rows")))

    hit = null_safe_join(placed, targets.select(*by, "_stretch", "_before").distinct(), [*by, "_stretch"])
    up = Window.partitionBy(*by, "_stretch").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = hit.select(*by, "_stretch", "_v", "_n", (F.col("_before") + F.sum("_n").over(up)).alias("_until"))
    found = null_safe_join(ranked, targets.drop("_before", "_rows", "_total"), [*by, "_stretch"])
    found = found.where((F.col("_at") < F.col("_until")) & (F.col("_at") >= F.col("_until") - F.col("_n")))
    pairs = found.groupBy(*by, "name").agg(
        F.min_by("_v", "_at").alias("_a"), F.max_by("_v", "_at").alias("_b"), F.max(F.col("_rank") - F.col("_lo")).alias("_w")
    )
    drawn = F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_w")
    return pairs.groupBy(*by).agg(*[F.max(F.when(F.col("name") == n, drawn)).alias(n) for n in quantiles])
