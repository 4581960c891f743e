"""As-of joins: each left row sees the latest right row that was known by then.

Three ways, all exact:

* ``asof_join`` puts both sides into one sorted stream per (key, range of time) and carries the
  last right row over the borders. Ranges are parts of calendar chunks that hold about as many rows of both sides
  as a task should, however many there are in a chunk. Any size, any skew, no pairs of rows.
* ``asof_calendar`` is for national series with at most one value a day (policy rate, weekly
  reservoir level). Its broadcast map has one row per day between the first and last value, so
  its size is bounded by the calendar, not by the data.
* ``nearest_within`` is for a tolerance of at most half a step: an equi-join on the step.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from causalgrid.operators.chunks import CHUNK, DAY
from causalgrid.operators.keys import with_facts

_TS, _SIDE, _BUCKET, _RANGE = "_ts", "_side", "_bucket", "_range"
#: Parts of a chunk whose rows are counted; ranges begin at their borders.
BUCKETS = 4_096


@dataclass(frozen=True)
class Series:
    """The right side of an as-of join.

    ``on`` is the time the row became known. Rows of equal key and time are settled before the
    join: the greatest ``tiebreak``, then the greatest values, wins.
    """

    df: DataFrame
    on: str
    values: tuple[str, ...]
    tiebreak: tuple[str, ...] = ()
    rename: dict[str, str] = field(default_factory=dict)

    def settled(self, by: Sequence[str]) -> DataFrame:
        order = [F.col(c).alias(f"_t{i}") for i, c in enumerate(self.tiebreak)]
        vals = [F.col(v).alias(self.rename.get(v, v)) for v in self.values]
        known = self.df.where(F.col(self.on).isNotNull())
        out = known.groupBy(*by, F.col(self.on).alias(_TS)).agg(F.max(F.struct(*order, *vals)).alias("_row"))
        return out.select(*by, _TS, F.struct(F.col(_TS).alias("at"), *[F.col("_row")[n].alias(n) for n in self.names]).alias("_v"))

    @property
    def names(self) -> list[str]:
        return [self.rename.get(v, v) for v in self.values]


def _chunked(df: DataFrame, chunk_seconds: int) -> DataFrame:
    """Stretches of time, and the part of its stretch a row lies in."""
    width = chunk_seconds * 1_000_000
    since = f"pmod(unix_micros({_TS}), {width}L)"
    part = F.expr(f"cast(floor({since} / {width / BUCKETS!r}) as int)")
    return df.withColumns({CHUNK: F.expr(f"(unix_micros({_TS}) - {since}) div {width}L"), _BUCKET: part})


def _range_facts(both: DataFrame, by: Sequence[str], slots: Sequence[str], nearest: bool, rows_per_task: int) -> DataFrame:
    """One row per (key, chunk): its ranges of buckets, each with the last right rows before it, the first ones after it, and its shares.

    Ranges come from the counts of both sides together, so each has ``rows_per_task`` rows and one bucket more at most. Everything
    here works on one row a bucket, made by one aggregation.
    """
    last = [F.max(s).alias(f"_b{s}") for s in slots]
    first = [F.min(s).alias(f"_a{s}") for s in slots] if nearest else []
    per_bucket = both.groupBy(*by, CHUNK, _BUCKET).agg(F.count("*").alias("_n"), F.count_if(F.col(_SIDE) == 1).alias("_lefts"), *last, *first)
    so_far = Window.partitionBy(*by, CHUNK).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    number = F.floor(F.coalesce(F.sum("_n").over(so_far), F.lit(0)) / rows_per_task)
    per_range = per_bucket.withColumn(_RANGE, number).groupBy(*by, CHUNK, _RANGE).agg(
        F.min(_BUCKET).alias("start"),
        F.sum("_lefts").alias("_lefts"),
        *[F.max(f"_b{s}").alias(f"_b{s}") for s in slots],
        *([F.min(f"_a{s}").alias(f"_a{s}") for s in slots] if nearest else []),
    )
    order = Window.partitionBy(*by)
    earlier = order.orderBy(CHUNK, _RANGE).rowsBetween(Window.unboundedPreceding, -1)
    later = order.orderBy(F.col(CHUNK).desc(), F.col(_RANGE).desc()).rowsBetween(Window.unboundedPreceding, -1)
    ends = [F.last(f"_b{s}", ignorenulls=True).over(earlier).alias(f"_b{s}") for s in slots]
    if nearest:
        ends += [F.last(f"_a{s}", ignorenulls=True).over(later).alias(f"_a{s}") for s in slots]
    shares = F.greatest(F.lit(1), F.ceil(F.col("_lefts") / rows_per_task)).cast("int").alias("shares")
    edges = per_range.select(*by, CHUNK, _RANGE, "start", shares, *ends)
    one = F.struct(_RANGE, "start", "shares", *[f"_b{s}" for s in slots], *([f"_a{s}" for s in slots] if nearest else []))
    return edges.groupBy(*by, CHUNK).agg(F.sort_array(F.collect_list(one)).alias("_ranges"))


def asof_join(
    left: DataFrame,
    series: Series | Sequence[Series],
    on: str = "timestamp_utc",
    by: Sequence[str] = ("zone",),
    direction: str = "backward",
    tolerance_seconds: int | None = None,
    chunk_seconds: int = 90 * DAY,
    rows_per_task: int = 1_000_000,
) -> DataFrame:
    """All left rows, with the values of each series as known at ``on``.

    Several series share one shuffle of the left side. A matched right row whose value is NULL
    wins over an older value. ``nearest`` takes the closer of both neighbours, on a tie the
    earlier one. A NULL key matches nothing, wherever its rows lie, and neither does a NULL time.
    """
    rights = [series] if isinstance(series, Series) else list(series)
    by = list(by)
    # copies of one row differ by the partition they are read from, which is the same in a retry
    deal = F.xxhash64(*left.columns, F.spark_partition_id())
    spread = left.select(*by, F.col(on).alias(_TS), F.lit(1).alias(_SIDE), F.struct(*left.columns).alias("_left"), deal.alias("_deal"))
    streams = [spread]
    for i, r in enumerate(rights):
        keyed = r.settled(by).dropna(subset=by) if by else r.settled(by)
        streams.append(keyed.withColumn(_SIDE, F.lit(0)).withColumnRenamed("_v", f"_r{i}"))
    both = _chunked(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), streams), chunk_seconds)

    slots = [f"_r{i}" for i in range(len(rights))]
    nearest = direction == "nearest"
    joined = with_facts(both, _range_facts(both, by, slots, nearest, rows_per_task), [*by, CHUNK])
    began = F.size(F.filter("_ranges", lambda r: F.coalesce(r["start"], F.lit(-1)) <= F.coalesce(F.col(_BUCKET), F.lit(-1))))
    joined = joined.withColumn("_r", F.element_at("_ranges", began)).drop("_ranges")
    # left rows of one moment may be many: they are dealt out, each share with the range's right rows
    everywhere = F.sequence(F.lit(0), F.col("_r.shares") - 1)
    one = F.array(F.pmod(F.col("_deal"), F.col("_r.shares")).cast("int"))
    joined = joined.withColumn("_share", F.explode(F.when(F.col(_SIDE) == 0, everywhere).otherwise(one))).withColumn(_RANGE, F.col(f"_r.{_RANGE}"))
    part = [*by, CHUNK, _RANGE, "_share"]
    # a join by (key, chunk) would satisfy the windows as it is and keep all ranges of a chunk in one task
    joined = joined.repartition(*part)
    up = Window.partitionBy(*part).orderBy(_TS, _SIDE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = joined.select(
        "*", *[F.coalesce(F.last(s, ignorenulls=True).over(up), F.col(f"_r._b{s}")).alias(f"_m{s}") for s in slots]
    )
    if nearest:
        down = Window.partitionBy(*part).orderBy(F.col(_TS).desc(), F.col(_SIDE).desc())
        down = down.rowsBetween(Window.unboundedPreceding, -1)
        found = found.select(
            "*", *[F.coalesce(F.last(s, ignorenulls=True).over(down), F.col(f"_r._a{s}")).alias(f"_x{s}") for s in slots]
        )
    out = found.where(F.col(_SIDE) == 1)
    picked: list[Column] = []
    for r, s in zip(rights, slots):
        match = F.col(f"_m{s}")
        if nearest:
            match = _closer(F.col(f"_m{s}"), F.col(f"_x{s}"))
        timed = F.col(_TS).isNotNull()
        if tolerance_seconds is not None:
            timed = timed & (_distance(match["at"]) <= tolerance_seconds * 1_000_000)
        match = F.when(timed, match)
        picked += [match[n].alias(n) for n in r.names]
    return out.select("_left.*", *picked)


def _distance(at: Column) -> Column:
    return F.abs(F.unix_micros(F.col(_TS)) - F.unix_micros(at))


def _closer(earlier: Column, later: Column) -> Column:
    return (
        F.when(earlier.isNull(), later)
        .when(later.isNull(), earlier)
        .when(_distance(earlier["at"]) <= _distance(later["at"]), earlier)
        .otherwise(later)
    )


def asof_calendar(
    left: DataFrame,
    right: DataFrame,
    right_on: str,
    values: Sequence[str],
    on: str = "timestamp_utc",
    tiebreak: Sequence[str] = (),
    drop_nulls: bool = True,
) -> DataFrame:
    """Backward as-of join, without key, on a right side whose times are midnights.

    Every value holds from its day until the day before the next one; those days are spelled
    out and joined by equality. The last value has no end and comes from a one-row subquery.
    """
    values = list(values)
    known = right.where(F.col(right_on).isNotNull())
    if drop_nulls:
        known = known.where(reduce(lambda a, b: a & b, [F.col(v).isNotNull() for v in values]))
    at_midnight = F.col(right_on).cast("timestamp") == F.date_trunc("day", right_on)
    late = F.raise_error(F.concat(F.lit("not a midnight: "), F.col(right_on).cast("string"))).cast("boolean")
    known = known.where(F.when(at_midnight, F.lit(True)).otherwise(late))  # or it would be seen too early
    day = F.to_date(F.col(right_on)).alias("_day")
    per_day = known.groupBy(day).agg(F.max(F.struct(*tiebreak, *values)).alias("_v"))
    per_day = per_day.select("_day", F.struct(*[F.col("_v")[v].alias(v) for v in values]).alias("_v"))
    following = F.lead("_day").over(Window.orderBy("_day"))  # at most one row per calendar day
    holding = per_day.withColumn("_until", following).where(F.col("_until").isNotNull())
    calendar = holding.select("_v", F.explode(F.sequence("_day", F.date_sub("_until", 1))).alias("_day"))
    latest = per_day.agg(F.max(F.struct("_day", "_v")).alias("_latest")).scalar()
    at = F.to_date(F.col(on))
    joined = left.withColumn("_day", at).withColumn("_tail", latest).join(F.broadcast(calendar), "_day", "left")
    seen = F.coalesce(F.col("_v"), F.when(F.col("_day") >= F.col("_tail")["_day"], F.col("_tail")["_v"]))
    return joined.select(*left.columns, *[seen[v].alias(v) for v in values])


def nearest_within(
    left: DataFrame,
    right: DataFrame,
    values: Sequence[str],
    on: str = "timestamp_utc",
    by: Sequence[str] = ("zone",),
    step_seconds: int = 3_600,
    tolerance_seconds: int = 1_800,
) -> DataFrame:
    """Nearest right row within a tolerance of at most half a step; ties take the earlier row.

    The left times of a key lie on one grid of that step, or on a few, at any distance from the
    full hour. A right row can only be the nearest of the step it lies in or the next one, so on each
    grid of its key it is offered to both, and the best offer per step is taken before the join.
    """
    if 2 * tolerance_seconds > step_seconds:
        raise ValueError("the tolerance must not exceed half a step; use asof_join(direction='nearest')")
    values, by = list(values), list(by)
    step = step_seconds * 1_000_000
    phases = left.where(F.col(on).isNotNull()).select(*by, F.pmod(F.unix_micros(F.col(on)), F.lit(step)).alias("_phase")).distinct()
    best = nearest_per_step(right, phases, values, on, by, step_seconds, tolerance_seconds)
    return left.join(best, [*by, on], "left").select(*left.columns, *values)


def nearest_per_step(right, phases, values, on, by, step_seconds, tolerance_seconds) -> DataFrame:
    step = step_seconds * 1_000_000
    micros = F.unix_micros(F.col(on))
    floor = F.col("_obs") - F.pmod(F.col("_obs") - F.col("_phase"), F.lit(step))
    offered = right.where(F.col(on).isNotNull()).withColumn("_obs", micros).join(phases, by)
    offered = offered.withColumn("_step", F.explode(F.array(floor, floor + step)))
    offered = offered.withColumn("_gap", F.abs(F.col("_obs") - F.col("_step"))).where(F.col("_gap") <= tolerance_seconds * 1_000_000)
    best = offered.groupBy(*by, "_step").agg(F.min(F.struct("_gap", "_obs", *values)).alias("_row"))
    return best.select(*by, F.timestamp_micros("_step").alias(on), *[F.col("_row")[v].alias(v) for v in values])
