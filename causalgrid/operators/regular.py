"""Irregular to regular: duplicate removal, calendar fill, bounded gap filling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from causalgrid.operators.chunks import CHUNK, POS, Grid, chunk_edges
from causalgrid.operators.keys import null_safe_join, with_facts

SO_FAR = (Window.unboundedPreceding, Window.currentRow)
STRICTLY_BEFORE = (Window.unboundedPreceding, -1)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last by ``order``; equal ones by the remaining columns.

    An aggregate rather than a ranking window, so that copies of a key are combined before
    they are shuffled.
    """
    return _keep(df, keys, order, F.max)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order``, NULL last; equal ones by the remaining columns."""
    return _keep(df, keys, order, F.min)


def _keep(df, keys, order, pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    # NULL is least in a struct: it loses a maximum as it is, and a minimum by being flagged
    flags = [F.col(c).isNull().alias(f"_n{i}") for i, c in enumerate(order)] if pick is F.min else []
    ordered = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]
    both = [x for pair in zip(flags, ordered) for x in pair] if flags else ordered
    picked = df.groupBy(*keys).agg(pick(F.struct(*both, *rest)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def _known(name: str) -> Column:
    return F.when(F.col(name).isNotNull(), F.struct(F.col(POS).alias("pos"), F.col(name).alias("v")))


def _known_edges(fills: Sequence[str], linear: Sequence[str]) -> tuple[dict[str, Column], dict[str, Column]]:
    before = {f"_pe_{c}": _known(c) for c in fills}
    return before, {"_next_pos": F.col(POS), **{f"_ne_{c}": _known(c) for c in linear}}


def _with_neighbours(rows: DataFrame, edges: DataFrame, grid: Grid, fills: Sequence[str], linear: Sequence[str]) -> DataFrame:
    """Add the known value at or before (``_p_c``) and, for ``linear``, after (``_n_c``)."""
    joined = rows.join(edges, [*grid.keys, CHUNK])
    if "_phase" in edges.columns:
        joined = joined.where(F.col("_off") == F.col("_phase"))
    up, down = grid.window().rowsBetween(*SO_FAR), grid.reverse_window().rowsBetween(*STRICTLY_BEFORE)
    out = joined.select(
        *rows.columns,
        F.coalesce(F.lead(POS).over(grid.window()), F.col("_next_pos")).alias("_next_pos"),
        *[F.coalesce(F.last(_known(c), True).over(up), F.col(f"_pe_{c}")).alias(f"_p_{c}") for c in fills],
        *[F.col(f"_ne_{c}") for c in linear],
    )
    return out.select(
        "*",
        *[F.coalesce(F.last(_known(c), True).over(down), F.col(f"_ne_{c}")).alias(f"_n_{c}") for c in linear],
    )


def _phased_edges(rows: DataFrame, grid: Grid, fills: Sequence[str], linear: Sequence[str]) -> DataFrame:
    """Chunk edges over rows on the key's own grid only, whose phase is its first timestamp.

    One aggregation by (key, chunk, phase) serves both questions: which phase comes first, and
    what the chunks of that phase hold.
    """
    before, after = _known_edges(fills, linear)
    per_phase = rows.groupBy(*grid.keys, CHUNK, "_off").agg(
        F.min(grid.ts).alias("_first"),
        *[F.max(c).alias(n) for n, c in before.items()],
        *[F.min(c).alias(n) for n, c in after.items()],
    )
    per_key = Window.partitionBy(*grid.keys)
    first = per_phase.groupBy(*grid.keys, CHUNK).agg(F.min("_first").alias("_start"))
    first = first.select(*grid.keys, CHUNK, F.min("_start").over(per_key).alias("_start"))
    phase = F.pmod(F.unix_micros("_start"), F.lit(grid.step_micros))
    own = per_phase.join(first.select(*grid.keys, CHUNK, phase.alias("_phase")), [*grid.keys, CHUNK])
    own = own.where(F.col("_off") == F.col("_phase"))
    earlier, later = per_key.orderBy(CHUNK), per_key.orderBy(F.col(CHUNK).desc())
    return own.select(
        *grid.keys,
        CHUNK,
        "_phase",
        *[F.last(n, True).over(earlier.rowsBetween(*STRICTLY_BEFORE)).alias(n) for n in before],
        *[F.last(n, True).over(later.rowsBetween(*STRICTLY_BEFORE)).alias(n) for n in after],
    )


def _filled(value: Column, at: Column, name: str, limit: int | None, interpolate: bool, hold: bool = False) -> Column:
    prev, nxt = F.col(f"_p_{name}"), F.col(f"_n_{name}")
    steps = at - prev["pos"]
    within = prev.isNotNull() if limit is None or hold else steps <= limit
    if hold and limit is not None:
        steps = F.least(steps, F.lit(limit))
    guess = prev["v"]
    if interpolate:
        slope = (nxt["v"] - prev["v"]) * steps / (nxt["pos"] - prev["pos"])
        guess = F.coalesce(prev["v"] + slope, prev["v"])
    return F.coalesce(value, F.when(within, guess))


def _misplaced(grid: Grid) -> Column:
    no_key = reduce(or_, [F.col(k).isNull() for k in grid.keys], F.lit(False))
    return F.when(no_key, "no_key").when(F.col(grid.ts).isNull(), "no_time")


def unplaced(df: DataFrame, grid: Grid) -> DataFrame:
    """The rows that have no place on a regular grid, with ``unplaced_reason``: ``no_key``, ``no_time``, or ``off_phase``.

    ``regularize`` makes its series from the others; both together are all rows. The phase of a key is its first timestamp's.
    """
    phases = df.groupBy(*grid.keys).agg(F.pmod(F.unix_micros(F.min(grid.ts)), F.lit(grid.step_micros)).alias("_phase"))
    why = F.coalesce(_misplaced(grid), F.when(grid.offset() != F.col("_phase"), "off_phase"))
    return with_facts(df, phases, grid.keys).withColumn("unplaced_reason", why).where("unplaced_reason is not null").drop("_phase")


def unplaced_counts(df: DataFrame, grid: Grid) -> DataFrame:
    """How many rows of each key have no place, by reason: the side table of ``regularize``.

    Rows are counted by key and phase before anything is joined.
    """
    counted = df.groupBy(*grid.keys, _misplaced(grid).alias("_why"), grid.offset().alias("_off")).agg(F.count("*").alias("_n"), F.min(grid.ts).alias("_first"))
    first = counted.groupBy(*grid.keys).agg(F.pmod(F.unix_micros(F.min("_first")), F.lit(grid.step_micros)).alias("_phase"))
    why = F.coalesce("_why", F.when(F.col("_off") != F.col("_phase"), "off_phase")).alias("unplaced_reason")
    return null_safe_join(counted, first, grid.keys).groupBy(*grid.keys, why).agg(F.sum("_n").alias("n")).where("unplaced_reason is not null")


def regularize(
    df: DataFrame,
    grid: Grid,
    linear: Mapping[str, int | None] | None = None,
    ffill: Mapping[str, int | None] | None = None,
    flags: Sequence[str] = (),
    imputed_from: str | None = None,
    imputed_flag: str = "has_imputed_grid",
    check_phase: bool = True,
) -> DataFrame:
    """Complete each key's series to every step between its first and last row.

    Missing steps are made from the row before the gap, which knows where the next row is;
    no calendar table and no join against one. ``linear`` columns get line values for the
    first *n* steps of a gap (a trailing gap repeats the last value), ``ffill`` columns the
    last value for the first *n* steps; ``None`` is without limit. ``flags`` become false on
    new rows and where NULL. ``imputed_flag`` marks rows where ``imputed_from`` was NULL
    before any filling. Rows off the key's grid, whose phase is its first timestamp, and rows
    without key or time are left to ``unplaced``; with ``check_phase=False`` the caller vouches that there are none off it. Expects one row per (key,
    timestamp).
    """
    linear, ffill = dict(linear or {}), dict(ffill or {})
    fills = [*linear, *ffill]
    rows = grid.placed(df).withColumn("_off", grid.offset())
    if check_phase:
        edges = _phased_edges(rows, grid, fills, list(linear))
    else:
        before, after = _known_edges(fills, list(linear))
        edges = chunk_edges(rows, grid.keys, before, after)
    known = _with_neighbours(rows, edges, grid, fills, list(linear))
    steps = F.sequence(F.col(POS), F.coalesce(F.col("_next_pos"), F.col(POS) + 1) - 1)
    grown = known.withColumn("_at", F.explode(steps))
    real = F.col("_at") == F.col(POS)

    def out(c: str) -> Column:
        if c in grid.keys:
            return F.col(c)
        if c == grid.ts:
            return F.timestamp_micros(F.col("_at") * grid.step_micros + F.col("_off")).alias(c)
        value = F.when(real, F.col(c))
        if c in linear:
            value = _filled(value, F.col("_at"), c, linear[c], True)
        elif c in ffill:
            value = _filled(value, F.col("_at"), c, ffill[c], False)
        elif c in flags:
            value = F.coalesce(value, F.lit(False))
        return value.alias(c)

    columns = [out(c) for c in df.columns]
    if imputed_from is not None:
        columns.append(F.when(real, F.col(imputed_from)).isNull().alias(imputed_flag))
    return grown.select(*columns)


def fill_gaps(
    df: DataFrame,
    grid: Grid,
    linear: Mapping[str, int | None] | None = None,
    ffill: Mapping[str, int | None] | None = None,
    hold: Sequence[str] = (),
) -> DataFrame:
    """The filling of ``regularize`` on a series that is regular already.

    Columns in ``hold`` keep the value of the last filled step for the rest of a longer gap.
    """
    linear, ffill = dict(linear or {}), dict(ffill or {})
    rows = grid.placed(df)
    before, after = _known_edges([*linear, *ffill], list(linear))
    edges = chunk_edges(rows, grid.keys, before, after)
    known = _with_neighbours(rows, edges, grid, [*linear, *ffill], list(linear))
    limits = {**linear, **ffill}
    return known.select(
        *[
            _filled(F.col(c), F.col(POS), c, limits[c], c in linear, c in hold).alias(c) if c in limits else F.col(c)
            for c in df.columns
        ]
    )


def resample(df: DataFrame, grid: Grid, sums: Sequence[str] = (), means: Sequence[str] = (), flags: Sequence[str] = ()) -> DataFrame:
    """Sub-step rows (15 or 30 minutes) combined to one row per step."""
    start = F.timestamp_micros(grid.position() * grid.step_micros).alias(grid.ts)
    return df.groupBy(*grid.keys, start).agg(
        *[F.sum(c).alias(c) for c in sums], *[F.avg(c).alias(c) for c in means], *[F.bool_or(c).alias(c) for c in flags]
    )
