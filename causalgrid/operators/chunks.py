"""Time chunks: how one hot key is spread over many tasks without changing any result.

A window over ``partitionBy(zone)`` puts a whole zone into one task. Here every ordered
operator works on (key, chunk of time) instead:

* a bounded look-back (lags, rolling frames) copies the last rows of each chunk into the
  next one as a *halo*, which is dropped afterwards;
* an unbounded look-back (last known value, run starts) reads one *edge* row per chunk, made
  by a pre-aggregation, so only as many rows as there are chunks meet in one place.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

POS, CHUNK, HOME = "_pos", "_chunk", "_home"

HOUR = 3_600
DAY = 86_400


@dataclass(frozen=True)
class Grid:
    """A regular time axis per key."""

    keys: tuple[str, ...] = ("zone",)
    ts: str = "timestamp_utc"
    step_seconds: int = HOUR
    chunk_steps: int = 4_096

    @property
    def step_micros(self) -> int:
        return self.step_seconds * 1_000_000

    def sized_for(self, lookback: int) -> Grid:
        """Chunks at least twice the look-back: a halo then costs at most half a copy."""
        return replace(self, chunk_steps=max(self.chunk_steps, 2 * lookback))

    def position(self) -> Column:
        """Number of whole steps since the epoch; floor division also before 1970."""
        micros, step = f"unix_micros(`{self.ts}`)", f"{self.step_micros}L"
        return F.expr(f"({micros} - pmod({micros}, {step})) div {step}")

    def offset(self) -> Column:
        """Distance in microseconds from the start of the step."""
        return F.pmod(F.unix_micros(F.col(self.ts)), F.lit(self.step_micros))

    def chunk_of(self, pos: str) -> Column:
        return F.expr(f"(`{pos}` - pmod(`{pos}`, {self.chunk_steps}L)) div {self.chunk_steps}L")

    def placed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(POS, self.position()).withColumn(CHUNK, self.chunk_of(POS))

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, CHUNK).orderBy(POS)

    def over(self, frame: str = "") -> str:
        """``window()`` for use in SQL expressions."""
        keys = ", ".join(f"`{k}`" for k in (*self.keys, CHUNK))
        return f"(partition by {keys} order by {POS} {frame})"

    def reverse_window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, CHUNK).orderBy(F.col(POS).desc())


def with_halo(df: DataFrame, grid: Grid, lookback: int) -> DataFrame:
    """Place rows in chunks and copy the last ``lookback`` rows of each into the next.

    ``grid.window()`` over the result sees, for every home row, exactly the ``lookback`` rows
    before it. Needs a gap-free series per key (see ``regular.regularize``).
    """
    if lookback > grid.chunk_steps:
        raise ValueError(f"a halo of {lookback} rows needs chunks of at least that size")
    placed = grid.placed(df)
    if lookback == 0:
        return placed.withColumn(HOME, F.lit(True))
    last_rows = F.pmod(F.col(POS), F.lit(grid.chunk_steps)) >= grid.chunk_steps - lookback
    return (
        placed.withColumn("_ahead", F.explode(F.when(last_rows, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .withColumn(CHUNK, F.col(CHUNK) + F.col("_ahead"))
        .withColumn(HOME, F.col("_ahead") == 0)
        .drop("_ahead")
    )


def home_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col(HOME)).drop(HOME, POS, CHUNK)


def chunk_edges(
    placed: DataFrame,
    keys: Sequence[str],
    before: Mapping[str, Column] | None = None,
    after: Mapping[str, Column] | None = None,
    own: Mapping[str, Column] | None = None,
) -> DataFrame:
    """For each (key, chunk): what earlier chunks left behind and what later ones hold.

    ``before[name]`` is an ordered value (time first in a struct): the greatest one of all
    earlier chunks comes out. ``after[name]`` likewise gives the least of all later chunks.
    ``own`` holds aggregates of the chunk itself.
    The windows run over one row per chunk.
    """
    before, after, own = before or {}, after or {}, own or {}
    per_chunk = placed.groupBy(*keys, CHUNK).agg(
        *[F.max(c).alias(f"b_{n}") for n, c in before.items()],
        *[F.min(c).alias(f"a_{n}") for n, c in after.items()],
        *[c.alias(n) for n, c in own.items()],
    )
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*keys).orderBy(F.col(CHUNK).desc()).rowsBetween(Window.unboundedPreceding, -1)
    return per_chunk.select(
        *keys,
        CHUNK,
        *[F.last(f"b_{n}", ignorenulls=True).over(earlier).alias(n) for n in before],
        *[F.last(f"a_{n}", ignorenulls=True).over(later).alias(n) for n in after],
        *own,
    )
