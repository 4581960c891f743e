"""Trailing statistics over n rows without looking at n rows for each of them.

A sliding ``rowsBetween(-(n-1), 0)`` frame is evaluated from scratch for every row: 720 updates
per row and column for a month of hours. Here only the shortest width is a frame. Every longer
one is put together from shorter ones that end earlier: 168 rows are seven times 24, 720 rows are
four times 168 and two times 24, fetched with ``lag``. Stretches are joined by count, sum, centred
second moment, least and greatest, so nothing is subtracted from a running total and no digits
are lost. The result of a row depends only on the values in its own window, never on where a
chunk begins.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from causalgrid.operators.chunks import Grid


@dataclass(frozen=True)
class Rolling:
    """One statistic of one column over a number of rows including the current one."""

    column: str
    width: int
    stat: str  # mean, std, min, max, sum, count
    name: str
    min_count: int = 1


def min_periods(width: int, fraction: float = 0.5) -> int:
    return max(1, int(width * fraction))


FRAME, PIECES = 24, 12


def build_order(widths: set[int]) -> list[int]:
    """The widths to build, shortest first, with steps between that keep every one cheap."""
    order: list[int] = []
    for w in sorted(widths):
        if not order:
            order.append(w if w <= 2 * FRAME else FRAME)
        while w > PIECES * order[-1]:
            order.append((PIECES - 4) * order[-1])
        if w != order[-1]:
            order.append(w)
    return order


def pieces(width: int, built: Sequence[int]) -> list[tuple[int, int]]:
    """``(built width, rows back)`` that tile ``width``; a rest shorter than any comes last."""
    out, at = [], 0
    for unit in sorted(built, reverse=True):
        while width - at >= unit:
            out.append((unit, at))
            at += unit
    return out + ([(width - at, at)] if at < width else [])


def _fields(stats: set[str]) -> list[str]:
    # the spread of equal values is zero, which least and greatest tell exactly
    needs = {"m2": {"std"}, "lo": {"min", "std"}, "hi": {"max", "std"}}
    return ["n", "s", *[f for f, kinds in needs.items() if kinds & stats]]


def _struct(values: dict[str, str], fields: Sequence[str]) -> str:
    return "named_struct(" + ", ".join(f"'{f}', {values[f]}" for f in fields) + ")"


def _framed(c: str, grid: Grid, first: int, last: int, fields: Sequence[str]) -> str:
    """The rows from ``first`` to ``last`` back, as a plain frame."""
    end = "current row" if last == 0 else f"{last} preceding"
    over = f"over {grid.over(f'rows between {first} preceding and {end}')}"
    x = f"cast(`{c}` as double)"
    values = {
        "n": f"count({x}) {over}",
        "s": f"coalesce(sum({x}) {over}, 0D)",
        "m2": f"coalesce(var_pop({x}) {over} * count({x}) {over}, 0D)",
        "lo": f"min({x}) {over}",
        "hi": f"max({x}) {over}",
    }
    return _struct(values, fields)


def _joined(parts: Sequence[str], n: str, s: str, fields: Sequence[str]) -> str:
    """Neighbouring stretches as one; those before the series began are NULL."""
    inner = [f"coalesce({p}.m2, 0D)" for p in parts if "m2" in fields]
    between = [f"if({p}.n > 0, {p}.n * pow({p}.s / {p}.n - {s} / {n}, 2), 0D)" for p in parts if "m2" in fields]
    values = {
        "n": n,
        "s": s,
        "m2": " + ".join(inner + between),
        "lo": f"least({', '.join(f'{p}.lo' for p in parts)})",
        "hi": f"greatest({', '.join(f'{p}.hi' for p in parts)})",
    }
    return _struct(values, fields)


def _statistic(state: str, stat: str) -> str:
    return {
        "count": f"cast({state}.n as double)",
        "sum": f"{state}.s",
        "mean": f"{state}.s / {state}.n",
        "std": f"case when {state}.n < 2 then null when {state}.lo = {state}.hi then 0D else sqrt({state}.m2 / ({state}.n - 1)) end",
        "min": f"{state}.lo",
        "max": f"{state}.hi",
    }[stat]


def rolling(df: DataFrame, grid: Grid, specs: Sequence[Rolling]) -> DataFrame:
    """Add every statistic in ``specs``; NULL where fewer than ``min_count`` values are known.

    ``df`` is placed in chunks with a halo of the longest width minus one.
    """
    widths: dict[str, set[int]] = {}
    stats: dict[str, set[str]] = {}
    for s in specs:
        widths.setdefault(s.column, set()).add(s.width)
        stats.setdefault(s.column, set()).add(s.stat)
    fields = {c: _fields(kinds) for c, kinds in stats.items()}
    orders = {c: build_order(ws) for c, ws in widths.items()}
    own = [f"`{c}`" for c in df.columns]
    out, built = df, {c: [] for c in widths}
    for level in range(max(len(o) for o in orders.values())):
        fetch, totals, joins = [], [], []
        for c in [c for c, o in orders.items() if len(o) > level]:
            width = orders[c][level]
            name, parts = f"`_w_{c}_{width}`", []
            for unit, back in pieces(width, built[c]):
                if unit not in built[c]:
                    part = f"`_f_{c}`" if built[c] else name
                    fetch.append(f"{_framed(c, grid, back + unit - 1, back, fields[c])} as {part}")
                elif back:
                    part = f"`_p_{c}_{back}`"
                    fetch.append(f"lag(`_w_{c}_{unit}`, {back}) over {grid.over()} as {part}")
                else:
                    part = f"`_w_{c}_{unit}`"
                parts.append(part)
            if built[c]:
                n, s = f"`_n_{c}`", f"`_t_{c}`"
                totals.append(" + ".join(f"coalesce({p}.n, 0L)" for p in parts) + f" as {n}")
                totals.append(" + ".join(f"coalesce({p}.s, 0D)" for p in parts) + f" as {s}")
                # a frame that lies before the series holds no rows and is no part
                joins.append(f"if({n} = 0, null, {_joined(parts, n, s, fields[c])}) as {name}")
        kept = [f"`_w_{c}_{w}`" for c, ws in built.items() for w in ws]
        out = out.selectExpr("*", *fetch)
        for c, o in orders.items():
            if len(o) > level:
                if not built[c]:
                    kept.append(f"`_w_{c}_{o[level]}`")
                built[c].append(o[level])
        if totals:
            out = out.selectExpr("*", *totals)
        out = out.selectExpr(*own, *kept, *joins)
    wanted = []
    for s in specs:
        state = f"`_w_{s.column}_{s.width}`"
        wanted.append(f"if({state}.n >= {s.min_count}, {_statistic(state, s.stat)}, null) as `{s.name}`")
    return out.selectExpr(*own, *wanted)


def rolling_frames(df: DataFrame, window: WindowSpec, specs: Sequence[Rolling]) -> DataFrame:
    """The same with plain sliding frames: simplest plan, best for short windows."""
    stats = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "sum": F.sum, "count": F.count}

    def one(s: Rolling) -> Column:
        frame = window.rowsBetween(-(s.width - 1), 0)
        value = stats[s.stat](F.col(s.column)).over(frame).cast("double")
        return F.when(F.count(F.col(s.column)).over(frame) >= s.min_count, value).alias(s.name)

    return df.select("*", *[one(s) for s in specs])
