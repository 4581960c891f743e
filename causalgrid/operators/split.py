"""Splits in time: what is trained on never comes after what is tested."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from causalgrid.operators.chunks import CHUNK, POS, Grid

INDEX, TOTAL = "row_index", "n_rows"


def with_row_index(df: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """Number the rows of each key in time order from 0 and add their count.

    Rows are numbered inside chunks; the chunks' counts, one row each, give the offsets. NULL is a key like any
    other; rows without a time have no place in an order and are left out (``regular.unplaced`` has them).
    """
    placed = grid.placed(df.where(F.col(grid.ts).isNotNull()))
    counts = placed.groupBy(*grid.keys, CHUNK).agg(F.count("*").alias("_n"))
    order = Window.partitionBy(*grid.keys).orderBy(CHUNK)
    own = [F.col(k).alias(f"_own_{k}") for k in grid.keys]
    offsets = counts.select(
        *own,
        F.col(CHUNK).alias("_own_chunk"),
        F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
        F.sum("_n").over(Window.partitionBy(*grid.keys)).alias(TOTAL),
    )
    same = F.col(CHUNK) == F.col("_own_chunk")
    for k in grid.keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_own_{k}"))
    joined = placed.join(offsets, same).drop("_own_chunk", *[f"_own_{k}" for k in grid.keys])
    here = F.row_number().over(Window.partitionBy(*grid.keys, CHUNK).orderBy(POS, grid.ts)) - 1
    return joined.withColumn(INDEX, F.col("_offset") + here).drop("_offset", POS, CHUNK)


def marked(indexed: DataFrame, test_rows: int) -> DataFrame:
    """Add ``split``: ``test`` for the last ``test_rows`` rows of a key, ``train`` before, NULL where a key has fewer than twice as many."""
    role = F.when(F.col(INDEX) >= F.col(TOTAL) - test_rows, "test").otherwise("train")
    return indexed.withColumn("split", F.when(F.col(TOTAL) >= 2 * test_rows, role))


def temporal_split(df: DataFrame, test_rows: int = 168, grid: Grid = Grid(), strict: bool = True) -> DataFrame:
    """Ready rows with ``split`` (see ``marked``).

    A key with too few rows to split is an error; with ``strict=False`` its rows stay and have none.
    """
    ready = df.where("feature_ready") if "feature_ready" in df.columns else df
    indexed = marked(with_row_index(ready, grid), test_rows)
    if not strict:
        return indexed
    keys = F.concat_ws("/", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in grid.keys])
    message = F.concat(F.lit("too few rows to split: "), keys)
    return indexed.withColumn("split", F.when(F.col("split").isNotNull(), F.col("split")).otherwise(F.raise_error(message)))


def fold_bounds(fold: Column, folds: int, gap: int) -> tuple[Column, Column, Column]:
    """``(end of training, start of test, end of test)`` as row indexes, for fold 1 to ``folds``."""
    size = F.floor(F.col(TOTAL) / (folds + 1))
    start = F.col(TOTAL) - (F.lit(folds + 1) - fold) * size
    return start - gap, start, start + size


def fold_role(fold: Column, folds: int = 5, gap: int = 168) -> Column:
    """``train``, ``test`` or NULL for each row in a fold; training grows, the gap is left out."""
    until, start, end = fold_bounds(fold, folds, gap)
    index = F.col(INDEX)
    return F.when((index >= start) & (index < end), "test").when(index < until, "train")


def walk_forward(indexed: DataFrame, folds: int = 5, gap: int = 168) -> DataFrame:
    """One row per (row, fold) it takes part in."""
    spread = indexed.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(folds))))
    return spread.withColumn("role", fold_role(F.col("fold"), folds, gap)).where(F.col("role").isNotNull())


def early_stop_slice(index: Column, total: Column, share: float = 0.10) -> Column:
    """The last tenth of the training rows, at least one, watches the fit."""
    return index >= total - F.greatest(F.lit(1), F.floor(total * share))
