"""Boosted trees as rows: one row a tree, its nodes in flat arrays.

``feature[k]`` is the column that node k asks (-1 at a leaf), ``left`` and ``right`` its children, ``value`` a leaf's answer, ``gain``
what the split brought times the rows it split. A table of such rows is stored, cut to a prefix, summed up and
walked like any other; models of all zones answer in one scan.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from causalgrid.session import scratch_path

SCHEMA = (
    "zone string, tree int, weight double, feature array<int>, threshold array<double>, left array<int>, right array<int>, "
    "value array<double>, gain array<double>"
)
COLUMNS = ("tree", "weight", "feature", "threshold", "left", "right", "value", "gain")
#: Trees of so many bytes are held by a task at a time; zones beyond it are walked in further scans.
HELD_BYTES = 64 << 20
NODE_BYTES = 28
#: Rows times trees that take a step together.
STEP = 1 << 21


def trees_of(spark: SparkSession, model: GBTRegressionModel) -> DataFrame:
    """The rows of a fitted model, read from what it writes itself."""
    path = scratch_path(spark, "boosted")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    split = F.col("leftChild") >= 0
    node = F.struct(
        F.col("id"),
        F.when(split, F.col("split.featureIndex")).otherwise(-1).alias("feature"),
        F.when(split, F.element_at("split.leftCategoriesOrThreshold", 1)).otherwise(0.0).alias("threshold"),
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
        F.col("prediction").alias("value"),
        F.when(split, F.col("gain") * F.element_at("impurityStats", 1)).otherwise(0.0).alias("gain"),
    )
    trees = nodes.groupBy("tree").agg(F.array_sort(F.collect_list(node)).alias("n"))
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "notes", "weight").select("tree", "weight")
    return trees.join(weights, "tree").select("tree", "weight", *[F.col(f"n.{c}").alias(c) for c in COLUMNS[2:]])


def best_prefix(errors: Sequence[float], patience: int) -> tuple[int, bool]:
    """Number of trees with the least error, the first of equal ones, and whether ``patience`` trees in a row brought no gain."""
    best = 0
    for k, e in enumerate(errors):
        if e < errors[best]:
            best = k
        elif k - best >= patience:
            return best + 1, True
    return best + 1, False


class Walker:
    """The trees of one zone, side by side in flat arrays."""

    def __init__(self, trees: Sequence):
        trees = sorted(trees, key=lambda t: t.tree)
        sizes = [len(t.feature) for t in trees]
        self.roots = np.cumsum([0, *sizes[:-1]])
        shift = np.repeat(self.roots, sizes)
        join = lambda name, kind: np.concatenate([np.array(t[name], kind) for t in trees])
        self.feature, self.threshold = join("feature", np.int64), join("threshold", float)
        inner = self.feature >= 0
        here = np.arange(len(self.feature))
        self.left = np.where(inner, join("left", np.int64) + shift, here)
        self.right = np.where(inner, join("right", np.int64) + shift, here)
        self.feature = np.maximum(self.feature, 0)
        self.value = join("value", float) * np.repeat([t.weight for t in trees], sizes)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """The sum of all trees' answers for each row of features."""
        out = np.empty(len(x))
        rows = max(1, STEP // len(self.roots))
        for a in range(0, len(x), rows):
            part = x[a : a + rows]
            node = np.tile(self.roots, (len(part), 1))
            line = np.arange(len(part))[:, None]
            while True:
                below = part[line, self.feature[node]] <= self.threshold[node]
                then = np.where(below, self.left[node], self.right[node])
                if (then == node).all():
                    break
                node = then
            out[a : a + rows] = self.value[node].sum(axis=1)
        return out


def blocks_of(forests: DataFrame, held: int = HELD_BYTES) -> list[list[str]]:
    """Zones whose trees are held together, by the bytes of their nodes."""
    size = forests.groupBy("zone").agg((F.sum(F.size("feature")) * NODE_BYTES).alias("bytes"))
    blocks, room = [], 0
    for r in sorted(size.collect(), key=lambda r: r.zone):
        if r.bytes > room:
            blocks.append([])
            room = held
        blocks[-1].append(r.zone)
        room -= r.bytes
    return blocks


def predictions(rows: DataFrame, forests: DataFrame, features: Sequence[str], missing: float, out: str = "y_pred", held: int = HELD_BYTES) -> DataFrame:
    """``rows`` of zones with trees, and their answers; features that are not known count as ``missing``.

    One scan of ``rows`` serves all zones whose trees fit into ``held`` bytes.
    """
    others = [c for c in rows.columns if c != out]
    taken = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(missing)) for c in features])
    asked = rows.select(*others, taken.alias("_x"))
    schema = rows.select(*others).withColumn(out, F.lit(0.0)).schema
    parts = [answered(asked, {z: Walker(t) for z, t in by_zone(forests, block).items()}, others, len(features), schema, out) for block in blocks_of(forests, held)]
    if not parts:
        return rows.select(*others).withColumn(out, F.lit(None).cast("double")).limit(0)
    for p in parts[1:]:
        parts[0] = parts[0].unionByName(p)
    return parts[0]


def by_zone(forests: DataFrame, zones: Sequence[str]) -> dict[str, list]:
    trees: dict[str, list] = {}
    for t in forests.where(F.col("zone").isin(*zones)).select("zone", *COLUMNS[:-1]).collect():
        trees.setdefault(t.zone, []).append(t)
    return trees


def answered(asked: DataFrame, walkers: dict[str, Walker], others: Sequence[str], width: int, schema, out: str) -> DataFrame:
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), width)
            zones = np.array(batch.column("zone").to_pylist(), object)
            y = np.empty(len(batch))
            for zone in set(zones):
                own = np.flatnonzero(zones == zone)
                y[own] = walkers[zone](x[own])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], pa.array(y)], names=[*others, out])

    return asked.where(F.col("zone").isin(*walkers)).mapInArrow(walk, schema)


def gains(forests: DataFrame, features: Sequence[str], by: Sequence[str] = ("zone",)) -> DataFrame:
    """``feature, gain``: each feature's part of all the gains, 0 for those that no node asks."""
    names = F.array(*[F.lit(f) for f in features])
    node = forests.select(*by, F.inline(F.arrays_zip("feature", "gain")))
    asked = node.where("feature >= 0").groupBy(*by, "feature").agg(F.sum("gain").alias("gain"))
    total = forests.groupBy(*by).agg(F.sum(F.aggregate("gain", F.lit(0.0), lambda a, b: a + b)).alias("_total"))
    every = total.select(*by, "_total", F.posexplode(names).alias("feature", "_name"))
    share: Column = F.coalesce(F.try_divide("gain", "_total"), F.lit(0.0))
    return every.join(asked, [*by, "feature"], "left").select(*by, F.col("_name").alias("feature"), share.alias("gain"))
