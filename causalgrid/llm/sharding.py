"""Shards of equal bytes by a k-d tree over metadata of the documents.

The tree splits every node with more than one shard along its widest dimension, at the weighted
median (or the quantile that its shards' counts ask for). The quantiles of all nodes of a level are
found together by histograms that get finer around the quantile, so a level moves some thousand counts,
never rows. Coordinates depend on the text alone: equal texts stay in one shard unless their
group alone is heavier than the tolerance and lies on a cut; then a hash of the id cuts the group, so a
group of any size is spread.

Nulls: a null text has no bytes and the checksum 0; a null id is hashed as an empty one. Equal rows
(id and text) cannot be told apart and stay together. Any text counts by its length. An
empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from causalgrid.llm.common import stored

BINS = 1024
#: Cuts may miss the wanted weight by this share of a shard.
TOLERANCE = 0.002
ROWS_PER_SLOT_GROUP = 20_000
SLOT_GROUPS_AT_LEAST = 8
DIMENSIONS = ("size", "outside ascii", "blanks", "lines")
LOW = 1 << 32


@dataclass
class Node:
    """Shards ``first`` to ``first + shards - 1``; ``cut`` is (dimension, coordinate, hash of the id)."""

    first: int
    shards: int
    weight: float = 0.0
    cut: tuple[int, int, int] | None = None
    left: Node | None = None
    right: Node | None = None


def points(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Of every document: its size, checksum, hash of the id and a coordinate for each dimension.

    The dimension's value, below 2**20, is the high part of a coordinate and the checksum its low part.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = F.octet_length("text").cast("long")
    without = lambda c: F.octet_length("text") - F.octet_length(F.replace(F.col("text"), F.lit(c), F.lit("")))
    share = lambda n: F.floor(n.cast("long") * 1_000_000 / F.greatest(size, F.lit(1))).cast("long")
    values = [
        F.floor(F.log2(size + 16) * (1 << 14)).cast("long"),
        share(size - F.char_length("text")),
        share(without(" ")),
        share(without("\n")),
    ]
    return rows.select(
        "doc_id",
        (size + 16).alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("crc"),
        F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(LOW)).alias("h"),
        *[v.alias(f"v{k}") for k, v in enumerate(values)],
    ).withColumns({f"c{k}": F.col(f"v{k}") * LOW + F.col("crc") for k in range(len(values))})


def first_shard(node: Node):
    """SQL for the first shard of the deepest node so far that a point belongs to."""
    if node.cut is None:
        return str(node.first)
    k, c, h = node.cut
    return f"CASE WHEN c{k} < {c}L OR (c{k} = {c}L AND h < {h}L) THEN {first_shard(node.left)} ELSE {first_shard(node.right)} END"


def leaves(node: Node) -> list[Node]:
    return [node] if node.cut is None else leaves(node.left) + leaves(node.right)


def histogram(placed: DataFrame, asks: dict[int, tuple]) -> dict[int, dict[int, int]]:
    """Bytes per node and bin. ``asks``: node's first shard -> (dimension, low, width, coordinate to stay inside or None)."""
    spark = placed.sparkSession
    table = spark.createDataFrame([(n, *x) for n, x in asks.items()], "node int, k int, low long, width long, inside long")
    asked = placed.join(F.broadcast(table), "node")  # a row for each node, fewer than shards
    along = "element_at(array(" + ", ".join(f"c{k}" for k in range(len(DIMENSIONS))) + "), k + 1)"
    ahead = asked.where(f"inside IS NULL OR inside = {along}").selectExpr(
        "node", f"if(inside IS NULL, {along}, h) - low AS ahead", "width", "size"
    )
    binned = ahead.where(f"ahead >= 0 AND ahead < width * {BINS}").selectExpr("node", "ahead div width AS bin", "size")
    found: dict[int, dict[int, int]] = {n: {} for n in asks}
    for r in binned.groupBy("node", "bin").agg(F.sum("size").alias("bytes")).collect():  # at most shards x BINS rows
        found[r["node"]][r["bin"]] = r["bytes"]
    return found


def cut_level(data: DataFrame, root: Node, spans: list[int], slack: float) -> None:
    """Give every leaf with more than one shard its cut."""
    active = {n.first: n for n in leaves(root) if n.shards > 1}
    placed = data.selectExpr("*", f"CAST({first_shard(root)} AS INT) AS node")
    extremes = [f(f"c{k}").alias(f"{name}{k}") for k in range(len(spans)) for name, f in (("min", F.min), ("max", F.max))]
    search = {}
    for r in placed.groupBy("node").agg(F.sum("size").alias("bytes"), *extremes).collect():
        if r["node"] not in active:
            continue
        node = active[r["node"]]
        node.weight = float(r["bytes"])
        k = max(range(len(spans)), key=lambda k: ((r[f"max{k}"] // LOW - r[f"min{k}"] // LOW) / max(1, spans[k]), r[f"max{k}"] - r[f"min{k}"]))
        want = node.weight * (node.shards // 2) / node.shards
        # looked for in [low, high); everything below low weighs ``below``
        search[node.first] = {"k": k, "low": r[f"min{k}"], "high": r[f"max{k}"] + 1, "below": 0.0, "want": want, "inside": None}
    while search:
        asks = {n: (s["k"], s["low"], -(-(s["high"] - s["low"]) // BINS), s["inside"]) for n, s in search.items()}
        found = histogram(placed, asks)
        for n, s in list(search.items()):
            width, below, at = asks[n][2], s["below"], None
            for b in sorted(found[n]):
                if below + found[n][b] >= s["want"]:
                    at = b
                    break
                below += found[n][b]
            if at is None:  # rounding at the upper end
                at, below = max(found[n]), below - found[n][max(found[n])]
            low, high, weight = s["low"] + at * width, s["low"] + (at + 1) * width, found[n][at]
            edge = low if s["want"] - below <= below + weight - s["want"] else high
            if width == 1 and s["inside"] is None and weight > slack:
                s |= {"inside": low, "low": 0, "high": LOW, "below": below}
            elif width == 1 or weight <= slack:
                k, inside = s["k"], s["inside"]
                active[n].cut = (k, edge, 0) if inside is None else (k, inside, edge)
                del search[n]
            else:
                s |= {"low": low, "high": high, "below": below}
    for n in active.values():
        n.cut = n.cut or (0, 0, 0)  # a node without rows
        half = n.shards // 2
        n.left, n.right = Node(n.first, half), Node(n.first + half, n.shards - half)


def grown_tree(data: DataFrame, shards: int) -> Node:
    root = Node(0, shards)
    extremes = [f(f"v{k}").alias(f"{name}{k}") for k in range(len(DIMENSIONS)) for name, f in (("min", F.min), ("max", F.max))]
    r = data.agg(F.sum("size").alias("bytes"), *extremes).first()
    if r["bytes"] is None:
        return root
    spans = [r[f"max{k}"] - r[f"min{k}"] for k in range(len(DIMENSIONS))]
    while any(n.shards > 1 for n in leaves(root)):
        cut_level(data, root, spans, TOLERANCE * r["bytes"] / shards)
    return root


def with_slots(rows: DataFrame, order: list[str]) -> DataFrame:
    """A column ``slot``: the place in its shard, from 0 without gaps.

    Places are counted inside groups of bounded expected size and moved by the rows of the groups before.
    """
    shards = rows.agg(F.count("*").alias("n"), F.countDistinct("shard").alias("k")).first()
    groups = max(SLOT_GROUPS_AT_LEAST, -(-shards["n"] // (ROWS_PER_SLOT_GROUP * max(1, shards["k"]))))
    rows = rows.withColumn("_group", F.pmod(F.xxhash64("h", "crc", "size"), F.lit(groups)))
    inside = Window.partitionBy("shard", "_group").orderBy(*order)
    before = Window.partitionBy("shard").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("shard", "_group").agg(F.count("*").alias("_rows"))
    starts = sizes.select("shard", "_group", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    numbered = rows.withColumn("_place", F.row_number().over(inside) - 1)
    return numbered.join(starts, ["shard", "_group"]).withColumn("slot", (F.col("_start") + F.col("_place")).cast("long"))


def kd_shards(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every document; the law is ``bytes``."""
    data = stored(points(docs, id_col, text_col), "kd-points")
    root = grown_tree(data, shards)
    placed = data.withColumn("shard", F.expr(first_shard(root)).cast("int"))
    return with_slots(placed, ["crc", "h", "doc_id"]).select(
        "doc_id",
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
