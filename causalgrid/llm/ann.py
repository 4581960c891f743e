"""Nearest neighbours by inner product: a small-world graph per shard, all shards searched, results merged.

A shard's graph is a hierarchy of levels held as flat neighbour arrays: one row of neighbour numbers for each
member. It is built in batches of growing size: a batch is searched in the graph so far and linked, with diverse neighbours
preferred, then searched by the next. Graphs are written out, then every shard meets the queries in blocks of a bounded size; queries walk in step. Shards are about as many as
``SHARDS`` until they would pass ``SHARD_ROWS`` members, so the work of a search grows as queries do. Every shard returns its best ``k``
for each query; merging them keeps the best ``k`` of all.

A shard holds vectors whose lengths differ by less than a factor of two. They are scaled by the longest of them and given one more
component, so that inner products of any lengths become nearness on a sphere, which single precision can tell whatever other lengths occur.
Vectors that are null, zero, or hold a null or a non-finite component take no part. Only vectors of equal
dimension are compared. Equal vectors tie and are ordered by id; the query's own id is no candidate. Rows with
a null id take no part. Fewer candidates than ``k`` are all returned. An empty table gives an empty table.
"""

from __future__ import annotations


import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from causalgrid.llm.common import stored

SHARDS, SHARD_ROWS = 16, 100_000
#: Neighbours on the ground level and above, and candidates kept while building and searching.
GROUND, ABOVE = 32, 16
BUILD_WIDTH, SEARCH_WIDTH = 64, 96
QUERY_BLOCK, STEP = 4_096, 512


class SmallWorld:
    """Hierarchical navigable small-world graph over the rows of ``x``."""

    def __init__(self, x: np.ndarray, seed: int = 7):
        self.x, n = np.ascontiguousarray(x, np.float32), len(x)
        rng = np.random.default_rng(seed)
        levels = np.minimum((-np.log(rng.random(n)) / np.log(ABOVE)).astype(np.int64), 8)
        #: Members in the order of insertion, so that each level's members of higher levels come early.
        self.order = np.argsort(-levels, kind="stable")
        levels = levels[self.order]
        self.x = self.x[self.order]
        self.counts = [int((levels >= k).sum()) for k in range(int(levels[0]) + 1)] if n else []
        self.links = [np.full((c, GROUND if k == 0 else ABOVE), -1, np.int32) for k, c in enumerate(self.counts)]
        done = 0
        while done < n:
            size = min(max(1, done), 256, n - done)
            self._insert(np.arange(done, done + size))
            done += size

    @classmethod
    def held(cls, x: np.ndarray, order: np.ndarray, counts: list[int], links: list[np.ndarray]) -> SmallWorld:
        """A graph from its arrays."""
        made = cls.__new__(cls)
        made.x, made.order, made.counts, made.links = x, order, counts, links
        return made

    def _insert(self, new: np.ndarray) -> None:
        first = int(new[0])
        near = np.full((len(new), 1), 0, np.int32)
        for level in range(len(self.counts) - 1, -1, -1):
            member = new[new < self.counts[level]]
            there = min(first, self.counts[level])
            if not there:
                if len(member):
                    self._connect(level, member, np.full((len(member), 0), -1, np.int32))
                continue
            width = BUILD_WIDTH if len(member) else 1
            near, _ = self.search_level(self.x[new], near, level, width, there)
            if len(member):
                self._connect(level, member, near[new < self.counts[level]])

    def _connect(self, level: int, member: np.ndarray, found: np.ndarray) -> None:
        """Link ``member`` with diverse ones of what the search found and of their own batch, both ways."""
        most = self.links[level].shape[1]
        own = self.x[member] @ self.x[member].T
        np.fill_diagonal(own, -np.inf)
        take = min(BUILD_WIDTH // 2, len(member) - 1)
        batch = member[np.argpartition(-own, take - 1, axis=1)[:, :take]] if take > 0 else np.empty((len(member), 0), np.int64)
        back: dict[int, list[int]] = {}
        for k, i in enumerate(member):
            candidates = np.unique(np.r_[found[k][found[k] >= 0], batch[k]])
            chosen = self._diverse(i, candidates, most // 2 if len(candidates) > most // 2 else most)
            self.links[level][i, : len(chosen)] = chosen
            for j in chosen:
                back.setdefault(int(j), []).append(int(i))
        for j, more in back.items():
            row = self.links[level][j]
            all_ = np.unique(np.r_[row[row >= 0], more])
            all_ = all_[all_ != j]
            kept = all_ if len(all_) <= most else self._diverse(j, all_, most)
            row[:] = -1
            row[: len(kept)] = kept

    def _diverse(self, i: int, candidates: np.ndarray, most: int) -> np.ndarray:
        """Nearest first, those nearer to a chosen one than to ``i`` only while places are left."""
        if not len(candidates):
            return candidates
        v = self.x[candidates]
        to = v @ self.x[i]
        order = np.argsort(-to, kind="stable")
        candidates, v, to = candidates[order], v[order], to[order]
        among = v @ v.T
        chosen: list[int] = []
        nearest = np.full(len(candidates), -np.inf)
        for k in range(len(candidates)):
            if nearest[k] < to[k]:
                chosen.append(k)
                if len(chosen) == most:
                    break
                np.maximum(nearest, among[k], out=nearest)
        if len(chosen) < most:
            rest = np.setdiff1d(np.arange(len(candidates)), chosen)[: most - len(chosen)]
            chosen = [*chosen, *rest.tolist()]
        return candidates[chosen]

    def search_level(self, q: np.ndarray, entry: np.ndarray, level: int, width: int, there: int) -> tuple[np.ndarray, np.ndarray]:
        """The best ``width`` members of ``level`` (-1 where fewer) for each query, walking from ``entry``."""
        b = len(q)
        rows = np.arange(b)[:, None]
        seen = np.zeros((b, there + 1), bool)  # the last column stands for no member
        entry = np.where((entry >= 0) & (entry < there), entry, there)
        beam = np.full((b, width), there, np.int64)
        score = np.full((b, width), -np.inf, np.float32)
        spent = np.ones((b, width), bool)
        take = min(width, entry.shape[1])
        beam[:, :take] = entry[:, :take]
        s = np.einsum("bkd,bd->bk", self.x[np.minimum(beam[:, :take], there - 1)], q)
        score[:, :take] = np.where(beam[:, :take] < there, s, -np.inf)
        spent[:, :take] = beam[:, :take] == there
        seen[rows, beam] = True
        seen[:, there] = True
        links, active = self.links[level], np.arange(b)
        while len(active):
            open_score = np.where(spent[active], -np.inf, score[active])
            best = open_score.argmax(axis=1)
            going = open_score[np.arange(len(active)), best] > -np.inf
            active, best = active[going], best[going]
            if not len(active):
                break
            at = beam[active, best]
            spent[active, best] = True
            next_ = links[at].astype(np.int64)
            next_ = np.where((next_ < 0) | (next_ >= there), there, next_)
            fresh = ~seen[active[:, None], next_]
            next_ = np.where(fresh, next_, there)
            seen[active[:, None], next_] = True
            s = np.einsum("bkd,bd->bk", self.x[np.minimum(next_, there - 1)], q[active])
            s = np.where(next_ < there, s, -np.inf).astype(np.float32)
            all_score = np.concatenate([score[active], s], axis=1)
            all_beam = np.concatenate([beam[active], next_], axis=1)
            all_spent = np.concatenate([spent[active], next_ == there], axis=1)
            top = np.argpartition(-all_score, width - 1, axis=1)[:, :width]
            pick = np.arange(len(active))[:, None]
            beam[active], score[active], spent[active] = all_beam[pick, top], all_score[pick, top], all_spent[pick, top]
        order = np.argsort(-score, axis=1, kind="stable")
        beam, score = beam[rows, order], score[rows, order]
        return np.where(beam < there, beam, -1).astype(np.int32), score

    def search(self, q: np.ndarray, width: int) -> np.ndarray:
        """Rows of ``x`` near each query, -1 where fewer."""
        near = np.zeros((len(q), 1), np.int32)
        for level in range(len(self.counts) - 1, 0, -1):
            near, _ = self.search_level(q, near, level, 4, self.counts[level])
        near, _ = self.search_level(q, near, 0, width, self.counts[0])
        return np.where(near >= 0, self.order[np.maximum(near, 0)], -1)


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, v, dim`` of the vectors that take part, as doubles."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    given = rows.select(F.col(id_col).alias("vec_id"), v.alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
    good = given.where(F.forall("v", finite)).where(F.exists("v", lambda x: x != 0))
    return good.withColumn("dim", F.size("v"))


def distinct_vectors(data: DataFrame, keep: int) -> DataFrame:
    """``dim, v, ids``: every different vector once with its ``keep`` least ids; ties need no more."""
    least = Window.partitionBy("v").orderBy("vec_id")
    ranked = data.withColumn("_n", F.row_number().over(least)).where(F.col("_n") <= keep)
    return ranked.groupBy("dim", "v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def shard_graphs(vectors: DataFrame) -> DataFrame:
    """``dim, shard, graph``: the vectors, ids and flat neighbour arrays of each shard, as bytes."""
    most = F.array_max(F.transform("v", F.abs))
    of_most = F.sqrt(F.aggregate(F.transform("v", lambda x: x / most), F.lit(0.0), lambda a, x: a + x * x))
    banded = vectors.withColumn("band", F.floor(F.log2(most) + F.log2(of_most)).cast("int"))
    # a row for each dimension and power of two: some thousands for each dimension whatever the vectors
    counts = banded.groupBy("dim", "band").count()
    all_ = Window.partitionBy("dim")
    share = F.greatest(F.ceil(F.col("count") * SHARDS / F.sum("count").over(all_)), F.ceil(F.col("count") / SHARD_ROWS)).cast("int")
    before = F.coalesce(F.sum("shards").over(all_.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bands = counts.withColumn("shards", share).withColumn("first", before).select("dim", "band", "shards", "first")
    dealt = banded.join(F.broadcast(bands), ["dim", "band"]).select(
        "dim", "v", "ids", (F.col("first") + F.pmod(F.xxhash64("v"), F.col("shards"))).cast("int").alias("shard")
    )

    def built(key, own: pd.DataFrame) -> pd.DataFrame:
        own = own.iloc[np.argsort([i[0] for i in own["ids"]], kind="stable")]
        v = np.stack(own["v"].to_numpy())
        scaled = v / np.abs(v).max()
        scaled /= np.sqrt((scaled**2).sum(axis=1).max())
        last = np.sqrt(np.maximum(0.0, 1.0 - (scaled**2).sum(axis=1)))
        graph = SmallWorld(np.column_stack([scaled, last]))
        held = (v, [np.asarray(i) for i in own["ids"]], graph.x, graph.order, graph.counts, graph.links)
        return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "graph": [pickle.dumps(held, 5)]})

    return dealt.groupBy("dim", "shard").applyInPandas(built, "dim int, shard int, graph binary")


def nearest(rows: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", width: int = SEARCH_WIDTH) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries`` its ``k`` nearest rows of ``rows``, itself left out.

    Equal vectors are one node of a graph, however many rows have them.
    """
    vectors = stored(distinct_vectors(usable(rows, id_col, vector_col), k + 1), "vectors")
    asked = stored(usable(queries, id_col, vector_col), "query-vectors")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    graphs = stored(shard_graphs(vectors), "graphs")
    kind = asked.schema["vec_id"].dataType.simpleString()
    # every shard meets every block of queries: shards x blocks graphs, each with its block
    meeting = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    sent = asked.withColumn("block", block).join(graphs.select("dim", F.col("shard").alias("shard")), "dim").select(
        *[F.col(c).alias(c) for c in ("dim", "shard", "block", "vec_id", "v")]
    )

    def searched(key, graph: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        found = {"query_id": [], "vec_id": [], "score": []}
        if len(graph) and len(asks):
            v, ids, *arrays = pickle.loads(graph["graph"].iat[0])
            world = SmallWorld.held(*arrays)
            asks = asks.sort_values("vec_id", kind="stable")
            q_all, q_ids = np.stack(asks["v"].to_numpy()), asks["vec_id"].to_numpy()
            for at in range(0, len(q_all), STEP):
                q, qi = q_all[at : at + STEP], q_ids[at : at + STEP]
                unit = q / np.abs(q).max(axis=1, keepdims=True)
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                near = world.search(np.column_stack([unit, np.zeros(len(q))]).astype(np.float32), max(width, k + 1))
                for j in range(len(q)):
                    nodes = near[j][near[j] >= 0]
                    exact = (v[nodes] * q[j]).sum(axis=1)
                    own = np.concatenate([ids[n] for n in nodes])
                    score = np.repeat(exact, [len(ids[n]) for n in nodes])
                    other = own != qi[j]
                    own, score = own[other], score[other]
                    top = np.lexsort((own, -score))[:k]
                    found["query_id"].append(np.full(len(top), qi[j]))
                    found["vec_id"].append(own[top])
                    found["score"].append(score[top])
        return pd.DataFrame({c: np.concatenate(x) if x else [] for c, x in found.items()})

    keys = ("dim", "shard", "block")
    hits = meeting.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInPandas(searched, f"query_id {kind}, vec_id {kind}, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
