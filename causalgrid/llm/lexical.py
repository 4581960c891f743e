"""Ranked lexical search by the Best Position Algorithm.

Documents are read once for the terms that the items ask for; what is kept of each is its length and the counts of these terms.
A shard of documents then has a list of each term's documents by falling impact. All lists of an item are read side by side;
a document that turns up is looked up in every other list, and each list notes which of its positions have been seen in either
way. No document left can score more than the impacts at the lists' best positions, up to which all have been seen; the search ends
where their sum is strictly below the k-th score, so ties are settled by all of their documents. A task keeps its best documents
from shard to shard, which ends later searches sooner; the best of all tasks are merged by a window that is limited before its shuffle.

Items come in blocks of bounded bytes, so the terms that tasks hold are bounded. Nulls: a null text has no terms, an item without any finds
nothing; null ids are ids that come last. Equal rows are documents or items of their own; ties go to the smaller ``doc_id``. Very
long texts count whole. Empty tables give an empty result. Only ids and texts are read, so other columns may clash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from causalgrid.llm.common import arrow_batches, stored, texts_of

#: Bytes of item texts whose terms are searched together.
BLOCK_BYTES = 8 << 20
#: Postings of a shard, and positions of each list that are read at first.
SHARD_POSTINGS, DEPTH = 2_000_000, 32
#: Lower-cases A to Z, keeps digits, letters and all bytes of other scripts, blanks the rest.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256))


@dataclass(frozen=True)
class Facts:
    """Of all documents: how many have terms, all terms of theirs, and each asked term's weight."""

    documents: int
    terms: int
    weights: np.ndarray


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def term_rows(docs: DataFrame, known: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, counts``: terms of each document, and how often it has which of the ``known`` ones."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_of(batches, "text"):
            size, offsets, terms, counts = [], [0], [], []
            for data in texts:
                own = terms_of(data)
                found = Counter(map(known.get, own))
                found.pop(None, None)
                size.append(len(own))
                terms.extend(found.keys())
                counts.extend(found.values())
                offsets.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x, pa.int32())) for x in (terms, counts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(size, pa.int64()), *lists], names=["doc_id", "n", "terms", "counts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(rows, f"doc_id {kind}, n long, terms array<int>, counts array<int>")


def facts_of(rows: DataFrame, size: int) -> Facts:
    """Counts over all documents; of ``size`` terms at most their document counts come to the driver."""

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["term", "df"])

    n, terms = rows.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(size, np.int64)
    for r in rows.select("terms").mapInArrow(frequencies, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r.term] = r.df
    weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * k + 1))) for k in df.tolist()]
    return Facts(n, terms, np.array(weights, np.int64))


class Shard:
    """Impact lists of the documents of a shard, numbered in the order of their ids."""

    def __init__(self, size: np.ndarray, lengths: np.ndarray, terms: np.ndarray, counts: np.ndarray, facts: Facts):
        self.documents = len(size)
        doc = np.repeat(np.arange(len(size)), lengths)
        m = 25 + 75 * size * facts.documents // max(facts.terms, 1)
        impact = facts.weights[terms] * (1_000_000_000 * counts // (1000 * counts + 8 * m[doc]))
        # by term and document, for direct accesses
        self.key = terms * self.documents + doc
        order = np.argsort(self.key)
        self.key, self.impact_of = self.key[order], impact[order]
        # by term and falling impact, for sorted ones
        self.by_impact = np.lexsort((self.key, -self.impact_of, self.key // max(self.documents, 1)))
        self.position = np.empty(len(order), np.int64)
        self.position[self.by_impact] = np.arange(len(order))
        self.begin = np.searchsorted(self.key, np.arange(len(facts.weights) + 1) * self.documents)

    def best(self, terms: np.ndarray, times: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores that may be among the best ``k``; documents that score ``floor`` or less may be left out.

        ``terms`` are different, ``times`` says how often the item has each.
        """
        begin, end = self.begin[terms], self.begin[terms + 1]
        have = end > begin
        terms, times, begin, end = terms[have], times[have], begin[have], end[have]
        docs, scores = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        met = np.zeros(self.documents, bool)
        seen = [np.zeros(n, bool) for n in (end - begin).tolist()]
        best = np.zeros(len(terms), np.int64)  # positions seen without a gap
        depth, step = 0, DEPTH
        top = np.empty(0, np.int64)
        while len(terms):
            # sorted access to the next positions of all lists
            stop = depth + step
            at = np.concatenate([self.by_impact[b + depth : min(b + stop, e)] for b, e in zip(begin.tolist(), end.tolist()) if b + depth < e] or [np.empty(0, np.int64)])
            new = np.unique(self.key[at] % self.documents)
            new = new[~met[new]]
            met[new] = True
            # direct access to the documents found, in every list
            if len(new):
                total = np.zeros(len(new), np.int64)
                for j, (t, n, b, e) in enumerate(zip(terms.tolist(), times.tolist(), begin.tolist(), end.tolist())):
                    own = self.key[b:e]
                    place = np.searchsorted(own, t * self.documents + new)
                    hit = np.flatnonzero(own[np.minimum(place, len(own) - 1)] == t * self.documents + new)
                    total[hit] += n * self.impact_of[b:e][place[hit]]
                    seen[j][self.position[b:e][place[hit]] - b] = True
                docs.append(new)
                scores.append(total)
                top = np.sort(np.r_[top, total])[-k:]
            for j, own in enumerate(seen):
                if best[j] < len(own):
                    rest = own[best[j] :]
                    gap = int(rest.argmin())
                    best[j] += len(rest) if rest[gap] else gap
            left = best < end - begin
            if not left.any():
                break
            last = self.by_impact[begin + np.maximum(best - 1, 0)]
            threshold = int((times * self.impact_of[last])[left].sum())
            if threshold < max(floor, int(top[0]) if len(top) == k else 0) or threshold == 0:
                break
            depth, step = stop, min(2 * step, 4_096)
        return np.concatenate(docs), np.concatenate(scores)


def best_documents(rows: DataFrame, items: list[tuple[int, np.ndarray, np.ndarray]], facts: Facts, k: int) -> DataFrame:
    """``q, doc_id, score``: the best ``k`` documents of each task for every item (number, terms, times)."""

    def merged(held: dict, q: int, ids: list, scores: np.ndarray) -> None:
        own = [*held.get(q, []), *((-s, d is None, d) for d, s in zip(ids, scores.tolist()) if s > 0)]
        held[q] = sorted(own, key=lambda x: (x[0], x[1], 0 if x[1] else x[2]))[:k]

    def search(held: dict, batches: list[pa.RecordBatch]) -> None:
        table = pa.Table.from_batches(batches)
        table = table.take(pc.sort_indices(table, [("doc_id", "ascending")], null_placement="at_end"))
        flat = [table.column(c).combine_chunks().flatten().to_numpy().astype(np.int64) for c in ("terms", "counts")]
        shard = Shard(table.column("n").to_numpy(), pc.list_value_length(table.column("terms")).to_numpy(), *flat, facts)
        ids = table.column("doc_id")
        for q, terms, times in items:
            own = held.get(q, [])
            floor = -own[-1][0] if len(own) == k else 0
            docs, scores = shard.best(terms, times, k, floor)
            if len(docs) > k:  # the best of the shard alone; numbers follow ids
                order = np.lexsort((docs, -scores))[:k]
                docs, scores = docs[order], scores[order]
            if len(docs):
                merged(held, q, ids.take(pa.array(docs)).to_pylist(), scores)

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        waiting, postings = [], 0
        for batch in batches:
            waiting.append(batch)
            postings += len(batch.column("terms").flatten())
            if postings >= SHARD_POSTINGS:
                search(held, waiting)
                waiting, postings = [], 0
        if waiting:
            search(held, waiting)
        flat = [(q, d, -s) for q, own in held.items() for s, _, d in own]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in flat], pa.int64()), pa.array([x[1] for x in flat], kind), pa.array([x[2] for x in flat], pa.int64())], names=["q", "doc_id", "score"]
        )

    name = rows.schema["doc_id"].dataType.simpleString()
    kind = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[name]
    return rows.where("size(terms) > 0").mapInArrow(searched, f"q long, doc_id {name}, score long")


def ranked(
    items: DataFrame, docs: DataFrame, k: int = 10, item_col: str = "item_id", item_text: str = "text", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each item the ``k`` documents of highest score above 0."""
    spark = docs.sparkSession
    arrow_batches(spark)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    asked = items.select(F.col(item_col).alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    asked = stored(asked.withColumn("q", F.monotonically_increasing_id()), "search-items")
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_BYTES))
    found = None
    for b in range(blocks):
        known: dict[bytes, int] = {}
        own = []
        for r in asked.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == b).collect():
            counts = Counter(known.setdefault(t, len(known)) for t in terms_of(r.text.encode()))
            if counts:
                own.append((r.q, np.array(list(counts.keys())), np.array(list(counts.values()))))
        rows = stored(term_rows(texts, known), "search-terms")
        part = best_documents(rows, own, facts_of(rows, len(known)), k)
        found = part if found is None else found.union(part)
    by = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return best.join(asked.select("q", "item_id"), "q").select("item_id", "rank", "doc_id", "score")
