"""Toxicity by a weighted lexicon, learned from labels and matched by Aho-Corasick on folded text.

Texts are folded first: lower case, look-alike letters to the Latin ones, and digits or signs that
stand for letters inside a word to those letters. The lexicon holds whole words and beginnings of words with the log odds
that labelled documents give them; phrases around a term that only harmless documents hold are
exceptions, which take its weight back. The sum of weights, also taken per 100 words, goes through a fitted logistic curve.

Nulls: a null or empty text has no terms and gets the score of a text without any; a null label or
id teaches nothing. Equal texts get equal scores. Texts of any length are matched whole, in one pass.
Without labels of both kinds the lexicon is empty and every score is the share of toxic labels.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from causalgrid.llm.common import arrow_batches, fresh, is_fold, stored

# Letters of other scripts that look like Latin ones, and what stands for a letter.
LOOKALIKES = str.maketrans(
    "аеорсухікмтвнјѕԁɡαοερτυνικıⅰ０１３４５７＠＄",
    "aeopcyxikmtbhjsdgaoeptuvikii013457@$",
)
STAND_INS = str.maketrans("013457@$!", "oieastasi")

WORD = re.compile(r"\w+")
STAND_IN = re.compile(r"(?<![^\W_])[\w@$!]*(?:[^\W\d_][013457@$!]+[^\W\d_]|(?<![^\W_])[013457@$!]+[^\W\d_]{2})[\w@$!]*")
MAY_STAND_IN = re.compile(r"[013457@$!][^\W\d_]")
MARKS = re.compile(r"[@$!]+(?!\w)")


@dataclass(frozen=True)
class ToxicityParams:
    """``sample`` bounds the labelled rows that the lexicon is learned from."""

    sample: int = 20_000
    lexicon: int = 5_000
    exceptions: int = 1_000
    documents_at_least: int = 4
    beginnings: tuple[int, ...] = (3, 4, 5, 6, 7, 8)
    surer_than: float = math.log(4)


def folded(text: str) -> str:
    """Words of ``text`` in folded form, each between single blanks."""
    text = text.lower()
    if not text.isascii():
        text = text.translate(LOOKALIKES)
    if MAY_STAND_IN.search(text):
        text = STAND_IN.sub(lambda m: MARKS.sub("", m[0]).translate(STAND_INS), text)
    return f" {' '.join(WORD.findall(text))} "


def features(text: str, beginnings: tuple[int, ...]) -> set[str]:
    """Whole words ("` word `") and beginnings ("` wor`") in a folded text."""
    found = set()
    for w in set(text.split(" ")):
        if w:
            found.add(f" {w} ")
            found.update(f" {w[:n]}" for n in beginnings if n <= len(w))
    return found


class Lexicon:
    """Terms with weights and exception phrases, ready to score folded texts."""

    def __init__(self, weights: dict[str, float], exceptions: dict[str, float], curve: tuple[float, float, float]):
        self.weights, self.exceptions, self.curve = weights, exceptions, curve
        self._automaton = None

    def __getstate__(self):
        return (self.weights, self.exceptions, self.curve)

    def __setstate__(self, state):
        self.__init__(*state)

    def automaton(self):
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for term, w in self.weights.items():
                self._automaton.add_word(term, (len(term), w))
            for phrase, w in self.exceptions.items():
                self._automaton.add_word(phrase, (len(phrase), -w))
            if self.weights:
                self._automaton.make_automaton()
        return self._automaton

    def matches(self, text: str) -> dict[int, float]:
        """Of a folded text: for each place where a word begins, the heaviest term there, less exceptions."""
        best: dict[int, float] = {}
        back: dict[int, float] = {}
        if self.weights:
            for end, (n, w) in self.automaton().iter(text):
                start = end - n + 1
                if w >= 0:
                    if w > best.get(start, 0.0):
                        best[start] = w
                else:  # an exception covers the terms that begin inside it
                    back.update((k, 0.0) for k in range(start, end))
        return {k: w for k, w in best.items() if k not in back}

    def inputs(self, text: str) -> tuple[float, float]:
        total = sum(self.matches(text).values())
        words = max(1, text.count(" ") - 1)
        return math.log1p(total), math.log1p(100.0 * total / words)

    def score(self, text: str) -> float:
        a, b = self.inputs(text)
        z = self.curve[0] + self.curve[1] * a + self.curve[2] * b
        return 1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, z))))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: ToxicityParams = ToxicityParams()) -> Lexicon:
    """A lexicon from the labelled documents whose crc32(doc_id as text) mod 5 is not 0.

    Of these labels at most ``params.sample`` rows, those with the least hashes of their ids, are
    used, so what is broadcast or gathered here has that bound.
    """
    arrow_batches(docs.sparkSession)
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~is_fold("doc_id", 0))
    one = usable.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    sample = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(params.sample)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    known = stored(texts.join(F.broadcast(sample), "doc_id").select("text", "toxic"), "toxicity-sample")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = Counter(), Counter()
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                seen[toxic].update(features(folded(text), params.beginnings))
        terms = list(seen[0].keys() | seen[1].keys())
        yield pa.record_batch(
            [pa.array(terms, pa.string()), pa.array([seen[1][t] for t in terms], pa.int64()), pa.array([seen[0][t] for t in terms], pa.int64())],
            names=["term", "toxic", "harmless"],
        )

    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    # where no label is known, nothing is called toxic
    prior = math.log((n1 + 0.5) / (n0 + 1.0))
    if not n1 or not n0:
        return Lexicon({}, {}, (prior, 0.0, 0.0))
    counts = known.mapInArrow(counted, "term string, toxic long, harmless long").groupBy("term").agg(
        F.sum("toxic").alias("a"), F.sum("harmless").alias("b")
    )
    weight = F.log((F.col("a") + 0.5) / (n1 + 1.0)) - F.log((F.col("b") + 0.5) / (n0 + 1.0))
    error = F.sqrt(1.0 / (F.col("a") + 0.5) + 1.0 / (F.col("b") + 0.5))
    chosen = (
        counts.where(F.col("a") >= params.documents_at_least)
        .withColumn("weight", weight)
        .where(F.col("weight") - error > params.surer_than)
        .orderBy(F.desc(F.col("a") * F.col("weight")), "term")
        .limit(params.lexicon)
    )
    weights = {r["term"]: float(r["weight"]) for r in chosen.collect()}
    plain = Lexicon(weights, {}, (prior, 0.0, 0.0))

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = Counter(), Counter()
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                text = folded(text)
                own = set()
                for at in plain.matches(text):
                    end = text.find(" ", at + 1)
                    before, after = text.rfind(" ", 0, at) if at else -1, text.find(" ", end + 1)
                    if before >= 0:
                        own.add(text[before : end + 1])
                    if after >= 0:
                        own.add(text[at : after + 1])
                seen[toxic].update(own)
        terms = list(seen[0].keys())
        yield pa.record_batch(
            [pa.array(terms, pa.string()), pa.array([0] * len(terms), pa.int64()), pa.array([seen[0][t] for t in terms], pa.int64())],
            names=["term", "toxic", "harmless"],
        )
        terms = list(seen[1].keys())
        yield pa.record_batch(
            [pa.array(terms, pa.string()), pa.array([seen[1][t] for t in terms], pa.int64()), pa.array([0] * len(terms), pa.int64())],
            names=["term", "toxic", "harmless"],
        )

    around = known.mapInArrow(phrases, "term string, toxic long, harmless long").groupBy("term").agg(
        F.sum("toxic").alias("a"), F.sum("harmless").alias("b")
    )
    harmless = around.where((F.col("a") == 0) & (F.col("b") >= params.documents_at_least)).orderBy(F.desc("b"), "term").limit(params.exceptions)
    exceptions = {r["term"]: 1.0 for r in harmless.collect()}
    lexicon = Lexicon(weights, exceptions, (prior, 0.0, 0.0))

    def inputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [lexicon.inputs(folded(t)) for t in batch.column("text").to_pylist()]
            yield pa.record_batch(
                [pa.array([p[0] for p in pairs], pa.float64()), pa.array([p[1] for p in pairs], pa.float64()), batch.column("toxic")],
                names=["a", "b", "toxic"],
            )

    rows = known.mapInArrow(inputs, "a double, b double, toxic int").toPandas()  # at most params.sample rows
    return Lexicon(weights, exceptions, fitted(rows[["a", "b"]].to_numpy(), rows["toxic"].to_numpy()))


def fitted(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic curve by Newton steps with a small ridge."""
    x, w = np.column_stack([np.ones(len(x)), x]), np.zeros(3)
    ridge = np.diag([1e-3, 0.05, 0.05])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1]), float(w[2])


def with_score(docs: DataFrame, lexicon: Lexicon, out: str, text_col: str = "text") -> DataFrame:
    """``docs`` with a double column ``out``; the other columns pass through as they are."""
    arrow_batches(docs.sparkSession)
    if fresh(docs, out) != out:
        raise ValueError(f"{out} is a column already")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [lexicon.score(folded(t or "")) for t in batch.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, out])

    return docs.mapInArrow(scored, StructType([*docs.schema.fields, StructField(out, DoubleType())]))


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    lexicon = learn(docs, labels, id_col, text_col, params)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scored = with_score(rows, lexicon, "score")
    return scored.select("doc_id", is_fold("doc_id", 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """The documents with a score under 0.5, under the columns of ``docs``."""
    lexicon = learn(docs, labels, id_col, text_col, params)
    out = fresh(docs, "_toxicity")
    return with_score(docs, lexicon, out, text_col).where(F.col(out) < 0.5).drop(out)
