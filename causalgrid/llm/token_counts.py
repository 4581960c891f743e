"""Token counts of a byte-level BPE by rank-synchronous array merging.

Pre-tokens of a batch of texts that were not met before are laid out as one ragged numpy array. In
each round every sequence merges all places of its own lowest-rank pair at once; sequences without a mergeable pair
are counted and leave. A document's count is the sum over its pre-tokens.

Nulls: a null text is empty and has no tokens; a null id stays null. Equal texts count alike. A very
long text is handled alone, so memory follows the longest text. Special tokens inside a text count once
each, as the tokenizer's file declares them. An empty table gives an empty table.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from causalgrid.llm.common import arrow_batches, texts_of

# Fixed value: how the byte-level scheme cuts a text into pre-tokens.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
NEVER = np.int32(2**31 - 1)
#: Pre-tokens whose counts a Python worker remembers; at the bound it starts over.
REMEMBERED = 600_000
CHUNK_BYTES = 2 << 20


def byte_letters() -> dict[str, int]:
    """The letter by which the vocabulary writes each byte: itself where printable, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class RaggedMerger:
    """Merge tables as arrays: pair keys in order, the rank of each, and what the pair becomes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.size = np.int64(max(vocab.values()) + 1)
        keys = np.array([vocab[a] * int(self.size) + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.first = np.zeros(256, np.int32)
        for letter, byte in byte_letters().items():
            self.first[byte] = vocab[letter]
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.cut = regex.compile(PRE_TOKEN)
        self.apart = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def pair_ranks(self, symbols: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Of each symbol with its right neighbour; ``last`` marks the ends of sequences."""
        key = symbols.astype(np.int64) * self.size
        key[:-1] += symbols[1:]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        rank = np.where(self.keys[at] == key, self.ranks[at], NEVER)
        rank[last] = NEVER
        return rank

    def counts(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols that survive in each of ``tokens``, none of which is empty."""
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        symbols = self.first[np.frombuffer(b"".join(tokens), np.uint8)]
        out, who = lengths.copy(), np.arange(len(tokens))
        while len(who):
            ends = np.cumsum(lengths)
            starts = ends - lengths
            rank = self.pair_ranks(symbols, ends - 1)
            lowest = np.minimum.reduceat(rank, starts)
            going = lowest != NEVER
            stay = np.repeat(going, lengths)
            out[who] = lengths
            symbols, rank = symbols[stay], rank[stay]
            who, lengths, lowest = who[going], lengths[going], lowest[going]
            if not len(who):
                break
            at = np.flatnonzero(rank == np.repeat(lowest, lengths))
            # of places that overlap, as in a run of one symbol, every second merges
            begins = np.r_[True, np.diff(at) != 1]
            run = np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
            at = at[(at - at[run]) % 2 == 0]
            symbols[at] = self.made[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols = symbols[keep]
            lengths = np.add.reduceat(keep.astype(np.int64), np.cumsum(lengths) - lengths)
        return out


class TokenCounter:
    """Counts tokens of texts, remembering the counts of pre-tokens up to a bound."""

    def __init__(self, path: str):
        self.merger, self.known = RaggedMerger(path), {}

    def learn(self, tokens: set[str]) -> None:
        new = list(tokens - self.known.keys())
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
            new = list(tokens)
        for k in range(0, len(new), 200_000):
            part = new[k : k + 200_000]
            self.known.update(zip(part, self.merger.counts([t.encode() for t in part]).tolist()))

    def count(self, texts: list[str]) -> list[int]:
        cut, apart = self.merger.cut, self.merger.apart
        tokens, special = [], []
        for text in texts:
            if apart is not None and any(s in text for s in self.merger.special):
                parts = apart.split(text)
                special.append(len(parts) - 1)
                tokens.append([t for p in parts for t in cut.findall(p)])
            else:
                special.append(0)
                tokens.append(cut.findall(text))
        self.learn(set().union(*tokens))
        count = self.known.__getitem__
        return [n + sum(map(count, own)) for n, own in zip(special, tokens)]


def counter(path: str) -> TokenCounter:
    """One for each Python worker and file: what it remembers serves later tasks as well."""
    held = sys.__dict__.setdefault("_llm_token_counters", {})
    if path not in held:
        held[path] = TokenCounter(path)
    return held[path]


def chunks(texts: list, most: int = CHUNK_BYTES) -> Iterator[list]:
    """Consecutive parts of ``texts`` of about ``most`` bytes, each of one text at least."""
    part, n = [], 0
    for t in texts:
        part.append(t)
        n += len(t)
        if n >= most:
            yield part
            part, n = [], 0
    if part:
        yield part


def token_counts(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every document."""
    arrow_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch, texts in texts_of(batches, "text"):
            n = [c for part in chunks(texts) for c in own.count([t.decode() for t in part])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array([k > limit for k in n], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(counted, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
