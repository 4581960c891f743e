"""Plain-Python versions of the operators, for small tables."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import zlib

import numpy as np


def words(text):
    return (text or "").encode().lower().split()


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    own = [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
    return " ".join(own)


def docs_table(spark, rows):
    """``(doc_id, text)`` rows with columns whose names clash with results and inner names."""
    full = [(i, t, 7, "x", True, 1.5) for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, n_words int, row string, kept boolean, score double")


NASTY = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "two words"), (6, "é" * 3000), (7, "ab " * 4000), (8, "<|endoftext|> a\x0bb")]


def repeated_bytes(texts, length):
    seen = collections.Counter()
    data = [(t or "").encode() for t in texts]
    for b in data:
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] += 1
    out = []
    for b in data:
        covered = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                covered[i] += 1
                covered[i + length] -= 1
        c = np.cumsum(covered)[: len(b)] > 0
        runs = int((np.diff(np.r_[0, c.astype(int)]) == 1).sum())
        out.append((len(b), int(c.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~c].tobytes()).hexdigest()))
    return out


def shingles(text, width):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1)))


def components(rows, width, percent):
    """Of each row: the size of its set, and the least id it is linked with."""
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    least = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    best = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    return [(d, len(s), best[find(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def unigram(rows):
    """Of each row: held out, tokens, known tokens, all training tokens, base score."""
    own = [[*words(t), b"\n"] for _, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in rows]
    c = collections.Counter(w for ws, h in zip(own, held) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    return [
        (h, len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
        for ws, h in zip(own, held)
    ]
