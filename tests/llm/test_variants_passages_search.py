"""Spelling variants, passages of earlier documents and ranked search against brute force, on small and odd tables."""

import collections
import hashlib
import math
import random
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from brute import NASTY, docs_table, prose  # noqa: E402

from causalgrid.llm import fm_index, lexical, passages, spelling  # noqa: E402


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- spelling variants ---------------------------------------------------------------------------------


def variants(rows, damage=None, least=6, count=5, ratio=5):
    n = collections.Counter()
    for own, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if own is None else own}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= least and k >= count}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    form, out = {}, {}
    links = {w: [v for v in n if near(w, v)] for w in n}
    for w, own in links.items():
        best = min(own, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= ratio * n[w] else None
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(links[w]), n[form[w]] if form[w] else None)
    return out


def spelled(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def misspelled(seed, words, copies=3):
    """Texts of long words, some with one letter changed, dropped or doubled, at very different counts."""
    rng = random.Random(seed)
    out = []
    for k in range(words):
        w = "".join(rng.choice("abcdeéÉ") for _ in range(rng.randrange(6, 9)))
        own = [w] * rng.choice((1, 6, 40))
        for _ in range(copies):
            i = rng.randrange(len(w))
            v = w[:i] + rng.choice(["", "x", w[i] * 2, "é"]) + w[i + 1 :]
            own += [v] * rng.choice((1, 5, 7))
        out.append((k, " ".join(own)))
    return out


@pytest.mark.parametrize("block", [4_000, 1])
def test_variants(spark, block):
    rows = misspelled(1, 60)
    got = spelled(spelling.spelling_groups(docs_table(spark, rows), block=block))
    want = variants(rows)
    assert got == want and any(v[0] for v in want.values()) and any(v[3] > 1 for v in want.values())


def test_variants_with_damage_on_odd_rows(spark):
    rows = [*NASTY, *misspelled(2, 30), (None, "Straße " * 40), (8, "ÀÉÎõü÷× " * 9), (9, "a" * 70_000 + " " + "ab" * 4), *[(k, "colour kolour") for k in range(600)]]
    rows += [(k, "b" + "a" * 5_000 + " " + "a" * 5_001) for k in range(5)]
    for damage in (199, 3):
        assert spelled(spelling.spelling_groups(docs_table(spark, rows), damage=damage)) == variants(rows, damage)


def test_variants_follow_forms_to_the_root(spark):
    words = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb"]
    rows = [(k, " ".join([w] * 5 ** (k + 1))) for k, w in enumerate(words)]
    got = spelled(spelling.spelling_groups(docs_table(spark, rows)))
    assert got == variants(rows) and {v[1] for v in got.values()} == {"aabbbb"}


def test_variants_of_nothing(spark):
    assert spelling.spelling_groups(docs_table(spark, [])).count() == 0
    assert spelling.spelling_groups(docs_table(spark, NASTY)).count() == 0


def test_variants_count_once_in_all_blocks():
    rng = np.random.default_rng(3)
    for path in ([1], [5, 0], [2, 3, 4]):
        changed = rng.random((50, spelling.LETTERS)) < 0.02
        for row in changed:
            if 1 <= row.sum() <= 2:
                firsts = 0
                for step in range(len(spelling.KEPT)):
                    firsts += bool(spelling.counts_here([*path[:-1], step], row[None])[0])
                within = all(spelling.counts_here(path[:k], row[None])[0] for k in range(1, len(path)))
                assert firsts == (1 if within else 0)


# --- passages ------------------------------------------------------------------------------------------


def earlier_windows(rows, window):
    own = [(d, (t or "").encode().split()) for d, t in rows]
    least = {}
    for d, w in own:
        for i in range(len(w) - window + 1):
            if d is not None:
                x = tuple(w[i : i + window])
                least[x] = min(d, least.get(x, d))
    out = []
    for d, w in own:
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and least[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((-1 if d is None else d, len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return sorted(out)


def removed(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in df.collect())


def passage_rows(seed):
    """Passages shared by many documents at all places, exact copies, repeated ids, repeats inside one document."""
    rng = random.Random(seed)
    shared = [prose(seed + k, n) for k, n in enumerate((50, 51, 60, 130))]
    rows = []
    for k in range(70):
        parts = [prose(1000 * seed + k, rng.randrange(0, 60)), rng.choice(shared), prose(2000 * seed + k, rng.randrange(0, 60))]
        rows.append((rng.randrange(60), "\n".join(parts[: rng.randrange(1, 4)])))
    twice = prose(99, 55)
    rows += rows[:9] + [(500 + k, t) for k, (_, t) in enumerate(rows[:9])]
    rows += [(7, twice + " x " + twice), (8, twice[:-1] + "z"), (None, shared[3]), (None, None), (1, "same " * 300), (2, "same " * 120), (3, "")]
    return rows


@pytest.mark.parametrize("group", [2_000, 5])
def test_passages(spark, group):
    rows = passage_rows(1)
    got = removed(passages.without_passages(docs_table(spark, rows), group=group))
    want = earlier_windows(rows, 50)
    assert got == want and sum(r[2] > 0 for r in want) > 30


def test_passages_of_another_width_on_odd_rows(spark):
    rows = [*NASTY, *passage_rows(2), (6, "é" * 3000), (9, "a\x85b\xa0c " * 200), (4, "a\x85b\xa0c " * 40)]
    assert removed(passages.without_passages(docs_table(spark, rows), window=20, group=9)) == earlier_windows(rows, 20)
    assert passages.without_passages(docs_table(spark, [])).count() == 0
    with pytest.raises(ValueError):
        passages.without_passages(docs_table(spark, rows), window=3)


def test_matching_lengths():
    for seed in range(25):
        r = np.random.default_rng(seed)
        segments = [r.integers(0, r.integers(1, 5), r.integers(1, 15)) for _ in range(r.integers(1, 9))]
        owners = r.integers(0, 4, len(segments))
        want = []
        for s, o in zip(segments, owners):
            for i in range(len(s)):
                most = 0
                for t in (t for t, p in zip(segments, owners) if p < o):
                    for j in range(len(t)):
                        k = 0
                        while i + k < len(s) and j + k < len(t) and s[i + k] == t[j + k]:
                            k += 1
                        most = max(most, k)
                want.append(most)
            want.append(0)
        assert fm_index.SegmentIndex(segments, owners).matching_lengths().tolist() == want


# --- ranked search -------------------------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def ranking(items, rows, k=10):
    own = [(d, collections.Counter(TERM.findall(lower(t)))) for d, t in rows]
    size = [sum(c.values()) for _, c in own]
    n, total = sum(s > 0 for s in size), sum(size)
    df = collections.Counter(t for _, c in own for t in c)
    out = []
    for item, text in items:
        scores = []
        for (d, c), s in zip(own, size):
            score = 0
            for t in TERM.findall(lower(text)):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * (25 + 75 * s * n // total)))
            if score > 0:
                scores.append((-score, d is None, d or 0))
        out += [(item, r + 1, None if no else d, -s) for r, (s, no, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def search(items, docs, **more):
    got = lexical.ranked(items, docs, **more)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def items_table(spark, rows):
    return spark.createDataFrame([(i, t, 3, 0.5) for i, t in rows], "item_id long, text string, rank int, score double")


def test_search(spark, monkeypatch):
    rows = [(k, prose(k, 5 + k % 90, 60 + k % 300)) for k in range(400)]
    rows += rows[:30] + [(1000 + k, t) for k, (_, t) in enumerate(rows[:30])]
    items = [(k, prose(7000 + k, 3 + 2 * k, 350)) for k in range(12)]
    want = ranking(items, rows)
    assert search(items_table(spark, items), docs_table(spark, rows)) == want
    # many small shards, short first reads
    monkeypatch.setattr(lexical, "DEPTH", 1)
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", 50)
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 300)
    assert search(items_table(spark, items), docs_table(spark, rows).repartition(3)) == want


def test_search_in_several_shards_of_a_task():
    """Best documents of a shard at a time, with the best so far as the floor, are those of all."""
    rng = np.random.default_rng(5)
    facts = lexical.Facts(300, 9000, rng.integers(0, 5000, 40))
    size = rng.integers(1, 90, 300)
    lists = [np.unique(rng.integers(0, 40, n)) for n in rng.integers(0, 20, 300)]
    counts = [rng.integers(1, 4, len(x)) for x in lists]
    terms, times = np.arange(0, 40, 3), rng.integers(1, 3, 14)

    def score(k):
        hit = {t: c for t, c in zip(lists[k].tolist(), counts[k].tolist())}
        m = 25 + 75 * size[k] * 300 // 9000
        return sum(int(q * facts.weights[t]) * (10**9 * hit[t] // (1000 * hit[t] + 8 * m)) for t, q in zip(terms.tolist(), times.tolist()) if t in hit)

    want = sorted(((-score(k), k) for k in range(300) if score(k) > 0))[:10]
    held = []
    for a in range(0, 300, 100):
        own = lists[a : a + 100]
        shard = lexical.Shard(size[a : a + 100], np.array([len(x) for x in own]), np.concatenate(own), np.concatenate(counts[a : a + 100]), facts)
        docs, scores = shard.best(terms, times, 10, -held[-1][0] if len(held) == 10 else 0)
        held = sorted([*held, *((-s, a + d) for d, s in zip(docs.tolist(), scores.tolist()) if s > 0)])[:10]
    assert held == want


def test_search_on_odd_rows(spark):
    rows = [*NASTY, (None, "two words"), (11, "ÄB äb Äb 7x"), (12, "_-!"), (13, "日本 語"), (14, "one " * 5000)]
    items = [(1, None), (2, ""), (3, "one ONE two"), (3, "one ONE two"), (None, "é äb Äb 語 日本"), (4, "nowhere"), (5, "ab " * 50)]
    assert search(items_table(spark, items), docs_table(spark, rows)) == ranking(items, rows)
    assert search(items_table(spark, []), docs_table(spark, rows)) == []
    assert search(items_table(spark, items), docs_table(spark, [])) == []


def test_search_ends_early():
    """Long lists are not read to their ends once no document left can be among the best."""
    n = 20_000
    facts = lexical.Facts(n, n * 50, np.array([10, 9000]))
    size = np.full(n, 50)
    lengths = np.where(np.arange(n) < 40, 2, 1)
    terms = np.concatenate([[0, 1] if k < 40 else [0] for k in range(n)])
    shard = lexical.Shard(size, lengths, terms, np.ones(len(terms), np.int64), facts)
    docs, scores = shard.best(np.array([0, 1]), np.array([1, 1]), 10, 0)
    assert len(docs) < 1_000 and np.sort(docs[np.lexsort((docs, -scores))][:10]).tolist() == list(range(10))
