"""Deduplication, scoring, sharding, neighbours and the pipeline against brute force."""

import collections
import pickle
import math
import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
from brute import NASTY, docs_table, prose  # noqa: E402

import corpus_pipeline  # noqa: E402
from causalgrid.llm import ann, lm_scoring, near_dedup, sharding, suffix_dedup  # noqa: E402
from causalgrid.llm.suffix_array import common_prefixes, suffix_array  # noqa: E402


def copies(n=120, seed=1):
    """Texts of their own, exact and near copies, shared passages, runs."""
    rng, rows = random.Random(seed), []
    shared = prose(999, 120)
    for k in range(n):
        text = prose(k, rng.choice([5, 40, 150]))
        kind = k % 6
        if kind == 1 and rows:
            text = rows[rng.randrange(len(rows))][1] or ""
        elif kind == 2 and rows:
            own = (rows[rng.randrange(len(rows))][1] or "x").split() or ["x"]
            own[rng.randrange(len(own))] = "changed"
            text = " ".join(own)
        elif kind == 3:
            text = f"{text} {shared} {prose(k + 5000, 30)}"
        rows.append((k, text))
    return rows + [(500, "ab" * 700), (501, "x" + "ab" * 400)]


@pytest.mark.parametrize("seed", range(3))
def test_suffix_arrays(seed):
    rng = random.Random(seed)
    for _ in range(300):
        b = bytes(rng.randrange(rng.choice([1, 2, 4])) for _ in range(rng.randrange(1, 70)))
        t = np.frombuffer(b, np.uint8)
        order = sorted(range(len(b)), key=lambda i: b[i:])
        sa = suffix_array(t.astype(np.int32) + 1, 257)
        assert sa.tolist() == order
        before, prefix = common_prefixes(t, sa)
        for i, j in zip(order, order[1:]):
            n = 0
            while max(i, j) + n < len(b) and b[i + n] == b[j + n]:
                n += 1
            assert (before[j], prefix[j]) == (i, n)


@pytest.mark.parametrize("group", [1000, 2])
def test_suffix_dedup(spark, group):
    rows = copies() + NASTY
    got = suffix_dedup.removal_digests(docs_table(spark, rows), group=group).collect()
    want = brute.repeated_bytes([t for _, t in rows], suffix_dedup.LENGTH)
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(want)
    assert sum(w[1] > 0 for w in want) > 20


def test_suffix_dedup_texts(spark):
    passage = "é" * 300
    rows = [(1, "a" + passage), (2, "bb" + passage), (3, "short"), (4, None)]
    left = suffix_dedup.without_repeats(docs_table(spark, rows))
    assert left.columns == docs_table(spark, []).columns
    assert {r.doc_id: r.text for r in left.collect()} == {1: "a", 2: "bb", 3: "short", 4: None}


def test_anchors_cover_every_string():
    for text in (prose(1, 400), "a" * 2000, "abc" * 700, ("x" * 90 + "y") * 30):
        data = text.encode()
        places, hashes = suffix_dedup.anchors(data)
        h = suffix_dedup.gram_hashes(data)
        own = dict(zip(places.tolist(), hashes.tolist()))
        for s in range(len(data) - suffix_dedup.LENGTH + 1):
            least = h[s : s + suffix_dedup.PLACES].min()
            assert any(own.get(p) == least for p in range(s, s + suffix_dedup.PLACES))


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, monkeypatch, width, percent):
    monkeypatch.setattr(near_dedup, "BLOCK", 400)
    rows = [r for r in copies(240, seed=width)] + [(600, None), (601, " "), (602, "one two"), (603, "ONE two"), (604, "one"), (700, "one two")]
    chain = prose(77, 60).split()
    for k in range(12):  # each close to the next, the ends far apart
        chain[5 * k % 60] = f"new{k}"
        rows.append((800 + k, " ".join(chain)))
    got = near_dedup.near_duplicates(docs_table(spark, rows), width, percent).collect()
    want = brute.components(rows, width, percent)
    key = lambda x: (x[0], x[1])
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=key) == sorted(want, key=key)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_of_odd_rows(spark):
    assert near_dedup.near_duplicates(docs_table(spark, NASTY)).count() == len(NASTY)
    assert near_dedup.near_duplicates(docs_table(spark, [])).count() == 0
    left = near_dedup.without_near_duplicates(docs_table(spark, NASTY))
    assert left.columns == docs_table(spark, []).columns
    assert left.where("text = 'one'").count() == 1


def test_near_duplicates_are_dropped_by_row(spark):
    a, b, c = (prose(k, 80, 5000) for k in (1, 2, 3))
    near = lambda t: t.replace(" ", " new ", 1)
    rows = [(1, a), (7, near(a)), (7, b), (None, c), (None, near(c)), (None, c)]
    left = near_dedup.without_near_duplicates(docs_table(spark, rows)).collect()
    assert {(r.doc_id, r.text) for r in left if r.doc_id is not None} == {(1, a), (7, b)}
    assert [r.text in (c, near(c)) for r in left if r.doc_id is None] == [True]
    mixed = [(None, a), (4, near(a))]
    assert [r.doc_id for r in near_dedup.without_near_duplicates(docs_table(spark, mixed)).collect()] == [4]


def test_estimates_follow_similarity():
    rng = np.random.default_rng(3)
    for common, own in ((900, 50), (300, 300), (20, 1)):
        pool = rng.integers(0, 2**63, common + 2 * own, np.uint64)
        a, b = np.unique(pool[: common + own]), np.unique(np.r_[pool[:common], pool[common + own :]])
        truth = common / (common + 2 * own)
        assert abs(near_dedup.estimated(near_dedup.registers(a), near_dedup.registers(b)) - truth) < 0.15


@pytest.mark.parametrize("held", [3, 10_000])
def test_language_scores(spark, held):
    rows = copies(80) + NASTY
    got = lm_scoring.language_scores(docs_table(spark, rows), held_words=held).toPandas()
    want = pd.DataFrame(brute.unigram(rows), columns=["h", "n", "k", "all", "base"])
    cols = ["held_out", "n_tokens", "n_known", "train_tokens", "base_score"]
    a, b = got[cols].sort_values(cols).to_numpy(float), want.sort_values(list(want.columns)).to_numpy(float)
    assert np.allclose(a, b, atol=1e-6)
    assert np.isfinite(got.score).all() and (got.score < 0).all()


def test_scores_do_not_depend_on_what_is_held(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "CLASSES", 0)  # classes are counted for held words alone
    docs = docs_table(spark, copies(60))
    a, b = (lm_scoring.language_scores(docs, held_words=h).toPandas().set_index("doc_id").score for h in (5, 10_000))
    assert np.allclose(a.sort_index(), b.sort_index(), atol=1e-6)


def test_words_share_one_unit_of_probability():
    """Over all words of one byte the model's probabilities stay below one, and learning raises those seen."""
    mixer = lm_scoring.Mixer(np.zeros(1 << lm_scoring.SLOT_BITS, np.float16), np.zeros(1 << lm_scoring.SLOT_BITS, np.float16))
    assert np.isclose(mixer.log10([b"a"])[0], 2 * np.log10(1 / 256), atol=1e-3)


def test_context_counts_are_whole(spark):
    """Slots with more than 60000 zeros and ones keep both, and so their ratio."""
    words = [(b"%c%06d" % (c, k),) for k in range(70_000) for c in b"aA"]
    zeros, ones = lm_scoring.context_table(spark.createDataFrame(words, "word binary"))
    bits = lm_scoring.Bits([w for w, in words])
    want = np.zeros((2, 1 << lm_scoring.SLOT_BITS))
    for b in range(8):
        bit, at = bits.bit(b)
        for slots in at:
            np.add.at(want[0], slots[~bit], 1)
            np.add.at(want[1], slots[bit], 1)
    assert ((want > 60_000).all(axis=0)).any()
    assert (zeros == want[0]).all() and (ones == want[1]).all()


def test_mixer_travels_as_small_as_what_it_counted():
    zeros, ones = np.zeros((2, 1 << lm_scoring.SLOT_BITS), np.float32)
    zeros[::1000], ones[5::1000] = 3, 70_000
    sent = pickle.dumps(lm_scoring.Mixer(zeros, ones, np.full((lm_scoring.GATES, lm_scoring.ORDERS), 0.7)))
    assert len(sent) < 1 << 20
    mixer = pickle.loads(sent)
    assert (mixer.zeros == zeros).all() and (mixer.ones == ones).all() and (mixer.weights == 0.7).all()
    assert mixer.log10([b"abc"]) == lm_scoring.Mixer(zeros, ones, mixer.weights.copy()).log10([b"abc"])


def test_bits_per_byte_follow_running_text(spark):
    """The same words cost more bits in an order that was not learned, and no cut of the texts changes a byte's contexts."""
    rows = [(k, prose(k, 60, 40)) for k in range(150)]
    rows += [(1000 + k, "alpha beta gamma delta " * 40) for k in range(20)]
    rows += [(2000 + k, "alpha delta gamma beta " * 40) for k in range(20) if brute.zlib.crc32(str(2000 + k).encode()) % 5 == 1] + [(3000, None)]
    got = lm_scoring.language_scores(docs_table(spark, rows)).toPandas().set_index("doc_id")
    assert np.isfinite(got.bits_per_byte).all() and (got.bits_per_byte > 0).all()
    held = got[got.held_out].bits_per_byte
    assert held[(held.index >= 1000) & (held.index < 2000)].max() < 0.8 * held[(held.index >= 2000) & (held.index < 3000)].min()
    assert held[held.index < 1000].mean() < 3.5

    texts = [(t or "").encode() for _, t in rows]
    whole = [np.concatenate([c for b, _ in lm_scoring.running(texts, most) for c in b.bit(3)[1][4:]]) for most in (7, 1 << 20)]
    assert (whole[0] == whole[1]).all() and len(whole[0]) == sum(len(t) + 1 for t in texts)


def plain_learning(mixer, bits, step):
    """One step of learning after another, byte for byte, without windows; the bits of each byte by the mixer before learning."""
    weights, cost = mixer.weights.copy(), np.zeros(len(bits.data))
    for begin in range(0, len(bits.data), step):
        for b in range(8):
            bit, at = bits.bit(b)
            grad, size = np.zeros_like(weights), np.zeros(len(weights))
            for i in range(begin, min(begin + step, len(bits.data))):
                x = {}
                for own in (0, 1):
                    n = [(max(mixer.zeros[s[i]] - own * (not bit[i]), 0), max(mixer.ones[s[i]] - own * bit[i], 0)) for s in at]
                    logit = np.array([math.log((n1 + 0.4) / (n0 + 0.4)) * (n0 + n1) / (n0 + n1 + 0.5) for n0, n1 in n])
                    x[own] = logit, max([k + 1 for k, (n0, n1) in enumerate(n) if n0 + n1], default=0) * 8 + b
                logit, gate = x[0]
                z = np.clip(logit @ mixer.weights[gate], -12, 12)
                p = 0.5 / (1 + math.exp(-z)) + 0.5 * mixer.refined[gate, int(np.clip(np.rint(z * 2) + lm_scoring.MAP_BINS // 2, 0, lm_scoring.MAP_BINS - 1))]
                cost[i] -= math.log2(p if bit[i] else 1 - p)
                logit, gate = x[1]
                z = np.clip(logit @ weights[gate], -12, 12)
                grad[gate] += logit * (bit[i] - 1 / (1 + math.exp(-z)))
                size[gate] += logit @ logit
            weights += 2.0 * grad / (size[:, None] / 2 + 10)
    return weights, cost


def test_equal_windows_are_worked_out_once_and_count_as_often():
    texts = [(prose(k, 8) or "").encode() for k in (1, 2, 1, 3, 1)]
    zeros, ones = np.zeros((2, 1 << lm_scoring.SLOT_BITS), np.float32)
    ((bits, _),) = lm_scoring.running(texts)
    for b in range(8):
        bit, at = bits.bit(b)
        for slots in at:
            np.add.at(ones, slots[bit], 1)
            np.add.at(zeros, slots[~bit], 1)
    for other in (bits, lm_scoring.Bits([b"the", b"other", b"the", b""])):
        mixer = lm_scoring.Mixer(zeros, ones)
        step = other.step = min(other.step, 100)
        weights, cost = plain_learning(mixer, other, step)
        assert np.allclose(-mixer.log10_of(other) / math.log10(2), cost, atol=1e-4)
        seen = np.zeros((2, lm_scoring.GATES, lm_scoring.MAP_BINS))
        mixer.learn(other, seen, mixer.stretched_without)
        assert np.allclose(mixer.weights, weights, atol=1e-4) and seen[0].sum() == 8 * len(other.data)
        assert seen[1].sum() == np.unpackbits(other.data).sum()
    ((many, _),) = lm_scoring.running(texts * 50)
    assert len(lm_scoring.Windows(many).data) == len(lm_scoring.Windows(bits).data) < len(many.data) / 50


def test_language_scores_of_nothing(spark):
    assert lm_scoring.language_scores(docs_table(spark, [])).count() == 0


def test_sharding(spark):
    rows = [(k, prose(k, random.Random(k).randrange(200))) for k in range(600)] + [(1000 + k, "same text of a group") for k in range(300)]
    rows += [(None, None), (5, prose(5, 3)), (5, prose(5, 3)), (9, "")]
    r = sharding.kd_shards(docs_table(spark, rows), 10).toPandas()
    assert sorted(r["size"]) == sorted(len((t or "").encode()) + 16 for _, t in rows)
    assert sorted(r.text_crc32) == sorted(zlib.crc32((t or "").encode()) for _, t in rows)
    total = r.groupby("shard")["size"].sum()
    assert len(total) == 10 and total.max() < 1.08 * total.mean() and total.min() > 0.92 * total.mean()
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in r.groupby("shard"))
    assert set(r.law) == {"bytes"} and r.grown_shard.isna().all()


def test_sharding_of_few_rows(spark):
    assert sharding.kd_shards(docs_table(spark, []), 4).count() == 0
    r = sharding.kd_shards(docs_table(spark, [(1, "a"), (2, "b")]), 4).toPandas()
    assert len(r) == 2 and r.shard.between(0, 3).all()


def neighbours(v, ids, q, k):
    s = (v * q).sum(axis=1)
    return ids[np.lexsort((ids, -s))[:k]].tolist()


def test_nearest(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(1500, 12)) * rng.uniform(0.5, 2, size=(1500, 1))
    v[200:500] = v[200]  # a group of equal vectors
    rows = [(k, x.tolist()) for k, x in enumerate(v)]
    odd = [(5000, None), (5001, [0.0] * 12), (5002, [float("nan")] + [1.0] * 11), (5003, [None] + [1.0] * 11), (5004, [float("inf")] * 12), (5020, [])]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    got = ann.nearest(table, table.where("vec_id % 20 = 0"), 10).toPandas().sort_values(["query_id", "rank"])
    ids, hits, n = np.arange(len(v)), 0, 0
    for q, g in got.groupby("query_id"):
        other = ids != q
        want = neighbours(v[other], ids[other], v[q], 10)
        hits += len(set(want) & set(g.vec_id))
        n += 10
        assert np.allclose(g.score, [(v[i] * v[q]).sum() for i in g.vec_id]) and g["rank"].tolist() == list(range(1, 11))
    assert n == 750 and hits / n >= 0.95
    same = got[got.query_id == 220].vec_id.tolist()
    assert same == neighbours(v[ids != 220], ids[ids != 220], v[220], 10)


@pytest.mark.parametrize("outliers", [[], [1e4], [1e9, 1e-9]])
def test_nearest_beside_outliers(spark, monkeypatch, outliers):
    """Few outlying lengths leave the others' neighbours alone, also in shards far larger than a beam."""
    monkeypatch.setattr(ann, "SHARDS", 1)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(60, 32))
    v = centres[rng.integers(0, 60, 4000)] + 0.4 * rng.normal(size=(4000, 32))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    for k, x in enumerate(outliers):
        v[k] *= x
    table = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = ann.nearest(table, table.where("vec_id % 40 = 7"), 10).toPandas()
    ids, hits, n = np.arange(len(v)), 0, 0
    for q in range(7, 4000, 40):
        other = ids != q
        hits += len(set(neighbours(v[other], ids[other], v[q], 10)) & set(got[got.query_id == q].vec_id))
        n += 10
    assert len(got) == n and hits / n >= 0.95


def test_nearest_of_few(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.nearest(empty, empty).count() == 0
    two = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in ann.nearest(two, two.where("vec_id = 0")).collect()] == [(0, 1, 1, 0.5)]


def test_pipeline(spark, tmp_path):
    good = [(k, " ".join(f"{w}" for w in prose(k, 120, 5000).split()) + ".") for k in range(60)]
    near = good[3][1].replace("w1", "w2", 1)
    rows = good + [(100, good[5][1]), (101, near), (102, "menu | home | about\n" * 50), (103, None)]
    docs_table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 0) for k in range(60)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        seen[name] = docs
        if name != "packing":
            assert docs.columns == columns
    assert {r.doc_id for r in seen["near-dedup"].collect()} == set(range(60))
    packed = seen["packing"].toPandas()
    assert set(packed.doc_id) == set(range(60)) and packed.groupby("sequence_id").length.sum().max() <= 2048
    run = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert sorted(run.ids_crc32) == sorted(packed.ids_crc32)


def test_pipeline_takes_out_short_passages_and_toxic_documents(spark, tmp_path):
    """Shared passages of over 50 words have less than 400 bytes here; one of 50 words stays."""
    own = lambda k: " ".join(f"d{k}x{j}" for j in range(70))
    passages = [" ".join(f"p{n}{j}" for j in range(n)) for n in (51, 55, 65)]
    kept = " ".join(f"q{j}" for j in range(50))
    assert all(len(p) < 400 for p in passages)
    rows = [(10 * n + c, f"{own(10 * n + c)} {p} {own(1000 + 10 * n + c)}.") for n, p in enumerate(passages) for c in range(2)]
    rows += [(100 + c, f"{own(100 + c)} {kept} {own(200 + c)}.") for c in range(2)]
    rows.append((110, own(110) + " " + passages[0].replace(" ", "\n", 3) + " " + own(111) + "."))
    left = {r.doc_id: r.text for r in corpus_pipeline.suffix_dedup_stage(spark, docs_table(spark, rows), "").collect()}
    assert {k: t.split() for k, t in left.items() if k < 100 or k == 110} == {
        **{10 * n + c: f"{own(10 * n + c)} {own(1000 + 10 * n + c)}.".split() for n in range(3) for c in range(2)}, 110: f"{own(110)} {own(111)}.".split()
    }
    assert {left[k] for k in (100, 101)} == {t for k, t in rows if k in (100, 101)}

    toxic = [(1000 + k, own(30000 + k) + " nastyword " + own(40000 + k) + ".") for k in range(40)]
    clean = [(2000 + k, own(9000 + k) + " fine " + own(20000 + k) + ".") for k in range(80)]
    docs_table(spark, rows + toxic + clean).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(k, 1) for k, _ in toxic] + [(k, 0) for k, _ in clean]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
    end = {r.doc_id: r.text for r in docs.collect()}
    assert not end.keys() & {k for k, _ in toxic}
    assert end.keys() >= {k for k, _ in rows}
    assert not any(p in t for p in passages for t in end.values())


@pytest.mark.parametrize("words", [16, 20, 51])
def test_word_spans(spark, words):
    rows = [*copies(), (900, "again " * 300), (901, None)]
    own = [brute.words(t and t.lower()) for _, t in rows]
    seen = collections.Counter(tuple(w[k : k + words]) for w in own for k in range(len(w) - words + 1))
    want = []
    for w in own:
        cut = {j for k in range(len(w) - words + 1) if seen[tuple(w[k : k + words])] > 1 for j in range(k, k + words)}
        want.append(b" ".join(x for j, x in enumerate(w) if j not in cut))
    docs = suffix_dedup.keyed(docs_table(spark, rows), "doc_id", "text")
    found = {(r.k1, r.k2): r.spans for r in suffix_dedup.word_spans(docs, words).collect()}
    got = []
    for r in docs.collect():
        data = r.text.encode()
        got.append(b" ".join(suffix_dedup.without(data, suffix_dedup.merged([(s.begin, s.end) for s in found.get((r.k1, r.k2), ())], len(data))).split()))
    assert sorted(got) == sorted(want) and got != [b" ".join(w) for w in own]


def test_pipeline_on_odd_rows(spark, tmp_path):
    """Null and repeated ids through all stages: rows are documents of their own, copies go, and no document is lost with another of its id."""
    good = [prose(900 + k, 120, 3000) + "." for k in range(4)]
    rows = [*NASTY, (5, good[0]), (5, good[1]), (None, good[2]), (None, good[2]), (None, good[3]), (5, good[0])]
    spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, kept = docs_table(spark, rows), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns, name
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept.append(sorted((-1 if r.doc_id is None else r.doc_id, r.text) for r in docs.collect()))
    whole = sorted([(5, good[0]), (5, good[1]), (-1, good[2]), (-1, good[3])])
    assert [len(x) for x in kept] == [6, 6, 4, 4] and kept[-1] == whole
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert len(packed) == 4 and {r.doc_id for r in packed} == {5, None}


def test_pipeline_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs_table(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
