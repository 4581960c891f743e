"""Quality rules, toxicity, token counts, packing and SentencePiece on small and odd tables."""

import random
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
from brute import NASTY, docs_table, prose  # noqa: E402

import corpus_pipeline  # noqa: E402
from causalgrid.llm import packing, quality_rules, sentencepiece_lattice, token_counts, toxicity  # noqa: E402

BYTES, WORDS, PIECES = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json"), P.path("piece_bpe_32k.model")
LETTERS = [*"abzAZ09'sdt .,!?\n\t\x1c\x85\xa0 éÉΣςİß½²́\U0001f600<|>_-", "<|endoftext|>", "'LL", "don't", "  "]


def noise(seed, n, most=25):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(most))) for _ in range(n)]


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_empty_tables(spark):
    empty = docs_table(spark, [])
    assert quality_rules.quality_verdicts(empty).count() == 0
    assert token_counts.token_counts(empty, BYTES).count() == 0
    assert packing.packed_documents(empty, WORDS).count() == 0
    assert sentencepiece_lattice.piece_counts(empty, PIECES).count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.toxicity_scores(empty, labels).count() == 0


def test_quality_counts(spark):
    line = "the quick brown fox jumps over the lazy dog."
    rows = [(1, "\n".join([line] * 3)), (2, None), (3, "a b c a b c"), (4, "# | x\nfine words end here."), (5, "z " * 60)]
    r = by_id(quality_rules.quality_verdicts(docs_table(spark, rows)))
    assert (r[1].n_words, r[1].n_dup_lines, r[1].n_repeat_words) == (27, 2, 27)
    assert (r[2].n_words, r[2].base_failed, r[2].kept) == (0, True, False)
    assert r[3].n_repeat_words == 6
    assert (r[4].n_symbols, r[4].failed_lines) == (2, 1)
    assert r[5].base_failed


def test_quality_keeps_columns_and_cleans(spark):
    good = " ".join(f"word{k}" for k in range(80)) + "."
    rows = [(1, good), (2, good + "\nAll rights reserved by someone or other."), (3, "menu | home | about\n" * 40)]
    kept = quality_rules.keep_good(docs_table(spark, rows))
    assert kept.columns == ["doc_id", "text", "n_words", "row", "kept", "score"]
    assert {r.doc_id: r.text for r in kept.collect()} == {1: good, 2: good}


def test_quality_stage_keeps_prose_that_mentions_phrases(spark):
    own = lambda k: " ".join(f"word{k}x{j}" for j in range(40))
    clean = [f"{own(k)} {x} {own(k + 50)}." for k, x in enumerate(["design in", "catalog in", "dialog in", "analog in", "a privacy policy", "they log in"])]
    rows = [*enumerate(clean), (10, own(10) + "\nlong words follow here in the " + clean[0]), (11, f"{own(11)} {own(12)}.\nSign in, or click here to log in!")]
    rows.append((12, f"{own(13)} {own(14)}.\nThis work is licensed under the GNU General Public License, version 3."))
    rows.append((13, "Sign in. Log in. Privacy policy. Terms of use. Click here. " * 12))
    kept = {r.doc_id: r.text for r in corpus_pipeline.quality_stage(spark, docs_table(spark, rows), "").collect()}
    assert kept == {**{k: t for k, t in rows if k < 11}, 11: f"{own(11)} {own(12)}.", 12: f"{own(13)} {own(14)}."}


def test_quality_plan_holds_the_verdict_once(spark):
    """A condition on the verdict is not pushed below it, which would copy its expression."""
    df = docs_table(spark, [(1, "a b c.")])
    plan = lambda x: x._jdf.queryExecution().optimizedPlan().toString()
    judged, kept = plan(quality_rules.quality_verdicts(df)), plan(quality_rules.keep_good(df))
    for part in ("filter(", "split(", "aggregate("):
        assert kept.count(part) <= judged.count(part) + 1


def test_quality_rule_and_its_sql_agree_on_phrases(spark):
    import duckdb

    from causalgrid.llm import queries

    own = " ".join(f"word{k}" for k in range(30))
    lines = ["design in dialog in", "sign in", "Sign in log in click here", f"{own} privacy policy.", f"{own[:60]} sign in log in sign in, sign in log in.", "catalog in", "we use cookies_now here", "we use cookies!"]
    rows = [(k, f"{own} {own} x{k}.\n{line}\n{own} y{k}.") for k, line in enumerate(lines)] + [(99, None), (98, "")]
    got = {r.doc_id: (r.failed_lines, r.lost_chars, r.kept) for r in quality_rules.quality_verdicts(docs_table(spark, rows)).collect()}
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    sql = queries.ORACLE["op10_quality_rules"]
    want = {r[0]: r[1:] for r in con.execute(f"select doc_id, failed_lines, lost_chars, kept from ({sql})").fetchall()}
    assert got == want and [got[k][0] for k in range(8)] == [0, 1, 1, 0, 1, 1, 0, 1]


def test_quality_on_odd_rows(spark):
    assert quality_rules.quality_verdicts(docs_table(spark, NASTY)).count() == len(NASTY)
    assert quality_rules.quality_verdicts(docs_table(spark, NASTY)).where("kept").count() == 0


def test_toxicity_learns_words_and_beginnings(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for k in range(400):
        toxic = k % 4 == 0
        own = prose(k, 60).split()
        if toxic:
            own[rng.randrange(60)] = rng.choice(["nasty", "n4sty", "gruxa", "gruxo", "gruxi"])
        rows.append((k, " ".join(own)))
        labels.append((k, int(toxic)))
    labels = spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, toxic int")
    scored = by_id(toxicity.toxicity_scores(docs_table(spark, rows), labels))
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in scored.items())
    assert np.mean([r.predicted == (k % 4 == 0) for k, r in scored.items() if r.held_out]) > 0.97
    left = toxicity.without_toxic(docs_table(spark, rows), labels)
    assert left.columns == docs_table(spark, []).columns and 290 <= left.count() <= 310


def test_toxicity_matches_as_a_plain_search_does():
    """The automaton's matches are those of looking for every term at every place."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randrange(1, 6)))
    for _ in range(200):
        text = toxicity.folded(" ".join(word() for _ in range(rng.randrange(0, 40))))
        weights = {rng.choice([f" {w} ", f" {w}"]): rng.uniform(0.1, 5) for w in (word() for _ in range(rng.randrange(1, 12)))}
        exceptions = {p: 1.0 for p in (f" {word()} {word()} " for _ in range(rng.randrange(0, 6))) if p not in weights}
        covered = {k for p in exceptions for at in range(len(text)) if text.startswith(p, at) for k in range(at, at + len(p) - 1)}
        want = {}
        for at in range(len(text)):
            found = [w for t, w in weights.items() if text.startswith(t, at)]
            if found and at not in covered:
                want[at] = max(found)
        lexicon = toxicity.Lexicon(weights, exceptions, (0.0, 1.0, 1.0))
        assert lexicon.matches(text) == want
        total, words = sum(want.values()), max(1, len(text.split()))
        assert lexicon.inputs(text) == pytest.approx((np.log1p(total), np.log1p(100 * total / words)))


def test_toxicity_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    r = toxicity.toxicity_scores(docs_table(spark, NASTY), labels).collect()
    assert len(r) == len(NASTY) and all(0 <= x.score <= 1 for x in r)


@pytest.mark.parametrize(
    "text, want", [("1d10t", " idiot "), ("stup1d!", " stupid "), ("lo5er$$$ 100", " loser 100 "), ("сlоwn", " clown "), ("", "  ")]
)
def test_folding(text, want):
    assert toxicity.folded(text) == want


def test_exceptions_take_weight_back():
    lexicon = toxicity.Lexicon({" bad ": 2.0}, {" not bad ": 1.0}, (0.0, 1.0, 0.0))
    assert lexicon.matches(" bad day ") == {0: 2.0}
    assert lexicon.matches(" not bad day ") == {}


def test_token_counts_match_the_library(spark):
    texts = noise(1, 400) + [None, "", "a" * 5000, "aaaa " * 300, prose(1, 3000), "x<|endoftext|>y  <|endoftext|>"]
    library = Tokenizer.from_file(BYTES)
    r = by_id(token_counts.token_counts(docs_table(spark, list(enumerate(texts))), BYTES))
    for k, t in enumerate(texts):
        want = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (r[k].n_tokens, r[k].n_bytes, r[k].over_limit) == (want, len((t or "").encode()), want > 1024)
    assert token_counts.token_counts(docs_table(spark, NASTY), BYTES).count() == len(NASTY)


def test_word_ids_match_the_library():
    library, own = Tokenizer.from_file(WORDS), packing.WordIds(WORDS)
    for t in noise(2, 3000) + ["<|startoftext|>Hi", "ΑΣ ΑΣ."]:
        assert np.frombuffer(own.encode([t])[0], "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_word_ids_when_memory_begins_anew(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 50)
    library, own = Tokenizer.from_file(WORDS), packing.WordIds(WORDS)
    for k in range(5):
        texts = [prose(k, 40), prose(k + 10, 40)]
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == [e.ids for e in library.encode_batch(texts)]


@pytest.mark.parametrize("limits", [{}, {"most": 3, "per_shard": 40, "at_least": 9}])
def test_packing(spark, limits):
    rows = [(k, prose(k, random.Random(k).choice([0, 3, 50, 200, 900]))) for k in range(200)] + [(7, prose(7, 50)), (None, None)]
    size = 128
    r = packing.packed_documents(docs_table(spark, rows), WORDS, size, **limits).toPandas()
    library = Tokenizer.from_file(WORDS)
    ids = [[*library.encode(t or "", add_special_tokens=False).ids, 0] for _, t in rows]
    want = sorted(zlib.crc32(np.array(x[k : k + size], "<u4").tobytes()) for x in ids for k in range(0, len(x), size))
    assert sorted(r.ids_crc32) == want
    r = r.sort_values(["sequence_id", "offset"])
    ends = r.groupby("sequence_id").length.cumsum()
    assert (r.offset == ends - r.length).all() and ends.max() <= size
    assert r.sequence_id.nunique() <= 1.1 * -(-sum(map(len, ids)) // size) + 3


def test_open_sequences_close_the_fullest():
    own = packing.OpenSequences(10, 2)
    assert own.place(6) == (0, 0, None)
    assert own.place(7) == (1, 0, None)
    assert own.place(4) == (0, 6, None)  # full now
    assert own.place(8) == (2, 0, None)
    assert own.place(9) == (3, 0, 2)  # of 7 and 8 the fuller closes
    assert own.place(3) == (1, 7, None)


def test_sentencepiece(spark):
    texts = noise(3, 200) + [None, "", " ", "x" * 150, "a▁b ▁ c", "漢字 ok", "ab" * 60 + " the"]
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = docs_table(spark, list(enumerate(texts)))
    rows = sentencepiece_lattice.encode(docs, PIECES)
    got = {r.doc_id: r for r in rows.collect()}
    want = [library.encode(t or "") for t in texts]
    assert [got[k].ids for k in range(len(texts))] == want
    back = {r.row: r.text for r in sentencepiece_lattice.decode(rows, PIECES).collect()}
    assert [back[got[k].row] for k in range(len(texts))] == [(t or "").replace("▁", " ") for t in texts]
    for held in (5, 100_000):
        counts = by_id(sentencepiece_lattice.piece_counts(docs, PIECES, held_units=held))
        assert [(counts[k].n_pieces, counts[k].ids_sum) for k in range(len(texts))] == [(len(w), sum(w)) for w in want]


def test_lattice_tasks_grow_in_number_not_in_units(spark, monkeypatch):
    made = []

    def seen(units, path, encoded=sentencepiece_lattice.encoded_units):
        made.append(units.rdd.glom().map(len).collect())
        return encoded(units, path)

    monkeypatch.setattr(sentencepiece_lattice, "encoded_units", seen)
    monkeypatch.setattr(sentencepiece_lattice, "UNITS_A_SHARD", 20, raising=False)
    texts = [f"ord{k} och ord{k + 1}" for k in range(400)]
    r = by_id(sentencepiece_lattice.piece_counts(docs_table(spark, list(enumerate(texts))), PIECES, held_units=5))
    assert all(x["decodes"] for x in r.values())
    assert sum(made[0]) == 402 and len(made[0]) == 21 and max(made[0]) < 60


@pytest.mark.parametrize("held", [5, 100_000])
def test_sentencepiece_digests_see_order_and_decoding(spark, held):
    texts = noise(4, 60) + [None, "", "b a", "a b", "rare " * 3 + "other rare", "a▁b"]
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    r = by_id(sentencepiece_lattice.piece_counts(docs_table(spark, list(enumerate(texts))), PIECES, held_units=held))
    for k, t in enumerate(texts):
        assert r[k].ids_crc32 == zlib.crc32(np.array(library.encode(t or ""), "<u4").tobytes())
        assert r[k].decodes == ("▁" not in (t or ""))


def test_sentencepiece_shuffles_numbers_not_texts(spark, monkeypatch):
    """Texts are read and not written again, and frequent units leave their numbers."""
    made, keep = {}, sentencepiece_lattice.stored

    def seen(df, name):
        made[name] = keep(df, name)
        return made[name]

    monkeypatch.setattr(sentencepiece_lattice, "stored", seen)
    text = "one two one three " * 2_000
    r = by_id(sentencepiece_lattice.piece_counts(docs_table(spark, [(1, text), (2, ""), (3, "four")]), PIECES, held_units=4))
    ids = sentencepiece.SentencePieceProcessor(model_file=PIECES).encode(text)
    assert (r[1].n_chars, r[1].ids_crc32, r[1].decodes) == (len(text), zlib.crc32(np.array(ids, "<u4").tobytes()), True)
    assert "text" not in made["unit-parts"].columns and max(len(x.held or b"") for x in made["unit-parts"].collect()) < 500


def test_packed_numbers_come_back():
    for numbers in ([], [0], [1, 0, 300_000, 255, 256], list(range(70_000))):
        assert sentencepiece_lattice.numbers_in(sentencepiece_lattice.packed(numbers)) == numbers
