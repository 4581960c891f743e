"""Groups of spelling variants: words one edit apart, found by Gram matrices of letter counts.

A word is a vector of letter counts. One inserted, deleted or replaced letter leaves two such vectors at a squared distance
of one or two, so NumPy products of blocks of words of equal and of adjacent lengths name all candidates, whose letters
are then compared. Blocks need not be the whole vocabulary: with the letters dealt to four sets, an edit changes
the counts of two sets at most, so near words agree on the counts of some two sets, which are the key of a block. A block of
more words than a bound is split again by dealing its free letters to four sets, and so on; no word or pair is left out.
A pair that meets in several blocks counts in the first one.

Nulls: a null text has no words, a null id counts as an empty text. Equal rows count each by itself. Very long texts are
read whole; a task holds a bounded number of words before it passes them on. Very long words are compared whole. Ties of ``n`` go to
the smaller word. An empty table gives an empty table. Only the two named columns are read, so others may clash.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from causalgrid.llm.common import arrow_batches, stored

#: Words that a task holds before it passes counts on.
HELD = 200_000
#: A block of more words is split.
BLOCK = 4_000
#: Words of small blocks that share one product, and rows of a product.
TILE = 256
#: Letter of each Latin-1 code: a to z, then U+00C0 to U+00FF; -1 where none is.
LETTER = np.full(256, -1)
LETTER[ord("a") : ord("z") + 1] = np.arange(26)
LETTER[0xC0:] = 26 + np.arange(64)
LETTERS = 90
#: The two of four letter sets that a key keeps; a pair counts at the first it agrees on.
KEPT = [(0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3)]
#: Lower-cases A to Z, keeps other letters, blanks the rest.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if LETTER[c] >= 0 else 32 for c in range(256))


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 6, damage: int | None = None) -> DataFrame:
    """``word, n`` for all letter runs of at least ``least`` letters, lower-cased.

    With ``damage``, a run whose crc32 of ``<id>:<run>`` it divides first loses the letter at crc32 modulo its length.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            kept = {w: n for w, n in held.items() if n}
            out = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in kept], pa.string()), pa.array(kept.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for own, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                words = [w for w in text.encode("latin-1", "replace").translate(FOLD).split() if len(w) >= least]
                held.update(words)
                if damage is not None:
                    begin = zlib.crc32(f"{own}:".encode())
                    for w in set(words):
                        h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), begin)
                        if h % damage == 0:
                            n = words.count(w)
                            held[w] -= n
                            if len(w) > least:
                                held[w[: h % len(w)] + w[h % len(w) + 1 :]] += n
                if len(held) >= HELD:
                    yield rows()
        if held:
            yield rows()

    arrow_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def letter_counts(words: list[bytes]) -> np.ndarray:
    """One row of letter counts a word."""
    sizes = np.array([len(w) for w in words], np.int64)
    codes = LETTER[np.frombuffer(b"".join(words), np.uint8)]
    rows = np.repeat(np.arange(len(words)), sizes)
    return np.bincount(rows * LETTERS + codes, minlength=len(words) * LETTERS).reshape(len(words), LETTERS)


def letter_sets(path: list[int]) -> np.ndarray:
    """The set (0 to 3) of each letter once the sets named by ``path`` are kept; -1 for letters that are."""
    free = np.arange(LETTERS)
    for step in path:
        free = free[~np.isin(np.arange(len(free)) % 4, KEPT[step])]
    sets = np.full(LETTERS, -1)
    sets[free] = np.arange(len(free)) % 4
    return sets


def counts_here(path: list[int], changed: np.ndarray) -> np.ndarray:
    """Whether a block at ``path`` is the first for pairs that differ in the ``changed`` letters (booleans by letter)."""
    here = np.ones(len(changed), bool)
    for depth, step in enumerate(path):
        sets = letter_sets(path[:depth])
        touched = np.stack([changed[:, sets == s].any(axis=1) for s in range(4)], axis=1)
        here &= ~touched[:, KEPT[step]].any(axis=1)
        for a, b in KEPT[:step]:
            here &= touched[:, a] | touched[:, b]
        if depth:  # letters kept before stay as they are
            here &= ~changed[:, sets < 0].any(axis=1)
    return here


def keyed(rows: DataFrame) -> DataFrame:
    """``path, key, word, n``: each word of ``path, word, n`` once for every two letter sets that may stay as they are."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path").to_pylist()
            counts = letter_counts([w.encode("latin-1") for w in batch.column("word").to_pylist()]).astype(np.uint32)
            for step, kept in enumerate(KEPT):
                key, new = [], []
                known: dict[tuple, np.ndarray] = {}
                for path, own in zip(map(tuple, paths), counts):
                    if path not in known:
                        known[path] = np.isin(letter_sets(list(path)), (-1, *kept))
                    key.append(xxhash.xxh3_64_intdigest(own[known[path]].tobytes()))
                    new.append([*path, step])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(new, pa.list_(pa.int32())), pa.array(np.array(key, np.uint64).view(np.int64)), batch.column("word"), batch.column("n")],
                    names=["path", "key", "word", "n"],
                )

    return rows.select("path", "word", "n").mapInArrow(keys, "path array<int>, key long, word string, n long")


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of letters of ``a`` that become those of ``b``, as long or longer by one, by one replaced or inserted letter."""
    size = a.shape[1]
    if b.shape[1] == size:
        return (a != b).sum(axis=1) == 1
    differ = a != b[:, :size]
    before = np.where(differ.any(axis=1), differ.argmax(axis=1), size)
    return ~((a != b[:, 1:]) & (np.arange(size) >= before[:, None])).any(axis=1)


def near_in_block(path: list[int], words: list[bytes], n: np.ndarray) -> dict[bytes, list]:
    """``[number of near words, largest n, its word]`` by word, over pairs that count in this block.

    Words of several blocks of one path may come together: pairs across them never count.
    """
    found: dict[bytes, list] = {}

    def note(word: bytes, other: bytes, k: int) -> None:
        own = found.setdefault(word, [0, 0, b""])
        own[0] += 1
        if k > own[1] or (k == own[1] and other < own[2]):
            own[1:] = k, other

    by_length: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        by_length.setdefault(len(w), []).append(k)
    for size, own in by_length.items():
        exact = np.float32 if size < 4_000 else np.float64
        for longer in (size, size + 1):
            others = by_length.get(longer, [])
            for i in range(0, len(own), TILE):
                left = own[i : i + TILE]
                a = letter_counts([words[k] for k in left]).astype(exact)
                for j in range(i if longer == size else 0, len(others), TILE):
                    right = others[j : j + TILE]
                    b = letter_counts([words[k] for k in right]).astype(exact)
                    distance = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
                    x, y = np.nonzero((distance > 0) & (distance <= 2))
                    if longer == size and i == j:
                        x, y = x[x < y], y[x < y]
                    if not len(x):
                        continue
                    letters = [np.frombuffer(b"".join(words[k] for k in side), np.uint8).reshape(len(side), -1) for side in (left, right)]
                    for at in range(0, len(x), 4_096):
                        p, q = x[at : at + 4_096], y[at : at + 4_096]
                        near = one_edit(letters[0][p], letters[1][q])
                        p, q = p[near], q[near]
                        here = counts_here(path, a[p] != b[q])
                        for k, m in zip(p[here].tolist(), q[here].tolist()):
                            note(words[left[k]], words[right[m]], n[right[m]])
                            note(words[right[m]], words[left[k]], n[left[k]])
    return found


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``word, n_near, best_n, best`` for the words of ``word, n`` that have a near word."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            found = near_in_block(list(path), list(held), np.array(list(held.values())))
            columns = [[w.decode("latin-1") for w in found], *[[v[k] for v in found.values()] for k in (0, 1)], [v[2].decode("latin-1") for v in found.values()]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["word", "n_near", "best_n", "best"])

        held: dict[bytes, int] = {}
        path, key = (), None
        for batch in batches:
            for p, k, w, n in zip(*(batch.column(c).to_pylist() for c in ("path", "key", "word", "n"))):
                if (p, k) != (path, key):
                    if held and (p != path or len(held) >= TILE):
                        yield rows()
                        held = {}
                    path, key = p, k
                held[w.encode("latin-1")] = n
        if held:
            yield rows()

    arrow_batches(words.sparkSession)
    large = words.select(F.array().cast("array<int>").alias("path"), "word", "n")
    parts = []
    # free letters halve with each split; where two are left, words agree on all others and a block is searched as it is
    while True:
        blocks = stored(keyed(large), "spelling-blocks")
        sizes = blocks.groupBy("path", "key").count()
        splits = F.size("path") < int(math.log2(LETTERS))
        crowded = stored(sizes.where((F.col("count") > block) & splits), "spelling-crowded")
        if crowded.limit(1).count():
            small = blocks.join(crowded, ["path", "key"], "left_anti")
            large = blocks.join(crowded.select("path", "key"), ["path", "key"], "left_semi")
        else:
            small, large = blocks, None
        dealt = small.repartition("path", "key").sortWithinPartitions("path", "key")
        parts.append(stored(dealt.mapInArrow(near, "word string, n_near long, best_n long, best string"), "spelling-near"))
        if large is None:
            break
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.w").alias("best"))


def spelling_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = 6,
    count: int = 5,
    ratio: int = 5,
    damage: int | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of at least ``least`` letters and ``count`` occurrences.

    A word's form is its most frequent near word if that is at least ``ratio`` times as frequent; ``root`` follows forms to the last.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 at least, so that forms lead upwards")
    words = stored(word_counts(docs, id_col, text_col, least, damage).where(F.col("n") >= count), "spelling-words")
    near = near_words(words, block)
    formed = F.col("best_n") >= F.col("n") * ratio
    rows = stored(
        words.join(near, "word", "left").select(
            "word",
            F.when(formed, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(formed, F.col("best_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    # each form is so many times as frequent, which bounds a chain; every round doubles the steps taken
    most = rows.agg(F.max("n")).first()[0] or 1
    steps = max(1, math.ceil(math.log(most, ratio)))
    roots = rows.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(max(0, steps - 1).bit_length()):
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = stored(roots.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
