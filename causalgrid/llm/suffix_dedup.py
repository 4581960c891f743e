"""Removal of byte strings that also start elsewhere, found by suffix arrays of shards.

Every string of ``LENGTH`` bytes has a least hash among its ``GRAM``-byte grams, so equal strings share such an
anchor. A document's anchors are the grams that are least in some string of it; the segment around an anchor
holds all strings that it can be least in. Anchors that occur once prove that no string around them repeats. Segments that are
equal are one, with a count. Of anchors with several different segments the segments are dealt to
shards by anchor; a shard's suffix array and permuted common prefixes show which of its strings repeat. A group of
more segments than a bound is split by the place of the anchor in the string: strings with the anchor in a narrower range of places
share a longer context, which is the key of the next round, until the groups fit or the context is the whole string.

Strings are judged on the input; matches never cross documents. Nulls: a null text is empty; a null id stays null. Equal rows
are documents of their own, so of texts as long as a string nothing is left. Very long texts are windowed whole. Texts
shorter than a string stay as they are. An empty table gives an empty table.

``without_repeats`` can take out runs of so many words as well, whatever their bytes: runs are anchored by least grams of words in the
same way, and around anchors that occur again the hashes of all runs are counted. Words are compared, not the white space between them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from causalgrid.llm.common import arrow_batches, fresh, stored, texts_of
from causalgrid.llm.suffix_array import common_prefixes, suffix_array

LENGTH, GRAM = 400, 64
#: Grams in a string; the anchor's place in it is 0 to PLACES - 1.
PLACES = LENGTH - GRAM + 1
#: A group of more segments is split; so many segments and bytes at most meet in one suffix array.
GROUP = 1_000
SHARD_BYTES = 1 << 20
COLUMNS = ("group", "node", "left", "origin", "count", "bytes")
#: Words in a gram of words.
WORD_GRAM = 16
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def gram_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of all grams; each step joins the hashes of two halves."""
    n = len(data)
    h = np.ndarray((n - 7,), "<u8", data, 0, (1,)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    width = 8
    while width < GRAM:
        h = paired(h[:-width], h[width:])
        width *= 2
    return h


def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of pairs of hashes."""
    h = a * np.uint64(0xD6E8FEB86659FD93) + b
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def sliding(f: np.ufunc, x: np.ndarray, width: int, fill: int) -> np.ndarray:
    """``f`` (minimum or maximum) over every ``width`` consecutive values."""
    n = len(x) - width + 1
    rows = -(-len(x) // width)
    padded = np.full(rows * width, fill, x.dtype)
    padded[: len(x)] = x
    blocks = padded.reshape(rows, width)
    ahead = f.accumulate(blocks, axis=1).ravel()
    back = f.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return f(back[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors; every string of ``LENGTH`` bytes holds one that is its least gram."""
    if len(data) < LENGTH:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = gram_hashes(data)
    places = least_places(h, PLACES)
    return places, h[places]


def least_places(h: np.ndarray, width: int) -> np.ndarray:
    """Places of hashes that are least among some ``width`` consecutive ones; all so many hold one that is their least."""
    least = sliding(np.minimum, h, width, 2**64 - 1)
    around = np.zeros(len(h) + width - 1, np.uint64)
    around[width - 1 : width - 1 + len(least)] = least
    places = np.flatnonzero(sliding(np.maximum, around, width, 0) == h)
    # of equal least grams near each other, as in a repeated phrase, only so many that no string lacks one
    close = (h[places[1:]] == h[places[:-1]]) & (np.diff(places) <= width)
    if close.any():
        keep, last = [], None
        for k, p in enumerate(places.tolist()):
            runs_on = k < len(close) and close[k]
            if not (k and close[k - 1]) or not runs_on or places[k + 1] > last + width:
                keep.append(k)
                last = p
        places = places[keep]
    return places


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, k1, k2, text``: two hashes name a text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("k1"), F.hash(text, F.octet_length(text)).alias("k2"), text.alias("text"))


def anchor_rows(texts: DataFrame) -> DataFrame:
    """``k1, k2, place, anchor, segment, left, size`` for every anchor; ``segment`` is a hash of its bytes."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, own in texts_of(batches, "text"):
            row, at, gram, segment, left, size = [], [], [], [], [], []
            for k, data in enumerate(own):
                places, hashes = anchors(data)
                begin = np.maximum(places - PLACES + 1, 0)
                end = np.minimum(places + LENGTH, len(data))
                row.append(np.full(len(places), k))
                at.append(places)
                gram.append(hashes)
                left.append(places - begin)
                size.append(end - begin)
                segment.extend(xxhash.xxh3_64_intdigest(data[b:e], seed=p - b) for b, e, p in zip(begin.tolist(), end.tolist(), places.tolist()))
            if segment:
                rows = pa.array(np.concatenate(row))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("k1").take(rows),
                        batch.column("k2").take(rows),
                        pa.array(np.concatenate(at).astype(np.int32)),
                        pa.array(np.concatenate(gram).view(np.int64)),
                        pa.array(np.array(segment, np.uint64).view(np.int64)),
                    ],
                    names=["k1", "k2", "place", "anchor", "segment"],
                )

    return texts.select("k1", "k2", "text").mapInArrow(found, "k1 long, k2 int, place int, anchor long, segment long")


def contents(reps: DataFrame, texts: DataFrame) -> DataFrame:
    """``node, group, low, high, left, origin, bytes, count`` for ``reps``: ``anchor, segment, count, rep (k1, k2, place)``.

    ``origin`` numbers the anchor's place among all texts.
    """
    one = texts.groupBy("k1", "k2").agg(F.min("doc_id").alias("doc_id"))
    asked = reps.groupBy("rep.k1", "rep.k2").agg(F.collect_list(F.struct("rep.place", "anchor", "segment", "count")).alias("asked"))
    asked = asked.join(one, ["k1", "k2"]).select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("doc_id").alias("_doc"), "asked")
    same = (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")) & F.col("doc_id").eqNullSafe(F.col("_doc"))
    cut = texts.join(asked, same).select("k1", F.col("text").cast("binary").alias("text"), F.explode("asked").alias("a"))
    left = F.least(F.col("a.place"), F.lit(PLACES - 1))
    return cut.select(
        F.xxhash64("a.anchor", "a.segment").alias("node"),
        F.col("a.anchor").alias("group"),
        F.lit(0).alias("low"),
        F.lit(PLACES - 1).alias("high"),
        left.alias("left"),
        (F.col("k1").bitwiseAND((1 << 62) - 1) + F.col("a.place")).alias("origin"),
        F.substring(F.col("text"), F.col("a.place") - left + 1, left + LENGTH).alias("bytes"),
        F.col("a.count").alias("count"),
    ).dropDuplicates(["node"])


def narrowed(items: DataFrame) -> DataFrame:
    """Both halves of each item's range of places, as items with ``parent``; those without a whole string are left out."""
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    halves = items.withColumn(
        "half", F.explode(F.array(F.struct(F.col("low").alias("x"), middle.alias("y")), F.struct((middle + 1).alias("x"), F.col("high").alias("y"))))
    )
    right = F.octet_length("bytes") - F.col("left")
    x, y = F.col("half.x"), F.col("half.y")
    whole = halves.where((x <= y) & (F.greatest(x, LENGTH - right) <= F.least(y, F.col("left"))))
    new_left = F.least(y, F.col("left"))
    cut = F.substring(F.col("bytes"), F.col("left") - new_left + 1, new_left + F.least(LENGTH - x, right))
    shared = F.substring(F.col("bytes"), F.col("left") - x + 1, x + LENGTH - y)
    return whole.select(
        F.col("node").alias("parent"),
        F.xxhash64("group", x, y, shared).alias("group"),
        x.alias("low"),
        y.alias("high"),
        new_left.alias("left"),
        "origin",
        cut.alias("bytes"),
        "count",
    ).withColumn("node", F.xxhash64("group", "left", "bytes"))


def repeated_spans(items: DataFrame) -> DataFrame:
    """``node, begin, end`` relative to the anchor: strings of items that repeat among the items of a shard.

    Groups come whole and in order; consecutive groups share a suffix array up to a bound of bytes.
    """

    def spans(nodes: list[int], lefts: list[int], origins: list[int], counts: list[int], pieces: list[bytes]) -> pa.RecordBatch | None:
        sizes = np.array([len(p) for p in pieces])
        begins = np.cumsum(sizes + 1) - sizes - 1
        text = np.zeros(int((sizes + 1).sum()), np.int32)
        joined = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
        text[:] = joined
        text += 2
        text[begins + sizes] = 1  # between segments, below all bytes
        sa = suffix_array(text, 258)
        before, prefix = common_prefixes(text, sa)
        # suffixes that share LENGTH bytes stand together in order; segments that overlap in one text show
        # a string more than once, so it repeats only if its places among all texts differ, or its segment occurs again
        offset = np.arange(len(text)) - np.repeat(begins + np.array(lefts), sizes + 1)
        place = (np.repeat(np.array(origins), sizes + 1) + offset)[sa]
        first = np.flatnonzero(np.r_[True, prefix[sa[1:]] < LENGTH])
        differ = np.minimum.reduceat(place, first) != np.maximum.reduceat(place, first)
        again = np.maximum.reduceat(np.repeat(np.array(counts), sizes + 1)[sa], first) > 1
        starts = np.zeros(len(text), bool)
        starts[sa] = np.repeat(differ | again, np.diff(np.r_[first, len(sa)]))
        # a string has to end inside its segment
        room = np.repeat(begins + sizes, sizes + 1) - np.arange(len(text))
        at = np.flatnonzero(starts & (room >= LENGTH))
        if not len(at):
            return None
        owner = np.searchsorted(begins, at, side="right") - 1
        new = np.r_[True, (np.diff(at) > LENGTH) | (np.diff(owner) != 0)]
        first, last = at[new], at[np.r_[np.flatnonzero(new)[1:] - 1, len(at) - 1]]
        own = owner[new]
        origin = begins[own] + np.array(lefts)[own]
        return pa.record_batch(
            [pa.array(np.array(nodes, np.int64)[own]), pa.array((first - origin).astype(np.int32)), pa.array((last + LENGTH - origin).astype(np.int32))],
            names=["node", "begin", "end"],
        )

    def sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, ...] = [], [], [], [], []
        size, group = 0, None
        for batch in batches:
            for g, node, left, origin, count, data in zip(*(batch.column(c).to_pylist() for c in COLUMNS)):
                if g != group and size >= SHARD_BYTES:
                    if (out := spans(*held)) is not None:
                        yield out
                    held, size = ([], [], [], [], []), 0
                group = g
                for x, v in zip(held, (node, left, origin, count, data)):
                    x.append(v)
                size += len(data)
        if size and (out := spans(*held)) is not None:
            yield out

    arrow_batches(items.sparkSession)
    dealt = items.select(*COLUMNS).repartition("group").sortWithinPartitions("group", "node")
    return dealt.mapInArrow(sharded, "node long, begin int, end int")


def all_spans(items: DataFrame, group: int) -> DataFrame:
    """``node, begin, end`` of all items: small groups by suffix arrays, larger ones narrowed first."""
    sizes = items.groupBy("group").agg(F.count("*").alias("items"), F.sum("count").alias("rows"))
    sized = stored(items.join(sizes, "group"), "segments")
    small, large = sized.where((F.col("items") <= group) & (F.col("rows") > 1)), sized.where(F.col("items") > group)
    own = stored(repeated_spans(small), "spans")
    if not large.limit(1).count():
        return own
    halves = stored(narrowed(large), "halves")
    # equal contexts of one group are one item
    merged = halves.groupBy("node").agg(
        *[F.first(c).alias(c) for c in ("group", "low", "high", "left", "origin", "bytes")], F.sum("count").alias("count")
    )
    below = all_spans(merged, group)
    return own.union(halves.select("parent", "node").join(below, "node").select(F.col("parent").alias("node"), "begin", "end"))


def document_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> DataFrame:
    """``k1, k2, spans`` for every text with repeated strings; spans are ``begin, end`` in bytes, unmerged."""
    arrow_batches(docs.sparkSession)
    texts = keyed(docs, id_col, text_col)
    rows = stored(anchor_rows(texts), "anchors")
    often = rows.groupBy("anchor").count().where("count > 1").select("anchor")
    shared = stored(rows.join(often, "anchor"), "shared-anchors")
    segments = shared.groupBy("anchor", "segment").agg(F.count("*").alias("count"), F.min(F.struct("k1", "k2", "place")).alias("rep"))
    several = segments.groupBy("anchor").agg(F.count("*").alias("different"))
    segments = stored(segments.join(several, "anchor"), "anchor-segments")
    items = contents(segments.where("different > 1"), texts)
    node = F.xxhash64("anchor", "segment").alias("node")
    spans = all_spans(items, group)
    # an anchor whose segments are all equal: the whole segment repeats
    whole = segments.where("different = 1").select(node, F.lit(1 - PLACES).alias("begin"), F.lit(LENGTH).alias("end"))
    placed = shared.select("k1", "k2", "place", node).distinct().join(spans.union(whole), "node")
    ends = F.struct((F.col("place") + F.col("begin")).alias("begin"), (F.col("place") + F.col("end")).alias("end"))
    return placed.groupBy("k1", "k2").agg(F.collect_set(ends).alias("spans"))


def word_grams(data: bytes) -> np.ndarray:
    """64-bit hashes of all grams of words; none of a text with fewer words."""
    words = data.split()
    if len(words) < WORD_GRAM:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = 1
    while width < WORD_GRAM:
        h = paired(h[:-width], h[width:])
        width *= 2
    return h


def word_spans(texts: DataFrame, words: int) -> DataFrame:
    """``k1, k2, spans`` for every text with runs of ``words`` words that start elsewhere as well. ``texts``: as ``keyed`` makes them."""
    if words < WORD_GRAM:
        raise ValueError(f"words must be {WORD_GRAM} at least")
    places = words - WORD_GRAM + 1
    # grams that cover a run, the last one up to its end
    covers = [*range(0, places - 1, WORD_GRAM), places - 1]

    def anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, own in texts_of(batches, "text"):
            row, at, gram = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
            for k, data in enumerate(own):
                if len(h := word_grams(data)) >= places:
                    least = least_places(h, places)
                    row.append(np.full(len(least), k))
                    at.append(least)
                    gram.append(h[least])
            rows = pa.array(np.concatenate(row))
            yield pa.RecordBatch.from_arrays(
                [batch.column("k1").take(rows), batch.column("k2").take(rows), pa.array(np.concatenate(at).astype(np.int32)), pa.array(np.concatenate(gram).view(np.int64))],
                names=["k1", "k2", "place", "anchor"],
            )

    def run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, own in texts_of(batches, "text"):
            for k, (data, anchors_) in enumerate(zip(own, batch.column("places").to_pylist())):
                h = word_grams(data)
                near = np.zeros(len(h) + 1, np.int64)
                anchors_ = np.array(anchors_)
                np.add.at(near, np.maximum(anchors_ - places + 1, 0), 1)
                np.add.at(near, anchors_ + 1, -1)
                first = np.flatnonzero(np.cumsum(near)[: len(h) - places + 1])
                hashes = h[first]
                for c in covers[1:]:
                    hashes = paired(hashes, h[first + c])
                found = np.array([m.span() for m in WORD.finditer(data)], np.int32)
                for b in range(0, len(first), 100_000):
                    part = first[b : b + 100_000]
                    rows = pa.array(np.full(len(part), k))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("k1").take(rows), batch.column("k2").take(rows), pa.array(found[part, 0]), pa.array(found[part + words - 1, 1]), pa.array(hashes[b : b + 100_000].view(np.int64))],
                        names=["k1", "k2", "begin", "end", "run"],
                    )

    rows = stored(texts.select("k1", "k2", "text").mapInArrow(anchored, "k1 long, k2 int, place int, anchor long"), "word-anchors")
    often = rows.groupBy("anchor").count().where("count > 1").select("anchor")
    shared = rows.join(often, "anchor").groupBy("k1", "k2").agg(F.collect_set("place").alias("places"))
    asked = texts.select("k1", "k2", "text").join(shared, ["k1", "k2"])
    runs = stored(asked.mapInArrow(run_rows, "k1 long, k2 int, begin int, end int, run long"), "word-runs")
    again = runs.groupBy("run").count().where("count > 1").select("run")
    return runs.join(again, "run").groupBy("k1", "k2").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))


def merged(spans: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes inside a text of ``size`` bytes."""
    out: list[list[int]] = []
    for b, e in sorted((max(0, b), min(size, e)) for b, e in spans):
        if out and b <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([b, e])
    return [(b, e) for b, e in out]


def with_spans(
    docs: DataFrame, out: str, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP, words: int | None = None
) -> DataFrame:
    """``docs`` with an array column ``out`` of the unmerged spans, null where nothing repeats; with ``words``, also of runs of so many words."""
    k1, k2 = fresh(docs, "_k1"), fresh(docs, "_k2")
    text = F.coalesce(F.col(text_col), F.lit(""))
    spans = document_spans(docs, id_col, text_col, group)
    if words is not None:
        both = spans.unionByName(word_spans(keyed(docs, id_col, text_col), words))
        spans = both.groupBy("k1", "k2").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    spans = spans.select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("spans").alias(out))
    keys = docs.withColumns({k1: F.xxhash64(text), k2: F.hash(text, F.octet_length(text))})
    return keys.join(spans, [k1, k2], "left").drop(k1, k2)


def removal_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spanned = with_spans(rows, "spans", "doc_id", "text", group)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_of(batches, "text"):
            size, removed, runs, digest = [], [], [], []
            for data, own in zip(texts, batch.column("spans").to_pylist()):
                cut = merged([(s["begin"], s["end"]) for s in own or ()], len(data))
                size.append(len(data))
                removed.append(sum(e - b for b, e in cut))
                runs.append(len(cut))
                digest.append(hashlib.sha256(without(data, cut)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(x, pa.int64()) for x in (size, removed, runs)], pa.array(digest)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return spanned.mapInArrow(digests, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without(data: bytes, cut: list[tuple[int, int]]) -> bytes:
    return b"".join(data[b:e] for b, e in zip([0, *[e for _, e in cut]], [*[b for b, _ in cut], len(data)]))


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP, words: int | None = None
) -> DataFrame:
    """``docs`` with repeated strings, and repeated runs of ``words`` words, taken out of their texts, at whole characters; ``n_chars`` follows."""
    out = fresh(docs, "_spans")
    spanned = with_spans(docs, out, id_col, text_col, group, words)

    @F.pandas_udf("string")
    def cleaned(text: pd.Series, spans: pd.Series) -> pd.Series:
        made = []
        for t, own in zip(text, spans):
            if own is not None and t is not None:
                data = t.encode()
                # a character cut in two loses its other bytes as well
                t = without(data, merged([(s["begin"], s["end"]) for s in own], len(data))).decode(errors="ignore")
            made.append(t)
        return pd.Series(made, dtype="object")

    done = spanned.withColumn(text_col, cleaned(F.col(text_col), F.col(out)))
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(F.col(out).isNotNull(), F.length(text_col).cast("long")).otherwise(F.col("n_chars")))
    return done.select(*docs.columns)
