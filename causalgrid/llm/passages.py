"""Removal of passages that an earlier document has, found by compressed FM-indexes of shards.

A passage is a window of so many consecutive words that also starts in a document with a smaller id. Each window has a least
hash among its grams of words, so equal windows share such an anchor, at the same place in them. The segment around an anchor
holds all windows it can be least in. Anchors of one document alone prove that no window around them repeats. Equal segments are one,
owned by their least document; all others lose the whole of it. Of anchors with several different segments the segments are dealt
to shards by anchor, where an FM-index holds them; backward search over its wavelet matrix gives each segment's matching
statistics against earlier owners, and stretches as long as a window are reported. A group of more segments than a bound is
split by the anchor's place in the window: windows with it in a narrower range of places share a longer context, the key of the next
round, until the context is the whole window.

Words are runs without ASCII white space, compared as they are. Windows are judged on the input and never cross documents. Nulls: a null
text has no words; a document without an id is neither earlier nor later than any, so it stays whole. Rows with equal ids are documents of
their own, neither of them earlier. Very long texts are windowed whole; texts of fewer words stay as they are. An empty table gives
an empty table. Only the two named columns are read, so others may clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from causalgrid.llm.common import arrow_batches, stored, texts_of
from causalgrid.llm.fm_index import SegmentIndex
from causalgrid.llm.suffix_dedup import least_places, paired

#: Words in a window, and in the grams that anchor it.
WINDOW, GRAM = 50, 16
#: A group of more different segments is split by so many ranges of places.
GROUP, RANGES = 2_000, 6
#: Words that share an index, beyond which the next group begins another.
SHARD_WORDS = 1 << 18
#: A key with this share of all rows or more counts as hot; there are no more than twice its inverse.
HOT = 0.001
SPANS = "array<struct<begin:int,end:int>>"


def gram_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of all grams, joined from halves."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = 1
    while width < GRAM:
        h = paired(h[:-width], h[width:])
        width *= 2
    return h


def anchor_rows(texts: DataFrame, window: int) -> DataFrame:
    """``doc_id, k, place, anchor, segment`` for every anchor; places count words, ``segment`` hashes the words around."""
    places = window - GRAM + 1

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, own in texts_of(batches, "text"):
            row, at, gram, segment = [], [], [], []
            for k, data in enumerate(own):
                words = data.split()
                if len(words) < window:
                    continue
                h = gram_hashes(words)
                least = least_places(h, places)
                row.append(np.full(len(least), k))
                at.append(least)
                gram.append(h[least])
                segment.extend(xxhash.xxh3_64_intdigest(b" ".join(words[max(0, p - places + 1) : p + window]), seed=min(p, places - 1)) for p in least.tolist())
            if segment:
                rows = pa.array(np.concatenate(row))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(rows),
                        batch.column("k").take(rows),
                        pa.array(np.concatenate(at).astype(np.int32)),
                        pa.array(np.concatenate(gram).view(np.int64)),
                        pa.array(np.array(segment, np.uint64).view(np.int64)),
                    ],
                    names=["doc_id", "k", "place", "anchor", "segment"],
                )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.where("doc_id is not null").mapInArrow(found, f"doc_id {kind}, k long, place int, anchor long, segment long")


def keyed_join(rows: DataFrame, facts: DataFrame, keys: list[str], total: int) -> DataFrame:
    """``rows`` with the columns of ``facts``, one row a key, whose ``rows`` says how many rows have the key.

    Hot keys, of which there are ``2 / HOT`` at most, are broadcast, so that none of them meets in one task.
    """
    hot = F.col("rows") >= max(1, int(total * HOT))
    few = F.broadcast(facts.where(hot).drop("rows"))
    return rows.join(few, keys).unionByName(rows.join(few.select(*keys), keys, "left_anti").join(facts.where(~hot).drop("rows"), keys))


def segment_words(reps: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """Items (``node, group, low, high, left, owner, words``) for ``reps``: ``anchor, segment, rep (doc_id, k, place)``."""
    places = window - GRAM + 1
    asked = reps.groupBy("rep.doc_id", "rep.k").agg(F.collect_list(F.struct("rep.place", "anchor", "segment")).alias("asked"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, own in texts_of(batches, "text"):
            row, node, anchor, left, words = [], [], [], [], []
            for k, (data, wanted) in enumerate(zip(own, batch.column("asked").to_pylist())):
                split = data.split()
                for a in wanted:
                    p = a["place"]
                    row.append(k)
                    node.append(a["segment"])
                    anchor.append(a["anchor"])
                    left.append(min(p, places - 1))
                    words.append(b" ".join(split[max(0, p - places + 1) : p + window]))
                if k + 1 == len(own) or len(words) >= 20_000:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(node, pa.int64()), pa.array(anchor, pa.int64()), pa.array(left, pa.int32()), batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(words, pa.binary())],
                        names=["segment", "group", "left", "owner", "words"],
                    )
                    row, node, anchor, left, words = [], [], [], [], []

    kind = texts.schema["doc_id"].dataType.simpleString()
    items = texts.join(asked, ["doc_id", "k"]).select("doc_id", "text", "asked").mapInArrow(cut, f"segment long, group long, left int, owner {kind}, words binary")
    # rows that share an id and a text are asked alike
    one = items.groupBy("group", "segment").agg(*[F.first(c).alias(c) for c in ("left", "owner", "words")])
    return one.select(F.xxhash64("group", "segment").alias("node"), "group", F.lit(0).alias("low"), F.lit(places - 1).alias("high"), "left", "owner", "words")


def narrowed(items: DataFrame, window: int) -> DataFrame:
    """Items for parts of each item's range of places, with ``parent`` and ``parent_owner``; those without a whole window are left out."""
    low, high, left = F.col("low"), F.col("high"), F.col("left")
    width = F.ceil((high - low + 1) / RANGES).cast("int")
    cut = items.withColumn("all", F.split(F.col("words").cast("string"), " ")).withColumn("width", width)
    parts = cut.withColumn("x", F.explode(F.expr("sequence(low, high, width)"))).withColumn("y", F.least(F.col("x") + F.col("width") - 1, high))
    right, x, y = F.size("all") - left, F.col("x"), F.col("y")
    whole = parts.where(F.greatest(x, window - right) <= F.least(y, left))
    new_left = F.least(y, left)
    shared = F.slice("all", left - x + 1, x + window - y)
    own = F.slice("all", left - new_left + 1, new_left + F.least(window - x, right))
    return whole.select(
        F.col("node").alias("parent"),
        F.col("owner").alias("parent_owner"),
        F.xxhash64("group", x, y, F.array_join(shared, " ")).alias("group"),
        x.alias("low"),
        y.alias("high"),
        new_left.alias("left"),
        "owner",
        F.array_join(own, " ").cast("binary").alias("words"),
    ).withColumn("node", F.xxhash64("group", "left", "words"))


def repeated_spans(items: DataFrame, window: int) -> DataFrame:
    """``node, spans``: stretches of an item, counted from its anchor, that an item of an earlier owner in its group has too."""

    def searched(held: list[tuple]) -> pa.RecordBatch:
        known: dict[bytes, int] = {}
        segments = [np.array([known.setdefault(w, len(known)) for w in words.split()], np.int64) for _, _, _, words in held]
        owners = np.unique(np.array([o for _, _, o, _ in held]), return_inverse=True)[1]
        index = SegmentIndex(segments, owners)
        lengths = index.matching_lengths()
        at = np.flatnonzero(lengths >= window)
        own = np.searchsorted(index.begins, at, side="right") - 1
        # a match of places side by side ends no earlier than the one before, so the last one ends the stretch
        first = np.flatnonzero(np.r_[True, (np.diff(at) > 1) | (np.diff(own) > 0)][: len(at)])
        last = np.r_[first[1:], len(at)][: len(first)] - 1
        nodes = np.array([n for n, _, _, _ in held], np.int64)[own[first]]
        anchor = index.begins[own[first]] + np.array([x for _, x, _, _ in held])[own[first]]
        begin, end = at[first] - anchor, at[last] + lengths[at[last]] - anchor
        return pa.record_batch([pa.array(nodes), pa.array(begin.astype(np.int32)), pa.array(end.astype(np.int32))], names=["node", "begin", "end"])

    def sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, group = [], 0, None
        for batch in batches:
            for g, *item in zip(*(batch.column(c).to_pylist() for c in ("group", "node", "left", "owner", "words"))):
                if g != group and size >= SHARD_WORDS:
                    yield searched(held)
                    held, size = [], 0
                group = g
                held.append(tuple(item))
                size += item[-1].count(b" ") + 2
        if held:
            yield searched(held)

    dealt = items.select("group", "node", "left", "owner", "words").repartition("group").sortWithinPartitions("group", "node")
    found = dealt.mapInArrow(sharded, "node long, begin int, end int")
    return found.groupBy("node").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))


def all_spans(items: DataFrame, window: int, group: int) -> DataFrame:
    """``node, spans`` of all items with spans: small groups by an index, larger ones narrowed first."""
    items = stored(items, "passage-items")
    sizes = items.groupBy("group").agg(F.count("*").alias("items")).withColumn("rows", F.col("items"))
    sized = keyed_join(items, sizes, ["group"], items.count())
    own = stored(repeated_spans(sized.where((F.col("items") <= group) & (F.col("items") > 1)), window), "passage-spans")
    large = sized.where(F.col("items") > group)
    if not large.limit(1).count():
        return own
    parts = stored(narrowed(large, window), "passage-parts")
    # equal parts of one group are one item of the least owner; the others lose it whole
    merged = parts.groupBy("node").agg(
        *[F.first(c).alias(c) for c in ("group", "low", "high", "left", "words")], F.min("owner").alias("owner"), F.count("*").alias("parents")
    )
    merged = stored(merged, "passage-merged")
    below = all_spans(merged, window, group)
    size = F.size(F.split(F.col("words").cast("string"), " "))
    whole = F.array(F.struct((-F.col("left")).alias("begin"), (size - F.col("left")).alias("end"))).cast(SPANS)
    found = merged.select("node", "owner", F.col("parents").alias("rows"), whole.alias("whole")).join(below, "node", "left")
    spans = F.when(F.col("parent_owner") > F.col("owner"), F.col("whole")).otherwise(F.col("spans"))
    placed = keyed_join(parts.select("parent", "parent_owner", "node"), found, ["node"], parts.count())
    up = placed.select(F.col("parent").alias("node"), spans.alias("spans"))
    return own.union(up.where("spans is not null").groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans")))


def passage_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """``doc_id, k, spans`` (begin and end in words) for documents with repeated windows; ``k`` is the text's xxhash64."""
    if window < GRAM:
        raise ValueError(f"window must be {GRAM} at least")
    arrow_batches(docs.sparkSession)
    texts = keyed(docs, id_col, text_col)
    rows = stored(anchor_rows(texts, window), "passage-anchors")
    anchors = rows.groupBy("anchor").agg(F.count("*").alias("rows"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    shared = stored(keyed_join(rows, anchors.where("first < last").select("anchor", "rows"), ["anchor"], rows.count()), "passage-shared")
    facts = shared.groupBy("anchor", "segment").agg(F.count("*").alias("rows"), F.min(F.struct("doc_id", "k", "place")).alias("rep"))
    facts = stored(facts, "passage-segments")
    several = facts.groupBy("anchor").agg(F.count("*").alias("rows")).where("rows > 1")
    items = segment_words(keyed_join(facts.select("anchor", "segment", "rep"), several, ["anchor"], facts.count()), texts, window)
    spans = all_spans(items, window, group)
    judged = facts.withColumn("node", F.xxhash64("anchor", "segment")).join(spans, "node", "left")
    judged = stored(judged.select("anchor", "segment", "rows", F.col("rep.doc_id").alias("owner"), "spans"), "passage-judged")
    # a document after the segment's owner loses all of it; the owner what still earlier ones have
    whole = F.array(F.struct(F.lit(GRAM - window).alias("begin"), F.lit(window).alias("end"))).cast(SPANS)
    placed = keyed_join(shared, judged, ["anchor", "segment"], shared.count())
    own = placed.select("doc_id", "k", "place", F.when(F.col("doc_id") > F.col("owner"), whole).otherwise(F.col("spans")).alias("s")).where("s is not null")
    moved = F.transform("s", lambda s: F.struct((s.begin + F.col("place")).alias("begin"), (s.end + F.col("place")).alias("end")))
    return own.groupBy("doc_id", "k").agg(F.array_distinct(F.flatten(F.collect_list(moved))).alias("spans"))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("k"), text.alias("text"))


def without_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept`` for every document; ``kept`` joins the words that stay by one space."""
    texts = keyed(docs, id_col, text_col)
    found = passage_spans(docs, id_col, text_col, window, group)
    kind = texts.schema["doc_id"].dataType.simpleString()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, own in texts_of(batches, "text"):
            size, removed, digest, left = [], [], [], []
            for data, spans in zip(own, batch.column("spans").to_pylist()):
                words = data.split()
                gone = np.zeros(len(words) + 1, np.int64)
                for s in spans or ():
                    gone[max(0, s["begin"])] += 1
                    gone[min(len(words), s["end"])] -= 1
                kept = words if not spans else [w for w, g in zip(words, np.cumsum(gone).tolist()) if not g]
                text = b" ".join(kept)
                size.append(len(words))
                removed.append(len(words) - len(kept))
                digest.append(hashlib.sha256(text).hexdigest())
                left.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest), pa.array(left, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    out = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept string"
    return texts.join(found, ["doc_id", "k"], "left").select("doc_id", "text", "spans").mapInArrow(digests, out)
