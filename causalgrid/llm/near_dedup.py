"""Near-duplicate documents by HyperMinHash sketches, banding, estimates and exact verification.

A document's distinct shingles are hashed; the hash picks one of ``REGISTERS`` buckets, and the bucket keeps
the most leading zeros it met together with the mantissa bits after them, which is a minimum hash in 16 bits. Empty
buckets borrow from a full one that a fixed hash of their number picks, so small sets band as well as large ones. Bands of
registers are the keys under which documents meet.

Documents with equal shingle sets are one class and never form pairs. Two rounds of stars come first: every class is
verified, on whole sets, with the most connected member of its buckets, that is, the one whose own buckets hold the most members;
connected components of the links follow. Then the members of a bucket that lie in different components are compared where they
meet: pairs whose collision-corrected estimate from the registers may reach the threshold are verified on whole sets, and of the links found
as many are passed on as join components. So links inside a group of copies are not spelled out, and no link between documents
of different components is lost. Buckets are compared in blocks of a bounded number of shingles, and a pair in the first
band only in which it meets.

Defined cases: a null or empty text, or one without words, has an empty set and is linked with nothing. With fewer words than a
shingle has, the whole sequence is the one shingle. Rows with equal ids are documents of their own that carry the same id; a null id
never names a component of documents with ids. Texts of any length are shingled whole. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from causalgrid.llm.common import arrow_batches, fresh, stored, texts_of

ROWS, BANDS = 8, 40
REGISTERS = ROWS * BANDS
MANTISSA_BITS = 10
#: Shingles of a bucket's members that are compared with as many others at a time.
BLOCK = 1_000_000
#: Estimates may fall below the threshold by so many standard errors before a pair is given up.
ERRORS = 5.0


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``width`` words, A-Z in lower case."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, map(b" ".join, zip(*[words[k:] for k in range(width)]))), np.uint64, len(words) - width + 1)
    return np.unique(hashed)


def _fixed_hash(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: An empty bucket looks at so many others before it takes the first full one.
LOOKS = 2_000


def registers(hashes: np.ndarray) -> np.ndarray:
    """16-bit registers: the leading zeros (6 bits) over the inverted mantissa, so that the greatest is the least hash."""
    out = np.zeros(REGISTERS, np.uint16)
    if not len(hashes):
        return out
    mixed = _fixed_hash(hashes)
    bucket = (mixed % np.uint64(REGISTERS)).astype(np.int64)
    rest = _fixed_hash(mixed + np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1 << MANTISSA_BITS)
    # the float's exponent gives the place of the leading bit; the bits after it are the mantissa
    high = (rest >> np.uint64(11)) | np.uint64(1)
    zeros = (53 - np.frexp(high.astype(np.float64))[1]).astype(np.uint64)
    after = (rest << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA_BITS)
    value = ((zeros + np.uint64(1)) << np.uint64(MANTISSA_BITS)) | (np.uint64((1 << MANTISSA_BITS) - 1) - after)
    np.maximum.at(out, bucket, value.astype(np.uint16))
    empty = np.flatnonzero(out == 0)
    full = out != 0
    filled = out.copy()
    for look in range(LOOKS):
        if not len(empty):
            break
        at = (_fixed_hash(empty.astype(np.uint64) + np.uint64(1 + look * REGISTERS)) % np.uint64(REGISTERS)).astype(np.int64)
        found = full[at]
        filled[empty[found]] = out[at[found]]
        empty = empty[~found]
    if len(empty):
        filled[empty] = out[np.flatnonzero(full)[0]]
    return filled


def estimated(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from rows of registers, less the share of registers that agree by chance.

    Different minima agree in a register of ``MANTISSA_BITS`` bits below a common count of zeros with a chance of about
    2**-MANTISSA_BITS / 3, the sum over counts of zeros of both having it, times the mantissa's chance.
    """
    chance = 2.0**-MANTISSA_BITS / 3
    same = (a == b).mean(axis=-1)
    return np.clip((same - chance) / (1 - chance), 0, 1)


def least_estimate(percent: int, sizes: np.ndarray) -> np.ndarray:
    """Pairs with estimates below this are given up. The error is that of the registers that ``sizes`` shingles fill."""
    t = percent / 100
    filled = REGISTERS * -np.expm1(-np.maximum(1, sizes) / REGISTERS)
    return t - ERRORS * np.sqrt(t * (1 - t) / filled)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text_key, text``; the id and the hash of the text name a row."""
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text"))


def sketches(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text_key, n_shingles, set_key, sketch`` for every row."""
    arrow_batches(docs.sparkSession)
    rows = keyed(docs, id_col, text_col)

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_of(batches, "text"):
            n, keys, own = [], [], []
            for t in texts:
                h = shingle_hashes(t, width)
                n.append(len(h))
                keys.append(xxhash.xxh3_64_intdigest(h.tobytes()) - (1 << 63) if len(h) else None)
                own.append(registers(h).tobytes() if len(h) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(n, pa.int64()), pa.array(keys, pa.int64()), pa.array(own, pa.binary())],
                names=["doc_id", "text_key", "n_shingles", "set_key", "sketch"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(sketched, f"doc_id {kind}, text_key long, n_shingles long, set_key long, sketch binary")


def band_keys(classes: DataFrame) -> DataFrame:
    """``band_key, band, id, n`` for every class and band; ``n`` is the size of its set."""

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint16).reshape(-1, BANDS, ROWS)
            keys = [xxhash.xxh3_64_intdigest(x.tobytes(), seed=k) for doc in own for k, x in enumerate(doc)]
            yield pa.record_batch(
                [
                    pa.array(np.array(keys, np.uint64).view(np.int64)),
                    pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(own))),
                    *[pa.array(np.repeat(np.asarray(batch.column(c)), BANDS)) for c in ("id", "n_shingles")],
                ],
                names=["band_key", "band", "id", "n"],
            )

    return classes.select("id", "n_shingles", "sketch").mapInArrow(banded, "band_key long, band int, id long, n long")


def shingle_sets(classes: DataFrame, docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """``id, own``: the whole sets of ``classes`` (``id, rep``), from the text of the row that stands for each."""
    wanted = classes.select("id", F.col("rep.doc_id").alias("_doc"), F.col("rep.text_key").alias("_key"))
    rows = keyed(docs, id_col, text_col)
    texts = rows.join(wanted, (F.col("text_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_doc"))).select("id", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, own in texts_of(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([shingle_hashes(t, width).tobytes() for t in own], pa.binary())], names=["id", "own"]
            )

    return texts.mapInArrow(sets, "id long, own binary")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs ``a, b`` of class ids those whose whole sets pass."""

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("own_a").to_pylist(), batch.column("own_b").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("own").alias("own_a")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("own").alias("own_b")), "b")
    return both.select("a", "b", "own_a", "own_b").mapInArrow(passing, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``id, label`` for every id of the links ``a, b``; the label is the least id of its component.

    Each round every id takes the least label around it, and then its label's label, so paths shorten
    by half or more. A round is written out before the next.
    """
    both = stored(links.union(links.select("b", "a")).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("label")), "labels")
    while True:
        around = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        near = labels.join(around, "id", "left").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        of_label = labels.select(F.col("id").alias("label"), F.col("label").alias("far"))
        # a label is an id too; its own label may be smaller
        moved = near.join(of_label, "label", "left").select("id", "old", F.least("label", "far").alias("label"))
        moved = stored(moved, "labels")
        labels = moved.select("id", "label")
        if not moved.where("label < old").limit(1).count():
            return labels


def star_pairs(buckets: DataFrame, tested: DataFrame | None = None) -> DataFrame:
    """Each class with the best connected member of its buckets that lies in another component.

    ``buckets``: ``band_key, id, label, degree``; ``tested``: pairs ``a, b`` that are not to come again.
    """
    hub = buckets.groupBy("band_key").agg(F.max(F.struct("degree", "id", "label")).alias("hub"))
    met = buckets.join(hub, "band_key").where("label <> hub.label")
    pairs = met.groupBy(F.col("hub.id").alias("a"), F.col("id").alias("b")).agg(F.max("hub.degree").alias("degree"))
    if tested is not None:
        pairs = pairs.join(tested, ["a", "b"], "left_anti")
    return pairs.groupBy("b").agg(F.max(F.struct("degree", "a")).alias("best")).select("best.a", "b")


def links_across(buckets: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between components that meet in a bucket; of those in one group only what joins components.

    ``buckets``: ``band_key, band, id, label, n``; ``classes``: ``id, sketch``; ``sets``: ``id, own``. A group gets two
    blocks of a bucket.
    """
    sizes = buckets.groupBy("band_key").agg(F.sum("n").alias("all"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    mixed = sizes.where("lo < hi").select("band_key", F.ceil(F.col("all") / BLOCK).cast("int").alias("blocks"))
    cut = buckets.join(mixed, "band_key").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "band_key", "band", "id", "label", "block", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y")
    )
    known = dealt.join(classes.select("id", "sketch"), "id").join(sets, "id")

    def compare(pdf):
        regs = np.frombuffer(b"".join(pdf["sketch"]), np.uint16).reshape(len(pdf), REGISTERS)
        own = [np.frombuffer(s, np.uint64) for s in pdf["own"]]
        ids, label, block = (pdf[c].to_numpy() for c in ("id", "label", "block"))
        n, label = np.array([len(s) for s in own]), label.copy()
        x, y, band = (int(pdf[c].iat[0]) for c in ("x", "y", "band"))
        a, b, places = [], [], np.arange(len(ids))
        for k in np.flatnonzero(block == x):
            # sizes alone rule many out
            fits = 100 * np.minimum(n, n[k]) >= percent * np.maximum(n, n[k])
            rest = np.flatnonzero((label != label[k]) & fits & ((block == y) if x != y else (places > k)))
            if not len(rest):
                continue
            same = regs[rest] == regs[k]
            chance = estimated(regs[rest], regs[k])
            earlier = same.reshape(len(rest), BANDS, ROWS)[:, :band].all(axis=2).any(axis=1)
            rest = rest[~earlier & (chance >= least_estimate(percent, np.minimum(n[rest], n[k])))]
            for at in range(0, len(rest), 256):
                part = rest[at : at + 256]
                part = part[label[part] != label[k]]
                if not len(part):
                    continue
                joined = np.concatenate([own[j] for j in part])
                found = np.minimum(np.searchsorted(own[k], joined), n[k] - 1)
                begins = np.cumsum(n[part]) - n[part]
                common = np.add.reduceat((own[k][found] == joined).astype(np.int64), begins)
                for j in part[100 * common >= percent * (n[part] + n[k] - common)]:
                    if label[j] != label[k]:
                        a.append(min(ids[j], ids[k]))
                        b.append(max(ids[j], ids[k]))
                        label[label == label[j]] = label[k]
        return pd.DataFrame({"a": a, "b": b}, dtype="int64")

    return known.groupBy("band_key", "x", "y").applyInPandas(compare, "a long, b long")


def row_components(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text_key, n_shingles, label, component_id`` for every row of ``docs``; ``label`` names a component even without ids.

    Links are pairs with 100 * intersection >= percent * union of the shingle sets.
    """
    rows = stored(sketches(docs, width, id_col, text_col), "sketches")
    full = rows.where("n_shingles > 0")
    # equal sets are one class, named by the hash of the set
    row = F.struct("doc_id", "text_key", "n_shingles", "sketch")
    grouped = full.groupBy(F.col("set_key").alias("id")).agg(F.min("doc_id").alias("least_doc"), F.max(row).alias("rep"))
    classes = stored(grouped.select("id", "least_doc", "rep", "rep.n_shingles", "rep.sketch"), "classes")
    banded = band_keys(classes)
    crowded = banded.groupBy("band_key").count().where("count > 1").select("band_key")
    buckets = stored(banded.join(crowded, "band_key"), "buckets")
    met = stored(classes.join(buckets.select("id").distinct(), "id", "left_semi").select("id", "rep", "n_shingles", "sketch"), "met")
    sets = stored(shingle_sets(met, docs, width, id_col, text_col).dropDuplicates(["id"]), "sets")

    crowd = buckets.groupBy("band_key").agg(F.count("*").alias("members"))
    degrees = stored(buckets.join(crowd, "band_key").groupBy("id").agg(F.sum("members").alias("degree")), "degrees")
    placed, links, tested, labels = buckets.withColumn("label", F.col("id")), None, None, None
    for last in (False, False, True):
        if last:
            found = links_across(placed, met, sets, percent)
        else:
            pairs = stored(star_pairs(placed.join(degrees, "id"), tested), "pairs")
            tested = pairs if tested is None else tested.union(pairs)
            found = verified(pairs, sets, percent)
        found = stored(found, "links")
        if found.limit(1).count():
            links = found if links is None else links.union(found)
            labels = components(links)
            placed = buckets.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    owner = classes.select("id", "least_doc", F.col("id").alias("label"))
    if labels is not None:
        owner = classes.select("id", "least_doc").join(labels, "id", "left").select("id", "least_doc", F.coalesce("label", "id").alias("label"))
    least = owner.groupBy("label").agg(F.min("least_doc").alias("component_id"))
    of_class = owner.join(least, "label").select(F.col("id").alias("set_key"), "label", "component_id")
    columns = ("doc_id", "text_key", "n_shingles", "label", "component_id")
    member = full.select("doc_id", "text_key", "n_shingles", "set_key").join(of_class, "set_key").select(*columns)
    alone = rows.where("n_shingles = 0").withColumns({"label": F.lit(None).cast("long"), "component_id": F.col("doc_id")})
    return member.union(alone.select(*columns))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``."""
    found = row_components(docs, width, percent, id_col, text_col).select("doc_id", "n_shingles", "component_id")
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def without_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, that of the least id and, of equal ids, the least hash of the text; null ids come last.

    Rows are named by id and text, so rows of one id may stay or go each by itself; of repeated rows one stays.
    """
    found = stored(row_components(docs, width, percent, id_col, text_col).where("label IS NOT NULL"), "row-components")
    named = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    best = found.groupBy("label").agg(F.min(named).alias("best"))
    id_, of_text, key = (fresh(docs, c) for c in ("_near_id", "_near_text", "_text_key"))
    dropped = found.join(best, "label").where(~named.eqNullSafe(F.col("best"))).select(F.col("doc_id").alias(id_), F.col("text_key").alias(of_text)).distinct()
    rows = docs.withColumn(key, F.xxhash64(text_col))
    left = rows.join(dropped, (F.col(key) == F.col(of_text)) & F.col(id_col).eqNullSafe(F.col(id_)), "left_anti")
    if docs.groupBy(id_col).count().where("count > 1").limit(1).count():
        left = left.dropDuplicates([id_col, key])
    return left.select(*docs.columns)
