"""SentencePiece encoding and decoding of a BPE model as relations.

Texts are cut into units, which pieces never cross: a run of blanks and what follows it. For every different unit its substrings
of bounded length are exploded and joined to the table of pieces, which has the model's size; the pieces found are the edges of
the unit's lattice, grouped by unit. The model ranks merges, so the best path by summed scores is not what it means: instead of
Viterbi, ``aggregate`` folds the steps of merging, each of which takes the best-ranked edge that spans exactly two symbols of
the path so far. A path is a number whose bits are the symbols' borders; units with more characters than it has bits are
merged by a small helper over the same table. Characters without a piece fall back to pieces for their bytes.

Nulls: a null text is empty and has no pieces; a null id stays null. Equal texts encode alike. Texts of any length are encoded whole.
An empty table gives an empty table. Decoding joins pieces, turns byte pieces into bytes and drops the blank that encoding puts first.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from causalgrid.llm.common import arrow_batches, stored, texts_of

BLANK = "▁"
#: Characters that the borders of a path in a long can hold.
LONG_BITS = 62
HELD_UNITS = 300_000
#: Different units whose edges one task groups, in memory.
UNITS_A_SHARD = 30_000
EMIT = 400_000


def pieces_of(path: str) -> list[tuple[str, int, int]]:
    """``piece, id, rank`` of all ordinary pieces."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
    own = [(model.id_to_piece(i), i, -model.get_score(i)) for i in range(model.vocab_size()) if not special(i)]
    # equal scores are told apart by nothing but the place in a text
    ranks = {s: k for k, s in enumerate(sorted({s for _, _, s in own}))}
    return [(p, i, ranks[s]) for p, i, s in own]


def byte_base(path: str) -> int:
    """The id of the piece for byte 0."""
    return sentencepiece.SentencePieceProcessor(model_file=path).piece_to_id("<0x00>")


def piece_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.createDataFrame(pieces_of(path), "piece string, id int, rank int")


def units_of(text: str) -> list[str]:
    """Units of a text, which starts after a blank of its own."""
    if not text:
        return []
    out, blanks = [], ""
    for part in text.replace(BLANK, " ").split(" "):
        blanks += BLANK
        if part:
            out.append(blanks + part)
            blanks = ""
    if blanks:
        out.append(blanks)
    return out


def merged_ids(unit: str, table: dict[str, tuple[int, int]], base: int) -> list[int]:
    """The same merging for one long unit, with a heap of the places where neighbours make a piece."""
    symbols, after, before = list(unit), list(range(1, len(unit) + 1)), list(range(-1, len(unit) - 1))
    heap: list[tuple[int, int, str]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < len(unit) and (both := symbols[i] + symbols[after[i]]) in table:
            heapq.heappush(heap, (table[both][1], i, both))

    for i in range(len(unit) - 1):
        offer(i)
    while heap:
        _, i, both = heapq.heappop(heap)
        if symbols[i] and after[i] < len(unit) and symbols[i] + symbols[after[i]] == both:
            j = after[i]
            symbols[i], symbols[j] = both, ""
            after[i] = after[j]
            if after[j] < len(unit):
                before[after[j]] = i
            offer(before[i])
            offer(i)
    return [k for s in symbols if s for k in ([table[s][0]] if s in table else [base + b for b in s.encode()])]


def encoded_units(units: DataFrame, path: str) -> DataFrame:
    """``unit, ids`` for different units; ``units`` is grouped by unit, and stays where it is."""
    spark = units.sparkSession
    base = byte_base(path)
    n = F.char_length("unit")
    spans = (
        units.where(n <= LONG_BITS)
        .select("unit", n.alias("n"), F.explode(F.sequence(F.lit(0), n - 1)).alias("s"))
        .select("unit", "n", "s", F.explode(F.expr("sequence(1, least(16, n - s))")).alias("size"))
        .withColumn("piece", F.expr("substring(unit, s + 1, size)"))
    )
    found = spans.join(F.broadcast(piece_table(spark, path)), "piece", "left").where("id IS NOT NULL OR size = 1")
    edge = F.expr(
        "struct(coalesce(rank, 2147483647) AS rank, s, (shiftleft(1L, s) | shiftleft(1L, s + size)) AS ends, "
        "shiftleft(shiftleft(1L, size - 1) - 1L, s + 1) AS inner, "
        f"CASE WHEN id IS NOT NULL THEN array(id) ELSE transform(sequence(1, octet_length(piece)), "
        f"k -> {base} + cast(conv(hex(substring(cast(piece AS binary), k, 1)), 16, 10) AS int)) END AS ids)"
    )
    lattice = found.groupBy("unit", "n").agg(F.sort_array(F.collect_list(edge)).alias("edges"))
    # from all borders, each step removes the border inside the best edge that spans two symbols
    path_of = lattice.withColumn("merges", F.expr("filter(edges, e -> e.inner <> 0)")).withColumn(
        "path",
        F.expr(
            "aggregate(slice(sequence(1, n), 1, least(n - 1, size(merges))), shiftleft(1L, n + 1) - 1L, (m, k) -> "
            "m & ~coalesce(get(filter(merges, e -> (m & e.ends) = e.ends AND bit_count(m & e.inner) = 1), 0).inner, 0L))"
        ),
    )
    used = F.expr("filter(edges, e -> (path & e.ends) = e.ends AND (path & e.inner) = 0L)")
    ids = F.expr("flatten(transform(array_sort(used, (a, b) -> a.s - b.s), e -> e.ids))")
    short = path_of.withColumn("used", used).select("unit", ids.alias("ids"))

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = {p: (i, r) for p, i, r in pieces_of(path)}
        for batch in batches:
            own = batch.column("unit").to_pylist()
            yield pa.record_batch([batch.column("unit"), pa.array([merged_ids(u, table, base) for u in own], pa.list_(pa.int32()))], names=["unit", "ids"])

    return short.unionByName(units.where(n > LONG_BITS).select("unit").mapInArrow(merged, "unit string, ids array<int>"))


def unit_counts(docs: DataFrame) -> DataFrame:
    """``unit, c``: how often each unit occurs; ``docs``: ``text``."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for _, texts in texts_of(batches, "text"):
            for text in texts:
                seen.update(units_of(text.decode()))
                if len(seen) > EMIT:
                    yield pa.record_batch([pa.array(list(seen)), pa.array(list(seen.values()), pa.int64())], names=["unit", "c"])
                    seen.clear()
        if seen:
            yield pa.record_batch([pa.array(list(seen)), pa.array(list(seen.values()), pa.int64())], names=["unit", "c"])

    return docs.select("text").mapInArrow(counted, "unit string, c long").groupBy("unit").agg(F.sum("c").alias("c"))


def packed(numbers: list[int]) -> bytes:
    """Numbers that are mostly small, in few bytes."""
    return zlib.compress(np.array(numbers, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def numbers_in(x: bytes) -> list[int]:
    return np.frombuffer(zlib.decompress(x), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().tolist()


def with_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", held_units: int = HELD_UNITS) -> DataFrame:
    """``row, doc_id, n_chars, sha256, ids``: every document with its ids in order and what tells its text; ``row`` numbers rows.

    The most frequent units are held by every worker, which writes their numbers and leaves gaps for the others; these are joined once
    for each document that has them. So texts are not shuffled, and ids are put in where they are used.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    counts = stored(unit_counts(rows), "unit-counts")
    shards = max(1, -(-counts.count() // UNITS_A_SHARD))
    units = stored(encoded_units(counts.select("unit").repartition(shards, "unit"), path), "units")
    most = counts.orderBy(F.desc("c"), "unit").limit(held_units)
    top = units.join(most, "unit").orderBy(F.desc("c"), "unit").select("unit", "ids").toArrow()  # at most held_units rows
    held = spark.sparkContext.broadcast((top.column("unit").to_pylist(), [np.array(x, "<i4").tobytes() for x in top.column("ids").to_pylist()]))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = dict(zip(held.value[0], itertools.count(1)))  # 0 is a gap
        row = TaskContext.get().partitionId() << 36
        for batch, texts in texts_of(batches, "text"):
            numbers, chars, hashes, rare_row, rare, gaps = [], [], [], [], [], []
            for k, text in enumerate(texts):
                own = units_of(text.decode())
                found = [known.get(u, 0) for u in own]
                more: dict[str, list[int]] = {}
                for n, at in enumerate(i for i, x in enumerate(found) if not x):
                    more.setdefault(own[at], []).append(n)
                rare_row.extend([row + k] * len(more))
                rare.extend(more)
                gaps.extend(more.values())
                numbers.append(packed(found))
                chars.append(len(text.decode()))
                hashes.append(hashlib.sha256(text).digest())
            n, m = len(texts), len(rare)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.r_[np.arange(row, row + n), np.array(rare_row, np.int64)]),
                    pa.concat_arrays([batch.column("doc_id"), pa.nulls(m, batch.column("doc_id").type)]),
                    pa.array(chars + [None] * m, pa.int64()),
                    pa.array(hashes + [None] * m, pa.binary()),
                    pa.array(numbers + [None] * m, pa.binary()),
                    pa.array([None] * n + rare, pa.string()),
                    pa.array([None] * n + gaps, pa.list_(pa.int32())),
                ],
                names=["row", "doc_id", "n_chars", "sha256", "held", "unit", "gaps"],
            )
            row += n

    own = f"row long, doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_chars long, sha256 binary"
    made = stored(rows.mapInArrow(parts, f"{own}, held binary, unit string, gaps array<int>"), "unit-parts")
    rare = made.where("unit IS NOT NULL").select("row", "unit", "gaps").join(units, "unit")
    more = rare.groupBy("row").agg(F.collect_list("gaps").alias("gaps"), F.collect_list("ids").alias("more"))

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = [b"", *held.value[1]]
        for batch in batches:
            out = []
            for numbers, gaps, found in zip(*(batch.column(c).to_pylist() for c in ("held", "gaps", "more"))):
                numbers = numbers_in(numbers)
                whole = [ids_of[i] for i in numbers]
                if gaps is not None:
                    places = [k for k, i in enumerate(numbers) if not i]
                    for own, ids in zip(gaps, found):
                        ids = np.array(ids, "<i4").tobytes()
                        for n in own:
                            whole[places[n]] = ids
                out.append(b"".join(whole))
            columns = [batch.column(c) for c in ("row", "doc_id", "n_chars", "sha256")]
            ends = np.cumsum([0, *[len(x) // 4 for x in out]], dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(out), "<i4")))
            yield pa.RecordBatch.from_arrays([*columns, ids], names=["row", "doc_id", "n_chars", "sha256", "ids"])

    both = made.where("unit IS NULL").select("row", "doc_id", "n_chars", "sha256", "held").join(more, "row", "left")
    return both.mapInArrow(filled, f"{own}, ids array<int>")


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", held_units: int = HELD_UNITS) -> DataFrame:
    """``row, doc_id, ids``: every document's ids in order; ``row`` numbers rows."""
    return with_ids(docs, path, id_col, text_col, held_units).select("row", "doc_id", "ids")


def bytes_of_ids(path: str) -> dict[int, bytes]:
    """What each id stands for."""
    base = byte_base(path)
    return {**{i: p.replace(BLANK, " ").encode() for p, i, _ in pieces_of(path)}, **{base + b: bytes([b]) for b in range(256)}}


def decoded_text(ids: list[int], table: dict[int, bytes]) -> str:
    """Without the blank that encoding puts first; ids without a piece stand for nothing."""
    return b"".join([table.get(i, b"") for i in ids]).decode(errors="replace")[1:]


def decode(rows: DataFrame, path: str) -> DataFrame:
    """``row, text`` from ``row, ids``; every worker holds the pieces, which have the model's size."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bytes_of_ids(path)
        for batch in batches:
            texts = [decoded_text(ids or [], table) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])

    kind = rows.schema["row"].dataType.simpleString()
    return rows.select("row", "ids").mapInArrow(decoded, f"row {kind}, text string")


def piece_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", held_units: int = HELD_UNITS) -> DataFrame:
    """``doc_id, n_chars, n_pieces, ids_sum, n_byte_pieces, ids_crc32, decodes`` of every document's encoding.

    ``ids_crc32`` is of the ids in order as 32-bit little-endian numbers; ``decodes`` says whether decoding gives the text back, which
    a text that holds the sign for blanks itself cannot.
    """
    rows = with_ids(docs, path, id_col, text_col, held_units)
    base = byte_base(path)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bytes_of_ids(path)
        for batch in batches:
            out = []
            ids = batch.column("ids")
            every, ends = ids.values.to_numpy(), ids.offsets.to_numpy()
            for chars, sha, begin, end in zip(*(batch.column(c).to_pylist() for c in ("n_chars", "sha256")), ends, ends[1:]):
                own = every[begin:end].astype("<i4", copy=False)
                same = hashlib.sha256(decoded_text(own.tolist(), table).encode()).digest() == sha
                out.append((chars, len(own), int(own.sum(dtype=np.int64)), int(((own >= base) & (own < base + 256)).sum()), zlib.crc32(own.tobytes()), same))
            columns = list(zip(*out)) or [()] * 6
            made = [*[pa.array(x, pa.int64()) for x in columns[:5]], pa.array(columns[5], pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], names=["doc_id", "n_chars", "n_pieces", "ids_sum", "n_byte_pieces", "ids_crc32", "decodes"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(digests, f"doc_id {kind}, n_chars long, n_pieces long, ids_sum long, n_byte_pieces long, ids_crc32 long, decodes boolean")
