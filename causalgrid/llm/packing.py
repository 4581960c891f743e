"""Best-fit packing with a bounded number of open sequences.

Documents become token pieces of at most ``size``; only longer ones are cut. Pieces are dealt to shards by
a hash and packed online: the open sequence with the least sufficient free space takes the piece. Free spaces are the set bits of
one integer. Where no open sequence fits and the bound is reached, the fullest closes. What is still open at
the end of a shard is packed again in an eighth of the shards, until one is left, so the waste at the ends does not grow
with the shards and the last task gets a bounded number of sequences.

Nulls: a null text is empty, its piece holds the end token alone; a null id stays null. Equal rows
are packed as separate pieces. A very long text is cut into full pieces. An empty table gives an empty table.
"""

from __future__ import annotations

import sys
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from causalgrid.llm.common import arrow_batches, stored, texts_of

# Fixed value: how the word scheme cuts a lower-case text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
SEPARATORS, BLANKS = regex.compile(r"[\x1c-\x1f]"), regex.compile(r"\p{White_Space}+")
#: Words whose ids a Python worker remembers; at the bound it starts over.
REMEMBERED = 600_000
OPEN = 64
PIECES_PER_SHARD = 20_000
SHARDS_AT_LEAST = 64
#: Sequences this full are not packed again.
FULL_ENOUGH = 0.995


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the vocabulary: printable ones for themselves, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(0x100 + k) for k, b in enumerate(others)}


LETTERS = byte_letters()


def spelled(word: str) -> str:
    """A word as the model reads it: a letter for each byte of its UTF-8."""
    if word.isascii() and word.isprintable():
        return word
    return word.encode().decode("latin-1").translate(LETTERS)


class WordIds:
    """Ids of texts; the library encodes each different word once.

    Words never cross white space, so what stands between white space is remembered with its ids.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        special = self.tokenizer.get_added_tokens_decoder()
        self.special = {t.content: np.array([k], "<u4").tobytes() for k, t in special.items()}
        self.apart = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.cut, self.known, self.words = regex.compile(WORDS), {}, {}

    def learn_words(self, words: set[str]) -> None:
        new = list(words - self.words.keys())
        if len(self.words) + len(new) > REMEMBERED:
            self.words = {}
            new = list(words)
        # a word is one pre-token, so the model alone gives its ids, without the rest of the library's work on a text
        pieces = self.tokenizer.model.tokenize
        self.words.update((w, np.array([t.id for t in pieces(spelled(w))], "<u4").tobytes()) for w in new)

    def learn(self, chunks: set[str]) -> None:
        """Ids for what stands between white space, in lower case."""
        cut = {c: self.cut.findall(c) for c in chunks}
        self.learn_words({w for words in cut.values() for w in words})
        ids = self.words.__getitem__
        self.known.update((c, b"".join(map(ids, words))) for c, words in cut.items())

    def chunks(self, text: str) -> list[str]:
        """What stands between white space in a text without special tokens, in lower case."""
        if not text.isascii():
            # letters go to lower case one by one, so a final sigma is like any other
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        # four control characters end a word for split() but not for the tokenizer
        return text.split() if not SEPARATORS.search(text) else [c for c in BLANKS.split(text) if c]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        parts = []
        for text in texts:
            if self.apart is not None and any(s in text for s in self.special):
                parts.append([(self.special.get(p), [] if p in self.special else self.chunks(p)) for p in self.apart.split(text)])
            else:
                parts.append([(None, self.chunks(text))])
        known = self.known.keys()
        new = {c for own in parts for _, chunks in own for c in chunks if c not in known}
        if len(known) + len(new) > REMEMBERED:
            self.known = {}
            new = {c for own in parts for _, chunks in own for c in chunks}
        if new:
            self.learn(new)
        ids = self.known.__getitem__
        return [b"".join(special or b"".join(map(ids, chunks)) for special, chunks in own) for own in parts]


def word_ids(path: str) -> WordIds:
    """One for each Python worker and file: what it remembers serves later tasks as well."""
    held = sys.__dict__.setdefault("_llm_word_ids", {})
    if path not in held:
        held[path] = WordIds(path)
    return held[path]


def parts_of(texts: list[bytes], most: int = 4 << 20) -> Iterator[list[str]]:
    """Consecutive texts of about ``most`` bytes together, one at least."""
    part, n = [], 0
    for t in texts:
        part.append(t.decode())
        n += len(t)
        if n >= most:
            yield part
            part, n = [], 0
    if part:
        yield part


def token_pieces(docs: DataFrame, path: str, size: int, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: each document's ids with the end id, cut where longer than ``size``."""
    arrow_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = word_ids(path)
        for batch, texts in texts_of(batches, "text"):
            row, piece, start, length, crc = [], [], [], [], []
            encoded = (ids for part in parts_of(texts) for ids in own.encode(part))
            for k, ids in enumerate(encoded):
                ids += end
                for j, at in enumerate(range(0, len(ids), 4 * size)):
                    own_ids = ids[at : at + 4 * size]
                    row.append(k)
                    piece.append(j)
                    start.append(at // 4)
                    length.append(len(own_ids) // 4)
                    crc.append(zlib.crc32(own_ids))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    *[pa.array(x, pa.int64()) for x in (start, length, crc)],
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


class OpenSequences:
    """At most ``most`` open sequences, found by their free space."""

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.bits, self.count, self.made = 0, 0, 0
        self.by_free: dict[int, list[int]] = {}

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        number = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        self.count -= 1
        return number

    def place(self, length: int) -> tuple[int, int, int | None]:
        """The sequence that takes the piece, the place in it, and the sequence that closes for it, if any."""
        closed = None
        above = self.bits >> length
        if above:
            free = length + ((above & -above).bit_length() - 1)
            number = self._take(free)
        else:
            if self.count == self.most:
                closed = self._take((self.bits & -self.bits).bit_length() - 1)
            free, number = self.size, self.made
            self.made += 1
        left = free - length
        if left:
            self.by_free.setdefault(left, []).append(number)
            self.bits |= 1 << left
            self.count += 1
        return number, self.size - free, closed

    def open(self) -> dict[int, int]:
        """Open sequences with their free space."""
        return {n: free for free, own in self.by_free.items() for n in own}


def packed_once(pieces: DataFrame, shards: int, size: int, most: int, level: int, last: bool) -> DataFrame:
    """``pieces`` with ``sequence_id``, ``offset`` and ``again``, which marks what is to be packed again."""
    order = F.xxhash64("doc_id", "piece", "ids_crc32", "start", "length")
    dealt = pieces.withColumn("_shard", F.pmod(order, F.lit(shards)).cast("int")).withColumn("_order", order)
    dealt = dealt.repartition(1) if shards == 1 else dealt.repartition(shards, "_shard")
    dealt = dealt.sortWithinPartitions("_shard", "_order", "doc_id", "piece", "start")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bins = None, OpenSequences(size, most)
        waiting: dict[int, list[tuple[pa.RecordBatch, int, int]]] = {}  # rows of open sequences

        def out(numbers: list[int], again: bool) -> Iterator[pa.RecordBatch]:
            by: dict[int, list] = {}
            for n in numbers:
                for b, k, at in waiting.pop(n):
                    by.setdefault(id(b), []).append((b, k, n, at))
            for own in by.values():
                taken = own[0][0].take(pa.array([r[1] for r in own], pa.int64()))
                ids = [(level << 56) | (now << 32) | r[2] for r in own]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[taken.column(c) for c in KEPT],
                        pa.array(ids, pa.int64()),
                        pa.array([r[3] for r in own], pa.int64()),
                        pa.array([again] * len(own), pa.bool_()),
                    ],
                    names=[*KEPT, "sequence_id", "offset", "again"],
                )

        def ended() -> Iterator[pa.RecordBatch]:
            free = bins.open()
            done = [n for n in list(waiting) if last or free.get(n, 0) <= size * (1 - FULL_ENOUGH)]
            yield from out(done, False)
            yield from out(list(waiting), True)

        for batch in batches:
            finished: list[int] = []
            for k, (s, length) in enumerate(zip(batch.column("_shard").to_pylist(), batch.column("length").to_pylist())):
                if s != now:
                    if now is not None:
                        yield from out(finished, False)
                        finished = []
                        yield from ended()
                    now, bins = s, OpenSequences(size, most)
                number, at, closed = bins.place(length)
                waiting.setdefault(number, []).append((batch, k, at))
                if closed is not None:
                    finished.append(closed)
                if at + length == size:
                    finished.append(number)
            yield from out(finished, False)
        if now is not None:
            yield from ended()

    kind = pieces.schema["doc_id"].dataType.simpleString()
    return dealt.mapInArrow(
        pack, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, again boolean"
    )


KEPT = ("doc_id", "piece", "start", "length", "ids_crc32")


def pack_pieces(pieces: DataFrame, size: int, most: int = OPEN, per_shard: int = PIECES_PER_SHARD, at_least: int = SHARDS_AT_LEAST) -> DataFrame:
    """Sequences for the pieces: ``sequence_id`` and ``offset`` beside what the pieces hold."""
    shards = max(at_least, -(-pieces.count() // per_shard))
    done, level, rest = [], 0, pieces
    while True:
        placed = stored(packed_once(rest, shards, size, most, level, shards == 1), f"packed-{level}")
        done.append(placed.where("not again").drop("again"))
        if shards == 1:
            break
        rest, shards, level = placed.where("again").select(*KEPT), -(-shards // 8), level + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def packed_documents(docs: DataFrame, path: str, size: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """Every document's pieces and the sequences that hold them."""
    pieces = stored(token_pieces(docs, path, size, end_id, id_col, text_col), "pieces")
    return pack_pieces(pieces, size, **limits)
