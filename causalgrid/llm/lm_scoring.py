"""Log probabilities of documents by logistic context mixing, beside a smoothed unigram model.

Words are predicted bit by bit: hashed contexts (the last 0 to 4 bytes inside the word, with the bits of the byte so far) hold
counts of zeros and ones; a mixer adds their logits with weights that a gate (bit position and longest known context) selects; an
adaptive map, by gate and mixed logit, refines the result. The contexts count every different training word once, because the
byte model has to speak for words that were not counted: a known word keeps its discounted share, and what the discounts
leave goes to all words by the byte model. The mixer learns online, batch by batch, from every training word, each with its own count
taken out of its contexts.

A document then runs through several experts: some blend the model with the document's own earlier words at different rates,
others are the model's frequent words counted anew over the training documents of one class, that is, those in which the same one of the
most frequent words leads. The experts' weights follow the document, which is the exact Bayesian mixture. All counts are sums over all training documents. The context
table has a fixed number of slots and the words kept in each worker are a fixed number of the most frequent; other words are joined.

Beside the score stands the bits per byte of a second mixer of the same kind over running bytes: its contexts, up to six bytes that reach
into earlier words, count all bytes of all training documents, its weights and map learn from all of them, and it predicts every bit of every
text and of its end.

A null or empty text is its end token alone; a null id is held out or not as an empty id. Equal texts get equal scores. Texts of any
length are scored whole. Without training documents N and V are 0 and the byte model is uniform. An empty table gives an empty table.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from causalgrid.llm.common import arrow_batches, is_fold, stored, texts_of

ORDERS = 5
#: Bytes in each context of running text.
RUNNING = (1, 2, 3, 4, 6)
SLOT_BITS = 22
#: The table of contexts is sent in so many blocks, as a power of two.
BLOCK_BITS = 8
#: Bytes of running text in one step of learning.
STEP = 1 << 15
#: The bits of a negative zero, which stands for a context without counts.
UNKNOWN = np.iinfo(np.int32).min
GATES = 8 * (ORDERS + 1)
MAP_BINS = 33
#: Words with the highest counts that every worker holds; the rest is joined.
HELD_WORDS = 200_000
#: Shares of a document's own earlier words in each expert's prediction, and the experts' weights at the start.
SHARES = (0.0, 0.05, 0.3, 0.8)
STARTS = (0.3, 0.1, 0.05, 0.05)
#: Documents are classed by which of so many most frequent words leads in them; all class experts share ``CLASS_START``.
CLASSES, CLASS_START = 12, 0.5
#: Words that the model adds to the counts of a class.
CLASS_PRIOR = 2_000
#: Stands for the end of a text among the words.
END = b"\n"
EMIT = 400_000


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, c``: all words, counted in training documents (0: only held-out ones have it). ``docs``: ``text, train``."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, other = Counter(), set()

        def out() -> pa.RecordBatch:
            more = list(other - seen.keys())
            words = [*seen.keys(), *more]
            made = pa.record_batch(
                [pa.array(words, pa.binary()), pa.array([*seen.values(), *[0] * len(more)], pa.int64())], names=["word", "c"]
            )
            seen.clear()
            other.clear()
            return made

        for batch, texts in texts_of(batches, "text"):
            for text, train in zip(texts, batch.column("train").to_pylist()):
                words = text.lower().split()
                if train:
                    seen.update(words)
                    seen[END] += 1
                else:
                    other.update(words)
                    other.add(END)
                if len(seen) + len(other) > EMIT:
                    yield out()
        if seen or other:
            yield out()

    return docs.mapInArrow(counted, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def slots_of(context: np.ndarray, data: np.ndarray, b: int) -> np.ndarray:
    """The slot of a context with the first ``b`` bits of the byte that follows it."""
    node = (np.uint64(1) << np.uint64(b)) | (data >> np.uint64(8 - b))
    x = (context ^ (node * np.uint64(0xC2B2AE3D27D4EB4F))) * np.uint64(0xD6E8FEB86659FD93)
    return ((x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def bit_of(data: np.ndarray, b: int) -> np.ndarray:
    """Bit ``b`` from the top of every byte."""
    return ((data >> np.uint64(7 - b)) & np.uint64(1)).astype(bool)


def hashed(before: list[np.ndarray], k: int) -> np.ndarray:
    """The context of the last ``k`` bytes, of which ``before`` has the nearest first."""
    context = np.zeros(len(before[0]), np.uint64)
    for x in before[:k]:
        context = context * np.uint64(257) + x.astype(np.uint64) + np.uint64(1)
    odd = np.uint64(0x9E3779B97F4A7C15)
    return (context + np.uint64(k)) * odd if k else context + odd


class Bits:
    """The bits of a batch of words, each followed by a blank; ``before`` has the bytes before each, nearest first."""

    orders = tuple(range(ORDERS))

    def __init__(self, words: list[bytes]):
        joined = b" ".join(words) + b" "
        data = np.frombuffer(joined, np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        self.starts = np.cumsum(sizes) - sizes
        into = np.arange(len(data)) - np.repeat(self.starts, sizes)  # bytes of the word before this one
        self.before = []
        for k in range(1, ORDERS):
            before = np.zeros(len(data), np.uint16)
            before[k:] = data[:-k]
            before[into < k] = 32  # a word begins after a blank
            before[into < k - 1] = 0
            self.before.append(before)
        self.data = data
        self.step = len(data)

    def bit(self, b: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """Of every byte: bit ``b`` from the top, and a slot for each order."""
        return bit_of(self.data, b), [slots_of(hashed(self.before, k), self.data, b) for k in self.orders]


class RunningBits(Bits):
    """The bits of consecutive bytes of texts; ``into`` has the bytes of the text before each, and the first ``lead`` bytes are context alone."""

    orders = RUNNING

    def __init__(self, data: np.ndarray, into: np.ndarray, lead: int):
        self.before = []
        for k in range(1, RUNNING[-1] + 1):
            before = np.zeros(len(data), np.uint16)
            before[k:] = data[:-k]
            before[into < k] = 256  # before the text
            self.before.append(before[lead:])
        self.data = data[lead:]
        self.step = STEP


class Windows:
    """What the model sees of a batch of bits, each thing once.

    A window is a byte and the bytes of its longest context. ``of`` numbers the window of every byte. Windows are sorted, byte first and
    then the nearest byte, so those that agree for a shorter context lie together: ``groups`` numbers them for each order.
    """

    def __init__(self, bits: Bits):
        key = bits.data.astype(np.uint64)
        for x in bits.before:
            key <<= np.uint64(9)
            key |= x
        order = np.argsort(key)
        key = key[order]
        new = np.r_[True, key[1:] != key[:-1]]
        windows = key[new]
        self.of = np.empty(len(key), np.int32)
        self.of[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
        self.often = np.diff(np.flatnonzero(np.r_[new, True]))
        deep = len(bits.before)
        self.data = windows >> np.uint64(9 * deep)
        self.groups, self.own = [], []
        for k in bits.orders:
            short = windows >> np.uint64(9 * (deep - k))
            new = np.r_[True, short[1:] != short[:-1]]
            short = short[new]
            before = [(short >> np.uint64(9 * (k - j))) & np.uint64(511) for j in range(1, k + 1)] or [short]
            self.groups.append(np.cumsum(new, dtype=np.int32) - np.int32(1))
            self.own.append((hashed(before, k), short >> np.uint64(9 * k)))

    def slots(self, b: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each order the bit and the slot of every group."""
        for context, data in self.own:
            yield bit_of(data, b), slots_of(context, data, b)


def running(texts: list[bytes], most: int = 1 << 21) -> Iterator[tuple[RunningBits, np.ndarray]]:
    """Bits of all texts, each with its end, at most ``most`` bytes at a time, and the number of each byte's text."""
    for begin, part in parts_of(texts, most):
        data = np.frombuffer(b"\0".join(part) + b"\0", np.uint8)
        sizes = np.fromiter(map(len, part), np.int64, len(part)) + 1
        of = np.repeat(np.arange(begin, begin + len(part)), sizes)
        into = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        for at in range(0, len(data), most):
            first = max(0, at - RUNNING[-1])
            yield RunningBits(data[first : at + most], into[first : at + most], at - first), of[at : at + most]


def word_bits(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Bits]:
    yield from map(Bits, batched(batches, size))


def text_bits(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Bits]:
    for _, texts in texts_of(batches, "text"):
        for bits, _ in running(texts):
            yield bits


class Mixer:
    """Context counts, mixing weights by gate, and the adaptive map."""

    def __init__(self, zeros: np.ndarray, ones: np.ndarray, weights: np.ndarray | None = None, refined: np.ndarray | None = None):
        self.zeros, self.ones = zeros, ones
        self.weights = np.full((GATES, ORDERS), 0.3) if weights is None else weights
        self.refined = np.tile(1 / (1 + np.exp(-(np.arange(MAP_BINS) - MAP_BINS // 2) / 2)), (GATES, 1)) if refined is None else refined

    def __reduce__(self) -> tuple:
        # most slots hold nothing or a small count, and every executor keeps a copy on its disk
        return unpacked, (*[zlib.compress(x.astype(np.float32, copy=False), 1) for x in (self.zeros, self.ones)], self.weights, self.refined)

    @cached_property
    def stretched(self) -> np.ndarray:
        """The logit of every slot."""
        return stretch(self.zeros.astype(np.float32), self.ones.astype(np.float32))

    @cached_property
    def stretched_without(self) -> np.ndarray:
        """The logit of every slot without one zero, and without one one, by turns."""
        n0, n1 = self.zeros.astype(np.float32), self.ones.astype(np.float32)
        return np.stack([stretch(np.maximum(n0 - 1, 0), n1), stretch(n0, np.maximum(n1 - 1, 0))], axis=1).ravel()

    @staticmethod
    def known(tables: list[np.ndarray], groups: list[np.ndarray]) -> np.ndarray:
        """The longest known context of every window, from the logits of its groups."""
        known = np.zeros(len(groups[0]), np.int8)
        for k, (own, group) in enumerate(zip(tables, groups)):
            np.copyto(known, np.int8(k + 1), where=(own.view(np.int32) != UNKNOWN)[group])
        return known

    @staticmethod
    def logits(x: np.ndarray, place: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The logits mixed by the weights that the gate chooses: ``weights`` has a row for each number of known contexts, ``place`` points into rows and windows."""
        z = (weights @ x).ravel().take(place)
        return np.clip(z, -12, 12, out=z)

    def learn(self, bits: Bits, seen: np.ndarray, logits_of: np.ndarray) -> None:
        """Online steps, of ``bits.step`` bytes each, for every gate from the bits of training words or of running text.

        ``logits_of`` are those of ``stretched_without``: a byte's own count is left out. ``seen`` gathers bits and ones by gate and bin
        of the mixed logit, as predicted before the step. Equal windows of a step count once, times their number.
        """
        windows = Windows(bits)
        tables = [[logits_of[2 * slot + bit] for bit, slot in windows.slots(b)] for b in range(8)]
        knowns = [self.known(own, windows.groups) for own in tables]
        for begin in range(0, len(bits.data), bits.step):
            own, often = np.unique(windows.of[begin : begin + bits.step], return_counts=True)
            own, often = own.astype(np.int64), often.astype(np.float64)
            at, data, each = [group.take(own).astype(np.int64) for group in windows.groups], windows.data[own], np.arange(len(own))
            x = np.empty((ORDERS, len(own)))
            for b in range(8):
                for k in range(ORDERS):
                    x[k] = tables[b][k].take(at[k])
                known, bit = knowns[b].take(own).astype(np.int64), bit_of(data, b)
                place, weights = known * len(own) + each, self.weights[b::8]
                z = self.logits(x, place, weights)
                cell = (known * MAP_BINS + self.bins(z)) * 2 + bit
                count = np.bincount(cell, weights=often, minlength=(ORDERS + 1) * MAP_BINS * 2).reshape(-1, MAP_BINS, 2)
                seen[0, b::8] += count.sum(axis=2)
                seen[1, b::8] += count[:, :, 1]
                error = np.zeros((ORDERS + 1, len(own)))
                error.ravel()[place] = (bit - 1 / (1 + np.exp(-z))) * often
                # the step of a least-squares fit along the gradient
                size = np.bincount(known, weights=np.einsum("kn,kn->n", x, x) * often, minlength=ORDERS + 1)
                weights += 2.0 * (error @ x.T) / (size[:, None] / 2 + 10)

    @staticmethod
    def bins(logits: np.ndarray) -> np.ndarray:
        return np.clip(np.rint(logits * 2) + MAP_BINS // 2, 0, MAP_BINS - 1).astype(np.int64)

    def log10(self, words: list[bytes]) -> np.ndarray:
        """log10 probability of each word, its end included."""
        bits = Bits(words)
        return np.add.reduceat(self.log10_of(bits), bits.starts)

    def text_bits(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text and its end."""
        total = np.zeros(len(texts))
        for bits, of in running(texts, 1 << 22):  # the more bytes together, the more of their windows are equal
            total += np.bincount(of, weights=self.log10_of(bits), minlength=len(texts))
        return -total / math.log10(2)

    def log10_of(self, bits: Bits) -> np.ndarray:
        """log10 probability of each byte."""
        windows = Windows(bits)
        whole = np.ones(len(windows.data))
        tables = [[self.stretched[slot] for _, slot in windows.slots(b)] for b in range(8)]
        knowns = [self.known(own, windows.groups) for own in tables]
        for begin in range(0, len(whole), STEP):  # so that a step's numbers stay in the processor's cache
            own = slice(begin, begin + STEP)
            at, each = [group[own].astype(np.int64) for group in windows.groups], np.arange(len(whole[own]))
            for b in range(8):
                x = np.array([table.take(k) for table, k in zip(tables[b], at)], np.float64)
                known = knowns[b][own].astype(np.int64)
                z = self.logits(x, known * len(each) + each, self.weights[b::8])
                p = 0.5 / (1 + np.exp(-z)) + 0.5 * self.refined[b::8].ravel().take(known * MAP_BINS + self.bins(z))
                p = np.clip(p, 1e-6, 1 - 1e-6)
                whole[own] *= np.where(bit_of(windows.data[own], b), p, 1 - p)  # 1e-48 at least in the end
        return np.log10(whole)[windows.of]


def stretch(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """The logit that counts of zeros and ones give; without any it is the negative zero that no counts give."""
    n = n0 + n1
    out = np.log((n1 + 0.4) / (n0 + 0.4)) * (n / (n + 0.5))
    out[n == 0] = -0.0
    return out


def unpacked(zeros: bytes, ones: bytes, weights: np.ndarray, refined: np.ndarray) -> Mixer:
    return Mixer(*[np.frombuffer(zlib.decompress(x), np.float32) for x in (zeros, ones)], weights, refined)


def batched(batches: Iterator[pa.RecordBatch], size: int = 10_000) -> Iterator[list[bytes]]:
    for batch in batches:
        words = batch.column("word").to_pylist()
        for k in range(0, len(words), size):
            yield words[k : k + size]


def context_table(known: DataFrame, column: str = "word", bits_of: Callable = word_bits) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones of all slots over the different training words, or over running texts; the size is fixed.

    A task sends its counts as blocks of consecutive slots, compressed.
    """
    size = 1 << SLOT_BITS - BLOCK_BITS

    def block(number: int, zeros: np.ndarray, ones: np.ndarray) -> pa.RecordBatch:
        packed = [pa.array([zlib.compress(x.astype("<i8", copy=False), 1)], pa.binary()) for x in (zeros, ones)]
        return pa.record_batch([pa.array([number], pa.int32()), *packed], names=["block", "n0", "n1"])

    def counts_in(x: bytes) -> np.ndarray:
        return np.frombuffer(zlib.decompress(x), "<i8")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zeros, ones = np.zeros(1 << SLOT_BITS, np.int64), np.zeros(1 << SLOT_BITS, np.int64)
        for bits in bits_of(batches, 10_000):
            windows = Windows(bits)
            often = [np.bincount(group, weights=windows.often).astype(np.int64) for group in windows.groups]
            for b in range(8):
                for n, (bit, slot) in zip(often, windows.slots(b)):
                    np.add.at(ones, slot[bit], n[bit])
                    np.add.at(zeros, slot[~bit], n[~bit])
        for k in range(1 << BLOCK_BITS):
            own = slice(k * size, (k + 1) * size)
            if zeros[own].any() or ones[own].any():
                yield block(k, zeros[own], ones[own])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # the table's size at most
        for batch in batches:
            for k, *parts in zip(*(batch.column(c).to_pylist() for c in ("block", "n0", "n1"))):
                own = total.setdefault(k, (np.zeros(size, np.int64), np.zeros(size, np.int64)))
                for sums, part in zip(own, parts):
                    sums += counts_in(part)
        for k, own in total.items():
            yield block(k, *own)

    kind = "block int, n0 binary, n1 binary"
    rows = known.select(column).mapInArrow(counted, kind).repartition("block").mapInArrow(summed, kind)
    zeros, ones = np.zeros(1 << SLOT_BITS, np.float32), np.zeros(1 << SLOT_BITS, np.float32)
    for r in rows.toArrow().to_pylist():  # at most 2**BLOCK_BITS rows
        own = slice(r["block"] * size, (r["block"] + 1) * size)
        zeros[own], ones[own] = counts_in(r["n0"]), counts_in(r["n1"])
    return zeros, ones


def trained(known: DataFrame, column: str = "word", bits_of: Callable = word_bits) -> Mixer:
    """The mixer after one online pass over all training words or texts; the partitions' weights are averaged by their bytes."""
    mixer = Mixer(*context_table(known, column, bits_of))
    held = known.sparkSession.sparkContext.broadcast(mixer)

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, n = Mixer(held.value.zeros, held.value.ones, held.value.weights.copy(), held.value.refined), 0
        logits_of = held.value.stretched_without
        seen = np.zeros((2, GATES, MAP_BINS))
        for bits in bits_of(batches, 2_000):
            own.learn(bits, seen, logits_of)
            n += len(bits.data)
        if n:
            yield pa.record_batch([pa.array([n]), pa.array([own.weights.ravel().tolist()]), pa.array([seen.ravel().tolist()])], names=["n", "weights", "seen"])

    # a row for each partition, of a few kilobytes
    rows = known.select(column).mapInArrow(learned, "n long, weights array<double>, seen array<double>").collect()
    if not rows:
        return mixer
    n = np.array([r["n"] for r in rows], float)
    weights = (np.array([r["weights"] for r in rows]) * (n / n.sum())[:, None]).sum(axis=0).reshape(GATES, ORDERS)
    bits, ones = np.sum([r["seen"] for r in rows], axis=0).reshape(2, GATES, MAP_BINS)
    return Mixer(mixer.zeros, mixer.ones, weights, (ones + 20 * mixer.refined) / (bits + 20))


def scored_words(words: DataFrame, mixer: Mixer, total: int, distinct: int, discount: float) -> DataFrame:
    """``word, c, p``: log10 probability of every word under the model."""
    held = words.sparkSession.sparkContext.broadcast(mixer)
    left = discount * distinct / total if total else 1.0

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer = held.value
        for batch in batches:
            own, c = batch.column("word").to_pylist(), batch.column("c").to_numpy()
            spelled = np.concatenate([mixer.log10(own[k : k + 10_000]) for k in range(0, len(own), 10_000)]) if own else np.empty(0)
            share = np.maximum(c - discount, 0) / max(1, total)
            with np.errstate(divide="ignore"):
                p = np.where(share > 0, np.log10(share + left * 10.0 ** np.maximum(spelled, -300)), math.log10(left) + spelled)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64())], names=["word", "c", "p"])

    return words.mapInArrow(scored, "word binary, c long, p double")


def parts_of(texts: list[bytes], most: int = 2 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Places and consecutive texts of about ``most`` bytes together, one at least."""
    begin, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t)
        if size >= most or k == len(texts) - 1:
            yield begin, texts[begin : k + 1]
            begin, size = k + 1, 0


def class_tables(docs: DataFrame, names: list[bytes], logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 probabilities of the held words in each class, and what a class adds to those of other words."""
    leads = [k for k, w in enumerate(names) if w != END][:CLASSES]
    width = len(names) + 1  # the last column stands for words that are not held
    if not leads:
        return np.empty((0, len(names))), np.empty(0)
    held = docs.sparkSession.sparkContext.broadcast((names, leads))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, leads = held.value
        number = dict(zip(names, itertools.count()))
        lead = np.full(width, -1)
        lead[leads] = np.arange(len(leads))
        total = np.zeros(len(leads) * width, np.int64)
        for _, texts in texts_of(batches, "text"):
            for _, part in parts_of(texts, 4 << 20):
                own = [t.lower().split() for t in part]
                lengths = np.array([len(w) + 1 for w in own])
                for w in own:
                    w.append(END)
                word = np.fromiter((number.get(w, width - 1) for w in itertools.chain.from_iterable(own)), np.int64, int(lengths.sum()))
                doc = np.repeat(np.arange(len(own)), lengths)
                leading = lead[word] >= 0
                score = np.bincount(doc[leading] * len(leads) + lead[word[leading]], minlength=len(own) * len(leads)).reshape(len(own), -1)
                of = np.where(score.max(axis=1) > 0, score.argmax(axis=1), -1)[doc]
                total += np.bincount(of[of >= 0] * width + word[of >= 0], minlength=len(total))
        full = np.flatnonzero(total)
        yield pa.record_batch([pa.array(full), pa.array(total[full])], names=["cell", "n"])

    rows = docs.where("train").select("text").mapInArrow(counted, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    table, counts = rows.toArrow(), np.zeros(len(leads) * width)  # at most CLASSES x (HELD_WORDS + 1) rows
    counts[table.column("cell").to_numpy()] = table.column("n").to_numpy()
    counts = counts.reshape(len(leads), width)
    plain = 10.0**logs
    other = min(0.999, max(1e-9, 1 - plain.sum()))  # of all probability what words that are not held have
    words = counts[:, :-1].sum(axis=1, keepdims=True)
    rare = (counts[:, -1:] + CLASS_PRIOR * other) / (words + counts[:, -1:] + CLASS_PRIOR)
    own = (counts[:, :-1] + CLASS_PRIOR * plain / plain.sum()) / (words + CLASS_PRIOR)
    return np.log10((1 - rare) * own), np.log10(rare[:, 0] / other)


def document_parts(docs: DataFrame, top: tuple[list[bytes], np.ndarray, np.ndarray], norm: float, classes: tuple[np.ndarray, np.ndarray], spelling: Mixer) -> DataFrame:
    """Rows of two kinds. Documents: ``row``, their columns, and sums over words held in the worker. Other words, once in a
    document: ``row, word`` and ``again``, the shares of earlier words at each repetition."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast((*top, *classes))
    spelled_by = spark.sparkContext.broadcast(spelling)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, counts, logs, class_logs, class_rest = held.value
        spelling = spelled_by.value
        number = dict(zip(names, itertools.count()))
        base = np.log10((counts + 0.5) / norm)
        plain = 10.0**logs
        row = TaskContext.get().partitionId() << 36
        for batch, texts in texts_of(batches, "text"):
            bits = spelling.text_bits(texts) / np.array([len(t) + 1 for t in texts])
            for begin, part in parts_of(texts):
                own = [t.lower().split() for t in part]
                for w in own:
                    w.append(END)
                lengths = np.array([len(w) for w in own])
                rare: dict[bytes, int] = {}
                word = np.fromiter(map(lambda w: number[w] if w in number else len(names) + rare.setdefault(w, len(rare)), itertools.chain.from_iterable(own)), np.int64, int(lengths.sum()))
                doc = np.repeat(np.arange(len(own)), lengths)
                place = np.arange(len(word)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                order = np.lexsort((place, word, doc))
                d, w = doc[order], word[order]
                new = np.r_[True, (d[1:] != d[:-1]) | (w[1:] != w[:-1])]
                run = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
                earlier = np.empty(len(word))
                earlier[order] = np.arange(len(order)) - run
                share = earlier / np.maximum(place, 1)
                common = word < len(names)
                dc, wc, sc = doc[common], word[common], share[common]
                add = lambda v: np.bincount(dc, weights=v, minlength=len(own))
                experts = [add(logs[wc] if s == 0 else np.log10((1 - s) * plain[wc] + s * sc + 1e-300)) for s in SHARES]
                n = len(own)
                unheld = np.bincount(doc[~common], minlength=n)
                experts += [add(c[wc]) + r * unheld for c, r in zip(class_logs, class_rest)]
                yield rows_of(
                    row + np.arange(n),
                    batch.column("doc_id").slice(begin, n),
                    batch.column("train").slice(begin, n),
                    lengths,
                    add(counts[wc] > 0),
                    add(base[wc]),
                    np.array(experts).T,
                    bits[begin : begin + n],
                )
                o = order[~common[order]]
                if len(o):
                    first = new[~common[order]]
                    at = np.flatnonzero(first)
                    again = np.split(share[o], at[1:])
                    spelled = list(rare)
                    yield words_of(batch.column("doc_id").type, row + doc[o][at], [spelled[k - len(names)] for k in word[o][at]], [x[1:].tolist() for x in again])
                row += n

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        parts,
        f"row long, doc_id {kind}, train boolean, n_tokens long, n_known double, base double, experts array<double>, bits_per_byte double, word binary, again array<double>",
    )


FIELDS = ("row", "doc_id", "train", "n_tokens", "n_known", "base", "experts", "bits_per_byte", "word", "again")


def rows_of(row, doc_id, train, lengths, known, base, experts, bits) -> pa.RecordBatch:
    n = len(row)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(row, pa.int64()), doc_id, train, pa.array(lengths, pa.int64()), pa.array(known, pa.float64()), pa.array(base, pa.float64()),
            pa.array(list(experts), pa.list_(pa.float64())), pa.array(bits, pa.float64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.list_(pa.float64())),
        ],
        names=list(FIELDS),
    )


def words_of(kind, row, words, again) -> pa.RecordBatch:
    n = len(words)
    empty = [pa.nulls(n, t) for t in (kind, pa.bool_(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.float64()), pa.float64())]
    return pa.RecordBatch.from_arrays(
        [pa.array(row, pa.int64()), *empty, pa.array(words, pa.binary()), pa.array(again, pa.list_(pa.float64()))], names=list(FIELDS)
    )


def language_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_words: int = HELD_WORDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte`` for every document.

    Documents whose crc32(id as text) mod 5 is 1 are held out.
    """
    arrow_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), (~is_fold(id_col, 1)).alias("train"), F.col(text_col).alias("text"))
    counts = stored(word_counts(rows), "word-counts")
    known = counts.where("c > 0")
    r = known.agg(F.sum("c").alias("n"), F.count("*").alias("v"), F.sum((F.col("c") == 1).cast("long")).alias("n1"), F.sum((F.col("c") == 2).cast("long")).alias("n2")).first()
    total, distinct = r["n"] or 0, r["v"] or 0
    discount = min(0.95, max(0.05, (r["n1"] or 0) / max(1, (r["n1"] or 0) + 2 * (r["n2"] or 0))))
    words = stored(scored_words(counts, trained(known), total, distinct, discount), "scored-words")
    most = words.orderBy(F.desc("c"), "word").limit(held_words).toArrow()
    top = (most.column("word").to_pylist(), most.column("c").to_numpy().astype(float), most.column("p").to_numpy())
    norm = total + 0.5 * (distinct + 1)
    classes = class_tables(rows, top[0], top[2])
    parts = stored(document_parts(rows, top, norm, classes, trained(rows.where("train"), "text", text_bits)), "parts")

    p, log_p = F.pow(F.lit(10.0), F.col("p")), F.col("p")
    first = lambda s: log_p + math.log10(1 - s)
    later = lambda s: F.aggregate("again", F.lit(0.0), lambda a, x: a + F.log10((1 - s) * p + s * x + 1e-300))
    repeats = F.size("again") > 0
    rare = parts.where("word IS NOT NULL").select("row", "word", "again").join(words, "word")
    sums = rare.select(
        "row",
        ((F.col("c") > 0).cast("double") * (1 + F.size("again"))).alias("n_known"),
        (F.log10((F.col("c") + 0.5) / norm) * (1 + F.size("again"))).alias("base"),
        *[(first(s) + F.when(repeats, later(s)).otherwise(0.0)).alias(f"e{k}") for k, s in enumerate(SHARES)],
    )
    local = parts.where("word IS NULL").select("row", "doc_id", "train", "n_tokens", "n_known", "base", "experts", "bits_per_byte", *[F.col("experts")[k].alias(f"e{k}") for k in range(len(SHARES))])
    names = ("n_known", "base", *[f"e{k}" for k in range(len(SHARES))])
    more = sums.groupBy("row").agg(*[F.sum(c).alias(f"more_{c}") for c in names])
    both = local.join(more, "row", "left").withColumns({c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0.0)) for c in names})
    # what other words add to a class expert is what they add to the first, which has no share of earlier words
    of_classes = [F.col("experts")[len(SHARES) + k] + F.coalesce("more_e0", F.lit(0.0)) for k in range(len(classes[1]))]
    weights = [*STARTS, *[CLASS_START / max(1, len(of_classes))] * len(of_classes)]
    own = F.array(*[f"e{k}" for k in range(len(SHARES))], *of_classes)
    both = both.withColumn("own", own).withColumn("best", F.array_max("own"))
    mixed = F.col("best") + F.log10(
        sum((F.pow(F.lit(10.0), F.col("own")[k] - F.col("best")) * (w / sum(weights)) for k, w in enumerate(weights)), F.lit(0.0))
    )
    return both.select(
        "doc_id",
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        F.col("n_known").cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        mixed.alias("score"),
        "bits_per_byte",
    )
