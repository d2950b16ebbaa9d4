"""Language-model scoring by online logistic context mixing.

A text is its words in lower case (A-Z) and one end. A Huffman code of leaves turns
it into binary decisions, one per node of the code's tree. The most frequent words
have leaves of their own. The others are, by their count, of a group (a leaf for each
doubling), or, where the text has had the word before, of the leaf "again"; the word's
share of its leaf (its count in the learning texts, or in this text so far) completes
its probability. Words that the learning texts have at most once are spelled byte by
byte, the first by the same tree, the rest by a tree of letters. So a word takes few
decisions, whatever the size of the vocabulary.

A decision is predicted from three hashed contexts that the corpus has filled: before
a word the node alone, with the word before, and with the two before; inside a spelled
word the node with the last two, three and five letters. Two more predictors adapt
within the text: what the text itself has shown of the node (and two letters), and of
the node after the word before (or five letters). The stretched predictions are
combined by weights that a gate picks by how often the contexts have been seen, and
the mix is refined adaptively by a gain and an offset per text. A text's own
predictors, gain and offset follow its decisions online, 64 at a time at first, a
thirty-second of what came before later in a long text. The sum of the log probabilities of decisions
and shares is that of the text.

All learning documents teach: six sevenths by id. One of these folds learns the
gated weights online, over contexts that the others have filled, and then fills the
contexts, too. Words that are not spelled also teach letters, each occurrence by
a chance of one in the word's count. Counts of words are exact, by 64-bit hash, over
all learning documents. Texts are split twice, to count words and to code them; all
else works on the codes. The model is of fixed size (documented bounds below), so
that each task can hold it; what is counted grows with the corpus.

Nulls and the like: a null text is empty (one end, no words); a row with a null
doc_id is held out; repeated rows are scored and learned from each; extra columns
are ignored; an empty table gives no rows; texts of any length are scored whole.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.shared import batched, mix64, pack_planes, pack_sorted, rows_of, settle, unpack_planes, unpack_sorted
from orderflow.llm.slices import cuts, documents, packed, slice_count

FOLDS, HELD_OUT, MIXING = 7, 2, 6  # crc32(doc_id as text) mod 7
LEAVES = 1 << 12  # words with leaves of their own
DICTIONARY = 60_000  # words that are told apart as contexts
TABLE_BITS = 22  # slots of each hashed context's table
BLOCK_BITS = 16  # slots in a block that is sent
BLOCK, GROWTH, LARGEST = 64, 32, 2048  # decisions of a text between what it learns: at least, as a part of those before, at most
ORDER = 5  # letters of a spelled word that are looked back at
CONTEXTS = 3  # of the corpus, in hashed tables
START = (0.3, 0.3, 0.3, 0.2, 0.3)  # weights at first, by context
RATE, GAIN_RATE, OFFSET_RATE = 0.03, 0.004, 0.005
SYMBOLS_AT_ONCE = 40_000

# Symbols: letters, ends, words beyond the dictionary by doubling, those of the dictionary.
END_WORD, END_TEXT, FIRST_GROUP, FIRST_WORD = 256, 257, 258, 322
AGAIN_LEAF, FIRST_LEAF = 258, 323  # leaves: as symbols, but one for "again"
AGAIN = 1 << 16  # added to the symbol of a word that the text has had before
AGAIN_SHARE = 0.4  # of the words without leaves of their own, for the code only
END_HASH = 0x5BD1E9955BD1E995  # counts as the token "end"
BUCKETS = 16  # of a doubling, in histograms of counts
TWICE = 1 + BUCKETS  # the bucket of the count 2


def fold(doc_id: int | None) -> int:
    return HELD_OUT if doc_id is None else zlib.crc32(str(doc_id).encode()) % FOLDS


# --- counts of words -------------------------------------------------------

_COUNTED = pa.schema(
    [("slice", pa.int32()), ("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("bytes", pa.list_(pa.int64()))]
)
_TOLD = pa.schema(
    [
        ("slice", pa.int32()),
        ("shard", pa.int32()),
        ("keys", pa.binary()),
        ("counts", pa.binary()),
        ("bytes", pa.list_(pa.int64())),
        ("total", pa.int64()),
        ("distinct", pa.int64()),
        ("histogram", pa.list_(pa.int64())),
        ("sums", pa.list_(pa.int64())),
    ]
)
_COUNTED_DDL = "slice int, shard int, keys binary, counts binary, bytes array<long>"
_TOLD_DDL = _COUNTED_DDL + ", total long, distinct long, histogram array<long>, sums array<long>"


def _sorted_counts(seen: Counter, ends: int) -> tuple[np.ndarray, np.ndarray]:
    keys = np.fromiter(map(xxhash.xxh3_64_intdigest, seen), np.uint64, len(seen))
    keys = np.append(keys, np.uint64(END_HASH))
    counts = np.append(np.fromiter(seen.values(), np.int64, len(seen)), ends)
    order = np.argsort(keys)
    return keys[order], counts[order]


def _count_slice(key, frame):
    """Of a slice: its words, with their counts in learning documents."""
    seen, ends = Counter(), 0
    for doc, text in documents(frame["docs"].to_pylist()):
        words = text.lower().split()
        if fold(doc) == HELD_OUT:
            seen.update(dict.fromkeys(words, 0))
        else:
            seen.update(words)
            ends += 1
    spelled = np.bincount(np.frombuffer(b"".join(w for w, n in seen.items() if n), np.uint8), minlength=256).tolist()
    keys, counts = _sorted_counts(seen, ends)
    rows = [
        {"slice": key[0].as_py(), "shard": k, "keys": pack_sorted(keys[part]), "counts": pack_planes(counts[part]), "bytes": spelled if k == 0 else None}
        for k, part in enumerate(cuts(keys, frame["shards"][0].as_py()))
        if part.stop > part.start or k == 0
    ]
    return pa.Table.from_pylist(rows, schema=_COUNTED)


def bucket(counts: np.ndarray) -> np.ndarray:
    return np.where(counts > 0, 1 + np.floor(BUCKETS * np.log2(np.maximum(counts, 1))), 0).astype(np.int64)


def _sum_shard(key, frame):
    """Of a shard: the sums (slice -1), and each slice's words' counts in all."""
    rows = frame.to_pylist()
    own = [(unpack_sorted(r["keys"]), unpack_planes(r["counts"]).astype(np.int64)) for r in rows]
    keys, at = np.unique(np.concatenate([k for k, _ in own]), return_inverse=True)
    sums = np.bincount(at, np.concatenate([c for _, c in own]), len(keys)).astype(np.int64)
    spelled = np.sum([r["bytes"] for r in rows if r["bytes"]] or [[0] * 256], axis=0).tolist()
    shard = key[0].as_py()
    learned = sums > 0
    plain = learned & (keys != np.uint64(END_HASH))
    out = [
        {
            "slice": -1,
            "shard": shard,
            "keys": pack_sorted(keys[learned]),
            "counts": pack_planes(sums[learned]),
            "bytes": spelled,
            "total": int(sums.sum()),
            "distinct": int(learned.sum()),
            "histogram": np.bincount(bucket(sums[learned]), minlength=64 * BUCKETS).tolist(),
            "sums": np.bincount(bucket(sums[plain]), sums[plain], 64 * BUCKETS).astype(np.int64).tolist(),
        }
    ]
    for r, (k, _) in zip(rows, own, strict=True):
        out.append({"slice": r["slice"], "shard": shard, "counts": pack_planes(sums[np.searchsorted(keys, k)])})
    return pa.Table.from_pylist(out, schema=_TOLD)


# --- the code of symbols ---------------------------------------------------


class Code:
    """Huffman code: for each symbol its decisions (nodes and bits)."""

    def __init__(self, frequency: np.ndarray):
        heap = [(int(f), k) for k, f in enumerate(frequency)]
        heapq.heapify(heap)
        n = len(frequency)
        up, bit = np.zeros(2 * n - 1, np.int64), np.zeros(2 * n - 1, np.uint8)
        for node in range(n, 2 * n - 1):
            for b in (0, 1):
                f, child = heapq.heappop(heap)
                up[child], bit[child] = node, b
                total = f if b == 0 else total + f
            heapq.heappush(heap, (total, node))
        # From the leaves up, all symbols at once; the root is the last node.
        at, length = np.arange(n), np.zeros(n, np.int64)
        nodes, bits = [], []
        while True:
            open_ = at != 2 * n - 2
            if not open_.any():
                break
            nodes.append(np.where(open_, up[at] - n, -1))
            bits.append(np.where(open_, bit[at], 0))
            length += open_
            at = np.where(open_, up[at], at)
        self.length = length.astype(np.int32)
        self.start = (np.cumsum(length) - length).astype(np.int64)
        deep, wide = np.array(nodes), np.array(bits)
        # Root first: the last node found of each symbol leads.
        symbol = np.repeat(np.arange(n), length)
        level = np.repeat(length, length) - 1 - (np.arange(len(symbol)) - np.repeat(self.start, length))
        self.node = deep[level, symbol].astype(np.int32)
        self.bit = wide[level, symbol].astype(np.uint8)
        self.nodes = n - 1


class Coder:
    """Texts of symbols to decisions with their contexts. ``frequency`` is that of the
    leaves, ``leaf`` the leaf of each symbol (the same number if not given)."""

    def __init__(self, keys: np.ndarray, frequency: np.ndarray, leaf: np.ndarray | None = None, letters: np.ndarray | None = None):
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.leaf = np.arange(len(frequency)) if leaf is None else leaf
        words, inside = Code(frequency), Code(frequency[:FIRST_GROUP] if letters is None else letters)
        self.leaves = len(frequency)  # those of letters inside words follow
        self.length = np.concatenate([words.length, inside.length])
        self.start = np.concatenate([words.start, inside.start + len(words.node)])
        self.bit = np.concatenate([words.bit, inside.bit])
        nodes = np.concatenate([words.node, inside.node + words.nodes]).astype(np.uint32)
        self.salt = _mixed(np.zeros(len(nodes), np.uint32), nodes)

    def words(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The symbols of words, by hash and count; of those to be spelled, that of
        the first group."""
        out = FIRST_GROUP + np.log2(np.maximum(counts, 1)).astype(np.int64)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = self.keys[at] == keys
            out[hit] = FIRST_WORD + self.order[at[hit]]
        return out

    def decisions(self, texts: list[np.ndarray], alone: bool = True):
        """Slots of the corpus's contexts, hashes of the text's own two (if ``alone``),
        bits, whether inside a spelled word, and where each text's decisions begin."""
        coded = np.concatenate(texts)
        symbol = coded & (AGAIN - 1)
        sizes = np.array([len(t) for t in texts])
        ends = np.cumsum(sizes)
        place = np.arange(len(symbol)) - np.repeat(ends - sizes, sizes)

        def back(k: int, at: np.ndarray | slice = slice(None)) -> np.ndarray:
            shifted = np.full(len(symbol), END_TEXT, np.uint32)
            shifted[k:] = symbol[:-k]
            return np.where(place[at] >= k, shifted[at], np.uint32(END_TEXT))

        last, former = back(1), back(2)
        inside = last < END_WORD
        # Before a word: nothing, the one before (the last letters of a spelled one)
        # and the two before.
        spelled = np.flatnonzero(last == END_WORD)
        zero = np.zeros(len(spelled), np.uint32)
        last[spelled] = _mixed(_mixed(zero, former[spelled]), back(3, spelled))
        former[spelled] = END_WORD
        one = _mixed(np.ones(len(symbol), np.uint32), last)
        contexts = [np.zeros(len(symbol), np.uint32), one, _mixed(one + np.uint32(1), former)]
        own = [contexts[0].copy(), one.copy()] if alone else []
        # Inside a word: its last two, three and five letters, as far as it goes.
        some = np.flatnonzero(inside)
        if len(some):
            at, open_, letters = np.zeros(len(some), np.uint32), True, []
            for k in range(1, ORDER + 1):
                letter = back(k, some)
                open_ = open_ & (letter < END_WORD)
                at = _mixed(at, np.where(open_, letter, np.uint32(END_WORD)))
                letters.append(at)
            for context, k in zip([*contexts, *own], (1, 2, 4, 1, 4), strict=False):
                context[some] = letters[k]
        leaf = np.where(coded >= AGAIN, AGAIN_LEAF, self.leaf[symbol]) + inside * self.leaves
        length = self.length[leaf]
        stop = np.cumsum(length, dtype=np.int64)
        at = np.arange(stop[-1]) + np.repeat(self.start[leaf] - (stop - length), length)
        salt, shift = self.salt[at], np.uint32(32 - TABLE_BITS)
        spread = lambda c: np.repeat(c, length) ^ salt
        slots = [(spread(c) >> shift).view(np.int32) for c in contexts]
        begins = np.concatenate([[0], stop[ends - 1]])
        return slots, [spread(c) for c in own], self.bit[at], np.repeat(inside, length), begins


def _mixed(h: np.ndarray, value: np.ndarray) -> np.ndarray:
    """One more value into 32-bit hashes."""
    with np.errstate(over="ignore"):
        h = (h ^ (value * np.uint32(0x9E3779B1) + np.uint32(0x7F4A7C15))) * np.uint32(0x85EBCA6B)
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0xC2B2AE35)
        return h ^ (h >> np.uint32(13))


# --- contexts and weights --------------------------------------------------

_TABLE = pa.schema([("context", pa.int32()), ("block", pa.int32()), ("counts", pa.binary())])


def stored(text: np.ndarray) -> bytes:
    """A text of symbols as bytes."""
    return (text & (AGAIN - 1)).astype("<u2").tobytes() + np.packbits(text >= AGAIN).tobytes()


def restored(blob: bytes) -> np.ndarray:
    n = 8 * len(blob) // 17
    text = np.frombuffer(blob, "<u2", n).astype(np.int32)
    return text + np.unpackbits(np.frombuffer(blob, np.uint8, offset=2 * n), count=n).astype(np.int32) * AGAIN


def _spelled(words: list[bytes]) -> np.ndarray:
    """Words letter by letter, each with its end."""
    letters = np.frombuffer(b" ".join([*words, b""]), np.uint8).astype(np.int32)
    letters[letters == 32] = END_WORD
    return letters


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list[np.ndarray], list[np.ndarray], list[tuple]]]:
    """Coded texts, some at once, their lessons and what else is known of them."""
    held, lessons, rows, size = [], [], [], 0
    for blob, lesson, *row in rows_of(batches, "symbols", "lessons", *ABOUT):
        held.append(restored(blob))
        if lesson:
            lessons.append(_spelled(lesson.split(b" ")))
        rows.append(row)
        size += len(held[-1])
        if size > SYMBOLS_AT_ONCE:
            yield held, lessons, rows
            held, lessons, rows, size = [], [], [], 0
    if held:
        yield held, lessons, rows


def table_sizes() -> list[int]:
    return [1 << TABLE_BITS] * CONTEXTS


def count_contexts(docs: DataFrame, sent) -> DataFrame:
    """Per task, context and block of slots: how often each bit followed."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = sent.value
        tables = [np.zeros(2 * n, np.uint32) for n in table_sizes()]
        any_ = False
        for texts, lessons, _ in _texts(batches):
            any_ = True
            slots, _, bit, _, _ = coder.decisions(texts, False)
            for table, slot in zip(tables, slots, strict=True):
                np.add.at(table, 2 * slot + bit, np.uint32(1))
            if lessons:
                slots, _, bit, inside, _ = coder.decisions(lessons, False)
                for table, slot in zip(tables, slots, strict=True):
                    np.add.at(table, (2 * slot + bit)[inside], np.uint32(1))

        def rows():
            for context, table in enumerate(tables if any_ else ()):
                for block, start in enumerate(range(0, len(table), 2 << BLOCK_BITS)):
                    part = table[start : start + (2 << BLOCK_BITS)]
                    if part.any():
                        yield context, block, pack_planes(part)

        yield from batched(rows(), _TABLE, 16)

    return docs.mapInArrow(count, "context int, block int, counts binary")


_LEARNED = pa.schema([("context", pa.int32()), ("block", pa.int32()), ("cells", pa.binary())])
LEVEL = np.array([0, 1, 2, 2, 3, 3, 3, 3], np.int16)  # of how often seen


def _sum_block(key, frame):
    """Of a block: stretched predictions (eighths) and the level of how often seen."""
    counts = sum(unpack_planes(b).astype(np.float64) for b in frame["counts"].to_pylist())
    n0, n1 = counts[0::2], counts[1::2]
    stretch = np.clip(np.round(8 * np.log((n1 + 0.2) / (n0 + 0.2))), -127, 127).astype(np.int16)
    level = LEVEL[np.minimum(np.floor(np.log2(n0 + n1 + 1)), 7).astype(np.int64)]
    row = {"context": key[0].as_py(), "block": key[1].as_py(), "cells": (stretch * 4 + level).tobytes()}
    return pa.Table.from_pylist([row], schema=_LEARNED)


def _summed(counts: DataFrame) -> list:
    """The whole model: two bytes per slot of tables of fixed size."""
    ddl = "context int, block int, cells binary"
    return settle(counts.groupBy("context", "block").applyInArrow(_sum_block, ddl), "contexts").collect()


class Own:
    """What a text has shown of itself so far: bits by context, in a table of its
    own size for each text, so that no text's score depends on others."""

    WIDE = np.uint32(0xFF00FF00)  # set in a pair of counters beyond 255
    _n0, _n1 = np.arange(1 << 16) & 255, np.arange(1 << 16) >> 8
    STRETCH = (np.log(_n1 + 0.4) - np.log(_n0 + 0.4)).astype(np.float32)
    LEVEL = np.minimum((_n0 + _n1 + 1) >> 1, 2).astype(np.int16)

    def __init__(self, hashes: np.ndarray, begins: np.ndarray):
        size = np.diff(begins)
        width = 1 << np.ceil(np.log2(np.maximum(2 * size, 2))).astype(np.int64)
        start = np.cumsum(width) - width
        self.slot = np.repeat(start, size) + (hashes & np.repeat((width - 1).astype(np.uint32), size))
        self.seen = np.zeros(2 * int(width.sum()), "<u2")
        self.pairs = self.seen.view("<u4")

    def ask(self, place: np.ndarray) -> np.ndarray:
        """How often each bit was seen (0 to 255), as one number."""
        self.at = self.slot[place]
        pair = self.pairs[self.at]
        return (pair | pair >> np.uint32(8)) & np.uint32(0xFFFF)

    def learn(self, bit: np.ndarray) -> None:
        """The bits of what was asked last."""
        np.add.at(self.seen, 2 * self.at + bit, np.uint16(1))
        full = (self.pairs[self.at] & self.WIDE) != 0
        if full.any():
            full = np.unique(self.at[full])
            while len(full):  # they are halved
                self.pairs[full] = (self.pairs[full] >> np.uint32(1)) & np.uint32(0x7FFF7FFF)
                full = full[(self.pairs[full] & self.WIDE) != 0]


class Model:
    """The tables of the contexts and the gated weights."""

    GATES = 4 * 4 * 3 * 2

    def __init__(self, coder: Coder, blocks: list):
        self.coder = coder
        self.cells = [np.zeros(n, np.int16) for n in table_sizes()]
        for b in blocks:
            part = np.frombuffer(b.cells, np.int16)
            self.cells[b.context][b.block << BLOCK_BITS : (b.block << BLOCK_BITS) + len(part)] = part
        self.weights = np.tile(np.array(START, np.float32), (self.GATES, 1))

    def learn(self, texts: list[np.ndarray], squares: np.ndarray) -> int:
        """Online: the weights follow the texts' decisions, block by block, in steps
        that shrink with ``squares``, the slopes met so far."""
        return self._run(texts, squares)[1]

    def log2(self, texts: list[np.ndarray]) -> list[float]:
        """log2 probability of each text's decisions."""
        return self._run(texts)[0]

    def _run(self, texts: list[np.ndarray], squares: np.ndarray | None = None) -> tuple[list[float], int]:
        """All texts side by side, a block of each at a time: predict the block,
        then learn from it (the text's own contexts, its gain and offset)."""
        slots, hashes, bit, inside, begins = self.coder.decisions(texts)
        cells = [c[k] for c, k in zip(self.cells, slots, strict=True)]
        gate = (((cells[1] & 3) << 2 | (cells[2] & 3)) * 2 + inside) * 3
        static = [(c >> 2).astype(np.float32) * np.float32(0.125) for c in cells]
        del slots, cells
        own = [Own(h, begins) for h in hashes]
        size = np.diff(begins)
        order = np.argsort(-size, kind="stable")
        begin, size = begins[:-1][order], size[order]
        gain, offset = np.ones(len(size), np.float32), np.zeros(len(size), np.float32)
        total = np.zeros(len(size))
        at = 0
        while at < size[0]:
            step = min(max(BLOCK, at // GROWTH), LARGEST)
            live = int(np.searchsorted(-size, -at, "left"))
            n = np.minimum(size[:live] - at, step)
            stop = np.cumsum(n)
            first = stop - n
            place = np.arange(stop[-1]) + np.repeat(begin[:live] + at - first, n)
            asked = [o.ask(place) for o in own]
            g = gate[place] + Own.LEVEL.take(asked[-1])
            x = [*(k.take(place) for k in static), *(Own.STRETCH.take(k) for k in asked)]
            z = sum(w.take(g) * k for w, k in zip(np.ascontiguousarray(self.weights.T), x, strict=True))
            b = bit[place]
            s = b * np.float32(2) - np.float32(1)
            # log sigmoid of the refined logit, on the side that came
            y = s * (np.repeat(gain[:live], n) * z + np.repeat(offset[:live], n))
            logs = np.minimum(y, 0) - np.log(1 + np.exp(-np.abs(y)))
            total[:live] += np.add.reduceat(logs, first, dtype=np.float64)
            error = s * (1 - np.exp(logs))
            part = np.minimum(1, BLOCK / n)  # a larger block is no larger step
            offset[:live] += OFFSET_RATE * part * np.add.reduceat(error, first)
            gain[:live] = np.clip(gain[:live] + GAIN_RATE * part * np.add.reduceat(error * z, first), 0.5, 2)
            for o in own:
                o.learn(b)
            at += step
            if squares is not None:
                plain = s / (1 + np.exp(np.clip(s * z, -30, 30)))
                slope = np.stack([np.bincount(g, plain * k, self.GATES) for k in x], 1)
                squares += slope * slope
                self.weights += (RATE * slope / np.sqrt(squares + 1e-6)).astype(np.float32)
        out = np.empty(len(size))
        out[order] = total / np.log(2)
        return out.tolist(), len(bit)


def learn_weights(docs: DataFrame, sent) -> np.ndarray:
    """The tasks' weights, averaged by how much each has learned from."""

    def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = sent.value
        start, model, n = base.weights.copy(), base, 0
        squares = np.zeros(start.shape)
        for texts, _, _ in _texts(batches):
            n += model.learn(texts, squares)
        learned, model.weights = model.weights, start
        if n:
            yield from batched([(learned.astype(np.float64).ravel().tolist(), n)], pa.schema([("w", pa.list_(pa.float64())), ("n", pa.int64())]))

    by = docs.mapInArrow(learn, "w array<double>, n long").select("n", F.posexplode("w").alias("k", "w"))
    means = by.groupBy("k").agg((F.sum(F.col("w") * F.col("n")) / F.sum("n")).alias("w")).collect()
    weights = sent.value.weights.copy()
    for r in means:
        weights.ravel()[r.k] = r.w
    return weights


# --- coding ----------------------------------------------------------------

# Of a text, besides its decisions: shares is the log2 probability of words in their leaves.
ABOUT = ("doc_id", "fold", "n_tokens", "n_known", "base_score", "shares", "bytes")
_CODED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("fold", pa.int32()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("base_score", pa.float64()),
        ("shares", pa.float64()),
        ("bytes", pa.int64()),
        ("symbols", pa.binary()),
        ("lessons", pa.binary()),
    ]
)
_CODED_DDL = (
    "doc_id long, fold int, n_tokens long, n_known long, base_score double, "
    "shares double, bytes long, symbols binary, lessons binary"
)


class Numbers(dict):
    """Words to numbers, in the order in which they come; 0 is the end."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) + 1
        return n


class Slice:
    """Codes texts whose words' counts are known."""

    def __init__(self, coder: Coder, words: list[bytes], keys: np.ndarray, counts: np.ndarray, log_all: float, leaf_sums: np.ndarray):
        """The end leads ``keys`` and ``counts``; ``words`` has none."""
        self.names, self.counts, self.log_all = words, counts, log_all
        self.symbol = coder.words(keys, counts)
        self.symbol[0] = END_TEXT
        leaf = coder.leaf[self.symbol]
        self.plain = leaf >= FIRST_LEAF  # has a leaf of its own
        self.plain[0] = True
        self.rare = (counts < 2) & ~self.plain  # to be spelled
        self.share = np.where(self.plain | self.rare, 0, np.log2(np.maximum(counts, 1) / np.maximum(leaf_sums[leaf], 1)))
        self.logs = np.log10(counts + 1)
        self.chance = np.where(counts > 1, 1 / np.maximum(counts, 1), 0)
        self.chance[0] = 0

    def rows(self, held: list[tuple[int | None, int, np.ndarray, int]]) -> Iterator[tuple]:
        """Of texts (doc_id, bytes, numbers of words and the end, seed): as _CODED."""
        number = np.concatenate([h[2] for h in held])
        sizes = np.array([len(h[2]) for h in held])
        ends = np.cumsum(sizes)
        text = np.repeat(np.arange(len(held)), sizes)
        symbol, share = self.symbol[number], self.share[number]
        # Words without leaves of their own: how often the text has had them, and all such.
        some = np.flatnonzero(~self.plain[number])
        key = text[some] * len(self.counts) + number[some]
        order = np.argsort(key, kind="stable")
        ranks = np.arange(len(some))
        new = np.append(True, np.diff(key[order]) != 0)[: len(some)]
        before = np.empty(len(some), np.int64)
        before[order] = ranks - np.maximum.accumulate(np.where(new, ranks, 0))
        own = text[some]
        first = np.flatnonzero(np.append(True, np.diff(own) != 0)[: len(own)])
        there = ranks - np.repeat(ranks[first], np.diff(np.append(first, len(own))))
        again = before > 0
        at = some[again]
        symbol[at] += AGAIN
        share[at] = np.log2(before[again] / there[again])
        at = some[~again]
        at = at[self.rare[number[at]]]
        size = np.ones(len(number), np.int64)
        names = [self.names[k - 1] for k in number[at].tolist()]
        size[at] = [len(w) + 1 for w in names]
        start = np.cumsum(size) - size
        out = np.empty(int(size.sum()), np.int32)
        out[start] = symbol
        if names:
            letters = _spelled(names)
            length = size[at]
            out[np.repeat(start[at] - np.cumsum(length) + length, length) + np.arange(len(letters))] = letters
        stops = np.append(start, len(out))[ends]
        seed = np.repeat(np.array([h[3] for h in held], np.uint64), sizes)
        draw = (mix64(seed ^ (np.arange(len(number)) - np.repeat(ends - sizes, sizes)).astype(np.uint64)) >> np.uint64(11)) * 2.0**-53
        drawn = np.flatnonzero(draw < self.chance[number])
        lessons = np.split(number[drawn], np.searchsorted(drawn, ends[:-1]))
        shares = np.bincount(text, share, len(held)).tolist()
        counts = self.counts[number]
        known = np.bincount(text, counts > 0, len(held)).astype(np.int64).tolist()
        logs, begin, a = self.logs[number], 0, 0
        for k, (doc, length, _, _) in enumerate(held):
            stop, b = int(stops[k]), int(ends[k])
            base = float(logs[a:b].sum()) - (b - a) * self.log_all
            lesson = b" ".join([self.names[w - 1] for w in lessons[k].tolist()])
            yield doc, fold(doc), b - a, known[k], base, shares[k], length, stored(out[begin:stop]), lesson
            begin, a = stop, b


def _slice_coder(sent, log_all: float, leaf_sums: np.ndarray):
    def code(left, right):
        numbers, texts = Numbers(), []
        for doc, text in documents(left["docs"].to_pylist()):
            words = text.lower().split()
            own = np.empty(len(words) + 1, np.int32)
            own[:-1] = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
            own[-1] = 0
            texts.append((doc, len(text), own, xxhash.xxh3_64_intdigest(text)))
        names = list(numbers)
        keys = np.fromiter(map(xxhash.xxh3_64_intdigest, names), np.uint64, len(names))
        keys = np.concatenate([np.array([END_HASH], np.uint64), keys])
        told = dict(zip(right["shard"].to_pylist(), right["counts"].to_pylist(), strict=True))
        counts = np.concatenate([unpack_planes(told[k]).astype(np.int64) for k in sorted(told)])
        if len(counts) != len(keys):
            raise ValueError("a slice's words and their counts do not match")
        own = np.empty(len(counts), np.int64)
        own[np.argsort(keys)] = counts
        coder = Slice(sent.value, names, keys, own, log_all, leaf_sums)
        rows, held, size = [], [], 0
        for text in texts:
            held.append(text)
            size += len(text[2])
            if size > SYMBOLS_AT_ONCE:
                rows += coder.rows(held)
                held, size = [], 0
        if held:
            rows += coder.rows(held)
        columns = zip(*rows, strict=True) if rows else [()] * len(_CODED)
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(columns, _CODED, strict=True)], schema=_CODED)

    return code


# --- scoring ---------------------------------------------------------------

_SCORED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("train_tokens", pa.int64()),
        ("base_score", pa.float64()),
        ("score", pa.float64()),
        ("bits_per_byte", pa.float64()),
    ]
)
_SCORED_DDL = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double, bits_per_byte double"
)


def _scorer(sent, total: int):
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for texts, _, about in _texts(batches):
                for (doc, own, n, known, base, shares, size), log2 in zip(about, sent.value.log2(texts), strict=True):
                    log2 += shares
                    yield doc, own == HELD_OUT, n, known, total, base, log2 * float(np.log10(2)), -log2 / max(1, size)

        yield from batched(rows(), _SCORED)

    return score


def coder_of(keys: np.ndarray, counts: np.ndarray, sums: np.ndarray, spelled: np.ndarray, own: int, total: int) -> tuple[Coder, np.ndarray]:
    """The code of the words of the dictionary and of the groups, and the sum of each
    leaf's counts. Words have leaves of their own from the bucket ``own`` on."""
    order = np.argsort(-counts, kind="stable")
    keys, counts = keys[order], counts[order]
    plain = int((bucket(counts) >= own).sum())
    groups = np.zeros(64, np.int64)
    np.add.at(groups, (np.arange(TWICE, own) - 1) // BUCKETS, sums[TWICE:own])
    rare = max(1, int(sums[:TWICE].sum()))
    letters = 1 + rare * spelled // max(1, int(spelled.sum()))
    again = (AGAIN_SHARE * groups).astype(np.int64)
    ends = [1, max(1, total // 100)]
    frequency = np.concatenate([letters, ends, [1 + again.sum()], 1 + groups - again, counts[:plain]])
    of_group = AGAIN_LEAF + 1 + np.log2(np.maximum(counts[plain:], 1)).astype(np.int64)
    leaf = np.concatenate([np.arange(FIRST_GROUP), AGAIN_LEAF + 1 + np.arange(64), FIRST_LEAF + np.arange(plain), of_group])
    leaf_sums = np.concatenate([np.zeros(AGAIN_LEAF + 1, np.int64), groups, counts[:plain]])
    return Coder(keys, frequency, leaf, np.concatenate([1 + 8 * letters, [rare, 1]])), leaf_sums


def scores(docs: DataFrame) -> DataFrame:
    """A row per row of ``docs``: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score (unigram, add one), score (log10 probability by the
    model), bits_per_byte."""
    spark = docs.sparkSession
    slices = slice_count(docs)
    texts = packed(docs, slices)
    counted = texts.withColumn("shards", F.lit(slices)).groupBy("slice").applyInArrow(_count_slice, _COUNTED_DDL)
    told = settle(counted.groupBy("shard").applyInArrow(_sum_shard, _TOLD_DDL), "counts")

    shards = told.where("slice = -1")
    small = shards.select("total", "distinct", "bytes", "histogram", "sums").collect()
    total, distinct = sum(r.total for r in small), sum(r.distinct for r in small)
    spelled = np.sum([r.bytes for r in small] or [[0] * 256], axis=0)
    none = [0] * 64 * BUCKETS
    above = np.cumsum(np.sum([r.histogram for r in small] or [none], axis=0)[::-1])[::-1]
    sums = np.sum([r.sums for r in small] or [none], axis=0)
    # Words seen once are spelled, so that the model learns how new words come.
    least, own = (max(int(np.flatnonzero(above <= n)[0]), TWICE) for n in (DICTIONARY, LEAVES))

    def frequent(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for k, c in rows_of(batches, "keys", "counts"):
                keys, counts = unpack_sorted(k), unpack_planes(c).astype(np.int64)
                top = (bucket(counts) >= least) & (keys != np.uint64(END_HASH))
                yield keys[top].tobytes(), counts[top].tobytes()

        yield from batched(rows(), pa.schema([("k", pa.binary()), ("c", pa.binary())]))

    got = shards.select("keys", "counts").mapInArrow(frequent, "k binary, c binary").collect()
    keys = np.concatenate([np.frombuffer(r.k, np.uint64) for r in got] or [np.empty(0, np.uint64)])
    counts = np.concatenate([np.frombuffer(r.c, np.int64) for r in got] or [np.empty(0, np.int64)])
    coder, leaf_sums = coder_of(keys, counts, sums, spelled, own, total)

    sent = spark.sparkContext.broadcast(coder)
    answers = told.where("slice >= 0").select("slice", "shard", "counts")
    code = _slice_coder(sent, float(np.log10(total + distinct + 1)), leaf_sums)
    coded = settle(texts.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(code, _CODED_DDL), "coded")
    rest = coded.where(~F.col("fold").isin(HELD_OUT, MIXING))
    mixing = coded.where(F.col("fold") == MIXING)
    counts = settle(count_contexts(rest, sent), "counts_of_contexts")
    model = Model(coder, _summed(counts))
    weights = learn_weights(mixing, spark.sparkContext.broadcast(model))
    # The documents that taught the weights now fill the contexts, too.
    model = Model(coder, _summed(counts.unionByName(count_contexts(mixing, sent))))
    model.weights = weights
    return coded.mapInArrow(_scorer(spark.sparkContext.broadcast(model), total), _SCORED_DDL)
