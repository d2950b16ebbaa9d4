"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

One inserted or deleted letter changes a word's vector of letter counts by one,
one replaced letter by two (L1). So the near words of a word lie within a small
ball around its vector, among the words of its own length and of the next.

The top of a k-d tree per length, fitted on a bounded sample of the words, cuts
the space into cells. Every word goes to its own cell and, as a visitor, to each
other cell whose box the ball touches: of its length, with a higher number (so
that a pair meets once), and of the next length. A cell's task grows the rest of
the tree from its words and sends its visitors down in blocks, pruning by boxes.
Pairs that meet in a leaf are compared by the parity of their letters, by their
vectors, and at last letter by letter. The sample only decides how even the cells
are; every word is in the search.

Nulls and the like: a null text has no words, a null doc_id is written as
nothing before the colon; ties for the form go to the word first in code-point
order; repeated rows count again; a text of any length is cut into words in one
row; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.shared import settle

SHORTEST, OCCURRENCES, DAMAGE, COMMONER = 7, 2, 31, 10
SAMPLE = 100_000  # words that the top of the trees is fitted on
CELL = 8_192  # words that a cell should hold
LEAF = 32
BLOCK = 16_384  # visitors that go down a tree at once
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Letters have a dimension each: a to z, then U+00C0 to U+00FF.
DIMENSIONS = 26 + 64
_DIMENSION = np.zeros(256, np.int64)
_DIMENSION[ord("a") : ord("z") + 1] = np.arange(26)
_DIMENSION[0xC0:] = 26 + np.arange(64)
# Parities of the dimensions, folded into 64 bits.
_BIT = np.uint64(1) << np.concatenate([np.arange(26), 26 + np.arange(64) % 38]).astype(np.uint64)


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, occurrences: int = OCCURRENCES) -> DataFrame:
    """word, n: runs of letters with A-Z in lower case. Where the checksum of
    document and run is divisible, the run loses the letter it points to."""
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
        F.explode(
            F.regexp_extract_all(
                F.coalesce(F.col("text"), F.lit("")),
                F.lit(f"[A-Za-z\\u00C0-\\u00FF]{{{shortest},}}"),
                F.lit(0),
            )
        ).alias("raw"),
    ).select("doc", F.translate("raw", UPPER, LOWER).alias("run"))
    check = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
    at = (F.col("check") % F.length("run")).cast("int")
    shorter = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    return (
        runs.withColumn("check", check)
        .select(F.when(F.col("check") % DAMAGE == 0, shorter).otherwise(F.col("run")).alias("word"))
        .where(F.length("word") >= shortest)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= occurrences)
    )


def letters(words: list[str]) -> np.ndarray:
    """Words of one length as rows of bytes: every letter is below U+0100."""
    raw = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    return raw.reshape(len(words), -1)


def vectors(rows: np.ndarray) -> np.ndarray:
    """Letter counts. Above 255 they are cut, which makes no distance larger."""
    counts = np.zeros((len(rows), DIMENSIONS), np.uint8 if rows.shape[1] < 256 else np.int32)
    number = np.arange(len(rows))
    for column in range(rows.shape[1]):
        counts[number, _DIMENSION[rows[:, column]]] += 1
    return np.minimum(counts, 255).astype(np.uint8)


def parities(rows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(rows), np.uint64)
    for column in range(rows.shape[1]):
        out ^= _BIT[_DIMENSION[rows[:, column]]]
    return out


# A tree is a leaf (any value that is no node) or a node: dimension, value, the
# tree of those at most the value, and the tree of the others.


class Node(tuple):
    """dimension, value, low, high"""


def split(points: np.ndarray) -> tuple[int, int] | None:
    """The dimension of largest spread and the value that halves it best."""
    if len(points) < 2:
        return None
    spread = points.var(axis=0)
    dimension = int(spread.argmax())
    if spread[dimension] == 0:
        return None
    column = points[:, dimension]
    shares = np.cumsum(np.bincount(column))[:-1]
    return dimension, int(np.abs(shares - len(column) / 2).argmin())


def grow(points: np.ndarray, members: np.ndarray, most: int, leaf):
    """Cut ``members`` (rows of points) until at most ``most`` are together."""
    cut = split(points[members]) if len(members) > most else None
    if cut is None:
        return leaf(members)
    dimension, value = cut
    low = points[members, dimension] <= value
    return Node((dimension, value, grow(points, members[low], most, leaf), grow(points, members[~low], most, leaf)))


def reach(tree, points: np.ndarray, radius: int) -> Iterator[tuple[object, np.ndarray]]:
    """Each leaf with the rows of points whose ball touches its box."""

    def down(node, who, distance, box):
        if not isinstance(node, Node):
            yield node, who
            return
        dimension, value, low, high = node
        at = points[who, dimension].astype(np.int16)
        least, most = box.get(dimension, (0, 255))
        before = np.maximum(least - at, 0) + np.maximum(at - most, 0)
        for child, least, most in ((low, least, value), (high, value + 1, most)):
            beyond = distance - before + np.maximum(least - at, 0) + np.maximum(at - most, 0)
            near = beyond <= radius
            if near.any():
                yield from down(child, who[near], beyond[near], box | {dimension: (least, most)})

    yield from down(tree, np.arange(len(points)), np.zeros(len(points), np.int16), {})


def homes(tree, points: np.ndarray) -> np.ndarray:
    """The leaf of each row of points."""
    out = np.empty(len(points), np.int64)
    for cell, who in reach(tree, points, 0):
        out[who] = cell
    return out


def fit(words: DataFrame, sample: int = SAMPLE, cell: int = CELL) -> dict[int, object]:
    """The top of a tree per length; leaves are numbers of cells. The driver gets
    the number of words per length and about ``sample`` words at most, picked by
    their hashes from all."""
    lengths = words.groupBy(F.length("word").alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()
    every = max(1, -(-sum(r.n for r in lengths) // sample))
    picked: dict[int, list[str]] = {r.length: [] for r in lengths}
    if any(r.n > cell for r in lengths):
        for r in words.where(F.pmod(F.xxhash64("word"), F.lit(every)) == 0).select("word").toLocalIterator():
            picked[len(r.word)].append(r.word)
    numbers = iter(range(1 << 62))
    trees = {}
    for length in sorted(picked):
        held = picked[length]
        points = vectors(letters(held)) if held else np.empty((0, DIMENSIONS), np.uint8)
        # Never fewer than 8 words of the sample decide on a cell.
        trees[length] = grow(points, np.arange(len(held)), max(8, cell // every), lambda _: next(numbers))
    return trees


_PLACED = "cell long, length int, visitor boolean, word string, n long"
_SCHEMA = pa.schema(
    [("cell", pa.int64()), ("length", pa.int32()), ("visitor", pa.bool_()), ("word", pa.string()), ("n", pa.int64())]
)


def _by_length(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[tuple[int, list[str], np.ndarray]]:
    """Words of one length and their counts, in blocks."""
    held: dict[int, list[tuple]] = {}
    for batch in batches:
        for row in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
            own = held.setdefault(len(row[0]), [])
            own.append(row)
            if len(own) >= size:
                yield _unzipped(held.pop(len(row[0])))
    for own in held.values():
        yield _unzipped(own)


def _unzipped(rows: list[tuple]) -> tuple[int, list[str], np.ndarray]:
    words, n = zip(*rows, strict=True)
    return len(words[0]), list(words), np.array(n, np.int64)


def placed(words: DataFrame, trees: dict[int, object]) -> DataFrame:
    """Every word in its own cell, and as a visitor in the others it may have
    near words in."""
    sent = words.sparkSession.sparkContext.broadcast(trees)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = sent.value
        for length, block, n in _by_length(batches, BLOCK):
            points, column = vectors(letters(block)), pa.array(block, pa.string())
            home = homes(trees[length], points)
            parts = [(home, np.arange(len(block)), False)]
            for cell, who in reach(trees[length], points, 2):
                who = who[home[who] < cell]
                parts.append((np.full(len(who), cell), who, True))
            if length + 1 in trees:
                for cell, who in reach(trees[length + 1], points, 1):
                    parts.append((np.full(len(who), cell), who, True))
            for cell, who, visitor in parts:
                if len(who):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(cell, pa.int64()),
                            pa.array(np.full(len(who), length, np.int32)),
                            pa.array(np.full(len(who), visitor)),
                            column.take(pa.array(who)),
                            pa.array(n[who]),
                        ],
                        schema=_SCHEMA,
                    )

    return words.select("word", "n").mapInArrow(place, _PLACED)


class Block:
    """Words of one length."""

    def __init__(self, words: pa.Array, n: np.ndarray):
        self.words, self.n = words, n
        self.rows = letters(words.to_pylist())
        self.points, self.parities = vectors(self.rows), parities(self.rows)


def one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether rows of letters, pair by pair, are exactly one edit apart; both of
    one length, or the second longer by one."""
    size = short.shape[1]
    if long.shape[1] == size:
        return (short != long).sum(axis=1) == 1
    front = np.logical_and.accumulate(short == long[:, :size], axis=1).sum(axis=1)
    back = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= size


def _chunked(meetings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A leaf of many words with equal vectors meets a few words at a time."""
    for members, who in meetings:
        step = max(1, (1 << 21) // max(1, len(members)))
        for start in range(0, len(who), step):
            yield members, who[start : start + step]


def near_pairs(tree, home: Block, asking: Block, within: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (asking, home) one edit apart; ``within`` one block each pair once."""
    radius = 2 if home.rows.shape[1] == asking.rows.shape[1] else 1
    for members, who in _chunked(reach(tree, asking.points, radius)):
        odd = np.bitwise_count(asking.parities[who][:, None] ^ home.parities[members][None, :])
        a, b = np.nonzero(odd <= radius)
        a, b = who[a], members[b]
        if within:
            a, b = a[a < b], b[a < b]
        far = np.abs(asking.points[a].astype(np.int16) - home.points[b]).sum(axis=1)
        a, b = a[far == radius], b[far == radius]
        true = one_edit(asking.rows[a], home.rows[b])
        if true.any():
            yield a[true], b[true]


_NEAR = "word string, near string, near_n long"
_NEAR_SCHEMA = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])


def _both_ways(asking: Block, home: Block, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    left, right = asking.words.take(pa.array(a)), home.words.take(pa.array(b))
    n = np.concatenate([home.n[b], asking.n[a]])
    return pa.RecordBatch.from_arrays(
        [pa.concat_arrays([left, right]), pa.concat_arrays([right, left]), pa.array(n)], schema=_NEAR_SCHEMA
    )


def _search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell, those at home first. Holds the words of one cell and
    a block of its visitors."""
    home = tree = cell = None

    def ask(asking: Block, within: bool = False):
        for a, b in near_pairs(tree, home, asking, within):
            yield _both_ways(asking, home, a, b)

    for key, rows in _runs(batches):
        if key[:2] != (cell, False) and not key[1]:
            home = Block(rows["word"].combine_chunks(), rows["n"].to_numpy())
            tree, cell = grow(home.points, np.arange(len(home.n)), LEAF, lambda x: x), key[0]
            yield from ask(home, within=True)
        elif key[0] == cell:  # no word at home, nothing to meet
            yield from ask(Block(rows["word"].combine_chunks(), rows["n"].to_numpy()))


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.Table]]:
    """Consecutive rows of equal cell, visitor and length: those at home all at
    once, visitors in blocks."""
    key, held, size = None, [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        cell, visitor, length = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "visitor", "length"))
        new = (np.diff(cell) != 0) | (np.diff(visitor.astype(np.int8)) != 0) | (np.diff(length) != 0)
        bounds = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for start, end in zip(bounds[:-1], bounds[1:], strict=True):
            own = (int(cell[start]), bool(visitor[start]), int(length[start]))
            if held and (own != key or (own[1] and size >= BLOCK)):
                yield key, pa.Table.from_batches(held)
                held, size = [], 0
            key = own
            held.append(batch.slice(start, end - start))
            size += end - start
    if held:
        yield key, pa.Table.from_batches(held)


def near_words(words: DataFrame, cell: int = CELL) -> DataFrame:
    """word, near, near_n: every ordered pair of words exactly one edit apart."""
    rows = placed(words, fit(words, cell=cell)).repartition("cell").sortWithinPartitions("cell", "visitor", "length")
    return rows.mapInArrow(_search, _NEAR)


def grouped(words: DataFrame, cell: int = CELL) -> DataFrame:
    """Per word: its form (the near word of largest n, if that is ten times its
    own), the root that forms lead to, n, n_near and form_n."""
    words = settle(words, "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = near_words(words, cell).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    common = -F.col("best.less") >= COMMONER * F.col("n")
    formed = settle(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(common, F.col("best.near")).alias("form"),
            F.when(common, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def roots(links: DataFrame) -> DataFrame:
    """word, root: links followed to their ends, twice as far in each round. A
    form is ten times commoner than its word, so few rounds do."""
    links, turn = settle(links, "roots0"), 0
    while True:
        turn += 1
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        followed = links.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        followed = settle(followed, f"roots{turn}")
        links = followed.select("word", "root")
        if not followed.where("moved").limit(1).count():
            return links
