"""Quality rules with n-gram perplexity bands.

Base counts of each text reject plain junk. A modified Kneser-Ney bigram model,
counted by Spark over all texts, then gives each text's perplexity, and a text
whose perplexity is outside its language's band is rejected.

Slices: a task turns its texts, some at a time, into a slice: the sorted hashes
of its distinct words and the run of their numbers. All else works on slices, so
a text is read and split once.

Counting: a slice's distinct bigrams are cut into shards by their first word and
sent as sorted, packed arrays, so a shuffled record is a whole array. A shard
merges its arrays, knows all about its contexts and answers each slice in the
order in which it asked: the count of each bigram, totals and counts of counts of
each context. Words are answered likewise, by ranges of their hashes, with the
number of distinct words before them. A slice then has the exact probability of
each of its bigrams. The model as a whole is in no one place: no n-gram is left
out, and the driver gets sums only. Shards, and slices at the end, take their turns,
so that a part of what is shuffled lies on disk at once.

Nulls and the like: a null text has no words, a null language is a language of
its own, repeated rows are kept row by row and counted each, extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.shared import (
    batched,
    gram_hashes,
    pack_planes,
    pack_sorted,
    pack_table,
    passing,
    rows_of,
    settle,
    sliced,
    text_bytes,
    text_key,
    unpack_planes,
    unpack_sorted,
    unpack_table,
    word_hashes,
    working_for,
)
from orderflow.llm.sieve import set_aside
from orderflow.session import Settle

SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 20, 30, 8
TOKENS_AT_ONCE = 900_000  # of a slice
MARGIN, LOWER_SHARE = 4.0, 0.1  # where the bands end
SHORT = 8.0  # over the square root of the words: a short text's mean varies more
SHARD_BYTES = 16 << 20  # text whose bigrams a shard should hold
TURNS, TURN_SHARDS = 6, 6  # at most so many turns, of so many shards at least
LAST_TURNS = 24  # at most, of slices, when all answers lie beside them
BITS = 48  # of a word's hash
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
PACKED = ["first", "sizes", "words", "second", "count"]
EDGE = np.uint64(0x1D872B41A9D3C57F)  # stands for the start and the end of a text


def repeated_words(words: np.ndarray, window: int = REPEAT_WINDOW) -> int:
    """Words in windows that occur twice or more, the first included."""
    grams = gram_hashes(words, window)
    if len(grams) < 2:
        return 0
    order = np.sort(grams)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    at = np.minimum(np.searchsorted(twice, grams), len(twice) - 1)
    hit = np.flatnonzero(twice[at] == grams)
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + window, -1)
    return int((np.cumsum(cover) > 0).sum())


def base_counts(text: bytes, words: list[bytes], hashes: np.ndarray) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    whole = b"".join(words)
    chars = len(whole) if whole.isascii() else len(whole.decode("utf-8", "replace"))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return (
        len(words),
        chars,
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(hashes),
    )


def _short(words: np.ndarray) -> np.ndarray:
    """What is kept of the hashes, 48 bits."""
    return words >> np.uint64(64 - BITS)


def _merged(first: np.ndarray, second: np.ndarray, count: np.ndarray, place: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Distinct bigrams in order, and the sums of their counts. ``place`` is filled
    with the number of each given one among them."""
    order = np.lexsort((second, first))
    first, second, count = first[order], second[order], count[order]
    new = np.ones(len(first), bool)
    new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    if place is not None:
        place[order] = np.cumsum(new) - 1
    at = np.flatnonzero(new)
    return first[at], second[at], np.add.reduceat(count, at) if len(at) else count


def _pack(first: np.ndarray, second: np.ndarray, count: np.ndarray) -> tuple[bytes, ...]:
    """Sorted bigrams: distinct first words, how many bigrams each has, distinct
    second words, their numbers among those as differences, the counts."""
    at = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
    words, number = np.unique(second, return_inverse=True)
    number = number.astype(np.uint64)
    steps = np.diff(number, prepend=np.uint64(0))
    steps[at] = number[at]
    sizes = np.diff(np.append(at, len(first)))
    return pack_sorted(first[at]), pack_planes(sizes), pack_sorted(words), pack_planes(steps), pack_planes(count)


def _unpack(first: bytes, sizes: bytes, words: bytes, second: bytes, count: bytes) -> tuple[np.ndarray, ...]:
    sizes, steps = unpack_planes(sizes).astype(np.int64), unpack_planes(second)
    if not len(sizes):
        return np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64)
    at = np.cumsum(sizes) - sizes
    with np.errstate(over="ignore"):
        run = np.cumsum(steps, dtype=np.uint64)
        run -= np.repeat(run[at] - steps[at], sizes)
    return np.repeat(unpack_sorted(first), sizes), unpack_sorted(words)[run], unpack_planes(count).astype(np.int64)


def pack_run(numbers: np.ndarray, counts: np.ndarray) -> bytes:
    """Words of a text by number, and how often each number comes. Frequent ones are
    renumbered first, so that the upper planes pack well; the counts tell the order."""
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    head = pack_planes(counts)
    return len(head).to_bytes(8, "little") + head + pack_planes(rank[numbers])


def unpack_run(blob: bytes) -> np.ndarray:
    end = 8 + int.from_bytes(blob[:8], "little")
    counts = unpack_planes(blob[8:end]).view("<i8")
    return np.argsort(-counts, kind="stable")[unpack_planes(blob[end:]).view("<i8")]


class Bigrams:
    """The bigrams of a slice. One edge stands between two texts: it ends the one
    and starts the other."""

    def __init__(self, run: bytes):
        numbers = unpack_run(run)
        self.words = int(numbers.max()) + 1
        self.all = numbers[:-1] * self.words
        self.all += numbers[1:]

    def split(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the first and the second word."""
        return np.divmod(keys, self.words)


def cut_slices(docs: DataFrame) -> DataFrame:
    """slice, size (bytes of text), docs (packed: doc_id, lang, text_key, the base
    counts of each text), words, run."""
    schema = pa.schema([("slice", pa.binary()), ("size", pa.int64()), *((n, pa.binary()) for n in ("docs", "words", "run"))])
    own = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("text_key", pa.binary()), *((n, pa.int64()) for n in COUNTS)])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        working_for("quality")

        def packed(held: list[tuple], texts: list[np.ndarray], size: int) -> tuple:
            edge = np.array([EDGE])
            run = np.concatenate([edge, *(part for words in texts for part in (words, edge))])
            texts.clear()
            run >>= np.uint64(64 - BITS)
            words, run, counts = np.unique(run, return_inverse=True, return_counts=True)
            table = pa.table(list(zip(*held, strict=True)), schema=own)
            return uuid.uuid4().bytes, size, pack_table(table), pack_sorted(words), pack_run(run, counts)

        def rows():
            held, texts, size, tokens = [], [], 0, 0
            for doc, lang, key, text in rows_of(sliced(batches), "doc_id", "lang", "text_key", "text"):
                words = text.split()
                texts.append(word_hashes(words))
                held.append((doc, lang, key, *base_counts(text, words, texts[-1])))
                size += len(text)
                tokens += len(words) + 1
                if tokens >= TOKENS_AT_ONCE:
                    yield packed(held, texts, size)
                    held, texts, size, tokens = [], [], 0, 0
            if held:
                yield packed(held, texts, size)

        yield from batched(rows(), schema, 1)

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _lang(docs).alias("lang"), text_key().alias("text_key"), text_bytes().alias("text")
    ).mapInArrow(cut, "slice binary, size long, docs binary, words binary, run binary")


def _ranges(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where ascending keys are cut into shards by their high bits."""
    return np.searchsorted(keys, [np.uint64((k << BITS) // shards) for k in range(1, shards)])


def count_bigrams(slices: DataFrame, shards: int, own: range | None = None) -> DataFrame:
    """shard, slice and the packed bigram counts of a slice by shard of the first word,
    of the shards ``own`` (or all)."""
    own = range(shards) if own is None else own
    schema = pa.schema([("shard", pa.int32()), ("slice", pa.binary()), *((n, pa.binary()) for n in PACKED)])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        working_for("quality")

        def rows():
            for name, words, run in rows_of(sliced(batches, 1), "slice", "words", "run"):
                bigrams, words = Bigrams(run), unpack_sorted(words)
                edges = [0, *_ranges(words, shards).tolist(), len(words)]
                low, high = (edges[k] * bigrams.words for k in (own.start, own.stop))
                keys = bigrams.all[(bigrams.all >= low) & (bigrams.all < high)]
                keys, n = np.unique(keys, return_counts=True)
                first, second = (words[k] for k in bigrams.split(keys))
                cuts = _ranges(first, shards)
                for k, (f, s, c) in enumerate(zip(*(np.split(x, cuts) for x in (first, second, n)), strict=True)):
                    if len(f):
                        yield k, name, *_pack(f, s, c)

        yield from batched(rows(), schema, 64)

    return slices.select("slice", "words", "run").mapInArrow(
        count, "shard int, slice binary, " + ", ".join(f"{n} binary" for n in PACKED)
    )


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    """The arrays as one; they are let go of."""
    whole = np.concatenate(parts)
    parts.clear()
    return whole


def merge_shards(counted: DataFrame, whole: bool = False) -> DataFrame:
    """Per shard a row for each slice: the count of each of its bigrams, and of each
    of its contexts the total and how many bigrams have a count of 1, of 2, of more
    (one after another). Besides a row without slice: all second words with their
    numbers of distinct first words, how many bigrams have the counts 1 to 4, and
    with ``whole`` the bigrams themselves."""
    fields = [("shard", pa.int32()), ("slice", pa.binary()), ("counts", pa.binary()), ("contexts", pa.binary()), ("word", pa.binary()), ("before", pa.binary()), ("histogram", pa.list_(pa.int64())), *((n, pa.binary()) for n in PACKED)]

    def merge(key, frame):
        names = frame["slice"].to_pylist()
        columns = [list(x) for x in zip(*(_unpack(*(r[n] for n in PACKED)) for r in frame.select(PACKED).to_pylist()), strict=True)]
        ends = np.cumsum([len(x) for x in columns[0]])
        first, second, count = (_joined(columns.pop(0)) for _ in range(3))
        place = np.empty(len(first), np.int64)
        first, second, count = _merged(first, second, count, place)
        start = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
        context = np.cumsum(np.append(True, first[1:] != first[:-1])) - 1
        about = [np.add.reduceat(x, start, dtype=np.int64) for x in (count, count == 1, count == 2, count > 2)]
        rows = []
        for name, own in zip(names, np.split(place, ends[:-1]), strict=True):
            asked = context[own]
            asked = asked[np.append(True, asked[1:] != asked[:-1])]
            rows.append({"slice": name, "counts": pack_planes(count[own]), "contexts": pack_planes(np.concatenate([x[asked] for x in about]))})
        word, before = np.unique(second, return_counts=True)
        last = {"word": pack_sorted(word), "before": pack_planes(before), "histogram": _few(count)}
        if whole:
            last |= dict(zip(PACKED, _pack(first, second, count), strict=True))
        return pa.Table.from_pylist([{"shard": key[0].as_py()} | r for r in [*rows, last]], schema=pa.schema(fields))

    ddl = "shard int, slice binary, counts binary, contexts binary, word binary, before binary, histogram array<long>"
    return counted.groupBy("shard").applyInArrow(merge, ddl + "".join(f", {n} binary" for n in PACKED))


def _few(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3 and 4."""
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist()


def count_words(merged: DataFrame, slices: DataFrame, shards: int, own: range | None = None) -> DataFrame:
    """By range of the words (of the ranges ``own``, or all) a row for each slice: of each of its words before how
    many distinct words it stands after (``before``). Besides a row without slice:
    all words of the range and theirs, how many there are, their sum, and how many
    of them are 1 to 4."""
    schema = pa.schema([("shard", pa.int32()), ("slice", pa.binary()), ("word", pa.binary()), ("before", pa.binary())])
    own = range(shards) if own is None else own

    def told(batches):
        def rows():
            for word, n in rows_of(batches, "word", "before"):
                word, n = unpack_sorted(word), unpack_planes(n)
                cuts = _ranges(word, shards)
                for k, (w, c) in enumerate(zip(np.split(word, cuts), np.split(n, cuts), strict=True)):
                    if len(w) and k in own:
                        yield k, None, pack_sorted(w), pack_planes(c)

        yield from batched(rows(), schema, 64)

    def asked(batches):
        def rows():
            for name, words in rows_of(batches, "slice", "words"):
                word = unpack_sorted(words)
                for k, w in enumerate(np.split(word, _ranges(word, shards))):
                    if len(w) and k in own:
                        yield k, name, pack_sorted(w), None

        yield from batched(rows(), schema, 64)

    out = pa.schema([*schema, ("n", pa.int64()), ("total", pa.int64()), ("histogram", pa.list_(pa.int64()))])

    def answer(key, frame):
        part = {"shard": key[0].as_py()}
        rows = frame.select(["slice", "word", "before"]).to_pylist()
        parts = [r for r in rows if r["slice"] is None]
        word, at = np.unique(np.concatenate([unpack_sorted(r["word"]) for r in parts]), return_inverse=True)
        n = np.bincount(at, np.concatenate([unpack_planes(r["before"]) for r in parts])).astype(np.int64)
        answers = [
            part | {"slice": r["slice"], "before": pack_planes(n[np.searchsorted(word, unpack_sorted(r["word"]))])}
            for r in rows
            if r["slice"] is not None
        ]
        last = {"word": pack_sorted(word), "before": pack_planes(n), "n": len(n), "total": int(n.sum()), "histogram": _few(n)}
        return pa.Table.from_pylist([*answers, part | last], schema=out)

    ddl = "shard int, slice binary, word binary, before binary"
    return (
        merged.where("slice is null").select("word", "before").mapInArrow(told, ddl)
        .unionByName(slices.select("slice", "words").mapInArrow(asked, ddl))
        .groupBy("shard")
        .applyInArrow(answer, ddl + ", n long, total long, histogram array<long>")
    )


def discounts(histogram: list[int]) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 0, 1, 2 and 3 or more, from the
    numbers of counts 1 to 4."""
    n = [max(1.0, float(x)) for x in histogram]
    y = n[0] / (n[0] + 2 * n[1])
    d = [k + 1 - (k + 2) * y * n[k + 1] / n[k] for k in range(3)]
    return np.array([0.0, *(min(max(x, 0.05), k + 0.95) for k, x in enumerate(d))])


@dataclass(frozen=True)
class Shares:
    """What counts come to, by a few sums over the corpus."""

    discount: np.ndarray
    word_discount: np.ndarray
    total: int  # of the numbers of words before a word
    left: float  # the share of a word as such, known or not

    def low(self, before: np.ndarray) -> np.ndarray:
        """Probability of a word in the lower order."""
        before = before.astype(np.int64)
        return (before - self.word_discount[np.minimum(before, 3)]) / self.total + self.left

    def direct(self, count: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Probability of a bigram by its own count."""
        count = count.astype(np.int64)
        return ((count - self.discount[np.minimum(count, 3)]) / total).astype(np.float32)

    def back(self, contexts: np.ndarray) -> np.ndarray:
        """What contexts (total; counts of 1, of 2, of more) leave to the lower order."""
        return (self.discount[1:] @ contexts[1:] / contexts[0]).astype(np.float32)


def _four(column: str) -> list[Column]:
    return [F.coalesce(F.sum(F.col(column)[k]), F.lit(0)).alias(f"h{k}") for k in range(4)]


def _shares(merged: DataFrame, words: DataFrame) -> Shares:
    of_bigrams = merged.where("slice is null").agg(*_four("histogram")).first()
    *of_words, n, total = words.where("slice is null").agg(*_four("histogram"), F.sum("n"), F.sum("total")).first()
    n, total, by = n or 0, total or 1, discounts(of_words)
    rest = by[1] * of_words[0] + by[2] * of_words[1] + by[3] * (n - of_words[0] - of_words[1])
    return Shares(discounts(of_bigrams), by, total, max(0.0, rest / total) / (n + 1))


def _shards(slices: DataFrame) -> int:
    return max(4, -(-(slices.agg(F.sum("size")).first()[0] or 0) // SHARD_BYTES))


class Model:
    """The whole model as tables: packed bigrams by shard, words by range."""

    def __init__(self, bigrams: DataFrame, words: DataFrame, shares: Shares, shards: int):
        self.bigrams, self.words, self.shares, self.shards = bigrams, words, shares, shards

    def _asked(self, table: DataFrame, keys: np.ndarray, find) -> dict[int, tuple]:
        """What the shards of some keys say, by number of the question."""
        shard, columns = [int(k) * self.shards >> BITS for k in keys], table.columns
        schema = pa.schema([("number", pa.int64()), ("a", pa.float64()), ("b", pa.float64())])

        def look(batches):
            yield from batched((found for row in rows_of(batches, *columns) for found in find(*row)), schema)

        rows = table.where(F.col("shard").isin(sorted(set(shard)))).mapInArrow(look, "number long, a double, b double").collect()
        return {r.number: (r.a, r.b) for r in rows}

    def probabilities(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Of some bigrams, by the hashes of their words."""
        first, second = _short(first), _short(second)
        shares = self.shares

        def of_words(_, word, before):
            word, low = unpack_sorted(word), shares.low(unpack_planes(before))
            for k, w in enumerate(second):
                at = np.searchsorted(word, w)
                if at < len(word) and word[at] == w:
                    yield k, float(low[at]), 0.0

        def of_bigrams(_, *packed):
            f, s, n = _unpack(*packed)
            for k, (x, y) in enumerate(zip(first, second, strict=True)):
                own = slice(*np.searchsorted(f, [x, x + np.uint64(1)]))
                if own.start < own.stop:
                    c = n[own]
                    about = np.array([[c.sum()], [(c == 1).sum()], [(c == 2).sum()], [(c > 2).sum()]])
                    hit = c[s[own] == y]
                    yield k, float(shares.direct(hit, about[0])[0]) if len(hit) else 0.0, float(shares.back(about)[0])

        words = self.words.where("slice is null").select("shard", "word", "before")
        low = self._asked(words, second, of_words)
        near = self._asked(self.bigrams.select("shard", *PACKED), first, of_bigrams)
        return np.array(
            [d + b * low.get(k, (shares.left,))[0] for k in range(len(first)) for d, b in [near.get(k, (0.0, 1.0))]]
        )


def fit(docs: DataFrame) -> Model:
    """Count all texts; the model stays with Spark."""
    slices = settle(cut_slices(docs), "slices")
    shards = _shards(slices)
    merged = settle(merge_shards(count_bigrams(slices, shards), whole=True), "bigrams")
    words = settle(count_words(merged, slices, shards), "words")
    return Model(merged.where("slice is null"), words, _shares(merged, words), shards)


def _turns(shards: int) -> int:
    return max(1, min(TURNS, shards // TURN_SHARDS))


def _lang(docs: DataFrame) -> Column:
    return F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")


def score(docs: DataFrame, settle: Settle = settle) -> DataFrame:
    """Per row: doc_id, lang, text_key, the base counts and log2 (null without
    words), by the model of all rows."""
    slices = settle(cut_slices(docs), "slices")
    shards = _shards(slices)
    turns = _turns(shards)
    parts = [range(k * shards // turns, (k + 1) * shards // turns) for k in range(turns)]
    merged = [settle(merge_shards(count_bigrams(slices, shards, own)).drop(*PACKED), f"bigrams_{k}") for k, own in enumerate(parts)]
    merged = reduce(DataFrame.unionByName, merged)
    words = [settle(count_words(merged, slices, shards, own), f"words_{k}") for k, own in enumerate(parts)]
    words = reduce(DataFrame.unionByName, words)
    shares = _shares(merged, words)
    none = lambda *names: [F.lit(None).cast("binary").alias(n) for n in names]
    rows = (
        slices.select("slice", F.lit(None).cast("int").alias("shard"), "docs", "run", *none("counts", "contexts", "before"))
        .unionByName(merged.where("slice is not null").select("slice", "shard", *none("docs", "run"), "counts", "contexts", *none("before")))
        .unionByName(words.where("slice is not null").select("slice", "shard", *none("docs", "run", "counts", "contexts"), "before"))
    )

    def measure(key, frame):
        got = sorted(frame.drop(["slice"]).to_pylist(), key=lambda r: -1 if r["shard"] is None else r["shard"])
        own = got[0]
        table = unpack_table(own["docs"])
        bigrams = Bigrams(own["run"])
        before = np.concatenate([unpack_planes(r["before"]) for r in got if r["before"] is not None])
        count = np.concatenate([unpack_planes(r["counts"]) for r in got if r["counts"] is not None])
        about = np.concatenate([unpack_planes(r["contexts"]).reshape(4, -1) for r in got if r["contexts"] is not None], axis=1).astype(np.int64)
        keys, at = np.unique(bigrams.all, return_inverse=True)
        first, second = bigrams.split(keys)
        context = np.cumsum(np.append(True, first[1:] != first[:-1])) - 1
        p = shares.direct(count, about[0][context]) + shares.back(about)[context] * shares.low(before)[second]
        sizes = table["n_words"].to_numpy() + 1
        logs = np.add.reduceat(np.log2(p)[at], np.cumsum(sizes) - sizes) / sizes
        return table.append_column("log2", pa.array(logs, mask=sizes == 1))

    ddl = "doc_id long, lang string, text_key binary, " + ", ".join(f"{n} long" for n in COUNTS) + ", log2 double"
    last = min(turns * turns, LAST_TURNS)
    turn = F.pmod(F.crc32("slice"), F.lit(last))
    scored = [settle(rows.where(turn == k).groupBy("slice").applyInArrow(measure, ddl), f"measured_{k}") for k in range(last)]
    return reduce(DataFrame.unionByName, scored)


def bands(scored: DataFrame, margin: float = MARGIN) -> DataFrame:
    """lang, lower, upper: limits of log2 perplexity by language, from the texts
    that pass the base rules. Copies of other texts are predicted well, so the
    low side of the distribution is wide: it is only cut at a share of the
    median. The high side is cut at so many times the distance from the median
    to the upper quartile (half a bit at least) beyond that quartile."""
    sound = scored.where(~base_failed() & F.col("log2").isNotNull())
    quartile = lambda q: F.percentile_approx(-F.col("log2"), q, 10_000)
    return (
        sound.groupBy("lang")
        .agg(quartile(0.5).alias("q2"), quartile(0.75).alias("q3"))
        .select(
            "lang",
            (F.col("q2") * LOWER_SHARE).alias("lower"),
            (F.col("q3") + F.greatest(F.lit(0.5), F.col("q3") - F.col("q2")) * margin).alias("upper"),
        )
    )


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _verdicts(docs: DataFrame) -> DataFrame:
    with passing(docs.sparkSession) as step:
        scored = settle(score(docs, step), "scored")
    bounds = settle(bands(scored), "bands").withColumnRenamed("lang", "band_lang")
    upper = F.col("upper") + SHORT / F.sqrt("n_words")
    inside = (-F.col("log2")).between(F.col("lower"), upper)
    return (
        scored.join(bounds, F.col("lang").eqNullSafe(F.col("band_lang")), "left")
        .drop("band_lang")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False)))
    )


def judged(docs: DataFrame) -> DataFrame:
    """Per row of the input: the counts, log2, base_failed, lower, upper, kept."""
    return _verdicts(docs).drop("text_key")


def sound(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns. Rows of one
    doc_id, language and text have one verdict; those rejected are told by these."""
    names = ["__quality_doc", "__quality_lang", "__quality_text"]
    gone = settle(_verdicts(docs).where("not kept").select("doc_id", "lang", "text_key").distinct().toDF(*names), "gone")
    own = [F.col("doc_id").cast("long"), _lang(docs), text_key()]
    some, others = set_aside(docs, F.xxhash64(*own), gone.select(F.xxhash64(*names)))
    doc, lang, text = (x.eqNullSafe(F.col(n)) for x, n in zip(own, names, strict=True))
    return some.join(gone, doc & lang & text, "left_anti").union(others)
