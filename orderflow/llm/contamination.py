"""Benchmark decontamination: BM25 retrieval of test items by training passages.

Test items form an inverted index, built and broadcast in shards of a fixed
number of items and words. Every passage of every training document queries each
shard. As in block-max WAND, upper bounds rule out most work: first the sum of
each word's largest impact, then its largest impact in each block of items; only
the blocks left are scored. All items whose score is above the threshold are
retrieved, none is ranked away. A retrieved pair is then verified on the text:
enough of the question's and of the answer's word runs must occur in the
document.

A test item is one text. Its last sentence counts as the answer (the last
quarter of the words if there is only one sentence), the rest as the question.
An item's impacts are capped by its own words, so its score against a passage
that holds it whole is known: the threshold is a share of it.

Nulls and the like: null or wordless texts and items match nothing; items with a
null item_id keep it; repeated documents or items are matched row by row; long
texts are cut into overlapping passages, so nothing is left out; an empty table
on either side gives no rows.
"""

from __future__ import annotations

import re
import string
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm.shared import batched, rows_of, settle, text_bytes, text_key, working_for
from orderflow.llm.sieve import set_aside

K1, B = 1.2, 0.75
SHARE = 0.5  # of an item's own score
RUN = 3  # words of a run
QUESTION, ANSWER = 0.6, 0.6  # shares of runs that must occur
PASSAGE_STEP = 64  # words; a passage is two steps, one begins at every step
SEGMENT = 64  # words of an item that are one entry of the index
STRETCH = 128  # passages scored at once
BLOCK = 16  # entries
MARKS = string.punctuation.encode()
SHARD_ITEMS, SHARD_BYTES = 20_000, 8 << 20  # bounds of what is broadcast at once

def normal(words: list[bytes]) -> list[bytes]:
    """Lower case, without ASCII punctuation around: an edit of case or marks is no change."""
    lowered = b" ".join(words).decode("utf-8", "replace").lower().encode().split()
    return [w for w in [x.strip(MARKS) for x in lowered] if w]


def runs(words: list[bytes]) -> set:
    """Word runs of a text; a text shorter than a run is one run itself."""
    if len(words) < RUN:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(RUN)), strict=False))


def question_answer(text: bytes) -> tuple[list[bytes], list[bytes]]:
    """Normal words of the question and of the answer."""
    sentences = [s for s in (normal(x.split()) for x in re.split(rb"(?<=[.!?])\s+|\n", text)) if s]
    words = [w for s in sentences for w in s]
    cut = len(words) - len(sentences[-1]) if len(sentences) > 1 else len(words) - max(1, len(words) // 4)
    return (words[:cut], words[cut:]) if words else ([], [])


class Index:
    """One shard of items: dense upper bounds by block, sparse impacts."""

    def __init__(self, items: list[tuple[int | None, bytes]]):
        self.items, entries = [], []
        for item, text in items:
            question, answer = question_answer(text)
            words = question + answer
            if not words:
                continue
            self.items.append((item, frozenset(runs(question)), frozenset(runs(answer))))
            pieces = max(1, round(len(words) / SEGMENT))
            size = -(-len(words) // pieces)
            entries += [(len(self.items) - 1, Counter(words[k : k + size])) for k in range(0, len(words), size)]
        # Entries of like words stand together, so that the bounds of blocks are close.
        common = Counter(w for _, e in entries for w in e)
        entries.sort(key=lambda e: sorted(e[1], key=lambda w: (-common[w], w))[:3])
        self.owner = np.array([e[0] for e in entries], np.int64)
        df = Counter(w for _, e in entries for w in e)
        self.term = {w: k for k, w in enumerate(df)}
        lengths = np.array([sum(e.values()) for _, e in entries], np.float64)
        mean = lengths.mean() if entries else 1.0
        idf = np.array([np.log(1 + (len(entries) - n + 0.5) / (n + 0.5)) for n in df.values()])
        cells = [(self.term[w], k, c) for k, (_, e) in enumerate(entries) for w, c in e.items()]
        t, at, c = (np.array(x) for x in zip(*cells, strict=True)) if cells else (np.empty(0, int),) * 3
        weight = idf[t] * c * (K1 + 1) / (c + K1 * (1 - B + B * lengths[at] / mean)) if cells else np.empty(0)
        self.need = SHARE * np.bincount(at, weight, len(entries)) if cells else np.empty(0)
        self.blocks = -(-len(entries) // BLOCK)
        # The last row is for words that no item has.
        self.bound = np.zeros((len(df) + 1, max(1, self.blocks)), np.float32)
        np.maximum.at(self.bound, (t, at // BLOCK), weight.astype(np.float32))
        # Impacts by word and, within, by entry; where each (word, block) begins.
        order = np.lexsort((at, t))
        self.at, self.weight = at[order], weight[order]
        cells = t[order] * self.blocks + self.at // BLOCK
        self.cell = np.searchsorted(cells, np.arange(len(df) * self.blocks + 1))
        least = np.full(max(1, self.blocks) * BLOCK, np.inf)
        least[: len(entries)] = self.need
        self.least = least.reshape(-1, BLOCK).min(1)

    def terms(self, words: list[bytes]) -> np.ndarray:
        unknown = len(self.term)
        return np.fromiter((self.term.get(w, unknown) for w in words), np.int64, len(words))

    def retrieve(self, terms: np.ndarray) -> dict[int, tuple[float, int]]:
        """item -> (best score as a share of the item's own, first word of the passage)."""
        found: dict[int, tuple[float, int]] = {}
        # Long texts in stretches, which share a step, so memory stays bounded.
        stretch = PASSAGE_STEP * STRETCH
        for start in range(0, max(1, len(terms) - PASSAGE_STEP), stretch):
            self._retrieve(terms[start : start + stretch + PASSAGE_STEP], start, found)
        return found

    def _retrieve(self, terms: np.ndarray, start: int, found: dict) -> None:
        unknown = len(self.term)
        if not self.blocks or not len(terms):
            return
        # The distinct words of each passage. It is two steps, so it holds any
        # segment whole.
        steps = -(-len(terms) // PASSAGE_STEP)
        passages = max(1, steps - 1)
        step = np.arange(len(terms)) // PASSAGE_STEP
        both = np.concatenate([step, step - 1]) * unknown + np.concatenate([terms, terms])
        ok = np.concatenate([(step < passages) & (terms < unknown), (step > 0) & (terms < unknown)])
        passage, term = np.divmod(np.unique(both[ok]), unknown)
        # Which blocks of entries each passage may reach.
        bounds = np.zeros((passages, self.blocks))
        filled, first = np.unique(passage, return_index=True)
        if len(filled):
            bounds[filled] = np.add.reduceat(self.bound[term].astype(np.float64), first, axis=0)
        open_ = bounds * 1.0001 >= self.least
        pair, block = np.nonzero(open_[passage] & (self.bound[term] > 0))
        begin = self.cell[term[pair] * self.blocks + block]
        count = self.cell[term[pair] * self.blocks + block + 1] - begin
        ends = np.cumsum(count)
        if not len(ends):
            return
        place = np.arange(ends[-1]) + np.repeat(begin - (ends - count), count)
        entries = len(self.need)
        target = np.repeat(passage[pair], count) * entries + self.at[place]
        score = np.bincount(target, self.weight[place], passages * entries).reshape(passages, entries)
        for p, e in zip(*np.nonzero(score * 1.0001 >= self.need), strict=True):
            item, share = int(self.owner[e]), float(SHARE * score[p, e] / self.need[e])
            if share > found.get(item, (0.0, 0))[0]:
                found[item] = (share, start + int(p) * PASSAGE_STEP)

    def verified(self, words: list[bytes], retrieved: dict) -> Iterator[tuple]:
        if not retrieved:
            return
        have = runs(words)
        short = set(words)
        for item, (share, start) in retrieved.items():
            name, question, answer = self.items[item]
            overlap = [self._share(part, have, short) for part in (question, answer)]
            if overlap[0] >= QUESTION and overlap[1] >= ANSWER:
                yield name, round(share, 6), start, *(round(o, 6) for o in overlap)

    @staticmethod
    def _share(part: frozenset, have: set, short: set) -> float:
        if not part:
            return 1.0
        return sum(r in have if len(r) == RUN else short.issuperset(r) for r in part) / len(part)


def _shards(benchmark: DataFrame) -> Iterator[list[tuple[int | None, bytes]]]:
    """The test items in shards of bounded size, one at a time on the driver."""
    held, size = [], 0
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_bytes().alias("text")).orderBy("item_id", "text")
    for item, text in items.toLocalIterator():
        if held and (len(held) >= SHARD_ITEMS or size + len(text) > SHARD_BYTES):
            yield held
            held, size = [], 0
        held.append((item, bytes(text)))
        size += len(text)
    if held:
        yield held


_built: dict[str, Index] = {}


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score_share (BM25 as a share of the item's own score),
    passage_start (in normal words), question_overlap, answer_overlap: a row for
    each document (row) and test item that is confirmed."""
    return _found(docs, benchmark).drop("text_key")


def _found(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    ddl = "doc_id long, text_key binary, item_id long, score_share double, passage_start long, question_overlap double, answer_overlap double"
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text_key", pa.binary()), ("item_id", pa.int64()), ("score_share", pa.float64()), ("passage_start", pa.int64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())]
    )
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), text_bytes().alias("text"))
    out = None
    for shard in _shards(benchmark):
        sent = spark.sparkContext.broadcast(shard)

        def search(batches: Iterable[pa.RecordBatch], sent=sent, key=uuid.uuid4().hex) -> Iterator[pa.RecordBatch]:
            working_for("contamination", _built.clear)
            if key not in _built:
                _built.clear()
                _built[key] = Index(sent.value)
            index = _built[key]

            def rows():
                for doc, own_key, text in rows_of(batches, "doc_id", "text_key", "text"):
                    words = normal(text.split())
                    for pair in index.verified(words, index.retrieve(index.terms(words))):
                        yield doc, own_key, *pair

            yield from batched(rows(), schema)

        part = own.mapInArrow(search, ddl)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], ddl)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no test item (those with a null doc_id are
    kept). Rows are told apart by doc_id and text: a clean text stays where its
    doc_id also stands on one that goes."""
    bad = _found(docs, benchmark).select(F.col("doc_id").alias("__bad_doc"), F.col("text_key").alias("__bad_text"))
    bad = settle(bad.distinct(), "contaminated")
    doc, key = F.col("doc_id").cast("long"), text_key()
    some, others = set_aside(docs, F.xxhash64(doc, key), bad.select(F.xxhash64("__bad_doc", "__bad_text")))
    return some.join(bad, (doc == F.col("__bad_doc")) & (key == F.col("__bad_text")), "left_anti").union(others)
