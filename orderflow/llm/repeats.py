"""Substring deduplication with repeated-phrase automata.

A passage of 13 words that also starts in a document with a smaller doc_id is
removed. First recurring passages are confirmed: slices of the corpus send the
hashes of their windows, each with the smallest document that has it, and shards
answer with those that recur and their first document overall. A slice then
deals its documents into groups of bounded size. Overlapping recurring windows of
a document are joined into maximal passages; those that a group holds are
compiled into an Aho-Corasick automaton, each as the fewest windows that cover
it, and all documents of the group are streamed through it to locate every
occurrence. Windows are judged on the input, not on what is left.

Nulls and the like: a null text has no words; rows that share a doc_id are cut
alike, as none is smaller; a row without a doc_id is left whole and makes no
other lose words; extra columns are ignored; texts of any length are streamed
whole; an empty table gives no rows.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.shared import gram_hashes, pack_planes, pack_sorted, settle, unpack_planes, unpack_sorted, word_hashes
from orderflow.llm.slices import cuts, documents, packed, slice_count

WINDOW = 13
GROUP_WORDS = 40_000  # of the documents that share an automaton
RADIX = 64


class Automaton:
    """Recurring passages and their first documents, compiled. A node of the trie
    looks its letters up one after the other, so the alphabet is kept small: a
    word is written with as many letters as it takes to tell all words apart."""

    def __init__(self, phrases: list[tuple[list[bytes], int]]):
        distinct = {w for words, _ in phrases for w in words}
        self.step = 1
        while RADIX**self.step < len(distinct):
            self.step += 1
        self.letters = {
            word: "".join([chr(1 + k // RADIX**i % RADIX) for i in range(self.step)]) for k, word in enumerate(distinct)
        }
        self.machine = ahocorasick.Automaton()
        for words, first in phrases:
            self.machine.add_word("".join([self.letters[w] for w in words]), first)
        self.machine.make_automaton()

    def covered(self, doc_id: int, words: list[bytes]) -> np.ndarray:
        """Whether each word is in a passage that an earlier document has."""
        cover = np.zeros(len(words) + 1, np.int64)
        get, other, step = self.letters.get, "\0" * self.step, self.step
        for end, first in self.machine.iter("".join([get(w, other) for w in words])):
            # A match between the words' borders is none.
            if first < doc_id and (end + 1) % step == 0:
                last = (end + 1) // step
                cover[last - WINDOW] += 1
                cover[last] -= 1
        return np.cumsum(cover[:-1]) > 0


def _windows(words: list[bytes]) -> np.ndarray:
    return gram_hashes(word_hashes(words), WINDOW)


def _asked(key, frame):
    """Of a slice: its windows, each with its first document and whether it has
    more, packed by shard."""
    shards = frame["shards"][0].as_py()
    hashes, owners = [], []
    for doc, text in documents(frame["docs"].to_pylist()):
        own = _windows(text.split()) if doc is not None else ()
        if len(own):
            hashes.append(own)
            owners.append(np.full(len(own), doc, np.int64))
    rows = []
    if hashes:
        h, d = np.concatenate(hashes), np.concatenate(owners)
        order = np.lexsort((d, h))
        h, d = h[order], d[order]
        new = np.append(True, h[1:] != h[:-1])
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(h)) - 1
        h, first, more = h[at], d[at], d[last] > d[at]
        for k, part in enumerate(cuts(h, shards)):
            if part.stop > part.start:
                rows.append(
                    {
                        "slice": key[0].as_py(),
                        "shard": k,
                        "hashes": pack_sorted(h[part]),
                        "first": pack_planes(first[part].view(np.uint64)),
                        "more": np.packbits(more[part]).tobytes(),
                    }
                )
    return pa.Table.from_pylist(rows, schema=_ASKED)


_ASKED = pa.schema(
    [("slice", pa.int32()), ("shard", pa.int32()), ("hashes", pa.binary()), ("first", pa.binary()), ("more", pa.binary())]
)
_ANSWER = pa.schema([("slice", pa.int32()), ("hashes", pa.binary()), ("first", pa.binary())])


def _answered(key, frame):
    """Of a shard: for each slice those of its windows that start in a document
    before one of its own, and the first document of all."""
    rows = frame.to_pylist()
    parts = []
    for r in rows:
        h = unpack_sorted(r["hashes"])
        parts.append((h, unpack_planes(r["first"]).view(np.int64), np.unpackbits(np.frombuffer(r["more"], np.uint8), count=len(h))))
    h, d = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    order = np.argsort(h, kind="stable")
    h, d = h[order], d[order]
    at = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    keys, first = h[at], np.minimum.reduceat(d, at)
    out = []
    for r, (own, mine, more) in zip(rows, parts, strict=True):
        least = first[np.searchsorted(keys, own)]
        hit = (least < mine) | (more == 1)
        if hit.any():
            out.append(
                {"slice": r["slice"], "hashes": pack_sorted(own[hit]), "first": pack_planes(least[hit].view(np.uint64))}
            )
    return pa.Table.from_pylist(out, schema=_ANSWER)


_KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())])


def _groups(docs):
    """Documents with their words, in groups of about so many words."""
    group, size = [], 0
    for doc, text in docs:
        group.append((doc, text.split()))
        size += len(group[-1][1])
        if size >= GROUP_WORDS:
            yield group
            group, size = [], 0
    if group:
        yield group


def _covering(starts: np.ndarray) -> np.ndarray:
    """Of the starts of recurring windows the fewest whose windows still cover the
    same words: of each run of neighbouring starts, every thirteenth and the last."""
    if not len(starts):
        return starts
    new = np.append(True, np.diff(starts) > 1)
    first = np.flatnonzero(new)
    place = np.arange(len(starts)) - np.repeat(first, np.diff(np.append(first, len(starts))))
    last = np.append(new[1:], True)
    return starts[(place % WINDOW == 0) | last]


def _cut(left, right):
    """Of a slice: per group of documents, compile the recurring passages that it
    holds and stream all its documents through them."""
    keys = [unpack_sorted(b) for b in right["hashes"].to_pylist()]
    firsts = [unpack_planes(b).view(np.int64) for b in right["first"].to_pylist()]
    keys = np.concatenate(keys) if keys else np.empty(0, np.uint64)
    firsts = np.concatenate(firsts) if firsts else np.empty(0, np.int64)
    order = np.argsort(keys)
    keys, firsts = keys[order], firsts[order]
    rows = []
    for group in _groups(documents(left["docs"].to_pylist())):
        phrases: dict[int, tuple[list[bytes], int]] = {}
        for doc, words in group:
            if doc is None or len(words) < WINDOW or not len(keys):
                continue
            own = _windows(words)
            at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            for start in _covering(np.flatnonzero((keys[at] == own) & (firsts[at] < doc))).tolist():
                k = int(at[start])
                if k not in phrases:
                    phrases[k] = (words[start : start + WINDOW], int(firsts[k]))
        automaton = Automaton(list(phrases.values())) if phrases else None
        for doc, words in group:
            removed, kept = 0, words
            if doc is not None and automaton:
                gone = automaton.covered(doc, words)
                removed = int(gone.sum())
                kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g] if removed else words
            rows.append((doc, len(words), removed, b" ".join(kept)))
    columns = zip(*rows, strict=True) if rows else [()] * 4
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _KEPT, strict=True)], schema=_KEPT)


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that are left, joined by one
    space): a row for each row of ``docs``."""
    slices = slice_count(docs)
    texts = packed(docs, slices)
    asked = texts.withColumn("shards", F.lit(2 * slices)).groupBy("slice").applyInArrow(
        _asked, "slice int, shard int, hashes binary, first binary, more binary"
    )
    answers = settle(asked.groupBy("shard").applyInArrow(_answered, "slice int, hashes binary, first binary"), "recurring")
    return (
        texts.groupBy("slice")
        .cogroup(answers.groupBy("slice"))
        .applyInArrow(_cut, "doc_id long, n_words long, n_removed long, kept binary")
        .withColumn("kept", F.col("kept").cast("string"))
    )
