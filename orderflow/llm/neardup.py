"""N-gram Jaccard join: MinHash banding, verified on full n-gram sets.

Texts are sets of five-word shingles. Texts with equal sets form a class, and
only the class's smallest doc_id goes on (its representative). Representatives
whose MinHash values agree in a whole band meet in a shuffle on the band's hash.
Who meets whom is kept as a forest (the bucket's smallest member with each
other), whose components hold all pairs that share a band. In a component the
sets are compared in tiles of bounded size: a component of many members is cut
into chunks, and each pair of chunks is a task's work. A tile checks its pairs
that share a band on their full sets and sends on only counts of links and a
forest of them, so no row per pair is ever made and no link is lost.

Rows and bands are chosen for the recall wanted at the threshold.

Nulls and the like: texts without words link to nothing and are classes of
their own (equal ones too); texts of fewer than five words have all their words
as their one shingle; rows that share a doc_id are compared row by row; rows
without a doc_id are left out, extra columns are ignored; empty tables give no
rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.shared import batched, gram_hashes, mix64, passing, rows_of, settle, text_bytes, text_key, word_hashes, working_for
from orderflow.llm.sieve import among, set_aside, sieve
from orderflow.session import Settle

SHINGLE, THRESHOLD, RECALL, ROWS = 5, 0.8, 0.9995, 6
CHUNK = 256  # representatives in a chunk of a tile


def band_count(threshold: float = THRESHOLD, rows: int = ROWS, recall: float = RECALL) -> int:
    """Bands of so many rows that find a pair just at the threshold with this chance."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


def shingles(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the text's distinct shingles."""
    words = word_hashes(text.split())
    if not len(words):
        return np.empty(0, np.uint64)
    return np.unique(gram_hashes(words, size) if len(words) >= size else gram_hashes(words, len(words)))


def _hashers(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(1729)
    return rng.integers(1, 2**32, n, np.uint64) | np.uint64(1), rng.integers(0, 2**32, n, np.uint64)


def band_hashes(sets: list[np.ndarray], bands: int, rows: int = ROWS) -> np.ndarray:
    """MinHash of each set, band by band: sets x bands. No set may be empty."""
    flat = np.concatenate(sets)
    low = (flat & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    high = (flat >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0] + [len(s) for s in sets])[:-1]
    out = np.empty((len(sets), bands), np.uint64)
    scale, shift = _hashers(bands * rows)
    with np.errstate(over="ignore"):
        for b in range(bands):
            key = np.full(len(sets), b, np.uint64)
            for k in range(b * rows, (b + 1) * rows):
                # Two independent halves: multiply one, mask with the other.
                h = low * np.uint32(scale[k]) + (high ^ np.uint32(shift[k])) * np.uint32(scale[-1 - k] >> np.uint64(1) | np.uint64(1))
                h ^= h >> np.uint32(15)
                key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(h, starts))
            out[:, b] = key
    return out


def signatures(docs: DataFrame, bands: int) -> DataFrame:
    """doc_id, text_key, set_key (hash of the whole set; null if empty), n (its size), bands."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text_key", pa.binary()), ("set_key", pa.binary()), ("n", pa.int64()), ("bands", pa.list_(pa.int64()))]
    )

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        working_for("neardup")

        def chunk(held):
            full = [row for row in held if len(row[-1])]
            signed = band_hashes([s for *_, s in full], bands).view(np.int64).tolist() if full else []
            for (d, t, s), b in zip(full, signed, strict=True):
                yield d, t, xxhash.xxh3_128_digest(s.tobytes()), len(s), b
            for d, t, s in held:
                if not len(s):
                    yield d, t, None, 0, None

        def rows():
            held, size = [], 0
            for doc, key, text in rows_of(batches, "doc_id", "text_key", "text"):
                held.append((doc, key, shingles(text)))
                size += len(held[-1][-1])
                if size > 100_000:
                    yield from chunk(held)
                    held, size = [], 0
            yield from chunk(held)

        yield from batched(rows(), schema, 1024)

    return docs.mapInArrow(sign, "doc_id long, text_key binary, set_key binary, n long, bands array<long>")


def components(edges: DataFrame, settle: Settle = settle) -> DataFrame:
    """a, b (edges, both ways not needed) -> id, component (its smallest id), for
    all ids of an edge. Rounds of hooking each id to the smallest it sees, then
    of shortcuts; the forest shrinks to stars. Every round is settled."""
    forest = settle(
        edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).where("lo < hi").distinct(), "forest"
    )
    while True:
        # Larger neighbours of each id go to its smallest neighbour ...
        both = forest.select(F.col("lo").alias("id"), F.col("hi").alias("near")).union(
            forest.select(F.col("hi").alias("id"), F.col("lo").alias("near"))
        )
        # The smallest is settled, so that the join back can split a hub.
        least = settle(both.groupBy("id").agg(F.min("near").alias("least")).withColumn("least", F.least("id", "least")), "least")
        large = (
            both.where("near > id").join(least, "id").select(F.col("least").alias("lo"), F.col("near").alias("hi")).where("lo < hi").distinct()
        )
        large = settle(large, "large")
        # ... then smaller neighbours of each id, and itself, to the smallest of them.
        low = settle(large.groupBy(F.col("hi").alias("id")).agg(F.min("lo").alias("least")), "low")
        small = (
            large.join(low, large["hi"] == low["id"])
            .select(F.col("least").alias("lo"), F.explode(F.array("lo", "hi")).alias("hi"))
            .where("lo < hi")
            .distinct()
        )
        small = settle(small, "small")
        changed = small.exceptAll(forest).limit(1).count() if small.count() == forest.count() else 1
        forest = small
        if not changed:
            break
    return settle(
        forest.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
        .union(forest.select(F.col("lo").alias("id"), F.col("lo").alias("component")))
        .distinct(),
        "components",
    )


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def compare(ids: list, part: np.ndarray | None, bands: np.ndarray, sets: list[np.ndarray], threshold: float):
    """Links in a tile: how many each member has there, and a forest of them.
    Pairs of different parts count, or all pairs where ``part`` is None."""
    m = len(ids)
    shared = np.zeros((m, m), bool)
    for b in range(bands.shape[1]):
        order = np.argsort(bands[:, b], kind="stable")
        cuts = np.flatnonzero(np.diff(bands[order, b])) + 1
        for group in np.split(order, cuts):
            if len(group) > 1:
                shared[np.ix_(group, group)] = True
    shared &= np.tri(m, m, -1, dtype=bool)
    if part is not None:
        shared &= part[:, None] != part[None, :]
    if not shared.any():
        return np.zeros(m, np.int64), []
    sizes = np.array([len(s) for s in sets])
    # Only shingles of two members at least can be in an intersection.
    flat, owner = np.concatenate(sets), np.repeat(np.arange(m), sizes)
    values, at, times = np.unique(flat, return_inverse=True, return_counts=True)
    column = np.cumsum(times > 1) - 1
    held = times[at] > 1
    owner, at = owner[held], column[at[held]]
    common = np.zeros((m, m), np.float32)
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    wide = 1 << 13
    for low in range(0, int(at[-1]) + 1 if len(at) else 0, wide):
        a, b = np.searchsorted(at, [low, low + wide])
        grid = np.zeros((m, wide), np.float32)
        grid[owner[a:b], at[a:b] - low] = 1
        common += grid @ grid.T
    union = sizes[:, None] + sizes[None, :] - common
    x, y = np.nonzero(shared & (common >= threshold * union - 1e-6))
    links = np.bincount(x, minlength=m) + np.bincount(y, minlength=m)
    trees = _Union(m)
    forest = [(ids[i], ids[j]) for i, j in zip(x.tolist(), y.tolist(), strict=True) if trees.join(i, j)]
    return links, forest


def join(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, copy_of (smallest doc_id with the same shingles), n_links (how many
    other sets its own is similar to) and class_id (smallest doc_id of all that
    are linked, through others too); a row for each row of ``docs``."""
    return classes_of(docs, threshold, recall).drop("text_key", "class_key")


def classes_of(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, settle: Settle = settle) -> DataFrame:
    """As ``join``, with text_key (of the row's text) and class_key (the class's
    own; null for texts without words)."""
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), text_bytes().alias("text")
    ).where("doc_id is not null")
    signed = settle(signatures(own, band_count(threshold, ROWS, recall)), "signed")
    heads = settle(
        signed.where("n > 0")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("copy_of"), F.min_by("bands", "doc_id").alias("bands"))
        # Settled with its number: what meets below are longs, so Spark sums them up by
        # hash and sorts no rows for it.
        .withColumn("id", F.monotonically_increasing_id()),
        "heads",
    )
    met = heads.select("id", F.posexplode("bands").alias("band", "hash"))
    buckets = settle(
        met.groupBy("band", "hash").agg(F.min("id").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n"),
        "buckets",
    )
    together = components(met.join(buckets, ["band", "hash"]).select("a", F.col("id").alias("b")), settle)
    checked = settle(_checked(_tiles(own.drop("text_key"), heads, together, settle), threshold), "checked")

    links = checked.where("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n_links"))
    linked = components(checked.where("b is not null").select("a", "b"), settle).join(links, "id")
    sets = settle(
        heads.select("set_key", "copy_of", "id")
        .join(linked, "id", "left")
        .withColumn("component", F.coalesce("component", "id"))
        .drop("id"),
        "sets_linked",
    )
    classes = settle(sets.groupBy("component").agg(F.min("copy_of").alias("class_id")), "classes")
    sets = settle(sets.join(classes, "component").withColumnRenamed("component", "class_key"), "sets_classed")
    alone = F.col("set_key").isNull()
    return signed.select("doc_id", "text_key", "set_key").join(sets, "set_key", "left").select(
        "doc_id",
        "text_key",
        "class_key",
        F.when(alone, F.col("doc_id")).otherwise(F.col("copy_of")).alias("copy_of"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
    )


def sift(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id may be among ``ids`` (doc_id), and few
    others, so that texts that nobody asks for are not shuffled."""
    sent = docs.sparkSession.sparkContext.broadcast(sieve(ids))

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(among(batch.column("doc_id").to_numpy(), sent.value)))

    return docs.mapInArrow(keep, docs.schema)


def _tiles(own: DataFrame, heads: DataFrame, together: DataFrame, settle: Settle) -> DataFrame:
    """component, i, j, chunk, id, bands, set: the sets of each tile. A component
    of m members has m / CHUNK chunks, by a hash, and a tile for each two."""
    sizes = settle(together.groupBy("component").agg(F.ceil(F.count("*") / CHUNK).alias("chunks")), "sizes")
    chunked = (
        together.join(sizes, "component")
        .withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        .select("id", "component", "chunk", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"))
    )
    asked = heads.join(together.select("id"), "id")
    asked = settle(asked, "asked")
    wanted = asked.select(F.col("copy_of").alias("doc_id")).distinct()
    texts = sift(own, wanted).join(wanted, "doc_id")
    schema = pa.schema([("set_key", pa.binary()), ("set", pa.binary())])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = (shingles(t).tobytes() for (t,) in rows_of(batches, "text"))
        yield from batched(((xxhash.xxh3_128_digest(s), s) for s in sets), schema, 256)

    sets = settle(texts.mapInArrow(cut, "set_key binary, set binary").join(asked.select("id", "set_key", "bands"), "set_key").drop("set_key"), "sets")
    return chunked.join(sets, "id")


def _checked(tiles: DataFrame, threshold: float) -> DataFrame:
    """a, b, n: a link of a tile's forest, or (b null) so many links of a."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def check(key, frame):
        # A repeated row of a document brings its set again.
        rows = {r["id"]: r for r in frame.select(["id", "chunk", "bands", "set"]).to_pylist()}
        rows = [rows[k] for k in sorted(rows)]
        ids = [r["id"] for r in rows]
        links, forest = compare(
            ids,
            None if key[1] == key[2] else np.array([r["chunk"] for r in rows]),
            np.array([r["bands"] for r in rows], np.int64),
            [np.frombuffer(r["set"], np.uint64) for r in rows],
            threshold,
        )
        out = [{"a": i, "n": n} for i, n in zip(ids, links.tolist(), strict=True) if n]
        return pa.Table.from_pylist(out + [{"a": a, "b": b} for a, b in forest], schema=schema)

    return tiles.groupBy("component", "i", "j").applyInArrow(check, "a long, b long, n long")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each class: of the rows with its smallest doc_id that with the
    least key of its text, once if it stands there repeatedly. Rows are told apart
    by doc_id and text, so a text of its own stays where its doc_id also stands on a
    copy. Texts without words and rows with a null doc_id stay."""
    with passing(docs.sparkSession) as step:
        classes = classes_of(docs, settle=step).where("class_key is not null")
        pairs = step(classes.groupBy("class_key", "doc_id", "text_key").agg(F.count("*").alias("n")), "pairs")
        first = step(pairs.groupBy("class_key").agg(F.min(F.struct("doc_id", "text_key")).alias("first")), "first")
        told = pairs.join(first, "class_key").withColumn("is_first", F.struct("doc_id", "text_key") == F.col("first"))
        # Settled, so that its size is known: of most texts nothing is told.
        told = told.where("not is_first or n > 1").select(
            "is_first", F.col("doc_id").alias("__near_doc"), F.col("text_key").alias("__near_text")
        )
        told = settle(told, "told")
    own = [F.col("doc_id").cast("long"), text_key()]
    some, others = set_aside(docs, F.xxhash64(*own), told.select(F.xxhash64("__near_doc", "__near_text")))
    same = (own[0] == F.col("__near_doc")) & (own[1] == F.col("__near_text"))
    left = some.join(told.where("not is_first"), same, "left_anti")
    again = told.where("is_first")
    # Which of the rows alike in doc_id and text stays is up to their other columns.
    columns = F.xxhash64(*[c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind])
    once = (
        left.join(again, same, "left_semi")
        .groupBy(F.col("doc_id").alias("__near_doc"), text_key().alias("__near_text"))
        .agg(F.min_by(F.struct(*docs.columns), columns).alias("__near_row"))
    )
    return left.join(again, same, "left_anti").unionByName(once.select("__near_row.*")).unionByName(others)
