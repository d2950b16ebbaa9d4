"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source's documents are permuted by a seeded hash and cut into blocks. How
many blocks of each source the mix takes (its quota: whole passes, then a part
of one that ends inside a block) follows from the weights. A binary tree splits
the quotas among the output shards: every node deals the blocks of its sources
to its two children as drawing without replacement would. A shard finds its own
path down the tree from seeds alone, so shards are planned in parallel and
reruns agree. It owns the next blocks of each source in a permuted order,
disjoint from all other shards', and shuffles their documents locally.

Nulls and the like: a null text has size 0, a null source is a source of its
own (the last one), rows are placed by a hash of all their columns, so many rows of
one doc_id (or of none) fall apart, and rows alike in everything are numbered and
placed by their number, too: each is a document of its own; texts without words are taken as often as their block is, and an
empty table gives an empty mix. Columns of the input may have any names; ours
start with ``__mix_``.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.llm.shared import batched, rows_of, settle, text_bytes

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
BLOCK_WORDS = 1 << 15
SHARD_WORDS = 1 << 22
SEED = 20

SOURCE, SIZE, HASH, BLOCK = "__mix_source", "__mix_size", "__mix_hash", "__mix_block"
ROW, SAME = "__mix_row", "__mix_same"


@F.pandas_udf(T.LongType())
def count_words(text: pd.Series) -> pd.Series:
    return text.map(lambda t: len(t.split())).astype("int64")


def sized(docs: DataFrame) -> DataFrame:
    """Adds the size: the words of the whole text."""
    return docs.withColumn(SIZE, count_words(text_bytes()))


def targets(
    sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """source, source_size -> source, source_size, target.

    Weights go to the sources by code point, null last, over and over. The
    targets share out all sizes by weight; none is above ``max_repeats`` times
    its source's size, and the excess goes to the others by weight. So each is
    min(cap, level * weight), and the level is found from the sources in order
    of cap / weight: those before the first that fits are at their caps. One row
    per source, so a small table."""
    nulls_last = F.col("source").isNull()
    nth = (F.row_number().over(Window.orderBy(nulls_last, "source")) - 1) % len(weights) + 1
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), nulls_last, "source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    left = lambda c: F.sum(c).over(everything) - F.coalesce(F.sum(c).over(before), F.lit(0.0))
    return (
        sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), nth.cast("int")))
        .withColumn("cap", (F.col("source_size") * max_repeats).cast("double"))
        .withColumn("place", F.row_number().over(by_ratio))
        .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn(
            "level", (F.sum("source_size").over(everything) - F.col("capped")) / left("weight")
        )
        .withColumn("first", F.min(F.when(fits, F.struct("place", "level"))).over(everything))
        .withColumn(
            "target",
            F.when(F.col("place") < F.col("first.place"), F.col("cap")).otherwise(
                F.col("first.level") * F.col("weight")
            ),
        )
        .select("source", "source_size", "target")
    )


def _block(hash_: Column, blocks: Column) -> Column:
    """Blocks follow the order of the hash: an even cut of its range."""
    return F.shiftright(F.shiftrightunsigned(hash_, 32) * blocks, 31)


def _hashable(kind: str) -> bool:
    return "map<" not in kind and "variant" not in kind


def in_order(docs: DataFrame) -> DataFrame:
    """Settles the rows with their place (63 bits) in the permuted order: a hash of
    their columns, and of a number among the rows that are alike in all of them.
    Which of these gets which number makes no difference, so reruns agree."""
    columns = [c for c, kind in docs.dtypes if _hashable(kind)]
    rows = settle(
        docs.withColumn(SOURCE, F.col("source").cast("string"))
        .withColumn(HASH, F.xxhash64(F.lit(SEED), *columns))
        .withColumn(ROW, F.monotonically_increasing_id()),
        "rows",
    )
    slim = rows.select(HASH, ROW, F.shiftright(ROW, 33).alias("part"))
    # A part is a task's rows; no window gathers more than one task's rows alike.
    parts = slim.groupBy(HASH, "part").agg(F.count("*").alias("n"))
    alike = settle(parts.groupBy(HASH).agg(F.sum("n").alias("n")).where("n > 1").select(HASH), "alike")
    ahead = Window.partitionBy(HASH).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = settle(
        parts.join(alike, HASH).select(HASH, "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base")), "base"
    )
    inside = F.row_number().over(Window.partitionBy(HASH, "part").orderBy(ROW)) - 1
    numbers = (
        slim.join(alike, HASH)
        .withColumn("k", inside)
        .join(base, [HASH, "part"])
        .select(ROW, (F.col("base") + F.col("k")).alias(SAME))
        .where(F.col(SAME) > 0)
    )
    return (
        rows.join(settle(numbers, "numbers"), ROW, "left")
        .withColumn(SAME, F.coalesce(SAME, F.lit(0)))
        .withColumn(HASH, F.shiftrightunsigned(F.xxhash64(HASH, SAME), 1))
    )


def _key() -> Column:
    return F.struct(F.col(HASH).alias("h"), F.col(SAME).alias("k"), F.col(SIZE).alias("s"))


def source_specs(docs: DataFrame, weights=WEIGHTS, max_repeats=MAX_REPEATS) -> DataFrame:
    """What the mix takes of each source, of rows ``in_order``: whole passes, then the documents up to
    a cut in hash order. The cut is found by running sums over groups of
    blocks, then the blocks of one group, then the documents of one block, so
    no task sees a whole source."""
    # Sizes are counted once here, from the texts.
    slim = settle(docs.select(SOURCE, SIZE, HASH, SAME), "slim")
    totals = slim.groupBy(F.col(SOURCE).alias("source")).agg(F.sum(SIZE).alias("source_size"))
    spec = (
        targets(totals, weights, max_repeats)
        .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / BLOCK_WORDS)))
        .withColumn(
            "passes",
            F.when(F.col("source_size") == 0, F.lit(1)).otherwise(
                F.floor(F.col("target") / F.col("source_size") + 1e-12)
            ),
        )
        .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    )
    spec = settle(spec, "targets")
    same = lambda other: F.col("source").eqNullSafe(F.col(other))
    blocks = settle(
        slim.join(spec, same(SOURCE))
        .withColumn(BLOCK, _block(F.col(HASH), F.col("blocks")))
        .groupBy(SOURCE, BLOCK)
        .agg(F.sum(SIZE).alias("words"), F.first("rest").alias("rest")),
        "blocks",
    )
    group = F.shiftright(F.col(BLOCK), 12)

    def cut(parts: DataFrame, order: list, size: str) -> DataFrame:
        """Per source the part in which ``rest`` runs out, and what is left for it."""
        run = Window.partitionBy(SOURCE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        ahead = F.coalesce(F.sum(size).over(run), F.lit(0))
        return (
            parts.withColumn("ahead", ahead)
            .where(F.col("ahead") <= F.col("rest"))
            .groupBy(SOURCE)
            .agg(F.max_by(F.struct(*order), F.struct(*order)).alias("at"), F.max_by(F.col("rest") - F.col("ahead"), F.struct(*order)).alias("rest"))
        )

    groups = cut(
        blocks.groupBy(SOURCE, group.alias("group")).agg(F.sum("words").alias("words"), F.first("rest").alias("rest")),
        ["group"],
        "words",
    ).select(SOURCE, F.col("at.group").alias("group"), "rest")
    inside = blocks.drop("rest").withColumn("group", group).alias("b").join(
        groups.alias("g"),
        F.col(f"b.{SOURCE}").eqNullSafe(F.col(f"g.{SOURCE}")) & (F.col("b.group") == F.col("g.group")),
    )
    edge = settle(
        cut(inside.select(f"b.{SOURCE}", BLOCK, "words", "rest"), [BLOCK], "words").select(
            F.col(SOURCE).alias("source"), F.col(f"at.{BLOCK}").alias("edge"), F.col("rest").alias("left")
        ),
        "edges",
    )
    spec = spec.alias("x").join(edge.alias("e"), F.col("x.source").eqNullSafe(F.col("e.source")), "left")
    spec = settle(spec.select("x.*", "edge", "left"), "specs")
    last = (
        slim.join(spec, same(SOURCE))
        .where(_block(F.col(HASH), F.col("blocks")) == F.col("edge"))
        .select(SOURCE, _key().alias("key"), SIZE, "left")
    )
    run = Window.partitionBy(SOURCE).orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    # A document is in if at least half of it is before the cut.
    cuts = (
        last.withColumn("mid", F.coalesce(F.sum(SIZE).over(run), F.lit(0)) + F.col(SIZE) / 2)
        .where(F.col("mid") <= F.col("left"))
        .groupBy(F.col(SOURCE).alias("source"))
        .agg(F.max("key").alias("cut"))
    )
    return settle(
        spec.alias("x")
        .join(cuts.alias("c"), F.col("x.source").eqNullSafe(F.col("c.source")), "left")
        .select("x.*", "c.cut")
        .withColumn("part", F.coalesce(F.when(F.col("cut").isNotNull(), F.col("edge") + 1), F.col("edge"), F.lit(0)))
        .withColumn("quota", (F.col("passes") * F.col("blocks") + F.col("part")).cast("long")),
        "cuts",
    )


def _walk(n: int, seed: int) -> tuple[int, int]:
    """A seeded step and start, so that k -> (step * k + start) % n permutes."""
    rng = np.random.default_rng([SEED, seed, n])
    step = int(rng.integers(1, max(2, n)))
    while math.gcd(step, n) != 1:
        step += 1
    return step, int(rng.integers(0, max(1, n)))


def shard_blocks(specs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """shard, source, pass, block: which blocks go to which shard.

    The driver holds a quota per source (sources are named by whoever sets the
    weights, so they are few), never blocks or documents."""
    spark = specs.sparkSession
    rows = sorted(
        specs.select("source", "quota", "blocks", "target").collect(),
        key=lambda r: (r.source is None, r.source),
    )
    rows = [r for r in rows if r.quota]
    words = sum(r.target for r in rows)
    depth = max(0, math.ceil(math.log2(max(1.0, words / shard_words))))
    quotas = np.array([r.quota for r in rows], np.int64)
    walks = [_walk(r.quota, k) for k, r in enumerate(rows)]

    def path(shard: int) -> tuple[np.ndarray, np.ndarray]:
        """Quotas of one shard, and how many blocks lie before its own."""
        own, first = quotas, np.zeros_like(quotas)
        for level in range(depth):
            node, right = shard >> (depth - level), (shard >> (depth - level - 1)) & 1
            rng = np.random.default_rng([SEED, level, node])
            drawn = rng.multivariate_hypergeometric(own, int(own.sum()) // 2, method="marginals")
            own, first = (own - drawn, first + drawn) if right else (drawn, first)
        return own, first

    schema = pa.schema([("shard", pa.int64()), ("source", pa.string()), ("pass", pa.int64()), ("block", pa.int64())])

    def plan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks():
            for (shard,) in rows_of(batches, "id"):
                own, first = path(shard)
                for row, (step, start), n, f in zip(rows, walks, own.tolist(), first.tolist(), strict=True):
                    for k in range(f, f + n):
                        at = (step * k + start) % row.quota
                        yield shard, row.source, at // row.blocks, at % row.blocks

        yield from batched(blocks(), schema)

    shards = spark.range(0, 1 << depth if rows else 0)
    return shards.mapInArrow(plan, "shard long, source string, pass long, block long")


def mix(sized_docs: DataFrame, weights=WEIGHTS, max_repeats=MAX_REPEATS, shard_words=SHARD_WORDS) -> DataFrame:
    """The mix: a row for each copy of a document that it takes, with the input's
    columns and ``__mix_source_size``, ``__mix_target``, ``__mix_shard`` and
    ``__mix_position`` (its place in the shard, in shuffled order)."""
    return _mixed(in_order(sized_docs), weights, max_repeats, shard_words).drop(ROW)


def _mixed(ordered: DataFrame, weights=WEIGHTS, max_repeats=MAX_REPEATS, shard_words=SHARD_WORDS) -> DataFrame:
    specs = source_specs(ordered, weights, max_repeats)
    plan = shard_blocks(specs, shard_words)
    keyed = (
        ordered.join(
            specs.select(
                F.col("source").alias("__mix_s"),
                F.struct("source_size", "target", "blocks", "passes", "edge", "cut").alias("__mix_spec"),
            ),
            F.col(SOURCE).eqNullSafe(F.col("__mix_s")),
        )
        .withColumn(BLOCK, _block(F.col(HASH), F.col("__mix_spec.blocks")))
    )
    taken = keyed.join(
        plan.select(
            F.col("shard").alias("__mix_shard"),
            F.col("source").alias("__mix_p"),
            F.col("pass").alias("__mix_pass"),
            F.col("block").alias("__mix_b"),
        ),
        F.col(SOURCE).eqNullSafe(F.col("__mix_p")) & (F.col(BLOCK) == F.col("__mix_b")),
    ).where(
        (F.col("__mix_pass") < F.col("__mix_spec.passes"))
        | (F.col(BLOCK) < F.col("__mix_spec.edge"))
        | (_key() <= F.col("__mix_spec.cut"))
    )
    shuffled = Window.partitionBy("__mix_shard").orderBy(
        F.xxhash64(F.lit(SEED + 1), "__mix_shard", "__mix_pass", HASH), _key()
    )
    return (
        taken.withColumn("__mix_position", F.row_number().over(shuffled))
        .withColumn("__mix_source_size", F.col("__mix_spec.source_size"))
        .withColumn("__mix_target", F.col("__mix_spec.target"))
        .drop("__mix_spec", "__mix_s", "__mix_p", "__mix_b", SOURCE, HASH, SAME, BLOCK)
    )


def digests(sized_docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken: what the mix takes of each row."""
    slim = in_order(settle(sized_docs.select("doc_id", F.col("source").cast("string").alias("source"), SIZE), "slim"))
    slim = settle(slim, "ordered")
    taken = _mixed(slim).groupBy(ROW).agg(F.sum(SIZE).alias("taken"))
    specs = targets(slim.groupBy("source").agg(F.sum(SIZE).alias("source_size")))
    return (
        slim.alias("d")
        .join(taken, ROW, "left")
        .join(settle(specs, "specs").alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
        .select(
            "doc_id",
            F.col(SIZE).alias("size"),
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        )
    )
