"""Slices of a corpus, and questions that they ask each other by key.

Documents are dealt into slices of about equal size by a hash. In a slice the
keys of interest (hashes of words, of windows) become one sorted array; it is
cut into shards by the keys' high bits and sent as packed bytes, so a shuffled
record is a whole array and each key travels once per slice, however common it
is. A shard sees all slices' arrays for its range of keys and answers each.
Texts travel packed, too.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.shared import text_bytes

SLICE_BYTES = 24 << 20


def slice_count(docs: DataFrame, slice_bytes: int = SLICE_BYTES) -> int:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-size // slice_bytes))


def packed(docs: DataFrame, slices: int) -> DataFrame:
    """slice, docs: the rows (doc_id, text) of each slice, as packed Arrow data."""
    doc = F.col("doc_id").cast("long")
    own = docs.select(
        doc.alias("doc_id"),
        text_bytes().alias("text"),
        F.pmod(F.xxhash64(doc, F.xxhash64("text")), F.lit(slices)).cast("int").alias("slice"),
    )

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size > 64 << 20:
                yield from dealt(held)
                held, size = [], 0
        if held:
            yield from dealt(held)

    def dealt(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        number = table["slice"].to_numpy()
        order = np.argsort(number, kind="stable")
        ends = np.flatnonzero(np.diff(number[order], append=-1)) + 1
        start = 0
        for end in ends.tolist():
            rows = order[start:end]
            part = table.select(["doc_id", "text"]).take(pa.array(rows)).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema) as out:
                out.write_table(part)
            blob = zstandard.compress(sink.getvalue(), 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(number[rows[0]])], pa.int32()), pa.array([blob], pa.binary())], ["slice", "docs"]
            )
            start = end

    return own.mapInArrow(pack, "slice int, docs binary")


def documents(blobs: Iterable[bytes]) -> Iterator[tuple[int | None, bytes]]:
    """The rows of a slice."""
    for blob in blobs:
        table = pa.ipc.open_stream(zstandard.decompress(blob)).read_all()
        yield from zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True)


def cuts(keys: np.ndarray, shards: int) -> list[slice]:
    """Where sorted 64-bit keys fall into shards by their high bits."""
    at = np.searchsorted(keys, np.array([(k << 64) // shards for k in range(1, shards)], np.uint64))
    ends = [0, *at.tolist(), len(keys)]
    return [slice(a, b) for a, b in zip(ends[:-1], ends[1:], strict=True)]
