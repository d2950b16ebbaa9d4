"""Rows set aside by key without a shuffle of the others.

A Bloom filter of fixed size, built by the executors from the keys asked for,
tells which rows may be among them. Only those go on to a join; a text that
nobody asks for stays where it is.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.llm.shared import batched, mix64

BITS, PARTS = 1 << 25, 32  # 4 MB whatever the number of keys


def _places(keys: np.ndarray) -> list[np.ndarray]:
    h = mix64(keys.view(np.uint64))
    return [h % np.uint64(BITS), (h >> np.uint64(32)) % np.uint64(BITS)]


def sieve(keys: DataFrame) -> bytes:
    """Of one column of 64-bit keys; empty without any."""
    schema = pa.schema([("part", pa.int32()), ("bits", pa.binary())])

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(BITS, bool)
        for batch in batches:
            for places in _places(batch.column(0).to_numpy()):
                bits[places] = True
        if bits.any():
            parts = np.packbits(bits).reshape(PARTS, -1)
            yield from batched(((k, zstandard.compress(p.tobytes(), 1)) for k, p in enumerate(parts)), schema)

    def unite(key, frame):
        bits = np.bitwise_or.reduce([np.frombuffer(zstandard.decompress(b), np.uint8) for b in frame["bits"].to_pylist()])
        return pa.Table.from_pylist([{"part": key[0].as_py(), "bits": bits.tobytes()}], schema=schema)

    parts = keys.mapInArrow(build, "part int, bits binary").groupBy("part").applyInArrow(unite, "part int, bits binary").collect()
    return b"".join(r.bits for r in sorted(parts, key=lambda r: r.part))


def among(keys: np.ndarray, whole: bytes) -> np.ndarray:
    """Which keys may have been asked for."""
    bits = np.frombuffer(whole, np.uint8)
    hit = np.full(len(keys), len(bits) > 0)
    if len(bits):
        for places in _places(keys):
            hit &= (bits[places >> np.uint64(3)] >> (np.uint64(7) - (places & np.uint64(7))).astype(np.uint8)) & 1 == 1
    return hit


def set_aside(docs: DataFrame, key: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` whose ``key`` (64 bits) may be among ``keys``, and the
    others, of which none is."""
    sent = docs.sparkSession.sparkContext.broadcast(sieve(keys))

    @F.pandas_udf(T.BooleanType())
    def maybe(own: pd.Series) -> pd.Series:
        return pd.Series(among(own.to_numpy(), sent.value))

    return docs.where(maybe(key)), docs.where(~maybe(key))
