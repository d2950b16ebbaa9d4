"""Helpers of the training-data operators: settled steps, words, packed keys."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.session import Settle, settle_into, shared_dir
from orderflow.sources.paths import drop_directory

# ASCII white space, [\x20\x09-\x0D], is just what bytes.split() splits at.
SPACE = " \t\n\v\f\r"

# While a step is written: its shuffle files go when it has ended, not when the driver
# happens to collect its garbage, so those of several steps do not add up; and whole
# texts pass between Spark and Python some at a time.
STEP_CONF = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def _step_into(root: str) -> Settle:
    plain = settle_into(root)

    def settle(df: DataFrame, name: str) -> DataFrame:
        conf = df.sparkSession.conf
        was = {k: conf.get(k, None) for k in STEP_CONF}
        for k, v in STEP_CONF.items():
            conf.set(k, v)
        try:
            return plain(df, name)
        finally:
            for k, v in was.items():
                conf.unset(k) if v is None else conf.set(k, v)

    return settle


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a step below the shared checkpoint folder and go on from the
    written table: cuts the lineage, and a lost executor costs no recomputation."""
    return _step_into(shared_dir(df.sparkSession))(df, name)


@contextmanager
def passing(spark: SparkSession) -> Iterator[Settle]:
    """A settle whose tables are dropped at the end: of steps on the way to a
    result that is settled itself by then."""
    root = shared_dir(spark)
    try:
        yield lambda df, name: _step_into(f"{root}/{uuid.uuid4().hex}")(df, name)
    finally:
        drop_directory(spark, root)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: str = "text"):
    """UTF-8 bytes of a text column, null as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def text_key(column: str = "text"):
    """128 bits that tell texts apart, null as empty."""
    return F.unhex(F.md5(text_bytes(column)))


def rows_of(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The named columns of Arrow batches, row by row."""
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def sliced(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """A few rows at a time, so that few texts are Python objects at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def batched(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches, of bounded length."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def give_back() -> None:
    """Freed memory goes back to the system; else a worker holds on to the most
    that any task of its life has needed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
    if trim is not None:
        trim(0)


_owner = ""
_remembered: dict[str, Callable[[], None]] = {}


def working_for(owner: str, forget: Callable[[], None] | None = None) -> None:
    """To be called where a task starts. One worker process serves the tasks of
    many operators; what others remember there for speed is forgotten, so that it
    does not lie beside what this one needs. ``forget`` drops the owner's own."""
    for other in [name for name in _remembered if name != owner]:
        _remembered.pop(other)()
        gc.collect()
    global _owner
    if owner != _owner:
        _owner = owner
        _hashes.clear()
        give_back()
    if forget is not None:
        _remembered[owner] = forget


class WordHashes(dict):
    """64-bit hash of each word, remembered up to a bound (a speed matter only)."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads 64-bit keys over all their bits."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(33))
        x = x * np.uint64(0xFF51AFD7ED558CCD)
        x = x ^ (x >> np.uint64(33))
        x = x * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def gram_hashes(words: np.ndarray, n: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """64-bit hashes of all runs of ``n`` word hashes; empty if there are fewer."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        out = words[:count].copy()
        for k in range(1, n):
            out = out * np.uint64(base) + words[k : k + count]
    return mix64(out)


def pack_planes(values: np.ndarray) -> bytes:
    """Integers byte plane by byte plane, compressed; planes of zeros cost nothing."""
    own = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)
    out = zstandard.ZstdCompressor(1).compressobj(size=own.size)  # a plane at a time is copied
    return b"".join([*(out.compress(np.ascontiguousarray(own[:, k])) for k in range(8)), out.flush()])


def unpack_planes(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u8")


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys, as packed differences."""
    return pack_planes(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumsum(unpack_planes(blob), dtype=np.uint64)


def pack_table(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return zstandard.compress(sink.getvalue(), 1)


def unpack_table(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.decompress(blob)).read_all()
