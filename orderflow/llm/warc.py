"""WARC archives: deduplicated records, one gzip member each, and a splittable reader.

An archive is a file of gzip members. The writer leaves the joining of members
to Spark's text sink, whose line separator is an empty gzip member, so a file
is written by a task on whatever storage Spark writes to, and is plain
multi-member gzip. (The file name does not end in .gz: Hadoop would unpack such
a file as one stream and so could not split it.)

The reader lets Spark's text source cut byte ranges at gzip magic. A task gets
the candidates that start inside its range, decodes their headers and keeps
those that open a member; a false candidate is a piece of compressed data and
is put back behind the member that it was cut from. Where that member started
in an earlier range, the pieces meet in a small join by file.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm.shared import batched, rows_of, settle

# Fixed by the formats.
GZIP_MAGIC = b"\x1f\x8b\x08"
EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff\x03\x00" + bytes(8)
VERSION = b"WARC/1.1"

RECORDS = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)
RECORD_DDL = (
    "page_id long, url string, record_type string, payload_digest string, "
    "payload_bytes long, refers_to long, payload binary"
)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Decide for each page whether it is a response or a revisit of an earlier one.

    Of pages with equal payloads of at least ``min_bytes`` bytes, the smallest
    page_id answers. Null html is an empty payload; repeated page_ids stay
    separate rows; a null page_id answers for none and revisits as others do.
    Columns other than page_id, url and html are left out."""
    cols = {c.lower() for c in pages.columns}
    url = F.col("url").cast("string") if "url" in cols else F.lit(None).cast("string")
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        url.alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("sha", F.unhex(F.sha1("payload")))
    # The heads are settled, so that the join has a plain exchange on both
    # sides and a payload of a third of all pages is split among tasks.
    heads = settle(
        own.where(F.length("payload") >= min_bytes)
        .groupBy("sha")
        .agg(F.min("page_id").alias("head"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n"),
        "heads",
    )
    joined = own.join(heads, "sha", "left")
    revisit = F.col("head").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("head"))
    return joined.withColumn("refers_to", F.when(revisit, F.col("head"))).drop("head", "sha")


def _record(page_id, url, payload: bytes, refers_to) -> bytes:
    head = [VERSION]
    put = lambda k, v: head.append(f"{k}: {v}".encode())
    put("WARC-Type", "response" if refers_to is None else "revisit")
    put("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>")
    if url is not None:
        put("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A"))
    put("WARC-Date", "1970-01-01T00:00:00Z")
    put("WARC-Payload-Digest", f"sha1:{digest(payload)}")
    put("X-Payload-Length", len(payload))
    if refers_to is not None:
        put("WARC-Refers-To", f"<urn:page:{refers_to}>")
        put("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        payload = b""
    put("Content-Type", "text/html")
    put("Content-Length", len(payload))
    return gzip.compress(b"\r\n".join([*head, b"", b""]) + payload + b"\r\n\r\n", 6, mtime=0)


def write_archives(records: DataFrame, path: str) -> None:
    """One archive file per task; ``records`` as ``with_records`` returns them."""

    def members(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = rows_of(batches, "page_id", "url", "payload", "refers_to")
        yield from batched(((_record(*r),) for r in rows), pa.schema([("value", pa.binary())]), 256)

    (
        records.select("page_id", "url", "payload", "refers_to")
        .mapInArrow(members, "value binary")
        .select(F.col("value").cast("string").alias("value"))
        .write.option("lineSep", EMPTY_MEMBER.decode("latin1"))
        .option("encoding", "ISO-8859-1")
        .text(path)
    )


def _opens(member: bytes) -> bool:
    """Whether the bytes start a member: its header is sound and its data begin
    as a WARC record or are none at all."""
    inflate = zlib.decompressobj(31)
    try:
        got = inflate.decompress(member, 64)
    except zlib.error:
        return False
    return got.startswith(b"WARC/") or (not got and inflate.eof)


def _whole(member: bytes) -> bytes | None:
    inflate = zlib.decompressobj(31)
    try:
        got = inflate.decompress(member)
    except zlib.error:
        return None
    return got if inflate.eof else None


def _parsed(data: bytes) -> tuple:
    head, _, body = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        fields[key.strip().lower()] = value.strip().decode("utf-8", "replace")
    page = lambda v: int(v[10:-1]) if v and v[10:-1].lstrip("-").isdigit() else None
    kind = fields.get(b"warc-type")
    payload = body[: int(fields.get(b"content-length", 0))]
    stated = fields.get(b"warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and stated and digest(payload) != stated:
        raise ValueError(f"payload of {fields.get(b'warc-record-id')} does not match its digest")
    return (
        page(fields.get(b"warc-record-id")),
        fields.get(b"warc-target-uri"),
        kind,
        stated or digest(payload),
        int(fields.get(b"x-payload-length", len(payload))),
        page(fields.get(b"warc-refers-to")),
        payload,
    )


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """(file, range start, 'head' | 'tail' | None, bytes) of the candidates in
    each range: whole members as None; what precedes the first member of a
    range as 'head'; a last member that the range does not end as 'tail'."""
    place, held, kind = None, b"", "head"

    def closed(last: bool) -> Iterator[tuple]:
        if held and kind == "head":
            yield (*place, "head", held)
        elif held:
            yield (*place, "tail" if last and _whole(held) is None else None, held)

    for file, start, value in rows_of(batches, "file", "start", "value"):
        if place != (file, start):
            if place:
                yield from closed(True)
            place, held, kind = (file, start), b"", "head"
            # The source takes the separator off; only a file's first row had none before it.
            if start == 0 and not value:
                continue
        piece = GZIP_MAGIC + value
        if _opens(piece) and (kind == "head" or _whole(held) is not None):
            yield from closed(False)
            held, kind = piece, "member"
        else:
            held += piece
    if place:
        yield from closed(True)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of all archives below ``path``, one row each: page_id, url,
    record_type, payload_digest, payload_bytes, refers_to, payload (empty for
    revisits). A damaged member ends the job with an error; empty members are
    skipped; an empty folder gives no rows."""
    candidates = (
        spark.read.option("lineSep", GZIP_MAGIC.decode("latin1"))
        .option("encoding", "ISO-8859-1")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.col("value").cast("binary").alias("value"),
        )
    )
    places = [("file", pa.string()), ("start", pa.int64()), ("cut", pa.string())]

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for file, start, cut, piece in _pieces(batches):
                if cut:
                    yield (file, start, cut, piece, *[None] * len(RECORDS))
                    continue
                data = _whole(piece)
                if data is None:
                    raise ValueError(f"damaged member in {file}, range from {start}")
                if data:
                    yield (file, start, None, None, *_parsed(data))

        yield from batched(rows(), pa.schema([*places, ("piece", pa.binary()), *RECORDS]), 256)

    scanned = settle(
        candidates.mapInArrow(scan, f"file string, start long, cut string, piece binary, {RECORD_DDL}"),
        "scanned",
    )
    whole = scanned.where("cut is null").select(*RECORDS.names)

    def stitch(key, frame):
        rows = sorted(frame.to_pylist(), key=lambda r: (r["start"], r["cut"] == "tail"))
        members: list[bytes] = []
        for r in rows:
            if r["cut"] == "tail" or not members:
                members.append(r["piece"])
            else:
                members[-1] += r["piece"]
        found = []
        for m in members:
            data = _whole(m)
            if data is None:
                raise ValueError(f"damaged member in {key[0].as_py()}")
            if data:
                found.append(_parsed(data))
        return pa.Table.from_pylist(
            [dict(zip(RECORDS.names, f, strict=True)) for f in found], schema=RECORDS
        )

    # At most two pieces per byte range, and only where a false magic lies
    # between a range's last member and its end.
    cut = scanned.where("cut is not null").select("file", "start", "cut", "piece")
    return whole.unionByName(cut.groupBy("file").applyInArrow(stitch, RECORD_DDL))
