from __future__ import annotations

import base64
import gzip
import hashlib
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from orderflow.llm import warc
from orderflow.session import shared_dir
from tests.llm.conftest import same_rows

ROWS = [
    (1, "http://a/é\r\nX: y", "<p>same</p>"),
    (2, None, "<p>same</p>"),
    (3, "http://c", None),
    (4, "http://d", ""),
    (5, "http://e", "WARC/1.1\r\n\r\n\x1f\x8b\x08 looks like a record"),
    (6, "http://f", "x" * 400_000),
    (6, "http://f", "x" * 400_000),
    (None, "http://g", "<p>same</p>"),
]


def _digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def _expected(rows):
    first = {}
    for p, _, h in rows:
        if p is not None:
            first[h or ""] = min(p, first.get(h or "", p))
    out = []
    for p, _, h in rows:
        size = len((h or "").encode())
        head = first.get(h or "")
        again = head is not None and head != p
        out.append((p, size, _digest(h), "revisit" if again else "response", head if again else None))
    return out


def _read(spark, path):
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()


def test_round_trip(spark):
    path = f"{shared_dir(spark)}/w"
    pages = spark.createDataFrame([(*r, 1, "x") for r in ROWS], "page_id long, url string, html string, head int, sha string")
    warc.write_archives(warc.with_records(pages), path)
    same_rows(_read(spark, path), _expected(ROWS))
    # What is written is plain gzip.
    files = spark.read.format("binaryFile").load(path).collect()
    text = b"".join(gzip.decompress(bytes(f.content)) for f in files if f.length)
    assert text.count(b"WARC/1.1\r\nWARC-Type") == len(ROWS)


def test_small_payloads_never_revisit(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    got = {r.page_id: r.refers_to for r in warc.with_records(pages, min_bytes=3).collect()}
    assert got == {1: None, 2: None, 3: None, 4: 3}


def test_ranges_cut_anywhere(spark, conf):
    """Small byte ranges: members that span many, false magic in stored data."""
    path = f"{shared_dir(spark)}/w"
    html = "".join(f"\x1f{k}" for k in range(3000))
    pages = spark.createDataFrame([(k, "u", html * (k % 3) + str(k)) for k in range(60)], "page_id long, url string, html string")
    warc.write_archives(warc.with_records(pages).coalesce(1), path)
    whole = _read(spark, path)
    conf(spark__sql__files__maxPartitionBytes="700", spark__sql__files__openCostInBytes="1")
    same_rows(_read(spark, path), whole)
    assert len(whole) == 60


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.binary(max_size=80)), min_size=1, max_size=8), st.data())
def test_pieces_of_any_cut(parts, data):
    """Stored (uncompressed) members full of magic, cut into ranges anywhere."""
    members = []
    for k, (magic, body) in enumerate(parts):
        payload = (warc.GZIP_MAGIC * 3 if magic else b"") + body
        head = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Length: %d\r\n\r\n" % (k, len(payload))
        packer = zlib.compressobj(0, zlib.DEFLATED, 31)
        members.append(packer.compress(head + payload + b"\r\n\r\n") + packer.flush())
    raw = b"".join(members)
    cuts = sorted(data.draw(st.sets(st.integers(1, len(raw) - 1), max_size=4)))
    at = [i for i in range(len(raw)) if raw.startswith(warc.GZIP_MAGIC, i)]
    rows = [("f", 0, b"")]
    for i, j in zip(at, [*at[1:], len(raw)], strict=True):
        start = max([0, *(c for c in cuts if c <= i)])
        rows.append(("f", start, raw[i + 3 : j]))
    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist([{"file": f, "start": s, "value": v} for f, s, v in rows], schema=pa.schema([("file", pa.string()), ("start", pa.int64()), ("value", pa.binary())]))
    pieces = list(warc._pieces([batch]))
    got = [p[3] for p in pieces if p[2] is None]
    open_ = b""
    stitched = []
    for p in sorted((p for p in pieces if p[2]), key=lambda p: (p[1], p[2] == "tail")):
        if p[2] == "tail" and open_:
            stitched.append(open_)
            open_ = b""
        open_ += p[3]
    stitched += [open_] if open_ else []
    assert sorted(got + stitched) == sorted(members)


def test_empty(spark):
    path = f"{shared_dir(spark)}/w"
    warc.write_archives(warc.with_records(spark.createDataFrame([], "page_id long, url string, html string")), path)
    assert _read(spark, path) == []
