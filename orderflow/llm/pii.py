"""Personal data: base patterns, and bootstrapped contextual extraction.

The base patterns find seeds. Secrets have seeds, too: long mixed runs of letters
and digits. All identifier-like tokens (those with a digit or an @) become
instances, their neighbouring words lexical patterns. Spark then scores the graph
of patterns and instances in rounds: a pattern is as good for a kind as the share
of its instances that are known to be of the kind, an instance is of a kind if
its patterns say so together; sure ones are known in the next round. Instances
that no base pattern finds, but the graph does, add spans. A seed of a secret is
no proof (it may be a checksum): it adds a span only where a sure pattern of
secrets holds it.

Nulls and the like: a null text is empty, repeated rows and null doc_ids are kept
row by row, extra columns are ignored, and a text of any length is searched in
linear time; an empty table gives no rows. A very long token is told apart by a
digest. Spans are code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.shared import batched, rows_of, settle

KINDS = ("email", "ip", "card", "phone")
SECRET = "secret"
ALL_KINDS = (*KINDS, SECRET)
ROUNDS = 3
SUPPORT = 5  # known instances that a pattern must have
SURE = 0.9  # score of a pattern that counts, and of an instance that it finds
LONGEST = 80  # code points of a name; a longer one goes by its digest

# The fixed base patterns. A run of digits is only tried from its start: later
# starts in it end alike.
_domain = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_local = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_ip = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_card = re.compile(r"[0-9]([\x20-]?[0-9])+")
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_digit = re.compile(r"[0-9]")
_token = re.compile(r"[^\x20\x09-\x0D]+")
_secret = re.compile(r"(?=[^0-9]*[0-9])(?=[^A-Za-z]*[A-Za-z])[A-Za-z0-9_-]{32,}")
_marks = "\"'()[]{}<>,;:!?.=*#$%&|"


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As the pattern finds them, but from each @ outwards, in linear time."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _local:
            start -= 1
        domain = _domain.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), kinds by number, in order."""
    found = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    if _digit.search(text):
        for m in _ip.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-9:]) <= 255 for p in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _card.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _phone.finditer(text):
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def written(spans: Iterable[tuple[int, int, int]]) -> str:
    return ",".join(f"{ALL_KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _name(token: str) -> str:
    token = token.lower()
    return token if len(token) <= LONGEST else "#" + hashlib.sha256(token.encode("utf-8", "replace")).hexdigest()


def instances(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple]:
    """Identifier-like tokens: start, end, kind by base or seed (or None), the
    identifier in lower case, and its patterns. A base span is one instance."""
    if not spans and "@" not in text and not _digit.search(text):
        return
    known = iter([*spans, None])
    span, free, waiting, before = next(known), 0, [], ("", "")

    def patterns(left: tuple[str, str], right: str) -> list[str]:
        return [f"{left[0]} {left[1]} _", f"{left[1]} _ {right}", f"_ {right}"]

    def word(token: str) -> str:
        token = token.strip(_marks).lower()
        return _name(_digit.sub("0", token))

    for m in _token.finditer(text):
        if m.end() <= free:
            continue
        for item in waiting:
            yield (*item[:4], patterns(item[4], word(m[0])))
        waiting = []
        while span and span[0] < m.end():
            if span[2] > free:
                waiting.append((span[0], span[2], KINDS[span[1]], _name(text[span[0] : span[2]]), before))
            free = max(free, span[2])
            span = next(known)
        if free > m.start():
            before = (before[1], "_")
            continue
        own = m[0].strip(_marks)
        if len(own) >= 4 and ("@" in own or _digit.search(own)):
            start = m.start() + m[0].index(own)
            waiting.append((start, start + len(own), SECRET if _secret.fullmatch(own) else None, _name(own), before))
        before = (before[1], word(m[0]))
    for item in waiting:
        yield (*item[:4], patterns(item[4], ""))


def scan(docs: DataFrame) -> DataFrame:
    """Per row of the input: row, doc_id, base (spans) and found (instances)."""
    span = pa.struct([("start", pa.int64()), ("kind", pa.int64()), ("end", pa.int64())])
    found = pa.struct(
        [("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("name", pa.string()), ("patterns", pa.list_(pa.string()))]
    )
    schema = pa.schema([("doc_id", pa.int64()), ("base", pa.list_(span)), ("found", pa.list_(found))])

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for doc, text in rows_of(batches, "doc_id", "text"):
                spans = base_spans(text)
                own = [dict(zip(found_names, i, strict=True)) for i in instances(text, spans)]
                yield doc, [dict(zip(span_names, s, strict=True)) for s in spans], own

        yield from batched(rows(), schema, 1024)

    span_names = ("start", "kind", "end")
    found_names = ("start", "end", "kind", "name", "patterns")
    ddl = (
        "doc_id long, base array<struct<start:long,kind:long,end:long>>, "
        "found array<struct<start:long,end:long,kind:string,name:string,patterns:array<string>>>"
    )
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .mapInArrow(search, ddl)
        .withColumn("row", F.monotonically_increasing_id())
    )


def discovered(scanned: DataFrame) -> DataFrame:
    """name, kind: identifiers that the rounds are sure of and the base never finds,
    and the seeds of secrets that a sure pattern holds."""
    seen = scanned.select(F.explode("found").alias("i")).select("i.name", "i.kind", "i.patterns")
    edges = settle(
        seen.select("name", "kind", F.explode("patterns").alias("pattern"))
        .groupBy("pattern", "name")
        .agg(F.max("kind").alias("kind")),
        "edges",
    )
    # The same identifier may be known from one place and unknown in another.
    base = edges.where("kind is not null").groupBy("name").agg(F.max("kind").alias("kind"))
    known = settle(base.withColumn("by_base", F.lit(True)), "known0")
    for k in range(ROUNDS):
        labelled = edges.drop("kind").join(known, "name", "left")
        per_kind = labelled.groupBy("pattern", "kind").agg(F.count("*").alias("n"))
        patterns = (
            per_kind.groupBy("pattern")
            .agg(
                F.sum("n").alias("all"),
                F.max(F.when(F.col("kind").isNotNull(), F.struct("n", "kind"))).alias("best"),
            )
            .select("pattern", F.col("best.kind").alias("kind"), F.col("best.n").alias("n"), (F.col("best.n") / F.col("all")).alias("score"))
            .where((F.col("n") >= SUPPORT) & (F.col("score") >= SURE))
        )
        patterns = settle(patterns, f"patterns{k}")
        miss = F.exp(F.sum(F.log1p(-F.least("score", F.lit(0.999)))))
        new = (
            edges.drop("kind")
            .join(patterns, "pattern")
            .join(known.select("name"), "name", "left_anti")
            .groupBy("name", "kind")
            .agg((1 - miss).alias("score"))
            .where(F.col("score") >= SURE)
            .groupBy("name")
            .agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"))
            .withColumn("by_base", F.lit(False))
        )
        known = settle(known.unionByName(new), f"known{k + 1}")
    held = edges.where(F.col("kind") == SECRET).join(patterns, ["pattern", "kind"], "left_semi").select("name", "kind").distinct()
    return known.where("not by_base").select("name", "kind").unionByName(held)


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, base and spans (arrays of start, kind number, end, in order); a
    row for each row of the input."""
    scanned = settle(scan(docs), "scanned")
    new = settle(discovered(scanned), "new")
    number = F.element_at(F.create_map(*[F.lit(x) for k, n in enumerate(ALL_KINDS) for x in (n, k)]), F.col("kind")).cast("long")
    more = (
        scanned.select("row", F.explode(F.filter("found", lambda i: i["kind"].isNull() | (i["kind"] == SECRET))).alias("i"))
        .select("row", "i.start", "i.end", "i.name")
        .join(new, "name")
        .groupBy("row")
        .agg(F.collect_list(F.struct("start", number.alias("kind"), "end")).alias("more"))
    )
    return scanned.join(settle(more, "more"), "row", "left").select(
        "doc_id",
        "base",
        F.array_sort(F.concat("base", F.coalesce("more", F.expr("cast(array() as array<struct<start:long,kind:long,end:long>>)")))).alias("spans"),
    )


def digests(found: DataFrame) -> DataFrame:
    name = F.array(*map(F.lit, ALL_KINDS))
    joined = lambda c: F.array_join(
        F.transform(c, lambda s: F.concat_ws(":", F.get(name, s["kind"].cast("int")), s["start"], s["end"])), ","
    )
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return found.select(
        "doc_id", *map(count, range(len(KINDS))), F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
    )
