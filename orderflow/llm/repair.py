"""Repair of conversations whose rows were damaged.

A sound conversation has the role initials ``(s?(ua)+)?``: a system row at most
in front, then user and assistant in turn, or nothing. Edits make it so: keep a
row (K, free), give it the role that fits (R, 1), delete it (D, 2; blank rows
and duplicates must go), insert an empty row (I, 5); a truncated row that stays
costs 5 more. Among the cheapest edits those with the ASCII-least letters count.

Rows are shuffled once, by conversation, and then stream through three sorted
passes of the same partitions, each keeping a state of fixed size between Arrow
batches:

1. by content: a row equal to the one before it is a duplicate;
2. by turn, backwards: the cheapest cost from here to the end, for each of the
   four states a conversation can be in, leads to one byte per row: the edit to
   choose in each state. These backpointers travel on as a column, so Spark's
   sort spills them when a conversation is giant;
3. by turn, forwards: the bytes are followed from the start, edits and final
   rows come out.

A conversation is one stream in one task by this method; its memory does not
grow with it, but for the letters of the audit, which is one value by contract.

Nulls and the like: a null role or text is one space, hence blank or without a
role that can be kept; null turns come first and are no gaps; a null conv_id is
a conversation of its own; rows with equal turns come by role, then text, so
repeated rows stand together and all but the first are duplicates; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.shared import SPACE, batched, rows_of

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5  # costs
EDITS = "DIKR"  # in ASCII order, which decides ties
# States: nothing yet, after the system row, after a user, after an assistant.
KEEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
FOLLOWS = (2, 2, 3, 2)  # state after the role that fits, inserted or given
FITTING = {2: "user", 3: "assistant"}
AT_END = (0, 10, 5, 0)  # costs of the missing rows
ENDING = ((), (2, 3), (3,), ())
LEGAL = {"su", "ua", "au"}
ROWS = ("conv_id", "turn", "role", "text")
_NONE = object()  # no conversation yet; None is one


def rows_for_repair(conversations: DataFrame) -> DataFrame:
    """Rows with their faults; a ``dropped`` row only keeps its conversation."""
    dropped = F.col("dropped") if "dropped" in conversations.columns else F.lit(False)
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
        F.coalesce(dropped, F.lit(False)).alias("dropped"),
    )
    body = F.rtrim("text", F.lit(SPACE))
    return (
        rows.withColumn("initial", F.substring("role", 1, 1))
        .withColumn("blank", body == "")
        .withColumn("truncated", ~F.right(body, F.lit(1)).isin(".", "!", "?"))
        .withColumn("content", F.unhex(F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256)))
    )


def _duplicates(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by content: all but the first live row of equal content."""
    last = _NONE
    for batch in batches:
        marks = []
        for row in rows_of([batch], "conv_id", "content", "dropped"):
            marks.append(not row[2] and row == last)
            last = row
        yield _with(batch, "duplicate", pa.array(marks, pa.bool_()))


@lru_cache(maxsize=65536)
def decide(after: tuple[int, ...], initial: str, must_go: bool, truncated: bool) -> tuple[tuple[int, ...], int]:
    """Costs from a row on per state, less their least, from those behind the
    row; and the edits to choose, two bits per state."""
    own = []
    for state in range(4):
        costs = {"D": DELETE + after[state]}
        if not must_go:
            stays = TRUNCATED if truncated else 0
            costs["R"] = REROLE + stays + after[FOLLOWS[state]]
            kept = KEEPS.get((state, initial))
            if kept is not None:
                costs["K"] = stays + after[kept]
        own.append(costs)
    least = [min(c.values()) for c in own]
    # Rows inserted before this one: two in a row lead back to the same state.
    least[2], least[3] = min(least[2], INSERT + least[3]), min(least[3], INSERT + least[2])
    for state, costs in enumerate(own):
        costs["I"] = INSERT + least[FOLLOWS[state]]
        least[state] = min(least[state], costs["I"])
    choice = 0
    for state, costs in enumerate(own):
        edit = next(k for k, e in enumerate(EDITS) if costs.get(e) == least[state])
        choice |= edit << (2 * state)
    low = min(least)
    return tuple(x - low for x in least), choice


def _choices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by turn, backwards: a byte of backpointers for each."""
    conversation, after = _NONE, AT_END
    for batch in batches:
        choices = []
        for conv, initial, gone, blank, duplicate, truncated in rows_of(
            [batch], "conv_id", "initial", "dropped", "blank", "duplicate", "truncated"
        ):
            if conv != conversation or conversation is _NONE:
                conversation, after = conv, AT_END
            choice = 0
            if not gone:
                after, choice = decide(after, initial, blank or duplicate, truncated)
            choices.append(choice)
        yield _with(batch, "choice", pa.array(choices, pa.int16()))


def _with(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])


def _ddl(df: DataFrame, more: str) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema) + ", " + more


def with_choices(conversations: DataFrame) -> DataFrame:
    """The rows of each conversation together, by turn, with their backpointers."""
    rows = rows_for_repair(conversations).repartition("conv_id")
    rows = rows.sortWithinPartitions("conv_id", "dropped", "content", F.asc_nulls_first("turn"))
    rows = rows.mapInArrow(_duplicates, _ddl(rows, "duplicate boolean")).drop("content")
    back = [F.desc_nulls_last("turn"), F.desc("role"), F.desc("text"), F.desc("duplicate")]
    rows = rows.sortWithinPartitions(F.asc_nulls_first("conv_id"), *back)
    rows = rows.mapInArrow(_choices, _ddl(rows, "choice short"))
    forth = [F.asc_nulls_first("turn"), F.asc("role"), F.asc("text"), F.asc("duplicate")]
    return rows.sortWithinPartitions(F.asc_nulls_first("conv_id"), *forth)


class Walk:
    """The edits of one conversation, row after row, following the backpointers."""

    def __init__(self):
        self.state = 0

    def edits(self, choice: int) -> Iterator[tuple[str, int]]:
        """Edit and state of the rows inserted before this one, then of this one
        (state -1 where it does not decide: the row is deleted or kept)."""
        while True:
            edit = EDITS[choice >> (2 * self.state) & 3]
            if edit in "DK":
                yield edit, -1
                return
            self.state = FOLLOWS[self.state]
            yield edit, self.state
            if edit == "R":
                return

    def kept(self, initial: str) -> None:
        self.state = KEEPS[self.state, initial]

    def ending(self) -> Iterator[int]:
        yield from ENDING[self.state]


_READ = (*ROWS, "initial", "dropped", "blank", "duplicate", "truncated", "choice")


def _stories(batches: Iterable[pa.RecordBatch], story: Callable) -> Iterator[tuple]:
    """Feed a story per conversation with its rows and give on what it tells."""
    conversation, told = _NONE, None
    for conv, *row in rows_of(batches, *_READ):
        if conversation is _NONE or conv != conversation:
            if told is not None:
                yield from told.end()
            conversation, told = conv, story(conv)
        yield from told.row(*row)
    if told is not None:
        yield from told.end()


class _Edited:
    """Tells conv_id, place, edit, turn, role, text of each edit."""

    def __init__(self, conv):
        self.conv, self.place, self.walk = conv, 0, Walk()

    def _tell(self, edit, turn, role, text):
        self.place += 1
        return self.conv, self.place, edit, turn, role, text

    def row(self, turn, role, text, initial, dropped, blank, duplicate, truncated, choice):
        if dropped:
            return
        for edit, state in self.walk.edits(choice):
            if edit == "I":
                yield self._tell(edit, None, FITTING[state], "")
            else:
                if edit == "K":
                    self.walk.kept(initial)
                yield self._tell(edit, turn, FITTING.get(state, role), text)

    def end(self):
        for state in self.walk.ending():
            yield self._tell("I", None, FITTING[state], "")


class _Summary:
    """Tells one row: counts of faults, cost, audit and digest of the repaired."""

    def __init__(self, conv):
        self.conv, self.walk = conv, Walk()
        self.low = self.high = self.turn = self.before = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.audit, self.digest, self.rows = bytearray(), hashlib.sha256(), 0

    def _write(self, role, text):
        self.digest.update((("\n" if self.rows else "") + role + ":" + text).encode())
        self.rows += 1

    def _edit(self, edit, cost):
        self.audit += edit.encode()
        self.cost += cost

    def row(self, turn, role, text, initial, dropped, blank, duplicate, truncated, choice):
        if dropped:
            return ()
        if turn is not None:
            self.turns += self.turn is None or turn != self.turn
            self.low = turn if self.low is None else self.low
            self.high = self.turn = turn
        self.illegal += self.before is not None and self.before + initial not in LEGAL
        self.before = initial
        # The first fault counts.
        self.blank += blank
        self.duplicate += duplicate and not blank
        truncated = truncated and not (blank or duplicate)
        self.truncated += truncated
        for edit, state in self.walk.edits(choice):
            if edit == "I":
                self._edit(edit, INSERT)
                self._write(FITTING[state], "")
            elif edit == "D":
                self._edit(edit, DELETE)
            else:
                self._edit(edit, (REROLE if edit == "R" else 0) + (TRUNCATED if truncated else 0))
                if edit == "K":
                    self.walk.kept(initial)
                self._write(FITTING.get(state, role), text)
        return ()

    def end(self):
        for state in self.walk.ending():
            self._edit("I", INSERT)
            self._write(FITTING[state], "")
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        counts = (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost)
        yield self.conv, *map(int, counts), self.audit.decode(), self.digest.hexdigest()


def _told(rows: DataFrame, story: Callable, fields: dict[str, str]) -> DataFrame:
    arrow = {"long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(n, arrow[t]) for n, t in fields.items()])
    ddl = ", ".join(f"{n} {t}" for n, t in fields.items())

    def tell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(_stories(batches, story), schema)

    return rows.mapInArrow(tell, ddl)


def edited(conversations: DataFrame) -> DataFrame:
    """All rows of all conversations with what was done to each: conv_id, place
    (order of the edits), edit, turn (null if inserted), role and text after the
    edit. The repaired conversation is the rows whose edit is not D."""
    fields = {"conv_id": "long", "place": "long", "edit": "string", "turn": "long", "role": "string", "text": "string"}
    return _told(with_choices(conversations), _Edited, fields)


def summaries(conversations: DataFrame) -> DataFrame:
    """Per conversation: gaps in the turns, rows by their first fault, illegal
    neighbours, the cost and letters of the edits, the digest of the result."""
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    fields = {"conv_id": "long"} | dict.fromkeys(counts, "long") | {"audit": "string", "repaired_sha256": "string"}
    return _told(with_choices(conversations), _Summary, fields)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after damage by the checksum of conversation and turn: dropped (kept
    here with a mark), emptied, without ends of sentences, repeated, made user's."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate(word("text"), ".!?", ""))
    return (
        conversations.select(*ROWS)
        .withColumn("fault", fault)
        .select(
            "conv_id",
            "turn",
            F.when(F.col("fault") == 4, "user").otherwise(word("role")).alias("role"),
            text.otherwise(word("text")).alias("text"),
            (F.col("fault") == 0).alias("dropped"),
            F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
        )
        .drop("copy")
    )
