from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from orderflow.llm import repair
from orderflow.llm.queries import QUERIES
from tests.llm.conftest import SF, same_rows

SPACE = " \t\n\v\f\r"


def brute_damage(rows):
    """conv -> rows after damage, in order."""
    out = defaultdict(list)
    word = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{word(conv)}:{word(turn)}".encode()) % 20
        role, text = word(role), word(text)
        own = out[conv]
        if fault == 1:
            text = ""
        elif fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif fault == 4:
            role = "user"
        own += [(turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    for own in out.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return out


def brute_repair(rows):
    """The least (cost, letters) over all edits, by trying every one."""
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.strip(SPACE)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else None
        if fault is None and body[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        faults.append(fault)
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    other = {"": "u", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(k, state, inserted):
        ways = []
        if k == len(rows):
            if state in ("", "a"):
                ways.append((0, "", ()))
        else:
            _, role, text = rows[k]
            c, e, r = best(k + 1, state, 0)
            ways.append((c + 2, "D" + e, r))
            if faults[k] not in ("blank", "duplicate"):
                more = 5 if faults[k] == "truncated" else 0
                for new in "ua":
                    if (state, new) in step:
                        c, e, r = best(k + 1, new, 0)
                        ways.append((c + more + 1, "R" + e, ((new, text), *r)))
                if (state, role[:1]) in step:
                    c, e, r = best(k + 1, role[:1], 0)
                    ways.append((c + more, "K" + e, ((role, text), *r)))
        if inserted < 3:
            new = other[state]
            c, e, r = best(k, new, inserted + 1)
            ways.append((c + 5, "I" + e, ((new, ""), *r)))
        return min(ways, key=lambda w: w[:2], default=(10**9, "", ()))

    cost, audit, result = best(0, "", 0)
    full = {"u": "user", "a": "assistant"}
    said = "\n".join(f"{full.get(role, role)}:{text}" for role, text in result)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [role[:1] for _, role, _ in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        faults.count("blank"),
        faults.count("duplicate"),
        faults.count("truncated"),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
        cost,
        audit,
        hashlib.sha256(said.encode()).hexdigest(),
    )


def expected(rows):
    return [(conv, *brute_repair(own)) for conv, own in brute_damage(rows).items()]


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select(*repair.ROWS).collect()]
    got = QUERIES["op13_repair"](spark, SF)
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"] * 2
    same_rows(got.collect(), expected(rows))


def random_rows(seed):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "", " \t", "Why? ", "So on\n", "Well!", None, "a:b."]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "unknown"]
    out = []
    for conv in [*range(40), None]:
        weights = [8, 8, rng.choice([0, 2]), 1, 1, 1, 1, 1]
        turn = 0
        for _ in range(rng.randrange(0, 14)):
            turn += rng.choice([0, 1, 1, 1, 2])
            out.append((conv, rng.choice([turn, turn, turn, None]), rng.choices(roles, weights)[0], rng.choice(texts)))
    return out


DDL = "conv_id long, turn long, role string, text string, blank long, choice string, dropped boolean"


@pytest.mark.parametrize("seed", range(6))
def test_random_conversations(spark, seed):
    rows = random_rows(seed)
    frame = spark.createDataFrame([(*r, 1, "x", False) for r in rows], DDL).repartition(3)
    same_rows(repair.summaries(repair.damaged(frame)).collect(), expected(rows))


def test_batches_do_not_matter(spark, conf):
    conf(spark__sql__execution__arrow__maxRecordsPerBatch="3")
    rows = random_rows(77)
    frame = spark.createDataFrame([(*r, 1, "x", False) for r in rows], DDL)
    same_rows(repair.summaries(repair.damaged(frame)).collect(), expected(rows))


def test_giant_conversation_and_its_rows(spark):
    """One conversation of 30,000 rows; its edits, row by row, give its digest."""
    said = [(7, k, ("user", "assistant", "assistant")[k % 3], f"Part {k}{'.' if k % 11 else ''}") for k in range(30_000)]
    frame = spark.createDataFrame(said, "conv_id long, turn long, role string, text string")
    row = repair.summaries(frame).first()
    edits = sorted(repair.edited(frame).collect(), key=lambda r: r.place)
    assert "".join(r.edit for r in edits) == row.audit
    kept = [r for r in edits if r.edit != "D"]
    whole = "\n".join(f"{r.role}:{r.text}" for r in kept)
    assert hashlib.sha256(whole.encode()).hexdigest() == row.repaired_sha256
    assert [r.role for r in kept] == ["user", "assistant"] * (len(kept) // 2)
    assert row.truncated == len(range(0, 30_000, 11))


def test_no_rows(spark):
    assert repair.summaries(spark.createDataFrame([], DDL)).collect() == []


def test_all_rows_dropped(spark):
    frame = spark.createDataFrame([(1, 0, "user", "Hi.", 1, "x", True)], DDL)
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in repair.summaries(frame).collect()] == [(1, 0, 0, 0, 0, 0, 0, "", empty)]
