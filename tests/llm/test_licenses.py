from __future__ import annotations

import re

from orderflow.llm import licenses
from orderflow.llm.oracle import ORACLE_SQL
from orderflow.llm.queries import QUERIES
from tests.check_oracle import differences
from tests.llm.conftest import SF

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def brute_base(text):
    own, starts, labels = words(text), [], set()
    for label, phrase in licenses.PHRASES:
        phrase = phrase.split()
        for k in range(len(own) - len(phrase) + 1):
            if own[k : k + len(phrase)] == phrase:
                starts.append(k)
                labels.add(label)
    ends = (min(starts), max(starts)) if starts else (None, None)
    return len(own), len(starts), *ends, ",".join(sorted(labels))


def check(docs):
    key = lambda t: tuple((x is None, str(x)) for x in t)
    got = licenses.scan(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()
    expected = [(r.doc_id, *brute_base(r.text)) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)


def frame(spark, *texts):
    return spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")


def test_query_equals_sql(spark, small_duck):
    assert differences(spark, small_duck, QUERIES["op11_licenses"], ORACLE_SQL["op11_licenses"], SF) == []


def test_base_equals_brute_force(documents):
    check(documents)


def test_hard_rows_and_none(spark, hard, no_documents):
    check(hard)
    assert licenses.scan(no_documents).collect() == []


def test_places_overlaps_and_odd_letters(spark):
    check(
        frame(
            spark,
            "CC BY cc-by, Cc_By cc",
            "All rights reserved" * 3,
            "all rights  all rights reserved; GENERAL public license general public license",
            "ccby éall rights reservedé all\x00rights\x7freserved",
            "general publicK license All İ rights reserved",
            "all rights reserved " * 20_000,
        )
    )


def one(spark, text):
    return licenses.scan(frame(spark, text)).first()


NOTICE = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"


def test_notices_with_words_put_in_and_left_out(spark):
    assert one(spark, f"Some words. {NOTICE}. More.").score == 1.0
    changed = NOTICE.replace("source and binary", "source, object and binary").replace("that the following", "that following")
    got = one(spark, changed)
    assert got.labels == "bsd" and licenses.COVER <= got.score < 1
    shuffled = " ".join(sorted(NOTICE.split()))
    assert one(spark, shuffled).labels == ""
    assert one(spark, NOTICE[:40]).labels == ""


def test_labels_of_the_method_come_beside_the_base(spark):
    got = one(spark, "This work is licensed under the GNU General Public License, version 3.")
    assert (got.base_labels, got.labels, got.n_base) == ("gpl", "gpl,gpl-3.0", 1)


def test_a_kelvin_sign_is_no_k(spark):
    notices = (("x", "work walk talk"),)
    known = lambda t: licenses.scan(frame(spark, t), (), notices).first().labels
    assert known("Work WALK talk") == "x" and known("worK walk talk") == ""


def test_plan_is_native_and_shuffles_no_text(spark, documents):
    plan = licenses.scan(documents)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Arrow", "Pandas", "ExistingRDD", "CartesianProduct", "NestedLoop"):
        assert word not in plan
    below = plan[plan.index("Generate") :]
    assert "Exchange hashpartitioning" not in below
