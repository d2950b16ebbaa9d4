from __future__ import annotations

import corpus_pipeline
from orderflow.llm import mixing
from orderflow.llm.contamination import normal, question_answer, runs
from orderflow.llm.shared import settle
from tests.llm import brute
from tests.llm.conftest import SF, pairs


def test_each_stage_does_its_work_on_what_is_left(spark, documents):
    docs, seen = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, settle(stage(spark, docs, SF), name)
        seen[name] = (before, docs)
        if name != "token_files":
            assert docs.columns == documents.columns
    before, after = seen["quality_rules"]
    kept = dict(pairs(after))
    for d, t in pairs(before):
        n, _, _, _, repeated = brute.quality_counts(t)
        assert not (d in kept and (n < 20 or 100 * repeated > 30 * n))
    before, after = seen["near_duplicates"]
    first = {d for d, _, _, c in brute.near(pairs(before)) if d == c}
    assert {d for d, _ in pairs(after)} == first
    before, after = seen["benchmark_free"]
    items = [question_answer(r.text.encode()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = set()
    for d, t in pairs(before):
        have = runs(normal(t.encode().split()))
        if all(min(len(runs(p) & have) / len(runs(p)) for p in parts) < 0.6 for parts in items):
            clean.add(d)
    assert {d for d, _ in pairs(after)} == clean
    before, after = seen["mixed_sources"]
    assert {d for d, _ in pairs(after)} <= {d for d, _ in pairs(before)}
    size = lambda df: sum(len(brute.words(t)) for _, t in pairs(df))
    assert abs(size(after) - size(before)) <= 0.2 * size(before)
    assert seen["token_files"][1].count() == after.count()
    assert mixing.MAX_REPEATS == 3


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_a_worker_forgets_what_other_operators_remember():
    from orderflow.llm import shared, tokens

    tokens._encoders["x"] = object()
    shared.working_for("tokens", tokens.forget_encoders)
    assert "x" in tokens._encoders
    shared.working_for("quality")
    assert not tokens._encoders
