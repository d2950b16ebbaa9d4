"""Named queries of the training-data operators, thin digests of their results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import chat, contamination, licenses, lmscore, mixing, neardup, pii, quality, repair, repeats, tokens, variants, warc
from orderflow.llm.shared import table
from orderflow.session import shared_dir


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_lmscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.scores(table(spark, sf_dir, "documents"))


def op2_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return tokens.token_index(docs, f"{shared_dir(spark)}/tokens", tokenizer())


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    slim = mixing.sized(docs).select("doc_id", "source", mixing.SIZE)
    return mixing.digests(slim)


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    hard = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.explode(F.array(*[F.struct(F.lit(k).cast("long").alias("turn"), F.lit(r).alias("role")) for k, r in enumerate(("user", "assistant"))])).alias("t"),
    ).select("conv_id", "t.turn", "t.role", F.lit(said).alias("text"))
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(hard)
    messages = chat.fold(chat.events_of(conversations))
    return chat.digests(chat.read_back(chat.render(messages)))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.personal_data(table(spark, sf_dir, "documents")))


def op7_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.join(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "log2", "lower", "upper",
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/archives"
    warc.write_archives(warc.with_records(table(spark, sf_dir, "pages")), path)
    return warc.read_archives(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op10_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.grouped(variants.vocabulary(table(spark, sf_dir, "documents")))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.summaries(repair.damaged(table(spark, sf_dir, "conversations")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_lmscore,
        op2_tokens,
        op3_mix,
        op4_repeats,
        op5_chat,
        op6_pii,
        op7_near,
        op8_quality,
        op9_warc,
        op10_leaks,
        op11_licenses,
        op12_variants,
        op13_repair,
    )
}
