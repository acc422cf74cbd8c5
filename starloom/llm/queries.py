"""The queries of this subpackage, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (
    byte_bpe, decontaminate, hard_negatives, language_id, license_scan, line_dedup, oracles, pii, quality_rules,
    repeated_bytes, secret_scan, simhash, spelling, stable_search,
)
from starloom.llm.frames import documents, span_columns
from starloom.llm.vector_rows import sound

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(documents(spark, sf_dir))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.passes(quality_rules.BASE)).alias("base_failed"),
        quality_rules.passes(quality_rules.STRICT).alias("kept"),
        "failed",
    )


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.with_spans(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", *span_columns("found", secret_scan.BASE_KINDS))


@query
def op3_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_bytes.without_repeats(documents(spark, sf_dir))
    sizes = F.transform("spans", lambda s: s["stop"] - s["start"])
    return found.select(
        "doc_id", "n_bytes", F.aggregate(sizes, F.lit(0).cast("long"), lambda a, b: a + b).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.without_repeated_passages(documents(spark, sf_dir))
    spans = F.transform("removed", lambda s: F.concat_ws(":", s["start"], s["stop"]))
    sizes = F.transform("removed", lambda s: (s["stop"] - s["start"]).cast("long"))
    n_units = F.aggregate("removed.units", F.lit(0).cast("long"), lambda a, b: a + b)
    return found.select(
        "doc_id", n_units.alias("n_removed"),
        F.aggregate(sizes, F.lit(0).cast("long"), lambda a, b: a + b).alias("n_removed_chars"),
        F.concat_ws(",", spans).alias("spans"), F.sha2("text", 256).alias("kept_sha256"),
    )


@query
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contaminated(documents(spark, sf_dir), items)


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.find_licenses(documents(spark, sf_dir))


@query
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(documents(spark, sf_dir))
    return found.select("doc_id", *span_columns("found", pii.BASE_KINDS))


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", shown.alias("fingerprint"), "component_id")


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language_id.learn(docs.filter(~language_id.held_out(F.col("doc_id"))))
    found = language_id.identify(docs, model)
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.encode(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN, with_ids=False)


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").filter(sound(F.col("embedding")))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = hard_negatives.whole_components(F.col("embedding"))
    return hard_negatives.mine(
        rows.select(F.col("vec_id").alias("id"), moved.alias("label"), whole.alias("vector")), F.col("id") % 50 == 0
    )


@query
def op13_stable_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return stable_search.nearest(rows, F.col("vec_id") % 20 == 0, "vec_id", "embedding")


SQL: dict[str, str] = oracles.SQL
