"""A training-text pipeline over `documents`.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the
columns of `documents`; the last returns token ids. `run` writes every stage to the shared folder
and reads it again, so a lost executor costs no more than the stage it worked on.

Null texts count as empty: the first stage rejects them, as they have no language.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import byte_bpe, decontaminate, language_id, near_copies, secret_scan
from starloom.llm.frames import free_name
from starloom.session import scratch_path


#: Pieces in a worker's cache of the last stage: less than alone, as executors still hold what the other stages touched.
PIECES = 100_000


def bounded_batches(spark: SparkSession) -> None:
    """Rows of an Arrow batch for the stages that follow: a worker holds as many whole texts at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without letters, or mostly of words unlike any labelled text, go."""
    bounded_batches(spark)
    return language_id.accepted(docs, language_id.learn(docs))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies (five-word shingles, 0.8 or more), the one of the smallest id.

    Candidates come from SimHash fingerprints through the binary trie self-join, and from MinHash bands.
    """
    bounded_batches(spark)
    return near_copies.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of `benchmark`."""
    bounded_batches(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind in brackets and n_chars counted anew."""
    spans = free_name(docs, "found")
    found = secret_scan.with_spans(docs, spans)
    text = F.when(F.size(spans) > 0, secret_scan.redacted(F.col("text"), F.col(spans))).otherwise(F.col("text"))
    changed = found.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        counted = F.when(F.size(spans) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        changed = changed.withColumn("n_chars", counted)
    return changed.select(docs.columns)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the decoded bytes, and the token ids."""
    bounded_batches(spark)
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN, keep=PIECES)


STAGES = [
    ("language_id", identified),
    ("simhash", deduplicated),
    ("decontaminate", decontaminated),
    ("secret_scan", redacted),
    ("byte_bpe", tokenized),
]

#: SQL has no MinHash bands, no banded alignment and no BPE; tests hold the stages against brute
#: force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
