"""Corpus pipeline: quality, near duplicates, benchmark passages, PII, tokens.

Each stage reads what the one before it wrote. All return the columns of
``documents``; the last adds n_tokens, token_ids and decoded_sha256.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm import bpe, decontaminate, nbsvm, pii, simhash
from tramline.llm.common import carried, keep_columns, read_table, restored
from tramline.llm.queries import pseudonym_key
from tramline.session import scratch_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be good."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    scored = nbsvm.classify(carried(docs, "doc_id", "text"), labels)
    return restored(scored.filter(F.col("predicted") == 1), docs, "doc_id", "text")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document, by id, of each group of near duplicates."""
    return simhash.keep_first(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """No contaminated documents; shorter benchmark passages are cut from the others."""
    return _sized(decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark")))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers, dates and addresses replaced by pseudonyms."""
    return _sized(restored(pii.pseudonymise(carried(docs, "text"), pseudonym_key(spark)), docs, "text"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its token ids, for training, and the digest of the bytes that
    they decode to. Ids that don't decode to the text fail the stage.

    Columns of ``docs`` with the added names are replaced.
    """
    added = ["n_tokens", "token_ids", "decoded_sha256"]
    kept = keep_columns(docs, added)
    codec = bpe.make_codec()
    encoded = bpe.encode(carried(docs, "text"), codec).withColumn("__ids__", F.col("token_ids"))
    decoded = bpe.digests(encoded, codec, "__ids__")
    same = F.col("decoded_sha256") == F.sha2(F.coalesce("text", F.lit("")), 256)
    sure = F.when(same, F.col("decoded_sha256")).otherwise(F.raise_error(F.lit("token ids don't decode to their text")))
    return decoded.select(*[F.col(c) if c == "text" else F.col("__row__")[c].alias(c) for c in kept],
                          "n_tokens", "token_ids", sure.alias("decoded_sha256"))


def _sized(docs: DataFrame) -> DataFrame:
    """n_chars follows the text where the table has that column."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("PII", private),
    ("byte-level BPE", tokens),
]

# A classifier, fingerprints and a tokenizer are not SQL; tests/llm has a brute-force twin.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is stored and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_dir(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
