"""From raw documents to token ids: a pipeline of five stages.

Every stage takes (spark, docs, sf_dir), works on all documents its predecessor kept and returns a
DataFrame, which is written as Parquet to the shared folder and read again for the next one. All
but the last return the columns of `documents`. The stages set the session's Arrow batches to a size that suits texts.

Defined cases: null and letterless texts are rejected by the first stage. A null id is an id of its
own; rows equal in id and text count as copies. An empty table passes through all stages. Columns
beyond those of `documents` are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm import decontaminate, langid, neardup, pieces, secrets
from wardlake.llm.common import bounded_batches, stored
from wardlake.llm.queries import piece_model
from wardlake.session import scratch_path, unused

LEAST_POSTERIOR = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; learns from the languages the documents name."""
    bounded_batches(spark)
    names = unused(docs, "lang_pred", "score")
    judged = langid.identify(docs, F.col("lang").isNotNull(), piece_model(spark), names=tuple(names))
    clear = (F.col(names[0]) != langid.UND) & (F.col(names[1]) >= LEAST_POSTERIOR)
    return judged.filter(clear).drop(*names)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    bounded_batches(spark)
    return neardup.drop_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    bounded_batches(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their texts replaced by a mark."""
    bounded_batches(spark)
    clean = secrets.redact(docs, scratch_path(spark, "ledger"))
    return clean.withColumn("n_chars", F.length("text").cast("bigint"))


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids, how many they are, and whether decoding gives the text back.

    The columns are `ids`, `n_tokens` and `round_trip`, with underscores in front where these names are taken.
    """
    bounded_batches(spark)
    model = piece_model(spark)
    ids, n_tokens, round_trip = unused(docs, "ids", "n_tokens", "round_trip")
    (coded,) = unused(docs, "coded")
    encoded = docs.withColumn(coded, pieces.encode_checked(F.col("text"), model))
    return encoded.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.col(coded)["ids"].alias(ids),
        F.size(F.col(coded)["ids"]).cast("bigint").alias(n_tokens),
        F.col(coded)["round_trip"].alias(round_trip),
    )


STAGES = [
    ("language_id", known_language),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("pieces", as_pieces),
]

# SQL cannot express the language model, so the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
