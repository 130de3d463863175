"""Registered queries of the text operators: thin, over whole tables, with digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm import (
    decontaminate,
    filter_audit,
    langid,
    licenses,
    lines,
    neardup,
    negatives,
    paragraphs,
    pieces,
    quality,
    secrets,
    suffix_lm,
    url_filter,
)
from wardlake.llm.common import bounded_batches, held_out
from wardlake.session import scratch_path

PIECE_MODEL = "piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]

# Fixed rules of the URL query: host, path, verdict.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha256_of(parts: Column) -> Column:
    """Lower-case hex sha256 of the comma-joined strings."""
    return F.sha2(F.array_join(parts, ","), 256)


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    lists = {c: F.array_join(c, ",") for c in ("sentence_ids", "licenses", "unmatched")}
    return found.withColumns(lists)


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        sha256_of(F.col("items")).alias("items_sha256"),
        "contaminated",
    )


def piece_model(spark: SparkSession) -> bytes:
    """The public model file of the piece queries."""
    import public_tokenizers

    return pieces.model_bytes(spark, public_tokenizers.path(PIECE_MODEL))


def piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = piece_model(spark)
    encoded = table(spark, sf_dir, "documents").select("doc_id", pieces.encode(F.col("text"), model).alias("ids"))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        sha256_of(F.transform("ids", lambda i: i.cast("string"))).alias("ids_sha256"),
        F.sha2(pieces.decode(F.col("ids"), model), 256).alias("decoded_sha256"),
    )


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first scan: the ledger starts empty."""
    bounded_batches(spark)
    found = secrets.scan(table(spark, sf_dir, "documents"), scratch_path(spark, "ledger"))

    def kind_count(kind: str) -> Column:
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def span(f: Column) -> Column:
        return F.concat_ws(":", f["kind"], f["start"], f["stop"])

    base = F.filter("findings", lambda f: f["kind"].isin(*secrets.BASE_KINDS))
    return found.select(
        "doc_id",
        *[kind_count(kind) for kind in secrets.BASE_KINDS],
        sha256_of(F.transform(base, span)).alias("base_sha256"),
        F.array_join(F.transform("findings", span), ",").alias("spans"),
    )


def suffix_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_lm.score(table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 5, 1))


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = held_out(F.col("doc_id"), 4, 2)
    judged = langid.identify(docs, ~out, piece_model(spark))
    return judged.select("doc_id", out.alias("held_out"), "lang_pred", "score")


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=4).drop("print")


def passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated_paragraphs(table(spark, sf_dir, "documents")).drop("print")


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first insertion: the index starts empty."""
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents")
    index = lines.LineIndex(spark, scratch_path(spark, "lines"))
    index.insert(docs)
    kept = lines.drop_repeated(docs, index)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh label is moved on by one; every hundredth row is an anchor."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), "embedding")
    return negatives.mine(vectors, F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Query] = {
    "op1_license_scan": license_scan,
    "op2_decontamination": decontamination,
    "op3_piece_codec": piece_codec,
    "op4_suffix_lm": suffix_scores,
    "op5_url_rules": url_rules,
    "op6_secret_scan": secret_scan,
    "op7_quality_rules": quality_rules,
    "op8_language_id": languages,
    "op9_minhash_neardup": near_duplicates,
    "op10_passage_dedup": passage_dedup,
    "op11_line_dedup": line_dedup,
    "op12_filter_audit": filter_interactions,
    "op13_hard_negatives": hard_negatives,
}
