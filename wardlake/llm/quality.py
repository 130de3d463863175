"""Quality rules and a hashed n-gram likelihood ratio (DataFrame functions only).

Base rules count words, symbols, repeated lines and repeated word windows. The verdict beyond them
is the log-likelihood ratio of a document's hashed one- and two-word grams between two multinomials,
one of trusted target documents and one of the whole raw corpus, divided by the number of grams. A word,
in lower case, is hashed to a bucket, and a pair to a bucket by the buckets of its words. Every text is
cut into words once: its counts and the buckets of its words are written to the shared folder, and both
the models and the ratios are made from these.
Every document at or above the threshold is kept; nothing is sampled at random. Unless one is given, the
threshold is the exact quantile `QUANTILE` of the ratios of all target documents that pass the base
rules, less `MARGIN`. For this each half of them is judged by the model of the other half, as a document
that a model was fitted on scores higher than clean ones it has not seen.

The target model is fitted on every trusted document, the corpus counts cover every document. Counts
go to `buckets` hash buckets, so both models are bounded tables of that many rows.

Defined cases: null, empty and blank texts have no words, fail the base rules and score 0. Repeated
rows are judged alike and all returned. Without any target document the ratio is 0 everywhere.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.llm.common import broadcast_if_small, stored
from wardlake.operators.percentiles import with_exact_percentiles

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
BUCKETS = 1 << 14
QUANTILE = 0.01
MARGIN = 0.02
SMOOTHING = 1.0


def words_of(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def word_buckets(words: Column, buckets: int) -> Column:
    return F.transform(words, lambda w: F.pmod(F.xxhash64(F.lower(w)), F.lit(buckets)).cast("int"))


def pair_bucket(codes: Column, i: Column, buckets: int) -> Column:
    """Bucket of the pair that begins at word i."""
    return F.pmod(F.xxhash64(F.get(codes, i), F.get(codes, i + 1)), F.lit(buckets)).cast("int")


def gram_buckets(codes: Column, buckets: int) -> Column:
    """Buckets of all single words and neighbouring pairs, from the buckets of the words."""
    pairs = F.transform(F.sequence(F.lit(0), F.size(codes) - 2), lambda i: pair_bucket(codes, i, buckets))
    return F.concat(codes, F.when(F.size(codes) >= 2, pairs).otherwise(F.array().cast("array<int>")))


def mean_weight(codes: Column, weights: Column, buckets: int) -> Column:
    """Mean of the weights of all grams, without making the grams; 0 where there are none."""
    last = F.size(codes) - 1
    total = F.aggregate(
        F.sequence(F.lit(0), last - 1),
        F.get(weights, F.get(codes, last)),
        lambda acc, i: acc + F.get(weights, F.get(codes, i)) + F.get(weights, pair_bucket(codes, i, buckets)),
    )
    one = F.get(weights, F.get(codes, F.lit(0)))
    return F.when(last < 0, 0.0).when(last == 0, one).otherwise(total / (2 * last + 1))


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    return F.coalesce(F.size(lines) - F.size(F.array_distinct(lines)), F.lit(0))


def windows_of(hashes: Column) -> Column:
    """Hash of every run of three words, in order, from the hashes of the words."""
    runs = F.transform(
        F.sequence(F.lit(0), F.size(hashes) - 3),
        lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2)),
    )
    return F.when(F.size(hashes) >= 3, runs).otherwise(F.array().cast("array<bigint>"))


def repeated_words(ordered: Column) -> Column:
    """Words inside runs of three that occur twice or more; `ordered`: sorted (run, at) pairs."""
    again = F.filter(
        ordered,
        lambda x, i: (x["run"] == F.get(ordered, i - 1)["run"]) | (x["run"] == F.get(ordered, i + 1)["run"]),
    )
    places = F.array_sort(F.transform(again, lambda x: x["at"]))
    start = F.struct(F.lit(0).alias("covered"), F.lit(-3).alias("last"))
    return F.aggregate(
        places,
        start,
        lambda acc, at: F.struct(
            (acc["covered"] + F.least(F.lit(3), at - acc["last"])).alias("covered"), at.alias("last")
        ),
    )["covered"]


def base_counts(docs: DataFrame, doc_id: str, text: str, buckets: int) -> DataFrame:
    """The id, the counted columns and the buckets of the words (`codes`) of every document."""
    content = F.coalesce(F.col("text"), F.lit(""))
    words = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).withColumn("words", words_of(content))
    hashed = words.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    kept_symbols = F.length(F.regexp_replace(content, f"[^{SYMBOLS}]+", ""))
    counted = hashed.select(
        "id",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        kept_symbols.cast("bigint").alias("n_symbols"),
        n_dup_lines(content).cast("bigint").alias("n_dup_lines"),
        word_buckets(F.col("words"), buckets).alias("codes"),
        windows_of(F.col("hashes")).alias("runs"),
    )
    # sorting is only needed where some run occurs twice
    twice = F.size(F.array_distinct("runs")) < F.size("runs")
    pairs = F.transform("runs", lambda run, i: F.struct(run.alias("run"), i.alias("at")))
    ordered = counted.withColumn("ordered", F.when(twice, F.array_sort(pairs)))
    return ordered.withColumn(
        "n_repeat_words", F.coalesce(repeated_words(F.col("ordered")), F.lit(0)).cast("bigint")
    ).drop("runs", "ordered")


def target_ids(labels: DataFrame) -> DataFrame:
    """Ids and half of the trusted documents, which the target model is fitted on."""
    good = labels.filter("quality = 1 and doc_id is not null").select("doc_id").distinct()
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).cast("int").alias("half")
    return good.select("doc_id", half)


def quantile_of(rows: DataFrame, value: str, q: float) -> Column:
    """The exact quantile of all values, in even passes; null where there are none."""
    keyed = stored(rows.select(F.lit(0).alias("all"), value), "quality-unseen")
    report = keyed.groupBy("all").agg(F.count("*").alias("rows"))
    found = with_exact_percentiles(report, keyed, ["all"], value, {"quantile": q}, bounded=True)
    return found.agg(F.max("quantile")).scalar()


def ratio_table(coded: DataFrame, buckets: int) -> DataFrame:
    """One row with `weights`: per bucket, log of target over corpus probability; and `others`, the same
    for each half of the target documents from the other half alone. `coded` has half and codes."""
    grams = coded.select("half", F.explode(gram_buckets(F.col("codes"), buckets)).alias("bucket"))
    counts = grams.groupBy("bucket").agg(
        F.count("*").alias("raw"), F.count("half").alias("target"), F.coalesce(F.sum("half"), F.lit(0)).alias("second")
    )
    every = coded.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    filled = every.join(counts, "bucket", "left").fillna(0, ["raw", "target", "second"])
    table = filled.agg(
        F.array_sort(F.collect_list(F.struct("bucket", "raw", "target", "second"))).alias("t"),
        F.sum("raw").alias("raw_all"),
        F.sum("target").alias("target_all"),
        F.sum("second").alias("second_all"),
    )
    mass = buckets * SMOOTHING

    def ratios(count: Callable[[Column], Column], all_: Column) -> Column:
        weight = lambda x: F.log(
            ((count(x) + SMOOTHING) / (all_ + mass)) / ((x["raw"] + SMOOTHING) / (F.col("raw_all") + mass))
        )
        return F.when(all_ > 0, F.transform("t", weight)).otherwise(F.array_repeat(F.lit(0.0), buckets))

    first = ratios(lambda x: x["target"] - x["second"], F.col("target_all") - F.col("second_all"))
    second = ratios(lambda x: x["second"], F.col("second_all"))
    whole = ratios(lambda x: x["target"], F.col("target_all"))
    return table.select(F.struct(whole.alias("weights"), F.array(second, first).alias("others")).alias("model"))


def quality(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """One row per document: base counts, base_failed, the ratio per gram, and kept.

    `labels` has doc_id and quality (1: trusted).
    """
    ids = stored(target_ids(labels), "quality-targets")
    halves = broadcast_if_small(ids.select(F.col("doc_id").alias("id"), "half"))
    counted = stored(base_counts(docs, doc_id, text, buckets).join(halves, "id", "left"), "quality-words")
    model = stored(ratio_table(counted, buckets), "quality-model")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    weighed = counted.withColumn("weights", model.select("model.weights").scalar())
    scored = weighed.select(
        F.col("id").alias(doc_id),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        mean_weight(F.col("codes"), F.col("weights"), buckets).alias("ratio"),
    )
    # written, so that a filter on the result is not moved into the array functions above
    scored = stored(scored, "quality")
    if threshold is None:  # repeated documents count once
        own = counted.filter(F.col("half").isNotNull() & ~failed)
        own = own.withColumn("others", model.select("model.others").scalar())
        unseen = mean_weight(F.col("codes"), F.get("others", F.col("half")), buckets)
        own = own.groupBy("id").agg(F.min(unseen).alias("unseen"))
        limit = F.coalesce(quantile_of(own, "unseen", QUANTILE) - F.lit(MARGIN), F.lit(0.0))
    else:
        limit = F.lit(threshold)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= limit))
