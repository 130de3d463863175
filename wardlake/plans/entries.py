"""Every registered query: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlake.functions.cleaning import to_double
from wardlake.functions.reporting import iso_text, stamp_text
from wardlake.models.features import feature_pipeline, prepare
from wardlake.models.registry import list_models, load_models, registry
from wardlake.models.scoring import rmse_by_model, score_isolated, score_smart
from wardlake.models.training import ALGORITHMS, leaderboard, numeric_target
from wardlake.operators import numbering, percentiles, profile, query, requests, rows
from wardlake.plans import catalogue, inputs, templates
from wardlake.plans.discharges import raw_discharges, table, to_processed
from wardlake.schema import NUMERIC_FEATURES, RAW_SCHEMA, TARGETS
from wardlake.session import scratch_path
from wardlake.sources import file_index, lake, messages, zones
from wardlake.streaming import ingest, progress, reports, timeline

Query = Callable[[SparkSession, str], DataFrame]
SINCE = dt.date(1998, 1, 1)
# So few rows that the passes of radix selection are needed on small tables, too.
CROWDED = 1 << 10


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Engines add up floating numbers in different orders; four decimals hide that."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({name: F.round(name, digits) for name in doubles})


def over_processed(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: rounded(plan(inputs.processed_zone(spark, sf_dir)))


def over_raw(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: rounded(plan(raw_discharges(spark, sf_dir)))


def over_events(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: rounded(plan(table(spark, sf_dir, "events")))


def over_requests(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(
        requests.decode_requests(inputs.request_bodies(spark, sf_dir))
    )


def file_facts(raw: DataFrame) -> DataFrame:
    """What a whole scan of a raw file must agree on."""
    cleaned = to_processed(raw)
    return cleaned.groupBy("hospital_county").agg(
        F.count("*").alias("records"),
        F.count("race").alias("races"),
        F.sum("record_id").alias("id_sum"),
        F.sum(F.col("total_charges").cast("decimal(20,2)")).cast("double").alias("charges"),
    )


def over_lake(fmt: str, declared: str | None = None) -> Query:
    """Scan of the whole lake file in a format, with the declared schema."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = inputs.LAKE_FILES[fmt](spark, sf_dir)
        schema = None if fmt == "parquet" else RAW_SCHEMA
        return file_facts(lake.read_lake(spark, path, declared or fmt, schema))

    return run


def inferred_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return file_facts(lake.read_lake(spark, inputs.LAKE_FILES["csv"](spark, sf_dir)))


def lake_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return file_facts(lake.load_raw(spark, inputs.lake_files(spark, sf_dir)["base"]))


def lake_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = [lake.read_lake(spark, inputs.LAKE_FILES[f](spark, sf_dir), f, RAW_SCHEMA) for f in ("csv", "json")]
    return file_facts(lake.union_files(frames))


def main_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of the largest CSV dataset of the lake."""
    path = lake.pick_main_file(spark, inputs.lake_files(spark, sf_dir)["base"]).first()["path"]
    return file_facts(lake.read_lake(spark, path, "csv", RAW_SCHEMA))


def inventory_facts(spark: SparkSession, base: str) -> DataFrame:
    """Zones and formats of an inventory, held against the contents and a listing of the same files.

    How many files a zone has is up to the writer. Bytes of plain CSV and JSON files are those of their lines
    and line ends; of other and of compressed files they are the listed ones.
    """
    found = lake.lake_inventory(spark, base)
    lines = spark.read.option("recursiveFileLookup", True).text(base, pathGlobFilter="*.{csv,json}")
    path = F.col("_metadata.file_path")
    texts = lines.select(path.alias("path"), (F.octet_length("value") + 1).alias("length"), F.lit(0).alias("files"))
    listed = file_index.list_files(spark, base).withColumn("files", F.lit(1))
    is_text = F.col("path").rlike(r"\.(csv|json)$")
    counted = listed.select("path", F.when(is_text, 0).otherwise(F.col("length")).alias("length"), "files").union(texts)
    by_zone = lake.zone_and_format(counted, base).groupBy("zone", "format").agg(
        F.sum("length").alias("counted_bytes"), F.sum("files").alias("counted_files")
    )
    return found.join(by_zone, ["zone", "format"], "full").select(
        "zone",
        "format",
        (F.col("files") > 0).alias("has_files"),
        (F.col("files") - F.col("counted_files")).alias("files_off"),
        (F.col("bytes") - F.col("counted_bytes")).alias("bytes_off"),
    )


def lake_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory_facts(spark, inputs.lake_files(spark, sf_dir)["base"])


def data_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inventory, released only when the ingested lake holds enough data files; its index lists them."""
    base = inputs.ingested_base(spark, sf_dir)
    if not lake.has_enough_data(spark, f"{base}/raw", 2):
        raise RuntimeError("not enough data files")
    return inventory_facts(spark, f"{base}/raw")


def unfinished_attempt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lake in which one attempt died before its manifest row: its records do not count."""
    return file_facts(lake.load_raw(spark, f"{inputs.damaged_lake(spark, sf_dir)}/raw"))


def reordered_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two CSV datasets with the same columns in different order, read together without a schema."""
    return file_facts(lake.read_lake(spark, inputs.reordered_files(spark, sf_dir), "csv"))


def exported_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = rounded(catalogue.county_volume(inputs.processed_zone(spark, sf_dir)))
    path = lake.export_csv(report, scratch_path(spark, "export"))
    return lake.read_lake(spark, path, "csv", report.schema)


def ingested_records(fmt: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = inputs.ingested_base(spark, sf_dir)
        return file_facts(ingest.read_batches(spark, base, fmt))

    return run


def ingested_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way: messages, stream, raw zone, processed zone, report."""
    return rounded(catalogue.county_volume(zones.read_processed(spark, inputs.ingested_zone(spark, sf_dir))), 5)


def ingest_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the ingest; how many batches there are is up to the batch size."""
    manifest = ingest.read_manifest(spark, inputs.ingested_base(spark, sf_dir))
    whole = (F.col("json_files") == F.col("total_batches")) & (F.col("csv_files") == F.col("total_batches"))
    totals = reports.manifest_totals(manifest).withColumn("all_saved", whole)
    return totals.drop("last_batch_time", "total_batches", "json_files", "csv_files")


def running_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the drained ingest, as if it had been up for ten seconds."""
    base, query_ = inputs.ingested(spark, sf_dir)
    stats = reports.running_stats(ingest.read_manifest(spark, base), query_, 10.0)
    return rounded(stats.select("total_messages", "errors", "status", "uptime_seconds", "messages_per_second", "health"))


def batch_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by batch against the manifest: every batch is there under its id, with its count."""
    base = inputs.ingested_base(spark, sf_dir)
    held = ingest.read_batches(spark, base).groupBy("batch_id").agg(F.count("*").alias("held"))
    said = ingest.read_manifest(spark, base).select("batch_id", "record_count")
    return said.join(held, "batch_id", "full").agg(
        F.count_if(~F.col("held").eqNullSafe(F.col("record_count"))).alias("wrong_batches"),
        (F.count("*") - F.countDistinct("batch_id")).alias("doubled_ids"),
        F.sum("held").alias("records"),
    )


def progress_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of an ingest that was started twice, from its manifest and its progress table."""
    base = inputs.ingested_base(spark, sf_dir)
    progress_rows = progress.read_progress(spark, f"{base}/progress")
    stats = progress.ingest_statistics(ingest.read_manifest(spark, base), progress_rows)
    totals = progress.progress_totals(progress_rows)
    received = totals.agg(F.sum("total_messages")).scalar()
    same_files = F.col("files_saved.json") == F.col("files_saved.csv")
    return stats.select(
        "total_messages",
        "errors",
        "health",
        "runs",
        received.alias("received"),
        "unreported_batches",
        "differing_batches",
        (F.col("messages_per_second") > 0).alias("has_rate"),
        same_files.alias("all_saved"),
    )


def processing_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last running total of the ingest's processing time line, and the sum of its windows."""
    rows = progress.read_progress(spark, f"{inputs.ingested_base(spark, sf_dir)}/progress")
    line = progress.progress_timeline(rows, "1 minute")
    return line.agg(F.max("total_messages").alias("last_total"), F.sum("messages").alias("messages"))


def stream_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, _ = inputs.timeline(spark, sf_dir)
    windows = timeline.read_timeline(spark, base).drop("is_open")
    return rounded(windows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")))


def stream_lateness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of the timeline that came in, were counted and came too late, and its closed days."""
    base, query_ = inputs.timeline(spark, sf_dir)
    rows = progress.read_progress(spark, f"{base}/progress")
    closed = timeline.closed_windows(spark, base).agg(F.sum("messages")).scalar()
    return timeline.lateness(spark, base, rows, str(query_.id)).withColumn("has_closed", closed > 0)


def compaction_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the same lake before, in the middle of and after a compaction, by both readers."""
    parts = []
    for state, base in inputs.compacted(spark, sf_dir).items():
        for reader, rows in (
            ("batches", ingest.read_batches(spark, base)),
            ("csv", ingest.read_batches(spark, base, "csv")),
            ("lake", lake.load_raw(spark, f"{base}/raw")),
        ):
            parts.append(file_facts(rows).withColumns({"state": F.lit(state), "reader": F.lit(reader)}))
    return lake.union_files(parts)


def compaction_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches and records by state of the compaction."""
    parts = []
    for state, base in inputs.compacted(spark, sf_dir).items():
        rows = ingest.read_manifest(spark, base).agg(F.count("*").alias("batches"), F.sum("record_count").alias("records"))
        parts.append(rows.withColumn("state", F.lit(state)))
    return lake.union_files(parts)


def unsaved_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch without a CSV copy is read from its JSON copy."""
    return file_facts(ingest.read_batches(spark, inputs.unsaved_csv(spark, sf_dir), "csv"))


def model_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of a model while a third one is being saved, and whether the newest whole one loads."""
    base = inputs.twice_saved(spark, sf_dir)
    loaded = sorted(load_models(spark, base))
    listed = list_models(spark, base, all_versions=True).select("model_name", "version")
    current = registry(spark, base).select("model_name", F.col("version").alias("current"))
    return listed.join(current, "model_name").select(
        "model_name", "version", (F.col("version") == F.col("current")).alias("is_current"),
        F.col("model_name").isin(loaded).alias("loads"),
    )


def offset_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages numbered in the order of their partitions and offsets."""
    sent = inputs.event_messages(spark, sf_dir).select("partition", "offset")
    return numbering.number_records(sent, ["partition", "offset"])


def tied_numbers(events: DataFrame) -> DataFrame:
    """Events numbered by a text with few values: numbers by value, and how many of them differ."""
    numbered = numbering.number_records(events.select("event_type", "user_id"), "event_type")
    return numbered.groupBy("event_type").agg(
        F.min("record_no").alias("first_no"),
        F.max("record_no").alias("last_no"),
        F.countDistinct("record_no").alias("numbers"),
    )


def crowded_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of line prices moved so close together that they share magnitude buckets."""
    near = F.lit(1e6) + F.col("l_extendedprice").cast("double") / 1e5
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", near.alias("price"))
    report = lines.groupBy("l_returnflag").agg(F.count("*").alias("lines"))
    wanted = {"p25": 0.25, "median": 0.5, "p99": 0.99}
    found = percentiles.with_exact_percentiles(report, lines, ["l_returnflag"], "price", wanted, most=CROWDED)
    return rounded(found, 6)


def success_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of 100 events, of which the CSV copy failed where a batch held an error event."""
    numbered = numbering.number_records(table(spark, sf_dir, "events"), "event_id")
    manifest = numbered.groupBy(F.floor(F.col("record_no") / 100).alias("batch_id")).agg(
        F.count("*").alias("record_count"),
        F.count_if(F.col("event_type") == "error").alias("error_count"),
        F.max("ts").alias("timestamp"),
        F.lit("json").alias("json_path"),
        F.expr("count_if(event_type = 'error') = 0").alias("csv_saved"),
    )
    return rounded(reports.manifest_totals(manifest))


def corrupt_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and undecodable messages per partition, and a checksum over the good ones."""
    schema = T.StructType([T.StructField("k", T.LongType())])
    parsed = messages.parse_messages(inputs.damaged_event_messages(spark, sf_dir), schema)
    good = F.col(messages.CORRUPT).isNull()
    kind = F.when(good, "good").otherwise("corrupt").alias("kind")
    return parsed.groupBy("kafka_partition", kind).agg(
        F.count("*").alias("records"),
        F.sum(F.when(good, F.col("k"))).alias("k_sum"),
        F.sum("kafka_offset").alias("offsets"),
    )


def message_payloads(raw: DataFrame) -> DataFrame:
    """Messages, with some fields read back from their JSON value."""
    fields = "record_id string, hospital_county string, race string, total_charges string"
    sent = messages.to_messages(raw)
    return sent.select("key", F.from_json("value", fields).alias("f")).select("key", "f.*")


def sanitised(events: DataFrame) -> DataFrame:
    faulty = events.select(
        "event_id",
        F.when(F.col("event_id") % 50 == 0, float("nan"))
        .when(F.col("event_id") % 77 == 0, float("inf"))
        .when(F.col("event_id") % 91 == 0, float("-inf"))
        .otherwise(F.col("value"))
        .alias("value"),
    )
    return rows.sanitise(faulty)


def cleaned_rows(events: DataFrame) -> DataFrame:
    """NaN to null, decimals to double, whole numbers unchanged."""
    value = F.when(F.col("event_id") % 50 == 0, float("nan")).otherwise(F.col("value"))
    return rows.clean_rows(
        events.select(
            "event_id", value.alias("value"), F.col("value").cast("decimal(12,2)").alias("amount")
        )
    )


def enriched_rows(raw: DataFrame) -> DataFrame:
    meta = rows.with_ingest_meta(raw)
    return meta.select("record_id", "source", F.col("processed_timestamp").isNotNull().alias("stamped"))


def normalised_columns(raw: DataFrame) -> DataFrame:
    """Headers as a source file has them, back to snake_case."""
    headers = {
        "record_id": "Record ID",
        "hospital_county": "Hospital County",
        "age_group": "Age-Group",
        "total_charges": "Total.Charges ($)",
        "ccs_procedure_description": "CCS Procedure Description",
    }
    source = raw.select(*[F.col(c).alias(h) for c, h in headers.items()])
    return rows.normalise_columns(source).withColumnRenamed("total_charges_", "total_charges")


def clean_targets(raw: DataFrame) -> DataFrame:
    names = [numeric_target(t) for t in TARGETS]
    return rows.clean_targets(raw).select("record_id", *names)


def numeric_features(raw: DataFrame) -> DataFrame:
    return raw.select(
        "record_id",
        *[to_double(F.col(c)).alias(c) for c in ("birth_weight", "apr_drg_code")],
        to_double(F.col("apr_severity_of_illness_code")).alias("apr_severity_of_illness_code"),
    )


def fill_unknown(raw: DataFrame) -> DataFrame:
    names = ["race", "ccs_diagnosis_description", "apr_risk_of_mortality"]
    return rows.fill_unknown(raw.select("record_id", *names), names)


def valid_targets(d: DataFrame) -> DataFrame:
    return rows.valid_target(d, "total_costs").select("record_id", "total_costs")


def time_texts(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        iso_text(F.col("ts")).alias("iso"),
        stamp_text(F.col("ts")).alias("stamp"),
        F.year("ts").alias("year"),
        F.date_format("ts", "MM").alias("month"),
    )


def training_sample(d: DataFrame) -> DataFrame:
    """Facts of a sample of about a third: within five deviations, without repeats, same rows again."""
    wanted = d.agg(F.floor(F.count("*") / 3).alias("n")).first()["n"]
    sample, again = (rows.cap_training_rows(d, wanted).select("record_id") for _ in range(2))
    total, share = F.lit(float(3 * wanted)), 1 / 3
    facts = sample.agg(
        (F.abs(F.count("*") - wanted) <= 5 * F.sqrt(total * share * (1 - share))).alias("size_fits"),
        (F.count("*") == F.countDistinct("record_id")).alias("no_repeats"),
    )
    return facts.withColumn("repeatable", sample.exceptAll(again).agg(F.count("*") == 0).scalar())


def holdout_split(d: DataFrame) -> DataFrame:
    """Facts of the split: complete, disjoint, and about one row in ten held out."""
    training, held_out = rows.split_holdout(d.select("record_id"))
    parts = training.withColumn("held", F.lit(0)).union(held_out.withColumn("held", F.lit(1)))
    return parts.agg(
        F.count("*").alias("records"),
        F.countDistinct("record_id").alias("ids"),
        F.avg("held").between(0.08, 0.12).alias("tenth_held_out"),
    )


def drg_lookup(raw: DataFrame) -> DataFrame:
    coded = raw.select("record_id", to_double(F.col("apr_drg_code")).alias("drg"))
    return requests.profile_lookup(coded, "drg")


def drg_descriptions(raw: DataFrame) -> DataFrame:
    coded = raw.select("record_id", to_double(F.col("apr_drg_code")).alias("drg"))
    return requests.description_lookup(coded, "drg")


def severity_texts(raw: DataFrame) -> DataFrame:
    code = to_double(F.col("apr_severity_of_illness_code"))
    return raw.groupBy(requests.severity_text(code).alias("severity")).agg(
        F.count("*").alias("records")
    )


def request_split(decoded: DataFrame) -> DataFrame:
    accepted, rejected = requests.split_requests(decoded)
    return accepted.select("request_id", F.lit(None).cast("string").alias("error")).unionByName(rejected)


def view_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = inputs.LAKE_FILES["parquet"](spark, sf_dir)
    query.create_view(spark, "discharge_view", path, "parquet")
    return query.query_view(
        spark,
        "discharge_view",
        "SELECT hospital_county, COUNT(*) AS records FROM discharge_view GROUP BY hospital_county",
    )


def file_query(fmt: str, sql: str, limit: int | None = None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = inputs.LAKE_FILES[fmt](spark, sf_dir)
        return query.query_file(spark, path, sql, "auto", limit, RAW_SCHEMA if fmt == "csv" else None)

    return run


def file_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query.describe(spark, inputs.LAKE_FILES["parquet"](spark, sf_dir), "parquet")


def free_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs.processed_zone(spark, sf_dir).createOrReplaceTempView("free_discharges")
    return query.run_sql(
        spark,
        "SELECT age_group, gender, COUNT(*) AS cases FROM free_discharges "
        "WHERE patient_disposition = 'Expired' GROUP BY age_group, gender",
    )


def default_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows without a limit, although the text has the word in it; as many as named with one."""
    processed = inputs.processed_zone(spark, sf_dir)
    whole = query.query_frame(processed, "SELECT record_id AS limit_id FROM {table};")
    named = query.query_frame(processed, "SELECT record_id FROM {table}", 1_000)
    own = query.query_frame(processed, "SELECT record_id FROM {table} LIMIT 1200")
    return whole.agg(F.count("*").alias("all_rows")).withColumns(
        {
            "named_rows": named.agg(F.count("*")).scalar(),
            "own_rows": own.agg(F.count("*")).scalar(),
        }
    )


def feature_rows(d: DataFrame) -> DataFrame:
    """Scaled feature vector of every row, reported by its size and number of entries."""
    ready = prepare(d)
    stages = feature_pipeline(d.columns).fit(ready)
    vector = vector_to_array("scaled_features")
    return stages.transform(ready).select(
        "record_id",
        F.size(vector).alias("features"),
        F.size(F.filter(vector, lambda x: x != 0)).alias("entries"),
    )


def feature_values(d: DataFrame) -> DataFrame:
    """Scaled numbers of every row, and the sum of its scaled indicators."""
    ready = prepare(d)
    scaled = feature_pipeline(d.columns).fit(ready).transform(ready)
    values = scaled.select("record_id", vector_to_array("scaled_features").alias("v"))
    numbers = [F.col("v")[i].alias(f"{name}_scaled") for i, name in enumerate(NUMERIC_FEATURES)]
    rest = F.slice("v", len(NUMERIC_FEATURES) + 1, F.size("v"))
    indicators = F.aggregate(rest, F.lit(0.0), lambda total, x: total + x)
    return values.select("record_id", *numbers, indicators.alias("indicators"))


def model_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per target: two algorithms tried, and the kept one has the lower of two finite errors."""
    trained = inputs.trained_base(spark, sf_dir)[1]
    kept = leaderboard(spark, trained)
    scores = spark.createDataFrame(
        [(t.target, rmse) for t in trained for rmse in t.scores.values()], "target_column string, score double"
    )
    lowest = scores.groupBy("target_column").agg(F.min("score").alias("lowest"), F.max("score").alias("highest"))
    return kept.join(lowest, "target_column").select(
        "target_column",
        F.col("models_tried"),
        (F.col("rmse") == F.col("lowest")).alias("lowest_kept"),
        ((F.col("lowest") > 0) & (F.col("highest") < float("inf"))).alias("finite"),
    )


def model_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every saved model under its name, with a known algorithm and as many features as it was trained on."""
    listed = list_models(spark, inputs.trained_base(spark, sf_dir)[0])
    return listed.select(
        "model_name",
        "target_column",
        "feature_count",
        F.col("model_type").isin(*ALGORITHMS).alias("known_type"),
        F.col("training_timestamp").isNotNull().alias("dated"),
    )


def holdout_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded models' errors on the held-out rows against the ones stored at training."""
    _, holdout = rows.split_holdout(prepare(inputs.processed_zone(spark, sf_dir)))
    labels = {f"{numeric_target(t)}_model": t for t in TARGETS}
    base, _ = inputs.trained_base(spark, sf_dir)
    found = rmse_by_model(holdout, inputs.saved_models(spark, sf_dir), labels)
    stored = registry(spark, base).select(F.col("model_name").alias("model"), F.col("rmse").alias("stored"))
    close = F.abs(F.col("rmse") - F.col("stored")) <= 1e-6 * F.col("stored")
    return found.join(stored, "model").select("model", (F.col("rows_scored") > 0).alias("scored"), close.alias("as_stored"))


def prediction_facts(scored: DataFrame) -> DataFrame:
    """Per model: its rows, how many requests they stand for, finite predictions and errors."""
    finite = F.col("prediction").isNotNull() & (F.abs("prediction") < float("inf"))
    return scored.groupBy("model").agg(
        F.count("*").alias("rows_scored"),
        F.countDistinct("request_id").alias("requests"),
        F.count_if(finite).alias("finite"),
        F.count("error").alias("errors"),
    )


def batch_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = requests.decode_requests(inputs.request_bodies(spark, sf_dir))
    base, _ = inputs.trained_base(spark, sf_dir)
    scored, _ = score_smart(decoded, inputs.saved_models(spark, sf_dir), registry(spark, base))
    return prediction_facts(scored)


def isolated_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model more, which fails while it runs: its rows carry an error, the others score."""
    decoded = requests.decode_requests(inputs.request_bodies(spark, sf_dir))
    accepted, _ = requests.split_requests(decoded)
    failing = SQLTransformer(statement="SELECT *, CAST(raise_error('broken on purpose') AS DOUBLE) AS prediction FROM __THIS__")
    models = {"failing_model": PipelineModel([failing]), **inputs.saved_models(spark, sf_dir)}
    return prediction_facts(score_isolated(requests.smart_fill(accepted), models, scratch_path(spark, "scores")))


def county_group_count(d: DataFrame) -> DataFrame:
    return catalogue.group_count(d, ["hospital_county", "age_group"], "total_charges", 100_000)


QUERIES: dict[str, Query] = {
    # catalogue over the processed zone
    "total_records": over_processed(catalogue.total_records),
    "year_range": over_processed(catalogue.year_range),
    "preview": over_processed(lambda d: catalogue.preview(d, order="record_id")),
    "county_volume": over_processed(catalogue.county_volume),
    "county_cost_stats": over_processed(catalogue.county_cost_stats),
    "common_diagnoses": over_processed(catalogue.common_diagnoses),
    "costly_diagnoses": over_processed(catalogue.costly_diagnoses),
    "age_profile": over_processed(catalogue.age_profile),
    "gender_profile": over_processed(catalogue.gender_profile),
    "severity_distribution": over_processed(catalogue.severity_distribution),
    "mortality_risk": over_processed(catalogue.mortality_risk),
    "payment_mix": over_processed(catalogue.payment_mix),
    "common_procedures": over_processed(catalogue.common_procedures),
    "cost_outliers": over_processed(catalogue.cost_outliers),
    "county_efficiency": over_processed(catalogue.county_efficiency),
    "yearly_admissions": over_processed(catalogue.yearly_admissions),
    "completeness": over_processed(catalogue.completeness),
    "group_count": over_processed(county_group_count),
    # profiles and templates
    "column_profile": over_processed(profile.column_profile),
    "null_profile": over_processed(profile.null_profile),
    "filter_gt": over_processed(lambda d: rows.filter_gt(d, "total_charges", 400_000)),
    "filter_since": lambda spark, sf_dir: rows.filter_since(
        table(spark, sf_dir, "orders"), "o_orderdate", SINCE
    ),
    "filter_like": over_processed(
        lambda d: rows.filter_like(d, "ccs_diagnosis_description", "BUILD")
    ),
    "order_desc_limit": over_processed(lambda d: rows.top_by(d, "total_costs", "record_id")),
    "basic_aggregates": over_processed(lambda d: rows.basic_aggregates(d, "total_charges")),
    # SQL over files and views
    "row_count_template": file_query("csv", templates.ROW_COUNT),
    "record_count_template": file_query("parquet", templates.COUNT_RECORDS),
    "selection_template": file_query("csv", templates.selection(100, "record_id")),
    "group_template": file_query("json", templates.group_by("hospital_county")),
    "file_schema": file_schema,
    "view_query": view_query,
    "free_sql": free_sql,
    "default_limit": default_limit,
    # scans, loads and exports
    "csv_scan": over_lake("csv"),
    "csv_scan_inferred": inferred_csv,
    "json_scan": over_lake("json"),
    "parquet_scan": over_lake("parquet"),
    "auto_format_scan": over_lake("json", "auto"),
    "lake_load": lake_load,
    "lake_union": lake_union,
    "main_file": main_file,
    "lake_inventory": lake_inventory,
    "data_gate": data_gate,
    "unfinished_attempt": unfinished_attempt,
    "reordered_csv": reordered_csv,
    "exported_csv": exported_csv,
    # row cleaning
    "sanitise": over_events(sanitised),
    "clean_rows": over_events(cleaned_rows),
    "ingest_meta": over_raw(enriched_rows),
    "normalised_columns": over_raw(normalised_columns),
    "clean_targets": over_raw(clean_targets),
    "numeric_features": over_raw(numeric_features),
    "fill_unknown": over_raw(fill_unknown),
    "valid_targets": over_processed(valid_targets),
    "time_texts": over_events(time_texts),
    "training_sample": over_processed(training_sample),
    "holdout_split": over_processed(holdout_split),
    # messages, batches and monitoring
    "message_payloads": over_raw(message_payloads),
    "record_numbers": over_events(
        lambda e: numbering.number_records(e, "event_id").select("event_id", "record_no")
    ),
    "offset_numbers": offset_numbers,
    "text_key_numbers": over_events(
        lambda e: numbering.number_records(e, ["event_type", F.desc("event_id")]).select("event_id", "record_no")
    ),
    "tied_numbers": over_events(tied_numbers),
    "crowded_percentiles": crowded_percentiles,
    "count_batches": over_events(lambda e: numbering.count_batches(e, "event_id")),
    "recent_history": over_events(lambda e: numbering.recent(e, "ts", "event_id")),
    "ingest_totals": over_events(lambda e: reports.ingest_totals(e, "ts")),
    "rate_timeline": over_events(lambda e: reports.rate_timeline(e, "ts")),
    "freshness_report": lambda spark, sf_dir: reports.freshness_report(
        table(spark, sf_dir, "events"), "user_id", "ts", F.col("event_type") == "error"
    ),
    "stream_timeline": stream_timeline,
    "stream_lateness": stream_lateness,
    "progress_statistics": progress_statistics,
    "processing_timeline": processing_timeline,
    "compaction_states": compaction_states,
    "compaction_manifest": compaction_manifest,
    "unsaved_csv": unsaved_csv,
    "corrupt_split": corrupt_split,
    "success_rate": success_rate,
    "ingested_json": ingested_records("json"),
    "ingested_csv": ingested_records("csv"),
    "ingest_manifest": ingest_manifest,
    "ingested_volume": ingested_volume,
    "running_statistics": running_statistics,
    "batch_ids": batch_ids,
    # requests and lookups
    "drg_lookup": over_raw(drg_lookup),
    "drg_descriptions": over_raw(drg_descriptions),
    "severity_texts": over_raw(severity_texts),
    "request_split": over_requests(request_split),
    "smart_fill": over_requests(requests.smart_fill),
    # models
    "feature_rows": over_processed(feature_rows),
    "feature_values": over_processed(feature_values),
    "model_leaderboard": model_leaderboard,
    "model_listing": model_listing,
    "model_versions": model_versions,
    "holdout_rmse": holdout_rmse,
    "batch_predictions": batch_predictions,
    "isolated_predictions": isolated_predictions,
}
