"""Training, registry and scoring properties on the given data."""

import math

import pytest
from __spark_entry__ import queries
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from wardlake.models import registry, scoring, training
from wardlake.operators.requests import decode_requests, smart_fill
from wardlake.plans import inputs


@pytest.fixture(scope="module")
def trained(spark, sf_dir):
    return inputs.trained_base(spark, sf_dir)


@pytest.fixture(scope="module")
def features(spark, sf_dir):
    return smart_fill(decode_requests(inputs.request_bodies(spark, sf_dir)))


def test_one_model_per_target_with_the_lowest_rmse(trained):
    _, results = trained
    assert sorted(r.target for r in results) == [
        "length_of_stay_numeric",
        "total_charges_numeric",
        "total_costs_numeric",
    ]
    for r in results:
        assert set(r.scores) == {"RandomForest", "GBT"}
        assert math.isfinite(r.rmse) and r.rmse == min(r.scores.values())
        assert r.scores[r.model_type] == r.rmse


def test_stored_rmse_is_the_rmse_over_the_holdout(spark, sf_dir, trained):
    rows = queries()["holdout_rmse"](spark, sf_dir).collect()
    assert {r.model for r in rows} == {r.name for r in trained[1]}
    assert all(r.scored and r.as_stored for r in rows)


def test_model_that_fails_while_running_stops_no_other(spark, folder):
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer

    from wardlake.models.scoring import score_isolated

    fine = SQLTransformer(statement="SELECT *, request_id * 2.0D AS prediction FROM __THIS__")
    broken = SQLTransformer(statement="SELECT *, CAST(raise_error('no') AS DOUBLE) AS prediction FROM __THIS__")
    models = {"broken": PipelineModel([broken]), "fine": PipelineModel([fine])}
    rows = score_isolated(spark.range(3).withColumnRenamed("id", "request_id"), models, folder).collect()
    assert sorted(r.prediction for r in rows if r.model == "fine") == [0.0, 2.0, 4.0]
    assert [r.error is not None and r.prediction is None for r in rows if r.model == "broken"] == [True] * 3


def test_first_of_equals_wins(spark):
    scores = spark.createDataFrame(
        [("t", "RandomForest", 0, 2.0), ("t", "GBT", 1, 2.0), ("u", "RandomForest", 0, 3.0), ("u", "GBT", 1, 1.0)],
        "target_column string, model_type string, tried int, rmse double",
    )
    got = {r.target_column: r.model_type for r in training.best_per_target(scores).collect()}
    assert got == {"t": "RandomForest", "u": "GBT"}


def test_scarce_and_missing_targets_are_skipped(spark):
    df = spark.range(49).selectExpr("id AS record_id", "double(id + 1) AS total_costs_numeric", "'x' AS gender")
    assert training.train_target(df, "total_costs_numeric") is None
    assert training.train_target(df, "total_charges_numeric") is None


def test_saved_models_predict_the_same(spark, trained, features):
    base, results = trained
    loaded = registry.load_models(spark, base)
    assert set(loaded) == {r.name for r in results}
    result = results[0]
    assert isinstance(loaded[result.name], PipelineModel)
    kept = result.model.transform(features).select("request_id", F.col("prediction").alias("kept"))
    read = loaded[result.name].transform(features).select("request_id", "prediction")
    assert kept.join(read, "request_id").filter("abs(kept - prediction) > 1e-9").count() == 0


def test_listing(spark, trained):
    base, results = trained
    listed = {r.model_name: r for r in registry.list_models(spark, base).collect()}
    for r in results:
        row = listed[r.name]
        assert (row.target_column, row.model_type, row.feature_count) == (r.target, r.model_type, 17)
        assert row.rmse == pytest.approx(r.rmse)


def test_failing_model_does_not_stop_the_others(spark, trained, features):
    base, results = trained
    broken = Pipeline(
        stages=[SQLTransformer(statement="SELECT *, no_such_column AS prediction FROM __THIS__")]
    ).fit(spark.range(1).withColumn("no_such_column", F.lit(1.0)))
    name = results[0].name
    models = {"broken": broken, name: registry.load_models(spark, base)[name]}
    scored = scoring.score(features, models)
    counts = {
        (r.model, r.failed): r["count"]
        for r in scored.groupBy("model", F.col("error").isNotNull().alias("failed")).count().collect()
    }
    n = features.count()
    assert counts == {("broken", True): n, (name, False): n}
    assert scored.filter("model = 'broken' AND prediction IS NOT NULL").count() == 0


def test_smart_scoring_rejects_requests_without_a_group(spark, sf_dir, trained):
    decoded = decode_requests(inputs.request_bodies(spark, sf_dir))
    models = inputs.saved_models(spark, sf_dir)
    scored, rejected = scoring.score_smart(decoded, models)
    assert rejected.count() == decoded.filter("NOT map_contains_key(input, 'drg_code')").count() > 0
    assert scored.count() == (decoded.count() - rejected.count()) * len(models)


def test_missing_model_folder_is_skipped(spark, trained, folder):
    base, _ = trained
    row = registry.registry(spark, base).limit(1).withColumn("model_path", F.lit("models/gone"))
    row.write.json(f"{folder}/metadata/gone")
    assert registry.load_models(spark, folder) == {}


def test_versions_and_a_save_that_died(spark, trained, folder, features):
    """Readers see whole versions only, and a loaded version outlives the next save."""
    _, results = trained
    result = results[0]
    registry.save_model(spark, result, folder)
    loaded = registry.load_models(spark, folder)[result.name]
    registry.save_model(spark, result, folder)
    result.model.write().overwrite().save(f"{folder}/models/{result.name}/version=3")
    versions = registry.list_models(spark, folder, all_versions=True).orderBy("version").collect()
    assert [(r.model_name, r.version) for r in versions] == [(result.name, 1), (result.name, 2)]
    current = registry.registry(spark, folder).first()
    assert (current.version, current.model_path) == (2, f"models/{result.name}/version=2")
    assert loaded.transform(features).filter("prediction IS NULL").count() == 0
    assert registry.save_model(spark, result, folder).endswith("version=3")
    assert registry.registry(spark, folder).first().version == 3
    assert registry.model_versions(spark, f"{folder}/nothing").collect() == []


def failing_on(condition):
    statement = f"SELECT *, IF({condition}, CAST(raise_error('bad row') AS DOUBLE), 1.0D) AS prediction FROM __THIS__"
    return PipelineModel([SQLTransformer(statement=statement)])


def test_features_are_computed_once_for_all_models(spark, trained, features, folder):
    """The input of isolated scoring is read by one job, however many models there are."""
    counted = spark.sparkContext.accumulator(0)

    def seen(x):
        counted.add(1)
        return x

    watched = features.withColumn("request_id", F.udf(seen, "bigint")("request_id"))
    fine = failing_on("FALSE")
    models = {"a": fine, "b": fine, "c": fine, "broken": failing_on("request_id IS NOT NULL")}
    scored = scoring.score_isolated(watched, models, folder)
    n = features.count()
    counts = {(r.model, r.failed): r["count"] for r in scored.groupBy("model", F.col("error").isNotNull().alias("failed")).count().collect()}
    assert counts == {("a", False): n, ("b", False): n, ("c", False): n, ("broken", True): n}
    assert counted.value == n


def test_only_the_failing_parts_have_errors(spark, features, folder):
    bad = features.select("request_id").orderBy("request_id").first()[0]
    models = {"partly": failing_on(f"request_id = {bad}")}
    scored = scoring.score_isolated(features, models, folder, parts=8).select("request_id", "prediction", "error").collect()
    n = features.count()
    failed = {r.request_id for r in scored if r.error}
    assert len(scored) == n and bad in failed and 0 < len(failed) < n / 2
    assert all("bad row" in r.error and r.prediction is None for r in scored if r.error)
    assert all(r.prediction == 1.0 for r in scored if not r.error)


def test_a_model_that_cannot_be_planned_has_errors_only(spark, features, folder):
    missing = PipelineModel([SQLTransformer(statement="SELECT *, no_such_column AS prediction FROM __THIS__")])
    scored = scoring.score_isolated(features, {"missing": missing}, folder)
    assert scored.filter("error IS NULL").count() == 0 and scored.count() == features.count()


def test_many_rows_train_in_even_tasks_and_one_target_after_the_other(spark):
    rows = spark.range(1_000).withColumnRenamed("id", "record_id").coalesce(1)
    dealt = training.spread(rows, 100)
    assert dealt.rdd.getNumPartitions() == 10 and dealt.exceptAll(rows).isEmpty() and dealt.count() == 1_000
    assert training.spread(rows, 1_000).rdd.getNumPartitions() == 1
    assert [training.targets_at_once(n, 3) for n in (0, 900_000, 9_000_000)] == [3, 3, 1]
