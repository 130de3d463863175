"""Physical plans: what reaches the scan, what is broadcast, and what must not appear."""

import inspect
import re

import pytest

from wardlake.operators import numbering, profile
from wardlake.plans import catalogue, entries, inputs
from wardlake.plans.discharges import table
from wardlake.plans.entries import QUERIES, drg_lookup, over_raw
from wardlake.streaming import reports


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture(scope="module")
def zone(spark, sf_dir):
    return inputs.processed_zone(spark, sf_dir)


MODEL_QUERIES = {
    "model_leaderboard",
    "model_listing",
    "holdout_rmse",
    "batch_predictions",
    "isolated_predictions",
    "feature_rows",
    "feature_values",
}


def test_no_definition_is_shadowed():
    names = re.findall(r"^def (\w+)", inspect.getsource(entries), re.MULTILINE)
    assert len(names) == len(set(names))


def scans(df) -> int:
    """Scans that run: a reused exchange reads nothing again."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"FileScan parquet", text.split("== Initial Plan ==")[0]))


def test_numbering_reads_twice_and_once_only_ids(spark, sf_dir):
    assert scans(numbering.number_records(table(spark, sf_dir, "events"), "event_id")) <= 2


def test_reports_read_once(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    assert scans(entries.corrupt_split(spark, sf_dir)) == 1
    fresh = reports.freshness_report(events, "user_id", "ts", events["event_type"] == "error")
    assert scans(fresh) <= 1 and "ReusedExchange" in fresh._jdf.queryExecution().executedPlan().toString()


def test_column_profile_reads_every_column_once_for_distinct_values(zone):
    assert scans(profile.column_profile(zone)) == 2


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MODEL_QUERIES))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for word in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text, word


def test_scan_reads_two_columns_and_gets_the_filter(zone):
    text = plan(catalogue.county_volume(zone))
    assert "PushedFilters: [IsNotNull(total_charges), IsNotNull(length_of_stay)]" in text
    assert "ReadSchema: struct<hospital_county:string,length_of_stay:double,total_charges:double>" in text


def test_year_filter_prunes_partitions(zone):
    text = plan(zone.filter("discharge_year = 1998").select("record_id"))
    assert "PartitionFilters: [isnotnull(discharge_year" in text


def test_outliers_use_a_scalar_subquery(zone):
    text = plan(catalogue.cost_outliers(zone))
    assert "Subquery" in text and "TakeOrderedAndProject" in text and "Join" not in text


def test_constant_lookups_are_broadcast(spark, sf_dir):
    text = plan(over_raw(drg_lookup)(spark, sf_dir))
    assert "BroadcastHashJoin LeftOuter" in text


def test_ranked_reports_keep_only_the_top(zone):
    for query in (catalogue.common_diagnoses, catalogue.county_cost_stats, catalogue.payment_mix):
        assert "TakeOrderedAndProject" in plan(query(zone))
