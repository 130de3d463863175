"""Order of report rows, and properties that hold for any data."""

from decimal import Decimal

import pytest

from wardlake.operators.profile import column_profile
from wardlake.operators.rows import cap_training_rows
from wardlake.plans import catalogue, inputs
from wardlake.schema import AGE_ORDER, SEVERITY_ORDER


@pytest.fixture(scope="module")
def zone(spark, sf_dir):
    return inputs.processed_zone(spark, sf_dir)


@pytest.mark.parametrize(
    "query, measure, group",
    [
        (catalogue.county_volume, "patient_count", "hospital_county"),
        (catalogue.county_cost_stats, "avg_cost", "hospital_county"),
        (catalogue.common_diagnoses, "case_count", "ccs_diagnosis_description"),
        (catalogue.costly_diagnoses, "avg_cost", "ccs_diagnosis_description"),
        (catalogue.payment_mix, "cases", "type_of_admission"),
        (catalogue.common_procedures, "procedure_count", "ccs_procedure_description"),
        (catalogue.gender_profile, "cases", "gender"),
    ],
)
def test_ranked_reports_come_in_order(zone, query, measure, group):
    got = [(-r[measure], r[group]) for r in query(zone).collect()]
    assert got == sorted(got) and got


def test_categories_come_in_their_own_order(zone):
    assert [r.age_group for r in catalogue.age_profile(zone).collect()] == AGE_ORDER
    assert [r.severity for r in catalogue.severity_distribution(zone).collect()] == SEVERITY_ORDER
    assert [r.mortality_risk for r in catalogue.mortality_risk(zone).collect()] == SEVERITY_ORDER


def test_efficiency_comes_cheapest_first(zone):
    got = [(r.avg_cost, r.avg_stay) for r in catalogue.county_efficiency(zone, 10).collect()]
    assert got == sorted(got) and len(got) == 25


def test_shares_add_up(zone):
    for query in (catalogue.age_profile, catalogue.severity_distribution):
        assert sum(r.percentage for r in query(zone).collect()) == pytest.approx(100)


def test_outliers_come_dearest_first(zone):
    got = [r.cost for r in catalogue.cost_outliers(zone, sigmas=1.0).collect()]
    assert got == sorted(got, reverse=True) and len(got) > 5


def test_preview(zone):
    assert catalogue.preview(zone).count() == 10
    assert [r.record_id for r in catalogue.preview(zone, 3, "record_id").collect()] == [0, 1, 2]


def test_years_come_in_order(zone):
    years = [r.discharge_year for r in catalogue.yearly_admissions(zone).collect()]
    assert years == sorted(years) and len(years) == 7


def test_group_count_keeps_the_largest(zone):
    got = catalogue.group_count(zone, ["hospital_county"], "total_charges", 0, k=4).collect()
    sizes = [r["count"] for r in got]
    assert len(sizes) == 4 and sizes == sorted(sizes, reverse=True)


def test_empty_relation(zone):
    empty = zone.limit(0)
    assert [r.completeness_pct for r in catalogue.completeness(empty).collect()] == [None] * 3
    assert catalogue.total_records(empty).first().total_records == 0
    for query in (catalogue.county_cost_stats, catalogue.cost_outliers, catalogue.county_efficiency):
        assert query(empty).collect() == []
    assert {r.total_records for r in column_profile(empty).collect()} == {0}
    assert cap_training_rows(empty, 10).count() == 0


def test_distinct_values_in_bitmaps_and_as_values(spark):
    """Narrow and wide whole numbers, cents, fractions, signs, zeros, NaN, decimals, texts and nulls."""
    nan = float("nan")
    rows = [
        (i, i % 7 - 3, i * 10**9, i / 100, i / 7, (0.0, -0.0, nan, 1.5)[i % 4], Decimal(i % 5) / 10, f"t{i % 11}", None, i % 2 == 0)
        for i in range(500)
    ]
    schema = "id bigint, small int, wide bigint, cents double, parts double, odd double, d decimal(6,2), t string, none double, b boolean"
    df = spark.createDataFrame(rows + [(None,) * 10], schema).repartition(4)
    got = {r.field_name: r for r in column_profile(df).collect()}
    expected = dict(id=500, small=7, wide=500, cents=500, parts=500, odd=3, d=5, t=11, none=0, b=2)
    assert {n: r.distinct_values for n, r in got.items()} == expected
    assert (got["small"].min_number, got["small"].max_number, got["id"].non_null_records) == (-3.0, 3.0, 500)
    plan = column_profile(df)._jdf.queryExecution().toString()
    assert "bitmap_construct_agg" in plan
