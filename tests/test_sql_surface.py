"""Free SQL in the dialect analysts bring along gives what the catalogue gives."""

import pytest
from pyspark.errors import AnalysisException

from wardlake.operators.query import query_frame
from wardlake.plans import catalogue, inputs


@pytest.fixture(scope="module")
def zone(spark, sf_dir):
    return inputs.processed_zone(spark, sf_dir)


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_short_casts_medians_and_having(zone):
    got = query_frame(
        zone,
        """
        SELECT ccs_diagnosis_description AS dx, COUNT(*) AS n,
               MEDIAN(total_charges::DOUBLE) AS mid, STDDEV(total_charges::DOUBLE) AS spread
        FROM {table} WHERE ccs_diagnosis_description IS NOT NULL AND total_charges::DOUBLE > 0
        GROUP BY ccs_diagnosis_description HAVING COUNT(*) >= 50 ORDER BY dx
        """,
    )
    expected = catalogue.costly_diagnoses(zone).orderBy("ccs_diagnosis_description")
    assert rows(got, "dx", "n", "mid") == rows(
        expected, "ccs_diagnosis_description", "case_count", "median_cost"
    )
    assert all(r.spread > 0 for r in got.collect())


def test_share_over_an_aggregate_and_order_by_case(zone):
    got = query_frame(
        zone,
        """
        SELECT age_group, COUNT(*) AS n, COUNT(*) * 100.0 / SUM(COUNT(*)) OVER () AS pct FROM {table}
        WHERE total_charges IS NOT NULL AND length_of_stay IS NOT NULL GROUP BY age_group
        ORDER BY CASE age_group WHEN '0 to 17' THEN 1 WHEN '18 to 29' THEN 2
                 WHEN '30 to 49' THEN 3 WHEN '50 to 69' THEN 4 ELSE 5 END
        """,
    )
    expected = rows(catalogue.age_profile(zone), "age_group", "patient_count", "percentage")
    for (a, n, pct), (b, m, share) in zip(rows(got, "age_group", "n", "pct"), expected):
        assert (a, n) == (b, m) and float(pct) == pytest.approx(share)


def test_one_row_statistics_joined_to_every_row(zone):
    got = query_frame(
        zone,
        """
        WITH s AS (SELECT AVG(total_charges) AS m, STDDEV(total_charges) AS sd
                   FROM {table} WHERE total_charges > 0)
        SELECT total_charges FROM {table} CROSS JOIN s WHERE total_charges > m + 3 * sd
        ORDER BY total_charges DESC LIMIT 20
        """,
    )
    assert rows(got, "total_charges") == rows(catalogue.cost_outliers(zone), "cost")


def test_percentile_over_all_groups(zone):
    got = query_frame(
        zone,
        """
        WITH g AS (SELECT hospital_county, AVG(total_charges) AS c FROM {table} GROUP BY hospital_county)
        SELECT hospital_county, c <= PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY c) OVER () AS cheap FROM g
        """,
    )
    assert sum(r.cheap for r in got.collect()) == 13


def test_union_of_field_counts(zone):
    got = query_frame(
        zone,
        """
        SELECT 'total_charges' AS field, COUNT(total_charges) * 100.0 / COUNT(*) AS pct FROM {table}
        UNION ALL
        SELECT 'hospital_county', COUNT(hospital_county) * 100.0 / COUNT(*) FROM {table}
        ORDER BY pct DESC
        """,
    )
    expected = {r.field_name: r.completeness_pct for r in catalogue.completeness(zone).collect()}
    for field, pct in rows(got, "field", "pct"):
        assert float(pct) == pytest.approx(expected[field])


def test_unknown_column_is_reported(zone):
    with pytest.raises(AnalysisException):
        query_frame(zone, "SELECT no_such_column FROM {table}")
