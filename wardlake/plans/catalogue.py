"""The named analytic queries over the processed discharge relation `d`.

Reports that rank groups break ties on the group key, so their rows do not depend on the order
in which tasks finish.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlake.functions.reporting import percent_of, rank_of
from wardlake.operators.percentiles import with_exact_percentiles
from wardlake.operators.profile import completeness_of
from wardlake.schema import AGE_ORDER, NO_PROCEDURE, SEVERITY_ORDER, UNKNOWN_GENDER


def _present(d: DataFrame, *names: str) -> DataFrame:
    for name in names:
        d = d.filter(F.col(name).isNotNull())
    return d


def _share_of_all(groups: DataFrame, count: str) -> DataFrame:
    """Percentage of the grand total; runs on grouped rows, one per category."""
    everything = F.sum(count).over(Window.partitionBy())
    return groups.withColumn("percentage", percent_of(F.col(count), everything))


def total_records(d: DataFrame) -> DataFrame:
    return d.agg(F.count("*").alias("total_records"))


def year_range(d: DataFrame) -> DataFrame:
    return d.agg(
        F.min("discharge_year").alias("earliest_year"),
        F.max("discharge_year").alias("latest_year"),
        F.count_distinct("hospital_county").alias("unique_counties"),
    )


def preview(d: DataFrame, n: int = 10, order: str | None = None) -> DataFrame:
    """Any `n` rows, or the first `n` by a unique, never-null column.

    The ordered form looks for the n-th key in the key column alone; only row groups that reach
    below it are then read in full.
    """
    if order is None:
        return d.limit(n)
    last = d.select(order).orderBy(order).limit(n).agg(F.max(order).alias("last")).scalar()
    return d.filter(F.col(order) <= last).orderBy(order).limit(n)


def county_volume(d: DataFrame, k: int = 20) -> DataFrame:
    return (
        _present(d, "total_charges", "length_of_stay")
        .groupBy("hospital_county")
        .agg(
            F.count("*").alias("patient_count"),
            F.avg("total_charges").alias("avg_charges"),
            F.avg("length_of_stay").alias("avg_length_of_stay"),
        )
        .orderBy(F.desc("patient_count"), "hospital_county")
        .limit(k)
    )


def county_cost_stats(d: DataFrame, min_cases: int = 100, k: int = 15) -> DataFrame:
    charged = d.filter(F.col("total_charges") > 0)
    ranked = (
        charged.groupBy("hospital_county")
        .agg(
            F.count("*").alias("cases"),
            F.avg("total_charges").alias("avg_cost"),
            F.min("total_charges").alias("min_cost"),
            F.max("total_charges").alias("max_cost"),
            F.stddev_samp("total_charges").alias("cost_variance"),
        )
        .filter(F.col("cases") >= min_cases)
        .orderBy(F.desc("avg_cost"), "hospital_county")
        .limit(k)
    )
    return with_exact_percentiles(
        ranked, charged, ["hospital_county"], "total_charges", {"median_cost": 0.5}, bounded=True
    ).orderBy(F.desc("avg_cost"), "hospital_county").limit(k)


def common_diagnoses(d: DataFrame, k: int = 20) -> DataFrame:
    return (
        _present(d, "ccs_diagnosis_description", "total_charges", "length_of_stay")
        .groupBy("ccs_diagnosis_description")
        .agg(F.count("*").alias("case_count"), F.avg("total_charges").alias("avg_cost"), F.avg("length_of_stay").alias("avg_stay"))
        .orderBy(F.desc("case_count"), "ccs_diagnosis_description")
        .limit(k)
    )


def costly_diagnoses(d: DataFrame, min_cases: int = 50, k: int = 15) -> DataFrame:
    charged = _present(d, "ccs_diagnosis_description").filter(F.col("total_charges") > 0)
    ranked = (
        charged.groupBy("ccs_diagnosis_description")
        .agg(F.count("*").alias("case_count"), F.avg("total_charges").alias("avg_cost"), F.avg("length_of_stay").alias("avg_stay"))
        .filter(F.col("case_count") >= min_cases)
        .orderBy(F.desc("avg_cost"), "ccs_diagnosis_description")
        .limit(k)
    )
    return with_exact_percentiles(
        ranked,
        charged,
        ["ccs_diagnosis_description"],
        "total_charges",
        {"median_cost": 0.5},
        bounded=True,
    ).orderBy(F.desc("avg_cost"), "ccs_diagnosis_description").limit(k)


def age_profile(d: DataFrame) -> DataFrame:
    groups = (
        _present(d, "age_group", "total_charges", "length_of_stay")
        .groupBy("age_group")
        .agg(
            F.count("*").alias("patient_count"), F.avg("total_charges").alias("avg_charges"), F.avg("length_of_stay").alias("avg_stay")
        )
    )
    return _share_of_all(groups, "patient_count").orderBy(
        rank_of(F.col("age_group"), AGE_ORDER), "age_group"
    )


def gender_profile(d: DataFrame) -> DataFrame:
    extreme = F.col("apr_severity_of_illness_description") == "Extreme"
    return (
        d.filter(F.col("gender") != UNKNOWN_GENDER)
        .groupBy("gender")
        .agg(
            F.count("*").alias("cases"),
            F.avg("total_charges").alias("avg_charges"),
            F.avg("length_of_stay").alias("avg_stay"),
            F.count_if(extreme).alias("extreme_cases"),
        )
        .orderBy(F.desc("cases"), "gender")
    )


def severity_distribution(d: DataFrame) -> DataFrame:
    groups = (
        _present(d, "apr_severity_of_illness_description")
        .groupBy(F.col("apr_severity_of_illness_description").alias("severity"))
        .agg(F.count("*").alias("case_count"), F.avg("total_charges").alias("avg_cost"), F.avg("length_of_stay").alias("avg_stay"))
    )
    return _share_of_all(groups, "case_count").orderBy(
        rank_of(F.col("severity"), SEVERITY_ORDER), "severity"
    )


def mortality_risk(d: DataFrame) -> DataFrame:
    return (
        _present(d, "apr_risk_of_mortality", "total_charges", "length_of_stay")
        .groupBy(F.col("apr_risk_of_mortality").alias("mortality_risk"))
        .agg(
            F.count("*").alias("cases"),
            F.avg("total_charges").alias("avg_charges"),
            F.avg("length_of_stay").alias("avg_stay"),
            F.count_if(F.col("length_of_stay") > 10).alias("long_stay_cases"),
        )
        .orderBy(rank_of(F.col("mortality_risk"), SEVERITY_ORDER), "mortality_risk")
    )


def payment_mix(d: DataFrame, k: int = 20) -> DataFrame:
    paid = _present(d, "payment_typology_1", "type_of_admission", "total_charges").withColumn(
        "primary_payment", F.col("payment_typology_1")
    )
    order = [F.desc("cases"), "type_of_admission", "primary_payment"]
    ranked = (
        paid.groupBy("type_of_admission", "primary_payment")
        .agg(F.count("*").alias("cases"), F.avg("total_charges").alias("avg_charges"))
        .orderBy(*order)
        .limit(k)
    )
    return with_exact_percentiles(
        ranked,
        paid,
        ["type_of_admission", "primary_payment"],
        "total_charges",
        {"median_charges": 0.5},
        bounded=True,
    ).orderBy(*order).limit(k)


def common_procedures(d: DataFrame, k: int = 15) -> DataFrame:
    return (
        _present(d, "total_charges")
        .filter(F.col("ccs_procedure_description") != NO_PROCEDURE)
        .groupBy("ccs_procedure_description")
        .agg(
            F.count("*").alias("procedure_count"),
            F.avg("total_charges").alias("avg_cost"),
            F.avg("length_of_stay").alias("avg_stay"),
        )
        .orderBy(F.desc("procedure_count"), "ccs_procedure_description")
        .limit(k)
    )


def cost_outliers(d: DataFrame, sigmas: float = 3.0, k: int = 20) -> DataFrame:
    """Dearest cases beyond mean + n sigma; the threshold is a scalar subquery, not a join."""
    threshold = (
        d.filter(F.col("total_charges") > 0)
        .agg((F.avg("total_charges") + F.lit(sigmas) * F.stddev_samp("total_charges")).alias("threshold"))
        .scalar()
    )
    return (
        d.filter(F.col("total_charges") > threshold)
        .orderBy(F.desc("total_charges"), "record_id")
        .limit(k)
        .select(
            "hospital_county",
            "ccs_diagnosis_description",
            F.col("total_charges").alias("cost"),
            F.col("length_of_stay").alias("stay"),
            "age_group",
            "apr_severity_of_illness_description",
        )
    )


def county_efficiency(d: DataFrame, min_cases: int = 100) -> DataFrame:
    """Counties rated against the quartiles of all counties."""
    minor = F.col("apr_severity_of_illness_description") == "Minor"
    metrics = (
        _present(d, "total_charges", "length_of_stay")
        .groupBy("hospital_county")
        .agg(
            F.count("*").alias("volume"),
            F.avg("total_charges").alias("avg_cost"),
            F.avg("length_of_stay").alias("avg_stay"),
            F.avg(F.when(minor, 1.0).otherwise(0.0)).alias("minor_rate"),
        )
        .filter(F.col("volume") >= min_cases)
    )
    benchmark = metrics.agg(
        F.struct(
            F.percentile("avg_cost", 0.25).alias("cost_quartile"),
            F.percentile("avg_stay", 0.25).alias("stay_quartile"),
            F.percentile("avg_cost", 0.5).alias("cost_median"),
        ).alias("benchmark")
    ).scalar()
    cheap = F.col("avg_cost") <= benchmark["cost_quartile"]
    short = F.col("avg_stay") <= benchmark["stay_quartile"]
    rating = (
        F.when(cheap & short, "High Efficiency")
        .when(F.col("avg_cost") <= benchmark["cost_median"], "Good Efficiency")
        .otherwise("Needs Improvement")
    )
    return metrics.select(
        "hospital_county",
        "volume",
        "avg_cost",
        "avg_stay",
        "minor_rate",
        rating.alias("efficiency_rating"),
    ).orderBy("avg_cost", "avg_stay", "hospital_county")


def yearly_admissions(d: DataFrame) -> DataFrame:
    return (
        _present(d, "discharge_year")
        .groupBy("discharge_year")
        .agg(
            F.count("*").alias("admissions"), F.avg("total_charges").alias("avg_charges"), F.avg("length_of_stay").alias("avg_stay")
        )
        .orderBy("discharge_year")
    )


def completeness(d: DataFrame) -> DataFrame:
    return completeness_of(d, ["total_charges", "length_of_stay", "hospital_county"])


def group_count(
    d: DataFrame, keys: list[str], numeric: str, above: float, k: int = 10
) -> DataFrame:
    """Group sizes among the rows above a bound, largest first."""
    return (
        d.filter(F.col(numeric) > above)
        .groupBy(*keys)
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), *keys)
        .limit(k)
    )
