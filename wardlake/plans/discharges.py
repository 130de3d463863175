"""The discharge relation: one raw text row per order, and its typed, cleaned form.

The raw relation carries the faults real discharge files have: currency signs, the literal
'NULL', open-ended stays such as '120 +', missing categories and extreme charges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.functions.cleaning import clean_numeric, to_double
from wardlake.schema import NUMERIC_FEATURES, TARGETS

# Portable text; {orders}, {customer} and {nation} are the three input relations.
RAW_SQL = """
SELECT
  o.o_orderkey AS record_id,
  n.n_name AS hospital_county,
  CAST(1000 + o.o_custkey % 200 AS VARCHAR(16)) AS operating_certificate_number,
  CASE o.o_custkey % 5 WHEN 0 THEN '0 to 17' WHEN 1 THEN '18 to 29' WHEN 2 THEN '30 to 49'
       WHEN 3 THEN '50 to 69' ELSE '70 or Older' END AS age_group,
  CASE WHEN o.o_orderkey % 50 = 0 THEN 'U' WHEN o.o_orderkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
  CASE o.o_custkey % 4 WHEN 0 THEN 'White' WHEN 1 THEN 'Black/African American'
       WHEN 2 THEN 'Other Race' ELSE NULL END AS race,
  CASE WHEN o.o_custkey % 3 = 0 THEN 'Spanish/Hispanic' ELSE 'Not Span/Hispanic' END AS ethnicity,
  CASE o.o_orderkey % 4 WHEN 0 THEN 'Emergency' WHEN 1 THEN 'Elective' WHEN 2 THEN 'Urgent'
       ELSE 'Newborn' END AS type_of_admission,
  CASE WHEN o.o_orderkey % 7 = 0 THEN 'Expired' ELSE 'Home or Self Care' END AS patient_disposition,
  CASE WHEN o.o_orderkey % 61 = 0 THEN NULL ELSE 'Diagnosis ' || c.c_mktsegment END
    AS ccs_diagnosis_description,
  CASE WHEN o.o_orderkey % 3 = 0 THEN 'NO PROC' WHEN o.o_orderkey % 67 = 0 THEN NULL
       ELSE 'Procedure ' || CAST(o.o_orderkey % 20 AS VARCHAR(16)) END AS ccs_procedure_description,
  CASE o.o_orderkey % 6 WHEN 0 THEN '753' WHEN 1 THEN '141' WHEN 2 THEN '194' WHEN 3 THEN '444'
       WHEN 4 THEN '540' ELSE '999' END AS apr_drg_code,
  CASE o.o_orderkey % 6 WHEN 0 THEN 'Bipolar disorders' WHEN 1 THEN 'Asthma'
       WHEN 2 THEN 'Simple pneumonia' WHEN 3 THEN 'Other digestive system diagnoses'
       WHEN 4 THEN 'Cesarean delivery' ELSE NULL END AS apr_drg_description,
  CASE SUBSTRING(o.o_orderpriority, 1, 1) WHEN '1' THEN '4' WHEN '2' THEN '3' WHEN '3' THEN '2'
       WHEN '4' THEN '1' ELSE NULL END AS apr_severity_of_illness_code,
  CASE SUBSTRING(o.o_orderpriority, 1, 1) WHEN '1' THEN 'Extreme' WHEN '2' THEN 'Major'
       WHEN '3' THEN 'Moderate' WHEN '4' THEN 'Minor' ELSE NULL END
    AS apr_severity_of_illness_description,
  CASE (o.o_orderkey + o.o_custkey) % 5 WHEN 0 THEN 'Minor' WHEN 1 THEN 'Moderate'
       WHEN 2 THEN 'Major' WHEN 3 THEN 'Extreme' ELSE NULL END AS apr_risk_of_mortality,
  CASE WHEN o.o_orderkey % 3 = 0 THEN 'Medical' ELSE 'Surgical' END AS apr_medical_surgical_description,
  CASE o.o_orderstatus WHEN 'F' THEN 'Medicare' WHEN 'O' THEN 'Private Health Insurance'
       ELSE 'Medicaid' END AS payment_typology_1,
  CAST(EXTRACT(YEAR FROM o.o_orderdate) AS INT) AS discharge_year,
  CASE WHEN o.o_orderkey % 4 = 3 THEN CAST(2500 + o.o_orderkey % 2000 AS VARCHAR(16)) ELSE NULL END
    AS birth_weight,
  CASE WHEN o.o_orderkey % 53 = 0 THEN NULL WHEN o.o_orderkey % 997 = 1 THEN '120 +'
       ELSE CAST(1 + o.o_orderkey % 14 AS VARCHAR(16)) END AS length_of_stay,
  CASE WHEN o.o_orderkey % 97 = 0 THEN NULL WHEN o.o_orderkey % 89 = 0 THEN 'NULL'
       ELSE '$' || CAST(CAST(o.o_totalprice * CASE WHEN o.o_orderkey % 211 = 0 THEN 20 ELSE 1 END
         AS DECIMAL(14,2)) AS VARCHAR(24)) END AS total_charges,
  CASE WHEN o.o_orderkey % 101 = 0 THEN NULL
       ELSE CAST(CAST(o.o_totalprice * 0.4 AS DECIMAL(14,2)) AS VARCHAR(24)) END AS total_costs
FROM {orders} o
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_discharges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text rows. Join sides are left to the optimiser, which broadcasts by measured size."""
    return spark.sql(
        RAW_SQL,
        orders=table(spark, sf_dir, "orders"),
        customer=table(spark, sf_dir, "customer"),
        nation=table(spark, sf_dir, "nation"),
    )


def to_processed(raw: DataFrame) -> DataFrame:
    """Typed relation: targets stripped of stray signs, codes and weights cast."""
    types = dict(raw.dtypes)
    cleaned = {
        name: clean_numeric(F.col(name)) if types[name] == "string" else to_double(F.col(name))
        for name in TARGETS
        if name in types
    }
    cleaned |= {name: to_double(F.col(name)) for name in NUMERIC_FEATURES if name in types}
    if "discharge_year" in types:
        cleaned["discharge_year"] = F.col("discharge_year").try_cast("int")
    return raw.withColumns(cleaned)


def discharges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_processed(raw_discharges(spark, sf_dir))
