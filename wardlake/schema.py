"""Schemas and fixed vocabularies of the discharge relation."""

from __future__ import annotations

from pyspark.sql import types as T

CATEGORICALS = [
    "age_group",
    "gender",
    "race",
    "ethnicity",
    "type_of_admission",
    "patient_disposition",
    "ccs_diagnosis_description",
    "ccs_procedure_description",
    "apr_drg_description",
    "apr_medical_surgical_description",
    "apr_severity_of_illness_description",
    "apr_risk_of_mortality",
    "hospital_county",
    "operating_certificate_number",
]
NUMERIC_FEATURES = ["birth_weight", "apr_drg_code", "apr_severity_of_illness_code"]
TARGETS = ["length_of_stay", "total_costs", "total_charges"]

RAW_COLUMNS = [
    "record_id",
    *CATEGORICALS,
    *NUMERIC_FEATURES,
    "payment_typology_1",
    "discharge_year",
    *TARGETS,
]

# Raw zone: every field is text apart from the record id, so no file needs inference.
RAW_SCHEMA = T.StructType(
    [
        T.StructField(name, T.LongType() if name == "record_id" else T.StringType())
        for name in RAW_COLUMNS
    ]
)

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("error_count", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("json_path", T.StringType()),
        T.StructField("csv_path", T.StringType()),
        T.StructField("csv_saved", T.BooleanType()),
        T.StructField("data_source", T.StringType()),
        T.StructField("schema_version", T.StringType()),
    ]
)

# Display order of the categories.
AGE_ORDER = ["0 to 17", "18 to 29", "30 to 49", "50 to 69", "70 or Older"]
SEVERITY_ORDER = ["Minor", "Moderate", "Major", "Extreme"]

# Literals the data and the ingest metadata use.
UNKNOWN = "Unknown"
UNKNOWN_GENDER = "U"
NO_PROCEDURE = "NO PROC"
DATA_SOURCE = "kafka-stream"
ROW_SOURCE = "local_hospital_dataset"
SCHEMA_VERSION = "1.0"
