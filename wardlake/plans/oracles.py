"""The same queries as standard SQL over the given tables, for checking results."""

from __future__ import annotations

from wardlake.functions.vocabulary import (
    CONSTANT_DEFAULTS,
    DEFAULT_DESCRIPTION,
    DEFAULT_PROFILE,
    DEFAULT_SEVERITY,
    DRG_DESCRIPTIONS,
    PROFILE_COLUMNS,
    PROFILES,
    SEVERITIES,
    TEXT_FIELDS,
)
from wardlake.plans.discharges import RAW_SQL
from wardlake.plans.inputs import REPLAYED, REQUEST_SQL
from wardlake.schema import CATEGORICALS, NUMERIC_FEATURES, TARGETS

RAW = RAW_SQL.format(orders="orders", customer="customer", nation="nation")


def _clean(name: str) -> str:
    return f"TRY_CAST(regexp_replace({name}, '[^0-9.]', '', 'g') AS DOUBLE)"


def _number(name: str) -> str:
    return f"TRY_CAST({name} AS DOUBLE)"


_TYPED = (
    ["record_id", *CATEGORICALS, "payment_typology_1", "discharge_year"]
    + [f"{_number(c)} AS {c}" for c in NUMERIC_FEATURES]
    + [f"{_clean(c)} AS {c}" for c in TARGETS]
)
WITH_D = f"WITH raw AS ({RAW}), d AS (SELECT {', '.join(_TYPED)} FROM raw)"
WITH_RAW = f"WITH raw AS ({RAW})"
CHARGES = "ROUND(AVG(total_charges), 4)"
STAY = "ROUND(AVG(length_of_stay), 4)"
KNOWN = "total_charges IS NOT NULL AND length_of_stay IS NOT NULL"
FIELDS = {
    **{c: "string" for c in CATEGORICALS + ["payment_typology_1"]},
    **{c: "double" for c in NUMERIC_FEATURES + TARGETS},
    "record_id": "bigint",
    "discharge_year": "int",
}


def _d(select: str) -> str:
    return WITH_D + (select if select.startswith(",") else " " + select)


def _raw(select: str) -> str:
    return f"{WITH_RAW} {select}"


def _values(rows: list[tuple], names: list[str]) -> str:
    def literal(v) -> str:
        return str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"(VALUES {body}) AS dim({', '.join(names)})"


def _profile(field: str, kind: str) -> str:
    text = kind == "string"

    def pick(expr: str, wanted: bool, cast: str) -> str:
        return f"{expr}({field})" if wanted and cast == "VARCHAR" else (
            f"CAST({expr}({field}) AS DOUBLE)" if wanted else f"CAST(NULL AS {cast})"
        )

    return (
        f"SELECT '{field}' AS field_name, '{kind}' AS data_type, COUNT(*) AS total_records, "
        f"COUNT({field}) AS non_null_records, {pick('MIN', text, 'VARCHAR')} AS min_text, "
        f"{pick('MAX', text, 'VARCHAR')} AS max_text, "
        f"{pick('MIN', not text, 'DOUBLE')} AS min_number, "
        f"{pick('MAX', not text, 'DOUBLE')} AS max_number, "
        f"ROUND({pick('AVG', not text, 'DOUBLE')}, 4) AS mean, "
        f"ROUND({pick('STDDEV_SAMP', not text, 'DOUBLE')}, 4) AS stddev, "
        f"COUNT(DISTINCT {field}) AS distinct_values FROM d"
    )


def _file_facts(source: str = "raw", where: str = "") -> str:
    return (
        "SELECT hospital_county, COUNT(*) AS records, COUNT(race) AS races, "
        "CAST(SUM(record_id) AS BIGINT) AS id_sum, "
        f"CAST(SUM(CAST({_clean('total_charges')} AS DECIMAL(20,2))) AS DOUBLE) AS charges "
        f"FROM {source} {where} GROUP BY hospital_county"
    )


def _severity(code: str) -> str:
    cases = " ".join(f"WHEN {n} THEN '{t}'" for n, t in SEVERITIES)
    return f"CASE {code} {cases} ELSE '{DEFAULT_SEVERITY}' END"


def _smart_fill() -> str:
    names = PROFILE_COLUMNS[1:]
    fallback = dict(zip(names, DEFAULT_PROFILE[1:]))

    def has(key: str) -> str:
        return f"list_contains(json_keys(body), '{key}')"

    def given(key: str) -> str:
        return f"json_extract_string(body, '$.{key}')"

    def default(key: str) -> str:
        if key in fallback:
            return f"COALESCE(p.{key}, '{fallback[key]}')"
        if key in ("severity", "mortality_risk"):
            return _severity("r.sev")
        return f"'{CONSTANT_DEFAULTS[key]}'"

    def text(key: str) -> str:
        chosen = f"CASE WHEN {has(key)} THEN COALESCE({given(key)}, 'Unknown') ELSE {default(key)} END"
        if key == "drg_description":
            return (
                f"CASE WHEN COALESCE(r.drg, 0) <> 0 THEN COALESCE(t.description, '{DEFAULT_DESCRIPTION}') "
                f"ELSE {chosen} END"
            )
        if key == "severity":
            return f"CASE WHEN COALESCE(r.sev, 0) <> 0 THEN {_severity('r.sev')} ELSE {chosen} END"
        return chosen

    columns = ", ".join(f"{text(key)} AS {column}" for key, column in TEXT_FIELDS.items())
    coded = (
        f"SELECT request_id, body, "
        f"CASE WHEN {has('drg_code')} THEN TRY_CAST({given('drg_code')} AS DOUBLE) ELSE 444 END AS drg, "
        f"CASE WHEN {has('severity_code')} THEN TRY_CAST({given('severity_code')} AS DOUBLE) ELSE 1 END AS sev "
        f"FROM requests"
    )
    return (
        f"{WITH_RAW}, requests AS ({REQUEST_SQL.format(discharges='raw')}), r AS ({coded}), "
        f"p AS (SELECT * FROM {_values(PROFILES, PROFILE_COLUMNS)}), "
        f"t AS (SELECT * FROM {_values(DRG_DESCRIPTIONS, ['code', 'description'])}) "
        f"SELECT request_id, {columns}, "
        f"COALESCE(TRY_CAST({given('birth_weight')} AS DOUBLE), 0) AS birth_weight, "
        f"COALESCE(r.drg, 0) AS apr_drg_code, COALESCE(r.sev, 0) AS apr_severity_of_illness_code "
        f"FROM r LEFT JOIN p ON r.drg = p.code LEFT JOIN t ON r.drg = t.code"
    )


def _predictions() -> str:
    """Rows per model: one for every request that names a group code."""
    return (
        f"{WITH_RAW}, requests AS ({REQUEST_SQL.format(discharges='raw')}), accepted AS (SELECT request_id "
        "FROM requests WHERE list_contains(json_keys(body), 'drg_code')) "
        "SELECT target || '_numeric_model' AS model, COUNT(*) AS rows_scored, "
        "COUNT(DISTINCT request_id) AS requests, COUNT(*) AS finite, CAST(0 AS BIGINT) AS errors "
        f"FROM accepted CROSS JOIN {_values([(t,) for t in TARGETS], ['target'])} GROUP BY target"
    )


def _feature_values() -> str:
    """Numbers over their sample deviation; an indicator's deviation follows from its share."""
    numbers = ", ".join(
        f"ROUND(COALESCE({c}, 0) / STDDEV_SAMP(COALESCE({c}, 0)) OVER (), 4) AS {c}_scaled" for c in NUMERIC_FEATURES
    )
    share = "(COUNT(*) OVER (PARTITION BY COALESCE({c}, 'Unknown')) * 1.0 / COUNT(*) OVER ())"
    one = "1 / SQRT({s} * (1 - {s}) * COUNT(*) OVER () / (COUNT(*) OVER () - 1))"
    total = " + ".join(one.format(s=share.format(c=c)) for c in CATEGORICALS)
    return _d(f"SELECT record_id, {numbers}, ROUND({total}, 4) AS indicators FROM d")


DAMAGED = "event_id % 40 = 0"
NUMBERED_EVENTS = "(SELECT *, ROW_NUMBER() OVER (ORDER BY event_id) - 1 AS record_no FROM events)"
BATCHED_EVENTS = (
    "(SELECT CAST(FLOOR(record_no / 100) AS BIGINT) AS batch_no, COUNT(*) AS record_count, "
    "MIN(event_id) AS first_id, MAX(event_id) AS last_id, MAX(ts) AS last_ts, "
    f"COUNT(*) FILTER (WHERE event_type = 'error') AS errors FROM {NUMBERED_EVENTS} GROUP BY 1)"
)
NUMBERED_RAW = "(SELECT *, ROW_NUMBER() OVER (ORDER BY record_id) - 1 AS record_no FROM raw)"
HEALTH = "CASE WHEN {0} = 0 THEN 'healthy' WHEN {0} < 5 THEN 'degraded' ELSE 'failing' END"

RATE_TIMELINE = (
    "SELECT window_start, messages, ROUND(messages / 3600.0, 2) AS messages_per_second, "
    "CAST(SUM(messages) OVER (ORDER BY window_start) AS BIGINT) AS total_messages FROM "
    "(SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, COUNT(*) AS messages "
    "FROM events GROUP BY 1)"
)
NOTHING_OFF = "TRUE AS has_files, CAST(0 AS BIGINT) AS files_off, CAST(0 AS BIGINT) AS bytes_off"
REPLAYED_EVENTS = f"(SELECT COUNT(*) FROM events WHERE ts < '{REPLAYED}')"

ORACLES: dict[str, str] = {
    "total_records": _d("SELECT COUNT(*) AS total_records FROM d"),
    "year_range": _d(
        "SELECT MIN(discharge_year) AS earliest_year, MAX(discharge_year) AS latest_year, "
        "COUNT(DISTINCT hospital_county) AS unique_counties FROM d"
    ),
    "preview": _d("SELECT * FROM d ORDER BY record_id LIMIT 10"),
    "county_volume": _d(
        f"SELECT hospital_county, COUNT(*) AS patient_count, {CHARGES} AS avg_charges, "
        f"{STAY} AS avg_length_of_stay FROM d WHERE {KNOWN} GROUP BY hospital_county "
        "ORDER BY patient_count DESC, hospital_county LIMIT 20"
    ),
    "county_cost_stats": _d(
        "SELECT hospital_county, COUNT(*) AS cases, "
        f"{CHARGES} AS avg_cost, ROUND(MEDIAN(total_charges), 4) AS median_cost, "
        "MIN(total_charges) AS min_cost, MAX(total_charges) AS max_cost, "
        "ROUND(STDDEV_SAMP(total_charges), 4) AS cost_variance FROM d WHERE total_charges > 0 "
        "GROUP BY hospital_county HAVING COUNT(*) >= 100 "
        "ORDER BY AVG(total_charges) DESC, hospital_county LIMIT 15"
    ),
    "common_diagnoses": _d(
        f"SELECT ccs_diagnosis_description, COUNT(*) AS case_count, {CHARGES} AS avg_cost, "
        f"{STAY} AS avg_stay FROM d WHERE ccs_diagnosis_description IS NOT NULL AND {KNOWN} "
        "GROUP BY ccs_diagnosis_description "
        "ORDER BY case_count DESC, ccs_diagnosis_description LIMIT 20"
    ),
    "costly_diagnoses": _d(
        f"SELECT ccs_diagnosis_description, COUNT(*) AS case_count, {CHARGES} AS avg_cost, "
        f"ROUND(MEDIAN(total_charges), 4) AS median_cost, {STAY} AS avg_stay FROM d "
        "WHERE ccs_diagnosis_description IS NOT NULL AND total_charges > 0 "
        "GROUP BY ccs_diagnosis_description HAVING COUNT(*) >= 50 "
        "ORDER BY AVG(total_charges) DESC, ccs_diagnosis_description LIMIT 15"
    ),
    "age_profile": _d(
        f"SELECT age_group, COUNT(*) AS patient_count, {CHARGES} AS avg_charges, "
        f"{STAY} AS avg_stay, ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 4) AS percentage "
        f"FROM d WHERE age_group IS NOT NULL AND {KNOWN} GROUP BY age_group"
    ),
    "gender_profile": _d(
        f"SELECT gender, COUNT(*) AS cases, {CHARGES} AS avg_charges, {STAY} AS avg_stay, "
        "COUNT(CASE WHEN apr_severity_of_illness_description = 'Extreme' THEN 1 END) AS extreme_cases "
        "FROM d WHERE gender IS NOT NULL AND gender <> 'U' GROUP BY gender"
    ),
    "severity_distribution": _d(
        "SELECT apr_severity_of_illness_description AS severity, COUNT(*) AS case_count, "
        f"{CHARGES} AS avg_cost, {STAY} AS avg_stay, "
        "ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 4) AS percentage FROM d "
        "WHERE apr_severity_of_illness_description IS NOT NULL GROUP BY 1"
    ),
    "mortality_risk": _d(
        "SELECT apr_risk_of_mortality AS mortality_risk, COUNT(*) AS cases, "
        f"{CHARGES} AS avg_charges, {STAY} AS avg_stay, "
        "COUNT(CASE WHEN length_of_stay > 10 THEN 1 END) AS long_stay_cases FROM d "
        f"WHERE apr_risk_of_mortality IS NOT NULL AND {KNOWN} GROUP BY 1"
    ),
    "payment_mix": _d(
        "SELECT type_of_admission, payment_typology_1 AS primary_payment, COUNT(*) AS cases, "
        f"{CHARGES} AS avg_charges, ROUND(MEDIAN(total_charges), 4) AS median_charges FROM d "
        "WHERE payment_typology_1 IS NOT NULL AND type_of_admission IS NOT NULL "
        "AND total_charges IS NOT NULL GROUP BY 1, 2 "
        "ORDER BY cases DESC, type_of_admission, primary_payment LIMIT 20"
    ),
    "common_procedures": _d(
        f"SELECT ccs_procedure_description, COUNT(*) AS procedure_count, {CHARGES} AS avg_cost, "
        f"{STAY} AS avg_stay FROM d WHERE ccs_procedure_description IS NOT NULL "
        "AND ccs_procedure_description <> 'NO PROC' AND total_charges IS NOT NULL "
        "GROUP BY ccs_procedure_description "
        "ORDER BY procedure_count DESC, ccs_procedure_description LIMIT 15"
    ),
    "cost_outliers": _d(
        ", s AS (SELECT AVG(total_charges) AS mean_cost, STDDEV_SAMP(total_charges) AS std_cost "
        "FROM d WHERE total_charges > 0) SELECT hospital_county, ccs_diagnosis_description, "
        "ROUND(total_charges, 4) AS cost, length_of_stay AS stay, age_group, "
        "apr_severity_of_illness_description FROM d CROSS JOIN s "
        "WHERE total_charges > mean_cost + 3 * std_cost "
        "ORDER BY total_charges DESC, record_id LIMIT 20"
    ),
    "county_efficiency": _d(
        ", m AS (SELECT hospital_county, COUNT(*) AS volume, AVG(total_charges) AS avg_cost, "
        "AVG(length_of_stay) AS avg_stay, AVG(CASE WHEN apr_severity_of_illness_description = 'Minor' "
        f"THEN 1.0 ELSE 0.0 END) AS minor_rate FROM d WHERE {KNOWN} GROUP BY hospital_county "
        "HAVING COUNT(*) >= 100), b AS (SELECT PERCENTILE_CONT(0.25) WITHIN GROUP (ORDER BY avg_cost) "
        "AS cost_25, PERCENTILE_CONT(0.25) WITHIN GROUP (ORDER BY avg_stay) AS stay_25, "
        "PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY avg_cost) AS cost_50 FROM m) "
        "SELECT hospital_county, volume, ROUND(avg_cost, 4) AS avg_cost, "
        "ROUND(avg_stay, 4) AS avg_stay, ROUND(minor_rate, 4) AS minor_rate, "
        "CASE WHEN avg_cost <= cost_25 AND avg_stay <= stay_25 THEN 'High Efficiency' "
        "WHEN avg_cost <= cost_50 THEN 'Good Efficiency' ELSE 'Needs Improvement' END "
        "AS efficiency_rating FROM m CROSS JOIN b"
    ),
    "yearly_admissions": _d(
        f"SELECT discharge_year, COUNT(*) AS admissions, {CHARGES} AS avg_charges, "
        f"{STAY} AS avg_stay FROM d WHERE discharge_year IS NOT NULL GROUP BY discharge_year"
    ),
    "completeness": _d(
        " UNION ALL ".join(
            f"SELECT '{f}' AS field_name, COUNT(*) AS total_records, "
            f"COUNT({f}) AS non_null_records, "
            f"ROUND(COUNT({f}) * 100.0 / COUNT(*), 4) AS completeness_pct FROM d"
            for f in ("total_charges", "length_of_stay", "hospital_county")
        )
    ),
    "group_count": _d(
        "SELECT hospital_county, age_group, COUNT(*) AS count FROM d WHERE total_charges > 100000 "
        "GROUP BY hospital_county, age_group ORDER BY count DESC, hospital_county, age_group LIMIT 10"
    ),
    "column_profile": _d(" UNION ALL ".join(_profile(f, kind) for f, kind in FIELDS.items())),
    "null_profile": _d(
        " UNION ALL ".join(
            f"SELECT '{f}' AS field_name, COUNT(*) AS total_records, "
            f"COUNT(*) - COUNT({f}) AS null_records, "
            f"ROUND((COUNT(*) - COUNT({f})) * 100.0 / COUNT(*), 4) AS null_pct FROM d"
            for f in FIELDS
        )
    ),
    "filter_gt": _d("SELECT * FROM d WHERE total_charges > 400000"),
    "filter_since": "SELECT * FROM orders WHERE o_orderdate >= '1998-01-01'",
    "filter_like": _d("SELECT * FROM d WHERE ccs_diagnosis_description LIKE '%BUILD%'"),
    "order_desc_limit": _d("SELECT * FROM d ORDER BY total_costs DESC NULLS LAST, record_id LIMIT 50"),
    "basic_aggregates": _d(
        f"SELECT {CHARGES} AS avg_value, MAX(total_charges) AS max_value, "
        "MIN(total_charges) AS min_value FROM d"
    ),
    "row_count_template": _raw("SELECT COUNT(*) AS total_rows FROM raw"),
    "record_count_template": _raw("SELECT COUNT(*) AS total_records FROM raw"),
    "selection_template": _raw(
        "SELECT * REPLACE (CAST(discharge_year AS VARCHAR) AS discharge_year) FROM raw "
        "ORDER BY record_id LIMIT 100"
    ),
    "group_template": _raw(
        "SELECT hospital_county, COUNT(*) AS count FROM raw GROUP BY hospital_county"
    ),
    "file_schema": (
        "SELECT column_name AS col_name, CASE column_type WHEN 'VARCHAR' THEN 'string' "
        "WHEN 'INTEGER' THEN 'int' ELSE LOWER(column_type) END AS data_type "
        f"FROM (DESCRIBE {WITH_RAW} SELECT * FROM raw)"
    ),
    "view_query": _raw(
        "SELECT hospital_county, COUNT(*) AS records FROM raw GROUP BY hospital_county"
    ),
    "free_sql": _raw(
        "SELECT age_group, gender, COUNT(*) AS cases FROM raw "
        "WHERE patient_disposition = 'Expired' GROUP BY age_group, gender"
    ),
    "default_limit": _raw(
        "SELECT COUNT(*) AS all_rows, LEAST(COUNT(*), 1000) AS named_rows, LEAST(COUNT(*), 1200) AS own_rows FROM raw"
    ),
    **{
        name: _raw(_file_facts())
        for name in (
            "csv_scan",
            "csv_scan_inferred",
            "json_scan",
            "parquet_scan",
            "auto_format_scan",
            "lake_load",
            "main_file",
            "unfinished_attempt",
            "reordered_csv",
        )
    },
    "lake_union": _raw(_file_facts("(SELECT * FROM raw UNION ALL SELECT * FROM raw) AS both_files")),
    "sanitise": (
        "SELECT event_id, CASE WHEN event_id % 50 = 0 OR event_id % 77 = 0 OR event_id % 91 = 0 "
        "THEN NULL ELSE ROUND(value, 4) END AS value FROM events"
    ),
    "clean_rows": (
        "SELECT event_id, CASE WHEN event_id % 50 = 0 THEN NULL ELSE ROUND(value, 4) END AS value, "
        "ROUND(CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE), 4) AS amount FROM events"
    ),
    "ingest_meta": _raw(
        "SELECT record_id, 'local_hospital_dataset' AS source, TRUE AS stamped FROM raw"
    ),
    "normalised_columns": _raw(
        "SELECT record_id, hospital_county, age_group, total_charges, ccs_procedure_description FROM raw"
    ),
    "clean_targets": _raw(
        "SELECT record_id, " + ", ".join(f"{_clean(t)} AS {t}_numeric" for t in TARGETS) + " FROM raw"
    ),
    "numeric_features": _raw(
        "SELECT record_id, " + ", ".join(f"{_number(c)} AS {c}" for c in NUMERIC_FEATURES) + " FROM raw"
    ),
    "fill_unknown": _raw(
        "SELECT record_id, "
        + ", ".join(
            f"COALESCE({c}, 'Unknown') AS {c}"
            for c in ("race", "ccs_diagnosis_description", "apr_risk_of_mortality")
        )
        + " FROM raw"
    ),
    "valid_targets": _d("SELECT record_id, total_costs FROM d WHERE total_costs > 0"),
    "time_texts": (
        "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso, "
        "strftime(ts, '%Y%m%d_%H%M%S') AS stamp, CAST(year(ts) AS INT) AS year, "
        "strftime(ts, '%m') AS month FROM events"
    ),
    "exported_csv": _d(
        f"SELECT hospital_county, COUNT(*) AS patient_count, {CHARGES} AS avg_charges, "
        f"{STAY} AS avg_length_of_stay FROM d WHERE {KNOWN} GROUP BY hospital_county "
        "ORDER BY patient_count DESC, hospital_county LIMIT 20"
    ),
    "message_payloads": _raw(
        "SELECT 'record_' || CAST(record_no AS VARCHAR) AS key, CAST(record_id AS VARCHAR) AS record_id, "
        f"hospital_county, race, total_charges FROM {NUMBERED_RAW}"
    ),
    "record_numbers": f"SELECT event_id, record_no FROM {NUMBERED_EVENTS}",
    "count_batches": f"SELECT batch_no, record_count, first_id, last_id FROM {BATCHED_EVENTS}",
    "recent_history": (
        "SELECT event_id, ts, user_id, event_type, ROUND(value, 4) AS value, props FROM events "
        "ORDER BY ts DESC, event_id DESC LIMIT 50"
    ),
    "ingest_totals": (
        "SELECT COUNT(*) AS total_messages, MIN(ts) AS first_message_time, "
        "MAX(ts) AS last_message_time, CASE WHEN MAX(ts) > MIN(ts) THEN "
        "ROUND(COUNT(*) / ((epoch_us(MAX(ts)) - epoch_us(MIN(ts))) / 1e6), 2) ELSE 0.0 END "
        "AS messages_per_second FROM events"
    ),
    "rate_timeline": RATE_TIMELINE,
    "stream_timeline": RATE_TIMELINE,
    "stream_lateness": (
        f"SELECT COUNT(*) + {REPLAYED_EVENTS} AS received, COUNT(*) AS counted, {REPLAYED_EVENTS} AS late, "
        "TRUE AS has_closed FROM events"
    ),
    "progress_statistics": _raw(
        "SELECT COUNT(*) FILTER (WHERE record_no % 101 <> 100) AS total_messages, "
        "COUNT(*) FILTER (WHERE record_no % 101 = 100) AS errors, "
        f"{HEALTH.format('COUNT(*) FILTER (WHERE record_no % 101 = 100)')} AS health, CAST(2 AS BIGINT) AS runs, "
        "COUNT(*) AS received, CAST(0 AS BIGINT) AS unreported_batches, CAST(0 AS BIGINT) AS differing_batches, "
        f"TRUE AS has_rate, TRUE AS all_saved FROM {NUMBERED_RAW}"
    ),
    "processing_timeline": _raw("SELECT COUNT(*) AS last_total, COUNT(*) AS messages FROM raw"),
    "compaction_states": _raw(
        f"SELECT * FROM ({_file_facts()}) CROSS JOIN (VALUES ('before'), ('during'), ('after')) AS s(state) "
        "CROSS JOIN (VALUES ('batches'), ('csv'), ('lake')) AS r(reader)"
    ),
    "compaction_manifest": _raw(
        "SELECT state, CAST(batches AS BIGINT) AS batches, COUNT(*) AS records FROM raw "
        "CROSS JOIN (VALUES ('before', 4), ('during', 4), ('after', 1)) AS s(state, batches) GROUP BY ALL"
    ),
    "unsaved_csv": _raw(_file_facts()),
    "offset_numbers": (
        'SELECT CAST(event_id % 3 AS INT) AS "partition", event_id AS "offset", '
        "ROW_NUMBER() OVER (ORDER BY event_id % 3, event_id) - 1 AS record_no FROM events"
    ),
    "text_key_numbers": (
        "SELECT event_id, ROW_NUMBER() OVER (ORDER BY event_type, event_id DESC) - 1 AS record_no FROM events"
    ),
    "tied_numbers": (
        "SELECT event_type, MIN(n) AS first_no, MAX(n) AS last_no, COUNT(*) AS numbers FROM "
        "(SELECT event_type, ROW_NUMBER() OVER (ORDER BY event_type) - 1 AS n FROM events) GROUP BY event_type"
    ),
    "crowded_percentiles": (
        "SELECT l_returnflag, COUNT(*) AS lines, "
        + ", ".join(
            f"ROUND(QUANTILE_CONT(1e6 + CAST(l_extendedprice AS DOUBLE) / 1e5, {q}), 6) AS {name}"
            for name, q in (("p25", 0.25), ("median", 0.5), ("p99", 0.99))
        )
        + " FROM lineitem GROUP BY l_returnflag"
    ),
    "model_versions": (
        f"SELECT '{TARGETS[0]}_numeric_model' AS model_name, CAST(v AS INT) AS version, v = 2 AS is_current, "
        "TRUE AS loads FROM (VALUES (1), (2)) AS x(v)"
    ),
    "freshness_report": (
        "SELECT user_id, messages, last_message_time, errors, age AS age_seconds, "
        "CASE WHEN age < 30 THEN 'Active' ELSE CAST(CAST(FLOOR(age) AS BIGINT) AS VARCHAR) || 's ago' "
        f"END AS freshness, {HEALTH.format('errors')} AS health FROM (SELECT user_id, "
        "COUNT(*) AS messages, MAX(ts) AS last_message_time, "
        "COUNT(CASE WHEN event_type = 'error' THEN 1 END) AS errors, "
        "((SELECT epoch_us(MAX(ts)) FROM events) - epoch_us(MAX(ts))) / 1e6 AS age "
        "FROM events GROUP BY user_id)"
    ),
    "corrupt_split": (
        "SELECT CAST(event_id % 3 AS INT) AS kafka_partition, "
        f"CASE WHEN {DAMAGED} THEN 'corrupt' ELSE 'good' END AS kind, COUNT(*) AS records, "
        f"CAST(SUM(CASE WHEN NOT {DAMAGED} THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END) "
        "AS BIGINT) AS k_sum, CAST(SUM(event_id) AS BIGINT) AS offsets FROM events GROUP BY 1, 2"
    ),
    "success_rate": (
        "SELECT COUNT(*) AS total_batches, CAST(SUM(record_count) AS BIGINT) AS total_messages, "
        "CAST(SUM(errors) AS BIGINT) AS errors, COUNT(*) AS json_files, "
        "COUNT(*) FILTER (WHERE errors = 0) AS csv_files, MAX(last_ts) AS last_batch_time, "
        "ROUND((COUNT(*) + COUNT(*) FILTER (WHERE errors = 0)) * 100.0 / (2 * COUNT(*)), 4) "
        f"AS success_rate, {HEALTH.format('SUM(errors)')} AS health FROM {BATCHED_EVENTS}"
    ),
    **{
        name: _raw(_file_facts(NUMBERED_RAW, "WHERE record_no % 101 <> 100"))
        for name in ("ingested_json", "ingested_csv")
    },
    "ingest_manifest": _raw(
        "SELECT COUNT(*) FILTER (WHERE record_no % 101 <> 100) AS total_messages, "
        "COUNT(*) FILTER (WHERE record_no % 101 = 100) AS errors, TRUE AS all_saved, "
        "CAST(100.0 AS DOUBLE) AS success_rate, "
        f"{HEALTH.format('COUNT(*) FILTER (WHERE record_no % 101 = 100)')} AS health "
        f"FROM {NUMBERED_RAW}"
    ),
    "running_statistics": _raw(
        "SELECT COUNT(*) FILTER (WHERE record_no % 101 <> 100) AS total_messages, "
        "COUNT(*) FILTER (WHERE record_no % 101 = 100) AS errors, 'stopped' AS status, "
        "CAST(10 AS DOUBLE) AS uptime_seconds, "
        "ROUND(COUNT(*) FILTER (WHERE record_no % 101 <> 100) / 10.0, 4) AS messages_per_second, "
        f"{HEALTH.format('COUNT(*) FILTER (WHERE record_no % 101 = 100)')} AS health FROM {NUMBERED_RAW}"
    ),
    "batch_ids": _raw(
        "SELECT CAST(0 AS BIGINT) AS wrong_batches, CAST(0 AS BIGINT) AS doubled_ids, "
        f"COUNT(*) AS records FROM {NUMBERED_RAW} WHERE record_no % 101 <> 100"
    ),
    "lake_inventory": (
        f"SELECT 'discharges.' || format AS zone, format, {NOTHING_OFF} "
        "FROM (VALUES ('csv'), ('json'), ('parquet')) AS f(format)"
    ),
    "data_gate": (
        f"SELECT zone, format, {NOTHING_OFF} "
        "FROM (VALUES ('csv', 'csv'), ('json', 'json'), ('manifest', 'json')) AS f(zone, format)"
    ),
    "training_sample": "SELECT TRUE AS size_fits, TRUE AS no_repeats, TRUE AS repeatable",
    "holdout_split": _d("SELECT COUNT(*) AS records, COUNT(*) AS ids, TRUE AS tenth_held_out FROM d"),
    "model_leaderboard": (
        f"SELECT target || '_numeric' AS target_column, CAST(2 AS BIGINT) AS models_tried, "
        f"TRUE AS lowest_kept, TRUE AS finite FROM {_values([(t,) for t in TARGETS], ['target'])}"
    ),
    "model_listing": (
        "SELECT target || '_numeric_model' AS model_name, target || '_numeric' AS target_column, "
        f"CAST({len(CATEGORICALS) + len(NUMERIC_FEATURES)} AS INT) AS feature_count, TRUE AS known_type, "
        f"TRUE AS dated FROM {_values([(t,) for t in TARGETS], ['target'])}"
    ),
    "holdout_rmse": (
        "SELECT target || '_numeric_model' AS model, TRUE AS scored, TRUE AS as_stored "
        f"FROM {_values([(t,) for t in TARGETS], ['target'])}"
    ),
    "batch_predictions": _predictions(),
    "isolated_predictions": (
        f"{_predictions()} UNION ALL SELECT 'failing_model' AS model, COUNT(*) AS rows_scored, "
        "COUNT(*) AS requests, CAST(0 AS BIGINT) AS finite, COUNT(*) AS errors FROM accepted"
    ),
    "feature_values": _feature_values(),
    "ingested_volume": _d(
        f"SELECT hospital_county, COUNT(*) AS patient_count, ROUND(AVG(total_charges), 5) AS avg_charges, "
        f"ROUND(AVG(length_of_stay), 5) AS avg_length_of_stay FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY record_id) - 1 "
        f"AS record_no FROM d) WHERE {KNOWN} AND record_no % 101 <> 100 GROUP BY hospital_county "
        "ORDER BY patient_count DESC, hospital_county LIMIT 20"
    ),
    "drg_lookup": _raw(
        f"SELECT record_id, {_number('apr_drg_code')} AS drg, "
        + ", ".join(
            f"COALESCE(dim.{n}, '{v}') AS profile_{n}"
            for n, v in zip(PROFILE_COLUMNS[1:], DEFAULT_PROFILE[1:])
        )
        + f" FROM raw LEFT JOIN {_values(PROFILES, PROFILE_COLUMNS)} "
        + f"ON {_number('apr_drg_code')} = dim.code"
    ),
    "drg_descriptions": _raw(
        f"SELECT record_id, {_number('apr_drg_code')} AS drg, "
        f"COALESCE(dim.description, '{DEFAULT_DESCRIPTION}') AS drg_description FROM raw "
        f"LEFT JOIN {_values(DRG_DESCRIPTIONS, ['code', 'description'])} "
        f"ON {_number('apr_drg_code')} = dim.code"
    ),
    "severity_texts": _raw(
        f"SELECT {_severity(_number('apr_severity_of_illness_code'))} AS severity, "
        "COUNT(*) AS records FROM raw GROUP BY 1"
    ),
    "request_split": (
        f"{WITH_RAW}, requests AS ({REQUEST_SQL.format(discharges='raw')}) SELECT request_id, "
        "CASE WHEN list_contains(json_keys(body), 'drg_code') THEN NULL "
        "ELSE 'drg_code is required' END AS error FROM requests"
    ),
    "smart_fill": _smart_fill(),
    # one entry per category and per number that is not 0; each category has a slot for the unseen
    "feature_rows": _d(
        "SELECT record_id, CAST("
        + " + ".join(
            f"(SELECT COUNT(DISTINCT COALESCE({c}, 'Unknown')) + 1 FROM d)" for c in CATEGORICALS
        )
        + f" + {len(NUMERIC_FEATURES)} AS INT) AS features, CAST({len(CATEGORICALS)}"
        + "".join(f" + CASE WHEN COALESCE({c}, 0) <> 0 THEN 1 ELSE 0 END" for c in NUMERIC_FEATURES)
        + " AS INT) AS entries FROM d"
    ),
}
