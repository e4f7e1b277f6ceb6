"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

_HOSPITAL = """
hospital AS (
  SELECT
    'E' || o_orderkey AS event_id,
    'P' || o_custkey AS patient_id,
    CASE WHEN o_orderkey % 97 = 0 THEN 'X' WHEN o_custkey % 3 = 0 THEN 'M'
         WHEN o_custkey % 3 = 1 THEN 'F' ELSE 'O' END AS patient_gender,
    CASE WHEN o_orderkey % 101 = 0 THEN DATE '2030-01-01'
         ELSE DATE '1950-01-01' + CAST(o_custkey % 15000 AS INTEGER) END AS patient_dob,
    'INS' || c_nationkey AS insurance_id,
    n_name AS insurance_name,
    c_mktsegment AS department,
    'D' || (o_orderkey % 50) AS doctor_id,
    'B' || (o_orderkey % 100) AS bed_id,
    o_orderpriority AS bed_type,
    'H' || (n_regionkey + 1) AS hospital_id,
    o_orderdate + (o_orderkey % 24) * INTERVAL 1 HOUR AS admission_time,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL
         WHEN o_orderkey % 103 = 0
           THEN o_orderdate + (o_orderkey % 24) * INTERVAL 1 HOUR - INTERVAL 1 DAY
         ELSE o_orderdate + (o_orderkey % 24) * INTERVAL 1 HOUR
              + (o_orderkey % 15) * INTERVAL 1 DAY + (o_orderkey % 7) * INTERVAL 1 HOUR
    END AS discharge_time,
    CAST(floor(o_totalprice) AS BIGINT) AS billed_amount,
    CASE WHEN o_orderkey % 107 = 0 THEN CAST(floor(o_totalprice) AS BIGINT) + 1
         ELSE CAST(floor(o_totalprice) AS BIGINT) - o_orderkey % 1000 END AS approved_amount,
    CASE o_orderstatus WHEN 'F' THEN 'APPROVED' WHEN 'O' THEN 'REJECTED'
                       WHEN 'P' THEN 'PENDING' END AS claim_status,
    o_orderkey AS n
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""

_CLEAN = _HOSPITAL + """,
clean AS (
  SELECT * EXCLUDE (n) FROM hospital
  WHERE patient_gender IN ('M', 'F', 'O') AND patient_dob <= DATE '1998-07-01'
    AND (discharge_time IS NULL OR admission_time <= discharge_time)
    AND billed_amount >= approved_amount
),
insurers AS (SELECT DISTINCT insurance_id, insurance_name FROM clean),
claims AS (
  SELECT b.claim_status, i.insurance_name
  FROM clean b LEFT JOIN insurers i ON i.insurance_id = b.insurance_id
)"""

_DEVICE = """
device AS (
  SELECT 'H' || l_suppkey AS hospital_id, 'DEV' || l_partkey AS device_id, p_type AS device_type,
         CAST(CAST(l_quantity AS INTEGER) + l_suppkey % 40 AS INTEGER) AS total_units,
         CAST(l_quantity AS INTEGER) AS in_use_units,
         strftime(l_shipdate, '%Y-M%m') AS week, l_partkey AS n
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""

_PHARMA = """
pharma AS (
  SELECT 'MED' || l_partkey AS medicine_id, p_name AS medicine_name, p_type AS category,
         'H' || l_suppkey AS hospital_id, CAST(20 * q AS BIGINT) AS total_stock,
         CAST(2 * q * (l_partkey % 12) AS BIGINT) AS issued_stock, d AS expiry_date, l_partkey AS n
  FROM (SELECT l_partkey, l_suppkey, SUM(CAST(l_quantity AS INTEGER)) AS q,
               CAST(MAX(l_shipdate) AS DATE) AS d
        FROM lineitem GROUP BY l_partkey, l_suppkey)
  JOIN part ON l_partkey = p_partkey
)"""

_VALID = _PHARMA + """,
valid AS (
  SELECT * EXCLUDE (n), total_stock - issued_stock AS available_stock, 'VALID' AS expiry_status
  FROM pharma
  WHERE total_stock >= 0 AND issued_stock >= 0 AND issued_stock <= total_stock
    AND (expiry_date IS NULL OR expiry_date >= DATE '1998-07-01')
),
stocked AS (
  SELECT f.hospital_id, f.medicine_id, d.medicine_name, d.category, f.total_stock,
         f.available_stock, f.expiry_date
  FROM valid f JOIN (SELECT DISTINCT medicine_id, medicine_name, category FROM valid) d
    ON d.medicine_id = f.medicine_id
)"""

_FINANCE = _CLEAN + """,
finance AS (
  SELECT CAST(date_trunc('week', a.admission_time) AS DATE) AS week_start_date, b.insurance_id,
         i.insurance_name, COUNT(*) AS claims, CAST(SUM(b.billed_amount) AS BIGINT) AS billed,
         CAST(SUM(b.approved_amount) AS BIGINT) AS approved
  FROM clean b JOIN clean a ON a.event_id = b.event_id
  LEFT JOIN insurers i ON i.insurance_id = b.insurance_id
  WHERE b.claim_status = 'APPROVED' GROUP BY 1, 2, 3
),
gold_finance_weekly AS (
  SELECT week_start_date, insurance_id, insurance_name, claims AS total_claims,
         CAST(billed AS DOUBLE) AS total_billed_amount,
         CAST(approved AS DOUBLE) AS total_approved_amount,
         CAST(billed - approved AS DOUBLE) AS revenue_leakage_amount,
         CAST((20000 * CAST(approved AS HUGEINT) + billed) // (2 * billed) AS DOUBLE)
           / CAST(100 AS DOUBLE) AS approval_percentage,
         'January' AS report_month
  FROM finance
)"""

_CLAIMS = _CLEAN + """,
gold_claim_status_summary AS (
  SELECT insurance_name, claim_status, COUNT(*) AS claim_count, 'January' AS report_month
  FROM claims GROUP BY insurance_name, claim_status
)"""

_REJECTED = _CLEAN + """,
gold_rejected_claims AS (
  SELECT insurance_name, COUNT(*) AS rejected_claim_count, 'January' AS report_month
  FROM claims WHERE claim_status = 'REJECTED' GROUP BY insurance_name
)"""

_ADMISSIONS = _CLEAN + """,
gold_weekly_admissions AS (
  SELECT CAST(date_trunc('week', admission_time) AS DATE) AS week_start_date,
         COUNT(*) AS total_admissions, 'January' AS report_month
  FROM clean GROUP BY 1
)"""

_DEVICES = _DEVICE + """,
units AS (
  SELECT u.hospital_id, d.device_type, CAST(SUM(total_units) AS BIGINT) AS total_units,
         CAST(SUM(in_use_units) AS BIGINT) AS in_use_units,
         CAST(SUM(total_units - in_use_units) AS BIGINT) AS available_units
  FROM device u JOIN (SELECT DISTINCT device_id, device_type, hospital_id FROM device) d
    ON d.device_id = u.device_id AND d.hospital_id = u.hospital_id
  GROUP BY u.hospital_id, d.device_type
),
gold_device_availability AS (
  SELECT *, CASE WHEN total_units <> 0
                 THEN CAST(in_use_units AS DOUBLE) / CAST(total_units AS DOUBLE) * 100
            END AS utilization_pct, 'January' AS report_month
  FROM units
)"""

_STOCK = _VALID + """,
gold_medicine_availability AS (
  SELECT hospital_id, medicine_name, category, available_stock, expiry_date,
         'January' AS report_month
  FROM stocked
),
alerts AS (
  SELECT *, CASE WHEN available_stock < 200 THEN 'CRITICAL' WHEN available_stock < 500 THEN 'LOW'
                 ELSE 'ADEQUATE' END AS stock_alert_level
  FROM gold_medicine_availability
)"""

# Landing text with the defects of the gate queries.
_HOSPITAL_DEFECTS = _HOSPITAL + """,
defective AS (
  SELECT CASE WHEN n % 79 <> 0 THEN insurance_id END AS insurance_id,
         CASE WHEN n % 79 <> 0 THEN CASE WHEN n % 71 = 0 THEN '31/12/1980'
                                         ELSE CAST(patient_dob AS VARCHAR) END END AS patient_dob,
         CASE WHEN n % 73 = 0 THEN 'Male' ELSE patient_gender END AS patient_gender,
         CASE WHEN n % 89 = 0 THEN 'bad' ELSE CAST(billed_amount AS VARCHAR) END AS billed_amount,
         CASE WHEN n % 83 = 0 THEN '12.5' ELSE CAST(approved_amount AS VARCHAR)
         END AS approved_amount,
         CASE WHEN n % 71 = 0 THEN '31/12/1980' ELSE CAST(admission_time AS VARCHAR) END AS admission_time,
         CASE WHEN n % 71 = 0 THEN '31/12/1980' ELSE CAST(discharge_time AS VARCHAR) END AS discharge_time
  FROM hospital
)"""

_DEVICE_DEFECTS = _DEVICE + """,
defective AS (
  SELECT CASE WHEN n % 79 <> 0 THEN hospital_id END AS hospital_id,
         CASE WHEN n % 79 <> 0 THEN device_id END AS device_id,
         CASE WHEN n % 89 = 0 THEN 'bad' ELSE CAST(total_units AS VARCHAR) END AS total_units,
         CASE WHEN n % 83 = 0 THEN '12.5' ELSE CAST(in_use_units AS VARCHAR) END AS in_use_units
  FROM device
)"""

_PHARMA_DEFECTS = _PHARMA + """,
defective AS (
  SELECT CASE WHEN n % 79 <> 0 THEN hospital_id END AS hospital_id,
         CASE WHEN n % 79 <> 0 THEN medicine_id END AS medicine_id,
         CASE WHEN n % 89 = 0 THEN 'bad' ELSE CAST(total_stock AS VARCHAR) END AS total_stock,
         CASE WHEN n % 83 = 0 THEN '12.5' ELSE CAST(issued_stock AS VARCHAR) END AS issued_stock,
         CASE WHEN n % 71 = 0 THEN '31/12/1980' ELSE CAST(expiry_date AS VARCHAR) END AS expiry_date
  FROM pharma
)"""

_DEFECTS = {
    "Hospital": _HOSPITAL_DEFECTS, "Device": _DEVICE_DEFECTS, "Pharma": _PHARMA_DEFECTS,
}

# (check, column, predicate of a violating row), in the order of the gate.
_NULLS = {
    "Hospital": ("insurance_id", "billed_amount", "approved_amount", "patient_dob"),
    "Device": ("hospital_id", "device_id"),
    "Pharma": ("hospital_id", "medicine_id"),
}
_LENGTHS = {"Hospital": ("patient_gender", 1), "Device": ("device_id", 6), "Pharma": ("medicine_id", 6)}
_INTEGERS = {
    "Hospital": ("billed_amount", "approved_amount"),
    "Device": ("total_units", "in_use_units"),
    "Pharma": ("total_stock", "issued_stock"),
}


_DATES = {"Hospital": ("patient_dob",), "Device": (), "Pharma": ("expiry_date",)}
_TIMES = {"Hospital": ("admission_time", "discharge_time"), "Device": (), "Pharma": ()}


def _not_an_int(column: str) -> str:
    return f"NOT regexp_full_match({column}, '-?[0-9]+')"


def _number(column: str) -> str:
    return f"CASE WHEN regexp_full_match({column}, '-?[0-9]+') THEN CAST({column} AS BIGINT) END"


def _gate(source: str) -> list[tuple[str, str, str]]:
    column, limit = _LENGTHS[source]
    return [
        *[("not_null", c, f"{c} IS NULL") for c in _NULLS[source]],
        ("max_length", column, f"length({column}) > {limit}"),
        *[("castable_int", c, _not_an_int(c)) for c in _INTEGERS[source]],
        *[("readable_date", c, f"{c} IS NOT NULL AND TRY_CAST({c} AS DATE) IS NULL") for c in _DATES[source]],
        *[("readable_time", c, f"{c} IS NOT NULL AND TRY_CAST({c} AS TIMESTAMP) IS NULL") for c in _TIMES[source]],
    ]


_ROW_RULES = [
    ("gender", "patient_gender", "patient_gender NOT IN ('M', 'F', 'O')"),
    ("dob", "patient_dob", "patient_dob > DATE '1998-07-01'"),
    ("admission_before_discharge", "admission_time", "admission_time > discharge_time"),
]
_TEXT_RULES = [
    _ROW_RULES[0],
    ("dob", "patient_dob", "TRY_CAST(patient_dob AS DATE) > DATE '1998-07-01'"),
    ("admission_before_discharge", "admission_time",
     "TRY_CAST(admission_time AS TIMESTAMP) > TRY_CAST(discharge_time AS TIMESTAMP)"),
]
_BILLED_TEXT = ("at_least", "billed_amount", f"{_number('billed_amount')} < {_number('approved_amount')}")
_BILLED = ("at_least", "billed_amount", "billed_amount < approved_amount")


def _report(ctes: str, table: str, checks: list[tuple[str, str, str]]) -> str:
    rows = " UNION ALL ".join(
        f"""SELECT '{check}' AS "check", '{column}' AS "column",
                   COUNT(*) FILTER (WHERE {predicate}) AS violations FROM {table}"""
        for check, column, predicate in checks
    )
    return f"WITH {ctes} SELECT *, violations = 0 AS passed FROM ({rows})"


def _all_sources(check: str) -> str:
    parts = []
    for source, ctes in _DEFECTS.items():
        checks = [c for c in _gate(source) if c[0] == check]
        parts.append(
            f"""SELECT "column", violations, passed, '{source}' AS source
                FROM ({_report(ctes, 'defective', checks)})"""
        )
    return " UNION ALL ".join(parts)


def _text(ctes: str, table: str, columns: str) -> str:
    cast = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns.split())
    return f"WITH {ctes} SELECT {cast} FROM {table}"


_HOSPITAL_COLUMNS = (
    "event_id patient_id patient_gender patient_dob insurance_id insurance_name department "
    "doctor_id bed_id bed_type hospital_id admission_time discharge_time billed_amount "
    "approved_amount claim_status"
)
_PHARMA_COLUMNS = (
    "medicine_id medicine_name category hospital_id total_stock issued_stock expiry_date"
)
_DEVICE_COLUMNS = "hospital_id device_id device_type total_units in_use_units week"

_WEEK_NUMBER = (
    "CAST((dayofyear(week_start_date) + dayofweek(date_trunc('year', week_start_date)) - 1) // 7"
    " + 1 AS INTEGER)"
)

_BILLING = """
  SELECT event_id AS admission_id, insurance_id, billed_amount, approved_amount, claim_status
  FROM clean"""

_FINANCE_SUMMARY = f"""
  SELECT week_start_date, {_WEEK_NUMBER} AS week_number, insurance_id, insurance_name, total_claims,
         total_billed_amount AS total_billed, total_approved_amount AS total_approved,
         revenue_leakage_amount AS revenue_leakage, approval_percentage, report_month
  FROM gold_finance_weekly"""


def _distinct(ctes: str, table: str, columns: str) -> str:
    return f"WITH {ctes} SELECT DISTINCT {columns} FROM {table}"


def _duplicates(table: str, name: str, keys: str) -> str:
    return f"""
  SELECT '{name}' AS name, '{keys}' AS key, COUNT(*) AS duplicate_keys,
         CAST(COALESCE(SUM(c - 1), 0) AS BIGINT) AS surplus_rows
  FROM (SELECT COUNT(*) AS c FROM {table} GROUP BY {keys} HAVING COUNT(*) > 1)"""


_DUPLICATES = " UNION ALL ".join([
    _duplicates("hospital", "Hospital", "event_id"),
    _duplicates("device", "Device", "hospital_id,device_id,week"),
    _duplicates("pharma", "Pharma", "hospital_id,medicine_id"),
    _duplicates(
        "(SELECT DISTINCT medicine_id, medicine_name, category FROM valid)",
        "dim_medicine", "medicine_id",
    ),
    _duplicates(
        "(SELECT DISTINCT device_id, device_type, hospital_id FROM device)",
        "dim_device", "device_id,hospital_id",
    ),
    _duplicates(
        "(SELECT DISTINCT insurance_id, insurance_name FROM clean)", "dim_insurance", "insurance_id"
    ),
    _duplicates(
        "(SELECT DISTINCT patient_id, patient_gender, patient_dob, insurance_id FROM clean)",
        "dim_patient", "patient_id",
    ),
    _duplicates(
        "(SELECT DISTINCT doctor_id, department, hospital_id FROM clean)", "dim_doctor", "doctor_id"
    ),
    _duplicates("(SELECT DISTINCT bed_id, bed_type, hospital_id FROM clean)", "dim_bed", "bed_id"),
])

# Every table a full run writes, with its row count.
_ALL = ", ".join([_FINANCE, _DEVICES, _VALID])
_RAW_COUNTS = """
  SELECT 'Hospital' AS source, COUNT(*) AS record_count FROM hospital
  UNION ALL SELECT 'Device', COUNT(*) FROM device
  UNION ALL SELECT 'Pharma', COUNT(*) FROM pharma"""
_SILVER_COUNTS = """
  SELECT 'Hospital' AS source, COUNT(*) AS record_count FROM clean
  UNION ALL SELECT 'Device', COUNT(*) FROM device
  UNION ALL SELECT 'Pharma', COUNT(*) FROM valid"""
_REJECT_COUNTS = """
  SELECT 'Hospital' AS source, (SELECT COUNT(*) FROM hospital) - (SELECT COUNT(*) FROM clean) AS record_count
  UNION ALL SELECT 'Pharma', (SELECT COUNT(*) FROM pharma) - (SELECT COUNT(*) FROM valid)"""
_GOLD_COUNTS = """
  SELECT 'gold_medicine_availability' AS source, COUNT(*) AS record_count FROM stocked
  UNION ALL SELECT 'gold_device_availability', COUNT(*) FROM gold_device_availability
  UNION ALL SELECT 'gold_finance_weekly', COUNT(*) FROM gold_finance_weekly
  UNION ALL SELECT 'gold_weekly_admissions',
    COUNT(DISTINCT date_trunc('week', admission_time)) FROM clean
  UNION ALL SELECT 'gold_claim_status_summary',
    COUNT(*) FROM (SELECT DISTINCT insurance_name, claim_status FROM claims)
  UNION ALL SELECT 'gold_rejected_claims',
    COUNT(DISTINCT insurance_name) FROM claims WHERE claim_status = 'REJECTED'
  UNION ALL SELECT 'gold_patient_status', COUNT(DISTINCT discharge_time IS NULL) FROM clean"""


def _audit(layers: dict[str, tuple[str, str]]) -> str:
    rows = " UNION ALL ".join(
        f"""SELECT '{notebook}' AS notebook_name, source, '{layer}' AS layer, record_count,
                   'Success' AS status FROM ({counts})"""
        for layer, (notebook, counts) in layers.items()
    )
    return f"""WITH {_ALL}, audit_rows AS ({rows})
      SELECT 'healthcare_ingest' AS pipeline_name, notebook_name, 'bound-run' AS run_id, source,
             layer, record_count, DATE '2026-02-01' AS load_time, status,
             'January' AS report_month, CAST(1 AS BIGINT) AS run_seq,
             CASE layer WHEN 'raw' THEN 1 WHEN 'silver' THEN 2 WHEN 'reject' THEN 3 ELSE 4 END AS step
      FROM audit_rows"""


_LAYERS = {
    "raw": ("raw_nb", _RAW_COUNTS),
    "silver": ("silver_nb", _SILVER_COUNTS),
    "reject": ("silver_nb", _REJECT_COUNTS),
    "gold": ("gold_nb", _GOLD_COUNTS),
}
_AUDIT_LOG = f"""
  SELECT * FROM ({_audit(_LAYERS)})
  UNION ALL
  SELECT 'healthcare_ingest', 'Pipeline_Start', 'bound-run', 'ALL', 'Init', 0, DATE '2026-02-01',
         'RUNNING', 'January', 1, 0"""

ORACLES: dict[str, str] = {
    # Scans and sinks
    "scan_landing_csv": _text(_HOSPITAL, "hospital", _HOSPITAL_COLUMNS),
    "landing_csv_round_trip": _text(_PHARMA, "pharma", _PHARMA_COLUMNS),
    "bronze_round_trip": _text(_HOSPITAL, "hospital", _HOSPITAL_COLUMNS),
    "scan_bronze_parquet": f"""
      SELECT *, 'Device_events_January_2026.csv' AS file_name_last, 'January' AS Month,
             '2026' AS Year
      FROM ({_text(_DEVICE, 'device', _DEVICE_COLUMNS)})""",
    "provenance_columns": f"""
      WITH {_PHARMA} SELECT medicine_id, hospital_id,
        'Pharma_events_January_2026.csv' AS file_name_last, 'January' AS Month, '2026' AS Year
      FROM pharma""",
    "landing_manifest": f"""
      WITH {_HOSPITAL}, {_DEVICE}, {_PHARMA}
      SELECT source || '_events_January_2026.csv' AS file_name, record_count AS row_count,
             record_count > 0 AS present
      FROM ({_RAW_COUNTS})""",
    "column_contract_report": f"""
      WITH {_HOSPITAL}, {_DEVICE}, {_PHARMA}
      SELECT source,
             CASE source WHEN 'Hospital' THEN 17 WHEN 'Device' THEN 7 ELSE 8 END AS expected_columns,
             CASE source WHEN 'Hospital' THEN 17 WHEN 'Device' THEN 7 ELSE 8 END AS found_columns,
             TRUE AS passed, record_count AS rows_checked
      FROM ({_RAW_COUNTS})""",
    "header_contract_cases": f"""
      WITH {_PHARMA}, landed AS (SELECT unnest(['good', 'swapped', 'renamed', 'extra']) AS "case")
      SELECT "case", "case" = 'good' AS passed, (SELECT COUNT(*) FROM pharma) AS rows FROM landed""",
    "history_claim_views": f"""
      WITH {_CLAIMS}, months AS (SELECT unnest(['January', 'February']) AS report_month),
      totals AS (
        SELECT * EXCLUDE (report_month), CAST(SUM(claim_count) OVER (PARTITION BY insurance_name) AS BIGINT)
                    AS total_claims_per_insurer
        FROM gold_claim_status_summary),
      ranked AS (
        SELECT insurance_name, COUNT(*) AS rejected_claim_count,
               CAST(RANK() OVER (ORDER BY COUNT(*) DESC) AS INTEGER) AS rejection_rank
        FROM claims WHERE claim_status = 'REJECTED' GROUP BY insurance_name)
      SELECT totals.*, CAST((2000 * claim_count + total_claims_per_insurer)
                            // (2 * total_claims_per_insurer) AS DOUBLE) / CAST(10 AS DOUBLE) AS claim_status_pct,
             report_month, CAST(2026 AS INTEGER) AS report_year, rejected_claim_count, rejection_rank
      FROM totals LEFT JOIN ranked USING (insurance_name) CROSS JOIN months""",
    "silver_replace_idempotent": f"WITH {_CLEAN} {_BILLING}",
    "silver_published_together": f"""
      WITH {_ALL}
      SELECT 'dim_medicine' AS table_name, COUNT(*) AS row_count FROM (SELECT DISTINCT medicine_id, medicine_name, category FROM valid)
      UNION ALL SELECT 'dim_device', COUNT(*) FROM (SELECT DISTINCT device_id, device_type, hospital_id FROM device)
      UNION ALL SELECT 'dim_insurance', COUNT(*) FROM (SELECT DISTINCT insurance_id, insurance_name FROM clean)
      UNION ALL SELECT 'dim_patient', COUNT(*) FROM (SELECT DISTINCT patient_id, patient_gender, patient_dob, insurance_id FROM clean)
      UNION ALL SELECT 'dim_doctor', COUNT(*) FROM (SELECT DISTINCT doctor_id, department, hospital_id FROM clean)
      UNION ALL SELECT 'dim_bed', COUNT(*) FROM (SELECT DISTINCT bed_id, bed_type, hospital_id FROM clean)
      UNION ALL SELECT 'fact_medicine_inventory', COUNT(*) FROM valid
      UNION ALL SELECT 'fact_device_usage', COUNT(*) FROM device
      UNION ALL SELECT 'fact_admission', COUNT(*) FROM clean
      UNION ALL SELECT 'fact_billing', COUNT(*) FROM clean""",
    "hospital_dimensions": f"""
      WITH {_CLEAN}
      SELECT DISTINCT 'dim_insurance' AS dimension, insurance_id, insurance_name, NULL::VARCHAR AS patient_id,
             NULL::VARCHAR AS patient_gender, NULL::DATE AS patient_dob, NULL::VARCHAR AS doctor_id, NULL::VARCHAR AS department,
             NULL::VARCHAR AS hospital_id, NULL::VARCHAR AS bed_id, NULL::VARCHAR AS bed_type FROM clean
      UNION ALL SELECT DISTINCT 'dim_patient', insurance_id, NULL, patient_id, patient_gender, patient_dob, NULL, NULL, NULL, NULL, NULL
        FROM clean
      UNION ALL SELECT DISTINCT 'dim_doctor', NULL, NULL, NULL, NULL, NULL, doctor_id, department, hospital_id, NULL, NULL FROM clean
      UNION ALL SELECT DISTINCT 'dim_bed', NULL, NULL, NULL, NULL, NULL, NULL, NULL, hospital_id, bed_id, bed_type FROM clean""",
    "gold_round_trip": f"WITH {_CLAIMS} SELECT * FROM gold_claim_status_summary",
    "external_gold_scan": f"WITH {_FINANCE} SELECT * FROM gold_finance_weekly",
    "gold_row_counts": f"""
      WITH {_ALL} SELECT source AS table_name, record_count AS row_count FROM ({_GOLD_COUNTS})
      UNION ALL SELECT lower(source) || '_events', record_count FROM ({_RAW_COUNTS})""",
    "preview_top5": f"""
      WITH {_FINANCE} SELECT * FROM ({_FINANCE_SUMMARY})
      ORDER BY week_start_date, insurance_id, insurance_name LIMIT 5""",
    # Gates
    **{
        f"null_counts_{source.lower()}": f"WITH {_DEFECTS[source]} SELECT "
        + ", ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in columns)
        + " FROM defective"
        for source, columns in _NULLS.items()
    },
    "string_length_violations": _all_sources("max_length"),
    "int_cast_violations": _all_sources("castable_int"),
    "gender_violations": _report(_HOSPITAL, "hospital", _ROW_RULES[:1]),
    "dob_violations": _report(_HOSPITAL, "hospital", _ROW_RULES[1:2]),
    "admission_discharge_violations": _report(_HOSPITAL, "hospital", _ROW_RULES[2:]),
    "billed_lt_approved_violations": _report(_HOSPITAL, "hospital", [_BILLED]),
    "duplicate_keys": f"WITH {_CLEAN}, {_DEVICE}, {_VALID} {_DUPLICATES}",
    "quality_report_hospital": _report(
        _HOSPITAL_DEFECTS, "defective", [*_gate("Hospital"), *_TEXT_RULES, _BILLED_TEXT]
    ),
    "quality_report_device": _report(_DEVICE_DEFECTS, "defective", _gate("Device")),
    "quality_report_pharma": _report(_PHARMA_DEFECTS, "defective", _gate("Pharma")),
    # Cleansing
    "report_period": """
      SELECT strftime(o_orderdate, '%Y%m%d') AS input_date,
             monthname(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH) AS report_month,
             CAST(year(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH) AS INTEGER) AS report_year,
             COUNT(*) AS row_count
      FROM orders GROUP BY ALL""",
    "clean_hospital": f"WITH {_CLEAN} SELECT * FROM clean",
    "clean_pharma": f"WITH {_VALID} SELECT * FROM valid",
    "hospital_reject_reasons": f"""
      WITH {_HOSPITAL}
      SELECT event_id, failed_rules FROM (
        SELECT event_id, concat_ws(',',
          CASE WHEN patient_gender NOT IN ('M', 'F', 'O') THEN 'gender' END,
          CASE WHEN patient_dob > DATE '1998-07-01' THEN 'dob' END,
          CASE WHEN admission_time > discharge_time THEN 'stay' END,
          CASE WHEN billed_amount < approved_amount THEN 'billing' END) AS failed_rules
        FROM hospital)
      WHERE failed_rules <> ''""",
    "pharma_reject_reasons": f"""
      WITH {_PHARMA}
      SELECT medicine_id, hospital_id, failed_rules FROM (
        SELECT medicine_id, hospital_id, concat_ws(',',
          CASE WHEN total_stock < 0 THEN 'total_stock' END,
          CASE WHEN issued_stock < 0 THEN 'issued_stock' END,
          CASE WHEN issued_stock > total_stock THEN 'issued_within_total' END,
          CASE WHEN expiry_date < DATE '1998-07-01' THEN 'expiry' END) AS failed_rules
        FROM pharma)
      WHERE failed_rules <> ''""",
    "hospital_id_conformance": f"""
      WITH {_HOSPITAL}, {_DEVICE}, {_PHARMA}
      SELECT hospital_id, COUNT(*) FILTER (WHERE source = 'Hospital') AS hospital_rows,
             COUNT(*) FILTER (WHERE source = 'Device') AS device_rows,
             COUNT(*) FILTER (WHERE source = 'Pharma') AS pharma_rows
      FROM (SELECT hospital_id, 'Hospital' AS source FROM hospital
            UNION ALL SELECT hospital_id, 'Device' FROM device
            UNION ALL SELECT hospital_id, 'Pharma' FROM pharma)
      GROUP BY hospital_id""",
    "expiry_status_summary": f"""
      WITH {_PHARMA}
      SELECT COUNT(*) FILTER (WHERE expiry_date < DATE '1998-07-01') AS expired_count,
             COUNT(*) FILTER (WHERE expiry_date IS NULL OR expiry_date >= DATE '1998-07-01')
               AS valid_count
      FROM pharma""",
    # Star schema
    "dim_medicine": _distinct(_VALID, "valid", "medicine_id, medicine_name, category"),
    "dim_device": _distinct(_DEVICE, "device", "device_id, device_type, hospital_id"),
    "dim_insurance": _distinct(_CLEAN, "clean", "insurance_id, insurance_name"),
    "dim_patient": _distinct(
        _CLEAN, "clean", "patient_id, patient_gender, patient_dob, insurance_id"
    ),
    "dim_doctor": _distinct(_CLEAN, "clean", "doctor_id, department, hospital_id"),
    "dim_bed": _distinct(_CLEAN, "clean", "bed_id, bed_type, hospital_id"),
    "fact_medicine_inventory": f"""
      WITH {_VALID} SELECT medicine_id, hospital_id, total_stock, issued_stock, expiry_date,
                           available_stock FROM valid""",
    "fact_device_usage": f"""
      WITH {_DEVICE} SELECT device_id, hospital_id, week AS week, total_units, in_use_units,
                            total_units - in_use_units AS available_units FROM device""",
    "fact_admission": f"""
      WITH {_CLEAN}
      SELECT event_id AS admission_id, patient_id, doctor_id, bed_id, hospital_id, admission_time,
             discharge_time,
             CAST(date_diff('day', admission_time, discharge_time) * 24 AS INTEGER)
               AS length_of_stay_hrs,
             discharge_time IS NULL AS is_currently_admitted
      FROM clean""",
    "fact_billing": f"WITH {_CLEAN} {_BILLING}",
    # Marts
    "gold_medicine_availability": f"WITH {_STOCK} SELECT * FROM gold_medicine_availability",
    "category_distribution": f"""
      WITH {_VALID} SELECT category, CAST(SUM(available_stock) AS BIGINT) AS total_available_stock,
                           'January' AS report_month FROM stocked GROUP BY category""",
    "gold_device_availability": f"WITH {_DEVICES} SELECT * FROM gold_device_availability",
    "gold_finance_weekly": f"WITH {_FINANCE} SELECT * FROM gold_finance_weekly",
    "gold_weekly_admissions": f"WITH {_ADMISSIONS} SELECT * FROM gold_weekly_admissions",
    "gold_claim_status_summary": f"WITH {_CLAIMS} SELECT * FROM gold_claim_status_summary",
    "gold_rejected_claims": f"WITH {_REJECTED} SELECT * FROM gold_rejected_claims",
    "gold_patient_status": f"""
      WITH {_CLEAN}
      SELECT CASE WHEN discharge_time IS NULL THEN 'Currently Admitted' ELSE 'Discharged' END
               AS patient_status, COUNT(*) AS patient_count, 'January' AS report_month
      FROM clean GROUP BY 1""",
    # Views
    "vw_medicine_stock_alert": f"WITH {_STOCK} SELECT * FROM alerts",
    "vw_device_utilization": f"""
      WITH {_DEVICES}
      SELECT hospital_id, device_type, total_units, in_use_units, available_units,
             CASE WHEN total_units <> 0 THEN
               CAST((2000 * CAST(in_use_units AS HUGEINT) + total_units) // (2 * total_units)
                    AS DOUBLE) / CAST(10 AS DOUBLE) END AS utilization_pct,
             report_month,
             CASE WHEN utilization_pct >= 90 THEN 'OVERLOADED' WHEN utilization_pct >= 70 THEN 'HIGH'
                  WHEN utilization_pct >= 50 THEN 'MODERATE' ELSE 'AVAILABLE'
             END AS utilization_status
      FROM gold_device_availability""",
    "vw_finance_summary": f"WITH {_FINANCE} {_FINANCE_SUMMARY}",
    "vw_weekly_admissions": f"""
      WITH {_ADMISSIONS}
      SELECT week_start_date, {_WEEK_NUMBER} AS week_number,
             monthname(week_start_date) AS month_name,
             CAST(year(week_start_date) AS INTEGER) AS year_number, total_admissions, report_month
      FROM gold_weekly_admissions""",
    "vw_claim_status_breakdown": f"""
      WITH {_CLAIMS}, totals AS (
        SELECT *, CAST(SUM(claim_count) OVER (PARTITION BY insurance_name) AS BIGINT)
                    AS total_claims_per_insurer
        FROM gold_claim_status_summary)
      SELECT *, CAST((2000 * claim_count + total_claims_per_insurer)
                     // (2 * total_claims_per_insurer) AS DOUBLE) / CAST(10 AS DOUBLE)
                AS claim_status_pct
      FROM totals""",
    "vw_rejected_claims_ranking": f"""
      WITH {_REJECTED}
      SELECT *, CAST(RANK() OVER (ORDER BY rejected_claim_count DESC) AS INTEGER) AS rejection_rank
      FROM gold_rejected_claims""",
    # Measures
    "kpi_admissions": f"""
      WITH {_CLEAN}
      SELECT COUNT(DISTINCT event_id) AS total_admissions,
             COUNT(*) FILTER (WHERE discharge_time IS NULL) AS currently_admitted,
             COUNT(*) FILTER (WHERE discharge_time IS NOT NULL) AS discharged
      FROM clean""",
    "kpi_admissions_by_department": f"""
      WITH {_CLEAN} SELECT department, COUNT(*) AS admission_count FROM clean GROUP BY department""",
    "kpi_finance_totals": f"""
      WITH {_FINANCE}
      SELECT CAST(SUM(CAST(total_billed_amount AS BIGINT)) AS DOUBLE) AS total_billed,
             CAST(SUM(CAST(total_approved_amount AS BIGINT)) AS DOUBLE) AS total_approved,
             CAST(SUM(CAST(revenue_leakage_amount AS BIGINT)) AS DOUBLE) AS total_revenue_leakage,
             CAST(SUM(CAST(round(approval_percentage * 100) AS BIGINT)) AS DOUBLE)
               / CAST(COUNT(*) AS DOUBLE) / CAST(100 AS DOUBLE) AS avg_approval_percentage
      FROM gold_finance_weekly""",
    "kpi_leakage_by_insurer": f"""
      WITH {_FINANCE} SELECT insurance_name,
        CAST(SUM(CAST(revenue_leakage_amount AS BIGINT)) AS DOUBLE) AS revenue_leakage
      FROM gold_finance_weekly GROUP BY insurance_name""",
    "kpi_claim_distribution": f"""
      WITH {_CLEAN}, counts AS (
        SELECT claim_status, COUNT(*) AS claim_count, (SELECT COUNT(*) FROM clean) AS n
        FROM clean GROUP BY claim_status)
      SELECT claim_status, claim_count,
             CAST((2000 * claim_count + n) // (2 * n) AS DOUBLE) / CAST(10 AS DOUBLE) AS claim_pct
      FROM counts""",
    "kpi_utilization_matrix": f"""
      WITH {_DEVICES}
      SELECT hospital_id, string_agg(device_type, ',' ORDER BY device_type) AS device_types,
             string_agg(coalesce(CAST(CAST(utilization_pct AS DECIMAL(18, 3)) AS VARCHAR), '-'), ',' ORDER BY device_type)
               AS utilization_pcts
      FROM gold_device_availability GROUP BY hospital_id""",
    "kpi_utilization_bands": f"""
      WITH {_DEVICES}
      SELECT hospital_id, device_type, utilization_pct,
             CASE WHEN utilization_pct > 90 THEN 'Red' WHEN utilization_pct >= 70 THEN 'Yellow'
                  WHEN utilization_pct < 70 THEN 'Green' END AS band
      FROM gold_device_availability""",
    "kpi_units_by_device_type": f"""
      WITH {_DEVICES} SELECT device_type, CAST(SUM(available_units) AS BIGINT) AS available_units,
                             CAST(SUM(in_use_units) AS BIGINT) AS in_use_units
      FROM gold_device_availability GROUP BY device_type""",
    "kpi_overloaded_devices": f"""
      WITH {_DEVICES} SELECT * FROM gold_device_availability WHERE utilization_pct > 90""",
    "kpi_low_stock": f"""
      WITH {_STOCK} SELECT * FROM alerts WHERE stock_alert_level IN ('CRITICAL', 'LOW')""",
    "kpi_stock_by_medicine": f"""
      WITH {_VALID} SELECT medicine_id, medicine_name,
        CAST(SUM(total_stock) AS BIGINT) AS total_stock,
        CAST(SUM(available_stock) AS BIGINT) AS available_stock
      FROM stocked GROUP BY medicine_id, medicine_name""",
    # Jobs and audit
    "raw_layer_counts": f"WITH {_ALL} {_RAW_COUNTS}",
    "silver_layer_counts": f"WITH {_ALL} {_SILVER_COUNTS}",
    "gold_layer_counts": f"WITH {_ALL} {_GOLD_COUNTS}",
    "audit_log": _AUDIT_LOG,
    "audit_recent": f"""
      SELECT *, CAST(row_number() OVER (ORDER BY load_time DESC, run_seq DESC, run_id DESC, step DESC, source) AS INTEGER) AS place
      FROM ({_AUDIT_LOG})""",
    "audit_by_layer": _audit({"gold": _LAYERS["gold"]}),
    "audit_run_health": f"""
      SELECT CAST(1 AS BIGINT) AS run_seq, 'bound-run' AS run_id, 'COMPLETE' AS state, 'gold' AS last_layer,
             COUNT(*) FILTER (WHERE status = 'Success') AS success_rows,
             COUNT(*) FILTER (WHERE status = 'Success') >= 10 AS healthy
      FROM ({_AUDIT_LOG})
      UNION ALL SELECT 2, 'stopped-run', 'FAILED', 'Any', 0, FALSE""",
    "raw_balance": f"""
      WITH {_ALL}, r AS ({_RAW_COUNTS}), s AS ({_SILVER_COUNTS})
      SELECT 'bound-run' AS run_id, source, r.record_count AS raw_rows, s.record_count AS clean_rows,
             r.record_count - s.record_count AS rejected_rows, TRUE AS balanced
      FROM r JOIN s USING (source) WHERE source <> 'Device'""",
    "layer_reconciliation": f"""
      WITH {_ALL}, figures AS (
        SELECT 'gold_medicine_availability' AS mart, (SELECT COUNT(*) FROM valid) AS s,
               (SELECT COUNT(*) FROM stocked) AS g
        UNION ALL SELECT 'gold_device_availability', (SELECT SUM(total_units) FROM device),
               (SELECT SUM(total_units) FROM gold_device_availability)
        UNION ALL SELECT 'gold_finance_weekly',
               (SELECT COUNT(*) FROM clean WHERE claim_status = 'APPROVED'),
               (SELECT SUM(total_claims) FROM gold_finance_weekly)
        UNION ALL SELECT 'gold_weekly_admissions', (SELECT COUNT(*) FROM clean),
               (SELECT COUNT(*) FROM clean WHERE event_id IS NOT NULL)
        UNION ALL SELECT 'gold_claim_status_summary', (SELECT COUNT(*) FROM clean),
               (SELECT COUNT(*) FROM claims)
        UNION ALL SELECT 'gold_rejected_claims',
               (SELECT COUNT(*) FROM clean WHERE claim_status = 'REJECTED'),
               (SELECT COUNT(*) FROM claims WHERE claim_status = 'REJECTED')
        UNION ALL SELECT 'gold_patient_status', (SELECT COUNT(*) FROM clean),
               (SELECT COUNT(*) FROM clean WHERE event_id IS NOT NULL))
      SELECT mart, CAST(s AS BIGINT) AS silver_figure, CAST(g AS BIGINT) AS gold_figure,
             s = g AS matches
      FROM figures""",
}


ORACLES["content_reconciliation"] = f"""
  SELECT mart, '' AS differs, TRUE AS matches FROM ({ORACLES['layer_reconciliation']})"""
ORACLES["content_reconciliation_swapped"] = f"""
  WITH {_FINANCE}, ends AS (SELECT MIN(total_billed_amount) < MAX(total_billed_amount) AS moved FROM gold_finance_weekly),
  found AS (
    SELECT mart, CASE WHEN mart = 'gold_finance_weekly' AND (SELECT moved FROM ends) THEN 'total_billed_amount' ELSE '' END AS differs
    FROM ({ORACLES['layer_reconciliation']}))
  SELECT mart, differs, differs = '' AS matches FROM found"""


def _first_five(sql: str, order: str) -> str:
    keys = ", ".join(f"{key} NULLS FIRST" for key in order.split(", "))
    return f"SELECT * FROM ({sql}) ORDER BY {keys} LIMIT 5"


ORACLES |= {
    "preview_medicine_stock_alert": _first_five(
        ORACLES["vw_medicine_stock_alert"], "hospital_id, medicine_name, category, available_stock, expiry_date"
    ),
    "preview_device_utilization": _first_five(ORACLES["vw_device_utilization"], "hospital_id, device_type"),
    "preview_weekly_admissions": _first_five(ORACLES["vw_weekly_admissions"], "week_start_date"),
    "preview_claim_status_breakdown": _first_five(
        ORACLES["vw_claim_status_breakdown"], "insurance_name, claim_status"
    ),
    "preview_rejected_claims_ranking": _first_five(
        ORACLES["vw_rejected_claims_ranking"], "rejection_rank, insurance_name"
    ),
    "preview_hospital_events": _first_five(f"WITH {_HOSPITAL} SELECT * EXCLUDE (n) FROM hospital", "event_id"),
    "preview_device_events": _first_five(
        f"WITH {_DEVICE} SELECT * EXCLUDE (n) FROM device", "hospital_id, device_id, week, total_units, in_use_units"
    ),
    "preview_pharma_events": _first_five(
        f"WITH {_PHARMA} SELECT * EXCLUDE (n) FROM pharma", "medicine_id, hospital_id"
    ),
}
