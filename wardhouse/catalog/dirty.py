"""Messy operational tables, derived from the clean ones by fixed expressions.

Spark and the SQL check share the texts, so both see the same dirt over the whole tables. `{again}` stands for the
engine's way to emit a row once or twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VISITS = """
WITH b AS (
  SELECT *, CAST(CAST(o_orderdate AS DATE) AS STRING) AS d, {again_50} AS again FROM orders
)
SELECT
  o_orderkey + again * 1000000000 AS visit_id,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN '  '
       ELSE concat(' lk', CAST(o_orderkey AS STRING), ' ') END AS visit_code,
  CASE o_orderkey % 11 WHEN 0 THEN d
       WHEN 1 THEN concat(substr(d, 9, 2), '/', substr(d, 6, 2), '/', substr(d, 1, 4))
       WHEN 2 THEN replace(d, '-', '') WHEN 3 THEN replace(d, '-', '/')
       WHEN 4 THEN concat(substr(d, 9, 2), '-', substr(d, 6, 2), '-', substr(d, 1, 4))
       WHEN 5 THEN replace(d, '-', '.') WHEN 6 THEN 'invalid'
       WHEN 7 THEN concat(CAST(CAST(substr(d, 9, 2) AS INT) AS STRING), '/', CAST(CAST(substr(d, 6, 2) AS INT) AS STRING), '/', substr(d, 1, 4))
       WHEN 8 THEN concat(d, ' 11:15:00') WHEN 9 THEN concat('  ', d) ELSE NULL END AS visit_date,
  CASE WHEN o_orderkey % 61 = 0 THEN 'bn_not_found' ELSE concat('bn', CAST(o_custkey AS STRING)) END AS patient_code,
  CASE WHEN o_orderkey % 67 = 0 THEN 'bs_not_found' ELSE concat('bs', CAST(o_orderkey % 90 AS STRING)) END AS doctor_code,
  CASE WHEN o_orderkey % 59 = 0 THEN NULL ELSE concat(' khoa_', CAST(o_custkey % 25 AS STRING)) END AS department_code,
  CASE WHEN o_orderkey % 43 = 0 THEN 'bh999' ELSE concat('bh', CAST(o_custkey % 20 AS STRING)) END AS insurance_code,
  concat(d, ' 08:00:00', CASE WHEN o_orderkey % 13 = 0 THEN '.5' ELSE '' END) AS checkin_time,
  CASE o_orderkey % 5 WHEN 0 THEN concat(d, ' 07:50:00') WHEN 1 THEN concat(d, ' 08:25:30')
       WHEN 2 THEN concat(d, ' 09:10:00') WHEN 3 THEN NULL ELSE 'bad' END AS consultation_start_time,
  CASE o_orderkey % 6 WHEN 0 THEN '150000' WHEN 1 THEN '80,000' WHEN 2 THEN '250000 vnd'
       WHEN 3 THEN ' 200.000 ' WHEN 4 THEN '-50000' ELSE 'abc' END AS consultation_fee_raw,
  CASE o_orderstatus WHEN 'F' THEN ' completed' WHEN 'O' THEN 'COMPLETED' ELSE NULL END AS visit_status,
  CAST(NULL AS STRING) AS created_at,
  concat(d, CASE again WHEN 0 THEN ' 10:00:00' ELSE ' 12:00:00' END) AS updated_at
FROM b
"""

LINES = """
WITH b AS (
  SELECT *, CAST(CAST(l_shipdate AS DATE) AS STRING) AS d,
    CAST(l_quantity AS INT) AS q, l_orderkey * 10 + l_linenumber AS k FROM lineitem
)
SELECT
  k AS txn_id,
  concat('tx', CAST(k AS STRING)) AS txn_code,
  concat('lk', CAST(l_orderkey AS STRING)) AS visit_code,
  CASE WHEN k % 6 = 0 THEN d WHEN k % 3 = 0 THEN concat(d, ' 10:30:00') WHEN k % 3 = 1 THEN replace(d, '-', '') ELSE NULL END AS txn_date,
  concat('bn', CAST(l_orderkey % 1500 AS STRING)) AS patient_code,
  CASE WHEN k % 41 = 0 THEN NULL ELSE concat('bs', CAST(l_suppkey AS STRING)) END AS doctor_code,
  CASE WHEN k % 37 = 0 THEN ' ' ELSE concat('khoa_', CAST(l_suppkey % 25 AS STRING)) END AS department_code,
  CASE WHEN k % 53 = 0 THEN 'dv_missing' ELSE concat('dv', CAST(l_partkey AS STRING)) END AS item_code,
  concat('bh', CAST(l_suppkey % 20 AS STRING)) AS insurance_code,
  CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN '-1' WHEN 2 THEN concat(' ', CAST(q AS STRING))
       ELSE CAST(q AS STRING) END AS quantity_raw,
  CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN '1,500' WHEN 2 THEN '2000 VND' ELSE '2500' END AS unit_price_raw,
  CASE k % 4 WHEN 0 THEN CAST(q * 1000 AS STRING) WHEN 1 THEN CAST(q * 1500 AS STRING)
       WHEN 2 THEN CAST(q * 2000 AS STRING) ELSE NULL END AS total_amount_raw,
  CASE l_returnflag WHEN 'N' THEN {done} WHEN 'A' THEN lower({done}) ELSE NULL END AS status,
  CASE WHEN k % 3 = 2 AND k % 7 = 0 THEN concat(d, ' 06:00:00') ELSE NULL END AS created_at,
  concat(d, ' 09:00:00') AS updated_at
FROM b
"""

PATIENTS = """
WITH b AS (SELECT *, {again_20} AS again FROM customer)
SELECT
  c_custkey + again * 1000000000 AS patient_id,
  CASE WHEN c_custkey % 71 = 0 THEN NULL ELSE concat('bn', CAST(c_custkey AS STRING)) END AS patient_code,
  concat('  NGUYEN ', CASE WHEN c_custkey % 2 = 0 THEN '  van' ELSE 'Thi' END, '  ') AS full_name,
  CASE c_custkey % 6 WHEN 0 THEN 'M' WHEN 1 THEN ' nam' WHEN 2 THEN 'F' WHEN 3 THEN 'nu' WHEN 4 THEN 'other'
       ELSE NULL END AS gender_raw,
  CASE c_custkey % 5 WHEN 0 THEN CAST(1930 + c_custkey % 90 AS STRING) WHEN 1 THEN 'abc'
       WHEN 2 THEN concat(CAST(1940 + c_custkey % 70 AS STRING), '.7') ELSE NULL END AS birth_year,
  concat(CASE WHEN c_custkey % 2 = 0 THEN '0' ELSE '' END, CAST(1 + c_custkey % 9 AS STRING), CASE WHEN c_custkey % 4 < 2 THEN '/05/' ELSE '/5/' END, CAST(1890 + c_custkey % 130 AS STRING)) AS date_of_birth,
  CASE c_nationkey % 5 WHEN 0 THEN 'HCM' WHEN 1 THEN ' ha noi' WHEN 2 THEN 'da nang ' WHEN 3 THEN 'hue'
       ELSE NULL END AS city_raw,
  CASE c_mktsegment WHEN 'BUILDING' THEN '80%' WHEN 'MACHINERY' THEN '0.5' WHEN 'HOUSEHOLD' THEN '0'
       WHEN 'FURNITURE' THEN '120' ELSE ' 95 ' END AS coverage_rate_raw,
  CASE WHEN again = 1 THEN '2024-02-01 00:00:00' WHEN c_custkey % 2 = 0 THEN '2024-01-05 00:00:00'
       ELSE '2024-01-17 00:00:00' END AS updated_at
FROM b
"""

DOCTORS = """
SELECT s_suppkey AS doctor_id, concat(' bs', CAST(s_suppkey AS STRING)) AS doctor_code, s_name AS doctor_name,
  CASE s_suppkey % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'woman' ELSE 'khac' END AS gender_raw,
  CASE s_nationkey % 3 WHEN 0 THEN 'Cardiology' WHEN 1 THEN 'lab' ELSE 'mat' END AS specialty_raw,
  CASE s_nationkey % 4 WHEN 0 THEN 'Bac si' WHEN 1 THEN ' ThS' WHEN 2 THEN 'TS' ELSE ' PGS ' END AS academic_title_raw,
  '2024-01-05 00:00:00' AS updated_at
FROM supplier
"""

DEPARTMENTS = """
SELECT n_nationkey AS department_id, concat('khoa_', CAST(n_nationkey AS STRING)) AS department_code,
  n_name AS department_name_raw,
  CASE n_regionkey WHEN 0 THEN 'CLS' WHEN 1 THEN 'kham benh' ELSE 'noi tru' END AS department_group_raw,
  '2024-01-05 00:00:00' AS updated_at
FROM nation
"""

ITEMS = """
SELECT p_partkey AS item_id,
  concat('dv', CAST(p_partkey AS STRING)) AS item_code,
  p_name AS item_name_raw,
  CASE p_size % 6 WHEN 0 THEN 'Lab' WHEN 1 THEN 'kham' WHEN 2 THEN 'thu thuat' WHEN 3 THEN ' Antibiotic'
       WHEN 4 THEN 'da day' ELSE p_type END AS item_type_raw,
  CASE p_size % 3 WHEN 0 THEN 'tablet' WHEN 1 THEN 'hop' ELSE 'lo' END AS unit_raw,
  concat(CAST(CAST(floor(p_retailprice) AS INT) AS STRING), ' VND') AS standard_price,
  '2024-01-05 00:00:00' AS updated_at
FROM part
"""

PLANS = """
SELECT n_nationkey AS insurance_id, concat('bh', CAST(n_nationkey AS STRING)) AS insurance_code,
  CASE n_nationkey % 6 WHEN 0 THEN '80%' WHEN 1 THEN '0.5' WHEN 2 THEN '0' WHEN 3 THEN '120' WHEN 4 THEN ' 95 %'
       ELSE '0.285' END AS coverage_rate_raw,
  '2024-01-05 00:00:00' AS updated_at
FROM nation
"""

# What a source holds on other days: `{table}` is the dirty table, `{but}` the engine's word for all columns but some.
LATER = {
    "first": {"dirty_patients": "SELECT * FROM {table} WHERE patient_id % 50 <> 3"},
    "corrected": {
        "dirty_patients": "SELECT * FROM {table} WHERE patient_id % 50 <> 4",
        "dirty_departments": "SELECT * FROM {table} WHERE department_id <> 7",
    },
    "second": {
        "dirty_doctors": "SELECT * FROM {table} WHERE doctor_id % 40 <> 5",
        "dirty_visits": """SELECT * {but} (consultation_fee_raw), CASE WHEN visit_id % 25 = 6 AND consultation_fee_raw = '150000'
            THEN '140,000' ELSE consultation_fee_raw END AS consultation_fee_raw FROM {table}""",
    },
}

_TEXTS = {
    "dirty_visits": VISITS,
    "dirty_services": LINES,
    "dirty_prescriptions": LINES,
    "dirty_patients": PATIENTS,
    "dirty_doctors": DOCTORS,
    "dirty_departments": DEPARTMENTS,
    "dirty_items": ITEMS,
    "dirty_plans": PLANS,
}
_SOURCES = {
    "dirty_visits": "orders",
    "dirty_services": "lineitem",
    "dirty_prescriptions": "lineitem",
    "dirty_patients": "customer",
    "dirty_doctors": "supplier",
    "dirty_departments": "nation",
    "dirty_items": "part",
    "dirty_plans": "nation",
}
_DONE = {"dirty_services": "' PAID '", "dirty_prescriptions": "'DISPENSED'"}
# The source names that the cleansing functions look for.
_NAMES = {
    "dirty_services": {"txn_id": "ServiceTransactionId", "txn_code": "service_transaction_no", "txn_date": "Service-Date",
                       "item_code": "ServiceNo", "status": "PaymentStatus"},
    "dirty_prescriptions": {"txn_id": "prescription_id", "txn_code": "PrescriptionNo", "txn_date": "prescription_date",
                            "item_code": "medicine_no", "status": "Dispense Status"},
}


def _text(name: str, again) -> str:
    text = _TEXTS[name].replace("{done}", _DONE.get(name, ""))
    for every, key in ((50, "o_orderkey"), (20, "c_custkey")):
        text = text.replace(f"{{again_{every}}}", again(f"{key} % {every} = 0"))
    return text


def duckdb_text(name: str) -> str:
    return _text(name, lambda cond: f"unnest(CASE WHEN {cond} THEN [0, 1] ELSE [0] END)")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dirty(spark: SparkSession, sf_dir: str, name: str, day: str | None = None) -> DataFrame:
    source = _SOURCES[name]
    text = _text(name, lambda cond: f"explode(CASE WHEN {cond} THEN array(0, 1) ELSE array(0) END)")
    rows = spark.sql(text.replace(f"FROM {source}", "FROM {source}"), source=table(spark, sf_dir, source))
    later = LATER.get(day, {}).get(name)
    return spark.sql(later.replace("{but}", "EXCEPT"), table=rows) if later else rows


def renamed(spark: SparkSession, sf_dir: str, name: str, day: str | None = None) -> DataFrame:
    """The dirty table under unsettled column names, as sources carry them."""
    return dirty(spark, sf_dir, name, day).withColumnsRenamed(_NAMES[name])
