"""The SQL that must give the same rows as each query (DuckDB dialect), written from the rules and not from the plans.

`{...}` blocks are shared pieces: `CTES` holds named sub-queries, and `sql` puts those that a text mentions in front.
"""

from __future__ import annotations

import re

from wardhouse.catalog.dirty import LATER, duckdb_text

AS_OF_YEAR = 2024


def code(x: str) -> str:
    return f"upper(trim({x}))"


def words(x: str) -> str:
    """Blank-separated words in lower case with capitals."""
    parts = f"string_split(lower(trim(regexp_replace({x}, '\\s+', ' ', 'g'))), ' ')"
    return f"array_to_string(list_transform({parts}, lambda w: upper(w[1]) || w[2:]), ' ')"


def day(x: str) -> str:
    ymd, dmy = r"\d{4}S\d{1,2}S\d{1,2}", r"\d{1,2}S\d{1,2}S\d{4}"
    formats = (
        (ymd.replace("S", "-"), "%Y-%m-%d"), (dmy.replace("S", "/"), "%d/%m/%Y"), (r"\d{8}", "%Y%m%d"),
        (ymd.replace("S", "/"), "%Y/%m/%d"), (dmy.replace("S", "-"), "%d-%m-%Y"), (ymd.replace("S", "[.]"), "%Y.%m.%d"),
    )
    start = lambda p: f"regexp_extract(trim({x}), '^({p})([^0-9]|$)', 1)"
    return "coalesce(" + ", ".join(f"CAST(try_strptime({start(p)}, '{f}') AS DATE)" for p, f in formats) + ")"


def time_day(x: str) -> str:
    return f"CAST(TRY_CAST({x} AS TIMESTAMP) AS DATE)"


def money(x: str) -> str:
    return f"TRY_CAST(replace(replace(replace(upper(trim({x})), 'VND', ''), ',', ''), ' ', '') AS DECIMAL(18,2))"


def whole(x: str) -> str:
    return f"CAST(trunc(TRY_CAST(replace(trim({x}), ',', '') AS DOUBLE)) AS INTEGER)"


def case(x: str, pairs: dict[str, tuple[str, ...]], default: str) -> str:
    whens = " ".join(
        f"WHEN lower(trim({x})) IN ({', '.join(repr(n) for n in names)}) THEN '{label}'" for label, names in pairs.items()
    )
    return f"CASE {whens} ELSE {default} END"


def bucket(x: str) -> str:
    return f"substr(md5({x}), 1, 4)"


def dense(x: str) -> str:
    return f"row_number() OVER (ORDER BY {bucket(x)}, {x})"


def sparse(x: str) -> str:
    return (
        f"CAST(concat('0x', {bucket(x)}) AS BIGINT) * 68719476736 "
        f"+ row_number() OVER (PARTITION BY {bucket(x)} ORDER BY {x})"
    )


MINUTES = """CASE WHEN try_strptime(substr(consultation_start_time, 1, 19), '%Y-%m-%d %H:%M:%S') IS NULL
       OR try_strptime(substr(checkin_time, 1, 19), '%Y-%m-%d %H:%M:%S') IS NULL THEN 0
  ELSE CAST(greatest(trunc((epoch(try_strptime(substr(consultation_start_time, 1, 19), '%Y-%m-%d %H:%M:%S'))
       - epoch(try_strptime(substr(checkin_time, 1, 19), '%Y-%m-%d %H:%M:%S'))) / 60), 0) AS INTEGER) END"""

GENDER = {"Nam": ("nam", "m", "male"), "Nữ": ("nữ", "nu", "f", "female", "woman"), "Khác": ("khac", "other")}
CITY = {"TP. Hồ Chí Minh": ("hcm",), "Hà Nội": ("ha noi",), "Đà Nẵng": ("da nang",)}
SPECIALTY = {"Tim mạch": ("cardiology",), "Xét nghiệm": ("lab",)}
TITLE = {"BS": ("bac si",), "ThS": ("ths",), "TS": ("ts",)}
GROUP = {"Cận lâm sàng": ("cls",), "Khám bệnh": ("kham benh",)}
TYPE = {"Xét nghiệm": ("lab",), "Khám": ("kham",), "Thủ thuật": ("thu thuat",)}
MEDICINE = {"Kháng sinh": ("antibiotic",), "Tiêu hóa": ("da day",)}
UNIT = {"Viên": ("tablet",), "Hộp": ("hop",)}
NEWEST = "ORDER BY CAST(updated_at AS TIMESTAMP) DESC, CAST({id} AS BIGINT) DESC"


def year(year_col: str, born: str) -> str:
    found = f"coalesce({whole(year_col)}, CAST(year({day(born)}) AS INTEGER))"
    return f"CASE WHEN {found} BETWEEN 1900 AND {AS_OF_YEAR} THEN {found} END"


def band(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN 'Không xác định' WHEN {AS_OF_YEAR} - {x} <= 17 THEN '0-17' "
        f"WHEN {AS_OF_YEAR} - {x} <= 35 THEN '18-35' WHEN {AS_OF_YEAR} - {x} <= 55 THEN '36-55' ELSE '56+' END"
    )


def percent(x: str) -> str:
    value = f"TRY_CAST(replace(replace(trim({x}), '%', ''), ' ', '') AS DOUBLE)"
    scaled = f"(CASE WHEN {value} <= 1 THEN {value} * 100 ELSE {value} END)"
    return f"CASE WHEN {scaled} BETWEEN 0 AND 100 THEN {scaled} END"


def label(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} = 0 THEN 'Tự chi trả' ELSE concat('BHYT ', CAST(CAST(trunc({x}) AS INTEGER) AS VARCHAR), '%') END"


def recovered(source: str, extra: str) -> str:
    """Quantity, then price, then amount over parsed q, p, t."""
    return f"""
    SELECT *, CAST(quantity * price AS DECIMAL(18,2)) AS amount FROM (
      SELECT *, CASE WHEN p > 0 THEN p WHEN t > 0 AND quantity > 0 THEN CAST(t / quantity AS DECIMAL(18,2))
                     ELSE CAST(0 AS DECIMAL(18,2)) END AS price
      FROM (
        SELECT *, CAST(CASE WHEN q > 0 THEN q WHEN t > 0 AND p > 0 THEN greatest(CAST(round(t / p) AS INTEGER), 1)
                       ELSE 1 END AS INTEGER) AS quantity
        FROM (SELECT {extra}, {whole('quantity_raw')} AS q, {money('unit_price_raw')} AS p,
                     {money('total_amount_raw')} AS t FROM {source})))"""


LINE_COLUMNS = f"""CAST(txn_id AS VARCHAR) AS id, {code('txn_code')} AS code, {code('visit_code')} AS "VisitCode",
  coalesce({day('txn_date')}, {time_day('created_at')}) AS line_day, {code('patient_code')} AS "PatientCode",
  {code('doctor_code')} AS "DoctorCode", {code('department_code')} AS "DepartmentCode", {code('item_code')} AS item,
  {code('insurance_code')} AS "InsuranceCode", {code("coalesce(status, 'UNKNOWN')")} AS done, created_at, updated_at"""


def line_reason(what: str, item: str, done: str, failed: str) -> str:
    return f"""CASE WHEN code IS NULL OR code = '' THEN 'missing_{what}_code'
      WHEN "VisitCode" IS NULL OR "VisitCode" = '' THEN 'missing_visit_code'
      WHEN line_day IS NULL THEN 'invalid_{'service' if item == 'service' else 'prescription'}_date'
      WHEN item IS NULL OR item = '' THEN 'missing_{item}_code'
      WHEN quantity <= 0 THEN 'invalid_quantity' WHEN price <= 0 THEN 'invalid_unit_price'
      WHEN done <> '{done}' THEN '{failed}' END AS error_reason"""


def dim(key: str, code_col: str, attrs: str, source: str, id_col: str) -> str:
    newest = NEWEST.format(id=id_col)
    return f"""SELECT CAST({dense('c')} AS BIGINT) AS "{key}", c AS "{code_col}", {attrs}
      FROM (SELECT *, row_number() OVER (PARTITION BY c {newest}) AS rn FROM (SELECT *, {source})) WHERE rn = 1"""


def orphan_reason(kinds: tuple[str, ...]) -> str:
    return "CASE " + " ".join(f"WHEN {k}_k IS NULL THEN 'missing_{k}_dimension'" for k in kinds) + " END AS error_reason"


def resolved(source: str, day_col: str, item: str | None) -> str:
    kinds = ("date", "patient", "doctor", "department", *((item,) if item else ()), "insurance")
    item_key = f', i."{item.title()}Key" AS {item}_k' if item else ""
    item_join = f'LEFT JOIN dim_{item} i ON s.item = i."{item.title()}Code"' if item else ""
    return f"""SELECT *, {orphan_reason(kinds)} FROM (
      SELECT s.*, dd."DateKey" AS date_k, p."PatientKey" AS patient_k, doc."DoctorKey" AS doctor_k,
        dep."DepartmentKey" AS department_k{item_key}, ins."InsuranceKey" AS insurance_k, ins."CoverageRate" AS rate
      FROM {source} s LEFT JOIN dim_date dd ON s.{day_col} = dd."FullDate"
      LEFT JOIN dim_patient p ON s."PatientCode" = p."PatientCode"
      LEFT JOIN dim_doctor doc ON s."DoctorCode" = doc."DoctorCode"
      LEFT JOIN dim_department dep ON s."DepartmentCode" = dep."DepartmentCode" {item_join}
      LEFT JOIN dim_insurance ins ON s."InsuranceCode" = ins."InsuranceCode")"""


def line_fact(source: str, key: str, code_col: str, item: str, amount: str) -> str:
    ties = ["date_k", "patient_k", "doctor_k", "department_k", f"{item}_k", "insurance_k", '"VisitCode"', "quantity", "price", "amount"]
    order = ", ".join(f"{t} DESC" for t in ties)
    return f"""SELECT {sparse('code')} AS "{key}", date_k AS "DateKey", patient_k AS "PatientKey", doctor_k AS "DoctorKey",
      department_k AS "DepartmentKey", {item}_k AS "{item.title()}Key", insurance_k AS "InsuranceKey", "VisitCode",
      code AS "{code_col}", quantity AS "Quantity", price AS "UnitPrice", amount AS "{amount}",
      CAST(amount * rate * 0.01 AS DECIMAL(18,2)) AS "InsurancePaidAmount",
      CAST(amount - amount * rate * 0.01 AS DECIMAL(18,2)) AS "PatientPaidAmount"
      FROM (SELECT *, row_number() OVER (PARTITION BY code {NEWEST.format(id='id')}, {order}) AS rn
            FROM {source} WHERE error_reason IS NULL) WHERE rn = 1"""


DATE_COLUMNS = """CAST(strftime(d, '%Y%m%d') AS INTEGER) AS "DateKey", d AS "FullDate",
  CAST(day(d) AS INTEGER) AS "DayNumber", CAST(month(d) AS INTEGER) AS "MonthNumber", monthname(d) AS "MonthName",
  CAST(quarter(d) AS INTEGER) AS "QuarterNumber", CAST(year(d) AS INTEGER) AS "YearNumber",
  CAST(dayofweek(d) + 1 AS INTEGER) AS "DayOfWeekNumber", dayname(d) AS "DayOfWeekName",
  CAST(dayofweek(d) IN (0, 6) AS INTEGER) AS "IsWeekend" """


def items(kind: str) -> str:
    return f"""SELECT item_id, {code('item_code')} AS c, {words('item_name_raw')} AS "{kind}Name",
      {case('item_type_raw', TYPE if kind == 'Service' else MEDICINE, words('item_type_raw'))} AS "{'ServiceType' if kind == 'Service' else 'MedicineGroup'}",
      {case('unit_raw', UNIT, words('unit_raw'))} AS "Unit", updated_at FROM dirty_items"""


def filled(column: str) -> str:
    return f"""coalesce(CASE WHEN trim(c."{column}") <> '' THEN c."{column}" END, v."{column}") AS "{column}" """


CTES = {
    **{
        name: duckdb_text(name)
        for name in (
            "dirty_visits", "dirty_services", "dirty_prescriptions", "dirty_patients", "dirty_doctors",
            "dirty_departments", "dirty_items", "dirty_plans",
        )
    },
    "visits": f"""
      SELECT *, CASE WHEN "VisitCode" IS NULL OR "VisitCode" = '' THEN 'missing_visit_code'
        WHEN "VisitDate" IS NULL THEN 'invalid_visit_date'
        WHEN "ConsultationFee" IS NULL OR "ConsultationFee" < 0 THEN 'invalid_consultation_fee'
        WHEN "WaitingMinutes" < 0 THEN 'negative_waiting_minutes'
        WHEN "VisitStatus" <> 'COMPLETED' THEN 'not_completed_visit' END AS error_reason
      FROM (SELECT CAST(visit_id AS VARCHAR) AS visit_id, {code('visit_code')} AS "VisitCode",
        coalesce({day('visit_date')}, {time_day('checkin_time')}, {time_day('created_at')}) AS "VisitDate",
        {code('patient_code')} AS "PatientCode", {code('doctor_code')} AS "DoctorCode",
        {code('department_code')} AS "DepartmentCode", {code('insurance_code')} AS "InsuranceCode",
        {MINUTES} AS "WaitingMinutes", {money('consultation_fee_raw')} AS "ConsultationFee",
        {code("coalesce(visit_status, 'UNKNOWN')")} AS "VisitStatus", created_at, updated_at FROM dirty_visits)""",
    "good_visits": "SELECT * EXCLUDE (error_reason) FROM visits WHERE error_reason IS NULL",
    "services": f"""SELECT *, {line_reason('service_transaction', 'service', 'PAID', 'not_paid_service_transaction')}
      FROM ({recovered('dirty_services', LINE_COLUMNS)})""",
    "good_services": "SELECT * EXCLUDE (error_reason) FROM services WHERE error_reason IS NULL",
    "one_visit": f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "VisitCode" {NEWEST.format(id='visit_id')}) AS rn
      FROM good_visits) WHERE rn = 1""",
    "prescriptions": f"""SELECT *, {line_reason('prescription', 'medicine', 'DISPENSED', 'not_dispensed_prescription')} FROM (
      SELECT c.* EXCLUDE (line_day, "PatientCode", "DoctorCode", "DepartmentCode", "InsuranceCode"),
        coalesce(c.line_day, v."VisitDate") AS line_day, {filled('PatientCode')}, {filled('DoctorCode')},
        {filled('DepartmentCode')}, {filled('InsuranceCode')}
      FROM ({recovered('dirty_prescriptions', LINE_COLUMNS)}) c LEFT JOIN one_visit v ON c."VisitCode" = v."VisitCode")""",
    "good_prescriptions": "SELECT * EXCLUDE (error_reason) FROM prescriptions WHERE error_reason IS NULL",
    "patients": f"""SELECT patient_id, {code('patient_code')} AS c, {words('full_name')} AS "FullName",
      {case('gender_raw', GENDER, "'Không xác định'")} AS "Gender", {year('birth_year', 'date_of_birth')} AS "BirthYear",
      {case('city_raw', CITY, words('city_raw'))} AS "City", updated_at FROM dirty_patients""",
    "plans": f"""SELECT insurance_id, {code('insurance_code')} AS c, {label(percent('coverage_rate_raw'))} AS "InsuranceType",
      CAST({percent('coverage_rate_raw')} AS DECIMAL(5,2)) AS "CoverageRate", updated_at FROM dirty_plans""",
    "dim_patient": dim("PatientKey", "PatientCode", f'"FullName", "Gender", "BirthYear", {band(chr(34) + "BirthYear" + chr(34))} AS "AgeGroup", "City"',
                       "1 AS one FROM patients WHERE c IS NOT NULL AND c <> ''", "patient_id"),
    "dim_doctor": dim("DoctorKey", "DoctorCode", f"""{words('doctor_name')} AS "DoctorName",
        {case('gender_raw', {k: v for k, v in GENDER.items() if k != 'Khác'}, "'Không xác định'")} AS "Gender",
        {case('specialty_raw', SPECIALTY, words('specialty_raw'))} AS "Specialty",
        {case('academic_title_raw', TITLE, 'trim(academic_title_raw)')} AS "AcademicTitle" """,
                      f"{code('doctor_code')} AS c FROM dirty_doctors", "doctor_id"),
    "dim_department": dim("DepartmentKey", "DepartmentCode", f"""{words('department_name_raw')} AS "DepartmentName",
        {case('department_group_raw', GROUP, words('department_group_raw'))} AS "DepartmentGroup" """,
                          f"{code('department_code')} AS c FROM dirty_departments", "department_id"),
    "service_items": items("Service"),
    "medicine_items": items("Medicine"),
    "dim_service": dim("ServiceKey", "ServiceCode", '"ServiceName", "ServiceType"', "1 AS one FROM service_items", "item_id"),
    "dim_medicine": dim("MedicineKey", "MedicineCode", '"MedicineName", "MedicineGroup", "Unit"', "1 AS one FROM medicine_items", "item_id"),
    "dim_insurance": dim("InsuranceKey", "InsuranceCode", '"InsuranceType", "CoverageRate"',
                         '1 AS one FROM plans WHERE "CoverageRate" IS NOT NULL', "insurance_id"),
    "days": """SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem""",
    "dim_date": f"SELECT {DATE_COLUMNS} FROM days WHERE d IS NOT NULL",
    "resolved_visits": resolved("good_visits", '"VisitDate"', None),
    "resolved_services": resolved("good_services", "line_day", "service"),
    "resolved_prescriptions": resolved("good_prescriptions", "line_day", "medicine"),
    "fact_services": line_fact("resolved_services", "ServiceRevenueFactKey", "ServiceTransactionCode", "service", "RevenueAmount"),
    "fact_prescriptions": line_fact("resolved_prescriptions", "PrescriptionFactKey", "PrescriptionCode", "medicine", "MedicineRevenueAmount"),
    "fact_visits": f"""SELECT {sparse('"VisitCode"')} AS "VisitFactKey", date_k AS "DateKey", patient_k AS "PatientKey",
      doctor_k AS "DoctorKey", department_k AS "DepartmentKey", insurance_k AS "InsuranceKey", "VisitCode",
      "ConsultationFee", "WaitingMinutes", 1 AS "VisitCount"
      FROM (SELECT *, row_number() OVER (PARTITION BY "VisitCode" {NEWEST.format(id='visit_id')}) AS rn
            FROM resolved_visits WHERE error_reason IS NULL) WHERE rn = 1""",
    "order_codes": "SELECT DISTINCT concat('LK', CAST(o_orderkey AS VARCHAR)) AS code FROM orders",
    "used_codes": "SELECT DISTINCT concat('LK', CAST(l_orderkey AS VARCHAR)) AS code FROM lineitem",
    "used_keys": f"SELECT code, {dense('code')} AS key FROM used_codes",
    "by_priority": """SELECT concat('revenue|', o_orderpriority) AS series_id, CAST(o_orderdate AS DATE) AS ds,
      CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS y FROM orders GROUP BY ALL""",
    "revenue_users": """SELECT 'revenue' AS series_id, CAST(o_orderdate AS DATE) AS ds,
      CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS y FROM orders GROUP BY ALL
      UNION ALL SELECT 'user_count', CAST(o_orderdate AS DATE), CAST(count(DISTINCT o_custkey) AS DOUBLE) FROM orders GROUP BY ALL""",
}


def _gapless(source: str) -> str:
    return f"""SELECT g.series_id, g.ds, s.y FROM (
      SELECT series_id, CAST(unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY)) AS DATE) AS ds
      FROM {source} GROUP BY series_id) g LEFT JOIN {source} s ON g.series_id = s.series_id AND g.ds = s.ds"""


def _linear(gapless: str) -> str:
    return f"""SELECT series_id, ds, CASE WHEN y IS NOT NULL THEN y WHEN yn IS NULL THEN yb
        ELSE yb + (yn - yb) * (ds - db) / (dn - db) END AS y
      FROM (SELECT *,
        last_value(y IGNORE NULLS) OVER b AS yb, last_value(CASE WHEN y IS NOT NULL THEN ds END IGNORE NULLS) OVER b AS db,
        first_value(y IGNORE NULLS) OVER n AS yn, first_value(CASE WHEN y IS NOT NULL THEN ds END IGNORE NULLS) OVER n AS dn
        FROM {gapless}
        WINDOW b AS (PARTITION BY series_id ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               n AS (PARTITION BY series_id ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


CTES |= {
    "gapless": _gapless("by_priority"),
    "linear": _linear("gapless"),
    "gapless2": _gapless("revenue_users"),
    "linear2": _linear("gapless2"),
    "placed": """SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) AS back FROM linear""",
    "naive": """SELECT f.season, t.series_id, t.ds, t.y, k.y AS yhat
      FROM placed t JOIN (SELECT unnest([1, 7, 14]) AS season) f ON t.back <= 15
      JOIN placed k ON k.series_id = t.series_id AND k.back = 15 + f.season - (15 - t.back) % f.season""",
    "scores": """SELECT series_id, season, round(avg(abs(y - yhat)), 4) AS mae,
      round(sqrt(avg((y - yhat) * (y - yhat))), 4) AS rmse FROM naive GROUP BY series_id, season""",
    "verdicts": """SELECT r.series_id, r.mae, c.mae AS old_mae, r.mae <= c.mae AS promoted
      FROM (SELECT * FROM scores WHERE season = 1) r JOIN (SELECT * FROM scores WHERE season = 7) c USING (series_id)""",
}

VALID_SERVICES = """code AS "ServiceTransactionCode", "VisitCode", line_day AS "ServiceDate", "PatientCode", "DoctorCode",
  "DepartmentCode", item AS "ServiceCode", "InsuranceCode", quantity AS "Quantity", price AS "UnitPrice",
  amount AS "RevenueAmount", done AS "PaymentStatus", created_at, updated_at, id AS service_transaction_id"""

TEXTS = {
    "clean_codes": f"""SELECT visit_id, {code('visit_code')} AS code, coalesce(trim(visit_code) = '', true) AS no_code,
      {code("coalesce(visit_status, 'UNKNOWN')")} AS status FROM dirty_visits""",
    "clean_names": f"""SELECT patient_id, {words('full_name')} AS name FROM dirty_patients
      UNION ALL SELECT p_partkey, {words('upper(p_name)')} FROM part""",
    "standardize_category": f"""SELECT patient_id, {case('gender_raw', GENDER, "'Không xác định'")} AS gender,
      {case('city_raw', CITY, words('city_raw'))} AS city FROM dirty_patients""",
    "parse_dates": f"""SELECT visit_id, {day('visit_date')} AS own_date,
      coalesce({day('visit_date')}, {time_day('checkin_time')}, {time_day('created_at')}) AS any_date FROM dirty_visits""",
    "birth_year_band": f"""SELECT patient_id, y AS birth_year, {band('y')} AS age_band
      FROM (SELECT patient_id, {year('birth_year', 'date_of_birth')} AS y FROM dirty_patients)""",
    "parse_money": f"""SELECT txn_id AS id, {money('unit_price_raw')} AS money, {money('total_amount_raw')} AS total FROM dirty_services
      UNION ALL SELECT visit_id, {money('consultation_fee_raw')},
        {money("regexp_replace(consultation_fee_raw, '[.]([0-9]{3})([^0-9]|$)', '\\1\\2')")} FROM dirty_visits""",
    "parse_int": f"""SELECT txn_id AS id, {whole('quantity_raw')} AS whole FROM dirty_services
      UNION ALL SELECT patient_id, {whole('birth_year')} FROM dirty_patients""",
    "coverage_rate": f"""SELECT patient_id, CAST({percent('coverage_rate_raw')} AS DECIMAL(5,2)) AS rate,
      {label(percent('coverage_rate_raw'))} AS label FROM dirty_patients""",
    "waiting_minutes": f"SELECT visit_id, {MINUTES} AS minutes FROM dirty_visits",
    "recover_qty_price": f"SELECT txn_id, quantity, price, amount FROM ({recovered('dirty_services', 'txn_id')})",
    "canonical_columns": """SELECT CAST(txn_id AS VARCHAR) AS service_transaction_id, txn_code AS service_transaction_code,
      visit_code, txn_date AS service_date, patient_code, doctor_code, department_code, item_code AS service_code,
      insurance_code, quantity_raw, unit_price_raw, total_amount_raw, CAST(NULL AS VARCHAR) AS insurance_paid_raw,
      CAST(NULL AS VARCHAR) AS patient_paid_raw, status AS payment_status, created_at, updated_at FROM dirty_services""",
    "classify_visits_valid": "SELECT * FROM good_visits",
    "classify_visits_rejected": "SELECT * FROM visits WHERE error_reason IS NOT NULL",
    "classify_services_valid": f"SELECT {VALID_SERVICES} FROM good_services",
    "classify_services_rejected": """SELECT id AS service_transaction_id, code AS "ServiceTransactionCode", error_reason
      FROM services WHERE error_reason IS NOT NULL""",
    "classify_prescriptions_valid": """SELECT code AS "PrescriptionCode", "VisitCode", line_day AS "PrescriptionDate",
      "PatientCode", "DoctorCode", "DepartmentCode", item AS "MedicineCode", "InsuranceCode", quantity AS "Quantity",
      price AS "UnitPrice", amount AS "MedicineRevenueAmount", done AS "DispenseStatus", created_at, updated_at,
      id AS prescription_id FROM good_prescriptions""",
    "classify_masters": f"""SELECT name, verdict, count(*) AS n FROM (
      SELECT 'stg_patients' AS name, CASE WHEN c IS NULL OR c = '' THEN 'missing_patient_code' ELSE 'valid' END AS verdict FROM patients
      UNION ALL SELECT 'stg_doctors', 'valid' FROM supplier UNION ALL SELECT 'stg_departments', 'valid' FROM nation
      UNION ALL SELECT 'stg_services', 'valid' FROM part UNION ALL SELECT 'stg_medicines', 'valid' FROM part
      UNION ALL SELECT 'stg_insurance', CASE WHEN "CoverageRate" IS NULL THEN 'invalid_insurance_code_or_coverage_rate'
        ELSE 'valid' END FROM plans) GROUP BY name, verdict""",
    "quarantine_reasons": """SELECT error_reason, count(*) AS n FROM (SELECT error_reason FROM visits
      UNION ALL SELECT error_reason FROM services) WHERE error_reason IS NOT NULL GROUP BY error_reason""",
    "fill_from_parent": f"""WITH v AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "VisitCode"
        {NEWEST.format(id='visit_id')}) AS rn FROM visits WHERE "VisitCode" <> '') WHERE rn = 1)
      SELECT c.txn_id, c."VisitCode", coalesce(c.d, v."VisitDate") AS "Day", {filled('DoctorCode')}, {filled('DepartmentCode')}
      FROM (SELECT txn_id, {code('visit_code')} AS "VisitCode", {day('txn_date')} AS d, {code('doctor_code')} AS "DoctorCode",
            {code('department_code')} AS "DepartmentCode" FROM dirty_prescriptions) c LEFT JOIN v ON c."VisitCode" = v."VisitCode" """,
    "latest_per_key": f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY patient_code
      {NEWEST.format(id='patient_id')}) AS rn FROM dirty_patients WHERE patient_code IS NOT NULL) WHERE rn = 1""",
    "latest_transaction": f"""SELECT code AS "ServiceTransactionCode", id AS service_transaction_id, updated_at,
      quantity AS "Quantity", price AS "UnitPrice", "DoctorCode" FROM (SELECT *, row_number() OVER (PARTITION BY code
      {NEWEST.format(id='id')}, quantity DESC, price DESC, "DoctorCode" DESC NULLS LAST) AS rn FROM services) WHERE rn = 1""",
    "dense_keys": f"SELECT {dense('code')} AS key, code FROM order_codes",
    "dense_keys_reused": f"""SELECT coalesce(key, (SELECT max(key) FROM used_keys) + row_number() OVER
        (PARTITION BY key IS NULL ORDER BY {bucket('code')}, code)) AS key, code
      FROM order_codes LEFT JOIN used_keys USING (code)""",
    "sparse_keys": f"SELECT {sparse('code')} AS key, code FROM order_codes",
    **{n: f"SELECT * FROM {n}" for n in ("dim_patient", "dim_doctor", "dim_department", "dim_service", "dim_medicine", "dim_insurance", "dim_date")},
    "star_join": """SELECT id AS service_transaction_id, date_k AS "DateKey", patient_k AS "PatientKey", doctor_k AS "DoctorKey",
      department_k AS "DepartmentKey", service_k AS "ServiceKey", insurance_k AS "InsuranceKey", rate AS "CoverageRate"
      FROM resolved_services WHERE error_reason IS NULL""",
    "orphans": f"SELECT {VALID_SERVICES}, error_reason FROM resolved_services WHERE error_reason IS NOT NULL",
    "orphan_visits": """SELECT * EXCLUDE (date_k, patient_k, doctor_k, department_k, insurance_k, rate) FROM resolved_visits
      WHERE error_reason IS NOT NULL""",
    "split_payment": """SELECT l_orderkey, l_linenumber, amount, rate, CAST(amount * rate * 0.01 AS DECIMAL(18,2)) AS insurance,
        CAST(amount - amount * rate * 0.01 AS DECIMAL(18,2)) AS patient,
        CAST(amount - CAST(amount * rate * 0.01 AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS patient_balanced
      FROM (SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
            CAST(l_discount * 1000 AS DECIMAL(5,2)) AS rate FROM lineitem)""",
    "fact_visit": "SELECT * FROM fact_visits",
    "fact_service_revenue": "SELECT * FROM fact_services",
    "fact_prescription": "SELECT * FROM fact_prescriptions",
    "revenue_per_day": """SELECT "DateKey", CAST(sum("RevenueAmount") AS DECIMAL(38,2)) AS revenue,
      CAST(sum("InsurancePaidAmount") AS DECIMAL(38,2)) AS insurance_paid, count(DISTINCT "PatientKey") AS patients
      FROM fact_services GROUP BY "DateKey" ORDER BY "DateKey" """,
    "upsert": f"""WITH d AS (SELECT * FROM dirty_patients WHERE patient_code IS NOT NULL),
      new AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY patient_code
        {NEWEST.format(id='patient_id')}) AS rn FROM d WHERE updated_at >= '2024-02-01') WHERE rn = 1)
      SELECT * FROM d WHERE updated_at < '2024-02-01' AND patient_code NOT IN (SELECT patient_code FROM new)
      UNION ALL SELECT * FROM new""",
    "registered_views": """WITH spent AS (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total, count(*) AS n
        FROM orders GROUP BY o_custkey)
      SELECT n_name AS nation, c_mktsegment AS segment, CAST(sum(total) AS DECIMAL(38,2)) AS total,
        CAST(sum(n) AS BIGINT) AS orders, count(DISTINCT c_custkey) AS customers
      FROM spent JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      GROUP BY n_name, c_mktsegment ORDER BY nation, segment""",
    "customers_without_orders": """SELECT c_custkey, c_name FROM customer
      LEFT JOIN (SELECT DISTINCT o_custkey FROM orders) ON c_custkey = o_custkey WHERE o_custkey IS NULL""",
    "left_join_status": """SELECT c_custkey, last_order, CASE WHEN last_order IS NULL THEN 'new' ELSE 'known' END AS kind
      FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS last_order FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey""",
    "distinct_days": "SELECT d AS day FROM days WHERE d IS NOT NULL",
    "top_order_per_customer": """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER
      (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
    "string_functions": """SELECT c_custkey, upper(c_name) AS up, lower(c_name) AS low, trim(concat('  ', c_name, ' ')) AS trimmed,
      regexp_replace(c_name, '[0-9]+', '#', 'g') AS masked, c_mktsegment IN ('BUILDING', 'MACHINERY') AS heavy FROM customer""",
    "date_functions": """SELECT o_orderkey, CAST(year(t) AS INTEGER) AS y, CAST(month(t) AS INTEGER) AS m, CAST(day(t) AS INTEGER) AS d,
      CAST(quarter(t) AS INTEGER) AS q, CAST(dayofweek(t) + 1 AS INTEGER) AS dow, strftime(t, '%Y%m%d') AS compact,
      monthname(t) AS month_name, dayname(t) AS day_name, CAST(strftime(t, '%Y%m%d') AS INTEGER) AS date_key,
      CAST(t AS DATE) AS back FROM (SELECT o_orderkey, o_orderdate AS t FROM orders)""",
    "math_functions": """SELECT l_orderkey, l_linenumber, CAST(q * p AS DECIMAL(18,2)) AS product,
      CAST(round(p, 1) AS DECIMAL(18,1)) AS rounded, CAST(greatest(q, 25) AS DECIMAL(18,2)) AS at_least_25,
      CASE WHEN q BETWEEN 10 AND 20 THEN 'mid' ELSE 'other' END AS band, coalesce(CASE WHEN q > 40 THEN 'big' END, 'small') AS size
      FROM (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DECIMAL(18,2)) AS q, CAST(l_extendedprice AS DECIMAL(18,2)) AS p FROM lineitem)""",
    "human_number": """WITH t AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS x FROM orders GROUP BY o_custkey)
      SELECT o_custkey,
        CASE WHEN x >= 1e9 THEN format('{:.2f}B', x / 1e9) WHEN x >= 1e6 THEN format('{:.2f}M', x / 1e6)
             ELSE format('{:,}', CAST(round_even(x, 0) AS BIGINT)) END AS compact,
        CASE WHEN x * 4096 >= 1e9 THEN format('{:.2f}B', x * 4096 / 1e9) WHEN x * 4096 >= 1e6 THEN format('{:.2f}M', x * 4096 / 1e6)
             ELSE format('{:,}', CAST(round_even(x * 4096, 0) AS BIGINT)) END AS larger,
        concat(format('{:,}', CAST(floor(x) AS BIGINT)), '.00') AS plain FROM t""",
    "layer_roundtrip": """SELECT CAST(patient_id AS VARCHAR) AS patient_id, CASE WHEN c <> '' THEN c END AS "PatientCode",
      CASE WHEN c IS NULL OR c = '' THEN 'missing_patient_code' END AS error_reason FROM patients""",
    "land_tables": """SELECT r_name, count(*) AS customers, count(DISTINCT n_name) AS nations FROM customer
      JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""",
    "row_counts": """SELECT 'stg_visits' AS name, count(*) AS rows, count(*) FILTER (error_reason IS NULL) AS valid,
        count(*) FILTER (error_reason IS NOT NULL) AS rejected FROM visits
      UNION ALL SELECT 'stg_service_transactions', count(*), count(*) FILTER (error_reason IS NULL),
        count(*) FILTER (error_reason IS NOT NULL) FROM services""",
    "daily_revenue": """SELECT 'revenue' AS series_id, CAST(o_orderdate AS DATE) AS ds,
      CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS y FROM orders GROUP BY ALL ORDER BY ds""",
    "daily_users": """SELECT 'users' AS series_id, CAST(o_orderdate AS DATE) AS ds, count(DISTINCT o_custkey) AS y
      FROM orders GROUP BY ALL ORDER BY ds""",
    "daily_series_by": "SELECT * FROM by_priority",
    "fill_gaps": "SELECT * FROM gapless",
    "interpolate": "SELECT * FROM linear",
    "history": "SELECT series_id, ds, CASE WHEN series_id = 'user_count' THEN round_even(y, 0) ELSE y END AS y FROM linear2",
    "holdout_split": """SELECT series_id, ds, CASE WHEN back <= 15 THEN 'test' WHEN back <= 30 THEN 'validation' ELSE 'train' END AS segment
      FROM placed""",
    "seasonal_naive": "SELECT series_id, ds, y, yhat FROM naive WHERE season = 7",
    "accuracy": "SELECT series_id, mae, rmse FROM scores WHERE season = 7",
    "select_best": """SELECT series_id, CAST(pos AS INTEGER) AS pos, CAST(season AS INTEGER) AS season, mae AS val_mae FROM (
      SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY mae, pos) AS rn
      FROM (SELECT *, CASE season WHEN 1 THEN 0 WHEN 7 THEN 1 ELSE 2 END AS pos FROM scores)) WHERE rn = 1""",
    "promote": "SELECT * FROM verdicts",
    "crown": "SELECT series_id, CASE WHEN promoted THEN mae ELSE old_mae END AS mae FROM verdicts",
}


def _warehouse_counts() -> str:
    tables = {
        "dim_date": """SELECT DISTINCT d FROM (SELECT "VisitDate" AS d FROM good_visits UNION ALL SELECT line_day FROM good_services
          UNION ALL SELECT line_day FROM good_prescriptions)""",
        **{f"dim_{n}": f"SELECT 1 FROM dim_{n}" for n in ("patient", "doctor", "department", "service", "medicine", "insurance")},
        "fact_visit": "SELECT 1 FROM fact_visits",
        "fact_service_revenue": "SELECT 1 FROM fact_services",
        "fact_prescription": "SELECT 1 FROM fact_prescriptions",
    }
    return " UNION ALL ".join(f"SELECT '{name}' AS name, count(*) AS n FROM ({text})" for name, text in tables.items())


TEXTS["warehouse_load"] = _warehouse_counts()


# Least squares and recursion ---------------------------------------------------------------------------------------


def _exact(tag: str, known: str, chosen: str, steps: int) -> None:
    """Sub-queries from (series_id, ys) and (series_id, pos, p, d, sp, sd) to `said_<tag>` (series_id, pos, yhats)."""
    times = lambda n, i: f"CASE WHEN {n} = 2 AND {i} = 1 THEN 2 ELSE 1 END"
    CTES[f"forms_{tag}"] = f"""SELECT *, list_transform(range(0, d + 7 * sd + 1), lambda k: CASE WHEN k % 7 <= d AND k // 7 <= sd
        THEN (CASE WHEN (k % 7 + k // 7) % 2 = 0 THEN 1.0 ELSE -1.0 END) * ({times('d', 'k % 7')}) * ({times('sd', 'k // 7')}) ELSE 0.0 END) AS poly,
      list_filter(range(1, p + 7 * sp + 1), lambda k: k % 7 <= p AND k // 7 <= sp) AS lags
      FROM {chosen} JOIN {known} USING (series_id)"""
    CTES[f"moved_{tag}"] = f"""SELECT * EXCLUDE (poly), list_transform(poly, lambda c: CAST(c AS DOUBLE)) AS poly,
      list_transform(range(len(poly), len(ys) + 1),
        lambda t: list_sum(list_transform(range(1, len(poly) + 1), lambda k: CAST(poly[k] AS DOUBLE) * ys[t - k + 1]))) AS w FROM forms_{tag}"""
    dot = lambda a, b: f"list_sum(list_transform(range(lags[-1] + 1, len(w) + 1), lambda t: w[t - {a}] * w[t - {b}]))"
    CTES[f"system_{tag}"] = f"""SELECT *, list_transform(lags, lambda a: list_append(list_transform(lags, lambda b: {dot('a', 'b')}), {dot('a', '0')})) AS m
      FROM moved_{tag}"""
    CTES[f"rec_solve_{tag}"] = f"""SELECT series_id, pos, 0 AS j, m FROM system_{tag} UNION ALL
      SELECT series_id, pos, j + 1, list_transform(m, lambda r, i: list_transform(r, lambda x, c:
        CASE WHEN i = j + 1 THEN x / m[j + 1][j + 1] ELSE x - r[j + 1] * (m[j + 1][c] / m[j + 1][j + 1]) END)) FROM rec_solve_{tag} WHERE j < len(m)"""
    CTES[f"fitted_{tag}"] = f"""SELECT s.series_id, s.pos, s.poly, s.lags, s.w, s.ys, list_transform(r.m, lambda x: x[-1]) AS coef
      FROM system_{tag} s JOIN rec_solve_{tag} r ON s.series_id = r.series_id AND s.pos = r.pos AND r.j = len(r.m)"""
    value = "coalesce(list_sum(list_transform(coef, lambda c, i: c * w[len(w) - lags[i] + 1])), 0)"
    back = "coalesce(list_sum(list_transform(range(2, len(poly) + 1), lambda k: poly[k] * y[len(y) - k + 2])), 0)"
    CTES[f"rec_roll_{tag}"] = f"""SELECT series_id, pos, poly, lags, coef, 0 AS step, w[-20:] AS w, ys[-20:] AS y, CAST([] AS DOUBLE[]) AS yhats FROM fitted_{tag}
      UNION ALL SELECT series_id, pos, poly, lags, coef, step + 1, list_append(w[-19:], {value}), list_append(y[-19:], {value} - {back}),
        list_append(yhats, {value} - {back}) FROM rec_roll_{tag} WHERE step < {steps}"""
    CTES[f"said_{tag}"] = f"SELECT series_id, pos, yhats FROM rec_roll_{tag} WHERE step = {steps}"


CTES["both_days"] = """SELECT series_id, ds, CASE WHEN series_id = 'user_count' THEN round_even(y, 0) ELSE y END AS y,
  row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) AS back FROM linear2"""
CTES["train_values"] = "SELECT series_id, list(y ORDER BY ds) AS ys FROM both_days WHERE back > 30 GROUP BY series_id"
CTES["known_values"] = "SELECT series_id, list(y ORDER BY ds) AS ys FROM both_days WHERE back > 15 GROUP BY series_id"
CTES["plain_orders"] = """SELECT series_id, p * 243 + d * 81 + sp * 9 + sd * 3 AS pos, p, d, sp, sd
  FROM (SELECT DISTINCT series_id FROM both_days), (SELECT unnest(range(3)) AS p), (SELECT unnest(range(3)) AS d),
    (SELECT unnest(range(3)) AS sp), (SELECT unnest(range(3)) AS sd)"""
_exact("grid", "train_values", "plain_orders", 15)
CTES["both_scales"] = "SELECT series_id, avg(abs(y)) AS scale FROM both_days GROUP BY series_id"
CTES["plain_scores"] = """SELECT series_id, pos, avg(abs(yhat - y)) AS val_mae
  FROM (SELECT series_id, pos, unnest(yhats) AS yhat, unnest(range(15)) AS i FROM said_grid)
  JOIN (SELECT series_id, y, 30 - back AS i FROM both_days WHERE back BETWEEN 16 AND 30) USING (series_id, i) GROUP BY series_id, pos"""
CTES["plain_best"] = """SELECT o.* FROM (SELECT series_id, min_by(pos, (val_mae, pos)) AS pos FROM plain_scores GROUP BY series_id) b
  JOIN plain_orders o ON o.series_id = b.series_id AND o.pos = b.pos"""
_exact("best", "known_values", "plain_best", 45)
CTES["champion_values"] = """SELECT series_id, list(y ORDER BY ds) AS ys FROM linear l
  WHERE ds <= (SELECT max(ds) - 60 FROM linear x WHERE x.series_id = l.series_id) GROUP BY series_id"""
CTES["champion_orders"] = "SELECT DISTINCT series_id, 495 AS pos, 2 AS p, 0 AS d, 1 AS sp, 0 AS sd FROM linear"
_exact("champion", "champion_values", "champion_orders", 60)

TEXTS |= {
    "grid_search_exact": """SELECT s.series_id, CAST(o.pos AS INTEGER) AS pos, CAST(p AS INTEGER) AS p, CAST(d AS INTEGER) AS d, 0 AS q,
        CAST(sp AS INTEGER) AS sp, CAST(sd AS INTEGER) AS sd, 0 AS sq, 7 AS season, round(val_mae / scale, 5) AS score
      FROM plain_scores s JOIN plain_orders o USING (series_id, pos) JOIN both_scales USING (series_id)""",
    "forecast_exact": """SELECT series_id, CAST(last + i + 1 AS DATE) AS ds, CASE WHEN i < 15 THEN 'test' ELSE 'future' END AS segment,
        round(yhat / scale, 5) AS yhat
      FROM (SELECT series_id, unnest(yhats) AS yhat, CAST(unnest(range(45)) AS INTEGER) AS i FROM said_best)
      JOIN (SELECT series_id, max(ds) AS last FROM both_days WHERE back > 15 GROUP BY series_id) USING (series_id) JOIN both_scales USING (series_id)""",
    "champion_stored": """SELECT series_id, ds, round(yhat / scale, 5) AS yhat
      FROM (SELECT series_id, unnest(yhats) AS yhat, 60 - unnest(range(60)) AS back FROM said_champion)
      JOIN placed USING (series_id, back) JOIN (SELECT series_id, avg(abs(y)) AS scale FROM linear GROUP BY series_id) USING (series_id)
      WHERE back <= 15""",
    "forecast_status": """WITH several AS (SELECT concat(series_id, '|y', year(ds)) AS series_id, ds, y FROM linear
        UNION ALL SELECT concat(series_id, '|', year(ds)), ds, y FROM linear WHERE month(ds) = 3 AND day(ds) <= 30),
      sized AS (SELECT *, count(*) OVER (PARTITION BY series_id) AS n, row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) AS back FROM several),
      enough AS (SELECT * FROM sized WHERE n > 30),
      tried AS (SELECT t.series_id, f.season, f.pos, round(avg(abs(t.y - k.y)), 4) AS mae
        FROM enough t JOIN (SELECT unnest([1, 7, 14]) AS season, unnest([0, 1, 2]) AS pos) f ON t.back <= 15
        JOIN enough k ON k.series_id = t.series_id AND k.back = 15 + f.season - (15 - t.back) % f.season GROUP BY ALL),
      known AS (SELECT series_id, list(y ORDER BY ds) AS ys FROM enough WHERE back > 15 GROUP BY series_id),
      turns AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY mae, pos) AS turn,
        CAST(trunc(ys[-1]) AS BIGINT) % 5 = 0 OR (CAST(trunc(ys[-1]) AS BIGINT) % 2 = 0 AND season <> 1) AS fails FROM tried JOIN known USING (series_id)),
      firsts AS (SELECT series_id, min(turn) FILTER (NOT fails) AS turn FROM turns GROUP BY series_id)
      SELECT f.series_id, CASE WHEN f.turn IS NULL THEN 'failed' WHEN f.turn = 1 THEN 'fitted' ELSE 'fallback' END AS status,
        CAST(t.pos AS INTEGER) AS pos, CAST(coalesce(f.turn - 1, 3) AS INTEGER) AS failures,
        round(list_sum(list_transform(range(20), lambda i: ys[len(ys) - season + CAST(i % season AS BIGINT) + 1])), 2) AS total
      FROM firsts f LEFT JOIN turns t ON f.series_id = t.series_id AND f.turn = t.turn
      UNION ALL SELECT DISTINCT series_id, 'too_short', CAST(NULL AS INTEGER), 0, CAST(NULL AS DOUBLE) FROM sized WHERE n <= 30""",
}


# Rejected, orphan and line-level prescriptions, splits, sketches, refreshed days, a grid of one's own --------------------

CTES["coded_prescriptions"] = "SELECT * REPLACE (concat('rx', txn_id // 10) AS txn_code) FROM dirty_prescriptions"
for _name in ("prescriptions", "good_prescriptions", "resolved_prescriptions"):
    _text = re.sub(r"\b(good_|resolved_)?prescriptions\b", r"\1line_prescriptions", CTES[_name]).replace("dirty_prescriptions", "coded_prescriptions")
    CTES[re.sub(r"prescriptions", "line_prescriptions", _name)] = _text
CTES["identified_lines"] = "SELECT * REPLACE (concat(code, chr(1), CAST(CAST(id AS BIGINT) % 10 AS VARCHAR)) AS code), code AS own_code FROM resolved_line_prescriptions"

TEXTS |= {
    "classify_prescriptions_rejected": """SELECT id AS prescription_id, code AS "PrescriptionCode", error_reason
      FROM prescriptions WHERE error_reason IS NOT NULL""",
    "orphan_prescriptions": """SELECT id AS prescription_id, code AS "PrescriptionCode", item AS "MedicineCode", "DoctorCode", quantity AS "Quantity",
      error_reason FROM resolved_prescriptions WHERE error_reason IS NOT NULL""",
    "fact_prescription_lines": line_fact("identified_lines", "PrescriptionFactKey", "_identity", "medicine", "MedicineRevenueAmount").replace(
        'code AS "_identity"', """own_code AS "PrescriptionCode", CAST(CAST(id AS BIGINT) % 10 AS VARCHAR) AS prescription_line_no"""),
    "masters_rejected": """SELECT 'stg_patients' AS name, CAST(patient_id AS VARCHAR) AS id, c AS code, 'missing_patient_code' AS error_reason
        FROM patients WHERE c IS NULL OR c = ''
      UNION ALL SELECT 'stg_insurance', CAST(insurance_id AS VARCHAR), c, 'invalid_insurance_code_or_coverage_rate' FROM plans
        WHERE "CoverageRate" IS NULL""",
    "jdbc_splits": """SELECT 'even' AS name, count(*) AS rows, count(*) AS met, 8 AS parts, true AS even FROM orders
      UNION ALL SELECT unnest(['skewed', 'with_null']), count(*), count(*), 8, true FROM lineitem""",
    "users_by_period": """SELECT kind, CAST(date_trunc(kind, CAST(o_orderdate AS DATE)) AS DATE) AS period, count(DISTINCT o_custkey) AS exact, true AS close
      FROM orders, (SELECT unnest(['week', 'month']) AS kind) GROUP BY ALL""",
    "daily_refresh": """WITH o AS (SELECT o_orderkey AS k, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS day, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_custkey AS who FROM orders),
      t AS (SELECT day FROM o WHERE k % 400 = 3 OR k % 500 = 7 OR (k % 700 = 9 AND day <> 19970704)
        UNION SELECT 19970704 FROM o WHERE k % 700 = 9 AND day <> 19970704 AND k % 400 <> 3)
      SELECT day AS "DateKey", CAST(sum(amount) AS DECIMAL(38,2)) AS revenue, count(DISTINCT who) AS users, day IN (SELECT day FROM t) AS made_anew
      FROM o GROUP BY day""",
    "grid_given": """SELECT series_id, CAST(i AS INTEGER) AS pos, CAST(i % 2 % 3 AS INTEGER) AS p, CAST(i % 3 % 3 AS INTEGER) AS d, CAST(i % 4 % 3 AS INTEGER) AS q,
        CAST(i % 5 % 3 AS INTEGER) AS sp, CAST(i % 6 % 3 AS INTEGER) AS sd, CAST(i % 7 % 3 AS INTEGER) AS sq,
        CASE WHEN i = 11 THEN 2000 WHEN i % 2 = 0 THEN 7 ELSE 14 END AS season, i <> 11 AS scored
      FROM (SELECT DISTINCT series_id FROM by_priority), (SELECT unnest(range(12)) AS i)""",
}


# Two days of the warehouse ---------------------------------------------------------------------------------------

DATES = ("2024-06-01", "2024-06-02")
LINE_KEYS = ("DateKey", "DepartmentKey", "DoctorKey", "InsuranceKey", "PatientKey")
LINE_VALUES = ("InsurancePaidAmount", "PatientPaidAmount", "Quantity", "UnitPrice", "VisitCode")
# Warehouse table -> surrogate key, code, other columns.
WAREHOUSE = {
    "dim_date": ("DateKey", "DateKey", ("FullDate", "DayNumber", "MonthNumber", "MonthName", "QuarterNumber", "YearNumber",
                                        "DayOfWeekNumber", "DayOfWeekName", "IsWeekend")),
    "dim_patient": ("PatientKey", "PatientCode", ("FullName", "Gender", "BirthYear", "AgeGroup", "City")),
    "dim_doctor": ("DoctorKey", "DoctorCode", ("DoctorName", "Gender", "Specialty", "AcademicTitle")),
    "dim_department": ("DepartmentKey", "DepartmentCode", ("DepartmentName", "DepartmentGroup")),
    "dim_service": ("ServiceKey", "ServiceCode", ("ServiceName", "ServiceType")),
    "dim_medicine": ("MedicineKey", "MedicineCode", ("MedicineName", "MedicineGroup", "Unit")),
    "dim_insurance": ("InsuranceKey", "InsuranceCode", ("InsuranceType", "CoverageRate")),
    "fact_visit": ("VisitFactKey", "VisitCode", (*LINE_KEYS, "ConsultationFee", "WaitingMinutes", "VisitCount")),
    "fact_service_revenue": ("ServiceRevenueFactKey", "ServiceTransactionCode", (*LINE_KEYS, *LINE_VALUES, "ServiceKey", "RevenueAmount")),
    "fact_prescription": ("PrescriptionFactKey", "PrescriptionCode", (*LINE_KEYS, *LINE_VALUES, "MedicineKey", "MedicineRevenueAmount")),
}
# The sub-query that gives a table of one day on its own.
OF_DAY = {**{n: n for n in WAREHOUSE}, "fact_visit": "fact_visits", "fact_service_revenue": "fact_services", "fact_prescription": "fact_prescriptions"}
CTES["own_days"] = f"""SELECT {DATE_COLUMNS} FROM (SELECT "VisitDate" AS d FROM good_visits UNION SELECT line_day FROM good_services
  UNION SELECT line_day FROM good_prescriptions)"""
OF_DAY["dim_date"] = "own_days"
_NAME = r"(?<![\w\"'.])({})\b(?!['\"])"


def _needed(text: str) -> set[str]:
    found = {n for n in CTES if re.search(_NAME.format(n), text)}
    return found.union(*[_needed(CTES[n]) for n in found]) if found else found


def _day(tag: str, variant: str, before: str | None) -> None:
    """Copies of all sub-queries for a day; codes known to the day before keep their keys."""
    names = set().union(*[_needed(n) for n in OF_DAY.values()]) - {"days", "dim_date"}
    again = lambda text: re.sub(_NAME.format("|".join(sorted(names, key=len, reverse=True))), rf"\1_{tag}", text)
    for name in [n for n in CTES if n in names]:
        table = next((t for t, own in OF_DAY.items() if own == name), None)
        text = again(CTES[name])
        if name.startswith("dirty_"):
            text = LATER[variant].get(name, "SELECT * FROM {table}").replace("{table}", name).replace("{but}", "EXCLUDE")
        elif before and table and table != "dim_date":
            text = _known_keys(text, table, before)
        CTES[f"{name}_{tag}"] = text
    for table, (_, code_col, _) in WAREHOUSE.items():
        own = f"SELECT * FROM {OF_DAY[table]}_{tag}"
        if before:
            own += f""" UNION ALL BY NAME SELECT * FROM {table}_at_{before}
              WHERE "{code_col}" NOT IN (SELECT "{code_col}" FROM {OF_DAY[table]}_{tag})"""
        CTES[f"{table}_at_{tag}"] = own


def _known_keys(text: str, table: str, before: str) -> str:
    key, code_col, _ = WAREHOUSE[table]
    c = f'f."{code_col}"'
    known = f"""SELECT f.* EXCLUDE ("{key}"), k."{key}" AS known FROM ({text}) f LEFT JOIN {table}_at_{before} k ON {c} = k."{code_col}" """
    if table.startswith("dim_"):
        fresh = f"""(SELECT max("{key}") FROM {table}_at_{before})
          + row_number() OVER (PARTITION BY known IS NULL ORDER BY {bucket(c)}, {c})"""
    else:
        fresh = f"""CAST(concat('0x', {bucket(c)}) AS BIGINT) * 68719476736
          + coalesce((SELECT max(b."{key}") % 68719476736 FROM {table}_at_{before} b WHERE {bucket(f'b."{code_col}"')} = {bucket(c)}), 0)
          + row_number() OVER (PARTITION BY {bucket(c)}, known IS NULL ORDER BY {c})"""
    return f"""SELECT * EXCLUDE (known), coalesce(known, {fresh}) AS "{key}" FROM ({known}) f"""


def _content(phase: str, tags: tuple[str, str]) -> str:
    parts = []
    for tag, day_ in zip(tags, DATES):
        for table, (key, code_col, others) in WAREHOUSE.items():
            columns = sorted({key, code_col, *others})
            texts = ", ".join(f"""coalesce(CAST("{c}" AS VARCHAR), '~')""" for c in columns)
            parts.append(f"""SELECT '{phase}' AS phase, '{day_}' AS run_date, '{table}' AS name, CAST("{key}" AS BIGINT) AS key,
              concat_ws('|', {texts}) AS content FROM {table}_at_{tag}""")
    return " UNION ALL ".join(parts)


def _written(first: str, second: str) -> str:
    parts = []
    for table, (key, code_col, others) in WAREHOUSE.items():
        columns = ", ".join(f'"{c}"' for c in sorted({key, code_col, *others}))
        parts.append(f"""SELECT 'written', '{DATES[1]}', '{table}', (SELECT count(*) FROM (SELECT {columns} FROM {OF_DAY[table]}_{second}
          EXCEPT SELECT {columns} FROM {table}_at_{first})), CAST((SELECT count(*) FROM {table}_at_{second}) AS VARCHAR)""")
    return " UNION ALL ".join(parts)


_day("a1", "first", None)
_day("a2", "second", "a1")
_day("c1", "corrected", None)
_day("c2", "second", "c1")
# Patients and departments of the corrected first day are others, and with them all facts that found them.
_STALE = [f"gold.Dim_{n}" for n in ("Patient", "Department")] + [f"gold.Fact_{n}" for n in ("Visit", "ServiceRevenue", "Prescription")]
_STALE += [f"warehouse.{n}" for n in ("dim_patient", "dim_department", "fact_visit", "fact_service_revenue", "fact_prescription")]
TEXTS["warehouse_days"] = " UNION ALL ".join([
    _content("loaded", ("a1", "a2")), _content("corrected", ("c1", "c2")), _written("a1", "a2"),
    *[f"SELECT 'stale', '{DATES[1]}', '{name}', 0, ''" for name in _STALE],
])


def sql(name: str) -> str:
    """The text of a query with every shared sub-query it needs in front."""
    text, needed = TEXTS[name], []

    def visit(body: str) -> None:
        for cte in CTES:
            if cte not in needed and re.search(rf"(?<![\w\"'.]){cte}\b(?!['\"])", body):
                needed.append(cte)
                visit(CTES[cte])

    visit(text)
    order = [n for n in CTES if n in needed]
    if not order:
        return text
    shared = ",\n".join(f"{n} AS ({CTES[n]})" for n in order)
    # A text with sub-queries of its own continues the list.
    words = "WITH RECURSIVE" if any(n.startswith("rec_") for n in order) else "WITH"
    if text.lstrip().startswith("WITH "):
        return f"{words} {shared},\n{text.lstrip()[5:]}"
    return f"{words} {shared}\n{text}"
