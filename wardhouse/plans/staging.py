"""Cleansing per source table.

Each `stage_*` function returns a judged frame: the cleansed columns, `error_reason` (NULL when valid), and for
rejected master rows the source row in `raw`. It is computed in one pass and can be written once; `silver` and
`quarantine` then only select from it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardhouse.functions import (
    age_band,
    birth_year,
    clean_code,
    clean_name,
    clean_status,
    elapsed_minutes,
    line_amount,
    parse_date,
    parse_int,
    parse_money,
    parse_rate,
    percent_value,
    rate_label,
    recover_price,
    recover_quantity,
    standardize,
)
from wardhouse.operators.canonical import canonicalize
from wardhouse.operators.quality import REASON, Rule, fill_from_parent, present, verdict
from wardhouse.plans import vocabulary as v

RAW = "raw"


def newest_first(id_col: str, *more: str, text_order: bool = False) -> list[Column]:
    """Order for the latest row: update time, then id, then further columns against ties.

    Times and ids compare as such. `text_order=True` compares both as text, where id 9 is above id 10.
    """
    time, number = F.col("updated_at"), F.col(id_col)
    if not text_order:
        time, number = time.try_cast("timestamp"), number.try_cast("long")
    return [c.desc_nulls_last() for c in (time, number, *[F.col(m) for m in more])]


def _columns(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(", ")]


def silver(judged: DataFrame, name: str) -> DataFrame:
    """The valid rows with the columns of the cleansed table."""
    return judged.where(F.col(REASON).isNull()).select(*_columns(v.SILVER_COLUMNS[name]))


def quarantine(judged: DataFrame) -> DataFrame:
    """The rejected rows: the source row where it was kept, else the parsed columns; always with the reason."""
    bad = judged.where(F.col(REASON).isNotNull())
    return bad.select(f"{RAW}.*", REASON) if RAW in judged.columns else bad


def _master(raw: DataFrame, table: str, rules: Sequence[Rule], **columns: Column) -> DataFrame:
    source = canonicalize(raw, v.alias_map(table))
    whole_row = F.struct(*[F.col(f"`{c}`") for c in source.columns])
    clean = source.select(
        *[c.alias(name) for name, c in columns.items()], "updated_at", v.SOURCE_COLUMNS[table][0], whole_row.alias("_row")
    )
    judged = clean.select("*", verdict(rules).alias(REASON))
    kept = F.when(F.col(REASON).isNotNull(), F.col("_row"))
    return judged.select(*clean.columns[:-1], kept.alias(RAW), REASON)


def stage_patients(raw: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    year = birth_year("birth_year", "date_of_birth", as_of)
    return _master(
        raw,
        "patients",
        [present("missing_patient_code", "PatientCode")],
        PatientCode=clean_code("patient_code"),
        FullName=clean_name("full_name"),
        Gender=standardize("gender_raw", v.PATIENT_GENDER, v.UNKNOWN),
        BirthYear=year,
        AgeGroup=age_band(year, as_of),
        City=standardize("city_raw", v.CITY),
    )


def stage_doctors(raw: DataFrame) -> DataFrame:
    return _master(
        raw,
        "doctors",
        [present("missing_doctor_code", "DoctorCode")],
        DoctorCode=clean_code("doctor_code"),
        DoctorName=clean_name("doctor_name"),
        Gender=standardize("gender_raw", v.DOCTOR_GENDER, v.UNKNOWN),
        Specialty=standardize("specialty_raw", v.SPECIALTY),
        AcademicTitle=standardize("academic_title_raw", v.ACADEMIC_TITLE, F.trim("academic_title_raw")),
    )


def stage_departments(raw: DataFrame) -> DataFrame:
    return _master(
        raw,
        "departments",
        [present("missing_department_code", "DepartmentCode")],
        DepartmentCode=clean_code("department_code"),
        DepartmentName=clean_name("department_name_raw"),
        DepartmentGroup=standardize("department_group_raw", v.DEPARTMENT_GROUP),
    )


def stage_services(raw: DataFrame) -> DataFrame:
    return _master(
        raw,
        "services",
        [present("missing_service_code", "ServiceCode")],
        ServiceCode=clean_code("service_code"),
        ServiceName=clean_name("service_name_raw"),
        ServiceType=standardize("service_type_raw", v.SERVICE_TYPE),
        StandardPrice=parse_money("standard_price"),
    )


def stage_medicines(raw: DataFrame) -> DataFrame:
    return _master(
        raw,
        "medicines",
        [present("missing_medicine_code", "MedicineCode")],
        MedicineCode=clean_code("medicine_code"),
        MedicineName=clean_name("medicine_name_raw"),
        MedicineGroup=standardize("medicine_group_raw", v.MEDICINE_GROUP),
        Unit=standardize("unit_raw", v.UNIT),
        StandardPrice=parse_money("standard_price"),
    )


def stage_insurance(raw: DataFrame) -> DataFrame:
    """A rate outside 0..100 is rejected with the same reason as a missing code: no row gets lost."""
    reason = "invalid_insurance_code_or_coverage_rate"
    return _master(
        raw,
        "insurance",
        [present(reason, "InsuranceCode"), Rule(reason, F.col("CoverageRate").isNotNull())],
        InsuranceCode=clean_code("insurance_code"),
        InsuranceType=rate_label(percent_value("coverage_rate_raw")),
        CoverageRate=parse_rate("coverage_rate_raw"),
    )


def stage_visits(raw: DataFrame) -> DataFrame:
    source = canonicalize(raw, v.alias_map("visits"))
    parsed = source.select(
        "visit_id",
        clean_code("visit_code").alias("VisitCode"),
        parse_date("visit_date", fallbacks=["checkin_time", "created_at"]).alias("VisitDate"),
        clean_code("patient_code").alias("PatientCode"),
        clean_code("doctor_code").alias("DoctorCode"),
        clean_code("department_code").alias("DepartmentCode"),
        clean_code("insurance_code").alias("InsuranceCode"),
        elapsed_minutes("checkin_time", "consultation_start_time").alias("WaitingMinutes"),
        parse_money("consultation_fee_raw").alias("ConsultationFee"),
        clean_status("visit_status").alias("VisitStatus"),
        "created_at",
        "updated_at",
    )
    return parsed.select("*", verdict(visit_rules()).alias(REASON))


def visit_rules() -> list[Rule]:
    return [
        present("missing_visit_code", "VisitCode"),
        Rule("invalid_visit_date", F.col("VisitDate").isNotNull()),
        Rule("invalid_consultation_fee", F.col("ConsultationFee") >= 0),
        Rule("negative_waiting_minutes", F.col("WaitingMinutes") >= 0),
        Rule("not_completed_visit", F.col("VisitStatus") == "COMPLETED"),
    ]


def line_rules(code: str, code_reason: str, date: str, date_reason: str, item: str, item_reason: str, done: Rule) -> list[Rule]:
    """The rules that service and medicine lines share."""
    return [
        present(code_reason, code),
        present("missing_visit_code", "VisitCode"),
        Rule(date_reason, F.col(date).isNotNull()),
        present(item_reason, item),
        Rule("invalid_quantity", F.col("Quantity") > 0),
        Rule("invalid_unit_price", F.col("UnitPrice") > 0),
        done,
    ]


def service_rules() -> list[Rule]:
    return line_rules(
        "ServiceTransactionCode", "missing_service_transaction_code",
        "ServiceDate", "invalid_service_date",
        "ServiceCode", "missing_service_code",
        Rule("not_paid_service_transaction", F.col("PaymentStatus") == "PAID"),
    )


def prescription_rules() -> list[Rule]:
    return line_rules(
        "PrescriptionCode", "missing_prescription_code",
        "PrescriptionDate", "invalid_prescription_date",
        "MedicineCode", "missing_medicine_code",
        Rule("not_dispensed_prescription", F.col("DispenseStatus") == "DISPENSED"),
    )


def recover_qty_price(df: DataFrame, qty: str, price: str, total: str) -> DataFrame:
    """Adds `Quantity` and `UnitPrice`; the price uses the recovered quantity."""
    return df.withColumn("Quantity", recover_quantity(qty, price, total)).withColumn(
        "UnitPrice", recover_price("Quantity", price, total)
    )


def _parsed_lines(source: DataFrame, *ids: str, **named: Column) -> DataFrame:
    """The columns that service and medicine lines share, after the `named` ones; quantity and price recovered."""
    parsed = source.select(
        *ids,
        *[c.alias(name) for name, c in named.items()],
        clean_code("visit_code").alias("VisitCode"),
        clean_code("patient_code").alias("PatientCode"),
        clean_code("doctor_code").alias("DoctorCode"),
        clean_code("department_code").alias("DepartmentCode"),
        clean_code("insurance_code").alias("InsuranceCode"),
        parse_int("quantity_raw").alias("QuantityRawParsed"),
        parse_money("unit_price_raw").alias("UnitPriceRawParsed"),
        parse_money("total_amount_raw").alias("TotalAmountRawParsed"),
        "created_at",
        "updated_at",
    )
    return recover_qty_price(parsed, "QuantityRawParsed", "UnitPriceRawParsed", "TotalAmountRawParsed")


def _judged_lines(lines: DataFrame, rules: Sequence[Rule], amount: str) -> DataFrame:
    return lines.select(
        "*",
        line_amount("Quantity", "UnitPrice").alias(amount),
        verdict(rules).alias(REASON),
    )


def stage_service_transactions(raw: DataFrame) -> DataFrame:
    lines = _parsed_lines(
        canonicalize(raw, v.alias_map("service_transactions")),
        "service_transaction_id",
        ServiceTransactionCode=clean_code("service_transaction_code"),
        ServiceDate=parse_date("service_date", fallbacks=["created_at"]),
        ServiceCode=clean_code("service_code"),
        PaymentStatus=clean_status("payment_status"),
    )
    return _judged_lines(lines, service_rules(), "RevenueAmount")


def stage_prescriptions(raw: DataFrame, stg_visits: DataFrame) -> DataFrame:
    """Missing date and references come from the latest visit before the rules are applied."""
    lines = _parsed_lines(
        canonicalize(raw, v.alias_map("prescriptions")),
        "prescription_id",
        "prescription_line_no",
        PrescriptionCode=clean_code("prescription_code"),
        PrescriptionDate=parse_date("prescription_date", fallbacks=["created_at"]),
        MedicineCode=clean_code("medicine_code"),
        DispenseStatus=clean_status("dispense_status"),
    )
    filled = fill_from_parent(
        lines,
        stg_visits,
        "VisitCode",
        ["PrescriptionDate", "PatientCode", "DoctorCode", "DepartmentCode", "InsuranceCode"],
        newest_first("visit_id", "VisitDate", "PatientCode", "DoctorCode", "DepartmentCode", "InsuranceCode"),
        {"PrescriptionDate": "VisitDate"},
    )
    return _judged_lines(filled, prescription_rules(), "MedicineRevenueAmount")
