"""Latest-state dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardhouse.operators.dates import build_date_dim
from wardhouse.operators.keys import assign_keys, latest_by
from wardhouse.plans.staging import newest_first

# Dimension -> (cleansed table, key, code, attributes, id that breaks ties).
DIMENSIONS = {
    "Dim_Patient": (
        "stg_patients", "PatientKey", "PatientCode", ("FullName", "Gender", "BirthYear", "AgeGroup", "City"), "patient_id",
    ),
    "Dim_Doctor": (
        "stg_doctors", "DoctorKey", "DoctorCode", ("DoctorName", "Gender", "Specialty", "AcademicTitle"), "doctor_id",
    ),
    "Dim_Department": (
        "stg_departments", "DepartmentKey", "DepartmentCode", ("DepartmentName", "DepartmentGroup"), "department_id",
    ),
    "Dim_Service": ("stg_services", "ServiceKey", "ServiceCode", ("ServiceName", "ServiceType"), "service_id"),
    "Dim_Medicine": (
        "stg_medicines", "MedicineKey", "MedicineCode", ("MedicineName", "MedicineGroup", "Unit"), "medicine_id",
    ),
    "Dim_Insurance": (
        "stg_insurance", "InsuranceKey", "InsuranceCode", ("InsuranceType", "CoverageRate"), "insurance_id",
    ),
}
DATE_DIMENSION = "Dim_Date"


def build_dim(
    stg: DataFrame,
    key: str,
    code: str,
    attrs: Sequence[str],
    order_cols: Sequence[Column],
    existing: DataFrame | None = None,
) -> DataFrame:
    """One row per code with its latest attributes and a dense surrogate key."""
    latest = latest_by(stg, [code], order_cols).select(code, *attrs)
    return assign_keys(latest, code, key, existing, codes=stg.select(code).distinct())


def build_dimension(name: str, stg: DataFrame, existing: DataFrame | None = None, text_order: bool = False) -> DataFrame:
    _, key, code, attrs, id_col = DIMENSIONS[name]
    return build_dim(stg, key, code, attrs, newest_first(id_col, *attrs, text_order=text_order), existing)


def build_dates(stg_visits: DataFrame, stg_services: DataFrame, stg_prescriptions: DataFrame) -> DataFrame:
    return build_date_dim(
        stg_visits.select(F.col("VisitDate")),
        stg_services.select(F.col("ServiceDate")),
        stg_prescriptions.select(F.col("PrescriptionDate")),
    )
