"""Names and labels that decide the results. Nothing here is logic."""

from __future__ import annotations

# Source tables with their canonical column names.
SOURCE_COLUMNS = {
    "patients": (
        "patient_id", "patient_code", "full_name", "gender_raw", "date_of_birth", "birth_year", "phone",
        "address", "city_raw", "national_id", "source_system", "created_at", "updated_at",
    ),
    "doctors": (
        "doctor_id", "doctor_code", "doctor_name", "gender_raw", "specialty_raw", "academic_title_raw",
        "department_code", "status", "created_at", "updated_at",
    ),
    "departments": (
        "department_id", "department_code", "department_name_raw", "department_group_raw", "floor", "building",
        "status", "created_at", "updated_at",
    ),
    "services": (
        "service_id", "service_code", "service_name_raw", "service_type_raw", "standard_price", "status",
        "created_at", "updated_at",
    ),
    "medicines": (
        "medicine_id", "medicine_code", "medicine_name_raw", "medicine_group_raw", "unit_raw",
        "standard_price", "status", "created_at", "updated_at",
    ),
    "insurance": (
        "insurance_id", "insurance_code", "insurance_type_raw", "coverage_rate_raw", "status", "created_at",
        "updated_at",
    ),
    "visits": (
        "visit_id", "visit_code", "visit_date", "patient_code", "doctor_code", "department_code",
        "insurance_code", "checkin_time", "consultation_start_time", "consultation_fee_raw", "visit_status",
        "source_system", "created_at", "updated_at",
    ),
    "service_transactions": (
        "service_transaction_id", "service_transaction_code", "visit_code", "service_date", "patient_code",
        "doctor_code", "department_code", "service_code", "insurance_code", "quantity_raw", "unit_price_raw",
        "total_amount_raw", "insurance_paid_raw", "patient_paid_raw", "payment_status", "created_at",
        "updated_at",
    ),
    "prescriptions": (
        "prescription_id", "prescription_code", "prescription_line_no", "visit_code", "prescription_date",
        "patient_code", "doctor_code", "department_code", "medicine_code", "insurance_code", "quantity_raw",
        "unit_price_raw", "total_amount_raw", "insurance_paid_raw", "patient_paid_raw", "dispense_status",
        "created_at", "updated_at",
    ),
}

# Further names under which a source may carry a column, where no rule of `alias_map` gives them.
# An entry of a table replaces the rule for that column.
OTHER_NAMES = {
    "patients": {
        "full_name": ("patient_name",),
        "date_of_birth": ("dob", "birth_date"),
        "phone": ("phone_number",),
    },
    "doctors": {"doctor_name": ("full_name",)},
    "services": {"standard_price": ("standard_price_raw",)},
    "medicines": {"standard_price": ("standard_price_raw",)},
    "visits": {"consultation_start_time": ("consultation_start",)},
    "service_transactions": {
        "total_amount_raw": ("total_amount", "revenue_amount_raw", "revenue_amount"),
        "insurance_paid_raw": ("insurance_paid_amount",),
        "patient_paid_raw": ("patient_paid_amount",),
    },
    "prescriptions": {
        "total_amount_raw": ("total_amount", "medicine_revenue_amount_raw", "medicine_revenue_amount"),
        "insurance_paid_raw": ("insurance_paid_amount",),
        "patient_paid_raw": ("patient_paid_amount",),
    },
}

# Labels and the lower-case spellings that mean them.
UNKNOWN = "Không xác định"
MALE = {"Nam": ("nam", "m", "male", "man", "boy", "nam giới")}
FEMALE = {"Nữ": ("nữ", "nu", "f", "female", "woman", "girl", "nữ giới")}
OTHER = {"Khác": ("khác", "khac", "other")}
PATIENT_GENDER = MALE | FEMALE | OTHER
DOCTOR_GENDER = MALE | FEMALE
CITY = {
    "Hà Nội": ("ha noi", "hà nội", "hn", "hanoi"),
    "TP. Hồ Chí Minh": (
        "hcm", "tp.hcm", "tp hcm", "tphcm", "tp. hcm", "tp. hồ chí minh", "ho chi minh", "hồ chí minh",
        "sai gon", "sài gòn", "sg",
    ),
    "Đà Nẵng": ("da nang", "đà nẵng"),
    "Hải Phòng": ("hai phong", "hải phòng", "hp"),
    "Bắc Ninh": ("bac ninh", "bắc ninh"),
    "Cần Thơ": ("can tho", "cần thơ"),
    "Nghệ An": ("nghe an", "nghệ an"),
    "Thanh Hóa": ("thanh hoa", "thanh hóa", "thanh hoá"),
}
SPECIALTY = {
    "Tim mạch": ("tim mach", "tim mạch", "cardiology"),
    "Nhi khoa": ("nhi khoa",),
    "Chẩn đoán hình ảnh": ("chan doan hinh anh", "chẩn đoán hình ảnh"),
    "Xét nghiệm": ("xet nghiem", "xét nghiệm", "lab"),
    "Tai mũi họng": ("tai mui hong", "tai mũi họng"),
    "Cấp cứu": ("cap cuu", "cấp cứu"),
    "Ngoại khoa": ("ngoai khoa", "ngoại khoa"),
    "Sản khoa": ("san khoa", "sản khoa"),
    "Nội tổng quát": ("noi tong quat", "nội tổng quát", "nội tổng hợp", "noi tong hop"),
    "Da liễu": ("da lieu", "da liễu"),
}
ACADEMIC_TITLE = {
    "BS": ("bs", "bác sĩ", "bac si"),
    "ThS": ("ths", "thạc sĩ", "thac si"),
    "TS": ("ts", "tiến sĩ", "tien si"),
}
DEPARTMENT_GROUP = {
    "Khám bệnh": ("kham benh", "khám bệnh"),
    "Cận lâm sàng": ("cls", "can lam sang", "cận lâm sàng"),
}
SERVICE_TYPE = {
    "Khám": ("kham", "khám"),
    "Xét nghiệm": ("xet nghiem", "xét nghiệm", "lab"),
    "Chẩn đoán hình ảnh": ("chan doan hinh anh", "chẩn đoán hình ảnh"),
    "Thủ thuật": ("thu thuat", "thủ thuật"),
}
MEDICINE_GROUP = {
    "Kháng sinh": ("khang sinh", "kháng sinh", "antibiotic"),
    "Giảm đau": ("giam dau", "giảm đau"),
    "Tiêu hóa": ("tieu hoa", "tiêu hóa", "dạ dày", "da day"),
    "Hô hấp": ("ho hap", "hô hấp"),
    "Tim mạch": ("tim mach", "tim mạch"),
    "Nội tiết": ("noi tiet", "nội tiết"),
    "Kháng histamin": ("khang histamin", "kháng histamin"),
    "Kháng viêm": ("khang viem", "kháng viêm"),
    "Bù điện giải": ("bu dien giai", "bù điện giải"),
}
UNIT = {
    "Viên": ("vien", "viên", "tablet"),
    "Hộp": ("hop", "hộp", "box"),
    "Chai": ("chai", "bottle"),
    "Ống": ("ong", "ống", "ampoule"),
    "Gói": ("goi", "gói"),
}

# Cleansed tables.
SILVER_COLUMNS = {
    "stg_patients": (
        "PatientCode string, FullName string, Gender string, BirthYear int, AgeGroup string, City string, "
        "updated_at string, patient_id string"
    ),
    "stg_doctors": (
        "DoctorCode string, DoctorName string, Gender string, Specialty string, AcademicTitle string, "
        "updated_at string, doctor_id string"
    ),
    "stg_departments": (
        "DepartmentCode string, DepartmentName string, DepartmentGroup string, updated_at string, "
        "department_id string"
    ),
    "stg_services": (
        "ServiceCode string, ServiceName string, ServiceType string, StandardPrice decimal(18,2), "
        "updated_at string, service_id string"
    ),
    "stg_medicines": (
        "MedicineCode string, MedicineName string, MedicineGroup string, Unit string, "
        "StandardPrice decimal(18,2), updated_at string, medicine_id string"
    ),
    "stg_insurance": (
        "InsuranceCode string, InsuranceType string, CoverageRate decimal(5,2), updated_at string, "
        "insurance_id string"
    ),
    "stg_visits": (
        "visit_id string, VisitCode string, VisitDate date, PatientCode string, DoctorCode string, "
        "DepartmentCode string, InsuranceCode string, WaitingMinutes int, ConsultationFee decimal(18,2), "
        "VisitStatus string, created_at string, updated_at string"
    ),
    "stg_service_transactions": (
        "ServiceTransactionCode string, VisitCode string, ServiceDate date, PatientCode string, "
        "DoctorCode string, DepartmentCode string, ServiceCode string, InsuranceCode string, Quantity int, "
        "UnitPrice decimal(18,2), RevenueAmount decimal(18,2), PaymentStatus string, created_at string, "
        "updated_at string, service_transaction_id string"
    ),
    "stg_prescriptions": (
        "PrescriptionCode string, VisitCode string, PrescriptionDate date, PatientCode string, "
        "DoctorCode string, DepartmentCode string, MedicineCode string, InsuranceCode string, Quantity int, "
        "UnitPrice decimal(18,2), MedicineRevenueAmount decimal(18,2), DispenseStatus string, "
        "created_at string, updated_at string, prescription_id string"
    ),
}

# Warehouse tables with the key that a newer row replaces.
REPLACE_KEYS = {
    "dim_date": "DateKey",
    "dim_patient": "PatientCode",
    "dim_doctor": "DoctorCode",
    "dim_department": "DepartmentCode",
    "dim_service": "ServiceCode",
    "dim_medicine": "MedicineCode",
    "dim_insurance": "InsuranceCode",
    "fact_visit": "VisitCode",
    "fact_service_revenue": "ServiceTransactionCode",
    "fact_prescription": "PrescriptionCode",
}


def alias_map(table: str) -> dict[str, tuple[str, ...]]:
    """Canonical column -> other source names, by two rules: `x_code` is also `x_no`, `x_raw` is also `x`."""
    special = OTHER_NAMES.get(table, {})

    def others(column: str) -> tuple[str, ...]:
        if column in special:
            return special[column]
        for ending, other in (("_code", "_no"), ("_raw", "")):
            if column.endswith(ending):
                return (column.removesuffix(ending) + other,)
        return ()

    return {column: others(column) for column in SOURCE_COLUMNS[table]}
