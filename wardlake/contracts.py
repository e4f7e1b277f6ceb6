"""Column contracts of every layer and the constants of the business rules."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

# --------------------------------------------------------------------------
# Sources
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class SourceContract:
    """What one monthly extract must look like before it may enter bronze."""

    name: str
    columns: tuple[str, ...]
    key: tuple[str, ...]
    not_null: tuple[str, ...]
    integers: tuple[str, ...]
    max_lengths: Mapping[str, int] = field(default_factory=dict)
    integer_type: str = "int"
    dates: tuple[str, ...] = ()
    times: tuple[str, ...] = ()

    @property
    def landing_columns(self) -> list[str]:
        """The ordered column list checked on landing, provenance column included."""
        return [*self.columns, "file_path"]

    @property
    def text_schema(self) -> str:
        return ", ".join(f"{c} STRING" for c in self.columns)


HOSPITAL = SourceContract(
    name="Hospital",
    columns=(
        "event_id", "patient_id", "patient_gender", "patient_dob", "insurance_id",
        "insurance_name", "department", "doctor_id", "bed_id", "bed_type", "hospital_id",
        "admission_time", "discharge_time", "billed_amount", "approved_amount", "claim_status",
    ),
    key=("event_id",),
    not_null=("insurance_id", "billed_amount", "approved_amount", "patient_dob"),
    integers=("billed_amount", "approved_amount"),
    max_lengths={"patient_gender": 1},
    dates=("patient_dob",),
    times=("admission_time", "discharge_time"),
)

DEVICE = SourceContract(
    name="Device",
    columns=("hospital_id", "device_id", "device_type", "total_units", "in_use_units", "week"),
    key=("hospital_id", "device_id", "week"),
    not_null=("hospital_id", "device_id"),
    integers=("total_units", "in_use_units"),
    max_lengths={"device_id": 6},
)

PHARMA = SourceContract(
    name="Pharma",
    columns=(
        "medicine_id", "medicine_name", "category", "hospital_id", "total_stock",
        "issued_stock", "expiry_date",
    ),
    key=("hospital_id", "medicine_id"),
    not_null=("hospital_id", "medicine_id"),
    integers=("total_stock", "issued_stock"),
    max_lengths={"medicine_id": 6},
    # Stock is BIGINT from landing to gold: sums of a large source exceed an INT.
    integer_type="bigint",
    dates=("expiry_date",),
)

# Where a landing scan keeps the text of a record whose fields do not match the contract.
BAD_RECORD = "bad_record"

SOURCES = {c.name: c for c in (HOSPITAL, DEVICE, PHARMA)}

# The ordered column lists above are the contract; so are the rule values below.
GENDERS = ("M", "F", "O")
APPROVED, REJECTED, PENDING = "APPROVED", "REJECTED", "PENDING"
STOCK_CRITICAL_BELOW = 200
STOCK_LOW_BELOW = 500
UTILIZATION_OVERLOADED = 90
UTILIZATION_HIGH = 70
UTILIZATION_MODERATE = 50

# --------------------------------------------------------------------------
# Tables: ordered column -> Spark SQL type
#
# Money is BIGINT in silver so that sums do not depend on their order; marts
# turn it into DOUBLE. DATETIME sources hold wall-clock times, hence
# TIMESTAMP_NTZ: the same text gives the same value under any session zone.
# --------------------------------------------------------------------------

SILVER: dict[str, dict[str, str]] = {
    "dim_medicine": {"medicine_id": "string", "medicine_name": "string", "category": "string"},
    "dim_device": {"device_id": "string", "device_type": "string", "hospital_id": "string"},
    "dim_insurance": {"insurance_id": "string", "insurance_name": "string"},
    "dim_patient": {
        "patient_id": "string", "patient_gender": "string", "patient_dob": "date",
        "insurance_id": "string",
    },
    "dim_doctor": {"doctor_id": "string", "department": "string", "hospital_id": "string"},
    "dim_bed": {"bed_id": "string", "bed_type": "string", "hospital_id": "string"},
    "fact_medicine_inventory": {
        "medicine_id": "string", "hospital_id": "string", "total_stock": "bigint",
        "issued_stock": "bigint", "expiry_date": "date", "available_stock": "bigint",
    },
    "fact_device_usage": {
        "device_id": "string", "hospital_id": "string", "week": "string",
        "total_units": "int", "in_use_units": "int", "available_units": "int",
    },
    "fact_admission": {
        "admission_id": "string", "patient_id": "string", "doctor_id": "string",
        "bed_id": "string", "hospital_id": "string", "admission_time": "timestamp_ntz",
        "discharge_time": "timestamp_ntz", "length_of_stay_hrs": "int",
        "is_currently_admitted": "boolean",
    },
    "fact_billing": {
        "admission_id": "string", "insurance_id": "string", "billed_amount": "bigint",
        "approved_amount": "bigint", "claim_status": "string",
    },
}

# The facts that meet on this column.
BUCKET_KEYS = {"fact_admission": "admission_id", "fact_billing": "admission_id"}

GOLD: dict[str, dict[str, str]] = {
    "gold_medicine_availability": {
        "hospital_id": "string", "medicine_name": "string", "category": "string",
        "available_stock": "bigint", "expiry_date": "date", "report_month": "string",
    },
    "gold_device_availability": {
        "hospital_id": "string", "device_type": "string", "total_units": "bigint",
        "in_use_units": "bigint", "available_units": "bigint", "utilization_pct": "double",
        "report_month": "string",
    },
    "gold_finance_weekly": {
        "week_start_date": "date", "insurance_id": "string", "insurance_name": "string",
        "total_claims": "bigint", "total_billed_amount": "double",
        "total_approved_amount": "double", "revenue_leakage_amount": "double",
        "approval_percentage": "double", "report_month": "string",
    },
    "gold_weekly_admissions": {
        "week_start_date": "date", "total_admissions": "bigint", "report_month": "string",
    },
    "gold_claim_status_summary": {
        "insurance_name": "string", "claim_status": "string", "claim_count": "bigint",
        "report_month": "string",
    },
    "gold_rejected_claims": {
        "insurance_name": "string", "rejected_claim_count": "bigint", "report_month": "string",
    },
    "gold_patient_status": {
        "patient_status": "string", "patient_count": "bigint", "report_month": "string",
    },
}

# record_count is BIGINT: a fact of a large run has more rows than an INT can hold. load_time is a
# day, so the last two columns order the rows: the run's number in this table, and the step in the run.
AUDIT: dict[str, str] = {
    "pipeline_name": "string", "notebook_name": "string", "run_id": "string",
    "source": "string", "layer": "string", "record_count": "bigint", "load_time": "date",
    "status": "string", "report_month": "string", "run_seq": "bigint", "step": "int",
}

# The hospital dimensions share one pass over the cleansed rows.
HOSPITAL_DIMENSIONS = ("dim_insurance", "dim_patient", "dim_doctor", "dim_bed")


def ddl(contract: Mapping[str, str]) -> str:
    return ", ".join(f"{name} {type_}" for name, type_ in contract.items())


def conform(df: DataFrame, contract: Mapping[str, str]) -> DataFrame:
    """Select the contract's columns in order, cast to its types."""
    return df.select(*[F.col(name).cast(type_).alias(name) for name, type_ in contract.items()])
