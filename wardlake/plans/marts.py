"""Gold marts, silver tables in, one DataFrame out.

Sums and counts are taken per join key before a dimension is joined, then summed
again per mart key. That equals joining first, also when a dimension holds
several tuples per id, but the shuffle carries one row per key and map task:
an insurer, device or medicine with a third of all rows costs no more than any
other. No side is broadcast by hint; adaptive execution does so when the
measured size allows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from wardlake.contracts import APPROVED, GOLD, REJECTED, conform
from wardlake.functions.scalars import percentage, week_start


def gold_medicine_availability(
    inventory: DataFrame, dim_medicine: DataFrame, report_month: str
) -> DataFrame:
    joined = inventory.join(dim_medicine, "medicine_id", "inner")
    return _mart(joined, "gold_medicine_availability", report_month)


def category_distribution(
    inventory: DataFrame, dim_medicine: DataFrame, report_month: str
) -> DataFrame:
    per_medicine = inventory.groupBy("medicine_id").agg(F.sum("available_stock").alias("stock"))
    return (
        per_medicine.join(dim_medicine, "medicine_id", "inner")
        .groupBy("category")
        .agg(F.sum("stock").alias("total_available_stock"))
        .withColumn("report_month", F.lit(report_month))
    )


def gold_device_availability(
    usage: DataFrame, dim_device: DataFrame, report_month: str
) -> DataFrame:
    units = ("total_units", "in_use_units", "available_units")
    per_device = usage.groupBy("device_id", "hospital_id").agg(
        *[F.sum(u).alias(u) for u in units]
    )
    per_type = (
        per_device.join(dim_device, ["device_id", "hospital_id"], "inner")
        .groupBy("hospital_id", "device_type")
        .agg(*[F.sum(u).alias(u) for u in units])
    )
    share = F.try_divide(F.col("in_use_units").cast("double"), F.col("total_units").cast("double"))
    return _mart(
        per_type.withColumn("utilization_pct", share * 100),
        "gold_device_availability",
        report_month,
    )


def gold_finance_weekly(
    billing: DataFrame, admission: DataFrame, dim_insurance: DataFrame, report_month: str
) -> DataFrame:
    """Approved claims per week and insurer.

    The two facts meet on ``admission_id``. Each side is first reduced to its
    distinct ids with counts, so an id that repeats contributes a product of two
    counts and never a pair per combination of rows.
    """
    claims = (
        billing.filter(F.col("claim_status") == APPROVED)
        .groupBy("admission_id", "insurance_id")
        .agg(
            F.count("*").alias("claims"),
            F.sum("billed_amount").alias("billed"),
            F.sum("approved_amount").alias("approved"),
        )
    )
    weeks = (
        admission.select("admission_id", week_start(F.col("admission_time")).alias("week_start_date"))
        .groupBy("admission_id", "week_start_date")
        .agg(F.count("*").alias("admissions"))
    )
    per_insurer = (
        claims.join(weeks, "admission_id", "inner")
        .groupBy("week_start_date", "insurance_id")
        .agg(*[
            F.sum(F.col(c) * F.col("admissions")).alias(c) for c in ("claims", "billed", "approved")
        ])
    )
    billed, approved = F.col("billed"), F.col("approved")
    named = (
        per_insurer.join(dim_insurance, "insurance_id", "left")
        .groupBy("week_start_date", "insurance_id", "insurance_name")
        .agg(*[F.sum(c).alias(c) for c in ("claims", "billed", "approved")])
    )
    return _mart(
        named.select(
            "week_start_date", "insurance_id", "insurance_name",
            F.col("claims").alias("total_claims"),
            billed.alias("total_billed_amount"),
            approved.alias("total_approved_amount"),
            (billed - approved).alias("revenue_leakage_amount"),
            percentage(approved, billed, 2).alias("approval_percentage"),
        ),
        "gold_finance_weekly",
        report_month,
    )


def gold_weekly_admissions(admission: DataFrame, report_month: str) -> DataFrame:
    weekly = (
        admission.groupBy(week_start(F.col("admission_time")).alias("week_start_date"))
        .agg(F.count("admission_id").alias("total_admissions"))
        .orderBy("week_start_date")
    )
    return _mart(weekly, "gold_weekly_admissions", report_month)


def gold_claim_status_summary(
    billing: DataFrame, dim_insurance: DataFrame, report_month: str
) -> DataFrame:
    per_id = billing.groupBy("insurance_id", "claim_status").agg(
        F.count("admission_id").alias("claims")
    )
    per_name = (
        per_id.join(dim_insurance, "insurance_id", "left")
        .groupBy("insurance_name", "claim_status")
        .agg(F.sum("claims").alias("claim_count"))
    )
    return _mart(per_name, "gold_claim_status_summary", report_month)


def gold_rejected_claims(
    billing: DataFrame, dim_insurance: DataFrame, report_month: str
) -> DataFrame:
    per_id = (
        billing.filter(F.col("claim_status") == REJECTED)
        .groupBy("insurance_id")
        .agg(F.count("admission_id").alias("claims"))
    )
    per_name = (
        per_id.join(dim_insurance, "insurance_id", "left")
        .groupBy("insurance_name")
        .agg(F.sum("claims").alias("rejected_claim_count"))
        .orderBy(F.desc("rejected_claim_count"))
    )
    return _mart(per_name, "gold_rejected_claims", report_month)


def gold_patient_status(admission: DataFrame, report_month: str) -> DataFrame:
    label = F.when(F.col("is_currently_admitted"), "Currently Admitted").otherwise("Discharged")
    per_status = admission.groupBy(label.alias("patient_status")).agg(
        F.count("admission_id").alias("patient_count")
    )
    return _mart(per_status, "gold_patient_status", report_month)


# mart -> (function, silver tables it reads)
MARTS = {
    "gold_medicine_availability": (
        gold_medicine_availability, ("fact_medicine_inventory", "dim_medicine"),
    ),
    "gold_device_availability": (gold_device_availability, ("fact_device_usage", "dim_device")),
    "gold_finance_weekly": (
        gold_finance_weekly, ("fact_billing", "fact_admission", "dim_insurance"),
    ),
    "gold_weekly_admissions": (gold_weekly_admissions, ("fact_admission",)),
    "gold_claim_status_summary": (gold_claim_status_summary, ("fact_billing", "dim_insurance")),
    "gold_rejected_claims": (gold_rejected_claims, ("fact_billing", "dim_insurance")),
    "gold_patient_status": (gold_patient_status, ("fact_admission",)),
}


def build_mart(name: str, silver: Callable[[str], DataFrame], report_month: str) -> DataFrame:
    function, inputs = MARTS[name]
    return function(*[silver(table) for table in inputs], report_month)


# Marts whose joins and groups all have this column among their keys: its values can be dealt into slices.
SLICED = {"gold_device_availability": "hospital_id"}


def slices(name: str, silver: Callable[[str], DataFrame], report_month: str, n: int) -> list[DataFrame]:
    """A mart in ``n`` parts that together have its rows, each from the silver rows of its share of the values."""
    share = F.pmod(F.xxhash64(SLICED[name]), F.lit(n))
    return [build_mart(name, lambda table, i=i: silver(table).filter(share == i), report_month) for i in range(n)]


def _mart(df: DataFrame, name: str, report_month: str) -> DataFrame:
    return conform(df.withColumn("report_month", F.lit(report_month)), GOLD[name])
