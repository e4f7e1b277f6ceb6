"""Dashboard measures over silver tables, marts and views.

Measures over marts with history have a row per period, told apart by its columns; over the
marts of one period they have none of those.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardlake.contracts import UTILIZATION_HIGH, UTILIZATION_OVERLOADED
from wardlake.functions.scalars import percentage
from wardlake.operators.cleanse import EXPIRED, VALID, enrich_pharma
from wardlake.plans.views import period_of

# Hospital overview


def kpi_admissions(admission: DataFrame) -> DataFrame:
    """Exact distinct admissions, and the admitted / discharged split."""
    return admission.agg(
        F.count_distinct("admission_id").alias("total_admissions"),
        F.count_if("is_currently_admitted").alias("currently_admitted"),
        F.count_if(~F.col("is_currently_admitted")).alias("discharged"),
    )


def kpi_admissions_by_department(clean_hospital: DataFrame) -> DataFrame:
    """From the cleansed events: a doctor id can occur under several departments."""
    return clean_hospital.groupBy("department").agg(F.count("event_id").alias("admission_count"))


# Finance and claims


def _history(df: DataFrame) -> list[str]:
    return period_of(df) if "report_year" in df.columns else []


def _money_total(name: str) -> Column:
    """Marts hold whole amounts as DOUBLE; summing them as BIGINT keeps the total exact."""
    return F.sum(F.col(name).cast("bigint")).cast("double")


def kpi_finance_totals(finance_weekly: DataFrame) -> DataFrame:
    """Totals, and the unweighted mean of the approval percentages.

    The mean is taken over whole hundredths, so it does not depend on row order.
    """
    hundredths = F.round(F.col("approval_percentage") * 100).cast("bigint")
    mean = F.try_divide(
        F.sum(hundredths).cast("double"), F.count("approval_percentage").cast("double")
    )
    return finance_weekly.groupBy(*_history(finance_weekly)).agg(
        _money_total("total_billed_amount").alias("total_billed"),
        _money_total("total_approved_amount").alias("total_approved"),
        _money_total("revenue_leakage_amount").alias("total_revenue_leakage"),
        (mean / F.lit(100.0)).alias("avg_approval_percentage"),
    )


def kpi_leakage_by_insurer(finance_weekly: DataFrame) -> DataFrame:
    return finance_weekly.groupBy("insurance_name", *_history(finance_weekly)).agg(
        _money_total("revenue_leakage_amount").alias("revenue_leakage")
    )


def kpi_claim_distribution(claim_status_summary: DataFrame) -> DataFrame:
    """Share of every claim status; the window sees one row per status and period."""
    period = _history(claim_status_summary)
    per_status = claim_status_summary.groupBy("claim_status", *period).agg(
        F.sum("claim_count").alias("claim_count")
    )
    return per_status.withColumn("all_claims", F.sum("claim_count").over(Window.partitionBy(*period))).select(
        *period,
        "claim_status",
        "claim_count",
        percentage(F.col("claim_count"), F.col("all_claims"), 1).alias("claim_pct"),
    )


# Devices


def utilization_band(pct: Column) -> Column:
    return (
        F.when(pct > UTILIZATION_OVERLOADED, "Red")
        .when(pct >= UTILIZATION_HIGH, "Yellow")
        .when(pct < UTILIZATION_HIGH, "Green")
    )


NO_TYPE = "(none)"  # the key of devices without a type: a map has no NULL key


def kpi_utilization_matrix(device_availability: DataFrame) -> DataFrame:
    """Hospital by device type: ``utilization``, a map from every type there is to its percentage.

    The keys are data, in order, so the schema is the same whatever types there are, and no job is
    needed to learn them. A mart has a row per hospital and type.
    """
    cell = F.struct(F.coalesce("device_type", F.lit(NO_TYPE)).alias("type"), F.col("utilization_pct").alias("pct"))
    return device_availability.groupBy("hospital_id", *_history(device_availability)).agg(
        F.map_from_entries(F.sort_array(F.collect_list(cell))).alias("utilization")
    )


def matrix_text(matrix: DataFrame, digits: int = 3) -> DataFrame:
    """The matrix with its types and rounded percentages as text, for sinks without maps."""
    pct = F.transform(F.map_values("utilization"), lambda v: F.coalesce(v.cast(f"decimal(18,{digits})").cast("string"), F.lit("-")))
    return matrix.withColumns({
        "device_types": F.array_join(F.map_keys("utilization"), ","), "utilization_pcts": F.array_join(pct, ","),
    }).drop("utilization")


def kpi_utilization_bands(device_availability: DataFrame) -> DataFrame:
    return device_availability.select(
        *_history(device_availability),
        "hospital_id",
        "device_type",
        "utilization_pct",
        utilization_band(F.col("utilization_pct")).alias("band"),
    )


def kpi_units_by_device_type(device_availability: DataFrame) -> DataFrame:
    return device_availability.groupBy("device_type", *_history(device_availability)).agg(
        F.sum("available_units").alias("available_units"),
        F.sum("in_use_units").alias("in_use_units"),
    )


def kpi_overloaded_devices(device_availability: DataFrame) -> DataFrame:
    """Strictly above the threshold, unlike the view's status."""
    return device_availability.filter(F.col("utilization_pct") > UTILIZATION_OVERLOADED)


# Pharmacy


def kpi_low_stock(stock_alert: DataFrame) -> DataFrame:
    return stock_alert.filter(F.col("stock_alert_level").isin("CRITICAL", "LOW"))


def expiry_status_summary(pharma: DataFrame, as_of: date) -> DataFrame:
    """Expired and valid rows before the expired ones are dropped."""
    status = F.col("expiry_status")
    return enrich_pharma(pharma, as_of).agg(
        F.count_if(status == EXPIRED).alias("expired_count"),
        F.count_if(status == VALID).alias("valid_count"),
    )


def kpi_stock_by_medicine(inventory: DataFrame, dim_medicine: DataFrame) -> DataFrame:
    per_id = inventory.groupBy("medicine_id").agg(
        F.sum("total_stock").alias("total_stock"),
        F.sum("available_stock").alias("available_stock"),
    )
    return (
        per_id.join(dim_medicine, "medicine_id", "inner")
        .groupBy("medicine_id", "medicine_name")
        .agg(
            F.sum("total_stock").alias("total_stock"),
            F.sum("available_stock").alias("available_stock"),
        )
    )
