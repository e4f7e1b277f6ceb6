"""Serving views over the gold marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from wardlake.contracts import (
    STOCK_CRITICAL_BELOW,
    STOCK_LOW_BELOW,
    UTILIZATION_HIGH,
    UTILIZATION_MODERATE,
    UTILIZATION_OVERLOADED,
)
from wardlake.functions.scalars import month_name, percentage, week_number


def period_of(df: DataFrame) -> list[str]:
    """The columns that tell report periods apart: marts with history also have the year."""
    return [c for c in ("report_year", "report_month") if c in df.columns]


def vw_medicine_stock_alert(medicine_availability: DataFrame) -> DataFrame:
    """A missing stock figure counts as ADEQUATE."""
    stock = F.col("available_stock")
    return medicine_availability.withColumn(
        "stock_alert_level",
        F.when(stock < STOCK_CRITICAL_BELOW, "CRITICAL")
        .when(stock < STOCK_LOW_BELOW, "LOW")
        .otherwise("ADEQUATE"),
    )


def vw_device_utilization(device_availability: DataFrame) -> DataFrame:
    """The status looks at the unrounded percentage."""
    pct = F.col("utilization_pct")
    status = (
        F.when(pct >= UTILIZATION_OVERLOADED, "OVERLOADED")
        .when(pct >= UTILIZATION_HIGH, "HIGH")
        .when(pct >= UTILIZATION_MODERATE, "MODERATE")
        .otherwise("AVAILABLE")
    )
    return device_availability.withColumns({
        "utilization_pct": percentage(F.col("in_use_units"), F.col("total_units"), 1),
        "utilization_status": status,
    })


def vw_finance_summary(finance_weekly: DataFrame) -> DataFrame:
    return finance_weekly.select(
        "week_start_date",
        week_number(F.col("week_start_date")).alias("week_number"),
        "insurance_id",
        "insurance_name",
        "total_claims",
        F.round("total_billed_amount", 0).alias("total_billed"),
        F.round("total_approved_amount", 0).alias("total_approved"),
        F.round("revenue_leakage_amount", 0).alias("revenue_leakage"),
        "approval_percentage",
        *period_of(finance_weekly),
    )


def vw_weekly_admissions(weekly_admissions: DataFrame) -> DataFrame:
    week = F.col("week_start_date")
    return weekly_admissions.select(
        "week_start_date",
        week_number(week).alias("week_number"),
        month_name(week).alias("month_name"),
        F.year(week).alias("year_number"),
        "total_admissions",
        *period_of(weekly_admissions),
    )


def vw_claim_status_breakdown(claim_status_summary: DataFrame) -> DataFrame:
    """A window partition holds one row per claim status of one insurer and period."""
    group = Window.partitionBy("insurance_name", *period_of(claim_status_summary))
    total = F.sum("claim_count").over(group)
    return claim_status_summary.withColumn("total_claims_per_insurer", total).withColumn(
        "claim_status_pct", percentage(F.col("claim_count"), F.col("total_claims_per_insurer"), 1)
    )


def vw_rejected_claims_ranking(rejected_claims: DataFrame) -> DataFrame:
    """RANK by descending count within a period: ties share a rank, a gap follows.

    Only the distinct counts pass through a period's window. N rejected claims
    allow at most sqrt(2N) distinct counts, however many insurers there are.
    """
    period = period_of(rejected_claims)
    counts = rejected_claims.groupBy(*period, "rejected_claim_count").agg(
        F.count("*").alias("insurers")
    )
    ahead = Window.partitionBy(*period).orderBy(F.desc("rejected_claim_count")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    ranks = counts.select(
        *period,
        "rejected_claim_count",
        (F.coalesce(F.sum("insurers").over(ahead), F.lit(0)) + 1).cast("int").alias("rejection_rank"),
    )
    return rejected_claims.join(ranks, [*period, "rejected_claim_count"]).select(
        "insurance_name", "rejected_claim_count", *period, "rejection_rank"
    )


# view name -> (function, mart it reads)
VIEWS = {
    "vw_medicine_stock_alert": (vw_medicine_stock_alert, "gold_medicine_availability"),
    "vw_device_utilization": (vw_device_utilization, "gold_device_availability"),
    "vw_finance_summary": (vw_finance_summary, "gold_finance_weekly"),
    "vw_weekly_admissions": (vw_weekly_admissions, "gold_weekly_admissions"),
    "vw_claim_status_breakdown": (vw_claim_status_breakdown, "gold_claim_status_summary"),
    "vw_rejected_claims_ranking": (vw_rejected_claims_ranking, "gold_rejected_claims"),
}
