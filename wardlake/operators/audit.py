"""Audit rows and the queries over them."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wardlake.context import RunContext
from wardlake.contracts import APPROVED, GOLD, REJECTED
from wardlake.session import shuffles_freed

SUCCESS, RUNNING = "Success", "RUNNING"
FAILED = "FAILED: "

# The order of a run's steps, by the layer of their rows.
STEPS = {"Init": 0, "raw": 1, "silver": 2, "reject": 3, "gold": 4, "Any": 5}
LAYERS = ("raw", "silver", "gold")


def audit_row(
    ctx: RunContext, notebook: str, source: str, layer: str, count: int, status: str = SUCCESS
) -> tuple:
    return (
        ctx.pipeline_name, notebook, ctx.run_id, source, layer, count, ctx.run_date, status,
        ctx.report_month, ctx.run_seq, STEPS[layer],
    )


def start_row(ctx: RunContext) -> tuple:
    return audit_row(ctx, "Pipeline_Start", "ALL", "Init", 0, RUNNING)


def fail_row(ctx: RunContext, message: str) -> tuple:
    return audit_row(ctx, "Pipeline_Fail", "ALL", "Any", 0, f"{FAILED}{message}")


def newest_first() -> list[Column]:
    """A total order of audit rows: days, then runs, then a run's steps, all newest first, then sources."""
    return [F.desc("load_time"), F.desc("run_seq"), F.desc("run_id"), F.desc("step"), F.asc("source")]


def audit_recent(audit: DataFrame) -> DataFrame:
    """Newest first."""
    return audit.orderBy(*newest_first())


def audit_by(audit: DataFrame, **equals: str) -> DataFrame:
    """Rows where every named column has the given value, newest first."""
    for name, value in equals.items():
        audit = audit.filter(F.col(name) == value)
    return audit_recent(audit)


def raw_balance(audit: DataFrame) -> DataFrame:
    """Per run and source with row rules: raw rows are clean rows plus rejected rows."""
    of = {layer: F.sum(F.when(F.col("layer") == layer, F.col("record_count"))) for layer in ("raw", "silver", "reject")}
    figures = audit.groupBy("run_id", "source").agg(
        of["raw"].alias("raw_rows"), of["silver"].alias("clean_rows"), of["reject"].alias("rejected_rows")
    )
    balanced = F.col("raw_rows") == F.col("clean_rows") + F.col("rejected_rows")
    return figures.filter("rejected_rows IS NOT NULL").withColumn("balanced", balanced)


def audit_run_health(audit: DataFrame, min_success: int = 10) -> DataFrame:
    """What became of every run: its state, the last step it wrote, and whether all is well.

    A run is FAILED if it says so, COMPLETE if all layers have rows, STARTED with nothing but its
    marker, and INCOMPLETE otherwise: it is still at work, or its driver is gone.
    """
    successes = F.count_if(F.col("status") == SUCCESS)
    layers = F.count_distinct(F.when(F.col("layer").isin(*LAYERS) & (F.col("status") == SUCCESS), F.col("layer")))
    state = (
        F.when(F.bool_or(F.col("status").startswith(FAILED)), "FAILED")
        .when(layers == len(LAYERS), "COMPLETE")
        .when(layers == 0, "STARTED")
        .otherwise("INCOMPLETE")
    )
    return (
        audit.groupBy("run_seq", "run_id")
        .agg(state.alias("state"), F.max_by("layer", "step").alias("last_layer"), successes.alias("success_rows"))
        .withColumn("healthy", (F.col("state") == "COMPLETE") & (F.col("success_rows") >= min_success))
    )


# What identifies a row of a mart; all other columns but the period are its measures.
MART_KEYS = {
    "gold_medicine_availability": ("hospital_id", "medicine_name", "category", "expiry_date"),
    "gold_device_availability": ("hospital_id", "device_type"),
    "gold_finance_weekly": ("week_start_date", "insurance_id", "insurance_name"),
    "gold_weekly_admissions": ("week_start_date",),
    "gold_claim_status_summary": ("insurance_name", "claim_status"),
    "gold_rejected_claims": ("insurance_name",),
    "gold_patient_status": ("patient_status",),
}


def measures(mart: str) -> list[str]:
    return [c for c in GOLD[mart] if c not in MART_KEYS[mart] and c != "report_month"]


def content_checksums(df: DataFrame, mart: str, side: str) -> DataFrame:
    """Per measure of a mart, checksums that do not depend on the rows' order.

    A value is hashed with its row's key, so values that changed places show; the sum notices rows that are
    there twice, which cancel out in the xor.
    """
    found = []
    for column in measures(mart):
        mark = F.xxhash64(*MART_KEYS[mart], column)
        found.append(F.struct(
            F.lit(column).alias("column"), F.sum(mark.cast("decimal(38,0)")).alias("total"), F.bit_xor(mark).alias("mixed"),
        ))
    return df.agg(F.array(*found).alias("sums")).select(F.lit(mart).alias("mart"), F.lit(side).alias("side"), F.inline("sums"))


CHECKSUMS = "mart string, side string, column string, total decimal(38,0), mixed bigint"


def content_reconciliation(
    rebuilt: Mapping[str, DataFrame], gold: Mapping[str, DataFrame], ctx: RunContext | None = None
) -> DataFrame:
    """``(mart, differs, matches)``: the measures in which a stored mart is not what silver gives.

    The checksums are taken now, mart by mart, so that no two marts' shuffles are on disk together.
    """
    gold = _this_period(gold, ctx)
    found, spark = [], next(iter(rebuilt.values())).sparkSession
    for side, marts in (("silver", rebuilt), ("gold", gold)):
        for mart, df in marts.items():
            with shuffles_freed(df.sparkSession):
                found += content_checksums(df, mart, side).collect()
    is_silver = F.col("side") == "silver"
    pair = {
        side: F.max(F.when(is_silver if side == "silver" else ~is_silver, F.struct("total", "mixed"))) for side in ("silver", "gold")
    }
    sums = spark.createDataFrame(found, CHECKSUMS)
    per_column = sums.groupBy("mart", "column").agg(*[c.alias(side) for side, c in pair.items()])
    wrong = F.when(~F.col("silver").eqNullSafe(F.col("gold")), F.col("column"))
    return (
        per_column.groupBy("mart")
        .agg(F.array_join(F.sort_array(F.collect_list(wrong)), ",").alias("differs"))
        .withColumn("matches", F.col("differs") == "")
    )


def _this_period(gold: Mapping[str, DataFrame], ctx: RunContext | None) -> Mapping[str, DataFrame]:
    """Silver holds one run, so of marts with history only the run's period is compared with it."""
    if not (ctx and ctx.history):
        return gold
    this = (F.col("report_year") == ctx.report_year) & (F.col("report_month") == ctx.report_month)
    return {mart: df.filter(this) for mart, df in gold.items()}


def layer_reconciliation(
    silver: Callable[[str], DataFrame], gold: Mapping[str, DataFrame], ctx: RunContext | None = None
) -> DataFrame:
    """For each mart, the figure it must preserve, computed on both sides.

    Silver holds one run; of marts with history only the period of ``ctx`` is compared with it.
    """
    gold = _this_period(gold, ctx)
    billing, admission = silver("fact_billing"), silver("fact_admission")
    status = F.col("claim_status")
    pairs = {
        "gold_medicine_availability": (
            (silver("fact_medicine_inventory"), F.count("*")), F.count("*"),
        ),
        "gold_device_availability": (
            (silver("fact_device_usage"), F.sum("total_units")), F.sum("total_units"),
        ),
        "gold_finance_weekly": (
            (billing.filter(status == APPROVED), F.count("*")), F.sum("total_claims"),
        ),
        "gold_weekly_admissions": ((admission, F.count("*")), F.sum("total_admissions")),
        "gold_claim_status_summary": ((billing, F.count("*")), F.sum("claim_count")),
        "gold_rejected_claims": (
            (billing.filter(status == REJECTED), F.count("*")), F.sum("rejected_claim_count"),
        ),
        "gold_patient_status": ((admission, F.count("*")), F.sum("patient_count")),
    }
    sides = []
    for mart, ((table, silver_figure), gold_figure) in pairs.items():
        for side, df, figure in (("silver", table, silver_figure), ("gold", gold[mart], gold_figure)):
            sides.append(
                df.agg(F.coalesce(figure, F.lit(0)).alias("figure")).select(
                    F.lit(mart).alias("mart"), F.lit(side).alias("side"), "figure"
                )
            )
    figures = (
        reduce(DataFrame.unionByName, sides)
        .groupBy("mart")
        .agg(
            F.max(F.when(F.col("side") == "silver", F.col("figure"))).alias("silver_figure"),
            F.max(F.when(F.col("side") == "gold", F.col("figure"))).alias("gold_figure"),
        )
    )
    return figures.withColumn("matches", F.col("silver_figure") == F.col("gold_figure"))
