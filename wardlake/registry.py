"""Every operator as a query over the TPC-H-like tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from wardlake.context import RunContext
from wardlake.contracts import DEVICE, GOLD, HOSPITAL, HOSPITAL_DIMENSIONS, PHARMA, SILVER, SOURCES, SourceContract
from wardlake.functions.scalars import as_date, month_name, normalize_hospital_id, previous_month
from wardlake.operators import audit, cleanse, star, validate
from wardlake.plans import jobs, kpis, marts, views
from wardlake.session import shuffles_freed
from wardlake.sources import bindings, landing, tables
from wardlake.sources.shared import shared_folder

Query = Callable[[SparkSession, str], DataFrame]

# The bound tables end in 2001; "today" lies inside their range.
AS_OF = date(1998, 7, 1)
INPUT_DATE = "20260201"
REPORT_MONTH = "January"
RUN_DATE = date(2026, 2, 1)
RUN_ID = "bound-run"
STOPPED_RUN_ID = "stopped-run"

# Bound ids are longer than the six characters the real extracts use.
BOUND_SOURCES = (
    HOSPITAL,
    replace(DEVICE, max_lengths={"device_id": 20}),
    replace(PHARMA, max_lengths={"medicine_id": 20}),
)
# Under these no extract passes the gate.
STRICT_SOURCES = (HOSPITAL, replace(DEVICE, max_lengths={"device_id": 1}), BOUND_SOURCES[2])


@dataclass(frozen=True)
class Bound:
    """The source, silver and gold DataFrames over one set of tables, unevaluated."""

    spark: SparkSession
    sf_dir: str
    _built: dict[tuple[str, str], DataFrame] = field(default_factory=dict)

    def source(self, contract: SourceContract) -> DataFrame:
        bind = bindings.BINDINGS[contract.name]
        return self._once("source", contract.name, lambda: bind(self.spark, self.sf_dir))

    def defective(self, contract: SourceContract) -> DataFrame:
        return bindings.with_defects(self.source(contract), contract)

    def clean(self, name: str) -> DataFrame:
        return self._once("clean", name, lambda: self._clean(name))

    def _clean(self, name: str) -> DataFrame:
        source = self.source(SOURCES[name])
        if name == "Hospital":
            return cleanse.clean_hospital(source, AS_OF)
        if name == "Pharma":
            return cleanse.clean_pharma(source, AS_OF)
        return cleanse.type_device(source)

    def _once(self, kind: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """Plans (not rows) are kept: opening a table lists files and reads a footer."""
        if (kind, name) not in self._built:
            self._built[kind, name] = build()
        return self._built[kind, name]

    def silver(self, table: str) -> DataFrame:
        build, source = star.TABLES[table]
        return build(self.clean(source))

    def gold(self, mart: str) -> DataFrame:
        return marts.build_mart(mart, self.silver, REPORT_MONTH)

    def view(self, name: str) -> DataFrame:
        function, mart = views.VIEWS[name]
        return function(self.gold(mart))

    def stored(self, mart: str) -> DataFrame:
        """A mart as a written table, for plans that read it more than once."""
        ctx = self.context()
        tables.write_gold(self.gold(mart), mart, ctx)
        return self.spark.read.schema(tables.ddl(GOLD[mart])).parquet(ctx.gold_path(mart))

    def context(self) -> RunContext:
        base = shared_folder(self.spark)
        unique = base.rsplit("/", 1)[-1]
        ctx = RunContext(
            input_date=INPUT_DATE, base_path=base, as_of=AS_OF, run_date=RUN_DATE, run_id=RUN_ID,
            database=f"silver_{unique}", gold_database=f"gold_{unique}",
            audit_database=f"audit_{unique}",
        )
        OPEN_RUNS.append(ctx)
        return ctx

    def land(self, ctx: RunContext, *sources: SourceContract) -> None:
        jobs.land_extracts(ctx, {s.name: self.source(s) for s in sources}, sources)

    def run(self) -> RunContext:
        """Land the extracts and run all layers."""
        ctx = self.context()
        self.land(ctx, *BOUND_SOURCES)
        jobs.run_medallion(self.spark, ctx, BOUND_SOURCES)
        return ctx

    def shared_run(self) -> RunContext:
        """One full run per session and table directory, for all queries that only read what it wrote."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir)
        if key not in SHARED_RUNS:
            SHARED_RUNS[key] = self.run()
        return SHARED_RUNS[key]

    def audit_table(self, ctx: RunContext) -> DataFrame:
        """The rows of a run."""
        return self.spark.table(ctx.audit_table).filter(F.col("run_id") == ctx.run_id)


QUERIES: dict[str, Query] = {}

# Runs of registered queries whose tables a caller may still be reading, and those that queries share.
OPEN_RUNS: list[RunContext] = []
SHARED_RUNS: dict[tuple[str, str], RunContext] = {}


def close_runs(spark: SparkSession, shared: bool = True) -> None:
    """Remove the databases and folders of the runs so far; their DataFrames end with them.

    Without ``shared`` those that several queries read stay.
    """
    kept = [] if shared else [ctx for ctx in OPEN_RUNS if ctx in SHARED_RUNS.values()]
    for ctx in [ctx for ctx in OPEN_RUNS if ctx not in kept]:
        jobs.drop_run(spark, ctx)
    OPEN_RUNS[:] = kept
    if shared:
        SHARED_RUNS.clear()


def query(function: Callable[[Bound], DataFrame]) -> Callable[[Bound], DataFrame]:
    QUERIES[function.__name__] = lambda spark, sf_dir: function(Bound(spark, sf_dir))
    return function


def _register(name: str, build: Callable[[Bound], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: build(Bound(spark, sf_dir))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --------------------------------------------------------------------------
# Scans and sinks
# --------------------------------------------------------------------------


@query
def scan_landing_csv(b: Bound) -> DataFrame:
    ctx = b.context()
    b.land(ctx, HOSPITAL)
    return landing.read_landing_csv(b.spark, ctx.landing_path(HOSPITAL), HOSPITAL).drop("file_path")


@query
def landing_csv_round_trip(b: Bound) -> DataFrame:
    ctx = b.context()
    b.land(ctx, PHARMA)
    return landing.read_landing_csv(b.spark, ctx.landing_path(PHARMA), PHARMA).drop("file_path")


@query
def landing_manifest(b: Bound) -> DataFrame:
    ctx = b.context()
    b.land(ctx, *BOUND_SOURCES)
    return landing.landing_manifest(
        b.spark, ctx.landing_folder, [ctx.landing_file(s) for s in BOUND_SOURCES]
    )


@query
def column_contract_report(b: Bound) -> DataFrame:
    """Contract outcome per source over the headers of all its files, and the rows behind them."""
    ctx = b.context()
    b.land(ctx, *BOUND_SOURCES)
    reports = []
    for source in BOUND_SOURCES:
        path = ctx.landing_path(source)
        headers = landing.header_report(b.spark, path, source).agg(
            F.lit(source.name).alias("source"),
            F.lit(len(source.landing_columns)).alias("expected_columns"),
            (F.max(F.size(F.split("header", ","))) + 1).alias("found_columns"),
            F.bool_and("passed").alias("passed"),
        )
        rows = landing.line_counts(b.spark, path).agg(
            F.lit(source.name).alias("source"), F.sum(F.col("lines") - 1).alias("rows_checked")
        )
        reports.append(rows.join(headers, "source").select(*headers.columns, "rows_checked"))
    return _union(reports)


@query
def header_contract_cases(b: Bound) -> DataFrame:
    """A landing with good files, and three whose second half has a wrong header, per case."""
    ctx = b.context()
    good = bindings.as_text(b.source(PHARMA), PHARMA)
    first = list(PHARMA.columns)
    cases = {
        "good": good,
        "swapped": good.select(first[1], first[0], *first[2:]),
        "renamed": good.withColumnRenamed("expiry_date", "expires"),
        "extra": good.withColumn("extra", F.lit("x")),
    }
    even = F.crc32("medicine_id") % 2 == 0
    reports = []
    for case, other in cases.items():
        folder = f"{ctx.landing_folder}/{case}"
        landing.write_landing_csv(good.filter(even), f"{folder}/a.csv")
        landing.write_landing_csv(other.filter(~even), f"{folder}/b.csv")
        report = landing.header_report(b.spark, f"{folder}/*.csv", PHARMA).agg(
            F.lit(case).alias("case"), F.bool_and("passed").alias("passed")
        )
        lines = landing.line_counts(b.spark, [f"{folder}/a.csv", f"{folder}/b.csv"])
        counted = lines.agg(F.lit(case).alias("case"), F.sum(F.col("lines") - 1).alias("rows"))
        reports.append(counted.join(report, "case").select("case", "passed", "rows"))
    return _union(reports)


@query
def history_claim_views(b: Bound) -> DataFrame:
    """Two stored months; the claim views over both give each month its own figures."""
    ctx = replace(b.context(), history=True)
    status, rejected = "gold_claim_status_summary", "gold_rejected_claims"
    for run in (ctx, replace(ctx, input_date="20260301")):
        for mart in (status, rejected):
            tables.write_gold(marts.build_mart(mart, b.silver, run.report_month), mart, run)
    stored = {mart: b.spark.read.parquet(ctx.gold_path(mart)) for mart in (status, rejected)}
    ranks = views.vw_rejected_claims_ranking(stored[rejected])
    return views.vw_claim_status_breakdown(stored[status]).join(
        ranks, ["insurance_name", "report_year", "report_month"], "left"
    )


@query
def provenance_columns(b: Bound) -> DataFrame:
    ctx = b.context()
    b.land(ctx, PHARMA)
    landed = landing.read_landing_csv(b.spark, ctx.landing_path(PHARMA), PHARMA)
    return cleanse.add_provenance(landed).select(
        "medicine_id", "hospital_id", "file_name_last", "Month", "Year"
    )


@query
def scan_bronze_parquet(b: Bound) -> DataFrame:
    """Landing to bronze through the gate, then the bronze scan."""
    ctx = b.context()
    device = BOUND_SOURCES[1]
    b.land(ctx, device)
    jobs.raw_to_bronze(b.spark, ctx, device)
    return tables.read_bronze(b.spark, ctx.bronze_path(device)).drop("file_path")


@query
def bronze_round_trip(b: Bound) -> DataFrame:
    path = b.context().bronze_path(HOSPITAL)
    tables.write_parquet(bindings.as_text(b.source(HOSPITAL), HOSPITAL), path)
    return tables.read_bronze(b.spark, path)


@query
def silver_replace_idempotent(b: Bound) -> DataFrame:
    ctx = b.context()
    tables.create_silver(b.spark, ctx)
    for _ in range(2):
        tables.replace_table(
            b.silver("fact_billing"), ctx.silver_table("fact_billing"), SILVER["fact_billing"]
        )
    return tables.read_silver(b.spark, ctx, "fact_billing")


@query
def silver_published_together(b: Bound) -> DataFrame:
    """A version is published, and the next one stops half-way: rows of all ten tables."""
    ctx = b.context()
    tables.create_silver(b.spark, ctx)
    own_writes = sorted(set(SILVER) - set(HOSPITAL_DIMENSIONS))
    for written in (own_writes, own_writes[:1]):
        version = tables.new_version(ctx)
        tables.write_dimensions(star.hospital_dimensions(b.clean("Hospital")), ctx, version)
        for table in written:
            tables.write_version(b.silver(table), ctx, version, table)
        try:
            tables.publish_silver(b.spark, ctx, version)
        except FileNotFoundError:  # the second version lacks tables
            tables.remove_folder(b.spark, ctx.silver_folder(version))
    return _union([
        df.agg(F.lit(table).alias("table_name"), F.count("*").alias("row_count"))
        for table, df in tables.silver_snapshot(b.spark, ctx).items()
    ])


@query
def hospital_dimensions(b: Bound) -> DataFrame:
    """All four hospital dimensions by one scan of the cleansed rows and one shuffle."""
    return star.hospital_dimensions(b.clean("Hospital"))


@query
def gold_round_trip(b: Bound) -> DataFrame:
    ctx = b.context()
    mart = "gold_claim_status_summary"
    tables.write_gold(b.gold(mart), mart, ctx)
    return b.spark.read.schema(tables.ddl(GOLD[mart])).parquet(ctx.gold_path(mart))


@query
def external_gold_scan(b: Bound) -> DataFrame:
    ctx = b.context()
    mart = "gold_finance_weekly"
    tables.write_gold(b.gold(mart), mart, ctx)
    tables.create_database(b.spark, ctx, ctx.gold_database)
    return tables.external_table(
        b.spark, f"{ctx.gold_database}.finance_weekly", ctx.gold_path(mart), GOLD[mart]
    )


@query
def gold_row_counts(b: Bound) -> DataFrame:
    """Rows of the seven marts of a run, and of the three sources, from the footers of their files."""
    ctx = b.shared_run()
    paths = {mart: ctx.gold_path(mart) for mart in GOLD}
    schemas = {mart: tables.ddl(contract) for mart, contract in GOLD.items()}
    for source in BOUND_SOURCES:
        name = f"{source.name.lower()}_events"
        paths[name], schemas[name] = ctx.bronze_path(source), source.text_schema
    return tables.row_counts(b.spark, paths, schemas)


@query
def preview_top5(b: Bound) -> DataFrame:
    return tables.preview(
        b.view("vw_finance_summary"), 5, "week_start_date", "insurance_id", "insurance_name"
    )


# The first five rows of the other views and of the sources, each in a total order.
VIEW_PREVIEWS = {
    "vw_medicine_stock_alert": ("hospital_id", "medicine_name", "category", "available_stock", "expiry_date"),
    "vw_device_utilization": ("hospital_id", "device_type"),
    "vw_weekly_admissions": ("week_start_date",),
    "vw_claim_status_breakdown": ("insurance_name", "claim_status"),
    "vw_rejected_claims_ranking": ("rejection_rank", "insurance_name"),
}
SOURCE_PREVIEWS = {
    "Hospital": ("event_id",),
    "Device": ("hospital_id", "device_id", "week", "total_units", "in_use_units"),
    "Pharma": ("medicine_id", "hospital_id"),
}
for _view, _order in VIEW_PREVIEWS.items():
    _register(
        f"preview_{_view.removeprefix('vw_')}",
        lambda b, v=_view, o=_order: tables.preview(QUERIES[v](b.spark, b.sf_dir), 5, *o),
    )
for _name, _order in SOURCE_PREVIEWS.items():
    _register(
        f"preview_{_name.lower()}_events",
        lambda b, n=_name, o=_order: tables.preview(b.source(SOURCES[n]), 5, *o),
    )

# --------------------------------------------------------------------------
# Gates
# --------------------------------------------------------------------------

for _source in SOURCES.values():
    _register(
        f"null_counts_{_source.name.lower()}",
        lambda b, s=_source: validate.null_counts(b.defective(s), s.not_null),
    )
    _register(
        f"quality_report_{_source.name.lower()}",
        lambda b, s=_source: validate.quality_report(
            b.defective(s),
            validate.hospital_checks(s, AS_OF) if s is HOSPITAL else validate.gate_checks(s),
        ),
    )


def _per_source(b: Bound, check_name: str) -> DataFrame:
    reports = []
    for source in SOURCES.values():
        checks = [c for c in validate.gate_checks(source) if c.name == check_name]
        report = validate.quality_report(b.defective(source), checks)
        reports.append(report.withColumn("source", F.lit(source.name)).drop("check"))
    return _union(reports)


@query
def string_length_violations(b: Bound) -> DataFrame:
    return _per_source(b, "max_length")


@query
def int_cast_violations(b: Bound) -> DataFrame:
    return _per_source(b, "castable_int")


_HOSPITAL_CHECKS = {
    "gender_violations": lambda: validate.gender_check(),
    "dob_violations": lambda: validate.dob_check(AS_OF),
    "admission_discharge_violations": lambda: validate.stay_check(),
    "billed_lt_approved_violations": lambda: validate.at_least_check(
        "billed_amount", "approved_amount"
    ),
}
for _name, _check in _HOSPITAL_CHECKS.items():
    _register(
        _name, lambda b, check=_check: validate.quality_report(b.source(HOSPITAL), [check()])
    )

# Ids that joins rely on: the source keys, and every dimension's own id.
DIMENSION_KEYS = {
    "dim_medicine": ("medicine_id",),
    "dim_device": ("device_id", "hospital_id"),
    "dim_insurance": ("insurance_id",),
    "dim_patient": ("patient_id",),
    "dim_doctor": ("doctor_id",),
    "dim_bed": ("bed_id",),
}


def key_rules(source: SourceContract) -> list[validate.KeyRule]:
    """The key of a source, and those of the dimensions that its cleansed rows make."""
    kept = {
        "Hospital": lambda: cleanse.all_hold(cleanse.hospital_rules(AS_OF)),
        "Pharma": lambda: cleanse.all_hold(cleanse.pharma_rules(AS_OF)),
    }
    applies = kept[source.name]() if source.name in kept else None
    rules = [validate.KeyRule(source.name, source.key)]
    for table, key in DIMENSION_KEYS.items():
        if star.TABLES[table][1] == source.name:
            others = [as_date(c) if t == "date" else F.col(c) for c, t in SILVER[table].items() if c not in key]
            rules.append(validate.KeyRule(table, key, tuple(others), applies))
    return rules


@query
def duplicate_keys(b: Bound) -> DataFrame:
    """All nine keys; every source is read once."""
    return validate.key_uniqueness([(b.source(s), key_rules(s)) for s in SOURCES.values()])


# --------------------------------------------------------------------------
# Cleansing
# --------------------------------------------------------------------------


@query
def report_period(b: Bound) -> DataFrame:
    """Every order day as a run's ``input_date``."""
    orders = b.spark.read.parquet(f"{b.sf_dir}/orders.parquet")
    previous = previous_month(F.col("input_date"))
    return (
        orders.groupBy(F.date_format("o_orderdate", "yyyyMMdd").alias("input_date"))
        .agg(F.count("*").alias("row_count"))
        .select(
            "input_date",
            month_name(previous).alias("report_month"),
            F.year(previous).alias("report_year"),
            "row_count",
        )
    )


_register("clean_hospital", lambda b: b.clean("Hospital"))
_register("clean_pharma", lambda b: b.clean("Pharma"))


@query
def hospital_reject_reasons(b: Bound) -> DataFrame:
    rejected = cleanse.rejected_rows(b.source(HOSPITAL), cleanse.hospital_rules(AS_OF))
    return rejected.select("event_id", F.array_join("failed_rules", ",").alias("failed_rules"))


@query
def pharma_reject_reasons(b: Bound) -> DataFrame:
    rejected = cleanse.rejected_rows(b.source(PHARMA), cleanse.pharma_rules(AS_OF))
    return rejected.select(
        "medicine_id", "hospital_id", F.array_join("failed_rules", ",").alias("failed_rules")
    )


@query
def hospital_id_conformance(b: Bound) -> DataFrame:
    """Rows per hospital and source once padded ids (``H007``) and plain ones (``H7``) agree."""
    counted = []
    for source in SOURCES.values():
        hospital_id = F.col("hospital_id")
        if source is DEVICE:
            hospital_id = F.regexp_replace(hospital_id, "^H", "H00")
        counted.append(
            b.source(source)
            .groupBy(normalize_hospital_id(hospital_id).alias("hospital_id"))
            .agg(F.count("*").alias("row_count"))
            .withColumn("source", F.lit(source.name))
        )
    rows = {
        f"{name.lower()}_rows": F.coalesce(
            F.sum(F.when(F.col("source") == name, F.col("row_count"))), F.lit(0)
        )
        for name in SOURCES
    }
    return (
        _union(counted)
        .groupBy("hospital_id")
        .agg(*[expr.alias(name) for name, expr in rows.items()])
    )


# --------------------------------------------------------------------------
# Star schema, marts, views, measures
# --------------------------------------------------------------------------

for _table in SILVER:
    _register(_table, lambda b, t=_table: b.silver(t))
for _mart in GOLD:
    _register(_mart, lambda b, m=_mart: b.gold(m))
for _view in views.VIEWS:
    _register(_view, lambda b, v=_view: b.view(v))


@query
def vw_rejected_claims_ranking(b: Bound) -> DataFrame:
    """The ranking reads its mart twice, so it reads the written one."""
    return views.vw_rejected_claims_ranking(b.stored("gold_rejected_claims"))



_register(
    "category_distribution",
    lambda b: marts.category_distribution(
        b.silver("fact_medicine_inventory"), b.silver("dim_medicine"), REPORT_MONTH
    ),
)
_register("kpi_admissions", lambda b: kpis.kpi_admissions(b.silver("fact_admission")))
_register("kpi_admissions_by_department", lambda b: kpis.kpi_admissions_by_department(b.clean("Hospital")))
_register("kpi_finance_totals", lambda b: kpis.kpi_finance_totals(b.gold("gold_finance_weekly")))
_register(
    "kpi_leakage_by_insurer", lambda b: kpis.kpi_leakage_by_insurer(b.gold("gold_finance_weekly"))
)
_register(
    "kpi_claim_distribution",
    lambda b: kpis.kpi_claim_distribution(b.gold("gold_claim_status_summary")),
)
_register(
    "kpi_utilization_matrix",
    lambda b: kpis.matrix_text(kpis.kpi_utilization_matrix(b.gold("gold_device_availability"))),
)
_register(
    "kpi_utilization_bands", lambda b: kpis.kpi_utilization_bands(b.gold("gold_device_availability"))
)
_register(
    "kpi_units_by_device_type",
    lambda b: kpis.kpi_units_by_device_type(b.gold("gold_device_availability")),
)
_register(
    "kpi_overloaded_devices",
    lambda b: kpis.kpi_overloaded_devices(b.gold("gold_device_availability")),
)
_register("kpi_low_stock", lambda b: kpis.kpi_low_stock(b.view("vw_medicine_stock_alert")))
_register(
    "expiry_status_summary", lambda b: kpis.expiry_status_summary(b.source(PHARMA), AS_OF)
)
_register(
    "kpi_stock_by_medicine",
    lambda b: kpis.kpi_stock_by_medicine(
        b.silver("fact_medicine_inventory"), b.silver("dim_medicine")
    ),
)

# --------------------------------------------------------------------------
# Jobs and audit
# --------------------------------------------------------------------------


def _layer_counts(b: Bound, layer: str) -> DataFrame:
    ctx = b.shared_run()
    return audit.audit_by(b.audit_table(ctx), layer=layer).select("source", "record_count")


_register("raw_layer_counts", lambda b: _layer_counts(b, "raw"))
_register("silver_layer_counts", lambda b: _layer_counts(b, "silver"))
_register("gold_layer_counts", lambda b: _layer_counts(b, "gold"))
_register("audit_log", lambda b: b.audit_table(b.shared_run()))
_register("audit_by_layer", lambda b: audit.audit_by(b.audit_table(b.shared_run()), layer="gold"))


@query
def audit_recent(b: Bound) -> DataFrame:
    """Newest first, with the place each row has in that order; a run has some twenty rows."""
    log = b.audit_table(b.shared_run())
    place = F.row_number().over(Window.orderBy(*audit.newest_first()))
    return audit.audit_recent(log.withColumn("place", place))


@query
def audit_run_health(b: Bound) -> DataFrame:
    """The state of a whole run, and of one that its gate stopped: its device ids may have one character."""
    ctx = replace(b.shared_run(), run_id=STOPPED_RUN_ID)
    if b.audit_table(ctx).isEmpty():
        try:
            jobs.run_medallion(b.spark, ctx, STRICT_SOURCES)
        except validate.ValidationError:
            pass  # what is left of it is in the audit table
    return audit.audit_run_health(b.spark.table(ctx.audit_table))


def _reconciled(b: Bound, ctx: RunContext, gold: Mapping[str, DataFrame]) -> DataFrame:
    """The marts rebuilt from silver, as a run builds them, against ``gold``."""
    silver, staged = tables.silver_snapshot(b.spark, ctx), ctx.stage_path(f"rebuilt_{uuid.uuid4().hex}")
    try:
        with shuffles_freed(b.spark):
            rebuilt = {m: jobs.build_mart(m, silver.__getitem__, ctx.report_month, f"{staged}/{m}") for m in GOLD}
        return audit.content_reconciliation(rebuilt, gold, ctx)
    finally:
        tables.remove_folder(b.spark, staged)


@query
def content_reconciliation(b: Bound) -> DataFrame:
    ctx = b.shared_run()
    return _reconciled(b, ctx, tables.external_gold_tables(b.spark, ctx))


@query
def content_reconciliation_swapped(b: Bound) -> DataFrame:
    """The same after the least and the greatest billed amount of the finance mart changed places."""
    ctx, mart, amount = b.shared_run(), "gold_finance_weekly", "total_billed_amount"
    gold = dict(tables.external_gold_tables(b.spark, ctx))
    low, high = gold[mart].agg(F.min(amount), F.max(amount)).first()
    value = F.col(amount)
    gold[mart] = gold[mart].withColumn(amount, F.when(value == low, high).when(value == high, low).otherwise(value))
    return _reconciled(b, ctx, gold)


@query
def layer_reconciliation(b: Bound) -> DataFrame:
    ctx = b.shared_run()
    return audit.layer_reconciliation(
        lambda table: tables.read_silver(b.spark, ctx, table),
        tables.external_gold_tables(b.spark, ctx),
        ctx,
    )


_register("raw_balance", lambda b: audit.raw_balance(b.audit_table(b.shared_run())))
