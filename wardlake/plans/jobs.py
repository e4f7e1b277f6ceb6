"""The batch job: landing CSV -> bronze -> silver -> gold, with gates and audit rows.

Each layer starts from files the previous one has finished, so nothing depends on
cached blocks or on a lineage longer than one layer. Row counts and gate counts
are observed in the write's last stage, where Spark counts every task once even
if it runs again on another executor; no table is scanned a second time for them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from typing import TypeVar

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from wardlake.context import RunContext
from wardlake.contracts import (
    BAD_RECORD,
    BUCKET_KEYS,
    DEVICE,
    GOLD,
    HOSPITAL,
    HOSPITAL_DIMENSIONS,
    PHARMA,
    SILVER,
    SourceContract,
    ddl,
)
from wardlake.operators import audit, cleanse, star
from wardlake.operators.validate import (
    ValidationError,
    duplicate_keys,
    enforce,
    gate_checks,
    shape_check,
    violation_counts,
)
from wardlake.plans import marts
from wardlake.plans.views import VIEWS
from wardlake.session import shuffles_freed
from wardlake.sources import tables
from wardlake.sources.landing import read_landing_csv, write_landing_csv

T = TypeVar("T")

ALL_SOURCES = (HOSPITAL, DEVICE, PHARMA)


def land_extracts(
    ctx: RunContext, extracts: Mapping[str, DataFrame], sources: Iterable[SourceContract] = ALL_SOURCES
) -> None:
    """Copy the source tables, from JDBC or anywhere else, to this period's landing files."""
    by_name = {s.name: s for s in sources}

    def land(name: str) -> None:
        source = by_name[name]
        with shuffles_freed(extracts[name].sparkSession):
            write_landing_csv(extracts[name].select(*source.columns), ctx.landing_path(source))

    for name in by_name:  # one by one: side by side, their shuffles would stand on disk together
        land(name)


def raw_to_bronze(spark: SparkSession, ctx: RunContext, source: SourceContract) -> int:
    """Gate one source and write it to bronze in a single pass; returns its row count.

    The rows go to this run's own directory. If the gate fails, the error stops the
    run before anything reads it.
    """
    scan = read_landing_csv(spark, ctx.landing_path(source), source, bad_records=True)
    checks = [*gate_checks(source), shape_check()]
    seen = Observation(f"raw_{source.name}_{ctx.run_id}")
    # Provenance is one value for all rows as long as nothing stands between it and the scan; behind
    # the observation it would be taken out of the path row by row.
    marked = cleanse.add_provenance(scan)
    observed = marked.observe(seen, F.count(F.lit(1)).alias("rows"), *violation_counts(checks))
    tables.write_parquet(observed.drop(BAD_RECORD), ctx.bronze_path(source))
    enforce(source.name, checks, seen.get)
    return seen.get["rows"]


def run_raw(
    spark: SparkSession, ctx: RunContext, sources: Iterable[SourceContract] = ALL_SOURCES
) -> None:
    by_name = {s.name: s for s in sources}
    counts = _concurrently(by_name, lambda name: raw_to_bronze(spark, ctx, by_name[name]))
    _audit(spark, ctx, "raw_nb", "raw", counts)


# The fact whose rows stand for a source in the audit table.
COUNTED = {
    "Hospital": "fact_admission",
    "Device": "fact_device_usage",
    "Pharma": "fact_medicine_inventory",
}


def run_silver(spark: SparkSession, ctx: RunContext) -> None:
    """Write a version of all ten tables, then publish them together; a failure before leaves the last one."""
    tables.create_silver(spark, ctx)
    tables.recover_silver(spark, ctx)
    bronze = {s.name: tables.read_bronze(spark, ctx.bronze_path(s)) for s in ALL_SOURCES}

    # Written once and read by six tables, each with only its own columns; it goes when they are there.
    clean_path = ctx.stage_path("clean_hospital")
    tables.write_parquet(cleanse.clean_hospital(bronze["Hospital"], ctx.as_of), clean_path)
    clean = {
        "Hospital": spark.read.parquet(clean_path),
        "Device": cleanse.type_device(bronze["Device"]),
        "Pharma": cleanse.clean_pharma(bronze["Pharma"], ctx.as_of),
    }

    version = tables.new_version(ctx)
    rules = {"Hospital": cleanse.hospital_rules(ctx.as_of), "Pharma": cleanse.pharma_rules(ctx.as_of)}

    def table(name: str) -> int:
        build, source = star.TABLES[name]
        if ctx.fact_buckets and name in BUCKET_KEYS:
            require_unique(build(clean[source]), BUCKET_KEYS[name], name)
        return _write_counted(
            tables.silver_layout(build(clean[source]), name, ctx),
            lambda out: tables.write_version(out, ctx, version, name),
            f"{name}_{ctx.run_id}",
        )

    def dimensions(_: str) -> int:
        tables.write_dimensions(star.hospital_dimensions(clean["Hospital"]), ctx, version)
        return 0

    def reject(name: str) -> int:
        return _write_counted(
            cleanse.rejected_rows(bronze[name], rules[name]),
            lambda out: tables.write_parquet(out, ctx.reject_path(name)),
            f"rejected_{name}_{ctx.run_id}",
        )

    # Dimensions come first: they alone shuffle, and so before the facts are on disk as well.
    others = sorted(set(SILVER) - set(HOSPITAL_DIMENSIONS))
    work = {t: table for t in others if t.startswith("dim_")} | {"hospital_dimensions": dimensions}
    work |= {t: table for t in others} | {s: reject for s in rules}
    try:
        rows = _concurrently(work, lambda name: work[name](name))
        tables.publish_silver(spark, ctx, version)
    except Exception:
        if tables.database_properties(spark, ctx.database)[tables.MOVING] != version:
            tables.remove_folder(spark, ctx.silver_folder(version))
        raise
    finally:
        tables.remove_folder(spark, clean_path)
    _audit(spark, ctx, "silver_nb", "silver", {s: rows[t] for s, t in COUNTED.items()})
    _audit(spark, ctx, "silver_nb", "reject", {s: rows[s] for s in rules})


def require_unique(df: DataFrame, key: str, table: str) -> None:
    """A bucket takes all rows of an id, so an id may only occur once."""
    if duplicate_keys(df, [key]).head(1):
        raise ValidationError(f"{table}: {key} is not unique, so it cannot be bucketed by it")


def drop_run(spark: SparkSession, ctx: RunContext) -> None:
    """Remove a run's databases and everything below its folder."""
    for database in (ctx.database, ctx.gold_database, ctx.audit_database):
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    tables.remove_folder(spark, ctx.base_path)


def run_gold(spark: SparkSession, ctx: RunContext) -> None:
    def refresh(mart: str) -> int:
        staged = ctx.stage_path(f"{mart}_{ctx.run_id}")
        try:
            built = build_mart(mart, lambda table: tables.read_silver(spark, ctx, table), ctx.report_month, staged)
            return _write_counted(
                built, lambda out: tables.write_gold(out, mart, ctx), f"{mart}_{ctx.run_id}"
            )
        finally:
            tables.remove_folder(spark, staged)

    # One by one, so that no two marts' shuffles are on disk together.
    _audit(spark, ctx, "gold_nb", "gold", {mart: refresh(mart) for mart in GOLD})


# From so many bytes of silver files on, a mart that can be built in slices is, in so many of them.
SLICE_FROM, SLICES = 64 << 20, 4


def build_mart(mart: str, silver: Callable[[str], DataFrame], report_month: str, staged: str) -> DataFrame:
    """A mart's rows; those of a large one that can be built in slices are put into ``staged`` slice by slice.

    Only one slice's shuffle is on disk at a time (see ``shuffles_freed``), for reading the silver tables once per slice.
    """
    sizes = [tables.file_bytes(silver(table)) for table in marts.MARTS[mart][1]]
    if mart not in marts.SLICED or sum(sizes) < SLICE_FROM:
        return marts.build_mart(mart, silver, report_month)
    for part in marts.slices(mart, silver, report_month, SLICES):
        part.write.options(**tables.PARQUET_OPTIONS).mode("append").parquet(staged)
    return part.sparkSession.read.schema(ddl(GOLD[mart])).parquet(staged)


def register_views(spark: SparkSession, ctx: RunContext) -> None:
    """External tables over gold, and the six serving views as temporary views."""
    gold = tables.external_gold_tables(spark, ctx)
    for name, (view, mart) in VIEWS.items():
        view(gold[mart]).createOrReplaceTempView(name)


def run_medallion(
    spark: SparkSession, ctx: RunContext, sources: Iterable[SourceContract] = ALL_SOURCES
) -> None:
    """All layers in order; a failure is written to the audit table and raised again."""
    ctx = replace(ctx, run_seq=tables.next_run_seq(spark, ctx))
    tables.append_audit(spark, ctx, [audit.start_row(ctx)])
    try:
        with shuffles_freed(spark):
            run_raw(spark, ctx, sources)
            run_silver(spark, ctx)
            run_gold(spark, ctx)
    except Exception as error:
        tables.append_audit(spark, ctx, [audit.fail_row(ctx, str(error))])
        raise


def _write_counted(df: DataFrame, write: Callable[[DataFrame], None], name: str) -> int:
    seen = Observation(name)
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def _concurrently(names: Iterable[str], work: Callable[[str], T]) -> dict[str, T]:
    """Run independent writes side by side, so one's last tasks leave no executor idle."""
    names = list(names)
    with ThreadPoolExecutor(max_workers=4) as pool:
        return dict(zip(names, pool.map(work, names)))


def _audit(
    spark: SparkSession, ctx: RunContext, notebook: str, layer: str, counts: Mapping[str, int]
) -> None:
    if ctx.run_seq is None:  # a layer that is run by itself
        ctx = replace(ctx, run_seq=tables.run_seq_of(spark, ctx))
    rows = [audit.audit_row(ctx, notebook, source, layer, n) for source, n in counts.items()]
    tables.append_audit(spark, ctx, rows)
