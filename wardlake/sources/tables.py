"""Bronze and gold Parquet, silver catalog tables, external tables, audit appends."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardlake.context import RunContext
from wardlake.contracts import AUDIT, BUCKET_KEYS, GOLD, HOSPITAL_DIMENSIONS, SILVER, conform, ddl

# Parquet directories

# A third less on disk than with the default codec.
PARQUET_OPTIONS = {"compression": "zstd"}


def write_parquet(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Overwrite ``path``. One file means one task, so it is only for small results."""
    (df.coalesce(1) if single_file else df).write.options(**PARQUET_OPTIONS).mode("overwrite").parquet(path)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_gold(df: DataFrame, name: str, ctx: RunContext) -> None:
    """Overwrite a mart; with ``ctx.history`` only the partition of this report period."""
    out = conform(df, GOLD[name])
    if not ctx.history:
        write_parquet(out, ctx.gold_path(name))
        return
    (
        out.withColumn("report_year", F.lit(ctx.report_year))
        .write.options(**PARQUET_OPTIONS)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("report_year", "report_month")
        .parquet(ctx.gold_path(name))
    )


# Catalog tables


def create_database(spark: SparkSession, ctx: RunContext, database: str) -> None:
    location = ctx.database_path(database)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")


def create_silver(spark: SparkSession, ctx: RunContext, recreate: bool = False) -> None:
    """The ten typed silver tables; ``recreate`` drops the schema first."""
    if recreate:
        spark.sql(f"DROP DATABASE IF EXISTS {ctx.database} CASCADE")
    create_database(spark, ctx, ctx.database)
    for table, contract in SILVER.items():
        layout = ""
        if ctx.fact_buckets and table in BUCKET_KEYS:
            key = BUCKET_KEYS[table]
            layout = f"CLUSTERED BY ({key}) INTO {ctx.fact_buckets} BUCKETS"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {ctx.silver_table(table)} ({ddl(contract)}) "
            f"USING parquet {layout}"
        )


def replace_table(df: DataFrame, table: str, contract: Mapping[str, str]) -> None:
    """Full refresh of a single table in one statement; ``df`` must not read ``table``.

    A run replaces all silver tables together instead: see ``publish_silver``.
    """
    conform(df, contract).write.insertInto(table, overwrite=True)


# Silver versions. A run writes its ten tables into a folder of its own, where nobody reads
# them, and publishes all of them by moving the tables' locations there. The database keeps the name of
# the version it shows, and of one it is moving to.

PUBLISHED, PREVIOUS, MOVING = "wardlake.published", "wardlake.previous", "wardlake.moving"
DIMENSIONS_FOLDER = "hospital_dimensions"


def new_version(ctx: RunContext) -> str:
    return f"{ctx.run_id}-{uuid.uuid4().hex[:8]}"


def version_path(ctx: RunContext, version: str, table: str) -> str:
    """Where a version keeps a table; the hospital dimensions are the partitions of one write."""
    folder = ctx.silver_folder(version)
    if table in HOSPITAL_DIMENSIONS:
        return f"{folder}/{DIMENSIONS_FOLDER}/dimension={table}"
    return f"{folder}/{table}"


def write_version(df: DataFrame, ctx: RunContext, version: str, table: str) -> None:
    """One table of a version. A bucketed one is written through a catalog table of its layout."""
    spark, path = df.sparkSession, version_path(ctx, version, table)
    if not (ctx.fact_buckets and table in BUCKET_KEYS):
        conform(df, SILVER[table]).write.options(**PARQUET_OPTIONS).parquet(path)
        return
    staged = f"{ctx.database}.{table}_{uuid.uuid4().hex[:8]}"
    spark.sql(
        f"CREATE TABLE {staged} ({ddl(SILVER[table])}) USING parquet "
        f"CLUSTERED BY ({BUCKET_KEYS[table]}) INTO {ctx.fact_buckets} BUCKETS LOCATION '{path}'"
    )
    try:
        conform(df, SILVER[table]).write.insertInto(staged, overwrite=True)
    finally:
        spark.sql(f"DROP TABLE {staged}")  # its files stay


def write_dimensions(df: DataFrame, ctx: RunContext, version: str) -> None:
    """All hospital dimensions of a version in one write, one partition each."""
    df.write.options(**PARQUET_OPTIONS).partitionBy("dimension").parquet(f"{ctx.silver_folder(version)}/{DIMENSIONS_FOLDER}")


def database_properties(spark: SparkSession, database: str) -> dict[str, str]:
    found = spark._jsparkSession.sessionState().catalog().getDatabaseMetadata(database).properties()
    return {PUBLISHED: "", PREVIOUS: "", MOVING: ""} | {k: found.apply(k) for k in (PUBLISHED, PREVIOUS, MOVING) if found.contains(k)}


def _set_properties(spark: SparkSession, database: str, **values: str) -> None:
    names = {"published": PUBLISHED, "previous": PREVIOUS, "moving": MOVING}
    listed = ", ".join(f"'{names[k]}' = '{v}'" for k, v in values.items())
    spark.sql(f"ALTER DATABASE {database} SET DBPROPERTIES ({listed})")


def _move(spark: SparkSession, ctx: RunContext, version: str) -> None:
    for table in SILVER:
        spark.sql(f"ALTER TABLE {ctx.silver_table(table)} SET LOCATION '{version_path(ctx, version, table)}'")
        spark.catalog.refreshTable(ctx.silver_table(table))


def publish_silver(spark: SparkSession, ctx: RunContext, version: str) -> None:
    """Show all tables of a complete version; if that fails on the way, all of the last one again.

    Of the earlier versions one is kept, for readers that still have it open. A driver that dies in
    between leaves ``MOVING`` behind, from which ``recover_silver`` goes on.
    """
    last = database_properties(spark, ctx.database)[PUBLISHED]
    for name in HOSPITAL_DIMENSIONS:  # an empty dimension has no partition on disk
        make_folder(spark, version_path(ctx, version, name))
    missing = [t for t in SILVER if not folder_exists(spark, version_path(ctx, version, t))]
    if missing:
        raise FileNotFoundError(f"version {version} lacks {missing}")
    _set_properties(spark, ctx.database, moving=version)
    try:
        _move(spark, ctx, version)
    except Exception:
        if last:
            _move(spark, ctx, last)
            _set_properties(spark, ctx.database, moving="")
        raise
    _set_properties(spark, ctx.database, published=version, previous=last, moving="")
    keep_versions(spark, ctx, {version, last})


def recover_silver(spark: SparkSession, ctx: RunContext) -> None:
    """Finish a switch that its driver did not live to finish; the version it moves to is complete."""
    found = database_properties(spark, ctx.database)
    if found[MOVING]:
        _move(spark, ctx, found[MOVING])
        _set_properties(spark, ctx.database, published=found[MOVING], previous=found[PUBLISHED], moving="")


def silver_snapshot(spark: SparkSession, ctx: RunContext) -> dict[str, DataFrame]:
    """All silver tables of the version published now, whatever is published while they are read."""
    version = database_properties(spark, ctx.database)[PUBLISHED]
    if not version:
        return {table: read_silver(spark, ctx, table) for table in SILVER}
    return {t: spark.read.schema(ddl(contract)).parquet(version_path(ctx, version, t)) for t, contract in SILVER.items()}


# Folders, through the file system of their path


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def make_folder(spark: SparkSession, path: str) -> None:
    files, found = _path(spark, path)
    files.mkdirs(found)


def folder_exists(spark: SparkSession, path: str) -> bool:
    files, found = _path(spark, path)
    return files.exists(found)


def remove_folder(spark: SparkSession, path: str) -> None:
    files, found = _path(spark, path)
    files.delete(found, True)


def file_bytes(table: DataFrame) -> int:
    """The size of a stored table's files, from their listing."""
    return int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def keep_versions(spark: SparkSession, ctx: RunContext, kept: set[str]) -> None:
    """Remove the folders of all other versions."""
    files, root = _path(spark, ctx.silver_folder(""))
    for status in files.listStatus(root):
        if status.getPath().getName() not in kept:
            files.delete(status.getPath(), True)


def silver_layout(df: DataFrame, table: str, ctx: RunContext) -> DataFrame:
    """The rows of a bucketed table, one task per bucket, so that a bucket is one file."""
    if ctx.fact_buckets and table in BUCKET_KEYS:
        return df.repartition(ctx.fact_buckets, BUCKET_KEYS[table])
    return df


def read_silver(spark: SparkSession, ctx: RunContext, table: str) -> DataFrame:
    return spark.table(ctx.silver_table(table))


def external_table(
    spark: SparkSession, name: str, path: str, contract: Mapping[str, str]
) -> DataFrame:
    """Declare a typed table over a Parquet directory; dropping it leaves the files."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({ddl(contract)}) USING parquet LOCATION '{path}'")
    return spark.table(name)


def external_gold_tables(spark: SparkSession, ctx: RunContext) -> dict[str, DataFrame]:
    """All seven marts as external tables, named without the ``gold_`` prefix.

    A mart with history is partitioned by period, so its table declares the partition
    columns and then discovers the partitions on disk.
    """
    create_database(spark, ctx, ctx.gold_database)
    tables = {}
    for mart, contract in GOLD.items():
        name = f"{ctx.gold_database}.{mart.removeprefix('gold_')}"
        if ctx.history:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            spark.sql(
                f"CREATE TABLE {name} ({ddl(contract)}, report_year INT) USING parquet "
                f"PARTITIONED BY (report_year, report_month) LOCATION '{ctx.gold_path(mart)}'"
            )
            spark.sql(f"MSCK REPAIR TABLE {name}")
            tables[mart] = spark.table(name)
        else:
            tables[mart] = external_table(spark, name, ctx.gold_path(mart), contract)
    return tables


# Inspection


def preview(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in a total order: a top-n in every task, then one merge of n rows each."""
    return df.orderBy(*order).limit(n)


def footer_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` whose Parquet reader takes counts from the files' footers."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def row_counts(spark: SparkSession, paths: Mapping[str, str], schemas: Mapping[str, str]) -> DataFrame:
    """``(table_name, row_count)`` of Parquet tables by their paths, without reading a column."""
    session = footer_session(spark)
    counts = []
    for name, path in paths.items():
        pushed = session.read.schema(schemas[name]).parquet(path).agg(F.count("*").alias("row_count"))
        counts.append(pushed.select(F.lit(name).alias("table_name"), "row_count"))
    # The pushed count of a table without a row group is NULL, though a count's type has no NULL and
    # a plain coalesce would be optimised away; behind an outer join it is not.
    names = session.createDataFrame([(name,) for name in paths], "table_name string")
    found = names.join(reduce(DataFrame.unionByName, counts), "table_name", "left")
    return found.select("table_name", F.coalesce("row_count", F.lit(0)).alias("row_count"))


# Audit


def create_audit(spark: SparkSession, ctx: RunContext) -> None:
    create_database(spark, ctx, ctx.audit_database)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {ctx.audit_table} ({ddl(AUDIT)}) USING parquet")


def next_run_seq(spark: SparkSession, ctx: RunContext) -> int:
    """One more than the highest run number of the audit table."""
    create_audit(spark, ctx)
    return (spark.table(ctx.audit_table).agg(F.max("run_seq")).first()[0] or 0) + 1


def run_seq_of(spark: SparkSession, ctx: RunContext) -> int:
    """The run's number if it has rows in the audit table, else the next one."""
    create_audit(spark, ctx)
    own = spark.table(ctx.audit_table).filter(F.col("run_id") == ctx.run_id).agg(F.max("run_seq")).first()[0]
    return own or next_run_seq(spark, ctx)


def append_audit(spark: SparkSession, ctx: RunContext, rows: list[tuple]) -> None:
    """Append the rows of one step in one write."""
    create_audit(spark, ctx)
    spark.createDataFrame(rows, ddl(AUDIT)).coalesce(1).write.insertInto(ctx.audit_table)
