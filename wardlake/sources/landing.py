"""Landing CSV: header, ``,`` between fields, ``"`` as quote, ``\\`` as escape."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardlake.contracts import BAD_RECORD, SourceContract
from wardlake.functions.scalars import landing_file
from wardlake.operators.validate import check_columns

# Blanks are data: neither side trims them. An empty string and NULL are one, both read as NULL.
CSV_OPTIONS = {
    "header": True, "sep": ",", "quote": '"', "escape": "\\",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}
# Landing text is several times as large as its tables, so it is written compressed. A compressed file is read
# as a whole by one task, so files have a bound.
WRITE_OPTIONS = {
    **CSV_OPTIONS, "compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 1_000_000,
}


def write_landing_csv(df: DataFrame, path: str) -> None:
    """Every column as text; a directory of compressed part files, one or more per task, each with a header.

    A record is a line, so that plain files can be split: a value with a line break fails the write.
    """
    message = F.lit("a landing value holds a line break")
    text = df.select(*[_line(F.col(c).cast("string"), kind, message).alias(c) for c, kind in df.dtypes])
    text.write.options(**WRITE_OPTIONS).mode("overwrite").csv(path)


# Types whose text holds digits, signs and names only.
UNBROKEN = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal", "boolean", "date", "timestamp")


def _line(text: Column, kind: str, message: Column) -> Column:
    """``text`` if it is one line; two searches for a byte cost far less than a pattern."""
    if kind.startswith(UNBROKEN):
        return text
    breaks = F.contains(text, F.lit("\n")) | F.contains(text, F.lit("\r"))
    return F.when(breaks, F.raise_error(message).cast("string")).otherwise(text)


# More than any landing file has, so that a file is one split, and a split one task.
ONE_FILE = str(1 << 40)


def landing_headers(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(file, header)``: the first line of every landing file.

    A task opens one file and stops after its first line, so what is read does not grow with the files.
    """
    apart = spark.newSession()  # how files are dealt into tasks is set per session
    apart.conf.set("spark.sql.files.maxPartitionBytes", ONE_FILE)
    apart.conf.set("spark.sql.files.openCostInBytes", ONE_FILE)
    lines = apart.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("header"))
    return first_of_each_task(lines)


def first_of_each_task(df: DataFrame) -> DataFrame:
    """One row of every partition, which is read no further: the local half of ``limit(1)``.

    A function over batches would not do: the JVM goes on sending it rows after it has returned.
    """
    spark = df.sparkSession
    local = df.limit(1)._jdf.logicalPlan().child()  # below a GlobalLimit, which would keep one row of all
    return DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, local), spark)


def header_report(spark: SparkSession, path: str | Sequence[str], contract: SourceContract) -> DataFrame:
    """``(file, header, passed)`` for every landing file, whatever columns anyone reads."""
    expected = ",".join(contract.columns)
    return landing_headers(spark, path).withColumn("passed", F.col("header") == expected)


def line_counts(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(file, lines)`` of every landing file; all lines but the header are records."""
    return spark.read.text(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("lines"))


def landing_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of the first file, ``file_path`` appended as in the contract."""
    return [*spark.read.options(**CSV_OPTIONS).csv(path).columns, "file_path"]


def read_landing_csv(
    spark: SparkSession, path: str, contract: SourceContract, bad_records: bool = False
) -> DataFrame:
    """All columns as text, plus ``file_path``, the landing file the caller names.

    As a literal it folds to a constant, and so does everything derived from it. The first file's
    header is compared on the driver, before any row is read; with ``enforceSchema`` off the tasks
    compare the header of every other file, and with ``columnPruning`` off they do so for all
    columns, also under a count. ``bad_records`` adds the text of records with too few or too many
    fields as ``bad_record``.
    """
    check_columns(landing_header(spark, path), contract.landing_columns)
    scan = spark.read.options(**CSV_OPTIONS).option("enforceSchema", False).option("columnPruning", False)
    schema = contract.text_schema
    if bad_records:
        scan = scan.option("columnNameOfCorruptRecord", BAD_RECORD)
        schema += f", {BAD_RECORD} STRING"
    return scan.schema(schema).csv(path).withColumn("file_path", F.lit(path))


def landing_manifest(spark: SparkSession, folder: str, expected: Sequence[str]) -> DataFrame:
    """``(file_name, row_count, present)`` for every expected landing file, found or not.

    Presence comes from listing the folder, so a file with nothing but a header is present. Rows
    are counted per physical file first, so the name is taken out of a path once per file.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    found = listed.select(landing_file(F.col("path"), 1).alias("file_name")).distinct()
    per_part = (
        spark.read.options(**CSV_OPTIONS)
        .option("recursiveFileLookup", True)
        .schema("first_column STRING")
        .csv(folder)
        .groupBy(F.col("_metadata.file_path").alias("path"))
        .agg(F.count("*").alias("part_rows"))
    )
    kinds = [
        spark.createDataFrame([(name,) for name in expected], "file_name string").select(
            "file_name", F.lit(0).cast("bigint").alias("part_rows"), F.lit(True).alias("expected"), F.lit(False).alias("present")
        ),
        found.select("file_name", F.lit(0).cast("bigint").alias("part_rows"), F.lit(False).alias("expected"), F.lit(True).alias("present")),
        per_part.select(
            landing_file(F.col("path"), 1).alias("file_name"), "part_rows", F.lit(False).alias("expected"), F.lit(True).alias("present")
        ),
    ]
    # A union, not a join: the key of a join would be tested for NULL on every row.
    return (
        reduce(DataFrame.unionByName, kinds)
        .groupBy("file_name")
        .agg(F.sum("part_rows").alias("row_count"), F.bool_or("present").alias("present"), F.bool_or("expected").alias("expected"))
        .filter("expected")
        .drop("expected")
    )
