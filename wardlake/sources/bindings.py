"""The three source shapes, projected from the TPC-H-like tables.

The joins carry only the columns a query uses (Catalyst prunes the rest), and take
their strategy from measured sizes. ``pharma_events`` is grouped before it is
joined, so a hot part costs one row per supplier.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardlake.contracts import APPROVED, PENDING, REJECTED, SourceContract

def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _prefixed(prefix: str, key: str | Column) -> Column:
    return F.concat(F.lit(prefix), (F.col(key) if isinstance(key, str) else key).cast("string"))


def hospital_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer, nation = (_table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    key, patient = F.col("o_orderkey"), F.col("o_custkey")
    ordered = F.col("o_orderdate").cast("timestamp_ntz")
    hour, day = F.lit(timedelta(hours=1)), F.lit(timedelta(days=1))
    admitted = ordered + hour * (key % 24)
    billed = F.floor("o_totalprice").cast("bigint")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            _prefixed("E", key).alias("event_id"),
            _prefixed("P", patient).alias("patient_id"),
            F.when(key % 97 == 0, "X")
            .when(patient % 3 == 0, "M")
            .when(patient % 3 == 1, "F")
            .otherwise("O")
            .alias("patient_gender"),
            F.when(key % 101 == 0, F.to_date(F.lit("2030-01-01")))
            .otherwise(F.date_add(F.to_date(F.lit("1950-01-01")), (patient % 15000).cast("int")))
            .alias("patient_dob"),
            _prefixed("INS", "c_nationkey").alias("insurance_id"),
            F.col("n_name").alias("insurance_name"),
            F.col("c_mktsegment").alias("department"),
            _prefixed("D", key % 50).alias("doctor_id"),
            _prefixed("B", key % 100).alias("bed_id"),
            F.col("o_orderpriority").alias("bed_type"),
            _prefixed("H", F.col("n_regionkey") + 1).alias("hospital_id"),
            admitted.alias("admission_time"),
            F.when(key % 5 == 0, None)
            .when(key % 103 == 0, admitted - day)
            .otherwise(admitted + day * (key % 15) + hour * (key % 7))
            .alias("discharge_time"),
            billed.alias("billed_amount"),
            F.when(key % 107 == 0, billed + 1).otherwise(billed - key % 1000).alias(
                "approved_amount"
            ),
            F.when(F.col("o_orderstatus") == "F", APPROVED)
            .when(F.col("o_orderstatus") == "O", REJECTED)
            .when(F.col("o_orderstatus") == "P", PENDING)
            .alias("claim_status"),
        )
    )


def device_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, part = (_table(spark, sf_dir, t) for t in ("lineitem", "part"))
    in_use = F.col("l_quantity").cast("int")
    return lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        _prefixed("H", "l_suppkey").alias("hospital_id"),
        _prefixed("DEV", "l_partkey").alias("device_id"),
        F.col("p_type").alias("device_type"),
        (in_use + F.col("l_suppkey") % 40).cast("int").alias("total_units"),
        in_use.alias("in_use_units"),
        F.date_format("l_shipdate", "yyyy-'M'MM").alias("week"),
    )


def pharma_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, part = (_table(spark, sf_dir, t) for t in ("lineitem", "part"))
    quantity = F.col("quantity")  # BIGINT, as stock is: the sum of a hot pair is kept whole
    return (
        lineitem.groupBy("l_partkey", "l_suppkey")
        .agg(
            F.sum(F.col("l_quantity").cast("int")).alias("quantity"),
            F.max("l_shipdate").cast("date").alias("last_ship"),
        )
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            _prefixed("MED", "l_partkey").alias("medicine_id"),
            F.col("p_name").alias("medicine_name"),
            F.col("p_type").alias("category"),
            _prefixed("H", "l_suppkey").alias("hospital_id"),
            (quantity * 20).alias("total_stock"),
            (quantity * 2 * (F.col("l_partkey") % 12)).alias("issued_stock"),
            F.col("last_ship").alias("expiry_date"),
        )
    )


BINDINGS = {"Hospital": hospital_events, "Device": device_events, "Pharma": pharma_events}


def as_text(df: DataFrame, source: SourceContract) -> DataFrame:
    """The landing form of typed rows: every column a string."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in source.columns])


def with_defects(df: DataFrame, source: SourceContract) -> DataFrame:
    """Landing text with gate violations: every 89th, 83rd, 79th, 73rd or 71st id has a bad value or none."""
    text = as_text(df, source)
    id_column = {"Hospital": "event_id", "Device": "device_id", "Pharma": "medicine_id"}[source.name]
    number = F.regexp_extract(id_column, r"(\d+)$", 1).cast("bigint")
    bad = {c: F.when(number % 89 == 0, F.lit("bad")).otherwise(F.col(c)) for c in source.integers[:1]}
    fraction = {
        c: F.when(number % 83 == 0, F.lit("12.5")).otherwise(F.col(c)) for c in source.integers[1:]
    }
    # Where a date column must not be NULL, some values are missing and some unreadable.
    unreadable = {
        c: F.when(number % 71 == 0, F.lit("31/12/1980")).otherwise(F.col(c))
        for c in (*source.dates, *source.times)
    }
    missing = {
        c: F.when(number % 79 != 0, unreadable.get(c, F.col(c)))
        for c in source.not_null if c not in source.integers
    }
    wordy = (
        {"patient_gender": F.when(number % 73 == 0, F.lit("Male")).otherwise(F.col("patient_gender"))}
        if "patient_gender" in source.columns
        else {}
    )
    return text.withColumns({**bad, **fraction, **unreadable, **missing, **wordy})
