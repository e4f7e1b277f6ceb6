"""Silver cleansing: row rules, typing, rejected rows.

A rule is a Column that must be TRUE for a row to stay; FALSE and NULL both drop
it. The same rule set drives the clean and the rejected side, so they partition
the input.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wardlake.contracts import GENDERS
from wardlake.functions.scalars import as_date, as_long, as_wall_clock, landing_file

EXPIRED, VALID = "EXPIRED", "VALID"


def add_provenance(df: DataFrame) -> DataFrame:
    """``file_name_last``, ``Month`` and ``Year`` out of ``file_path``."""
    path = F.col("file_path")
    return df.withColumns({
        "file_name_last": landing_file(path, 1),
        "Month": landing_file(path, 2),
        "Year": landing_file(path, 3),
    })


# Hospital


def hospital_rules(as_of: date) -> dict[str, Column]:
    admitted, discharged = as_wall_clock("admission_time"), as_wall_clock("discharge_time")
    return {
        "gender": F.col("patient_gender").isin(*GENDERS),
        "dob": as_date("patient_dob") <= F.lit(as_of),
        # The raw column is tested for NULL: an unreadable discharge is not an open stay.
        "stay": F.col("discharge_time").isNull() | (admitted <= discharged),
        "billing": as_long("billed_amount") >= as_long("approved_amount"),
        "admission_format": F.col("admission_time").isNull() | admitted.isNotNull(),
    }


def clean_hospital(df: DataFrame, as_of: date) -> DataFrame:
    return _keep(df, hospital_rules(as_of)).withColumns({
        "patient_dob": as_date("patient_dob"),
        "admission_time": as_wall_clock("admission_time"),
        "discharge_time": as_wall_clock("discharge_time"),
        "billed_amount": as_long("billed_amount"),
        "approved_amount": as_long("approved_amount"),
    })


# Pharma


def expiry_status(as_of: date) -> Column:
    """A missing expiry date counts as VALID."""
    return F.when(as_date("expiry_date") < F.lit(as_of), EXPIRED).otherwise(VALID)


def enrich_pharma(df: DataFrame, as_of: date) -> DataFrame:
    """Typed stock, ``available_stock`` and ``expiry_status``, before any row is dropped."""
    return df.withColumns({
        "total_stock": as_long("total_stock"),
        "issued_stock": as_long("issued_stock"),
        "expiry_date": as_date("expiry_date"),
        "available_stock": as_long("total_stock") - as_long("issued_stock"),
        "expiry_status": expiry_status(as_of),
    })


def pharma_rules(as_of: date) -> dict[str, Column]:
    total, issued = as_long("total_stock"), as_long("issued_stock")
    return {
        "medicine_id": F.col("medicine_id").isNotNull(),
        "hospital_id": F.col("hospital_id").isNotNull(),
        "total_stock": total >= 0,
        "issued_stock": issued >= 0,
        "issued_within_total": issued <= total,
        "expiry": expiry_status(as_of) == VALID,
        "expiry_format": F.col("expiry_date").isNull() | as_date("expiry_date").isNotNull(),
    }


def clean_pharma(df: DataFrame, as_of: date) -> DataFrame:
    return enrich_pharma(_keep(df, pharma_rules(as_of)), as_of)


# Device


def type_device(df: DataFrame) -> DataFrame:
    """No device row is dropped; the gate has shown that both columns are integers."""
    return df.withColumns({
        "total_units": F.col("total_units").cast("int"),
        "in_use_units": F.col("in_use_units").cast("int"),
    })


# Rule sets


def rejected_rows(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """The rows the rules drop, with the names of all rules they break."""
    broken = [F.when(~_holds(rule), F.lit(name)) for name, rule in rules.items()]
    # The names are put together for the rejected rows only, not to find them.
    kept = reduce(lambda a, b: a & b, map(_holds, rules.values()))
    return df.filter(~kept).withColumn("failed_rules", F.split(F.concat_ws("\n", *broken), "\n"))


def all_hold(rules: dict[str, Column]) -> Column:
    return reduce(lambda a, b: a & b, rules.values())


def _keep(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    return df.filter(all_hold(rules))


def _holds(rule: Column) -> Column:
    return F.coalesce(rule, F.lit(False))
