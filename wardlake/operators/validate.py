"""Quality gates.

A check is a predicate that is TRUE for a violating row. All checks of a source
are counted in one aggregation, either as a report of their own or while the
rows are written (see ``plans.jobs``). No check raises on malformed text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wardlake.contracts import BAD_RECORD, GENDERS, SourceContract
from wardlake.functions.scalars import as_date, as_long, as_wall_clock


class ValidationError(Exception):
    """A gate failed; the message lists every failing check."""


@dataclass(frozen=True)
class Check:
    name: str
    column: str
    violates: Column


# Single checks


def null_check(column: str) -> Check:
    return Check("not_null", column, F.col(column).isNull())


def length_check(column: str, max_length: int) -> Check:
    return Check("max_length", column, F.length(column) > max_length)


def integer_check(column: str, type_: str = "int") -> Check:
    """Text that is there but is no integer of the type. NULL is left to ``null_check``."""
    return Check("castable_int", column, F.col(column).isNotNull() & F.col(column).try_cast(type_).isNull())


def date_check(column: str) -> Check:
    """Text that is there but is no date."""
    return Check("readable_date", column, F.col(column).isNotNull() & as_date(column).isNull())


def time_check(column: str) -> Check:
    """Text that is there but is no time."""
    return Check("readable_time", column, F.col(column).isNotNull() & as_wall_clock(column).isNull())


def shape_check(column: str = BAD_RECORD) -> Check:
    """Landing records with too few or too many fields."""
    return Check("record_shape", column, F.col(column).isNotNull())


def gender_check(column: str = "patient_gender", valid: Sequence[str] = GENDERS) -> Check:
    return Check("gender", column, ~F.col(column).isin(*valid))


def dob_check(as_of: date, column: str = "patient_dob") -> Check:
    return Check("dob", column, as_date(column) > F.lit(as_of))


def stay_check(admission: str = "admission_time", discharge: str = "discharge_time") -> Check:
    return Check(
        "admission_before_discharge", admission, as_wall_clock(admission) > as_wall_clock(discharge)
    )


def at_least_check(greater: str, smaller: str) -> Check:
    return Check("at_least", greater, as_long(greater) < as_long(smaller))


# Check lists


def gate_checks(contract: SourceContract) -> list[Check]:
    """What every row of a source must satisfy to enter bronze."""
    return [
        *[null_check(c) for c in contract.not_null],
        *[length_check(c, n) for c, n in contract.max_lengths.items()],
        *[integer_check(c, contract.integer_type) for c in contract.integers],
        *[date_check(c) for c in contract.dates],
        *[time_check(c) for c in contract.times],
    ]


def hospital_checks(contract: SourceContract, as_of: date) -> list[Check]:
    """The gate plus the four row rules that silver applies as filters."""
    return [
        *gate_checks(contract),
        gender_check(),
        dob_check(as_of),
        stay_check(),
        at_least_check("billed_amount", "approved_amount"),
    ]


# Evaluation


def violation_counts(checks: Sequence[Check]) -> list[Column]:
    """One aggregate per check; 0, not NULL, for an empty input."""
    return [F.count_if(c.violates).alias(f"check_{i}") for i, c in enumerate(checks)]


def quality_report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``(check, column, violations, passed)``, from one pass over ``df``."""
    rows = [
        F.struct(
            F.lit(c.name).alias("check"),
            F.lit(c.column).alias("column"),
            F.col(f"check_{i}").alias("violations"),
            (F.col(f"check_{i}") == 0).alias("passed"),
        )
        for i, c in enumerate(checks)
    ]
    return df.agg(*violation_counts(checks)).select(F.inline(F.array(*rows)))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter(F.col("row_count") > 1)


@dataclass(frozen=True)
class KeyRule:
    """A key that should be unique among the rows of a source for which ``applies`` holds.

    With ``others`` it should be unique among the distinct tuples of the key and these columns, which
    is how a dimension of those columns is made.
    """

    name: str
    key: tuple[str, ...]
    others: tuple[Column, ...] | None = None
    applies: Column | None = None


def tagged_keys(df: DataFrame, rules: Sequence[KeyRule]) -> DataFrame:
    """Every row as one ``(name, key, others)`` for each rule that applies to it."""

    def texts(columns: Sequence[str | Column]) -> Column:
        return F.array(*[(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns])

    tags = []
    for rule in rules:
        others = F.lit(None).cast("array<string>") if rule.others is None else texts(rule.others)
        tag = F.struct(F.lit(rule.name).alias("name"), texts(rule.key).alias("key"), others.alias("others"))
        tags.append(tag if rule.applies is None else F.when(rule.applies, tag))
    return df.select(F.inline(F.filter(F.array(*tags), lambda tag: tag.isNotNull())))


def key_uniqueness(sources: Sequence[tuple[DataFrame, Sequence[KeyRule]]]) -> DataFrame:
    """``(name, key, duplicate_keys, surplus_rows)`` of all rules; every source is read once.

    Rows are folded to tuples with their counts, tuples to keys, and keys to counts of counts; a hot
    key is folded before each shuffle.
    """
    rules = [rule for _, some in sources for rule in some]
    tagged = reduce(DataFrame.unionByName, [tagged_keys(df, some) for df, some in sources])
    tuples = tagged.groupBy("name", "key", "others").agg(F.count("*").alias("n"))
    per_key = tuples.groupBy("name", "key").agg(
        F.sum(F.when(F.col("others").isNull(), F.col("n")).otherwise(F.lit(1).cast("long"))).alias("row_count")
    )
    repeated = F.col("row_count") > 1
    found = per_key.groupBy("name").agg(
        F.count_if(repeated).alias("duplicate_keys"), F.sum(F.col("row_count") - 1).alias("surplus_rows")
    )
    # A table without rows has its row, too.
    none = tagged.sparkSession.createDataFrame([(r.name, 0, 0) for r in rules], "name string, duplicate_keys long, surplus_rows long")
    keys = F.create_map(*[F.lit(text) for r in rules for text in (r.name, ",".join(r.key))])
    return (
        found.unionByName(none)
        .groupBy("name")
        .agg(F.sum("duplicate_keys").alias("duplicate_keys"), F.sum("surplus_rows").alias("surplus_rows"))
        .select("name", keys[F.col("name")].alias("key"), "duplicate_keys", "surplus_rows")
    )


# Enforcement


def check_columns(found: Sequence[str], expected: Sequence[str]) -> None:
    """The ordered column list has to match exactly."""
    if list(found) != list(expected):
        raise ValidationError(f"column mismatch: expected {list(expected)}, found {list(found)}")


def enforce(source: str, checks: Sequence[Check], counts: Mapping[str, int]) -> None:
    """Raise if any of the counts named by ``violation_counts`` is above zero or not there."""
    failed = [
        f"{c.name}({c.column}): {counts[f'check_{i}']}"
        for i, c in enumerate(checks)
        if counts[f"check_{i}"] > 0
    ]
    if failed:
        raise ValidationError(f"{source}: " + "; ".join(failed))


def require(df: DataFrame, source: str, checks: Sequence[Check]) -> DataFrame:
    """Count the violations now and raise if there are any; hands ``df`` back."""
    enforce(source, checks, df.agg(*violation_counts(checks)).first().asDict())
    return df
