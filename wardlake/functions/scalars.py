"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Text -> type. The try_ forms give NULL for malformed text instead of an error,
# and cost nothing where the column already has the type.


def as_date(name: str) -> Column:
    return F.col(name).try_cast("date")


def as_wall_clock(name: str) -> Column:
    return F.col(name).try_cast("timestamp_ntz")


def as_int(name: str) -> Column:
    return F.col(name).try_cast("int")


def as_long(name: str) -> Column:
    return F.col(name).try_cast("bigint")


# Calendar


def week_start(ts: Column) -> Column:
    """Monday of the week as a DATE; pure date arithmetic, so no session zone is involved."""
    return F.trunc(ts.cast("date"), "week")


def week_number(day: Column) -> Column:
    """Week of the year where week 1 holds January 1 and a new week starts each Sunday."""
    days_before = F.dayofyear(day) + F.dayofweek(F.trunc(day, "year")) - 2
    return (F.floor(days_before / 7) + 1).cast("int")


def month_name(day: Column) -> Column:
    return F.date_format(day, "MMMM")


def previous_month(input_date: Column) -> Column:
    """``yyyyMMdd`` text -> the day one month earlier, clamped to the month's end."""
    return F.add_months(F.to_date(input_date, "yyyyMMdd"), -1)


# Ratios


def percentage(part: Column, whole: Column, decimals: int) -> Column:
    """``part / whole * 100`` rounded half up, in exact integer arithmetic.

    The same inputs give the same bits whatever the order of the sums behind
    them. NULL when ``whole`` is 0. DECIMAL keeps large sums from overflowing.
    """
    shift = 10**decimals
    exact_part, exact_whole = part.cast("decimal(20,0)"), whole.cast("decimal(20,0)")
    numerator = F.abs(exact_part) * F.lit(200 * shift) + F.abs(exact_whole)
    rounded = F.call_function("div", numerator, F.abs(exact_whole) * 2)
    sign = F.signum(part) * F.signum(whole)
    return F.when(whole != 0, sign * rounded.cast("double") / F.lit(float(shift)))


# Keys and paths


def normalize_hospital_id(hospital_id: Column) -> Column:
    """``H01`` and ``H1`` name the same hospital."""
    return F.regexp_replace(hospital_id, "^H0+([0-9])", "H$1")


# <anything>/<Source>_events_<Month>_<Year>.csv, whatever the folder depth.
LANDING_FILE = r"(?:^|/)([^/_]+_events_([^/_]+)_(\d{4})\.csv)"


def landing_file(path: Column, group: int) -> Column:
    found = F.regexp_extract(path, LANDING_FILE, group)
    return F.when(found != "", found)
