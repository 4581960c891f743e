"""Periods and the moments at which values become known, all in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

QUARTER = r"^(\d{4})K([1-4])$"
FIRST_YEAR, LAST_YEAR = 1990, 2100


def quarter_start(raw: Column, check_year: bool = True) -> Column:
    """``2024K2`` to 2024-04-01; blanks and case do not matter; NULL if it is no quarter."""
    s = F.upper(F.trim(raw))
    year = F.regexp_extract(s, QUARTER, 1).try_cast("int")
    month = (F.regexp_extract(s, QUARTER, 2).try_cast("int") - 1) * 3 + 1
    valid = s.rlike(QUARTER)
    if check_year:
        valid = valid & year.between(FIRST_YEAR, LAST_YEAR)
    zero = F.lit(0)
    return F.when(valid, F.make_timestamp(year, month, F.lit(1), zero, zero, zero))


def quarter_column(raw: Column, errors: str = "coerce") -> Column:
    """``coerce`` gives NULL for what cannot be read, ``raise`` fails, ``ignore`` keeps the text."""
    if errors == "ignore":
        return raw
    parsed = quarter_start(raw)
    if errors == "raise":
        message = F.concat(F.lit("not a quarter: "), F.coalesce(raw, F.lit("NULL")))
        return F.when(parsed.isNull(), F.raise_error(message)).otherwise(parsed)
    if errors != "coerce":
        raise ValueError(f"errors must be raise, coerce or ignore, not {errors!r}")
    return parsed


def utc(c: Column) -> Column:
    """Zone-less times are UTC; strings may carry a zone."""
    return c.try_cast("timestamp")


def day_start(raw: Column) -> Column:
    return F.try_to_timestamp(F.trim(raw), F.lit("yyyy-MM-dd"))


def iso_monday(year: Column, week: Column) -> Column:
    """Monday 00:00 of an ISO week: January 4th always lies in week 1."""
    fourth = F.make_date(year, F.lit(1), F.lit(4))
    return F.date_add(F.date_sub(fourth, F.weekday(fourth)), (week - 1) * 7).cast("timestamp")


def has_53_weeks(year: Column) -> Column:
    thursday = 3
    first, last = F.make_date(year, F.lit(1), F.lit(1)), F.make_date(year, F.lit(12), F.lit(31))
    return (F.weekday(first) == thursday) | (F.weekday(last) == thursday)


def published(monday: Column) -> Column:
    """Weekly reservoir levels are published one week after the week began."""
    return monday + F.expr("INTERVAL 7 DAYS")


def gate_closure(delivery: Column) -> Column:
    """Positions for a delivery day are final at noon of the day before."""
    return F.date_trunc("day", delivery) - F.expr("INTERVAL 12 HOURS")
