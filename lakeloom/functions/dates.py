"""Date parsing, ages, fiscal periods and date lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The layouts raw files use.
DATE_FORMATS = ("yyyy-MM-dd", "yyyy_MM_dd", "M-d-yyyy", "yyyy/MM/dd")


def parse_date(c: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First layout that fits; null where none does."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)).cast("date") for f in formats])


def parse_timestamp(c: Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.try_to_timestamp(c, F.lit(fmt))


def date_from_name(name: Column) -> Column:
    """Last date in a file name: yyyyMMdd, or its parts joined by '-' or '_'."""
    pattern = r"^.*(?<!\d)(\d{4}([-_]?)\d{2}\2\d{2})(?!\d)"
    run = F.regexp_replace(F.regexp_extract(name, pattern, 1), "[-_]", "")
    return F.try_to_timestamp(F.nullif(run, F.lit("")), F.lit("yyyyMMdd")).cast("date")


def reference_date(c: Column, pivot: int = 69) -> Column:
    """Date held by the first six characters as ddMMyy; two-digit years from the pivot on are 19xx."""
    short = F.substring(c, 5, 2)
    century = F.when(short.try_cast("int") >= pivot, F.lit("19")).otherwise(F.lit("20"))
    text = F.concat(F.substring(c, 1, 4), century, short)
    return F.when(c.rlike(r"^\d{6}"), F.try_to_timestamp(text, F.lit("ddMMyyyy")).cast("date"))


def to_local(c: Column, zone: str) -> Column:
    return F.from_utc_timestamp(c, zone)


def whole_years(early: Column, late: Column) -> Column:
    """Completed years, counted as days / 365.25."""
    return F.floor(F.datediff(late, early) / F.lit(365.25))


def age_at(birth: Column, on: Column, fallback: Column) -> Column:
    """Age on a date; where that is unknown or negative, on the fallback date, never below zero."""
    first = whole_years(birth, on)
    age = F.when(first.isNull() | (first < 0), whole_years(birth, fallback)).otherwise(first)
    return F.when(age < 0, F.lit(0).cast("long")).otherwise(age)


def active_on(enrolled: Column, start: Column, end: Column, day: Column) -> Column:
    """1 where enrolled and covered on a day; an open end counts as covered."""
    return F.when(enrolled & (((start <= day) & (day <= end)) | end.isNull()), 1).otherwise(0)


def previous_friday(day: Column) -> Column:
    """The day itself on a Friday, else the Friday before it."""
    return F.date_sub(day, (F.dayofweek(day) + 1) % 7)


def minutes(seconds: Column) -> Column:
    """Minutes to one decimal, half to even."""
    return F.bround(seconds / 60, 1)


def fiscal_year(day: Column, first_month: int = 4, label: str = "FY") -> Column:
    start = F.year(day) - F.when(F.month(day) < first_month, 1).otherwise(0)
    return F.concat(F.lit(label), start.cast("string"), F.lit("-"), (start + 1).cast("string"))


def fiscal_quarter(day: Column) -> Column:
    """Quarter of a year that starts in April."""
    return (F.quarter(day) + 2) % 4 + 1


def fiscal_bounds(start_year: Column) -> tuple[Column, Column]:
    """First and last day of the fiscal year that starts in April of a year."""
    return (
        F.make_date(start_year, F.lit(4), F.lit(1)),
        F.make_date(start_year + 1, F.lit(3), F.lit(31)),
    )


def days_between(bounds: DataFrame, start: str, end: str, name: str = "date") -> DataFrame:
    """One row per day of a one-row frame's bounds."""
    return bounds.select(F.explode(F.sequence(start, end)).alias(name))


def load_days(days: DataFrame, frequency: str = "weekly", name: str = "date") -> DataFrame:
    """Days on which a load is due: Saturdays, or Tuesday to Saturday."""
    weekday = F.weekday(name)
    keep = (weekday == 5) if frequency == "weekly" else weekday.between(1, 5)
    return days.where(keep)
