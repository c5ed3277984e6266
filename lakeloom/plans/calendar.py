"""Date dimension and working calendars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.dates import fiscal_quarter, fiscal_year, previous_friday


def span_of(df: DataFrame, col: str) -> DataFrame:
    """Every day from the first to the last date of a column."""
    ends = df.agg(F.min(col).cast("date").alias("a"), F.max(col).cast("date").alias("b"))
    return ends.select(F.explode(F.sequence("a", "b")).alias("date"))


#: Periods a day lies in: first day, months or days until the next one, number, and date patterns of its names.
PERIODS = {
    "year": ("year", 12, F.year, {"label": "yyyy"}),
    "quarter": ("quarter", 3, F.quarter, {"label": "QQQ", "name": "QQQQ"}),
    "month": ("month", 1, F.month, {"label": "yyyy-MM", "name": "MMMM", "abbreviation": "MMM"}),
    "week": ("week", None, F.weekofyear, {}),
    "weekday": (None, None, lambda d: F.weekday(d) + 1, {"name": "EEEE", "abbreviation": "EEE"}),
}


def attributes(days: DataFrame, periods: Sequence[str] = tuple(PERIODS)) -> DataFrame:
    """Number, bounds and names of the periods asked for, as ``<period>_<what>``, and the fiscal year and quarter."""
    d, out = F.col("date"), {}
    for period in periods:
        unit, months, number, patterns = PERIODS[period]
        out[f"{period}_number"] = number(d)
        if unit:
            first = F.trunc(d, unit)
            after = F.add_months(first, months) if months else F.date_add(first, 7)
            out |= {f"{period}_first": first, f"{period}_last": F.date_sub(after, 1)}
        out |= {f"{period}_{what}": F.date_format(d, pattern) for what, pattern in patterns.items()}
    out |= {"fiscal_year": fiscal_year(d), "fiscal_quarter": fiscal_quarter(d)}
    return days.select("date", *[column.alias(name) for name, column in out.items()])


def reporting_weeks(days: DataFrame, base_year: int) -> DataFrame:
    """The reporting week of each day, and its number from the base year on.

    A reporting week takes the number of the calendar week of the Friday before it; the days of a new year
    before its first such week are week 0. Every year counts 52 weeks.
    """
    d = F.col("date")
    number = F.weekofyear(previous_friday(d))
    early = (F.dayofyear(d) < 7) & (number == 52)
    week = F.when(early, F.lit(0)).otherwise(number)
    return days.select("date", week.alias("reporting_week"), ((F.year(d) - base_year) * 52 + week).alias("running_week"))


def with_holidays(calendar: DataFrame, holidays: DataFrame, holiday: str = "date") -> DataFrame:
    """Holiday and working-day flags from a table of holidays."""
    marks = holidays.select(F.col(holiday).alias("date")).distinct().withColumn("_h", F.lit(1))
    flagged = calendar.join(marks, "date", "left").withColumn("holiday", F.coalesce("_h", F.lit(0))).drop("_h")
    rest = (F.col("holiday") == 1) | (F.weekday("date") >= 5)
    return flagged.withColumn("working_day", F.when(rest, 0).otherwise(1))


def work_weeks(days: DataFrame) -> DataFrame:
    """One row per week with the day numbers of Monday to Friday; its month is that of the Monday."""
    d = F.col("date")
    monday = F.trunc(d, "week")
    spread = {name: F.max(F.when(F.weekday(d) == i, F.day(d))) for i, name in enumerate(("mon", "tue", "wed", "thu", "fri"))}
    weeks = days.where(F.weekday(d) < 5).groupBy(monday.alias("week_start")).agg(*[c.alias(n) for n, c in spread.items()])
    return weeks.select(F.date_format("week_start", "MMM-yy").alias("month_year"), "week_start", *spread)
