"""Profiles kept as mergeable sketches per day and column, so that any span of days is profiled without its rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.quality import _as_text

#: Distinct counts: 2^LG_K registers, a relative standard error of 1.04 / sqrt(2^LG_K) once days are merged (1.6 %).
LG_K = 12
#: Quantiles: rank error below 0.5 % of the values in 99 of 100 cases.
QUANTILE_K = 800
#: Frequent values: counts are exact up to three quarters as many different values, else off by at most 3.5 / TRACKED of all.
TRACKED = 1024
#: Longer values stand under their hash among the frequent ones, so that a sketch has a bounded size.
LONGEST = 200

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
NESTED = (T.ArrayType, T.StructType, T.MapType, T.BinaryType, T.VariantType)


def relative_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a distinct count from merged sketches."""
    return 1.04 / (1 << lg_k) ** 0.5


def _extreme(f, name: str, kind: T.DataType) -> Column:
    """Smallest or largest value in the one of three fields that keeps its order: exact number, float or text."""
    c, number = F.col(f"`{name}`"), isinstance(kind, T.NumericType)
    inexact = isinstance(kind, (T.FloatType, T.DoubleType))
    held = f(c)
    return F.when(held.isNotNull(), F.struct(
        (held if number and not inexact else F.lit(None)).cast("decimal(38,6)").alias("exact"),
        (held if inexact else F.lit(None)).cast("double").alias("inexact"),
        (F.lit(None) if number else F.date_format(held, "yyyy-MM-dd HH:mm:ss") if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else held
         ).cast("string").alias("text")))


def sketch(df: DataFrame, day: str, columns: Sequence[str] | None = None, lg_k: int = LG_K,
           quantile_k: int = QUANTILE_K, tracked: int = TRACKED) -> DataFrame:
    """One row per day and column: rows, nulls, extremes, and sketches of distinct values, quantiles and frequent values.

    One pass over the rows; a task sends one row per day on. ``day`` is a date column or is cast to one; rows
    without a day keep a row of their own with a null day. Nested and binary columns are left out. An empty table gives no rows.
    The result is a table to keep: sketches of new days are appended, a day that comes again replaces its rows.
    """
    wanted = [f for f in df.schema.fields if f.name in (columns or df.columns) and f.name != day and not isinstance(f.dataType, NESTED)]
    parts = []
    for f in wanted:
        c, quoted = F.col(f"`{f.name}`"), f"`{f.name}`"
        text = _as_text(quoted, f.dataType)
        number = isinstance(f.dataType, T.NumericType)
        short = F.when(F.length(text) > LONGEST, F.sha2(text, 256)).otherwise(text)
        parts.append(F.struct(
            F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
            F.count(F.lit(1)).alias("n_rows"), F.count_if(c.isNull()).alias("n_null"),
            _extreme(F.min, f.name, f.dataType).alias("low"), _extreme(F.max, f.name, f.dataType).alias("high"),
            F.hll_sketch_agg(c.cast("long") if isinstance(f.dataType, WHOLE) else text, lg_k).alias("distinct"),
            F.kll_sketch_agg_double(c.cast("double") if number else F.lit(None).cast("double"), F.lit(quantile_k)).alias("quantiles"),
            _tracked(short, tracked).alias("frequent")))
    if not parts:
        raise ValueError("no column to profile")
    daily = df.withColumn("_day", F.col(f"`{day}`").cast("date")).groupBy("_day").agg(F.array(*parts).alias("_c"))
    return daily.select(F.col("_day").alias("day"), F.inline("_c"))


def _tracked(value: Column, tracked: int) -> Column:
    return F.call_function("approx_top_k_accumulate", value, F.lit(tracked))


def merge(sketches: DataFrame, *by: str, lg_k: int = LG_K, tracked: int = TRACKED) -> DataFrame:
    """Sketches of the same column put together, per ``by``; merging merged ones gives the same estimates' guarantees."""
    return sketches.groupBy(*by, "column", "type").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("n_null"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.call_function("approx_top_k_combine", F.col("frequent"), F.lit(tracked)).alias("frequent"))


def over_spans(sketches: DataFrame, spans: DataFrame, first: str = "first_day", last: str = "last_day", tracked: int = TRACKED) -> DataFrame:
    """Merged sketches of each span, both ends included; spans may overlap, and one without rows gives none.

    A span is spelt out into its days, which meet the days of the sketches by an equi-join.
    """
    names = [c for c in spans.columns if c not in (first, last)]
    days = spans.where(F.col(first) <= F.col(last)).select(*names, F.explode(F.sequence(first, last)).alias("day"))
    return merge(sketches.join(days, "day"), *names, tracked=tracked)


def _shown(extreme: str, kind: str = "type") -> Column:
    """An extreme as the plain profile shows it: the whole part of numbers, text of anything else."""
    number = F.coalesce(F.col(f"{extreme}.exact").cast("long"), F.col(f"{extreme}.inexact").cast("long"))
    return F.coalesce(number.cast("string"), F.col(f"{extreme}.text"))


def read(merged: DataFrame, probabilities: Sequence[float] = (0.25, 0.5, 0.75), top: int = 10) -> DataFrame:
    """What merged sketches say: counts, extremes, estimated distinct values, quantiles, and the ``top`` values with counts.

    Quantiles are null for columns that are not numbers or hold none; counts of frequent values are estimates from above.
    """
    numbers = F.col("low.exact").isNotNull() | F.col("low.inexact").isNotNull()
    at = lambda p: F.when(numbers, F.kll_sketch_get_quantile_double("quantiles", F.lit(p)))
    listed = F.call_function("approx_top_k_estimate", F.col("frequent"), F.lit(top))
    known = F.filter(listed, lambda x: x["item"].isNotNull())
    others = [c for c in merged.columns if c not in ("low", "high", "distinct", "quantiles", "frequent")]
    return merged.select(
        *others, _shown("low").alias("min_value"), _shown("high").alias("max_value"),
        F.hll_sketch_estimate("distinct").alias("n_distinct_estimate"),
        *[at(p).alias(f"q{round(p * 100)}") for p in probabilities], known.alias("top_values"))
