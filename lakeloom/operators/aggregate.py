"""Grouping, de-duplication and statistics. Aggregates combine on the map side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.ordered import Scan, group_values, is_hot, scan
from lakeloom.session import cut


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def collapse(df: DataFrame, key: str, sep: str = "|") -> DataFrame:
    """One row per key, other columns packed as sorted distinct values; rows without key stay."""
    others = [c for c in df.columns if c != key]

    def packed(c: str) -> Column:
        values = F.array_sort(F.collect_set(F.col(c).cast("string")))
        return F.nullif(F.array_join(values, sep), F.lit("")).alias(c)

    grouped = df.where(F.col(key).isNotNull()).groupBy(key).agg(*[packed(c) for c in others])
    loose = df.where(F.col(key).isNull()).select(key, *[F.col(c).cast("string") for c in others])
    return grouped.unionByName(loose)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], latest: bool = False) -> DataFrame:
    """One row per key, first (or last) along columns that decide every tie.

    This is an aggregate: each task keeps one row per key before the shuffle.
    """
    pick = F.max_by if latest else F.min_by
    others = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.col(c) for c in order])
    picked = df.groupBy(*keys).agg(pick(F.struct(*others), rank).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def first_by_or_null(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """As first_by, but rows without key all stay."""
    kept = first_by(df.where(F.col(key).isNotNull()), [key], order)
    return kept.unionByName(df.where(F.col(key).isNull()))


def row_sum(cols: Sequence[str]) -> Column:
    return reduce(add, [F.coalesce(F.col(c), F.lit(0)) for c in cols])


def group_remaining(df: DataFrame, by: Sequence[str], total: Column, used: Column, name: str,
                    hot: bool | None = None) -> DataFrame:
    """Group total less the row's own value."""
    return group_values(df, by, {"_total": F.sum(total)}, hot).withColumn(name, F.col("_total") - used).drop("_total")


def pivot_first(df: DataFrame, by: Sequence[str], column: str, value: Column, values: Sequence) -> DataFrame:
    """First (smallest) value per cell under a fixed list of columns."""
    return df.groupBy(*by).pivot(column, list(values)).agg(F.min(value))


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """All counts in one job."""
    return df.agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])


def time_bins(df: DataFrame, ts: str, width: str = "1 hour", by: Sequence[str] = ()) -> DataFrame:
    grouped = df.groupBy(F.window(ts, width).alias("_w"), *by).agg(F.count(F.lit(1)).alias("n_rows"))
    return grouped.select(F.col("_w.start").alias("bin_start"), *by, "n_rows")


def silent_groups(df: DataFrame, by: Sequence[str], flag: Column) -> DataFrame:
    """Groups in which a flag never fires."""
    return df.groupBy(*by).agg(F.sum(flag.cast("int")).alias("_fired")).where("_fired = 0").drop("_fired")


def distribution(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count of each value of each column, long form."""
    return long_values(df, cols).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n_rows"))


def long_values(df: DataFrame, cols: Sequence[str], dtype: str = "string") -> DataFrame:
    """One row per cell: column and value."""
    typed = df.select(*[F.col(c).cast(dtype).alias(c) for c in cols])
    return typed.unpivot([], list(cols), "column", "value")


def default_aggregates(df: DataFrame, by: Sequence[str], kinds: Mapping[str, str]) -> DataFrame:
    """Summarise each column by its default: sum, count or none."""
    make = {"sum": F.sum, "count": F.count}
    return df.groupBy(*by).agg(*[make[k](c).alias(f"{k}_{c}") for c, k in kinds.items() if k != "none"])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def quantiles(values: DataFrame, by: Sequence[str], probabilities: Mapping[str, float],
              max_group_rows: int | None = None) -> DataFrame:
    """Exact quantiles of a column ``value`` per group, with linear interpolation.

    Values are counted first, and the counts are kept so that the data is read once. Ranks are a
    running sum over the counts, which stays parallel for a group of many distinct values.
    """
    by = list(by)
    counts = cut(
        values.where("value is not null").groupBy(*by, "value").agg(F.count(F.lit(1)).alias("_n"))
    )
    hot = is_hot(counts, by, max_group_rows)
    ranked = group_values(
        scan(counts, by, ["value"], Scan(sums={"_upto": F.col("_n")}), max_group_rows, hot),
        by, {"_total": F.sum("_n")}, hot=hot,
    )
    # a value covers the zero-based positions [_upto - _n, _upto - 1]
    picks = []
    for name, p in probabilities.items():
        at = (F.col("_total") - 1) * F.lit(p)
        low, high = F.floor(at), F.ceil(at)
        holds = lambda position: (position >= F.col("_upto") - F.col("_n")) & (position < F.col("_upto"))
        picks += [
            F.max(F.when(holds(low), F.col("value"))).alias(f"_low_{name}"),
            F.max(F.when(holds(high), F.col("value"))).alias(f"_high_{name}"),
            F.max(at - low).alias(f"_part_{name}"),
        ]
    edges = ranked.groupBy(*by).agg(*picks)
    return edges.select(*by, *[
        (F.col(f"_low_{n}") + (F.col(f"_high_{n}") - F.col(f"_low_{n}")) * F.col(f"_part_{n}")).alias(n)
        for n in probabilities
    ])


def describe_values(values: DataFrame, by: Sequence[str], digits: int = 2,
                    max_group_rows: int | None = None) -> DataFrame:
    """Count, mean, standard deviation, minimum, quartiles and maximum of ``value`` per group."""
    basic = values.groupBy(*by).agg(
        F.count("value").alias("n_values"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    both = basic.join(quantiles(values, by, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, max_group_rows), list(by), "left")
    stats = ["mean", "std", "min", "q25", "q50", "q75", "max"]
    return both.select(*by, "n_values", *[F.round(c, digits).alias(c) for c in stats])


def describe(df: DataFrame, cols: Sequence[str] | None = None, digits: int = 2,
             max_group_rows: int | None = None) -> DataFrame:
    """The statistics of describe_values, one row per numeric column."""
    return describe_values(long_values(df, cols or numeric_columns(df), "double"), ["column"], digits, max_group_rows)
