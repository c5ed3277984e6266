"""Reconciliation of two datasets: counts, names, values, rows and hashes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.text import row_hash
from lakeloom.operators.aggregate import describe_values, long_values, numeric_columns
from lakeloom.session import cut


def shared_columns(a: DataFrame, b: DataFrame) -> list[str]:
    return [c for c in a.columns if c in b.columns]


def _verdict(same: Column) -> Column:
    return F.when(F.coalesce(same, F.lit(False)), F.lit("Passed")).otherwise(F.lit("Failed"))


def row_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    n = lambda df, side: df.agg(F.count(F.lit(1)).alias("_n")).select(F.lit(side).alias("_side"), "_n")
    of = lambda side: F.max(F.when(F.col("_side") == side, F.col("_n"))).alias(f"rows_{side}")
    both = n(a, 1).unionByName(n(b, 2)).agg(of(1), of(2))
    return both.withColumn("result", _verdict(F.col("rows_1") == F.col("rows_2")))


def column_names(a: DataFrame, b: DataFrame) -> DataFrame:
    """Every column name with its type on either side."""
    side = lambda df, name: df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in df.schema.fields], f"column string, {name} string")
    both = side(a, "type_1").join(side(b, "type_2"), "column", "full_outer")
    return both.withColumn("result", _verdict(F.col("type_1") == F.col("type_2")))


def same_schema(a: DataFrame, b: DataFrame) -> bool:
    return {(f.name, f.dataType) for f in a.schema.fields} == {(f.name, f.dataType) for f in b.schema.fields}


def _null_counts(df: DataFrame, suffix: str) -> DataFrame:
    parts = [F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias(f"missing_{suffix}"),
                      F.count(F.col(c)).alias(f"present_{suffix}")) for c in df.columns]
    return df.agg(F.array(*parts).alias("_p")).select(F.explode("_p").alias("_p")).select("_p.*")


def missing_values(a: DataFrame, b: DataFrame) -> DataFrame:
    """Missing counts and shares per column; a column passes when both shares are equal."""
    both = _null_counts(a, "1").join(_null_counts(b, "2"), "column", "full_outer")
    n = lambda s: F.col(f"missing_{s}") + F.col(f"present_{s}")
    same = F.col("missing_1") * n("2") == F.col("missing_2") * n("1")
    share = lambda s: F.round(F.try_divide(F.col(f"missing_{s}") * 100, n(s)), 3)
    return both.withColumns({"share_1": share("1"), "share_2": share("2"), "result": _verdict(same)})


def distinct_values(a: DataFrame, b: DataFrame) -> DataFrame:
    """Every value of every column with its copies on either side, from one grouping; nothing is left out."""
    side = lambda df, flag: long_values(df, df.columns).where("value is not null").withColumn("_l", F.lit(flag))
    return side(a, 1).unionByName(side(b, 0)).groupBy("column", "value").agg(
        F.sum("_l").alias("copies_1"), F.sum(1 - F.col("_l")).alias("copies_2"))


def distinct_totals(values: DataFrame) -> DataFrame:
    """Distinct counts per column of ``distinct_values``; a column passes when they are equal."""
    both = values.groupBy("column").agg(F.count_if(F.col("copies_1") > 0).alias("distinct_1"),
                                        F.count_if(F.col("copies_2") > 0).alias("distinct_2"))
    return both.withColumn("result", _verdict(F.col("distinct_1") == F.col("distinct_2")))


def duplicates(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that occur more than once, with copies per side (0 where a side has at most one)."""
    cols = shared_columns(a, b)
    sides = a.select(*cols).withColumn("_l", F.lit(1)).unionByName(b.select(*cols).withColumn("_l", F.lit(0)))
    counted = sides.groupBy(*cols).agg(F.sum("_l").alias("copies_1"), F.sum(1 - F.col("_l")).alias("copies_2"))
    return counted.where("copies_1 > 1 or copies_2 > 1")


def statistics(a: DataFrame, b: DataFrame, max_group_rows: int | None = None) -> DataFrame:
    """Statistics of shared numeric columns, one row per column and statistic, both sides at once."""
    cols = [c for c in numeric_columns(a) if c in numeric_columns(b)]
    names = ["n_values", "mean", "std", "min", "q25", "q50", "q75", "max"]
    side = lambda df, n: long_values(df, cols, "double").withColumn("_side", F.lit(n))
    stats = describe_values(side(a, 1).unionByName(side(b, 2)), ["_side", "column"], max_group_rows=max_group_rows)
    long = stats.select("_side", "column", *[F.col(n).cast("double").alias(n) for n in names]).unpivot(
        ["_side", "column"], names, "statistic", "value")
    of = lambda n: F.max(F.when(F.col("_side") == n, F.col("value"))).alias(f"value_{n}")
    both = long.groupBy("column", "statistic").agg(of(1), of(2))
    return both.withColumn("result", _verdict(F.col("value_1").eqNullSafe(F.col("value_2"))))


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def distributions(a: DataFrame, b: DataFrame) -> DataFrame:
    """Count of each value of each shared text column on both sides, from one grouping."""
    cols = [c for c in text_columns(a) if c in text_columns(b)]
    side = lambda df, flag: long_values(df, cols).where("value is not null").withColumn("_l", F.lit(flag))
    counted = side(a, 1).unionByName(side(b, 0)).groupBy("column", "value").agg(
        F.sum("_l").alias("n_1"), F.sum(1 - F.col("_l")).alias("n_2"))
    return counted.withColumn("result", _verdict(F.col("n_1") == F.col("n_2")))


def cell_differences(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    """Cells that differ between rows of the same key, and rows found on one side only.

    Where a key repeats, its rows are paired by their place in the order of their values, so no row meets more
    than one other.
    """
    cols = [c for c in shared_columns(a, b) if c not in key]
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(*(cols or key)))
    side = lambda df, s: df.select(*key, nth.alias("_nth"), *[F.col(c).cast("string").alias(f"{c}{s}") for c in cols],
                                   F.lit(True).alias(f"_in{s}"))
    both = side(a, "_1").join(side(b, "_2"), [*key, "_nth"], "full_outer")
    lone = F.col("_in_1").isNull() | F.col("_in_2").isNull()
    origin = (F.when(F.col("_in_1").isNull(), F.lit("right_only"))
              .when(F.col("_in_2").isNull(), F.lit("left_only")).otherwise(F.lit("both")))
    cells = [F.when(~F.col(f"{c}_1").eqNullSafe(F.col(f"{c}_2")),
                    F.struct(F.lit(c).alias("column"), F.col(f"{c}_1").alias("value_1"),
                             F.col(f"{c}_2").alias("value_2"))) for c in cols]
    whole = F.struct(F.lit("*").alias("column"), F.lit(None).cast("string").alias("value_1"),
                     F.lit(None).cast("string").alias("value_2"))
    found = F.when(lone, F.array(whole)).otherwise(F.array_compact(F.array(*cells)))
    return both.select(*key, origin.alias("origin"), F.explode(found).alias("_c")).select(*key, "origin", "_c.*")


def hash_reconcile(a: DataFrame, b: DataFrame, by: str, cols: Sequence[str], key: Sequence[str], samples: int = 2) -> DataFrame:
    """Per load date: are the distinct row hashes equal, how many exist on one side only, and whose they are.

    All dates go through one grouping of hashes. Copies of a row do not count. ``keys_1`` and ``keys_2`` hold the
    key values, joined by '|', of up to ``samples`` rows of one side only, in order of hash and key; only
    so many rows of a date and side leave a task.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key])
    side = lambda df, flag: df.select(by, row_hash(cols).alias("_h"), text.alias("_k"), F.lit(flag).alias("_l"))
    seen = cut(side(a, 1).unionByName(side(b, 0)).groupBy(by, "_h").agg(
        F.max("_l").alias("_in_1"), F.max(1 - F.col("_l")).alias("_in_2"), F.min("_k").alias("_k")))
    left, right = F.col("_in_2") == 0, F.col("_in_1") == 0
    report = seen.groupBy(by).agg(F.count_if(left).alias("only_1"), F.count_if(right).alias("only_2"))
    first = Window.partitionBy(by, "_in_1").orderBy("_h", "_k")
    some = seen.where(left | right).withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= samples)
    listed = lambda flag: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("_in_1") == flag, F.struct("_n", "_k")))), lambda x: x["_k"]), ", ")
    keys = some.groupBy(by).agg(listed(1).alias("keys_1"), listed(0).alias("keys_2"))
    keys = keys.select(F.col(by).alias("_by"), "keys_1", "keys_2")
    report = report.join(keys, report[by].eqNullSafe(keys["_by"]), "left").drop("_by")
    return report.withColumns({"keys_1": F.coalesce("keys_1", F.lit("")), "keys_2": F.coalesce("keys_2", F.lit("")),
                               "identical": (F.col("only_1") == 0) & (F.col("only_2") == 0)})


def unmatched_rows(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """All rows of the first side whose hash the other side does not hold."""
    other = b.select(row_hash(cols).alias("_h")).distinct()
    return a.withColumn("_h", row_hash(cols)).join(other, "_h", "left_anti").drop("_h")


def grouped(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Whole rows of the shared columns, and their (column, value) cells, with copies per side; each written once.

    The two sides are read once; the cells are counted from the grouped rows.
    """
    cols = shared_columns(a, b)
    side = lambda df, flag: df.select(*cols).withColumn("_l", F.lit(flag))
    whole = cut(side(a, 1).unionByName(side(b, 0)).groupBy(*cols).agg(
        F.sum("_l").alias("copies_1"), F.sum(1 - F.col("_l")).alias("copies_2")))
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    each = whole.select(F.explode(cells).alias("_c"), "copies_1", "copies_2").groupBy("_c.column", "_c.value")
    return whole, cut(each.agg(F.sum("copies_1").alias("copies_1"), F.sum("copies_2").alias("copies_2")))


def suite(a: DataFrame, b: DataFrame) -> DataFrame:
    """All checks as one list of metric and result, from two groupings; statistics read both sides once more.

    Checks without a column to work on are left out, and two frames without a shared column give an Error.
    """
    spark = a.sparkSession
    static = [("column_count", "Passed" if len(a.columns) == len(b.columns) else "Failed"),
              ("column_names", "Passed" if set(a.columns) == set(b.columns) else "Failed")]
    cols = shared_columns(a, b)
    if not cols:
        return spark.createDataFrame([*static, ("rows", "Error")], "metric string, result string")
    whole, values = grouped(a, b)

    def overall(metric: str, report: DataFrame, same: Column) -> DataFrame:
        return report.agg(_verdict(F.count_if(~same) == 0).alias("result")).select(F.lit(metric).alias("metric"), "result")

    equal = F.col("copies_1") == F.col("copies_2")
    none = lambda s: F.sum(F.when(F.col("value").isNull(), F.col(f"copies_{s}")).otherwise(0)).alias(f"none_{s}")
    filled = values.groupBy("column").agg(none(1), none(2), F.sum("copies_1").alias("all_1"), F.sum("copies_2").alias("all_2"))
    known = values.where("value is not null")
    totals = whole.agg(F.sum("copies_1").alias("copies_1"), F.sum("copies_2").alias("copies_2")).na.fill(0)
    parts = [
        spark.createDataFrame(static, "metric string, result string"),
        overall("row_count", totals, equal),
        overall("missing_values", filled, F.col("none_1") * F.col("all_2") == F.col("none_2") * F.col("all_1")),
        overall("distinct_values", distinct_totals(known), F.col("result") == "Passed"),
        overall("duplicates", whole, F.greatest("copies_1", F.lit(1)) == F.greatest("copies_2", F.lit(1))),
        overall("rows", whole, equal),
    ]
    texts = [c for c in text_columns(a) if c in text_columns(b)]
    if texts:
        parts.append(overall("distributions", known.where(F.col("column").isin(texts)), equal))
    if [c for c in numeric_columns(a) if c in numeric_columns(b)]:
        parts.append(overall("statistics", statistics(a, b), F.col("result") == "Passed"))
    return reduce(lambda p, q: p.unionByName(q), parts)


def failures(report: DataFrame) -> DataFrame:
    return report.where("result <> 'Passed'")


def result_counts(report: DataFrame) -> DataFrame:
    return report.groupBy("result").agg(F.count(F.lit(1)).alias("n_checks"))


def compare_by_date(a: DataFrame, b: DataFrame, by: str) -> DataFrame:
    """Rows and differing rows per load date, for all dates in one pass."""
    cols = shared_columns(a, b)
    sides = a.select(*cols).withColumn("_l", F.lit(1)).unionByName(b.select(*cols).withColumn("_l", F.lit(0)))
    counted = sides.groupBy(*cols).agg(F.sum("_l").alias("_1"), F.sum(1 - F.col("_l")).alias("_2"))
    report = counted.groupBy(by).agg(
        F.sum("_1").alias("rows_1"), F.sum("_2").alias("rows_2"),
        F.sum(F.greatest(F.col("_1") - F.col("_2"), F.lit(0))).alias("only_1"),
        F.sum(F.greatest(F.col("_2") - F.col("_1"), F.lit(0))).alias("only_2"),
    )
    return report.withColumn("result", _verdict((F.col("only_1") == 0) & (F.col("only_2") == 0)))
