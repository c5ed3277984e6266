"""Row filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def differs(c: Column, value: object, keep_null: bool = True) -> Column:
    """Inequality; nulls differ from any value unless SQL semantics are asked for."""
    return ~c.eqNullSafe(F.lit(value)) if keep_null else c != F.lit(value)


def drop_all_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.na.drop("all", subset=list(cols))


def drop_values(df: DataFrame, blacklist: Mapping[str, Sequence]) -> DataFrame:
    """Remove rows with listed values in the named columns that exist; nulls stay."""
    tests = [~F.coalesce(F.col(c).isin(*vs), F.lit(False)) for c, vs in blacklist.items() if c in df.columns]
    return df.where(reduce(and_, tests)) if tests else df


def drop_repeated_headers(df: DataFrame) -> DataFrame:
    """Remove lines that repeat the header: each cell equals its column name."""
    is_header = reduce(and_, [F.col(c).cast("string").eqNullSafe(F.lit(c)) for c in df.columns])
    return df.where(~is_header)


def in_range(c: Column, start: object, stop: object) -> Column:
    """Half-open range."""
    return (c >= start) & (c < stop)


def in_other(df: DataFrame, other: DataFrame, col: str, other_col: str) -> DataFrame:
    """Rows whose value occurs in a column of another frame."""
    keys = other.select(F.col(other_col).alias("_other")).distinct()
    return df.join(keys, F.col(col) == F.col("_other"), "left_semi")


def null_split(df: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(col).isNull()), df.where(F.col(col).isNotNull())


def exclude_pair(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Keep rows that differ in every named column: a match in any one drops the row."""
    return df.where(reduce(and_, [F.col(c) != F.lit(v) for c, v in values.items()]))


def exclude_key(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Drop only rows that match all named columns; nulls do not match."""
    return df.where(reduce(or_, [differs(F.col(c), v) for c, v in values.items()]))
