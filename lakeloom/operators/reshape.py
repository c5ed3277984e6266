"""Wide to long, nested to flat, packed text to rows and columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.aggregate import first_by


def wide_to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], variable: str = "variable",
                 value: str = "value", drop_null: bool = False, drop_zero: bool = False) -> DataFrame:
    """One row per value column; frames that lack one of them are left unchanged."""
    if not set(values) <= set(df.columns):
        return df
    long = df.unpivot(list(ids), list(values), variable, value)
    if drop_null:
        long = long.where(F.col(value).isNotNull())
    if drop_zero:
        long = long.where(~F.coalesce(F.col(value).try_cast("double") == 0, F.lit(False)))
    return long


def child_table(df: DataFrame, nested: str, parents: Sequence[str], fields: Sequence[str], key: str,
                keep_empty: bool = False) -> DataFrame:
    """Rows of an array of structs under the joined key of their parent."""
    explode = F.explode_outer if keep_empty else F.explode
    items = df.select(F.concat_ws("|", *parents).alias(key), explode(nested).alias("_item"))
    return items.select(*[F.col(f"_item.{f}").alias(f) for f in fields], key)


def explode_matches(df: DataFrame, col: str, pattern: str, out: str) -> DataFrame:
    """One row per match of a pattern; rows without match stay with null."""
    return df.select("*", F.explode_outer(F.regexp_extract_all(F.col(col), F.lit(pattern), F.lit(1))).alias(out))


def split_into(c: Column, names: Sequence[str], sep: str) -> list[Column]:
    """Split into as many columns as there are names; the last one takes the rest."""
    parts = F.split(c, sep, len(names))
    return [F.try_element_at(parts, F.lit(i + 1)).alias(n) for i, n in enumerate(names)]


def rows_per_system(df: DataFrame, key: str, first: str, second: str, labels: tuple[str, str],
                    order: Sequence[str], code: str = "code", system: str = "system") -> DataFrame:
    """One row per code system: rows with one code are tagged, rows with both give two.

    A row without either code appears under both systems. Where both codes exist, the first
    system keeps one row per key.
    """
    def tag(name: str, label: str):
        return F.struct(F.col(name).alias(code), F.lit(label).alias(system))

    a, b = F.col(first), F.col(second)
    single = F.array_compact(F.array(
        F.when(b.isNull(), tag(first, labels[0])),
        F.when(a.isNull() | b.isNotNull(), tag(second, labels[1])),
    ))
    tagged = df.select("*", F.explode(single).alias("_t")).select(*df.columns, "_t.*")
    both = first_by(df.where(a.isNotNull() & b.isNotNull()), [key], order)
    return tagged.unionByName(both.select("*", a.alias(code), F.lit(labels[0]).alias(system)))
