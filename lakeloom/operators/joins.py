"""Equi-joins with reference tables, and reconciliation joins.

No join here carries a broadcast hint: the optimizer broadcasts a side whose measured size is
below spark.sql.autoBroadcastJoinThreshold and otherwise shuffles, where skewed partitions are
split by adaptive execution.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.rules import listed_tag
from lakeloom.operators.ordered import Scan, attach, scan


def lookup(df: DataFrame, ref: DataFrame, on: Mapping[str, str], take: Mapping[str, str] | Sequence[str],
           how: str = "left") -> DataFrame:
    """Add chosen columns of a reference table; ``on`` maps left keys to reference keys."""
    taken = take if isinstance(take, Mapping) else {c: c for c in take}
    keys = {r: f"_ref{i}" for i, r in enumerate(on.values())}
    right = ref.select(*[F.col(r).alias(k) for r, k in keys.items()],
                       *[F.col(c).alias(n) for c, n in taken.items()])
    match = reduce(and_, [F.col(left) == F.col(keys[r]) for left, r in on.items()])
    return df.join(right, match, how).drop(*keys.values())


def lookup_each(df: DataFrame, ref: DataFrame, key: str, lefts: Mapping[str, str], take: Sequence[str]) -> DataFrame:
    """The same reference once per left column; its columns get that column's suffix."""
    for left, suffix in lefts.items():
        df = lookup(df, ref, {left: key}, {c: f"{c}{suffix}" for c in take})
    return df


def anti(df: DataFrame, ref: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows without partner; the reference keys are made distinct first, so a hot one is one row."""
    return _exists(df, ref, on, "left_anti")


def semi(df: DataFrame, ref: DataFrame, on: Mapping[str, str]) -> DataFrame:
    return _exists(df, ref, on, "left_semi")


def _exists(df: DataFrame, ref: DataFrame, on: Mapping[str, str], how: str) -> DataFrame:
    keys = ref.select(*[F.col(r).alias(f"_ref{i}") for i, r in enumerate(on.values())]).distinct()
    match = reduce(and_, [F.col(left) == F.col(f"_ref{i}") for i, left in enumerate(on)])
    return df.join(keys, match, how)


def outer_with_origin(left: DataFrame, right: DataFrame, on: Sequence[str], suffixes=("_old", "_new")) -> DataFrame:
    """Full outer join on unique keys with left_only, right_only or both."""
    a = left.select(*on, *[F.col(c).alias(c + suffixes[0]) for c in left.columns if c not in on],
                    F.lit(True).alias("_in_left"))
    b = right.select(*on, *[F.col(c).alias(c + suffixes[1]) for c in right.columns if c not in on],
                     F.lit(True).alias("_in_right"))
    origin = (
        F.when(F.col("_in_left").isNull(), F.lit("right_only"))
        .when(F.col("_in_right").isNull(), F.lit("left_only"))
        .otherwise(F.lit("both"))
    )
    return a.join(b, list(on), "full_outer").withColumn("origin", origin).drop("_in_left", "_in_right")


def flag_members(df: DataFrame, key: str, packed: str, members: DataFrame, member: str, flag: str,
                 sep: str = r"\|") -> DataFrame:
    """Flag rows whose packed id list holds any of the members. The key must be unique."""
    pieces = df.select(key, F.explode(F.split(packed, sep)).alias("_piece"))
    hit = semi(pieces, members, {"_piece": member}).select(key).distinct().withColumn(flag, F.lit(True))
    return attach(df, hit, [key]).withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def resolve_code(df: DataFrame, code: str, ref: DataFrame, ref_code: str, stand_ins: DataFrame, stand_in_for: str,
                 stand_in: str, out: str = "resolved", unknown: str = "Unknown") -> DataFrame:
    """A code in the reference list stands for itself, else its stand-in does, else it is unknown.

    Of several stand-ins for one code the first in their order is taken, so rows never multiply.
    """
    found = lookup(df, ref.select(ref_code).distinct(), {code: ref_code}, {ref_code: "_listed"})
    stand_ins = stand_ins.groupBy(stand_in_for).agg(F.min(stand_in).alias(stand_in))
    found = lookup(found, stand_ins, {code: stand_in_for}, {stand_in: "_stand_in"})
    value = F.when(F.col("_listed").isNotNull(), F.col(code)).otherwise(
        F.coalesce(F.col("_stand_in"), F.lit(unknown))
    )
    return found.withColumns({out: value, "list_tag": listed_tag(F.col("_listed"))}).drop("_listed", "_stand_in")


def unmatched(df: DataFrame, code: str, ref: DataFrame, ref_code: str, amount: Column) -> DataFrame:
    """Codes absent from the reference list with their row counts and amounts.

    Rows are summed per code before the anti join, so that it sees each code once.
    """
    per_code = df.groupBy(code).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(amount).alias("amount"))
    return anti(per_code, ref, {code: ref_code})


def as_of(facts: DataFrame, versions: DataFrame, key: str, at: str, start: str, end: str, take: Sequence[str],
          tie: Sequence[str], first_if_before: bool = True, max_group_rows: int | None = None) -> DataFrame:
    """Add the version valid on each fact's date: start <= date <= end.

    Facts before a key's first version take that first one if asked for. Versions and facts are
    merged along the date and the last version is carried forward, so no pairs are formed.
    """
    values = F.struct(F.col(start), F.col(end), *[F.col(c) for c in take])
    lines = facts.select(key, F.col(at).alias("_at"), F.lit(1).alias("_side"), F.struct("*").alias("_fact"),
                         F.lit(None).cast(versions.select(values.alias("v")).schema["v"].dataType).alias("_version"),
                         *[F.col(c).alias(f"_tie{i}") for i, c in enumerate(tie)])
    marks = versions.select(key, F.col(start).alias("_at"), F.lit(0).alias("_side"),
                            F.lit(None).cast(lines.schema["_fact"].dataType).alias("_fact"),
                            values.alias("_version"),
                            *[F.lit(None).cast(lines.schema[f"_tie{i}"].dataType).alias(f"_tie{i}")
                              for i in range(len(tie))])
    order = ["_at", "_side", *[f"_tie{i}" for i in range(len(tie))]]
    what = Scan(last={"_now": F.col("_version")}, next={"_later": F.col("_version")})
    merged = scan(lines.unionByName(marks), [key], order, what, max_group_rows).where("_side = 1")
    valid = F.when(F.col("_at") <= F.col(f"_now.{end}"), F.col("_now"))
    if first_if_before:
        valid = F.when(F.col("_now").isNull(), F.col("_later")).otherwise(valid)
    return merged.withColumn("_hit", valid).select("_fact.*", *[F.col(f"_hit.{c}").alias(c) for c in take])
