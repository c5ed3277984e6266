"""Set and multiset operations over frames with the same columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column one frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _sided(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of both with counts per side, from one grouping instead of a join per direction."""
    cols = left.columns
    sides = left.withColumn("_l", F.lit(1)).unionByName(
        right.select(*cols).withColumn("_l", F.lit(0))
    )
    return sides.groupBy(*cols).agg(F.sum("_l").alias("n_left"), F.sum(1 - F.col("_l")).alias("n_right"))


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of the first frame that the second lacks."""
    return left.subtract(right.select(*left.columns))


def common(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.intersect(right.select(*left.columns))


def symmetric_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows found on one side only, with that side."""
    one_sided = _sided(left, right).where("n_left = 0 or n_right = 0")
    side = F.when(F.col("n_left") > 0, F.lit("left")).otherwise(F.lit("right"))
    return one_sided.withColumn("side", side).drop("n_left", "n_right")


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with the copies on either side."""
    return _sided(left, right).where("n_left <> n_right")
