"""Connected components by alternating large and small stars, every round written to a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.session import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large: each node hands its larger neighbours to its smallest one. Small: its smaller ones, and itself."""
    if large:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        out = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        low = edges.groupBy("a").agg(F.min("b").alias("m"))
        out = edges.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = out.unionAll(low.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (a, b): label is the smallest node of its component.

    A round moves every link closer to the smallest node; nothing is gathered on the driver but two
    counts a round. Ends when the edges form stars that no round changes.
    """
    now = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        # the edges are stars when no centre hangs on another node and no node on two centres
        n, mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (n, mark) == state or not n:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(
                now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
        state = (n, mark)
        now = cut(_star(_star(now, True), False))
