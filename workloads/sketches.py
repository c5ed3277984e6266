"""Profiles of any span of days from daily sketches, beside the exact numbers of the same spans."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.operators import sketches
from lakeloom.session import cut
from workloads.registry import Tables, query

c = F.col
COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
#: Estimates may be off by four standard errors, a median's rank by two hundredths.
DISTINCT_BOUND = 4 * sketches.relative_error()
RANK_BOUND = 0.02
#: Up to so many different values, every value's count is asked for, and must be exact.
FEW = 10


def _spans(t: Tables):
    """Each year, each quarter, and one span over all: they overlap, and none of them follows the days of another table."""
    days = t.orders.select(c("o_orderdate").cast("date").alias("d"))
    units = [("year", "Y"), ("quarter", "Q")]
    starts = days.select(F.explode(F.array(*[F.struct(F.lit(mark).alias("mark"), F.trunc("d", u).alias("first_day")) for u, mark in units])).alias("s")).select("s.*").distinct()
    ends = F.when(c("mark") == "Y", F.add_months("first_day", 12)).otherwise(F.add_months("first_day", 3))
    listed = starts.select(F.concat("mark", c("first_day").cast("string")).alias("span"), "first_day", F.date_sub(ends, 1).alias("last_day"))
    return listed.unionByName(days.agg(F.min("d").alias("first_day"), F.max("d").alias("last_day")).select(F.lit("all").alias("span"), "first_day", "last_day"))


def _exact(orders, spans, estimates):
    """Distinct values and, per number column, the share of values up to the estimated median, counted from the rows."""
    days = spans.select("span", F.explode(F.sequence("first_day", "last_day")).alias("day"))
    rows = orders.withColumn("day", c("o_orderdate").cast("date")).join(days, "day")
    cells = rows.select("span", F.explode(F.array(*[
        F.struct(F.lit(x).alias("column"), c(x).cast("string").alias("value"), (c(x).cast("double") if x in ("o_orderkey", "o_custkey", "o_totalprice") else F.lit(None).cast("double")).alias("number"))
        for x in COLUMNS])).alias("x")).select("span", "x.*").where("value is not null")
    counted = cells.groupBy("span", "column", "value", "number").agg(F.count(F.lit(1)).alias("n"))
    met = counted.join(estimates.select("span", "column", "q50"), ["span", "column"])
    upto = lambda keep: F.sum(F.when(keep, c("n")).otherwise(0))
    return met.groupBy("span", "column").agg(
        F.count(F.lit(1)).alias("n_distinct"), (upto(c("number") <= c("q50")) / F.sum("n")).alias("rank_to"),
        (upto(c("number") < c("q50")) / F.sum("n")).alias("rank_before"))


_SPAN_SQL = """WITH o AS (SELECT * REPLACE (nullif(o_orderpriority, '5-LOW') AS o_orderpriority, CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders),
s AS (SELECT DISTINCT 'Y' || CAST(date_trunc('year', o_orderdate) AS DATE) AS span, date_trunc('year', o_orderdate) AS a, date_trunc('year', o_orderdate) + INTERVAL 1 YEAR AS b FROM o
  UNION ALL SELECT DISTINCT 'Q' || CAST(date_trunc('quarter', o_orderdate) AS DATE), date_trunc('quarter', o_orderdate), date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH FROM o
  UNION ALL SELECT 'all', min(o_orderdate), max(o_orderdate) + INTERVAL 1 DAY FROM o),
r AS (SELECT span, o.* FROM o JOIN s ON o_orderdate >= a AND o_orderdate < b)
"""


def _span_sql() -> str:
    parts = []
    for name in COLUMNS:
        number = name in ("o_orderkey", "o_custkey", "o_totalprice")
        show = (lambda v: f"CAST(CAST(trunc({v}) AS BIGINT) AS VARCHAR)") if number else (lambda v: v)
        few = f"""(SELECT string_agg(v || ':' || n, '|' ORDER BY v) FROM (SELECT {name} AS v, count(*) AS n FROM r x WHERE x.span = r.span AND {name} IS NOT NULL GROUP BY v))"""
        parts.append(f"""SELECT span, '{name}' AS "column", CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) - count({name}) AS BIGINT) AS n_null,
          {show(f'min({name})')} AS min_value, {show(f'max({name})')} AS max_value, count(DISTINCT {name}) AS n_distinct, TRUE AS distinct_within,
          {'TRUE' if number else 'CAST(NULL AS BOOLEAN)'} AS median_within, {'CAST(NULL AS VARCHAR)' if number else few} AS counts FROM r GROUP BY span""")
    return _SPAN_SQL + " UNION ALL ".join(parts)


@query(_span_sql())
def profile_spans(t: Tables):
    """Daily sketches are kept as a table; 30 odd overlapping spans are profiled from it alone, and held against exact numbers."""
    orders = t.orders.withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    kept = cut(sketches.sketch(orders, "o_orderdate", COLUMNS))
    spans = cut(_spans(t))
    found = cut(sketches.read(sketches.over_spans(kept, spans), [0.5], FEW))
    exact = _exact(orders, spans, found)
    off = F.abs(c("n_distinct_estimate") - c("n_distinct"))
    listed = F.array_join(F.transform(F.array_sort(F.transform("top_values", lambda x: F.struct(x["item"].alias("v"), x["count"].alias("n")))),
                                      lambda x: F.concat(x["v"], F.lit(":"), x["n"])), "|")
    return found.join(exact, ["span", "column"]).select(
        "span", "column", "n_rows", "n_null", "min_value", "max_value", "n_distinct",
        (off <= F.greatest(F.lit(1.0), c("n_distinct") * DISTINCT_BOUND)).alias("distinct_within"),
        F.when(c("q50").isNotNull(), (c("rank_before") <= 0.5 + RANK_BOUND) & (c("rank_to") >= 0.5 - RANK_BOUND)).alias("median_within"),
        F.when(c("q50").isNull(), listed).alias("counts"))
