"""Lookups, reconciliation joins and the metric layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.operators import joins
from lakeloom.plans.metrics import Role, by_every_role, evaluate, standard_measures
from workloads.registry import Tables, query

c = F.col


# ---- metric layer ----

def _measures(item: str, member: str, amount: str):
    return standard_measures(item, member, c(amount), c("o_orderstatus") == "F", c("o_orderpriority").isin("1-URGENT", "2-HIGH"))


def _measure_sql(item: str, amount: str) -> str:
    kept, on = "o_orderstatus IS DISTINCT FROM 'F'", "coalesce(o_orderpriority IN ('1-URGENT', '2-HIGH'), FALSE)"
    d = lambda col, cond: f"count(DISTINCT {col}) FILTER (WHERE {cond})"
    items, items_off = d(item, kept), d(item, f"{kept} AND NOT {on}")
    members, members_off = "count(DISTINCT o_custkey)", d("o_custkey", f"NOT {on}")
    return f"""{items} AS items, {members} AS members, {d(item, f'{kept} AND {on}')} AS items_active, {items_off} AS items_inactive,
      coalesce({items_off} / nullif({items}, 0), 0.0) AS items_inactive_share, {d('o_custkey', on)} AS members_active,
      {members_off} AS members_inactive, coalesce({members_off} / nullif({members}, 0), 0.0) AS members_inactive_share,
      CAST(sum(CAST({amount} AS DECIMAL(18,2))) AS DOUBLE) AS total_amount"""


@query(f"""SELECT n_name, {_measure_sql('o_orderkey', 'o_totalprice')} FROM orders LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def metric_by_nation(t: Tables):
    roles = [Role(t.customer, "o_custkey", "c_custkey", ["c_nationkey"]), Role(t.nation, "c_nationkey", "n_nationkey", ["n_name"])]
    return evaluate(t.orders, _measures("o_orderkey", "o_custkey", "o_totalprice"), ["n_name"], roles=roles)


ROLE_SQL = "FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN supplier ON l_suppkey = s_suppkey"


@query(f"""SELECT 'member' AS role, n_name, {_measure_sql('l_orderkey', 'l_extendedprice')} {ROLE_SQL} LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
UNION ALL SELECT 'facility', n_name, {_measure_sql('l_orderkey', 'l_extendedprice')} {ROLE_SQL} LEFT JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name""")
def metric_by_role(t: Tables):
    """The same measures by the region of the member and by that of the facility."""
    fact = t.lineitem.select("l_orderkey", "l_suppkey", "l_extendedprice").join(
        t.orders.select(c("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus", "o_orderpriority"), "l_orderkey")
    measures = _measures("l_orderkey", "o_custkey", "l_extendedprice")
    paths = {"member": [Role(t.customer, "o_custkey", "c_custkey", ["c_nationkey"]), Role(t.nation, "c_nationkey", "n_nationkey", ["n_name"])],
             "facility": [Role(t.supplier, "l_suppkey", "s_suppkey", ["s_nationkey"]), Role(t.nation, "s_nationkey", "n_nationkey", ["n_name"])]}
    return by_every_role(fact, measures, paths, ["n_name"])


@query(f"""SELECT r_name, n_name, CAST(2 - grouping(r_name) - grouping(n_name) AS INTEGER) AS level, {_measure_sql('o_orderkey', 'o_totalprice')}
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
GROUP BY ROLLUP (r_name, n_name)""")
def metric_rollup(t: Tables):
    roles = [Role(t.customer, "o_custkey", "c_custkey", ["c_nationkey"]),
             Role(t.nation, "c_nationkey", "n_nationkey", ["n_name", "n_regionkey"]),
             Role(t.region, "n_regionkey", "r_regionkey", ["r_name"])]
    by = ["r_name", "n_name"]
    return evaluate(t.orders, _measures("o_orderkey", "o_custkey", "o_totalprice"), by, levels=[by, by[:1], []], roles=roles, bitmaps=True)


@query("""SELECT o_orderpriority, count(*) AS n_lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE year(o_orderdate) = 1998 GROUP BY o_orderpriority""")
def payment_view(t: Tables):
    orders = t.orders.where((c("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")) & (c("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")))
    lines = t.lineitem.select("l_orderkey", "l_extendedprice").join(orders.select("o_orderkey", "o_orderpriority"), c("l_orderkey") == c("o_orderkey"))
    return lines.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_lines"),
                                                F.sum(c("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("amount"))


# ---- lookups ----

@query("""SELECT o_orderkey, c_name AS customer, n_name AS nation FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_mktsegment <> 'MACHINERY'
LEFT JOIN nation ON c_nationkey = n_nationkey""")
def lookup_left(t: Tables):
    known = t.customer.where("c_mktsegment <> 'MACHINERY'")
    df = joins.lookup(t.orders.select("o_orderkey", "o_custkey"), known, {"o_custkey": "c_custkey"}, {"c_name": "customer", "c_nationkey": "n"})
    return joins.lookup(df, t.nation, {"n": "n_nationkey"}, {"n_name": "nation"}).select("o_orderkey", "customer", "nation")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, a.p_name AS p_name_submitted, b.p_name AS p_name_paid
FROM lineitem LEFT JOIN part a ON l_partkey = a.p_partkey LEFT JOIN part b ON l_suppkey = b.p_partkey""")
def lookup_twice(t: Tables):
    raw = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return joins.lookup_each(raw, t.part, "p_partkey", {"l_partkey": "_submitted", "l_suppkey": "_paid"}, ["p_name"]).drop("l_suppkey")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, n FROM lineitem LEFT JOIN (SELECT o_orderkey, o_orderkey % 7 + 1 AS ln, o_totalprice AS n FROM orders)
ON l_orderkey = o_orderkey AND l_linenumber = ln""")
def lookup_two_keys(t: Tables):
    ref = t.orders.select("o_orderkey", (c("o_orderkey") % 7 + 1).alias("ln"), c("o_totalprice").alias("n"))
    return joins.lookup(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), ref,
                        {"l_orderkey": "o_orderkey", "l_linenumber": "ln"}, ["n"])


@query("""SELECT c_custkey, c_name, 'without' AS kind FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
UNION ALL SELECT c_custkey, c_name, 'with' FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def anti_and_semi(t: Tables):
    urgent, people = t.orders.where("o_orderpriority = '1-URGENT'"), t.customer.select("c_custkey", "c_name")
    a = joins.anti(people, urgent, {"c_custkey": "o_custkey"}).withColumn("kind", F.lit("without"))
    return a.unionByName(joins.semi(people, urgent, {"c_custkey": "o_custkey"}).withColumn("kind", F.lit("with")))


@query("""WITH a AS (SELECT o_orderkey, o_totalprice AS v FROM orders WHERE o_orderstatus <> 'F'),
b AS (SELECT o_orderkey, o_totalprice + 1 AS v FROM orders WHERE o_orderpriority <> '5-LOW')
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, a.v AS v_old, b.v AS v_new,
  CASE WHEN a.o_orderkey IS NULL THEN 'right_only' WHEN b.o_orderkey IS NULL THEN 'left_only' ELSE 'both' END AS origin
FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey""")
def outer_indicator(t: Tables):
    a = t.orders.where("o_orderstatus <> 'F'").select("o_orderkey", c("o_totalprice").alias("v"))
    b = t.orders.where("o_orderpriority <> '5-LOW'").select("o_orderkey", (c("o_totalprice") + 1).alias("v"))
    return joins.outer_with_origin(a, b, ["o_orderkey"])


@query("""WITH d AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS gone FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT o_orderkey, packed, list_has_any(string_split(packed, '|'), (SELECT list(gone) FROM d)) AS hit
FROM (SELECT o_orderkey, o_custkey || '|' || (o_custkey + 1) AS packed FROM orders)""")
def packed_members(t: Tables):
    raw = t.orders.select("o_orderkey", F.concat_ws("|", c("o_custkey"), c("o_custkey") + 1).alias("packed"))
    gone = t.orders.where("o_orderpriority = '1-URGENT'").select(c("o_custkey").cast("string").alias("gone"))
    return joins.flag_members(raw, "o_orderkey", "packed", gone, "gone", "hit")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN p_type <> 'PROMO' THEN 'In list' ELSE 'Not in list' END AS list_tag,
  CASE WHEN p_type <> 'PROMO' THEN CAST(l_partkey AS VARCHAR) WHEN p_size <= 25 THEN 'S' || p_size ELSE 'Unknown' END AS resolved
FROM lineitem JOIN part ON l_partkey = p_partkey""")
def resolve_code(t: Tables):
    code = lambda k: c(k).cast("string").alias("code")
    known = t.part.where("p_type <> 'PROMO'").select(code("p_partkey"))
    stand_ins = t.part.where("p_size <= 25").select(code("p_partkey"), F.concat(F.lit("S"), "p_size").alias("dummy"))
    raw = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", code("l_partkey"))
    return joins.resolve_code(raw, "code", known, "code", stand_ins, "code", "dummy").drop("code")


@query("""SELECT l_partkey, count(*) AS n_rows, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_type NOT IN ('PROMO', 'SMALL')) GROUP BY l_partkey""")
def unmatched_codes(t: Tables):
    out = joins.unmatched(t.lineitem, "l_partkey", t.part.where("p_type not in ('PROMO', 'SMALL')"), "p_partkey", c("l_extendedprice").cast("decimal(18,2)"))
    return out.withColumn("amount", c("amount").cast("double"))


@query("""WITH v AS (SELECT o_custkey AS k, o_orderpriority AS label, d AS s, coalesce(lead(d) OVER (PARTITION BY o_custkey ORDER BY d) - 1, DATE '9999-12-31') AS e
  FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, min(o_orderpriority) AS o_orderpriority FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL)),
f AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey, o_custkey, coalesce((SELECT label FROM v WHERE k = o_custkey AND d BETWEEN s AND e),
  (SELECT arg_min(label, s) FROM v WHERE k = o_custkey AND s > d)) AS label FROM f""")
def as_of_lookup(t: Tables):
    day = c("o_orderdate").cast("date")
    v = t.orders.where("o_orderstatus = 'F'").groupBy(c("o_custkey").alias("k"), day.alias("s")).agg(F.min("o_orderpriority").alias("label"))
    from pyspark.sql import Window
    v = v.withColumn("e", F.coalesce(F.date_sub(F.lead("s").over(Window.partitionBy("k").orderBy("s")), 1), F.lit("9999-12-31").cast("date")))
    facts = t.orders.select("o_orderkey", c("o_custkey").alias("k"), day.alias("d"))
    return joins.as_of(facts, v, "k", "d", "s", "e", ["label"], ["o_orderkey"]).select("o_orderkey", c("k").alias("o_custkey"), "label")
