"""Profiles, checks, comparisons, relations, lineage and logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.operators import compare, quality
from workloads.registry import Tables, query

c = F.col


def _profile_sql(table: str, columns: dict[str, str]) -> str:
    """One SELECT per column; text types are measured as text, numbers by their whole part."""
    parts = []
    for name, kind in columns.items():
        if kind in ("bigint", "int", "double"):
            show, lengths = (lambda v: f"CAST(CAST(trunc({v}) AS BIGINT) AS VARCHAR)"), None
        elif kind == "timestamp_ntz":
            show, lengths = (lambda v: f"strftime({v}, '%Y-%m-%d %H:%M:%S')"), "19"
        else:
            show, lengths = (lambda v: v), f"length({name})"
        low, high = show(f"min({name})"), show(f"max({name})")
        min_len = f"min({lengths})" if lengths else f"length({low})"
        max_len = f"max({lengths})" if lengths else f"length({high})"
        parts.append(f"""SELECT '{name}' AS "column", '{kind}' AS type, count(*) AS n_rows, count(DISTINCT {name}) AS n_distinct,
          count({name}) < count(*) AS has_null, count({name}) = 0 AS all_null, count(*) - count({name}) AS n_null, {low} AS min_value, {high} AS max_value,
          CAST({min_len} AS INTEGER) AS min_length, CAST({max_len} AS INTEGER) AS max_length FROM {table}""")
    return " UNION ALL ".join(parts)


ORDER_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}


@query(_profile_sql("(SELECT * REPLACE (nullif(o_orderstatus, 'P') AS o_orderstatus) FROM orders)", ORDER_TYPES))
def profile(t: Tables):
    return quality.profile(t.orders.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P"))))


@query("""SELECT r.rule, checked, failed, failed = 0 AS passed FROM (
SELECT 'name length' AS rule, count(*) AS checked, count(*) FILTER (WHERE length(c_name) <> 18) AS failed FROM customer
UNION ALL SELECT 'no edge blanks', count(*), 0 FROM customer
UNION ALL SELECT 'segment listed', count(*), count(*) FILTER (WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')) FROM customer
UNION ALL SELECT 'balance positive', count(*), count(*) FILTER (WHERE NOT c_acctbal > 0) FROM customer) r""")
def rule_checks(t: Tables):
    return quality.check(t.customer, {
        "name length": quality.has_length(c("c_name"), 18), "no edge blanks": quality.no_edge_blanks(c("c_name")),
        "segment listed": c("c_mktsegment").isin("BUILDING", "MACHINERY"), "balance positive": c("c_acctbal") > 0}).drop("sample")


@query("""SELECT doc_id, length(text) > 0 AS filled, regexp_matches(text, '^\\s|\\s$') AS ragged FROM documents""")
def document_checks(t: Tables):
    return t.documents.select("doc_id", (F.length("text") > 0).alias("filled"), (~quality.no_edge_blanks(c("text"))).alias("ragged"))


@query("SELECT l_suppkey, count(*) AS n_rows FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0 AND s_nationkey < 15) GROUP BY l_suppkey")
def orphans(t: Tables):
    return quality.orphans(t.lineitem, t.supplier.where("s_acctbal > 0 and s_nationkey < 15"), "l_suppkey", "s_suppkey")


RELATED = {
    "customer": {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_mktsegment": "string"},
    "orders": {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string"},
    "nation": {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"},
    "region": {"r_regionkey": "int", "r_name": "string"},
    "supplier": {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int"},
    "lineitem": {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint"},
    "part": {"p_partkey": "bigint", "p_name": "string"},
}


def _related_sql() -> str:
    cols = [(t, n, k) for t, fields in RELATED.items() for n, k in fields.items()]
    stem = lambda n: n.split("_", 1)[1]
    parts = []
    for t1, c1, k1 in cols:
        for t2, c2, k2 in cols:
            if t1 != t2 and k1 == k2:
                a, b = stem(c1), stem(c2)
                parts.append(f"""SELECT '{t1}' AS child, '{c1}' AS child_column, '{t2}' AS parent, '{c2}' AS parent_column,
                  round(1 - levenshtein('{a}', '{b}') / {max(len(a), len(b))}, 4) AS similarity,
                  (SELECT count(DISTINCT {c1}) FROM {t1}) AS n_values, (SELECT count(DISTINCT {c1}) FROM {t1} WHERE {c1} IN (SELECT {c2} FROM {t2})) AS n_shared""")
    return f"SELECT *, n_shared / n_values AS coverage FROM ({' UNION ALL '.join(parts)}) WHERE similarity >= 0.7 AND n_shared / n_values >= 0.7"


@query(_related_sql())
def related_columns(t: Tables):
    return quality.related_columns({name: getattr(t, name).select(*fields) for name, fields in RELATED.items()})


EDGES = """
SELECT r_name AS source, n_name AS target FROM nation JOIN region ON n_regionkey = r_regionkey
UNION SELECT n_name, c_name FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION SELECT r_name, c_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE c_mktsegment = 'BUILDING'
UNION SELECT c_name, 'O' || o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey
UNION SELECT n_name, 'O' || o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderstatus = 'F'"""


def _edges(t: Tables):
    people = t.customer.join(t.nation, c("c_nationkey") == c("n_nationkey")).join(t.region, c("n_regionkey") == c("r_regionkey"))
    bought = t.orders.select(F.concat(F.lit("O"), "o_orderkey").alias("o"), "o_custkey", "o_orderstatus").join(people, c("o_custkey") == c("c_custkey"))
    edge = lambda df, a, b: df.select(c(a).alias("source"), c(b).alias("target"))
    return (
        edge(t.nation.join(t.region, c("n_regionkey") == c("r_regionkey")), "r_name", "n_name")
        .unionByName(edge(people, "n_name", "c_name")).unionByName(edge(people.where("c_mktsegment = 'BUILDING'"), "r_name", "c_name"))
        .unionByName(edge(bought, "c_name", "o")).unionByName(edge(bought.where("o_orderstatus = 'F'"), "n_name", "o"))
    )


@query(f"""WITH RECURSIVE e AS ({EDGES}), p AS (SELECT DISTINCT source AS node, 0 AS depth FROM e WHERE source NOT IN (SELECT target FROM e)
UNION SELECT target, depth + 1 FROM p JOIN e ON source = node) SELECT node, max(depth) AS depth FROM p GROUP BY node""")
def lineage_depth(t: Tables):
    return quality.lineage_depth(_edges(t))


@query(f"""SELECT node, CAST(sum(i) AS BIGINT) AS n_inputs, CAST(sum(o) AS BIGINT) AS n_outputs FROM (
SELECT source AS node, 0 AS i, 1 AS o FROM ({EDGES}) UNION ALL SELECT target, 1, 0 FROM ({EDGES})) GROUP BY node""")
def lineage_neighbours(t: Tables):
    return quality.neighbours(_edges(t))


@query("""SELECT event_id, date_trunc('second', ts) AS logged_at, upper(event_type) AS level, 'user ' || user_id || ' - ' || event_id AS message
FROM events WHERE event_type <> 'view'""", text=["logged_at"])
def log_parse(t: Tables):
    rendered = F.concat_ws(" - ", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.upper("event_type"), F.concat(F.lit("user "), "user_id"), "event_id")
    lines = t.events.select("event_id", F.when(c("event_type") == "view", "no log line").otherwise(rendered).alias("value"))
    return quality.parse_log(lines)


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_orderdate AS DATE) AS order_date, CASE WHEN o_orderstatus = 'F' THEN 7 ELSE 0 END AS age,
round(o_totalprice, 2) AS paid_amount FROM orders""", text=["order_date"])
def coerce_by_name(t: Tables):
    raw = t.orders.select(c("o_orderkey").alias("order_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
                          F.when(c("o_orderstatus") == "F", "7").otherwise("n/a").alias("age"), F.format_number("o_totalprice", 2).alias("paid_amount"))
    return quality.coerce_by_name(raw)


# ---- comparison of two datasets ----

def _pair(t: Tables):
    """Orders, and a copy with rows dropped, cells changed or emptied, and rows repeated."""
    a = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", c("o_totalprice").alias("amount"), c("o_custkey").alias("member"))
    p = c("o_orderpriority")
    b = a.where("not (o_orderstatus = 'P' and o_orderpriority = '5-LOW')").withColumns({
        "amount": F.when(p == "2-HIGH", c("amount") + 1).otherwise(c("amount")),
        "o_orderstatus": F.when(p == "3-MEDIUM", None).otherwise(c("o_orderstatus"))})
    return a, b.unionByName(b.where("o_orderstatus = 'F' and o_orderpriority = '1-URGENT'"))


PAIR = """
WITH a AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice AS amount, o_custkey AS member FROM orders),
k AS (SELECT o_orderkey, CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_orderstatus END AS o_orderstatus, o_orderpriority,
  CASE WHEN o_orderpriority = '2-HIGH' THEN amount + 1 ELSE amount END AS amount, member FROM a WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')),
b AS (SELECT * FROM k UNION ALL SELECT * FROM k WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')
"""
PAIR_COLUMNS = ["o_orderkey", "o_orderstatus", "o_orderpriority", "amount", "member"]
VERDICT = "CASE WHEN {} THEN 'Passed' ELSE 'Failed' END"


@query(PAIR + f"SELECT x AS rows_1, y AS rows_2, {VERDICT.format('x = y')} AS result FROM (SELECT count(*) AS x FROM a), (SELECT count(*) AS y FROM b)")
def compare_row_counts(t: Tables):
    return compare.row_counts(*_pair(t))


@query(PAIR + "SELECT *, CASE WHEN missing_1 * (missing_2 + present_2) = missing_2 * (missing_1 + present_1) THEN 'Passed' ELSE 'Failed' END AS result, "
       "round(missing_1 * 100 / (missing_1 + present_1), 3) AS share_1, round(missing_2 * 100 / (missing_2 + present_2), 3) AS share_2 FROM ("
       + " UNION ALL ".join(f"""SELECT '{x}' AS "column", (SELECT count(*) - count({x}) FROM a) AS missing_1, (SELECT count({x}) FROM a) AS present_1,
       (SELECT count(*) - count({x}) FROM b) AS missing_2, (SELECT count({x}) FROM b) AS present_2""" for x in PAIR_COLUMNS) + ")")
def compare_missing(t: Tables):
    return compare.missing_values(*_pair(t))


@query(PAIR + """SELECT "column", value, CAST(sum(l) AS BIGINT) AS copies_1, CAST(sum(1 - l) AS BIGINT) AS copies_2 FROM (""" + " UNION ALL ".join(
    f"""SELECT '{x}' AS "column", CAST({x} AS VARCHAR) AS value, {side} AS l FROM {name}""" for x in PAIR_COLUMNS for name, side in (("a", 1), ("b", 0)))
    + """) WHERE value IS NOT NULL GROUP BY "column", value""")
def compare_distinct(t: Tables):
    return compare.distinct_values(*_pair(t))


@query(PAIR + """SELECT o_orderkey, o_orderstatus, o_orderpriority, amount, member, CAST(sum(l) AS BIGINT) AS copies_1, CAST(sum(1 - l) AS BIGINT) AS copies_2
FROM (SELECT *, 1 AS l FROM a UNION ALL SELECT *, 0 FROM b) GROUP BY ALL HAVING sum(l) > 1 OR sum(1 - l) > 1""")
def compare_duplicates(t: Tables):
    return compare.duplicates(*_pair(t))


@query(PAIR + """, s AS (SELECT 1 AS side, x, v FROM (SELECT 'amount' AS x, amount AS v FROM a UNION ALL SELECT 'member', CAST(member AS DOUBLE) FROM a UNION ALL SELECT 'o_orderkey', CAST(o_orderkey AS DOUBLE) FROM a)
UNION ALL SELECT 2, x, v FROM (SELECT 'amount' AS x, amount AS v FROM b UNION ALL SELECT 'member', CAST(member AS DOUBLE) FROM b UNION ALL SELECT 'o_orderkey', CAST(o_orderkey AS DOUBLE) FROM b)),
g AS (SELECT side, x, CAST(count(v) AS DOUBLE) AS n_values, round(avg(v), 2) AS mean, round(stddev_samp(v), 2) AS std, min(v) AS min, round(quantile_cont(v, 0.25), 2) AS q25,
  round(quantile_cont(v, 0.5), 2) AS q50, round(quantile_cont(v, 0.75), 2) AS q75, max(v) AS max FROM s GROUP BY side, x),
u AS (UNPIVOT g ON n_values, mean, std, min, q25, q50, q75, max INTO NAME statistic VALUE v)
SELECT p.x AS "column", p.statistic, round(p.v, 2) AS value_1, round(q.v, 2) AS value_2, CASE WHEN round(p.v, 2) = round(q.v, 2) THEN 'Passed' ELSE 'Failed' END AS result
FROM u p JOIN u q ON p.x = q.x AND p.statistic = q.statistic AND p.side = 1 AND q.side = 2""")
def compare_statistics(t: Tables):
    return compare.statistics(*_pair(t))


@query(PAIR + """, s AS (SELECT 1 AS l, 'o_orderstatus' AS "column", o_orderstatus AS value FROM a UNION ALL SELECT 1, 'o_orderpriority', o_orderpriority FROM a
UNION ALL SELECT 0, 'o_orderstatus', o_orderstatus FROM b UNION ALL SELECT 0, 'o_orderpriority', o_orderpriority FROM b)
SELECT "column", value, CAST(sum(l) AS BIGINT) AS n_1, CAST(sum(1 - l) AS BIGINT) AS n_2, CASE WHEN sum(l) = sum(1 - l) THEN 'Passed' ELSE 'Failed' END AS result
FROM s WHERE value IS NOT NULL GROUP BY "column", value""")
def compare_distributions(t: Tables):
    return compare.distributions(*_pair(t))


@query("""WITH a AS (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_totalprice > 100000),
b AS (SELECT o_orderkey, CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_orderstatus END AS o_orderstatus, replace(o_orderpriority, '2-HIGH', 'high') AS o_orderpriority FROM orders WHERE o_totalprice < 400000),
j AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN a.o_orderkey IS NULL THEN 'right_only' WHEN b.o_orderkey IS NULL THEN 'left_only' ELSE 'both' END AS origin,
  a.o_orderstatus AS s1, b.o_orderstatus AS s2, a.o_orderpriority AS p1, b.o_orderpriority AS p2 FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey)
SELECT o_orderkey, origin, '*' AS "column", NULL AS value_1, NULL AS value_2 FROM j WHERE origin <> 'both'
UNION ALL SELECT o_orderkey, origin, 'o_orderstatus', s1, s2 FROM j WHERE origin = 'both' AND s1 IS DISTINCT FROM s2
UNION ALL SELECT o_orderkey, origin, 'o_orderpriority', p1, p2 FROM j WHERE origin = 'both' AND p1 IS DISTINCT FROM p2""")
def compare_cells(t: Tables):
    a = t.orders.where("o_totalprice > 100000").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    p = c("o_orderpriority")
    b = t.orders.where("o_totalprice < 400000").select(
        "o_orderkey", F.when(p != "3-MEDIUM", c("o_orderstatus")).alias("o_orderstatus"), F.when(p == "2-HIGH", "high").otherwise(p).alias("o_orderpriority"))
    return compare.cell_differences(a, b, ["o_orderkey"])


def _dated_pair(t: Tables):
    """The pair with a load date: the first day of the order's month."""
    days = t.orders.select("o_orderkey", F.trunc(c("o_orderdate").cast("date"), "month").alias("load"))
    a, b = _pair(t)
    # one month of the copy is left as it was
    same = c("load") == F.lit("1998-03-01").cast("date")
    a = a.join(days, "o_orderkey")
    return a, b.join(days, "o_orderkey").where(~same).unionByName(a.where(same))


DATED = PAIR + """, m AS (SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS load FROM orders),
da AS (SELECT a.*, load FROM a JOIN m USING (o_orderkey)),
db AS (SELECT b.*, load FROM b JOIN m USING (o_orderkey) WHERE load <> DATE '1998-03-01' UNION ALL SELECT * FROM da WHERE load = DATE '1998-03-01')
"""


@query(DATED + """, h AS (SELECT load, '=' || o_orderkey || chr(31) || coalesce('=' || o_orderstatus, '0') || chr(31) || '=' || o_orderpriority AS h, CAST(o_orderkey AS VARCHAR) AS k, l FROM (SELECT *, 1 AS l FROM da UNION ALL SELECT *, 0 FROM db)),
g AS (SELECT load, md5(h) AS h, max(l) AS x, max(1 - l) AS y, min(k) AS k FROM h GROUP BY ALL)
SELECT load, count(*) FILTER (WHERE y = 0) AS only_1, count(*) FILTER (WHERE x = 0) AS only_2,
  coalesce(array_to_string((list(k ORDER BY h) FILTER (WHERE y = 0))[:2], ', '), '') AS keys_1, coalesce(array_to_string((list(k ORDER BY h) FILTER (WHERE x = 0))[:2], ', '), '') AS keys_2,
  count(*) FILTER (WHERE x = 0 OR y = 0) = 0 AS identical FROM g GROUP BY load""", text=["load"])
def hash_reconcile(t: Tables):
    return compare.hash_reconcile(*_dated_pair(t), "load", ["o_orderkey", "o_orderstatus", "o_orderpriority"], ["o_orderkey"])


@query(DATED + """, g AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, amount, member, load, sum(l) AS x, sum(1 - l) AS y FROM (SELECT *, 1 AS l FROM da UNION ALL SELECT *, 0 FROM db) GROUP BY ALL)
SELECT load, CAST(sum(x) AS BIGINT) AS rows_1, CAST(sum(y) AS BIGINT) AS rows_2, CAST(sum(greatest(x - y, 0)) AS BIGINT) AS only_1, CAST(sum(greatest(y - x, 0)) AS BIGINT) AS only_2,
  CASE WHEN bool_and(x = y) THEN 'Passed' ELSE 'Failed' END AS result FROM g GROUP BY load""", text=["load"])
def compare_by_date(t: Tables):
    return compare.compare_by_date(*_dated_pair(t), "load")


SUITE = """, r AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, amount, member, sum(l) AS x, sum(1 - l) AS y FROM (SELECT *, 1 AS l FROM {a} UNION ALL SELECT *, 0 FROM {b}) GROUP BY ALL)
SELECT 'column_count' AS metric, 'Passed' AS result UNION ALL SELECT 'column_names', 'Passed'
UNION ALL SELECT 'row_count', CASE WHEN (SELECT count(*) FROM {a}) = (SELECT count(*) FROM {b}) THEN 'Passed' ELSE 'Failed' END
UNION ALL SELECT 'missing_values', CASE WHEN (SELECT count(*) - count(o_orderstatus) FROM {b}) = 0 THEN 'Passed' ELSE 'Failed' END
UNION ALL SELECT 'distinct_values', CASE WHEN (SELECT count(DISTINCT o_orderkey) FROM {a}) = (SELECT count(DISTINCT o_orderkey) FROM {b}) THEN 'Passed' ELSE 'Failed' END
UNION ALL SELECT 'duplicates', CASE WHEN bool_and(greatest(x, 1) = greatest(y, 1)) THEN 'Passed' ELSE 'Failed' END FROM r
UNION ALL SELECT 'rows', CASE WHEN bool_and(x = y) THEN 'Passed' ELSE 'Failed' END FROM r
UNION ALL SELECT 'distributions', CASE WHEN (SELECT count(o_orderstatus) FROM {a}) = (SELECT count(o_orderstatus) FROM {b}) THEN 'Passed' ELSE 'Failed' END
UNION ALL SELECT 'statistics', CASE WHEN (SELECT count(amount) FROM {a}) = (SELECT count(amount) FROM {b}) THEN 'Passed' ELSE 'Failed' END"""


@query(PAIR + SUITE.format(a="a", b="b"))
def compare_suite(t: Tables):
    return compare.suite(*_pair(t))


@query("SELECT 'Passed' AS result, count(*) * 0 + 9 AS n_checks FROM orders")
def compare_equal(t: Tables):
    a, _ = _pair(t)
    return compare.result_counts(compare.suite(a, a.select(*reversed(a.columns))))


@query("""SELECT * FROM (VALUES ('amount', 'double', 'double', 'Passed'), ('member', 'bigint', 'bigint', 'Passed'), ('o_orderkey', 'bigint', 'bigint', 'Passed'),
  ('o_orderpriority', 'string', 'string', 'Passed'), ('o_orderstatus', 'string', NULL, 'Failed'), ('status', NULL, 'string', 'Failed')) v("column", type_1, type_2, result)""")
def compare_names(t: Tables):
    a, b = _pair(t)
    return compare.column_names(a, b.withColumnRenamed("o_orderstatus", "status"))


@query("""WITH i AS (SELECT 'orders' AS t, column_name AS c FROM (DESCRIBE orders) UNION ALL SELECT 'nation', column_name FROM (DESCRIBE nation))
SELECT t AS table_name, c AS column_name, CASE WHEN c LIKE '%key' THEN 'documented' ELSE 'not in dictionary' END AS status FROM i UNION ALL SELECT 'orders', 'o_channel', 'not in files'""")
def lexicon(t: Tables):
    """Columns of table files, read from their footers, against a dictionary that knows the keys."""
    from lakeloom.sources import files

    found = files.column_inventory(t.spark, {n: t.path(n) for n in ("orders", "nation")}, "parquet")
    known = found.where("column_name like '%key'").select("table_name", "column_name", F.lit("a key").alias("meaning"))
    known = known.unionByName(t.spark.createDataFrame([("orders", "o_channel", "gone")], "table_name string, column_name string, meaning string"))
    return quality.lexicon(found, known).select("table_name", "column_name", "status")


@query(PAIR + """SELECT o_orderkey, o_orderstatus, o_orderpriority, amount, member FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.o_orderkey = a.o_orderkey
AND b.o_orderstatus IS NOT DISTINCT FROM a.o_orderstatus AND b.o_orderpriority = a.o_orderpriority)""")
def unmatched_rows(t: Tables):
    """Whole rows behind unmatched hashes, joined on the hash."""
    a, b = _pair(t)
    return compare.unmatched_rows(a, b, ["o_orderkey", "o_orderstatus", "o_orderpriority"])
