"""Grouping, de-duplication, statistics, reshaping, sets and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.operators import aggregate, filters, reshape, sets
from lakeloom.session import scratch
from workloads.registry import Tables, query

c = F.col


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(t: Tables):
    return aggregate.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""
SELECT k, nullif(array_to_string(list_sort(list(DISTINCT l_returnflag)), '|'), '') AS flags,
       array_to_string(list_sort(list(DISTINCT CAST(l_linenumber AS VARCHAR))), '|') AS lines
FROM (SELECT *, CASE WHEN l_linenumber < 7 THEN l_orderkey END AS k FROM lineitem) WHERE k IS NOT NULL GROUP BY k
UNION ALL SELECT NULL, l_returnflag, CAST(l_linenumber AS VARCHAR) FROM lineitem WHERE NOT l_linenumber < 7""")
def collapse_duplicates(t: Tables):
    raw = t.lineitem.select(F.when(c("l_linenumber") < 7, c("l_orderkey")).alias("k"), c("l_returnflag").alias("flags"),
                            c("l_linenumber").alias("lines"))
    return aggregate.collapse(raw, "k")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1""")
def first_by_key(t: Tables):
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    return aggregate.first_by(t.lineitem.select(*cols, "l_extendedprice"), ["l_orderkey", "l_linenumber"],
                              ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]).select(*cols)


@query("""
SELECT k, o_orderkey FROM (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS k, o_orderkey FROM orders)
QUALIFY k IS NULL OR row_number() OVER (PARTITION BY k ORDER BY o_orderkey) = 1""")
def keep_null_keys(t: Tables):
    raw = t.orders.select(F.when(c("o_orderstatus") != "P", c("o_custkey")).alias("k"), "o_orderkey")
    return aggregate.first_by_or_null(raw, "k", ["o_orderkey"])


@query("SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(t: Tables):
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, CAST(round(coalesce(a, 0) + coalesce(b, 0) + l_tax, 2) AS DOUBLE) AS total
FROM (SELECT *, CASE WHEN l_returnflag <> 'A' THEN l_quantity END AS a, CASE WHEN l_linestatus = 'F' THEN l_discount END AS b FROM lineitem)""")
def row_sum(t: Tables):
    raw = t.lineitem.withColumns({"a": F.when(c("l_returnflag") != "A", c("l_quantity")),
                                  "b": F.when(c("l_linestatus") == "F", c("l_discount"))})
    return raw.select("l_orderkey", "l_linenumber", "l_partkey", F.round(aggregate.row_sum(["a", "b", "l_tax"]), 2).alias("total"))


@query("""
SELECT o_orderkey, CAST(sum(p) OVER (PARTITION BY o_custkey) - p AS DOUBLE) AS remaining
FROM (SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS p FROM orders)""")
def group_remaining(t: Tables):
    p = c("o_totalprice").cast("decimal(18,2)")
    out = aggregate.group_remaining(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), ["o_custkey"], p, p, "remaining")
    return out.select("o_orderkey", c("remaining").cast("double").alias("remaining"))


@query("""
SELECT o_custkey, min(o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS "F", min(o_orderkey) FILTER (WHERE o_orderstatus = 'O') AS "O",
       min(o_orderkey) FILTER (WHERE o_orderstatus = 'P') AS "P" FROM orders GROUP BY o_custkey""")
def pivot_first(t: Tables):
    return aggregate.pivot_first(t.orders, ["o_custkey"], "o_orderstatus", c("o_orderkey"), ["F", "O", "P"])


@query("""
SELECT col AS "column", count(v) AS n_values, round(avg(v), 2) AS mean, round(stddev_samp(v), 2) AS std, min(v) AS min,
       round(quantile_cont(v, 0.25), 2) AS q25, round(quantile_cont(v, 0.5), 2) AS q50, round(quantile_cont(v, 0.75), 2) AS q75, max(v) AS max
FROM (SELECT 'o_totalprice' AS col, o_totalprice AS v FROM orders UNION ALL SELECT 'o_custkey', CAST(o_custkey AS DOUBLE) FROM orders
      UNION ALL SELECT 'o_orderkey', CAST(o_orderkey AS DOUBLE) FROM orders) GROUP BY col""")
def describe_numeric(t: Tables):
    return aggregate.describe(t.orders)


@query("""
SELECT 'o_orderstatus' AS "column", o_orderstatus AS value, count(*) AS n_rows FROM orders GROUP BY ALL
UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY ALL""")
def distribution(t: Tables):
    return aggregate.distribution(t.orders, ["o_orderstatus", "o_orderpriority"])


@query("""
SELECT o_custkey FROM orders GROUP BY o_custkey HAVING NOT bool_or(o_orderpriority = '1-URGENT')""")
def silent_groups(t: Tables):
    return aggregate.silent_groups(t.orders, ["o_custkey"], c("o_orderpriority") == "1-URGENT")


@query("""
SELECT count(*) AS total, count(*) FILTER (WHERE o_orderstatus = 'F') AS final,
       count(*) FILTER (WHERE o_totalprice > 200000) AS large, count(DISTINCT o_custkey) AS members FROM orders""")
def conditional_counts(t: Tables):
    counts = aggregate.conditional_counts(t.orders, {
        "total": F.lit(True), "final": c("o_orderstatus") == "F", "large": c("o_totalprice") > 200000})
    members = t.orders.select("o_custkey").distinct().agg(F.count(F.lit(1)).alias("members"))
    both = counts.unionByName(members, allowMissingColumns=True)
    return both.agg(*[F.max(n).alias(n) for n in both.columns])


@query("SELECT date_trunc('hour', ts) AS bin_start, count(*) AS n_rows FROM events GROUP BY ALL", text=["bin_start"])
def hourly_counts(t: Tables):
    return aggregate.time_bins(t.events.withColumn("ts", c("ts").cast("timestamp")), "ts")


@query("""
SELECT p_type, sum(CAST(p_size AS BIGINT))::BIGINT AS sum_p_size, count(p_brand) AS count_p_brand FROM part GROUP BY p_type""")
def default_aggregates(t: Tables):
    return aggregate.default_aggregates(t.part, ["p_type"], {"p_size": "sum", "p_brand": "count", "p_name": "none"})


@query("""
SELECT l_partkey, count(*) AS n_rows, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM lineitem GROUP BY l_partkey ORDER BY n_rows DESC, l_partkey LIMIT 20""")
def top_counts(t: Tables):
    grouped = t.lineitem.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(c("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("amount"))
    return grouped.orderBy(F.desc("n_rows"), "l_partkey").limit(20)


# ---- reshape ----

@query("""
SELECT o_orderkey, variable, value FROM (
  SELECT l_orderkey AS o_orderkey, 'l_quantity' AS variable, l_quantity AS value FROM lineitem
  UNION ALL SELECT l_orderkey, 'l_discount', l_discount FROM lineitem UNION ALL SELECT l_orderkey, 'l_tax', CASE WHEN l_returnflag <> 'N' THEN l_tax END FROM lineitem)
WHERE value IS NOT NULL AND value <> 0""")
def unpivot_amounts(t: Tables):
    raw = t.lineitem.select(c("l_orderkey").alias("o_orderkey"), "l_quantity", "l_discount",
                            F.when(c("l_returnflag") != "N", c("l_tax")).alias("l_tax"))
    return reshape.wide_to_long(raw, ["o_orderkey"], ["l_quantity", "l_discount", "l_tax"], drop_null=True, drop_zero=True)


@query("""
SELECT doc_id, unnest(CASE WHEN len(m) = 0 THEN [NULL] ELSE m END) AS word
FROM (SELECT doc_id, regexp_extract_all(text, '([A-Z][a-z]+ing) ', 1) AS m FROM documents)""")
def explode_matches(t: Tables):
    return reshape.explode_matches(t.documents.select("doc_id", "text"), "text", "([A-Z][a-z]+ing) ", "word").drop("text")


@query("""
SELECT l_orderkey || '|' || l_linenumber || '|' || l_partkey AS parent, 'price' AS kind, l_extendedprice AS amount FROM lineitem WHERE l_returnflag <> 'N'
UNION ALL SELECT l_orderkey || '|' || l_linenumber || '|' || l_partkey, 'tax', l_tax FROM lineitem WHERE l_returnflag <> 'N'""")
def explode_struct_child(t: Tables):
    part = lambda kind, v: F.struct(F.lit(kind).alias("kind"), c(v).alias("amount"))
    nested = F.when(c("l_returnflag") == "N", F.array()).otherwise(F.array(part("price", "l_extendedprice"), part("tax", "l_tax")))
    raw = t.lineitem.withColumn("details", F.when(c("l_returnflag") == "A", nested).when(c("l_returnflag") == "R", nested))
    return reshape.child_table(raw, "details", ["l_orderkey", "l_linenumber", "l_partkey"], ["kind", "amount"], "parent")


@query("""
SELECT p_partkey, split_part(p_name, ' ', 1) AS colour, nullif(split_part(p_name, ' ', 2), '') AS noun,
       split_part(p_brand || ' ' || p_name, ' ', 1) AS brand, p_name AS rest FROM part""")
def split_columns(t: Tables):
    two = reshape.split_into(c("p_name"), ["colour", "noun"], " ")
    capped = reshape.split_into(F.concat_ws(" ", "p_brand", "p_name"), ["brand", "rest"], " ")
    return t.part.select("p_partkey", *two, *capped)


@query("""
WITH r AS (SELECT p_partkey, p_size, CASE WHEN p_type <> 'PROMO' THEN p_type END AS a, CASE WHEN p_size < 30 THEN p_brand END AS b FROM part)
SELECT p_partkey, p_size, a AS code, 'ONE' AS system FROM r WHERE b IS NULL
UNION ALL SELECT p_partkey, p_size, b, 'TWO' FROM r WHERE a IS NULL
UNION ALL SELECT p_partkey, p_size, b, 'TWO' FROM r WHERE a IS NOT NULL AND b IS NOT NULL
UNION ALL (SELECT p_partkey, p_size, a, 'ONE' FROM r WHERE a IS NOT NULL AND b IS NOT NULL
           QUALIFY row_number() OVER (PARTITION BY p_size ORDER BY p_partkey) = 1)""")
def dual_code_rows(t: Tables):
    raw = t.part.select("p_partkey", "p_size", F.when(c("p_type") != "PROMO", c("p_type")).alias("a"),
                        F.when(c("p_size") < 30, c("p_brand")).alias("b"))
    return reshape.rows_per_system(raw, "p_size", "a", "b", ("ONE", "TWO"), ["p_partkey"]).drop("a", "b")


# ---- sets ----

def _two_states(t: Tables):
    """Orders and an altered copy: some dropped, some changed, some repeated."""
    a = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    kept = a.where("not (o_orderstatus = 'P' and o_orderpriority = '5-LOW')")
    b = kept.withColumn("o_orderpriority", F.when(c("o_orderpriority") == "1-URGENT", "0-NOW").otherwise(c("o_orderpriority")))
    return a, b.unionByName(b.where("o_orderstatus = 'O' and o_orderpriority = '2-HIGH'"))


STATES = """
WITH a AS (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders),
k AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderpriority = '1-URGENT' THEN '0-NOW' ELSE o_orderpriority END AS o_orderpriority
      FROM a WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')),
b AS (SELECT * FROM k UNION ALL SELECT * FROM k WHERE o_orderstatus = 'O' AND o_orderpriority = '2-HIGH')
"""


@query("""SELECT c_custkey AS k, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier UNION ALL SELECT p_partkey, p_name, NULL, NULL FROM part""")
def union_by_name(t: Tables):
    return sets.union_all([
        t.customer.select(c("c_custkey").alias("k"), c("c_name").alias("name"), c("c_mktsegment").alias("segment")),
        t.supplier.select(c("s_acctbal").alias("balance"), c("s_name").alias("name"), c("s_suppkey").alias("k")),
        t.part.select(c("p_partkey").alias("k"), c("p_name").alias("name"))])


@query(STATES + "SELECT * FROM a EXCEPT SELECT * FROM b")
def set_difference(t: Tables):
    return sets.difference(*_two_states(t))


@query(STATES + "SELECT * FROM a INTERSECT SELECT * FROM b")
def set_common(t: Tables):
    return sets.common(*_two_states(t))


@query(STATES + "SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT *, 'right' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)")
def symmetric_difference(t: Tables):
    return sets.symmetric_difference(*_two_states(t))


@query(STATES + """SELECT o_orderkey, o_orderstatus, o_orderpriority, sum(l)::BIGINT AS n_left, sum(1 - l)::BIGINT AS n_right
FROM (SELECT *, 1 AS l FROM a UNION ALL SELECT *, 0 FROM b) GROUP BY ALL HAVING sum(l) <> sum(1 - l)""")
def multiset_difference(t: Tables):
    return sets.multiset_difference(*_two_states(t))


# ---- filters ----

@query("""
SELECT o_orderkey, s, p FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS s, nullif(o_orderpriority, '5-LOW') AS p FROM orders)
WHERE (s IS DISTINCT FROM 'F') AND NOT (s IS NULL AND p IS NULL) AND coalesce(p NOT IN ('1-URGENT', '2-HIGH'), TRUE)""")
def null_safe_filters(t: Tables):
    raw = t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("s"), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("p"))
    df = filters.drop_all_null(raw, ["s", "p"]).where(filters.differs(c("s"), "F"))
    return filters.drop_values(df, {"p": ["1-URGENT", "2-HIGH"], "absent": ["x"]})


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate >= DATE '1996-07-01' AS late FROM lineitem
WHERE l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '1997-01-01' AND l_returnflag IN ('A', 'R') AND l_linestatus <> 'O'""")
def range_filters(t: Tables):
    d = c("l_shipdate")
    lit = lambda s: F.lit(s).cast("timestamp_ntz")
    hit = t.lineitem.where(filters.in_range(d, lit("1996-01-01"), lit("1997-01-01")) & c("l_returnflag").isin("A", "R"))
    return hit.where(filters.differs(c("l_linestatus"), "O", keep_null=False)).select(
        "l_orderkey", "l_linenumber", "l_partkey", (d >= lit("1996-07-01")).alias("late"))


@query("""
SELECT 'pair' AS kind, o_orderkey FROM orders WHERE o_orderstatus <> 'F' AND o_orderpriority <> '2-HIGH'
UNION ALL SELECT 'key', o_orderkey FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '2-HIGH')""")
def exclude_keys(t: Tables):
    gone = {"o_orderstatus": "F", "o_orderpriority": "2-HIGH"}
    a, b = filters.exclude_pair(t.orders, gone), filters.exclude_key(t.orders, gone)
    return a.select(F.lit("pair").alias("kind"), "o_orderkey").unionByName(b.select(F.lit("key").alias("kind"), "o_orderkey"))


@query("SELECT p_partkey, p_brand FROM part WHERE p_brand LIKE 'Brand#1%' AND NOT regexp_matches(p_name, '^(red|blue)')")
def pattern_filters(t: Tables):
    rows = t.part.select("p_partkey", "p_brand", "p_name").where(c("p_brand").startswith("Brand#1") & ~c("p_name").rlike("^(red|blue)"))
    return rows.drop("p_name")


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name FROM customer")
def repeated_headers(t: Tables):
    """Text files each of which carries its own header, read as headerless lines."""
    path = scratch(t.spark, "headers")
    t.customer.select("c_custkey", "c_name").write.option("header", "true").csv(path)
    raw = t.spark.read.schema("c_custkey string, c_name string").csv(path)
    return filters.drop_repeated_headers(raw)


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def in_other_frame(t: Tables):
    return filters.in_other(t.orders.select("o_orderkey", "o_custkey"), t.customer.where("c_mktsegment = 'BUILDING'"), "o_custkey", "c_custkey")


@query("""SELECT 'null' AS part, count(*) AS n FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT 'filled', count(*) FROM orders WHERE o_orderstatus <> 'P'""")
def null_split(t: Tables):
    a, b = filters.null_split(t.orders.select(F.nullif("o_orderstatus", F.lit("P")).alias("s")), "s")
    n = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n")
    return n(a, "null").unionByName(n(b, "filled"))


@query("SELECT event_id, event_type FROM events ORDER BY ts, event_id LIMIT 10")
def take_rows(t: Tables):
    return t.events.orderBy("ts", "event_id").limit(10).select("event_id", "event_type")
