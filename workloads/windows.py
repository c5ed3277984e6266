"""Ordered operators: versions, keys, latest values, running values, labels, calendars."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions import dates
from lakeloom.operators import windows
from lakeloom.plans import calendar
from workloads.registry import Tables, query

c = F.col
MONEY = "decimal(18,2)"


def _orders(t: Tables):
    return t.orders.withColumn("day", c("o_orderdate").cast("date"))


@query("""SELECT o_orderkey, CASE WHEN n = 1 THEN CAST(o_custkey AS VARCHAR) ELSE o_custkey || '-' || n END AS version_id
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS n FROM orders)""")
def version_suffix(t: Tables):
    return windows.version_suffix(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), "o_custkey",
                                  [F.desc("o_orderdate"), "o_orderkey"], "version_id").select("o_orderkey", "version_id")


@query("""WITH a AS (SELECT o_orderkey, o_custkey, o_orderpriority AS unit, date_trunc('year', o_orderdate) AS y, nullif(o_orderstatus, 'P') AS s FROM orders),
b AS (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY y, s NULLS FIRST) AS r FROM a),
d AS (SELECT *, count(*) OVER (PARTITION BY o_custkey, r) AS size FROM b),
e AS (SELECT *, first_value(CASE WHEN size = 1 THEN unit END IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY y, s NULLS FIRST, o_orderkey
      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM d),
f AS (SELECT *, CASE WHEN size > 1 AND unit = nxt THEN r + 1 ELSE r END AS r2 FROM e),
g AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, r2 ORDER BY o_orderkey) AS n FROM f)
SELECT o_orderkey, r2 AS key_rank, n AS key_number, CASE WHEN n = 1 THEN o_custkey || '-' || r2 ELSE o_custkey || '-' || r2 || '-' || n END AS surrogate_key FROM g""")
def surrogate_key(t: Tables):
    raw = t.orders.select("o_orderkey", "o_custkey", c("o_orderpriority").alias("unit"), F.date_trunc("year", "o_orderdate").alias("y"),
                          F.nullif("o_orderstatus", F.lit("P")).alias("s"))
    out = windows.surrogate_key(raw, "o_custkey", "unit", ["y", "s"], ["o_orderkey"])
    return out.select("o_orderkey", "key_rank", "key_number", "surrogate_key")


@query("""SELECT o_orderkey, first_value(o_orderpriority) OVER w AS latest_priority, first_value(o_orderstatus) OVER w AS latest_status
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC)""")
def latest_value(t: Tables):
    out = windows.latest_value(t.orders.drop("o_totalprice"), ["o_custkey"], ["o_orderdate", "o_orderkey"],
                               {"o_orderpriority": "latest_priority", "o_orderstatus": "latest_status"})
    return out.select("o_orderkey", "latest_priority", "latest_status")


@query("""SELECT o_custkey, o_orderkey FROM orders QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) = 1""")
def latest_rows(t: Tables):
    return windows.latest_rows(t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], "o_orderdate").drop("o_orderdate")


@query("""SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def latest_one(t: Tables):
    return windows.latest_one(t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey = max(o_orderkey) OVER (PARTITION BY o_custkey) THEN 1 ELSE 0 END AS current_customer,
CASE WHEN o_orderdate = max(o_orderdate) OVER (PARTITION BY o_custkey, o_orderpriority) THEN 1 ELSE 0 END AS current_priority FROM orders""")
def current_flags(t: Tables):
    raw = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    df = windows.current_flag(raw, ["o_custkey"], ["o_orderkey"], "current_customer")
    df = windows.current_flag(df, ["o_custkey", "o_orderpriority"], ["o_orderdate"], "current_priority")
    return df.select("o_orderkey", "current_customer", "current_priority")


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND n > 1 AND asked >= prev THEN n - 1 ELSE 0 END AS resubmission, n - 1 AS occurrence
FROM (SELECT *, row_number() OVER w AS n, lag(decided) OVER w AS prev
      FROM (SELECT *, CAST(o_orderdate AS DATE) AS asked, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) + 120 END AS decided FROM orders)
      WINDOW w AS (PARTITION BY o_custkey ORDER BY asked, o_orderkey))""")
def resubmission(t: Tables):
    asked = c("o_orderdate").cast("date")
    raw = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", asked.alias("asked"),
                          F.when(c("o_orderpriority") != "5-LOW", F.date_add(asked, 120)).alias("decided"))
    df = windows.resubmissions(raw, ["o_custkey"], "asked", "decided", c("o_orderstatus") == "F", ["o_orderkey"])
    df = windows.occurrence(df, ["o_custkey"], ["asked", "o_orderkey"])
    return df.select("o_orderkey", "resubmission", "occurrence")


@query("""SELECT o_custkey, max(o_orderdate) AS last_day, greatest(min(o_orderdate), DATE '1995-06-01') AS first_day,
CASE WHEN sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'P') > 0 THEN 'Y' ELSE 'N' END AS paid FROM
(SELECT o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice, o_orderstatus FROM orders) GROUP BY o_custkey""", text=["last_day", "first_day"])
def group_extremes(t: Tables):
    paid = F.sum(F.when(c("o_orderstatus") == "P", c("o_totalprice").cast(MONEY)))
    return _orders(t).groupBy("o_custkey").agg(
        F.max("day").alias("last_day"), F.greatest(F.min("day"), F.lit("1995-06-01").cast("date")).alias("first_day"),
        F.when(paid > 0, "Y").otherwise("N").alias("paid"))


@query("""SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS DOUBLE) AS running FROM orders""")
def running_total(t: Tables):
    raw = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    out = windows.running_total(raw, ["o_custkey"], ["o_orderdate", "o_orderkey"], c("o_totalprice").cast(MONEY), "running")
    return out.select("o_orderkey", c("running").cast("double").alias("running"))


@query("""SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN length(text) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS asked,
last_value(CASE WHEN role = 'system' THEN role END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS opened,
CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS group_id FROM conversations""")
def fill_forward(t: Tables):
    raw = t.conversations.select("conv_id", "turn", F.when(c("role") == "user", F.length("text").cast("bigint")).alias("asked"),
                                 F.when(c("role") == "system", c("role")).otherwise("").alias("opened"))
    df = windows.group_number(raw, ["conv_id"], ["turn"], "asked")
    df = windows.fill_forward(df, ["conv_id"], ["turn"], ["opened"], blank_as_null=True)
    return windows.fill_forward(df, ["conv_id"], ["turn"], ["asked"])


@query("""SELECT o_orderkey, lag(o_orderpriority, 1) OVER w AS p1, lag(o_orderpriority, 2) OVER w AS p2 FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def lag_values(t: Tables):
    raw = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    out = windows.lagged(raw, ["o_custkey"], ["o_orderdate", "o_orderkey"], {"p1": ("o_orderpriority", 1), "p2": ("o_orderpriority", 2)})
    return out.select("o_orderkey", "p1", "p2")


def _lines(t: Tables):
    """Lines of the documents with their place."""
    return t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("seq", "line"))


LINES = """(SELECT doc_id, CAST(unnest(generate_series(0, len(parts) - 1)) AS INTEGER) AS seq, unnest(parts) AS line
            FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))"""


@query(f"""SELECT doc_id, seq, CASE WHEN regexp_matches(line, '^The ') THEN line ELSE '' END AS category,
CASE WHEN marked AND seq > 0 THEN line ELSE '' END AS class, CASE WHEN marked AND seq > 1 THEN line ELSE '' END AS subclass,
CASE WHEN length(line) < 200 AND seq > 2 THEN line ELSE '' END AS description
FROM (SELECT *, length(line) < 60 AS marked FROM {LINES})""")
def outline_labels(t: Tables):
    size = F.length("line")
    return windows.outline_labels(_lines(t), ["doc_id"], ["seq"], "line", "^The ", size < 60, size < 200).select(
        "doc_id", "seq", "category", "class", "subclass", "description")


def _spans(t: Tables):
    """Lines of the documents as spans, with a text size that follows from their length."""
    n = F.length("line")
    size = (F.when(n % 11 == 0, 18.0).when(n % 7 == 0, 15.96).when(n % 13 == 0, 14.04).when(n % 3 == 0, 12.0)
            .when(n % 2 == 0, 11.04).otherwise(9.0))
    return _lines(t).select("doc_id", c("seq").cast("bigint").alias("seq"), size.alias("size"), "line")


SIZES = {"province": 18.0, "heading": 15.96, "section": 14.04, "row": 12.0, "limitation": 11.04, "code": 9.0}


@query(f"""WITH s AS (SELECT doc_id, seq, line, CASE WHEN length(line) % 11 = 0 THEN 'province' WHEN length(line) % 7 = 0 THEN 'heading'
  WHEN length(line) % 13 = 0 THEN 'section' WHEN length(line) % 3 = 0 THEN 'row' WHEN length(line) % 2 = 0 THEN 'limitation' ELSE 'code' END AS role FROM {LINES}),
m AS (SELECT *, CASE WHEN role = 'row' AND regexp_matches(line, '^(T|A)') THEN seq END AS k, CASE WHEN role = 'row' AND NOT regexp_matches(line, '^(T|A)') THEN seq END AS p,
  CASE WHEN role = 'section' THEN seq END AS sec, CASE WHEN role = 'heading' AND contains(line, 'the') THEN seq END AS sch,
  CASE WHEN role = 'heading' AND NOT contains(line, 'the') THEN seq END AS ass, CASE WHEN role = 'province' THEN seq END AS prov FROM s),
w AS (SELECT doc_id, seq, line, role, count(*) FILTER (WHERE role = 'row') OVER o AS row_id, coalesce(max(k) OVER o, -1) AS k, coalesce(max(p) OVER o, -1) AS p,
  coalesce(max(sec) OVER o, -1) AS sec, max(sch) OVER o AS sch, max(ass) OVER o AS ass, min(prov) OVER o AS prov FROM m WINDOW o AS (PARTITION BY doc_id ORDER BY seq)),
f AS (SELECT *, k > sec AS in_class, p > sec AND p > k AS in_sub FROM w WHERE row_id > 0)
SELECT r.doc_id, r.row_id, a.line AS province, b.line AS association, d.line AS schedule, e.line AS section, CASE WHEN r.in_class THEN g.line END AS class,
  CASE WHEN r.in_sub THEN h.line END AS subclass, trim(l.t) AS limitations, q.t AS codes
FROM (SELECT * FROM f WHERE role = 'row') r LEFT JOIN s a ON a.doc_id = r.doc_id AND a.seq = r.prov LEFT JOIN s b ON b.doc_id = r.doc_id AND b.seq = r.ass
LEFT JOIN s d ON d.doc_id = r.doc_id AND d.seq = r.sch LEFT JOIN s e ON e.doc_id = r.doc_id AND e.seq = r.sec LEFT JOIN s g ON g.doc_id = r.doc_id AND g.seq = r.k
LEFT JOIN s h ON h.doc_id = r.doc_id AND h.seq = r.p
LEFT JOIN (SELECT doc_id, row_id, string_agg(line, ' ' ORDER BY seq) AS t FROM f WHERE role = 'limitation' AND (in_class OR in_sub) AND trim(line) <> '' GROUP BY ALL) l ON l.doc_id = r.doc_id AND l.row_id = r.row_id
LEFT JOIN (SELECT doc_id, row_id, string_agg(trim(line), ', ' ORDER BY seq) AS t FROM f WHERE role = 'code' AND in_sub AND regexp_matches(trim(line), 'on') GROUP BY ALL) q ON q.doc_id = r.doc_id AND q.row_id = r.row_id""")
def header_carry(t: Tables):
    return windows.outline_rows(_spans(t), "doc_id", "seq", "size", "line", SIZES, "^(T|A)", "on", schedule_word="the").withColumn(
        "row_id", c("row_id").cast("bigint"))


@query("""WITH q AS (SELECT DISTINCT last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH) AS cutoff FROM orders WHERE o_orderdate < DATE '2001-01-01')
SELECT o_orderkey, (SELECT min(cutoff) FROM q WHERE cutoff >= CAST(o_orderdate AS DATE)) AS load_date FROM orders""", text=["load_date"])
def bucket_dates(t: Tables):
    rows = _orders(t).select("o_orderkey", "day")
    early = rows.where(c("day") < F.lit("2001-01-01").cast("date"))
    cutoffs = early.select(F.last_day(F.add_months(F.trunc("day", "quarter"), 2)).alias("cutoff")).distinct()
    return windows.bucket_by_cutoff(rows, "day", cutoffs, "cutoff").drop("day")


# ---- calendars over the days the tables span ----

SPAN = "(SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d FROM orders)"
ATTRIBUTES = """CAST(year(d) AS INTEGER) AS year_number, CAST(date_trunc('year', d) AS DATE) AS year_first, make_date(year(d), 12, 31) AS year_last, strftime(d, '%Y') AS year_label,
CAST(quarter(d) AS INTEGER) AS quarter_number, CAST(date_trunc('quarter', d) AS DATE) AS quarter_first, CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_last,
'Q' || quarter(d) AS quarter_label, ['1st', '2nd', '3rd', '4th'][quarter(d)] || ' quarter' AS quarter_name,
CAST(month(d) AS INTEGER) AS month_number, CAST(date_trunc('month', d) AS DATE) AS month_first, last_day(d) AS month_last, strftime(d, '%Y-%m') AS month_label, monthname(d) AS month_name, substr(monthname(d), 1, 3) AS month_abbreviation,
CAST(week(d) AS INTEGER) AS week_number, CAST(date_trunc('week', d) AS DATE) AS week_first, CAST(date_trunc('week', d) + INTERVAL 6 DAY AS DATE) AS week_last,
CAST(isodow(d) AS INTEGER) AS weekday_number, dayname(d) AS weekday_name, substr(dayname(d), 1, 3) AS weekday_abbreviation, CAST((quarter(d) + 2) % 4 + 1 AS INTEGER) AS fiscal_quarter,
CASE WHEN month(d) >= 4 THEN 'FY' || year(d) || '-' || (year(d) + 1) ELSE 'FY' || (year(d) - 1) || '-' || year(d) END AS fiscal_year"""
CALENDAR_DATES = ["date", *[f"{p}_{e}" for p in ("year", "quarter", "month", "week") for e in ("first", "last")]]


@query(f"""SELECT *, CAST((year_number - 1990) * 52 + reporting_week AS INTEGER) AS running_week,
CASE WHEN holiday = 1 OR isodow("date") >= 6 THEN 0 ELSE 1 END AS working_day FROM (
SELECT d AS "date", {ATTRIBUTES}, CAST(CASE WHEN dayofyear(d) < 7 AND week(d - CAST((dayofweek(d) + 2) % 7 AS INTEGER)) = 52 THEN 0
  ELSE week(d - CAST((dayofweek(d) + 2) % 7 AS INTEGER)) END AS INTEGER) AS reporting_week,
CASE WHEN d IN (SELECT CAST(o_orderdate AS DATE) FROM orders GROUP BY ALL HAVING bool_and(o_orderstatus = 'F')) THEN 1 ELSE 0 END AS holiday, coalesce(n, 0) AS n_orders
FROM {SPAN} LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS od, count(*) AS n FROM orders GROUP BY ALL) ON od = d)""", text=CALENDAR_DATES)
def calendar_days(t: Tables):
    """Every day the orders span with its attributes, days without open business as holidays, and its orders."""
    orders = _orders(t)
    span = calendar.span_of(orders, "day")
    days = calendar.attributes(span).join(calendar.reporting_weeks(span, 1990), "date")
    closed = orders.groupBy(c("day").alias("date")).agg(F.bool_and(c("o_orderstatus") == "F").alias("all")).where("all").select("date")
    per_day = orders.groupBy(c("day").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    flagged = calendar.with_holidays(days, closed)
    return flagged.join(per_day, "date", "left").withColumn("n_orders", F.coalesce("n", F.lit(0))).drop("n")


@query(f"""SELECT strftime(w, '%b-%y') AS month_year, CAST(w AS DATE) AS week_start, max(CASE WHEN isodow(d) = 1 THEN day(d) END)::INTEGER AS mon,
max(CASE WHEN isodow(d) = 2 THEN day(d) END)::INTEGER AS tue, max(CASE WHEN isodow(d) = 3 THEN day(d) END)::INTEGER AS wed,
max(CASE WHEN isodow(d) = 4 THEN day(d) END)::INTEGER AS thu, max(CASE WHEN isodow(d) = 5 THEN day(d) END)::INTEGER AS fri
FROM (SELECT d, date_trunc('week', d) AS w FROM {SPAN}) WHERE isodow(d) <= 5 GROUP BY w""", text=["week_start"])
def work_weeks(t: Tables):
    return calendar.work_weeks(calendar.span_of(_orders(t), "day"))


@query(f"""SELECT 'weekly' AS kind, d AS "date" FROM {SPAN} WHERE isodow(d) = 6 UNION ALL SELECT 'daily', d FROM {SPAN} WHERE isodow(d) BETWEEN 2 AND 6""", text=["date"])
def load_days(t: Tables):
    span = calendar.span_of(_orders(t), "day")
    kinds = [dates.load_days(span, k).select(F.lit(k).alias("kind"), "date") for k in ("weekly", "daily")]
    return kinds[0].unionByName(kinds[1])
