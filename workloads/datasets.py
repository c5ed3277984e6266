"""Dataset jobs: whole silver and gold chains over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.plans import datasets
from lakeloom.plans.site_dimension import site_dimension as build_sites
from workloads.quality import DATED, SUITE, _dated_pair
from workloads.registry import Tables, query

c = F.col
M = "decimal(18,2)"


def _raw_claims(t: Tables):
    """Line items of an order as claims: member = customer, provider = supplier, codes = parts."""
    places = F.concat(F.char(c("c_nationkey") + 65), c("c_nationkey") % 10, F.lit("A 1B2"))
    orders = t.orders.join(t.customer, c("o_custkey") == c("c_custkey"))
    lines = t.lineitem.join(orders, c("l_orderkey") == c("o_orderkey")).join(t.supplier, c("l_suppkey") == c("s_suppkey"))
    text = lambda n: c(n).cast("string")
    return lines.select(
        F.concat(F.date_format("o_orderdate", "ddMMyy"), F.lit("-"), "l_orderkey", F.lit("-"), "l_linenumber", F.lit("-"), "l_partkey").alias("reference"),
        F.concat(F.lit(" "), text("l_suppkey"), F.lit(" ")).alias("provider"), F.when(c("l_linestatus") == "O", "N/A").otherwise(text("s_nationkey")).alias("facility"),
        places.alias("member_postal"), F.concat(F.char(c("s_nationkey") + 65), F.lit("0A 3C4")).alias("provider_postal"),
        F.when(c("s_nationkey") < 5, "QQ").when(c("s_nationkey") < 20, "ON").alias("provider_region"), c("l_returnflag").alias("kind"),
        F.when(c("l_tax") < 0.02, "DT").when(c("l_tax") < 0.05, "OS").otherwise("GP").alias("specialty"),
        text("l_partkey").alias("code"), F.when(c("l_discount") > 0.02, text("l_suppkey")).alias("code_paid"),
        F.when(c("l_linestatus") == "F", "Y").otherwise("No").alias("coordinated"), c("o_orderpriority").alias("reason"), c("o_orderstatus").alias("remark"),
        c("l_extendedprice").alias("amount"))


CLAIMS = """
SELECT strftime(o_orderdate, '%d%m%y') || '-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS reference, lpad(l_suppkey::VARCHAR, 9, '0') AS provider,
  CASE WHEN l_linestatus = 'O' THEN '00Unknown' ELSE lpad(s_nationkey::VARCHAR, 9, '0') END AS facility,
  chr(65 + c_nationkey) || c_nationkey % 10 || 'A 1B2' AS member_postal, chr(65 + s_nationkey) || '0A 3C4' AS provider_postal,
  CASE WHEN s_nationkey < 5 THEN 'QQ' WHEN s_nationkey < 20 THEN 'ON' END AS provider_region,
  CASE l_returnflag WHEN 'A' THEN 'Joined' WHEN 'R' THEN 'Single' ELSE 'N' END AS kind,
  CASE WHEN l_tax < 0.02 THEN 'DT' WHEN l_tax < 0.05 THEN 'OS' ELSE 'GP' END AS specialty,
  CASE WHEN length(l_partkey::VARCHAR) >= 5 THEN l_partkey::VARCHAR ELSE lpad(l_partkey::VARCHAR, 5, '0') END AS code,
  CASE WHEN l_discount > 0.02 THEN lpad(l_suppkey::VARCHAR, 5, '0') END AS code_paid, l_linestatus = 'F' AS coordinated, o_orderpriority AS reason, o_orderstatus AS remark,
  l_extendedprice AS amount, CAST(o_orderdate AS DATE) AS claim_date,
  CASE WHEN c_nationkey = 3 THEN 'D3' WHEN c_nationkey < 10 THEN 'low' END AS member_region, CASE WHEN s_nationkey < 10 THEN 'low' END AS facility_region,
  chr(65 + c_nationkey) || c_nationkey % 10 || 'A' AS member_prefix, chr(65 + s_nationkey) || '0A' AS facility_prefix,
  CASE WHEN s_nationkey < 5 THEN 'QQ' ELSE 'CAN' END AS system
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey"""


def _key(code: str) -> str:
    hit = f"specialty = 'OS' AND {code} IN (SELECT code FROM surgical)"
    return f"CASE WHEN {code} IS NULL THEN NULL WHEN specialty = 'DT' THEN {code} || '-DT' WHEN system = 'QQ' OR ({hit}) THEN {code} || '-' || system || '-' || specialty ELSE {code} || '-' || system END"


REFS = """pt AS (SELECT CASE WHEN length(p_partkey::VARCHAR) >= 5 THEN p_partkey::VARCHAR ELSE lpad(p_partkey::VARCHAR, 5, '0') END AS code, p_name, p_size FROM part),
surgical AS (SELECT code FROM pt WHERE p_size > 30)"""
LABELS = "CASE {0} WHEN '1-URGENT' THEN 'now' WHEN 'P' THEN 'partial' END"


@query(f"""WITH {REFS}, cl AS ({CLAIMS})
SELECT cl.*, {_key('code')} AS code_key_submitted, {_key('code_paid')} AS code_key_paid,
  (SELECT p_name FROM pt WHERE pt.code = cl.code) AS description_submitted, (SELECT p_name FROM pt WHERE pt.code = cl.code_paid) AS description_paid,
  {LABELS.format('reason')} AS reason_label, {LABELS.format('remark')} AS remark_label FROM cl""", text=["claim_date"])
def claims_silver(t: Tables):
    from lakeloom.functions.text import zero_pad

    parts = t.part.select(zero_pad(c("p_partkey").cast("string"), 5).alias("code"), c("p_name").alias("description"), "p_size")
    reasons = t.orders.select(F.explode(F.array("o_orderpriority", "o_orderstatus")).alias("reason")).distinct().withColumn(
        "label", F.when(c("reason") == "1-URGENT", "now").when(c("reason") == "P", "partial"))
    regions = {"D3A": "D3"} | {chr(65 + i): "low" for i in range(10)}
    return datasets.claims_silver(_raw_claims(t), parts.where("p_size > 30"), parts, reasons, {"A": "Joined", "R": "Single"}, regions, "QQ", ["DT"], "OS")


@query(f"""SELECT provider, reference, claim_date, member_postal, member_region, member_prefix, q, tax, CAST(coalesce(q, 0) + tax AS DOUBLE) AS total_amount FROM (
SELECT c.*, CASE WHEN kind <> 'N' THEN l_quantity END AS q, l_tax AS tax FROM ({CLAIMS.replace('SELECT strftime', 'SELECT l_quantity, l_tax, strftime', 1)}) c)""", text=["claim_date"])
def funding_silver(t: Tables):
    places = F.concat(F.char(c("c_nationkey") + 65), c("c_nationkey") % 10, F.lit("A 1B2"))
    orders = t.orders.join(t.customer, c("o_custkey") == c("c_custkey"))
    raw = t.lineitem.join(orders, c("l_orderkey") == c("o_orderkey")).select(
        c("l_suppkey").cast("string").alias("provider"),
        F.concat(F.date_format("o_orderdate", "ddMMyy"), F.lit("-"), "l_orderkey", F.lit("-"), "l_linenumber", F.lit("-"), "l_partkey").alias("reference"),
        places.alias("member_postal"), F.when(c("l_returnflag") != "N", c("l_quantity")).alias("q"), c("l_tax").alias("tax"))
    return datasets.funding_silver(raw, ["q", "tax"], {"D3A": "D3"} | {chr(65 + i): "low" for i in range(10)})


@query("""WITH m AS (SELECT year(o_orderdate) AS fy, month(o_orderdate) AS mo, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spent, sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'F') AS benefit,
  count(*) * 400000 AS budget FROM orders GROUP BY ALL)
SELECT CAST(fy AS INTEGER) AS fy, CAST(mo AS INTEGER) AS mo, CAST(sum(spent) OVER w AS DOUBLE) AS spent_to_date, CAST(sum(benefit) OVER w AS DOUBLE) AS benefit_to_date,
  CAST(sum(budget) OVER (PARTITION BY fy) - sum(spent) OVER w AS DOUBLE) AS budget_remaining, CAST(sum(budget) OVER (PARTITION BY fy) - sum(benefit) OVER w AS DOUBLE) AS budget2_remaining
FROM m WINDOW w AS (PARTITION BY fy ORDER BY mo)""")
def contract_cost(t: Tables):
    day, money = c("o_orderdate").cast("date"), c("o_totalprice").cast(M)
    raw = t.orders.groupBy(F.year(day).alias("fy"), F.month(day).alias("mo")).agg(
        F.sum(money).alias("spent"), F.sum(F.when(c("o_orderstatus") == "F", money)).alias("benefit"),
        (F.count(F.lit(1)) * 400000).alias("budget"), (F.count(F.lit(1)) * 400000).alias("budget2"))
    out = datasets.contract_cost(raw, "fy", "mo", {"spent": "budget", "benefit": "budget2"})
    made = ["spent_to_date", "benefit_to_date", "budget_remaining", "budget2_remaining"]
    return out.select("fy", "mo", *[c(x).cast("double").alias(x) for x in made])


@query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS y, o_orderpriority AS geo, 'F' AS specialty, 'Yes' AS direct, coalesce(nullif(count(*) FILTER (WHERE o_orderstatus = 'F'), 0), 0) AS count FROM orders GROUP BY ALL
UNION ALL SELECT CAST(year(o_orderdate) AS INTEGER), o_orderpriority, 'O', 'No', count(*) FILTER (WHERE o_orderstatus = 'O') FROM orders GROUP BY ALL""")
def billing_long(t: Tables):
    wide = t.orders.groupBy(F.year("o_orderdate").alias("y"), c("o_orderpriority").alias("geo")).agg(
        F.nullif(F.count_if(c("o_orderstatus") == "F"), F.lit(0)).alias("F_Direct"), F.count_if(c("o_orderstatus") == "O").alias("O_Non_Direct"),
        F.count(F.lit(1)).alias("TOTAL_Direct"))
    return datasets.billing_long(wide, ["y", "geo"], ["F_Direct", "O_Non_Direct"], ["TOTAL_Direct"])


@query("""WITH a AS (SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Unknown' ELSE c_mktsegment END AS region, CASE WHEN c_acctbal < 0 THEN 'Under 18' WHEN c_acctbal < 5000 THEN '18-64' ELSE '65+' END AS g, c_acctbal FROM customer WHERE c_mktsegment <> 'BUILDING')
SELECT region, age_group, (SELECT count(*) FROM a x WHERE x.region = r.region AND g = age_group) AS population, CASE age_group WHEN '18-64' THEN 18 WHEN '65+' THEN 65 ELSE 0 END AS lowest_age
FROM (SELECT DISTINCT region FROM a) r, (SELECT unnest(['Under 18', '18-64', '65+']) AS age_group)""")
def population_long(t: Tables):
    b = c("c_acctbal")
    wide = t.customer.groupBy(F.when(c("c_mktsegment") != "MACHINERY", c("c_mktsegment")).alias("region")).agg(
        F.count_if(b < 0).alias("Age Under 18"), F.count_if((b >= 0) & (b < 5000)).alias("Age 18-64"), F.count_if(b >= 5000).alias("Age 65+"))
    return datasets.population_long(wide, "region", {"Under 18": 0, "18-64": 18, "65+": 65}, "BUILDING", prefix="Age ")


@query("""SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority AS language, CASE o_orderpriority WHEN '5-LOW' THEN 'bas' ELSE o_orderpriority END AS language_2,
round_even(count(*) * 30 / 60, 1) AS wait_minutes, round_even(count(DISTINCT o_custkey) * 45 / 60, 1) AS talk_minutes FROM orders GROUP BY ALL""", text=["day"])
def contact_centre(t: Tables):
    raw = t.orders.groupBy(c("o_orderdate").cast("date").alias("day"), c("o_orderpriority").alias("language")).agg(
        (F.count(F.lit(1)) * 30).alias("wait"), (F.count_distinct("o_custkey") * 45).alias("talk"))
    return datasets.contact_centre(raw, ["wait", "talk"], "language", {"5-LOW": "bas"})


@query("""WITH p AS (SELECT c_nationkey AS number, min(c_custkey) AS member FROM customer WHERE c_mktsegment <> 'MACHINERY' GROUP BY ALL),
j AS (SELECT s_suppkey AS number_s, s_nationkey AS number, CASE WHEN s_acctbal > 5000 THEN 'B' ELSE 'A' END AS tier FROM supplier)
SELECT number, member, min(tier) AS tier FROM j JOIN p USING (number) GROUP BY number, member""")
def copay_tiers(t: Tables):
    tiers = t.supplier.select(c("s_nationkey").alias("number"), F.when(c("s_acctbal") > 5000, "B").otherwise("A").alias("tier"))
    people = t.customer.where("c_mktsegment <> 'MACHINERY'").select(c("c_nationkey").alias("number"), c("c_custkey").alias("member"))
    return datasets.copay_tiers(tiers, people, "number", "member", ["tier"])


@query("""WITH r AS (SELECT o_orderpriority AS doc, o_orderkey AS seq, CASE WHEN o_orderstatus <> 'P' THEN 'd' || o_orderkey END AS description, lpad((o_custkey % 100000)::VARCHAR, 5, '0') AS one,
  CASE WHEN o_totalprice > 250000 THEN lpad((o_orderkey % 100000)::VARCHAR, 5, '0') || ' DT ' || lpad((o_custkey % 100000)::VARCHAR, 5, '0') || '  OS more' END AS two,
  CASE WHEN o_totalprice > 50000 THEN 'Y' END AS a, CASE WHEN o_totalprice < 200000 THEN 'Y' END AS b FROM orders WHERE o_totalprice > 50000 OR o_totalprice < 200000),
f AS (SELECT doc, seq, one, CASE WHEN one < '00300' THEN NULL ELSE one END AS first_code, two, concat_ws('|', CASE WHEN a IS NOT NULL THEN 'a' END, CASE WHEN b IS NOT NULL THEN 'b' END) AS schedule,
  count(description) OVER w AS procedure, last_value(description IGNORE NULLS) OVER w AS description FROM r WINDOW w AS (PARTITION BY doc ORDER BY seq)),
x AS (SELECT *, unnest(CASE WHEN two IS NULL THEN [NULL] ELSE [substr(two, 1, 8), substr(two, 10, 5) || ' OS'] END) AS second_code FROM f),
y AS (SELECT *, first_code AS code, 'ONE' AS system FROM x WHERE second_code IS NULL UNION ALL SELECT *, second_code, 'TWO' FROM x WHERE first_code IS NULL
  UNION ALL SELECT *, second_code, 'TWO' FROM x WHERE first_code IS NOT NULL AND second_code IS NOT NULL
  UNION ALL (SELECT *, first_code, 'ONE' FROM x WHERE first_code IS NOT NULL AND second_code IS NOT NULL QUALIFY row_number() OVER (PARTITION BY seq ORDER BY doc, second_code) = 1)),
z AS (SELECT *, split_part(code, ' ', 1) AS base, nullif(split_part(code, ' ', 2), '') AS spec FROM y),
k AS (SELECT *, CASE WHEN base IS NULL THEN NULL WHEN spec = 'DT' THEN base || '-DT' WHEN system = 'TWO' OR spec = 'OS' THEN base || '-' || system || '-' || spec ELSE base || '-' || system END AS code_key FROM z)
SELECT k.seq, k.code, k.system, k.base AS code_base, k.spec AS specialty, k.code_key, k.schedule, CAST(k.procedure AS BIGINT) AS procedure, CASE WHEN k.two IS NOT NULL THEN 'more' END AS notes,
  coalesce(CASE WHEN p_size > 40 THEN p_name END, k.description) AS description, CASE WHEN s_acctbal > 5000 THEN DATE '2024-11-01' END AS exception_start, DATE '2024-01-01' AS start_date, DATE '9999-12-31' AS end_date
FROM (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY code_key ORDER BY doc, seq, system, code NULLS FIRST) = 1) k
LEFT JOIN part ON code = lpad(p_partkey::VARCHAR, 5, '0') AND p_size > 40 LEFT JOIN supplier ON code = lpad(s_suppkey::VARCHAR, 5, '0') AND s_acctbal > 5000""",
       text=["exception_start", "start_date", "end_date"])
def code_reference(t: Tables):
    price, five = c("o_totalprice"), lambda n: F.lpad((c(n) % 100000).cast("string"), 5, "0")
    raw = t.orders.select(
        c("o_orderpriority").alias("doc"), c("o_orderkey").alias("seq"), F.when(c("o_orderstatus") != "P", F.concat(F.lit("d"), "o_orderkey")).alias("description"),
        F.when(five("o_custkey") >= "00300", five("o_custkey")).alias("one"),
        F.when(price > 250000, F.concat(five("o_orderkey"), F.lit(" DT "), five("o_custkey"), F.lit("  OS more"))).alias("two"),
        F.when(price > 50000, "Y").alias("a"), F.when(price < 200000, "Y").alias("b"))
    replaced = t.part.where("p_size > 40").select(F.lpad(c("p_partkey").cast("string"), 5, "0").alias("code"), c("p_name").alias("description"))
    starts = t.supplier.where("s_acctbal > 5000").select(F.lpad(c("s_suppkey").cast("string"), 5, "0").alias("code"), F.lit("2024-11-01").cast("date").alias("starts"))
    out = datasets.code_reference(raw, "doc", "seq", ["a", "b"], "one", "two", replaced, starts, ("ONE", "TWO"), ["DT"], "OS")
    return out.select("seq", "code", "system", "code_base", "specialty", "code_key", "schedule", "procedure", "notes", "description", "exception_start", "start_date", "end_date")


@query("""WITH m AS (SELECT o_orderkey AS id, o_custkey AS client, o_orderpriority AS unit, date_trunc('month', o_orderdate)::DATE AS eff, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE - 10 END AS app,
  o_orderdate::DATE - 8000 AS birth, o_orderdate::DATE AS elig, o_orderdate::DATE AS cs, CASE WHEN o_orderstatus <> 'O' THEN o_orderdate::DATE + 365 END AS ce, o_totalprice > 100000 AS enrolled FROM orders),
a AS (SELECT *, CAST(8 + (app IS NOT NULL)::INT + (ce IS NOT NULL)::INT AS INTEGER) AS filled FROM m),
b AS (SELECT *, rank() OVER (PARTITION BY client ORDER BY eff, app NULLS FIRST, filled DESC, elig) AS r FROM a), s AS (SELECT *, count(*) OVER (PARTITION BY client, r) AS size FROM b),
e AS (SELECT *, first_value(CASE WHEN size = 1 THEN unit END IGNORE NULLS) OVER (PARTITION BY client ORDER BY eff, app NULLS FIRST, filled DESC, elig, unit, cs, ce NULLS FIRST, id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM s),
f AS (SELECT *, CASE WHEN size > 1 AND unit = nxt THEN r + 1 ELSE r END AS r2 FROM e), g AS (SELECT *, row_number() OVER (PARTITION BY client, r2 ORDER BY unit, cs, ce NULLS FIRST, id) AS n FROM f)
SELECT id, client, unit, CASE WHEN n = 1 THEN client || '-' || r2 ELSE client || '-' || r2 || '-' || n END AS member_key, CASE WHEN c_acctbal > 5000 THEN 'B' ELSE 'A' END AS tier,
  CASE WHEN (r2, n) = max((r2, n)) OVER (PARTITION BY client) THEN 1 ELSE 0 END AS current_client, CASE WHEN (r2, n) = max((r2, n)) OVER (PARTITION BY unit) THEN 1 ELSE 0 END AS current_unit,
  CASE WHEN eff = max(eff) OVER (PARTITION BY unit) THEN 1 ELSE 0 END AS current_record,
  CASE WHEN enrolled AND ((cs <= DATE '1999-01-01' AND DATE '1999-01-01' <= ce) OR ce IS NULL) THEN 1 ELSE 0 END AS covered, CAST(floor((DATE '1999-01-01' - birth) / 365.25) AS BIGINT) AS age_now,
  CAST(coalesce(floor((app - birth) / 365.25), floor((elig - birth) / 365.25)) AS BIGINT) AS age_applied
FROM g JOIN customer ON client = c_custkey""")
def gold_members(t: Tables):
    day = c("o_orderdate").cast("date")
    raw = t.orders.select(
        c("o_orderkey").alias("coverage_id"), c("o_custkey").alias("client"), c("o_orderpriority").alias("unit"), F.trunc(day, "month").alias("effective_date"), day.alias("end_date"),
        F.when(c("o_orderstatus") != "P", F.date_sub(day, 10)).alias("applied_on"), day.alias("eligible_on"), F.date_sub(day, 8000).alias("birth_date"),
        day.alias("coverage_start"), F.when(c("o_orderstatus") != "O", F.date_add(day, 365)).alias("coverage_end"), (c("o_totalprice") > 100000).alias("enrolled"))
    tiers = t.customer.select(c("c_custkey").alias("client"), F.when(c("c_acctbal") > 5000, "B").otherwise("A").alias("tier"))
    out = datasets.gold_members(raw, tiers, F.lit("1999-01-01").cast("date"), tie=["unit", "coverage_start", "coverage_end", "coverage_id"])
    return out.select(c("coverage_id").alias("id"), "client", "unit", "member_key", "tier", "current_client", "current_unit", "current_record", "covered", "age_now", "age_applied")


LINES = """(SELECT l_orderkey || '.' || l_linenumber || '.' || l_partkey AS claim, l_suppkey AS provider, l_linenumber AS site, o_custkey AS member, l_returnflag AS kind, l_linestatus AS region, CAST(l_quantity AS INTEGER) AS age,
  l_shipdate::DATE AS service_date, o_orderdate::DATE AS claim_date FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


@query(f"""SELECT claim, provider || '-' || site AS uid, first_value(kind) OVER (PARTITION BY provider ORDER BY service_date DESC, claim_date DESC, kind DESC) AS current_kind,
first_value(region) OVER m AS latest_region, first_value(age) OVER m AS latest_age, CASE WHEN c_acctbal > 5000 THEN 'B' ELSE 'A' END AS tier, CASE WHEN site < 5 THEN site > 2 END AS valid, CASE WHEN site < 5 THEN site > 3 END AS active
FROM {LINES} JOIN customer ON member = c_custkey WINDOW m AS (PARTITION BY member ORDER BY service_date DESC, claim DESC)""")
def gold_claims(t: Tables):
    claims = t.lineitem.join(t.orders, c("l_orderkey") == c("o_orderkey")).select(
        F.concat_ws(".", "l_orderkey", "l_linenumber", "l_partkey").alias("claim"), c("l_suppkey").alias("provider"), c("l_linenumber").alias("site"), c("o_custkey").alias("member"),
        c("l_returnflag").alias("kind"), c("l_linestatus").alias("region"), c("l_quantity").cast("int").alias("age"), c("l_shipdate").cast("date").alias("service_date"), c("o_orderdate").cast("date").alias("claim_date"))
    tiers = t.customer.select(c("c_custkey").alias("member"), F.when(c("c_acctbal") > 5000, "B").otherwise("A").alias("tier"))
    sites = t.lineitem.where("l_linenumber < 5").select("l_suppkey", "l_linenumber").distinct().select(
        F.concat_ws("-", "l_suppkey", "l_linenumber").alias("uid"), (c("l_linenumber") > 2).alias("valid"), (c("l_linenumber") > 3).alias("active"))
    return datasets.gold_claims(claims, tiers, sites).select("claim", "uid", "current_kind", "latest_region", "latest_age", "tier", "valid", "active")


@query("""WITH e AS (SELECT l_orderkey || '.' || l_linenumber || '.' || l_partkey AS estimate, o_custkey AS member, 'C' || l_suppkey AS code, l_returnflag AS tooth, l_linestatus AS surface, l_linenumber, l_suppkey,
  CASE WHEN l_tax > 0.02 THEN 'Required' ELSE 'None' END AS indicator, o_orderdate::DATE AS asked, CASE WHEN l_discount < 0.08 THEN l_shipdate::DATE - 60 END AS decided,
  CASE WHEN l_quantity > 30 THEN l_extendedprice WHEN l_quantity > 10 THEN 0.0 END AS paid, o_orderpriority AS reason, o_orderstatus AS remark, l_shipdate::DATE AS service_date FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
w AS (SELECT *, row_number() OVER k AS n, lag(decided) OVER k AS prev, first_value(surface) OVER (PARTITION BY member ORDER BY service_date DESC, estimate DESC) AS latest_region FROM e WINDOW k AS (PARTITION BY member, code, tooth, surface ORDER BY asked, estimate))
SELECT estimate, CASE WHEN indicator = 'Required' AND n > 1 AND asked >= prev THEN n - 1 ELSE 0 END AS resubmission,
  CASE WHEN code LIKE 'C1%' THEN 'one' WHEN code LIKE 'C2%' OR code LIKE 'C31%' THEN 'two' ELSE 'Others' END AS code_group,
  CASE WHEN paid > 0 THEN 'Approved' WHEN paid = 0 AND (reason IN ('1-URGENT', 'P') OR remark IN ('1-URGENT', 'P')) THEN 'Incomplete' WHEN paid = 0 THEN 'Declined' ELSE 'Other' END AS outcome,
  l_suppkey || '-' || l_linenumber AS uid, latest_region, CASE WHEN c_acctbal > 5000 THEN 'B' ELSE 'A' END AS tier FROM w JOIN customer ON member = c_custkey""")
def gold_estimates(t: Tables):
    q = c("l_quantity")
    raw = t.lineitem.join(t.orders, c("l_orderkey") == c("o_orderkey")).select(
        F.concat_ws(".", "l_orderkey", "l_linenumber", "l_partkey").alias("estimate"), c("o_custkey").alias("member"), F.concat(F.lit("C"), "l_suppkey").alias("code"),
        c("l_returnflag").alias("tooth"), c("l_linestatus").alias("surface"), c("l_suppkey").alias("provider"), c("l_linenumber").alias("site"), c("l_linestatus").alias("region"),
        F.when(c("l_tax") > 0.02, "Required").otherwise("None").alias("indicator"), c("o_orderdate").cast("date").alias("asked"),
        F.when(c("l_discount") < 0.08, F.date_sub(c("l_shipdate").cast("date"), 60)).alias("decided"),
        F.when(q > 30, c("l_extendedprice")).when(q > 10, 0.0).alias("paid"), c("o_orderpriority").alias("reason"), c("o_orderstatus").alias("remark"), c("l_shipdate").cast("date").alias("service_date"))
    tiers = t.customer.select(c("c_custkey").alias("member"), F.when(c("c_acctbal") > 5000, "B").otherwise("A").alias("tier"))
    out = datasets.gold_estimates(raw, [("one", ["C1"]), ("two", ["C2", "C31"])], ["1-URGENT", "P"], tiers)
    return out.select("estimate", "resubmission", "code_group", "outcome", "uid", "latest_region", "tier")


SITE_FACTS = """f AS (SELECT l_suppkey::VARCHAR AS member, l_linenumber::VARCHAR AS site, chr(65 + s_nationkey) || (s_nationkey % 10) || 'A' AS prefix, n_name AS region,
  CASE l_returnflag WHEN 'A' THEN 'Participating' WHEN 'R' THEN 'Per claim' ELSE 'Mixed' END AS kind, CASE l_linestatus WHEN 'O' THEN 'General' ELSE 'Surgeon' END AS specialty,
  l_shipdate::DATE AS service_date, l_shipdate::DATE + 20 AS submitted_date, CASE WHEN s_acctbal > 2000 THEN l_extendedprice ELSE 0 END AS paid, CASE WHEN s_acctbal < 0 THEN l_tax ELSE 0 END AS coord
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE s_nationkey < 18),
r AS (SELECT s_suppkey::VARCHAR AS member, 'Surgeon' AS specialty, n_name AS region, chr(65 + s_nationkey) || (s_nationkey % 10) || 'A' AS prefix, CASE WHEN s_nationkey <> 7 THEN DATE '1996-05-05' END AS joined_on,
  CASE WHEN s_acctbal > 4000 THEN 'Y' ELSE 'N' END AS enrolled, CASE WHEN s_nationkey < 12 THEN 'English' ELSE 'French' END AS language, DATE '2002-02-02' AS left_on
  FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_nationkey > 5)"""


@query(f"""WITH {SITE_FACTS}, one AS (SELECT *, member || '-' || site AS uid FROM f QUALIFY row_number() OVER (PARTITION BY member, site ORDER BY service_date DESC, submitted_date DESC, kind DESC, region DESC, prefix DESC, specialty DESC) = 1),
per AS (SELECT member, max(service_date) AS last_service, min(CASE WHEN submitted_date >= DATE '1996-01-01' THEN submitted_date ELSE DATE '1996-01-01' END) AS first_claim,
  CASE WHEN sum(paid::DECIMAL(18,2)) > 0 OR sum(coord::DECIMAL(18,2)) > 0 THEN 'Y' ELSE 'N' END AS paid_status FROM f GROUP BY member),
u AS (SELECT one.uid, one.member, one.site, one.prefix, one.region, one.kind, one.specialty, last_service, first_claim, paid_status, r.joined_on, r.enrolled, r.language, CAST(NULL AS DATE) AS left_on FROM one JOIN per USING (member) LEFT JOIN r USING (member)
  UNION ALL SELECT member || '-0', member, '0', prefix, region, NULL, specialty, NULL, NULL, NULL, joined_on, enrolled, language, left_on FROM r WHERE member NOT IN (SELECT member FROM f)),
v AS (SELECT * REPLACE (CASE WHEN kind = 'Per claim' THEN first_claim WHEN kind = 'Participating' AND joined_on IS NULL THEN first_claim ELSE joined_on END AS joined_on,
  CASE WHEN enrolled = 'Y' AND kind IS NULL THEN 'Participating' WHEN enrolled = 'N' AND kind IS NULL THEN 'Unknown' ELSE kind END AS kind) FROM u)
SELECT uid, v.member, site, prefix, CASE region WHEN 'NATION_3' THEN 'N3' ELSE region END AS region, CASE WHEN substr(prefix, 2, 1) = '0' THEN 'Rural' ELSE 'Urban' END AS area, kind,
  CASE v.specialty WHEN 'General' THEN 'GP' WHEN 'Surgeon' THEN 'OS' END AS specialty, joined_on, last_service, coalesce(paid_status, CASE WHEN kind IN ('Participating', 'Unknown') THEN 'N' END) AS paid_status, language, left_on,
  CASE WHEN c_acctbal > 0 THEN c_name END AS school, CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS school_specialty, prefix || '-' || CASE v.specialty WHEN 'General' THEN 'GP' ELSE 'OS' END AS billing_key,
  coalesce(kind IN ('Participating', 'Per claim'), FALSE) AS valid, coalesce(kind = 'Participating', FALSE) AS active,
  CASE language WHEN 'English' THEN 'anglais' WHEN 'French' THEN 'français' END AS language_2, CASE WHEN substr(prefix, 2, 1) = '0' THEN 'rurale' ELSE 'urbaine' END AS area_2
FROM v LEFT JOIN customer ON v.member = c_custkey::VARCHAR""", text=["joined_on", "last_service", "left_on"])
def site_dimension(t: Tables):
    prefix = F.concat(F.char(c("s_nationkey") + 65), c("s_nationkey") % 10, F.lit("A"))
    suppliers = t.supplier.join(t.nation, c("s_nationkey") == c("n_nationkey"))
    flag, day = c("l_returnflag"), c("l_shipdate").cast("date")
    facts = t.lineitem.join(suppliers, c("l_suppkey") == c("s_suppkey")).select(
        c("l_suppkey").cast("string").alias("member"), c("l_linenumber").cast("string").alias("site"), prefix.alias("prefix"), c("n_name").alias("region"),
        F.when(flag == "A", "Participating").when(flag == "R", "Per claim").otherwise("Mixed").alias("kind"),
        F.when(c("s_nationkey") >= 18, "Office").when(c("l_linestatus") == "O", "General").otherwise("Surgeon").alias("specialty"),
        day.alias("service_date"), F.date_add(day, 20).alias("submitted_date"),
        F.when(c("s_acctbal") > 2000, c("l_extendedprice")).otherwise(0).alias("paid"), F.when(c("s_acctbal") < 0, c("l_tax")).otherwise(0).alias("coordinated"))
    roster = suppliers.where("s_nationkey > 5").select(
        c("s_suppkey").cast("string").alias("member"), F.lit("Surgeon").alias("specialty"), c("n_name").alias("region"), prefix.alias("prefix"),
        F.when(c("s_nationkey") != 7, F.lit("1996-05-05").cast("date")).alias("joined_on"), F.when(c("s_acctbal") > 4000, "Y").otherwise("N").alias("enrolled"),
        F.when(c("s_nationkey") < 12, "English").otherwise("French").alias("language"), F.lit("2002-02-02").cast("date").alias("snapshot_date"))
    mapping = t.customer.where("c_acctbal > 0").select(c("c_custkey").cast("string").alias("member"), c("c_name").alias("school"), c("c_mktsegment").alias("school_specialty"))
    return build_sites(facts, roster, mapping, "1996-01-01", "Office", {"General": "GP", "Surgeon": "OS"}, {"NATION_3": "N3"},
                       {"language": {"English": "anglais", "French": "français"}, "area": {"Urban": "urbaine", "Rural": "rurale"}})


@query("""SELECT lpad(s_suppkey::VARCHAR, 9, '0') AS provider, CASE WHEN s_acctbal > 5000 THEN 'GP' ELSE 'Unknown' END AS specialty, chr(65 + s_nationkey) || s_nationkey % 10 || 'A 1B1' AS postal,
  CASE WHEN s_nationkey < 8 THEN TRUE WHEN s_nationkey < 16 THEN FALSE END AS direct, CASE WHEN s_nationkey = 3 THEN 'D3' WHEN s_nationkey < 10 THEN 'low' END AS region,
  chr(65 + s_nationkey) || s_nationkey % 10 || 'A' AS prefix, CASE WHEN s_nationkey % 10 = 0 THEN 'Rural' ELSE 'Urban' END AS area, DATE '2024-05-01' AS snapshot, TRUE AS enrolled FROM supplier""", text=["snapshot"])
def roster_silver(t: Tables):
    n = c("s_nationkey")
    raw = t.supplier.select(
        F.concat(F.lit(" "), "s_suppkey").alias("provider"), F.when(c("s_acctbal") > 5000, "General Practitioner").otherwise(" ").alias("specialty"),
        F.concat(F.char(n + 65), n % 10, F.lit("A 1B1 ")).alias("postal"), F.when(n < 8, "Yes").when(n < 16, "N").otherwise("?").alias("direct"))
    return datasets.roster_silver(raw, F.lit("2024-05-01").cast("date"), {"D3A": "D3"} | {chr(65 + i): "low" for i in range(10)}, {"General Practitioner": "GP"})


@query("""SELECT o_orderstatus AS status, CASE o_orderpriority WHEN '5-LOW' THEN 'Unknown' ELSE o_orderpriority END AS priority, CASE o_orderstatus WHEN 'F' THEN 'fini' ELSE o_orderstatus END AS status_2,
  CASE o_orderpriority WHEN '5-LOW' THEN 'Inconnu' ELSE o_orderpriority END AS priority_2, CASE WHEN o_totalprice > 300000 THEN 'web' WHEN o_totalprice > 100000 THEN 'mail' END AS channel, count(*) AS n
FROM orders GROUP BY ALL""")
def applications_silver(t: Tables):
    p = c("o_totalprice")
    raw = t.orders.select(c("o_orderstatus").alias("status"), F.when(c("o_orderpriority") != "5-LOW", c("o_orderpriority")).alias("priority"),
                          F.when(p > 300000, "web").alias("online"), F.when(p > 100000, "mail").alias("paper"))
    out = datasets.applications_silver(raw, ["status", "priority"], {"F": "fini", "Unknown": "Inconnu"}, ["online", "paper"])
    return out.groupBy(*out.columns).agg(F.count(F.lit(1)).alias("n"))


POSTAL = """(SELECT chr(65 + c_nationkey) || c_custkey % 10 || chr(65 + CAST(c_custkey % 20 AS INTEGER)) AS prefix, c_custkey % 10 AS d, c_nationkey, n_name, c_custkey, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0)"""


@query(f"""SELECT 'code' AS part, prefix || ' 1B' || c_custkey % 7 AS code, c_nationkey::VARCHAR AS region, n_name AS region_name, CASE WHEN d = 0 THEN 'Rural' ELSE 'Urban' END AS area, coalesce(nullif(c_mktsegment, 'BUILDING'), 'Unknown') AS place FROM {POSTAL}
UNION ALL SELECT DISTINCT 'prefix', prefix, c_nationkey::VARCHAR, n_name, CASE WHEN d = 0 THEN 'Rural' ELSE 'Urban' END, NULL FROM {POSTAL}""")
def postal_silver(t: Tables):
    k = c("c_custkey")
    raw = t.customer.select(
        F.concat(F.char(c("c_nationkey") + 65), k % 10, F.char(k % 20 + 65), F.lit("1B"), k % 7).alias("postal"), c("c_nationkey").cast("string").alias("region"),
        F.when(c("c_acctbal") > 0, "1").otherwise("0").alias("status"), F.when(c("c_mktsegment") != "BUILDING", c("c_mktsegment")).alias("place"))
    named = t.nation.select(c("n_nationkey").cast("string").alias("region"), c("n_name").alias("region_name"))
    codes, prefixes = datasets.postal_silver(raw, "1", named)
    a = codes.withColumnRenamed("postal", "code").withColumn("part", F.lit("code"))
    return a.unionByName(prefixes.withColumnRenamed("prefix", "code").withColumns({"part": F.lit("prefix"), "place": F.lit(None).cast("string")}))


@query("""SELECT *, CASE WHEN eligible = 1 AND enrolled_on IS NOT NULL THEN 1 ELSE 0 END AS enrolled FROM (SELECT *, CASE WHEN empty_period <> 1 AND kind IN ('view', 'click') THEN 1 ELSE 0 END AS eligible FROM (
SELECT event_id AS id, event_type AS kind, CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS DATE) AS applied_on, CASE WHEN value > 20 THEN CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS DATE) END AS enrolled_on,
  CASE WHEN user_id < 100 THEN 'h' ELSE 'm' END AS street, CASE WHEN user_id < 50 THEN 'Ontario' WHEN user_id < 100 THEN 'QC' ELSE 'Unknown' END AS region, CASE WHEN user_id < 100 THEN 'Home' ELSE 'Mailing' END AS address_kind,
  CASE WHEN value < 40 THEN 1 ELSE 0 END AS empty_period FROM events))""", text=["applied_on", "enrolled_on"])
def members_silver(t: Tables):
    u, at = c("user_id"), c("ts").cast("timestamp")
    day = c("ts").cast("date")
    raw = t.events.select(
        c("event_id").alias("id"), c("event_type").alias("kind"), F.lit("h").alias("home_street"), F.when(u < 50, "ON").when(u < 100, "QC").alias("home_region"),
        F.lit("m").alias("mail_street"), F.lit(" ").alias("mail_region"), at.alias("applied_at"), F.when(c("value") > 20, at).alias("enrolled_at"),
        day.alias("coverage_start"), F.when(c("value") < 40, day).alias("coverage_end"))
    out = datasets.members_silver(raw, "America/New_York", {"ON": "Ontario"}, ["view", "click"])
    return out.select("id", "kind", "applied_on", "enrolled_on", "street", "region", "address_kind", "empty_period", "eligible", "enrolled")


@query("""SELECT strftime(o_orderdate, '%Y-%m') AS month, 'new' AS kind, count(*) FILTER (WHERE o_orderstatus = 'O') AS count FROM orders GROUP BY 1
UNION ALL SELECT strftime(o_orderdate, '%Y-%m'), 'renewed', count(*) FILTER (WHERE o_orderstatus = 'F') FROM orders GROUP BY 1""")
def wide_counts(t: Tables):
    wide = t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        F.count_if(c("o_orderstatus") == "O").alias("new"), F.count_if(c("o_orderstatus") == "F").alias("renewed"), F.count(F.lit(1)).alias("total"))
    return datasets.wide_counts(wide, ["month"], ["new", "renewed"], ["total"])


@query(f"""SELECT claim, provider || '-' || site AS uid, first_value(region) OVER m AS latest_region, CASE WHEN site < 5 THEN site > 2 END AS valid, CASE WHEN site < 5 THEN site > 3 END AS active, CASE WHEN c_acctbal > 5000 THEN 'B' ELSE 'A' END AS tier
FROM {LINES} JOIN customer ON member = c_custkey WINDOW m AS (PARTITION BY member ORDER BY claim_date DESC, claim DESC)""")
def gold_funding(t: Tables):
    rows = t.lineitem.join(t.orders, c("l_orderkey") == c("o_orderkey")).select(
        F.concat_ws(".", "l_orderkey", "l_linenumber", "l_partkey").alias("claim"), c("l_suppkey").alias("provider"), c("l_linenumber").alias("site"),
        c("o_custkey").alias("member"), c("l_linestatus").alias("region"), c("o_orderdate").cast("date").alias("claim_date"))
    tiers = t.customer.select(c("c_custkey").alias("member"), F.when(c("c_acctbal") > 5000, "B").otherwise("A").alias("tier"))
    sites = t.lineitem.where("l_linenumber < 5").select("l_suppkey", "l_linenumber").distinct().select(
        F.concat_ws("-", "l_suppkey", "l_linenumber").alias("uid"), (c("l_linenumber") > 2).alias("valid"), (c("l_linenumber") > 3).alias("active"))
    return datasets.gold_funding(rows, sites, tiers).select("claim", "uid", "latest_region", "valid", "active", "tier")


@query("""SELECT CASE WHEN p_type <> 'PROMO' THEN 'In list' ELSE 'Not in list' END AS list_tag, CASE WHEN p_type <> 'PROMO' THEN l_partkey::VARCHAR WHEN p_size <= 25 THEN 'S' || p_size ELSE 'Unknown' END AS resolved,
  l_returnflag AS specialty, count(*) AS n_rows, CAST(sum(l_extendedprice::DECIMAL(18,2)) AS DOUBLE) AS amount, count(DISTINCT l_partkey) AS n_codes
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag <> 'N' AND l_extendedprice > 20000 GROUP BY ALL""")
def code_investigation(t: Tables):
    code = lambda k: c(k).cast("string").alias("code")
    claims = t.lineitem.select(code("l_partkey"), c("l_returnflag").alias("specialty"), F.when(c("l_extendedprice") > 20000, c("l_extendedprice")).otherwise(0).alias("paid"))
    stand_ins = t.part.where("p_size <= 25").select(code("p_partkey"), F.concat(F.lit("S"), "p_size").alias("dummy"))
    out = datasets.code_investigation(claims, t.part.where("p_type <> 'PROMO'").select(code("p_partkey")), stand_ins, "N")
    return out.withColumn("amount", c("amount").cast("double"))


@query("""SELECT lpad(o_orderkey::VARCHAR, 9, '0') AS id, CASE o_orderstatus WHEN 'F' THEN 'Final' ELSE 'Unknown' END AS status, k AS amount_type, CAST(v AS DOUBLE) AS amount FROM (
SELECT o_orderkey, o_orderstatus, 'price' AS k, CASE WHEN o_orderpriority <> '5-LOW' THEN floor(o_totalprice) END AS v FROM orders UNION ALL SELECT o_orderkey, o_orderstatus, 'fee', CASE WHEN o_orderpriority = '2-HIGH' THEN 0 ELSE 5 END FROM orders)
WHERE (v IS NULL OR v <> 0) AND o_orderstatus <> 'P'""")
def clean_for_comparison(t: Tables):
    from lakeloom.plans.reconciliation import Cleaning, clean

    p = c("o_orderpriority")
    raw = t.orders.select(
        F.concat(F.lit(" "), "o_orderkey", F.lit(".0")).alias("order  id"), F.when(c("o_orderstatus") == "O", "n/a").otherwise(c("o_orderstatus")).alias("order status"),
        F.when(p == "5-LOW", "null").otherwise(F.format_number(F.floor("o_totalprice"), 0)).alias("price"), F.when(p == "2-HIGH", "0").otherwise("5").alias("fee"), F.lit("x").alias("junk"))
    raw = raw.where(c("order status") != "P")
    how = Cleaning(renames={"order id": "id", "order status": "status"}, melt_ids=["id", "status"], melt_values=["price", "fee"], pad={"id": 9},
                   values={"status": {"F": "Final"}}, unknown={"status": "Unknown"}, types={"amount": "double"}, blacklist={"status": ["VOID"]}, drop=["junk"])
    return clean(raw, how)


@query(DATED + SUITE.format(a="da", b="db"))
def reconciliation_reports(t: Tables):
    """The report tables of two extracts, appended as text; the metrics read back."""
    from lakeloom.plans.reconciliation import keep_reports, reports
    from lakeloom.session import scratch

    path = scratch(t.spark, "reports")
    keep_reports(reports(*_dated_pair(t), "load"), path, "orders", "2024-05-04")
    return t.spark.read.parquet(f"{path}/metrics").where("report_key = 'orders_2024-05-04'").select("metric", "result")



@query(f"""WITH {REFS} SELECT CAST(l_orderkey AS VARCHAR) AS estimate, lpad(l_suppkey::VARCHAR, 9, '0') AS provider, lpad(l_linenumber::VARCHAR, 9, '0') AS facility,
  CASE WHEN length(l_partkey::VARCHAR) >= 5 THEN l_partkey::VARCHAR ELSE lpad(l_partkey::VARCHAR, 5, '0') END AS code, chr(65 + s_nationkey) || '1A 2B3' AS member_postal,
  CASE WHEN s_nationkey < 5 THEN 'QQ' ELSE 'ON' END AS provider_region, l_shipdate::DATE AS asked, l_shipdate::DATE + 9 AS decided, l_returnflag AS reason, l_linestatus AS remark,
  CASE WHEN s_nationkey < 10 THEN 'low' END AS member_region, chr(65 + s_nationkey) || '1A' AS member_prefix, CASE WHEN s_nationkey < 5 THEN 'QQ' ELSE 'CAN' END AS system,
  (SELECT p_name FROM pt WHERE pt.code = CASE WHEN length(l_partkey::VARCHAR) >= 5 THEN l_partkey::VARCHAR ELSE lpad(l_partkey::VARCHAR, 5, '0') END) AS description,
  CASE l_returnflag WHEN 'A' THEN 'agreed' END AS reason_label, CASE l_linestatus WHEN 'A' THEN 'agreed' END AS remark_label
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""", text=["asked", "decided"])
def estimates_silver(t: Tables):
    day = lambda n: F.date_format(n, "yyyy-MM-dd")
    raw = t.lineitem.join(t.supplier, c("l_suppkey") == c("s_suppkey")).select(
        c("l_orderkey").cast("string").alias("estimate"), F.concat(F.lit(" "), "l_suppkey").alias("provider"), c("l_linenumber").cast("string").alias("facility"),
        c("l_partkey").cast("string").alias("code"), F.concat(F.char(c("s_nationkey") + 65), F.lit("1A 2B3")).alias("member_postal"),
        F.when(c("s_nationkey") < 5, "QQ").otherwise("ON").alias("provider_region"), day("l_shipdate").alias("asked"), day(F.date_add(c("l_shipdate").cast("date"), 9)).alias("decided"),
        c("l_returnflag").alias("reason"), c("l_linestatus").alias("remark"))
    names_ = t.part.select(F.when(F.length(c("p_partkey").cast("string")) >= 5, c("p_partkey").cast("string")).otherwise(F.lpad(c("p_partkey").cast("string"), 5, "0")).alias("code"), c("p_name").alias("description"))
    reasons = t.spark.createDataFrame([("A", "agreed")], "reason string, label string")
    return datasets.estimates_silver(raw, names_, reasons, {chr(65 + i): "low" for i in range(10)}, "QQ")


@query("""SELECT o_orderpriority AS reason_code, arg_min(o_orderstatus, (o_orderdate, o_orderkey)) AS label FROM orders GROUP BY ALL""")
def reason_codes(t: Tables):
    return datasets.reason_codes(t.orders, "o_orderpriority", ["o_orderdate", "o_orderkey"], {"o_orderpriority": "reason_code", "o_orderstatus": "label"})


@query("""SELECT CASE WHEN length(p_partkey::VARCHAR) >= 5 THEN p_partkey::VARCHAR ELSE lpad(p_partkey::VARCHAR, 5, '0') END AS code, p_name AS description FROM part""")
def procedure_descriptions(t: Tables):
    return datasets.procedure_descriptions(t.part.withColumn("p_partkey", c("p_partkey").cast("string")), "p_partkey", {"p_partkey": "code", "p_name": "description"})


@query("""SELECT c_custkey AS account, CAST(coalesce(CASE WHEN c_acctbal > 0 THEN c_nationkey END, 0) + c_nationkey + c_custkey AS BIGINT) AS cost FROM customer""")
def administration_cost(t: Tables):
    raw = t.customer.select("c_custkey", F.when(c("c_acctbal") > 0, c("c_nationkey").cast("long")).alias("fixed"), c("c_nationkey").cast("long").alias("staff"), c("c_custkey").alias("rent"))
    return datasets.administration_cost(raw, ["fixed", "staff", "rent"], "cost", {"c_custkey": "account"})
