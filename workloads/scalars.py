"""Column functions: text, rules, dates and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions import dates, names, rules, text
from workloads.registry import Tables, query

c = F.col


# ---- text ----

@query("""
SELECT c_custkey, trim(c_name, ' ' || chr(9)) AS c_name, trim(c_mktsegment, ' ' || chr(10)) AS c_mktsegment
FROM (SELECT c_custkey, ' ' || chr(9) || c_name || '  ' AS c_name, c_mktsegment || chr(10) || ' ' AS c_mktsegment
      FROM customer)""")
def trim_strings(t: Tables):
    raw = t.customer.select("c_custkey", F.concat(F.lit(" \t"), "c_name", F.lit("  ")).alias("c_name"),
                            F.concat("c_mktsegment", F.lit("\n ")).alias("c_mktsegment"))
    return text.trim_strings(raw)


@query("""
SELECT o_orderkey,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High'
            WHEN '4-NOT SPECIFIED' THEN 'Unknown' ELSE o_orderpriority END AS o_orderpriority,
       CASE o_orderstatus WHEN 'F' THEN 'Unknown' WHEN 'P' THEN 'Unknown' ELSE 'O' END AS status
FROM orders""")
def map_values_default(t: Tables):
    raw = t.orders.select("o_orderkey", "o_orderpriority",
                          F.when(c("o_orderstatus") == "O", "O").when(c("o_orderstatus") == "F", "  ").alias("status"))
    return text.map_values(raw, ["o_orderpriority", "status"],
                           {"1-URGENT": "Urgent", "2-HIGH": "High", "4-NOT SPECIFIED": None})


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Final' WHEN 'O' THEN 'Open' ELSE 'Unknown' END AS known,
       CASE o_orderstatus WHEN 'F' THEN 'Final' WHEN 'O' THEN 'Open' ELSE o_orderstatus END AS kept,
       CASE o_orderstatus WHEN 'F' THEN 'Final' WHEN 'O' THEN 'Open' END AS or_null
FROM orders""")
def map_modes(t: Tables):
    words = {"F": "Final", "O": "Open"}
    s = c("o_orderstatus")
    return t.orders.select("o_orderkey", text.map_known(s, words, "Unknown").alias("known"),
                           text.mapped(s, words).alias("kept"), text.mapped(s, words, "null").alias("or_null"))


@query("""
SELECT c_custkey,
       CASE WHEN length(k) >= 6 THEN k ELSE lpad(k, 6, '0') END AS padded,
       '-' || lpad(k, 8, '0') AS signed,
       CASE WHEN c_mktsegment = 'BUILDING' THEN ' ' WHEN length(k) >= 9 THEN k ELSE lpad(k, 9, '0') END AS filled
FROM (SELECT c_custkey, c_mktsegment, CAST(c_custkey AS VARCHAR) AS k FROM customer)""")
def zero_pad(t: Tables):
    k = c("c_custkey").cast("string")
    return t.customer.select(
        "c_custkey", text.zero_pad(k, 6).alias("padded"), text.zero_pad(F.concat(F.lit("-"), k), 9).alias("signed"),
        text.zero_pad_filled(F.when(c("c_mktsegment") == "BUILDING", " ").otherwise(k), 9).alias("filled"))


@query("""
SELECT p_partkey, CASE WHEN p_type IN ('PROMO', 'SMALL', 'LARGE') THEN NULL ELSE p_type END AS p_type FROM part""")
def placeholders(t: Tables):
    kind = c("p_type")
    raw = t.part.select("p_partkey", F.when(kind == "PROMO", "N/A").when(kind == "SMALL", " null ")
                        .when(kind == "LARGE", "  ").otherwise(kind).alias("p_type"))
    return text.clean_placeholders(raw)


@query("""
SELECT c_custkey, substr(c_name, 1, 8) || '-' || substr(c_name, 9, 4) || '-' || substr(c_name, 13) || '-' AS marked
FROM customer""")
def insert_marks(t: Tables):
    return t.customer.select("c_custkey", text.insert_at(c("c_name"), "-", [8, 12, 40]).alias("marked"))


@query("""
SELECT c_custkey, substr(c_mktsegment, 1, 3) AS prefix,
       CASE substr(c_mktsegment, 1, 3) WHEN 'AUT' THEN 'North' WHEN 'MAC' THEN 'East' ELSE
         CASE substr(c_mktsegment, 1, 1) WHEN 'A' THEN 'South' WHEN 'B' THEN 'West' WHEN 'M' THEN 'South' END
       END AS region
FROM customer""")
def region_from_prefix(t: Tables):
    places = {"AUT": "North", "MAC": "East", "A": "South", "B": "West", "M": "South"}
    s = c("c_mktsegment")
    return t.customer.select("c_custkey", text.leading(s).alias("prefix"),
                             text.region_from_code(s, places).alias("region"))


@query("""
SELECT c_custkey, CASE WHEN substr(code, 2, 1) = '0' THEN 'Rural' WHEN code IS NOT NULL THEN 'Urban' END AS area,
       CASE WHEN substr(code, 2, 1) = '0' THEN 'Rural' ELSE 'Urban' END AS area_parity
FROM (SELECT c_custkey, CASE WHEN c_mktsegment <> 'MACHINERY'
        THEN chr(65 + c_nationkey) || CAST(c_nationkey AS VARCHAR) END AS code FROM customer)""")
def area_kind(t: Tables):
    code = F.when(c("c_mktsegment") != "MACHINERY", F.concat(F.char(c("c_nationkey") + 65), "c_nationkey"))
    return t.customer.select("c_custkey", text.area_type(code).alias("area"),
                             text.area_type(code, null_as_urban=True).alias("area_parity"))


@query("""
SELECT c_custkey, round(abs(c_acctbal), 2) AS digits, round(c_acctbal, 2) AS number, CAST(c_custkey AS VARCHAR) AS id,
       c_custkey AS whole, CAST(0 AS BIGINT) AS bad
FROM customer""")
def numeric_clean(t: Tables):
    shown = F.format_number("c_acctbal", 2)
    key = F.concat(c("c_custkey").cast("string"), F.lit(".0"))
    return t.customer.select(
        "c_custkey", text.digits_to_double(F.concat(F.lit("$ "), shown)).alias("digits"),
        text.to_number(shown).alias("number"), text.drop_decimal_suffix(key).alias("id"),
        text.to_int_or_zero(key).alias("whole"), text.to_int_or_zero(c("c_name")).alias("bad"))


@query("""
SELECT p_partkey, regexp_replace(p_brand, '(Brand)#?(\\d+)', '\\1 \\2') AS spaced,
       nullif(regexp_extract(p_brand, '#(\\d+)$', 1), '') AS digits,
       nullif(regexp_extract(p_name, '(bolt|ring)', 1), '') AS noun
FROM part""")
def regex_spacing(t: Tables):
    return t.part.select("p_partkey", text.tidy_pair(c("p_brand"), r"(Brand)#?(\d+)").alias("spaced"),
                         text.extract(c("p_brand"), r"#(\d+)$").alias("digits"),
                         text.extract(c("p_name"), "(bolt|ring)").alias("noun"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       concat_ws('-', l_orderkey, nullif(l_returnflag, 'A'), l_linenumber) AS key_text,
       concat_ws('|', nullif(nullif(l_returnflag, 'N'), ''), l_linestatus) AS filled_text,
       CAST(l_orderkey AS VARCHAR) || '|' || nullif(l_returnflag, 'A') AS strict_text
FROM lineitem""")
def key_concat(t: Tables):
    flag = c("l_returnflag")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        text.key_of(["l_orderkey", F.nullif(flag, F.lit("A")), "l_linenumber"]).alias("key_text"),
        text.key_of([F.when(flag == "N", "").otherwise(flag), "l_linestatus"], "|", blank_as_null=True).alias("filled_text"),
        F.concat(c("l_orderkey").cast("string"), F.lit("|"), F.nullif(flag, F.lit("A"))).alias("strict_text"))


@query("""
SELECT o_orderkey, concat_ws('|', CASE WHEN a IS NOT NULL THEN 'a' END, CASE WHEN b IS NOT NULL THEN 'b' END,
                             CASE WHEN d IS NOT NULL THEN 'd' END) AS present,
       coalesce(a, b, d) AS first_value, coalesce(d, a) AS replaced,
       CAST(CASE WHEN a IS NOT NULL AND a <> '' THEN 1 ELSE 0 END + CASE WHEN b IS NOT NULL AND b <> '' THEN 1 ELSE 0 END
       + CASE WHEN d IS NOT NULL AND d <> '' THEN 1 ELSE 0 END AS INTEGER) AS n_filled
FROM (SELECT o_orderkey, nullif(o_orderstatus, 'F') AS a, nullif(o_orderpriority, '5-LOW') AS b,
             CASE WHEN o_orderpriority = '1-URGENT' THEN 'U' WHEN o_orderpriority = '2-HIGH' THEN '' END AS d
      FROM orders)""")
def nonnull_columns(t: Tables):
    p = c("o_orderpriority")
    raw = t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("F")).alias("a"),
                          F.nullif(p, F.lit("5-LOW")).alias("b"),
                          F.when(p == "1-URGENT", "U").when(p == "2-HIGH", "").alias("d"))
    return raw.select("o_orderkey", text.filled_names(["a", "b", "d"]).alias("present"),
                      F.coalesce("a", "b", "d").alias("first_value"),
                      text.overwrite_where_present(c("a"), c("d")).alias("replaced"),
                      rules.filled_count(["a", "b", "d"]).alias("n_filled"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN code IS NULL THEN NULL WHEN l_returnflag = 'N' THEN code || '-N'
            WHEN system = 'X' OR l_quantity > 40 THEN code || '-' || system || '-' || l_returnflag
            ELSE code || '-' || system END AS code_key
FROM (SELECT *, CASE WHEN l_discount > 0.09 THEN NULL ELSE lpad(CAST(l_partkey AS VARCHAR), 6, '0') END AS code,
             CASE WHEN l_linestatus = 'O' THEN 'X' ELSE 'Y' END AS system FROM lineitem)""")
def join_code(t: Tables):
    code = F.when(c("l_discount") > 0.09, None).otherwise(text.zero_pad(c("l_partkey").cast("string"), 6))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        text.code_key(code, rules.split_system(c("l_linestatus"), "O", "X", "Y"), c("l_returnflag"),
                      c("l_quantity") > 40, ["N"], "X").alias("code_key"))


@query("""
SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'EC' WHEN 'STANDARD' THEN 'ST' ELSE p_type END AS p_type,
       CASE p_type WHEN 'SMALL' THEN 'petit' WHEN 'LARGE' THEN 'grand' END AS type_2, p_name
FROM part""")
def translate_labels(t: Tables):
    short = t.part.withColumn("type_2", text.mapped(c("p_type"), {"SMALL": "petit", "LARGE": "grand"}, "null"))
    return short.na.replace({"ECONOMY": "EC", "STANDARD": "ST"}, subset=["p_type"]).select(
        "p_partkey", "p_type", "type_2", "p_name")


@query("""
SELECT p_partkey, CASE WHEN p_size > 25 THEN p_name END AS notes FROM part""")
def code_notes(t: Tables):
    five = F.lpad(c("p_partkey").cast("string"), 5, "1")
    packed = F.concat(five, F.lit(" AB "), five, F.lit("  CD "), F.when(c("p_size") > 25, c("p_name")).otherwise(""))
    return t.part.select("p_partkey", text.notes_after(packed, r"\d{5}\s+[A-Z]{2}").alias("notes"))


@query("""
SELECT o_orderkey,
       md5('=' || o_orderkey || chr(31) || CASE WHEN o_orderstatus = 'F' THEN '0' ELSE '=' || o_orderstatus END
           || chr(31) || '=' || o_orderpriority) AS h
FROM orders""")
def row_hashes(t: Tables):
    raw = t.orders.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("F")))
    return raw.select("o_orderkey", text.row_hash(["o_orderkey", "o_orderstatus", "o_orderpriority"]).alias("h"))


@query("""
SELECT c_custkey, code, regexp_matches(code, '^[ABCEGHJKLMNPRSTVXY][0-9][ABCEGHJKLMNPRSTVWXYZ] [0-9][ABCEGHJKLMNPRSTVWXYZ][0-9]$') AS valid
FROM (SELECT c_custkey, chr(65 + c_nationkey) || CAST(c_custkey % 10 AS VARCHAR) || substr(c_mktsegment, 2, 1) || ' '
             || CAST(c_nationkey % 10 AS VARCHAR) || substr(c_mktsegment, 1, 1) || CAST(c_custkey % 7 AS VARCHAR) AS code
      FROM customer)""")
def postal_check(t: Tables):
    digit = lambda n, m: (c(n) % m).cast("string")
    code = F.concat(F.char(c("c_nationkey") + 65), digit("c_custkey", 10), F.substring("c_mktsegment", 2, 1), F.lit(" "),
                    digit("c_nationkey", 10), F.substring("c_mktsegment", 1, 1), digit("c_custkey", 7))
    return t.customer.select("c_custkey", code.alias("code")).withColumn("valid", text.postal_ok(c("code")))


@query("""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, '{"id":' || event_id || ',"type":"' || event_type || '"}' AS j
FROM events""")
def json_props(t: Tables):
    return t.events.select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"),
                           F.to_json(F.struct(c("event_id").alias("id"), c("event_type").alias("type"))).alias("j"))


# ---- rules ----

BANDS = [(1, 10, "1-10"), (11, 20, "11-20"), (21, 35, "21-35"), (40, None, "40+")]


@query("""
SELECT p_partkey, CASE WHEN p_size BETWEEN 1 AND 10 THEN '1-10' WHEN p_size BETWEEN 11 AND 20 THEN '11-20'
       WHEN p_size BETWEEN 21 AND 35 THEN '21-35' WHEN p_size >= 40 THEN '40+' ELSE 'Unknown' END AS band,
       CASE WHEN p_size BETWEEN 1 AND 10 THEN 1 WHEN p_size BETWEEN 11 AND 20 THEN 11
       WHEN p_size BETWEEN 21 AND 35 THEN 21 WHEN p_size >= 40 THEN 40 ELSE 0 END AS floor
FROM part""")
def band_label(t: Tables):
    labelled = t.part.select("p_partkey", rules.band(c("p_size"), BANDS).alias("band"))
    floors = text.value_map({label: low for low, _, label in BANDS})
    return labelled.withColumn("floor", F.coalesce(F.try_element_at(floors, c("band")), F.lit(0)))


@query("""
SELECT p_partkey, CASE WHEN p_brand LIKE 'Brand#11%' OR p_brand LIKE 'Brand#12%' THEN 'first'
       WHEN p_brand LIKE 'Brand#1%' THEN 'second' WHEN p_brand LIKE 'Brand#2%' OR p_brand LIKE 'Brand#9%' THEN 'third'
       ELSE 'Others' END AS family
FROM part""")
def prefix_group(t: Tables):
    families = [("first", ["Brand#11", "Brand#12"]), ("second", ["Brand#1"]), ("third", ["Brand#2", "Brand#9"])]
    return t.part.select("p_partkey", rules.prefix_group(c("p_brand"), families, "Others").alias("family"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN paid > 0 THEN 'Approved' WHEN paid = 0 AND (l_returnflag IN ('R') OR l_linestatus IN ('R', 'X')) THEN 'Incomplete'
            WHEN paid = 0 THEN 'Declined' ELSE 'Other' END AS outcome
FROM (SELECT *, CASE WHEN l_discount > 0.08 THEN NULL WHEN l_discount > 0.06 THEN -1.0 WHEN l_discount > 0.03 THEN 0.0 ELSE l_extendedprice END AS paid
      FROM lineitem)""")
def outcome_group(t: Tables):
    d = c("l_discount")
    paid = F.when(d > 0.08, None).when(d > 0.06, -1.0).when(d > 0.03, 0.0).otherwise(c("l_extendedprice"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                             rules.outcome_group(paid, [c("l_returnflag"), c("l_linestatus")], ["R", "X"]).alias("outcome"))


@query("""
SELECT o_orderkey, o_orderpriority LIKE '%H%' AS has_h,
       CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS flag,
       CASE o_orderstatus WHEN 'F' THEN TRUE ELSE FALSE END AS flag_parity
FROM orders""")
def yes_no(t: Tables):
    word = F.when(c("o_orderstatus") == "F", "Yes").when(c("o_orderstatus") == "O", "n")
    return t.orders.select("o_orderkey", rules.is_true(c("o_orderpriority").contains("H")).alias("has_h"),
                           rules.yes_no(word).alias("flag"), rules.yes_no(word, null_as_false=True).alias("flag_parity"))


@query("""
SELECT *, CASE WHEN eligible = 1 AND o_orderstatus <> 'P' THEN 1 ELSE 0 END AS enrolled FROM (
  SELECT *, CASE WHEN empty_period <> 1 AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS eligible FROM (
    SELECT o_orderkey, o_orderstatus, o_orderpriority,
           CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END AS empty_period FROM orders))""")
def eligibility(t: Tables):
    day = c("o_orderdate").cast("date")
    end = F.when((c("o_orderstatus") == "F") & (c("o_orderpriority") == "2-HIGH"), day).when(
        c("o_orderstatus") == "O", F.date_add(day, 30))
    df = t.orders.withColumn("empty_period", rules.same_day(day, end))
    df = df.withColumn("eligible", rules.eligible(c("empty_period"), c("o_orderpriority"), ["1-URGENT", "2-HIGH"]))
    signed = F.when(c("o_orderstatus") != "P", day)
    return df.withColumn("enrolled", rules.enrolled(c("eligible"), signed)).select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "empty_period", "eligible", "enrolled")


@query("""
SELECT s_suppkey, CASE WHEN s_nationkey < 10 THEN 'H' || s_name ELSE s_name END AS street,
       CASE WHEN s_nationkey < 10 THEN 'region' ELSE 'mail' END AS region,
       CASE WHEN s_nationkey < 10 THEN 'Home' ELSE 'Mailing' END AS address_kind
FROM supplier""")
def pick_address(t: Tables):
    n = c("s_nationkey")
    raw = t.supplier.select(
        "s_suppkey", F.concat(F.lit("H"), "s_name").alias("home_street"), c("s_name").alias("mail_street"),
        F.when(n < 10, "region").when(n < 20, "Unknown").alias("home_region"), F.lit("mail").alias("mail_region"))
    chosen = rules.either_address({"street": "home_street", "region": "home_region"},
                                  {"street": "mail_street", "region": "mail_region"}, "region")
    return raw.select("s_suppkey", *[v.alias(k) for k, v in chosen.items()])


@query("""
SELECT p_partkey, CASE WHEN p_size > 45 THEN 'big' WHEN p_type = 'PROMO' THEN 'promo' WHEN p_type = 'SMALL' THEN 'LITTLE' ELSE p_type END AS label
FROM part""")
def rule_overrides(t: Tables):
    return t.part.select("p_partkey", rules.overrides(
        c("p_type"), [(c("p_type") == "SMALL", "LITTLE"), (c("p_type") == "PROMO", "promo"), (c("p_size") > 45, "big")]).alias("label"))


# ---- dates ----

@query("SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS parsed FROM orders",
       text=["parsed"])
def date_parse_formats(t: Tables):
    day, p = c("o_orderdate"), c("o_orderpriority")
    written = (F.when(p == "1-URGENT", F.date_format(day, "yyyy-MM-dd")).when(p == "2-HIGH", F.date_format(day, "yyyy_MM_dd"))
               .when(p == "3-MEDIUM", F.date_format(day, "M-d-yyyy")).when(p == "5-LOW", F.lit("n/a"))
               .otherwise(F.date_format(day, "yyyy/MM/dd")))
    return t.orders.select("o_orderkey", dates.parse_date(written).alias("parsed"))


@query("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS stamped, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 7 HOUR AS stamped_at
FROM orders""", text=["stamped", "stamped_at"])
def date_from_name(t: Tables):
    day, p = c("o_orderdate"), c("o_orderpriority")
    name = F.concat(F.lit("DROP_20010101_"), F.when(p == "1-URGENT", F.date_format(day, "yyyyMMdd"))
                    .when(p == "2-HIGH", F.date_format(day, "yyyy_MM_dd")).otherwise(F.date_format(day, "yyyy-MM-dd")), F.lit(".csv"))
    stamp = F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 07:00:00"))
    return t.orders.select("o_orderkey", dates.date_from_name(name).alias("stamped"), dates.parse_timestamp(stamp).alias("stamped_at"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS claim_date FROM orders""",
       text=["claim_date"])
def claim_date(t: Tables):
    ref = F.concat(F.date_format("o_orderdate", "ddMMyy"), F.lit("-"), c("o_orderkey"))
    bad = F.concat(F.date_format("o_orderdate", "ddMM"), F.lit("B"), c("o_orderkey"))
    return t.orders.select("o_orderkey", dates.reference_date(F.when(c("o_orderpriority") == "5-LOW", bad).otherwise(ref)).alias("claim_date"))


@query("""
SELECT event_id, strftime(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York', '%Y-%m-%d %H:%M:%S') AS local_ts FROM events""")
def local_time(t: Tables):
    return t.events.select("event_id", F.date_format(dates.to_local(c("ts").cast("timestamp"), "America/New_York"),
                                                     "yyyy-MM-dd HH:mm:ss").alias("local_ts"))


@query("""
SELECT o_orderkey, CAST(floor((DATE '2024-06-30' - d) / 365.25) AS BIGINT) AS age,
       CAST(greatest(CASE WHEN o_orderstatus = 'F' THEN floor((DATE '1994-01-01' + 730 - d) / 365.25)
            ELSE floor((DATE '2001-01-01' - d) / 365.25) END, 0) AS BIGINT) AS age_at,
       CASE WHEN o_orderstatus <> 'P' AND ((d <= DATE '1998-07-01' AND DATE '1998-07-01' <= e) OR e IS NULL) THEN 1 ELSE 0 END AS active
FROM (SELECT *, CAST(o_orderdate AS DATE) AS d, CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(o_orderdate AS DATE) + 365 END AS e FROM orders)""")
def age_and_coverage(t: Tables):
    d = c("o_orderdate").cast("date")
    end = F.when(c("o_orderpriority") != "1-URGENT", F.date_add(d, 365))
    lit = lambda s: F.lit(s).cast("date")
    on = F.when(c("o_orderstatus") != "F", lit("2001-01-01"))
    return t.orders.select("o_orderkey", dates.whole_years(d, lit("2024-06-30")).alias("age"),
                           dates.age_at(d, on, F.date_add(lit("1994-01-01"), 730)).alias("age_at"),
                           dates.active_on(c("o_orderstatus") != "P", d, end, lit("1998-07-01")).alias("active"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) - 1 AS day_before,
       CAST(l_shipdate AS DATE) - CAST((dayofweek(l_shipdate) + 2) % 7 AS INTEGER) AS friday,
       round_even(l_quantity * 30 / 60, 1) AS minutes
FROM lineitem""", text=["day_before", "friday"])
def day_arithmetic(t: Tables):
    d = c("l_shipdate").cast("date")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.date_sub(d, 1).alias("day_before"),
                             dates.previous_friday(d).alias("friday"), dates.minutes(c("l_quantity") * 30).alias("minutes"))


@query("""
SELECT fy, count(*) AS n_orders, min(a) AS valid_from, max(b) AS valid_to FROM (
  SELECT 'FY' || s || '-' || (s + 1) AS fy, make_date(s, 4, 1) AS a, make_date(s + 1, 3, 31) AS b
  FROM (SELECT year(o_orderdate) - CASE WHEN month(o_orderdate) < 4 THEN 1 ELSE 0 END AS s FROM orders))
GROUP BY fy""", text=["valid_from", "valid_to"])
def fiscal_years(t: Tables):
    d = c("o_orderdate").cast("date")
    start = F.year(d) - F.when(F.month(d) < 4, 1).otherwise(0)
    first, last = dates.fiscal_bounds(start)
    rows = t.orders.select(dates.fiscal_year(d).alias("fy"), first.alias("a"), last.alias("b"))
    return rows.groupBy("fy").agg(F.count(F.lit(1)).alias("n_orders"), F.min("a").alias("valid_from"), F.max("b").alias("valid_to"))


# ---- names ----

@query("""
SELECT c_custkey AS Customer_Key, c_name AS "_name_of_customer", c_mktsegment AS segment_part FROM customer""")
def clean_names(t: Tables):
    raw = t.customer.select(c("c_custkey").alias("customer  key"), c("c_name").alias(" name of\tcustomer?"), c("c_mktsegment").alias("segment - x"))
    titled = names.normalize_names(raw.select("customer  key"), names.Naming(title=True)).columns
    bare = names.normalize_names(raw.select(" name of\tcustomer?"), names.Naming(drop="?/-", trim=False, runs=False)).columns
    under = names.normalize_names(names.replace_in_names(raw.select("segment - x"), "x", "part"), names.Naming(join="-")).columns
    df = raw.toDF(*titled, *bare, *under)
    return names.rename_present(df, {"absent": "x"})


@query("""
SELECT o_orderkey AS id, o_orderstatus, CAST(o_totalprice AS BIGINT) AS amount, CAST(NULL AS INTEGER) AS bad,
       DATE '2024-01-01' AS loaded, 'batch' AS tag FROM (SELECT o_orderkey, o_orderstatus, floor(o_totalprice) AS o_totalprice FROM orders)""",
       text=["loaded"])
def shape_columns(t: Tables):
    df = names.keep_and_rename(t.orders, ["o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority"], {"o_orderkey": "id"})
    df = df.withColumns({"amount": F.floor("o_totalprice"), "bad": c("o_orderpriority"), "loaded": F.lit("2024-01-01").cast("date"), "tag": F.lit("batch")})
    df = names.cast_columns(df, {"bad": "int", "amount": "bigint"})
    return names.to_front(names.drop_present(df, ["o_totalprice", "o_orderpriority", "none"]), ["tag", "id", "absent"])


@query("SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer")
def align_columns(t: Tables):
    like = t.supplier.select(c("s_suppkey").alias("c_custkey"), c("s_suppkey").alias("c_nationkey"), c("s_name").alias("other"))
    return names.align_to(names.first_columns(t.customer, 3), like)


@query("""
SELECT o_orderkey, year(o_orderdate) * 100 + month(o_orderdate) AS ym, upper(o_orderpriority) AS shout FROM orders""")
def derive_columns(t: Tables):
    rules_table = [("ym", "cast(year(o_orderdate) * 100 + month(o_orderdate) as bigint)"), ("shout", "upper(o_orderpriority)")]
    return names.derive(t.orders, rules_table).select("o_orderkey", "ym", "shout")
