"""Readers and writers, over files that Spark derives from the given tables.

Files go to new folders below the session's shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lakeloom.operators.reshape import child_table
from lakeloom.session import scratch
from lakeloom.sources import files, tables
from lakeloom.sources.contracts import Contract
from workloads.registry import Tables, query

c = F.col

ORDER_FILE = Contract(
    name="orders", read_schema="`order key` string, status string, placed string, priority string, price string",
    dates=["placed"], keep=["order key", "priority", "placed", "price"],
    renames={"order key": "order_id", "placed": "placed_on"},
    write_schema="order_id string, placed_on date, price double, priority string",
    options={"multiLine": "true", "escape": '"'},
    transform=lambda df: df.where("status <> 'F'"),
)


@query("""SELECT lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS order_id, CAST(o_orderdate AS DATE) AS placed_on, o_totalprice AS price,
o_orderpriority || chr(10) || 'a "quoted", part' AS priority FROM orders WHERE o_orderstatus <> 'F'""", text=["placed_on"])
def csv_contract(t: Tables):
    """Quoted fields with line breaks, read by contract and matched by name."""
    path = scratch(t.spark, "orders-csv")
    tables_out = t.orders.select(
        c("o_orderstatus").alias("status"), F.lpad(c("o_orderkey").cast("string"), 9, "0").alias("order key"),
        F.date_format("o_orderdate", "yyyy_MM_dd").alias("placed"), F.concat("o_orderpriority", F.lit('\na "quoted", part')).alias("priority"),
        c("o_totalprice").cast("decimal(18,2)").alias("price"))
    tables_out.write.option("header", "true").option("escape", '"').csv(path)
    return ORDER_FILE.shape(ORDER_FILE.read(t.spark, path))


def _drops(t: Tables, label: str) -> str:
    """Order lines as one text file below one dated folder per month, each with a preamble and a trailer line; every tenth line has a field too many."""
    path = scratch(t.spark, label)
    month = F.concat(F.lit("orders_"), F.date_format(F.last_day(c("o_orderdate").cast("date")), "yyyy-MM-dd"))
    more = F.when(c("o_orderkey") % 10 == 3, ",odd").otherwise("")
    rows = t.orders.select(month.alias("drop"), F.lit(2).alias("place"), F.concat_ws(
        ",", "o_orderkey", "o_custkey", F.concat(F.lit('"'), F.format_number("o_totalprice", 2), F.lit('"')), F.concat("o_orderpriority", more)).alias("value"))
    marks = rows.select("drop").distinct().select("drop", F.explode(F.array(
        F.struct(F.lit(0).alias("place"), F.lit("REPORT,OF,ORDERS,1").alias("value")),
        F.struct(F.lit(1).alias("place"), F.lit("key,customer,amount,priority").alias("value")),
        F.struct(F.lit(3).alias("place"), F.lit("END,1,2,3").alias("value")))).alias("m")).select("drop", "m.place", "m.value")
    rows.unionByName(marks).repartition("drop").sortWithinPartitions("drop", "place").drop("place").write.partitionBy("drop").text(path)
    return path


@query("""SELECT o_orderkey AS order_id, o_custkey AS member, round(o_totalprice, 2) AS price, o_orderpriority AS priority, last_day(o_orderdate) AS source FROM orders WHERE o_orderkey % 10 <> 3""", text=["source"])
def enveloped_csv(t: Tables):
    path = _drops(t, "enveloped")
    df = files.read_enveloped(t.spark, path, "order_id bigint, member bigint, price string, priority string", by="folder")
    return df.withColumn("price", F.regexp_replace("price", ",", "").cast("double"))


@query("""SELECT last_day(o_orderdate) AS source, count(*) FILTER (WHERE o_orderkey % 10 = 3) AS n_rejects, count(*) AS n_records FROM orders GROUP BY ALL""", text=["source"])
def enveloped_counts(t: Tables):
    """Rejected lines and all records of each drop: nothing between preamble and trailer is lost."""
    records = files.enveloped_records(t.spark, _drops(t, "counts"), ["order_id", "member", "price", "priority"], by="folder")
    return records.groupBy("source").agg(F.count("reject").alias("n_rejects"), F.count(F.lit(1)).alias("n_records"))


def _text_drops(t: Tables, label: str) -> str:
    """Documents as delimited text below folders of 2 000 ids: a preamble with a quote, a header, quoted texts of several lines, and a trailer of two
    lines; every tenth record has a field too many."""
    path = scratch(t.spark, label)
    drop = F.concat(F.lit("texts-"), F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (c("doc_id") / 2000).cast("int")), "yyyy-MM-dd"))
    quoted = lambda v: F.concat(F.lit('"'), F.replace(F.coalesce(v, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    more = F.when(c("doc_id") % 10 == 3, ",odd").otherwise("")
    # records hold line breaks with a single and with a doubled quote beside them
    told = F.concat(c("text"), F.lit('\n"said, '), c("doc_id"), F.lit('"\n'))
    rows = t.documents.select(drop.alias("drop"), F.lit(2).alias("place"), F.concat_ws(",", "doc_id", quoted(c("lang")), quoted(told), F.concat("source", more)).alias("value"))
    marks = rows.select("drop").distinct().select("drop", F.explode(F.array(
        F.struct(F.lit(0).alias("place"), F.lit('"REPORT, OF TEXTS').alias("value")), F.struct(F.lit(1).alias("place"), F.lit("id,lang,text,source").alias("value")),
        F.struct(F.lit(3).alias("place"), F.lit('TOTAL,"1').alias("value")), F.struct(F.lit(4).alias("place"), F.lit('END,"2').alias("value")))).alias("m")).select("drop", "m.place", "m.value")
    rows.unionByName(marks).repartition("drop").sortWithinPartitions("drop", "place").drop("place").write.partitionBy("drop").text(path)
    return path


@query("""SELECT DATE '2024-01-01' + CAST(doc_id // 2000 AS INTEGER) AS drop_day, CASE WHEN doc_id % 10 <> 3 THEN CAST(doc_id AS VARCHAR) END AS doc_id,
  CASE WHEN doc_id % 10 <> 3 THEN lang END AS lang, CASE WHEN doc_id % 10 <> 3 THEN source END AS source,
  CASE WHEN doc_id % 10 <> 3 THEN md5(text || chr(10) || '"said, ' || doc_id || '"' || chr(10)) END AS text_digest,
  CASE WHEN doc_id % 10 = 3 THEN md5(doc_id || ',"' || lang || '","' || replace(text, '"', '""') || chr(10) || '""said, ' || doc_id || '""' || chr(10) || '",' || source || ',odd') END AS reject_digest
FROM documents""", text=["drop_day"])
def enveloped_texts(t: Tables):
    """Records of many lines between preamble and trailer, read in splits far smaller than a file; with the rejects they are all records."""
    path = _text_drops(t, "texts")
    small, usual = str(1 << 18), t.spark.conf.get("spark.sql.files.maxPartitionBytes")
    t.spark.conf.set("spark.sql.files.maxPartitionBytes", small)
    try:
        records = files.enveloped_records(t.spark, path, ["doc_id", "lang", "text", "source"], trail=2, name="drop_day", by="folder")
    finally:
        t.spark.conf.set("spark.sql.files.maxPartitionBytes", usual)
    read = lambda v, name: F.when(c("reject").isNull(), v).alias(name)
    return records.select("drop_day", *[read(c(x), x) for x in ("doc_id", "lang", "source")], read(F.md5("text"), "text_digest"), F.md5("reject").alias("reject_digest"))


@query("""SELECT p_partkey, p_name, DATE '2024-03-31' AS source FROM part""", text=["source"])
def dated_parquet(t: Tables):
    """Parquet drops read with the date in their folder's name."""
    path = scratch(t.spark, "parquet")
    t.part.select("p_partkey", "p_name").write.parquet(f"{path}/part_20240331")
    return files.read_parquet(t.spark, f"{path}/part_20240331", by="folder")


@query("""SELECT last_day(o_orderdate) AS source, count(*) AS n_rows FROM orders GROUP BY ALL""", text=["source"])
def dated_files(t: Tables):
    """Many dated drops as one frame with the date of each drop, and no trailing sums."""
    path = scratch(t.spark, "dated")
    day = F.date_format(F.last_day(c("o_orderdate").cast("date")), "yyyyMMdd")
    tables.export_by(t.orders.select("o_orderkey", F.concat(F.lit("orders_"), day).alias("drop")), path, "drop")
    raw = files.with_source_date(files.read_delimited(t.spark, f"{path}/*", "o_orderkey bigint"), by="folder")
    return raw.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"))


@query("""SELECT DISTINCT 'drop=orders_' || strftime(last_day(o_orderdate), '%Y-%m-%d') AS folder, last_day(o_orderdate) AS source_date, 'txt' AS file_type, 'drop=orders_' || strftime(last_day(o_orderdate), '%Y-%m-%d') AS source_key FROM orders""",
       text=["source_date"])
def list_files(t: Tables):
    """Newest file of each folder among those changed since long ago."""
    listing = files.list_files(t.spark, _drops(t, "listing"), "*.txt", changed_after="2020-01-01T00:00:00")
    newest = files.newest_per_folder(listing).select("source_key", "path")
    dated = listing.join(newest, ["source_key", "path"])
    from lakeloom.functions.dates import date_from_name

    return dated.select("folder", date_from_name(c("folder")).alias("source_date"), "file_type", "source_key")


@query("""SELECT s_suppkey AS code, s_acctbal AS price, CAST(s_nationkey % 5 AS VARCHAR) AS region, DATE '2024-04-01' AS valid_from, DATE '2025-03-31' AS valid_to, 'general' AS provider_type FROM supplier""",
       text=["valid_from", "valid_to"])
def price_list(t: Tables):
    path = scratch(t.spark, "prices")
    tables.export_by(t.supplier.select(c("s_suppkey").alias("code"), c("s_acctbal").alias("price"), (c("s_nationkey") % 5).alias("region")), path, "region")
    return files.price_list(t.spark, {str(r): f"{path}/region={r}" for r in range(5)}, 2024, "general", "code bigint, price double")


@query("SELECT o_orderpriority, count(*) AS n_rows FROM orders WHERE o_totalprice > 50000 AND o_orderstatus <> 'F' GROUP BY o_orderpriority")
def catalogue_view(t: Tables):
    """A table of another layer under a name of its own, read by a projected and filtered scan."""
    tables.expose(t.spark, {"silver_orders": t.orders})
    return t.spark.sql("SELECT o_orderpriority, count(*) AS n_rows FROM silver_orders WHERE o_totalprice > 50000 AND o_orderstatus <> 'F' GROUP BY o_orderpriority")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_returnflag <> 'A' AND l_quantity > 45")
def projected_scan(t: Tables):
    return tables.read(t.spark, t.path("lineitem")).where("l_returnflag <> 'A' and l_quantity > 45").select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT o_orderpriority AS load, o_orderkey, o_totalprice FROM orders")
def export_by_value(t: Tables):
    path = scratch(t.spark, "split")
    tables.export_by(t.orders.select("o_orderkey", "o_totalprice", c("o_orderpriority").alias("load")), path, "load")
    return t.spark.read.option("header", "true").schema("o_orderkey bigint, o_totalprice double, load string").csv(path)


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT (coalesce(o_orderstatus = 'F', FALSE) AND o_totalprice > 200000)")
def remove_rows(t: Tables):
    path = scratch(t.spark, "table")
    tables.overwrite(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), path)
    tables.remove_rows(t.spark, path, (c("o_orderstatus") == "F") & (c("o_totalprice") > 200000))
    return tables.read(t.spark, path).drop("o_totalprice")


@query("SELECT c_custkey AS k, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def append_rows(t: Tables):
    path = scratch(t.spark, "appended")
    tables.overwrite(t.part.select(c("p_partkey").alias("other")), path)
    tables.overwrite(t.customer.select(c("c_custkey").alias("k"), c("c_name").alias("name")), path)
    tables.append(t.supplier.select(c("s_suppkey").alias("k"), c("s_name").alias("name")), path)
    return tables.read(t.spark, path)


@query("""SELECT 'main' AS part, count(*) AS n_rows FROM customer UNION ALL SELECT 'segments', count(DISTINCT c_mktsegment) FROM customer
UNION ALL SELECT 'rich', count(*) FROM customer WHERE c_acctbal > 5000""")
def companion_tables(t: Tables):
    path = scratch(t.spark, "companions")
    people = t.customer
    tables.write_with_companions(people, path, {"segments": people.select("c_mktsegment").distinct(), "rich": people.where("c_acctbal > 5000")})
    n = lambda p, label: tables.read(t.spark, p).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(label).alias("part"), "n_rows")
    return n(path, "main").unionByName(n(f"{path}_segments", "segments")).unionByName(n(f"{path}_rich", "rich"))


@query("""SELECT o_orderstatus AS universe, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS report_date, o_orderstatus || '_' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS report_key,
CAST(o_orderkey AS VARCHAR) AS o_orderkey, TRUE AS stamped FROM orders""")
def report_rows(t: Tables):
    keyed = tables.report_keys(t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate"), c("o_orderstatus"), c("o_orderdate").cast("date"))
    out = tables.report_rows(keyed.drop("o_orderstatus", "o_orderdate"), "America/New_York")
    return out.withColumn("stamped", c("validated_at").isNotNull()).drop("validated_at")


@query("""SELECT id || '|' || source AS parent, kind, amount FROM (
SELECT 'L' || l_orderkey || '.' || l_linenumber || '.' || l_partkey AS id, strftime(l_shipdate, '%Y-%m-%d') AS source, 'tax' AS kind, l_tax AS amount, l_returnflag FROM lineitem
UNION ALL SELECT 'L' || l_orderkey || '.' || l_linenumber || '.' || l_partkey, strftime(l_shipdate, '%Y-%m-%d'), 'discount', l_discount, l_returnflag FROM lineitem) WHERE l_returnflag <> 'A'""")
def nested_parquet(t: Tables):
    """Arrays of structs written to Parquet, read by a declared schema, as a child table."""
    path = scratch(t.spark, "nested")
    part = lambda kind, v: F.struct(F.lit(kind).alias("kind"), c(v).alias("amount"))
    t.lineitem.select(
        F.concat(F.lit("L"), F.concat_ws(".", "l_orderkey", "l_linenumber", "l_partkey")).alias("id"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("source"),
        F.when(c("l_returnflag") != "A", F.array(part("tax", "l_tax"), part("discount", "l_discount"))).alias("details"),
    ).write.parquet(path)
    contract = Contract("nested", "id string, source string, details array<struct<kind: string, amount: double>>",
                        "id string, source string, details array<struct<kind: string, amount: double>>", fmt="parquet", mode="append")
    return child_table(contract.shape(contract.read(t.spark, path)), "details", ["id", "source"], ["kind", "amount"], "parent")


def bucketed_pair(t: Tables, buckets: int = 16):
    """Orders and their lines as tables in hash buckets of the order, in the shared folder."""
    mark = uuid.uuid4().hex
    keep = lambda df, label, key: tables.write_bucketed(df.withColumnRenamed(key, "order_id"), f"{label}_{mark}", ["order_id"], buckets, scratch(t.spark, label))
    lines = t.lineitem.select("l_orderkey", "l_quantity", c("l_extendedprice").cast("decimal(28,6)").alias("paid"), "l_shipdate", "l_returnflag")
    return keep(t.orders.select("o_orderkey", "o_custkey", "o_orderpriority"), "orders", "o_orderkey"), keep(lines, "lines", "l_orderkey")


@query("""SELECT o_orderkey AS order_id, o_custkey AS member, count(l_orderkey) AS n_lines, count(l_orderkey) FILTER (WHERE l_returnflag = 'R') AS n_returned,
CAST(sum(CAST(l_extendedprice AS DECIMAL(28,6))) AS DOUBLE) AS paid, CAST(max(l_shipdate) AS DATE) AS last_day FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL""", text=["last_day"])
def bucketed_claims(t: Tables):
    """Totals of each order from two bucketed tables: neither the join nor the grouping moves a row."""
    return bucketed_totals(*bucketed_pair(t))


def bucketed_totals(orders, lines):
    return orders.join(lines, "order_id", "left").groupBy("order_id", c("o_custkey").alias("member")).agg(
        F.count("paid").alias("n_lines"), F.count_if(c("l_returnflag") == "R").alias("n_returned"),
        F.sum("paid").cast("double").alias("paid"), F.max(c("l_shipdate").cast("date")).alias("last_day"))
