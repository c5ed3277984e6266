"""Streaming jobs over files of the given tables; results equal their batch forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.session import scratch
from lakeloom.streaming import history_store, jobs, resubmissions
from workloads.histories import FEED, _replay_sql, change_feed
from workloads.registry import Tables, query

c = F.col


def _event_files(t: Tables) -> str:
    """Events as one folder of files per day."""
    path = scratch(t.spark, "events")
    t.events.withColumn("day", c("ts").cast("date")).hint("rebalance", c("day")).write.partitionBy("day").parquet(path)
    return path


@query("SELECT date_trunc('hour', ts) AS bin_start, event_type, count(*) AS n_rows FROM events GROUP BY ALL", text=["bin_start"])
def stream_hourly_counts(t: Tables):
    src = jobs.new_files(t.spark, _event_files(t), t.events.schema, files_per_trigger=20)
    # the files appear in any order of days; so the watermark allows for all the days there are
    counts = jobs.counts_per_window(jobs.with_event_time(src, "ts", "3650 days"), "ts", by=("event_type",))
    out = scratch(t.spark, "hourly")
    jobs.update_each(counts, out, scratch(t.spark, "ck")).awaitTermination()
    return jobs.newest_values(t.spark, out, ["bin_start", "event_type"])


@query("SELECT event_id, user_id, event_type FROM events")
def stream_file_pickup(t: Tables):
    """Files are picked up once each, a few per batch, and appended to a table."""
    src = jobs.new_files(t.spark, _event_files(t), t.events.schema, files_per_trigger=10)
    out = scratch(t.spark, "picked")
    jobs.append_to(src.select("event_id", "user_id", "event_type"), out, scratch(t.spark, "ck")).awaitTermination()
    return t.spark.read.parquet(out)


@query(_replay_sql(), text=["effective_date", "end_date"])
def stream_history(t: Tables):
    """The history kept by a stream of change files, one a day, in whatever order they arrive."""
    path, out = scratch(t.spark, "changes"), scratch(t.spark, "history")
    feed = change_feed(t)
    feed.withColumn("part", c("day")).repartition("part").write.partitionBy("part").parquet(path)
    stream = jobs.new_files(t.spark, path, feed.schema, files_per_trigger=16).select(*feed.columns)
    history_store.keep(stream, out, scratch(t.spark, "ck"), "user_id", "id", "day", "op", buckets=16).awaitTermination()
    return history_store.current(t.spark, out, feed.schema, "user_id", "id", "day", "op")


DROP = "CASE WHEN day IN (DATE '2024-01-10', DATE '2024-01-11') THEN 1 WHEN day <= DATE '2024-01-20' THEN 0 ELSE 2 END"


def _late_files(t: Tables):
    """The store after three drops of change files, the second older than the first; one day's file is a full one."""
    path, out, check = (scratch(t.spark, x) for x in ("drops", "history", "ck"))
    feed = change_feed(t)
    day = lambda s: F.lit(s).cast("date")
    late = c("day").isin(day("2024-01-10"), day("2024-01-11"))
    for drop in ((c("day") <= day("2024-01-20")) & ~late, late, c("day") > day("2024-01-20")):
        feed.where(drop).withColumn("part", c("day")).repartition("part").write.mode("append").partitionBy("part").parquet(path)
        stream = jobs.new_files(t.spark, path, feed.schema).select(*feed.columns)
        history_store.keep(stream, out, check, "user_id", "id", "day", "op", full=c("day") == day("2024-01-15"), buckets=16).awaitTermination()
    return out, feed.schema


@query(f"""SELECT * REPLACE (coalesce(least(end_date, nxt - 1), end_date) AS end_date) FROM (SELECT *, lead(effective_date) OVER (PARTITION BY id ORDER BY effective_date) AS nxt
FROM ({_replay_sql("CASE WHEN max(f) = DATE '2024-01-15' THEN DATE '9999-12-31' ELSE max(f) - 1 END")}))""".replace("SELECT * REPLACE", "SELECT * EXCLUDE (nxt) REPLACE", 1), text=["effective_date", "end_date"])
def stream_history_late(t: Tables):
    """A late drop and a full file, read with upserts that end their predecessors."""
    out, schema = _late_files(t)
    return history_store.current(t.spark, out, schema, "user_id", "id", "day", "op", close_on_upsert=True)


@query(FEED.replace("user_id, day, array_to_string", "user_id, day, b, array_to_string").replace("GROUP BY user_id, day)", "GROUP BY user_id, day, b)").replace(
    "event_type FROM events)", f"event_type, {DROP.replace('day', 'CAST(ts AS DATE)')} AS b FROM events)") + """,
gone AS (SELECT id, day, b, count(*) AS n FROM feed WHERE op = 'delete' GROUP BY ALL),
part AS (SELECT user_id, id, day, b, unnest(string_split(id, '|')) AS piece FROM ver),
miss AS (SELECT * FROM gone g WHERE NOT EXISTS (SELECT 1 FROM ver v WHERE v.id = g.id AND v.b <= g.b AND v.day < g.day)),
apart AS (SELECT DISTINCT m.b, p.id, m.day AS at, p.day, p.user_id FROM miss m JOIN part p ON p.piece = m.id AND p.b <= m.b AND p.day < m.day),
met AS (SELECT DISTINCT g.b, p.id, g.day FROM gone g JOIN part p ON p.piece = g.id AND p.b <= g.b AND p.day < g.day),
d AS (SELECT b, min(day) AS first_date, max(day) AS last_date, count(*) AS delta_raw, count(*) FILTER (WHERE op = 'delete') AS delete_raw,
    count(*) FILTER (WHERE op = 'upsert') AS upsert_raw FROM feed GROUP BY b),
j AS (SELECT *, (SELECT count(*) FROM ver WHERE ver.b = d.b) AS fresh, (SELECT coalesce(sum(n), 0) FROM miss WHERE miss.b = d.b) AS m,
    (SELECT count(*) FROM apart WHERE apart.b = d.b) AS a, (SELECT count(DISTINCT user_id) FROM apart WHERE apart.b = d.b) AS u, (SELECT count(*) FROM met WHERE met.b = d.b) AS h,
    (SELECT count(*) FROM (SELECT DISTINCT id FROM ver WHERE ver.b = d.b) x WHERE (SELECT count(*) FROM ver v WHERE v.id = x.id AND v.b <= d.b) > 1) AS r FROM d)
SELECT CAST(b AS INTEGER) AS batch, first_date, last_date, CAST(coalesce(sum(fresh) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS total_before,
  delta_raw, delete_raw, CAST(m AS BIGINT) AS delete_without_match, a AS delete_without_match_detailed, u AS delete_without_match_no_duplicates, h AS delete_planned, h AS delete_actual,
  upsert_raw, upsert_raw - fresh AS upsert_duplicates, fresh AS upsert_planned, fresh AS upsert_actual, r AS total_duplicate,
  CAST(sum(fresh) OVER (ORDER BY b) AS BIGINT) AS total_planned, CAST(sum(fresh) OVER (ORDER BY b) AS BIGINT) AS total_actual FROM j""", text=["first_date", "last_date"])
def stream_history_audit(t: Tables):
    """The fifteen counters of every drop, taken while it was written."""
    return history_store.audit(t.spark, _late_files(t)[0])


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND n > 1 AND asked >= prev THEN n - 1 ELSE 0 END AS resubmission
FROM (SELECT *, row_number() OVER w AS n, lag(decided) OVER w AS prev
      FROM (SELECT *, CAST(o_orderdate AS DATE) AS asked, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) + 120 END AS decided FROM orders)
      WINDOW w AS (PARTITION BY o_custkey ORDER BY asked, o_orderkey))""")
def stream_resubmissions(t: Tables):
    """Requests that come in four drops, the third of them late; the numbers are those of all rows at once."""
    asked = c("o_orderdate").cast("date")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", asked.alias("asked"), F.when(c("o_orderpriority") != "5-LOW", F.date_add(asked, 120)).alias("decided"))
    day = lambda s: F.lit(s).cast("date")
    late = (c("asked") > day("1998-11-01")) & (c("asked") < day("1999-01-01")) & (c("o_orderkey") % 7 == 0)
    drops = [c("asked") < day("1997-01-01"), (c("asked") >= day("1997-01-01")) & (c("asked") < day("1999-01-01")) & ~late, late, c("asked") >= day("1999-01-01")]
    path, out, check = (scratch(t.spark, x) for x in ("requests", "numbers", "ck"))
    for drop in drops:
        rows.where(drop).write.mode("append").parquet(path)
        numbers = resubmissions.resubmissions(jobs.new_files(t.spark, path, rows.schema), ["o_custkey"], "asked", "decided", c("o_orderstatus") == "F",
                                              ["o_orderkey"], "90 days")
        jobs.update_each(numbers, out, check).awaitTermination()
    return jobs.newest_values(t.spark, out, ["o_custkey", "o_orderkey"]).select("o_orderkey", c("resubmission").cast("long").alias("resubmission"))
