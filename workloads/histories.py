"""Change history, rosters and source catalogues."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.operators import catalog, history
from lakeloom.session import cut
from workloads.registry import Tables, query

c = F.col


def change_feed(t: Tables):
    """Events as change files: one file per day, errors are deletes, purchases carry an id of their own."""
    user = c("user_id").cast("string")
    error = c("event_type") == "error"
    own = (c("event_type") == "purchase") | (error & (c("value") > 100))
    return t.events.select(
        "user_id", F.when(own, F.concat(user, F.lit("p"))).otherwise(user).alias("id"), c("ts").cast("date").alias("day"),
        F.when(error, F.lit("delete")).otherwise(F.lit("upsert")).alias("op"), c("event_type").alias("kinds"))


FEED = """
WITH feed AS (SELECT user_id, user_id || CASE WHEN event_type = 'purchase' OR (event_type = 'error' AND value > 100) THEN 'p' ELSE '' END AS id,
  CAST(ts AS DATE) AS day, CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS op, event_type FROM events),
ver AS (SELECT user_id, day, array_to_string(list_sort(list(DISTINCT id)), '|') AS id, array_to_string(list_sort(list(DISTINCT event_type)), '|') AS kinds
  FROM feed WHERE op = 'upsert' GROUP BY user_id, day),
piece AS (SELECT id, unnest(string_split(id, '|')) AS piece FROM (SELECT DISTINCT id FROM ver)),
closing AS (SELECT DISTINCT p.id, f.day AS f FROM piece p JOIN feed f ON f.id = p.piece AND f.op = 'delete'),
hit AS (SELECT c.id, c.f, max(v.day) AS vday FROM closing c JOIN ver v ON v.id = c.id AND v.day < c.f GROUP BY c.id, c.f)
"""


def _replay_sql(end: str = "max(f) - 1") -> str:
    return FEED + f""", ends AS (SELECT id, vday, {end} AS e FROM hit GROUP BY id, vday)
SELECT ver.user_id, ver.id, ver.kinds, ver.day AS effective_date, coalesce(e, DATE '9999-12-31') AS end_date,
  CAST(row_number() OVER (PARTITION BY ver.id ORDER BY ver.day DESC) AS INTEGER) AS version
FROM ver LEFT JOIN ends ON ends.id = ver.id AND vday = ver.day"""


@query(_replay_sql("CASE WHEN max(f) = DATE '2024-01-15' THEN DATE '9999-12-31' ELSE max(f) - 1 END"), text=["effective_date", "end_date"])
def scd2_replay(t: Tables):
    """All change files at once; the file of one day is a full file, whose deletes close nothing."""
    return history.replay(change_feed(t), "user_id", "id", "day", "op", full=c("day") == F.lit("2024-01-15").cast("date"))


@query(f"SELECT * EXCLUDE (nxt), CASE WHEN version = 1 THEN id ELSE id || '-' || version END AS version_id FROM (SELECT * REPLACE (coalesce(least(end_date, nxt - 1), end_date) AS end_date) FROM (SELECT *, lead(effective_date) OVER (PARTITION BY id ORDER BY effective_date) AS nxt FROM ({_replay_sql()})))",
       text=["effective_date", "end_date"])
def scd2_closing(t: Tables):
    """The variant in which an upsert closes its predecessor."""
    df = history.replay(change_feed(t), "user_id", "id", "day", "op", close_on_upsert=True)
    return df.withColumn("version_id", history.version_id())


@query(_replay_sql(), text=["effective_date", "end_date"])
def scd2_apply(t: Tables):
    """Replay up to a day, then the files after it one by one."""
    feed = change_feed(t)
    day = lambda s: F.lit(s).cast("date")
    df = cut(history.replay(feed.where(c("day") <= day("2024-01-27")), "user_id", "id", "day", "op"))
    for later in ("2024-01-28", "2024-01-29", "2024-01-30"):
        df = cut(history.apply_batch(df, feed.where(c("day") == day(later)).drop("day"), "user_id", "id", "op", day(later)))
    return df


@query(FEED + """, raw AS (SELECT day, count(*) AS delta_raw, count(*) FILTER (WHERE op = 'delete') AS delete_raw, count(*) FILTER (WHERE op = 'upsert') AS upsert_raw FROM feed GROUP BY day),
dup AS (SELECT day, count(*) AS n FROM (SELECT day, user_id FROM feed WHERE op = 'upsert' GROUP BY ALL HAVING count(*) > 1) GROUP BY day),
act AS (SELECT day, count(*) AS n FROM ver GROUP BY day),
miss AS (SELECT day, count(*) AS n FROM feed f WHERE op = 'delete' AND NOT EXISTS (SELECT 1 FROM ver v WHERE v.id = f.id AND v.day < f.day) GROUP BY day),
hits AS (SELECT f AS day, count(*) AS n FROM hit GROUP BY f),
j AS (SELECT raw.*, coalesce(dup.n, 0) AS upsert_duplicates, coalesce(act.n, 0) AS upsert_actual, coalesce(miss.n, 0) AS delete_without_match, coalesce(hits.n, 0) AS delete_actual
  FROM raw LEFT JOIN dup USING (day) LEFT JOIN act USING (day) LEFT JOIN miss USING (day) LEFT JOIN hits USING (day))
SELECT *, CAST(sum(upsert_actual) OVER (ORDER BY day) AS BIGINT) AS total_actual, CAST(sum(upsert_actual) OVER (ORDER BY day) AS BIGINT) - upsert_actual AS total_before,
  upsert_raw - upsert_duplicates AS upsert_planned, delete_raw - delete_without_match AS delete_planned FROM j""", text=["day"])
def audit_counts(t: Tables):
    return history.audit(change_feed(t), "user_id", "id", "day", "op")


ROSTERS = """
WITH old AS (SELECT c_custkey, c_name, c_mktsegment <> 'BUILDING' AS active, CASE WHEN c_mktsegment = 'BUILDING' THEN DATE '1997-01-01' END AS stamped
  FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')),
new AS (SELECT c_custkey, c_name, TRUE AS active, CAST(NULL AS DATE) AS stamped FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW'))
"""


@query(ROSTERS + """SELECT * FROM new UNION ALL SELECT c_custkey, c_name, FALSE, CASE WHEN active THEN DATE '1998-06-30' ELSE stamped END FROM old
WHERE c_custkey NOT IN (SELECT c_custkey FROM new)""", text=["stamped"])
def roster_refresh(t: Tables):
    has = lambda p: t.orders.where(c("o_orderpriority") == p).select(c("o_custkey").alias("c_custkey")).distinct()
    building = c("c_mktsegment") == "BUILDING"
    base = t.customer.select("c_custkey", "c_name", (~building).alias("active"), F.when(building, F.lit("1997-01-01").cast("date")).alias("stamped"))
    old = base.join(has("1-URGENT"), "c_custkey", "left_semi")
    new = base.join(has("5-LOW"), "c_custkey", "left_semi").withColumns({"active": F.lit(True), "stamped": F.lit(None).cast("date")})
    return history.roster_refresh(old, new, "c_custkey", "active", "stamped", F.lit("1998-06-30").cast("date"))


def _catalogues(t: Tables):
    """Orders as catalogue entries at two times."""
    day = c("o_orderdate").cast("date")
    entry = t.orders.select(
        F.concat(F.lit("drop/"), "o_orderkey").alias("path"), c("o_orderpriority").alias("source"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        F.when(c("o_orderstatus") == "F", "overwrite").otherwise("append").alias("write_mode"), day.alias("source_date"),
        day.alias("modified"), (c("o_orderpriority") != "5-LOW").alias("processed"),
        F.when(c("o_orderpriority") != "5-LOW", day).alias("processed_on"), "o_orderstatus", "o_totalprice")
    old = entry.where("o_totalprice > 100000").drop("o_orderstatus", "o_totalprice")
    new = entry.where("o_orderpriority <> '1-URGENT'").withColumns({
        "modified": F.when(c("o_totalprice") > 300000, F.date_add("modified", 1)).otherwise(c("modified")),
        "processed": F.lit(False), "processed_on": F.lit(None).cast("date")}).drop("o_orderstatus", "o_totalprice")
    return old, new


CATALOGUE = """
SELECT *, CASE WHEN due THEN FALSE ELSE TRUE END AS processed, CASE WHEN NOT due THEN source_date END AS processed_on FROM (
SELECT 'drop/' || o_orderkey AS path, o_orderpriority AS source, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority,
  CASE WHEN o_orderstatus = 'F' THEN 'overwrite' ELSE 'append' END AS write_mode, CAST(o_orderdate AS DATE) AS source_date,
  CAST(o_orderdate AS DATE) + CASE WHEN o_totalprice > 300000 THEN 1 ELSE 0 END AS modified,
  o_totalprice <= 100000 OR o_orderpriority = '5-LOW' OR (o_orderstatus = 'F' AND o_totalprice > 300000) AS due
FROM orders WHERE o_orderpriority <> '1-URGENT')"""


@query(CATALOGUE, text=["source_date", "modified", "processed_on"])
def catalog_diff(t: Tables):
    return catalog.diff(*_catalogues(t))


@query(f"SELECT path, processed OR source = '2-HIGH' OR write_mode = 'append' AS processed, CASE WHEN source = '2-HIGH' OR write_mode = 'append' THEN DATE '2002-01-01' ELSE processed_on END AS processed_on FROM ({CATALOGUE})",
       text=["processed_on"])
def mark_processed(t: Tables):
    on = F.lit("2002-01-01").cast("date")
    state = catalog.diff(*_catalogues(t))
    done = catalog.mark_processed(state, source="2-HIGH", on=on)
    return catalog.mark_processed(done, done=state.where("write_mode = 'append'"), on=on).select("path", "processed", "processed_on")


@query(f"SELECT priority, source, count(*) AS n_files, min(source_date) AS first_date, max(source_date) AS last_date FROM ({CATALOGUE}) WHERE NOT processed GROUP BY priority, source",
       text=["first_date", "last_date"])
def work_list(t: Tables):
    return catalog.work_list(catalog.diff(*_catalogues(t)))


@query(f"SELECT priority, '{{\"priority\":' || priority || ',\"sources\":[\"' || source || '\"]}}' AS work FROM ({CATALOGUE}) WHERE NOT processed GROUP BY priority, source")
def work_json(t: Tables):
    return catalog.sources_json(catalog.diff(*_catalogues(t)))
