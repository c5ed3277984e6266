"""URL lists joined in time: every capture meets the entries that were active when it was fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def address(url: Column) -> Column:
    """host/path of a URL in lower-case host letters, without scheme, user, port, query and fragment."""
    bare = F.regexp_replace(F.regexp_replace(url, "^[A-Za-z][A-Za-z0-9+.-]*://", ""), "[?#].*$", "")
    host = F.lower(F.regexp_replace(F.regexp_replace(F.substring_index(bare, "/", 1), "^.*@", ""), ":[0-9]*$", ""))
    path = F.substring(bare, F.length(F.substring_index(bare, "/", 1)) + 1, 1 << 30)
    return F.concat(host, F.when(path == "", F.lit("/")).otherwise(path))


def keys(url: Column) -> Column:
    """Everything an entry could name to hit this URL, as structs (scope, key, rank); a higher rank is closer.

    ``domain``: the host and each of its parents. ``prefix``: host with each leading run of path segments.
    ``url``: host and whole path. A URL without host has none.
    """
    full = address(url)
    host = F.substring_index(full, "/", 1)
    labels = F.split(host, "[.]")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(
        F.lit("domain").alias("scope"), F.array_join(F.slice(labels, -i, i), ".").alias("key"), i.alias("rank")))
    parts = F.split(full, "/")
    prefixes = F.when(F.size(parts) < 3, F.array().cast("array<struct<scope:string,key:string,rank:int>>")).otherwise(
        F.transform(F.sequence(F.lit(2), F.greatest(F.lit(2), F.size(parts) - 1)), lambda i: F.struct(
            F.lit("prefix").alias("scope"), F.concat(F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/")).alias("key"),
            (i + 1000).alias("rank"))))
    whole = F.array(F.struct(F.lit("url").alias("scope"), full.alias("key"), F.lit(1_000_000).alias("rank")))
    return F.when(host != "", F.concat(domains, prefixes, whole))


def validity(entries: DataFrame) -> DataFrame:
    """Intervals (list, action, scope, key, since, until) of dated entries (list, action, scope, key, day, present).

    An entry holds from its day until the next day on which the list says otherwise; ``until`` is exclusive
    and null while it is still listed. On one day a removal wins over an addition. Entries with a null key
    or day say nothing. Entries are first reduced to one row per key and day, so that no group is larger
    than the calendar, and days that repeat the state before them do not start an interval.
    """
    by = ["list", "action", "scope", "key"]
    days = entries.filter(F.col("key").isNotNull() & F.col("day").isNotNull()).groupBy(*by, "day").agg(
        F.min(F.coalesce("present", F.lit(True))).alias("present"))
    order = Window.partitionBy(*by).orderBy("day")
    turns = days.withColumn("before", F.lag("present").over(order)).filter(~F.col("present").eqNullSafe(F.col("before")))
    spans = turns.withColumn("until", F.lead("day").over(order)).filter("present")
    return spans.select(*by, F.col("day").alias("since"), "until")


def judge(captures: DataFrame, entries: DataFrame, *, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """The captures with all their columns and url_allowed, url_list, url_key, url_since of the deciding entry.

    Of all entries active at fetch time the closest key decides (whole URL, then longest path prefix, then
    longest domain); between equal keys ``block`` wins over ``allow``, then the first list by name. Without
    an entry, a URL or a fetch time a capture is allowed and the other columns are null. Repeated captures
    are kept and judged alike; empty captures or entries work.

    The verdict depends on URL and day alone, so those are made distinct first. Intervals are cut at year
    ends, and the as-of join is an equi-join on (scope, key, year) with the day inside the interval, whose
    large keys adaptive execution can split.
    """
    pairs = captures.select(F.col(url).alias("url"), F.to_date(fetched).alias("day")).filter(
        "url IS NOT NULL AND day IS NOT NULL").distinct()
    asked = pairs.select("url", "day", F.year("day").alias("year"), F.explode(keys(F.col("url"))).alias("k")).select(
        "url", "day", "year", "k.scope", "k.key", "k.rank")
    asked_years = pairs.agg(F.max(F.year("day"))).first()[0] or 0
    spans = validity(entries)
    last = F.least(F.year(F.coalesce(F.date_sub("until", 1), F.lit("9999-12-31").cast("date"))), F.lit(asked_years))
    spans = spans.withColumn("last", last).filter(F.year("since") <= F.col("last")).withColumn(
        "year", F.explode(F.sequence(F.year("since"), F.col("last"))))
    hit = asked.alias("a").join(spans.alias("s"), (F.col("a.scope") == F.col("s.scope")) & (F.col("a.key") == F.col("s.key"))
                                & (F.col("a.year") == F.col("s.year")) & (F.col("a.day") >= F.col("s.since"))
                                & (F.col("s.until").isNull() | (F.col("a.day") < F.col("s.until"))))
    order = F.struct(-F.col("a.rank"), F.col("s.action") != "block", F.col("s.list"), F.col("s.since"))
    found = hit.groupBy(F.col("a.url").alias("__url"), F.col("a.day").alias("__day")).agg(
        F.min_by(F.struct((F.col("s.action") != "block").alias("ok"), F.col("s.list").alias("list"),
                          F.col("s.key").alias("key"), F.col("s.since").alias("since")), order).alias("__e"))
    rows = captures.withColumns({"__at": F.to_date(fetched)})
    joined = rows.join(found, (rows[url] == found["__url"]) & (rows["__at"] == found["__day"]), "left")
    return joined.select(*[rows[c] for c in captures.columns], F.coalesce(F.col("__e.ok"), F.lit(True)).alias("url_allowed"),
                         F.col("__e.list").alias("url_list"), F.col("__e.key").alias("url_key"),
                         F.col("__e.since").alias("url_since"))
