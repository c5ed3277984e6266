"""The split path for huge groups gives the same rows as plain windows."""

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import aggregate, history, joins, windows
from lakeloom.operators.ordered import Scan, group_values, is_hot, lag_by, scan
from lakeloom.plans import datasets
from tests.conftest import SF, rows
from workloads.histories import change_feed
from workloads.registry import Tables

HOT = 60


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of the rows, one key is null, and the order column ties."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit("hot")).when(n % 50 != 1, F.concat(F.lit("k"), n % 37))
    return spark.range(600).select(
        key.alias("k"), (n * 7919 % 101).alias("o"), n.alias("id"), (n % 5).cast("decimal(10,2)").alias("v"),
        F.when(n % 4 == 0, n.cast("string")).alias("mark")).cache()


def test_scan_split_equals_plain(skewed):
    what = Scan(row_number="rn", rank="rk", sums={"run": F.col("v")}, last={"cur": F.col("mark")},
                prev={"before": F.col("mark")}, next={"after": F.col("mark")})
    assert is_hot(skewed, ["k"], HOT) and not is_hot(skewed, ["k"])
    order = ["o", "id"]
    plain, split = scan(skewed, ["k"], order, what), scan(skewed, ["k"], order, what, HOT)
    assert plain.dtypes == split.dtypes
    assert rows(plain) == rows(split)
    assert rows(scan(skewed, [], [F.desc("id")], what)) == rows(scan(skewed, [], [F.desc("id")], what, HOT))


def test_rank_keeps_ties_together(skewed):
    what = Scan(rank="rk")
    assert rows(scan(skewed, ["k"], ["o"], what)) == rows(scan(skewed, ["k"], ["o"], what, HOT))


def test_split_spreads_the_hot_group(skewed):
    seen = scan(skewed, ["k"], ["o", "id"], Scan(row_number="rn"), HOT).where("k = 'hot'")
    assert seen.count() == 200 and seen.agg(F.max("rn")).first()[0] == 200


def test_lag_and_group_values(skewed):
    lags = {"a": ("mark", 1), "b": ("id", 3)}
    assert rows(lag_by(skewed, ["k"], ["o", "id"], lags)) == rows(lag_by(skewed, ["k"], ["o", "id"], lags, HOT))
    values = {"t": F.sum("v"), "m": F.max("id")}
    assert rows(group_values(skewed, ["k"], values, hot=False)) == rows(group_values(skewed, ["k"], values, hot=True))


@pytest.mark.parametrize("op", [
    lambda d, n: windows.version_suffix(d, "k", [F.desc("o"), "id"], "v2", n),
    lambda d, n: windows.surrogate_key(d.withColumn("unit", F.col("id") % 4), "k", "unit", ["o"], ["id"], max_group_rows=n),
    lambda d, n: windows.fill_forward(d, ["k"], ["o", "id"], ["mark"], max_group_rows=n),
    lambda d, n: windows.group_number(d, ["k"], ["o", "id"], "mark", max_group_rows=n),
    lambda d, n: windows.running_total(d, ["k"], ["o", "id"], F.col("v"), max_group_rows=n),
    lambda d, n: windows.latest_value(d, ["k"], ["o", "id"], {"mark": "m"}, bool(n)),
    lambda d, n: windows.latest_rows(d, ["k"], "o", bool(n)),
    lambda d, n: windows.current_flag(d, ["k"], ["o"], "cur", bool(n)),
    lambda d, n: windows.occurrence(d, ["k"], ["o", "id"], max_group_rows=n),
    lambda d, n: windows.resubmissions(d.withColumn("dec", F.when(F.col("id") % 3 > 0, F.col("o") + 1)), ["k"], "o", "dec", F.col("id") % 2 == 0, ["id"], max_group_rows=n),
    lambda d, n: windows.outline_labels(d, ["k"], ["o", "id"], "mark", "^1", F.col("v") > 2, F.col("v") > 1, n),
    lambda d, n: aggregate.describe(d, ["o", "id"], max_group_rows=n),
])
def test_operators_on_a_hot_group(skewed, op):
    assert rows(op(skewed, None)) == rows(op(skewed, HOT))


def test_outline_rows_on_a_hot_document(spark):
    from workloads.windows import SIZES, _spans

    spans = _spans(Tables(spark, SF)).where(F.length("line") < 400)
    run = lambda n: windows.outline_rows(spans, "doc_id", "seq", "size", "line", SIZES, "^T", "on", "the", n)
    assert rows(run(None)) == rows(run(HOT))


def test_history_and_as_of_on_a_hot_key(spark):
    t = Tables(spark, SF)
    feed = change_feed(t)
    run = lambda n: history.replay(feed, "user_id", "id", "day", "op", close_on_upsert=True, max_group_rows=n)
    assert rows(run(None)) == rows(run(40))
    v = run(None).groupBy("id", "effective_date").agg(F.max("end_date").alias("end_date"), F.max("kinds").alias("kinds"))
    facts = t.events.select(F.col("user_id").cast("string").alias("id"), F.col("ts").cast("date").alias("day"), "event_id")
    find = lambda n: joins.as_of(facts, v, "id", "day", "effective_date", "end_date", ["kinds"], ["event_id"], max_group_rows=n)
    assert rows(find(None)) == rows(find(40))


def test_bucket_by_cutoff_split(spark, skewed):
    days = skewed.select("id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("o").cast("int")).alias("d"))
    cut = days.where("id % 40 = 0").select(F.col("d").alias("c"))
    run = lambda n: windows.bucket_by_cutoff(days, "d", cut, "c", max_group_rows=n)
    assert rows(run(None)) == rows(run(HOT))


def test_contract_cost_on_a_hot_year(spark):
    raw = spark.range(1, 61).select((F.col("id") % 2).alias("fy"), F.col("id").alias("mo"), (F.col("id") * 1.5).alias("spent"), F.lit(100.0).alias("budget"))
    run = lambda n: datasets.contract_cost(raw, "fy", "mo", {"spent": "budget"}, n)
    assert rows(run(None)) == rows(run(40))
