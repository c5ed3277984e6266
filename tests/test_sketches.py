"""Daily sketches merged over spans, and column relations by the sets of columns that hold a value."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import quality, sketches
from tests.conftest import SF
from workloads.registry import Tables

D = dt.date


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(7)
    data = [(D(2024, 1, 1) + dt.timedelta(days=rng.randrange(60)), rng.randrange(2000), rng.choice("abcde"), rng.gauss(0, 1) if i % 9 else None, None) for i in range(6000)]
    data += [(None, -5, "z", 1e300, None), (D(2024, 1, 1), 2**62, "x" * 100_000, 0.0, None), (D(2024, 1, 1), 2**62, "x" * 100_000, 0.0, None)]
    return spark.createDataFrame(data, "day date, `n.k` bigint, label string, v double, empty string"), data


def _read(df):
    return {r["column"]: r for r in sketches.read(df).collect()}


def test_merged_days_say_what_the_rows_say(facts):
    df, data = facts
    whole = [r for r in data if r[0]]
    spans = df.sparkSession.createDataFrame([("all", D(2023, 1, 1), D(2025, 1, 1))], "span string, first_day date, last_day date")
    daily = sketches.sketch(df, "day")
    got = _read(sketches.over_spans(daily, spans))
    assert set(got) == {"n.k", "label", "v", "empty"}
    for place, name in ((1, "n.k"), (2, "label"), (3, "v")):
        values = sorted(r[place] for r in whole if r[place] is not None)
        r, n = got[name], len(set(values))
        assert (r.n_rows, r.n_null) == (len(whole), len(whole) - len(values))
        assert abs(r.n_distinct_estimate - n) <= max(1, 4 * sketches.relative_error() * n)
        if place != 2:
            assert (r.min_value, r.max_value) == (str(int(values[0])), str(int(values[-1])))
            assert all(values[int(len(values) * (p - 0.02))] <= q <= values[int(len(values) * (p + 0.02))] for p, q in ((0.25, r.q25), (0.5, r.q50), (0.75, r.q75)))
    top = {x["item"]: x["count"] for x in got["label"].top_values}
    assert {k: v for k, v in top.items() if len(k) == 1} == {k: sum(r[2] == k for r in whole) for k in "abcde"}
    # a very long value stands under its hash
    assert len(top) == 6 and max(map(len, top)) == 64 and got["label"].max_value == "x" * 100_000 and got["label"].q50 is None
    e = got["empty"]
    assert (e.n_rows, e.n_null, e.n_distinct_estimate, e.min_value, e.top_values) == (len(whole), len(whole), 0, None, [])


def test_spans_overlap_and_touch_only_their_days(facts):
    df, data = facts
    spans = [("jan", D(2024, 1, 1), D(2024, 1, 31)), ("day", D(2024, 1, 5), D(2024, 1, 5)), ("none", D(2030, 1, 1), D(2030, 2, 1)), ("backwards", D(2024, 2, 1), D(2024, 1, 1))]
    daily = sketches.sketch(df, "day", ["label"])
    listed = df.sparkSession.createDataFrame(spans, "span string, first_day date, last_day date")
    got = {r.span: r.n_rows for r in sketches.read(sketches.over_spans(daily, listed)).collect()}
    assert got == {n: sum(r[0] is not None and a <= r[0] <= b for r in data) for n, a, b in spans[:2]}
    assert daily.where("day is null").first().n_rows == 1


def test_merging_twice_is_merging_once(facts):
    df, _ = facts
    daily = sketches.sketch(df, "day", ["n.k", "label"])
    weekly = sketches.merge(daily.withColumn("week", F.trunc("day", "week")), "week")
    once, twice = _read(sketches.merge(daily)), _read(sketches.merge(weekly))
    for c in once:
        assert (once[c].n_rows, once[c].min_value, once[c].max_value) == (twice[c].n_rows, twice[c].min_value, twice[c].max_value)
        assert abs(once[c].n_distinct_estimate - twice[c].n_distinct_estimate) <= 0.05 * once[c].n_distinct_estimate


def test_sketches_of_nothing(facts):
    df, _ = facts
    assert sketches.sketch(df.limit(0), "day").count() == 0
    with pytest.raises(ValueError):
        sketches.sketch(df.select("day"), "day")


def test_relations_over_more_columns_than_a_word_has_bits(spark):
    wide = {f"t{i}": spark.range(i, 90).select(F.col("id").alias(f"t{i}_key"), F.lit(None).cast("string").alias(f"t{i}_note")) for i in range(70)}
    got = {(r.child, r.parent): (r.n_values, r.n_shared) for r in quality.related_columns(wide, coverage_at_least=0.0).collect()}
    assert got == {(f"t{i}", f"t{j}"): (90 - i, 90 - max(i, j)) for i in range(70) for j in range(70) if i != j}


def test_relations_read_each_table_once(spark):
    t = Tables(spark, SF)
    df = t.lineitem
    plan = quality.column_sets([(0, df, "l_orderkey"), (70, df, "l_partkey"), (3, t.orders, "o_orderkey")])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2


def test_relations_without_candidates(spark):
    one = {"a": spark.createDataFrame([(1, "x")], "a_id int, a_name string")}
    got = quality.related_columns(one)
    assert got.count() == 0 and set(got.columns) >= {"child", "parent", "coverage", "n_shared", "n_values", "similarity"}
