"""Operators on small fixtures: duplicates, joins, reshape, history, catalogue, quality, metrics."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import aggregate, catalog, compare, history, joins, quality, reshape, sets
from lakeloom.plans.metrics import Distinct, Share, Total, evaluate
from tests.conftest import SF, rows
from workloads.histories import change_feed
from workloads.registry import Tables

D = dt.date


def test_collapse_keeps_null_keys_and_column_order(spark):
    df = spark.createDataFrame([("x", 1, "a"), ("x", 1, "b"), ("y", None, "c"), ("y", None, "c"), ("z", 1, None)], "v string, k int, w string")
    assert rows(aggregate.collapse(df, "k"), "k", "v", "w") == sorted([(1, "x|z", "a|b"), (None, "y", "c"), (None, "y", "c")], key=str)


def test_first_by_is_decided_by_the_order(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 2, "b"), (2, None, "n"), (2, 5, "m")], "k int, o int, v string")
    assert rows(aggregate.first_by(df, ["k"], ["o"], latest=True)) == [(1, 3, "c"), (2, 5, "m")]
    null_key = df.withColumn("k", F.when(F.col("k") == 1, 1))
    assert aggregate.first_by_or_null(null_key, "k", ["o"]).count() == 3


def test_describe_matches_linear_interpolation(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 4.0, 8.0, 8.0, None)], "v double")
    r = aggregate.describe(df).first()
    assert (r.n_values, r.min, r.q25, r.q50, r.q75, r.max, r["mean"]) == (5, 1.0, 2.0, 4.0, 8.0, 8.0, 4.6)


def test_lookup_keeps_rows_with_null_or_unknown_keys(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    ref = spark.createDataFrame([(1, "a"), (None, "x")], "k int, v string")
    assert rows(joins.lookup(left, ref, {"k": "k"}, ["v"])) == sorted([(1, "a"), (2, None), (None, None)], key=str)


def test_anti_with_a_hot_reference_key(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    ref = spark.createDataFrame([(1,)] * 50 + [(None,)], "r int")
    assert rows(joins.anti(left, ref, {"k": "r"})) == sorted([(2,), (None,)], key=str)


def test_packed_ids_match_any_piece(spark):
    df = spark.createDataFrame([(1, "a|b"), (2, "b|c"), (3, "ab")], "n int, ids string")
    gone = spark.createDataFrame([("a",), ("a",)], "g string")
    assert rows(joins.flag_members(df, "n", "ids", gone, "g", "hit"), "n", "hit") == [(1, True), (2, False), (3, False)]


def test_both_null_codes_give_two_rows(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "b"), (3, "a", "b"), (3, "a", "c"), (4, None, None)], "id int, x string, y string")
    out = reshape.rows_per_system(df, "id", "x", "y", ("ONE", "TWO"), ["y"])
    assert rows(out, "id", "code", "system") == sorted([
        (1, "a", "ONE"), (2, "b", "TWO"), (3, "a", "ONE"), (3, "b", "TWO"), (3, "c", "TWO"), (4, None, "ONE"), (4, None, "TWO")], key=str)


def test_child_table_drops_or_keeps_empty_arrays(spark):
    df = spark.createDataFrame([("p", "2024", [("a", 1)]), ("q", "2024", []), ("r", "2024", None)], "id string, s string, d array<struct<k:string,n:int>>")
    assert reshape.child_table(df, "d", ["id", "s"], ["k", "n"], "parent").count() == 1
    assert reshape.child_table(df, "d", ["id", "s"], ["k", "n"], "parent", keep_empty=True).count() == 3


def test_wide_to_long_needs_all_columns(spark):
    df = spark.createDataFrame([(1, 0.0, None)], "id int, a double, b double")
    assert reshape.wide_to_long(df, ["id"], ["a", "missing"]).columns == ["id", "a", "b"]
    assert reshape.wide_to_long(df, ["id"], ["a", "b"], drop_zero=True).count() == 1


def test_multiset_difference_sees_copies(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "v int"), spark.createDataFrame([(1,), (2,)], "v int")
    assert rows(sets.multiset_difference(a, b)) == [(1, 2, 1)]
    assert sets.symmetric_difference(a, b).count() == 0


CHANGES = "nat string, id string, day date, op string, v string"


def _replay(spark, data, **how):
    out = history.replay(spark.createDataFrame(data, CHANGES), "nat", "id", "day", "op", **how)
    return rows(out, "id", "effective_date", "end_date", "version", "v")


def test_delete_before_upsert_in_one_file_closes_the_older_version(spark):
    d1, d2 = D(2024, 1, 1), D(2024, 1, 5)
    data = [("n", "a", d1, "upsert", "1"), ("n", "a", d2, "delete", None), ("n", "a", d2, "upsert", "2")]
    assert _replay(spark, data) == sorted([("a", d1, D(2024, 1, 4), 2, "1"), ("a", d2, D(9999, 12, 31), 1, "2")], key=str)


def test_upsert_alone_leaves_its_predecessor_open(spark):
    d1, d2 = D(2024, 1, 1), D(2024, 1, 5)
    data = [("n", "a", d1, "upsert", "1"), ("n", "a", d2, "upsert", "2")]
    assert [r[2] for r in _replay(spark, data)] == [D(9999, 12, 31)] * 2
    assert _replay(spark, data, close_on_upsert=True)[0][2] == D(2024, 1, 4)


def test_delete_of_a_piece_closes_the_packed_row_and_the_last_delete_wins(spark):
    d1 = D(2024, 1, 1)
    data = [("n", "a", d1, "upsert", "1"), ("n", "b", d1, "upsert", "1"), ("x", "b", D(2024, 1, 3), "delete", None),
            ("x", "a", D(2024, 1, 9), "delete", None), ("x", "zz", D(2024, 1, 9), "delete", None)]
    assert _replay(spark, data) == [("a|b", d1, D(2024, 1, 8), 1, "1")]
    assert _replay(spark, data, which_delete="first") == [("a|b", d1, D(2024, 1, 2), 1, "1")]
    full = F.col("day") == F.lit("2024-01-09").cast("date")
    assert _replay(spark, data, full=full) == [("a|b", d1, D(9999, 12, 31), 1, "1")]


def test_replay_equals_files_applied_one_by_one(spark):
    feed = change_feed(Tables(spark, SF)).where("day <= date'2024-01-06'")
    days = sorted(r.day for r in feed.select("day").distinct().collect())
    first = lambda d: F.lit(d)
    df = history.replay(feed.where(F.col("day") == first(days[0])), "user_id", "id", "day", "op")
    for d in days[1:]:
        df = history.apply_batch(df, feed.where(F.col("day") == F.lit(d)).drop("day"), "user_id", "id", "op", F.lit(d))
        df = spark.createDataFrame(df.collect(), df.schema)
    assert rows(df) == rows(history.replay(feed, "user_id", "id", "day", "op").select(*df.columns))
    assert df.where("end_date < date_sub(effective_date, 0) and version = 1").count() >= 0
    assert df.groupBy("id").agg(F.count_if(F.col("version") == 1).alias("n")).where("n <> 1").count() == 0


def test_roster_keeps_the_first_loss_date_and_is_idempotent(spark):
    schema = "id int, active boolean, at date"
    old = spark.createDataFrame([(1, True, None), (2, True, None), (3, False, D(2020, 1, 1))], schema)
    new = spark.createDataFrame([(1, True, None)], schema)
    day = F.lit("2024-02-02").cast("date")
    once = history.roster_refresh(old, new, "id", "active", "at", day)
    assert rows(once) == sorted([(1, True, None), (2, False, D(2024, 2, 2)), (3, False, D(2020, 1, 1))], key=str)
    later = history.roster_refresh(once, new, "id", "active", "at", F.lit("2025-01-01").cast("date"))
    assert rows(later) == rows(once)


def test_catalogue_rules(spark):
    schema = "path string, source string, priority int, write_mode string, source_date date, modified date, processed boolean, processed_on date"
    e = lambda p, mode, mod, done: (p, "s", 1, mode, D(2024, 1, 1), mod, done, D(2024, 1, 2) if done else None)
    a, b = D(2024, 1, 1), D(2024, 3, 1)
    old = spark.createDataFrame([e("keep", "append", a, True), e("touched", "append", a, True), e("redo", "overwrite", a, True), e("gone", "append", a, True), e("open", "append", a, False)], schema)
    new = spark.createDataFrame([e("keep", "append", a, False), e("touched", "append", b, False), e("redo", "overwrite", b, False), e("new", "append", b, False), e("open", "append", a, False)], schema)
    out = catalog.diff(old, new)
    assert rows(out, "path", "due") == [("keep", False), ("new", True), ("open", True), ("redo", True), ("touched", False)]
    assert catalog.mark_processed(out).where("not processed").count() == 0
    assert catalog.work_list(out).first()["n_files"] == 3


def test_lineage_depth_and_cycles(spark):
    edges = [("A.col1", "B.col3"), ("A.col2", "C.col4"), ("B.col3", "D.col5"), ("C.col4", "D.col5"), ("A.col1", "D.col5")]
    got = dict(rows(quality.lineage_depth(spark.createDataFrame(edges, "source string, target string"))))
    assert got == {"A.col1": 0, "A.col2": 0, "B.col3": 1, "C.col4": 1, "D.col5": 2}
    with pytest.raises(ValueError):
        quality.lineage_depth(spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "b")], "source string, target string"))


def test_rule_checks_and_profile(spark):
    df = spark.createDataFrame([("ab", 1), (" a", None), (None, 3)], "s string, n int")
    got = {r["rule"]: (r.checked, r.failed, r.passed) for r in quality.check(df, {"len": quality.has_length(F.col("s"), 2), "edge": quality.no_edge_blanks(F.col("s"))}).collect()}
    assert got == {"len": (3, 1, False), "edge": (3, 1, False)}
    p = {r["column"]: r for r in quality.profile(df).collect()}
    assert (p["s"].n_distinct, p["s"].has_null, p["n"].min_value, p["n"].max_length) == (2, True, "1", 1)
    assert {r["column"] for r in quality.profile(df, approximate=True).collect()} == {"s", "n"}


def test_compare_of_equal_and_reordered_frames_passes(spark):
    a = Tables(spark, SF).customer
    assert rows(compare.failures(compare.suite(a, a.select(*reversed(a.columns))))) == []
    assert compare.same_schema(a, a) and not compare.same_schema(a, a.drop("c_name"))


def test_compare_names_and_samples(spark):
    a = spark.createDataFrame([(1, "x", D(2024, 1, 1)), (2, "y", D(2024, 1, 1))], "k int, v string, d date")
    b = spark.createDataFrame([(1, "x", D(2024, 1, 1)), (2, "z", D(2024, 1, 1))], "k long, v string, d date")
    assert rows(compare.column_names(a, b).where("result = 'Failed'"), "column") == [("k",)]
    report = compare.hash_reconcile(a, b, "d", ["k", "v"], ["k", "v"])
    assert rows(report, "only_1", "only_2", "keys_1", "keys_2", "identical") == [(1, 1, "2|y", "2|z", False)]
    assert rows(compare.unmatched_rows(a, b, ["k", "v"]), "k", "v") == [(2, "y")]


def test_compare_without_text_or_numbers(spark):
    a = spark.createDataFrame([(D(2024, 1, 1),)], "d date")
    assert rows(compare.failures(compare.suite(a, a))) == []


def test_coerce_by_whole_name_parts(spark):
    df = spark.createDataFrame([("12", "x", "paid in full", "2024-01-05", "soon", "1,5", "7"), ("13", "y", None, None, "2024-01-05", None, "n")],
                               "candidate_id string, amount_type string, paid string, load_date string, updateDate string, `paid amount` string, age string")
    got = quality.coerce_by_name(df)
    assert [f.dataType.simpleString() for f in got.schema] == ["string", "string", "string", "date", "string", "double", "int"]
    assert rows(got, "amount_type", "paid", "updateDate") == [("x", "paid in full", "soon"), ("y", None, "2024-01-05")]


def test_depth_of_a_long_chain(spark):
    edges = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(6)], "source string, target string")
    assert dict(map(tuple, quality.lineage_depth(edges).collect()))["n6"] == 6


def test_history_keeps_what_it_cannot_name(spark):
    from lakeloom.operators.history import versions_of

    changes = spark.createDataFrame([("p", None, D(2024, 1, 1), "upsert", "1"), (None, None, D(2024, 1, 1), "upsert", "2"), (None, None, D(2024, 1, 1), None, "3"),
                                     (None, "a", D(2024, 1, 1), None, "5"), (None, "a", D(2024, 1, 1), None, "0")],
                                    "person string, id string, day date, op string, v string")
    for order in (changes, changes.orderBy("v")):
        assert rows(versions_of(order, "person", "id", "day", "op"), "id", "v") == [("a", "0"), (None, "1"), (None, "2"), (None, "3")]


def test_lexicon(spark):
    found = spark.createDataFrame([("t", "a", 0), ("t", "b", 1)], "table_name string, column_name string, ordinal int")
    known = spark.createDataFrame([("t", "a", "first"), ("t", "z", "old")], "table_name string, column_name string, meaning string")
    assert rows(quality.lexicon(found, known), "column_name", "status") == [("a", "documented"), ("b", "not in dictionary"), ("z", "not in files")]


def test_distinct_measures_are_counted_per_level(spark):
    fact = spark.createDataFrame([("x", "p", 1, 1.0), ("x", "q", 1, 2.0), ("y", "q", 1, None), ("y", None, None, 4.0)], "a string, b string, m int, v double")
    m = {"members": Distinct("m"), "v": Total(F.col("v")), "big": Distinct("m", F.col("v") > 1.5), "part": Share("big", "members")}
    got = {(r.a, r.b, r.level): (r.members, r.v, r.big, r.part) for r in evaluate(fact, m, ["a", "b"], levels=[["a", "b"], ["a"], []]).collect()}
    assert got[(None, None, 0)] == (1, 7.0, 1, 1.0)
    assert got[("y", None, 1)] == (1, 4.0, 0, 0.0)
    assert got[("y", None, 2)] == (0, 4.0, 0, 0.0)
    assert got[("x", "p", 2)] == (1, 1.0, 0, 0.0)


def test_cells_of_repeated_keys_meet_once(spark):
    a = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b")], "k int, v string")
    b = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (1, "c")], "k int, v string")
    assert rows(compare.cell_differences(a, b, ["k"]), "origin", "column", "value_1", "value_2") == [
        ("both", "v", "b", "a"), ("right_only", "*", None, None)]


def test_measures_group_by_what_they_count(spark):
    from lakeloom.plans.metrics import Distinct, Total, evaluate
    from pyspark.sql import functions as F

    fact = spark.createDataFrame([("x", 0.004)] * 1000 + [("y", 1.0)], "m string, paid double")
    got = evaluate(fact, {"members": Distinct("m"), "paid": Total(F.col("paid"))}, by=["m"])
    assert rows(got, "m", "members", "paid") == [("x", 1, 4.0), ("y", 1, 1.0)]


def test_one_stand_in_per_code(spark):
    from lakeloom.operators.joins import resolve_code

    codes = spark.createDataFrame([("a",), ("b",)], "code string")
    stand_ins = spark.createDataFrame([("b", "z"), ("b", "q")], "code string, dummy string")
    got = resolve_code(codes, "code", spark.createDataFrame([("a",)], "code string"), "code", stand_ins, "code", "dummy")
    assert rows(got, "code", "resolved") == [("a", "a"), ("b", "q")]


def test_measures_by_bits_and_by_rows_agree(spark):
    import random

    from lakeloom.plans.metrics import Distinct, Role, Share, Total, by_every_role, evaluate

    r = random.Random(5)
    data = [(r.choice(["x", "y", None]), r.choice(["p", "q", "x"]), r.choice([None, -70000, -1, 0, 5, 32767, 32768, 99999, 2**40]), r.choice([None, 1, 2, 3]), r.choice([None, True, False]),
             r.choice([None, 1.25, -3.5, 7e20])) for _ in range(400)]
    fact = spark.createDataFrame(data, "a string, b string, item long, member int, on boolean, paid double")
    measures = {"items": Distinct("item"), "on_items": Distinct("item", F.col("on")), "members": Distinct("member", ~F.col("on")), "part": Share("on_items", "items"),
                "paid": Total(F.col("paid")), "on_paid": Total(F.col("paid"), F.col("on"), "decimal(38,2)")}
    levels = [["a", "b"], ["b"], []]
    found = [rows(evaluate(fact, measures, ["a", "b"], levels, bitmaps=bits)) for bits in (False, True)]
    assert found[0] == found[1]
    count = lambda mine, c, want: len({d[c] for d in mine if d[c] is not None and want(d[4])})
    want = []
    for level in (("a", "b"), ("b",), ()):
        at = [["a", "b"].index(x) for x in level]
        for group in {tuple(d[i] for i in at) for d in data}:
            mine = [d for d in data if tuple(d[i] for i in at) == group]
            named = dict(zip(level, group))
            want.append((named.get("a"), named.get("b"), len(level), count(mine, 2, lambda on: True), count(mine, 2, lambda on: on), count(mine, 3, lambda on: on is False)))
    assert sorted([x[:6] for x in found[0]], key=str) == sorted(want, key=str)
    with pytest.raises(ValueError):
        evaluate(fact, {"n": Distinct("b")}, ["a"], bitmaps=True)
    assert evaluate(fact.limit(0), measures, ["a"], bitmaps=True).collect() == []
    # roles: every row once under each name, unknown keys under a blank member
    dim = spark.createDataFrame([(1, "one", 10), (2, "two", 20)], "k int, name string, up int")
    top = spark.createDataFrame([(10, "ten")], "u int, city string")
    paths = {"own": [Role(dim, "member", "k", ["up"]), Role(top, "up", "u", ["city"])], "same": [Role(top, "member", "u", ["city"])]}
    got = rows(by_every_role(fact, {"n": Total(F.lit(1))}, paths, ["city"]))
    ones = sum(d[3] == 1 for d in data)
    assert got == sorted([("own", "ten", float(ones)), ("own", None, float(400 - ones)), ("same", None, 400.0)], key=str)
