"""Readers, writers and streaming jobs."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from lakeloom import session as s
from lakeloom.operators import catalog, history, windows
from lakeloom.sources import files, tables
from lakeloom.sources.contracts import Contract, enforce
from lakeloom.streaming import history_store, jobs, resubmissions
from tests.conftest import SF, rows
from workloads.histories import change_feed
from workloads.registry import Tables


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="lakeloom-test-")


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_enveloped_files_with_dates_in_their_names(spark, folder):
    body = 'REPORT,1\nid,amount,note\n1,"1,234.50","a ""b"" c"\n2,,x\nEND\n'
    put(f"{folder}/drop/CL_20240105.csv", body)
    put(f"{folder}/drop/CL_2024-01-06.csv", body)
    df = files.read_enveloped(spark, f"{folder}/drop", "id int, amount string, note string")
    assert rows(df.selectExpr("id", "amount", "note", "cast(source as string) s")) == sorted([
        (1, "1,234.50", 'a "b" c', "2024-01-05"), (2, None, "x", "2024-01-05"), (1, "1,234.50", 'a "b" c', "2024-01-06"), (2, None, "x", "2024-01-06")], key=str)


def test_contract_reads_by_declared_schema_and_fails_on_missing(spark, folder):
    put(f"{folder}/a.csv", "id,when,extra\n007,2024_02_03,z\n8,bad,y\n")
    how = Contract("t", "id string, when string, extra string", "key string, day date", dates=["when"], keep=["id", "when"], renames={"id": "key", "when": "day"})
    out = how.shape(how.read(spark, f"{folder}/a.csv"))
    assert out.dtypes == [("key", "string"), ("day", "date")]
    assert [r.key for r in out.orderBy("key").collect()] == ["007", "8"]
    with pytest.raises(ValueError):
        enforce(out, "key string, other int")


def test_listing_and_inventory(spark, folder):
    put(f"{folder}/x/CL90_20240105.csv", "a,b\n1,2\n")
    put(f"{folder}/x/CL90_20240106.csv", "a,b\n1,2\n")
    os.utime(f"{folder}/x/CL90_20240106.csv", (2_000_000_000, 2_000_000_000))
    listing = files.list_files(spark, folder, "*.csv")
    sources = spark.createDataFrame([("x", "claims", 1, "append")], "source_key string, source string, priority int, write_mode string")
    assert rows(files.with_source_facts(listing, sources), "file_type", "source", "priority") == [("csv", "claims", 1)] * 2
    assert rows(files.newest_per_folder(listing), "file_name") == [("CL90_20240106.csv",)]
    assert files.list_files(spark, folder, "*.csv", changed_after="2030-01-01T00:00:00").count() == 1
    assert rows(files.column_inventory(spark, {"x": f"{folder}/x"}), "column_name", "ordinal") == [("a", 0), ("b", 1)]


def test_save_by_schema(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    assert tables.save_by_schema(df, "report") == "overwrite"
    assert tables.save_by_schema(df.select("v", "k"), "report") == "append"
    assert rows(spark.table("report"), "k", "v") == [(1, "a"), (1, "a")]
    assert tables.save_by_schema(df.withColumn("z", F.lit(1)), "report") == "overwrite"
    assert spark.table("report").count() == 1


def test_remove_rows_keeps_unknown(spark, folder):
    path = f"{folder}/t"
    tables.overwrite(spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "k int, v string"), path)
    tables.remove_rows(spark, path, F.col("v") == "x")
    assert rows(tables.read(spark, path), "k") == [(2,), (3,)]


def test_exports_log_and_synthetic(spark, folder):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    tables.export_csv(df, f"{folder}/csv", ";")
    assert rows(files.read_delimited(spark, f"{folder}/csv", delimiter=";")) == [("1", "a"), ("2", "b")]
    for _ in range(2):
        catalog.append_log(spark, [("r", "read", "Failed", "m")], f"{folder}/log")
    assert spark.read.parquet(f"{folder}/log").count() == 2
    a, b = tables.synthetic(spark, 100, 7), tables.synthetic(spark, 100, 7)
    assert rows(a) == rows(b) and a.where("uniform between 0 and 1 and whole between 0 and 99").count() == 100


def test_shared_folder_comes_from_the_session(spark):
    assert s.scratch(spark, "x").startswith(s.shared_dir(spark).rstrip("/"))
    assert s.scratch(spark, "x") != s.scratch(spark, "x")


FEED = "user_id long, id string, day date, op string, kinds string"


@pytest.mark.parametrize("how", ["first"])
def test_stream_of_late_files_equals_replay(spark, folder, how):
    """Files arrive out of order over several runs of the same job, one of them a full file; one row has no op, one no id."""
    feed = change_feed(Tables(spark, SF)).where("day <= date'2024-01-08'")
    odd = spark.createDataFrame([(1, "1", dt.date(2024, 1, 6), None, "odd"), (2, None, dt.date(2024, 1, 6), "upsert", "odd"), (None, None, dt.date(2024, 1, 2), "upsert", "odd"),
                                 (3, None, dt.date(2024, 1, 6), "delete", "odd")], FEED)
    feed = s.cut(feed.unionByName(odd))
    full = F.col("day") == F.lit("2024-01-07").cast("date")
    names = ("user_id", "id", "day", "op")
    sizes = []
    drops = ["day <= '2024-01-03' or day = '2024-01-05'", "day = '2024-01-04'", "day > '2024-01-05'"]
    for number, part in enumerate(drops):
        feed.where(part).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = jobs.new_files(spark, f"{folder}/in", feed.schema)
        history_store.keep(stream, f"{folder}/out", f"{folder}/ck", *names, full=full, which_delete=how, buckets=4).awaitTermination()
        sizes.append(spark.read.parquet(f"{folder}/out/versions/batch={number}").count())
    for close in (False, True):
        got = history_store.current(spark, f"{folder}/out", feed.schema, *names, close_on_upsert=close)
        assert rows(got) == rows(history.replay(feed, *names, full=full, which_delete=how, close_on_upsert=close).select(*got.columns))
    counted = history_store.audit(spark, f"{folder}/out").orderBy("batch").collect()
    assert [r.delta_raw for r in counted] == [feed.where(x).count() for x in drops]
    assert all(r.delete_planned == r.delete_actual and r.upsert_planned == r.upsert_actual and r.total_planned == r.total_actual for r in counted)
    assert counted[-1].total_actual == got.count() and sizes[1] < 3 * counted[1].delta_raw


@pytest.mark.parametrize("how, close", [("last", False), ("first", False), ("last", True), ("first", True)])
def test_files_applied_one_by_one_by_every_rule(spark, how, close):
    feed = s.cut(change_feed(Tables(spark, SF)).where("day <= date'2024-01-07'"))
    odd = spark.createDataFrame([(1, None, dt.date(2024, 1, 6), "upsert", "a"), (2, None, dt.date(2024, 1, 6), "upsert", "a"), (2, None, dt.date(2024, 1, 7), "upsert", "a")], FEED)
    feed = feed.unionByName(odd)
    full_day = dt.date(2024, 1, 5)
    rule = {"which_delete": how, "close_on_upsert": close, "reached_name": "reached"}
    df = history.replay(feed.where("day <= '2024-01-04'"), "user_id", "id", "day", "op", **rule)
    for day in (5, 6, 7):
        d = dt.date(2024, 1, day)
        df = s.cut(history.apply_batch(df, feed.where(F.col("day") == F.lit(d)).drop("day"), "user_id", "id", "op", F.lit(d), full=d == full_day, **rule))
    want = history.replay(feed, "user_id", "id", "day", "op", full=F.col("day") == F.lit(full_day), **rule)
    assert rows(df) == rows(want.select(*df.columns))


def test_audit_counts_rows_without_op_as_upserts(spark):
    feed = spark.createDataFrame([(1, "a", dt.date(2024, 1, 1), None, "x"), (1, "a", dt.date(2024, 1, 2), "delete", "x"), (2, "b", dt.date(2024, 1, 2), "upsert", "x")],
                                 FEED)
    counted = history.audit(feed, "user_id", "id", "day", "op").orderBy("day").collect()
    assert [(r.upsert_raw, r.upsert_planned, r.upsert_actual, r.delete_planned, r.delete_actual) for r in counted] == [(1, 1, 1, 0, 0), (1, 1, 1, 1, 1)]


def test_streamed_resubmissions_wait_for_late_requests(spark, folder):
    kinds = "k string, row long, asked date, decided date, needs boolean"
    day = lambda m, d: dt.date(2024, m, d)
    drops = [[("a", 1, day(1, 1), day(1, 2), True), ("a", 3, day(1, 5), day(1, 6), True), (None, 9, day(1, 1), None, True), ("a", 8, None, None, True)],
             [("a", 2, day(1, 3), day(1, 9), True)],
             [("b", 4, day(3, 1), None, None)],
             [("a", 5, day(1, 4), day(1, 4), True), ("a", 6, day(3, 2), None, True), ("a", 7, day(3, 2), None, True), ("b", 10, day(3, 1), None, True)]]
    expected = [{1: 0, 3: 1, 9: 0}, {1: 0, 2: 1, 3: 0, 9: 0}, {1: 0, 2: 1, 3: 0, 4: 0, 9: 0}, {1: 0, 2: 1, 3: 0, 4: 0, 6: 3, 7: 0, 9: 0, 10: 0}]
    for drop, want in zip(drops, expected):
        spark.createDataFrame(drop, kinds).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        numbers = resubmissions.resubmissions(jobs.new_files(spark, f"{folder}/in", spark.createDataFrame([], kinds).schema), ["k"], "asked", "decided",
                                              F.col("needs"), ["row"], "10 days")
        jobs.update_each(numbers, f"{folder}/out", f"{folder}/ck").awaitTermination()
        assert dict(rows(jobs.newest_values(spark, f"{folder}/out", ["k", "row"]), "row", "resubmission")) == want


@pytest.mark.parametrize("kinds", ["k long, s string, t date", "k double, s binary, t timestamp"])
def test_streamed_resubmissions_keep_a_state_for_many_keys(spark, folder, kinds):
    import random

    r, nan, day = random.Random(7), float("nan"), lambda i: dt.date(2024, 1, 1) + dt.timedelta(i)
    whole = "long" in kinds
    key = lambda i: (r.choice([None, i, 2**53 + i, -i] if whole else [None, nan, 0.0, -0.0, i / 2]), r.choice([None, "", "b"] if whole else [None, b"", b"b"]))
    late = lambda i: None if i % 4 == 0 else day(i) if whole else dt.datetime(1500, 1, 1, 0, 0, 0, i)
    made = [(*key(i % 40), late(i), i, day(r.randrange(60)) if i % 50 else dt.date(9999, 12, 31) if i == 350 else None, None if i % 3 == 0 else day(r.randrange(90)), r.choice([True, True, None]))
            for i in range(400)]
    names = f"{kinds}, id long, asked date, decided date, needs boolean"
    for part in (made[:200], made[200:]):
        spark.createDataFrame(part, names).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        numbers = resubmissions.resubmissions(jobs.new_files(spark, f"{folder}/in", spark.createDataFrame([], names).schema), ["k", "s"], "asked", "decided",
                                              F.col("needs"), ["t", "id"], "100 days", buckets=8)
        done = jobs.update_each(numbers, f"{folder}/out", f"{folder}/ck")
        done.awaitTermination()
        # a packed value and the two entries of a timer for each bucket, where every key had its own
        assert done.lastProgress["stateOperators"][0]["numRowsTotal"] <= 3 * 8
    every = spark.createDataFrame(made, names).where("asked is not null")
    assert every.select("k", "s").distinct().count() > 50
    want = windows.resubmissions(every, ["k", "s"], "asked", "decided", F.coalesce("needs", F.lit(False)), ["t", "id"])
    assert rows(jobs.newest_values(spark, f"{folder}/out", ["k", "s", "t", "id"]), "t", "id", "resubmission") == rows(want, "t", "id", "resubmission")


RECORDS = ['1,"a\nb",x', '2,plain 5" pipe,"""q"",\n\n"', '3,"",', '4,"open, then\n""quoted""\n,end"tail,z', '5,,"\n"', '6,"' + 'w\n' * 40 + '",y', "7,too,many,fields", '8,"\r\n",last\r']
WIDE = '9,"' + '"",' * 50000 + '",' + "w" * 9


def _chopped(spark, path, size, **how):
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        return files.enveloped_records(spark, path, ["id", "b", "c"], **how)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)


@pytest.mark.parametrize("size", [61, 1 << 20])
def test_records_of_several_lines_in_any_split(spark, folder, size):
    body = '"REPORT\nid,b,c\n' + "\n".join(RECORDS) + '\nTOTAL,"\nEND,"9\n'
    put(f"{folder}/in/T_2024-01-05.csv", body)
    put(f"{folder}/in/T_2024-01-06.csv", '"REPORT\nid,b,c\nTOTAL\nEND')
    put(f"{folder}/in/T_2024-01-07.csv", "" if size < 100 else f"a\nb\n{WIDE}\n{WIDE}\n1\n2\n")
    df = _chopped(spark, f"{folder}/in", size, trail=2).where("reject is null")
    got = {r.id: (r.b, r.c) for r in df.collect()}
    assert df.count() == 7 + 2 * (size > 100) and got.pop("9", ('",' * 50000, "w" * 9)) == ('",' * 50000, "w" * 9)
    assert got.keys() == set("1234568") and got["8"] == ("\r\n", "last")
    assert got["1"] == ("a\nb", "x") and got["2"] == ('plain 5" pipe', '"q",\n\n') and got["6"] == ("w\n" * 40, "y") and got["5"] == (None, "\n")
    rejects = _chopped(spark, f"{folder}/in", size, trail=2).where("reject is not null")
    assert rows(rejects, "reject") == [("7,too,many,fields",)]


@pytest.mark.parametrize("size", [20, 1 << 20])
def test_lines_after_a_quote_that_never_closes_are_rejects(spark, folder, size):
    put(f"{folder}/in/T_2024-01-05.csv", 'id,b,c\n1,"a\nb",x\n2,"stray,y\n3,c,z\n\n4,d,w\n')
    df = _chopped(spark, f"{folder}/in", size, lead=0, trail=0)
    assert rows(df.where("reject is null"), "id", "b", "c") == [("1", "a\nb", "x")]
    assert rows(df.where("reject is not null"), "reject") == sorted([('2,"stray,y',), ("3,c,z",), ("",), ("4,d,w",)], key=str)


def test_quote_patterns_follow_a_reader_of_characters():
    import random
    import re

    from lakeloom.sources.records import quote_patterns

    def ends_inside(line, inside):
        fresh, closed, i = not inside, False, 0
        while i < len(line):
            x = line[i]
            if inside:
                if x == '"' and line[i + 1:i + 2] == '"':
                    i += 1
                elif x == '"':
                    inside, closed = False, True
            elif x == ",":
                fresh = True
                i += 1
                continue
            elif x == '"' and fresh:
                inside = True
            fresh = False
            i += 1
        return inside

    out, in_ = (re.compile(p.replace(r"\z", r"\Z")) for p in quote_patterns())
    r = random.Random(3)
    for _ in range(20000):
        line = "".join(r.choice('"",,ab') for _ in range(r.randrange(12)))
        assert (bool(out.search(line)), bool(in_.search(line))) == (ends_inside(line, False), ends_inside(line, True)), line


def test_bucketed_tables_are_joined_and_grouped_in_place(spark):
    from workloads.sources import bucketed_pair, bucketed_totals

    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = bucketed_totals(*bucketed_pair(Tables(spark, SF)))
        n = out.count()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "SelectedBucketsCount: 16 out of 16" in plan
        assert n == Tables(spark, SF).orders.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_a_hot_key_is_written_whole(spark, tmp_path):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), "id").unionByName(
        spark.createDataFrame([(None, -1), (None, -2)], "k long, id long"))
    kept = tables.write_bucketed(df, "hot_rows", ["k"], 4, str(tmp_path / "hot"))
    assert rows(kept, "k", "id") == rows(df, "k", "id") and kept.where("k = 7").count() == 2000
    spark.sql("DROP TABLE hot_rows")
