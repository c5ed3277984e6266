"""Worked examples and null rules of the column functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeloom.functions import dates, names, rules, text
from tests.conftest import rows

D = dt.date


def test_trim_strings(spark):
    df = spark.createDataFrame([("000376033 ", 1), ("  000376033", 2), (" 31310\t\n", 3), (None, 4)], "a string, n int")
    assert [r.a for r in text.trim_strings(df).orderBy("n").collect()] == ["000376033", "000376033", "31310", None]


def test_map_values_defaults(spark):
    df = spark.createDataFrame([("BC",), ("QC",), (None,), ("",), ("  ",), ("N/A",), ("XX",)], "p string")
    got = [r.p for r in text.map_values(df, ["p"], {"BC": "British Columbia", "QC": "Quebec", "N/A": None}).collect()]
    assert got == ["British Columbia", "Quebec", "Unknown", "Unknown", "Unknown", "Unknown", "XX"]


@pytest.mark.parametrize("value,width,want", [
    ("01111", 9, "000001111"), ("022", 9, "000000022"), ("1234567890", 9, "1234567890"), ("-12", 5, "-0012"), ("", 3, "000"), (None, 3, None)])
def test_zero_pad(one, value, width, want):
    assert one(lambda c: text.zero_pad(c, width), value) == want


@pytest.mark.parametrize("value,positions,want", [
    ("A1A0A1", [3], "A1A 0A1"), ("abc", [1, 9], "a bc "), ("ab", [0, 1], " a b"), (None, [1], None), ("abcd", [2, 2], "ab cd")])
def test_insert_at(one, value, positions, want):
    assert one(lambda c: text.insert_at(c, " ", positions), value) == want


def test_postal_rules(one):
    places = {"A": "NL", "X0A": "NU"}
    assert one(lambda c: text.region_from_code(c, places), "A1A 0A1") == "NL"
    assert one(lambda c: text.region_from_code(c, places), "X0A 0A1") == "NU"
    assert one(lambda c: text.leading(c), "A1A 0A1") == "A1A"
    assert one(lambda c: text.area_type(c), "A1A 0A1") == "Urban"
    assert one(lambda c: text.area_type(c), "X0A 0A1") == "Rural"
    assert one(lambda c: text.area_type(c), None) is None
    assert one(lambda c: text.area_type(c, null_as_urban=True), None) == "Urban"


@pytest.mark.parametrize("code,ok", [
    ("K0A 2W0", True), ("K1S 2C4", True), ("Z6K 3E9", False), ("K1A 0T6", True), ("Q4W 4X6", False), ("K0A Q4T", False), (None, False)])
def test_postal_ok(one, code, ok):
    assert one(text.postal_ok, code) is ok


def test_numbers(one):
    assert one(text.digits_to_double, "$ -1,234.50") == 1234.5
    assert one(text.digits_to_double, "none") is None
    assert one(text.to_number, "1,234.5") == 1234.5
    assert one(text.to_number, "x") is None
    assert one(text.to_int_or_zero, "12.0") == 12
    assert one(text.to_int_or_zero, None) == 0
    assert one(text.drop_decimal_suffix, "10.0") == "10"


def test_keys_and_codes(one):
    assert one(lambda a, b, c: text.key_of([a, b, c]), "x", None, "z") == "x-z"
    assert one(lambda a, b: text.key_of([a, b], "|", blank_as_null=True), "", "z") == "z"
    key = lambda code, system, spec, hit: one(
        lambda a, b, c: text.code_key(a, b, c, F.lit(hit).cast("boolean"), ["DT", "HY"], "QC"), code, system, spec)
    assert key("01234", "QC", "DT", False) == "01234-DT"
    assert key("01234", "QC", "GP", False) == "01234-QC-GP"
    assert key("01234", "CAN", "OS", True) == "01234-CAN-OS"
    assert key("01234", "CAN", "GP", None) == "01234-CAN"
    assert key(None, "CAN", "GP", False) is None
    assert one(lambda c: text.notes_after(c, r"\d{5}\s+[A-Z]{2}"), "12345 AB 23456 CD see note") == "see note"
    assert one(lambda c: text.tidy_pair(c, r"(\d{5})\s*([A-Z]{2})"), "12345   AB") == "12345 AB"


def test_row_hash_tells_null_shift_and_blank(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a", "", "b"), ("ab", None, None)], "x string, y string, z string")
    assert df.select(text.row_hash(["x", "y", "z"]).alias("h")).distinct().count() == 4


def test_placeholders(spark):
    df = spark.createDataFrame([("N/A",), (" null ",), ("nan",), ("",), ("x",)], "a string")
    assert [r.a for r in text.clean_placeholders(df).collect()] == [None, None, None, None, "x"]


@pytest.mark.parametrize("value,want", [("Y", True), ("no", False), (None, None), ("maybe", None)])
def test_yes_no(one, value, want):
    assert one(rules.yes_no, value) is want
    if value is None:
        assert one(lambda c: rules.yes_no(c, null_as_false=True), value) is False


def test_bands(one):
    bands = [(18, 64, "18-64"), (70, 71, "70-71"), (87, None, "87+")]
    for value, want in [(150, "87+"), (27, "18-64"), (70, "70-71"), (3, "Unknown"), (None, "Unknown")]:
        assert one(lambda c: rules.band(c, bands), value, type="int") == want


def test_outcome_order(one):
    make = lambda paid, reason: one(
        lambda p, r: rules.outcome_group(p.cast("double"), [r, F.lit(None).cast("string")], ["X1"]), paid, reason)
    assert make("5", "X1") == "Approved"
    assert make("0", "X1") == "Incomplete"
    assert make("0", None) == "Declined"
    assert make(None, "X1") == "Other"
    assert make("-1", "X1") == "Other"


def test_prefix_first_group_wins(one):
    groups = [("special", ["53301"]), ("partial", ["53", "52"])]
    assert [one(lambda c: rules.prefix_group(c, groups, "Others"), v) for v in ("53301", "53999", "99", None)] == [
        "special", "partial", "Others", "Others"]


@pytest.mark.parametrize("value,want", [
    ("2024-06-19", D(2024, 6, 19)), ("2024_06_19", D(2024, 6, 19)), ("6-19-2024", D(2024, 6, 19)), ("2024/06/19", D(2024, 6, 19)), ("abc", None), ("", None), (None, None)])
def test_parse_date_never_throws(one, value, want):
    assert one(dates.parse_date, value) == want


@pytest.mark.parametrize("name,want", [
    ("CL_2025-05-09.csv", D(2025, 5, 9)), ("CL_20250509.csv", D(2025, 5, 9)), ("CL_2025_05_09.csv", D(2025, 5, 9)),
    ("A_20010101_20250509.csv", D(2025, 5, 9)), ("A_123456789012.csv", None), ("none.csv", None)])
def test_date_from_name(one, name, want):
    assert one(dates.date_from_name, name) == want


@pytest.mark.parametrize("ref,want", [
    ("190624-0001", D(2024, 6, 19)), ("19062B-0001", None), ("000600-1", None), ("190699-1", D(1999, 6, 19)), (None, None)])
def test_reference_date(one, ref, want):
    assert one(dates.reference_date, ref) == want


def test_minutes_half_even(one):
    assert [one(dates.minutes, v, type="int") for v in (426, 600, 214, 30)] == [7.1, 10.0, 3.6, 0.5]


def test_local_time_shifts_with_daylight_saving(spark):
    df = spark.sql("SELECT timestamp'2024-01-15 12:00:00' a, timestamp'2024-07-15 12:00:00' b")
    r = df.select(*[F.date_format(dates.to_local(F.col(c), "America/New_York"), "HH").alias(c) for c in "ab"]).first()
    assert (r.a, r.b) == ("07", "08")


def test_age_falls_back_and_stops_at_zero(spark):
    df = spark.sql("""SELECT * FROM VALUES (date'2000-01-01', date'2020-06-01', date'2021-06-01'), (date'2000-01-01', null, date'2010-02-01'),
      (date'2000-01-01', date'1999-01-01', date'1998-01-01') AS t(b, o, f)""")
    assert [r.a for r in df.select(dates.age_at(F.col("b"), F.col("o"), F.col("f")).alias("a")).collect()] == [20, 10, 0]


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], "`a  b` int, `c?` int")
    assert names.normalize_names(df).columns == ["a_b", "c?"]
    assert names.normalize_names(df, names.Naming(title=True, drop="?")).columns == ["A_B", "C"]
    with pytest.raises(ValueError):
        names.normalize_names(spark.createDataFrame([(1, 2)], "`a b` int, `a_b` int"))
    assert names.to_front(spark.createDataFrame([(1, 2, 3)], "z int, b int, a int"), ["b", "none"]).columns == ["b", "a", "z"]


def test_align_casts_by_name(spark):
    like = spark.createDataFrame([(1, 2.0)], "a int, b double")
    got = names.align_to(spark.createDataFrame([("x", "7", 1)], "b string, a string, extra int"), like)
    assert got.dtypes == [("a", "int"), ("b", "double")] and rows(got) == [(7, None)]
