"""Golden rows for the scalar functions (C*, D*, F8, N6) with the traps of
SURVEY §2.13: null, '', '$ 1,234.50 %', half-even ties, bad dates, odd blanks."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loanmart.functions import (
    blank_to_null, case_hash, clean_symbols, days_until, full_name, has_label, null_token_to_null,
    pacific_stamp, parse_timestamp, py_strip, recode, status_is, strip_quotes, to_decimal_exact,
    to_decimal_rounded, to_number, try_parse_timestamp, utc_to_pacific,
)
from loanmart.functions.text import MONEY_CHARS, PY_WHITESPACE


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_py_whitespace_is_exactly_python_isspace():
    assert sorted(PY_WHITESPACE) == sorted(chr(c) for c in range(0x110000) if chr(c).isspace())


@pytest.mark.parametrize("raw,want", [
    ("$ 1,234.50 %", "1234.50"), ("  12.5 % ", "12.5"), ("", ""), (None, None), (" $5\t", "5"),
    ("12 Oak St, Unit 4", "12OakStUnit4"),
])
def test_clean_with_blanks(spark, raw, want):
    assert one(spark, clean_symbols(F.col("s")), raw) == want


def test_clean_without_blanks_keeps_inner_blanks(spark):
    assert one(spark, clean_symbols(F.col("s"), MONEY_CHARS), " $1, 234 ") == "1 234"


@pytest.mark.parametrize("raw,want", [
    ("1.00005", Decimal("1.0000")), ("1.00015", Decimal("1.0002")), ("2.5", Decimal("2.5000")),
    ("abc", None), ("nan", None), ("", None), (None, None), ("-0.00005", Decimal("0.0000")),
])
def test_decimal_half_even(spark, raw, want):
    got = one(spark, to_decimal_rounded(F.col("s")), raw)
    assert got == want


def test_decimal_exact_and_number(spark):
    assert one(spark, to_decimal_exact(F.col("s")), "1234.123456789") == Decimal("1234.123456789")
    assert one(spark, to_decimal_exact(F.col("s")), "12x") is None
    assert one(spark, to_number(F.col("s")), "12.5") == 12.5
    assert one(spark, to_number(F.col("s")), "n/a") is None


def test_null_spellings(spark):
    assert one(spark, blank_to_null(F.col("s")), "") is None
    assert one(spark, blank_to_null(F.col("s")), "x") == "x"
    assert one(spark, null_token_to_null(F.col("s")), "null") is None
    assert one(spark, null_token_to_null(F.col("s")), "nullable") == "nullable"
    assert one(spark, strip_quotes(F.col("s")), "O'Neil \"Jr\"") == "ONeil Jr"
    assert one(spark, recode(F.col("s"), {"First Lien": "First"}), "First Lien") == "First"
    assert one(spark, recode(F.col("s"), {"First Lien": "First"}), "Second") == "Second"


def test_strict_date_parse(spark):
    assert one(spark, parse_timestamp(F.col("s")), "1/2/2024") == dt.datetime(2024, 1, 2)
    assert one(spark, parse_timestamp(F.col("s")), "") is None
    assert one(spark, parse_timestamp(F.col("s")), None) is None
    with pytest.raises(Exception):
        one(spark, parse_timestamp(F.col("s"), "MM/dd/yyyy"), "02/30/2024")


def test_coercing_date_parse(spark):
    fmts = ("yyyy-MM-dd", "M/d/yyyy")
    assert one(spark, try_parse_timestamp(F.col("s"), fmts), "02/30/2024") is None
    assert one(spark, try_parse_timestamp(F.col("s"), fmts), "2024-03-01") == dt.datetime(2024, 3, 1)
    assert one(spark, try_parse_timestamp(F.col("s"), fmts), "3/1/2024") == dt.datetime(2024, 3, 1)


@pytest.mark.parametrize("due,want", [
    (dt.datetime(2024, 2, 14), 30), (dt.datetime(2024, 2, 14, 23, 59), 30),
    (dt.datetime(2024, 2, 13), 29), (dt.datetime(2024, 2, 15), 31),
])
def test_days_until(spark, due, want):
    assert one(spark, days_until(F.col("s"), dt.date(2024, 1, 15)), due, "s timestamp_ntz") == want


def test_pacific(spark):
    assert one(spark, pacific_stamp(dt.datetime(2024, 7, 1, 12, 0)), "x") == "2024-07-01T05:00:00"
    assert one(spark, pacific_stamp(dt.datetime(2024, 1, 1, 3, 0)), "x") == "2023-12-31T19:00:00"
    got = one(spark, utc_to_pacific(F.col("s")), dt.datetime(2024, 3, 10, 12, 0), "s timestamp_ntz")
    assert got == dt.datetime(2024, 3, 10, 5, 0)


def test_case_hash_spells_null_as_none(spark):
    import hashlib
    df = spark.createDataFrame([("LN-1", "7"), (None, None)], "a string, b string")
    got = [r["h"] for r in df.select(case_hash(F.col("a"), F.col("b")).alias("h")).collect()]
    assert got == [hashlib.sha256(b"LN-1-7").hexdigest(), hashlib.sha256(b"None-None").hexdigest()]


@pytest.mark.parametrize("raw,want", [
    ("Draw Submit", True), (" draw submit\n", True), (" DRAW SUBMIT", True),
    ("Draw Create", False), (None, False), ("draw submitted", False),
])
def test_status_is(spark, raw, want):
    assert one(spark, status_is(F.col("s"), "draw submit"), raw) is want


def test_labels_and_names(spark):
    df = spark.createDataFrame([(["Accounting", "Rehab"], "A", None), (None, "B", "C")],
                               "l array<string>, f string, g string")
    rows = df.select(has_label("l", "Accounting").alias("h"), full_name("f", "g").alias("n"),
                     full_name("f", "g", default_blank=True).alias("d")).collect()
    assert [(r.h, r.n, r.d) for r in rows] == [(True, None, "A "), (False, "B C", "B C")]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_results_do_not_depend_on_session_zone(spark, zone):
    from loanmart.plans.draws import runs_of_day
    from loanmart.sources.sinks import with_upload_date
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert one(spark, pacific_stamp(dt.datetime(2024, 7, 1, 12, 0)), "x") == "2024-07-01T05:00:00"
        assert one(spark, try_parse_timestamp(F.col("s"), ("M/d/yyyy H:mm",)), "3/10/2024 2:30") == \
            dt.datetime(2024, 3, 10, 2, 30)
        up = with_upload_date(spark.createDataFrame([(1,)], "k int"), dt.datetime(2024, 1, 15, 12, 0))
        assert up.first().upload_date == dt.datetime(2024, 1, 15, 12, 0)
        runs = spark.createDataFrame([("a", "2024-01-15T00:30:00Z"), ("b", "2024-01-15T23:30:00Z"),
                                      ("c", "2024-01-16T00:30:00Z")], "id string, t string") \
            .select("id", F.to_timestamp("t").alias("start_time"))
        got = sorted(r.id for r in runs_of_day(runs, dt.datetime(2024, 1, 16, 8, 0)).collect())
        assert got == ["a", "b"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_numbers_that_do_not_fit_are_not_bad_text(spark):
    from loanmart.functions.numbers import to_decimal_exact, to_decimal_rounded, to_number
    df = spark.createDataFrame([("12d",), ("12f",), ("nan",), ("1e3",), (" 7 ",), ("inf",), (None,), ("",), (".5",)], "t string")
    got = [r[0] for r in df.select(to_number("t")).collect()]
    assert got == [None, None, None, 1000.0, 7.0, float("inf"), None, None, 0.5]
    wide = spark.createDataFrame([("9" * 21,)], "t string")
    for f in (to_decimal_exact, to_decimal_rounded):
        with pytest.raises(Exception, match="too wide"):
            wide.select(f("t")).collect()


def test_utc_instant_in_any_session_zone(spark):
    from loanmart.functions.dates import utc_instant
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            rows = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-10 02:30:00.000001' AS t UNION ALL SELECT TIMESTAMP_NTZ '1960-11-03 01:30:00' UNION ALL SELECT NULL")
            assert [r[0] for r in rows.select(F.unix_micros(utc_instant(F.col("t")))).collect()] == [1710037800000001, -289089000000000, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_only_text_of_a_formats_shape_is_parsed(spark):
    from loanmart.functions.dates import _shape
    from loanmart.plans.lip import DATE_FORMATS
    assert all(_shape(f) for f in DATE_FORMATS) and _shape("MMM d") is None and _shape("yyyy-MM-dd'T'HH") is None
    texts = ["2024-01-02", "2024-01-02 03:04:05", "1/2/2024", "01/02/2024", "1/2/2024 3:04", "2/30/2024", "+12024-01-02", "-2024-01-02", "12024-01-02", "001/2/2024", "1/2/24",
             "", " ", "2024-01-02\n", " 2024-01-02", "2024-01-02T03:04:05", "-1/2/2024", "n/a", "\u0661/2/2024", "1/2/2024 3:04 ", "2024-1-2", "24:00", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    raw = F.coalesce(*[F.when(F.try_to_timestamp("s", F.lit(f)).isNotNull(), F.to_timestamp_ntz("s", F.lit(f))) for f in DATE_FORMATS])
    got = df.select(try_parse_timestamp("s", DATE_FORMATS).cast("string").alias("guarded"), raw.cast("string").alias("raw")).collect()
    assert [r.guarded for r in got] == [r.raw for r in got] and sum(r.raw is not None for r in got) >= 5
    days = df.limit(1).select(F.lit("2024-01-02").cast("date").alias("d"))  # a date has no shape
    assert days.select(try_parse_timestamp("d", ("M/d/yyyy",))).first()[0] == dt.datetime(2024, 1, 2)
