import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedwright.functions import dates, text as tx


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "value, want",
    [('a"b"', "ab"), ('""', ""), (None, ""), ("plain", "plain"), ('{"k": 1}', "{k: 1}")],
)
def test_strip_quotes(spark, value, want):
    assert one(spark, value, tx.strip_quotes("c")) == want


@pytest.mark.parametrize(
    "value, want",
    [("123", "0000000000123"), ("12345678901234", "1234567890123"), ("", "0" * 13), (None, None)],
)
def test_pad_code(spark, value, want):
    assert one(spark, value, tx.pad_code("c", 13)) == want


def test_strip_chars_is_null_safe(spark):
    assert one(spark, "12-34-5", tx.strip_chars("c", "-")) == "12345"
    assert one(spark, "1,234", tx.strip_chars("c", ",")) == "1234"
    assert one(spark, None, tx.strip_chars("c", "-")) is None


@pytest.mark.parametrize("value, want", [("  ", None), ("", None), (None, None), (" a ", " a ")])
def test_blank_to_null(spark, value, want):
    assert one(spark, value, tx.blank_to_null("c")) == want


def test_replace_text_is_literal(spark):
    assert one(spark, "a.b & c", tx.replace_text("c", ("&", "and"), (" ", "_"), (".", "`"))) == "a`b_and_c"


def test_row_text_prints_nulls(spark):
    df = spark.createDataFrame([("a", None, 3)], "x string, y string, z int")
    assert df.select(tx.row_text(["x", "y", "z"])).first()[0] == "a,null,3"


def test_dataset_name(spark):
    assert one(spark, "Sales.csv", tx.dataset_name("c")) == "Sales"
    assert one(spark, "a.csv.bak", tx.dataset_name("c")) == "a.csv.bak"


@pytest.mark.parametrize(
    "value, formats, want",
    [
        ("03-08-2017", ("dd-MM-yyyy",), "08/03/2017"),
        ("2014-01-18", ("yyyy-M-d",), "01/18/2014"),
        ("2014-1-8", ("yyyy-M-d",), "01/08/2014"),
        ("2014-13-45", ("yyyy-M-d",), "Unparceable"),
        ("", ("yyyy-M-d",), "Unparceable"),
        (None, ("yyyy-M-d",), "Unparceable"),
        ("20170930", ("yyyyMMdd",), "09/30/2017"),
        ("05/17/14", ("M/d/yy", "M/d/yyyy"), "05/17/2014"),
        ("05/17/2014", ("M/d/yy", "M/d/yyyy"), "05/17/2014"),
    ],
)
def test_reformat_date(spark, value, formats, want):
    assert one(spark, value, dates.reformat_date("c", *formats)) == want


def test_epoch_and_year(spark):
    assert one(spark, "1970-01-02", dates.epoch_millis("c", "yyyy-M-d")) == 86_400_000
    assert one(spark, "x", dates.epoch_millis("c", "yyyy-M-d")) == 0
    assert one(spark, "2016-02-29", dates.date_year("c", "yyyy-M-d")) == 2016
    assert one(spark, None, dates.date_year("c", "yyyy-M-d")) == 0
    assert one(spark, 1_485_907_200_000, dates.millis_year("c"), "bigint") == 2017


def test_compare_dates(spark):
    df = spark.createDataFrame(
        [("2017-01-01", "2017-01-02"), ("2017-01-02", "2017-01-02"), ("2018-01-01", "2017-01-02"), ("x", "2017-01-02")],
        "a string, b string",
    )
    got = [r[0] for r in df.select(dates.compare_dates("a", "b", "yyyy-M-d")).collect()]
    assert got == [-1, 0, 1, 0]


def test_week_label_repeats_at_new_year_but_week_start_does_not(spark):
    df = spark.createDataFrame([("12/31/2016",), ("12/30/2017",), ("01/01/2017",), ("bad",)], "c string")
    got = df.select(
        dates.week_label("c").alias("label"), dates.week_start(dates.parse_date("c", "M/d/yyyy")).alias("start")
    ).collect()
    assert [r["label"] for r in got] == ["2017/52", "2017/52", "2017/1", "Unparcable"]
    assert got[0]["start"] == dt.date(2016, 12, 26)
    assert got[1]["start"] == dt.date(2017, 12, 25)
    assert got[2]["start"] == dt.date(2017, 1, 2)


@pytest.mark.parametrize(
    "day, of_week, on_or_before",
    [
        ("2017-09-20", "2017-09-23", "2017-09-16"),
        ("2017-09-23", "2017-09-23", "2017-09-23"),
        ("2017-09-24", "2017-09-23", "2017-09-23"),
    ],
)
def test_saturdays(spark, day, of_week, on_or_before):
    d = F.col("c").cast("date")
    assert str(one(spark, day, dates.saturday_of_week(d))) == of_week
    assert str(one(spark, day, dates.saturday_on_or_before(d))) == on_or_before


def test_run_clock():
    c = dates.RunClock(dt.datetime(2017, 9, 20, 10, 0, 0))
    assert (c.day, c.millis, c.timestamp) == ("20170920", "1505901600000", "2017-09-20 10:00:00.000")


@pytest.mark.parametrize(
    "form, frame",
    [
        ("yyyy-M-d", (8, 10, ["-"])),
        ("yyyyMMdd", (8, 8, [])),
        ("M/d/yy", (6, 8, ["/"])),
        ("dd MMM yyyy", None),
        ("yyyy-MM-dd HH:mm", None),
    ],
)
def test_text_frame(form, frame):
    assert dates.text_frame(form) == frame


def test_formats_with_words_still_parse(spark):
    assert one(spark, "03 Aug 2017", dates.reformat_date("c", "dd MMM yyyy")) == "08/03/2017"
