import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from feedwright.limits import Limits
from feedwright.operators import buckets, coverage, lookups, merge, records, rules, schema, setops, unique
from feedwright.operators.lookups import Lookup

# Each limit set drives another way to join: broadcast everything, broadcast the
# verdicts only, broadcast the orphans only, and split hot keys from a shuffle.
EVERY_WAY = [
    Limits(),
    Limits(rows=6),
    Limits(rows=2),
    Limits(rows=0, hot_share=3),
    Limits(rows=0, hot_share=1),
    Limits(bytes=0),
]


# --- key rules -----------------------------------------------------------


def test_bad_key_is_the_exact_complement(text):
    df = text(["k", "d"], [("1", "01/01/2017"), ("", "x"), (None, "x"), ("0", "x"), ("2", "Unparceable"), ("3", None), ("00", "x")])
    clean, bad = rules.split(df, rules.bad_key(["k", "d"], ["d"]))
    assert clean.count() + bad.count() == df.count()
    assert sorted(r["k"] for r in clean.collect()) == ["00", "1"]


def test_bad_key_on_numbers_compares_text(spark):
    df = spark.createDataFrame([(0,), (1,), (None,)], "k bigint")
    assert df.where(rules.bad_key(["k"])).count() == 2
    assert df.where(rules.bad_key(["k"], zero_is_bad=False)).count() == 1


@pytest.mark.parametrize(
    "value, numeric_bad, text_bad",
    [("0", False, False), ("-5", True, True), (".5", False, True), ("abc", False, False), ("", True, True), (None, True, True), ("12.5", False, False)],
)
def test_bad_measure(text, value, numeric_bad, text_bad):
    df = text(["m"], [(value,)])
    got = df.select(rules.bad_measure(["m"]).alias("n"), rules.bad_measure(["m"], True).alias("t")).first()
    assert (got["n"], got["t"]) == (numeric_bad, text_bad)


def test_any_present(text):
    df = text(["a", "b"], [("1", None), (None, None), (None, "2")])
    assert df.where(rules.any_present(["a", "b"])).count() == 2


def test_outside_range_keeps_undated_rows_and_everything_for_empty_deliveries(spark):
    df = spark.createDataFrame([(dt.date(2017, 1, 1),), (dt.date(2017, 1, 5),), (None,)], "d date")
    lo, hi = dt.date(2017, 1, 4), dt.date(2017, 1, 6)
    assert df.where(rules.outside_range(F.col("d"), lo, hi)).count() == 2
    assert df.where(rules.outside_range(F.col("d"), None, None)).count() == 3


# --- unique keys ---------------------------------------------------------

KEYED = [("a", "1"), ("a", "1"), ("b", "1"), ("b", "2"), ("c", "1"), (None, "1"), (None, "2"), ("d", "9")] + [("hot", "7")] * 20


@pytest.mark.parametrize("limits", EVERY_WAY)
def test_split_unique(text, sorted_rows, limits):
    df = text(["k", "v"], KEYED)
    once, dups = unique.split_unique(df, ["k"], limits=limits)
    assert sorted_rows(once) == [("c", "1"), ("d", "9")]
    assert Counter(map(tuple, dups.collect())) == Counter(r for r in KEYED if r[0] not in ("c", "d"))
    _, collapsed = unique.split_unique(df, ["k"], distinct_dups=True, limits=limits)
    assert sorted_rows(collapsed) == sorted({r for r in KEYED if r[0] not in ("c", "d")}, key=repr)


def test_split_unique_without_repeats(text):
    once, dups = unique.split_unique(text(["k"], [("a",), ("b",)]), ["k"])
    assert (once.count(), dups.count()) == (2, 0)


def test_split_unique_on_pairs(text, sorted_rows):
    df = text(["a", "b"], [("1", "x"), ("1", "y"), ("1", "y")])
    once, dups = unique.split_unique(df, ["a", "b"])
    assert sorted_rows(once) == [("1", "x")]
    assert dups.count() == 2


def test_flag_repeated_counts_only_the_given_rows(text):
    df = text(["k", "go"], [("a", "y"), ("a", "n"), ("b", "y"), ("b", "y")])
    flagged = unique.flag_repeated(df, ["k"], rows=F.col("go") == "y")
    assert sorted((r["k"], r["go"], r["_repeated"]) for r in flagged.collect()) == [
        ("a", "n", False), ("a", "y", False), ("b", "y", True), ("b", "y", True),
    ]


# --- lookups -------------------------------------------------------------

FACTS = [("p1", "l1", "1"), ("p1", "l9", "2"), ("p9", "l1", "3"), ("p9", "l9", "4"), ("p9", "l9", "4"), (None, "l1", "5"), ("p2", "l2", "6")] + [("p1", "l1", "hot")] * 15


def masters(text):
    products = text(["pk", "x"], [("p1", "a"), ("p1", "b"), ("p2", "c"), (None, "d"), ("p3", "e")])
    places = text(["lk"], [("l1",), ("l2",)])
    return [Lookup("p", products, "pk", "product"), Lookup("l", places, "lk", "place")]


@pytest.mark.parametrize("limits", EVERY_WAY)
def test_lookup_chain(text, sorted_rows, limits):
    df = text(["p", "l", "m"], FACTS)
    looked = masters(text)
    flagged = lookups.flag_lookups(df, looked, limits)
    assert flagged.count() == len(FACTS)
    kept = lookups.kept_rows(flagged, looked, df.columns)
    good = [r for r in FACTS if r[0] in ("p1", "p2") and r[1] in ("l1", "l2")]
    assert Counter(map(tuple, kept.collect())) == Counter(good)
    failed = lookups.failed_rows(flagged, looked, df.columns)
    want = {(*r, "product") for r in FACTS if r[0] not in ("p1", "p2")}
    want |= {(*r, "place") for r in FACTS if r[1] not in ("l1", "l2")}
    assert sorted_rows(failed) == sorted(want, key=repr)


@pytest.mark.parametrize("limits", EVERY_WAY)
def test_single_lookup_matches_join_and_except(text, limits):
    df = text(["p", "l", "m"], FACTS)
    look = masters(text)[0]
    keys = look.master.select(F.col("pk").alias("p")).distinct()
    joined = df.join(keys, "p").select(df.columns)
    kept, bad = lookups.keep_known(df, look, limits), lookups.unknown_rows(df, look, limits)
    assert kept.exceptAll(joined).isEmpty() and joined.exceptAll(kept).isEmpty()
    naive = df.subtract(joined)
    assert bad.exceptAll(naive).isEmpty() and naive.exceptAll(bad).isEmpty()


@pytest.mark.parametrize("limits", EVERY_WAY)
def test_lookup_takes_master_spelling_without_multiplying(text, sorted_rows, limits):
    df = text(["geo", "v"], [("total us", "1"), ("TOTAL US", "2"), ("nowhere", "3"), ("East", "4")] + [("east", "5")] * 9)
    master = text(["g"], [("Total US",), ("TOTAL US",), ("EAST",)])
    look = [Lookup("geo", master, "g", ignore_case=True, take_spelling=True)]
    flagged = lookups.flag_lookups(df, look, limits)
    kept = lookups.kept_rows(flagged, look, df.columns)
    assert sorted_rows(kept) == sorted([("TOTAL US", "1"), ("TOTAL US", "2"), ("EAST", "4")] + [("EAST", "5")] * 9, key=repr)
    assert sorted_rows(lookups.failed_rows(flagged, look, df.columns)) == [("nowhere", "3", "geo")]


@pytest.mark.parametrize("spelling", [False, True])
def test_large_master_and_few_feed_keys(spark, text, sorted_rows, spelling):
    df = text(["k"], [("A1",), ("a2",), ("zz",), (None,)] + [("a3",)] * 5)
    master = spark.range(50).select(F.concat(F.lit("a"), F.col("id").cast("string")).alias("m"))
    look = [Lookup("k", master.unionByName(master), "m", ignore_case=True, take_spelling=spelling)]
    flagged = lookups.flag_lookups(df, look, Limits(rows=10))
    kept = lookups.kept_rows(flagged, look, df.columns)
    first = "a1" if spelling else "A1"
    assert sorted_rows(kept) == sorted([(first,), ("a2",)] + [("a3",)] * 5, key=repr)
    assert sorted_rows(lookups.failed_rows(flagged, look, ["k"])) == [("zz", "k"), (None, "k")]


def test_lookup_across_types(spark, text):
    df = spark.createDataFrame([(1,), (2,)], "k bigint")
    assert lookups.keep_known(df, Lookup("k", text(["m"], [("1",), ("x",)]), "m")).count() == 1


# --- merges --------------------------------------------------------------


def test_append_distinct_is_idempotent(text, sorted_rows):
    h, c = text(["a"], [("1",), ("2",)]), text(["a"], [("2",), ("3",), ("3",)])
    first = merge.append_distinct(h, c)
    assert sorted_rows(first) == [("1",), ("2",), ("3",)]
    assert sorted_rows(merge.append_distinct(first, c)) == sorted_rows(first)


@pytest.mark.parametrize("limits", [Limits(), Limits(rows=0)])
def test_new_rows_is_what_append_adds(text, sorted_rows, limits):
    h = text(["a", "b"], [("1", None), ("2", "x"), ("2", "x")])
    c = text(["a", "b"], [("1", None), ("3", None), ("3", None), ("2", "y")])
    assert sorted_rows(merge.new_rows(h, c, limits)) == [("2", "y"), ("3", None)]


@pytest.mark.parametrize("limits", [Limits(), Limits(rows=0)])
def test_upsert(text, sorted_rows, limits):
    h = text(["k", "v"], [("1", "old"), ("2", "old"), ("3", "old"), ("3", "old")])
    c = text(["k", "v"], [("2", "new"), ("4", "new")])
    once = merge.upsert(h, c, ["k"], limits=limits)
    assert sorted_rows(once) == [("1", "old"), ("2", "new"), ("3", "old"), ("4", "new")]
    assert sorted_rows(merge.upsert(once, c, ["k"], limits=limits)) == sorted_rows(once)


def history(text):
    return text(["d", "v"], [("01/07/2017", "a"), ("01/14/2017", "b"), ("01/21/2017", "c"), ("01/28/2017", "d"), ("Unparceable", "e"), (None, "f")])


def test_replace_range_erases_the_whole_range(text, sorted_rows):
    c = text(["d", "v"], [("01/14/2017", "new"), ("01/28/2017", "new"), ("01/28/2017", "new")])
    day = merge.feed_day("d")
    once = merge.replace_range(history(text), c, day)
    want = sorted([("01/07/2017", "a"), ("01/14/2017", "new"), ("01/28/2017", "new"), ("Unparceable", "e"), (None, "f")], key=repr)
    assert sorted_rows(once) == want
    assert sorted_rows(merge.replace_range(once, c, day)) == want


def test_replace_dates_keeps_undelivered_dates(text, sorted_rows):
    c = text(["d", "v"], [("01/14/2017", "new"), ("01/28/2017", "new")])
    got = sorted_rows(merge.replace_range(history(text), c, merge.feed_day("d"), scope="dates"))
    assert ("01/21/2017", "c") in got and ("01/14/2017", "b") not in got and (None, "f") in got


def test_replace_range_with_empty_delivery_or_history(text, sorted_rows):
    empty = text(["d", "v"], [])
    day = merge.feed_day("d")
    assert sorted_rows(merge.replace_range(history(text), empty, day)) == sorted_rows(history(text))
    assert sorted_rows(merge.replace_range(empty, history(text), day)) == sorted_rows(history(text))
    with pytest.raises(ValueError):
        merge.replace_range(empty, empty, day, scope="weeks")


# --- coverage and buckets ------------------------------------------------


def test_missing_weeks(text):
    df = text(["wk"], [("01/07/2017",), ("01/07/2017",), ("01/19/2017",), ("bad",), (None,)])
    got = coverage.missing_weeks(df, "wk", dt.date(2017, 2, 1), "Sales").collect()
    assert [(r["wk"], r["Availability"]) for r in got] == [
        ("01/07/2017", "Yes"), ("01/14/2017", "No"), ("01/21/2017", "Yes"), ("01/28/2017", "No"),
    ]
    assert (got[0]["MinDate"], got[0]["MaxDate"], got[0]["DBInsertDate"]) == ("1/7/2017", "1/19/2017", "02/01/2017")
    assert coverage.unreadable_dates(df, "wk").first()[0] == 2


def test_missing_weeks_keeps_new_year_saturdays_apart(text):
    df = text(["wk"], [("12/31/2016",)])
    got = coverage.missing_weeks(df, "wk", dt.date(2017, 12, 31), "S").collect()
    by_week = {r["wk"]: r["Availability"] for r in got}
    assert by_week["12/31/2016"] == "Yes" and by_week["12/30/2017"] == "No" and len(got) == 53


def test_missing_weeks_of_nothing(text):
    assert coverage.missing_weeks(text(["wk"], [("x",)]), "wk", dt.date(2017, 1, 1), "S").count() == 0
    assert coverage.missing_weeks(text(["wk"], [("01/07/2018",)]), "wk", dt.date(2017, 1, 1), "S").count() == 0


def test_missing_weeks_in_text_order(text):
    got = coverage.missing_weeks(text(["wk"], [("12/24/2016",)]), "wk", dt.date(2017, 1, 7), "S", text_order=True)
    assert [r["wk"] for r in got.collect()] == ["01/07/2017", "12/24/2016", "12/31/2016"]


def test_bucket_weeks_includes_the_last_day(text):
    df = text(["d"], [("01/01/2016",), ("12/29/2016",), ("12/30/2016",), ("12/29/2017",), ("bad",)])
    got = {r["d"]: r["bucket"] for r in buckets.bucket_weeks(df, "d").collect()}
    assert got == {"01/01/2016": 0, "12/29/2016": 0, "12/30/2016": 1, "12/29/2017": 2, "bad": None}


# --- schemas, set operators, records ------------------------------------


@pytest.mark.parametrize(
    "found, valid",
    [
        (["A B", "C", "D"], True),
        (["A_B", " C ", "D"], True),
        (["A_B", "C"], False),
        (["A_B", "C", "D", "E"], False),
        (["A_B", "D", "C"], False),
        (["A_B", "C", "X"], False),
    ],
)
def test_check_header(found, valid):
    assert schema.check_header(["A_B", "C", "D"], found).valid is valid


def test_header_details():
    v = schema.check_header(["A", "B", "C"], ["A", "X"])
    assert (v.missing, v.extra, v.misplaced) == (["B", "C"], ["X"], ["B", "C"])
    assert v.width.startswith("LESS")
    assert schema.compare_width(2, 3).startswith("MORE") and schema.compare_width(2, 2) is None


def test_field_count(text):
    got = text(["value"], [("a|b|c",), ("",), ("||",)]).select(schema.field_count("value")).collect()
    assert [r[0] for r in got] == [3, 1, 3]


def test_column_is_found_in_any_case(text):
    df = text(["WeekEnding"], [])
    assert schema.column(df, "WEEKENDING") == "WeekEnding"
    with pytest.raises(KeyError):
        schema.column(df, "x")


def test_set_operators(text, sorted_rows):
    a, b = text(["x", "y"], [("1", None), ("1", None), ("2", "z")]), text(["y", "x"], [("z", "2")])
    assert setops.union_all(a, b).count() == 4
    assert sorted_rows(setops.union_distinct(a, b)) == [("1", None), ("2", "z")]
    assert sorted_rows(setops.except_distinct(a, b)) == [("1", None)]
    assert sorted_rows(setops.except_keep_copies(a, b)) == [("1", None), ("1", None)]


def test_error_records_of_the_period_rows(text):
    names = ["PER", "SDESC", "LDESC", "DATE", "PERIOD LEVEL", "CALENDAR YEAR"]
    df = text(names, [
        ("W/E 01/04/14", "WEEK ENDING 01/04/14", "W/E 01/04/14", "Unparceable", "WEEK", "2014"),
        ("W/E 01/11/14", None, "W/E 01/11/14", "01/11/2014", "WEEK", "2014"),
        ("W/E 01/18/14", "WEEK", "W/E 01/18/14", "01/18/2014", "WEEK", "2014"),
    ])
    _, bad = rules.split(df, rules.bad_key(["DATE", "SDESC"], ["DATE"]))
    got = records.error_records(bad, "NielsenPeriod", records.BAD_KEY.format("DATE,SDESC"))
    assert got.columns == records.ERROR_COLUMNS
    assert sorted((r[0], r[1], r[2]) for r in got.collect()) == [
        ("NielsenPeriod", "Columns: DATE,SDESC is not proper(null/blank/0/Unparceable)", t)
        for t in (
            "W/E 01/04/14,WEEK ENDING 01/04/14,W/E 01/04/14,Unparceable,WEEK,2014",
            "W/E 01/11/14,null,W/E 01/11/14,01/11/2014,WEEK,2014",
        )
    ]


def test_row_counts(text):
    df = text(["k"], [("1",), ("",), (None,)])
    assert tuple(records.row_counts(df, rules.bad_key(["k"])).first()) == (3, 1, 2)


def test_large_lookups_read_the_feed_once(spark, tmp_path):
    rows = [(str(i % 3), str(i % 7), None if i % 5 == 0 else str(i)) for i in range(90)]
    spark.createDataFrame(rows, "a string, b string, c string").write.parquet(str(tmp_path / "feed"))
    feed = spark.read.parquet(str(tmp_path / "feed"))
    masters = [spark.createDataFrame([(str(k),) for k in range(n)], "k string") for n in range(1, 8)]
    seven = [Lookup("abcabca"[i], m, "k") for i, m in enumerate(masters)]
    flagged = lookups.flag_lookups(feed, seven, Limits(rows=0, bytes=0))
    plan = flagged._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Relation [a" in line for line in plan.splitlines()) == 1
    wanted = lookups.flag_lookups(feed, seven)
    names = sorted(flagged.columns)
    assert sorted(map(str, flagged.select(names).collect())) == sorted(map(str, wanted.select(names).collect()))
