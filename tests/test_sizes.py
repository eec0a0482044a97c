"""What keeps time, memory and shuffled bytes in proportion to the rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from feedwright.limits import Limits
from feedwright.operators import joining, merge
from feedwright.operators import lookups as lk
from feedwright.operators.records import FACT_LOOKUP
from feedwright.operators.setops import distinct_rows
from feedwright.operators.sizing import settle
from feedwright.plans.enriching import judge, judged_errors, settle_judged
from feedwright.plans.spec import FeedSpec, LookupSpec
from feedwright.plans.staging import _write
from feedwright.sources import snapshot as snapshots
from feedwright.sources.snapshot import Snapshot


def counted(df):
    return Counter(tuple(r) for r in df.collect())


NONE = Limits(rows=0, bytes=0)
ODD = [("a", None, "1"), (None, "a", "1"), ("a", None, "1"), ("", None, None), (None, "", None), (None, None, None), (None, None, None), ("b", "c", "2")]


@pytest.mark.parametrize("limits", [Limits(), NONE])
@pytest.mark.parametrize("copies", [1, 9])
def test_distinct_rows_are_those_of_distinct(spark, text, limits, copies):
    rows = ODD * copies + [(f"k{i}", None, str(i)) for i in range(50)]
    df = text(["x", "y", "z"], rows)
    assert counted(distinct_rows(df, limits)) == Counter(set(rows))
    doubles = spark.createDataFrame([(0.0, "a"), (-0.0, "a"), (float("nan"), "a"), (float("nan"), "a")], "d double, x string")
    assert distinct_rows(doubles, limits).count() == 2
    assert distinct_rows(text(["x"], []), limits).count() == 0


def test_distinct_rows_compares_rows_of_one_hash(monkeypatch, text):
    # All rows share two hashes, so that each is compared as a whole.
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.length(F.coalesce(c[0], F.lit(""))).cast("bigint"))
    df = text(["x", "y"], [("a", "1"), ("b", "1"), ("a", "1"), ("dd", None), ("dd", None), ("dd", "")])
    monkeypatch.setattr("feedwright.operators.setops.MANY_COPIES", 100)
    assert counted(distinct_rows(df)) == Counter([("a", "1"), ("b", "1"), ("dd", None), ("dd", "")])


def test_rows_without_copies_are_not_shuffled_as_a_whole(text):
    df = text(["x", "y"], [(str(i), None) for i in range(100)])
    assert "Exchange" not in distinct_rows(df)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("keys", [True, False])
def test_a_table_of_many_rows_has_a_bounded_number_of_buckets(spark, tmp_path, text, monkeypatch, keys):
    monkeypatch.setattr(snapshots, "MOST_BUCKETS", 8, raising=False)
    how = {"keys": ["a"]} if keys else {"hashed": True}
    snap = Snapshot(spark, str(tmp_path / "t"), ["a", "b"], bucket_rows=2, **how)
    add = snap.upsert if keys else snap.append_new
    first, more = [(str(i), "x") for i in range(100)], [(str(i), "x") for i in range(50, 400)]
    add(text(["a", "b"], first), 100)
    add(text(["a", "b"], more), 350)
    assert counted(snap.read()) == Counter({*first, *more})
    assert snap.log.newest().buckets == 8 and len(snap.partition_rows()) == 8
    # A table that cannot be dealt to more buckets is not dealt anew.
    assert snap.versions() == [1]


def test_writes_to_folders_do_not_sort_the_rows_of_a_task(spark, text):
    spark.conf.unset("spark.sql.maxConcurrentOutputFileWriters")
    df = text(["k", "part"], [(str(i), f"p{i % 20}") for i in range(200)]).coalesce(1)
    found = settle(df, "folders", partition_by=["part"])
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 1
    # Twenty folders in one task: more than stay open.
    assert counted(found.frame) == counted(df) and found.rows == 200


def test_staging_does_not_sort_by_file(spark, tmp_path):
    spark.conf.unset("spark.sql.maxConcurrentOutputFileWriters")
    paths = []
    for n in range(12):
        (tmp_path / f"f{n}.csv").write_text("a|b\n" * (n + 1))
        paths.append(type("F", (), {"path": str(tmp_path / f"f{n}.csv")}))
    spec = FeedSpec("p", "/Raw/p*", 2, "append", ("a", "b"), piped=True)
    _write(spark, spec, paths, None, str(tmp_path / "out"), 1)
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 1
    staged = spark.read.text(str(tmp_path / "out")).groupBy("file").count()
    assert {r["file"]: r["count"] for r in staged.collect()} == {f"f{n}.csv": n + 1 for n in range(12)}


def test_keys_of_all_large_masters_are_counted_in_one_pass(spark, text, monkeypatch):
    purposes = []
    monkeypatch.setattr(lk, "settle", lambda df, purpose, *a, **b: purposes.append(purpose) or settle(df, purpose, *a, **b))
    rows = [(f"a{i % 7}" if i % 5 else None, f"b{i % 11}") for i in range(60)] + [(None, None)]
    feed = text(["x", "y"], rows)
    known = {"x": ["a1", "a2", "A3"], "y": ["b1", "b9", "b9"], "again": ["a2", "a6"]}
    masters = {n: text(["key"], [(v,) for v in values]) for n, values in known.items()}
    checks = [lk.Lookup("x", masters["x"], "key"), lk.Lookup("y", masters["y"], "key"), lk.Lookup("x", masters["again"], "key")]
    found = lk.flag_lookups(feed, checks, NONE)
    want = Counter((x, y, x in known["x"], y in known["y"], x in known["again"]) for x, y in rows)
    assert counted(found) == want
    assert purposes.count("feed-keys") == 1
    empty = lk.flag_lookups(text(["x", "y"], []), checks, NONE)
    assert empty.count() == 0


def test_tables_beyond_the_limits_are_never_broadcast(spark, text, tmp_path, monkeypatch):
    # One key beside many empty columns: by the bytes of its file such a table looks small enough to broadcast.
    wide = text(["k"], [(str(i),) for i in range(300)]).select("k", *[F.lit(None).cast("string").alias(f"c{i}") for i in range(60)])
    wide.write.parquet(str(tmp_path / "wide"))
    wide = spark.read.parquet(str(tmp_path / "wide"))
    plans = []

    def noted(df, purpose, *a, **b):
        plans.append((purpose, df._jdf.queryExecution().executedPlan().toString()))
        return settle(df, purpose, *a, **b)

    monkeypatch.setattr(lk, "settle", noted)
    feed = text(["k", "x"], [(str(i % 400), None) for i in range(900)] + [(None, "1")])
    once = wide.withColumn("c0", F.lit("new"))
    history = text(wide.columns, [(str(i), *["old"] * 60) for i in range(290, 310)])
    merged = merge.upsert(history, once, ["k"], distinct=False, limits=NONE)
    assert merged.where("c0 = 'new'").count() == 300 and merged.where("c0 = 'old'").count() == 10
    flagged = lk.flag_lookups(feed, [lk.Lookup("k", wide, "k")], NONE)
    assert counted(flagged.groupBy("_ok0").count()) == Counter([(True, 700), (False, 201)])
    plain = joining.attach(feed, wide.select(F.col("k").alias("_k0"), F.lit(1).alias("_n")), [F.col("k")], small=False)
    assert plain.where("_n = 1").count() == 700
    plans += [(n, df._jdf.queryExecution().executedPlan().toString()) for n, df in (("merged", merged), ("plain", plain))]
    assert {n for n, _ in plans} == {"feed-keys", "key-verdicts", "merged", "plain"}
    assert [n for n, plan in plans if "Broadcast" in plan] == []


def test_fact_errors_name_each_failed_lookup_of_a_row_once(spark, text, tmp_path):
    spec = FeedSpec(
        "f", "/Raw/f*", 3, "range", ("d", "x", "y"), keys=("x",), range_date="d",
        lookups=(LookupSpec("x", "m", "k"), LookupSpec("y", "m", "k", "y in m")),
    )
    master = text(["k"], [("1",)])
    checks = [lk.Lookup("x", master, "k"), lk.Lookup("y", master, "k", "y in m")]
    df = text(["d", "x", "y"], [("1/2/2020", "1", None), ("1/2/2020", "1", None), ("never", "2", "3"), ("1/5/2020", "1", "1"), ("1/9/2020", None, "1")])
    found = settle_judged(judge(df, spec, checks), spec)
    assert (str(found.metrics["first_day"]), str(found.metrics["last_day"]), found.metrics["processed"]) == ("2020-01-05", "2020-01-05", 1)
    got = judged_errors(found.frame, spec, checks).select("Error_Description", "Error_Record")
    label = FACT_LOOKUP.format
    assert counted(got.where("Error_Record not like '%null,1'")) == Counter(
        [(label("y in m"), "1/2/2020,1,null"), (label("x"), "never,2,3"), (label("y in m"), "never,2,3")]
    )
    assert got.count() == 4
    plan = judged_errors(found.frame, spec, checks)._jdf.queryExecution().optimizedPlan().toString()
    # The text is made below the step that repeats a row for each lookup.
    assert "concat_ws" in plan[plan.index("Generate explode"):]
