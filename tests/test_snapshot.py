"""Commits, buckets, fingerprints, partition statistics and compaction of snapshots."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedwright.operators.merge import append_distinct, upsert
from feedwright.sources.commits import Entry, bins
from feedwright.sources.files import list_names
from feedwright.sources.snapshot import BUCKET, Snapshot

def day():
    return F.try_to_timestamp("d", F.lit("yyyy-MM-dd")).cast("date")


@pytest.fixture
def dated(spark, tmp_path):
    return Snapshot(spark, str(tmp_path / "t"), ["d", "x"], day())


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_a_broken_write_leaves_the_old_table(dated, text, monkeypatch):
    dated.replace(text(["d", "x"], [("2017-01-07", "a"), ("2017-01-14", "b"), (None, "c")]))
    before = rows(dated.read())
    fresh = text(["d", "x"], [("2017-01-07", "z"), ("2017-01-21", "y")])
    span = dt.date(2017, 1, 7), dt.date(2017, 1, 21)
    with monkeypatch.context() as m:
        m.setattr(dated.log, "write", lambda commit: (_ for _ in ()).throw(OSError("lost")))
        for change in (lambda: dated.replace_dates(fresh, *span), lambda: dated.append(fresh), lambda: dated.replace(fresh)):
            with pytest.raises(OSError):
                change()
            assert rows(dated.read()) == before and dated.partition_rows() == {"2017-01-07": 1, "2017-01-14": 1, None: 1}
    # A reader that has resolved a commit goes on with it while the table is restated.
    reader = dated.read()
    dated.replace_dates(fresh, *span)
    assert rows(reader) == before
    assert set(rows(dated.read())) == {("2017-01-07", "z"), ("2017-01-21", "y"), (None, "c")}
    folders = len(dated.prune(2))
    assert folders == 3 and rows(reader) == before
    assert dated.prune(1) == [] or rows(dated.read())


def test_a_slower_writer_is_refused(dated, text):
    dated.replace(text(["d", "x"], [("2017-01-07", "a")]))
    old = dated.log.newest()
    dated.append(text(["d", "x"], [("2017-01-07", "b")]))
    with pytest.raises(FileExistsError):
        dated._next(old, old.entries)
    assert dated.read().count() == 2


def test_dates_are_pruned_and_counted_without_data(dated, text, spark):
    dated.replace(text(["d", "x"], [("2017-01-07", "a"), ("2017-01-07", "b"), ("2017-02-01", "c"), ("never", "d")]))
    assert dated.partition_rows() == {"2017-01-07": 2, "2017-02-01": 1, None: 1}
    found = dated.read_dates(dt.date(2017, 1, 1), dt.date(2017, 1, 31))
    assert rows(found) == [("2017-01-07", "a"), ("2017-01-07", "b")]
    assert len(found.inputFiles()) == 1
    dated.replace_dates(text(["d", "x"], []), dt.date(2017, 1, 1), dt.date(2017, 1, 31))
    assert dated.partition_rows() == {"2017-02-01": 1, None: 1}


def test_upsert_rewrites_the_buckets_of_its_keys(spark, tmp_path, text):
    snap = Snapshot(spark, str(tmp_path / "m"), ["k", "v"], keys=["k"], bucket_rows=10)
    first = text(["k", "v"], [(f"k{i}", "old") for i in range(2000)])
    snap.upsert(first, 2000)
    old = snap.log.newest()
    assert old.buckets == 200 and old.rows == 2000
    some = text(["k", "v"], [("k1", "new"), ("k7", "new"), ("fresh", "new")])
    want = rows(upsert(snap.read(), some, ["k"]))
    snap.upsert(some, 3)
    now = snap.log.newest()
    assert rows(snap.read()) == want and now.rows == 2001
    assert len({e.path for e in old.entries} - {e.path for e in now.entries}) <= 3
    again = snap.upsert(some, 3) and rows(snap.read())
    assert again == want
    # A table twice as full as its buckets were laid out for is dealt anew.
    more = text(["k", "v"], [(f"m{i}", "x") for i in range(2500)])
    snap.upsert(more, 2500)
    assert snap.log.newest().buckets > 400 and snap.read().count() == 4501 and snap.versions() == [1, 2]


@pytest.mark.parametrize("collide", [False, True])
def test_append_compares_rows_only_where_fingerprints_meet(spark, tmp_path, text, collide):
    of_row = {"of_row": lambda names: F.length(F.coalesce(F.col("a"), F.lit(""))).cast("bigint")} if collide else {}
    snap = Snapshot(spark, str(tmp_path / "h"), ["a", "b"], hashed=True, bucket_rows=4, **of_row)
    past = text(["a", "b"], [(f"a{i}", None if i % 3 else "") for i in range(40)])
    snap.append_new(past, 40)
    fresh = text(["a", "b"], [("a1", None), ("a1", ""), ("a1", ""), ("z", None), (None, None), ("a39", "")])
    want = rows(append_distinct(past, fresh))
    new = snap.new_rows(fresh)
    plan = new._jdf.queryExecution().toString()
    assert f"PartitionFilters: [isnotnull({BUCKET}" in plan or f"{BUCKET}#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    before = {e.path for e in snap.log.newest().entries}
    for _ in range(2):
        snap.append_new(fresh, 6)
        assert rows(snap.read()) == want
    assert before <= {e.path for e in snap.log.newest().entries}


def test_small_appends_become_few_files(spark, tmp_path, text):
    snap = Snapshot(spark, str(tmp_path / "t"), ["d", "x"], day())
    frame = text(["d", "x"], [(f"2017-01-0{1 + i % 3}", str(i)) for i in range(12)])
    for _ in range(20):
        snap.append(frame)
    before, old = rows(snap.read()), snap.log.newest()
    assert len(old.entries) == 60 and snap.compact() > 50
    now = snap.log.newest()
    assert rows(snap.read()) == before and sum(e.files for e in now.entries) == 3
    assert snap.partition_rows() == {f"2017-01-0{i}": 80 for i in (1, 2, 3)} and snap.compact() == 0
    snap.tidy(keep=1)
    assert len(list_names(spark, snap.current())) == 1 and rows(snap.read()) == before


def test_bins_hold_small_entries_of_one_partition():
    entries = [Entry(f"e{i}", "ab"[i % 2], 1, size, 1) for i, size in enumerate([40, 10, 30, 10, 30, 90, 20, 45, 60, 5])]
    found = bins(entries, 100)
    assert all(len({e.part for e in g}) == 1 and sum(e.bytes for e in g) <= 100 and len(g) > 1 for g in found)
    assert sorted(e.path for g in found for e in g) == ["e0", "e1", "e2", "e3", "e4", "e7", "e9"]
    assert bins([Entry("x", None, 1, 5, 1)], 100) == [] and len(bins([Entry("x", None, 9, 50, 5)], 100)) == 1


def test_a_snapshot_has_one_kind_of_partition(spark, tmp_path):
    with pytest.raises(ValueError):
        Snapshot(spark, str(tmp_path), ["a"], day(), keys=["a"])
