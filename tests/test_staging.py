"""Record scan, file ledger and repeated runs of staging, and what an empty delivery does."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from feedwright.plans import catalog
from feedwright.plans.enriching import enrich, snapshot_of
from feedwright.plans.staging import file_ids, ledger, read_staged, stage
from feedwright.plans.zones import Zones
from feedwright.sources.files import File
from feedwright.sources.record_scan import parsed, read_records

HEADER = "zip,date,avgTemp,prcp,rh"
NAME = "unilever_history_weekly_data_{}.csv"


@pytest.fixture
def weather():
    return catalog.feeds()["Weather"]


def deliver(tmp_path, name, *lines):
    target = tmp_path / "Raw" / "Walmart" / name
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text("\n".join(lines) + "\n")


def verdicts(manifest):
    return {r["FileName"]: (r["Status"], r["Error_description"], r["Total_row_Count"]) for r in manifest.collect()}


def test_records_of_split_files(spark, tmp_path, monkeypatch):
    """Quoted line breaks across splits of 200 bytes, against the csv module."""
    r, want = random.Random(4), {}
    for f in range(3):
        texts = ["".join(r.choice(["a", "b", "\n", '"', ",", " x", "\n\n"]) for _ in range(r.randint(0, 20))) for _ in range(50)]
        rows = [["id", "text", "c"], *[[str(i), t, r.choice(["", "x", "y z"])] for i, t in enumerate(texts)]]
        held = io.StringIO()
        csv.writer(held, lineterminator="\n").writerows(rows)
        (tmp_path / f"f{f}.csv").write_text(held.getvalue())
        want[f"f{f}.csv"] = rows
    (tmp_path / "stray.csv").write_text('id,text,c\n1,a"b,c\n2,d,e\n\n3,f,g\n')
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        found = parsed(read_records(spark, [str(tmp_path)]), ["id", "text", "c"], "path", "record").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    for name, rows in want.items():
        own = sorted((x["record"], x["id"], x["text"] or "", x["c"] or "") for x in found if x["path"].endswith(name))
        assert own == [(i + 1, *row) for i, row in enumerate(rows)]
    stray = sorted((x["id"], x["text"], x["c"]) for x in found if x["path"].endswith("stray.csv"))
    assert stray == [("1", 'a"b', "c"), ("2", "d", "e"), ("3", "f", "g"), ("id", "text", "c")]


def test_long_records_mean_a_stray_quote(spark, tmp_path):
    (tmp_path / "f.csv").write_text('a,b\n1,"x\n' + "y\n" * 20 + '2,z"\n')
    assert read_records(spark, [str(tmp_path)], most=10).count() == 23
    assert read_records(spark, [str(tmp_path)], most=30).count() == 2


def test_quoted_line_breaks_are_staged(spark, tmp_path, weather, clock):
    zones = Zones(str(tmp_path))
    deliver(tmp_path, NAME.format("a"), HEADER, '1,"x', 'y",3,4,5', "2,b,3,4,5", '3,"c', '', 'd",3')
    deliver(tmp_path, NAME.format("b"), HEADER, "4,e,3,4,5")
    found = verdicts(stage(spark, weather, zones, "r1", clock))
    assert found[NAME.format("a")] == ("Processed", "1 lines with too few or too many fields", 3)
    assert found[NAME.format("b")] == ("Processed", "NA", 1)
    staged = sorted(tuple(r) for r in read_staged(spark, weather, zones, "r1").fillna("").collect())
    assert staged == [("1", "x\ny", "3", "4", "5"), ("2", "b", "3", "4", "5"), ("3", "c\n\nd", "3", "", ""), ("4", "e", "3", "4", "5")]
    lines = spark.read.parquet(zones.line_records).collect()
    assert [(r["FileName"], r["Line"]) for r in lines] == [(NAME.format("a"), '3,"c\n\nd",3')]


def test_restaged_runs_keep_no_refused_rows(spark, tmp_path, weather, clock):
    zones = Zones(str(tmp_path))
    deliver(tmp_path, NAME.format("a"), HEADER, "1,a,,,")
    deliver(tmp_path, NAME.format("b"), HEADER, "2,b,,,")
    stage(spark, weather, zones, "r1", clock)
    deliver(tmp_path, NAME.format("b"), "zip,wrong", "2,b")
    found = verdicts(stage(spark, weather, zones, "r1", clock))
    assert found[NAME.format("b")][0] == "Rejected"
    assert [r["zip"] for r in read_staged(spark, weather, zones, "r1").collect()] == ["1"]
    # The file that was withdrawn is free for the next run, the other one is not.
    deliver(tmp_path, NAME.format("b"), HEADER, "2,b,,,")
    found = verdicts(stage(spark, weather, zones, "r2", clock))
    assert found[NAME.format("a")][:2] == ("Rejected", "File Renameing Failed / File already present in Stage")
    assert found[NAME.format("b")][:2] == ("Processed", "NA")
    assert [r["zip"] for r in read_staged(spark, weather, zones, "r2").collect()] == ["2"]


def test_the_ledger_tells_changed_files_apart(spark, tmp_path, weather, clock, monkeypatch):
    zones = Zones(str(tmp_path))
    deliver(tmp_path, NAME.format("a"), HEADER, "1,a,,,")
    stage(spark, weather, zones, "r1", clock)
    deliver(tmp_path, NAME.format("a"), HEADER, "9,a,,,")
    found = verdicts(stage(spark, weather, zones, "r2", clock))
    assert found[NAME.format("a")][:2] == ("Rejected", "File already present in Stage, changed since")
    rows = ledger(spark, zones, "Weather").read().collect()
    assert [(r["name"], r["run"], r["verdict"]) for r in rows] == [(NAME.format("a"), "r1", "Processed")]


def test_one_base_name_in_two_folders(spark, tmp_path, weather, clock):
    from dataclasses import replace

    zones = Zones(str(tmp_path))
    spec = replace(weather, raw_glob="/Raw/Walmart/*/data.csv")
    deliver(tmp_path, "north +1/data.csv", HEADER, "1,a,,,")
    deliver(tmp_path, "south%20/data.csv", HEADER, "2,b,,,", "3,c,,,")
    found = verdicts(stage(spark, spec, zones, "r1", clock))
    assert found == {"north +1/data.csv": ("Processed", "NA", 1), "south%20/data.csv": ("Processed", "NA", 2)}
    assert sorted(r["zip"] for r in read_staged(spark, spec, zones, "r1").collect()) == ["1", "2", "3"]
    assert file_ids([File("/a/b/x", "x"), File("/c/b/x", "x")]) == ({"/a/b/x": "a/b/x", "/c/b/x": "c/b/x"}, 3)


def test_an_empty_delivery_leaves_the_snapshot_alone(spark, tmp_path, weather, clock):
    zones, specs = Zones(str(tmp_path)), catalog.feeds()
    deliver(tmp_path, NAME.format("a"), HEADER, "1,a,,,")
    stage(spark, weather, zones, "r1", clock)
    enrich(spark, "Weather", specs, zones, "r1", clock)
    deliver(tmp_path, NAME.format("a"), "zip", "1")
    for run in ("r2", "r2"):
        stage(spark, weather, zones, run, clock)
        result = enrich(spark, "Weather", specs, zones, run, clock)
        assert (result.status, result.received, result.processed) == ("Processed", 0, 0)
    assert snapshot_of(spark, weather, zones).read().count() == 1
    runs = spark.read.parquet(zones.run_manifests).where("run_id = 'r2'").collect()
    assert [(r["Status"], r["No_Of_records_received"]) for r in runs] == [("Processed", 0)]
    with pytest.raises(Exception):
        enrich(spark, "Weather", specs, zones, "never", clock)
