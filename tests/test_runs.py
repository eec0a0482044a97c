import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedwright.functions.dates import RunClock
from feedwright.plans import catalog
from feedwright.plans.enriching import enrich, report_coverage, snapshot_of
from feedwright.plans.spec import fill_schemas, read_schemas
from feedwright.plans.staging import read_staged, stage
from feedwright.plans.zones import Zones
from feedwright.sources.files import list_names
from feedwright.sources.readers import empty_frame, read_history, read_piped, read_typed_csv
from feedwright.sources.sinks import write_csv, write_split
from feedwright.sources.snapshot import Snapshot
from feedwright.streaming.arrivals import follow_staged


@pytest.fixture
def zones(tmp_path):
    return Zones(str(tmp_path))


@pytest.fixture
def specs():
    return catalog.feeds()


def deliver(tmp_path, folder, name, lines):
    target = tmp_path / "Raw" / folder
    target.mkdir(parents=True, exist_ok=True)
    (target / name).write_text("\n".join(lines) + "\n")


def manifest(spark, path):
    return spark.read.parquet(path)


PRODUCTS = [
    ",".join(catalog.PRODUCT_COLUMNS),
    *[f'{n},u{n},,,,"Name ""{n}""",b,,,,c' for n in ("p1", "p2", "p3", "p3", "0", "")],
]
LOCATIONS = [",".join(catalog.LOCATION_COLUMNS), *[f"{n},n,a,c,s,z,,f,r,g" for n in ("l1", "l2")]]


def sale(day, location, product, units="1"):
    return ",".join([day, location, product, *["0"] * 15, units])


def load_masters(spark, tmp_path, specs, zones, clock):
    deliver(tmp_path, "Target", "TGT_ITM_1.csv", PRODUCTS)
    deliver(tmp_path, "Target", "TGT_STR_1.csv", LOCATIONS)
    for name in ("TargetPOS_Product", "TargetPOS_Location"):
        stage(spark, specs[name], zones, "m", clock)
        enrich(spark, name, specs, zones, "m", clock)


def test_catalog_is_complete_and_ordered(specs):
    assert len(specs) == 55 and len(catalog.COVERAGE) == 10
    order = catalog.load_order(specs)
    for spec in specs.values():
        for lookup in spec.lookups:
            assert order.index(lookup.dataset) < order.index(spec.name)
    for spec in specs.values():
        if spec.columns:
            assert len(spec.columns) == spec.width
            assert {*spec.keys, *spec.unique, *(k.column for k in spec.lookups)} <= set(spec.columns)


def test_overlapping_globs_are_refused(specs):
    with pytest.raises(ValueError):
        catalog.check_globs([specs["TargetPOS_Sales"], catalog._plain("Other", "/Raw/Target/TGT_POS_X*.csv", 1)])


def test_schema_file(specs):
    found = read_schemas(["# wide feeds", "", "Weather = a,b,c,d,e"])
    assert fill_schemas(specs, found)["Weather"].columns == ("a", "b", "c", "d", "e")
    with pytest.raises(ValueError):
        specs["Weather"].with_columns("a,b")


def test_staging_verdicts(spark, tmp_path, specs, zones, clock):
    spec = specs["Weather"]
    deliver(tmp_path, "Walmart", "unilever_history_weekly_data_good.csv", ["zip,date,avgTemp,prcp,rh", '1,"2017 ""x""",3,,5', "2,b"])
    deliver(tmp_path, "Walmart", "unilever_history_weekly_data_swap.csv", ["date,zip,avgTemp,prcp,rh", "1,2,3,4,5"])
    deliver(tmp_path, "Walmart", "unilever_history_weekly_data_wide.csv", ["zip,date,avgTemp,prcp,rh,more", "1,2,3,4,5,6"])
    got = {r["FileName"].split("data_")[1]: r for r in stage(spark, spec, zones, "r1", clock).collect()}
    assert got["good.csv"]["Status"] == "Processed"
    assert got["good.csv"]["Error_description"] == "1 lines with too few or too many fields"
    off = spark.read.parquet(zones.line_records).collect()
    assert [(r["FileName"].split("data_")[1], r["Line"]) for r in off] == [("good.csv", "2,b")]
    assert got["good.csv"]["Total_row_Count"] == 2
    assert got["swap.csv"]["Error_description"] == "Schema validation failed"
    assert got["wide.csv"]["Status"] == "Rejected"
    staged = sorted(map(tuple, read_staged(spark, spec, zones, "r1").collect()))
    assert staged == [("1", "2017 x", "3", None, "5"), ("2", "b", None, None, None)]
    again = {r["FileName"].split("data_")[1]: r["Error_description"] for r in stage(spark, spec, zones, "r2", clock).collect()}
    assert again["good.csv"] == "File Renameing Failed / File already present in Stage"
    assert (tmp_path / "Raw/Walmart/unilever_history_weekly_data_swap.csv").exists()
    assert manifest(spark, zones.file_manifests).count() == 6


def test_staging_without_files(spark, specs, zones, clock):
    row = stage(spark, specs["Holiday"], zones, "r1", clock).first()
    assert (row["Status"], row["Error_description"]) == ("Rejected", "File Not Found")


def test_staging_piped(spark, tmp_path, specs, zones, clock):
    spec = specs["Target_GRM"].with_columns([f"c{i}" for i in range(19)])
    line = "|".join(["1"] * 19)
    deliver(tmp_path, "Target", "TGT_GRM_POS_a.txt", [line, line.replace("1", '"1"'), "1|2"])
    deliver(tmp_path, "Target", "TGT_GRM_POS_b.txt", ["1|2|3", line])
    got = {r["FileName"]: (r["Status"], r["Total_row_Count"]) for r in stage(spark, spec, zones, "r1", clock, every_line=False).collect()}
    assert got == {"TGT_GRM_POS_a.txt": ("Processed", 3), "TGT_GRM_POS_b.txt": ("Rejected", 2)}
    staged = read_staged(spark, spec, zones, "r1")
    assert staged.count() == 3 and staged.where("c18 = '1'").count() == 2
    strict = {r["FileName"]: r["Status"] for r in stage(spark, spec, Zones(zones.root), "r2", clock).collect()}
    assert set(strict.values()) == {"Rejected"}


def test_steps_can_be_repeated(spark, tmp_path, specs, zones, clock):
    spec = specs["Weather"]
    lines = ["zip,date,avgTemp,prcp,rh", '1,2017,"3,4",,5', "2,2017,3,4,5,6"]
    deliver(tmp_path, "Walmart", "unilever_history_weekly_data_good.csv", lines)
    seen = []
    for _ in range(2):
        stage(spark, spec, zones, "r1", clock)
        enrich(spark, "Weather", specs, zones, "r1", clock)
        tables = (read_staged(spark, spec, zones, "r1"), snapshot_of(spark, spec, zones).read())
        tables += tuple(manifest(spark, p) for p in (zones.file_manifests, zones.run_manifests, zones.line_records))
        tables = (*tables, spark.read.parquet(zones.error_records))
        timed = ("Start_Date_Time", "End_Date_Time")
        seen.append([sorted(map(str, t.drop(*[c for c in t.columns if "ime" in c or c in timed]).collect())) for t in tables])
    assert seen[0] == seen[1] and len(seen[0][0]) == 2 and len(seen[0][2]) == len(seen[0][3]) == len(seen[0][4]) == 1


def test_staging_jobs_do_not_grow_with_files(spark, tmp_path, specs, clock):
    counts = []
    for n in (2, 20):
        zones = Zones(str(tmp_path / str(n)))
        for i in range(n):
            deliver(tmp_path / str(n), "Walmart", f"unilever_history_weekly_data_{i}.csv", ["zip,date,avgTemp,prcp,rh", "1,2,3,4,5"])
        spark.sparkContext.setJobGroup(f"files-{n}", "staging")
        stage(spark, specs["Weather"], zones, "r1", clock)
        counts.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"files-{n}")))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts[0] == counts[1]


def test_master_run(spark, tmp_path, specs, zones, clock):
    load_masters(spark, tmp_path, specs, zones, clock)
    kept = snapshot_of(spark, specs["TargetPOS_Product"], zones).read()
    assert sorted(r["ProductNbr"] for r in kept.collect()) == ["p1", "p2"]
    errors = spark.read.parquet(zones.error_records).where("dataset = 'TargetPOS_Product'")
    texts = sorted((r["Error_Description"], r["Error_Record"].split(",")[0]) for r in errors.collect())
    assert texts == [
        ("Columns: ProductNbr is Duplicate in data", "p3"),
        ("Columns: ProductNbr is Duplicate in data", "p3"),
        ("Columns: ProductNbr is not proper(null/blank/0/Unparceable)", "0"),
        ("Columns: ProductNbr is not proper(null/blank/0/Unparceable)", "null"),
    ]
    run = manifest(spark, zones.run_manifests).where("dataset = 'TargetPOS_Product'").first()
    assert (run["No_Of_records_received"], run["No_Of_records_rejected"], run["No_Of_records_processed"]) == (6, 4, 2)
    # A repeated key is quarantined and its old row stays.
    deliver(tmp_path, "Target", "TGT_ITM_2.csv", [PRODUCTS[0], "p1,new,,,,,,,,,", "p2,x,,,,,,,,,", "p2,y,,,,,,,,,"])
    stage(spark, specs["TargetPOS_Product"], zones, "m2", clock)
    enrich(spark, "TargetPOS_Product", specs, zones, "m2", clock)
    kept = snapshot_of(spark, specs["TargetPOS_Product"], zones).read()
    assert sorted((r["ProductNbr"], r["UPC"]) for r in kept.collect()) == [("p1", "new"), ("p2", "up2")]


def test_fact_run_restates_a_range(spark, tmp_path, specs, zones, clock):
    load_masters(spark, tmp_path, specs, zones, clock)
    header = ",".join(catalog.SALES_COLUMNS)
    spec = specs["TargetPOS_Sales"]
    first = [sale(d, "l1", "p1") for d in ("2017-01-07", "2017-01-14", "2017-01-21", "2017-01-28")]
    bad = [sale("2017-01-07", "l9", "p9"), sale("2017-01-07", "l9", "p9"), sale("2017-13-07", "l1", "p1"), sale("2017-01-07", "", "p1")]
    deliver(tmp_path, "Target", "TGT_POS_1.csv", [header, *first, first[0], *bad])
    stage(spark, spec, zones, "r1", clock)
    result = enrich(spark, spec.name, specs, zones, "r1", clock)
    assert (result.received, result.processed, result.rejected) == (9, 5, 4)
    assert (result.first_day, result.last_day) == (dt.date(2017, 1, 7), dt.date(2017, 1, 28))
    snapshot = snapshot_of(spark, spec, zones)
    assert sorted(r["TransWeek"] for r in snapshot.read().collect()) == ["01/07/2017", "01/14/2017", "01/21/2017", "01/28/2017"]
    errors = spark.read.parquet(zones.error_records).where("dataset = 'TargetPOS_Sales'").collect()
    texts = sorted(r["Error_Description"] for r in errors)
    assert texts == [
        "Columns: LocationNbr, ProductNbr, TransWeek is not proper(null/blank/0/Unparceable)",
        "Columns: LocationNbr, ProductNbr, TransWeek is not proper(null/blank/0/Unparceable)",
        "Refrential Integrity failed at column: LocationNbr",
        "Refrential Integrity failed at column: ProductNbr",
    ]
    assert any(r["Error_Record"].startswith("Unparceable,l1,p1") for r in errors)

    deliver(tmp_path, "Target", "TGT_POS_2.csv", [header, sale("2017-01-14", "l2", "p2", "7"), sale("2017-01-28", "l2", "p2", "7")])
    stage(spark, spec, zones, "r2", clock)
    want = [("01/07/2017", "l1"), ("01/14/2017", "l2"), ("01/28/2017", "l2")]
    for _ in range(2):
        enrich(spark, spec.name, specs, zones, "r2", clock)
        assert sorted((r[0], r[1]) for r in snapshot.read().collect()) == want
    assert snapshot.read_dates(dt.date(2017, 1, 10), dt.date(2017, 1, 20)).count() == 1
    assert spark.read.parquet(zones.increments(spec.name)).where("run_id = 'r2'").count() == 2

    weeks = report_coverage(spark, "TargetPOS_Sales_MissingWk", catalog.COVERAGE, specs, zones, RunClock(dt.datetime(2017, 2, 5)))
    assert [(r["TransWeek"], r["Availability"]) for r in weeks.orderBy("TransWeek").collect()] == [
        ("01/07/2017", "Yes"), ("01/14/2017", "Yes"), ("01/21/2017", "No"), ("01/28/2017", "Yes"), ("02/04/2017", "No"),
    ]

    # A delivery without a single good row changes nothing.
    deliver(tmp_path, "Target", "TGT_POS_3.csv", [header, sale("2017-01-14", "l9", "p2")])
    stage(spark, spec, zones, "r3", clock)
    result = enrich(spark, spec.name, specs, zones, "r3", clock)
    assert (result.status, result.processed) == ("Processed", 0)
    assert sorted((r[0], r[1]) for r in snapshot.read().collect()) == want


def test_append_run_and_file_arrivals(spark, tmp_path, specs, zones, clock):
    spec = specs["Weather"]
    header = ",".join(spec.columns)
    deliver(tmp_path, "Walmart", "unilever_history_weekly_data_1.csv", [header, "1,d1,1,1,1", "1,d1,1,1,1", "2,0,1,1,1"])
    stage(spark, spec, zones, "r1", clock)
    for _ in range(2):
        follow_staged(spark, spec.name, specs, zones).awaitTermination()
        assert snapshot_of(spark, spec, zones).read().count() == 1
    deliver(tmp_path, "Walmart", "unilever_history_weekly_data_2.csv", [header, "1,d1,1,1,1", "1,d2,,1,1"])
    stage(spark, spec, zones, "r2", clock)
    follow_staged(spark, spec.name, specs, zones).awaitTermination()
    assert snapshot_of(spark, spec, zones).read().count() == 2
    enrich(spark, spec.name, specs, zones, "r2", clock)
    assert snapshot_of(spark, spec, zones).read().count() == 2


def test_scan_run_takes_spelling_and_pads(spark, tmp_path, specs, zones, clock):
    wide = ["PRDC_KEY", "PRDC_TAG", "PRDC_CODE", *[f"x/{i}" for i in range(374)]]
    markets = ["MKT", "LDESC", *[f"m{i}" for i in range(16)]]
    specs = fill_schemas(specs, {"Nielsen_Product": ",".join(wide), "Nielsen_DHC_Market": ",".join(markets)})
    deliver(tmp_path, "Nielsen", "NLS_ITM_1.csv", [",".join(wide), ",".join(["k1", "T", "123", *["v"] * 374])])
    deliver(tmp_path, "Nielsen", "NLS_STR_1.csv", [",".join(markets), ",".join(["m1", "Total US", *["v"] * 16])])
    period = ",".join(catalog.PERIOD_COLUMNS)
    deliver(tmp_path, "Nielsen", "NLS_PRD_1.csv", [period, "P,S,L,01/07/17,W,,,,,", "P,,L,01/14/17,W,,,,,"])
    scan = catalog.SCAN_COLUMNS

    def week(geo, upc, day):
        return ",".join([geo, upc, day, *["1"] * 53, day])

    deliver(tmp_path, "Nielsen", "NLS_SYN_1.csv", [",".join(scan), week("total us", "123", "2017-01-07"), week("Mars", "9", "2017-01-14")])
    for name in ("Nielsen_Product", "Nielsen_DHC_Market", "Nielsen_Period", "Nielsen_Scan_UPC"):
        assert stage(spark, specs[name], zones, "r", clock).first()["Status"] == "Processed"
        enrich(spark, name, specs, zones, "r", clock)
    got = snapshot_of(spark, specs["Nielsen_Scan_UPC"], zones).read().collect()
    assert [(r["GEO"], r["UPC"], r["WeekEnding"], r["Max_PeriodEnd"]) for r in got] == [("TOTAL US", "0000000000123", "01/07/2017", "01/07/2017")]
    errors = spark.read.parquet(zones.error_records).where("dataset = 'NielsenScantrack'").collect()
    assert sorted(r["Error_Description"].rsplit(" ", 1)[1] for r in errors) == ["GEO", "UPC", "WEEKENDING"]


def test_per_file_run(spark, tmp_path, specs, zones, clock):
    keys = [k.replace("_", " ") for k in catalog.PLANOGRAM_KEYS]
    keys = [k if k.replace(" ", "_") in ("Store_Nbr", "Planogram_Name", "Send_Trait") else k.replace(" ", "_") for k in keys]
    header = [*keys, *[f"extra {i}" for i in range(6)]]
    items = ["ITEM_KEY", "UPC", *[f"i{i}" for i in range(153)]]
    stores = ["RETAILER_KEY", "STORE_KEY", *[f"s{i}" for i in range(173)]]
    specs = fill_schemas(specs, {
        "Walmart_Assortment": ",".join(header), "Walmart_ULHairOil_ITEM": ",".join(items), "Walmart_Store_HairOil": ",".join(stores),
    })
    deliver(tmp_path, "Walmart", "WMT_HCS_ITM_1.csv", [",".join(items), ",".join(['"1,0"', "77", *["v"] * 153])])
    deliver(tmp_path, "Walmart", "WMT_HCS_STR_1.csv", [",".join(stores), ",".join(["r", '"1,5"', *["v"] * 173])])

    def row(**changes):
        values = dict.fromkeys(catalog.PLANOGRAM_KEYS, "1")
        values |= {"Store_Nbr": "15", "UPC": "0000000000077", "PL_Name": "a & b", "PL_Category": "x y"} | changes
        return ",".join([*[values[k] for k in catalog.PLANOGRAM_KEYS], *[""] * 6])

    deliver(tmp_path, "Assortment/Mod", "DHC_a.csv", [",".join(header), row(), row(), row(Position_X="-1"), row(Store_Nbr="9", UPC="9")])
    deliver(tmp_path, "Assortment/Mod", "DHC_b.csv", [",".join(header), row(PL_Brand="`q`")])
    for name in ("Walmart_ULHairOil_ITEM", "Walmart_Store_HairOil", "Walmart_Assortment"):
        stage(spark, specs[name], zones, "r", clock)
        enrich(spark, name, specs, zones, "r", clock)
    got = spark.read.parquet(zones.per_file("Walmart_Assortment")).orderBy("file").collect()
    assert [(r["file"], r["PL_Name"], r["PL_Category"], r["PL_Brand"]) for r in got] == [
        ("DHC_a.csv", "a and b", "x_y", "1"), ("DHC_b.csv", "a and b", "x_y", "q"),
    ]
    errors = spark.read.parquet(zones.error_records).where("dataset = 'Walmart_Assortment'").collect()
    assert sorted((r["Data_Set_Name"], r["Error_Description"][-11:]) for r in errors) == [
        ("DHC_a", "Unparceable)"[-11:]), ("DHC_a", "tion Failed"),
    ]
    runs = spark.read.parquet(zones.run_manifests).where("Data_Set_Name like 'DHC%'").collect()
    assert sorted((r[0], r[2], r[3], r[4]) for r in runs) == [("DHC_a", 4, 3, 1), ("DHC_b", 1, 0, 1)]


def test_failed_run_leaves_a_manifest(spark, tmp_path, specs, zones, clock):
    with pytest.raises(Exception):
        enrich(spark, "Weather", specs, zones, "never-staged", clock)
    row = manifest(spark, zones.run_manifests).first()
    assert row["Status"] == "Exception Occured while Processing" and row["No_Of_records_received"] is None


def test_scratch_tables_go_with_their_run(spark):
    from feedwright.operators.sizing import settle
    from feedwright.session import scratch_path, scratch_run
    from feedwright.sources.files import exists

    with scratch_run(spark) as folder:
        found = settle(spark.range(3), "x", sized=True)
        assert (found.rows, found.bytes) == (3, 3) and exists(spark, folder)
    assert not exists(spark, folder) and folder not in scratch_path(spark, "y")


def test_scratch_root_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from feedwright.session import scratch_root

    def session(master, folder=None):
        conf = SimpleNamespace(get=lambda key, default=None: folder)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="app"))

    assert scratch_root(session("yarn", "hdfs:///scratch/")) == "hdfs:///scratch"
    assert scratch_root(session("local[2]")) == scratch_root(session("local[2]"))
    with pytest.raises(ValueError):
        scratch_root(session("yarn"))


def test_wide_feeds_need_their_columns(spark, specs, zones):
    with pytest.raises(ValueError, match="schema file"):
        stage(spark, specs["Nielsen_Product"], zones, "r")
    with pytest.raises(ValueError, match="schema file"):
        enrich(spark, "Nielsen_Product", specs, zones, "r")


def test_snapshot_versions(spark, tmp_path, text):
    snap = Snapshot(spark, str(tmp_path / "s"), ["a"])
    assert snap.read().count() == 0 and snap.current() is None
    snap.replace(text(["a"], [("1",)]))
    snap.replace(snap.read().unionByName(text(["a"], [("2",)])))
    snap.append(text(["a"], [("3",)]))
    assert snap.read().count() == 3 and snap.versions() == [1, 2]
    (tmp_path / "s" / "v=3").mkdir()
    assert snap.versions() == [1, 2]
    snap.replace(text(["a"], [("9",)]))
    assert snap.versions() == [1, 2, 4] and snap.prune(1) and snap.versions() == [4]


def test_history_reader(spark, tmp_path, text):
    path = str(tmp_path / "h")
    assert read_history(spark, path, "a,b").count() == 0 and empty_frame(spark, "a").columns == ["a"]
    write_csv(text(["a", "b"], [("1", None)]), path)
    assert [tuple(r) for r in read_history(spark, path, "x,y", fmt="csv").collect()] == [("1", None)]


def test_scans(spark, tmp_path):
    nested = tmp_path / "n" / "one"
    nested.mkdir(parents=True)
    (nested / "f.csv").write_text('a,b\n1,"x ""q"" y"\n2\n3,4,5\n')
    got = sorted(map(tuple, read_typed_csv(spark, str(tmp_path / "n"), "p,q", nested=True).collect()))
    assert got == [("1", 'x "q" y'), ("2", None), ("3", "4")]
    (nested / "f.csv").unlink()
    (nested / "f.txt").write_text("1|2\n3|\n")
    assert sorted(map(tuple, read_piped(spark, str(tmp_path / "n"), "p,q", nested=True).collect())) == [("1", "2"), ("3", None)]


def test_split_sink(spark, tmp_path):
    write_split(spark.range(10).withColumn("bucket", F.col("id") % 3), str(tmp_path / "b"))
    assert [n for n in list_names(spark, str(tmp_path / "b")) if "=" in n] == ["bucket=0", "bucket=1", "bucket=2"]
