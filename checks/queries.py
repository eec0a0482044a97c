"""One query per operator, each over whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.feeds import (
    DASHED,
    as_text,
    customer,
    day_text,
    lineitem,
    monthly_lines,
    monthly_orders,
    orders,
    table,
)
from feedwright.functions import dates as d
from feedwright.functions import text as tx
from feedwright.operators import buckets, coverage, merge, records, rules, schema, setops, unique
from feedwright.operators.lookups import (
    Lookup,
    failed_rows,
    flag_lookups,
    keep_known,
    kept_rows,
    unknown_rows,
)
from feedwright.plans import catalog
from feedwright.plans.enriching import (
    clean_rows,
    enrich,
    enrich_frame,
    judge,
    judged_errors,
    report_coverage,
    settle_judged,
    snapshot_of,
)
from feedwright.plans.loading import load
from feedwright.plans.spec import FeedSpec, LookupSpec, dates, pad, without
from feedwright.plans.staging import header_verdicts, narrow_lines, read_staged, stage
from feedwright.plans.zones import Zones
from feedwright.session import scratch_path
from feedwright.sources.files import glob_files, list_names, move_file
from feedwright.sources.readers import file_name, master_keys, read_headed_csv, read_lines, read_piped
from feedwright.sources.sinks import write_csv, write_increment, write_lines, write_per_file, write_split
from feedwright.sources.snapshot import Snapshot

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}
CLOCK = d.RunClock(dt.datetime(2002, 3, 15))


def query(fn: Query) -> Query:
    REGISTERED[fn.__name__] = fn
    return fn


def without_time(errors: DataFrame) -> DataFrame:
    return errors.drop("Insert_Time")


# --- key rules -----------------------------------------------------------

ORDER_KEYS = ["o_orderkey", "o_custkey"]


@query
def key_rule_clean(spark, sf):
    return rules.split(orders(spark, sf), rules.bad_key(ORDER_KEYS))[0]


@query
def key_rule_errors(spark, sf):
    _, bad = rules.split(orders(spark, sf), rules.bad_key(ORDER_KEYS))
    return without_time(records.error_records(bad, "orders", records.BAD_KEY.format(",".join(ORDER_KEYS))))


@query
def key_rule_any(spark, sf):
    df = customer(spark, sf).withColumns(
        {"c_mktsegment": F.expr("nullif(c_mktsegment, 'BUILDING')"), "c_nationkey": F.expr("nullif(c_nationkey, '3')")}
    )
    return df.where(rules.any_present(["c_mktsegment", "c_nationkey"]))


def shelf(spark, sf):
    """Lines as a planogram: some measures negative, some without a leading zero, some names blank."""
    return lineitem(spark, sf).select(
        "l_orderkey",
        "l_linenumber",
        F.expr("case when l_returnflag = 'R' and l_linestatus = 'O' then concat('-', l_quantity) else l_quantity end").alias("height"),
        F.expr("case when l_linestatus = 'F' then replace(l_discount, '0.', '.') else l_discount end").alias("depth"),
        F.expr("case when l_returnflag = 'A' and l_linestatus = 'F' then '' else l_returnflag end").alias("merch_group"),
    )


def _shelf_rule(string_order=False):
    return rules.planogram_rule(["l_orderkey", "merch_group"], ["height", "depth"], string_order)


@query
def planogram_clean(spark, sf):
    return rules.split(shelf(spark, sf), _shelf_rule())[0]


@query
def planogram_errors(spark, sf):
    return rules.split(shelf(spark, sf), _shelf_rule())[1]


@query
def planogram_clean_text_order(spark, sf):
    return rules.split(shelf(spark, sf), _shelf_rule(True))[0]


@query
def planogram_errors_text_order(spark, sf):
    return rules.split(shelf(spark, sf), _shelf_rule(True))[1]


# --- unique keys ---------------------------------------------------------

LINE_KEYS = ["l_orderkey", "l_linenumber"]


@query
def unique_split_clean(spark, sf):
    return unique.split_unique(table(spark, sf, "lineitem"), LINE_KEYS)[0]


@query
def unique_split_dups(spark, sf):
    return unique.split_unique(table(spark, sf, "lineitem"), LINE_KEYS)[1]


@query
def unique_split_dups_distinct(spark, sf):
    lines = table(spark, sf, "lineitem")
    twice = lines.unionByName(lines.where("l_returnflag = 'R'"))
    return unique.split_unique(twice, LINE_KEYS, distinct_dups=True)[1]


@query
def unique_dup_records(spark, sf):
    _, dups = unique.split_unique(orders(spark, sf), ["o_custkey"])
    return without_time(records.error_records(dups, "orders", records.DUPLICATE.format("o_custkey")))


@query
def key_counts(spark, sf):
    return unique.key_counts(table(spark, sf, "lineitem"), LINE_KEYS).toDF(*LINE_KEYS, "n")


@query
def single_key_counts(spark, sf):
    return unique.single_keys(table(spark, sf, "lineitem"), LINE_KEYS).toDF(*LINE_KEYS)


@query
def padded_collisions(spark, sf):
    """Order numbers that are one code once they are cut to four digits."""
    keys = as_text(table(spark, sf, "lineitem").select("l_orderkey"))
    return unique.padded_collisions(keys, "l_orderkey", 4)


# --- lookups -------------------------------------------------------------


def listed_parts(spark, sf):
    return table(spark, sf, "part").where("p_size <= 25")


def line_lookups(spark, sf):
    return [
        Lookup("l_partkey", listed_parts(spark, sf), "p_partkey"),
        Lookup("l_suppkey", table(spark, sf, "supplier").where("s_nationkey < 12"), "s_suppkey"),
        Lookup("l_orderkey", table(spark, sf, "orders").where("o_orderstatus <> 'P'"), "o_orderkey"),
    ]


@query
def fk_keep(spark, sf):
    return keep_known(table(spark, sf, "lineitem"), Lookup("l_partkey", listed_parts(spark, sf), "p_partkey"))


@query
def fk_errors(spark, sf):
    return unknown_rows(table(spark, sf, "lineitem"), Lookup("l_partkey", listed_parts(spark, sf), "p_partkey"))


@query
def fk_documents_keep(spark, sf):
    return keep_known(table(spark, sf, "documents"), Lookup("doc_id", table(spark, sf, "labels"), "doc_id"))


@query
def fk_documents_errors(spark, sf):
    return unknown_rows(table(spark, sf, "documents"), Lookup("doc_id", table(spark, sf, "labels"), "doc_id"))


@query
def fk_chain_clean(spark, sf):
    lines, lookups = table(spark, sf, "lineitem"), line_lookups(spark, sf)
    return kept_rows(flag_lookups(lines, lookups), lookups, lines.columns)


@query
def fk_chain_errors(spark, sf):
    lines, lookups = table(spark, sf, "lineitem"), line_lookups(spark, sf)
    failed = failed_rows(flag_lookups(lines, lookups), lookups, lines.columns)
    return failed.withColumnRenamed("_failed", "failed")


@query
def fk_chain_records(spark, sf):
    lines, lookups = lineitem(spark, sf), line_lookups(spark, sf)
    failed = failed_rows(flag_lookups(lines, lookups), lookups, lines.columns)
    text = F.concat(F.lit(records.FACT_LOOKUP.format("")), F.col("_failed"))
    return without_time(records.error_records(failed, "lineitem", text, lines.columns))


@query
def fk_ci_spelling(spark, sf):
    df = customer(spark, sf).withColumn("c_mktsegment", F.lower("c_mktsegment"))
    known = table(spark, sf, "customer").where("c_mktsegment <> 'FURNITURE'").select("c_mktsegment")
    master = known.unionByName(known.select(F.initcap("c_mktsegment").alias("c_mktsegment")))
    lookups = [Lookup("c_mktsegment", master, "c_mktsegment", ignore_case=True, take_spelling=True)]
    return kept_rows(flag_lookups(df, lookups), lookups, df.columns)


@query
def master_key_scan(spark, sf):
    return master_keys(table(spark, sf, "customer"), "c_nationkey")


# --- merges --------------------------------------------------------------


def _by_status(spark, sf, *status):
    return orders(spark, sf).where(F.col("o_orderstatus").isin(*status))


@query
def merge_append(spark, sf):
    return merge.append_distinct(_by_status(spark, sf, "F", "O"), _by_status(spark, sf, "O", "P"))


@query
def merge_append_new_rows(spark, sf):
    return merge.new_rows(_by_status(spark, sf, "F", "O"), _by_status(spark, sf, "O", "P"))


def _raised_balances(spark, sf):
    return table(spark, sf, "customer").where("c_nationkey = 3").withColumn("c_acctbal", F.col("c_acctbal") + 1)


@query
def merge_upsert(spark, sf):
    return merge.upsert(table(spark, sf, "customer"), _raised_balances(spark, sf), ["c_custkey"])


def _late_orders(spark, sf):
    late = orders(spark, sf).where("o_orderdate >= '2001-07-01' and o_orderstatus = 'F'")
    return late.withColumn("o_orderdate", d.reformat_date("o_orderdate", *DASHED))


@query
def merge_replace_range(spark, sf):
    history = orders(spark, sf, "MM/dd/yyyy")
    return merge.replace_range(history, _late_orders(spark, sf), merge.feed_day("o_orderdate"))


@query
def merge_replace_dates(spark, sf):
    history = orders(spark, sf, "MM/dd/yyyy")
    return merge.replace_range(history, _late_orders(spark, sf), merge.feed_day("o_orderdate"), scope="dates")


@query
def merge_per_file(spark, sf):
    df = table(spark, sf, "events").select(F.col("event_type").alias("file"), "user_id", "props")
    return merge.per_file(df)


# --- set operators -------------------------------------------------------


@query
def union_all_rows(spark, sf):
    return setops.union_all(_by_status(spark, sf, "F", "O"), _by_status(spark, sf, "O", "P"))


@query
def except_distinct_rows(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag")
    return setops.except_distinct(lines, lines.where("l_returnflag = 'R'"))


@query
def except_keep_copies_rows(spark, sf):
    parts = table(spark, sf, "lineitem").select("l_partkey", "l_returnflag")
    return setops.except_keep_copies(parts, parts.where("l_returnflag = 'R'"))


@query
def distinct_rows(spark, sf):
    return setops.distinct_keys(table(spark, sf, "conversations"), ["role", "text"])


@query
def distinct_key_pairs(spark, sf):
    return setops.distinct_keys(table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"])


# --- coverage ------------------------------------------------------------


@query
def missing_weeks(spark, sf):
    return coverage.missing_weeks(orders(spark, sf, "MM/dd/yyyy"), "o_orderdate", CLOCK.date, "orders")


@query
def missing_weeks_large_urgent(spark, sf):
    df = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT' and o_totalprice > 480000")
    dated = df.select(day_text("o_orderdate", "MM/dd/yyyy").alias("o_orderdate"))
    return coverage.missing_weeks(dated, "o_orderdate", CLOCK.date, "large urgent orders")


@query
def missing_weeks_events(spark, sf):
    df = table(spark, sf, "events").select(day_text("ts", "MM/dd/yyyy").alias("day"))
    return coverage.missing_weeks(df, "day", dt.date(2024, 3, 31), "events", text_order=True)


@query
def first_and_last_day(spark, sf):
    return coverage.first_and_last_day(orders(spark, sf, "MM/dd/yyyy"), "o_orderdate")


@query
def week_labels(spark, sf):
    day = d.parse_date("o_orderdate", *d.CONFORMED_FORMATS)
    return (
        orders(spark, sf, "MM/dd/yyyy")
        .select("o_orderdate")
        .distinct()
        .select(
            "o_orderdate",
            d.week_label("o_orderdate").alias("label"),
            d.week_start(day).alias("week_start"),
            d.saturday_of_week(day).alias("saturday"),
            d.saturday_on_or_before(day).alias("saturday_before"),
        )
    )


# --- dates ---------------------------------------------------------------


def mixed_dates(spark, sf):
    """Ship dates in the form that each return flag stands for; one form cannot be read."""
    text = F.expr(
        "case l_returnflag when 'A' then date_format(l_shipdate, 'yyyy-MM-dd') "
        "when 'N' then date_format(l_shipdate, 'yyyyMMdd') else concat('wk ', date_format(l_shipdate, 'yy')) end"
    )
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", text.alias("ship_text"))


@query
def date_reformat(spark, sf):
    return mixed_dates(spark, sf).withColumn("ship_date", d.reformat_date("ship_text", "yyyy-M-d", "yyyyMMdd"))


@query
def date_epoch_millis(spark, sf):
    return mixed_dates(spark, sf).withColumn("millis", d.epoch_millis("ship_text", "yyyy-M-d", "yyyyMMdd"))


@query
def date_year(spark, sf):
    return mixed_dates(spark, sf).withColumn("year", d.date_year("ship_text", "yyyy-M-d", "yyyyMMdd").cast("bigint"))


@query
def date_millis_year(spark, sf):
    millis = d.epoch_millis("o_orderdate", *DASHED)
    return orders(spark, sf).select("o_orderkey", d.millis_year(millis).cast("bigint").alias("year"))


@query
def date_compare(spark, sf):
    lines = mixed_dates(spark, sf)
    placed = orders(spark, sf).select(F.col("o_orderkey").cast("bigint").alias("l_orderkey"), "o_orderdate")
    return lines.join(placed, "l_orderkey").select(
        "l_orderkey",
        "l_linenumber",
        "ship_text",
        d.compare_dates("ship_text", "o_orderdate", "yyyy-M-d", "yyyyMMdd").cast("bigint").alias("sign"),
    )


@query
def date_bounds(spark, sf):
    bounds = merge.date_bounds(orders(spark, sf, "MM/dd/yyyy"), merge.feed_day("o_orderdate"))
    return spark.createDataFrame([bounds], "lo date, hi date")


@query
def range_half_open(spark, sf):
    day = d.parse_date("o_orderdate", *DASHED)
    lo, hi = F.lit(dt.date(1998, 1, 1)), F.lit(dt.date(1998, 7, 1))
    return orders(spark, sf).where(rules.within_half_open(day, lo, hi))


@query
def bucket_52_weeks(spark, sf):
    return buckets.bucket_weeks(orders(spark, sf, "MM/dd/yyyy"), "o_orderdate")


@query
def bucket_52_weeks_sink(spark, sf):
    path = scratch_path(spark, "split")
    write_split(bucket_52_weeks(spark, sf), path)
    written = spark.read.parquet(path)
    return written.groupBy(F.col("bucket").cast("int").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key")
    )


# --- text ----------------------------------------------------------------


@query
def code_padding(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        tx.pad_code(F.col("p_partkey").cast("string"), 13).alias("code13"),
        tx.pad_code(F.col("p_partkey").cast("string"), 9).alias("code9"),
        tx.pad_code("p_name", 9).alias("name9"),
    )


@query
def strip_chars(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        tx.strip_chars("o_orderpriority", "-").alias("priority"),
        tx.strip_chars(day_text("o_orderdate"), "-").alias("packed_date"),
    )


@query
def strip_quotes(spark, sf):
    return table(spark, sf, "events").select("event_id", tx.strip_quotes("props").alias("props"))


@query
def strip_line_quotes(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.strip_line_quotes("html").alias("html"))


@query
def replace_text(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", tx.replace_text("text", ("&", "and"), (" ", "_"), ("`", "")).alias("text")
    )


@query
def blank_to_null(spark, sf):
    blanked = F.expr("case when c_mktsegment = 'MACHINERY' then repeat(' ', c_nationkey) else c_mktsegment end")
    return table(spark, sf, "customer").select("c_custkey", tx.blank_to_null(blanked).alias("segment"))


@query
def upper_keys(spark, sf):
    return table(spark, sf, "part").select("p_partkey", tx.upper_key("p_name").alias("p_name"))


@query
def row_text(spark, sf):
    df = table(spark, sf, "customer").withColumn("c_mktsegment", F.expr("nullif(c_mktsegment, 'BUILDING')"))
    return df.select("c_custkey", tx.row_text(df.columns).alias("line"))


@query
def dataset_names(spark, sf):
    file = F.concat(F.col("p_name"), F.lit(".csv"))
    return table(spark, sf, "part").select("p_partkey", tx.dataset_name(file).alias("dataset"))


# --- counts --------------------------------------------------------------


@query
def row_counts(spark, sf):
    return records.row_counts(orders(spark, sf), rules.bad_key(ORDER_KEYS))


@query
def rejected_arithmetic(spark, sf):
    lines, lookups = table(spark, sf, "lineitem"), line_lookups(spark, sf)
    flagged = flag_lookups(lines, lookups)
    return records.row_counts(flagged, ~(F.col("_ok0") & F.col("_ok1") & F.col("_ok2")))


# --- raw to stage --------------------------------------------------------


def event_spec():
    columns = ("event id", "ts", "user id", "event_type", "value", "props")
    return FeedSpec("events", "/Raw/events/*/part-*.csv", 6, "append", columns, keys=("event id",))


def raw_events(spark, sf):
    """Event files as delivered, with nation files that do not belong among them."""
    zones = Zones(scratch_path(spark, "zones"))
    events = as_text(table(spark, sf, "events").withColumn("ts", day_text("ts")))
    write_csv(events.toDF(*event_spec().columns), zones.raw("/Raw/events/good"))
    write_csv(as_text(table(spark, sf, "customer")), zones.raw("/Raw/events/other"))
    return zones


@query
def raw_to_stage(spark, sf):
    zones = raw_events(spark, sf)
    stage(spark, event_spec(), zones, "r1", CLOCK)
    staged = read_staged(spark, event_spec(), zones, "r1")
    return schema.rename(staged, {"event id": "event_id", "user id": "user_id"})


@query
def raw_to_stage_manifest(spark, sf):
    zones = raw_events(spark, sf)
    stage(spark, event_spec(), zones, "r1", CLOCK)
    again = stage(spark, event_spec(), zones, "r2", CLOCK)
    files = spark.read.parquet(zones.file_manifests).drop("run_date", "dataset", "run_id")
    return (
        files.select(*again.columns)
        .groupBy("Status", "Error_description")
        .agg(F.sum("Total_row_Count").cast("bigint").alias("total_rows"))
    )


def document_spec():
    return FeedSpec("texts", "/Raw/texts/*.csv", 3, "append", ("doc_id", "lang", "text"), keys=("doc_id",))


@query
def quoted_line_breaks(spark, sf):
    """Texts with line breaks and quotes inside quoted fields, through staging."""
    zones = Zones(scratch_path(spark, "zones"))
    texts = as_text(table(spark, sf, "documents").select(*document_spec().columns))
    texts.write.csv(
        zones.raw("/Raw/texts"),
        header=True,
        quoteAll=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    stage(spark, document_spec(), zones, "r1", CLOCK)
    return read_staged(spark, document_spec(), zones, "r1")


def restaged(spark, sf):
    """Orders and customers as two files of one feed; then the customers' file gets another header and the run is repeated."""
    zones = Zones(scratch_path(spark, "zones"))
    spec = FeedSpec("keys", "/Raw/keys/*/part-*.csv", 1, "append", ("key",), keys=("key",))
    write_csv(as_text(table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"))).coalesce(1), zones.raw("/Raw/keys/orders"))
    other = as_text(table(spark, sf, "customer").select(F.col("c_custkey").alias("key"))).coalesce(1)
    write_csv(other, zones.raw("/Raw/keys/customers"))
    stage(spark, spec, zones, "r1", CLOCK)
    write_csv(other.withColumnRenamed("key", "other"), zones.raw("/Raw/keys/customers"), mode="overwrite")
    stage(spark, spec, zones, "r1", CLOCK)
    return spec, zones


@query
def restaged_run(spark, sf):
    spec, zones = restaged(spark, sf)
    return read_staged(spark, spec, zones, "r1")


@query
def file_ledger(spark, sf):
    """Which files count as staged after a run was repeated and another one found the same files."""
    spec, zones = restaged(spark, sf)
    stage(spark, spec, zones, "r2", CLOCK)
    manifests = spark.read.parquet(zones.file_manifests)
    return manifests.groupBy("run_id", "Status", "Error_description").agg(
        F.sum("Total_row_Count").cast("bigint").alias("total_rows")
    )


@query
def empty_delivery(spark, sf):
    """The snapshot after a good run and one whose only file was refused."""
    zones, spec = Zones(scratch_path(spark, "zones")), customer_spec()
    good = customer(spark, sf)
    enrich_frame(good, spec, {spec.name: spec}, zones, "r1", CLOCK)
    write_csv(good.drop("c_name"), zones.raw("/Raw/customers"))
    stage(spark, spec, zones, "r2", CLOCK)
    enrich(spark, spec.name, {spec.name: spec}, zones, "r2", CLOCK)
    runs = spark.read.parquet(zones.run_manifests).where("run_id = 'r2'")
    # One manifest row per run.
    found = runs.select("Status", "No_Of_records_received", "No_Of_records_processed").first().asDict()
    kept = snapshot_of(spark, spec, zones).read().agg(F.count(F.lit(1)).alias("kept"))
    return kept.select("kept", *[F.lit(v).alias(n) for n, v in found.items()]).withColumns(
        {n: F.col(n).cast("bigint") for n in found if n != "Status"}
    )


@query
def header_check(spark, sf):
    zones = raw_events(spark, sf)
    files = glob_files(spark, zones.raw(event_spec().raw_glob))
    verdicts = header_verdicts(spark, event_spec(), files)
    counted = read_headed_csv(spark, [f.path for f in files]).groupBy(file_name().alias("file")).count()
    shown = [
        (n, v.valid, v.width or "", ",".join(v.missing), ",".join(v.extra), ",".join(v.misplaced))
        for n, v in verdicts.items()
    ]
    names = "file string, valid boolean, width string, missing string, extra string, misplaced string"
    return (
        spark.createDataFrame(shown, names)
        .join(counted, "file")
        .groupBy("valid", "width", "missing", "extra", "misplaced")
        .agg(F.sum("count").cast("bigint").alias("total_rows"))
    )


def order_lines(spark, sf):
    """Orders as pipe lines with stray quotes."""
    df = orders(spark, sf).withColumn("o_orderpriority", F.concat(F.lit('"'), "o_orderpriority", F.lit('"')))
    return df.select(F.concat_ws("|", *df.columns).alias("value"))


def pipe_spec():
    columns = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    return FeedSpec(
        "orders_piped", "/Raw/orders/*/part-*.txt", 6, "append", columns, piped=True, keys=("o_orderkey",)
    )


def raw_lines(spark, sf):
    zones = Zones(scratch_path(spark, "zones"))
    order_lines(spark, sf).write.text(zones.raw("/Raw/orders/good"))
    other = customer(spark, sf)
    other.select(F.concat_ws("|", *other.columns).alias("value")).write.text(zones.raw("/Raw/orders/other"))
    return zones


@query
def pipe_feed(spark, sf):
    zones = raw_lines(spark, sf)
    stage(spark, pipe_spec(), zones, "r1", CLOCK)
    return read_staged(spark, pipe_spec(), zones, "r1")


def ragged_spec():
    columns = ("o_orderkey", "o_custkey", "o_orderstatus")
    return FeedSpec("orders_ragged", "/Raw/ragged/*/part-*.csv", 3, "append", columns)


@query
def ragged_rows(spark, sf):
    """Lines that staging keeps as text because their number of fields is off."""
    zones, spec = Zones(scratch_path(spark, "zones")), ragged_spec()
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in spec.columns])
    more = F.when(F.col("o_orderstatus") == "P", F.concat(line, F.lit(",EXTRA"))).otherwise(line)
    lines = table(spark, sf, "orders").select(more.alias(",".join(spec.columns)))
    lines.write.csv(zones.raw("/Raw/ragged/in"), header=True, sep="\u0001")
    stage(spark, spec, zones, "r1", CLOCK)
    return spark.read.parquet(zones.line_records).select("Line")


@query
def piped_every_line(spark, sf):
    """A headerless file is refused when a line behind its first is off."""
    zones = Zones(scratch_path(spark, "zones"))
    lines = order_lines(spark, sf)
    lines.write.text(zones.raw("/Raw/orders/good"))
    key = F.split("value", r"\|")[0].cast("bigint")
    odd = F.when(key % 2 == 0, F.concat("value", F.lit("|EXTRA"))).otherwise(F.col("value"))
    lines.select(odd.alias("value")).write.text(zones.raw("/Raw/orders/odd"))
    files = stage(spark, pipe_spec(), zones, "r1", CLOCK)
    return files.groupBy("Status").agg(F.sum("Total_row_Count").cast("bigint").alias("total_rows"))


@query
def pipe_line_widths(spark, sf):
    zones = raw_lines(spark, sf)
    files = [f.path for f in glob_files(spark, zones.raw(pipe_spec().raw_glob))]
    per_file = narrow_lines(read_lines(spark, files), pipe_spec().width)
    return per_file.agg(
        F.sum("rows").cast("bigint").alias("total_rows"), F.sum("off").cast("bigint").alias("off_rows")
    )


@query
def text_line_sink(spark, sf):
    path = scratch_path(spark, "lines")
    write_lines(order_lines(spark, sf), path)
    return read_piped(spark, path, pipe_spec().columns)


@query
def nested_file_scan(spark, sf):
    path = scratch_path(spark, "nested")
    df = as_text(table(spark, sf, "part"))
    df.write.partitionBy("p_brand", "p_type").csv(path, sep="|")
    names = [c for c in df.columns if c not in ("p_brand", "p_type")]
    return read_piped(spark, path, names, nested=True)


# --- whole runs ----------------------------------------------------------


def customer_spec():
    return FeedSpec(
        "customers",
        "/Raw/customers/part-*.csv",
        5,
        "upsert",
        ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
        before=(without("c_name", "#"),),
        keys=("c_custkey", "c_mktsegment"),
        after=(("c_mktsegment", F.lower), pad("c_nationkey", 3)),
        unique=("c_custkey",),
    )


def customer_deliveries(spark, sf):
    """All customers; then changed balances of one nation, one segment sent twice."""
    first = customer(spark, sf)
    changed = as_text(_raised_balances(spark, sf))
    twice = changed.where("c_mktsegment = 'BUILDING'").withColumn("c_acctbal", F.lit("0"))
    return first, changed.unionByName(twice)


def run_customers(spark, sf):
    spec, zones = customer_spec(), Zones(scratch_path(spark, "zones"))
    for i, delivery in enumerate(customer_deliveries(spark, sf)):
        enrich_frame(delivery, spec, {spec.name: spec}, zones, f"r{i}", CLOCK)
    return spec, zones


@query
def master_run(spark, sf):
    spec, zones = run_customers(spark, sf)
    return snapshot_of(spark, spec, zones).read()


@query
def master_run_errors(spark, sf):
    _, zones = run_customers(spark, sf)
    return spark.read.parquet(zones.error_records).select(*records.ERROR_COLUMNS[:3])


@query
def run_manifests(spark, sf):
    _, zones = run_customers(spark, sf)
    return spark.read.parquet(zones.run_manifests).select(
        "Data_Set_Name", "Status", "No_Of_records_received", "No_Of_records_rejected", "No_Of_records_processed"
    )


def line_spec():
    return FeedSpec(
        "lines",
        "/Raw/lines/part-*.csv",
        8,
        "range",
        ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"),
        before=dates(DASHED, "l_shipdate"),
        keys=("l_orderkey", "l_partkey", "l_shipdate"),
        date_keys=("l_shipdate",),
        lookups=(
            LookupSpec("l_partkey", "parts", "p_partkey"),
            LookupSpec("l_suppkey", "suppliers", "s_suppkey"),
            LookupSpec("l_orderkey", "placed_orders", "o_orderkey"),
        ),
        range_date="l_shipdate",
    )


def returned_lines(spark, sf):
    """Lines returned since 2001 with their quantity taken to zero; open ones carry a broken date."""
    broken = F.expr("case when l_linestatus = 'O' then replace(l_shipdate, '-0', '-9') else l_shipdate end")
    return (
        monthly_lines(spark, sf)
        .where("l_returnflag = 'R' and l_shipdate >= '2001-01-01'")
        .withColumns({"l_quantity": F.lit("0"), "l_shipdate": broken})
        .select(*line_spec().columns)
    )


def past_lines(spark, sf):
    return monthly_lines(spark, sf, "MM/dd/yyyy").select(*line_spec().columns)


def judged_lines(spark, sf):
    lookups = line_lookups(spark, sf)
    return settle_judged(judge(returned_lines(spark, sf), line_spec(), lookups), line_spec()), lookups


@query
def fact_run(spark, sf):
    """What the line snapshot contains after a restating delivery."""
    spec = line_spec()
    found, lookups = judged_lines(spark, sf)
    clean = clean_rows(found.frame, spec, lookups)
    bounds = found.metrics["first_day"], found.metrics["last_day"]
    # No two past lines are equal, as in a snapshot, which holds each row once: history needs no distinct.
    return merge.replace_range(past_lines(spark, sf), clean, spec.day(), bounds=bounds, distinct=False)


@query
def fact_run_errors(spark, sf):
    found, lookups = judged_lines(spark, sf)
    return without_time(judged_errors(found.frame, line_spec(), lookups))


def run_lines(spark, sf):
    """Masters, history and the restating delivery, all through their folders."""
    zones = Zones(scratch_path(spark, "zones"))
    spec = line_spec()

    def master(name, df, key):
        columns = tuple(df.columns)
        made = FeedSpec(name, f"/Raw/{name}/*", len(columns), "upsert", columns, keys=(key,), unique=(key,))
        enrich_frame(df, made, {name: made}, zones, "r0", CLOCK)
        return made

    lookups = line_lookups(spark, sf)
    names = [s.dataset for s in spec.lookups]
    specs = {n: master(n, as_text(lk.master), lk.key) for n, lk in zip(names, lookups)}
    snapshot_of(spark, spec, zones).replace(past_lines(spark, sf))
    delivery = returned_lines(spark, sf)
    write_csv(delivery, zones.raw("/Raw/lines"))
    stage(spark, spec, zones, "r1", CLOCK)
    specs[spec.name] = spec
    enrich(spark, spec.name, specs, zones, "r1", CLOCK)
    return specs, zones


@query
def fact_run_in_folders(spark, sf):
    specs, zones = run_lines(spark, sf)
    return snapshot_of(spark, specs["lines"], zones).read()


@query
def fact_run_increment(spark, sf):
    specs, zones = run_lines(spark, sf)
    return spark.read.parquet(zones.increments("lines")).select(*specs["lines"].columns)


@query
def fact_run_coverage(spark, sf):
    specs, zones = run_lines(spark, sf)
    return report_coverage(spark, "lines_weeks", {"lines_weeks": ("lines", "l_shipdate")}, specs, zones, CLOCK)


@query
def snapshot_restatement(spark, sf):
    """A date-partitioned table, restated partition by partition."""
    day = merge.feed_day("o_orderdate")
    names = table(spark, sf, "orders").columns
    snapshot = Snapshot(spark, scratch_path(spark, "snapshot"), names, day)
    snapshot.replace(monthly_orders(spark, sf, "MM/dd/yyyy"))
    # The month between the two is not delivered, so the restatement drops it.
    months = [dt.date(2001, 4, 30), dt.date(2001, 6, 30)]
    late = monthly_orders(spark, sf, "MM/dd/yyyy").where(day.isin(months) & (F.col("o_orderstatus") == "F"))
    snapshot.replace_dates(late, *merge.date_bounds(late, day))
    return snapshot.read()


@query
def upsert_in_buckets(spark, sf):
    """Customers dealt to buckets by key; the balances of one nation are raised in place."""
    names = customer(spark, sf).columns
    snapshot = Snapshot(spark, scratch_path(spark, "snapshot"), names, keys=["c_custkey"], bucket_rows=50)
    first = customer(spark, sf)
    snapshot.upsert(first, first.count())
    raised = as_text(_raised_balances(spark, sf))
    snapshot.upsert(raised, raised.count())
    return snapshot.read()


@query
def append_by_fingerprint(spark, sf):
    """Urgent orders, then all orders: appending adds what is not there yet."""
    everything = orders(spark, sf)
    snapshot = Snapshot(spark, scratch_path(spark, "snapshot"), everything.columns, hashed=True, bucket_rows=500)
    urgent = everything.where("o_orderpriority = '1-URGENT'")
    snapshot.append_new(urgent, urgent.count())
    snapshot.append_new(everything.unionByName(urgent), 2 * everything.count())
    return snapshot.read()


@query
def compacted_appends(spark, sf):
    """Orders appended by priority, then compacted: rows and files of each month."""
    everything = monthly_orders(spark, sf, "MM/dd/yyyy")
    snapshot = Snapshot(spark, scratch_path(spark, "snapshot"), everything.columns, merge.feed_day("o_orderdate"))
    for priority in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"):
        snapshot.append(everything.where(F.col("o_orderpriority") == priority))
    snapshot.compact()
    files = snapshot.read().groupBy("o_orderdate", F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    return files.groupBy("o_orderdate").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"))


@query
def increment_sink(spark, sf):
    path = write_increment(_late_orders(spark, sf), scratch_path(spark, "increments"), "r1")
    return spark.read.parquet(path)


@query
def per_file_sink(spark, sf):
    path = scratch_path(spark, "files")
    write_per_file(merge_per_file(spark, sf), path)
    written = spark.read.parquet(path)
    return written.select(F.col("file").cast("string").alias("file"), "user_id", "props")


# --- loads of several feeds -------------------------------------------------


def keyed_feed(name, columns, key, *lookups, **more):
    return FeedSpec(name, f"/Raw/{name}/*", len(columns), "upsert", tuple(columns), keys=(key,), unique=(key,), lookups=lookups, **more)


def load_feeds(spark, sf):
    """Six feeds in three levels; the parts name a key they do not have, so parts fail and lines wait."""
    tables = {n: as_text(table(spark, sf, n)) for n in ("region", "nation", "supplier", "part", "customer", "orders")}
    columns = {n: df.columns for n, df in tables.items()}
    specs = [
        keyed_feed("region", columns["region"], "r_regionkey"),
        keyed_feed("nation", columns["nation"], "n_nationkey", LookupSpec("n_regionkey", "region", "r_regionkey")),
        keyed_feed("supplier", columns["supplier"], "s_suppkey", LookupSpec("s_nationkey", "nation", "n_nationkey")),
        keyed_feed("customer", columns["customer"], "c_custkey", LookupSpec("c_nationkey", "nation", "n_nationkey")),
        keyed_feed("part", columns["part"], "p_missing"),
        keyed_feed("orders", columns["orders"], "o_orderkey", LookupSpec("o_custkey", "part", "p_partkey")),
    ]
    return tables, {s.name: s for s in specs}


@query
def load_order_run(spark, sf):
    tables, specs = load_feeds(spark, sf)
    zones = Zones(scratch_path(spark, "zones"))
    step = lambda name: enrich_frame(tables[name], specs[name], specs, zones, "r1", CLOCK)
    report = load(spark, specs, zones, "r1", CLOCK, step)
    return report.select("Data_Set_Name", "Level", "Status", "Received", "Processed")


# --- feeds of the catalog --------------------------------------------------


def feed_rows(df, dataset: str, **values: str):
    """The columns of a catalog feed as text: ``values`` are SQL expressions, other columns are null."""
    columns = catalog.feeds()[dataset].columns
    return df.select(*[F.expr(values.get(c, "null")).cast("string").alias(c) for c in columns])


def run_feeds(spark, deliveries):
    """Enrich deliveries of catalog feeds one after the other; the zones that hold the results."""
    zones = Zones(scratch_path(spark, "zones"))
    for dataset, df in deliveries.items():
        enrich_frame(df, catalog.feeds()[dataset], catalog.feeds(), zones, "r1", CLOCK)
    return zones


def kept_feed(spark, zones, dataset: str):
    return snapshot_of(spark, catalog.feeds()[dataset], zones).read()


def error_counts(spark, zones, dataset: str):
    name = catalog.feeds()[dataset].output_name
    errors = spark.read.parquet(zones.error_records).where(F.col("dataset") == name)
    return errors.groupBy("Error_Description").agg(F.count(F.lit(1)).alias("n"))


def product_rows(spark, sf):
    """Parts as products: size 1 without a number, all of size 2 under one number."""
    key = "case when p_size = 2 then 'P2' when p_size > 2 then cast(p_partkey as string) end"
    return feed_rows(table(spark, sf, "part"), "TargetPOS_Product", ProductNbr=key, ProductName="p_name", UPC="p_partkey")


def location_rows(spark, sf):
    known = table(spark, sf, "supplier").where("s_nationkey > 3")
    return feed_rows(known, "TargetPOS_Location", LocationNbr="s_suppkey", LocationName="s_name")


def sales_rows(spark, sf):
    """Lines as sales by month; returned ones lack their store."""
    return feed_rows(
        table(spark, sf, "lineitem"),
        "TargetPOS_Sales",
        TransWeek="date_format(date_trunc('month', l_shipdate), 'yyyy-MM-dd')",
        LocationNbr="case when l_returnflag <> 'R' then l_suppkey end",
        ProductNbr="l_partkey",
        TotalSales="l_orderkey",
        TotalUnits="l_linenumber",
    )


def sales_run(spark, sf):
    masters = {"TargetPOS_Product": product_rows(spark, sf), "TargetPOS_Location": location_rows(spark, sf)}
    return run_feeds(spark, masters | {"TargetPOS_Sales": sales_rows(spark, sf)})


@query
def catalog_weather(spark, sf):
    """An append-distinct feed with a needed date."""
    day = "case when o_orderpriority <> '1-URGENT' then date_format(o_orderdate, 'yyyy-MM-dd') end"
    rows = feed_rows(table(spark, sf, "orders"), "Weather", zip="o_custkey", date=day, rh="o_orderstatus")
    return kept_feed(spark, run_feeds(spark, {"Weather": rows}), "Weather").select("zip", "date", "rh")


@query
def catalog_product(spark, sf):
    """A master with a needed, unique number."""
    zones = run_feeds(spark, {"TargetPOS_Product": product_rows(spark, sf)})
    return kept_feed(spark, zones, "TargetPOS_Product").select("ProductNbr", "ProductName")


@query
def catalog_product_errors(spark, sf):
    zones = run_feeds(spark, {"TargetPOS_Product": product_rows(spark, sf)})
    return error_counts(spark, zones, "TargetPOS_Product")


@query
def catalog_sales(spark, sf):
    """A weekly fact with both its masters."""
    kept = kept_feed(spark, sales_run(spark, sf), "TargetPOS_Sales")
    return kept.select("TotalSales", "TotalUnits", "LocationNbr", "ProductNbr")


@query
def catalog_sales_errors(spark, sf):
    return error_counts(spark, sales_run(spark, sf), "TargetPOS_Sales")


# --- feeds of the catalog, from raw files ------------------------------------


def deliver_raw(spark, zones, spec, df):
    """``df`` as raw files whose names fit the feed's pattern, headed or piped as the feed is."""
    folder = scratch_path(spark, "delivery")
    df.select(*[F.col(tx.quoted(c)) for c in spec.columns]).write.csv(
        folder, header=not spec.piped, sep="|" if spec.piped else ",", escape='"', emptyValue=""
    )
    for i, name in enumerate(n for n in list_names(spark, folder) if n.startswith("part-")):
        move_file(spark, f"{folder}/{name}", zones.raw(spec.raw_glob.replace("*", f"_{i}")))


def run_raw(spark, deliveries):
    """Deliver, stage and enrich feeds of the catalog, masters first; the zones that hold the results."""
    zones, specs = Zones(scratch_path(spark, "zones")), catalog.feeds()
    for dataset, df in deliveries.items():
        deliver_raw(spark, zones, specs[dataset], df)
    report = load(spark, {n: specs[n] for n in deliveries}, zones, "r1", CLOCK)
    if report.where("Status <> 'Processed'").count():
        raise ValueError(f"not all of {list(deliveries)} were loaded")
    return zones


def inventory_run(spark, sf):
    rows = sales_rows(spark, sf).withColumnsRenamed({"TotalSales": "EOHSales", "TotalUnits": "EOHUnits"})
    lines = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in catalog.INVENTORY_COLUMNS])
    masters = {"TargetPOS_Product": product_rows(spark, sf), "TargetPOS_Location": location_rows(spark, sf)}
    return run_raw(spark, masters | {"TargetPOS_Inventory": lines})


@query
def raw_inventory(spark, sf):
    """A weekly fact and its masters, from raw files to the snapshot."""
    kept = kept_feed(spark, inventory_run(spark, sf), "TargetPOS_Inventory")
    return kept.select("EOHSales", "EOHUnits", "LocationNbr", "ProductNbr")


@query
def raw_inventory_errors(spark, sf):
    return error_counts(spark, inventory_run(spark, sf), "TargetPOS_Inventory")


def basket_run(spark, sf):
    """Lines as basket rows: guests of some nations, items above a size and stores of some nations are known."""
    guests = table(spark, sf, "customer").where("c_nationkey > 3")
    stores = table(spark, sf, "supplier")
    items = table(spark, sf, "part").where("p_size > 10")
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    store, area = "l_suppkey + 1", "l_suppkey + 1000001"
    return run_raw(
        spark,
        {
            "GST_DEMOS": feed_rows(guests, "GST_DEMOS", GST_REF_I="c_custkey + 1", ST_C="c_mktsegment"),
            "STR_CNCPT": feed_rows(stores.where("s_nationkey > 2"), "STR_CNCPT", CO_LOC_I="s_suppkey + 1", CO_LOC_REF_I="s_suppkey + 1000001"),
            "STR_CURR": feed_rows(stores.where("s_nationkey < 20"), "STR_CURR", SITE_SEQ_I="s_suppkey + 1", STR_I="s_suppkey + 1000001"),
            "ITEM_HIER": feed_rows(items, "ITEM_HIER", MDSE_ITEM_I="p_partkey + 1", MDSE_ITEM_REF_I="concat('R', p_partkey)"),
            "Target_GRM": feed_rows(
                lines,
                "Target_GRM",
                GST_REF_I="case when l_returnflag <> 'R' then o_custkey + 1 end",
                SLS_D="date_format(date_trunc('month', o_orderdate), 'yyyy-MM-dd')",
                RGTN_I="l_orderkey",
                LITM_ENTR_SEQ_I="l_linenumber",
                MDSE_ITEM_I="l_partkey + 1",
                MDSE_ITEM_REF_I="concat('R', l_partkey)",
                CO_LOC_I=store,
                CO_LOC_REF_I=area,
            ),
        },
    )


@query
def raw_basket(spark, sf):
    """A piped fact with seven lookups in four piped masters."""
    kept = kept_feed(spark, basket_run(spark, sf), "Target_GRM")
    return kept.select("RGTN_I", "LITM_ENTR_SEQ_I", "GST_REF_I", "MDSE_ITEM_I", "CO_LOC_I", "SLS_D")


@query
def raw_basket_errors(spark, sf):
    return error_counts(spark, basket_run(spark, sf), "Target_GRM")


def tree_run(spark, sf):
    """Parts as an assortment tree whose dashed codes are padded to meet the product master."""
    parts = table(spark, sf, "part")
    products = feed_rows(parts.where("p_size > 10"), "TargetPOS_Product", ProductNbr="lpad(p_partkey + 1, 9, '0')", ProductName="p_name")
    code = "case when p_size <> 50 then concat('0-', p_partkey + 1) end"
    rows = feed_rows(parts, "TargetCDT_Tea", DPCI=code, Form="p_type", **{"Brand Name": "p_brand"})
    return run_raw(spark, {"TargetPOS_Product": products, "TargetCDT_Tea": rows.unionByName(rows)})


@query
def raw_assortment_tree(spark, sf):
    """An append-distinct feed with a cleaned key and one lookup; each row is delivered twice."""
    return kept_feed(spark, tree_run(spark, sf), "TargetCDT_Tea").select("DPCI", F.col("Brand Name").alias("brand"), "Form")


@query
def raw_assortment_tree_errors(spark, sf):
    return error_counts(spark, tree_run(spark, sf), "TargetCDT_Tea")


def price_rows(spark, sf):
    return feed_rows(
        table(spark, sf, "orders"),
        "PriceList",
        UNIT_UPC="case when o_orderstatus <> 'P' then o_orderkey end",
        Material_status_date="date_format(o_orderdate, 'yyyyMMdd')",
        GTIN="o_custkey",
    )


@query
def raw_price_list(spark, sf):
    """An append-distinct feed with packed dates and a padded code."""
    return kept_feed(spark, run_raw(spark, {"PriceList": price_rows(spark, sf)}), "PriceList").select(
        "UNIT_UPC", "Material_status_date", "GTIN"
    )


def event_ppg_run(spark, sf):
    """Order rows as promotion events; groups are known for some priorities."""
    known = feed_rows(
        table(spark, sf, "orders").select("o_orderpriority").distinct().where("o_orderpriority < '4'"),
        "PEA_PPG_Mapping",
        PEA_PPG="o_orderpriority",
        Nielsen="o_orderpriority",
    )
    events = feed_rows(
        table(spark, sf, "orders"),
        "PEA",
        Retailer="case when o_orderstatus <> 'P' then o_orderstatus end",
        PPG="o_orderpriority",
        AMPS_Event_Start_Date="date_format(o_orderdate, 'yyyy-MM-dd')",
    )
    return run_raw(spark, {"PEA_PPG_Mapping": known, "PEA": events})


@query
def raw_promotion_events(spark, sf):
    """An append-distinct feed with five dates and a mapping; equal events become one."""
    return kept_feed(spark, event_ppg_run(spark, sf), "PEA").select("Retailer", "PPG", "AMPS_Event_Start_Date")


@query
def raw_promotion_errors(spark, sf):
    return error_counts(spark, event_ppg_run(spark, sf), "PEA")
