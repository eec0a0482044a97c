"""Stage to enriched: check, look up, merge, report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedwright.functions.dates import RunClock
from feedwright.functions.text import dataset_name, quoted, row_text
from feedwright.limits import DEFAULT_LIMITS, Limits
from feedwright.operators.coverage import missing_weeks, unreadable_count
from feedwright.operators.lookups import Lookup, all_hold, failed_labels, failing_rows, flag_lookups, with_spelling
from feedwright.operators.merge import per_file, upsert
from feedwright.operators.records import (
    BAD_KEY,
    DUPLICATE,
    FACT_LOOKUP,
    FAILED,
    LOOKUP,
    PROCESSED,
    error_records,
    run_manifest,
)
from feedwright.operators.schema import cols, text_schema
from feedwright.operators.setops import union_all
from feedwright.operators.sizing import Settled, settle
from feedwright.operators.unique import flag_repeated
from feedwright.plans.spec import FeedSpec, apply_steps
from feedwright.plans.staging import read_staged, was_staged
from feedwright.plans.zones import Zones
from feedwright.session import scratch_run
from feedwright.sources.files import exists
from feedwright.sources.sinks import write_errors, write_increment, write_manifest, write_per_file
from feedwright.sources.snapshot import Snapshot


@dataclass(frozen=True)
class RunResult:
    dataset: str
    status: str
    received: int
    processed: int
    rejected: int
    first_day: dt.date | None
    last_day: dt.date | None


def bind_lookups(spec: FeedSpec, masters: Mapping[str, DataFrame]) -> list[Lookup]:
    return [
        Lookup(s.column, masters[s.dataset], s.key, s.label, s.ignore_case, s.ignore_case)
        for s in spec.lookups
    ]


def judge(
    df: DataFrame, spec: FeedSpec, lookups: list[Lookup], limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """The conformed feed with one flag per check and ``_clean`` for rows that pass all.

    Nothing is dropped and nothing is tested twice: clean rows, error records
    and counts all come from this frame.
    """
    df = apply_steps(df, spec.before)
    df = df.withColumns({"_bad": spec.bad(), "_go": spec.passes()})
    df = apply_steps(df, spec.after, where=F.col("_go"))
    if spec.unique:
        df = flag_repeated(df, spec.unique, rows=F.col("_go"), limits=limits)
    else:
        df = df.withColumn("_repeated", F.lit(False))
    df = flag_lookups(df, lookups, limits)
    return df.withColumn("_clean", F.col("_go") & ~F.col("_repeated") & all_hold(len(lookups)))


def clean_rows(judged: DataFrame, spec: FeedSpec, lookups: list[Lookup], *extra: str) -> DataFrame:
    kept = with_spelling(judged.where("_clean"), lookups)
    return kept.select(*cols([*spec.row_columns, *extra]))


def judged_errors(
    judged: DataFrame, spec: FeedSpec, lookups: list[Lookup], limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """Error records of every check.

    Bad and repeated keys report each row; failed lookups report each distinct
    row, once per lookup for facts and once in all for masters and mappings.
    """
    rejected = judged if spec.key_rule == "any" else judged.where("not _clean")
    reason = F.when(F.col("_bad"), F.lit(BAD_KEY.format(spec.key_names))).otherwise(
        F.lit(DUPLICATE.format(",".join(spec.unique)))
    )
    by_file = spec.merge == "file"
    dataset = dataset_name("file") if by_file else spec.output_name
    carried = [*spec.row_columns, "file"] if by_file else spec.row_columns
    own = rejected.where("_bad or _repeated")
    if spec.distinct_dups:
        own = own.where("_bad").unionByName(own.where("not _bad").dropDuplicates(carried))
    records = error_records(own, dataset, reason, spec.row_columns)
    if lookups:
        tested = rejected.where("_go and not _repeated")
        # Distinct by their columns, as the flags follow from these.
        failed = failing_rows(tested, lookups, carried, limits)
        text, columns = F.lit(LOOKUP.format(spec.lookup_text)), spec.row_columns
        if spec.is_fact:
            # The text of a row is made once, not again for each lookup that fails.
            rows = failed.select(row_text(cols(columns)).alias("_row"), failed_labels(lookups).alias("_labels"))
            failed = rows.select("_row", F.explode("_labels").alias("_failed"))
            text, columns = F.concat(F.lit(FACT_LOOKUP.format("")), F.col("_failed")), ["_row"]
        records = union_all(records, error_records(failed, dataset, text, columns))
    return records.distinct() if spec.distinct_errors else records


def settle_judged(judged: DataFrame, spec: FeedSpec) -> Settled:
    """Write the judged rows once; counts and date bounds come along.

    Clean and rejected rows lie in separate folders, so each later step reads
    only its own.
    """
    clean = F.col("_clean")
    metrics = {"processed": F.count_if(clean)}
    if spec.is_fact:
        # Read once: the counts beside a write evaluate each use of an expression anew.
        judged = judged.withColumn("_day", spec.day())
        day = F.when(clean, F.col("_day"))
        metrics |= {"first_day": F.min(day), "last_day": F.max(day)}
    return settle(judged, "judged", metrics, partition_by=["_clean"])


def snapshot_of(spark: SparkSession, spec: FeedSpec, zones: Zones) -> Snapshot:
    """Facts lie by date, masters by buckets of their keys, appended feeds by buckets of their rows."""
    day = spec.day() if spec.is_fact else None
    # A master whose whole history is conformed again in each run is rewritten as a whole anyway.
    keys = spec.unique if spec.merge == "upsert" and not spec.conform_history else ()
    return Snapshot(spark, zones.snapshot(spec.name), spec.columns, day, keys, hashed=spec.merge == "append")


def read_masters(spark: SparkSession, spec: FeedSpec, specs: Mapping[str, FeedSpec], zones: Zones) -> dict:
    return {s.dataset: snapshot_of(spark, specs[s.dataset], zones).read() for s in spec.lookups}


def merge_clean(
    clean: DataFrame, spec: FeedSpec, snapshot: Snapshot, found: Settled, limits: Limits = DEFAULT_LIMITS
) -> None:
    processed = found.metrics["processed"]
    if spec.merge == "append":
        snapshot.append_new(clean, processed, limits)
    elif spec.merge == "upsert" and snapshot.keys:
        snapshot.upsert(clean, processed, limits)
    elif spec.merge == "upsert":
        history = apply_steps(snapshot.read(), spec.after).distinct() if spec.conform_history else snapshot.read()
        # History was written by this very step and the clean keys are unique.
        snapshot.replace(upsert(history, clean, spec.unique, distinct=False, limits=limits))
    elif spec.merge == "range":
        snapshot.replace_dates(clean, found.metrics["first_day"], found.metrics["last_day"])
    else:
        raise ValueError(f"{spec.name} is not merged into a snapshot")
    snapshot.tidy()


def _record_failure(spark: SparkSession, spec: FeedSpec, zones: Zones, clock: RunClock, run_id: str) -> None:
    manifest = run_manifest(
        spark, spec.output_name, FAILED, None, None, clock.timestamp, RunClock().timestamp
    )
    write_manifest(manifest, zones.run_manifests, clock.day, spec.output_name, run_id)


def file_run_manifest(judged: DataFrame, written: DataFrame, started: str, ended: str) -> DataFrame:
    """One manifest row per delivered file; processed counts its distinct rows."""
    received = judged.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    # As many rows as files were listed for staging; only their folders are counted.
    delivered = F.broadcast(received.select("file"))
    kept = (
        written.withColumn("file", F.col("file").cast("string"))
        .join(delivered, "file", "left_semi")
        .groupBy(F.col("file").alias("kept_file"))
        .agg(F.count(F.lit(1)).alias("m"))
    )
    processed = F.coalesce(F.col("m"), F.lit(0))
    return received.join(kept, F.col("file") == F.col("kept_file"), "left").select(
        dataset_name("file").alias("Data_Set_Name"),
        F.lit(PROCESSED).alias("Status"),
        F.col("n").alias("No_Of_records_received"),
        (F.col("n") - processed).alias("No_Of_records_rejected"),
        processed.alias("No_Of_records_processed"),
        F.lit(started).alias("Start_Time"),
        F.lit(ended).alias("EndTime"),
    )


def enrich_frame(
    df: DataFrame,
    spec: FeedSpec,
    specs: Mapping[str, FeedSpec],
    zones: Zones,
    run_id: str,
    clock: RunClock | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> RunResult:
    """Bring one delivery of a feed into its snapshot.

    The delivery passes all checks in one job that writes the judged rows;
    increment, snapshot and errors start from those. Every step can be run
    again with the same ``run_id`` and gives the same tables.
    """
    spec.check_columns()
    spark = df.sparkSession
    clock = clock or RunClock()
    try:
        with scratch_run(spark):
            return _enrich(df, spec, specs, zones, run_id, clock, limits)
    except Exception:
        _record_failure(spark, spec, zones, clock, run_id)
        raise


def _enrich(df, spec, specs, zones, run_id, clock, limits) -> RunResult:
    spark = df.sparkSession
    lookups = bind_lookups(spec, read_masters(spark, spec, specs, zones))
    found = settle_judged(judge(df, spec, lookups, limits), spec)
    clean = clean_rows(found.frame, spec, lookups, *(["file"] if spec.merge == "file" else []))
    if spec.merge == "file":
        write_per_file(per_file(clean), zones.per_file(spec.name))
    else:
        write_increment(clean, zones.increments(spec.name), run_id)
        merge_clean(clean, spec, snapshot_of(spark, spec, zones), found, limits)
    errors = judged_errors(found.frame, spec, lookups, limits)
    write_errors(errors, zones.error_records, clock.day, spec.output_name, run_id)
    received, processed = found.rows, found.metrics["processed"]
    started, ended = clock.timestamp, RunClock().timestamp
    if spec.merge == "file":
        written = spark.read.parquet(zones.per_file(spec.name))
        manifest = file_run_manifest(found.frame, written, started, ended)
    else:
        manifest = run_manifest(spark, spec.output_name, PROCESSED, received, processed, started, ended)
    write_manifest(manifest, zones.run_manifests, clock.day, spec.output_name, run_id)
    first_day, last_day = found.metrics.get("first_day"), found.metrics.get("last_day")
    return RunResult(spec.name, PROCESSED, received, processed, received - processed, first_day, last_day)


def enrich(
    spark: SparkSession,
    dataset: str,
    specs: Mapping[str, FeedSpec],
    zones: Zones,
    run_id: str,
    clock: RunClock | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> RunResult:
    """Bring the staged files of one run into their dataset's snapshot.

    A run that staged no file is an empty delivery: it leaves a manifest with
    zeros and the snapshot alone. A run that was never staged is a failure.
    """
    spec = specs[dataset]
    spec.check_columns()
    clock = clock or RunClock()
    try:
        if was_staged(spark, spec, zones, run_id) and not exists(spark, zones.staged_run(spec.name, run_id)):
            manifest = run_manifest(spark, spec.output_name, PROCESSED, 0, 0, clock.timestamp, RunClock().timestamp)
            write_manifest(manifest, zones.run_manifests, clock.day, spec.output_name, run_id)
            return RunResult(spec.name, PROCESSED, 0, 0, 0, None, None)
        staged = read_staged(spark, spec, zones, run_id)
    except Exception:
        _record_failure(spark, spec, zones, clock, run_id)
        raise
    return enrich_frame(staged, spec, specs, zones, run_id, clock, limits)


def committed_dates(snapshot: Snapshot, date_col: str) -> tuple[DataFrame, int, int]:
    """The dates of a dated snapshot, its rows, and its rows without a readable date, all from the commit log."""
    found = snapshot.partition_rows()
    days = [(dt.date.fromisoformat(p).strftime("%m/%d/%Y"),) for p, n in found.items() if p is not None and n]
    frame = snapshot.spark.createDataFrame(days, text_schema([date_col]))
    return frame, sum(found.values()), found.get(None, 0)


def report_coverage(
    spark: SparkSession,
    report: str,
    reports: Mapping[str, tuple[str, str]],
    specs: Mapping[str, FeedSpec],
    zones: Zones,
    clock: RunClock | None = None,
) -> DataFrame:
    """Write the missing-week report of a snapshot and return it.

    A report on the date that its table is partitioned by reads no data file.
    """
    clock = clock or RunClock()
    dataset, date_col = reports[report]
    spec = specs[dataset]
    snapshot = snapshot_of(spark, spec, zones)
    if spec.is_fact and date_col == spec.range_date:
        dated, rows, unreadable = committed_dates(snapshot, date_col)
    else:
        dated = snapshot.read().select(quoted(date_col))
        counted = dated.agg(F.count(F.lit(1)).alias("rows"), unreadable_count(date_col).alias("unreadable")).first()
        rows, unreadable = counted["rows"], counted["unreadable"]
    path = f"{zones.coverage(report)}/run_date={clock.day}"
    weeks = missing_weeks(dated, date_col, clock.date, spec.output_name)
    weeks.write.mode("overwrite").parquet(path)
    written = spark.read.schema(weeks.schema).parquet(path)
    manifest = run_manifest(
        spark, spec.output_name, PROCESSED, rows, written.count(), clock.timestamp, RunClock().timestamp
    ).withColumn("No_Of_records_rejected", F.lit(unreadable).cast("bigint"))
    write_manifest(manifest, zones.run_manifests, clock.day, report, clock.day)
    return written
