"""Raw to stage: accept whole files by their header, then clean their text."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedwright.functions.dates import RunClock
from feedwright.functions.text import quoted, strip_line_quotes, strip_quotes
from feedwright.operators.records import (
    BAD_SCHEMA,
    CHANGED,
    FAILED,
    FILE_MANIFEST,
    NO_FILE,
    NO_REMARK,
    NOT_PLACED,
    PROCESSED,
    RAGGED,
    REJECTED,
)
from feedwright.operators.schema import (
    HeaderVerdict,
    check_header,
    field_count,
    normalise_names,
    rebind,
    text_schema,
)
from feedwright.operators.setops import union_all
from feedwright.plans.spec import FeedSpec
from feedwright.plans.zones import Zones
from feedwright.session import keep_folders_open, scratch_path, scratch_run
from feedwright.sources.files import File, delete_folder, exists, glob_files
from feedwright.sources.readers import file_name, read_lines, read_piped, read_typed_csv
from feedwright.sources.record_scan import parsed, quote_parity, read_records
from feedwright.sources.sinks import run_path, write_errors, write_manifest
from feedwright.sources.snapshot import Snapshot


def _with_place(lines: DataFrame) -> DataFrame:
    """Lines with their ``file`` and a ``place`` that orders the lines of one file."""
    place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    return lines.select("value", file_name().alias("file"), place.alias("place"))


def header_verdicts(spark: SparkSession, spec: FeedSpec, files: Sequence[File]) -> dict[str, HeaderVerdict]:
    """Verdict per file name, from one scan that finds the first filled line of every file."""
    lines = _with_place(read_lines(spark, [f.path for f in files])).where(F.trim("value") != "")
    first = lines.groupBy("file").agg(F.min_by("value", "place").alias("line"))
    found = {r["file"]: next(csv.reader([r["line"]]), []) for r in first.collect()}
    return {f.name: check_header(spec.columns, found.get(f.name, [])) for f in files}


def narrow_lines(lines: DataFrame, width: int) -> DataFrame:
    """Per file, how many lines there are, how many do not have ``width`` fields, and whether the first has."""
    fields = field_count("value")
    return _with_place(lines).groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(fields != width).alias("off"),
        (F.min_by(fields, "place") == width).alias("first_fits"),
    )


def comma_fields(line: Column | str) -> Column:
    """Fields of a comma line; commas inside quotes do not count."""
    line = F.col(line) if isinstance(line, str) else line
    # Every other stretch between quotes is quoted; a doubled quote leaves an empty stretch outside.
    outside = F.filter(F.split(line, '"'), lambda part, i: i % 2 == 0)
    return field_count(F.when(F.contains(line, F.lit('"')), F.array_join(outside, "")).otherwise(line), ",")


def ragged_lines(spark: SparkSession, paths: Sequence[str], width: int) -> DataFrame:
    """FileName and Line of every line of headed files that has too few or too many fields."""
    lines = read_lines(spark, paths).where(F.trim("value") != "").select("value", file_name().alias("FileName"))
    return lines.where(comma_fields("value") != width).select("FileName", F.col("value").alias("Line"))


@dataclass(frozen=True)
class Scanned:
    """What one pass over the text says of a file."""

    rows: int
    first_line: str
    #: Lines without the declared number of fields, and whether the first has it.
    off: int
    first_fits: bool
    #: Lines with an odd number of quotes: a quoted field may hold a line break.
    broken: int
    digest: str


def scan_files(spark: SparkSession, spec: FeedSpec, files: Sequence[File]) -> dict[str, Scanned]:
    """Every file by its path, in one scan: header, lines, odd lines, and a digest of all lines in any order."""
    lines = read_lines(spark, [f.path for f in files]).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"),
    )
    if not spec.piped:
        lines = lines.where(F.trim("value") != "")
    fields = field_count("value") if spec.piped else comma_fields("value")
    hashed = F.xxhash64("value")
    sums = [F.bit_xor(hashed), F.sum(F.shiftright(hashed, 32)), F.sum(hashed.bitwiseAND(0xFFFFFFFF))]
    found = lines.groupBy("path").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min_by("value", "place").alias("first_line"),
        F.count_if(fields != spec.width).alias("off"),
        (F.min_by(fields, "place") == spec.width).alias("first_fits"),
        (F.lit(0) if spec.piped else F.sum(quote_parity("value"))).alias("broken"),
        F.sha2(F.concat_ws(":", *[c.cast("string") for c in sums]), 256).alias("digest"),
    )
    by_path = {plain_path(unquote(r["path"])): r for r in found.collect()}
    nothing = Scanned(0, "", 0, False, 0, "")
    header = 0 if spec.piped else 1
    out = {}
    for f in files:
        r = by_path.get(plain_path(f.path))
        out[f.path] = nothing if r is None else Scanned(
            r["rows"] - header, r["first_line"], r["off"], r["first_fits"], r["broken"], r["digest"]
        )
    return out


def plain_path(path: str) -> str:
    """A listed path without its scheme, which listings and scans spell differently."""
    return re.sub("^[a-z0-9+.-]+:/*", "/", path)


def file_ids(files: Sequence[File]) -> tuple[dict[str, str], int]:
    """A name for each path, with as many folders as tell all of them apart, and the number of its parts."""
    for parts in range(1, max(f.path.count("/") for f in files) + 2):
        ids = {f.path: "/".join(f.path.rsplit("/", parts)[-parts:]) for f in files}
        if len(set(ids.values())) == len(files):
            break
    return ids, parts


def file_id(parts: int, path: Column | None = None) -> Column:
    """The id of a row's file by its path, as ``file_ids`` spells it."""
    if parts == 1 and path is None:
        return file_name()
    path = F.col("_metadata.file_path") if path is None else path
    # A plus sign is none of the escapes of a path.
    return F.substring_index(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "/", -parts)


LEDGER = ["path", "name", "size", "digest", "run", "verdict"]
WITHDRAWN = "Withdrawn"


def ledger(spark: SparkSession, zones: Zones, dataset: str) -> Snapshot:
    """The files that runs of a dataset have staged: one row per path, updated by each run's own files."""
    return Snapshot(spark, zones.file_ledger(dataset), LEDGER, keys=["path"])


def _placed(spark: SparkSession, book: Snapshot, rows: list[tuple], run_id: str) -> dict[str, bool]:
    """Paths that another run staged, and whether the file is still the one it staged."""
    asked = spark.createDataFrame(rows, "path string, size string, digest string")
    held = book.read().where((F.col("verdict") == PROCESSED) & (F.col("run") != run_id))
    same = (F.col("held.size") == F.col("asked.size")) & (F.col("held.digest") == F.col("asked.digest"))
    # As many rows as files were listed; only those meet the ledger.
    met = held.alias("held").join(F.broadcast(asked.alias("asked")), F.col("held.path") == F.col("asked.path"))
    return {r["path"]: r["same"] for r in met.select("asked.path", same.alias("same")).collect()}


def _enter(spark: SparkSession, book: Snapshot, accepted: list[tuple], run_id: str) -> None:
    """Enter a run's accepted files; files that it staged before and no longer accepts are withdrawn."""
    now = spark.createDataFrame([(*a, run_id, PROCESSED) for a in accepted], text_schema(LEDGER))
    held = book.read().where((F.col("run") == run_id) & (F.col("verdict") == PROCESSED))
    # As many rows as files were accepted.
    gone = held.join(F.broadcast(now), "path", "left_anti")
    rows = gone.withColumn("verdict", F.lit(WITHDRAWN)).select(*LEDGER).unionByName(now).collect()
    if rows:
        book.upsert(spark.createDataFrame(rows, text_schema(LEDGER)), len(rows))
        book.tidy()


def _staged_text(name: str) -> Column:
    """Without quotes, blank as null: downstream both mean missing, and text files cannot tell them apart."""
    return F.nullif(strip_quotes(F.col(quoted(name))), F.lit("")).alias(name)


def stage(
    spark: SparkSession,
    spec: FeedSpec,
    zones: Zones,
    run_id: str,
    clock: RunClock | None = None,
    every_line: bool = True,
) -> DataFrame:
    """Stage the files of one feed and return their manifest.

    Headed files need the declared header. Quoted fields may hold line breaks.
    Rows with too few or too many fields are filled or cut, counted in the
    manifest and kept as text in ``zones.line_records``. Headerless files need
    the declared number of fields in each line, or without ``every_line`` in
    their first. Accepted rows go to ``run_id=<run>/file=<name>`` in one parallel
    job, where files of one base name carry as much of their folders as tells
    them apart; raw files are left where they are. A ledger keeps path, size and
    digest of what runs have staged: a path that another run staged is refused,
    with another remark when its lines have changed since. Staging the same run
    again replaces its folder as a whole, and withdraws files it no longer accepts.
    """
    spec.check_columns()
    clock = clock or RunClock()
    try:
        with scratch_run(spark):
            rows = _stage(spark, spec, zones, run_id, clock, every_line)
    except Exception:
        failed = [(spec.raw_glob, FAILED, "", None, clock.timestamp, RunClock().timestamp)]
        write_manifest(spark.createDataFrame(failed, FILE_MANIFEST), zones.file_manifests, clock.day, spec.name, run_id)
        raise
    manifest = spark.createDataFrame(rows, FILE_MANIFEST)
    write_manifest(manifest, zones.file_manifests, clock.day, spec.name, run_id)
    return manifest


def _stage(spark, spec, zones, run_id, clock, every_line) -> list[tuple]:
    files = glob_files(spark, zones.raw(spec.raw_glob), spec.exclude)
    target = zones.staged_run(spec.name, run_id)
    book = ledger(spark, zones, spec.name)
    if not files:
        delete_folder(spark, target)
        _enter(spark, book, [], run_id)
        return [(spec.raw_glob, REJECTED, NO_FILE, None, clock.timestamp, RunClock().timestamp)]
    ids, parts = file_ids(files)
    scanned = scan_files(spark, spec, files)
    if spec.piped:
        fits = {f for f, s in scanned.items() if s.rows and (s.off == 0 if every_line else s.first_fits)}
    else:
        headers = {f: next(csv.reader([s.first_line]), []) for f, s in scanned.items()}
        fits = {f for f, found in headers.items() if check_header(spec.columns, found).valid}
    named = [(plain_path(f.path), str(f.size), scanned[f.path].digest) for f in files]
    placed = _placed(spark, book, named, run_id)
    accepted = [f for f in files if f.path in fits and plain_path(f.path) not in placed]
    broken = [f for f in accepted if scanned[f.path].broken]
    rows = {f: s.rows for f, s in scanned.items()}
    ragged = {f.path: scanned[f.path].off for f in accepted if not spec.piped and f not in broken}
    records = _records(spark, broken, parts) if broken else None
    _write(spark, spec, [f for f in accepted if f not in broken], records, target, parts)
    if not spec.piped:
        _keep_ragged(spark, spec, zones, run_id, clock, [f for f in accepted if ragged.get(f.path)], records)
    if broken:
        counted = records.groupBy("file").agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(comma_fields("value") != spec.width).alias("off")
        )
        found = {r["file"]: r for r in counted.collect()}
        for f in broken:
            r = found.get(ids[f.path])
            rows[f.path], ragged[f.path] = (r["rows"] - 1, r["off"]) if r else (0, 0)
    _enter(spark, book, [(plain_path(f.path), ids[f.path], str(f.size), scanned[f.path].digest) for f in accepted], run_id)
    ended = RunClock().timestamp

    def verdict(f: File) -> tuple[str, str]:
        if f.path not in fits:
            return REJECTED, BAD_SCHEMA
        if plain_path(f.path) in placed:
            return REJECTED, NOT_PLACED if placed[plain_path(f.path)] else CHANGED
        return PROCESSED, RAGGED.format(ragged[f.path]) if ragged.get(f.path) else NO_REMARK

    return [(ids[f.path], *verdict(f), rows[f.path], clock.timestamp, ended) for f in files]


def _records(spark: SparkSession, files: Sequence[File], parts: int) -> DataFrame:
    """file, record and value of files with quoted line breaks, headers included; written once for the steps that read them."""
    found = read_records(spark, [f.path for f in files])
    found = found.select(file_id(parts, F.col("path")).alias("file"), "record", "value")
    folder = scratch_path(spark, "staged-records")
    found.write.parquet(folder)
    return spark.read.parquet(folder)


def _without_header(records: DataFrame) -> DataFrame:
    first = records.groupBy("file").agg(F.min("record").alias("header"))
    # One row per file.
    return records.join(F.broadcast(first), "file").where("record > header").drop("header")


def _keep_ragged(spark, spec, zones, run_id, clock, files: Sequence[File], records: DataFrame | None) -> None:
    """Lines and records with too few or too many fields, as text beside the manifest."""
    off = spark.createDataFrame([], text_schema("FileName,Line"))
    if files:
        off = off.unionByName(ragged_lines(spark, [f.path for f in files], spec.width))
    if records is not None:
        wrong = records.where(comma_fields("value") != spec.width)
        off = off.unionByName(wrong.select(F.col("file").alias("FileName"), F.col("value").alias("Line")))
    write_errors(off, zones.line_records, clock.day, spec.name, run_id)


def _write(
    spark: SparkSession, spec: FeedSpec, files: Sequence[File], records: DataFrame | None, target: str, parts: int
) -> None:
    """The rows of accepted files in place of whatever the run's folder held."""
    paths = [f.path for f in files]
    if not paths and records is None:
        delete_folder(spark, target)
        return
    keep_folders_open(spark)
    if spec.piped:
        lines = read_lines(spark, paths).select(strip_line_quotes("value").alias("value"), file_id(parts).alias("file"))
        lines.write.mode("overwrite").partitionBy("file").text(target)
        return
    names = normalise_names(spec.columns)
    rows = [parsed(_without_header(records), names, "file")] if records is not None else []
    if paths:
        rows.append(read_typed_csv(spark, paths, names).withColumn("file", file_id(parts)))
    cleaned = union_all(*rows).select(*[_staged_text(n) for n in names], "file")
    cleaned.write.mode("overwrite").partitionBy("file").parquet(target)


def was_staged(spark: SparkSession, spec: FeedSpec, zones: Zones, run_id: str) -> bool:
    """Whether a run has staged this feed, with or without accepting a file; a run that broke has not."""
    path = run_path(zones.file_manifests, spec.name, run_id)
    return exists(spark, path) and not spark.read.parquet(path).where(F.col("Status") == FAILED).limit(1).count()


def read_staged(spark: SparkSession, spec: FeedSpec, zones: Zones, run_id: str) -> DataFrame:
    """Staged rows of one run under the declared names; per-file feeds keep ``file``."""
    path = zones.staged_run(spec.name, run_id)
    keep_file = spec.merge == "file"
    if spec.piped:
        scan = read_piped(spark, path, spec.columns, nested=True)
        return scan.withColumn("file", file_name()) if keep_file else scan
    names = normalise_names(spec.columns)
    schema = ", ".join(f"{quoted(n)} string" for n in [*names, "file"])
    scan = spark.read.schema(schema).parquet(path)
    # Per-file feeds are known by their staged header names, the others by the declared ones.
    if keep_file:
        return scan
    return rebind(scan.drop("file"), spec.columns)
