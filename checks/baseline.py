"""Time the straightforward plan of an operator against the plan used here.

    python -m checks.baseline [--dir /root/testdata/sf0.1] [--runs 3]

Both sides of each pair give the same rows. Seconds are the best of the runs;
shuffled bytes come from Spark's event log of that run.
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from checks import queries as q
from checks.feeds import lineitem, orders, table
from feedwright.operators.merge import feed_day
from feedwright.operators.rules import bad_key
from feedwright.operators.unique import split_unique
from feedwright.plans.spec import apply_steps
from feedwright.session import build_session


def split_by_self_join(spark, sf):
    lines = table(spark, sf, "lineitem")
    single = lines.groupBy(*q.LINE_KEYS).agg(F.count(F.lit(1)).alias("n")).where("n = 1").drop("n")
    once = lines.join(single, q.LINE_KEYS).select(*lines.columns)
    return [once, lines.exceptAll(once)]


def split_by_counts(spark, sf):
    return list(split_unique(table(spark, sf, "lineitem"), q.LINE_KEYS))


def errors_by_except(spark, sf):
    lines = table(spark, sf, "lineitem")
    keys = q.listed_parts(spark, sf).select(F.col("p_partkey").alias("l_partkey")).distinct()
    return [lines.subtract(lines.join(keys, "l_partkey").select(*lines.columns))]


def errors_by_flag(spark, sf):
    return [q.fk_errors(spark, sf)]


def _chain(df, lookups, columns):
    for lookup in lookups:
        key = F.col(lookup.key).cast(df.schema[lookup.column].dataType)
        keys = lookup.master.select(key.alias(lookup.column)).distinct()
        df = df.join(keys, lookup.column).select(*columns)
    return df


def _chain_errors(df, lookups):
    return [df.subtract(_chain(df, [lookup], df.columns)) for lookup in lookups]


def chain_by_joins(spark, sf):
    lines, lookups = table(spark, sf, "lineitem"), q.line_lookups(spark, sf)
    return [_chain(lines, lookups, lines.columns), *_chain_errors(lines, lookups)]


def chain_by_flags(spark, sf):
    lines, lookups = table(spark, sf, "lineitem"), q.line_lookups(spark, sf)
    flagged = q.flag_lookups(lines, lookups)
    return [q.kept_rows(flagged, lookups, lines.columns), q.failed_rows(flagged, lookups, lines.columns)]


def range_by_two_filters(spark, sf):
    history, clean = orders(spark, sf, "MM/dd/yyyy"), q._late_orders(spark, sf)
    day = F.try_to_date("o_orderdate", "M/d/yyyy")
    lo, hi = clean.agg(F.min(day), F.max(day)).first()
    return [history.where(day < F.lit(lo)).union(history.where(day > F.lit(hi))).union(clean).distinct()]


def range_by_one_filter(spark, sf):
    return [q.merge_replace_range(spark, sf)]


def fact_by_recomputing(spark, sf):
    """Every output starts again from the delivery."""
    spec, lookups = q.line_spec(), q.line_lookups(spark, sf)
    columns = list(spec.columns)
    conformed = apply_steps(q.returned_lines(spark, sf), spec.before)
    good = conformed.where(~bad_key(spec.keys, spec.date_keys))
    clean = _chain(good, lookups, columns)
    day = feed_day("l_shipdate")
    lo, hi = clean.agg(F.min(day), F.max(day)).first()
    history = q.past_lines(spark, sf)
    merged = history.where(day < F.lit(lo)).union(history.where(day > F.lit(hi))).union(clean).distinct()
    counts = [conformed.agg(F.count(F.lit(1))), clean.agg(F.count(F.lit(1)))]
    bad = conformed.where(bad_key(spec.keys, spec.date_keys))
    return [clean, merged, *counts, bad, *_chain_errors(good, lookups)]


def fact_from_judged(spark, sf):
    spec = q.line_spec()
    found, lookups = q.judged_lines(spark, sf)
    clean = q.clean_rows(found.frame, spec, lookups)
    bounds = found.metrics["first_day"], found.metrics["last_day"]
    merged = q.merge.replace_range(q.past_lines(spark, sf), clean, spec.day(), bounds=bounds)
    return [clean, merged, q.judged_errors(found.frame, spec, lookups)]


PAIRS = {
    "Unique-key split": (split_by_self_join, split_by_counts),
    "Foreign-key errors": (errors_by_except, errors_by_flag),
    "Foreign-key chain, clean + errors": (chain_by_joins, chain_by_flags),
    "Replace date range": (range_by_two_filters, range_by_one_filter),
    "Whole fact run": (fact_by_recomputing, fact_from_judged),
}


def finish(frames) -> None:
    for df in frames:
        df.write.format("noop").mode("overwrite").save()


def shuffled(log_dir: str, groups: list[str]) -> dict[str, int]:
    """Shuffle bytes written per job group."""
    stage_group, total = {}, dict.fromkeys(groups, 0)
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if not os.path.isfile(path):
            continue
        for line in open(path, encoding="utf-8", errors="ignore"):
            if '"SparkListenerJobStart"' in line:
                event = json.loads(line)
                group = event.get("Properties", {}).get("spark.jobGroup.id")
                stage_group |= dict.fromkeys(event["Stage IDs"], group)
            elif '"SparkListenerTaskEnd"' in line:
                event = json.loads(line)
                group = stage_group.get(event["Stage ID"])
                if group in total:
                    metrics = event.get("Task Metrics", {}).get("Shuffle Write Metrics", {})
                    total[group] += metrics.get("Shuffle Bytes Written", 0)
    return total


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--dir", default="/root/testdata/sf0.1")
    parser.add_argument("--runs", type=int, default=3)
    parser.add_argument("--only", default="")
    args = parser.parse_args()
    pairs = {n: p for n, p in PAIRS.items() if args.only in n}
    log_dir = tempfile.mkdtemp(prefix="run-events-")
    spark = build_session(
        "baseline",
        "local[8]",
        spark_sql_shuffle_partitions="8",
        spark_driver_memory="16g",
        spark_eventLog_enabled="true",
        spark_eventLog_dir=f"file://{log_dir}",
        spark_eventLog_compress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds, last = {}, []
    for name, pair in pairs.items():
        for side, fn in zip(("straightforward", "here"), pair):
            times = []
            for run in range(args.runs):
                group = f"{name}/{side}/{run}"
                spark.sparkContext.setJobGroup(group, group)
                started = time.perf_counter()
                finish(fn(spark, args.dir))
                times.append(time.perf_counter() - started)
            seconds[f"{name}/{side}"] = min(times)
            last.append(group)
    spark.stop()
    moved = shuffled(log_dir, last)
    for name in pairs:
        a, b = (f"{name}/{side}" for side in ("straightforward", "here"))
        mb = [moved[f"{x}/{args.runs - 1}"] / 1e6 for x in (a, b)]
        print(f"| {name} | {seconds[a]:.2f} s, {mb[0]:.1f} MB | {seconds[b]:.2f} s, {mb[1]:.1f} MB |", flush=True)


if __name__ == "__main__":
    main()
