"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query
runs in full (every column of every row is produced) and its best time counts.
``BENCH_ONLY`` is a comma list of query names, ``BENCH_RUNS`` the repetitions.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import REGISTERED  # noqa: E402
from feedwright.session import build_session  # noqa: E402

HEADLINE = [
    "key_rule_clean",
    "key_rule_errors",
    "planogram_clean",
    "unique_split_clean",
    "unique_split_dups",
    "fk_keep",
    "fk_errors",
    "fk_chain_clean",
    "fk_chain_errors",
    "fk_ci_spelling",
    "merge_append",
    "merge_upsert",
    "merge_replace_range",
    "missing_weeks",
    "date_reformat",
    "bucket_52_weeks",
    "raw_to_stage",
    "master_run",
    "fact_run",
    "fact_run_errors",
    "snapshot_restatement",
    "fact_run_in_folders",
    "merge_append_new_rows",
]


def finish(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def best_time(spark, fn, sf_dir: str, runs: int) -> float:
    times = []
    for _ in range(runs):
        started = time.perf_counter()
        finish(fn(spark, sf_dir))
        times.append(time.perf_counter() - started)
    return min(times)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    spark = build_session(
        "bench", f"local[{cpus}]", spark_sql_shuffle_partitions=cpus, spark_driver_memory="16g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {n: round(best_time(spark, REGISTERED[n], sf_dir, runs), 3) for n in only or HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
