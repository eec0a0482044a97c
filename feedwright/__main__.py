"""Run one step for one dataset.

    spark-submit feedwright/__main__.py stage  <dataset> <root> --run-id <id> [--schemas <file>]
    spark-submit feedwright/__main__.py enrich <dataset> <root> --run-id <id> [--schemas <file>]
    spark-submit feedwright/__main__.py weeks  <report>  <root>

``python -m feedwright ...`` does the same on a local session. The schema file
holds ``dataset = column,column,...`` lines for the feeds whose columns the
catalog does not list.
"""

from __future__ import annotations

import argparse

from feedwright.plans import catalog
from feedwright.plans.enriching import enrich, report_coverage
from feedwright.plans.spec import fill_schemas, read_schemas
from feedwright.plans.staging import stage
from feedwright.plans.zones import Zones
from feedwright.session import build_session
from feedwright.sources.readers import read_lines


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="feedwright")
    parser.add_argument("step", choices=["stage", "enrich", "weeks"])
    parser.add_argument("dataset")
    parser.add_argument("root")
    parser.add_argument("--run-id", default="")
    parser.add_argument("--schemas", default="")
    args = parser.parse_args(argv)
    if args.step != "weeks" and not args.run_id:
        parser.error("--run-id is needed")
    spark = build_session()
    specs = catalog.feeds()
    if args.schemas:
        # A configuration file: one line per feed.
        specs = fill_schemas(specs, read_schemas([r["value"] for r in read_lines(spark, args.schemas).collect()]))
    zones = Zones(args.root.rstrip("/"))
    if args.step == "weeks":
        report_coverage(spark, args.dataset, catalog.COVERAGE, specs, zones).show(100, truncate=False)
        return
    if args.dataset not in specs:
        parser.error(f"unknown dataset {args.dataset}")
    if not specs[args.dataset].columns:
        parser.error(f"the columns of {args.dataset} must come from --schemas")
    if args.step == "stage":
        stage(spark, specs[args.dataset], zones, args.run_id).show(100, truncate=False)
    else:
        print(enrich(spark, args.dataset, specs, zones, args.run_id))


if __name__ == "__main__":
    main()
