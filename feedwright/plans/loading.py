"""Running many feeds of one delivery: masters first, independent feeds side by side."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, SparkSession

from feedwright.functions.dates import RunClock
from feedwright.operators.records import FAILED, PROCESSED
from feedwright.plans.enriching import RunResult, enrich
from feedwright.plans.spec import FeedSpec
from feedwright.plans.staging import stage
from feedwright.plans.zones import Zones
from feedwright.sources.sinks import write_manifest

HELD_BACK = "Held back"
WAITS_FOR = "waits for {}"
#: Feeds that run at the same time; their Spark jobs share the cluster.
SIDE_BY_SIDE = 4

LOADED = "Data_Set_Name string, Level int, Status string, Remark string, Received bigint, Processed bigint"


@dataclass(frozen=True)
class Loaded:
    dataset: str
    level: int
    status: str
    remark: str
    received: int | None
    processed: int | None


def levels(specs: Mapping[str, FeedSpec]) -> dict[str, int]:
    """0 for feeds without masters among ``specs``, else one more than their highest master."""
    out: dict[str, int] = {}

    def level(name: str, below: tuple[str, ...]) -> int:
        if name in below:
            raise ValueError(f"{' -> '.join([*below, name])}: feeds look each other up")
        if name not in out:
            masters = {k.dataset for k in specs[name].lookups} & set(specs)
            out[name] = 1 + max((level(m, (*below, name)) for m in masters), default=-1)
        return out[name]

    for name in specs:
        level(name, ())
    return out


def load(
    spark: SparkSession,
    specs: Mapping[str, FeedSpec],
    zones: Zones,
    run_id: str,
    clock: RunClock | None = None,
    step: Callable[[str], RunResult] | None = None,
    side_by_side: int = SIDE_BY_SIDE,
) -> DataFrame:
    """Bring in all feeds of ``specs`` and return one row per feed.

    Feeds of one level run side by side; the next level starts when all are
    done. A feed whose master failed or was held back is held back itself and
    its snapshot stays as it is; all others go on. ``step`` loads one feed, by
    default its raw files. Running the same ``run_id`` again repeats it all.
    """
    clock = clock or RunClock()

    def from_raw(dataset: str) -> RunResult:
        stage(spark, specs[dataset], zones, run_id, clock)
        return enrich(spark, dataset, specs, zones, run_id, clock)

    step = step or from_raw
    at = levels(specs)
    done: dict[str, Loaded] = {}

    def run(dataset: str) -> Loaded:
        missing = sorted({k.dataset for k in specs[dataset].lookups if k.dataset in done and done[k.dataset].status != PROCESSED})
        if missing:
            return Loaded(dataset, at[dataset], HELD_BACK, WAITS_FOR.format(", ".join(missing)), None, None)
        try:
            found = step(dataset)
        except Exception as broken:  # reported with the feed; the others go on
            return Loaded(dataset, at[dataset], FAILED, type(broken).__name__, None, None)
        return Loaded(dataset, at[dataset], found.status, "", found.received, found.processed)

    with ThreadPoolExecutor(side_by_side) as pool:
        for level in sorted(set(at.values())):
            for loaded in pool.map(run, [n for n in specs if at[n] == level]):
                done[loaded.dataset] = loaded
    report = spark.createDataFrame([astuple(x) for x in done.values()], LOADED)
    write_manifest(report, zones.load_reports, clock.day, "all", run_id)
    return report
