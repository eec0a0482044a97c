"""Enrich staged files as they arrive.

The run is the same as for a batch: each micro-batch of staged files goes
through ``enrich_frame``. A replayed batch carries the same run id, and every
merge gives the same table when a delivery is applied twice.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from feedwright.functions.text import quoted
from feedwright.limits import DEFAULT_LIMITS, Limits
from feedwright.operators.schema import normalise_names, rebind
from feedwright.plans.enriching import enrich_frame
from feedwright.plans.spec import FeedSpec
from feedwright.plans.zones import Zones


def follow_staged(
    spark: SparkSession,
    dataset: str,
    specs: Mapping[str, FeedSpec],
    zones: Zones,
    limits: Limits = DEFAULT_LIMITS,
    once: bool = True,
) -> StreamingQuery:
    """A streaming query over the staged Parquet files of one feed.

    ``once`` takes what is there and stops; otherwise the query goes on.
    """
    spec = specs[dataset]
    if spec.piped or spec.merge == "file":
        raise ValueError(f"{dataset}: only headed feeds with a snapshot can be followed")
    names = normalise_names(spec.columns)
    schema = ", ".join(f"{quoted(n)} string" for n in names)
    arrivals = spark.readStream.schema(schema).parquet(zones.staged(dataset) + "/run_id=*/file=*")

    def merge(batch: DataFrame, batch_id: int) -> None:
        # The query's id lasts as long as its checkpoint; batch numbers start anew without it.
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        enrich_frame(rebind(batch, spec.columns), spec, specs, zones, f"arrivals-{query}-{batch_id}", limits=limits)

    writer = arrivals.writeStream.foreachBatch(merge).option(
        "checkpointLocation", f"{zones.snapshot(dataset)}-arrivals"
    )
    return (writer.trigger(availableNow=True) if once else writer).start()
