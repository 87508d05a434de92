"""Incremental staging of newly landed trip files (Structured Streaming).

The reference is batch only: re-running its staging script appends the
newly loaded rows to the staging table (S21).  ``stage_trips_stream`` is the
same staging plan run incrementally: a file-stream source over the landing
folder picks up only new CSV files, and each micro-batch is staged with
``plans.staging.stage_trips`` (same spatial joins, same labels) inside
``foreachBatch``.

Each micro-batch writes its own ``batch_id=<n>`` folder in ``overwrite``
mode, so a batch replayed after a failure replaces its own output instead
of duplicating it; together with the query's checkpoint this gives
exactly-once output.  The result reads as one table
(``spark.read.parquet(out_path)``).

With ``facts_path``, every micro-batch also writes its per-day counts
(``reports.trip_day_facts``) next to it.  Those counts roll up by summing
and OR-ing, so the rows of all batches together are valid input for the
six trip reports (``days=spark.read.parquet(facts_path)``): reports can be
refreshed without rescanning any trips.  No operator is added: this is only
a different way to run the staging and report plans.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import schemas, sinks
from ..operators.spatial import PolygonIndex
from ..plans.reports import trip_day_facts
from ..plans.staging import stage_trips
from ..schemas import REFERENCE_AIRPORTS
from ..sources.landing import csv_options, land_trips


def stage_trips_stream(
    spark: SparkSession,
    landing_dir: str,
    zip_polygons: DataFrame | PolygonIndex,
    areas: DataFrame | PolygonIndex,
    out_path: str,
    checkpoint_location: str,
    available_now: bool = True,
    multi_line: bool = True,
    max_files_per_trigger: int | None = None,
    dedupe_points: bool = True,
    facts_path: str | None = None,
    airports: Mapping[str, Sequence[int]] = REFERENCE_AIRPORTS,
) -> StreamingQuery:
    """Start a streaming query staging every new trip CSV under ``landing_dir``.

    ``available_now`` processes what is there and stops (a scheduled
    incremental job); otherwise it keeps running with the default trigger.
    ``checkpoint_location`` belongs to ``out_path``: it remembers which files
    were staged, so a restart neither skips nor repeats one.
    Polygon layers are indexed once, outside the stream.
    """
    opts = csv_options(schemas.DATE_FORMATS["taxi_trips"], multi_line)
    reader = spark.readStream.schema(schemas.TAXI_TRIPS).options(**opts)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    landed = land_trips(reader.csv(landing_dir))
    zi = zip_polygons if isinstance(zip_polygons, PolygonIndex) else PolygonIndex(zip_polygons, ["zip"])
    ai = areas if isinstance(areas, PolygonIndex) else PolygonIndex(areas, ["area_numbe"])
    root = out_path.rstrip("/")

    def stage_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # parsed once for the lookup and the staging
        try:
            staged = stage_trips(batch, zi, ai, lookup_path=f"{root}/_point_lookup" if dedupe_points else None)
            sinks.write_table(staged, f"{root}/batch_id={batch_id}", mode="overwrite")
        finally:
            batch.unpersist()
        if facts_path:
            written = sinks.scan_table(spark, f"{root}/batch_id={batch_id}")
            sinks.write_table(
                trip_day_facts(written, airports), f"{facts_path.rstrip('/')}/batch_id={batch_id}", mode="overwrite"
            )

    writer = (
        landed.writeStream.foreachBatch(stage_batch)
        .option("checkpointLocation", checkpoint_location)
        .queryName(f"stage_trips_stream_{abs(hash(root)) % 10**8}")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
