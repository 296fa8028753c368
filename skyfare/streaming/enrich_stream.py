"""Trips arriving as files -> located and matched with the nearest station, incrementally.

The static side (zone points, located stations, the tables of the nearest-station
join) is small derived tables, written to the shared folder and measured there.
Given as a function it is prepared anew for every micro-batch, so weather that
arrives while the stream runs is seen by the trips that come after it; given as
a ``StaticSide`` it is used for the whole run.  Each micro-batch runs the batch
merge through ``foreachBatch``.  Output goes to ``out_path/batch=<id>`` with
overwrite, so a micro-batch replayed after a failure rewrites its own folder
instead of duplicating rows.  The stream's progress lives in
``checkpoint_path`` (a shared folder), so a restarted query resumes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from skyfare.plans.merge import StaticSide, enrich_trips


def stream_enrich(spark: SparkSession, source_path: str, schema: StructType,
                  side: StaticSide | Callable[[], StaticSide], out_path: str, checkpoint_path: str, max_files_per_trigger: int = 1,
                  available_now: bool = True, fmt: str = "parquet"):
    """Start the stream; with ``available_now`` it processes what is there and stops."""
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
                .format(fmt).load(source_path))

    def write(batch: DataFrame, batch_id: int) -> None:
        enrich_trips(batch, side() if callable(side) else side).write.mode("overwrite").parquet(
            f"{out_path.rstrip('/')}/batch={batch_id}")

    writer = src.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_path)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
