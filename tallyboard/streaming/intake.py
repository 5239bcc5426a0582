"""Recurring import: pick up the downloads noted since the last time."""

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tallyboard.plans.pipeline import run_pipeline
from tallyboard.sources.exports import export_faults, scan_exports

DOWNLOADS = "file_path string, export_url string, league_id string, event_end_date date"


def import_new_downloads(
    spark: SparkSession,
    notes: str,
    root: str,
    checkpoint: str,
    now: Callable[[], datetime] = datetime.now,
    bytes_per_batch: str = "1m",
    **options,
) -> int:
    """Import every download note (JSON lines) not seen before, then work out the derived tables.

    The stream remembers which notes it has read, so each time touches new export files only. It
    imports batch by batch; the derived tables are worked out once at the end, also if there is
    nothing new. A batch that is repeated after a crash does no harm: its exports are imported
    already or not at all. Returns the number of batches.
    """
    batches = 0

    def load(batch: DataFrame, batch_id: int) -> None:
        nonlocal batches
        session = batch.sparkSession
        # One path per note of this batch, and bytes_per_batch bounds the notes.
        paths = [row.file_path for row in batch.select("file_path").distinct().collect()]
        if paths:
            rows, faults = scan_exports(session, paths), export_faults(session, paths)
            run_pipeline(session, root, now(), batch, rows, export_faults=faults, derive=False, **options)
            batches += 1

    query = (
        spark.readStream.schema(DOWNLOADS)
        .option("maxBytesPerTrigger", bytes_per_batch)
        .json(notes)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    run_pipeline(spark, root, now(), **options)
    return batches
