"""The contest load as a stream over a landing folder.

Each micro-batch goes through the same idempotent append as the batch job, so a batch
that is replayed after a failure adds nothing twice. Unusable pages and records are kept in the
quarantine table, and contests that land before their entity wait for it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from duelframe.plans.pipeline import load_contests, new_batch, usable
from duelframe.sources import landing, tables


def stream_pages(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Landed page lines as a stream, a bounded number of files per batch."""
    reader = spark.readStream.schema(landing.PAGE_SCHEMA).option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def append_stream(
    pages: DataFrame, warehouse: str, checkpoint: str, *, max_id: int | None = None
) -> StreamingQuery:
    """Load everything landed so far and stop; run again to pick up what came since."""
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def load(batch: DataFrame, number: int) -> None:
        spark, folder = batch.sparkSession, new_batch(warehouse)
        found = usable(batch, landing.raw_contests, folder, warehouse, "contests", f"stream-{stream}-{number}")
        load_contests(spark, found, warehouse, max_id=max_id)
        tables.remove(spark, folder)

    writer = pages.writeStream.option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).foreachBatch(load).start()
