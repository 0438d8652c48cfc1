"""Incremental registration as a stream: what isn't delivered yet goes to an upsert, batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lexloom.tables import TableStore

Sink = Callable[[DataFrame, int], None]


def available_now(spark: SparkSession, path: str, schema: StructType, checkpoint: str, key: list[str], sink: Sink, at: str | None = None, late: str = "1 day") -> int:
    """Everything not yet delivered under path goes to sink; returns the number of batches.

    The position moves only after sink returns, so a failure delivers the batch again: sink must be an upsert.  Within a
    batch keys are distinct.  Repeats over batches are the upsert's to settle; with an event time column (at) they are dropped
    before it as long as they come within late of each other, and no state is kept for longer.
    """
    rows = spark.readStream.schema(schema).parquet(path)
    if at:
        rows = rows.withWatermark(at, late).dropDuplicatesWithinWatermark(key)
    q = rows.writeStream.foreachBatch(lambda df, k: sink(df.dropDuplicates(key), k)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return sum(1 for p in q.recentProgress if p["numInputRows"])


def into(store: TableStore, name: str) -> Sink:
    """A sink that merges batches into a declared table by its key, so one that comes twice changes nothing."""
    return lambda df, _: store.upsert(name, df) and None
