"""Continuous updates: an extension, as the graph itself is maintained in batches.

A stream of changed objects moves the expiry state by micro-batches: each batch is
synchronised, marked as expired, and upserted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meshwork.operators.upsert import safe_upsert
from meshwork.schema import NODE_KEY


def event_stream(spark: SparkSession, folder: str, schema, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def windowed_counts(events: DataFrame, every: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Events and their value by window and type, late ones up to ``late``."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", every), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value")).select(F.col("window.start").alias("window_start"), "event_type", "n", "value")


def changed_objects(events: DataFrame, late: str = "1 day") -> DataFrame:
    """Objects with a change, each once within the watermark."""
    rows = events.select("ts", F.lit("TST").alias("institution_id"), F.lit("Person").alias("object_type"), F.col("user_id").cast("string").alias("object_id"))
    return rows.withWatermark("ts", late).dropDuplicatesWithinWatermark(NODE_KEY)


def maintain_state(changes: DataFrame, load: Callable[[], DataFrame], save: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Upserts each batch of changed objects into the state that ``load`` gives as to
    be processed; ``save`` gets the batch's number, so that a repeat can be told."""
    def step(batch: DataFrame, number: int) -> None:
        marks = batch.select(*NODE_KEY).distinct().withColumns({"has_changed": F.lit(1), "to_process": F.lit(1)})
        save(safe_upsert(load(), marks, NODE_KEY, ["has_changed", "to_process"]), number)

    return changes.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
