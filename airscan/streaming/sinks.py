"""Replayable sinks for updating streams.

Each micro-batch is written to a folder named after its batch id and overwritten when
the batch is replayed, so a restarted query leaves no duplicates.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def write_batches(
    stream: DataFrame, path: str, checkpoint: str, mode: str = "update", once: bool = False,
    transform: Callable[[DataFrame, int], DataFrame] | None = None,
) -> StreamingQuery:
    """Start a query that appends every micro-batch below ``path``."""

    def save(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch, batch_id) if transform else batch
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = stream.writeStream.outputMode(mode).foreachBatch(save).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def run_once(stream: DataFrame, path: str, checkpoint: str, mode: str = "update") -> None:
    """Process everything available and stop."""
    query = write_batches(stream, path, checkpoint, mode, once=True)
    try:
        query.awaitTermination()
    finally:
        query.stop()


def latest_per_key(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Current state of an updating stream: the row of the last batch that touched a key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("batch")))
    return spark.read.parquet(path).withColumn("_rank", rank).filter("_rank = 1").drop("_rank", "batch")
