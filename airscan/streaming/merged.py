"""Streams whose aggregates merge, so that no row is lost however late it comes.

Each micro-batch writes partial aggregates of its own rows to a folder named after its batch
id, which a repeated batch overwrites; merging the partials gives the result at any time.
Nothing is kept in memory and no window is ever closed to a row.  Rows that come after the
watermark has passed the end of their window are merged like all others and counted as late.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

Step = Callable[[DataFrame], DataFrame]


def start_batches(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


class MergedBatches:
    """A sink for micro-batches: ``partial`` aggregates a batch, ``merge`` partials, both to the same columns.

    With ``delay`` (an interval such as ``10 minutes``) partials have ``window_start`` and ``window_end``
    and a row count ``rows``, and ``late`` tells how many rows came late for their window.  Every
    ``compact_every`` batches the partials so far are merged into one table, so reading does not grow
    with the number of batches.
    """

    def __init__(self, path: str, partial: Step, merge: Step, delay: str | None = None, compact_every: int = 64):
        self.path, self.partial, self.merge, self.delay, self.compact_every = path, partial, merge, delay, compact_every

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows = self.partial(batch)
        if self.delay:
            passed = self.watermark(batch.sparkSession, batch_id - 1)
            late = F.lit(False) if passed is None else F.col("window_end") <= F.timestamp_micros(F.lit(passed))
            rows = rows.withColumn("is_late", late)
            newest = batch.agg(F.max(F.unix_micros(F.col("ts").cast("timestamp"))).alias("newest"))
            newest.write.mode("overwrite").parquet(f"{self.path}/newest/batch={batch_id}")
        rows.write.mode("overwrite").parquet(f"{self.path}/partials/batch={batch_id}")
        if self.compact_every and batch_id % self.compact_every == self.compact_every - 1:
            self._merged(batch.sparkSession, batch_id).write.mode("overwrite").parquet(f"{self.path}/merged/upto={batch_id}")

    def watermark(self, spark: SparkSession, batch_id: int) -> int | None:
        """Newest event time up to a batch, less the delay, in microseconds; None before the first batch."""
        if batch_id < 0:
            return None
        seen = spark.read.parquet(f"{self.path}/newest").filter(F.col("batch") <= batch_id)
        delayed = F.unix_micros(F.timestamp_micros(F.max("newest")) - F.expr(f"INTERVAL {self.delay}"))
        return seen.agg(delayed).first()[0]

    def _merged(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """All partials up to a batch, those before the last compaction from its table."""
        before = batch_id - batch_id % self.compact_every - 1 if self.compact_every else -1
        partials = spark.read.parquet(f"{self.path}/partials").filter(F.col("batch").between(before + 1, batch_id)).drop("batch")
        if before >= 0:
            partials = partials.unionByName(spark.read.parquet(f"{self.path}/merged/upto={before}"))
        return partials if not self.compact_every else self._grouped(partials)

    def _grouped(self, partials: DataFrame) -> DataFrame:
        if not self.delay:
            return self.merge(partials)
        on_time, late = (self.merge(partials.filter(F.col("is_late") == late).drop("is_late")) for late in (False, True))
        return on_time.withColumn("is_late", F.lit(False)).unionByName(late.withColumn("is_late", F.lit(True)))

    def _last(self, spark: SparkSession) -> int:
        return spark.read.parquet(f"{self.path}/partials").agg(F.max("batch")).first()[0]

    def result(self, spark: SparkSession) -> DataFrame:
        """The aggregates of all rows so far, late ones included."""
        whole = self._merged(spark, self._last(spark))
        return self.merge(whole.drop("is_late")).drop("rows", "window_end")

    def late(self, spark: SparkSession) -> DataFrame:
        """Late rows per window."""
        found = self._merged(spark, self._last(spark)).filter("is_late")
        return found.groupBy("window_start", "window_end").agg(F.sum("rows").alias("late_rows"))

    def closed(self, spark: SparkSession) -> DataFrame:
        """The aggregates of windows that the watermark has passed."""
        passed = self.watermark(spark, self._last(spark))
        whole = self._merged(spark, self._last(spark)).filter(F.col("window_end") <= F.timestamp_micros(F.lit(passed)))
        return self.merge(whole.drop("is_late")).drop("rows", "window_end")

    def start(self, stream: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
        return start_batches(stream, self, checkpoint, once)
