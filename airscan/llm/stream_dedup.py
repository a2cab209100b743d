"""Exact deduplication by a stream with keyed state.

A first pass over the documents writes one narrow row per document: digest of the normalised text, length, identifier,
and the locator of its content, the file and the position of the row in it. These rows are streamed into a keyed state
without expiry that lies on the executors' disks (RocksDB) and is saved with every micro-batch. Per digest it keeps the
number of rows and, of the row that stays, the identifier and the locator. Rows of a digest are combined before the
shuffle, so a text that makes up a third of all rows sends one row per task to its state.

Hits are digests met more than once. The locator of the row that stays is followed to its content, and the full bytes of
all rows of a hit are compared with it; the rows are combined to their smallest and largest bytes first, which both equal
the content if and only if all of them do. Rows that differ in spite of equal digests are grouped by their bytes.

With a folder ``state`` the state outlives the call: documents that arrive later meet all earlier ones, whose contents
are read again from the files that locators name. An arrival has a name; repeating a name after a crash counts nothing
twice.

Null text counts as empty; empty and white texts are equal to each other. Of equal texts the row with the most code
points stays, then the smallest doc_id (null last), then the first by file name and position; repeated rows with one
doc_id are separate rows of which one stays. An empty table gives an empty result. Very long texts are compared whole.
Only doc_id and text are read; other columns of any name are ignored by ``marked`` and kept by ``drop_copies``. Frames
that do not come from Parquet files are written once to have locators; a frame that makes several rows of one row of a
file, or computes its texts and leaves a state behind, has to be written by its caller.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airscan.llm.frames import SPACE, keep_marked, row_key, whole_text
from airscan.sources.local import bounded, staged, work_dir

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # Without this each of the state's partitions reserves several MB of disk, however few digests it holds.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
}


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE, "")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def locator(documents: DataFrame) -> Column:
    """The place of a row's content: file and position."""
    place = documents.metadataColumn("_metadata")
    return F.struct(place["file_path"].alias("file"), place["row_index"].alias("position"))


def readable(spark: SparkSession, path: str) -> DataFrame | None:
    """A written table, or None where nothing was written to its end."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def with_places(documents: DataFrame, folder: str) -> DataFrame:
    """The documents if their rows have locators, else a copy written to the folder."""
    try:
        documents.select(locator(documents))
        return documents
    except AnalysisException:
        if readable(documents.sparkSession, folder) is None:
            documents.select("doc_id", "text").write.mode("overwrite").parquet(folder)
        return documents.sparkSession.read.parquet(folder)


def fingerprints(documents: DataFrame, path: str, digest: Callable[[Column], Column]) -> DataFrame:
    """One narrow row per document, written to a shared folder: the stream's input."""
    written = readable(documents.sparkSession, path)
    if written is not None:
        return written
    text = whole_text()
    rows = documents.select(
        *row_key(), locator(documents).alias("row"), F.length(text).cast("bigint").alias("n_points"),
        digest(normalised(text)).alias("digest"),
    )
    rows.write.mode("overwrite").parquet(path)
    return documents.sparkSession.read.parquet(path)


def staying() -> Column:
    """Of rows of one text the one that stays, by the smallest struct."""
    by_id = F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("by_id")
    return F.min(F.struct((-F.col("n_points")).alias("by_points"), by_id, "row", "doc_id"))


def streamed_groups(spark: SparkSession, prints: DataFrame, folder: str, per_batch: int) -> DataFrame:
    """Per digest the number of rows and the row that stays, from the stream's last word on each digest.

    Every micro-batch writes the digests it touched to a folder of its own, which a repeated batch overwrites; the
    last is the one with the highest count.
    """
    session = spark.newSession()
    for key, value in STATE.items():
        session.conf.set(key, value)
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        session.conf.set(key, spark.conf.get(key))
    state = (
        session.readStream.schema(prints.schema).option("maxBytesPerTrigger", str(per_batch)).parquet(f"{folder}/prints/*")
        .groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), staying().alias("keep"))
    )

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/touched/batch={batch_id}")

    query = (
        state.writeStream.outputMode("update").foreachBatch(save).trigger(availableNow=True)
        .option("checkpointLocation", f"{folder}/state").start()
    )
    try:
        query.awaitTermination()
    finally:
        query.stop()
    touched = spark.read.parquet(f"{folder}/touched")
    return touched.groupBy("digest").agg(F.max("group_size").alias("group_size"), F.max_by("keep", "group_size").alias("keep")).select(
        "digest", "group_size", F.col("keep.doc_id").alias("keep_id"), F.col("keep.row").alias("keep_row")
    )


def marked(
    documents: DataFrame, per_batch: int = 1 << 30, digest: Callable[[Column], Column] = sha256,
    state: str | None = None, arrival: str = "first",
) -> DataFrame:
    """Per row of ``documents``: row, doc_id, mark, digest, n_points, group_size, keep_id and keep_row, as a written table.

    ``row`` and ``keep_row`` are locators. ``per_batch`` bounds the bytes of narrow rows in one micro-batch. ``digest`` may
    be replaced to test what happens when different texts share a digest. ``state`` is a shared folder in which an
    earlier call left its state: group_size, keep_id and keep_row then cover all arrivals up to this one.
    """
    spark = documents.sparkSession
    folder = state.rstrip("/") if state else work_dir(spark, "dedup-stream")
    documents = with_places(documents, f"{folder}/contents/{arrival}")
    prints = fingerprints(documents, f"{folder}/prints/{arrival}", digest)
    if prints.isEmpty():
        return prints.select(
            "row", "doc_id", "mark", "digest", "n_points", F.lit(1).cast("bigint").alias("group_size"),
            F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"),
        )
    groups = streamed_groups(spark, prints, folder, per_batch).filter("group_size > 1")
    if state:
        groups = groups.join(prints.select("digest"), "digest", "left_semi")
    hits = staged(groups, "dedup-groups")
    earlier = spark.read.parquet(f"{folder}/prints/*").join(prints.select("row"), "row", "left_anti") if state else None
    found_now = differing_digests(documents, hits, earlier, digest)
    found_now.write.mode("overwrite").parquet(f"{folder}/differing/{arrival}")
    differing = spark.read.parquet(f"{folder}/differing/*").join(hits, "digest", "left_semi").distinct()
    found = prints.join(hits, "digest", "left").select(
        "row", "doc_id", "mark", "digest", "n_points", F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.when(F.col("keep_row").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("keep_row", "row").alias("keep_row"),
    )
    if not differing.isEmpty():
        by_bytes = grouped_by_bytes(documents, differing, earlier, digest)
        found = found.join(differing, "digest", "left_anti").unionByName(by_bytes)
    return staged(found, "dedup-marked")


def contents(documents: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """The documents' locators, digests and normalised bytes."""
    text = whole_text()
    return documents.select(
        *row_key(), locator(documents).alias("row"), F.length(text).cast("bigint").alias("n_points"),
        digest(normalised(text)).alias("digest"), normalised(text).alias("bytes"),
    )


def fetched(wanted: DataFrame, digest: Callable[[Column], Column]) -> DataFrame | None:
    """The contents at locators of earlier arrivals; only the files that they name are read.

    The driver holds the names of these files, as it does for any scan of them.
    """
    wanted = staged(wanted.select("row"), "dedup-wanted")
    files = [r[0] for r in wanted.select("row.file").distinct().toLocalIterator()]
    if not files:
        return None
    return contents(wanted.sparkSession.read.parquet(*files), digest).join(bounded(wanted), "row", "left_semi")


def differing_digests(
    documents: DataFrame, hits: DataFrame, earlier: DataFrame | None, digest: Callable[[Column], Column]
) -> DataFrame:
    """Digests whose rows are not all of the bytes that lie at the locator of the row that stays.

    The rows of this arrival are combined to their smallest and largest bytes before the shuffle, so a text repeated in a
    third of all rows is not moved once per row. Of a digest's earlier rows one is read: the others were found equal to it
    when they arrived, or the digest was written down as differing.
    """
    place = bounded(hits.select("digest", "keep_row"))
    rows = contents(documents, digest).select("digest", "row", "bytes")
    if earlier is not None:
        one_each = earlier.groupBy("digest").agg(staying().alias("keep")).select("digest", F.col("keep.row").alias("row"))
        known = hits.select("digest", F.col("keep_row").alias("row")).unionByName(
            one_each.join(hits.select("digest"), "digest", "left_semi")
        ).join(earlier.select("row"), "row", "left_semi")
        before = fetched(known.distinct(), digest)
        rows = rows if before is None else rows.unionByName(before.select("digest", "row", "bytes"))
    content = F.when(F.col("row") == F.col("keep_row"), F.col("bytes"))
    compared = rows.join(place, "digest").groupBy("digest").agg(
        F.min("bytes").alias("low"), F.max("bytes").alias("high"), F.max(content).alias("content")
    )
    same = F.col("low").eqNullSafe(F.col("content")) & F.col("high").eqNullSafe(F.col("content"))
    return compared.filter(~same).select("digest")


def grouped_by_bytes(
    documents: DataFrame, differing: DataFrame, earlier: DataFrame | None, digest: Callable[[Column], Column]
) -> DataFrame:
    """This arrival's rows of the given digests, grouped with those of earlier arrivals by their full bytes instead."""
    rows = contents(documents, digest).join(differing, "digest", "left_semi").withColumn("new", F.lit(True))
    if earlier is not None:
        before = fetched(earlier.join(differing, "digest", "left_semi"), digest)
        rows = rows if before is None else rows.unionByName(before.withColumn("new", F.lit(False)))
    rows = staged(rows, "dedup-bytes")
    groups = rows.groupBy("digest", "bytes").agg(F.count(F.lit(1)).alias("group_size"), staying().alias("keep"))
    return rows.filter("new").join(groups, ["digest", "bytes"]).select(
        "row", "doc_id", "mark", "digest", "n_points", "group_size", F.col("keep.doc_id").alias("keep_id"),
        F.col("keep.row").alias("keep_row"),
    )


def drop_copies(documents: DataFrame, per_batch: int = 1 << 30) -> DataFrame:
    """``documents`` with one row of each group of equal texts, all columns as they were."""
    rows = marked(documents, per_batch)
    keep = (F.col("row") == F.col("keep_row")).alias("keep")
    return keep_marked(documents, staged(rows.select("doc_id", "mark", keep), "dedup-marks"))
