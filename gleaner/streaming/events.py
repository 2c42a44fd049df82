"""Streaming forms: deduplicated ingestion, windowed counts, archive upserts in micro-batches."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gleaner.operators.rows import new_rows
from gleaner.session import shared_dir
from gleaner.sources import archives


def dedup_stream(stream: DataFrame, key: str, ts: str, late: str = "30 days") -> DataFrame:
    """First row per key within the watermark; state of older keys is dropped."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, ts: str, by: str, width: str = "12 hours", slide: str = "1 hour", late: str = "1 day") -> DataFrame:
    """``win_start, by, n, total`` over sliding windows."""
    rows = stream.withWatermark(ts, late) if stream.isStreaming else stream
    grouped = rows.groupBy(F.window(ts, width, slide), by).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return grouped.select(F.col("window.start").alias("win_start"), by, "n", F.round("total", 4).alias("total"))


def run_to_table(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream over what there is and give its result as a table in the shared folder.

    In complete mode every batch replaces the table, in append mode it adds to it: a batch
    is a folder named by its number, so one that is repeated after a failure replaces itself.
    """
    spark = stream.sparkSession
    path = f"{shared_dir(spark)}/gleaner-stream-{uuid.uuid4().hex}"

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/rows/{0 if mode == 'complete' else number}")

    query = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception():
        raise RuntimeError(str(query.exception()))
    return spark.read.schema(stream.schema).option("recursiveFileLookup", "true").parquet(f"{path}/rows")


def upsert_stream(stream: DataFrame, path: str, checkpoint: str, key: str = "link") -> StreamingQuery:
    """Append only rows with a key that the archive lacks, batch by batch.

    Rows are marked as seen by standing in the archive, so a batch that fails is
    new again.
    """

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        seen = archives.read_archive(spark, path, batch.limit(0).schema)
        new_rows(batch, seen, key).dropDuplicates([key]).write.mode("append").parquet(path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
