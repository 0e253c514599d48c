"""Resumable ingestion as a stream: what a checkpoint has seen isn't read again, and errors go to a sink of their own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from marlstone.operators.keyed import by_errors, remaining
from marlstone.sources.sinks import write_json_lines


def ingest(spark: SparkSession, source: str, schema: str, key: str, errors: Callable[[DataFrame], Column], good: str, bad: str, checkpoint: str, files_per_batch: int = 16) -> StreamingQuery:
    """Read new JSON-lines files of ``source`` until there are no more, and append their valid and broken records to two folders.

    Files already read are known from ``checkpoint``; records already written are known from ``good`` (a batch that was
    cut off and runs again adds none twice). Work in flight is bounded by ``files_per_batch``.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(source)

    def write(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        at = session.sparkContext._jvm.org.apache.hadoop.fs.Path(good)
        there = at.getFileSystem(session.sparkContext._jsc.hadoopConfiguration()).exists(at)
        new = remaining(batch, session.read.schema(schema).json(good), key) if there else batch
        marked = new.withColumn("errors", errors(new)).persist()
        fine, dead = by_errors(marked)
        write_json_lines(fine, good, "append")
        write_json_lines(dead, bad, "append")
        marked.unpersist()

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_counts(spark: SparkSession, rows: DataFrame, at: str, by: list[str], every: str = "1 hour", late: str = "7 days") -> DataFrame:
    """Counts by event-time window of a stream (or a table), for records that arrive up to ``late`` behind."""
    timed = rows.withColumn(at, F.col(at).cast("timestamp"))
    marked = timed.withWatermark(at, late) if rows.isStreaming else timed
    return marked.groupBy(F.window(at, every).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *by, "n")
