"""Structured Streaming jobs over files that keep arriving in a folder."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Text lines of every file that appears in the folder."""
    r = spark.readStream.schema("value string").option("recursiveFileLookup", "true")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.text(path)


def parse_actions(lines: DataFrame) -> DataFrame:
    """(ts, user_id, action, value) from 'date time user action value' lines."""
    p = F.split("value", " ")
    return lines.select(
        F.to_timestamp_ntz(F.concat_ws(" ", p[0], p[1]), F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("ts"),
        p[2].cast("bigint").alias("user_id"), p[3].alias("action"), p[4].cast("double").alias("value"))


def drain(writer) -> StreamingQuery:
    """Process everything that has arrived, then stop."""
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def keep_running(writer, every: str = "30 seconds") -> StreamingQuery:
    """Start a query that looks for new data at every trigger until it is stopped; the handle stops it or waits for it.

    ``processAllAvailable()`` waits for what has arrived, ``awaitTermination(seconds)`` for the end, ``stop()`` ends it. A query
    started again with the same checkpoint goes on where this one stopped.
    """
    return writer.trigger(processingTime=every).start()


def batch_writer(df: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, mode: str = "append"):
    """A writer that applies a batch transformation to each micro-batch and keeps its result under ``batch_id``.

    A batch replayed after a failure overwrites its own folder, so results are exactly-once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)


def to_batches(df: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str,
               mode: str = "append") -> StreamingQuery:
    """``batch_writer`` over everything that has arrived."""
    return drain(batch_writer(df, transform, out, checkpoint, mode))


def count_by(*keys: str) -> Callable[[DataFrame], DataFrame]:
    return lambda batch: batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def top_by_count(key: str, n: int) -> Callable[[DataFrame], DataFrame]:
    return lambda batch: count_by(key)(batch).orderBy(F.desc("n"), key).limit(n)


def file_writer(df: DataFrame, out: str, checkpoint: str):
    """A writer that appends every micro-batch to a Parquet folder."""
    return df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)


def to_files(df: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """``file_writer`` over everything that has arrived."""
    return drain(file_writer(df, out, checkpoint))


def running_counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def sliding_counts(df: DataFrame, key: str, length: str, slide: str, late: str) -> DataFrame:
    """Counts per key in overlapping event-time windows; state older than ``late`` is dropped."""
    timed = df.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    counts = timed.groupBy(F.window("ts", length, slide), key).agg(F.count(F.lit(1)).alias("n"))
    start, end = (F.col(f"window.{edge}").cast("timestamp_ntz").alias(edge) for edge in ("start", "end"))
    return counts.select(start, end, key, "n")


def latest(updates: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Last state of each key among the batches of an update-mode stream."""
    last = F.max_by(F.struct(*values), "batch_id").alias("s")
    return updates.groupBy(*keys).agg(last).select(*keys, *[f"s.{v}" for v in values])


class ProgressTable(StreamingQueryListener):
    """One row per trigger of the session's queries, kept in a folder of JSON lines: nothing is held in memory or cut off.

    ``with ProgressTable(spark, path) as log:`` listens inside the block. A row is written when its trigger is reported, one
    file each, named by run and batch, in whatever file system the folder is.
    """

    SCHEMA = "id string, run_id string, name string, batch_id bigint, at string, rows bigint, seconds double"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.ended = spark, path, set()
        jvm = spark._jvm
        self.folder = jvm.org.apache.hadoop.fs.Path(path)
        self.files = self.folder.getFileSystem(spark._jsc.hadoopConfiguration())
        self.files.mkdirs(self.folder)

    def __enter__(self) -> ProgressTable:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = {"id": str(p.id), "run_id": str(p.runId), "name": p.name, "batch_id": p.batchId, "at": p.timestamp, "rows": p.numInputRows, "seconds": p.batchDuration / 1000}
        # An idle trigger repeats its batch number, so the time is part of the name.
        name = f"{p.runId}-{p.batchId:012d}-{''.join(c for c in p.timestamp if c.isdigit())}.json"
        out = self.files.create(self.spark._jvm.org.apache.hadoop.fs.Path(self.folder, name), True)
        try:
            out.write(bytearray((json.dumps(row) + "\n").encode()))
        finally:
            out.close()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the rows of an ended query are written: its end is reported after its last trigger."""
        end = time.monotonic() + seconds
        while str(query.runId) not in self.ended:
            if time.monotonic() > end:
                raise TimeoutError("the end of the query has not been reported")
            time.sleep(0.05)

    def table(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).json(self.path)
