"""Transcript segments and vectors from files that arrive while the stream runs (an extension, not parity)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from talkloom.operators import chunks
from talkloom.operators.chunks import OVERLAP, WINDOW


def arriving(spark: SparkSession, folder: str, ddl: str | T.StructType, kind: str = "parquet", files: int = 16) -> DataFrame:
    """Rows of files in a folder, in order of arrival."""
    return spark.readStream.schema(ddl).format(kind).option("maxFilesPerTrigger", files).load(folder)


def first_seen(stream: DataFrame, key: str, time: str, late: str = "1 hour") -> DataFrame:
    """Each key once, as long as its repetitions come within the watermark."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def counts_by_window(stream: DataFrame, time: str, key: str, width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Rows of each key in tumbling windows of event time."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count("*").alias("n"))


def rolling_chunks(stream: DataFrame, key: str, order: str, text: str, start: str, window: int = WINDOW, overlap: int = OVERLAP, idle_ms: int = 0) -> DataFrame:
    """(key, chunk_index, start_time, text): full chunks of transcripts as their segments come. The state is one buffer a key.

    Segments of one key must come in order over batches; within a batch they are sorted. A key that has had no segment for
    ``idle_ms`` gives its last, unfilled buffer, if that holds more than an overlap, and its state goes; with 0 it waits on.
    """
    kind = stream.schema[key].dataType.simpleString()

    def step(keys: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        buffer, began, index, fresh = state.get if state.exists else ("", 0.0, 0, False)
        out = []
        if state.hasTimedOut:
            if fresh:
                out.append((keys[0], index, began, buffer.strip()))
            state.remove()
        else:
            rows = pd.concat(list(batches)).sort_values("o")
            for s, x in zip(rows["s"], rows["t"]):
                if not buffer:
                    began = float(s)
                buffer, fresh = f"{buffer} {x}" if buffer else x, True
                if len(buffer) >= window:
                    out.append((keys[0], index, began, buffer.strip()))
                    index, fresh = index + 1, False
                    buffer, began = (buffer[-overlap:], float(s)) if len(buffer) > overlap else ("", 0.0)
            state.update((buffer, began, index, fresh))
            if idle_ms:
                state.setTimeoutDuration(idle_ms)
        yield pd.DataFrame(out, columns=[key, "chunk_index", "start_time", "text"])

    laid = stream.select(key, F.col(order).alias("o"), F.col(start).cast("double").alias("s"), F.col(text).alias("t"))
    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle_ms else GroupStateTimeout.NoTimeout
    shape, held = f"`{key}` {kind}, chunk_index int, start_time double, text string", "buffer string, began double, n int, fresh boolean"
    return laid.groupBy(key).applyInPandasWithState(step, shape, held, "append", timeout)


def keep_chunks(
    spark: SparkSession,
    folder: str,
    ddl: str | T.StructType,
    out: str,
    checkpoint: str,
    key: str,
    order: str,
    text: str,
    start: str,
    window: int = WINDOW,
    overlap: int = OVERLAP,
    buckets: int = 64,
    files: int = 16,
) -> int:
    """Bring the table of chunks under ``out`` up to the files of segments that have arrived; gives the rows read.

    Segments may come late and in any order: a batch stores its segments by bucket of their key, under its own name, and writes the
    chunks of those buckets anew, the last and unfilled ones included. A batch that is run again overwrites what it had written,
    so that after a crash the table is what it would have been. It equals ``chunks.windows`` of all segments so far. Rows
    without a key go.
    """
    columns = list(dict.fromkeys([key, order, text, start]))
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")

    def each(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        name = f"{session.sparkContext.getLocalProperty('sql.streaming.queryId')}-{number}"
        rows = batch.where(F.col(key).isNotNull()).select(*columns, bucket, F.lit(name).alias("batch"))
        stored, laid = f"{out}/segments", f"{out}/chunks"
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(stored)
        held = session.read.schema(rows.schema).parquet(stored)
        touched = [r["bucket"] for r in held.where(F.col("batch") == name).select("bucket").distinct().collect()]  # at most ``buckets``
        made = chunks.windows(held.where(F.col("bucket").isin(touched)), key, order, text, start, window, overlap).withColumn("bucket", bucket)
        made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(laid)

    stream = arriving(spark, folder, ddl, files=files)
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def into_table(stream: DataFrame, path: str, checkpoint: str, once: bool = True):
    """Append to a table, exactly once for each batch."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()
