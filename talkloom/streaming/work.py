"""Work that is costly to do twice: a queue of files, answered batch by batch, each batch's results stored once.

The queue is a folder of Parquet files of a few rows. A file stream takes files that no run has taken, some at a time, until none
is left; its checkpoint keeps the progress, so that a run after a crash goes on at the batch that was lost. A batch's results go
into a folder named by stream and batch, which a batch that is run again overwrites. However much work there is, the driver starts
as many jobs for a batch, and no plan grows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.sources.artifacts import exists

#: The column that the results' tables are partitioned by.
BATCH = "batch"


def enqueue(work: DataFrame, queue: str, rows_a_file: int) -> None:
    """Add rows to the queue, so many to a file at most. Nothing is added if the write doesn't end."""
    work.write.mode("append").option("maxRecordsPerFile", rows_a_file).parquet(queue)


def drain(
    spark: SparkSession,
    queue: str,
    ddl: str,
    checkpoint: str,
    answer: Callable[[DataFrame], dict[str, DataFrame]],
    paths: dict[str, str],
    files: int | None = None,
) -> int:
    """Answer what is in the queue and not answered yet; gives the number of rows taken.

    ``answer`` makes of a batch one table for each of ``paths``, which are written in order; they may share work by a
    checkpoint. By default a batch takes one file for each task that can run at a time.
    """
    if not exists(spark, queue):
        return 0
    stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", files or spark.sparkContext.defaultParallelism).parquet(queue)

    def each(batch: DataFrame, number: int) -> None:
        name = f"{batch.sparkSession.sparkContext.getLocalProperty('sql.streaming.queryId')}-{number}"
        for table, rows in answer(batch).items():
            writer = rows.withColumn(BATCH, F.lit(name)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(BATCH).parquet(paths[table])

    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def results(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """All results under a path so far, without the batch they came in; an empty table where there are none."""
    if not exists(spark, path):
        return spark.createDataFrame([], ddl)
    return spark.read.schema(f"{ddl}, {BATCH} string").parquet(path).drop(BATCH)
