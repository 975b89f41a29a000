"""Incremental job: what the talks of each track are about, kept up to date as texts arrive.

A file stream takes the files of the folder that no earlier run has taken, and stops when there is none left; Spark's checkpoint
remembers which. Each batch adds counts, not texts: of each track the talks and, of each keyword, the talks that hold it. A batch
writes into a folder of its own number, so that one that is run again after a crash replaces itself. The board then adds up the
batches: of each track the keywords in most talks (of equal ones the first by code point), with the share of the track's talks.

A keyword is a lower-case run of more than two ASCII letters or digits. Null and blank texts are talks without keywords; talks
without a source are a track of their own (null). Each row is a talk, also when ids repeat.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobs.settings import log, main
from talkloom.functions import text

#: What a batch adds (rows of null keyword count the talks), and the board.
ADDED = "keyword string, talks long, batch long, track string"
BOARD = "keyword string, talks long, of_talks long, percent double, rank int, track string"


def counted(docs: DataFrame) -> DataFrame:
    """(track, keyword, talks) of a batch; a null keyword for all talks of the track."""
    each = F.concat(F.array(F.lit(None).cast("string")), text.tokens("text"))
    return docs.select(F.col("source").alias("track"), F.explode(each).alias("keyword")).groupBy("track", "keyword").agg(F.count("*").alias("talks"))


def board(added: DataFrame, shown: int, least_talks: int) -> DataFrame:
    """The board from all that batches have added."""
    sums = added.groupBy("track", "keyword").agg(F.sum("talks").alias("talks"))
    track = F.coalesce(F.concat(F.lit("="), "track"), F.lit(""))  # joins null to null
    of_track = sums.where("keyword is null").select(track.alias("__track"), F.col("talks").alias("of_talks"))
    nth = F.row_number().over(Window.partitionBy("track").orderBy(F.desc("talks"), "keyword"))
    top = sums.where(F.col("keyword").isNotNull() & (F.col("talks") >= least_talks)).withColumn("rank", nth).where(F.col("rank") <= shown)
    got = top.withColumn("__track", track).join(of_track, "__track")
    return got.select("keyword", "talks", "of_talks", F.round(100 * F.col("talks") / F.col("of_talks"), 2).alias("percent"), "rank", "track")


def pattern(path: str) -> str:
    """A pattern that matches the path alone: streams take a file only by a pattern, and a folder either way."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def run(
    spark: SparkSession, documents: str, output: str, checkpoint: str, shown: int = 50, least_talks: int = 2, files: int = 64
) -> dict[str, int]:
    """Add the talks that have arrived to the keyword board. Gives the numbers of batches and rows read and of rows on the board."""
    arriving = spark.readStream.schema(spark.read.parquet(documents).schema).option("maxFilesPerTrigger", files).parquet(pattern(documents))

    def add(batch: DataFrame, number: int) -> None:
        rows = counted(batch).withColumn("batch", F.lit(number).cast("long")).select([x.split()[0] for x in ADDED.split(", ")])
        writer = rows.hint("rebalance", "track").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch", "track").parquet(f"{output}/added")

    query = (
        arriving.select("source", "text")
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    batches = [p for p in query.recentProgress if p["numInputRows"] > 0]
    added = spark.read.schema(ADDED).parquet(f"{output}/added")
    rows = board(added, shown, least_talks)
    rows.hint("rebalance", "track").write.mode("overwrite").partitionBy("track").parquet(f"{output}/board")
    found = {"batches": len(batches), "documents": sum(p["numInputRows"] for p in batches), "board": read(spark, output).count()}
    log.info("keyword_board read %(documents)d new documents in %(batches)d batches, wrote %(board)d rows of the board", found)
    return found


def read(spark: SparkSession, output: str) -> DataFrame:
    """The board."""
    return spark.read.schema(BOARD).parquet(f"{output}/board")


if __name__ == "__main__":
    sys.exit(main("keyword_board", run, ("documents", "output", "checkpoint"), ("shown", "least_talks", "files")))
