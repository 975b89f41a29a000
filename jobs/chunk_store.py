"""Batch job: the chunks that questions about talks are answered from.

Talks come as texts (documents: doc_id, text, source) whose lines are segments, and as dialogues (conversations: conv_id, turn,
text) whose turns are. Segments in order fill windows that overlap, as the library's chunks do; the source is a talk's track. The
store has a folder for each kind and track, so that a question about one track reads that track alone, and beside it an
inventory of what it holds.

Blank segments give nothing. Rows without an id give nothing. A talk without a source has a null track, dialogues have none.
Documents that share an id are one talk: repeated segments stay once, in order of place and then text. A rerun replaces the
store by an equal one.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.settings import log, main
from talkloom.operators import chunks
from talkloom.sources.artifacts import stored

#: What the store's tables hold.
STORE = "id string, talk string, chunk_index int, start_time double, text string, chunk_type string, track string"
INVENTORY = "chunk_type string, track string, talks long, chunks long, characters long"
SPACE = " \t\n\r"


def segments(rows: DataFrame, key: str, place: Column, text: Column, track: Column) -> DataFrame:
    """(talk, place, text) of the segments that aren't blank; a talk is its id and its track."""
    talk = F.struct(F.col(key).cast("string").alias("id"), track.cast("string").alias("track"))
    laid = rows.where(F.col(key).isNotNull()).select(talk.alias("talk"), place.alias("place"), F.btrim(text, F.lit(SPACE)).alias("text"))
    return laid.where("text <> ''")


def windowed(laid: DataFrame, kind: str, window: int, overlap: int, together: bool = False) -> DataFrame:
    got = chunks.windows(laid, "talk", "place", "text", "place", window, overlap, once=True, together=together)
    name = F.concat(F.lit(f"{kind}:"), F.col("talk.id"), F.lit(":"), F.col("chunk_index").cast("string"))
    return got.select(
        name.alias("id"), F.col("talk.id").alias("talk"), "chunk_index", "start_time", "text", F.lit(kind).alias("chunk_type"), F.col("talk.track").alias("track")
    )


def told(docs: DataFrame, window: int, overlap: int) -> DataFrame:
    """The chunks of texts. A document's lines stand in order where it is read, so that only documents that share an id are moved."""
    again = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"), F.min("source").alias("track")).where("n > 1")
    again = stored(again.select("doc_id", "track"))  # by its size Spark tells whether the others must be moved to be told apart
    lines = lambda rows, track: segments(
        rows.select("doc_id", track, F.posexplode(F.split("text", "\n")).alias("place", "line")), "doc_id", F.col("place").cast("long"), F.col("line"), F.col(track)
    )
    alone = lines(docs.join(again.select("doc_id"), "doc_id", "left_anti"), "source")
    shared = lines(docs.drop("source").join(again, "doc_id"), "track")
    return windowed(alone, "talk_text", window, overlap, together=True).unionByName(windowed(shared, "talk_text", window, overlap))


def run(spark: SparkSession, documents: str, conversations: str, output: str, window: int = chunks.WINDOW, overlap: int = chunks.OVERLAP) -> dict[str, int]:
    """Build the chunk store of talks and dialogues. Gives the numbers of rows read and written."""
    if not 0 <= overlap < window:
        raise ValueError("the overlap must be shorter than the window")
    docs, talks = spark.read.parquet(documents).select("doc_id", "text", "source"), spark.read.parquet(conversations).select("conv_id", "turn", "text")
    turns = segments(talks, "conv_id", F.col("turn").cast("long"), F.col("text"), F.lit(None))
    store = told(docs, window, overlap).unionByName(windowed(turns, "transcript_segment", window, overlap))
    store = store.select([x.split()[0] for x in STORE.split(", ")])
    # A track's rows come together for few files; rebalancing splits a track that is too much for one.
    store.hint("rebalance", "chunk_type", "track").write.mode("overwrite").partitionBy("chunk_type", "track").parquet(f"{output}/chunks")
    held = read(spark, output).groupBy("chunk_type", "track").agg(
        F.count_distinct("talk").alias("talks"), F.count("*").alias("chunks"), F.sum(F.length("text")).cast("long").alias("characters")
    )
    held.coalesce(1).write.mode("overwrite").parquet(f"{output}/inventory")  # a row for each kind and track
    # Counts of Parquet rows read the files' footers alone.
    found = {"documents": docs.count(), "conversations": talks.count(), "chunks": read(spark, output).count()}
    log.info("chunk_store read %(documents)d documents and %(conversations)d turns, wrote %(chunks)d chunks", found)
    return found


def read(spark: SparkSession, output: str) -> DataFrame:
    """The store's chunks."""
    return spark.read.schema(STORE).parquet(f"{output}/chunks")


if __name__ == "__main__":
    sys.exit(main("chunk_store", run, ("documents", "conversations", "output"), ("window", "overlap")))
