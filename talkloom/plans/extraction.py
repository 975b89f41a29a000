"""From landed videos to transcripts, slides and descriptions, as a queue of work that a crash loses one batch of.

What is done is kept in tables: ``heard`` (transcripts), ``seen`` (a video's slides), ``pictures`` (the slides' pictures) and
``told`` (descriptions). What failed is in ``extract_errors`` and is tried again by the next run.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkloom.functions import vector
from talkloom.functions.text import filled, strip
from talkloom.functions.time import rounded
from talkloom.operators import hashes, ordering, scenes
from talkloom.plans import media, preflight
from talkloom.plans.config import Config
from talkloom.plans.providers import MediaReader, read_media
from talkloom.schemas import ddl
from talkloom.sources.artifacts import checkpointed
from talkloom.streaming import work

#: Fixed value: videos shorter than these seconds have no slides; those of unknown length (0) have.
SHORTEST = 120
WORK = "step string, video_id string, path string, title string, duration double, index int"
TOLD = "video_id string, index int, description string"
PICTURES = "video_id string, image_file string, content binary"
ERRORS = "step string, video_id string, error string"
#: Rows of decoded frames that go to Spark at a time; a row is a small picture.
ROWS = 256
FRAME = "path string, at long, timestamp_sec double, pixels array<int>, grey array<int>, error string"


class FrameReader(Protocol):
    """Decodes videos."""

    def frames(self, content: bytes, path: str) -> Iterator[tuple[int, float, list[int], list[int]]]:
        """Each frame's number, seconds, small picture (hue, saturation and value of a few hundred pixels) and its grey values in
        eight rows of nine."""
        ...

    def pictures(self, content: bytes, path: str, numbers: list[int]) -> Iterator[tuple[int, bytes]]:
        """Whole pictures of some frames, by their numbers."""
        ...


@dataclass(frozen=True)
class Readers:
    """What makes the reader for each step; steps without one are left out, texts are then empty."""

    speech: Callable[[], MediaReader] | None = None
    video: Callable[[], FrameReader] | None = None
    words: Callable[[], MediaReader] | None = None
    eyes: Callable[[], MediaReader] | None = None
    model: str = ""


def readers(config: Config) -> Readers:
    """Those that this machine has by itself: the command-line recogniser where its programs are there."""
    needs = preflight.checks(config)["speech by the command line"]
    speech = functools.partial(media.CommandLine, language=config.extract.language) if all(needs.values()) else None
    return Readers(speech=speech)


def open_work(videos: DataFrame, heard: DataFrame, seen: DataFrame, use: Readers) -> DataFrame:
    """What is to be done (WORK) of videos (video_id, path, title, duration) with these transcripts and slides."""
    row = lambda df, step: df.select(F.lit(step).alias("step"), "video_id", "path", "title", "duration", F.lit(0).alias("index"))
    parts = []
    if use.speech:
        parts.append(row(ordering.unprocessed(videos, heard, "video_id"), "speech"))
    if use.video:
        long = videos.where(~((F.col("duration") > 0) & (F.col("duration") < SHORTEST)))
        parts.append(row(ordering.unprocessed(long, seen, "video_id"), "frames"))
    if not parts:
        return videos.sparkSession.createDataFrame([], WORK)
    return functools.reduce(DataFrame.unionByName, parts)


def open_descriptions(seen: DataFrame) -> DataFrame:
    """The slides (WORK, path is the picture's) that have a picture and no description."""
    each = seen.select("video_id", F.explode("slides").alias("s")).where((strip("s.description") == "") & (filled("s.image_file") != ""))
    return each.select(
        F.lit("describe").alias("step"), "video_id", F.col("s.image_file").alias("path"), F.lit("").alias("title"), F.lit(0.0).alias("duration"), "s.index"
    )


def described(seen: DataFrame, told: DataFrame) -> DataFrame:
    """Slides with the descriptions (TOLD) that were made since; one that a slide has already stays."""
    each = seen.select("video_id", F.explode("slides").alias("s")).select("video_id", "s.*")
    once = told.groupBy("video_id", "index").agg(F.min("description").alias("later"))
    own = F.when(strip("description") != "", F.col("description")).otherwise(F.coalesce("later", "description"))
    merged = each.join(once, ["video_id", "index"], "left").withColumn("description", own).drop("later")
    slide = F.struct("index", "timestamp_sec", "image_file", "text", "description")
    packed = merged.groupBy("video_id").agg(F.array_sort(F.collect_list(slide)).alias("slides"))
    none = seen.where(F.size("slides") == 0)
    return packed.unionByName(none.select("video_id", "slides"))


def _seen_frames(videos: DataFrame, make: Callable[[], FrameReader]) -> DataFrame:
    """FRAME rows of videos (path, content); a video that fails has a row with its error."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, names = make(), ["path", "at", "timestamp_sec", "pixels", "grey", "error"]
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                rows = []
                try:
                    for frame in reader.frames(content, path):
                        rows.append((path, *frame, None))
                        if len(rows) == ROWS:
                            yield pd.DataFrame(rows, columns=names)
                            rows = []
                except Exception as e:
                    rows.append((path, None, None, None, None, f"{type(e).__name__}: {e}"))
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    return videos.select("path", "content").mapInPandas(each, FRAME)


def _taken_pictures(chosen: DataFrame, make: Callable[[], FrameReader]) -> DataFrame:
    """(path, at, content, error) of chosen frames (path, content, numbers)."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, names = make(), ["path", "at", "content", "error"]
        for batch in batches:
            for path, content, numbers in zip(batch["path"], batch["content"], batch["numbers"]):
                try:
                    for number, picture in reader.pictures(content, path, [int(n) for n in numbers]):
                        yield pd.DataFrame([(path, number, picture, None)], columns=names)
                except Exception as e:
                    yield pd.DataFrame([(path, None, None, f"{type(e).__name__}: {e}")], columns=names)

    return chosen.select("path", "content", "numbers").mapInPandas(each, "path string, at long, content binary, error string")


def slides(todo: DataFrame, videos: DataFrame, use: Readers, threshold: float = scenes.THRESHOLD) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Slides, pictures and failures (video_id, error) of videos (path, content), as ``todo`` (video_id, path, duration) has them.

    A video's frames are cut into scenes, of which near-equal ones count once; only the pictures of these are decoded whole, and
    their texts are read one picture a row, on whatever tasks are free. A video of which anything fails has no slides.
    """
    known = todo.select("video_id", "path", "duration").dropDuplicates(["path"])
    decoded = checkpointed(_seen_frames(videos, use.video).join(known.select("video_id", "path"), "path"))
    failed = decoded.where("error is not null").select("video_id", "path", "error")
    frames = ordering.unprocessed(decoded, failed, "video_id")
    cut = scenes.cuts(frames, scenes.thresholds(known, threshold))
    looks = frames.groupBy("video_id", "at").agg(F.min(F.struct("timestamp_sec", "grey")).alias("l")).select("video_id", "at", "l.*")
    hashed = cut.join(looks, ["video_id", "at"]).withColumn("dhash", vector.difference_hash(F.col("grey"))).drop("grey", "score")
    kept = checkpointed(hashes.dedup_frames(hashed))
    wanted = kept.groupBy("video_id").agg(F.sort_array(F.collect_set("at")).alias("numbers")).join(known, "video_id")
    taken = checkpointed(_taken_pictures(videos.join(wanted, "path"), use.video).join(known.select("video_id", "path"), "path"))
    named = F.format_string("slides/%s/%04d.jpg", "video_id", F.col("index") + 1)
    shown = kept.withColumn("image_file", named).join(taken.where("error is null").select("video_id", "at", "content"), ["video_id", "at"], "left")
    broken = taken.where("error is not null").select("video_id", "path", "error")
    lost = shown.where("content is null").select("video_id", F.lit("no such picture").alias("error"))
    texts = shown.select(F.lit(None).cast("string").alias("image"), F.lit("").alias("text"), F.lit(None).cast("string").alias("fault")).limit(0)
    if use.words:
        spread = shown.where("content is not null").select(F.col("image_file").alias("path"), "content").repartition("path")
        read = checkpointed(read_media(spread, _kind("text string"), use.words))
        texts = read.select(F.col("path").alias("image"), strip("parsed.text").alias("text"), F.col("error").alias("fault"))
    rows = shown.join(texts, F.col("image_file") == F.col("image"), "left").drop("image")
    unread = rows.where("fault is not null").select("video_id", F.col("fault").alias("error"))
    faults = failed.select("video_id", "error").unionByName(broken.select("video_id", "error")).unionByName(lost).unionByName(unread)
    faults = checkpointed(faults.groupBy("video_id").agg(F.min("error").alias("error")))
    good = ordering.unprocessed(rows.withColumn("description", F.lit("")), faults, "video_id")
    good = good.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("timestamp_sec", rounded(F.col("timestamp_sec"), 2))
    packed = media.as_slides(good)
    without = ordering.unprocessed(ordering.unprocessed(known.select("video_id").distinct(), faults, "video_id"), packed, "video_id")
    empty = without.withColumn("slides", F.array().cast(packed.schema["slides"].dataType))
    return packed.unionByName(empty), good.select("video_id", "image_file", "content"), faults


def _kind(fields: str):
    from pyspark.sql import types as T

    return T.StructType.fromDDL(fields)


def answer(batch: DataFrame, use: Readers, pictures: DataFrame, threshold: float = scenes.THRESHOLD) -> dict[str, DataFrame]:
    """What a batch of work (WORK) gives, by table; ``pictures``: those of earlier batches."""
    spark = batch.sparkSession
    batch = checkpointed(batch)
    made = {"heard": ddl("transcript"), "seen": ddl("slides"), "pictures": PICTURES, "told": TOLD, "extract_errors": ERRORS}
    out = {name: spark.createDataFrame([], fields) for name, fields in made.items()}
    errors: list[DataFrame] = []

    def files(step: str) -> DataFrame | None:
        paths = [r["path"] for r in batch.where(F.col("step") == step).select("path").distinct().collect()]  # a batch's
        return spark.read.format("binaryFile").load(paths).select("path", "content") if paths else None

    def fail(df: DataFrame, step: str) -> None:
        errors.append(df.select(F.lit(step).alias("step"), "video_id", "error"))

    if (videos := files("speech")) is not None:
        titles = batch.where("step = 'speech'").select("video_id", "title").dropDuplicates(["video_id"])
        heard, failed = media.transcribe(videos, None, use.speech, use.model, titles)
        out["heard"] = heard.select(_fields(ddl("transcript")))
        fail(failed, "speech")
    if (videos := files("frames")) is not None:
        out["seen"], out["pictures"], failed = slides(batch.where("step = 'frames'"), videos, use, threshold)
        fail(failed, "frames")
    if not (asked := batch.where("step = 'describe'")).isEmpty():
        rows = asked.select("video_id", "index", F.col("path").alias("image_file"), F.lit("").alias("description"))
        images = pictures.join(F.broadcast(rows.select("image_file").distinct()), "image_file", "left_semi")  # a batch's names
        named = images.select(F.col("image_file").alias("path"), "content")
        told, failed = media.describe(rows, named, use.eyes, whole=True)
        out["told"] = told.where("description <> ''").select("video_id", "index", "description")
        fail(failed, "describe")
    if errors:
        out["extract_errors"] = functools.reduce(DataFrame.unionByName, errors)
    return out


def _fields(fields: str) -> list[Column]:
    return [F.col(f.name).cast(f.dataType) for f in _kind(fields).fields]


def drain(spark, folder: str, paths: dict[str, str], use: Readers, threshold: float = scenes.THRESHOLD) -> int:
    """Do what is in the queue; gives the number of rows taken. A batch takes a file for each task that can run at a time."""

    def each(batch: DataFrame) -> dict[str, DataFrame]:
        return answer(batch, use, work.results(spark, paths["pictures"], PICTURES), threshold)

    return work.drain(spark, f"{folder}/extract_work", WORK, f"{folder}/extract_progress", each, paths)
