"""From landed videos and frames to transcripts and slides. The models are providers; what is here is what goes around them.

Videos and images come as rows (path, content). A reader is made once in each Python worker; what fails is a row with its
error, and what is done already is not read again.
"""

from __future__ import annotations

import json
import subprocess
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom.functions.text import strip
from talkloom.operators import hashes, ordering
from talkloom.operators.scenes import thresholds  # noqa: F401
from talkloom.plans import providers, transcripts
from talkloom.plans.providers import MediaReader
from talkloom.schemas import schema
from talkloom.sources.artifacts import checkpointed

#: Seconds that conversion and recognition may take; what stands for a picture that shows nothing to tell of.
CONVERT_TIMEOUT, RECOGNISE_TIMEOUT = 600, 3600
NO_CONTENT = "[no content]"
FRAMES = "array<struct<index:int,timestamp_sec:double,image_file:string,dhash:bigint,text:string>>"


class CommandLine:
    """The command-line recogniser: audio at 16 kHz by ffmpeg, JSON by whisper-cli. Files live as long as one call."""

    def __init__(self, model: str = "", language: str = "en", run: Callable = subprocess.run):
        self.model, self.language, self.run = model, language, run

    def read(self, content: bytes, path: str) -> str:
        with tempfile.TemporaryDirectory() as folder:
            video, audio, out = Path(folder, Path(path).name), Path(folder, "audio.wav"), Path(folder, "out")
            video.write_bytes(content)
            self._call(["ffmpeg", "-nostdin", "-y", "-i", str(video), "-ar", "16000", "-ac", "1", str(audio)], CONVERT_TIMEOUT)
            self._call(["whisper-cli", "-m", self.model, "-l", self.language, "-oj", "-of", str(out), "-f", str(audio)], RECOGNISE_TIMEOUT)
            return out.with_suffix(".json").read_text(encoding="utf-8")

    def _call(self, command: list[str], seconds: int) -> None:
        done = self.run(command, capture_output=True, timeout=seconds)
        if done.returncode:
            raise RuntimeError(f"{command[0]} failed: {done.stderr.decode('utf-8', 'replace')[-200:]}")


def _named(df: DataFrame) -> DataFrame:
    """With video_id, the file's name without its suffix."""
    return df.withColumn("video_id", F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1))


def transcribe(
    videos: DataFrame,
    done: DataFrame | None = None,
    make: Callable[[], MediaReader] = CommandLine,
    model: str = "",
    titles: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Transcripts of videos (path, content) that are not done by video_id, and failures (video_id, error).

    titles: video_id and title; a video without one is named by its id.
    """
    work = _named(videos)
    work = work if done is None else ordering.unprocessed(work, done, "video_id")
    read = checkpointed(_named(providers.read_media(work, schema("cli_transcript"), make)))
    failed = read.where("error is not null").select("video_id", "error")
    good = read.where("error is null").select("video_id", "parsed.*")
    known = titles if titles is not None else good.limit(0).select("video_id", F.lit("").alias("title"))
    good = good.join(known.select("video_id", "title"), "video_id", "left").withColumn("title", F.coalesce(F.nullif("title", F.lit("")), "video_id"))
    return transcripts.from_cli(good, model), failed


def frames(videos: DataFrame, done: DataFrame | None = None, make: Callable[[], MediaReader] = providers.Unavailable) -> tuple[DataFrame, DataFrame]:
    """(video_id, index, timestamp_sec, image_file, dhash, text) of each video's frames in order, near-equal ones once, and failures.

    A reader returns a JSON list of frames, cut where the picture changes by more than its threshold.
    Frames may come in any order: their times say which is first.
    """
    work = _named(videos)
    work = work if done is None else ordering.unprocessed(work, done, "video_id")
    kind = _struct(f"frames {FRAMES}")
    read = checkpointed(_named(providers.read_media(work, kind, make)))
    failed = read.where("error is not null").select("video_id", "error")
    rows = read.where("error is null").select("video_id", F.explode(F.array_sort("parsed.frames", _by_time)).alias("f")).select("video_id", "f.*")
    return hashes.dedup_frames(rows), failed


def _by_time(a, b):
    less = (a["timestamp_sec"] < b["timestamp_sec"]) | (a["timestamp_sec"] == b["timestamp_sec"]) & (a["index"] < b["index"])
    return F.when(less, F.lit(-1)).when((a["timestamp_sec"] == b["timestamp_sec"]) & (a["index"] == b["index"]), F.lit(0)).otherwise(F.lit(1))


def _struct(ddl: str):
    from pyspark.sql import types as T

    return T.StructType.fromDDL(ddl)


def describe(
    slides: DataFrame, images: DataFrame, make: Callable[[], MediaReader] = providers.Unavailable, whole: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Slides (video_id, index, image_file, description) with descriptions of their pictures, and failures (video_id, index, error).

    images: path, content; a slide's picture is the file of its name, or with ``whole`` the very path. Slides that have a description keep it. An empty answer is NO_CONTENT, so that it is not asked
    for again. A slide whose picture is not there is a failure and stays without a description.
    """
    open_ = slides.where(strip("description") == "").select("image_file").distinct()
    name = F.col("path") if whole else F.regexp_extract("path", r"([^/]+)$", 1)
    wanted = images.withColumn("image", name).join(open_.withColumnRenamed("image_file", "image"), "image", "left_semi")
    read = checkpointed(providers.read_media(wanted, _struct("description string"), make).select(name.alias("image"), "parsed", "error"))
    both = slides.join(read, F.col("image_file") == F.col("image"), "left")
    own = F.when(strip("description") != "", F.col("description")).when(
        F.col("image").isNotNull() & F.col("error").isNull(),
        F.coalesce(F.nullif(strip("parsed.description"), F.lit("")), F.lit(NO_CONTENT)),
    )
    told = both.withColumn("told", own)
    missing = F.when(F.col("image").isNull(), F.lit("no such picture")).otherwise(F.col("error"))
    failed = told.where("told is null").select("video_id", "index", missing.alias("error"))
    return told.withColumn("description", F.coalesce("told", F.lit(""))).select(*slides.columns), failed


def as_slides(rows: DataFrame) -> DataFrame:
    """One row (video_id, slides) for each video, slides in order of their times."""
    one = F.struct(
        F.col("timestamp_sec").alias("at"),
        F.col("index").alias("i"),
        F.struct("index", F.col("timestamp_sec").cast("string").alias("timestamp_sec"), "image_file", "text", "description").alias("s"),
    )
    packed = F.transform(F.array_sort(F.collect_list(one)), lambda r: r["s"])
    return rows.groupBy("video_id").agg(packed.alias("slides"))


def dumps(frames_: list[dict]) -> str:
    """A reader's answer for a video's frames."""
    return json.dumps({"frames": frames_})
