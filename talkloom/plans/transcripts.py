"""Shaping of transcripts: what comes after speech recognition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom.functions.time import rounded, rounded_each, stamp
from talkloom.operators.ordering import dense_labels


def from_cli(raw: DataFrame, model: str = "", backend: str = "whisper.cpp") -> DataFrame:
    """The command-line recogniser's output (video_id, title, transcription, result) as a transcript."""
    at = lambda field: rounded_each(F.transform("transcription", lambda e: stamp(e["timestamps"][field])), 2)
    rows = raw.withColumns({"__from": at("from"), "__to": at("to")})
    each = F.transform(
        F.arrays_zip("transcription", "__from", "__to"),
        lambda e: F.struct(
            e["__from"].alias("start"),
            e["__to"].alias("end"),
            F.trim(e["transcription"]["text"]).alias("text"),
            F.lit(None).cast("string").alias("speaker"),
        ),
    )
    return finish(rows.select("video_id", "title", F.coalesce("result.language", F.lit("")).alias("language"), each.alias("segments")), model, backend)


def finish(df: DataFrame, model: str = "", backend: str = "", diarized: bool = False) -> DataFrame:
    """Add duration (the end of the last segment, 0 without any), full text and provenance."""
    said = F.array_join(F.transform("segments", lambda s: s["text"]), " ")
    end = rounded(F.coalesce(F.try_element_at("segments", F.lit(-1))["end"], F.lit(0.0)), 1)
    return df.select(
        "video_id",
        "title",
        "language",
        end.alias("duration_sec"),
        F.lit(model).alias("model"),
        F.lit(backend).alias("backend"),
        F.lit(diarized).alias("diarized"),
        F.coalesce(said, F.lit("")).alias("full_text"),
        "segments",
    )


def label_speakers(df: DataFrame) -> DataFrame:
    """Raw speaker labels within segments become "Speaker n" in their sorted order."""
    rows = df.select("video_id", F.posexplode("segments").alias("i", "s")).select(
        "video_id", "i", "s.start", "s.end", "s.text", F.col("s.speaker").alias("raw")
    )
    named = dense_labels(rows, "video_id", "raw")
    packed = named.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("i", "start", "end", "text", "speaker"))).alias("p"))
    segments = packed.select(
        "video_id",
        F.transform(
            "p",
            lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), r["text"].alias("text"), r["speaker"].alias("speaker")),
        ).alias("segments"),
    )
    return df.drop("segments").join(segments, "video_id", "left")
