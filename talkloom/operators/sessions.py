"""Sessions: coercion of raw records, cleaning, deduplication, union with recordings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkloom.functions.text import clean, clean_each, filled, or_else, strip
from talkloom.operators.ordering import keep_first

SPEAKERS = "array<struct<name:string,company:string>>"


def speakers_from_json(raw: Column) -> Column:
    """Speakers given as JSON: text of names with commas, a list of names, or a list of objects."""
    objects = F.from_json(raw, SPEAKERS)
    named = F.filter(objects, lambda s: s.isNotNull() & (s["name"].isNotNull() | s["company"].isNotNull()))
    texts = F.from_json(raw, "array<string>")
    plain = F.when(F.startswith(F.ltrim(raw), F.lit("[")), texts).otherwise(F.split(F.btrim(raw, F.lit('"')), ","))
    by_name = F.transform(plain, lambda n: F.struct(F.trim(n).alias("name"), F.lit("").alias("company")))
    full = F.transform(named, lambda s: F.struct(filled(s["name"]).alias("name"), filled(s["company"]).alias("company")))
    is_objects = F.startswith(F.ltrim(raw), F.lit("[")) & raw.rlike(r"^\s*\[\s*\{")
    empty = F.array().cast(SPEAKERS)
    return F.when(raw.isNull() | (F.trim(raw) == ""), empty).when(is_objects, full).otherwise(by_name).cast(SPEAKERS)


def coerce(raw: DataFrame) -> DataFrame:
    """Raw records, with any of the accepted field names, as sessions. Missing columns count as null."""
    has = {c.lower() for c in raw.columns}
    of = lambda *names: or_else(*(F.col(n) for n in names if n in has)) if any(n in has for n in names) else F.lit("")
    if "speakers" not in has:
        speakers = F.array().cast(SPEAKERS)
    elif raw.schema["speakers"].dataType.simpleString() == "string":
        speakers = speakers_from_json(F.col("speakers"))
    else:
        speakers = F.coalesce(F.col("speakers").cast(SPEAKERS), F.array().cast(SPEAKERS))
    tags = F.coalesce(F.col("tags"), F.array().cast("array<string>")) if "tags" in has else F.array().cast("array<string>")
    return raw.select(
        of("title", "name").alias("title"),
        of("abstract", "description").alias("abstract"),
        speakers.alias("speakers"),
        of("track", "venue").alias("track"),
        of("format").alias("format"),
        of("time", "event_start").alias("time"),
        tags.alias("tags"),
        *(c for c in raw.columns if c.startswith("_")),
    )


def normalize(sessions: DataFrame) -> DataFrame:
    """Clean the text fields and the speakers; time and tags stay as they are."""
    # No Python function may stand in a transform: the speakers' strings are cleaned as two plain arrays.
    of = lambda field: clean_each(F.transform("speakers", lambda s: s[field]))
    each = F.transform(
        F.arrays_zip(of("name").alias("name"), of("company").alias("company")),
        lambda s: F.struct(s["name"].alias("name"), s["company"].alias("company")),
    )
    return sessions.withColumns({c: clean(c) for c in ("title", "abstract", "track", "format")} | {"speakers": each.cast(SPEAKERS)})


def dedup(sessions: DataFrame, position: str = "_pos") -> DataFrame:
    """The first session of each title, whatever its case; blank titles go."""
    return keep_first(sessions, F.lower(F.trim(F.col("title"))), F.col(position))


def with_recordings(sessions: DataFrame, unmatched: DataFrame) -> DataFrame:
    """All sessions and one of format "recording" for each unmatched recording (video_id, title, ...)."""
    made = unmatched.withColumns({"title": or_else(F.trim("title"), F.concat(F.lit("Recording "), F.col("video_id"))), "format": F.lit("recording")})
    return sessions.unionByName(made, allowMissingColumns=True)


def sections_of_interest(talks: DataFrame, shortest: float = 120.0, least_chars: int = 100) -> DataFrame:
    """Talks that are long enough (0 is unknown and stays), have a transcript, and are no ceremony."""
    from talkloom.functions.text import non_analytical

    d = F.coalesce(F.col("duration_sec"), F.lit(0.0))
    return talks.where(~((d > 0) & (d < shortest))).where(F.length(filled("transcript")) >= least_chars).where(~non_analytical("title"))


def prompt_text(most: int = 30_000) -> Column:
    """What a model reads of a talk: transcript, then aligned slides, else slide text and references."""
    part = lambda head, x: F.when(filled(x) != "", F.concat(F.lit(f"[{head}]\n"), x))
    references = F.array_join("slide_references", "\n")
    slides = F.when(filled("slide_aligned") != "", part("SLIDE-ALIGNED CONTENT", F.col("slide_aligned"))).otherwise(
        F.nullif(F.concat_ws("\n\n", part("SLIDE CONTENT", F.col("slide_text")), part("SLIDE REFERENCES", references)), F.lit(""))
    )
    return F.substring(F.concat_ws("\n\n", filled("transcript"), slides), 1, most)


def merge_results(core: DataFrame, signals: DataFrame, key: str = "title") -> DataFrame:
    """The columns of two partial results under one key; what the second has wins."""
    own = [c for c in core.columns if c not in signals.columns or c == key]
    return core.select(own).join(signals, key)


def without_blank_relationships(df: DataFrame, column: str = "relationships") -> DataFrame:
    return df.withColumn(column, F.filter(column, lambda r: strip(r["entity_a"]) != ""))
