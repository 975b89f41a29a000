"""Alignment of timed segments with slides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkloom.functions.text import filled, strip
from talkloom.functions.time import minutes_m


def backward_as_of(events: DataFrame, marks: DataFrame, key: str, ts: str, mark_ts: str, mark_cols: list[str]) -> DataFrame:
    """Each event with the columns of the latest mark of its key at or before its time; events before the first mark go.

    Both tables are laid in one order and the last mark is carried forward: a single shuffle on the key and no range
    join, whose candidates would grow with the square of a key's rows.
    """
    carried = F.struct(*(F.col(c) for c in mark_cols))
    m = marks.select(F.col(key), F.col(mark_ts).alias("__ts"), carried.alias("__mark"), F.lit(0).alias("__kind"))
    kind = m.schema["__mark"].dataType
    e = events.select(
        F.col(key),
        F.col(ts).alias("__ts"),
        F.lit(None).cast(kind).alias("__mark"),
        F.lit(1).alias("__kind"),
        F.struct(*(F.col(c) for c in events.columns)).alias("__event"),
    )
    m = m.withColumn("__event", F.lit(None).cast(e.schema["__event"].dataType))
    w = Window.partitionBy(key).orderBy("__ts", "__kind", "__mark").rowsBetween(Window.unboundedPreceding, 0)
    both = m.unionByName(e).withColumn("__last", F.last("__mark", ignorenulls=True).over(w))
    hits = both.where("__kind = 1 and __last is not null")
    return hits.select("__event.*", *(F.col(f"__last.{c}").alias(f"{c}_mark" if c in events.columns else c) for c in mark_cols))


def active_spans(slides: DataFrame, key: str = "video_id", ts: str = "ts", order: str = "pos") -> DataFrame:
    """Add until: the time of the next slide, null (no end) for the last."""
    return slides.withColumn("until", F.lead(ts).over(Window.partitionBy(key).orderBy(ts, order)))


def slide_header(pos: Column, ts: Column) -> Column:
    return F.concat(F.lit("[SLIDE "), (pos + 1).cast("string"), F.lit(" at "), minutes_m(ts), F.lit("]"))


def aligned_text(slides: DataFrame, segments: DataFrame) -> DataFrame:
    """(video_id, slide_aligned): slides in time order, each followed by what was said while it stood.

    slides: video_id, pos, ts, text, description. segments: video_id, seq, start, text, speaker. Videos that lack either
    have no row. Blank segments say nothing.
    """
    said = segments.where(strip("text") != "")
    line = F.when(filled("speaker") != "", F.concat(F.lit("["), F.col("speaker"), F.lit("] "), strip("text"))).otherwise(strip("text"))
    said = said.select("video_id", "seq", "start", line.alias("line"))
    under = backward_as_of(said, slides.select("video_id", "ts", "pos"), "video_id", "start", "ts", ["ts", "pos"])
    spoken = under.groupBy("video_id", "pos").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "seq", "line"))), lambda r: r["line"]), "\n").alias("spoken")
    )
    both = slides.join(segments.select("video_id").distinct(), "video_id", "left_semi").join(spoken, ["video_id", "pos"], "left")
    part = lambda head, x: F.when(strip(x) != "", F.concat(F.lit(head), strip(x)))
    block = F.concat_ws(
        "\n",
        slide_header(F.col("pos"), F.col("ts")),
        part("OCR: ", F.col("text")),
        part("VLM: ", F.col("description")),
        F.when(F.col("spoken").isNotNull(), F.concat(F.lit("[TRANSCRIPT]\n"), F.col("spoken"))),
    )
    rows = F.array_sort(F.collect_list(F.struct("ts", "pos", block.alias("block"))))
    return both.groupBy("video_id").agg(F.array_join(F.transform(rows, lambda r: r["block"]), "\n\n").alias("slide_aligned"))
