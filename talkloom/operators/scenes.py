"""Where a video's picture changes: cuts by the difference of each frame from the one before it."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkloom.sources.artifacts import checkpointed

#: The mean difference of pixels that makes a cut, the same for long videos and what is long (seconds), and how
#: many frames a scene lasts at least.
THRESHOLD, LONG_THRESHOLD, LONG, APART = 27.0, 20.0, 300, 15
#: Frame numbers of a stretch of video that one task sees in order.
STRETCH = 1024


def difference(a: Column, b: Column) -> Column:
    """Mean absolute difference of two pictures' values; what one lacks counts as 0. Null if either is, 0 of empty ones."""
    apart = F.zip_with(a, b, lambda x, y: F.abs(F.coalesce(x.cast("double"), F.lit(0.0)) - F.coalesce(y.cast("double"), F.lit(0.0))))
    total = F.aggregate(apart, F.lit(0.0), lambda s, x: s + x)
    return F.when(F.size(apart) == 0, 0.0).otherwise(total / F.size(apart))


def _stretch(at: str, stretch: int) -> Column:
    return F.floor(F.col(at) / stretch).cast("long")


def with_previous(rows: DataFrame, key: str, at: str, value: str, stretch: int = STRETCH) -> DataFrame:
    """rows with ``previous``: ``value`` of the row before in its key's order of ``at`` (then of ``value``); null for the first.

    A key is cut into stretches of ``at``. The last row of each is handed to the next stretch that holds any, so a key of any
    length spreads over tasks, and what moves besides is a row for each stretch. ``rows`` is read twice.
    """
    laid = rows.withColumn("__stretch", _stretch(at, stretch))
    last = laid.groupBy(key, "__stretch").agg(F.max(F.struct(at, value)).alias("__last"))
    later = F.lead("__stretch").over(Window.partitionBy(key).orderBy("__stretch"))
    handed = last.select(key, F.col("__last")[at].alias(at), F.col("__last")[value].alias(value), later.alias("__stretch")).where("__stretch is not null")
    both = laid.withColumn("__handed", F.lit(0)).unionByName(handed.withColumn("__handed", F.lit(1)), allowMissingColumns=True)
    order = Window.partitionBy(key, "__stretch").orderBy(F.desc("__handed"), at, value)
    return both.withColumn("previous", F.lag(value).over(order)).where("__handed = 0").drop("__handed", "__stretch")


def scores(frames: DataFrame, key: str = "video_id", at: str = "at", pixels: str = "pixels", stretch: int = STRETCH) -> DataFrame:
    """(key, at, score) of frames: how far each is from the one before, null for a video's first.

    Frames without a key, number or picture are left out. Of several with one number each counts, in order of their values.
    """
    known = frames.where(F.col(key).isNotNull() & F.col(at).isNotNull() & F.col(pixels).isNotNull()).select(key, at, pixels)
    return with_previous(known, key, at, pixels, stretch).select(key, at, difference(F.col(pixels), F.col("previous")).alias("score"))


def _far_enough(nodes: DataFrame, key: str, at: str, apart: int) -> DataFrame:
    """Of nodes (key, island, at, score): an island's first, and then each that lies ``apart`` after the last one kept.

    Islands stream through sorted; the state is the last number kept.
    """
    sorted_ = nodes.repartition(key, "island").sortWithinPartitions(key, "island", at)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, kept = None, 0
        for batch in batches:
            stays = []
            for here, number in zip(zip(batch[key], batch["island"]), batch[at]):
                stays.append(here != now or number - kept >= apart)
                if stays[-1]:
                    now, kept = here, number
            yield batch[stays]

    return sorted_.mapInPandas(fold, sorted_.schema)


def cuts(
    frames: DataFrame,
    thresholds: DataFrame | None = None,
    key: str = "video_id",
    at: str = "at",
    pixels: str = "pixels",
    apart: int = APART,
    stretch: int = STRETCH,
) -> DataFrame:
    """(key, index, at, score): the first frame of each scene, numbered from 0; a video without a cut has none.

    A cut is a frame whose score reaches its video's threshold, at least ``apart`` frames after the cut before it, where a
    video's first frame counts as one. thresholds: key and threshold, once each; THRESHOLD where that is missing.

    A frame that lies ``apart`` or more after the one before it that reaches the threshold is a cut whatever came earlier. So
    such frames begin islands that are decided each by itself, and a video's spread over tasks.
    """
    scored = scores(frames, key, at, pixels, stretch)
    if thresholds is not None:
        scored = scored.join(thresholds.select(key, "threshold"), key, "left")
    else:
        scored = scored.withColumn("threshold", F.lit(None).cast("double"))
    reached = scored.where(F.col("score").isNull() | (F.col("score") >= F.coalesce("threshold", F.lit(THRESHOLD))))
    # Of one number's frames the first of all counts as such, else the highest score.
    first = F.bool_or(F.col("score").isNull())
    nodes = checkpointed(reached.groupBy(key, at).agg(F.when(~first, F.max("score")).alias("score")))
    before = with_previous(nodes.withColumn("number", F.col(at)), key, at, "number", stretch).withColumn("__stretch", _stretch(at, stretch))
    begins = F.when(F.col("previous").isNull() | (F.col(at) - F.col("previous") >= apart), F.col(at))
    marked = before.withColumn("begins", begins).drop("previous", "number")
    by_stretch = marked.groupBy(key, "__stretch").agg(F.max("begins").alias("begins"))
    earlier = Window.partitionBy(key).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = by_stretch.select(key, "__stretch", F.max("begins").over(earlier).alias("carried"))
    so_far = Window.partitionBy(key, "__stretch").orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = marked.withColumn("own", F.max("begins").over(so_far))
    islands = own.join(carried, [key, "__stretch"]).select(key, F.coalesce("own", "carried").alias("island"), at, "score")
    kept = _far_enough(islands, key, at, apart)
    order = Window.partitionBy(key).orderBy(at)  # a video's scenes, not its frames
    numbered = kept.select(key, (F.row_number().over(order) - 1).alias("index"), at, "score", F.lead(at).over(order).alias("next"))
    return numbered.where("index > 0 or next is not null").drop("next")


def thresholds(meta: DataFrame, threshold: float = THRESHOLD, key: str = "video_id") -> DataFrame:
    """key and the threshold for its duration; long videos are cut more readily."""
    long = F.coalesce("duration", F.lit(0.0)) > LONG
    return meta.select(key, F.when(long, min(threshold, LONG_THRESHOLD)).otherwise(threshold).alias("threshold"))
