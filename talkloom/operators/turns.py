"""Who said what: segments of a transcript and the turns of its speakers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Seconds of a bin in which segments and turns meet.
WIDTH = 30


def with_speakers(segments: DataFrame, turns: DataFrame, key: str = "video_id", place: str = "i", width: float = WIDTH) -> DataFrame:
    """segments (key, place, start, end, ...) with ``speaker``: whose turns overlap the segment longest, all of a speaker's together;
    of equal ones whose overlapping turn begins first, then the first by name. Null where no turn overlaps.

    turns: key, start, end, speaker; those without a speaker are nobody's. Both sides are laid into bins of time, so that they
    meet by an equi-join; a pair that shares several bins counts in the first. A bin that many share is split as any other join.
    """
    bins = lambda: F.sequence(F.floor(F.col("start") / width), F.floor(F.col("end") / width))
    first = lambda: F.floor(F.col("start") / width)
    sound = (F.col("end") > F.col("start")) & F.col(key).isNotNull()
    laid = segments.where(sound).select(key, place, "start", "end", first().alias("first"), F.explode(bins()).alias("bin"))
    said = turns.where(sound & F.col("speaker").isNotNull()).select(
        key, F.col("start").alias("t_start"), F.col("end").alias("t_end"), "speaker", first().alias("t_first"), F.explode(bins()).alias("bin")
    )
    met = laid.join(said, [key, "bin"]).where(F.col("bin") == F.greatest("first", "t_first"))
    shared = F.least("end", "t_end") - F.greatest("start", "t_start")
    sums = met.where(shared > 0).groupBy(key, place, "speaker").agg(F.sum(shared).alias("shared"), F.min("t_start").alias("begins"))
    best = sums.groupBy(key, place).agg(F.min(F.struct((-F.col("shared")).alias("less"), "begins", "speaker"))["speaker"].alias("speaker"))
    return segments.join(best, [key, place], "left")
