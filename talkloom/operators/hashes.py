"""Greedy removal of near-equal frames, by multi-index hashing and rounds of joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rounds that decide by the least place of each band's frames alone, and rounds over links; what waits longer is decided by components.
QUICK, ROUNDS = 2, 6
#: Bands of fewer bits tell too little apart to be worth several meetings of a pair: then all frames of a video meet once.
NARROW = 4


def bands(h: Column, most: int) -> Column:
    """(band, value) of a 64-bit hash in one band more than ``most``: hashes that differ in ``most`` bits or fewer agree in some band."""
    if 64 // (most + 1) < NARROW:
        return F.array(F.struct(F.lit(0).alias("band"), F.lit(0).cast("long").alias("value")))
    ends = [64 * i // (most + 1) for i in range(most + 2)]
    part = [F.shiftrightunsigned(h, a).bitwiseAND(F.lit((1 << b - a) - 1)) if b - a < 64 else h for a, b in zip(ends, ends[1:])]
    return F.array(*(F.struct(F.lit(i).alias("band"), x.alias("value")) for i, x in enumerate(part)))


def _place(of: str = "") -> Column:
    """What frames of a video are ordered by: those without a place come last, those of one place go by their hash."""
    return F.struct(F.col(f"at{of}").isNull().alias("last"), F.col(f"at{of}").alias("at"), F.col(f"h{of}").alias("h"))


def _near(a: DataFrame, b: DataFrame, most: int) -> DataFrame:
    """Pairs of rows (video, at, h, ...) of one video whose hashes differ in ``most`` bits or fewer, met in a band; columns of b end in _b."""
    named = b.toDF(*(c if c in ("video", "band", "value") else f"{c}_b" for c in b.columns))
    return a.join(named, ["video", "band", "value"]).where(F.bit_count(F.col("h").bitwiseXOR(F.col("h_b"))) <= most)


def _banded(nodes: DataFrame, most: int) -> DataFrame:
    return nodes.select("video", "at", "h", F.inline(bands(F.col("h"), most)))


def first_apart(nodes: DataFrame, most: int) -> DataFrame:
    """Of nodes (video, at, h): those that differ in more than ``most`` bits from every one kept before them in their video.

    These are the lexicographically first maximal independent set of the graph of near pairs. A node without an undecided
    earlier neighbour is kept, and its neighbours go; all such nodes are decided at once. The first rounds ask no more than
    whether a node comes first in all of its bands, which takes no pairs, so that what is alike many times over goes before
    pairs are made. Then pairs are made once and rounds run over them. Nodes that wait for each other in longer chains are
    decided in order within their connected component, whose kept hashes are all that a task holds.
    """
    from talkloom.operators.components import components
    from talkloom.sources.artifacts import checkpointed

    place, left, kept = _place(), checkpointed(nodes), []
    for _ in range(QUICK if 64 // (most + 1) >= NARROW else 0):
        keyed = _banded(left, most).withColumn("place", place)
        least = keyed.groupBy("video", "band", "value").agg(F.min("place").alias("least"))
        first = keyed.join(least, ["video", "band", "value"]).groupBy("video", "at", "h").agg(F.bool_and(F.col("place") == F.col("least")).alias("first"))
        now = checkpointed(first.where("first").select("video", "at", "h"))
        kept.append(now)
        near = _near(_banded(left, most), _banded(now, most), most).select("video", "h").distinct()  # the kept ones are near themselves
        left = checkpointed(left.join(near, ["video", "h"], "left_anti"))
    pairs = _near(_banded(left, most), _banded(left, most), most).where(_place("_b") < place)
    links = checkpointed(pairs.select("video", "h", F.col("h_b").alias("before")).distinct())
    for _ in range(ROUNDS):
        if left.isEmpty():
            break
        now = checkpointed(left.join(links.select("video", "h").distinct(), ["video", "h"], "left_anti"))
        kept.append(now)
        gone = links.join(now.select("video", F.col("h").alias("before")), ["video", "before"], "left_semi").select("video", "h").distinct()
        out = now.select("video", "h").unionByName(gone)
        left = checkpointed(left.join(out, ["video", "h"], "left_anti"))
        alive = left.select("video", "h")
        links = links.join(alive, ["video", "h"], "left_semi").join(alive.withColumnRenamed("h", "before"), ["video", "before"], "left_semi")
        links = checkpointed(links.select("video", "h", "before"))
    rest = left
    if not left.isEmpty():
        name = lambda h: F.concat_ws("\x00", F.col("video"), F.col(h).cast("string"))
        member = components(links.select(name("h").alias("u"), name("before").alias("v")), "u", "v")
        # Whoever's earlier neighbours have all gone in the last round has no link left, and is a component of its own.
        rest = left.join(member, name("h") == F.col("node"), "left").select(F.coalesce("root", name("h")).alias("root"), "at", "h", "video")
        rest = rest.repartition("root").sortWithinPartitions("root", F.asc_nulls_last("at"), "h").mapInArrow(_fold(most), rest.schema).select("video", "at", "h")
    for more in kept:
        rest = rest.unionByName(more)
    return rest


def _fold(most: int):
    """Rows (root, at, h, ...) in order: those that are apart from all kept before them under their root."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n, kept = None, 0, np.zeros(64, np.uint64)
        for batch in batches:
            keep = []
            for root, value in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if root != now:
                    now, n = root, 0
                h = np.uint64(value & 0xFFFFFFFFFFFFFFFF)
                keep.append(not (np.bitwise_count(kept[:n] ^ h) <= most).any())
                if keep[-1]:
                    if n == len(kept):
                        kept = np.concatenate([kept, np.zeros_like(kept)])
                    kept[n] = h
                    n += 1
            yield batch.filter(pa.array(keep, pa.bool_()))

    return fold


def dedup_frames(frames: DataFrame, most: int = 6, key: str = "video_id", order: str = "index", hash_col: str = "dhash") -> DataFrame:
    """Frames that differ in more than ``most`` bits from every frame kept before them in their video.

    Equal hashes of a video are one, at its first place; frames of one place go by their hash, those without a place come last.
    Frames without a hash stay.
    """
    video = F.when(F.col(key).isNull(), "").otherwise(F.concat(F.lit("="), F.col(key).cast("string"))).alias("video")
    hashed = frames.where(F.col(hash_col).isNotNull())
    nodes = hashed.groupBy(video, F.col(hash_col).cast("long").alias("h")).agg(F.min(order).alias("at")).select("video", "at", "h")
    kept = first_apart(nodes, most).select(F.col("video").alias("__video"), F.col("at").alias("__at"), F.col("h").alias("__h"))
    same = (F.col("__video") == video) & F.col(hash_col).cast("long").eqNullSafe(F.col("__h")) & F.col(order).eqNullSafe(F.col("__at"))
    one = hashed.join(kept, same, "left_semi").dropDuplicates([key, order, hash_col])
    return one.unionByName(frames.where(F.col(hash_col).isNull()))
