"""Scene cuts against a plain fold over each video's frames."""

import random

import pytest

from talkloom.functions import vector
from talkloom.operators import scenes


def plain(frames, thresholds, apart):
    out = []
    for video in sorted({f[0] for f in frames if f[0] is not None}):
        mine = sorted((at, px) for v, at, px in frames if v == video and at is not None and px is not None)
        if not mine:
            continue
        kept, before = [mine[0][0]], mine[0][1]
        for at, px in mine[1:]:
            n = max(len(px), len(before))
            pad = lambda a: list(a) + [0] * (n - len(a))
            score = sum(abs(a - b) for a, b in zip(pad(px), pad(before))) / n if n else 0.0
            before = px
            if score >= thresholds.get(video, 27.0) and at - kept[-1] >= apart:
                kept.append(at)
        out += [(video, i, at) for i, at in enumerate(kept)] if len(kept) > 1 else []
    return out


DDL = "video_id string, at long, pixels array<int>, extra string"


@pytest.mark.parametrize("stretch", [3, 16, 1024])
@pytest.mark.parametrize("apart", [1, 15])
def test_cuts_are_those_of_the_fold(spark, stretch, apart):
    rng, frames = random.Random(stretch * apart), []
    for video, n, lively in (("a", 400, 0.3), ("b", 90, 1.0), ("c", 60, 0.0), ("d", 1, 1.0), ("long gaps", 40, 0.8)):
        px = [0, 0, 0]
        for i in range(n):
            if rng.random() < lively:
                px = [rng.randrange(200) for _ in px]
            frames.append((video, i * (37 if video == "long gaps" else 1), list(px)))
    frames += [("a", 5, None), ("a", None, [1, 1, 1]), (None, 3, [9, 9, 9]), ("e", 0, []), ("e", 20, []), ("e", 40, [255] * 5), frames[7]]
    known = {"a": 60.0}
    df = spark.createDataFrame([(*f, "x") for f in rng.sample(frames, len(frames))], DDL).repartition(3)
    got = scenes.cuts(df, spark.createDataFrame(list(known.items()), "video_id string, threshold double"), apart=apart, stretch=stretch)
    assert sorted((r["video_id"], r["index"], r["at"]) for r in got.collect()) == plain(frames, known, apart)
    assert scenes.cuts(df.limit(0)).count() == 0


def test_a_video_of_cuts_alone_keeps_every_fifteenth(spark):
    df = spark.range(500).selectExpr("'v' AS video_id", "id AS at", "array(cast(id % 2 * 255 as int)) AS pixels")
    assert [r["at"] for r in scenes.cuts(df, stretch=50).orderBy("at").collect()] == list(range(0, 500, 15))


def test_difference_hash(spark):
    rising, falling = list(range(72)), list(range(72, 0, -1))
    one = [0] * 72
    one[1] = 5  # brighter than its left neighbour, and the right one is darker
    df = spark.createDataFrame([(0, rising), (1, falling), (2, one), (3, [1] * 71), (4, None)], "i int, grey array<int>")
    got = {r["i"]: r["h"] for r in df.select("i", vector.difference_hash(df["grey"]).alias("h")).collect()}
    assert got == {0: -1, 1: 0, 2: 1, 3: None, 4: None}
