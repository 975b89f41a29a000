"""Matching of titles: greedy one-to-one assignment, tiered look-up, token containment."""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkloom.functions.text import filled, title_prefix, tokens

THRESHOLD = 0.6


def ratio(a: str, b: str) -> float:
    return SequenceMatcher(None, a.lower(), b.lower()).ratio()


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity. The order of arguments matters."""
    return pd.Series([ratio(x, y) for x, y in zip(a.fillna(""), b.fillna(""))], dtype="float64")


#: Bits of a number that hold places of a text; the bit above takes the carry of an addition.
BITS = 63


def common_bounds(a: list[str], b: list[str]) -> np.ndarray:
    """For each pair of texts no less than the length of its longest common subsequence: exact but for characters taken as one
    (they agree in their low byte). All pairs advance together, a character of b at a time, by bit operations on as many
    numbers as the lengths of a ask for; pairs of like lengths go together, so that one very long text does not widen others."""
    names, texts = ({x: i for i, x in enumerate(dict.fromkeys(side))} for side in (a, b))
    of_a, of_b = np.array([names[x] for x in a], np.int64), np.array([texts[x] for x in b], np.int64)
    return _common(list(names), list(texts), of_a, of_b)


def _common(names: list[str], texts: list[str], of_a: np.ndarray, of_b: np.ndarray) -> np.ndarray:
    """common_bounds() of pairs of places in two lists."""
    out, n, m = np.zeros(len(of_a), np.int64), np.array([len(x) for x in names])[of_a], np.array([len(x) for x in texts])[of_b]
    words = np.maximum(1, -(-n // BITS))
    left = np.lexsort((m, words))
    while len(left):
        w, widest = int(words[left[0]]), max(64, 2 * int(m[left[0]]))
        mine = (words[left] == w) & (m[left] <= widest)
        here, left = left[mine], left[~mine]
        for at in np.array_split(here, -(-len(here) * w // (1 << 17))):
            own, place = np.unique(of_a[at], return_inverse=True)
            out[at] = _advance([names[i] for i in own], place, texts, of_b[at], w)
    return out


def _advance(names: list[str], of_a: np.ndarray, texts: list[str], of_b: np.ndarray, words: int) -> np.ndarray:
    full, n = np.uint64((1 << BITS) - 1), np.array([len(x) for x in names], np.int64)
    table = np.zeros((words, len(names), 257), np.uint64)  # places of each character in each of a; the last column is for ends of texts
    every = np.zeros((words, len(names)), np.uint64)
    for i, x in enumerate(names):
        for j, c in enumerate(x):
            table[j // BITS, i, ord(c) & 255] |= np.uint64(1 << j % BITS)
        for w in range(words):
            every[w, i] = np.uint64((1 << min(BITS, max(0, len(x) - BITS * w))) - 1)
    used, row = np.unique(of_b, return_inverse=True)
    codes = np.full((max((len(texts[i]) for i in used), default=0), len(used)), 256, np.int64)
    for k, i in enumerate(used):
        codes[: len(texts[i]), k] = np.frombuffer(texts[i].encode("utf-32-le"), np.uint32) & 255
    every, table, base = every[:, of_a], table.reshape(words, -1), of_a * 257
    s = every.copy()
    for of_text in codes:
        at, carry = base + of_text[row], None
        for w in range(words):
            u = s[w] & table[w][at]
            total = s[w] + u if carry is None else s[w] + u + carry
            carry = total >> np.uint64(BITS)
            s[w] = (total & full | s[w] - u) & every[w]
    return n[of_a] - np.bitwise_count(s).sum(axis=0, dtype=np.int64)


#: Titles, characters and pairs that one cell of the grid of similar_pairs() holds at most, but for one title alone.
TITLES, CHARS, PAIRS = 4096, 1 << 22, 50_000


def _histograms(texts: list[str]) -> np.ndarray:
    """Counts of each text's characters, taken as one where they agree in their low six bits."""
    out = np.zeros((len(texts), 64), np.int32)
    for i, x in enumerate(texts):
        out[i] = np.bincount(np.frombuffer(x.encode("utf-32-le"), np.uint32) & 63, minlength=64)
    return out


def above(a: list[str], b: list[str], threshold: float) -> list[tuple[int, int, float]]:
    """(place in a, place in b, ratio) of all pairs above the threshold.

    Matching blocks are a common subsequence: no pair can have more of them than characters in common, nor than its longest
    common subsequence. Both bounds are taken for whole batches; ratios of what is left only.
    """
    of_a, of_b = _histograms(a), _histograms(b)
    lengths, near = np.array([len(x) for x in b]), []
    for i, x in enumerate(a):
        mine = np.flatnonzero(2 * np.minimum(of_b, of_a[i]).sum(axis=1) > threshold * (lengths + len(x)))
        near.append(np.stack([np.full(len(mine), i), mine]))
    left, right = np.concatenate(near, axis=1) if near else np.zeros((2, 0), np.int64)
    both = np.array([len(x) for x in a], np.int64)[left] + lengths[right]
    out = np.flatnonzero(2 * _common(a, b, left, right) > threshold * both)
    found, matcher, last = [], SequenceMatcher(None), -1
    out = out[np.argsort(right[out], kind="stable")]
    for i, j in zip(left[out].tolist(), right[out].tolist()):  # what a matcher learns of its second text serves all pairs with it
        if j != last:
            matcher.set_seq2(b[j])
            last = j
        matcher.set_seq1(a[i])
        if (score := matcher.ratio()) > threshold:
            found.append((i, j, score))
    return found


def similar_pairs(left: DataFrame, right: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(left_id, right_id, score) of all pairs of titles above the threshold; columns id and title on both sides.

    Equal titles are one until the end. Lengths of a pair above the threshold t differ by at most the factor (2 - t) / t, so
    titles meet in classes of length, and within a class in a grid of cells: slices of one side with slices of the other.
    Texts are dealt out once for each cell; pairs never move, only what is above the threshold does.
    """
    step = F.log(F.lit((2 - threshold) / threshold))

    def side(df: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows = df.select("id", F.lower("title").alias("text")).where("text <> ''").withColumn("key", F.md5("text"))
        return rows.select("id", "key"), rows.groupBy("key").agg(F.first("text").alias("text"))

    left_ids, a = side(left)
    right_ids, b = side(right)
    a = a.withColumn("class", F.floor(F.log(F.length("text")) / step))
    near = F.floor(F.log(F.length("text")) / step)
    b = b.withColumn("class", F.explode(F.array(near - 1, near, near + 1)))
    size = lambda df, x: df.groupBy("class").agg(F.count("*").alias(f"n_{x}"), F.sum(F.length("text")).alias(f"c_{x}"))
    rows = lambda x: F.greatest(F.ceil(F.col(f"n_{x}") / TITLES), F.ceil(F.col(f"c_{x}") / CHARS))
    # One row for each class: their number is the logarithm of the longest title.
    grid = size(a, "a").join(size(b, "b"), "class").withColumn("k_a", rows("a").cast("int"))
    grid = grid.withColumn("k_b", F.greatest(rows("b"), F.ceil(F.col("n_a") / F.col("k_a") * F.col("n_b") / PAIRS)).cast("int"))
    grid = F.broadcast(grid.select("class", "k_a", "k_b"))
    slice_of = lambda k: F.pmod(F.xxhash64("key"), F.col(k)).cast("int")
    across = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    cells_a = a.join(grid, "class").withColumn("i", slice_of("k_a")).withColumn("j", across("k_b")).select("class", "i", "j", "key", "text")
    cells_b = b.join(grid, "class").withColumn("j", slice_of("k_b")).withColumn("i", across("k_a")).select("class", "i", "j", "key", "text")

    def cell(x: pa.Table, y: pa.Table) -> pa.Table:
        found = above(x.column("text").to_pylist(), y.column("text").to_pylist(), threshold)
        at = [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)]
        return pa.table([x.column("key").take(at[0]), y.column("key").take(at[1]), pa.array([f[2] for f in found], pa.float64())], names=["a", "b", "score"])

    cells = cells_a.groupBy("class", "i", "j").cogroup(cells_b.groupBy("class", "i", "j"))
    pairs = cells.applyInArrow(cell, "a string, b string, score double")
    pairs = pairs.join(left_ids.select(F.col("id").alias("left_id"), F.col("key").alias("a")), "a")
    return pairs.join(right_ids.select(F.col("id").alias("right_id"), F.col("key").alias("b")), "b").select("left_id", "right_id", "score")


#: Rounds of assign() before what is left is decided by connected components.
ROUNDS = 6


def assign(candidates: DataFrame, left_pos: str = "left_id", right_pos: str = "right_id") -> DataFrame:
    """Greedy one-to-one: each left row, in order, takes its best free right row; ties go to the first.

    Sequential by definition, but most rows need not wait: if of all rows that could take its best free partner a left row is
    the first, nothing that is decided elsewhere can change its choice. Each round lets all such rows choose at once, by
    aggregates over pairs; their pairs and those of their partners go. Chains of rows that wait for each other over more
    than ROUNDS rounds are decided within their connected components, of which a task holds one (as pairs of numbers).
    """
    from talkloom.operators.components import components
    from talkloom.sources.artifacts import checkpointed

    kinds = dict(candidates.dtypes)
    left = checkpointed(candidates.select("left_id", "right_id", "score").dropDuplicates(["left_id", "right_id"]))
    chosen = []
    for _ in range(ROUNDS):
        if left.isEmpty():
            break
        best = left.groupBy("left_id").agg(F.min(F.struct((-F.col("score")).alias("score"), F.col("right_id").alias("right_id"))).alias("b"))
        first = left.groupBy("right_id").agg(F.min("left_id").alias("first"))
        picks = best.select("left_id", F.col("b.right_id").alias("right_id"), (-F.col("b.score")).alias("score")).join(first, "right_id")
        picks = checkpointed(picks.where(F.col("first") == F.col("left_id")).select("left_id", "right_id", "score"))
        chosen.append(picks)
        left = checkpointed(left.join(picks.select("left_id"), "left_id", "left_anti").join(picks.select("right_id"), "right_id", "left_anti"))
    tagged = left.withColumn("l", F.concat(F.lit("l"), F.col("left_id").cast("string"))).withColumn(
        "r", F.concat(F.lit("r"), F.col("right_id").cast("string"))
    )

    def greedy(rows: pd.DataFrame) -> pd.DataFrame:
        taken, out = set(), []
        for left_id, mine in rows.sort_values(["left_id", "score", "right_id"], ascending=[True, False, True]).groupby("left_id", sort=True):
            for right_id, score in zip(mine["right_id"], mine["score"]):
                if right_id not in taken:
                    taken.add(right_id)
                    out.append((left_id, right_id, score))
                    break
        return pd.DataFrame(out, columns=["left_id", "right_id", "score"])

    shape = f"left_id {kinds['left_id']}, right_id {kinds['right_id']}, score double"
    if left.isEmpty():
        rest = left.sparkSession.createDataFrame([], shape)
    else:
        grouped = tagged.join(components(tagged, "l", "r"), F.col("l") == F.col("node")).select("root", "left_id", "right_id", "score")
        rest = grouped.groupBy("root").applyInPandas(greedy, shape)
    for more in chosen:
        rest = rest.unionByName(more)
    return rest.select("left_id", "right_id", "score")


def match_recordings(sessions: DataFrame, recordings: DataFrame, shortest: float = 120.0) -> DataFrame:
    """Sessions (with title, _pos) and recordings (video_id, title, duration_sec, full_text) matched one to one.

    Recordings are taken in order of video_id; those shorter than ``shortest`` seconds are left out unless their
    duration is 0. Every session comes back once, with nulls where nothing matched; every recording that matched none
    becomes a session of format "recording".
    """
    from talkloom.operators.sessions import with_recordings

    d = F.coalesce(F.col("duration_sec"), F.lit(0.0))
    usable = recordings.where(~((d > 0) & (d < shortest)))
    pairs = assign(
        similar_pairs(usable.select(F.col("video_id").alias("id"), filled("title").alias("title")), sessions.select(F.col("_pos").alias("id"), "title"))
    )
    pairs = pairs.select(F.col("left_id").alias("video_id"), F.col("right_id").alias("_pos"))
    got = usable.select("video_id", F.col("full_text").alias("transcript"), "duration_sec")
    matched = sessions.join(pairs, "_pos", "left").join(got, "video_id", "left")
    unmatched = usable.join(pairs, "video_id", "left_anti").select(
        "video_id", filled("title").alias("title"), F.col("full_text").alias("transcript"), "duration_sec"
    )
    return with_recordings(matched, unmatched)


def resolve_titles(wanted: DataFrame, titles: DataFrame, name: str = "wanted") -> DataFrame:
    """wanted (with a title column ``name``) and the column ``resolved``: the title of ``titles`` (title, pos) that it stands for.

    Tiers: the same title; the first title of the same part before " - "; the first title that begins with the wanted one.
    What the first two find is written once and read by all that follows, as their union with the third would be read by few
    tasks. The third tier joins what is still open on beginnings of just the lengths that are asked for, so all joins are on
    equal strings. What is open is the table that a task holds; the titles' beginnings, many times as many, stream past it
    unsorted, and only those that are asked for are grouped.
    """
    from talkloom.sources.artifacts import stored

    first = titles.groupBy("title").agg(F.min("pos").alias("pos")).where("title is not null")
    ask = wanted.select(F.col(name).alias("w")).where("w is not null and w <> ''").distinct()
    asked = ask.join(first.select(F.col("title").alias("same")), F.col("w") == F.col("same"), "left")
    by_prefix = first.groupBy(title_prefix("title").alias("p")).agg(F.min_by("title", F.struct("pos", "title")).alias("like"))
    asked = asked.join(by_prefix, title_prefix("w") == F.col("p"), "left").select("w", F.coalesce("same", "like").alias("title"))
    asked = stored(asked)
    open_ = asked.where("title is null").select("w")
    lengths = open_.agg(F.collect_set(F.length("w")).alias("ns"))  # one row: the different lengths of titles
    heads = first.join(F.broadcast(lengths), F.lit(True)).select("title", "pos", F.explode("ns").alias("n")).where(F.length("title") >= F.col("n"))
    heads = heads.select(F.substring("title", F.lit(1), F.col("n")).alias("head"), "title", "pos")
    starts = heads.join(open_.hint("shuffle_hash"), F.col("w") == F.col("head"))
    starts = starts.groupBy("w").agg(F.min_by("title", F.struct("pos", "title")).alias("title"))
    best = asked.where("title is not null").unionByName(starts).withColumnRenamed("title", "resolved")
    return wanted.join(best, F.col(name) == F.col("w"), "left").drop("w")


def best_titles(candidates: DataFrame, titles: DataFrame, strict: bool = False) -> DataFrame:
    """(candidate_id, title, score) of the title that shares most of a candidate's tokens.

    Columns: candidate_id and text, and title. At least half of the candidate's tokens must be shared and it must have two;
    strict: four, of which three shared. The same title is its own match. Ties go to the title first in order.

    A title that shares half of n tokens has one at least of any n - n/2 + 1 of them. So candidates meet titles on their
    rarest tokens alone, and what meets is counted on all. It has n/2 tokens at least, so candidates beyond twice the longest
    title's leave at once. Both sides go by digests; a whole text is read again only for what is chosen. What is known to
    be small once it is written is broadcast by Spark's size check, so that the larger side's tokens stay where they are.
    """
    from talkloom.sources.artifacts import stored

    hashed = lambda c: F.transform(tokens(c), lambda x: F.xxhash64(x))
    digest = lambda x: F.unhex(F.md5(x))
    asked = candidates.select("candidate_id", filled("text").alias("text")).withColumn("cid", digest(F.to_json(F.struct("candidate_id"))))
    least = 4 if strict else 2
    real = titles.select("title").where("title is not null").withColumn("tid", digest("title"))
    theirs = stored(real.select("tid", hashed("title").alias("theirs")).groupBy("tid").agg(F.first("theirs").alias("theirs")))
    widest = F.broadcast(theirs.agg(F.max(F.size("theirs")).alias("widest")))  # one row
    fits = asked.select("cid", hashed("text").alias("mine")).where(F.size("mine") >= least)
    fits = fits.join(widest, F.size("mine") <= 2 * F.col("widest")).select("cid", "mine")
    word = theirs.select("tid", F.size("theirs").alias("m"), F.explode("theirs").alias("token"))
    known = word.groupBy("token").agg(F.count("*").alias("held_by"))
    held = fits.select("cid", F.size("mine").alias("n"), F.explode("mine").alias("token")).join(known, "token")
    # Tokens that no title has come first: they are rarest, and stand for themselves only by their number.
    by_rarity = held.groupBy("cid", "n").agg(F.array_sort(F.collect_list(F.struct("held_by", "token"))).alias("held"))
    by_rarity = stored(by_rarity.select("cid", "n", F.transform("held", lambda h: h["token"]).alias("mine")))
    lead = F.col("n") - F.ceil(F.col("n") / 2).cast("int") + 1 - (F.col("n") - F.size("mine"))
    asks = by_rarity.where(lead > 0).select("cid", "n", F.explode(F.slice("mine", F.lit(1), lead)).alias("token"))
    met = stored(asks.join(word, "token").where(2 * F.col("m") >= F.col("n")).select("cid", "tid").distinct())
    shared = met.join(by_rarity, "cid").join(theirs, "tid").withColumn("shared", F.size(F.array_intersect("mine", "theirs")))
    shared = shared.withColumn("score", F.col("shared") / F.col("n")).where("score >= 0.5" + (" and shared >= 3" if strict else ""))
    same = asked.join(real, digest("text") == F.col("tid")).where("text = title").select("cid", "tid", F.lit(2.0).alias("score"))
    every = shared.select("cid", "tid", "score").unionByName(same)
    best = F.rank().over(Window.partitionBy("cid").orderBy(F.desc("score")))
    every = stored(every.withColumn("nth", best).where("nth = 1").select("cid", "tid", "score").distinct())
    chosen = stored(every.join(real, "tid").groupBy("cid").agg(F.min("title").alias("title"), F.first("score").alias("score")))
    one = asked.select("cid", "candidate_id").join(chosen, "cid").dropDuplicates(["cid"])
    return one.select("candidate_id", "title", F.least(F.lit(1.0), "score").alias("score"))
