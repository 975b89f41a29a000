"""Nearest neighbours among chunk vectors, filtered before or after."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkloom.functions.text import context_block
from talkloom.functions.vector import cosine_distance


def where_metadata(
    chunks: DataFrame, types: list[str] | None = None, track: str | None = None, type_col: str = "chunk_type", track_col: str = "track"
) -> DataFrame:
    """Both conditions reach the scan. A chunk without a track matches no track."""
    if types:
        chunks = chunks.where(F.col(type_col).isin(types))
    if track:
        chunks = chunks.where(F.col(track_col) == track)
    return chunks


def nearest(chunks: DataFrame, query: list[float], k: int = 15, vector: str = "embedding", id_col: str = "id", digits: int | None = None) -> DataFrame:
    """The k chunks of least cosine distance, ties by id. The whole table never moves: each task keeps its best k."""
    q = F.array(*(F.lit(float(x)) for x in query))
    length = F.lit(sum(float(x) ** 2 for x in query) ** 0.5)
    distance = cosine_distance(F.col(vector), q, length)
    rows = chunks.where(F.col(vector).isNotNull()).withColumn("distance", distance if digits is None else F.round(distance, digits))
    return rows.orderBy("distance", id_col).limit(k)


#: Claims, and chunks, that one task compares at once; digits to which distances are told apart.
CLAIMS, CHUNKS, DIGITS = 4096, 1 << 16, 12


def _unit(vectors: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors that are whole, and these at length one; a vector of length zero stays zero."""
    found = [(i, v) for i, v in enumerate(vectors.to_pylist()) if v is not None and len(v) and None not in v]
    if not found:
        return np.zeros(0, int), np.zeros((0, 0))
    rows = np.array([v for _, v in found], np.float64)
    length = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    return np.array([i for i, _ in found]), rows / np.where(length > 0, length, 1)[:, None]


def nearest_each(
    claims: DataFrame,
    chunks: DataFrame,
    k: int,
    claim_id: str = "claim_id",
    claim_vector: str = "claim_embedding",
    vector: str = "embedding",
    id_col: str = "id",
) -> DataFrame:
    """The claim's and the chunk's columns, distance and nth: the k nearest chunks of every claim, ties by id.

    Blocks of claims meet slices of chunks in a grid of cells. A cell is one matrix product and gives at most k chunks for
    each of its claims; only ids and distances move on. Vectors that are null, empty or hold a null take no part.
    """
    n_claims, n_chunks = claims.count(), chunks.count()
    blocks, slices = max(1, -(-n_claims // CLAIMS)), max(1, -(-n_chunks // CHUNKS))
    tasks = chunks.sparkSession.sparkContext.defaultParallelism
    slices = max(slices, min(tasks, -(-n_chunks // 4096)))
    kinds = dict(claims.dtypes)[claim_id], dict(chunks.dtypes)[id_col]
    asked = claims.select(F.col(claim_id).alias("c"), F.col(claim_vector).alias("v"), F.pmod(F.xxhash64(claim_id), F.lit(blocks)).alias("block"))
    asked = asked.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    held = chunks.select(F.col(id_col).alias("i"), F.col(vector).alias("v"), F.pmod(F.xxhash64(id_col), F.lit(slices)).cast("int").alias("slice"))
    held = held.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        at, a = _unit(left.column("v"))
        of, b = _unit(right.column("v"))
        out: tuple[list, list, list] = [], [], []
        if len(at) and len(of):
            ids = right.column("i").take(pa.array(of))
            place = np.argsort(np.array(ids.to_pylist()), kind="stable")  # ties go to the smaller id
            order = np.empty(len(place), int)
            order[place] = np.arange(len(place))
            for start in range(0, len(at), 512):
                far = np.round(1 - a[start : start + 512] @ b.T, DIGITS)
                for row, claim in zip(far, at[start : start + 512]):
                    best = np.flatnonzero(row <= np.partition(row, k - 1)[k - 1]) if len(row) > k else np.arange(len(row))
                    best = best[np.lexsort((order[best], row[best]))][:k]
                    out[0].extend([claim] * len(best))
                    out[1].extend(best.tolist())
                    out[2].extend(row[best].tolist())
            found = [left.column("c").take(pa.array(out[0], pa.int64())), ids.take(pa.array(out[1], pa.int64()))]
        else:
            found = [left.column("c").slice(0, 0), right.column("i").slice(0, 0)]
        return pa.table([*found, pa.array(out[2], pa.float64())], names=["c", "i", "distance"])

    pairs = asked.groupBy("block", "slice").cogroup(held.groupBy("block", "slice")).applyInArrow(cell, f"c {kinds[0]}, i {kinds[1]}, distance double")
    nth = F.row_number().over(Window.partitionBy("c").orderBy("distance", "i"))
    best = pairs.withColumn("nth", nth).where(F.col("nth") <= k)
    mine = best.withColumnRenamed("c", "__c").withColumnRenamed("i", "__i")
    return claims.join(mine, F.col(claim_id) == F.col("__c")).join(chunks, F.col("__i") == F.col(id_col)).drop("__c", "__i")


def title_contains(hits: DataFrame, cited: Column, title: Column) -> DataFrame:
    """After the search: hits whose title holds the cited one, whatever the case."""
    return hits.where(F.contains(F.lower(title), F.lower(cited)))


def quote_sources(claims: DataFrame, chunks: DataFrame, k: int = 8, k_slides: int = 5) -> DataFrame:
    """claim_id and the chunk to quote for it: the first of its k nearest transcript chunks whose title holds the cited
    one, else the first such of its nearest slide chunks. The title is looked at after the search, so fewer than k may remain."""
    parts = []
    for tier, (kind, n) in enumerate((("transcript_segment", k), ("slide_content", k_slides))):
        got = nearest_each(claims, where_metadata(chunks, [kind]), n)
        parts.append(title_contains(got, F.col("talk_title_cited"), F.col("talk_title")).withColumn("tier", F.lit(tier)))
    every = parts[0].unionByName(parts[1])
    first = Window.partitionBy("claim_id").orderBy("tier", "nth")
    return every.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n", "tier")


def context(hits: DataFrame, separator: str = "\n\n---\n\n") -> DataFrame:
    """One row: the hits in order of distance as the text that a model reads."""
    ordered = hits.withColumn("n", F.row_number().over(Window.orderBy("distance", "id")))  # at most k rows
    block = context_block(F.col("n"), F.col("id"), F.col("talk_title"), F.col("track"), F.col("start_time"), F.col("video_id"), F.col("text"))
    rows = F.array_sort(F.collect_list(F.struct("n", block.alias("b"))))
    return ordered.agg(F.count("*").alias("hits"), F.array_join(F.transform(rows, lambda r: r["b"]), separator).alias("context"))
