"""Ranked lexical search over a tiered inverted index.

Documents are dealt into blocks of at most ``BLOCK`` as they are scanned. A posting list belongs to one block and one term
and packs document numbers and impacts into arrays. An impact is what a term's occurrences in a document are worth before
the term's weight; all of a term's impacts over the corpus fall into three tiers by a histogram: the highest ``TIERS[0]`` or
fewer, the next ``TIERS[1]`` or fewer, and the rest, each written into a folder of its own. For each tier a term has a
residual, above which no impact of a lower tier lies.

A search reads the first tier alone. A block scores its documents and hands on, for each item, the ``k`` of highest possible
score (what is seen, and the residuals of terms not seen) and the best possible score among all others. Candidates that can
reach the ``k``-th score seen so far are then looked up in the lower tiers. If their ``k``-th exact score is above whatever
another document can have, the item's result is proved exact; if not, the item falls through to the next tier. The last
tier leaves no residual, so that every result is exact.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkloom.llm.common import cut, fresh_name, type_of, utf8
from talkloom.llm.line_dedup import LOWER, UPPER

#: Fixed values of the score: a term's characters, scale of weights, scale and saturation of impacts, length normalisation in per cent.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WEIGHT, IMPACT, HALF_AT, PART, LENGTH = 1000, 1_000_000_000, 1000, 20, 50
#: Documents in a block at most, and postings of one in a task's memory.
BLOCK, BLOCK_POSTINGS = 8192, 1_000_000
#: Postings of a term in the first and in the second tier at most; width of the impact histogram.
TIERS, STEP = (2_000, 32_000), 1024
K = 50
#: Terms up to which an index of asked terms alone is built from a set that tasks hold; pairs of item and term searched together.
ASKED, PACK = 200_000, 50_000
#: Bytes of terms and item numbers up to which a search sends them to all tasks.
BROADCAST = 8 << 20

#: Every byte that stands in no term becomes a space, A-Z become lower case.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8, in order, with repeats."""
    return text.translate(_PLAIN).split() if text else []


@dataclass
class Index:
    """documents: (block, ids, sizes); postings: (block, term, locals, impacts, tier); vocabulary: (term, df, weight, rest0, rest1, rest2)."""

    documents: DataFrame
    postings: DataFrame
    vocabulary: DataFrame


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *(len(x) for x in values)]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat).cast(kind))


def _scan(asked: frozenset[bytes] | None, id_type: str):
    """Rows of a block: one with its documents' ids and sizes (kind 0), and one for each term with numbers, occurrences, sizes (kind 1)."""

    def close(block: int, ids: list, sizes: list[int], found: dict[bytes, tuple[list[int], list[int]]], kind: pa.DataType) -> pa.RecordBatch:
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0, i))
        rank, size = np.empty(len(ids), np.int64), np.array(sizes, np.int64)
        rank[order] = np.arange(len(ids))
        names, at, tf = list(found), [rank[x[0]] for x in found.values()], [np.array(x[1], np.int64) for x in found.values()]
        n = [size[x[0]] for x in found.values()]
        none = [np.zeros(0, np.int64)]
        arrays = [
            pa.array(np.full(1 + len(names), block)),
            pa.array([None, *names], pa.binary()).cast(pa.string()),
            pa.array([[ids[i] for i in order], *([] for _ in names)], pa.list_(kind)),
            _lists(none + at, pa.int32()),
            _lists(none + tf, pa.int32()),
            _lists([size[order], *n], pa.int32()),
            pa.array(np.r_[0, np.ones(len(names))].astype(np.int32)),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=["block", "term", "ids", "locals", "tfs", "sizes", "kind"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, sizes, found, postings, kind = TaskContext.get().partitionId() << 32, [], [], {}, 0, None
        for batch in batches:
            kind = batch.column(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                words = terms(text)
                if not words:
                    continue
                for term, tf in Counter(words if asked is None else filter(asked.__contains__, words)).items():
                    at = found.get(term)
                    if at is None:
                        at = found[term] = ([], [])
                    at[0].append(len(ids))
                    at[1].append(tf)
                    postings += 1
                ids.append(doc_id)
                sizes.append(len(words))
                if len(ids) >= BLOCK or postings >= BLOCK_POSTINGS:
                    yield close(block, ids, sizes, found, kind)
                    block, ids, sizes, found, postings = block + 1, [], [], {}, 0
        if ids:
            yield close(block, ids, sizes, found, kind)

    return each, f"block long, term string, ids array<{id_type}>, locals array<int>, tfs array<int>, sizes array<int>, kind int"


def impacts(tf: np.ndarray, size: np.ndarray, documents: int, total: int) -> np.ndarray:
    """Impacts of occurrences in documents of so many terms, of a corpus of so many documents and terms."""
    m = 100 - LENGTH + LENGTH * size.astype(np.int64) * documents // total
    return IMPACT * tf.astype(np.int64) // (HALF_AT * tf.astype(np.int64) + PART * m)


def _flat(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False)


def build(docs: DataFrame, asked: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Index every row of docs by the terms of its whole text, or only by those of ``asked`` (a table of one column, term).

    Null texts and texts without a term are in no posting and count for nothing. Rows of one id are documents of their own;
    null ids come last among equal scores. An empty table gives an empty index. Columns other than the two named are ignored.
    """
    only = None
    if asked is not None:
        asked = cut(asked.toDF("term").where("term is not null").distinct(), "asked")
        if asked.count() <= ASKED:
            only = frozenset(r["term"].encode() for r in asked.collect())
    each, kind = _scan(only, type_of(docs, id_col))
    raw = cut(docs.select(id_col, text_col).mapInArrow(each, kind), "blocks", by="kind")
    documents = raw.where("kind = 0").select("block", "ids", "sizes")
    postings = raw.where("kind = 1").select("block", "term", "locals", "tfs", "sizes")
    if asked is not None and only is None:
        postings = postings.join(asked, "term", "left_semi")
    sums = documents.agg(
        F.coalesce(F.sum(F.size("sizes")), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0)).alias("l"),
    ).first()
    n, total = int(sums["n"]), max(1, int(sums["l"]))

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            level = impacts(_flat(batch, "tfs"), _flat(batch, "sizes"), n, total) // STEP
            length = np.diff(batch.column("tfs").offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), length)
            key, count = np.unique(row << 32 | level, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("term").take(pa.array(key >> 32)), pa.array(key & 0xFFFFFFFF), pa.array(count)], names=["term", "level", "n"]
            )

    levels = postings.mapInArrow(histogram, "term string, level long, n long").groupBy("term", "level").agg(F.sum("n").alias("n"))
    above = Window.partitionBy("term").orderBy(F.desc("level"))
    seen = levels.withColumn("upto", F.sum("n").over(above.rowsBetween(Window.unboundedPreceding, 0)))
    ends = [TIERS[0], TIERS[0] + TIERS[1]]
    # From which impact a tier reaches down, and the residual below: none where nothing lies there.
    lowest = lambda end: F.coalesce(F.min(F.when(F.col("upto") <= end, F.col("level"))), F.max("level") + 1) * STEP
    vocabulary = seen.groupBy("term").agg(F.sum("n").alias("df"), *(lowest(end).alias(f"from{j}") for j, end in enumerate(ends)))
    rest = [F.when(F.col("df") <= end, F.lit(0)).otherwise(F.col(f"from{j}") - 1).cast("long").alias(f"rest{j}") for j, end in enumerate(ends)]
    weight = F.floor(WEIGHT * F.log((F.lit(2.0 * n + 2)) / (2 * F.col("df") + 1))).cast("long").alias("weight")
    vocabulary = cut(vocabulary.select("term", "df", weight, *rest, F.lit(0).cast("long").alias("rest2"), "from0", "from1"), "vocabulary")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            impact = impacts(_flat(batch, "tfs"), _flat(batch, "sizes"), n, total)
            at, row = _flat(batch, "locals"), np.repeat(np.arange(batch.num_rows), np.diff(batch.column("tfs").offsets.to_numpy()))
            first, second = (batch.column(c).to_numpy(zero_copy_only=False)[row] for c in ("from0", "from1"))
            tier = np.where(impact >= first, 0, np.where(impact >= second, 1, 2))
            for t in range(3):
                mine = np.flatnonzero(tier == t)
                some = np.unique(row[mine], return_index=True)[1]
                which = pa.array(row[mine][some])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("block").take(which),
                        batch.column("term").take(which),
                        _lists(np.split(at[mine], some[1:]) if len(some) else [], pa.int32()),
                        _lists(np.split(impact[mine], some[1:]) if len(some) else [], pa.int32()),
                        pa.array(np.full(len(some), t, np.int32)),
                    ],
                    names=["block", "term", "locals", "impacts", "tier"],
                )

    dealt = postings.join(vocabulary.select("term", "from0", "from1"), "term").mapInArrow(
        deal, "block long, term string, locals array<int>, impacts array<int>, tier int"
    )
    return Index(documents, cut(dealt, "postings", by="tier"), vocabulary.drop("from0", "from1"))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each (pack, block), which come together."""
    held: list[dict] = []
    for batch in batches:
        for row in _rows(batch):
            if held and (row["pack"], row["block"]) != (held[0]["pack"], held[0]["block"]):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch, their lists as arrays."""
    names = batch.schema.names
    plain = {c: batch.column(c).to_pylist() for c in names if not pa.types.is_list(batch.column(c).type)}
    lists = {}
    for c in names:
        if c not in plain:
            column = batch.column(c)
            flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            lists[c] = [flat[i:j] for i, j in zip(ends[:-1], ends[1:])]
    for i in range(batch.num_rows):
        yield {c: x[i] for c, x in plain.items()} | {c: x[i].copy() for c, x in lists.items()}


_SCORED = "no long, block long, at int, score long, gain long"


def _scorer(k: int, last: bool):
    """Of each block and item: the k documents of most gain (of highest score, in the last tier) and, as ``at`` -1, the gain of the best other."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            wanted: dict[int, list[dict]] = {}
            for row in rows:
                for no in row["nos"]:
                    wanted.setdefault(int(no), []).append(row)
            size = 1 + max(int(row["locals"].max()) for row in rows)
            out = []
            for no, mine in wanted.items():
                score, gain, touched = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, bool)
                for row in mine:  # a document comes once in a posting list
                    at, impact = row["locals"], row["impacts"].astype(np.int64)
                    score[at] += row["weight"] * impact
                    gain[at] += row["weight"] * (impact - row["rest"])
                    touched[at] = True
                found = np.flatnonzero(touched)
                by = score if last else gain
                if len(found) > k:  # the k best and their equals, then exactly k
                    least = np.partition(by[found], len(found) - k - 1)[len(found) - k - 1]
                    found = found[by[found] >= least]
                found = found[np.lexsort((found, -by[found]))]
                others = int(by[found[k]]) if len(found) > k else 0
                found = found[:k]
                out.append((np.r_[found, -1], np.r_[score[found], 0], np.r_[gain[found], others], np.full(len(found) + 1, no)))
            at, score, gain, no = (np.concatenate(x) for x in zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(no), pa.array(np.full(len(no), rows[0]["block"])), pa.array(at.astype(np.int32)), pa.array(score), pa.array(gain)],
                names=["no", "block", "at", "score", "gain"],
            )

    return each


def _looker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact scores of candidates: rows of (pack, block) hold either an item's candidates and their scores so far, or a lower posting list."""
    for rows in _groups(batches):
        asked = {row["no"]: (row["locals"], row["scores"].astype(np.int64)) for row in rows if row["no"] is not None}
        lists = [row for row in rows if row["no"] is None]
        size = 1 + max(int(row["locals"].max()) for row in rows)
        dense = np.zeros(size, np.int64)
        for row in lists:
            dense[row["locals"]] = row["impacts"]
            for no in row["nos"]:
                if int(no) in asked:
                    at, score = asked[int(no)]
                    score += row["weight"] * dense[at]
            dense[row["locals"]] = 0
        for no, (at, score) in asked.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), no)), pa.array(np.full(len(at), rows[0]["block"])), pa.array(at), pa.array(score)],
                names=["no", "block", "at", "score"],
            )


def _best(scores: DataFrame, k: int) -> DataFrame:
    """The k-th score of each item (0 where it has fewer) as column ``kth``."""
    nth = F.row_number().over(Window.partitionBy("no").orderBy(F.desc("score")))
    kept = scores.select("no", "score").withColumn("nth", nth).where(F.col("nth") <= k)
    return kept.groupBy("no").agg(F.max(F.when(F.col("nth") == k, F.col("score"))).alias("kth")).fillna(0, ["kth"])


def search(index: Index, items: DataFrame, k: int = K, id_col: str = "item_id", text_col: str = "text", doc_col: str = "doc_id") -> DataFrame:
    """Of each row of items, the k documents of highest score above 0: item id, rank (from 1), document id, score.

    Equal scores rank by document id, nulls last. An item's terms count once each. Repeated items and null item ids are rows
    like others; items without a term, or with none that a document holds, give no rows, and so does an empty index.
    """
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER)
    each = F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)))
    numbered = cut(items.select(F.col(id_col).alias("item"), each.alias("terms"), F.monotonically_increasing_id().alias("no")), "items")
    asks = numbered.select("no", F.explode("terms").alias("term")).join(index.vocabulary, "term")
    size = asks.agg(F.count("*").alias("pairs"), F.coalesce(F.sum(F.octet_length("term") + 8), F.lit(0)).alias("bytes")).first()
    packs = max(1, -(-size["pairs"] // PACK))
    to_all = F.broadcast if size["bytes"] <= BROADCAST else lambda df: df  # larger ones meet the lists by a shuffle
    asks = cut(asks.withColumn("pack", F.pmod(F.xxhash64("no"), F.lit(packs)).cast("int")), "asks")
    active, results = asks.select("no").distinct(), []
    columns = ["pack", "block", "locals", "impacts", "weight", "rest", "nos"]
    for tier in range(3):
        last, rest = tier == 2, F.col(f"rest{tier}")
        mine = asks if tier == 0 else cut(asks.join(active, "no", "left_semi"), "asks_left")
        if tier and mine.isEmpty():
            break
        by_term = to_all(mine.groupBy("pack", "term", "weight", rest.alias("rest")).agg(F.collect_list("no").alias("nos")))
        lists = lambda which: index.postings.where(which).join(by_term, "term").select(columns)
        rows = lists(F.col("tier") <= tier).repartition("pack", "block").sortWithinPartitions("pack", "block")
        scored = cut(rows.mapInArrow(_scorer(k, last), _SCORED), "scored")
        found = scored.where("at >= 0")
        if last:
            results.append(found.select("no", "block", "at", "score"))
            break
        possible = mine.groupBy("no").agg(F.sum(F.col("weight") * rest).alias("most"))
        others = scored.where("at < 0").groupBy("no").agg(F.max("gain").alias("gain"))
        bounds = possible.join(others, "no", "left").select("no", "most", (F.col("most") + F.coalesce("gain", F.lit(0))).alias("others"))
        hopeful = found.join(_best(found, k), "no").join(bounds, "no").where(F.col("most") + F.col("gain") >= F.col("kth"))
        of_pack = mine.select("no", "pack").distinct()
        hopeful = cut(hopeful.select("no", "block", "at", "score").join(of_pack, "no"), "hopeful")
        held = hopeful.groupBy("pack", "block", "no").agg(F.collect_list(F.struct("at", "score")).alias("x"))
        held = held.select("pack", "block", "no", F.col("x.at").alias("locals"), F.col("x.score").alias("scores"))
        blocks = hopeful.select("pack", "block").distinct()
        lower = lists(F.col("tier") > tier).join(blocks, ["pack", "block"], "left_semi").drop("rest")
        rows = held.unionByName(lower, allowMissingColumns=True).repartition("pack", "block").sortWithinPartitions("pack", "block")
        exact = cut(rows.mapInArrow(_looker, "no long, block long, at int, score long"), "exact")
        proof = bounds.join(_best(exact, k), "no", "left").where((F.col("others") == 0) | (F.col("kth") > F.col("others"))).select("no")
        proved = cut(proof, "proved")
        results.append(exact.join(proved, "no", "left_semi"))
        active = active.join(proved, "no", "left_anti")
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    near = F.rank().over(Window.partitionBy("no").orderBy(F.desc("score")))
    found = cut(found.where("score > 0").withColumn("near", near).where(F.col("near") <= k).drop("near"), "found")
    named = found.join(index.documents, "block").select("no", "score", F.col("ids")[F.col("at")].alias("__doc"))
    rank = F.row_number().over(Window.partitionBy("no").orderBy(F.desc("score"), F.asc_nulls_last("__doc")))
    named = named.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k)
    doc_col = fresh_name(items.select(id_col), doc_col)
    return named.join(numbered.select("no", "item"), "no").select(F.col("item").alias(id_col), "rank", F.col("__doc").alias(doc_col), "score")


def item_terms(items: DataFrame, text_col: str = "text") -> DataFrame:
    """The distinct terms of all items, one a row."""
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER)
    return items.select(F.explode(F.regexp_extract_all(text, F.lit(TERM), F.lit(0))).alias("term")).distinct()
