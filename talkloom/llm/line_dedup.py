"""Exact line deduplication with levelled sorted runs of line hashes. DataFrame functions only.

A run is a sorted table of (hash, documents that hold the line, largest of their ids). A hash is settled once some run
counts it in ``LEAST_DOCS`` documents: whatever comes later, its line goes from every document below the largest id. Each
new batch of (hash, document) is merge-anti-joined with the settled hashes of the runs. What they have is decided there
and never stored again; the rest is counted into a run of the batch's own. When a level has ``FANOUT`` runs they are
compacted into one run of the next level, where hashes that batches have brought up to ``LEAST_DOCS`` together become
settled. After the last batch only what no batch has decided is joined with the totals of the runs.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.llm.common import cut, fresh_name

#: Production parameters: code points of a line that may go, documents that must hold it, runs in a level, and the rows
#: (hash, document) from which on each doubling of them makes one batch more.
LEAST_CHARS = 40
LEAST_DOCS = 5
FANOUT = 2
BATCH_ROWS = 1 << 18
#: Tasks that the rows of one hash are dealt to when they meet the hashes of the runs.
SALTS = 8

SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH = ["h1", "h2"]


def lines_of(text: Column) -> Column:
    """Null and empty texts are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    """Stripped of ASCII white space at both ends, A-Z lower-cased and nothing else."""
    bare = F.btrim(line, F.lit(SPACE))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def hash_of(line: Column) -> Column:
    """128 bits of the line's key; null if the key is too short ever to be dropped."""
    key = key_of(line)
    long = F.length(F.btrim(line, F.lit(SPACE))) >= LEAST_CHARS
    return F.when(long, F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")))


class RunStore:
    """Levelled runs of line hashes: h1, h2, n, last."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, least_docs: int = LEAST_DOCS):
        self.spark, self.fanout, self.least_docs = spark, max(2, fanout), least_docs
        self.levels: dict[int, list[DataFrame]] = defaultdict(list)

    def runs(self) -> list[DataFrame]:
        return [run for _, level in sorted(self.levels.items()) for run in level]

    def settled(self) -> DataFrame | None:
        """h1, h2, last of the settled hashes; a hash that several runs have settled comes once for each of them."""
        runs = [run.where(F.col("n") >= self.least_docs).select(*HASH, "last") for run in self.runs()]
        return union(runs) if runs else None

    def add(self, batch: DataFrame) -> tuple[DataFrame | None, DataFrame]:
        """Add a batch of (h1, h2, doc_id), each pair of line and document once; no pair may come in two batches.

        Returns the pairs that the runs decide, whose line goes from that document (None while there is no run), and
        the rest, which the batch's own run counts.
        """
        settled = self.settled()
        if settled is None:
            decided, rest = None, batch
        else:
            batch = salted(batch)
            settled = cut(spread(settled.groupBy(*HASH).agg(F.max("last").alias("last"))), "settled").hint("merge")
            below = [batch[c].eqNullSafe(settled[c]) for c in (*HASH, "salt")] + [batch["doc_id"] < settled["last"]]
            decided = cut(batch.join(settled, below, "left_semi").select(*HASH, "doc_id"), "decided")
            rest = cut(batch.join(settled, below, "left_anti").select(*HASH, "doc_id"), "rest")
        self._put(0, rest.groupBy(*HASH).agg(F.count("*").alias("n"), F.max("doc_id").alias("last")))
        return decided, rest

    def _put(self, level: int, run: DataFrame) -> None:
        self.levels[level].append(cut(run.sortWithinPartitions(*HASH), f"run{level}"))
        if len(self.levels[level]) >= self.fanout:
            self._put(level + 1, merged(self.levels.pop(level)))

    def totals(self) -> DataFrame:
        """h1, h2, n, last over all runs. n is that of all documents up to LEAST_DOCS, and at least LEAST_DOCS from there on."""
        runs = self.runs()
        return runs[0] if len(runs) == 1 else merged(runs)

    def save(self, path: str) -> None:
        """Write the runs below path, for batches that come in a later application."""
        for level, runs in self.levels.items():
            for i, run in enumerate(runs):
                run.write.mode("overwrite").parquet(f"{path}/level={level}/run={i}")

    @classmethod
    def load(cls, spark: SparkSession, path: str, fanout: int = FANOUT, least_docs: int = LEAST_DOCS) -> RunStore:
        store = cls(spark, fanout, least_docs)
        saved = spark.read.parquet(path)
        for row in saved.select("level", "run").distinct().orderBy("level", "run").collect():  # one row for each run
            mine = (F.col("level") == row["level"]) & (F.col("run") == row["run"])
            store.levels[int(row["level"])].append(saved.where(mine).drop("level", "run"))
        return store


def union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def merged(runs: list[DataFrame]) -> DataFrame:
    return union(runs).groupBy(*HASH).agg(F.sum("n").alias("n"), F.max("last").alias("last"))


def salted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))


def spread(hashes: DataFrame) -> DataFrame:
    """Each hash once for each salt, so that no task meets all rows of a hash."""
    return hashes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def batches_of(rows: int, batch_rows: int = BATCH_ROWS) -> int:
    return max(2, math.ceil(math.log2(max(1, rows / batch_rows))))


def dropped_lines(held: DataFrame, batches: int | None = None, fanout: int = FANOUT) -> DataFrame:
    """The pairs of held (h1, h2, doc_id; each once) whose line goes from that document."""
    spark = held.sparkSession
    held = cut(held, "lines")
    batches = batches or batches_of(held.count())
    of = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(batches))
    held = cut(held.withColumn("batch", of.cast("int")), "batches", by="batch") if batches > 1 else held.withColumn("batch", F.lit(0))
    store, decided, rest = RunStore(spark, fanout), [], []
    for b in range(batches):
        goes, left = store.add(held.where(F.col("batch") == b).select(*HASH, "doc_id"))
        decided += [goes] if goes is not None else []
        rest.append(left)
    shared = cut(spread(store.totals().where(F.col("n") >= LEAST_DOCS).select(*HASH, "last")), "shared").hint("merge")
    late = salted(union(rest)).join(shared, [*HASH, "salt"]).where(F.col("doc_id") != F.col("last"))
    return union([*decided, late.select(*HASH, "doc_id")])


def is_among(line_hash: Column, buckets: Column) -> Column:
    """Whether a hash is in the array that bucketed() made."""
    bucket = F.element_at(buckets, (F.pmod(line_hash["h1"], F.size(buckets)) + 1).cast("int"))
    return F.coalesce(F.array_contains(bucket, line_hash), F.lit(False))


def bucketed(hashes: Column) -> Column:
    """An array of hashes dealt into about the square root of its size of arrays, so that looking up each line of a document
    of n lines takes n times the square root of n steps and not n times n."""
    k = F.greatest(F.lit(1), F.floor(F.sqrt(F.size(hashes)))).cast("int")
    return F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.filter(hashes, lambda h: F.pmod(h["h1"], k) == i))


def dedup_lines(docs: DataFrame, batches: int | None = None, fanout: int = FANOUT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows and columns of docs with shared lines taken out of the text, then the number of lines and of dropped lines.

    These two columns are last and named __n_lines and __n_dropped, with more underscores where docs has such columns
    (see fresh_name). A line whose key (see key_of) has at least LEAST_CHARS code points and is found in at least
    LEAST_DOCS documents, counted by id, stays only in the largest id that holds it: there all its lines stay, everywhere
    else all go. Null and empty texts are one empty line and become the empty text. Rows repeated under one id are one
    document when counting and are all returned. Rows with a null id do not count and keep all their lines. An empty table
    gives an empty result. Other columns pass through unchanged.
    """
    keys = F.array_distinct(F.array_compact(F.transform(lines_of(F.col(text_col)), hash_of)))
    held = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.inline(keys)).distinct()
    goes = dropped_lines(held, batches, fanout).groupBy("doc_id").agg(F.collect_list(F.struct(*HASH)).alias("goes"))
    of, buckets, stays = (fresh_name(docs, x) for x in ("__id", "__goes", "__stays"))
    # What goes grows with the corpus: the join is planned as a merge at every size, so that no plan depends on a broadcast.
    goes = cut(goes.select(F.col("doc_id").alias(of), bucketed(F.col("goes")).alias(buckets)), "goes").hint("merge")
    lines = lines_of(F.col(text_col))
    joined = docs.join(goes, F.col(id_col) == F.col(of), "left")
    filtered = F.filter(lines, lambda line: ~F.coalesce(is_among(hash_of(line), F.col(buckets)), F.lit(False)))
    joined = joined.withColumn(stays, F.when(F.col(buckets).isNotNull(), filtered))
    text = F.coalesce(F.array_join(stays, "\n"), F.col(text_col), F.lit(""))
    n_lines = F.size(lines).cast("long")
    return joined.select(
        *(text.alias(c) if c == text_col else F.col(c) for c in docs.columns),
        n_lines.alias(fresh_name(docs, "__n_lines")),
        F.coalesce(n_lines - F.size(stays), F.lit(0)).cast("long").alias(fresh_name(docs, "__n_dropped")),
    )
