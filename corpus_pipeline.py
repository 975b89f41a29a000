"""A training corpus from documents: language ID, line dedup, near-dedup, mixing and packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of docs, whatever
more there are and however they are named. Repeated rows are rows like any other, but for near-dedup, which keeps one of an
id; rows without an id are never taken for copies of one another; ties go to the smaller id; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talkloom.llm import language, line_dedup, mixing, packing, simhash
from talkloom.llm.common import cut, fresh_name, mark, release, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known stay, with that language in lang; null, empty and letterless texts go.

    The model learns from the rows' own lang; where no row has one, no language is known.
    """
    return language.reject(docs, language.fit(docs, F.lit(True)))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines shared by many documents go from the text; n_chars follows. No document goes; null texts become empty."""
    cleaned = line_dedup.dedup_lines(docs)
    changed = F.col(fresh_name(docs, "__n_dropped")) > 0
    return cleaned.select(*(F.when(changed, F.length("text")).otherwise(F.col(c)).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one document stays, the first by id of those that lost least to line dedup.

    Line dedup has taken from copies the lines that they share, so groups are those of the texts before it; what stays is
    then grouped in the same way by the texts after it.
    """
    return simhash.keep_one(docs, table(spark, sf_dir, "documents").select("doc_id", "text"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document comes as often as the mix takes it, which may be never; documents are taken whole.

    Empty texts have no words to take and go. Rows alike in id and text share what the mix takes of them.
    """
    columns = docs.columns
    own, base, extra, nth, times = (fresh_name(docs, x) for x in ("__key", "__base", "__extra", "__nth", "__times"))
    mixed = mixing.mix(docs, table(spark, sf_dir, "labels"), whole=True)
    taken = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    # Rows alike in id and text: all come at least ``base`` times, the first ``extra`` once more. One key column serves
    # the join and the window, so the texts are dealt out once.
    key = lambda text_key: F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text_key)
    mixed = mixed.select(key(F.col("text_key")).alias(own), taken.alias("times")).groupBy(own)
    mixed = mixed.agg(F.min("times").alias(base), (F.sum("times") - F.min("times") * F.count("*")).alias(extra))
    mixed = cut(mixed.where(F.col(base) + F.col(extra) > 0), "mixed")
    joined = docs.withColumn(own, key(F.md5(F.coalesce("text", F.lit(""))))).join(mixed, own)
    joined = joined.withColumn(nth, F.row_number().over(Window.partitionBy(own).orderBy("source")))
    joined = joined.withColumn(times, (F.col(base) + F.when(F.col(nth) <= F.col(extra), 1).otherwise(0)).cast("int")).where(F.col(times) > 0)
    return joined.select(*columns, F.explode(F.sequence(F.lit(1), F.col(times))).alias(fresh_name(docs, "__copy"))).select(columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in the packed sequences; empty texts are pieces of length 0."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_shared_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: A trained model, XXH64 fingerprints and packing have no SQL; tests/llm holds each stage against what it must give.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over documents, each result written as a table and reread by the next.

    Once a result is written, all tables that went into it are removed.
    """
    docs, since = table(spark, sf_dir, "documents"), mark()
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut(docs, name)
            release(spark, since, keep=docs)
    return docs
