"""Keep-first, ordinals and other operators that depend on an explicit order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: Column, *order: Column) -> DataFrame:
    """The first row of each key in the given order. Rows with a null or empty key go.

    The row number is bounded before the shuffle, so a key with very many rows costs no more than others.
    """
    w = Window.partitionBy("__key").orderBy(*order)
    keyed = df.withColumn("__key", key).where("__key is not null and __key <> ''")
    return keyed.withColumn("__nth", F.row_number().over(w)).where("__nth = 1").drop("__key", "__nth")


def keep_last(df: DataFrame, key: Column, *order: Column) -> DataFrame:
    """The last value in the given order; other columns as in keep_first."""
    return keep_first(df, key, *(o.desc() for o in order))


def dense_labels(df: DataFrame, group: str, raw: str, out: str = "speaker", label: str = "Speaker ") -> DataFrame:
    """Raw labels, sorted within a group, become "Speaker 1", "Speaker 2", ..."""
    rank = F.dense_rank().over(Window.partitionBy(group).orderBy(raw))
    return df.withColumn(out, F.when(F.col(raw).isNotNull(), F.concat(F.lit(label), rank.cast("string"))))


def joined_text(text: Column, separator: str, *order: Column) -> Column:
    """Aggregate: texts in order, joined."""
    rows = F.array_sort(F.collect_list(F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order)), text.alias("t"))))
    return F.array_join(F.transform(rows, lambda r: r["t"]), separator)


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def unprocessed(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of work whose key is not done yet."""
    return work.join(done.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def looked_up(left: DataFrame, right: DataFrame, key: str, order: Column, **defaults) -> DataFrame:
    """Every row of left once, with the columns of the first row of right under its key; ``defaults`` fill what is missing."""
    first = keep_first(right.withColumn("__k", F.col(key).cast("string")), F.col("__k"), order).drop("__k")
    joined = left.join(first, key, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
