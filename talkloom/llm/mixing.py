"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A document's key is -ln(u) / w, with u drawn by a hash of the document and w its quality weight; the smallest
keys of a source are a weighted sample without replacement. A source first gives as many complete epochs as its
target holds, then the documents of smallest key until the rest of the target is spent.

Prefix sums are taken in two levels, so that no task holds a source: documents fall into slices of about
``SLICE`` neighbours in key order; sums over slices give where each slice begins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkloom.llm.common import cut, word_count

#: Production parameters.
WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MOST_EPOCHS = 2
SLICE = 500
#: Quality weight of a document labelled 1, labelled 0, and not labelled.
QUALITY = (2.0, 0.5, 1.0)


def uniform(*parts: Column) -> Column:
    """In (0, 1), drawn from the parts by MD5, the same in every run and engine."""
    text = F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return (F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, most: int = MOST_EPOCHS) -> DataFrame:
    """Add target to a table of one row for each source (source, source_size).

    Sharing the budget by weight, with the excess over ``most`` times a source's size shared anew until none is
    above, ends where every source has the lesser of its cap and weight times one common level. Sources taken by
    the level that fills them, lowest first, give that level in closed form.
    """
    everywhere = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(everywhere) - 1, F.lit(len(weights)))
    weighed = sources.withColumn("w", F.element_at(F.array(*(F.lit(float(x)) for x in weights)), place.cast("int") + 1))
    weighed = weighed.withColumn("cap", F.col("source_size") * float(most)).withColumn("full_at", F.col("cap") / F.col("w"))
    before = Window.orderBy("full_at", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    share = budget * F.sum("source_size").over(every)
    level = (share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    final = weighed.withColumn("level", level)
    # The common level is that of the first source which its own level does not fill; from there on levels only fall.
    final = final.withColumn("level", F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(every))
    return final.withColumn("target", F.round(F.least("cap", F.coalesce(F.col("level") * F.col("w"), "cap")), 6))


def mix(
    docs: DataFrame,
    quality: DataFrame | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    budget: float = BUDGET,
    most: int = MOST_EPOCHS,
    whole: bool = False,
    slice_rows: int = SLICE,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row for each row of docs: id, size, source_size, target, taken, and text_key, which tells rows of one id apart.

    quality (id, quality 0/1) weighs documents: repeated or contradicting labels are averaged, unlabelled
    documents weigh as QUALITY says. taken counts words: complete epochs times size, and of the document at which
    the rest of the target runs out the words that are left of it; with ``whole`` that document is taken whole if
    at least half of it was left, and not at all otherwise. Null sources are one source, placed last. Null and empty texts have size 0
    and nothing is taken of them. Ties in key are broken by id and text; rows alike in both are interchangeable.
    An empty table gives an empty result. Columns other than those named are ignored.
    """
    sized = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key")
    )
    if quality is None:
        sized = sized.withColumn("w", F.lit(QUALITY[2]))
    else:
        good, poor, unknown = (F.lit(x) for x in QUALITY)
        marked = quality.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.avg("quality").alias("q"))
        sized = sized.join(marked, "id", "left").withColumn("w", F.coalesce(poor + (good - poor) * F.col("q"), unknown)).drop("q")
    drawn = -F.log(uniform(F.col("id"), F.col("text_key"))) / F.col("w")
    sized = cut(sized.withColumn("key", F.round(drawn, 12)).drop("w"), "sized")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    sources = cut(targets(sources, weights, budget, most).select("source", "source_size", "target", "n"), "targets")
    placed = sized.join(sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    slices = F.ceil(F.col("n") / slice_rows)
    placed = placed.withColumn("slice", F.least(F.floor(slices * (1 - F.exp(-F.col("key")))), slices - 1).cast("long"))
    sums = cut(placed.groupBy("source", "slice").agg(F.sum("size").alias("s")), "slices")
    so_far = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    begins = sums.select(F.col("source").alias("of"), F.col("slice").alias("nth"), F.coalesce(F.sum("s").over(so_far), F.lit(0)).alias("begin"))
    inside = Window.partitionBy("source", "slice").orderBy("key", F.col("id").asc_nulls_last(), "text_key").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.join(begins, F.col("source").eqNullSafe(F.col("of")) & (F.col("slice") == F.col("nth")))
    before = F.col("begin") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    goal = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0).cast("long")
    left = goal - epochs * F.col("source_size") - before
    if whole:
        part = F.when((left >= F.col("size")) | (left * 2 >= F.col("size")) & (left > 0), F.col("size")).otherwise(0)
    else:
        part = F.greatest(F.lit(0), F.least(F.col("size"), left))
    taken = (epochs * F.col("size") + part).cast("long").alias("taken")
    return placed.select(F.col("id").alias(id_col), "size", "source_size", "target", taken, "text_key")
