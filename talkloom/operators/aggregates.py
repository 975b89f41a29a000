"""Counts, weights, pivots and arg-max."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkloom.functions.text import company_of_affiliation, company_tail, filled, percentages

#: Ordinals of the closed vocabularies.
EVIDENCE_RANK = {"production_proven": 4, "benchmarked": 3, "case_study": 2, "anecdotal": 1}
TALK_EVIDENCE = ("production", "proof_of_concept", "theoretical", "vendor_demo")
RING_ORDER = ("hold", "assess", "trial", "adopt")
URGENCIES = ("immediate", "next_quarter", "long_term")


def rank_of(x: Column, ranks: dict[str, int | str], default: int | str = 0) -> Column:
    """What a fixed table gives for a value, and the default for others."""
    table = F.create_map(*(F.lit(v) for pair in ranks.items() for v in pair))
    return F.coalesce(F.try_element_at(table, x), F.lit(default))


def counts(df: DataFrame, key: Column, out: str, position: Column | None = None, weight: Column | None = None) -> DataFrame:
    """(out, n) for each value that is neither null nor empty, most first; ties in order of first sight, then by value."""
    seen = F.min(position if position is not None else F.lit(0)).alias("__seen")
    n = F.count("*") if weight is None else F.sum(weight)
    rows = df.withColumn(out, key).where(F.col(out).isNotNull() & (F.col(out).cast("string") != "")).groupBy(out).agg(n.alias("n"), seen)
    return rows.orderBy(F.desc("n"), "__seen", out).drop("__seen")


def company_presence(sessions: DataFrame, position: str = "_pos") -> DataFrame:
    """(company, n): speaker slots, not talks, of each company."""
    slots = sessions.select(F.col(position).alias("p"), F.posexplode("speakers").alias("i", "s"))
    return counts(slots, company_of_affiliation("s.company"), "company", F.struct("p", "i"))


def track_distribution(sessions: DataFrame, position: str = "_pos") -> DataFrame:
    return counts(sessions, F.col("track"), "track", F.col(position))


def weighted_keywords(top_keywords: DataFrame, cluster_keywords: DataFrame, n: int = 15) -> DataFrame:
    """(keyword, weight): 3 for each top keyword and 1 for each cluster keyword; both tables have keyword."""
    rows = top_keywords.select("keyword", F.lit(3).alias("w")).unionByName(cluster_keywords.select("keyword", F.lit(1).alias("w")))
    return rows.where("keyword <> ''").groupBy("keyword").agg(F.sum("w").alias("weight")).orderBy(F.desc("weight"), "keyword").limit(n)


def recount(counted: DataFrame, key: str, n_col: str = "n", most: int = 15) -> DataFrame:
    """Counts added up again after the key is reduced to its company."""
    rows = counted.groupBy(company_tail(key).alias(key)).agg(F.sum(n_col).alias(n_col)).where(F.col(key) != "")
    return rows.orderBy(F.desc(n_col), key).limit(most)


def evidence_by_cluster(members: DataFrame, scores: DataFrame) -> DataFrame:
    """(cluster, score, one column for each kind of evidence) of clusters that have any, best score first.

    members: cluster, evidence_quality. scores: name, relevance_score; clusters without a score have 0.
    """
    kinds = [F.count_if(F.col("evidence_quality") == k).alias(k) for k in TALK_EVIDENCE]
    rows = members.groupBy("cluster").agg(*kinds).where(" + ".join(TALK_EVIDENCE) + " > 0")
    s = scores.groupBy(F.col("name").alias("cluster")).agg(F.max("relevance_score").alias("score"))
    return rows.join(s, "cluster", "left").withColumn("score", F.coalesce("score", F.lit(0.0))).orderBy(F.desc("score"), "cluster")


def best_evidence(landscape: DataFrame, key: str = "technology", rank: Column | None = None, *order: Column) -> DataFrame:
    """The row of highest evidence rank of each technology; of equal ones the first."""
    rank = rank_of(F.col("evidence_quality"), EVIDENCE_RANK) if rank is None else rank
    first = Window.partitionBy(key).orderBy(F.desc("__rank"), *(order or (F.col("pos"),)))
    rows = landscape.where(filled(key) != "").withColumn("__rank", rank)
    return rows.withColumn("__nth", F.row_number().over(first)).where("__nth = 1").drop("__rank", "__nth")


def actions_by_urgency(actions: DataFrame) -> DataFrame:
    """(urgency, actions): arrays in order of position; a missing urgency is immediate."""
    urgency = F.coalesce(F.nullif("urgency", F.lit("")), F.lit("immediate"))
    rows = actions.withColumn("urgency", urgency).groupBy("urgency").agg(
        F.array_sort(F.collect_list(F.struct("pos", "action", "category", "source_cluster"))).alias("actions")
    )
    place = rank_of(F.col("urgency"), {u: i + 1 for i, u in enumerate(URGENCIES)}, 99)
    return rows.orderBy(place, "urgency")


def actions_in_order(actions: DataFrame) -> DataFrame:
    """(urgency, place, pos, action, category, source_cluster): the actions of actions_by_urgency as rows; place counts from 1 within an urgency.

    Ordered parts are numbered apart and begin where those before them end, so no task holds an urgency.
    """
    from talkloom.sources.artifacts import checkpointed

    order = ["pos", "action", "category", "source_cluster"]
    rows = actions.select(F.coalesce(F.nullif("urgency", F.lit("")), F.lit("immediate")).alias("urgency"), *order)
    rows = checkpointed(rows.repartitionByRange("urgency", *order).withColumn("__part", F.spark_partition_id()))
    sizes = rows.groupBy("urgency", "__part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("urgency").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("urgency", "__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    inside = Window.partitionBy("urgency", "__part").orderBy(*order)
    placed = rows.withColumn("__nth", F.row_number().over(inside)).join(begins, ["urgency", "__part"])
    return placed.select("urgency", (F.col("begin") + F.col("__nth")).alias("place"), *order)


def distinct_percentages(*texts: DataFrame) -> DataFrame:
    """(percentage) over tables with a column text."""
    out = None
    for t in texts:
        rows = t.select(F.explode(percentages("text")).alias("percentage"))
        out = rows if out is None else out.unionByName(rows)
    return out.distinct()


def known_people(sessions: DataFrame) -> DataFrame:
    """(kind, name): speakers by full name and last word of it, and companies."""
    s = sessions.select(F.explode("speakers").alias("s"))
    name = F.trim(filled("s.name"))
    words = F.split(name, r"\s+")
    people = s.select(
        F.lit("speaker").alias("kind"),
        F.explode(F.when(F.size(words) > 1, F.array(name, F.element_at(words, -1))).otherwise(F.array(name))).alias("name"),
    )
    companies = s.select(F.lit("company").alias("kind"), company_tail("s.company").alias("name"))
    return people.unionByName(companies).where("name <> ''").distinct()


def stakeholders(people: DataFrame, n: int = 15) -> DataFrame:
    return people.orderBy(F.desc("talk_count"), "role").limit(n)


def relevance_tier(score: Column) -> Column:
    return F.when(score >= 0.7, "cluster_deep_dive").when(score >= 0.4, "cluster_brief")


def failure_share(results: DataFrame) -> DataFrame:
    """One row: n, failed, warn (whether more than half failed)."""
    return results.agg(F.count("*").alias("n"), F.count_if(F.col("error").isNotNull()).alias("failed")).withColumn("warn", F.col("failed") * 2 > F.col("n"))


def in_parts(rows: DataFrame, key: str, order: str, text: str, budget: int, least: int = 1) -> DataFrame:
    """(key, part, payload): each key's texts in order as JSON lists of those that begin within so many characters of the list's
    first, but of ``least`` texts at least (the last list of a key may hold fewer).

    Texts are numbered and measured apart in ranges of the order, and the ranges' sums are added up, so no task holds a key.
    Rows of one key and order are one, the first by text; rows without a key go.
    """
    from talkloom.sources.artifacts import checkpointed

    one = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key"), F.col(order).alias("__order")).agg(F.min(text).alias("__text"))
    laid = checkpointed(one.repartitionByRange("__key", "__order").withColumn("__range", F.spark_partition_id()))
    size = F.length("__text") + 1
    sums = laid.groupBy("__key", "__range").agg(F.sum(size).alias("size"), F.count("*").alias("n"))
    before = Window.partitionBy("__key").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    begins = sums.select("__key", "__range", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"__{c}") for c in ("size", "n")))
    inside = Window.partitionBy("__key", "__range").orderBy("__order")
    placed = laid.join(begins, ["__key", "__range"]).withColumn("__nth", F.col("__n") + F.row_number().over(inside) - 1)
    placed = placed.withColumn("__at", F.col("__size") + F.sum(size).over(inside) - size)
    part = F.least(F.floor(F.col("__at") / budget), F.floor(F.col("__nth") / least)).cast("long")
    packed = F.array_sort(F.collect_list(F.struct("__order", "__text")))
    payload = F.concat(F.lit("["), F.array_join(F.transform(packed, lambda r: r["__text"]), ","), F.lit("]"))
    return placed.groupBy(F.col("__key").alias(key), part.alias("part")).agg(payload.alias("payload"))


def payload_parts(members: DataFrame, talks: DataFrame, fields: list[str], budget: int) -> DataFrame:
    """(cluster, part, payload): the talks of each cluster, as in cluster_payloads, in parts of bounded size."""
    rows = members.select("cluster", "title").distinct().join(talks.select(*dict.fromkeys(["title", *fields])), "title")
    return in_parts(rows.select("cluster", "title", F.to_json(F.struct(*fields)).alias("j")), "cluster", "title", "j", budget)


def cluster_payloads(members: DataFrame, talks: DataFrame, fields: list[str]) -> DataFrame:
    """(cluster, payload): the talks of each cluster as one JSON text, fields pruned, in order of title."""
    rows = members.select("cluster", "title").distinct().join(talks.select(*dict.fromkeys(["title", *fields])), "title")
    packed = F.array_sort(F.collect_list(F.struct("title", F.to_json(F.struct(*fields)).alias("j"))))
    return rows.groupBy("cluster").agg(F.concat(F.lit("["), F.array_join(F.transform(packed, lambda r: r["j"]), ","), F.lit("]")).alias("payload"))
