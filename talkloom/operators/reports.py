"""Tables behind the reports: appendix, order of sections, brief merging, charts, links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkloom.functions.text import filled
from talkloom.operators.aggregates import RING_ORDER, best_evidence, rank_of, relevance_tier
from talkloom.operators.matching import resolve_titles
from talkloom.operators.ordering import keep_first

#: Charts that sections carry, and what each role should read.
SECTION_CHARTS = {
    "landscape": (
        ("images/track_distribution.svg", "Track Distribution"),
        ("images/company_presence.svg", "Company Presence"),
        ("images/topic_frequency.svg", "Top Conference Topics"),
        ("images/evidence_quality.svg", "Evidence Quality by Cluster"),
    ),
    "maturity": (("images/maturity_strip.svg", "Technology Maturity Landscape"),),
}
ROLE_SECTIONS = {
    "Platform Engineers": ("cluster_platform", "cluster_operators", "cluster_scheduling", "actions"),
    "SREs & Operations": ("cluster_observability", "cluster_ai_ml", "maturity", "actions"),
    "Security Leads": ("cluster_security", "cluster_supply_chain", "tensions"),
}
BRIEF_BELOW = 2500
DETAIL = ("summary", "key_takeaways", "evidence_quality", "speaker_perspective", "tools_and_projects")


def appendix(talks: DataFrame, ranking: DataFrame, agenda: DataFrame, outline: DataFrame | None = None, strategy: str = "top_talks_only") -> DataFrame:
    """(pos, title, cluster and the talk's details), by one of three strategies.

    top_talks_only: recommended talks, each recommended title once, only where it resolves to a talk. by_cluster: every
    talk of every cluster, with details only in deep-dive clusters. none: no row. talks have title and _pos.
    """
    if strategy == "by_cluster":
        rows = agenda.select(F.posexplode("clusters").alias("i", "c")).select(
            "i", F.col("c.name").alias("cluster"), F.posexplode("c.talks").alias("j", "wanted")
        )
    else:
        rows = ranking.select(F.col("rank").alias("i"), F.col("name").alias("cluster"), F.posexplode("recommended_talks").alias("j", "wanted"))
        rows = keep_first(rows, F.col("wanted"), F.col("i"), F.col("j")) if strategy == "top_talks_only" else rows.limit(0)
    titles = talks.select("title", F.col("_pos").alias("pos"))
    found = resolve_titles(rows, titles)
    detail = talks.groupBy(F.col("title").alias("resolved")).agg(*(F.max_by(c, "_pos").alias(c) for c in DETAIL))
    # Titles that resolve to nothing find no details; their rows are dealt out by a number, or all would come to one task.
    alone = F.concat(F.lit("0"), F.xxhash64("wanted", "cluster", "i", "j").cast("string"))
    found = found.withColumn("__key", F.coalesce(F.concat(F.lit("1"), "resolved"), alone))
    found = found.join(detail.select(F.concat(F.lit("1"), "resolved").alias("__key"), *DETAIL), "__key", "left")
    if strategy == "by_cluster":
        deep = F.array().cast("array<string>") if outline is None else None
        if outline is not None:
            names = outline.select(F.explode("sections").alias("s")).where("s.section_type = 'cluster_deep_dive'").select(
                F.col("s.cluster_name").alias("cluster")
            ).distinct()
            found = found.join(names.withColumn("deep", F.lit(True)), "cluster", "left")
        else:
            found = found.withColumn("deep", F.size(deep) > 0)
        full = F.coalesce("deep", F.lit(False)) & F.col("resolved").isNotNull()
    else:
        found, full = found.where("resolved is not null"), F.lit(True)
    empty = {"key_takeaways": F.array().cast("array<string>"), "tools_and_projects": F.array().cast("array<string>")}
    cols = [F.when(full, F.col(c)).otherwise(empty.get(c, F.lit(""))).alias(c) for c in DETAIL]
    return found.select(
        F.struct("i", "j").alias("pos"), F.when(full, F.col("resolved")).otherwise(F.col("wanted")).alias("title"), "cluster", *cols
    ).orderBy("pos", "cluster", "title")  # places alone would deal all rows of one place, as of many agendas, to one task


def in_order(sections: DataFrame, specs: DataFrame) -> DataFrame:
    """Sections by the outline's priority (99 where it has none), then position; specs: section_id, priority, section_type."""
    s = specs.groupBy("section_id").agg(
        F.min("priority").alias("priority"),
        F.first("section_type", ignorenulls=True).alias("section_type"),
        F.first("cluster_name", ignorenulls=True).alias("cluster_name"),
    )
    return sections.join(s, "section_id", "left").withColumn("priority", F.coalesce("priority", F.lit(99))).orderBy("priority", "_pos")


def thin_briefs(sections: DataFrame) -> Column:
    """Whether a section is a brief short enough to be merged with others."""
    return (F.coalesce("section_type", F.lit("")) == "cluster_brief") & (F.length(filled("prose")) < BRIEF_BELOW)


def enrichment_split(sections: DataFrame, most_quotes: int = 3) -> tuple[DataFrame, DataFrame]:
    """Deep dives with the citations to quote (at most most_quotes), and the sections that pass through."""
    asks = F.slice(
        F.filter(
            F.coalesce("citations", F.array().cast("array<struct<talk_title:string,claim:string,needs_quote:boolean>>")),
            lambda c: F.coalesce(c["needs_quote"], F.lit(False)),
        ),
        1,
        most_quotes,
    )
    marked = sections.withColumn("to_quote", asks).withColumn("__deep", (F.col("section_type") == "cluster_deep_dive") & (F.size("to_quote") > 0))
    marked = marked.withColumn("__deep", F.coalesce("__deep", F.lit(False)))
    return marked.where("__deep").drop("__deep"), marked.where("not __deep").drop("__deep", "to_quote")


def reading_guide(spark, sections: DataFrame) -> DataFrame:
    """(role, place, section_id, title) of the sections that a role should read; a key stands for ids that hold it."""
    rows = [(role, i, key) for role, keys in ROLE_SECTIONS.items() for i, key in enumerate(keys)]
    guide = spark.createDataFrame(rows, "role string, place int, key string")
    return sections.select("section_id", "title").join(F.broadcast(guide), F.contains("section_id", "key")).select("role", "place", "section_id", "title")


def section_charts(spark) -> DataFrame:
    rows = [(s, i, *c) for s, charts in SECTION_CHARTS.items() for i, c in enumerate(charts)]
    return spark.createDataFrame(rows, "section_type string, place int, path string, caption string")


def cluster_relevance(ranking: DataFrame) -> DataFrame:
    """Chart data: clusters by score with the tier that the score falls in."""
    return ranking.select("name", "relevance_score", relevance_tier(F.col("relevance_score")).alias("tier")).orderBy(F.desc("relevance_score"), "name")


def maturity_strip(clusters: DataFrame, recordings: DataFrame) -> DataFrame:
    """(technology, ring, evidence_quality): the best evidence over clusters, or the global list (its last word) if they have none."""
    each = clusters.select("_pos", "cluster_name", F.posexplode("maturity_landscape").alias("i", "m")).select(
        F.struct("_pos", "i").alias("pos"), F.col("cluster_name").alias("source_cluster"), "m.*"
    )
    best = best_evidence(each).select("technology", "ring", "evidence_quality", "source_cluster")
    last = recordings.select(F.posexplode("maturity_landscape").alias("i", "m")).select("i", "m.*").where(filled("technology") != "")
    last = last.groupBy("technology").agg(F.max_by("ring", "i").alias("ring"), F.max_by("evidence_quality", "i").alias("evidence_quality"))
    none = best.limit(1).agg(F.count("*").alias("n")).where("n = 0")
    spare = last.join(F.broadcast(none), F.lit(True)).select("technology", "ring", "evidence_quality", F.lit(None).cast("string").alias("source_cluster"))
    return best.unionByName(spare).orderBy("technology")


def ring_place(ring: Column) -> Column:
    return rank_of(ring, {r: i for i, r in enumerate(RING_ORDER)}, 0)


def section_counts(sections: DataFrame, appendix_rows: DataFrame, summary_words: int = 0) -> DataFrame:
    """One row of report metadata."""
    words = F.size(F.filter(F.split(filled("prose"), r"\s+"), lambda w: w != ""))
    s = sections.agg(F.count("*").alias("sections"), F.coalesce(F.sum(words), F.lit(0)).alias("words"))
    return s.join(appendix_rows.agg(F.count("*").alias("appendix_talks")), F.lit(True))
