"""The steps of the whole job. Each reads artifact tables, plans lazily, and returns tables to be written."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkloom.console import say
from talkloom.functions import entities, grounding
from talkloom.functions.text import filled, tokens, urls
from talkloom.functions.time import clock
from talkloom.operators import aggregates, alignment, chunks, matching, ordering, reports, retrieval, sessions, validation, vector_index
from talkloom.plans import providers, synthesis
from talkloom.plans.synthesis import cluster_members
from talkloom.schemas import schema
from talkloom.sources.artifacts import checkpointed

__all__ = ["cluster_members"]


def clean_schedule(raw: DataFrame) -> DataFrame:
    """Coerced, cleaned, each title once."""
    return sessions.dedup(sessions.normalize(sessions.coerce(raw)))


def attach_slides(matched: DataFrame, slides: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Add slide_text, slide_descriptions, slide_references and slide_aligned; null where a video has no slides."""
    each = slides.select("video_id", F.posexplode("slides").alias("pos", "s")).select(
        "video_id", "pos", clock(F.col("s.timestamp_sec")).alias("ts"), "s.text", "s.description"
    )
    texts = each.groupBy("video_id").agg(
        ordering.joined_text(F.nullif(F.trim(filled("text")), F.lit("")), "\n\n", F.col("pos")).alias("slide_text"),
        ordering.joined_text(F.nullif(F.trim(filled("description")), F.lit("")), " | ", F.col("pos")).alias("slide_descriptions"),
    )
    texts = texts.withColumn("slide_references", urls(F.concat_ws(" ", "slide_text", "slide_descriptions")))
    segments = transcripts.select("video_id", F.posexplode("segments").alias("seq", "s")).select("video_id", "seq", "s.start", "s.text", "s.speaker")
    return matched.join(texts.join(alignment.aligned_text(each, segments), "video_id", "left"), "video_id", "left")


def match(schedule: DataFrame, transcripts: DataFrame, slides: DataFrame | None = None) -> DataFrame:
    """Sessions with their recording's transcript and slides; recordings of no session at the end."""
    out = matching.match_recordings(schedule, transcripts)
    return out if slides is None else attach_slides(out, slides, transcripts)


#: The fields that each of a talk's two calls answers, and the answers' budgets in tokens.
TALK_CALLS = (
    (
        "Summarise the talk from its transcript.",
        "summary key_takeaways problems_discussed tools_and_projects qa_highlights evidence_quality speaker_perspective references",
        4096,
    ),
    ("Assess the technologies that the talk names, from its transcript.", "maturity_assessments caveats_and_concerns technology_stance relationships", 4096),
)


def talks_to_analyze(matched: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """title, speakers and prompt of the talks that are worth a model's time and not done by title."""
    from talkloom.functions.text import speakers_text

    work = sessions.sections_of_interest(matched)
    if done is not None:
        work = ordering.unprocessed(work, done, "title")
    return work.select(
        "title",
        speakers_text("speakers", "Unknown").alias("speakers"),
        F.concat_ws("\n", F.concat(F.lit("Title: "), "title"), sessions.prompt_text()).alias("prompt"),
    )


def analyze_talks(
    matched: DataFrame, done: DataFrame | None = None, make=providers.LocalCompleter, waits: tuple[float, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """New talk analyses and the talks that failed (title, error). Talks that are done by title are not asked for again."""
    return analyze_work(talks_to_analyze(matched, done), make, waits)


def analyze_work(work: DataFrame, make=providers.LocalCompleter, waits: tuple[float, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Analyses and failures of rows (title, speakers, prompt): two calls for each, merged; each is made once."""
    kinds = {f.name: f.dataType for f in schema("talk").fields}
    parts = []
    for i, (ask, fields, budget) in enumerate(TALK_CALLS):
        kind = T.StructType([T.StructField(f, kinds[f]) for f in fields.split()])
        asked = providers.complete_json(work, ask, kind, make, max_tokens=budget, waits=waits, said="said")
        own = [F.col(f"parsed.{f}").alias(f) for f in fields.split()]
        extra = [F.col("said"), F.when(F.col("said").isNull(), F.col("error")).alias("failure"), "speakers"] if i == 0 else []
        parts.append(asked.select("title", *own, *extra))
    answered = checkpointed(sessions.merge_results(*parts))
    failed = answered.where("failure is not null").select("title", F.col("failure").alias("error"))
    # A local model answers in prose: its sentences are the summary and the takeaways, named technologies the tools.
    sentences = F.filter(F.split("said", r"(?<=[.!?])\s+"), lambda s: F.length(s) > 0)
    found = F.array_distinct(F.transform(F.regexp_extract_all("said", F.lit(entities.PATTERN), F.lit(0)), entities.canonical))
    in_use = F.lower("said").contains("in production")
    rated = F.transform(
        found,
        lambda t: F.struct(t.alias("technology"), F.when(in_use, "adopt").otherwise("assess").alias("maturity"), F.lit("").alias("evidence")),
    )
    spare = {
        "summary": F.array_join(F.slice(sentences, 1, 3), " "),
        "key_takeaways": F.slice(sentences, 1, 5),
        "tools_and_projects": found,
        "evidence_quality": F.when(in_use, "production").otherwise("theoretical"),
        "maturity_assessments": rated,
    }
    columns = []
    for f in schema("talk").fields:
        own = F.col(f.name) if f.name in answered.columns else F.lit(None)
        columns.append((F.coalesce(own.cast(f.dataType), spare[f.name].cast(f.dataType)) if f.name in spare else own.cast(f.dataType)).alias(f.name))
    talks = answered.where("failure is null").select(*columns)
    return sessions.without_blank_relationships(entities.canonical_talk(talks)), failed


#: Places that terms are hashed into; how much farther than the nearest centre another may be that a talk belongs to as well.
TERMS, MARGIN = 1024, 0.05


def centre_distances(features: DataFrame, centres: list[list[float]], name: str = "title") -> DataFrame:
    """(name, c, distance): the cosine distance of each row's vector (column x, an array) to each of a few centres. A row or centre of
    length zero is at distance 1."""
    import numpy as np
    import pandas as pd

    unit = np.array(centres, float)
    unit = unit / np.maximum(np.linalg.norm(unit, axis=1), 1e-12)[:, None]

    def each(batches):
        for batch in batches:
            for start in range(0, len(batch), 512):
                part = batch.iloc[start : start + 512]
                rows = np.array(part["x"].tolist(), float).reshape(len(part), -1)
                rows = rows / np.maximum(np.linalg.norm(rows, axis=1), 1e-12)[:, None]
                far = np.round(1 - rows @ unit.T, 12)
                yield pd.DataFrame({name: np.repeat(part[name].to_numpy(), len(unit)), "c": np.tile(np.arange(len(unit)), len(part)), "distance": far.ravel()})

    return features.select(name, "x").mapInPandas(each, f"{name} string, c int, distance double")


def overlapping(rows: DataFrame, k: int, seed: int = 7, margin: float = MARGIN) -> DataFrame:
    """rows (title, text, ...) once for each cluster ``c`` that they belong to: the nearest centre's, and those of centres hardly farther.

    Centres are those of k-means over the talks' TF-IDF weights, by angle, at most one for two talks. Titles are taken once.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import IDF, HashingTF
    from pyspark.ml.functions import vector_to_array

    rows = checkpointed(ordering.keep_first(rows, F.col("title"), F.col("text")))
    words = rows.withColumn("words", F.filter(F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), F.lit(0)), lambda t: F.length(t) > 2))
    weights = Pipeline(stages=[HashingTF(inputCol="words", outputCol="counts", numFeatures=TERMS), IDF(inputCol="counts", outputCol="features")])
    weighed = weights.fit(words).transform(words)
    weighed = checkpointed(weighed.select("title", "features", vector_to_array("features").alias("x")))
    some = weighed.where(F.exists("x", lambda v: v != 0))
    n = some.count()
    if n < 2:
        return rows.withColumn("c", F.lit(0))
    model = KMeans(k=max(2, min(k, n // 2)), seed=seed, distanceMeasure="cosine", featuresCol="features").fit(some)
    far = centre_distances(weighed, [[float(x) for x in c] for c in model.clusterCenters()])
    least = far.groupBy("title").agg(F.min("distance").alias("least"), F.min_by("c", F.struct("distance", "c")).alias("nearest"))
    member = far.join(least, "title").where((F.col("c") == F.col("nearest")) | ((F.col("distance") <= F.col("least") + margin) & (F.col("distance") < 1)))
    return rows.join(member.select("title", "c"), "title")


def cluster_talks(talks: DataFrame, schedule: DataFrame, k: int = 15, seed: int = 7) -> DataFrame:
    """The agenda (one row). Local default: overlapping clusters by TF-IDF; keywords are the clusters' most frequent terms."""
    rows = talks.select("title", F.concat_ws(" ", "title", "summary", "key_takeaways", "tools_and_projects").alias("text"))
    member = overlapping(rows, k, seed)
    first = schedule.select("title", "speakers", "track", *(c for c in ("_pos",) if c in schedule.columns))
    placed = ordering.looked_up(member, first, "title", F.col("_pos") if "_pos" in schedule.columns else F.to_json("speakers"))
    words = placed.select("c", F.explode(tokens("text")).alias("w")).groupBy("c", "w").agg(F.count("*").alias("n"))
    best = words.groupBy("c").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "w"))), 1, 8).alias("k")
    ).select("c", F.transform("k", lambda x: x["w"]).alias("keywords"))
    titles = placed.groupBy("c").agg(
        F.array_sort(F.collect_set("title")).alias("talks"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.transform("speakers", lambda s: s["company"]))))).alias("companies"),
    )
    name = F.initcap(F.array_join(F.slice("keywords", 1, 3), " "))
    clusters = titles.join(best, "c").select(
        F.struct(
            name.alias("name"),
            F.lit("").alias("description"),
            "talks",
            "keywords",
            F.array_remove(F.array_compact("companies"), "").alias("companies"),
        ).alias("x"),
        "c",
    )
    top = words.groupBy("w").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "w").limit(20).agg(
        F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "w"))).alias("t")
    )
    as_map = lambda df, key: df.agg(F.map_from_entries(F.collect_list(F.struct(F.col(key), F.col("n").cast("int")))).alias(key))
    positioned = schedule if "_pos" in schedule.columns else schedule.withColumn("_pos", F.lit(0))
    agenda = clusters.agg(F.transform(F.array_sort(F.collect_list(F.struct("c", "x"))), lambda r: r["x"]).alias("clusters"))
    one = F.lit(True)
    agenda = agenda.join(top, one).join(
        as_map(aggregates.company_presence(positioned), "company"), one
    ).join(as_map(aggregates.track_distribution(positioned), "track"), one)
    return agenda.select(
        "clusters",
        F.transform("t", lambda r: r["w"]).alias("top_keywords"),
        F.lit("").alias("narrative"),
        F.col("company").alias("company_presence"),
        F.col("track").alias("track_distribution"),
    )


def rank_clusters(agenda: DataFrame, topics: list[str]) -> DataFrame:
    """Local default: clusters by the share of the topics' terms that their keywords and titles hold, spread over 0..1."""
    wanted = sorted({w for t in topics for w in re.findall("[a-z0-9]+", t.lower()) if len(w) > 2})
    c = agenda.select(F.posexplode("clusters").alias("i", "c")).select("i", "c.*")
    mine = tokens(F.concat_ws(" ", "name", "keywords", "talks"))
    hits = F.size(F.array_intersect(mine, F.array(*(F.lit(w) for w in wanted)) if wanted else F.array().cast("array<string>")))
    rows = c.withColumn("raw", hits + F.size("talks") / 1000)
    from pyspark.sql import Window

    every = Window.partitionBy()  # a few dozen clusters
    score = F.when(F.max("raw").over(every) > 0, F.col("raw") / F.max("raw").over(every)).otherwise(0.0)
    nth = F.row_number().over(Window.orderBy(F.desc("raw"), "i"))
    return rows.select(
        "name",
        nth.alias("rank"),
        F.round(score, 4).alias("relevance_score"),
        F.concat_ws(" ", F.lit("Talks:"), F.size("talks").cast("string")).alias("summary"),
        F.concat_ws(", ", "keywords").alias("relevance_argument"),
        F.slice("talks", 1, 5).alias("recommended_talks"),
        F.lit("").alias("skip_reason"),
    ).orderBy("rank")


def synthesize(
    agenda: DataFrame, talks: DataFrame, done: DataFrame | None = None, make=providers.LocalCompleter, waits: tuple[float, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """New cluster syntheses (done ones are skipped by name), and the global one over new and done ones."""
    new = checkpointed(synthesis.by_cluster(agenda, talks, done, make, waits))
    every = new if done is None else new.unionByName(done.select(new.columns))
    return new, synthesis.over_all(every, make, waits)


def all_chunks(
    matched: DataFrame,
    transcripts: DataFrame,
    slides: DataFrame,
    talks: DataFrame,
    ranking: DataFrame,
    agenda: DataFrame,
    recordings: DataFrame,
) -> DataFrame:
    """The thirteen kinds of chunks, each id once."""
    return chunks.union_chunks(
        chunks.transcript_chunks(matched, transcripts),
        chunks.abstract_chunks(matched),
        chunks.talk_chunks(talks),
        chunks.cluster_chunks(ranking),
        chunks.narrative_chunks(agenda, recordings),
        chunks.slide_chunks(matched, slides),
        chunks.signal_chunks(recordings),
    )


def build_index(chunk_table: DataFrame, path: str, make=providers.HashedTerms) -> DataFrame:
    """Write the vector table, by kind and cell, or bring it up to the chunks (see vector_index.refresh); returns the counts."""
    done = vector_index.refresh(chunk_table, path, lambda rows: providers.embed(rows, make), ["chunk_type"])
    say("index", "{embedded} chunks embedded, {kept} kept, {gone} gone".format(**done))
    return chunks.chunk_counts(chunk_table)


NO_HITS = "No relevant content found in the index."


def ask(
    index: DataFrame | str,
    question: str,
    k: int = 15,
    types: list[str] | None = None,
    track: str | None = None,
    embedder=providers.HashedTerms,
    completer=providers.LocalCompleter,
) -> DataFrame:
    """One row (answer, context, hits). A k of 0 is the default. An index given by its path is searched by its cells."""
    asked, of_interest = embedder().embed([question])[0], lambda rows: retrieval.where_metadata(rows, types, track)
    if isinstance(index, str):
        hits = vector_index.search(SparkSession.getActiveSession(), index, asked, k or 15, of_interest)
    else:
        hits = retrieval.nearest(of_interest(index), asked, k or 15)
    row = retrieval.context(hits).withColumn("prompt", F.concat(F.coalesce("context", F.lit("")), F.lit(f"\n\nQuestion: {question}")))
    answer = providers.complete(row, "Answer from the context alone and name the sources.", completer)
    return answer.select(F.when(F.col("hits") == 0, NO_HITS).otherwise(F.col("answer.value")).alias("answer"), "context", "hits")


def outline(ranking: DataFrame, word_budget: int = 8000, appendix_strategy: str = "top_talks_only") -> DataFrame:
    """Local default: five fixed sections around deep dives and briefs by relevance."""
    fixed = [
        ("landscape", "Conference Landscape", 600, 1),
        ("cross_cutting", "Cross-Cutting Themes", 800, 50),
        ("tensions", "Debates and Tensions", 500, 60),
        ("maturity", "Technology Maturity", 500, 70),
        ("actions", "Recommended Actions", 400, 80),
    ]
    spark = ranking.sparkSession
    own = spark.createDataFrame(
        [(t, h, t, None, w, p) for t, h, w, p in fixed],
        "section_id string, title string, section_type string, cluster_name string, word_budget int, priority int",
    )
    from talkloom.functions.text import slug

    tier = aggregates.relevance_tier(F.col("relevance_score"))
    c = ranking.withColumn("tier", tier).where("tier is not null")
    c = c.select(
        F.concat(F.lit("cluster_"), F.replace(slug("name"), F.lit("-"), F.lit("_"))).alias("section_id"),
        F.col("name").alias("title"),
        F.col("tier").alias("section_type"),
        F.col("name").alias("cluster_name"),
        F.when(F.col("tier") == "cluster_deep_dive", 1000).otherwise(250).alias("word_budget"),
        (F.col("rank") + 1).alias("priority"),
    )
    rows = own.unionByName(c)
    packed = F.array_sort(F.collect_list(F.struct("priority", "section_id", "title", "section_type", "cluster_name", "word_budget")))
    fields = ["section_id", "title", "section_type", "cluster_name", "word_budget", "priority"]
    sections = F.transform(
        packed,
        lambda r: F.struct(*(r[f].alias(f) for f in fields), F.lit("").alias("guidance"), F.array().cast("array<string>").alias("source_talks")),
    )
    return rows.agg(
        F.lit("").alias("thesis"),
        F.lit(appendix_strategy).alias("appendix_strategy"),
        F.lit(word_budget).alias("total_word_budget"),
        sections.alias("sections"),
    )


def source_percentages(talks: DataFrame, clusters: DataFrame | None = None, recordings: DataFrame | None = None) -> DataFrame:
    """(percentage) that the sources hold. The validator looks at talks alone; the scrubber at syntheses too."""
    text = lambda df, *cols: df.select(F.concat_ws(" ", *cols).alias("text"))
    parts = [text(talks, "summary", "key_takeaways", "problems_discussed")]
    if clusters is not None:
        parts.append(text(clusters, "narrative", "common_problems"))
    if recordings is not None:
        parts.append(text(recordings, "narrative"))
    return aggregates.distinct_percentages(*parts)


def ground(sections: DataFrame, titles: DataFrame, grounded: DataFrame, people: DataFrame) -> DataFrame:
    """Drafts put right: citations to real titles (or dropped), titles in prose, figures, speakers, in this order."""
    cited = sections.select("section_id", F.posexplode("citations").alias("i", "c")).select(
        F.struct("section_id", "i").alias("candidate_id"), F.col("c.talk_title").alias("text")
    )
    real = matching.best_titles(cited, titles).select(
        F.col("candidate_id.section_id").alias("sid"), F.struct(F.col("candidate_id.i").alias("i"), "title").alias("x")
    )
    real = real.groupBy("sid").agg(F.map_from_entries(F.collect_list("x")).alias("real"))
    phrases = sections.select("section_id", F.explode(grounding.title_candidates("prose")).alias("text"))
    known = titles.select(F.col("title").alias("text")).distinct()
    strict = matching.best_titles(
        phrases.join(known, "text", "left_anti").select(F.struct("section_id", "text").alias("candidate_id"), "text"), titles, strict=True
    )
    swaps = strict.select(
        F.col("candidate_id.section_id").alias("swap_id"), F.struct(F.col("candidate_id.text").alias("text"), "title").alias("x")
    ).groupBy("swap_id").agg(F.map_from_entries(F.collect_set("x")).alias("swaps"))
    facts = grounded.agg(F.coalesce(F.collect_set("percentage"), F.array().cast("array<string>")).alias("grounded"))
    names = people.where("kind = 'speaker'").agg(F.collect_set(F.lower("name")).alias("names"))  # one schedule's speakers
    rows = sections.join(real, F.col("section_id") == F.col("sid"), "left").join(
        swaps, F.col("section_id") == F.col("swap_id"), "left"
    ).join(facts, F.lit(True)).join(names, F.lit(True))
    kept = F.filter(
        F.transform(
            "citations",
            lambda c, i: F.struct(F.try_element_at("real", i).alias("talk_title"), c["claim"].alias("claim"), c["needs_quote"].alias("needs_quote")),
        ),
        lambda c: c["talk_title"].isNotNull(),
    )
    prose = grounding.scrub_metrics(grounding.put_titles("prose", F.col("swaps")), F.col("grounded"))
    rows = rows.withColumn("prose", prose).withColumn("citations", F.coalesce(kept, F.array().cast(sections.schema["citations"].dataType)))
    return rows.withColumn("prose", grounding.scrub_speakers("prose", "names")).select(*sections.columns)


def quotes(sections: DataFrame, index: DataFrame, embedder=providers.HashedTerms, most: int = 3) -> DataFrame:
    """(section_id, talk_title, speaker, quote, timestamp_sec, video_id): for each citation that asks for one, the sentence
    of the chunk found for it that shares most words with the claim."""
    deep, _ = reports.enrichment_split(sections, most)
    claims = deep.select("section_id", F.posexplode("to_quote").alias("i", "c"))
    claims = claims.select(
        F.concat_ws(":", "section_id", F.col("i").cast("string")).alias("claim_id"),
        "section_id",
        F.col("c.talk_title").alias("talk_title_cited"),
        filled("c.claim").alias("text"),
        F.col("c.claim").alias("claim"),
    )
    claims = providers.embed(claims, embedder, "text", "claim_embedding").drop("text")
    found = retrieval.quote_sources(claims, index)
    sentences = F.filter(F.split(F.substring("text", 1, 3000), r"(?<=[.!?])\s+"), lambda s: F.length(s) > 20)
    scored = F.transform(sentences, lambda s: F.struct(F.size(F.array_intersect(tokens(s), tokens("claim"))).alias("n"), s.alias("s")))
    best = F.array_max(scored)
    return found.withColumn("q", best).where("q.n > 0").select(
        "section_id", "talk_title", "speakers", F.col("q.s").alias("quote"), F.col("start_time").alias("timestamp_sec"), "video_id"
    ).withColumnRenamed("speakers", "speaker")


def validate(sections: DataFrame, schedule: DataFrame, talks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Warnings and their counts."""
    found = validation.warnings(sections, aggregates.known_people(schedule), source_percentages(talks), talks.select("title"))
    return found, validation.stats(sections, found)


def load_index(spark: SparkSession, path: str) -> DataFrame:
    return vector_index.load(spark, path)


