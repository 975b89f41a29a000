"""Drafting of sections, weaving of quotes, and the executive summary.

A section's facts are one JSON text, made by joins and aggregates for its type. A model drafts from them; where its answer
is no JSON, as the local one's, the draft is made of the facts themselves: sentences for prose, the talks behind them for
citations. Every draft is then put right against the sources (see steps.ground).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkloom.functions.text import bullets, filled, strip
from talkloom.operators import aggregates, reports
from talkloom.operators.ordering import joined_text, keep_first
from talkloom.plans import providers
from talkloom.plans.synthesis import OF_TALK, cluster_members
from talkloom.schemas import schema

#: The answer's budget in tokens by type of section; companies shown in the landscape; characters of a preview.
BUDGETS = {"cluster_deep_dive": 6144, "cluster_brief": 2048, "landscape": 4096, "cross_cutting": 4096, "tensions": 4096, "maturity": 4096, "actions": 4096}
COMPANIES, KEYWORDS, PREVIEW = 20, 20, 500
CLUSTER_TYPES = ("cluster_deep_dive", "cluster_brief")
CITATIONS = "array<struct<talk_title:string,claim:string,needs_quote:boolean>>"


def _cites(titles: Column, claim: Column, quoted: bool) -> Column:
    return F.transform(titles, lambda x: F.struct(x.alias("talk_title"), claim.alias("claim"), F.lit(quoted).alias("needs_quote")))


def _facts(rows: DataFrame, kind: str, facts: Column, told: Column, cites: Column | None = None, cluster: Column | None = None) -> DataFrame:
    """kind, cluster_name, facts (JSON), told (prose from the facts), cites."""
    cluster = F.lit("") if cluster is None else cluster
    cites = F.array().cast(CITATIONS) if cites is None else cites.cast(CITATIONS)
    return rows.select(
        F.lit(kind).alias("kind"),
        filled(cluster).alias("cluster_name"),
        facts.alias("facts"),
        filled(told).alias("told"),
        F.coalesce(cites, F.array().cast(CITATIONS)).alias("cites"),
    )


def _sentences(*parts: Column) -> Column:
    return F.concat_ws("\n\n", *(F.nullif(p, F.lit("")) for p in parts))


def _deep_dives(agenda: DataFrame, talks: DataFrame, clusters: DataFrame) -> DataFrame:
    """A cluster's synthesis and its talks."""
    fields = [c for c in OF_TALK if c in talks.columns]
    members = cluster_members(agenda, talks)
    payload = aggregates.cluster_payloads(members, talks, fields)
    claim = F.try_element_at(F.filter("key_takeaways", lambda k: strip(k) != ""), F.lit(1))
    each = members.join(talks.select("title", "summary", claim.alias("claim")), "title")
    packed = F.array_sort(F.collect_list(F.struct("title", "summary", F.coalesce(F.nullif("claim", F.lit("")), filled("summary")).alias("claim"))))
    each = each.groupBy("cluster").agg(packed.alias("t"))
    told = F.array_join(F.transform("t", lambda r: F.concat(F.lit("**"), r["title"], F.lit("**: "), filled(r["summary"]))), "\n\n")
    cites = F.transform("t", lambda r: F.struct(r["title"].alias("talk_title"), r["claim"].alias("claim"), F.lit(True).alias("needs_quote")))
    first = keep_first(clusters, F.col("cluster_name"), F.col("_pos"))
    rows = first.join(payload, F.col("cluster_name") == F.col("cluster")).join(each, "cluster")
    facts = F.to_json(
        F.struct(
            F.struct(*(c for c in clusters.columns if c != "_pos")).alias("synthesis"),
            F.col("payload").alias("talks"),
            F.transform("t", lambda r: r["title"]).alias("available_titles"),
        )
    )
    return _facts(rows, "cluster_deep_dive", facts, _sentences(filled("narrative"), told), cites, F.col("cluster_name"))


def _briefs(ranking: DataFrame, clusters: DataFrame) -> DataFrame:
    """A cluster's narrative and themes, and the talks recommended of it."""
    picks = keep_first(ranking, F.col("name"), F.col("rank")).select("name", "recommended_talks", "relevance_argument")
    rows = keep_first(clusters, F.col("cluster_name"), F.col("_pos")).join(picks, F.col("cluster_name") == F.col("name"), "left")
    talks = F.coalesce("recommended_talks", F.array().cast("array<string>"))
    recommended = F.when(F.size(talks) > 0, F.concat(F.lit("Recommended: "), F.array_join(talks, ", "), F.lit("."))).otherwise("")
    facts = F.to_json(F.struct("narrative", "cross_cutting_themes", talks.alias("recommended_talks")))
    return _facts(
        rows,
        "cluster_brief",
        facts,
        _sentences(filled("narrative"), recommended),
        _cites(talks, filled("relevance_argument"), False),
        F.col("cluster_name"),
    )


def _landscape(agenda: DataFrame, talks: DataFrame) -> DataFrame:
    """Narrative, keywords, tracks, the companies most present, and how many talks and clusters there are."""
    companies = aggregates.recount(agenda.select(F.explode("company_presence").alias("company", "n")), "company", most=COMPANIES)
    top = companies.agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "company"))).alias("x")).select(
        F.transform("x", lambda r: F.struct(r["company"].alias("company"), (-r["o"]).alias("n"))).alias("companies")
    )
    rows = agenda.limit(1).join(top, F.lit(True)).join(talks.agg(F.count("*").alias("n_talks")), F.lit(True))
    keywords = F.slice(F.coalesce("top_keywords", F.array().cast("array<string>")), 1, KEYWORDS)
    facts = F.to_json(F.struct("narrative", keywords.alias("keywords"), "track_distribution", "companies", "n_talks", F.size("clusters").alias("n_clusters")))
    counted = F.concat(F.col("n_talks").cast("string"), F.lit(" talks fall into "), F.size("clusters").cast("string"), F.lit(" clusters."))
    said = F.when(F.size(keywords) > 0, F.concat(F.lit("Most was said about "), F.array_join(keywords, ", "), F.lit("."))).otherwise("")
    present = F.when(
        F.size("companies") > 0,
        F.concat(F.lit("Most present were "), F.array_join(F.transform("companies", lambda r: r["company"]), ", "), F.lit(".")),
    ).otherwise("")
    return _facts(rows, "landscape", facts, _sentences(filled("narrative"), counted, said, present))


def _listed(recordings: DataFrame, kind: str, column: str, line, titles) -> DataFrame:
    """A list of the global synthesis, a line of prose for each entry, and the talks behind it."""
    items = F.coalesce(F.col(column), F.array().cast(recordings.schema[column].dataType))
    told = F.array_join(F.transform(items, line), "\n\n")
    cites = F.flatten(F.transform(items, lambda x: _cites(F.coalesce(titles(x), F.array().cast("array<string>")), line(x), False)))
    return _facts(recordings.limit(1), kind, F.to_json(F.struct(items.alias(column))), told, cites)


def _maturity(clusters: DataFrame, recordings: DataFrame) -> DataFrame:
    """Of each technology the entry of best evidence, in order of ring."""
    best = reports.maturity_strip(clusters, recordings)
    packed = F.array_sort(
        F.collect_list(F.struct(F.coalesce("ring", F.lit("assess")).alias("ring"), "technology", "evidence_quality", "source_cluster"))
    ).alias("landscape")
    line = lambda r: F.concat(
        F.lit("- **"),
        r["technology"],
        F.lit("**: "),
        r["ring"],
        F.when(filled(r["evidence_quality"]) != "", F.concat(F.lit(" ("), r["evidence_quality"], F.lit(")"))).otherwise(""),
    )
    rows = best.agg(packed)
    return _facts(rows, "maturity", F.to_json(F.struct("landscape")), F.array_join(F.transform("landscape", line), "\n"))


def _actions(clusters: DataFrame, recordings: DataFrame) -> DataFrame:
    """Actions of all clusters by urgency; those of the global synthesis where clusters have none."""
    own = clusters.select("_pos", F.col("cluster_name").alias("source_cluster"), F.posexplode("recommended_actions").alias("i", "a"))
    own = own.select(F.struct("_pos", "i").alias("pos"), "a.action", "a.category", "a.urgency", "source_cluster")
    spare = recordings.select(F.posexplode("recommended_actions").alias("i", "a"))
    spare = spare.select(
        F.struct(F.lit(0).cast("long").alias("_pos"), "i").alias("pos"),
        "a.action",
        "a.category",
        "a.urgency",
        F.lit("").alias("source_cluster"),
    )
    empty = own.limit(1).agg(F.count("*").alias("n")).where("n = 0")
    every = own.unionByName(spare.join(F.broadcast(empty), F.lit(True)).drop("n"))
    grouped = aggregates.actions_by_urgency(every)
    place = aggregates.rank_of(F.col("urgency"), {u: i for i, u in enumerate(aggregates.URGENCIES)}, 99)
    packed = F.array_sort(
        F.collect_list(
            F.struct(
                place.alias("place"),
                "urgency",
                F.transform(
                    "actions",
                    lambda a: F.struct(a["action"].alias("action"), a["category"].alias("category"), a["source_cluster"].alias("source_cluster")),
                ).alias("actions"),
            )
        )
    )
    rows = grouped.agg(packed.alias("by_urgency"))
    head = lambda u: F.concat(F.lit("**"), F.initcap(F.replace(u, F.lit("_"), F.lit(" "))), F.lit("**\n\n"))
    told = F.array_join(F.transform("by_urgency", lambda g: F.concat(head(g["urgency"]), bullets(F.transform(g["actions"], lambda a: a["action"])))), "\n\n")
    return _facts(rows, "actions", F.to_json(F.struct("by_urgency")), told)


def facts_of(agenda: DataFrame, ranking: DataFrame, talks: DataFrame, clusters: DataFrame, recordings: DataFrame) -> DataFrame:
    """What each kind of section is drafted from, by kind and cluster. clusters and talks have _pos."""
    side = lambda x, s: F.concat(
        x[s]["position"],
        F.when(F.size(x[s]["supporting_talks"]) > 0, F.concat(F.lit(" ("), F.array_join(x[s]["supporting_talks"], ", "), F.lit(")"))).otherwise(""),
    )
    parts = [
        _deep_dives(agenda, talks, clusters),
        _briefs(ranking, clusters),
        _landscape(agenda, talks),
        _listed(
            recordings,
            "cross_cutting",
            "cross_cutting_themes",
            lambda x: F.concat(F.lit("**"), x["theme"], F.lit("** "), filled(x["description"])),
            lambda x: x["supporting_talks"],
        ),
        _listed(
            recordings,
            "tensions",
            "tensions",
            lambda x: F.concat(F.lit("**"), x["topic"], F.lit("**: "), side(x, "side_a"), F.lit(" against "), side(x, "side_b"), F.lit(".")),
            lambda x: F.array_distinct(
                F.concat(
                    F.coalesce(x["side_a"]["supporting_talks"], F.array().cast("array<string>")),
                    F.coalesce(x["side_b"]["supporting_talks"], F.array().cast("array<string>")),
                )
            ),
        ),
        _maturity(clusters, recordings),
        _actions(clusters, recordings),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def draft_schema() -> T.StructType:
    """What a model answers for a section: the part of a section that the outline does not give."""
    return T.StructType([f for f in schema("section").fields if f.name not in ("section_id", "title")])


def drafts(specs: DataFrame, facts: DataFrame, topics: list[str], make=providers.LocalCompleter, waits: tuple[float, ...] = ()) -> DataFrame:
    """section_id, title, prose, citations, key_takeaway and _pos of each section of the outline (specs, with _pos).

    Ids and titles are the outline's, whatever a model says. Sections that have no facts are drafted from their guidance.
    Sections that draw on everything are told which chapters come before, so as not to repeat them.
    """
    on = (F.col("section_type") == F.col("kind")) & (
        F.when(F.col("section_type").isin(*CLUSTER_TYPES), filled("cluster_name")).otherwise("") == F.col("of_cluster")
    )
    given = specs.join(facts.withColumnRenamed("cluster_name", "of_cluster"), on, "left")
    titles = F.array_sort(F.collect_list(F.when(F.col("section_type").isin(*CLUSTER_TYPES), F.struct("_pos", "title"))))
    chapters = specs.agg(F.array_join(F.transform(titles, lambda r: F.concat(F.lit("- "), r["title"])), "\n").alias("chapters"))  # one outline
    given = given.join(F.broadcast(chapters), F.lit(True))
    whole = F.col("section_type").isin("cross_cutting", "tensions", "maturity", "actions") & (F.col("chapters") != "")
    note = F.when(whole, F.concat(F.lit("Chapters of their own treat these topics; name them instead of repeating them:\n"), "chapters"))
    wanted = F.when(F.col("section_type") == "actions", F.concat(F.lit("Readers weigh these topics:\n"), F.lit("\n".join(f"- {x}" for x in topics))))
    guidance = F.when(filled("guidance") != "", F.concat(F.lit("Guidance: "), "guidance"))
    budget = F.concat(F.lit("At most "), F.col("word_budget").cast("string"), F.lit(" words."))
    prompt = F.concat_ws("\n\n", F.concat(F.lit("Section: "), "title"), guidance, note, wanted, budget, F.concat(F.lit("Facts: "), filled("facts")))
    rows, parts = given.withColumn("prompt", prompt), []
    for kind, tokens in BUDGETS.items():
        ask = "Draft the section from the facts alone, as JSON with prose, citations and key_takeaway."
        parts.append(providers.complete_json(rows.where(F.col("section_type") == kind), ask, draft_schema(), make, max_tokens=tokens, waits=waits))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    own = F.coalesce(F.nullif("parsed.prose", F.lit("")), F.nullif("told", F.lit("")), filled("guidance"))
    first = F.regexp_extract(F.regexp_replace(filled("told"), r"[*#]", ""), r"(?s)^\s*(.{20,200}?[.!?])(?:\s|$)", 1)
    return out.select(
        "section_id",
        "title",
        own.alias("prose"),
        F.coalesce("parsed.citations", "cites", F.array().cast(CITATIONS)).alias("citations"),
        F.coalesce(F.nullif("parsed.key_takeaway", F.lit("")), first).alias("key_takeaway"),
        "_pos",
    )


def woven(sections: DataFrame, quotes: DataFrame, make=providers.LocalCompleter, model: str = "local", waits: tuple[float, ...] = ()) -> DataFrame:
    """sections with the quotes found for them in their prose. Sections without one are as they were.

    The local default sets quotes under the prose, as block quotes with their speaker; a model weaves them in.
    """
    line = F.concat(
        F.lit("> "),
        F.regexp_replace("quote", r"(?U)\s+", " "),
        F.lit("\n>\n> — "),
        F.concat_ws(", ", F.nullif(filled("speaker"), F.lit("")), F.concat(F.lit("*"), "talk_title", F.lit("*"))),
    )
    told = quotes.where(filled("quote") != "").select("section_id", F.struct("talk_title", "timestamp_sec", line.alias("line")).alias("q"))
    told = told.groupBy(F.col("section_id").alias("of_section")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_set("q")), lambda q: q["line"]), "\n\n").alias("quoted")
    )
    both = sections.join(told, F.col("section_id") == F.col("of_section"), "left").drop("of_section")
    if model == "local":
        return both.withColumn("prose", F.concat_ws("\n\n", "prose", "quoted")).drop("quoted")
    asked = both.where("quoted is not null").withColumn("prompt", F.concat(F.col("prose"), F.lit("\n\nQuotes:\n\n"), F.col("quoted")))
    done = providers.complete(asked, "Weave the quotes into the prose, word for word, and change nothing else.", make, max_tokens=6144, waits=waits)
    done = done.withColumn("prose", F.coalesce(F.nullif("answer.value", F.lit("")), F.concat_ws("\n\n", "prose", "quoted"))).select(*sections.columns)
    return done.unionByName(both.where("quoted is null").select(*sections.columns))


def executive_summary(
    sections: DataFrame,
    actions: DataFrame,
    name: str,
    thesis: str,
    topics: list[str],
    make=providers.LocalCompleter,
    waits: tuple[float, ...] = (),
) -> DataFrame:
    """One row (summary, key_findings, top_actions) from the sections' takeaways and the beginnings of their prose.

    sections: title, prose, key_takeaway, _pos. actions: action, place; the local default's top actions are their first five.
    """
    order = (F.col("_pos"),)
    takeaway = F.when(filled("key_takeaway") != "", F.concat(F.lit("- **"), "title", F.lit("**: "), "key_takeaway"))
    preview = F.concat(
        F.lit("## "),
        "title",
        F.lit("\nKey takeaway: "),
        filled("key_takeaway"),
        F.lit("\nPreview: "),
        F.substring(filled("prose"), 1, PREVIEW),
        F.lit("..."),
    )
    found = F.transform(
        F.filter(F.array_sort(F.collect_list(F.struct("_pos", F.nullif(filled("key_takeaway"), F.lit("")).alias("k")))), lambda r: r["k"].isNotNull()),
        lambda r: r["k"],
    )
    rows = sections.agg(joined_text(takeaway, "\n", *order).alias("takeaways"), joined_text(preview, "\n\n---\n\n", *order).alias("body"), found.alias("found"))
    acts = actions.groupBy("action").agg(F.min("place").alias("place")).orderBy("place", "action").limit(5)
    rows = rows.join(acts.agg(F.array_sort(F.collect_list(F.struct("place", "action"))).alias("acts")), F.lit(True))
    told = F.coalesce(F.nullif("takeaways", F.lit("")), F.lit("No takeaways available."))
    head = F.lit(f"Conference: {name}\nThesis: {thesis}\nTopics:\n" + "\n".join(f"- {x}" for x in topics))
    asked = rows.withColumn("prompt", F.concat_ws("\n\n", head, told, "body"))
    got = providers.complete_json(
        asked,
        "Write the executive summary as JSON with summary, key_findings and top_actions.",
        schema("summary"),
        make,
        max_tokens=4096,
        waits=waits,
    )
    return got.select(
        F.coalesce(F.nullif("parsed.summary", F.lit("")), F.array_join(F.slice("found", 1, 3), " ")).alias("summary"),
        F.when(F.size("parsed.key_findings") > 0, F.col("parsed.key_findings")).otherwise(F.col("found")).alias("key_findings"),
        F.when(F.size("parsed.top_actions") > 0, F.col("parsed.top_actions")).otherwise(F.transform("acts", lambda a: a["action"])).alias("top_actions"),
    )
