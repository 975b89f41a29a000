"""Synthesis in two reduces, over each cluster's talks and over all clusters, of four answers each.

The four calls are independent: narrative with themes and problems, signals, tensions with maturity, actions. Each is
parsed under its own part of the schema. Where a model gives no JSON, as the local one, that part is an aggregate of the
talks: what their analyses hold already, counted and put in order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkloom.functions.text import filled, strip
from talkloom.operators import aggregates, matching, ordering
from talkloom.plans import providers
from talkloom.schemas import schema
from talkloom.sources.artifacts import checkpointed


@dataclass(frozen=True)
class Call:
    """One of the four calls: what is asked, the fields of its answer, and the answer's budget in tokens."""

    name: str
    ask: str
    fields: tuple[str, ...]
    max_tokens: int


CALLS = (
    Call(
        "narrative",
        "Tell what connects these talks, and list cross-cutting themes and common problems.",
        ("narrative", "cross_cutting_themes", "common_problems"),
        8192,
    ),
    Call("signals", "List emerging technologies and how technologies relate to each other.", ("emerging_technologies", "technology_relationships"), 4096),
    Call("tensions", "List where speakers disagree, and how mature each technology is.", ("tensions", "maturity_landscape"), 6144),
    Call("actions", "List what a reader should do.", ("recommended_actions",), 4096),
)
#: Fields of a talk that a cluster's prompt holds, and of a cluster that the conference's prompt holds.
#: Characters of talks' analyses that one prompt begins with at most.
BUDGET = 200_000
OF_TALK = (
    "title speakers summary key_takeaways tools_and_projects problems_discussed evidence_quality speaker_perspective maturity_assessments caveats_and_concerns technology_stance relationships"
).split()
OF_CLUSTER = "cluster_name narrative cross_cutting_themes common_problems emerging_technologies technology_relationships tensions maturity_landscape recommended_actions".split()
#: Most entries of each list that is aggregated locally.
MOST = 12


def cluster_members(agenda: DataFrame, talks: DataFrame) -> DataFrame:
    """(cluster, title) with titles resolved to talks; what does not resolve goes."""
    listed = agenda.select(F.explode("clusters").alias("c")).select(F.col("c.name").alias("cluster"), F.explode("c.talks").alias("wanted"))
    got = matching.resolve_titles(listed, talks.select("title", F.col("_pos").alias("pos")))
    return got.where("resolved is not null").select("cluster", F.col("resolved").alias("title")).distinct()


def answers(prompts: DataFrame, key: str, system: str, make=providers.LocalCompleter, waits: tuple[float, ...] = ()) -> DataFrame:
    """key, one column for each field of the four answers, and said, the narrative call's plain answer. Rows: key, prompt.

    Each call is made once for each row; the table is cut, so that nothing that reads it asks again.
    """
    kinds = {f.name: f.dataType for f in schema("synthesis").fields}
    out = checkpointed(prompts.select(key, "prompt"))
    for call in CALLS:
        part = T.StructType([T.StructField(f, kinds[f]) for f in call.fields])
        asked = providers.complete_json(out, f"{system} {call.ask}", part, make, max_tokens=call.max_tokens, waits=waits, said="__said")
        fields = [F.col(f"parsed.{f}").alias(f) for f in call.fields]
        said = [F.col("__said").alias("said")] if call.name == "narrative" else []
        out = checkpointed(asked.select(*out.columns, *fields, *said))
    related = F.filter("technology_relationships", lambda r: strip(r["entity_a"]) != "")
    return out.withColumn("technology_relationships", related).drop("prompt")


def _top(df: DataFrame, key: str, order: list[Column], out: str, kind: T.DataType) -> DataFrame:
    """key and an array of its first MOST rows as structs of the kind."""
    fields = kind.elementType.fieldNames()
    nth = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    rows = df.withColumn("__n", nth).where(F.col("__n") <= MOST)
    packed = F.array_sort(F.collect_list(F.struct("__n", F.struct(*fields).alias("x"))))
    return rows.groupBy(key).agg(F.transform(packed, lambda r: r["x"]).cast(kind).alias(out))


def aggregated(members: DataFrame, talks: DataFrame) -> DataFrame:
    """cluster and every list field of a synthesis as an aggregate of its talks' analyses."""
    kinds = {f.name: f.dataType for f in schema("synthesis").fields}
    mine = members.join(talks, "title")
    each = lambda column, name="x": mine.select("cluster", "title", F.explode(column).alias(name))
    talks_of = F.array_sort(F.collect_set("title")).alias("supporting_talks")

    tools = each("tools_and_projects", "technology").where(strip("technology") != "").groupBy("cluster", "technology").agg(
        F.count_distinct("title").cast("int").alias("mentions"), talks_of
    )
    emerging = _top(
        tools.withColumn("context", F.lit("")),
        "cluster",
        [F.desc("mentions"), F.col("technology")],
        "emerging_technologies",
        kinds["emerging_technologies"],
    )
    themes = tools.where("mentions > 1").select(
        "cluster",
        F.col("technology").alias("theme"),
        F.concat(F.lit("Comes up in "), F.col("mentions").cast("string"), F.lit(" talks.")).alias("description"),
        "supporting_talks",
    )
    themes = _top(themes, "cluster", [F.desc(F.size("supporting_talks")), F.col("theme")], "cross_cutting_themes", kinds["cross_cutting_themes"])
    problems = each("problems_discussed").where(strip("x") != "").groupBy("cluster", F.col("x").alias("p")).agg(F.count_distinct("title").alias("n"))
    first = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "p")))
    problems = problems.groupBy("cluster").agg(F.transform(F.slice(first, 1, MOST), lambda r: r["p"]).alias("common_problems"))
    edges = each("relationships").where(strip("x.entity_a") != "").groupBy("cluster", "x.entity_a", "x.relation", "x.entity_b").agg(talks_of)
    related = _top(
        edges,
        "cluster",
        [F.desc(F.size("supporting_talks")), F.col("entity_a"), F.col("relation"), F.col("entity_b")],
        "technology_relationships",
        kinds["technology_relationships"],
    )

    rated = each("maturity_assessments").where(strip("x.technology") != "")
    rated = rated.groupBy("cluster", F.col("x.technology").alias("technology")).agg(
        F.mode(F.col("x.maturity"), True).alias("ring"), talks_of, F.max("x.evidence").alias("rationale")
    )
    rated = rated.withColumn("evidence_quality", F.when(F.size("supporting_talks") > 1, "case_study").otherwise("anecdotal"))
    maturity = _top(rated, "cluster", [F.desc(F.size("supporting_talks")), F.col("technology")], "maturity_landscape", kinds["maturity_landscape"])

    # Speakers disagree about a technology of which some are enthusiastic and others critical or cautious.
    stance = each("technology_stance").select(
        "cluster", "title", F.col("x.technology").alias("topic"), F.col("x.stance").alias("stance")
    ).where(strip("topic") != "")
    of = lambda *kinds_: F.array_sort(F.collect_set(F.when(F.col("stance").isin(*kinds_), F.col("title"))))
    sides = stance.groupBy("cluster", "topic").agg(
        of("enthusiastic").alias("pro"), of("critical", "cautious").alias("con"), of("critical").alias("hard")
    ).where("size(pro) > 0 and size(con) > 0")
    side = lambda position, who: F.struct(F.lit(position).alias("position"), F.col(who).alias("supporting_talks"))
    sides = sides.select(
        "cluster",
        "topic",
        side("enthusiastic", "pro").alias("side_a"),
        side("critical or cautious", "con").alias("side_b"),
        F.when(F.size("hard") > 1, "fundamental").when(F.size("hard") > 0, "significant").otherwise("minor").alias("severity"),
        F.concat(F.lit("Weigh both sides before adopting "), "topic", F.lit(".")).alias("implication"),
        (F.size("pro") + F.size("con")).alias("n"),
    )
    tensions = _top(sides, "cluster", [F.desc("n"), F.col("topic")], "tensions", kinds["tensions"])

    # What to do follows from the ring of a technology; caveats are to be watched.
    verb = {
        "adopt": ("Adopt ", "adopt", "immediate"),
        "trial": ("Evaluate ", "evaluate", "next_quarter"),
        "assess": ("Watch ", "watch", "long_term"),
        "hold": ("Avoid ", "avoid", "immediate"),
    }
    pick = lambda i: aggregates.rank_of(F.lower(filled("ring")), {k: v[i] for k, v in verb.items()}, verb["assess"][i])
    support = F.concat(
        F.size("supporting_talks").cast("string"),
        F.lit(" talks"),
        F.when(filled("rationale") != "", F.concat(F.lit(": "), "rationale")).otherwise(""),
    )
    acts = rated.select(
        "cluster", F.concat(pick(0), F.col("technology")).alias("action"), pick(1).alias("category"), pick(2).alias("urgency"), support.alias("supporting_evidence"), F.size("supporting_talks").alias("n")
    )
    caveats = each("caveats_and_concerns").where(strip("x") != "").groupBy("cluster", F.col("x").alias("action")).agg(F.count_distinct("title").alias("n"))
    caveats = caveats.select(
        "cluster",
        F.concat(F.lit("Watch: "), "action").alias("action"),
        F.lit("watch").alias("category"),
        F.lit("long_term").alias("urgency"),
        F.lit("").alias("supporting_evidence"),
        F.col("n").cast("int").alias("n"),
    )
    actions = _top(acts.unionByName(caveats), "cluster", [F.desc("n"), F.col("action")], "recommended_actions", kinds["recommended_actions"])

    people = mine.where(strip("speaker_perspective") != "").groupBy("cluster", F.col("speaker_perspective").alias("role")).agg(
        F.count_distinct("title").cast("int").alias("talk_count")
    )
    stakeholders = _top(people, "cluster", [F.desc("talk_count"), F.col("role")], "stakeholder_map", kinds["stakeholder_map"])
    out = members.select("cluster").distinct()
    for part in (emerging, themes, problems, related, maturity, tensions, actions, stakeholders):
        out = out.join(part, "cluster", "left")
    return out


def _chosen(rows: DataFrame, given: str) -> DataFrame:
    """The columns of a synthesis: the model's where it gave any, else those under ``given`` + name."""
    columns = []
    for f in schema("synthesis").fields:
        own, spare = f.name in rows.columns, f"{given}{f.name}" in rows.columns
        if isinstance(f.dataType, T.ArrayType):
            parts = [F.when(F.size(f.name) > 0, F.col(f.name))] * own + [F.col(f"{given}{f.name}")] * spare
            x = F.coalesce(*parts, F.array().cast(f.dataType)) if parts else F.array().cast(f.dataType)
        else:
            x = F.col(f.name) if own else F.lit(None)
        columns.append(x.cast(f.dataType).alias(f.name))
    return rows.select(*columns)


def _reduced(parts: DataFrame, make, waits: tuple[float, ...]) -> DataFrame:
    """(cluster, prompt): the one part of each cluster. Where there are more, each is answered, and the answers are dealt into
    parts again, two answers to a part at least, until one is left: so many rounds as the logarithm of the parts."""
    whole = None
    while True:
        alone = parts.groupBy("cluster").agg(F.max("part").alias("last"))
        parts = checkpointed(parts.join(alone, "cluster"))
        one = parts.where("last = 0").select("cluster", F.col("payload").alias("prompt"))
        whole = one if whole is None else whole.unionByName(one)
        more = parts.where("last > 0").select("cluster", F.lpad(F.col("part").cast("string"), 12, "0").alias("nth"), F.col("payload").alias("prompt"))
        if more.isEmpty():
            return whole
        asked = more.withColumn("of", F.struct("cluster", "nth"))
        said = answers(asked, "of", "You write about some of the talks of one cluster.", make, waits)
        fields = [c for c in said.columns if c != "of"]
        told = said.select("of.cluster", "of.nth", F.to_json(F.struct(*fields)).alias("j"))
        parts = checkpointed(aggregates.in_parts(told, "cluster", "nth", "j", BUDGET, least=2))


def by_cluster(agenda: DataFrame, talks: DataFrame, done: DataFrame | None = None, make=providers.LocalCompleter, waits: tuple[float, ...] = ()) -> DataFrame:
    """The syntheses of clusters that are not done yet (by name). Clusters without a talk that resolves have none."""
    members = cluster_members(agenda, talks)
    if done is not None:
        members = members.join(done.select(F.col("cluster_name").alias("cluster")).distinct(), "cluster", "left_anti")
    members = checkpointed(members)
    fields = [c for c in OF_TALK if c in talks.columns]
    parts = checkpointed(aggregates.payload_parts(members, talks, fields, BUDGET))
    said = answers(_reduced(parts, make, waits), "cluster", "You write about one cluster of talks.", make, waits)
    spare = aggregated(members, talks)
    spare = spare.select("cluster", *(F.col(c).alias(f"__{c}") for c in spare.columns if c != "cluster"))
    rows = said.join(spare, "cluster", "left").withColumn("cluster_name", F.col("cluster")).withColumn("narrative", F.coalesce("narrative", "said"))
    return _chosen(rows, "__")


def over_all(clusters: DataFrame, make=providers.LocalCompleter, waits: tuple[float, ...] = ()) -> DataFrame:
    """The synthesis of all clusters, one row (none without a cluster): four answers over the clusters' syntheses.

    Lists that a model does not give are those of the clusters, in order of the clusters' names.
    """
    packed = F.array_sort(F.collect_list(F.struct("cluster_name", F.to_json(F.struct(*OF_CLUSTER)).alias("j"))))
    prompt = F.concat(F.lit("["), F.array_join(F.transform(packed, lambda r: r["j"]), ","), F.lit("]"))
    lists = [f for f in schema("synthesis").fields if isinstance(f.dataType, T.ArrayType)]
    merged = lambda f: F.flatten(
        F.transform(F.array_sort(F.collect_list(F.struct("cluster_name", F.coalesce(f.name, F.array().cast(f.dataType)).alias("v")))), lambda r: r["v"])
    )
    whole = clusters.agg(
        F.count("*").alias("n"), prompt.alias("prompt"), ordering.joined_text(
            F.col("narrative"), "\n\n", F.col("cluster_name")
        ).alias("told"), *(merged(f).alias(f"__{f.name}") for f in lists)
    )
    whole = checkpointed(whole.where("n > 0").withColumn("one", F.lit(1)))
    said = answers(whole.select("one", "prompt"), "one", "You write about a whole conference from syntheses of its clusters.", make, waits)
    rows = said.join(whole.drop("prompt"), "one").withColumn("narrative", F.coalesce("narrative", F.nullif("said", F.lit("")), "told"))
    return _chosen(rows.withColumn("cluster_name", F.lit(None).cast("string")), "__")
