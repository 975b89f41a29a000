"""More operators as queries over the driver's tables: text rules on varied input, joins of artifacts, chunks of every kind.

The SQL states each rule anew, on its own terms or as a table of cases worked out by hand, and not from the library's constants.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkloom.functions import entities, grounding, text, time, vector
from talkloom.operators import (
    aggregates,
    alignment,
    chunks,
    hashes,
    links,
    matching,
    ordering,
    reports,
    retrieval,
    scenes,
    sessions,
    turns,
    validation,
    vector_index,
)
from talkloom.plans import providers, queries, transcripts
from talkloom.plans.registry import query, t
from talkloom.sources import artifacts
from talkloom.streaming import arrivals, work


def none() -> Column:
    return F.array().cast("array<string>")


def as_text(name: str) -> Column:
    return F.col(name).cast("string")


def cases(key: Column, *values: str) -> Column:
    """The value of a row's case, key modulo their number; and the SQL of the same."""
    out = F.lit(values[-1])
    for i, v in enumerate(values[:-1]):
        out = F.when(key % len(values) == i, F.lit(v)).otherwise(out)
    return out


def cases_sql(key: str, *values: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {quoted(v)}" for i, v in enumerate(values[:-1]))
    return f"CASE {key} % {len(values)} {whens} ELSE {quoted(values[-1])} END"


def quoted(v: str) -> str:
    """A SQL string; characters that are no plain ASCII by their code points."""
    parts, run = [], ""
    for c in v:
        if " " <= c <= "~":
            run += c.replace("'", "''")
        else:
            parts += [f"'{run}'"] * bool(run) + [f"chr({ord(c)})"]
            run = ""
    parts += [f"'{run}'"] * bool(run or not parts)
    return "(" + " || ".join(parts) + ")"


# Text rules ------------------------------------------------------------------------------------------------------

_SQUEEZED = r"trim(regexp_replace(regexp_replace({}, '<[^>]+>', '', 'g'), '\s+', ' ', 'g'))"


@query(
    f"""SELECT doc_id, {_SQUEEZED.format("'first ' || text")} AS title, {_SQUEEZED.format("text")} AS abstract, source AS track, lang AS format,
  'John ' || lang || ' (Office ' || source || '), fi b' AS speakers FROM documents"""
)
def normalize_session(spark, d):
    """Ligatures and full-width letters in titles and speakers become plain ones."""
    who = F.array(
        F.struct(F.concat(F.lit(" Ｊｏｈｎ <b>"), "lang", F.lit("</b>")).alias("name"), F.concat(F.lit("Oﬃce  "), "source").alias("company")),
        F.struct(F.lit("ﬁ  b").alias("name"), F.lit("").alias("company")),
    )
    raw = t(spark, d, "documents").select(
        F.concat(F.lit("ﬁrst <i>　"), "text").alias("title"),
        F.lit("untitled").alias("name"),
        F.lit("").alias("abstract"),
        F.col("text").alias("description"),
        F.to_json(who).alias("speakers"),
        F.lit("").alias("track"),
        F.col("source").alias("venue"),
        F.col("lang").alias("format"),
        F.col("doc_id").alias("_pos"),
    )
    s = sessions.normalize(sessions.coerce(raw))
    return s.select(F.col("_pos").alias("doc_id"), "title", "abstract", "track", "format", text.speakers_text("speakers").alias("speakers"))


_WIDE = ("\uff21\uff22\uff11", "\ufb03", "\u2460", "e\u0301", "\uff76", "\u2167", "plain")
_NARROW = ("AB1", "ffi", "1", "\u00e9", "\u30ab", "VIII", "plain")


@query(f"SELECT doc_id, {cases_sql('doc_id', *_NARROW)} || ' ' || lang AS folded FROM documents")
def unicode_folding(spark, d):
    return t(spark, d, "documents").select("doc_id", text.normalized(F.concat(cases(F.col("doc_id"), *_WIDE), F.lit(" "), "lang")).alias("folded"))


_AFFILIATION = "CASE s_suppkey % 5 WHEN 0 THEN ' (' || n_name || ')' WHEN 1 THEN 'Engineer, ' || n_name WHEN 2 THEN 'CTO, (x), ' || n_name || ' ' WHEN 3 THEN '()' ELSE n_name END"


@query(
    f"""WITH a AS (SELECT s_suppkey, {_AFFILIATION} AS raw FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT s_suppkey, trim(string_split(trim(trim(raw), '()'), ', ')[-1]) AS company, trim(string_split(raw, ', ')[-1]) AS tail FROM a"""
)
def company_names(spark, d):
    s = t(spark, d, "supplier").join(t(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    raw = F.expr(_AFFILIATION)
    return s.select("s_suppkey", text.company_of_affiliation(raw).alias("company"), text.company_tail(raw).alias("tail"))


@query(
    """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN p_name || ' -' || p_brand WHEN 2 THEN '' ELSE p_name || '-'
      || p_type END AS prefix FROM part"""
)
def title_prefixes(spark, d):
    """The part before the first " - ", without white space of any kind around it."""
    k = F.col("p_partkey") % 4
    title = (
        F.when(k == 0, F.concat("p_name", F.lit("  - "), "p_brand", F.lit(" - x")))
        .when(k == 1, F.concat(F.lit("\t"), "p_name", F.lit(" -"), "p_brand"))
        .when(k == 2, F.concat(F.lit(" - "), "p_name"))
        .otherwise(F.concat("p_name", F.lit("-"), "p_type"))
    )
    return t(spark, d, "part").select("p_partkey", text.title_prefix(title).alias("prefix"))


@query(
    r"""SELECT DISTINCT p AS percentage FROM (SELECT unnest(regexp_extract_all(text || ' ' || doc_id || '.' || (doc_id % 10) || '% or 7 % and ' || doc_id
      || '%', '\d+(?:\.\d+)?%')) AS p FROM documents)"""
)
def percent_extract(spark, d):
    n = as_text("doc_id")
    more = F.concat("text", F.lit(" "), n, F.lit("."), (F.col("doc_id") % 10).cast("string"), F.lit("% or 7 % and "), n, F.lit("%"))
    return aggregates.distinct_percentages(t(spark, d, "documents").select(more.alias("text")))


#: Prose and what is left of it where only 40% and 3.5% are grounded, worked out by hand.
_METRICS = (
    ("up 12% of all", "up many all"),
    ("only 5% of teams", "only a small fraction of teams"),
    ("only 5%, they say", "only a small share, they say"),
    ("cut by 30% today", "cut significantly today"),
    ("achieved 99.9% uptime", "achieved high uptime"),
    ("kept 40% of users", "kept 40% of users"),
    ("took 40 hours", "took 40 hours"),
    ("took 4 hours", "took hours"),
    ("within 20 ms flat", "within sub-second flat"),
    ("a 20% reduction", "a significant reduction"),
    ("20% faster", "notable faster"),
    ("(70% in Europe)", "(a significant proportion in Europe)"),
    ("3.5% in Asia, 3.4% in Peru", "3.5% in Asia, a significant proportion in Peru"),
    ("6-9 months later", "several months later"),
    ("after 90–99 seconds", "after seconds"),
    ("1 minute or 35 minutes", "minutes or 35 minutes"),
    ("no figure", "no figure"),
)
_UNNUMBERED = "regexp_replace(text, '[0-9]', '', 'g')"


@query(f"SELECT doc_id, {cases_sql('doc_id', *(w for _, w in _METRICS))} || ' ' || {_UNNUMBERED} AS prose FROM documents")
def scrub_metrics(spark, d):
    prose = F.concat(cases(F.col("doc_id"), *(p for p, _ in _METRICS)), F.lit(" "), F.regexp_replace("text", "[0-9]", ""))
    known = F.array(F.lit("40%"), F.lit("3.5%"), F.lit("35%"))
    return t(spark, d, "documents").select("doc_id", grounding.scrub_metrics(prose, known).alias("prose"))


#: Mentions and the names that they stand for, from the public names of the projects.
_MENTIONS = (
    ("k8s", "Kubernetes"), ("OTel", "OpenTelemetry"), ("kata containers", "Kata Containers"), ("kube-proxy", "Kubernetes-proxy"), ("ARGO-CD", "Argo CD"),
    ("open telemetry", "OpenTelemetry"), ("wasm", "WebAssembly"), ("tf", "Terraform"), ("open tofu", "OpenTofu"), ("aws", "AWS"), ("google cloud platform", "GCP"),
    ("kata", "Kata Containers"), ("opa", "Open Policy Agent"), ("grpc", "gRPC"), ("Core DNS", "CoreDNS"), ("certmanager", "cert-manager"), ("bpf", "eBPF"),
    ("crio", "CRI-O"), ("envoy proxy", "Envoy"), ("fluxcd", "Flux"), ("kubeflow", "Kubeflow"), ("otelx", "otelx"), ("kubevirt", "KubeVirt"),
)


@query(
    f"SELECT event_id, {cases_sql('event_id', *(n for _, n in _MENTIONS))} || ' on Kubernetes and ' || {cases_sql('(event_id // 23)', *(n for _, n in _MENTIONS))} AS names FROM events"
)
def canonicalize(spark, d):
    said = [m for m, _ in _MENTIONS]
    other = cases(F.floor(F.col("event_id") / 23).cast("long"), *said)
    return t(spark, d, "events").select("event_id", entities.canonical(F.concat(cases(F.col("event_id"), *said), F.lit(" on K8S and "), other)).alias("names"))


@query(
    r"""SELECT doc_id, text || chr(10) || chr(10) || CASE WHEN doc_id % 3 = 0 THEN '### Head ' || source WHEN doc_id % 3 = 1 THEN '**Head** and more'
      ELSE '### a b' END
  || chr(10) || CASE WHEN doc_id % 3 = 1 THEN '' ELSE chr(10) END || lang AS page FROM documents"""
)
def promote_bold(spark, d):
    """Bold phrases that stand alone become headings, others stay."""
    k = F.col("doc_id") % 3
    bold = F.when(k == 0, F.concat(F.lit("**Head "), "source", F.lit("**  \n"))).when(k == 1, F.lit("**Head** and more\n")).otherwise(F.lit("**a b** \n"))
    return t(spark, d, "documents").select("doc_id", text.promote_bold(F.concat("text", F.lit("\n\n"), bold, "lang")).alias("page"))


@query(
    r"""SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'e' || page_id WHEN 1 THEN 'x' || (page_id * 7) ELSE '' END AS event_id,
  CASE WHEN page_id % 2 = 0 THEN 'talk ' || page_id ELSE 'talk ' || page_id || 'Room 1' END AS title, 'Mon ' || (page_id % 12) || ':00' AS time_text
    FROM pages"""
)
def listing_texts(spark, d):
    p, k = as_text("page_id"), F.col("page_id")
    url = F.when(k % 3 == 0, F.concat(F.lit("https://x/event/e"), p, F.lit("/name?q"))).when(
        k % 3 == 1, F.concat(F.lit("/event/x"), (k * 7).cast("string"), F.lit("?a#b"))
    ).otherwise("https://x/other")
    venue = F.when(k % 2 == 0, F.lit(" Room 1 ")).otherwise(F.lit("Hall"))
    title = text.without_venue(F.concat(F.lit(" talk "), p, F.lit("Room 1")), venue)
    at = F.concat(F.lit(" Mon "), (k % 12).cast("string"), F.lit(":00   Room"))
    return t(spark, d, "pages").select("page_id", text.event_id(url).alias("event_id"), title.alias("title"), text.time_text(at).alias("time_text"))


#: Prose with artifacts of templates and names in contexts of attribution, and what is found, worked out by hand.
_PROSE = (
    ("{place_holder} [needs_quote=true] as presented by Anna Meier", "[needs_quote=true] {place_holder}", "Anna Meier"),
    ("[needs_quote = no] shown by Max Muster, engineer", "[needs_quote = no]", "Max Muster"),
    ("{No} (presented by Dr. Zoë Müller) so", "", "Zoë Müller"),
    ("said Ann Lee and Bob Ray, architect", "", "Ann Lee, Bob Ray"),
    ("nothing here, {a_b}{c}", "{a_b} {c}", ""),
)


@query(
    f"SELECT conv_id, turn, {cases_sql('turn', *(a for _, a, _ in _PROSE))} AS artifacts, {cases_sql('turn', *(n for _, _, n in _PROSE))} AS names FROM conversations"
)
def prose_patterns(spark, d):
    prose = F.concat(F.lower("text"), F.lit(" "), cases(F.col("turn"), *(p for p, _, _ in _PROSE)))
    return t(spark, d, "conversations").select(
        "conv_id",
        "turn",
        F.array_join(text.template_artifacts(prose), " ").alias("artifacts"),
        F.array_join(text.person_names(prose), ", ").alias("names"),
    )


@query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN lang || ' ' || source WHEN 1 THEN n_chars::VARCHAR ELSE '' END AS shown FROM documents")
def list_or_scalar_text(spark, d):
    k = F.col("doc_id") % 3
    docs = t(spark, d, "documents")
    shown = F.when(k == 0, text.text_of(F.array("lang", "source"))).when(k == 1, text.text_of("n_chars", "scalar")).otherwise(text.text_of(none()))
    return docs.select("doc_id", shown.alias("shown"))


# Joins and sets --------------------------------------------------------------------------------------------------


@query(
    """WITH titles AS (SELECT p_name || ' - ' || p_brand AS title, min(p_partkey) AS pos FROM part GROUP BY 1),
w AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_name || ' - ' || p_brand WHEN 1 THEN p_name WHEN 2 THEN left(p_name, 6) WHEN 3 THEN p_name
  || ' - Keynote' ELSE 'zz' || p_name END AS wanted FROM part),
c AS (SELECT wanted, 1 AS tier, pos, title FROM (SELECT DISTINCT wanted FROM w) JOIN titles ON title = wanted
  UNION ALL SELECT wanted, 2, pos, title FROM (SELECT DISTINCT wanted FROM w) JOIN titles ON trim(split_part(title, ' - ', 1)) = trim(split_part(wanted,
    ' - ', 1))
  UNION ALL SELECT wanted, 3, pos, title FROM (SELECT DISTINCT wanted FROM w) JOIN titles ON starts_with(title, wanted)),
b AS (SELECT wanted, title FROM (SELECT *, row_number() OVER (PARTITION BY wanted ORDER BY tier, pos, title) AS n FROM c) WHERE n = 1)
SELECT p_partkey, w.wanted, title AS resolved FROM w LEFT JOIN b USING (wanted)"""
)
def title_resolve_3tier(spark, d):
    """Wanted titles may have another suffix than the talk."""
    p = t(spark, d, "part")
    full = F.concat("p_name", F.lit(" - "), "p_brand")
    k = F.col("p_partkey") % 5
    w = F.when(k == 0, full).when(k == 1, F.col("p_name")).when(k == 2, F.substring("p_name", 1, 6)).when(
        k == 3, F.concat("p_name", F.lit(" - Keynote"))
    ).otherwise(F.concat(F.lit("zz"), "p_name"))
    return matching.resolve_titles(
        p.select("p_partkey", w.alias("wanted")), p.select(full.alias("title"), F.col("p_partkey").alias("pos"))
    ).select("p_partkey", "wanted", "resolved")


@query(
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders)
SELECT c_custkey, coalesce(o_orderkey, -1) AS first_order, coalesce(o_orderstatus, 'none') AS status FROM customer LEFT JOIN r ON o_custkey = c_custkey
  AND n = 1"""
)
def enrich_left(spark, d):
    """Every customer once, with the first of its orders."""
    o = t(spark, d, "orders").select(
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_orderkey").alias("first_order"),
        F.col("o_orderstatus").alias("status"),
        "o_orderdate",
    )
    first = ordering.looked_up(
        t(spark, d, "customer").select("c_custkey"), o, "c_custkey", F.struct("o_orderdate", "first_order"), first_order=-1, status="none"
    )
    return first.select("c_custkey", "first_order", "status")


_SESSION = "md5(n_name) || md5('x' || n_name)"


@query(
    f"""WITH r AS (SELECT s_suppkey AS video, s_acctbal AS secs, s_nationkey, s_suppkey % 3 = 0 AS told FROM supplier),
u AS (SELECT * FROM r WHERE NOT (secs > 0 AND secs < 3000)),
m AS (SELECT s_nationkey, min(video) AS video FROM u WHERE told GROUP BY 1)
SELECT 'session' AS kind, n_nationkey AS id, video FROM nation LEFT JOIN m ON s_nationkey = n_nationkey
UNION ALL SELECT 'recording', NULL, video FROM u WHERE video NOT IN (SELECT video FROM m)"""
)
def match_recordings(spark, d):
    """Recordings in order of their id take the session of a very similar title; short ones are left out, others that find none are kept.

    Titles are hashes, which are alike only where one was made of the other.
    """
    n = t(spark, d, "nation")
    s = n.select(F.col("n_nationkey").alias("_pos"), F.expr(_SESSION).alias("title"), F.lit("talk").alias("format"))
    r = t(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    other = F.concat(F.md5(as_text("s_suppkey")), F.md5(F.concat(F.lit("y"), as_text("s_suppkey"))))
    title = F.when(F.col("s_suppkey") % 3 == 0, F.upper(F.substring(F.expr(_SESSION), 1, 58))).otherwise(other)
    r = r.select(
        F.lpad(as_text("s_suppkey"), 12, "0").alias("video_id"),
        title.alias("title"),
        F.col("s_acctbal").alias("duration_sec"),
        F.lit("said").alias("full_text"),
    )
    got = matching.match_recordings(s, r, 3000.0)
    return got.select(
        F.when(F.col("format") == "recording", "recording").otherwise("session").alias("kind"),
        F.col("_pos").alias("id"),
        F.col("video_id").cast("long").alias("video"),
    )


_SLIDE = "SELECT user_id, ts, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos FROM events"


@query(
    f"""WITH e AS ({_SLIDE}),
s AS (SELECT user_id, string_agg(event_type, chr(10) || chr(10) ORDER BY pos) FILTER (event_type <> 'view') AS slide_text, string_agg('http://a.b/'
  || event_type, ' | ' ORDER BY pos) AS slide_descriptions,
  array_to_string(list_sort(list(DISTINCT 'http://a.b/' || event_type)), ' ') AS slide_references FROM e GROUP BY 1)
SELECT c_custkey, coalesce(slide_text, '') AS slide_text, coalesce(slide_descriptions, '') AS slide_descriptions, coalesce(slide_references,
  '') AS slide_references FROM customer LEFT JOIN s ON user_id = c_custkey"""
)
def attach_slides(spark, d):
    """Texts, descriptions and references of a video's slides beside its session; sessions without slides stay."""
    from talkloom.plans.steps import attach_slides as attach

    nth = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    e = t(spark, d, "events").withColumn("n", nth)
    shown = F.when(F.col("event_type") != "view", F.concat(F.lit(" "), "event_type", F.lit(" "))).otherwise(" ")
    one = F.struct(as_text("n").alias("timestamp_sec"), shown.alias("text"), F.concat(F.lit("http://a.b/"), "event_type").alias("description"))
    slides = e.groupBy(as_text("user_id").alias("video_id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("n", one.alias("s")))), lambda r: r["s"]).alias("slides")
    )
    said = F.array(F.struct(F.lit(0.0).alias("start"), F.lit("x").alias("text"), F.lit("").alias("speaker")))
    heard = t(spark, d, "customer").select(as_text("c_custkey").alias("video_id"), said.alias("segments"))
    got = attach(t(spark, d, "customer").select("c_custkey", as_text("c_custkey").alias("video_id")), slides, heard)
    return got.select(
        "c_custkey",
        text.filled("slide_text").alias("slide_text"),
        text.filled("slide_descriptions").alias("slide_descriptions"),
        text.filled(F.array_join("slide_references", " ")).alias("slide_references"),
    )


_STAFF = "CASE c_custkey % 3 WHEN 0 THEN 'Ann  van ' || c_name WHEN 1 THEN ' ' || c_name ELSE '' END"


@query(
    f"""WITH s AS (SELECT trim({_STAFF}) AS name, trim(string_split(CASE c_custkey % 2 WHEN 0 THEN 'CTO, ' || n_name ELSE '' END, ', ')[-1]) AS company
      FROM customer JOIN nation ON c_nationkey = n_nationkey),
p AS (SELECT 'speaker' AS kind, name FROM s UNION SELECT 'speaker', regexp_extract(name, '[^ ]+$') FROM s WHERE contains(name, ' ') UNION SELECT 'company',
  company FROM s)
SELECT DISTINCT kind, name FROM p WHERE name <> ''"""
)
def known_people(spark, d):
    """Speakers by full name and by its last word, and companies."""
    c = t(spark, d, "customer").join(t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    company = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("CTO, "), "n_name")).otherwise("")
    return aggregates.known_people(c.select(F.array(F.struct(F.expr(_STAFF).alias("name"), company.alias("company"))).alias("speakers")))


@query(
    """WITH a AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS j FROM orders),
k AS (SELECT DISTINCT o_custkey AS c FROM orders WHERE o_custkey % 3 = 0)
SELECT 'cluster ' || o_custkey AS cluster, j, 'talk ' || o_orderkey || '.' AS title, CASE WHEN c IS NOT NULL AND o_orderkey % 2 = 0 THEN 'sum ' || o_orderkey
  ELSE '' END AS summary FROM a LEFT JOIN k ON c = o_custkey"""
)
def appendix_by_cluster(spark, d):
    """All talks of all clusters, with details where the cluster is a deep dive and the title resolves."""
    o = t(spark, d, "orders").select("o_custkey", "o_orderkey", F.concat(F.lit("talk "), as_text("o_orderkey"), F.lit(".")).alias("title"))
    listed = o.groupBy("o_custkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "title"))), lambda r: r["title"]).alias("talks"))
    name = F.concat(F.lit("cluster "), as_text("o_custkey"))
    agenda = listed.select(F.array(F.struct(name.alias("name"), "talks")).alias("clusters"))
    outline = listed.where("o_custkey % 3 = 0").select(
        F.array(F.struct(F.lit("cluster_deep_dive").alias("section_type"), name.alias("cluster_name"))).alias("sections")
    )
    blank = F.lit("")
    even = o.where("o_orderkey % 2 = 0")
    talks = even.select(
        "title",
        F.col("o_orderkey").alias("_pos"),
        F.concat(F.lit("sum "), as_text("o_orderkey")).alias("summary"),
        none().alias("key_takeaways"),
        blank.alias("evidence_quality"),
        blank.alias("speaker_perspective"),
        none().alias("tools_and_projects"),
    )
    ranking = o.limit(0).select(F.lit(0).alias("rank"), blank.alias("name"), none().alias("recommended_talks"))
    got = reports.appendix(talks, ranking, agenda, outline, "by_cluster")
    return got.select("cluster", F.col("pos.j").cast("long").alias("j"), "title", "summary")


@query(
    """SELECT conv_id, turn, text, CASE WHEN turn % 2 = 0 THEN 'own ' || role ELSE role END AS title, length(text)::INTEGER AS n FROM conversations
      WHERE turn % 3 <> 0"""
)
def merged_results(spark, d):
    """Two partial results under one key; what the second has wins, and rows that it lacks go."""
    c = t(spark, d, "conversations").withColumn("key", F.concat_ws(":", "conv_id", "turn"))
    core = c.select("key", "conv_id", "turn", "text", F.lit("old").alias("title"))
    second = c.where("turn % 3 <> 0").select(
        "key",
        F.when(F.col("turn") % 2 == 0, F.concat(F.lit("own "), "role")).otherwise(F.col("role")).alias("title"),
        F.length("text").alias("n"),
    )
    return sessions.merge_results(core, second, "key").drop("key")


@query(
    """SELECT o_orderkey, array_to_string(list_filter([CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus || ' uses ' || o_orderpriority END, CASE
      WHEN o_orderkey % 3 = 0 THEN 'a uses b' END], lambda x: x IS NOT NULL), '; ') AS kept FROM orders"""
)
def blank_relationships(spark, d):
    rel = lambda a, b: F.struct(a.alias("entity_a"), F.lit("uses").alias("relation"), b.alias("entity_b"))
    some = lambda k, x: F.when(F.col("o_orderkey") % k == 0, x).otherwise(F.lit(" \t"))
    o = t(spark, d, "orders").withColumn(
        "relationships",
        F.array(
            rel(some(2, F.col("o_orderstatus")), F.col("o_orderpriority")),
            rel(some(3, F.lit("a")), F.lit("b")),
            rel(F.lit(None).cast("string"), F.lit("c")),
        ),
    )
    kept = F.transform("relationships", lambda r: F.concat_ws(" ", r["entity_a"], r["relation"], r["entity_b"]))
    return sessions.without_blank_relationships(o).select("o_orderkey", F.array_join(kept, "; ").alias("kept"))


@query("SELECT doc_id FROM documents WHERE length(text) >= 1000 AND NOT (doc_id % 7 > 0 AND doc_id % 7 < 3)")
def analysed_talks(spark, d):
    """Long enough, or of unknown length, and with a transcript of so many characters."""
    talks = t(spark, d, "documents").select(
        "doc_id",
        F.lit("A talk").alias("title"),
        F.col("text").alias("transcript"),
        (F.col("doc_id") % 7).cast("double").alias("duration_sec"),
    )
    return sessions.sections_of_interest(talks, 3.0, 1000).select("doc_id")


@query(f"WITH e AS ({_SLIDE}) SELECT event_id, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, pos) AS until FROM e")
def active_spans(spark, d):
    nth = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    e = t(spark, d, "events").select(F.col("user_id").alias("video_id"), "ts", "event_id", nth.alias("pos"))
    return alignment.active_spans(e).select("event_id", "until")


@query("SELECT o_orderpriority AS company, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, min(o_orderkey)) AS place FROM orders GROUP BY 1")
def first_seen_order(spark, d):
    """Most first; of equal counts what was seen first."""
    got = aggregates.counts(t(spark, d, "orders"), F.col("o_orderpriority"), "company", F.col("o_orderkey"))
    return spark.createDataFrame([(*r, i + 1) for i, r in enumerate(got.select("company", "n").collect())], "company string, n long, place long")


@query(
    """SELECT conv_id, coalesce(round(max(turn) + 0.27, 1), 0)::DOUBLE AS duration_sec, string_agg(trim(text), ' ' ORDER BY turn) AS full_text,
      count(*) AS n_segments FROM conversations GROUP BY 1"""
)
def finished_transcripts(spark, d):
    """Output of the command-line recogniser as a transcript: rounded times, text, and the end of the last segment as duration."""
    c = t(spark, d, "conversations")
    mark = lambda x: F.concat(F.lit("00:00:"), F.lpad(x.cast("string"), 2, "0"))
    one = F.struct(
        F.struct(F.concat(mark(F.col("turn")), F.lit(",000")).alias("from"), F.concat(mark(F.col("turn")), F.lit(",270")).alias("to")).alias("timestamps"),
        F.concat(F.lit(" "), "text", F.lit(" ")).alias("text"),
    )
    raw = c.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", one.alias("e")))), lambda r: r["e"]).alias("transcription"))
    raw = raw.select(as_text("conv_id").alias("video_id"), F.lit("t").alias("title"), "transcription", F.struct(F.lit("en").alias("language")).alias("result"))
    return transcripts.from_cli(raw).select(
        F.col("video_id").cast("long").alias("conv_id"), "duration_sec", "full_text", F.size("segments").cast("long").alias("n_segments")
    )


@query(
    """WITH m AS (SELECT p_brand AS technology, p_type AS ring, CASE p_size % 5 WHEN 0 THEN 'production_proven' WHEN 1 THEN 'benchmarked'
      WHEN 2 THEN 'case_study' WHEN 3 THEN 'anecdotal' ELSE 'odd' END AS evidence_quality, p_partkey FROM part),
b AS (SELECT *, row_number() OVER (PARTITION BY technology ORDER BY CASE evidence_quality WHEN 'production_proven' THEN 4 WHEN 'benchmarked' THEN 3
  WHEN 'case_study' THEN 2 WHEN 'anecdotal' THEN 1 ELSE 0 END DESC, p_partkey) AS n FROM m)
SELECT technology, ring, evidence_quality, 'c' || p_partkey AS source_cluster FROM b WHERE n = 1"""
)
def maturity_strip(spark, d):
    k = F.col("p_size") % 5
    eq = F.when(k == 0, "production_proven").when(k == 1, "benchmarked").when(k == 2, "case_study").when(k == 3, "anecdotal").otherwise("odd")
    one = F.array(F.struct(F.col("p_brand").alias("technology"), F.col("p_type").alias("ring"), eq.alias("evidence_quality")))
    rows = t(spark, d, "part").select(
        F.col("p_partkey").alias("_pos"),
        F.concat(F.lit("c"), as_text("p_partkey")).alias("cluster_name"),
        one.alias("maturity_landscape"),
    )
    return reports.maturity_strip(rows, rows.limit(0)).select("technology", "ring", "evidence_quality", "source_cluster")


_PRIORITY = "SELECT c_custkey, min(c_nationkey) AS priority FROM customer WHERE c_acctbal > 0 GROUP BY 1"


@query(f"SELECT o_orderkey, coalesce(priority, 99) AS priority FROM orders LEFT JOIN ({_PRIORITY}) ON o_custkey = c_custkey")
def section_order(spark, d):
    s = t(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("section_id"), F.col("o_orderkey").alias("_pos"))
    specs = t(spark, d, "customer").where("c_acctbal > 0").select(
        F.col("c_custkey").alias("section_id"),
        F.col("c_nationkey").alias("priority"),
        F.lit("cluster_brief").alias("section_type"),
        F.lit("").alias("cluster_name"),
    )
    return reports.in_order(s, specs).select("o_orderkey", "priority")


# Hashes and vectors ----------------------------------------------------------------------------------------------

_HASH = "list_sum(list_transform(embedding, lambda x, i: CASE WHEN x > 0 THEN (2::HUGEINT ** (i - 1))::HUGEINT ELSE 0 END))::HUGEINT"


@query(
    f"""WITH RECURSIVE v AS (SELECT label, vec_id, {_HASH} AS h, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS n FROM embeddings),
f AS (SELECT label, vec_id, n, [h] AS kept, true AS stays FROM v WHERE n = 1
  UNION ALL SELECT v.label, v.vec_id, v.n,
    CASE WHEN len(list_filter(kept, lambda k: bit_count(xor(k, v.h)) <= 24)) = 0 THEN list_append(kept, v.h) ELSE kept END, len(list_filter(kept,
      lambda k: bit_count(xor(k, v.h)) <= 24)) = 0
    FROM f JOIN v ON v.label = f.label AND v.n = f.n + 1)
SELECT label, vec_id FROM f WHERE stays"""
)
def hamming_dedup(spark, d):
    v = t(spark, d, "embeddings").select(
        as_text("label").alias("video_id"), F.col("vec_id").alias("index"), vector.sign_hash(F.col("embedding")).alias("dhash")
    )
    return hashes.dedup_frames(v, 24).select(F.col("video_id").cast("int").alias("label"), F.col("index").alias("vec_id"))


#: Hashes of 60 bits in families of like ones: a family's own, with five bits turned that depend on the row.
_TURNED = (1, 7, 11, 13, 17)


@query(
    f"""WITH RECURSIVE v AS (SELECT vec_id, {"xor(" * len(_TURNED)}('0x' || left(md5((vec_id % 40)::VARCHAR), 15))::BIGINT
  {"".join(f", 1::BIGINT << ((vec_id * {k}) % (20 + {k}))::INTEGER)" for k in _TURNED)} AS h, row_number() OVER (ORDER BY vec_id) AS n FROM embeddings),
f AS (SELECT vec_id, n, [h] AS kept, true AS stays FROM v WHERE n = 1
  UNION ALL SELECT v.vec_id, v.n, CASE WHEN near = 0 THEN list_append(kept, v.h) ELSE kept END, near = 0
  FROM f JOIN v ON v.n = f.n + 1, LATERAL (SELECT len(list_filter(kept, lambda k: bit_count(xor(k, v.h)) <= 6)) AS near))
SELECT vec_id FROM f WHERE stays"""
)
def frame_dedup(spark, d):
    """All rows as one video's frames."""
    h = F.conv(F.substring(F.md5((F.col("vec_id") % 40).cast("string")), 1, 15), 16, 10).cast("long")
    for k in _TURNED:
        h = h.bitwiseXOR(F.expr(f"shiftleft(1L, cast((vec_id * {k}) % (20 + {k}) as int))"))
    v = t(spark, d, "embeddings").select(F.lit("v").alias("video_id"), F.col("vec_id").alias("index"), h.alias("dhash"))
    return hashes.dedup_frames(v).select(F.col("index").alias("vec_id"))


@query(f"WITH h AS (SELECT vec_id, {_HASH} AS h FROM embeddings) SELECT a.vec_id, bit_count(xor(a.h, b.h))::INTEGER AS bits FROM h a, h b WHERE b.vec_id = 0")
def hamming_distance(spark, d):
    v = t(spark, d, "embeddings").select("vec_id", vector.sign_hash(F.col("embedding")).alias("h"))
    first = v.where("vec_id = 0").select(F.col("h").alias("h0"))
    return v.join(F.broadcast(first), F.lit(True)).select("vec_id", vector.hamming(F.col("h"), F.col("h0")).cast("int").alias("bits"))


_DISTANCE = "round(1 - list_cosine_similarity(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0)), 6)"


@query(
    """WITH RECURSIVE p AS (SELECT label, vec_id AS frame, list_transform(embedding, lambda x: floor(200 * x::DOUBLE)::INTEGER) AS pixels FROM embeddings),
b AS (SELECT *, lag(pixels) OVER (PARTITION BY label ORDER BY frame) AS before FROM p),
s AS (SELECT label, frame, before IS NULL AS start, CASE WHEN before IS NOT NULL THEN
  list_sum(list_transform(range(1, len(pixels) + 1), lambda i: abs(pixels[i] - before[i])))::DOUBLE / len(pixels) END AS score FROM b),
n AS (SELECT label, frame, start, score FROM s WHERE start OR score >= CASE WHEN label % 2 = 0 THEN 20 ELSE 27 END),
x AS (SELECT a.*, c.frame AS next FROM n a ASOF LEFT JOIN n c ON a.label = c.label AND c.frame >= a.frame + 15),
w AS (SELECT label, frame, score, next, 0 AS scene FROM x WHERE start
  UNION ALL SELECT x.label, x.frame, x.score, x.next, scene + 1 FROM w JOIN x ON x.label = w.label AND x.frame = w.next)
SELECT label, scene, frame, round(score, 6) AS score FROM w WHERE scene > 0 OR next IS NOT NULL"""
)
def scene_cuts(spark, d):
    """Every label's vectors as the decoded frames of a video; those of even labels are long."""
    pixels = F.transform("embedding", lambda x: F.floor(200 * x.cast("double")).cast("int"))
    frames = t(spark, d, "embeddings").select("label", F.col("vec_id").alias("at"), pixels.alias("pixels"))
    lengths = frames.groupBy("label").agg(F.max(F.when(F.col("label") % 2 == 0, 900.0)).alias("duration"))
    found = scenes.cuts(frames, scenes.thresholds(lengths, key="label"), "label", stretch=64)
    return found.select("label", F.col("index").alias("scene"), F.col("at").alias("frame"), F.round("score", 6).alias("score"))


@query(
    """WITH g AS (SELECT vec_id, list_transform(range(72), lambda i: embedding[i % 64 + 1]) AS g FROM embeddings)
SELECT vec_id, array_to_string(list_transform(range(64), lambda i: CASE WHEN g[9 * (i // 8) + i % 8 + 2] > g[9 * (i // 8) + i % 8 + 1] THEN '1' ELSE '0' END), '') AS bits FROM g"""
)
def picture_hash(spark, d):
    """Every vector's values, from the first on again where they end, as a picture of eight rows of nine."""
    grey = F.transform(F.sequence(F.lit(0), F.lit(71)), lambda i: F.get("embedding", i % 64))
    bits = F.reverse(F.lpad(F.bin(vector.difference_hash(grey)), 64, "0"))
    return t(spark, d, "embeddings").select("vec_id", bits.alias("bits"))


@query(
    f"SELECT vec_id, distance FROM (SELECT vec_id, label, {_DISTANCE} AS distance FROM embeddings ORDER BY 3, 1 LIMIT 60) WHERE contains('talk ' || label || ' of all', 'talk ' || 1)"
)
def knn_postfilter(spark, d):
    """Of the nearest those whose title holds the cited one: fewer than were searched for may remain."""
    e = t(spark, d, "embeddings")
    probe = [float(x) for x in e.where("vec_id = 0").select("embedding").first()[0]]
    hits = retrieval.nearest(e, probe, 60, id_col="vec_id", digits=6)
    return retrieval.title_contains(hits, F.lit("TALK 1"), F.concat(F.lit("Talk "), as_text("label"), F.lit(" of all"))).select("vec_id", "distance")


@query()
def embed_hashed(spark, d):
    """Feature hashing by XXH64 has no SQL; tests hold it against a plain computation."""
    from talkloom.plans.providers import embed

    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    shown = F.md5(F.array_join(F.transform("embedding", lambda x: F.round(x, 6).cast("string")), ","))
    return embed(t(spark, d, "documents").select("doc_id", "text")).select(
        "doc_id", F.size("embedding").alias("dims"), F.round(length, 6).alias("length"), shown.alias("digest")
    )


# Validation ------------------------------------------------------------------------------------------------------

_SAID = (" As presented by Anna Meier", " said Max Muster there", " shown by Customer Person", " according to Ann Leeds")
_FOLD = r"trim(regexp_replace(lower({}), '\s+', ' ', 'g'))"


@query(
    rf"""WITH s AS (SELECT conv_id || ':' || turn AS section_id, turn, text, CASE turn % 4 WHEN 0 THEN 'nothing real' WHEN 1 THEN text WHEN 2 THEN text
      || ' - Someone' ELSE '' END AS cited FROM conversations),
titles AS (SELECT DISTINCT {_FOLD.format("text")} AS t FROM conversations),
f AS (SELECT section_id, cited FROM s WHERE cited <> '' AND {_FOLD.format("cited")} NOT IN (SELECT t FROM titles)
  AND NOT EXISTS (SELECT 1 FROM titles WHERE starts_with(t, {_FOLD.format("trim(split_part(cited, ' - ', 1))")}))),
m AS (SELECT section_id, unnest(regexp_extract_all(text || ' ' || (turn % 5) || '0% up', '\d+(?:\.\d+)?%')) AS p FROM s)
SELECT section_id, 'unknown_speakers' AS kind, 'Unknown speaker: "Anna Meier" — not in schedule_clean.json' AS message FROM s WHERE turn % 4 = 0
UNION ALL SELECT section_id, 'ungrounded_metrics', 'Ungrounded metric: ' || p || ' — not found in analysis_talks.json' FROM m WHERE p NOT IN ('10%', '20%')
UNION ALL SELECT section_id, 'template_artifacts', 'Template artifact: ' || unnest(['[needs_quote=true]', '{{place_holder}}']) FROM s
UNION ALL SELECT section_id, 'fabricated_citations', 'Fabricated citation: "' || left(cited, 60) || '..."' FROM f"""
)
def validate_report(spark, d):
    """All warnings with their messages. Ann Leeds holds the known Ann Lee, and Max Muster the company Muster."""
    c = t(spark, d, "conversations")
    k = F.col("turn") % 4
    prose = F.concat("text", cases(F.col("turn"), *_SAID), F.lit(" {place_holder} [needs_quote=true] "), (F.col("turn") % 5).cast("string"), F.lit("0% up"))
    cited = F.when(k == 0, "nothing real").when(k == 1, F.col("text")).when(k == 2, F.concat("text", F.lit(" - Someone"))).otherwise("")
    cites = F.array(F.struct(cited.alias("talk_title"), F.lit("x").alias("claim"), F.lit(True).alias("needs_quote")))
    s = c.select(F.concat_ws(":", as_text("conv_id"), as_text("turn")).alias("section_id"), prose.alias("prose"), cites.alias("citations"))
    people = spark.createDataFrame([("speaker", "Customer Person"), ("speaker", "Ann Lee"), ("company", "Muster")], "kind string, name string")
    known = spark.createDataFrame([("10%",), ("20%",)], "percentage string")
    return validation.warnings(s, people, known, c.select(F.col("text").alias("title")))


# Chunks of every kind --------------------------------------------------------------------------------------------


def _talks(spark, d, **given) -> DataFrame:
    docs = t(spark, d, "documents")
    columns = {c: none() for c in ("key_takeaways", "qa_highlights", "problems_discussed", "tools_and_projects", "emerging_signals")} | given
    return docs.select(
        F.concat(F.lit("Talk "), as_text("doc_id")).alias("title"),
        F.lit("").alias("summary"),
        *(x.alias(c) for c, x in columns.items()),
        F.col("doc_id").alias("_pos"),
    )


_TALK_ID = "'talk-' || doc_id || '-' || left(md5('Talk ' || doc_id), 8) || ':0'"
_SHOWN = ("id", "text", "chunk_type", "talk_title", "source_file")


@query(
    f"""SELECT 'talk_takeaways:' || {_TALK_ID} AS id, 'Talk ' || doc_id || ' — Key Takeaways' || chr(10) || chr(10) || '- '
      || array_to_string(string_split(text, chr(10)), chr(10) || '- ') AS text,
  'talk_takeaways' AS chunk_type, 'Talk ' || doc_id AS talk_title, 'analysis_talks.json' AS source_file FROM documents WHERE doc_id % 4 <> 0"""
)
def chunk_takeaways(spark, d):
    lines = F.when(F.col("doc_id") % 4 != 0, F.split("text", "\n", -1)).otherwise(none())
    return chunks.talk_chunks(_talks(spark, d, key_takeaways=lines)).select(*_SHOWN)


@query(
    f"""SELECT 'talk_qa:' || {_TALK_ID} AS id, 'Talk ' || doc_id || ' — Q&A Highlights' || chr(10) || chr(10) || '- ' || lang || chr(10) || '- '
      || text AS text,
  'talk_qa' AS chunk_type, 'Talk ' || doc_id AS talk_title, 'analysis_talks.json' AS source_file FROM documents"""
)
def chunk_qa(spark, d):
    return chunks.talk_chunks(_talks(spark, d, qa_highlights=F.array("lang", "text"))).select(*_SHOWN)


@query(
    f"""SELECT 'talk_signals:' || {_TALK_ID} AS id, concat_ws(chr(10) || chr(10), 'Talk ' || doc_id || ' — Signals & Tools', CASE
      WHEN doc_id % 2 = 0 THEN 'Problems: ' || lang || '; ' || text END,
  CASE WHEN doc_id % 3 = 0 THEN 'Tools & Projects: ' || source END, CASE WHEN doc_id % 5 = 0 THEN 'Emerging Signals: ' || lang || '; x' END) AS text,
  'talk_signals' AS chunk_type, 'Talk ' || doc_id AS talk_title, 'analysis_talks.json' AS source_file FROM documents
    WHERE doc_id % 2 = 0 OR doc_id % 3 = 0 OR doc_id % 5 = 0"""
)
def chunk_signals(spark, d):
    on = lambda k, x: F.when(F.col("doc_id") % k == 0, x).otherwise(none())
    talks = _talks(
        spark,
        d,
        problems_discussed=on(2, F.array("lang", "text")),
        tools_and_projects=on(3, F.array("source")),
        emerging_signals=on(5, F.array(F.col("lang"), F.lit("x"))),
    )
    return chunks.talk_chunks(talks).select(*_SHOWN)


@query(
    """SELECT 'cluster_summary:' || left(replace(lower(c_name), ' ', '-'), 80) || '-' || left(md5(c_name), 8) || ':0' AS id,
  concat_ws(chr(10) || chr(10), 'Cluster: ' || c_name, 'in ' || c_mktsegment, CASE WHEN c_custkey % 2 = 0 THEN 'Relevance: ' || c_nationkey END, CASE
    WHEN c_custkey % 3 = 0 THEN 'Recommended talks: a, b ' || c_custkey END) AS text,
  'cluster_summary' AS chunk_type, c_name AS talk_title, 'analysis_ranking.json' AS source_file FROM customer WHERE c_custkey % 7 <> 0"""
)
def chunk_clusters(spark, d):
    k = F.col("c_custkey")
    ranking = t(spark, d, "customer").select(
        F.col("c_name").alias("name"),
        F.when(k % 7 != 0, F.concat(F.lit("in "), "c_mktsegment")).alias("summary"),
        F.when(k % 2 == 0, as_text("c_nationkey")).alias("relevance_argument"),
        F.when(k % 3 == 0, F.array(F.lit("a"), F.concat(F.lit("b "), as_text("c_custkey")))).otherwise(none()).alias("recommended_talks"),
        F.col("c_acctbal").alias("relevance_score"),
        k.alias("rank"),
    )
    return chunks.cluster_chunks(ranking).select(*_SHOWN)


@query(
    """WITH w AS (SELECT string_agg(r_name, ' ' ORDER BY r_regionkey) AS told FROM region)
SELECT 'conference_narrative:agenda:0' AS id, 'Conference Agenda Narrative' || chr(10) || chr(10) || told AS text, '' AS talk_title,
  'analysis_agenda.json' AS source_file FROM w
UNION ALL SELECT 'conference_narrative:recordings:0', 'Conference Recordings Narrative' || chr(10) || chr(10) || 'rec ' || told, '',
  'analysis_recordings.json' FROM w
UNION ALL SELECT 'conference_narrative:theme:' || n_nationkey, concat_ws(chr(10) || chr(10), 'Cross-cutting Theme: ' || n_name, 'of ' || n_regionkey, CASE
  WHEN n_nationkey % 3 > 0 THEN 'Supporting talks: ' || n_name || ', y' END), n_name, 'analysis_recordings.json'
  FROM nation WHERE n_nationkey % 2 = 0"""
)
def chunk_narratives(spark, d):
    told = ordering.joined_text(F.col("r_name"), " ", F.col("r_regionkey"))
    agenda = t(spark, d, "region").agg(told.alias("narrative"))
    supports = F.when(F.col("n_nationkey") % 3 > 0, F.array(F.col("n_name"), F.lit("y"))).otherwise(none())
    what = F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("of "), as_text("n_regionkey"))).otherwise("")
    themes = t(spark, d, "nation").agg(
        F.array_sort(
            F.collect_list(F.struct("n_nationkey", F.col("n_name").alias("theme"), what.alias("description"), supports.alias("supporting_talks")))
        ).alias("x")
    )
    recordings = agenda.select(F.concat(F.lit("rec "), "narrative").alias("narrative")).join(themes.withColumnRenamed("x", "cross_cutting_themes"), F.lit(True))
    got = chunks.narrative_chunks(agenda, recordings)
    return got.select("id", "text", text.filled("talk_title").alias("talk_title"), "source_file")


def _recordings(spark, d, **given) -> DataFrame:
    """One row of global signals for each part."""
    empty = {
        "maturity_landscape": "array<struct<technology:string,ring:string,evidence_quality:string,supporting_talks:array<string>,rationale:string>>",
        "tensions": "array<struct<topic:string,side_a:struct<position:string,supporting_talks:array<string>>,side_b:struct<position:string,supporting_talks:array<string>>,severity:string,implication:string>>",
        "recommended_actions": "array<struct<action:string,category:string,urgency:string,supporting_evidence:string>>",
        "technology_relationships": "array<struct<entity_a:string,relation:string,entity_b:string,supporting_talks:array<string>>>",
    }
    return t(spark, d, "part").select("p_partkey", *((given[c] if c in given else F.array()).cast(kind).alias(c) for c, kind in empty.items()))


def _safe_sql(x: str) -> str:
    return f"left(replace(lower({x}), ' ', '-'), 80) || '-' || left(md5({x}), 8)"


_PART = "p_name || ' ' || p_partkey"


def _part() -> Column:
    return F.concat("p_name", F.lit(" "), as_text("p_partkey"))


def _when(k: int, x: Column) -> Column:
    return F.when(F.col("p_partkey") % k == 0, x)


@query(
    f"""SELECT 'maturity_assessment:' || {_safe_sql(_PART)} || ':0' AS id, concat_ws(chr(10) || chr(10), 'Technology Maturity: ' || {_PART}, 'Ring: ' || CASE
      WHEN p_partkey % 2 = 0 THEN 'adopt' ELSE 'assess' END,
  'Evidence quality: ' || CASE WHEN p_partkey % 3 = 0 THEN 'benchmarked' ELSE 'anecdotal' END, CASE WHEN p_partkey % 5 = 0 THEN 'Rationale: ' || p_type END,
    CASE WHEN p_partkey % 7 = 0 THEN 'Supporting talks: ' || p_brand || ', z' END) AS text,
  {_PART} AS talk_title, CASE WHEN p_partkey % 2 = 0 THEN 'adopt' ELSE 'assess' END AS ring FROM part WHERE p_partkey % 11 > 0"""
)
def chunk_maturity(spark, d):
    technology = F.when(F.col("p_partkey") % 11 > 0, _part())
    talks = _when(7, F.array(F.col("p_brand"), F.lit("z"))).otherwise(none())
    one = F.struct(
        technology.alias("technology"),
        _when(2, F.lit("adopt")).alias("ring"),
        _when(3, F.lit("benchmarked")).alias("evidence_quality"),
        talks.alias("supporting_talks"),
        _when(5, F.col("p_type")).alias("rationale"),
    )
    return chunks.signal_chunks(_recordings(spark, d, maturity_landscape=F.array(one))).select(
        "id", "text", "talk_title", F.element_at("extra", "ring").alias("ring")
    )


@query(
    f"""SELECT 'tension:' || {_safe_sql(_PART)} || ':0' AS id, concat_ws(chr(10) || chr(10), 'Tension: ' || {_PART}, 'Side A: ' || p_type,
      'Supporting talks (A): ' || CASE WHEN p_partkey % 2 = 0 THEN p_brand || ', z' ELSE '' END, 'Side B: ' || p_brand,
  'Supporting talks (B): ', 'Severity: ' || CASE WHEN p_partkey % 3 = 0 THEN 'fundamental' ELSE 'minor' END, CASE WHEN p_partkey % 5 = 0 THEN 'Implication: '
    || p_size END) AS text, {_PART} AS talk_title FROM part WHERE p_partkey % 11 > 0"""
)
def chunk_tensions(spark, d):
    talks = _when(2, F.array(F.col("p_brand"), F.lit("z"))).otherwise(none())
    sides = [
        F.struct(F.col("p_type").alias("position"), talks.alias("supporting_talks")),
        F.struct(F.col("p_brand").alias("position"), none().alias("supporting_talks")),
    ]
    one = F.struct(
        F.when(F.col("p_partkey") % 11 > 0, _part()).alias("topic"),
        sides[0].alias("side_a"),
        sides[1].alias("side_b"),
        _when(3, F.lit("fundamental")).alias("severity"),
        _when(5, as_text("p_size")).alias("implication"),
    )
    return chunks.signal_chunks(_recordings(spark, d, tensions=F.array(one))).select("id", "text", "talk_title")


_LONG = "'Use ' || p_name || ' ' || repeat('very ', 20) || p_partkey"


@query(
    f"""SELECT 'recommended_action:' || {_safe_sql(_LONG)} || ':0' AS id, concat_ws(chr(10) || chr(10), 'Recommended Action: ' || {_LONG}, 'Category: ' ||
      CASE WHEN p_partkey % 2 = 0 THEN 'adopt' ELSE 'watch' END,
  'Urgency: ' || CASE WHEN p_partkey % 3 = 0 THEN 'immediate' ELSE 'long_term' END, CASE WHEN p_partkey % 5 = 0 THEN 'Evidence: ' || p_type END) AS text,
    left({_LONG}, 80) AS talk_title FROM part WHERE p_partkey % 11 > 0"""
)
def chunk_actions(spark, d):
    action = F.concat(F.lit("Use "), "p_name", F.lit(" " + "very " * 20), as_text("p_partkey"))
    one = F.struct(
        F.when(F.col("p_partkey") % 11 > 0, action).otherwise("").alias("action"),
        _when(2, F.lit("adopt")).alias("category"),
        _when(3, F.lit("immediate")).alias("urgency"),
        _when(5, F.col("p_type")).alias("supporting_evidence"),
    )
    return chunks.signal_chunks(_recordings(spark, d, recommended_actions=F.array(one))).select("id", "text", "talk_title")


@query(
    f"""SELECT 'technology_relationship:' || {_safe_sql(_PART)} || '-' || {_safe_sql("p_brand")} || ':0' AS id, concat_ws(chr(10) || chr(10),
      'Technology Relationship: ' || {_PART} || ' extends ' || p_brand,
  CASE WHEN p_partkey % 2 = 0 THEN 'Supporting talks: ' || p_type END) AS text, {_PART} || ' extends ' || p_brand AS talk_title FROM part
    WHERE p_partkey % 11 > 0 AND p_partkey % 13 > 0"""
)
def chunk_relationships(spark, d):
    a, b = F.when(F.col("p_partkey") % 11 > 0, _part()), F.when(F.col("p_partkey") % 13 > 0, F.col("p_brand")).otherwise("")
    talks = _when(2, F.array("p_type")).otherwise(none())
    one = F.struct(a.alias("entity_a"), F.lit("extends").alias("relation"), b.alias("entity_b"), talks.alias("supporting_talks"))
    return chunks.signal_chunks(_recordings(spark, d, technology_relationships=F.array(one))).select("id", "text", "talk_title")


@query(
    f"""SELECT 'transcript_segment:v' || conv_id || ':' || chunk_index AS id, text, 'Talk ' || conv_id AS talk_title, 'Ann (Acme), Bob' AS speakers,
      'Acme' AS companies, 'tr' AS track, 'v' || conv_id AS video_id,
  'transcripts/v' || conv_id || '.json' AS source_file, start_time FROM ({queries.ORACLE_SQL["transcript_chunks"]}) WHERE conv_id % 5 > 0"""
)
def chunk_transcripts(spark, d):
    """Chunks of transcripts with their session's data; recordings without a session give none."""
    c = t(spark, d, "conversations").withColumn("v", F.concat(F.lit("v"), as_text("conv_id")))
    one = F.struct(F.col("turn").cast("double").alias("start"), "text")
    heard = c.groupBy(F.col("v").alias("video_id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("turn", one.alias("s")))), lambda r: r["s"]).alias("segments")
    )
    who = F.array(F.struct(F.lit("Ann").alias("name"), F.lit("Acme").alias("company")), F.struct(F.lit("Bob").alias("name"), F.lit("").alias("company")))
    mine = c.where("conv_id % 5 > 0").select(F.col("v").alias("video_id"), "conv_id").distinct()  # the others have no session
    s = mine.select(
        "video_id",
        F.concat(F.lit("Talk "), as_text("conv_id")).alias("title"),
        who.alias("speakers"),
        F.lit("tr").alias("track"),
        F.col("conv_id").alias("_pos"),
    )
    got = chunks.transcript_chunks(s, heard)
    return got.select("id", "text", "talk_title", "speakers", "companies", "track", "video_id", "source_file", "start_time")


# Artifacts -------------------------------------------------------------------------------------------------------


@query("SELECT doc_id, text AS title, lang AS track FROM documents")
def artifact_round_trip(spark, d):
    """Sessions written as a JSON artifact in the shared folder and read back under the declared schema."""
    path = f"{artifacts.shared_folder(spark)}/round_trip"
    docs = t(spark, d, "documents").select(
        F.col("text").alias("title"),
        F.lit(None).cast("string").alias("name"),
        F.col("lang").alias("track"),
        as_text("doc_id").alias("time"),
    )
    artifacts.write_json(docs, path)
    back = artifacts.read_json(spark, path, "raw_session", lines=True)
    return back.select(F.col("time").cast("long").alias("doc_id"), "title", "track")


@query("SELECT event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events) WHERE n = 1")
def resumed_results(spark, d):
    """Results appended in two batches; the second run skips what is done."""
    path = f"{artifacts.shared_folder(spark)}/results"
    first = ordering.keep_first(t(spark, d, "events").withColumn("k", as_text("user_id")), F.col("k"), F.col("event_id")).select("user_id", "event_id", "ts")
    artifacts.append_results(first.where("user_id % 2 = 0"), path)
    done = spark.read.schema(first.schema).parquet(path)
    artifacts.append_results(artifacts.checkpointed(ordering.unprocessed(first, done, "user_id")), path)
    return spark.read.schema(first.schema).parquet(path).select("event_id", "ts")


@query("SELECT p_partkey, round(p_retailprice / 7, 1)::DOUBLE AS one, round(p_retailprice / 7, 2)::DOUBLE AS two FROM part")
def rounded_seconds(spark, d):
    x = F.col("p_retailprice") / 7
    return t(spark, d, "part").select("p_partkey", time.rounded(x, 1).alias("one"), time.rounded(x, 2).alias("two"))



# Models and what goes around them --------------------------------------------------------------------------------


class Echo:
    """Answers with what follows a colon in the prompt, with JSON where it is asked for; some prompts fail or have no answer."""

    def complete(self, system: str, prompt: str, max_tokens: int) -> str:
        if prompt.startswith("fail"):
            raise RuntimeError("no answer")
        if prompt.startswith("none"):
            return ""
        said = prompt.split(":", 1)[-1][:max_tokens]
        if prompt.startswith("json"):
            import json

            return "Here:\n```json\n" + json.dumps({"name": said, "rank": len(said), "recommended_talks": [said[:3], "x"]}) + "\n```"
        return said


_KIND = "CASE doc_id % 4 WHEN 0 THEN 'fail:' WHEN 1 THEN 'none:' ELSE 'say:' END"


@query(
    f"""SELECT doc_id, CASE WHEN doc_id % 4 > 1 THEN left(text, 300) END AS answer,
  CASE doc_id % 4 WHEN 0 THEN 'RuntimeError: no answer' WHEN 1 THEN 'ValueError: empty answer' END AS error FROM documents WHERE {_KIND} <> ''"""
)
def model_completion(spark, d):
    """One call for each row, its answer cut at the budget; a failure or an empty answer stays with its row."""
    from talkloom.plans.providers import complete

    asked = t(spark, d, "documents").select("doc_id", F.concat(F.expr(_KIND), "text").alias("prompt"))
    return complete(asked, "Echo.", Echo, max_tokens=300).select("doc_id", F.col("answer.value").alias("answer"), F.col("answer.error").alias("error"))


@query(
    """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN lang END AS name, CASE WHEN doc_id % 3 = 0 THEN length(lang)::INTEGER END AS rank,
  CASE WHEN doc_id % 3 = 0 THEN left(lang, 3) || ',x' END AS talks, CASE WHEN doc_id % 3 > 0 THEN 'no JSON in the answer' END AS error FROM documents"""
)
def model_structured(spark, d):
    """Answers in JSON parsed under a declared schema; those without any are told of."""
    from talkloom.plans.providers import complete_json
    from talkloom.schemas import schema

    asked = t(spark, d, "documents").select("doc_id", F.concat(F.when(F.col("doc_id") % 3 == 0, "json:").otherwise("say:"), "lang").alias("prompt"))
    got = complete_json(asked, "Echo.", schema("ranking"), Echo)
    return got.select(
        "doc_id", F.col("parsed.name").alias("name"), F.col("parsed.rank").alias("rank"), F.array_join("parsed.recommended_talks", ",").alias("talks"), "error"
    )


@query(
    """SELECT doc_id, left('Title: ' || lang || chr(10) || text || chr(10) || chr(10) || '[SLIDE CONTENT]' || chr(10) || repeat(text, 9), 30000 + length('Title: ' || lang || chr(10))) AS prompt
FROM documents WHERE length(text) >= 100"""
)
def capped_prompts(spark, d):
    """What a model reads of a talk is cut at 30,000 characters."""
    from talkloom.plans.steps import talks_to_analyze

    who = F.array(F.struct(as_text("doc_id").alias("name"), F.lit("").alias("company")))
    matched = t(spark, d, "documents").select(
        F.col("lang").alias("title"),
        who.alias("speakers"),
        F.col("text").alias("transcript"),
        F.lit(0.0).alias("duration_sec"),
        F.repeat("text", F.lit(9)).alias("slide_text"),
        F.lit("").alias("slide_aligned"),
        none().alias("slide_references"),
    )
    return talks_to_analyze(matched).select(F.col("speakers").cast("long").alias("doc_id"), "prompt")


_TOPICS = ("Asia and the MIDDLE east", "china, India")


@query(
    """WITH c AS (SELECT r_regionkey AS i, r_name AS name, list(n_name ORDER BY n_nationkey) AS talks FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1, 2),
k AS (SELECT *, list_distinct(list_filter(regexp_extract_all(lower(name || ' ' || array_to_string(talks, ' ') || ' word'), '[a-z0-9]+'), lambda x: length(x) > 2)) AS mine FROM c),
s AS (SELECT *, len(list_intersect(mine, ['and', 'asia', 'china', 'east', 'india', 'middle', 'the'])) + len(talks) / 1000 AS raw FROM k)
SELECT name, row_number() OVER (ORDER BY raw DESC, i)::INTEGER AS rank, round(raw / max(raw) OVER (), 4) AS relevance_score FROM s"""
)
def rank_clusters(spark, d):
    """The local default: clusters by the terms of the topics that they hold."""
    from talkloom.plans.steps import rank_clusters as rank

    n = t(spark, d, "nation").join(t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    c = n.groupBy("r_regionkey", "r_name").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: x["n_name"]).alias("talks")
    )
    one = F.struct(
        "r_regionkey",
        F.struct(
            F.col("r_name").alias("name"),
            F.lit("").alias("description"),
            "talks",
            F.array(F.lit("word")).alias("keywords"),
            none().alias("companies"),
        ).alias("c"),
    )
    agenda = c.agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["c"]).alias("clusters"))
    return rank(agenda, list(_TOPICS)).select("name", "rank", "relevance_score")


@query(
    """WITH u AS (SELECT source AS cluster, 'talk ' || doc_id || '.' AS title, unnest([lang, 't' || (doc_id % 17)]) AS technology FROM documents),
n AS (SELECT cluster, technology, count(DISTINCT title)::INTEGER AS mentions FROM u GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY mentions DESC, technology) AS k FROM n)
SELECT cluster, string_agg(technology || ' ' || mentions, ', ' ORDER BY k) AS technologies FROM r WHERE k <= 12 GROUP BY 1"""
)
def cluster_technologies(spark, d):
    """The technologies that most talks of a cluster name, of the titles that an agenda lists and that resolve."""
    from talkloom.plans import synthesis
    from talkloom.schemas import schema

    title = F.concat(F.lit("talk "), as_text("doc_id"), F.lit("."))
    docs = t(spark, d, "documents").select("doc_id", "source", "lang", title.alias("title"))
    listed = docs.groupBy("source").agg(F.array_sort(F.collect_list("title")).alias("talks"))
    agenda = listed.select(F.array(F.struct(F.col("source").alias("name"), F.concat("talks", F.array(F.lit("unknown"))).alias("talks"))).alias("clusters"))
    kinds = {f.name: f.dataType for f in schema("talk").fields}
    named = F.array("lang", F.concat(F.lit("t"), (F.col("doc_id") % 17).cast("string")))
    given = {"title": F.col("title"), "tools_and_projects": named}
    talks = docs.select(*(given.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()), F.col("doc_id").alias("_pos"))
    got = synthesis.aggregated(synthesis.cluster_members(agenda, talks), talks)
    shown = F.transform("emerging_technologies", lambda x: F.concat(x["technology"], F.lit(" "), x["mentions"].cast("string")))
    return got.select("cluster", F.array_join(shown, ", ").alias("technologies"))


# Sources and sinks -----------------------------------------------------------------------------------------------


@query(
    """SELECT 'https://h/event/e' || page_id || '/x' AS url, 'Talk ' || page_id AS title, CASE WHEN page_id % 2 = 0 THEN 'Room ' || (page_id % 7) ELSE '' END AS venue, 'e' || page_id AS event_id
FROM pages WHERE page_id % 5 > 0"""
)
def parse_listing(spark, d):
    """Sessions on listing pages, each URL once; links that lead elsewhere are none."""
    from talkloom.sources.listing import listing_sessions

    p, k = as_text("page_id"), F.col("page_id")
    href = F.when(k % 5 > 0, F.concat(F.lit("event/e"), p, F.lit("/x"))).otherwise("http://elsewhere/")
    venue = F.when(k % 2 == 0, F.concat(F.lit('<span class="vs">Room '), (k % 7).cast("string"), F.lit("</span>"))).otherwise("")
    one = F.concat(F.lit('<div><span class="event big"><a class="name" href="'), href, F.lit('">Talk '), p, F.lit(" "), venue, F.lit("</a></span></div>"))
    html = F.concat(F.col("html"), one, one)
    pages = t(spark, d, "pages").select(F.lit("https://h").alias("url"), html.alias("html"))
    return listing_sessions(pages).select("url", "title", "venue", "event_id")


@query(
    """SELECT page_id, 'About ' || page_id AS abstract, 'Ann ' || page_id || ' (Acme), Bob' AS speakers, CASE WHEN page_id % 2 = 0 THEN 'Track ' || (page_id % 3) ELSE '' END AS track,
  'Mon 9:00' AS time, CASE WHEN page_id % 3 = 0 THEN 'a,b' ELSE '' END AS tags FROM pages"""
)
def parse_detail(spark, d):
    from talkloom.sources.listing import detail_sessions

    p, k = as_text("page_id"), F.col("page_id")
    person = lambda name, company: F.concat(
        F.lit('<div class="sched-person-session"><h2><a>'), name, F.lit("</a></h2>"), company, F.lit("</div>")
    )
    people = F.concat(person(F.concat(F.lit("Ann "), p), F.lit('<div class="sched-event-details-role-company"> Acme </div>')), person(F.lit("Bob"), F.lit("")))
    track = F.when(k % 2 == 0, F.concat(F.lit('<div class="sched-event-type"><a>Track '), (k % 3).cast("string"), F.lit("</a></div>"))).otherwise("")
    tags = F.when(k % 3 == 0, '<ul class="tip-custom-fields"><li>a</li><li> b</li></ul>').otherwise("")
    about = F.concat(F.lit('<div class="tip-description"><strong>Abstract</strong>About '), p, F.lit("</div>"))
    when = F.lit('<div class="sched-event-details-timeandplace">Mon 9:00   Room</div>')
    html = F.concat(F.lit("<html><body>"), about, F.lit('<div class="tip-roles">'), people, F.lit("</div>"), track, when, tags)
    got = detail_sessions(t(spark, d, "pages").select(p.alias("url"), html.alias("html")))
    return got.select(
        F.col("url").cast("long").alias("page_id"), "abstract", text.speakers_text("speakers").alias("speakers"), "track", "time", F.array_join("tags", ",").alias("tags")
    )


@query("SELECT page_id FROM pages WHERE page_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def fetch_plan(spark, d):
    """Pages whose details are not cached yet."""
    from talkloom.sources.listing import fetch_plan as plan

    cached = t(spark, d, "labels").select(F.col("doc_id").alias("page_id")).where("page_id is not null")
    return plan(t(spark, d, "pages").select("page_id"), cached, "page_id")


@query("SELECT lang AS chunk_type, count(*) AS n, count(*) FILTER (doc_id % 2 = 0) AS found FROM documents GROUP BY 1")
def index_build(spark, d):
    """The vector table is written anew, by kind; what is read back through a filter on kind and track is all of it."""
    from talkloom.plans.steps import build_index, load_index

    path = f"{artifacts.shared_folder(spark)}/index"
    track = F.when(F.col("doc_id") % 2 == 0, "even").otherwise("odd")
    rows = t(spark, d, "documents").select(as_text("doc_id").alias("id"), "text", F.col("lang").alias("chunk_type"), track.alias("track"))
    counted = build_index(rows, path)
    kinds = [r["chunk_type"] for r in counted.collect()]  # the languages: a closed vocabulary
    even = retrieval.where_metadata(load_index(spark, path), kinds, "even").groupBy("chunk_type").agg(F.count("*").alias("found"))
    return counted.join(even, "chunk_type", "left").select("chunk_type", "n", F.coalesce("found", F.lit(0)).alias("found"))


@query(
    """WITH s AS (SELECT p.vec_id AS probe, v.vec_id, round(1 - list_cosine_similarity(v.embedding::DOUBLE[], p.embedding::DOUBLE[]), 6) AS distance
  FROM embeddings v, embeddings p WHERE p.vec_id < 5),
r AS (SELECT *, row_number() OVER (PARTITION BY probe ORDER BY distance, vec_id) AS n FROM s)
SELECT probe, vec_id, distance FROM r WHERE n <= 15"""
)
def index_search(spark, d):
    """Five questions to an index of all vectors, answered exactly by its cells."""
    path = f"{artifacts.shared_folder(spark)}/index"
    v = t(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    vector_index.refresh(v, path, lambda rows: rows)
    asked = [(r["id"], r["embedding"]) for r in v.where("id < 5").collect()]
    found = [vector_index.search(spark, path, q, digits=6).select(F.lit(i).cast("long").alias("probe"), F.col("id").alias("vec_id"), "distance") for i, q in asked]
    return functools.reduce(DataFrame.unionByName, found)


@query(
    """SELECT doc_id::VARCHAR AS id, md5(coalesce(text, '')) AS text_key,
  CASE WHEN doc_id % 50 = 7 OR doc_id % 60 = 11 THEN 2 ELSE 1 END::BIGINT AS made FROM documents"""
)
def index_refresh(spark, d):
    """An index of all documents as they were (some other, some not there yet, some that are gone now), brought up to what they
    are: only what is other or new is embedded again."""
    path = f"{artifacts.shared_folder(spark)}/index"
    docs = t(spark, d, "documents").select(as_text("doc_id").alias("id"), "text", "source", "doc_id")
    draft = F.when(F.col("doc_id") % 50 == 7, F.concat(F.lit("draft "), F.coalesce("text", F.lit("")))).otherwise(F.col("text"))
    gone = docs.where("doc_id % 70 = 3").withColumn("id", F.concat("id", F.lit("-gone")))
    before = docs.where("doc_id % 60 <> 11").withColumn("text", draft).unionByName(gone)
    for rows in (before, docs):
        vector_index.refresh(rows.drop("doc_id"), path, providers.embed, ["source"])
    return vector_index.load(spark, path).select("id", F.md5(F.coalesce("text", F.lit(""))).alias("text_key"), "made")


_LINK = "(SELECT CASE WHEN count(*) > 0 THEN '[' || {0} || '](appendix.md#' || {0} || ')' ELSE {0} END FROM benchmark WHERE 'talk ' || item_id = {0})"


@query(
    f"""WITH p AS (SELECT doc_id, 'talk ' || doc_id % 100 AS a, 'talk ' || doc_id % 77 AS b, 'talk ' || doc_id % 50 AS c, replace(text, '*', '') AS rest FROM documents)
SELECT doc_id, '**' || {_LINK.format("a")} || '** then *' || {_LINK.format("b")} || '*, * see ***' || {_LINK.format("c")} || '***, ' || a || ' and **' || a || ' ** here'
  || chr(10) || rest AS text FROM p"""
)
def cross_references(spark, d):
    """Pages of all documents, titles of all benchmark items."""
    name = lambda n: F.concat(F.lit("talk "), (F.col("doc_id") % n).cast("string"))
    parts = ["**", name(100), "** then *", name(77), "*, * see ***", name(50), "***, ", name(100), " and **", name(100), " ** here\n", F.replace("text", F.lit("*"), F.lit(""))]
    pages = t(spark, d, "documents").select("doc_id", F.concat(*(F.lit(x) if isinstance(x, str) else x for x in parts)).alias("text"))
    title = F.concat(F.lit("talk "), as_text("item_id"))
    targets = t(spark, d, "benchmark").select(title.alias("title"), F.concat(F.lit("appendix.md#"), title).alias("target"), F.col("item_id").alias("pos"))
    return links.linked(pages, targets, "doc_id")


@query(
    """WITH e AS (SELECT user_id, event_id, floor(epoch(ts))::BIGINT AS s, event_type FROM events),
t AS (SELECT user_id, s AS ts, s + 4000 + 100 * (event_id % 7) AS te, 'Speaker ' || event_id % 5 AS speaker FROM e WHERE event_type = 'view'),
g AS (SELECT user_id, event_id, s AS ss, s + 600 + event_id % 50 AS se FROM e WHERE event_type <> 'view'),
o AS (SELECT g.user_id, event_id, speaker, sum(least(te, se) - greatest(ts, ss)) AS shared, min(ts) AS begins
  FROM g JOIN t ON g.user_id = t.user_id AND ts < se AND ss < te GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_id ORDER BY shared DESC, begins, speaker) AS n FROM o)
SELECT g.user_id, g.event_id, speaker FROM g LEFT JOIN r ON g.user_id = r.user_id AND g.event_id = r.event_id AND n = 1"""
)
def speaker_turns(spark, d):
    """Views as turns of five speakers, other events as segments."""
    e = t(spark, d, "events").select("user_id", "event_id", time.epoch(F.col("ts")).alias("start"), "event_type")
    length = 4000 + 100 * (F.col("event_id") % 7)
    said = e.where("event_type = 'view'").select(
        "user_id", "start", (F.col("start") + length).alias("end"), F.concat(F.lit("Speaker "), (F.col("event_id") % 5).cast("string")).alias("speaker")
    )
    heard = e.where("event_type <> 'view'").select("user_id", "event_id", "start", (F.col("start") + 600 + F.col("event_id") % 50).alias("end"))
    return turns.with_speakers(heard, said, "user_id", "event_id", 1800).select("user_id", "event_id", "speaker")


@query(r"SELECT doc_id, len(string_split_regex(trim(text), '\s+'))::INTEGER AS words FROM documents WHERE text IS NOT NULL")
def streamed_results(spark, d):
    """All documents as work of two arrivals, answered as a stream; the third run finds nothing to do."""
    root = artifacts.shared_folder(spark)
    docs = t(spark, d, "documents").select("doc_id", "text").where("text is not null")
    ddl, paths = "doc_id long, text string", {"done": f"{root}/done"}
    count = F.size(F.split(F.trim("text"), r"(?U)\s+")).alias("words")
    for part in (docs.where("doc_id % 3 = 0"), docs.where("doc_id % 3 <> 0"), None):
        if part is not None:
            work.enqueue(part, f"{root}/queue", 500)
        work.drain(spark, f"{root}/queue", ddl, f"{root}/progress", lambda batch: {"done": batch.select("doc_id", count)}, paths)
    return work.results(spark, paths["done"], "doc_id long, words int")


@query(queries.ORACLE_SQL["transcript_chunks"])
def arriving_chunks(spark, d):
    """The chunks of all conversations, kept up as their turns arrive: odd turns first, then even ones between them."""
    root = artifacts.shared_folder(spark)
    segments = t(spark, d, "conversations").select("conv_id", "turn", "text")
    for part in (segments.where("turn % 2 = 1"), segments.where("turn % 2 = 0")):
        part.write.mode("append").parquet(f"{root}/in")
        arrivals.keep_chunks(spark, f"{root}/in", segments.schema, f"{root}/out", f"{root}/mark", "conv_id", "turn", "text", "turn")
    return spark.read.parquet(f"{root}/out/chunks").drop("bucket")


@query(
    """SELECT (SELECT count(*) FROM documents) AS sections_checked, count(*) FILTER (event_id % 5 = 0) AS unknown_speakers,
  count(*) FILTER (event_id % 5 = 1) AS ungrounded_metrics, count(*) FILTER (event_id % 5 = 2) AS template_artifacts,
  count(*) FILTER (event_id % 5 = 3) AS fabricated_citations, count(*) AS total FROM events WHERE event_id % 5 < 4"""
)
def report_stats(spark, d):
    """Counts of a report's warnings: documents as sections, events as warnings of four kinds."""
    kind = cases(F.col("event_id"), *validation.KINDS, "")
    found = t(spark, d, "events").select(F.col("user_id").alias("section_id"), kind.alias("kind"), F.lit("m").alias("message")).where("kind <> ''")
    return validation.stats(t(spark, d, "documents").select(F.col("doc_id").alias("section_id")), found)


@query("SELECT conv_id, max((role = 'user')::INTEGER) AS deep FROM conversations GROUP BY 1")
def enriched_union(spark, d):
    """Sections to enrich and those that pass through are together all of them."""
    c = t(spark, d, "conversations")
    one = F.struct(F.col("turn").cast("string").alias("talk_title"), F.lit("c").alias("claim"), (F.col("role") == "user").alias("needs_quote"))
    s = c.groupBy("conv_id").agg(F.collect_list(one).alias("citations")).withColumn("section_type", F.lit("cluster_deep_dive"))
    deep, rest = reports.enrichment_split(s)
    return deep.select("conv_id", F.lit(1).alias("deep")).unionByName(rest.select("conv_id", F.lit(0).alias("deep")))


@query(
    """SELECT 'cluster_' || replace(trim(regexp_replace(lower(n_name), '[^a-z0-9]+', '-', 'g'), '-'), '-', '_') AS section_id, n_name AS title,
  CASE WHEN n_nationkey % 10 >= 7 THEN 'cluster_deep_dive' ELSE 'cluster_brief' END AS section_type, n_nationkey + 2 AS priority, CASE WHEN n_nationkey % 10 >= 7 THEN 1000 ELSE 250 END AS word_budget
FROM nation WHERE n_nationkey % 10 >= 4
UNION ALL SELECT * FROM (VALUES ('landscape', 'Conference Landscape', 'landscape', 1, 600), ('cross_cutting', 'Cross-Cutting Themes', 'cross_cutting', 50, 800),
  ('tensions', 'Debates and Tensions', 'tensions', 60, 500), ('maturity', 'Technology Maturity', 'maturity', 70, 500), ('actions', 'Recommended Actions', 'actions', 80, 400))"""
)
def report_outline(spark, d):
    """Fixed sections around deep dives and briefs by relevance; clusters below both have none."""
    from talkloom.plans.steps import outline

    ranking = t(spark, d, "nation").select(
        F.col("n_name").alias("name"),
        (F.col("n_nationkey") + 1).alias("rank"),
        ((F.col("n_nationkey") % 10) / 10).alias("relevance_score"),
    )
    sections = outline(ranking).select(F.explode("sections").alias("s"))
    return sections.select("s.section_id", "s.title", "s.section_type", "s.priority", "s.word_budget")


#: The query that gives each kind of chunks (slides' groups apart, which have no ids).
_KINDS = {
    "transcript_segment": "chunk_transcripts", "talk_abstract": "chunk_union", "talk_summary": "chunk_union", "talk_takeaways": "chunk_takeaways",
    "talk_qa": "chunk_qa", "talk_signals": "chunk_signals", "cluster_summary": "chunk_clusters", "conference_narrative": "chunk_narratives",
    "maturity_assessment": "chunk_maturity", "tension": "chunk_tensions", "recommended_action": "chunk_actions",
    "technology_relationship": "chunk_relationships",
}


@query(
    "SELECT id, split_part(id, ':', 1) AS chunk_type, md5(text) AS digest FROM ("
    + " UNION ALL ".join(f"SELECT id, text FROM ({queries.ORACLE_SQL[name]})" for name in dict.fromkeys(_KINDS.values()))
    + f" UNION ALL SELECT 'slide_content:' || user_id || ':' || chunk_index, text FROM ({queries.ORACLE_SQL['slide_groups']}))"
)
def chunk_every_kind(spark, d):
    """All thirteen kinds at once; chunks of an id that come again later in their kind or in a later kind go. Rows of one name
    (customers, say) have one id and one place, and all stay."""

    def part(kind: str, as_kind: str = "", **given: Column) -> DataFrame:
        if kind == "slide_content":
            slide = F.concat_ws(":", F.lit(kind), as_text("user_id"), as_text("chunk_index"))
            rows = queries.slide_groups(spark, d).select(slide.alias("id"), "text")
        else:
            rows = queries.QUERIES[_KINDS[kind]](spark, d).where(F.substring_index("id", ":", 1) == kind)
        return chunks.as_chunks(rows, as_kind or kind, **{"id": F.col("id"), "text": F.col("text")} | given)

    again = part("talk_takeaways", text=F.lit("later"), _pos=F.lit(1))
    elsewhere = part("talk_qa", "tension", text=F.lit(""), _pos=F.lit(-1))
    got = chunks.union_places(elsewhere, again, *(part(kind) for kind in reversed(chunks.ORDER)))
    return got.select("id", "chunk_type", F.md5("text").alias("digest"))
