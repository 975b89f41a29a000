"""Every operator as a query over the driver's tables, with SQL of equal rows where SQL can express it.

The tables stand in for artifacts: documents for talks, conversations for transcripts, events for timed slides and
segments, benchmark for titles, pages for scraped pages, embeddings for the vector table, TPC-H tables for dimensions.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from talkloom.functions import entities, grounding, text, time, vector
from talkloom.operators import aggregates, alignment, chunks, hashes, matching, ordering, reports, retrieval, sessions, validation
from talkloom.plans.registry import ORACLE_SQL, QUERIES, query, t

__all__ = ["ORACLE_SQL", "QUERIES"]


# Text ------------------------------------------------------------------------------------------------------------

_SQUEEZE = r"trim(regexp_replace({}, '\s+', ' ', 'g'))"
_FOLDED = _SQUEEZE.format("lower({})")


@query("SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '\\s+', ' ', 'g')) AS body FROM pages")
def clean_html_text(spark, d):
    return t(spark, d, "pages").select("page_id", text.clean("html").alias("body"))


@query(
    "SELECT doc_id, text FROM (SELECT *, row_number() OVER (PARTITION BY lower(trim(text)) ORDER BY doc_id) AS n FROM documents WHERE trim(text) <> '') WHERE n = 1"
)
def dedup_keep_first(spark, d):
    s = t(spark, d, "documents").select("doc_id", "text", F.col("text").alias("title"))
    return sessions.dedup(s, "doc_id").select("doc_id", "text")


@query("SELECT lower(url) AS url, min(page_id) AS first_page FROM pages GROUP BY 1")
def listing_dedup(spark, d):
    p = t(spark, d, "pages").withColumn("k", F.lower("url"))
    return ordering.keep_first(p, F.col("k"), F.col("page_id")).select(F.col("k").alias("url"), F.col("page_id").alias("first_page"))


@query(
    r"""WITH h AS (SELECT page_id, regexp_extract(url, '://([^/?#]*)', 1) AS host FROM pages)
SELECT page_id, CASE WHEN host = 'example.com' OR host LIKE '%.example.com' THEN 'com'
  WHEN host = 'example.net' OR host LIKE '%.example.net' THEN 'net' END AS provider FROM h"""
)
def provider_resolve(spark, d):
    from talkloom.sources.listing import providers

    patterns = spark.createDataFrame([("example.com", "com", 0), ("example.net", "net", 1)], "domain string, provider string, place int")
    return providers(t(spark, d, "pages").select("page_id", "url"), patterns).select("page_id", "provider")


@query(
    r"SELECT page_id, array_to_string(list_sort(list_distinct(regexp_extract_all(url || ' see ' || url || ') http://a.example/x', 'https?://[^\s<>\])""'']+'))), ' ') AS urls FROM pages"
)
def url_extract(spark, d):
    twice = F.concat("url", F.lit(" see "), "url", F.lit(") http://a.example/x"))
    return t(spark, d, "pages").select("page_id", F.array_join(text.urls(twice), " ").alias("urls"))


@query(
    """SELECT c_custkey, left(replace(lower(c_name), ' ', '-'), 80) || '-' || left(md5(c_name), 8) AS safe_id,
  left(trim(regexp_replace(lower(c_name || ' (' || c_mktsegment || ')'), '[^a-z0-9]+', '-', 'g'), '-'), 60) AS slug FROM customer"""
)
def safe_id_slug(spark, d):
    c = t(spark, d, "customer")
    return c.select("c_custkey", text.safe_id("c_name").alias("safe_id"), text.slug(F.concat("c_name", F.lit(" ("), "c_mktsegment", F.lit(")"))).alias("slug"))


_TOKENS = "list_distinct(list_filter(regexp_extract_all(lower({}), '[a-z0-9]+'), lambda x: length(x) > 2))"


@query(f"SELECT doc_id, len({_TOKENS.format('text')})::INTEGER AS n_tokens, array_to_string(list_sort({_TOKENS.format('text')}), ' ') AS tokens FROM documents")
def token_sets(spark, d):
    return t(spark, d, "documents").select(
        "doc_id", F.size(text.tokens("text")).alias("n_tokens"), F.array_join(F.array_sort(text.tokens("text")), " ").alias("tokens")
    )


@query(
    r"""WITH prose AS (SELECT doc_id, text || ' ' || (doc_id % 7) || '% of all' AS prose FROM documents), src AS (SELECT (doc_id % 3) || '%' AS p
      FROM documents)
SELECT doc_id, p AS percentage FROM (SELECT doc_id, unnest(regexp_extract_all(prose, '\d+(?:\.\d+)?%')) AS p FROM prose) WHERE p NOT IN (SELECT p FROM src)"""
)
def grounding_check(spark, d):
    docs = t(spark, d, "documents")
    s = docs.select(F.col("doc_id").alias("section_id"), F.concat("text", F.lit(" "), (F.col("doc_id") % 7).cast("string"), F.lit("% of all")).alias("prose"))
    known = docs.select(F.concat((F.col("doc_id") % 3).cast("string"), F.lit("%")).alias("percentage"))
    return validation.ungrounded_metrics(s, known).select(F.col("section_id").alias("doc_id"), "percentage")


@query(
    r"""SELECT doc_id, regexp_matches(title, '\bclosing\s+remarks?\b', 'i') OR regexp_matches(title, '\bsponsored?\s+keynote\b', 'i') AS skip
FROM (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'Closing  Remarks ' WHEN 1 THEN 'Sponsor Keynote: ' ELSE '' END || text AS title FROM documents)"""
)
def non_analytical_titles(spark, d):
    head = F.when(F.col("doc_id") % 4 == 0, "Closing  Remarks ").when(F.col("doc_id") % 4 == 1, "Sponsor Keynote: ").otherwise("")
    return t(spark, d, "documents").select("doc_id", text.non_analytical(F.concat(head, "text")).alias("skip"))


@query(
    "SELECT event_id, (floor(epoch(ts))::BIGINT % 86400)::DOUBLE AS secs, (floor(epoch(ts))::BIGINT % 86400) // 60 || ':' || lpad(((floor(epoch(ts))::BIGINT % 86400) % 60)::VARCHAR, 2, '0') AS shown FROM events"
)
def time_parse_format(spark, d):
    secs = time.clock(F.date_format("ts", "HH:mm:ss"))
    return t(spark, d, "events").select("event_id", secs.alias("secs"), time.minutes(secs).alias("shown"))


@query("SELECT event_id, ('0' || regexp_extract(props, '([0-9]+)', 1))::INTEGER AS k FROM events")
def json_extract(spark, d):
    wrapped = F.concat(F.lit("Here it is:\n```json\n"), "props", F.lit("\n```\nas asked"))
    parsed = F.from_json(text.json_text(wrapped), "map<string,int>")
    return t(spark, d, "events").select("event_id", F.map_values(parsed)[0].alias("k"))


@query(
    r"""WITH p AS (SELECT doc_id, regexp_replace(text, '[`{}\[\]]', '', 'g') AS x FROM documents)
SELECT doc_id, md5(CASE doc_id % 5 WHEN 1 THEN '{' || x || '}' WHEN 2 THEN '[' || x || ']' WHEN 4 THEN ''
  ELSE regexp_replace(x, '^\s+|\s+$', '', 'g') END) AS said FROM p WHERE x IS NOT NULL"""
)
def answer_texts(spark, d):
    """Texts as answers in a fence, in braces, in brackets, without JSON, and in no more than an empty fence."""
    x, k = F.regexp_replace("text", r"[`{}\[\]]", ""), F.col("doc_id") % 5
    put = lambda before, after: F.concat(F.lit(before), x, F.lit(after))
    answer = F.when(k == 0, put("So:\n```json\n", "\n``` {}")).when(k == 1, put("Sure [1]: {", "} [2]")).when(k == 2, put("List: [", "], as asked"))
    answer = answer.when(k == 3, put(" \n", "\n ")).otherwise(put("```\n```", ""))
    return t(spark, d, "documents").where("text is not null").select("doc_id", F.md5(text.answer_text(answer)).alias("said"))


# Joins -----------------------------------------------------------------------------------------------------------


@query()
def fuzzy_match(spark, d):
    left = t(spark, d, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("title"))
    right = t(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("title"))
    return matching.assign(matching.similar_pairs(left, right)).withColumn("score", F.round("score", 6))


def _best_sql(least: int, shared: int) -> str:
    return f"""WITH c AS (SELECT item_id, text AS txt, {_TOKENS.format("text")} AS mine FROM benchmark),
r AS (SELECT DISTINCT text AS title, {_TOKENS.format("text")} AS theirs FROM documents),
p AS (SELECT item_id, title, len(list_intersect(mine, theirs)) AS shared, len(list_intersect(mine, theirs)) / len(mine) AS score FROM c, r
  WHERE len(mine) >= {least}),
q AS (SELECT item_id, title, score FROM p WHERE score >= 0.5 AND shared >= {shared} UNION ALL SELECT item_id, title, 2.0 FROM c JOIN r ON txt = title)
SELECT item_id, title, round(least(1.0, score), 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, title) AS n FROM q)
  WHERE n = 1"""


def _best(spark, d, strict):
    """Items as candidates and whole documents as titles: a document that holds an item shares all of its tokens."""
    c = t(spark, d, "benchmark").select(F.col("item_id").alias("candidate_id"), "text")
    got = matching.best_titles(c, t(spark, d, "documents").select(F.col("text").alias("title")), strict)
    return got.select(F.col("candidate_id").alias("item_id"), "title", F.round("score", 6).alias("score"))


@query(_best_sql(2, 1))
def token_best_match(spark, d):
    return _best(spark, d, False)


@query(_best_sql(4, 3))
def token_best_match_strict(spark, d):
    return _best(spark, d, True)


@query(
    """WITH m AS (SELECT user_id, ts, event_id AS mark_id, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS until FROM events
      WHERE event_type = 'error')
SELECT e.event_id, m.mark_id FROM events e JOIN m ON e.user_id = m.user_id AND e.ts >= m.ts AND (m.until IS NULL OR e.ts < m.until)
  WHERE e.event_type <> 'error'"""
)
def interval_align(spark, d):
    e = t(spark, d, "events").select("user_id", "ts", "event_id", "event_type")
    marks = e.where("event_type = 'error'").select("user_id", "ts", F.col("event_id").alias("mark_id"))
    return alignment.backward_as_of(e.where("event_type <> 'error'"), marks, "user_id", "ts", "ts", ["mark_id"]).select("event_id", "mark_id")


@query(
    """WITH s AS (SELECT user_id, floor(epoch(ts))::BIGINT AS ts, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos
      FROM events WHERE event_type = 'error'),
a AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, pos) AS until FROM s),
g AS (SELECT a.user_id, a.pos, string_agg('[' || e.event_type || '] ' || e.event_id, chr(10) ORDER BY floor(epoch(e.ts))::BIGINT, e.event_id) AS said FROM a
  JOIN events e ON e.user_id = a.user_id AND e.event_type <> 'error' AND floor(epoch(e.ts))::BIGINT >= a.ts
  AND (a.until IS NULL OR floor(epoch(e.ts))::BIGINT < a.until) GROUP BY 1, 2),
b AS (SELECT a.user_id, a.ts, a.pos, '[SLIDE ' || (a.pos + 1) || ' at ' || (a.ts // 60) || 'm' || lpad((a.ts % 60)::VARCHAR, 2, '0') || 's]' || chr(10)
  || 'OCR: ' || a.event_id || coalesce(chr(10) || '[TRANSCRIPT]' || chr(10) || said, '') AS block FROM a LEFT JOIN g USING (user_id, pos))
SELECT user_id, string_agg(block, chr(10) || chr(10) ORDER BY ts, pos) AS aligned FROM b WHERE user_id IN (SELECT user_id FROM events
  WHERE event_type <> 'error') GROUP BY user_id"""
)
def align_text(spark, d):
    from pyspark.sql import Window

    e = t(spark, d, "events").withColumn("secs", time.epoch(F.col("ts")))
    nth = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    slides = e.where("event_type = 'error'").select(
        F.col("user_id").alias("video_id"),
        nth.alias("pos"),
        F.col("secs").alias("ts"),
        F.col("event_id").cast("string").alias("text"),
        F.lit("").alias("description"),
    )
    said = e.where("event_type <> 'error'").select(
        F.col("user_id").alias("video_id"),
        F.col("event_id").alias("seq"),
        F.col("secs").alias("start"),
        F.col("event_id").cast("string").alias("text"),
        F.col("event_type").alias("speaker"),
    )
    return alignment.aligned_text(slides, said).select(F.col("video_id").alias("user_id"), F.col("slide_aligned").alias("aligned"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def resume_anti(spark, d):
    return ordering.unprocessed(t(spark, d, "documents").select("doc_id"), t(spark, d, "labels"), "doc_id")


# Aggregates ------------------------------------------------------------------------------------------------------


@query("SELECT n_name AS company, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1")
def presence_counts(spark, d):
    slots = t(spark, d, "lineitem").select("l_suppkey").join(
        t(spark, d, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")
    )
    named = slots.join(F.broadcast(t(spark, d, "nation").select("n_nationkey", "n_name")), F.col("s_nationkey") == F.col("n_nationkey"))
    return aggregates.counts(named, text.company_of_affiliation(F.concat(F.lit("("), "n_name", F.lit(")"))), "company")


@query("SELECT source AS track, count(*) AS n FROM documents GROUP BY 1")
def track_distribution(spark, d):
    return aggregates.track_distribution(t(spark, d, "documents").withColumn("track", F.col("source")), "doc_id")


@query(
    f"""SELECT keyword, sum(w)::BIGINT AS weight FROM (SELECT unnest({_TOKENS.format("text")}) AS keyword, CASE WHEN lang = 'en' THEN 3 ELSE 1 END AS w
      FROM documents)
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15"""
)
def weighted_keywords(spark, d):
    words = t(spark, d, "documents").select("lang", F.explode(text.tokens("text")).alias("keyword"))
    return aggregates.weighted_keywords(words.where("lang = 'en'"), words.where("NOT lang <=> 'en'"))


@query(
    "SELECT n_name AS company, sum(c)::BIGINT AS n FROM (SELECT s_nationkey, count(*) AS c FROM supplier GROUP BY 1) JOIN nation ON s_nationkey = n_nationkey GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"
)
def recounted_companies(spark, d):
    c = t(spark, d, "supplier").groupBy("s_nationkey").agg(F.count("*").alias("n"))
    named = c.join(
        F.broadcast(t(spark, d, "nation")), F.col("s_nationkey") == F.col("n_nationkey")
    ).select(F.concat(F.lit("CTO, "), "n_name").alias("company"), "n")
    return aggregates.recount(named, "company", most=20)


@query(
    """SELECT 'c' || (user_id % 10) AS cluster, (user_id % 10) / 10.0::DOUBLE AS score, count(*) FILTER (event_type = 'view') AS production,
      count(*) FILTER (event_type = 'click') AS proof_of_concept,
  count(*) FILTER (event_type = 'error') AS theoretical, count(*) FILTER (event_type = 'signup') AS vendor_demo FROM events GROUP BY user_id % 10"""
)
def evidence_pivot(spark, d):
    kind = F.col("event_type")
    eq = F.when(kind == "view", "production").when(kind == "click", "proof_of_concept").when(kind == "error", "theoretical").when(kind == "signup", "vendor_demo")
    m = t(spark, d, "events").select(F.concat(F.lit("c"), (F.col("user_id") % 10).cast("string")).alias("cluster"), eq.alias("evidence_quality"))
    scores = spark.range(10).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("name"), (F.col("id") / 10).alias("relevance_score"))
    return aggregates.evidence_by_cluster(m, scores)


@query(
    """SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
  ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 4 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 2 WHEN '4-NOT SPECIFIED' THEN 1 ELSE 0 END DESC,
    o_orderkey) AS n FROM orders) WHERE n = 1"""
)
def best_evidence(spark, d):
    o = t(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("technology"), "o_custkey", "o_orderkey", "o_orderpriority")
    rank = aggregates.rank_of(F.col("o_orderpriority"), {"1-URGENT": 4, "2-HIGH": 3, "3-MEDIUM": 2, "4-NOT SPECIFIED": 1})
    return aggregates.best_evidence(o, "technology", rank, F.col("o_orderkey")).select("o_custkey", "o_orderkey", "o_orderpriority")


@query(
    """SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 'immediate' ELSE o_orderpriority END AS urgency, row_number() OVER (PARTITION BY o_orderpriority
      ORDER BY o_orderkey) AS place,
  o_orderkey::VARCHAR AS action FROM orders"""
)
def group_actions(spark, d):
    a = t(spark, d, "orders").select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("urgency"),
        F.col("o_orderkey").alias("pos"),
        F.col("o_orderkey").cast("string").alias("action"),
        F.lit("watch").alias("category"),
        F.lit("").alias("source_cluster"),
    )
    return aggregates.actions_in_order(a).select("urgency", "place", "action")


@query(
    "SELECT 'role' || n_nationkey AS role, count(*) AS talk_count FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15"
)
def stakeholder_top(spark, d):
    c = t(spark, d, "customer").join(F.broadcast(t(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return aggregates.stakeholders(c.groupBy(F.concat(F.lit("role"), F.col("n_nationkey").cast("string")).alias("role")).agg(F.count("*").alias("talk_count")))


@query("SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS full_text, max(turn) AS last_turn FROM conversations GROUP BY conv_id")
def full_text(spark, d):
    c = t(spark, d, "conversations")
    return c.groupBy("conv_id").agg(ordering.joined_text(F.col("text"), " ", F.col("turn")).alias("full_text"), F.max("turn").alias("last_turn"))


# Order-dependent -------------------------------------------------------------------------------------------------


@query(
    """WITH RECURSIVE o AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, count(*)
      OVER (PARTITION BY conv_id) AS n FROM conversations),
f AS (SELECT conv_id, i, n, text AS buf, turn::DOUBLE AS began, turn::DOUBLE AS last FROM o WHERE i = 1
  UNION ALL SELECT o.conv_id, o.i, o.n,
    CASE WHEN length(buf) >= 2000 THEN right(buf, 400) || ' ' || o.text ELSE buf || ' ' || o.text END,
    CASE WHEN length(buf) >= 2000 THEN last ELSE began END, o.turn::DOUBLE FROM f JOIN o ON o.conv_id = f.conv_id AND o.i = f.i + 1)
SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY i) - 1)::INTEGER AS chunk_index, began AS start_time, trim(buf,
  chr(32)||chr(10)||chr(9)||chr(13)) AS text FROM f WHERE length(buf) >= 2000 OR i = n"""
)
def transcript_chunks(spark, d):
    return chunks.windows(t(spark, d, "conversations"), "conv_id", "turn", "text", "turn")


@query(
    """SELECT user_id, (pos // 3)::INTEGER AS chunk_index, min(secs) AS start_time, string_agg(event_id::VARCHAR, chr(10) || chr(10) ORDER BY pos) AS text
FROM (SELECT user_id, event_id, event_type, floor(epoch(ts))::BIGINT AS secs, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos
  FROM events) WHERE event_type <> 'error' GROUP BY 1, 2"""
)
def slide_groups(spark, d):
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    e = t(spark, d, "events").withColumn("pos", nth).withColumn("secs", time.epoch(F.col("ts")))
    return chunks.slide_groups(e, "user_id", "pos", "secs", F.when(F.col("event_type") != "error", F.col("event_id").cast("string")))


@query("SELECT conv_id, turn, 'Speaker ' || dense_rank() OVER (PARTITION BY conv_id ORDER BY role) AS speaker FROM conversations")
def speaker_renumber(spark, d):
    return ordering.dense_labels(t(spark, d, "conversations"), "conv_id", "role").select("conv_id", "turn", "speaker")


# Retrieval -------------------------------------------------------------------------------------------------------

_DIST = "round(1 - list_cosine_similarity(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0)), 6)"


def _probe(spark, d) -> list[float]:
    return [float(x) for x in t(spark, d, "embeddings").where("vec_id = 0").select("embedding").first()[0]]


def _hits(spark, d, **kw):
    e = t(spark, d, "embeddings")
    return retrieval.nearest(kw.pop("rows", e), _probe(spark, d), kw.pop("k", 15), id_col="vec_id", digits=6)


@query(f"SELECT vec_id, {_DIST} AS distance FROM embeddings ORDER BY 2, 1 LIMIT 15")
def knn_cosine(spark, d):
    return _hits(spark, d).select("vec_id", "distance")


@query(f"SELECT vec_id, label, {_DIST} AS distance FROM embeddings WHERE label IN (1, 3) ORDER BY 3, 1 LIMIT 15")
def knn_filtered(spark, d):
    rows = retrieval.where_metadata(t(spark, d, "embeddings"), [1, 3], type_col="label")
    return _hits(spark, d, rows=rows).select("vec_id", "label", "distance")


@query(
    """WITH c AS (SELECT vec_id AS claim_id, embedding::DOUBLE[] AS q FROM embeddings WHERE vec_id % 20 = 0)
SELECT claim_id, nth, vec_id FROM (SELECT claim_id, vec_id, row_number() OVER (PARTITION BY claim_id ORDER BY 1 - list_cosine_similarity(embedding::DOUBLE[],
  q), vec_id)::INTEGER AS nth FROM embeddings, c) WHERE nth <= 8"""
)
def knn_join(spark, d):
    e = t(spark, d, "embeddings")
    claims = e.where("vec_id % 20 = 0").select(F.col("vec_id").alias("claim_id"), F.col("embedding").alias("claim_embedding"))
    return retrieval.nearest_each(claims, e.select("vec_id", "embedding"), 8, id_col="vec_id").select("claim_id", "nth", "vec_id")


@query(
    f"""WITH h AS (SELECT vec_id, label, {_DIST} AS distance FROM embeddings ORDER BY 3, 1 LIMIT 15),
n AS (SELECT *, row_number() OVER (ORDER BY distance, 'v:' || vec_id) AS n FROM h)
SELECT count(*) AS hits, string_agg('[' || n || '] | type=v | talk=talk ' || label || CASE WHEN vec_id <> 0 THEN ' | time=' || (vec_id // 60) || ':'
  || lpad((vec_id % 60)::VARCHAR, 2, '0') ELSE '' END || chr(10) || 'text ' || vec_id, chr(10) || chr(10) || '---' || chr(10) || chr(10)
  ORDER BY n) AS context FROM n"""
)
def context_string(spark, d):
    h = _hits(spark, d)
    v = F.col("vec_id").cast("string")
    h = h.select(
        "distance",
        F.concat(F.lit("v:"), v).alias("id"),
        F.concat(F.lit("talk "), F.col("label").cast("string")).alias("talk_title"),
        F.lit("").alias("track"),
        F.col("vec_id").cast("double").alias("start_time"),
        v.alias("video_id"),
        F.concat(F.lit("text "), v).alias("text"),
    )
    return retrieval.context(h)


@query(
    """WITH u AS (SELECT 'talk_abstract:talk-' || doc_id || '-' || left(md5('talk ' || doc_id), 8) || ':0' AS id, 'talk ' || doc_id || chr(10) || chr(10)
      || trim(text) AS text, 'talk_abstract' AS chunk_type, 1 AS k, doc_id AS pos FROM documents WHERE trim(text) <> ''
  UNION ALL SELECT 'talk_summary:talk-' || doc_id || '-' || left(md5('talk ' || doc_id), 8) || ':0', 'talk ' || doc_id || chr(10) || chr(10) || text,
    'talk_summary', 2, doc_id FROM documents WHERE lang = 'en')
SELECT id, text, chunk_type FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY k, pos, text) AS n FROM u) WHERE n = 1"""
)
def chunk_union(spark, d):
    docs = t(spark, d, "documents")
    none = F.array().cast("array<string>")
    title = F.concat(F.lit("talk "), F.col("doc_id").cast("string")).alias("title")
    s = docs.select(
        title,
        F.col("text").alias("abstract"),
        F.array().cast(sessions.SPEAKERS).alias("speakers"),
        F.col("source").alias("track"),
        F.col("doc_id").alias("_pos"),
    )
    a = docs.select(
        title,
        F.when(F.col("lang") == "en", F.col("text")).otherwise("").alias("summary"),
        *(none.alias(c) for c in ("key_takeaways", "qa_highlights", "problems_discussed", "tools_and_projects", "emerging_signals")),
        F.col("doc_id").alias("_pos"),
    )
    return chunks.union_chunks(chunks.abstract_chunks(s), chunks.talk_chunks(a)).select("id", "text", "chunk_type")


@query("SELECT lang AS chunk_type, count(*) AS n FROM documents GROUP BY 1")
def chunk_counts(spark, d):
    return chunks.chunk_counts(t(spark, d, "documents").select(F.col("lang").alias("chunk_type")))


# Reports ---------------------------------------------------------------------------------------------------------


@query(
    """WITH r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS j FROM orders),
w AS (SELECT o_custkey AS i, j, CASE WHEN o_orderkey % 7 < 4 THEN 'seg ' ELSE 'lost ' END || (o_orderkey % 7) || ' of ' || o_custkey AS wanted FROM r
  WHERE j <= 3),
k AS (SELECT *, row_number() OVER (PARTITION BY wanted ORDER BY i, j) AS n FROM w),
titles AS (SELECT DISTINCT 'seg ' || (o_orderkey % 7) || ' of ' || o_custkey AS title FROM orders)
SELECT wanted AS title, 'cluster ' || i AS cluster FROM k JOIN titles ON title = wanted WHERE n = 1"""
)
def appendix(spark, d):
    from pyspark.sql import Window

    o = t(spark, d, "orders")
    rest = F.concat((F.col("o_orderkey") % 7).cast("string"), F.lit(" of "), F.col("o_custkey").cast("string"))
    wanted = F.concat(F.when(F.col("o_orderkey") % 7 < 4, "seg ").otherwise("lost "), rest)
    best = o.withColumn("j", F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey"))).where("j <= 3")
    ranking = best.groupBy("o_custkey").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("j", wanted.alias("w")))), lambda x: x["w"]).alias("recommended_talks")
    )
    ranking = ranking.select(
        F.col("o_custkey").alias("rank"),
        F.concat(F.lit("cluster "), F.col("o_custkey").cast("string")).alias("name"),
        "recommended_talks",
    )
    none = F.array().cast("array<string>")
    talks = o.select(
        F.concat(F.lit("seg "), rest).alias("title"),
        F.col("o_orderkey").alias("_pos"),
        F.lit("s").alias("summary"),
        none.alias("key_takeaways"),
        F.lit("").alias("evidence_quality"),
        F.lit("").alias("speaker_perspective"),
        none.alias("tools_and_projects"),
    )
    return reports.appendix(talks, ranking, ranking.limit(0)).select("title", "cluster")


@query(
    "SELECT p_name AS name, p_retailprice / 10000 AS relevance_score, CASE WHEN p_retailprice / 10000 >= 0.7 THEN 'cluster_deep_dive' WHEN p_retailprice / 10000 >= 0.4 THEN 'cluster_brief' END AS tier FROM part"
)
def cluster_relevance(spark, d):
    return reports.cluster_relevance(t(spark, d, "part").select(F.col("p_name").alias("name"), (F.col("p_retailprice") / 10000).alias("relevance_score")))


@query("SELECT conv_id, turn, length(text) < 2500 AND role = 'user' AS thin FROM conversations")
def thin_briefs(spark, d):
    s = t(spark, d, "conversations").select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "user", "cluster_brief").otherwise("landscape").alias("section_type"),
        F.col("text").alias("prose"),
    )
    return s.select("conv_id", "turn", reports.thin_briefs(s).alias("thin"))


@query("SELECT p_partkey, (round_even(p_retailprice * 100 / 10000, 0))::BIGINT || '%' AS shown FROM part")
def percent_format(spark, d):
    return t(spark, d, "part").select("p_partkey", time.percent(F.col("p_retailprice") / 10000).alias("shown"))


# The rest of the scalar and small operators ----------------------------------------------------------------------


@query(
    """WITH l AS (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS n FROM customer)
SELECT o_orderkey, coalesce(c_name, '') AS found FROM orders LEFT JOIN l ON n = 1 AND c_mktsegment = CASE o_orderkey % 3 WHEN 0 THEN 'BUILDING'
  WHEN 1 THEN 'MACHINERY' ELSE 'none' END"""
)
def find_by_name(spark, d):
    first = ordering.keep_first(t(spark, d, "customer"), F.col("c_mktsegment"), F.col("c_custkey")).select("c_mktsegment", "c_name")
    k = F.col("o_orderkey") % 3
    asked = t(spark, d, "orders").select("o_orderkey", F.when(k == 0, "BUILDING").when(k == 1, "MACHINERY").otherwise("none").alias("c_mktsegment"))
    return asked.join(first, "c_mktsegment", "left").select("o_orderkey", F.coalesce("c_name", F.lit("")).alias("found"))


@query(
    """WITH m AS (SELECT DISTINCT source AS cluster, 'talk ' || doc_id AS title, '{"lang":"' || lang || '","n_chars":' || n_chars || '}' AS j FROM documents
  WHERE source IS NOT NULL),
s AS (SELECT cluster, title, j, coalesce(sum(length(j) + 1) OVER (PARTITION BY cluster ORDER BY title ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
  // 300 AS part FROM m)
SELECT cluster, part::BIGINT AS part, '[' || string_agg(j, ',' ORDER BY title) || ']' AS payload FROM s GROUP BY cluster, part"""
)
def payload_parts(spark, d):
    m = t(spark, d, "documents").select(
        F.col("source").alias("cluster"), F.concat(F.lit("talk "), F.col("doc_id").cast("string")).alias("title"), "lang", "n_chars"
    )
    return aggregates.payload_parts(m.select("cluster", "title"), m.select("title", "lang", "n_chars"), ["lang", "n_chars"], 300)


@query(
    """WITH m AS (SELECT DISTINCT source AS cluster, 'talk ' || doc_id AS title, lang, n_chars FROM documents)
SELECT cluster, md5('[' || string_agg('{"lang":"' || lang || '","n_chars":' || n_chars || '}', ',' ORDER BY title) || ']') AS payload FROM m GROUP BY 1"""
)
def cluster_payloads(spark, d):
    m = t(spark, d, "documents").select(
        F.col("source").alias("cluster"), F.concat(F.lit("talk "), F.col("doc_id").cast("string")).alias("title"), "lang", "n_chars"
    )
    got = aggregates.cluster_payloads(m.select("cluster", "title"), m.select("title", "lang", "n_chars"), ["lang", "n_chars"])
    return got.select("cluster", F.md5("payload").alias("payload"))


@query(
    "SELECT conv_id, least(3, count(*) FILTER (role = 'user'))::INTEGER AS n_quotes, string_agg(turn::VARCHAR, ',' ORDER BY turn) FILTER (role = 'user' AND k <= 3) AS turns FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS k FROM conversations) GROUP BY conv_id HAVING count(*) FILTER (role = 'user') > 0"
)
def quotes_to_find(spark, d):
    c = t(spark, d, "conversations").select(
        "conv_id",
        "turn",
        F.struct(F.col("turn").cast("string").alias("talk_title"), F.lit("c").alias("claim"), (F.col("role") == "user").alias("needs_quote")).alias("c"),
    )
    s = c.groupBy("conv_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("turn", "c"))), lambda r: r["c"]).alias("citations")
    ).withColumn("section_type", F.lit("cluster_deep_dive"))
    deep, _ = reports.enrichment_split(s)
    return deep.select("conv_id", F.size("to_quote").alias("n_quotes"), F.array_join(F.transform("to_quote", lambda q: q["talk_title"]), ",").alias("turns"))


@query(
    "SELECT r.role, r.place, n_nationkey FROM nation, (VALUES ('Platform Engineers', 3), ('SREs & Operations', 3)) AS r(role, place) WHERE n_nationkey < 5 UNION ALL SELECT 'Security Leads', 2, n_nationkey FROM nation WHERE n_nationkey >= 20"
)
def reading_guide(spark, d):
    key = F.when(F.col("n_nationkey") < 5, "all_actions").when(F.col("n_nationkey") >= 20, "tensions").otherwise("none")
    s = t(spark, d, "nation").select(
        F.concat(key, F.lit("_"), F.col("n_nationkey").cast("string")).alias("section_id"),
        F.col("n_nationkey").cast("string").alias("title"),
    )
    return reports.reading_guide(spark, s).select("role", "place", F.col("title").cast("int").alias("n_nationkey"))


@query(
    """SELECT conv_id, string_agg(CASE WHEN role = 'user' THEN role || ' (' || 'c' || turn || ')' ELSE role END, ', ' ORDER BY turn) AS speakers,
  coalesce(array_to_string(list_sort(list_distinct(list('c' || turn) FILTER (role = 'user'))), ', '), '') AS companies FROM conversations GROUP BY 1"""
)
def speaker_texts(spark, d):
    who = F.struct(
        F.col("role").alias("name"),
        F.when(F.col("role") == "user", F.concat(F.lit("c"), F.col("turn").cast("string"))).otherwise("").alias("company"),
    )
    s = t(spark, d, "conversations").groupBy("conv_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("turn", who.alias("w")))), lambda r: r["w"]).alias("speakers")
    )
    return s.select("conv_id", text.speakers_text("speakers").alias("speakers"), text.companies_text("speakers").alias("companies"))


@query("SELECT count(*) AS n, count(*) FILTER (event_type = 'error') AS failed, 2 * count(*) FILTER (event_type = 'error') > count(*) AS warn FROM events")
def failure_share(spark, d):
    return aggregates.failure_share(t(spark, d, "events").select(F.when(F.col("event_type") == "error", F.col("event_type")).alias("error")))


@query(
    """WITH m AS (SELECT p_brand AS technology, CASE p_size % 4 WHEN 0 THEN 'case_study' WHEN 1 THEN 'benchmarked' WHEN 2 THEN 'anecdotal'
      ELSE 'odd' END AS evidence_quality, p_partkey, p_type AS ring FROM part)
SELECT technology, ring, evidence_quality FROM (SELECT *, row_number() OVER (PARTITION BY technology ORDER BY CASE evidence_quality WHEN 'benchmarked' THEN 3
  WHEN 'case_study' THEN 2 WHEN 'anecdotal' THEN 1 ELSE 0 END DESC, p_partkey) AS n FROM m) WHERE n = 1"""
)
def maturity_best(spark, d):
    k = F.col("p_size") % 4
    eq = F.when(k == 0, "case_study").when(k == 1, "benchmarked").when(k == 2, "anecdotal").otherwise("odd")
    m = t(spark, d, "part").select(
        F.col("p_brand").alias("technology"), eq.alias("evidence_quality"), F.col("p_partkey").alias("pos"), F.col("p_type").alias("ring")
    )
    return aggregates.best_evidence(m).select("technology", "ring", "evidence_quality")


@query("SELECT event_id, (floor(epoch(ts))::BIGINT % 86400) + 0.25::DOUBLE AS secs FROM events")
def stamps(spark, d):
    return t(spark, d, "events").select("event_id", time.stamp(F.concat(F.date_format("ts", "HH:mm:ss"), F.lit(",250"))).alias("secs"))


@query(
    "SELECT user_id, event_id AS last_event FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1"
)
def last_wins(spark, d):
    e = t(spark, d, "events").withColumn("k", F.col("user_id").cast("string"))
    return ordering.keep_last(e, F.col("k"), F.col("ts"), F.col("event_id")).select("user_id", F.col("event_id").alias("last_event"))


@query(r"SELECT c_custkey, regexp_full_match(left(md5(c_name), 10 + (c_custkey % 2)::INTEGER), '[a-zA-Z0-9_-]{11}') AS valid FROM customer")
def valid_video_ids(spark, d):
    v = F.substring(F.md5("c_name"), F.lit(1), (10 + F.col("c_custkey") % 2).cast("int"))
    return t(spark, d, "customer").select("c_custkey", text.valid_video_id(v).alias("valid"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE NOT (o_totalprice > 0 AND o_totalprice < 100000)")
def short_recordings(spark, d):
    o = t(spark, d, "orders")
    talks = o.select(
        "o_orderkey",
        "o_custkey",
        F.lit("A talk").alias("title"),
        F.lit("t" * 100).alias("transcript"),
        F.col("o_totalprice").alias("duration_sec"),
    )
    return sessions.sections_of_interest(talks, 100000.0).select("o_orderkey", "o_custkey")


@query(
    "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 't' || o_custkey || chr(10) || chr(10) || '[SLIDE-ALIGNED CONTENT]' || chr(10) || 'a' ELSE 't' || o_custkey || chr(10) || chr(10) || '[SLIDE CONTENT]' || chr(10) || 's' || chr(10) || chr(10) || '[SLIDE REFERENCES]' || chr(10) || 'u' || chr(10) || 'v' END AS prompt FROM orders"
)
def prompt_texts(spark, d):
    o = t(spark, d, "orders").select(
        "o_orderkey",
        F.concat(F.lit("t"), F.col("o_custkey").cast("string")).alias("transcript"),
        F.when(F.col("o_orderkey") % 2 == 0, "a").otherwise("").alias("slide_aligned"),
        F.lit("s").alias("slide_text"),
        F.array(F.lit("u"), F.lit("v")).alias("slide_references"),
    )
    return o.select("o_orderkey", sessions.prompt_text().alias("prompt"))


@query()
def scrub_speakers(spark, d):
    prose = F.concat("text", F.lit(" A tool presented by Max Muster, engineer at X and by Anna Meier."))
    return t(spark, d, "conversations").select("conv_id", "turn", grounding.scrub_speakers(prose, F.array(F.lit("anna meier"), F.lit("meier"))).alias("prose"))


@query()
def reconcile_titles(spark, d):
    titles = t(spark, d, "benchmark").select(F.col("text").alias("title"))
    s = t(spark, d, "documents").select("doc_id", F.concat(F.lit("See **"), F.regexp_replace("text", r"[*\n]", " "), F.lit("** now")).alias("prose"))
    asked = s.select(
        F.col("doc_id").alias("id"), F.explode(grounding.title_candidates("prose")).alias("text")
    ).select(F.struct("id", "text").alias("candidate_id"), "text")
    real = matching.best_titles(asked, titles, strict=True).select(
        F.col("candidate_id.id").alias("doc_id"), F.struct(F.col("candidate_id.text").alias("k"), "title").alias("x")
    )
    swaps = real.groupBy("doc_id").agg(F.map_from_entries(F.collect_set("x")).alias("swaps"))
    return s.join(swaps, "doc_id", "left").select("doc_id", grounding.put_titles("prose", F.col("swaps")).alias("prose"))


