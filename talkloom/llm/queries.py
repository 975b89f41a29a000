"""The queries of this subpackage's operators over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.llm import count_tree, host_rules, html_text, language, line_dedup, metric_tree, mixing, packing, quality_model, simhash, tiered_index, url_rules
from talkloom.llm.common import table


def _remainder(column: str, n: int) -> Column:
    """crc32 of the number as text, modulo n; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_host_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *host_rules.METRICS, "base_failed", "kept")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    labelled = url_rules.page_labels(pages, table(spark, sf_dir, "labels"))
    return url_rules.judge(pages, labelled).select("page_id", "host", "path", "rule", "verdict")


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_tree.top_k(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % metric_tree.QUERY_EVERY == 0)


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.sha2("text", 256).alias("kept_sha256"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_model.fit(docs, table(spark, sf_dir, "labels"), _remainder("doc_id", 5) != 0)
    scored = quality_model.score(docs, model)
    held_out = F.coalesce(_remainder("doc_id", 5) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= quality_model.THRESHOLD).cast("int").alias("predicted"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs, _remainder("doc_id", 4) != 2)
    held_out = F.coalesce(_remainder("doc_id", 4) == 2, F.lit(False))
    return language.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark")
    return tiered_index.search(tiered_index.build(table(spark, sf_dir, "documents"), tiered_index.item_terms(items)), items)


def op12_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tree.similar_sets(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_host_quality_rules,
        op3_simhash_near_dedup,
        op4_url_filters,
        op5_exact_top_k,
        op6_source_mixing,
        op7_line_dedup,
        op8_quality_classifier,
        op9_language_id,
        op10_html_extraction,
        op11_ranked_lexical_search,
        op12_ngram_jaccard_join,
    )
}

_WORD = r"[^\x20\x09-\x0D]+"
_SPACE = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"

def _host_sql() -> str:
    """The part of op2's SQL that is alike for each rule: failures by host, priors, shrunk rates, verdicts."""
    rules = {"base": "base_failed"} | host_rules.RULES
    usual, least, most = host_rules.STRENGTH
    floor, times, ceiling = host_rules.REFUSED_FROM
    failures = ", ".join(f"count(*) FILTER ({rule}) AS {name}" for name, rule in rules.items())
    moments = ", ".join(f"avg({x} / n) AS m_{x}, var_samp({x} / n) AS v_{x}" for x in rules)
    strength = ", ".join(
        f"m_{x}, least({most}, greatest({least}, CASE WHEN k > 1 AND v_{x} > 0 THEN m_{x} * (1 - m_{x}) / v_{x} - 1 ELSE {usual} END)) AS s_{x}"
        for x in rules
    )
    shrunk = ", ".join(f"({x} + m_{x} * s_{x}) / (n + s_{x}) AS rate_{x}, m_{x}" for x in rules)
    broken = " OR ".join(f"(({rule}) AND rate_{x} > {host_rules.STRICT_FROM} * m_{x})" for x, rule in host_rules.RULES.items())
    return f"""h AS (SELECT source, count(*) AS n, {failures} FROM f WHERE source IS NOT NULL GROUP BY source),
p AS (SELECT count(*) AS k, {moments} FROM h),
s AS (SELECT {strength} FROM p),
q AS (SELECT source, {shrunk} FROM h, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(rate_base < greatest({floor}, least({ceiling}, {times} * m_base)), true) AND NOT coalesce({broken}, false) AS kept
FROM f LEFT JOIN q USING (source)"""


def _url_sql() -> str:
    """op4 in SQL: tokens, their counts, sets of up to LONGEST tokens by joins of a URL's tokens with themselves, verdicts."""
    bound = "(({k} / {n}) + {z2} / (2 * {n}) - {z} * sqrt(({k} / {n}) * (1 - ({k} / {n})) / {n} + {z2} / (4 * {n} * {n}))) / (1 + {z2} / {n})"
    wilson = lambda k, n: bound.format(k=k, n=n, z=url_rules.Z, z2=url_rules.Z * url_rules.Z)
    fits = sorted(url_rules.RULES, key=lambda r: -len(r[1] + r[2]))
    explicit = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{v} {h}{p}'" for v, h, p in fits)
    sets = []
    for size in range(1, url_rules.LONGEST + 1):
        names = [f"i{j}" for j in range(size)]
        joins = " ".join(f"JOIN i {b} ON {b}.r = {a}.r AND {b}.token > {a}.token" for a, b in zip(names, names[1:]))
        needed = ", ".join(f"{x}.token" for x in names)
        sets.append(f"SELECT [{needed}] AS needed FROM i i0 {joins} GROUP BY {needed} HAVING count(*) >= (SELECT least_rows FROM b)")
    listed = lambda prefix, parts: f"list_transform(list_filter({parts}, lambda x: x <> ''), lambda x: '{prefix}=' || x)"
    words = "list_filter(regexp_split_to_array(lower(path), '[/._-]+'), lambda x: NOT regexp_matches(x, '[0-9]'))"
    query = r"string_split(lower(regexp_extract(coalesce(url, ''), '\?([^#]*)', 1)), '&')"
    fragment = "lower(regexp_extract(coalesce(url, ''), '#(.*)$', 1))"
    return rf"""WITH u AS (SELECT row_number() OVER () AS r, page_id, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
h AS (SELECT r, page_id, url, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{line_dedup.UPPER}', '{line_dedup.LOWER}'), '') AS host,
  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
t AS (SELECT *, list_distinct(['host=' || host] || {listed("h", "string_split(host, '.')")} || {listed("p", words)} || {listed("q", query)}
  || {listed("f", f"[{fragment}]")}) AS tokens FROM h),
g AS (SELECT doc_id, avg(coalesce(quality = 0 OR toxic = 1, quality = 0, toxic = 1)::INTEGER) AS poor FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
l AS (SELECT r, tokens, poor >= 0.5 AS blocked FROM t JOIN g ON doc_id = try_cast(regexp_extract(path, '([0-9]{{1,18}})(?:\.[A-Za-z]+)?/?$', 1) AS BIGINT) WHERE poor IS NOT NULL),
b AS (SELECT greatest({url_rules.LEAST_ROWS}, ceil({url_rules.SUPPORT} * count(*)))::BIGINT AS least_rows FROM l),
k AS (SELECT token, count(*) AS n, count(*) FILTER (blocked) AS hits FROM (SELECT unnest(tokens) AS token, blocked FROM l) GROUP BY 1),
j AS (SELECT r, token, row_number() OVER (PARTITION BY r ORDER BY {wilson("hits", "n")} DESC, token) AS nth
  FROM (SELECT r, unnest(tokens) AS token FROM l WHERE blocked) JOIN k USING (token) WHERE hits >= (SELECT least_rows FROM b)),
i AS (SELECT r, token FROM j WHERE nth <= {url_rules.MINED}),
s AS ({" UNION ALL ".join(sets)}),
c AS (SELECT needed, count(*) AS n, count(*) FILTER (blocked) AS hits FROM s JOIN l ON list_has_all(tokens, needed) GROUP BY 1),
m AS (SELECT needed FROM c WHERE hits >= (SELECT least_rows FROM b) AND {wilson("hits", "n")} >= {url_rules.CONFIDENCE}),
x AS (SELECT *, CASE {explicit} END AS fit FROM t)
SELECT page_id, host, path, split_part(fit, ' ', 2) AS rule,
  coalesce(split_part(fit, ' ', 1), CASE WHEN EXISTS (SELECT 1 FROM m WHERE list_has_all(x.tokens, needed)) THEN 'block' ELSE 'allow' END) AS verdict FROM x"""


_HOST_SQL = _host_sql()
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWERED = f"translate(coalesce(text, ''), '{line_dedup.UPPER}', '{line_dedup.LOWER}')"

ORACLE_SQL: dict[str, str] = {
    "op2_host_quality_rules": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, unnest(regexp_extract_all(text, '{_WORD}')) AS word, generate_subscripts(regexp_extract_all(text, '{_WORD}'), 1) AS i FROM d),
x AS (SELECT r, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o AS win, length(word) AS chars FROM w WINDOW o AS (PARTITION BY r
  ORDER BY i)),
y AS (SELECT r, i, chars, win IS NOT NULL AND count(*) OVER (PARTITION BY r, win) > 1 AS again FROM x),
z AS (SELECT r, chars, again OR coalesce(lag(again, 1) OVER o, false) OR coalesce(lag(again, 2) OVER o, false) AS covered FROM y WINDOW o AS (PARTITION BY r
  ORDER BY i)),
m AS (SELECT r, count(*) AS n_words, sum(chars)::BIGINT AS word_chars, count(*) FILTER (covered) AS n_repeat_words FROM z GROUP BY r),
l AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line,
  '{_WORD}') GROUP BY r),
b AS (SELECT d.r, doc_id, source, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words,
    0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN m USING (r) LEFT JOIN l USING (r)),
f AS (SELECT *, n_words < {host_rules.LEAST_WORDS} OR 100 * n_repeat_words > {host_rules.MOST_REPEATED} * n_words AS base_failed FROM b),
{_HOST_SQL}""",
    "op4_url_filters": _url_sql(),
    "op5_exact_top_k": f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({metric_tree.SCALE} * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score FROM v q, v c WHERE q.vec_id % {metric_tree.QUERY_EVERY} = 0
  AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {metric_tree.K}""",
    "op6_source_mixing": rf"""
WITH q AS (SELECT doc_id, avg(quality) AS q FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size, md5(coalesce(text, '')) AS text_key,
  coalesce({mixing.QUALITY[1]} + ({mixing.QUALITY[0]} - {mixing.QUALITY[1]}) * q, {mixing.QUALITY[2]}) AS w FROM documents LEFT JOIN q USING (doc_id)),
k AS (SELECT *, round(-ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || text_key), 1, 12))::BIGINT + 0.5::DOUBLE) / {1 << 48}::DOUBLE) / w,
  12) AS key FROM d),
g AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
o AS (SELECT *, [{", ".join(f"{x}::DOUBLE" for x in mixing.WEIGHTS)}][(row_number()
  OVER (ORDER BY encode(source) NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1] AS w FROM g),
c AS (SELECT *, source_size * {float(mixing.MOST_EPOCHS)} AS cap, cap / w AS full_at FROM o),
l AS (SELECT *, ({mixing.BUDGET} * sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level FROM c
  WINDOW b AS (ORDER BY full_at, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, round(least(cap, coalesce(max(CASE WHEN level <= full_at THEN level END) OVER () * w, cap)), 6) AS target FROM l),
e AS (SELECT k.*, source_size, target, floor(target)::BIGINT AS goal, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs,
  coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id NULLS LAST, text_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    0)::BIGINT AS before
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, goal - epochs * source_size - before)))::BIGINT AS taken FROM e""",
    "op7_line_dedup": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
u AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, {_SPACE}), '{line_dedup.UPPER}', '{line_dedup.LOWER}') AS key FROM u),
s AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= {line_dedup.LEAST_CHARS} AND doc_id IS NOT NULL
  GROUP BY key HAVING count(DISTINCT doc_id) >= {line_dedup.LEAST_DOCS}),
m AS (SELECT k.*, coalesce(doc_id <> last, false) AS goes FROM k LEFT JOIN s USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (goes) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT goes), '')) AS kept_sha256 FROM m GROUP BY r""",
    "op11_ranked_lexical_search": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, '{_TERM}') AS words FROM documents),
s AS (SELECT r, doc_id, len(words)::BIGINT AS n, words FROM d WHERE len(words) > 0),
c AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM s),
p AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(words) AS term FROM s) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM p, c GROUP BY term, n_docs),
i AS (SELECT i, item_id, unnest(list_distinct(regexp_extract_all({_LOWERED}, '{_TERM}'))) AS term
  FROM (SELECT row_number() OVER () AS i, * FROM benchmark)),
x AS (SELECT i, item_id, r, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM i JOIN w USING (term) JOIN p USING (term) JOIN s USING (r), c GROUP BY i, item_id, r),
k AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM x JOIN s USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 50""",
}
