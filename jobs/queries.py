"""The jobs as queries over whole tables, each run twice into one new folder, and SQL of equal rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from jobs import chunk_store, keyword_board
from talkloom.sources.artifacts import shared_folder


def job1_chunk_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    output = shared_folder(spark)
    for _ in range(2):
        chunk_store.run(spark, f"{sf_dir}/documents.parquet", f"{sf_dir}/conversations.parquet", output)
    return chunk_store.read(spark, output)


def job2_keyword_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    output, checkpoint = shared_folder(spark), shared_folder(spark)
    for _ in range(2):
        keyword_board.run(spark, f"{sf_dir}/documents.parquet", output, checkpoint)
    return keyword_board.read(spark, output)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (job1_chunk_store, job2_keyword_board)}

_SPACE = "chr(32)||chr(9)||chr(10)||chr(13)"

ORACLE_SQL: dict[str, str] = {
    "job1_chunk_store": f"""
WITH RECURSIVE l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS place FROM documents),
s AS (SELECT DISTINCT * FROM (
  SELECT 'talk_text' AS chunk_type, doc_id::VARCHAR AS talk, place::BIGINT AS place, trim(line, {_SPACE}) AS text FROM l WHERE doc_id IS NOT NULL
  UNION ALL SELECT 'transcript_segment', conv_id::VARCHAR, turn, trim(text, {_SPACE}) FROM conversations WHERE conv_id IS NOT NULL) WHERE text <> ''),
o AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY chunk_type, talk) AS n FROM s WINDOW w AS (PARTITION BY chunk_type, talk ORDER BY place, text)),
f AS (SELECT chunk_type, talk, i, n, text AS buf, place::DOUBLE AS began, place::DOUBLE AS last FROM o WHERE i = 1
  UNION ALL SELECT o.chunk_type, o.talk, o.i, o.n, CASE WHEN length(buf) >= 2000 THEN right(buf, 400) || ' ' || o.text ELSE buf || ' ' || o.text END,
    CASE WHEN length(buf) >= 2000 THEN last ELSE began END, o.place::DOUBLE FROM f JOIN o ON o.chunk_type = f.chunk_type AND o.talk = f.talk AND o.i = f.i + 1),
c AS (SELECT chunk_type, talk, (row_number() OVER (PARTITION BY chunk_type, talk ORDER BY i) - 1)::INTEGER AS chunk_index, began AS start_time,
  trim(buf, {_SPACE}) AS text FROM f WHERE length(buf) >= 2000 OR i = n),
t AS (SELECT doc_id::VARCHAR AS talk, min(source) AS track FROM documents GROUP BY 1)
SELECT chunk_type || ':' || c.talk || ':' || chunk_index AS id, c.talk, chunk_index, start_time, text, chunk_type,
  CASE WHEN chunk_type = 'talk_text' THEN track END AS track FROM c LEFT JOIN t ON c.talk = t.talk""",
    "job2_keyword_board": """
WITH k AS (SELECT source AS track, unnest(list_distinct(list_filter(regexp_extract_all(lower(text), '[a-z0-9]+'), lambda x: length(x) > 2))) AS keyword FROM documents),
s AS (SELECT track, keyword, count(*) AS talks FROM k GROUP BY 1, 2 HAVING count(*) >= 2),
r AS (SELECT *, row_number() OVER (PARTITION BY track ORDER BY talks DESC, keyword)::INTEGER AS rank FROM s),
n AS (SELECT source AS track, count(*) AS of_talks FROM documents GROUP BY 1)
SELECT keyword, talks, of_talks, round(100 * talks / of_talks, 2) AS percent, rank, r.track
FROM r JOIN n ON r.track IS NOT DISTINCT FROM n.track WHERE rank <= 50""",
}
