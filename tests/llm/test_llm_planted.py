"""Ten thousand rows in which hosts differ and URLs tell: verdicts of the learned part, and the same from SQL.

The hosts of the given tables are alike and their URLs have nothing to do with their labels, so that the base rules decide there.
"""

import duckdb
import pytest
from pyspark.sql import functions as F

from talkloom.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import canonical

N = 10_000


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Forty hosts of 250 documents. Of host 0 four in ten texts hold many symbols, of the others one in a hundred. Host 1 has a third
    too short to pass. Half of the pages under /win/ with a bonus in the query are labelled bad, hardly any others."""
    path = tmp_path_factory.mktemp("planted")
    rows = spark.range(N).withColumnRenamed("id", "doc_id").withColumn("host", F.col("doc_id") % 40).withColumn("nth", F.floor(F.col("doc_id") / 40))
    symbols = F.when(F.col("host") == 0, F.col("nth") % 10 < 4).otherwise(F.col("nth") % 100 == 7)
    short = (F.col("host") == 1) & (F.col("nth") % 3 == 0)
    word = lambda i: F.concat(F.lit("word"), (F.col("doc_id") * 131 + i * 7919).cast("string"))
    text = F.concat_ws(" ", *(word(i) for i in range(60)))
    text = F.when(short, F.lit("too short")).when(symbols, F.concat(text, F.lit(" #" * 9))).otherwise(text)
    docs = rows.select("doc_id", text.alias("text"), F.lit("en").alias("lang"), F.concat(F.lit("src"), "host").alias("source"), F.length(text).cast("long").alias("n_chars"))
    docs.coalesce(1).write.parquet(str(path / "documents.parquet"))
    bad_place = (F.col("doc_id") % 25 == 3)
    url = F.concat(
        F.lit("https://site"), (F.col("doc_id") % 90).cast("string"), F.lit(".example.info/"), F.when(bad_place, "win").otherwise("read"),
        F.lit("/"), F.col("doc_id").cast("string"), F.when(bad_place | (F.col("doc_id") % 50 == 1), "?bonus=now").otherwise("?page=one"),
    )
    rows.select(F.col("doc_id").alias("page_id"), url.alias("url"), F.lit("").alias("html")).coalesce(1).write.parquet(str(path / "pages.parquet"))
    labelled = rows.where("doc_id * 7919 % 1000 < 500 or doc_id % 25 = 3")
    quality = F.when(bad_place & (F.col("doc_id") % 200 != 3), 0).otherwise(F.when(F.col("doc_id") % 97 == 0, 0).otherwise(1))
    labelled.select("doc_id", quality.alias("quality"), F.lit(0).alias("toxic")).coalesce(1).write.parquet(str(path / "labels.parquet"))
    return str(path)


def both(spark, path, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "labels"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{path}/{table}.parquet/*.parquet'")
    got, want = QUERIES[name](spark, path), con.sql(ORACLE_SQL[name])
    rows = [r.asDict() for r in got.collect()]
    assert canonical([tuple(r.values()) for r in rows], got.columns) == canonical(want.fetchall(), want.columns)
    assert len(rows) == N
    return rows


def test_hosts_decide_at_ten_thousand_documents(spark, planted):
    rows = both(spark, planted, "op2_host_quality_rules")
    symbols = [r for r in rows if r["n_symbols"] > 0]
    assert {r["kept"] for r in symbols if r["doc_id"] % 40 == 0} == {False}  # the strict host's go
    assert {r["kept"] for r in symbols if r["doc_id"] % 40 > 1} == {True}  # the like of others stay
    flips = [r for r in rows if r["kept"] != (not r["base_failed"])]
    refused = [r for r in rows if r["doc_id"] % 40 == 1]
    assert len(flips) >= 100 and {r["kept"] for r in refused} == {False} and any(not r["base_failed"] for r in refused)
    assert all(r["kept"] for r in rows if r["doc_id"] % 40 > 1 and not r["base_failed"])


def test_urls_decide_at_ten_thousand_pages(spark, planted):
    rows = both(spark, planted, "op4_url_filters")
    win = [r for r in rows if r["path"].startswith("/win/")]
    assert len(win) == 400 and {r["verdict"] for r in win} == {"block"}
    blocked = [r for r in rows if r["verdict"] == "block" and not r["path"].startswith("/win/")]
    assert not blocked, blocked[:3]
