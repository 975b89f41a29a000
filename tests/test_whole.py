"""Queries over whole tables, held against the tables themselves."""

import re
import shutil
from collections import Counter

import pytest

from talkloom.operators import aggregates
from talkloom.plans import artifact_queries  # noqa: F401
from talkloom.plans.queries import QUERIES


def test_every_order_is_an_action(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderpriority").collect()
    want = {}
    for key, priority in sorted(map(tuple, orders)):
        want.setdefault("immediate" if priority == "5-LOW" else priority, []).append(str(key))
    got = QUERIES["group_actions"](spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == sorted((u, i + 1, x) for u, xs in want.items() for i, x in enumerate(xs))


def test_actions_in_order_are_those_of_the_arrays(spark):
    rows = [("a" if i % 3 else None, i % 50, str(i), None if i % 2 else "c", "") for i in range(400)] + [("", None, None, None, None)]
    df = spark.createDataFrame(rows, "urgency string, pos int, action string, category string, source_cluster string")
    want = [(r["urgency"], i + 1, *x) for r in aggregates.actions_by_urgency(df).collect() for i, x in enumerate(r["actions"])]
    key = lambda r: tuple(r[:2])
    assert sorted(map(tuple, aggregates.actions_in_order(df).collect()), key=key) == sorted(want, key=key)
    assert aggregates.actions_in_order(df.limit(0)).count() == 0


def test_every_twentieth_vector_is_a_claim(spark, sf_dir):
    ids = {r[0] for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id").collect()}
    got = QUERIES["knn_join"](spark, sf_dir).collect()
    assert {r["claim_id"] for r in got} == {i for i in ids if i % 20 == 0} and len(got) == 8 * len({r["claim_id"] for r in got})


def test_appendix_has_every_customer(spark, sf_dir):
    by_customer = {}
    for r in spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_custkey", "o_totalprice", "o_orderkey").collect():
        by_customer.setdefault(r["o_custkey"], []).append((-r["o_totalprice"], r["o_orderkey"]))
    want = {(f"seg {k % 7} of {c}", f"cluster {c}") for c, orders in by_customer.items() for _, k in sorted(orders)[:3] if k % 7 < 4}
    got = sorted(map(tuple, QUERIES["appendix"](spark, sf_dir).collect()))
    assert got == sorted(want) and any(int(c.split()[1]) % 2 == 0 for _, c in got)


def words(text):
    return {w for w in re.findall("[a-z0-9]+", (text or "").lower()) if len(w) > 2}


@pytest.fixture
def texts(spark, tmp_path):
    """Documents whose words of interest stand far behind their first hundreds of characters."""
    item = "whole texts decide which benchmark item a document matches best of all"
    docs = [(1, "in " * 100 + item, "en"), (2, "to " * 200 + "farword", "de"), (3, item[:70], "en")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, docs[0][1]), (8, "another thing")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), docs


def test_tokens_of_whole_texts_are_matched(spark, texts):
    path, docs = texts
    for name in ("token_best_match", "token_best_match_strict"):
        assert {(r["item_id"], r["title"]) for r in QUERIES[name](spark, path).collect()} == {(7, docs[0][1])}


def test_keywords_of_whole_texts_are_weighed(spark, texts):
    path, docs = texts
    want = Counter()
    for _, text, lang in docs:
        want.update({w: 3 if lang == "en" else 1 for w in words(text)})
    got = QUERIES["weighted_keywords"](spark, path).collect()
    assert [tuple(r) for r in got] == sorted(want.items(), key=lambda x: (-x[1], x[0]))[:15] and ("farword", 1) in map(tuple, got)


def test_titles_are_matched_whole(spark, texts):
    path, _ = texts
    assert [(r["left_id"], r["right_id"], r["score"]) for r in QUERIES["fuzzy_match"](spark, path).collect()] == [(7, 1, 1.0)]
    assert all(d[1] in r["prose"] for d, r in zip(texts[1], sorted(QUERIES["reconcile_titles"](spark, path).collect())) if d[0] != 3)


def test_bold_phrases_may_be_long(spark):
    from pyspark.sql import functions as F

    from talkloom.functions import grounding

    lazy = re.compile(r"\*\*(?:[^*]|\*(?!\*)){30,}?\*\*")
    x = "x" * 30
    proses = [f"See **{'word ' * 20000}** now", f"**{x}***", f"**a*b{x}** **{x[1:]}** {x} **", f"***{x}*y**", f"**{x}\n{x}** ****{x}**", f"**{x}*"]
    df = spark.createDataFrame(list(enumerate(proses)), "i int, prose string")
    got = dict(tuple(r) for r in df.select("i", F.regexp_extract_all("prose", F.lit(grounding.BOLD), F.lit(0))).collect())
    assert [got[i] for i in range(len(proses))] == [lazy.findall(p) for p in proses]


def test_customers_of_one_name_all_have_their_chunk(spark, sf_dir, tmp_path):
    """Tables grown by shifted keys repeat names, and so ids of chunks."""
    duckdb = pytest.importorskip("duckdb")
    for name in ("region", "nation", "part", "events", "documents", "conversations"):
        shutil.copy(f"{sf_dir}/{name}.parquet", tmp_path)
    n = duckdb.sql(f"SELECT max(c_custkey) + 1 FROM '{sf_dir}/customer.parquet'").fetchall()[0][0]
    grown = f"SELECT c.* REPLACE (c_custkey + {n} * i AS c_custkey) FROM '{sf_dir}/customer.parquet' c, range(2) r(i)"
    duckdb.sql(f"COPY ({grown}) TO '{tmp_path}/customer.parquet' (FORMAT parquet)")
    got = QUERIES["chunk_every_kind"](spark, str(tmp_path)).where("chunk_type = 'cluster_summary'").collect()
    want = duckdb.sql(f"SELECT count(*), count(DISTINCT c_name) FROM ({grown}) WHERE c_custkey % 7 <> 0").fetchall()[0]
    assert (len(got), len({r["id"] for r in got})) == want and want[0] > want[1]
