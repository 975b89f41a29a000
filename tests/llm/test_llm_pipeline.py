"""The corpus pipeline against a brute-force version of its stages on a small fixture."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from talkloom.llm import simhash

DDL = "doc_id long, text string, lang string, source string, n_chars long"
LINE = "this very line is shared by more than five of the documents"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    words = lambda seed, n: " ".join(f"wordy{seed}x{i} of the" for i in range(n))
    rows = [(i, f"{words(i, 40 + i)}\n{LINE}", "en", f"s{i % 3}", 0) for i in range(12)]
    rows += [
        (100, rows[3][1], "en", "s1", 0),
        (101, rows[4][1].replace("wordy4x7", "changed"), "en", "s0", 0),
        (102, "12345 !!", "en", "s0", 0),
        (103, None, "en", "s0", 0),
        (104, "", None, None, 0),
        (110, f"{words(50, 45)}\n{LINE}", "en", "s2", 0),
    ]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, DDL).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(6)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows


def staged(spark, path):
    docs, out = spark.read.parquet(f"{path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path).persist()
        out.append((name, docs))
    return out


def test_stages(spark, corpus):
    path, rows = corpus
    stages = dict(staged(spark, path))
    columns = [c.split()[0] for c in DDL.split(", ")]
    assert all(stages[name].columns == columns for name, _ in corpus_pipeline.STAGES[:-1])
    # Language: texts without a letter go.
    assert {r["doc_id"] for r in stages["language_id"].collect()} == {r[0] for r in rows} - {102, 103, 104}
    # Lines: the shared one stays in the largest id that holds it.
    texts = {r["doc_id"]: r["text"] for r in stages["line_dedup"].collect()}
    assert {i for i, t in texts.items() if LINE in t} == {110}
    assert all(r["n_chars"] in (0, len(r["text"])) for r in stages["line_dedup"].collect())
    # Near-duplicates: the copy and the near copy go.
    kept = {r["doc_id"] for r in stages["near_dedup"].collect()}
    assert kept == {*range(12), 110}
    # Mixing: whole documents, none more than twice, near one and a half times the words.
    size = {i: len(t.split()) for i, t in texts.items()}
    times = {r["doc_id"]: r["count"] for r in stages["mixing"].groupBy("doc_id").count().collect()}
    assert set(times.values()) <= {1, 2} and set(times) <= kept
    total = sum(size[i] for i in kept)
    assert abs(sum(size[i] * n for i, n in times.items()) - 1.5 * total) <= 3 * max(size.values()) / 2
    # Packing: every word of the mix is placed.
    packed = stages["packing"].groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in packed} == {i: size[i] * n for i, n in times.items()}


def test_run_gives_what_the_stages_give(spark, corpus):
    path, _ = corpus
    got = corpus_pipeline.run(spark, path)
    want = staged(spark, path)[-1][1]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], DDL).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_mixing_keeps_repeated_rows_apart(spark, corpus):
    path, _ = corpus
    df = spark.createDataFrame([(1, "a b c", "en", "s", 5)] * 3 + [(None, "d e", "en", None, 3)], DDL)
    got = corpus_pipeline.mix_sources(spark, df, path)
    assert 3 <= got.count() <= 8


def test_similar_groups_hold_all_links_of_near_duplicates(spark, corpus):
    path, _ = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    wide = {r["doc_id"]: r["component_id"] for r in simhash.similar_groups(docs).collect()}
    for r in simhash.near_duplicates(docs).collect():
        assert wide[r["doc_id"]] == wide[r["component_id"]]


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def alike(a, b):
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y)


def test_near_copies_are_caught_after_line_dedup(spark, tmp_path):
    """Line dedup takes from near copies in groups of five and more all that they share; they still are one group."""
    rng = np.random.default_rng(11)
    vocabulary = np.array([f"{a}{b}{c}" for a in "bdfgklmnpr" for b in ("a", "en", "ir", "o", "ut") for c in ("", "s", "th", "rel", "mo", "nd")])
    sentence = lambda n: " ".join(rng.choice(vocabulary, n)) + "."
    rows, copies, first = [], {}, {}
    for group in range(60):
        base = [sentence(45).split() for _ in range(9)]
        rows.append((len(rows), "\n".join(map(" ".join, base)), "en", f"s{group % 4}", 0))
        first[group] = rows[-1][0]
        for _ in range(int(rng.integers(1, 9))):
            lines = [x.copy() for x in base]
            for _ in range(int(rng.integers(1, 7))):
                line = lines[rng.integers(9)]
                line[rng.integers(len(line))] = str(rng.choice(vocabulary))
            text = "\n".join(map(" ".join, lines))
            if alike(text, rows[first[group]][1]) >= 0.8:
                copies[len(rows)] = group
                rows.append((len(rows), text, "en", f"s{group % 4}", 0))
    alone = [(1000 + i, "\n".join(sentence(45) for _ in range(5)), "en", "s1", 0) for i in range(60)]
    spark.createDataFrame(rows + alone, DDL).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    cleaned = corpus_pipeline.drop_shared_lines(spark, docs, str(tmp_path)).persist()
    stayed = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_near_duplicates(spark, cleaned, str(tmp_path)).collect()}
    assert {r[0] for r in alone} <= set(stayed)
    kept = {}
    for i in stayed:
        if i < 1000:
            kept.setdefault(copies.get(i) if i in copies else next(g for g, x in first.items() if x == i), []).append(i)
    assert len(copies) > 150 and set(kept) == set(first)
    caught = 1 - sum(len(x) - 1 for x in kept.values()) / len(copies)
    assert caught >= 0.9
    # What stays of a group is whole, if all of it was found.
    whole = [len(stayed[x[0]].split()) >= 9 * 45 - 5 for x in kept.values() if len(x) == 1]
    assert np.mean(whole) >= 0.9


def odd_rows():
    text = " ".join(f"word{i} of the" for i in range(40))
    rows = [
        (1, text, "en", "a", 0),
        (1, text, "en", "a", 0),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (None, text, "en", None, 0),
        (4, "long words here " * 40_000, "en", "b", 0),
        (5, text.upper(), None, "b", 0),
    ]
    return [(*r, 1, 2, 3, 4, 5, 6, 7) for r in rows]


CLASHES = ", __id long, __goes long, __nth long, __key long, __times long, __copy long, __kept_id long"


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows_and_clashing_columns(spark, tmp_path, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    odd = spark.createDataFrame(odd_rows(), DDL + CLASHES)
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (None, 0, 1), (5, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = stage(spark, odd, str(tmp_path))
    rows = got.collect()
    if name != "packing":
        assert got.columns == odd.columns
        assert all(tuple(r)[5:] == (1, 2, 3, 4, 5, 6, 7) for r in rows)
    assert stage(spark, odd.limit(0), str(tmp_path)).count() == 0
    ids = sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in rows)
    if name == "language_id":
        assert ids == [-1, 1, 1, 4, 5]  # without a letter: 2 and 3
    if name == "line_dedup":
        assert ids == [-1, 1, 1, 2, 3, 4, 5]
    if name == "near_dedup":
        assert ids == [-1, 1, 2, 4]  # 3 is a copy of 2, 5 of 1
    if name == "mixing":
        assert set(ids) <= {-1, 1, 4, 5} and len(ids) >= 2
    if name == "packing":
        assert {r["doc_id"]: 0 for r in rows} == {1: 0, 2: 0, 3: 0, None: 0, 4: 0, 5: 0}
