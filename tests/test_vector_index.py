"""The vector index: exact and approximate searches, what they read, refreshes and crashes."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkloom.operators import vector_index


def vectors(n, seed=0, dims=12, families=15):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(families, dims)) * 3
    return [(f"i{i}", [float(x) for x in centres[rng.integers(families)] + rng.normal(size=dims)], "ab"[i % 2]) for i in range(n)]


def table(spark, rows):
    return spark.createDataFrame(rows, "id string, embedding array<double>, kind string")


def slow(rows, q, k):
    far = []
    for i, v, _ in rows:
        if v is not None and None not in v and np.linalg.norm(v) > 0:
            far.append((1 - float(np.dot(v, q) / np.linalg.norm(v) / np.linalg.norm(q)), i))
    return [i for _, i in sorted(far)[:k]]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rows = vectors(1500) + [("null", None, "a"), ("hole", [1.0, None, *([0.0] * 10)], "a"), ("zero", [0.0] * 12, "b")]
    path = str(tmp_path_factory.mktemp("index") / "i")
    vector_index.refresh(table(spark, rows), path, lambda r: r, ["kind"])
    return path, rows


def test_exact_search_equals_brute_force_and_reads_few_cells(spark, index):
    path, rows = index
    centres, radii = vector_index._cells(spark, path)
    assert len(centres) > 20
    asked = vectors(6, seed=5) + rows[:2]
    for _, q, _ in asked:
        got = [r["id"] for r in vector_index.search(spark, path, q, 10).collect()]
        assert got == slow(rows, q, 10)
    got = vector_index.search(spark, path, rows[0][1], 10, lambda r: r.where("kind = 'b'"))
    assert [r["id"] for r in got.collect()] == slow([r for r in rows if r[2] == "b"], rows[0][1], 10)
    # In the families that the vectors come in, bounds rule cells out.
    last = 1 - vector_index.search(spark, path, rows[0][1], 10).agg(F.max("distance")).first()[0]
    order = vector_index.bounds(centres, radii, rows[0][1])
    assert sum(b <= np.arccos(last) + vector_index.OFF for b, _ in order) < 0.8 * len(order)


def test_approximate_search_recalls_nine_tenths(spark, index):
    path, rows = index
    hit = 0
    for _, q, _ in rows[:100:10]:
        plan = vector_index.search(spark, path, q, 10, exact=False, probes=8)
        hit += len({r["id"] for r in plan.collect()} & set(slow(rows, q, 10)))
    assert hit >= 90
    assert "PartitionFilters: [cell" in plan._jdf.queryExecution().toString().replace("isnotnull(cell#", "cell#")


def test_more_than_all_and_none(spark, index):
    path, rows = index
    q = rows[0][1]
    assert [r["id"] for r in vector_index.search(spark, path, q, 5000).collect()] == slow(rows, q, 5000)
    assert vector_index.search(spark, path, q, 5, lambda r: r.where("kind = 'none'")).count() == 0


def text_rows(spark, rows):
    return spark.createDataFrame(rows, "id string, text string, kind string")


def lengths(rows):
    """An embedder that counts its rows where Spark's accumulators see them."""
    return rows.withColumn("embedding", F.array(F.length("text").cast("double"), F.lit(1.0), (F.length("text") % 7).cast("double")))


def state(spark, path, *columns):
    return sorted(map(tuple, vector_index.load(spark, path).select(*columns).collect()), key=str)


def test_refresh_embeds_what_changed_and_equals_a_rebuild(spark, tmp_path):
    rng = random.Random(2)
    rows = [(f"t{i}", "x" * rng.randrange(1, 90), rng.choice(["1", "02", None])) for i in range(200)]
    path, asked = str(tmp_path / "i"), []

    def embed(r):
        asked.append(r.count())
        return lengths(r)

    assert vector_index.refresh(text_rows(spark, rows), path, embed, ["kind"]) == {"kept": 0, "embedded": 200, "gone": 0}
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "i").rglob("part-*") if "_cells" not in str(f)}
    again = vector_index.refresh(text_rows(spark, rows), path, embed, ["kind"])
    assert again == {"kept": 200, "embedded": 0, "gone": 0} and all(f.exists() for f in before)
    now = [("t0", "changed text of another length", rows[0][2]), (rows[1][0], rows[1][1], "moved"), *rows[4:], ("new", "fresh", "02"), (None, "no id", "1"), rows[9]]
    done = vector_index.refresh(text_rows(spark, now), path, embed, ["kind"])
    assert done == {"kept": 196, "embedded": 3, "gone": 2} and asked == [200, 0, 3]
    assert any(f.exists() for f in before)  # cells that nothing happened to aren't rewritten
    rebuilt = str(tmp_path / "j")
    vector_index.refresh(text_rows(spark, now), rebuilt, lengths, ["kind"])
    columns = ("id", "text", "kind", "embedding", "content")
    assert state(spark, path, *columns) == state(spark, rebuilt, *columns)
    assert {r[0] for r in state(spark, path, "id", "made") if r[1] == 2} | {r[0] for r in state(spark, path, "id", "made") if r[1] == 3} == {"t0", "t1", "new"}
    q = [30.0, 1.0, 2.0]
    assert [r["id"] for r in vector_index.search(spark, path, q, 9).collect()] == [r["id"] for r in vector_index.search(spark, rebuilt, q, 9).collect()]


def test_refresh_to_nothing_and_back(spark, tmp_path):
    path = str(tmp_path / "i")
    rows = [(f"t{i}", "x" * (i + 1), "k") for i in range(30)]
    vector_index.refresh(text_rows(spark, rows), path, lengths, ["kind"])
    assert vector_index.refresh(text_rows(spark, rows).limit(0), path, lengths, ["kind"])["gone"] == 30
    assert vector_index.load(spark, path).count() == 0 and vector_index.search(spark, path, [1.0, 1.0, 1.0]).count() == 0
    assert vector_index.refresh(text_rows(spark, rows[:9]), path, lengths, ["kind"])["embedded"] == 9
    assert vector_index.load(spark, path).count() == 9


def test_a_crash_between_bounds_and_vectors_is_mended(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "i")
    rows = [(f"t{i}", "x" * (i + 1), "k") for i in range(60)]
    vector_index.refresh(text_rows(spark, rows), path, lengths, ["kind"])
    more = [*rows[5:], *((f"n{i}", "y" * (200 + i), "k") for i in range(5))]
    was = vector_index._write
    monkeypatch.setattr(vector_index, "_write", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        vector_index.refresh(text_rows(spark, more), path, lengths, ["kind"])
    q = [20.0, 1.0, 3.0]
    plain = [(r["id"], r["embedding"], "") for r in vector_index.load(spark, path).collect()]
    assert [r["id"] for r in vector_index.search(spark, path, q, 7).collect()] == slow(plain, q, 7) and len(plain) == 60
    monkeypatch.setattr(vector_index, "_write", was)
    assert vector_index.refresh(text_rows(spark, more), path, lengths, ["kind"]) == {"kept": 55, "embedded": 5, "gone": 5}
    assert {r[0] for r in state(spark, path, "id")} == {r[0] for r in more}


def test_a_refresh_does_not_gather_the_rows_of_a_cell(spark, tmp_path, monkeypatch):
    """Rows that stay in touched cells go by their ids: texts and vectors are never shuffled by folder, however many a cell has."""
    plans, real = [], vector_index.checkpointed
    path = str(tmp_path / "i")
    rows = [(f"i{i}", [1.0, i / 1000.0], "a") for i in range(200)]
    vector_index.refresh(table(spark, rows), path, lambda r: r, ["kind"], cells=1)
    monkeypatch.setattr(vector_index, "checkpointed", lambda df: plans.append(df._jdf.queryExecution().toString()) or real(df))
    rows[5] = ("i5", [0.0, 1.0], "a")
    assert vector_index.refresh(table(spark, rows), path, lambda r: r, ["kind"]) == {"kept": 199, "embedded": 1, "gone": 0}
    last = plans[-1].split("== Physical Plan ==")[1]
    assert "hashpartitioning(" in last and "hashpartitioning(coalesce(kind#" not in last
    assert sorted(r["id"] for r in vector_index.load(spark, path).collect()) == sorted(i for i, _, _ in rows)
