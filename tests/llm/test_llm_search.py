"""Ranked lexical search and the n-gram Jaccard join, against brute force."""

import math
import random
import re

import numpy as np
import pytest

from talkloom.llm import count_tree, tiered_index
from talkloom.llm.queries import QUERIES

DOCS = "doc_id long, text string, score double, block long, no long, node long, n long"


def docs(spark, rows):
    """Documents with columns whose names clash with those that operators make."""
    return spark.createDataFrame([(i, t, 0.5, 1, 2, 3, 4) for i, t in rows], DOCS)


def slow_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def slow_search(rows, items, k):
    found = [(i, slow_terms(t)) for i, t in rows]
    found = [(i, w) for i, w in found if w]
    n_docs, n_terms = len(found), sum(len(w) for _, w in found)
    df = {}
    for _, w in found:
        for x in set(w):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for i, w in found:
            m = 50 + 50 * len(w) * n_docs // n_terms
            s = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (1_000_000_000 * w.count(x) // (1000 * w.count(x) + 20 * m))
                for x in set(slow_terms(text))
                if x in w
            )
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def made(n, seed, words=400):
    rng = random.Random(seed)
    pool = [f"w{int(rng.paretovariate(0.7)) % words}" for _ in range(20_000)]
    return [(i, " ".join(rng.choices(pool, k=rng.choice([0, 1, 5, 30, 200])))) for i in range(n)]


@pytest.fixture(scope="module")
def corpus():
    rows = made(700, 1)
    rows += [(1000 + i, rows[5][1]) for i in range(120)]  # a large group of exact copies: ties
    rows += [(7, rows[9][1]), (7, rows[9][1]), (None, rows[11][1]), (None, None), (2000, ""), (2001, "…\n"), (2002, "Größe ÉTÉ a_b 3,5 naïve")]
    return rows


ITEMS = [(0, "W1 w2, w3 w2 w399"), (0, "W1 w2, w3 w2 w399"), (None, "w1"), (1, None), (2, "…"), (3, "unseen words"), (4, "größe a B 3 5 été ÉTÉ")]


@pytest.mark.parametrize("tiers", [(2_000, 32_000), (20, 60), (1, 1), (150, 10)])
def test_search_equals_brute_force(spark, corpus, monkeypatch, tiers):
    monkeypatch.setattr(tiered_index, "TIERS", tiers)
    items = [*ITEMS, *((10 + i, t) for i, (_, t) in enumerate(made(12, 3)))]
    table = spark.createDataFrame(items, "item_id long, text string")
    index = tiered_index.build(docs(spark, corpus), tiered_index.item_terms(table))
    got = tiered_index.search(index, table, k=10)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == slow_search(corpus, items, 10)


def test_some_results_are_proved_early_and_others_fall_through(spark, monkeypatch):
    """A rare term's documents are proved in the first tier; a common term's ties can't be."""
    rows = [(i, f"common filler{i}") for i in range(400)] + [(1000 + i, "rare rare rare common") for i in range(3)]
    monkeypatch.setattr(tiered_index, "TIERS", (5, 20))
    table = spark.createDataFrame([(1, "rare"), (2, "common"), (3, "rare common")], "item_id long, text string")
    index = tiered_index.build(docs(spark, rows), tiered_index.item_terms(table))
    runs, was = [], tiered_index._scorer
    monkeypatch.setattr(tiered_index, "_scorer", lambda k, last: runs.append(last) or was(k, last))
    got = sorted(map(tuple, tiered_index.search(index, table.where("item_id = 1"), k=3).collect()), key=str)
    assert runs == [False] and [r[2] for r in got] == [1000, 1001, 1002]
    got = sorted(map(tuple, tiered_index.search(index, table, k=4).collect()), key=str)
    assert runs[1:] == [False, False, True] and got == slow_search(rows, [(1, "rare"), (2, "common"), (3, "rare common")], 4)


def test_whole_index_many_blocks_and_packs(spark, corpus, monkeypatch):
    """An index of all terms gives the same as one of asked terms; beyond the bound asked terms meet the lists by a join."""
    items = made(9, 5)
    table = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(tiered_index, "PACK", 40)
    monkeypatch.setattr(tiered_index, "BROADCAST", 0)
    wanted = slow_search(corpus, items, 50)
    whole = tiered_index.search(tiered_index.build(docs(spark, corpus).repartition(7)), table)
    assert sorted(map(tuple, whole.collect()), key=str) == wanted
    monkeypatch.setattr(tiered_index, "ASKED", 1)
    asked = tiered_index.build(docs(spark, corpus), tiered_index.item_terms(table))
    assert sorted(map(tuple, tiered_index.search(asked, table).collect()), key=str) == wanted


def test_search_of_nothing(spark, corpus):
    table = spark.createDataFrame(ITEMS, "item_id long, text string")
    none = docs(spark, [(1, None)]).limit(0)
    assert tiered_index.search(tiered_index.build(none), table).count() == 0
    assert tiered_index.search(tiered_index.build(docs(spark, [(1, None), (2, "...")])), table).count() == 0
    assert tiered_index.search(tiered_index.build(docs(spark, corpus)), table.limit(0)).count() == 0


def test_long_text_counts_whole(spark):
    rows = [(1, "x " * 200_000 + "needle"), (2, "needle"), (3, "x")]
    table = spark.createDataFrame([(1, "needle x")], "item_id long, text string")
    got = tiered_index.search(tiered_index.build(docs(spark, rows)), table)
    assert sorted(map(tuple, got.collect()), key=str) == slow_search(rows, [(1, "needle x")], 50)


# The join ----------------------------------------------------------------------------------------------------------


def slow_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))) if words else frozenset()


def slow_components(rows):
    sets = [slow_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    order = sorted(range(len(rows)), key=lambda i: len(sets[i]))
    for n, i in enumerate(order):
        for j in order[n + 1 :]:
            if not sets[i]:
                break
            if 9 * len(sets[j]) > 10 * len(sets[i]):
                break
            both = len(sets[i] & sets[j])
            if 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def family(rng, n, size, most, first):
    """Copies of one text of ``size`` words in which up to ``most`` words differ: similarities on both sides of 0.9."""
    base = [f"b{rng.randrange(10**6)}" for _ in range(size)]
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randint(0, most)):
            words[rng.randrange(size)] = f"c{rng.randrange(10**6)}"
        if rng.random() < 0.3:
            words = words[rng.randint(0, most) :]
        out.append((first + i, " ".join(words)))
    return out


@pytest.fixture(scope="module")
def families():
    rng, rows = random.Random(4), []
    for size in (3, 9, 10, 11, 12, 13, 20, 30, 31, 60, 150, 400, 1500):
        rows += family(rng, 24, size, max(1, size // 50), 10_000 * len(rows))
    rows += family(rng, 160, 120, 4, 5)
    shared = " ".join(f"s{i}" for i in range(90))  # a passage most of the text of many documents that don't link
    rows += [(10**8 + i, shared + " " + " ".join(f"o{rng.randrange(10**6)}" for _ in range(14))) for i in range(80)]
    rows += [(3, None), (4, ""), (None, " \n"), (None, "one TWO"), (6, "One two"), (6, "One two"), (8, "one two three"), (9, "long " * 30_000)]
    rng.shuffle(rows)
    return rows


def found(df):
    assert df.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted(map(tuple, df.collect()), key=str)


def test_join_equals_brute_force(spark, families):
    assert found(count_tree.similar_sets(docs(spark, families))) == slow_components(families)


def test_large_trees_are_dealt_into_cells(spark, families, monkeypatch):
    monkeypatch.setattr(count_tree, "CELL", 32)
    monkeypatch.setattr(count_tree, "SAMPLED", 1)
    assert found(count_tree.similar_sets(docs(spark, families).repartition(5))) == slow_components(families)


def test_join_of_nothing(spark):
    assert found(count_tree.similar_sets(docs(spark, [(1, None)]).limit(0))) == []
    assert found(count_tree.similar_sets(docs(spark, [(2, None), (1, ""), (None, None)]))) == [(1, 0, 1), (2, 0, 2), (None, 0, None)]


def test_a_link_shares_a_band(spark):
    """Whatever differs in a ninth or less of the smaller set has a band's counts in common, also across size classes."""
    rng = np.random.default_rng(0)
    for size in [*range(9, 60), 99, 100, 127, 500, 2000]:
        for _ in range(20):
            a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
            for gone in range(size // 9 + 1):
                b = np.unique(np.r_[rng.permutation(a)[gone:], rng.integers(0, 1 << 63, rng.integers(0, size // 9 + 1)).astype(np.uint64)])
                if count_tree.enough(len(np.intersect1d(a, b)), len(a), len(b)):
                    assert np.intersect1d(count_tree.band_keys(a), count_tree.band_keys(b)).size
                if size > 200:
                    break


def test_bound_prunes_pages_and_never_a_link():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in rng.integers(100, 2000, 600)]
    sets += [s[len(s) // 30 :] for s in sets[:100]]
    sizes, points = np.array([len(s) for s in sets]), np.stack([count_tree.point(s) for s in sets])
    edges = count_tree.forest(np.arange(len(sets)), sizes, points)
    assert {tuple(sorted(e)) for e in edges} >= {(i, 600 + i) for i in range(100)} and len(edges) < 200
    tree = count_tree.Tree(sizes, points)
    pages = [int(count_tree.enough(np.minimum(tree.top, p).sum(axis=1), n, tree.least).sum()) for n, p in zip(sizes, points)]
    assert np.mean(pages) < 0.7 * len(tree.least)


def test_op12_equals_brute_force(spark, sf_dir, duck):
    rows = duck.sql("SELECT doc_id, text FROM documents").fetchall()
    assert found(QUERIES["op12_ngram_jaccard_join"](spark, sf_dir)) == slow_components(rows)


def test_near_copies_below_the_threshold_are_no_pairs():
    """Parities part what counts leave together, and never what links: sets with twelve shingles of their own beside 188 do not link."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 200).astype(np.uint64)
    apart = [np.unique(np.r_[base[:188], rng.integers(0, 1 << 63, 12).astype(np.uint64)]) for _ in range(60)]
    near = [np.unique(np.r_[base[:195], rng.integers(0, 1 << 63, 5).astype(np.uint64)]) for _ in range(5)]
    sets = apart + near
    sizes, points, odd = np.array([len(s) for s in sets]), np.stack([count_tree.point(s) for s in sets]), np.stack([count_tree.parities(s) for s in sets])
    names = np.arange(len(sets))
    met = {(int(min(u, v)), int(max(u, v))) for us, vs in count_tree.across(names, sizes, names, points, odd) for u, v in zip(us, vs)}
    real = {
        (i, j) for i in names for j in names if i < j and count_tree.enough(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j]))
    }
    loose = sum(1 for i in range(60) for j in range(i) if count_tree.enough(np.minimum(points[i], points[j]).sum(), sizes[i], sizes[j]))
    assert real <= met and len(met - real) < loose / 4 and loose > 100
