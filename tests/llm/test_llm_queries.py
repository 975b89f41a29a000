"""The queries of the training-data operators: against SQL, against brute force, or by held-out accuracy."""

import os
import re
import zlib

import numpy as np
import pytest
import xxhash

from talkloom.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(same, name):
    same(QUERIES[name], ORACLE_SQL[name])


def read(duck, what):
    return duck.sql(what).fetchall()


def held(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(ids, fps):
    u = sorted(set(fps))
    root = {x: x for x in u}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, a in enumerate(u):
        for b in u[:i]:
            if bin(a ^ b).count("1") <= 3:
                root[find(a)] = find(b)
    least = {}
    for i, f in zip(ids, fps):
        least[find(f)] = min(least.get(find(f), i), i)
    return [least[find(f)] for f in fps]


def test_op3_equals_brute_force(spark, sf_dir, duck):
    docs = dict(read(duck, "SELECT doc_id, text FROM documents"))
    got = QUERIES["op3_simhash_near_dedup"](spark, sf_dir).toPandas().sort_values("doc_id")
    fps = [slow_fingerprint(docs[i]) for i in got["doc_id"]]
    assert list(got["fingerprint"]) == [f"{x:016x}" for x in fps]
    assert list(got["component_id"]) == slow_components(list(got["doc_id"]), fps)


def test_op1_places_every_word_once(spark, sf_dir, duck):
    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in read(duck, "SELECT doc_id, text FROM documents")}
    got = QUERIES["op1_best_fit_packing"](spark, sf_dir).toPandas()
    assert got.groupby("doc_id")["length"].sum().to_dict() == sizes
    for _, b in got.groupby("bin_id"):
        b = b.sort_values("bin_offset")
        assert (b["bin_offset"] + b["length"]).iloc[-1] == b["bin_fill"].iloc[0] <= b["bin_length"].iloc[0]
        assert (b["bin_offset"].to_numpy()[1:] == (b["bin_offset"] + b["length"]).to_numpy()[:-1]).all()


def test_op4_hosts_paths_and_rules(spark, sf_dir, duck):
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
    urls = dict(read(duck, "SELECT page_id, url FROM pages"))
    for r in QUERIES["op4_url_filters"](spark, sf_dir).collect():
        rest = urls[r["page_id"]].partition("://")[2]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        assert (r["host"], r["path"]) == (host.lower(), path)
        fits = [(v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        verdict, rule = max(fits, key=lambda f: len(f[1])) if fits else (None, None)
        assert r["rule"] == rule
        assert r["verdict"] in ("allow", "block") if rule is None else r["verdict"] == verdict


def test_op6_takes_its_targets(spark, sf_dir):
    mixed = QUERIES["op6_source_mixing"](spark, sf_dir)
    got = mixed.toPandas()
    assert (got["taken"] <= 2 * got["size"]).all()
    again = QUERIES["op6_source_mixing"](spark, sf_dir).toPandas()
    assert sorted(map(tuple, got.to_numpy())) == sorted(map(tuple, again.to_numpy()))
    assert abs(got["taken"].sum() - 1.5 * got["size"].sum()) < 40


def test_op8_held_out_accuracy(spark, sf_dir):
    import duckdb

    # The smallest tables hold out some twenty labels, of which too few are 0 to tell an accuracy by.
    larger = f"{os.path.dirname(sf_dir)}/sf0.01"
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{larger}/labels.parquet'").fetchall())
    rows = QUERIES["op8_quality_classifier"](spark, larger).collect()
    assert all(r["held_out"] == (held(r["doc_id"], 5) == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    test = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([p == y for p, y in test]) >= 0.95
    assert np.mean([p for p, y in test if y == 0]) <= 0.2


def test_op9_held_out_accuracy(spark, sf_dir, duck):
    langs = dict(read(duck, "SELECT doc_id, lang FROM documents"))
    rows = QUERIES["op9_language_id"](spark, sf_dir).collect()
    assert all(r["held_out"] == (held(r["doc_id"], 4) == 2) for r in rows)
    test = [r["lang_pred"] == langs[r["doc_id"]] for r in rows if r["held_out"]]
    assert np.mean(test) >= 0.95


def test_op10_equals_the_article(spark, sf_dir, duck):
    from html import unescape

    pages = dict(read(duck, "SELECT page_id, html FROM pages"))
    for r in QUERIES["op10_html_extraction"](spark, sf_dir).collect():
        article = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"</?b>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])
