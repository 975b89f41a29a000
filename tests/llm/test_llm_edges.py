"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkloom.llm import graph, host_rules, html_text, language, line_dedup, metric_tree, mixing, packing, quality_model, simhash, url_rules

DDL = "doc_id long, text string, lang string, source string, n_chars long, size long, kept boolean, component_id long, fp long, host string, score double"


def docs(spark, rows):
    """Documents with columns whose names clash with those that operators make."""
    return spark.createDataFrame([(i, t, la, s, 1, 7, True, 5, 6, "h", 0.5) for i, t, la, s in rows], DDL)


LINE = "a line of more than forty characters that many documents share"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (None, "x y z", "en", "a"),
        (1, None, None, None),
        (2, "", "en", "a"),
        (3, " \n\t ", "de", "b"),
        (4, "word " * 30_000, "en", "a"),
        (5, "same words here", "en", None),
        (5, "same words here", "en", None),
        (6, "SAME words here", None, "b"),
        (7, "…—", "fr", "b"),
    ]
    return docs(spark, rows).persist()


def one(df, key="doc_id"):
    return {tuple(r)[df.columns.index(key)]: r for r in df.collect()}


def test_released_tables_are_gone_and_kept_ones_are_not(spark):
    from talkloom.llm import common

    first = common.cut(spark.range(3), "first")
    since = common.mark()
    second, third = common.cut(spark.range(4), "second"), common.cut(spark.range(5), "third")
    common.release(spark, since, keep=third)
    assert first.count() == 3 and third.count() == 5
    with pytest.raises(Exception):  # noqa: B017
        second.count()


def test_tables_of_other_threads_stay(spark):
    from concurrent.futures import ThreadPoolExecutor

    from talkloom.llm import common

    since = common.mark()
    own = common.cut(spark.range(3), "own")
    with ThreadPoolExecutor(1) as pool:
        other = pool.submit(lambda: common.cut(spark.range(4), "other")).result()
    later = common.cut(spark.range(5), "later")
    common.release(spark, since, keep=later)
    assert other.count() == 4 and later.count() == 5 and common.mark() == since + 1
    with pytest.raises(Exception):  # noqa: B017
        own.count()
    common.release(spark, since)
    with pytest.raises(Exception):  # noqa: B017
        later.count()


def test_packing(spark, odd):
    got = packing.pack(odd, lengths=(16, 64, 1024), group=3).toPandas()
    assert got.groupby(got["doc_id"].fillna(-1))["length"].sum().to_dict() == {-1: 3, 1: 0, 2: 0, 3: 0, 4: 30_000, 5: 6, 6: 3, 7: 1}
    assert sorted(got[got["doc_id"] == 5]["copy"]) == [0, 1]
    assert got["length"].max() == 1024 and set(got["bin_length"]) <= {16, 64, 1024}
    assert packing.pack(odd.limit(0)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(odd, lengths=(0,))


def slow_pack(sizes, lengths):
    """Best fit by looking at every open bin, with opening lengths chosen bin by bin and with each as the one; the cheapest packing."""
    longest, best = lengths[-1], None
    shrunk = lambda x: min(c for c in lengths if c >= x)

    def held(c, size, rest):
        for x in rest:  # largest first
            if size + x <= c:
                size += x
        return size

    for opens in (None, *lengths):
        left, bins, where = sum(sizes), [], []  # bins: [capacity, fill]
        for n, size in enumerate(sizes):
            fits = sorted((c - f, i) for i, (c, f) in enumerate(bins) if c - f >= size and c > f)
            if fits:
                i = fits[0][1]
            else:
                able = [c for c in lengths if c >= size]
                want = max(opens, able[0]) if opens else 0
                if not opens:
                    fills = [(held(c, size, sizes[n + 1 :]), c) for c in able]
                    want = min((packing.cost(shrunk(f), longest) / max(1, f), c) for f, c in fills)[1]
                elif want > left:
                    want = min(able, key=lambda c: packing.cost(c, longest) / max(1, min(c, left)))
                bins.append([want, 0])
                i = len(bins) - 1
            where.append((i, bins[i][1]))
            bins[i][1] += size
            left -= size
        final = [min(c for c in lengths if c >= f) for _, f in bins]
        total = sum(packing.cost(c, longest) for c in final)
        if best is None or total < best[0]:
            best = (total, where, [f for _, f in bins], final)
    return best


def test_packing_equals_brute_force():
    rng = np.random.default_rng(9)
    for _ in range(60):
        lengths = sorted({int(x) for x in rng.choice([4, 8, 16, 32, 64], rng.integers(1, 5))})
        sizes = sorted((int(x) for x in rng.integers(1, lengths[-1] + 1, rng.integers(1, 40))), reverse=True)
        bins, offsets, fill, final = packing.pack_sizes(sizes, lengths)
        total, where, fills, ends = slow_pack(sizes, lengths)
        assert (list(zip(bins, offsets)), fill, final) == (where, fills, ends)
        # No cheaper than the cheapest sequence that could hold all words, and no dearer than a bin for each item.
        assert total <= sum(packing.cost(min(c for c in lengths if c >= x), lengths[-1]) for x in sizes) + 1e-9


def cheapest(sizes, lengths):
    """The least cost of any packing, by trying every way to deal the items into bins."""
    best = [float("inf")]

    def deal(i, fills):
        if i == len(sizes):
            best[0] = min(best[0], sum(packing.cost(min(c for c in lengths if c >= f), lengths[-1]) for f in fills))
            return
        for b in range(len(fills)):
            if fills[b] + sizes[i] <= lengths[-1]:
                deal(i + 1, fills[:b] + [fills[b] + sizes[i]] + fills[b + 1 :])
        deal(i + 1, [*fills, sizes[i]])

    deal(0, [])
    return best[0]


def test_packing_is_near_the_least_cost():
    rng, over, fixed_over = np.random.default_rng(19), [], []
    for _ in range(60):
        lengths = sorted({int(x) for x in rng.choice([64, 128, 256, 512, 1024], rng.integers(1, 5))})
        sizes = sorted((int(x) for x in rng.integers(1, lengths[-1] + 1, rng.integers(1, 8))), reverse=True)
        final = packing.pack_sizes(sizes, lengths)[3]
        least = cheapest(sizes, lengths)
        over.append(sum(packing.cost(c, lengths[-1]) for c in final) / least)
        for opens in (lengths[-1],):
            fill = packing.pack_once(sizes, lengths, opens)[2]
            fixed_over.append(sum(packing.cost(min(c for c in lengths if c >= f), lengths[-1]) for f in fill) / least)
    assert min(over) >= 1 - 1e-9 and max(over) < 1.25 and np.mean(over) < 1.01 and np.mean(over) <= np.mean(fixed_over)


def test_bins_open_at_lengths_of_their_own():
    """Items of 700 fill bins of 1024 with what is left of small ones; the large item's bin opens larger."""
    sizes = sorted([3900, 700, 700, 700, 300, 300, 300, 100], reverse=True)
    assert packing.best_fill(sorted(sizes), 1024) == 1000
    bins, offsets, fill = packing.pack_once(sizes, list(packing.LENGTHS), None)
    final = sorted(min(c for c in packing.LENGTHS if c >= f) for f in fill)
    assert len(set(final)) > 1 and sum(fill) == sum(sizes)


def test_packing_opens_and_shrinks():
    bins, offsets, fill, final = packing.pack_sizes([9, 7, 5, 3, 2], [4, 8, 16])
    assert sum(fill) == 26 and all(f <= c for f, c in zip(fill, final))
    for c, f in zip(final, fill):
        assert c == min(x for x in (4, 8, 16) if x >= f)
    assert len(set(zip(bins, offsets))) == 5
    assert packing.pack_sizes([0], [4]) == ([0], [0], [0], [4])


def brute_measure(text):
    import re

    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    win = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    cover = {i + k for i, x in enumerate(win) if win.count(x) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cover)


@pytest.mark.parametrize("text", [None, "", "a b c a b c", "a a a a", "é  é\n\né\né #*$", "a b c d a b x b c d", "\x0b\x0cx\ty | <b>", "a\nb\na\n \n \n"])
def test_measure_equals_brute_force(text):
    assert host_rules.measure(None if text is None else text.encode()) == brute_measure(text)


def test_host_rules(spark, odd):
    got = one(host_rules.judge(odd))
    assert len(got) == 8 and host_rules.judge(odd).count() == 9
    assert got[1]["base_failed"] and got[1]["host_rate"] is None and not got[1]["kept"]
    assert host_rules.judge(odd.limit(0)).count() == 0
    assert got[1]["host_broken"] == []


GOOD = " ".join(f"wordy{i}" for i in range(60))


def test_bad_hosts_are_refused(spark):
    rows = [(i, "short", "en", "bad") for i in range(40)] + [(i + 40, GOOD, "en", "bad") for i in range(40)]
    rows += [(i + 100, GOOD if i % 10 else "short", "en", f"fine{i // 10 % 5}") for i in range(400)] + [(900, GOOD, "en", None), (901, GOOD, "en", "small")]
    got = one(host_rules.judge(docs(spark, rows)))
    assert not any(got[i]["kept"] for i in range(80)) and got[40]["host_refused"]
    assert all(got[i + 100]["kept"] == bool(i % 10) for i in range(400)) and got[900]["kept"]
    # One document tells little of a host: its rate is nearly that of all.
    assert got[901]["kept"] and got[901]["host_rate"] > 0.05


def test_hosts_decide_on_what_breaks_a_rule_both_ways(spark):
    marked = GOOD + " ###" * 6
    share = {"clean": 2, "messy": 40}
    rows = [(i + 1000 * n, marked if i < k else GOOD, "en", host) for n, (host, k) in enumerate(share.items()) for i in range(100)]
    rows += [(5000, marked, "en", None)]
    got = one(host_rules.judge(docs(spark, rows)))
    assert all(got[i]["kept"] for i in range(100))  # marked or not, on a host that seldom is
    assert [got[1000 + i]["kept"] for i in range(100)] == [i >= 40 for i in range(100)]
    assert got[1000]["host_broken"] == ["symbols"] and got[5000]["kept"]


def test_host_rates_equal_a_plain_computation(spark):
    rng = np.random.default_rng(3)
    rows = [(i, GOOD if rng.random() > p else "short", "en", h) for h, p in (("a", 0.1), ("b", 0.4), ("c", 0.7)) for i in range(50)]
    measured = host_rules.metrics(docs(spark, rows))
    got = {r["host"]: r for r in host_rules.host_rates(measured).collect()}
    bad = {h: [sum(r[1] == "short" for r in rows if r[3] == h), 50] for h in "abc"}
    rates = [f / n for f, n in bad.values()]
    m, v = np.mean(rates), np.var(rates, ddof=1)
    strength = min(1e6, max(1, m * (1 - m) / v - 1))
    for h, (f, n) in bad.items():
        assert got[h]["rate_base"] == pytest.approx((f + m * strength) / (n + strength)) and got[h]["mean_base"] == pytest.approx(m)


def test_simhash(spark, odd):
    got = simhash.near_duplicates(odd)
    assert got.count() == 9 and set(got.columns) == {"doc_id", "fingerprint", "component_id"}
    got = one(got)
    assert got[1]["fingerprint"] == got[2]["fingerprint"] == "0" * 16 and got[3]["component_id"] == 1
    assert got[6]["component_id"] == 5
    assert simhash.near_duplicates(odd.limit(0)).count() == 0
    nobody = docs(spark, [(None, "a b c", "en", "a")])
    assert simhash.near_duplicates(nobody).first()["component_id"] is None


def test_every_close_pair_shares_a_home_anchor():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**64, 500, dtype=np.uint64)
    for bits in range(4):
        y = x.copy()
        for _ in range(bits):
            y ^= np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64)
        r, k, home = simhash.anchors(x)
        at_home = {(int(i), int(a)) for i, a, h in zip(r, k, home) if h}
        r, k, _ = simhash.anchors(y)
        met = {i for i, a in zip(r.tolist(), k.tolist()) if (i, a) in at_home}
        assert met == set(range(len(x)))


def test_hot_anchors_lose_no_link(spark):
    rng = np.random.default_rng(2)
    base = int(rng.integers(0, 2**62))
    fps = {base} | {base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 60, (300, 2))}
    chain, step = base ^ ((1 << 40) - 1), 0
    for step in range(5):
        chain ^= 0b111 << 3 * step
        fps.add(chain)
    fps = sorted(fps)
    df = spark.createDataFrame([(x, [x]) for x in fps], "node long, fps array<long>")
    for cell in (4096, 16):
        got = dict(tuple(r) for r in graph.connected_components(simhash.link_nodes(df, cell)).collect())
        want = {}
        from tests.llm.test_llm_queries import slow_components

        comp = slow_components(fps, fps)
        for x, c in zip(fps, comp):
            want[x] = c
        assert {x: got.get(x, x) for x in fps} == want


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7), (None, 3)]
    got = dict(tuple(r) for r in graph.connected_components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert {got[i] for i in range(61)} == {0} and {got[1000 + i] for i in range(50)} == {1000} and len(got) == 111
    assert graph.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_keep_one(spark, odd):
    words = [f"w{i}" for i in range(400)]
    near = words.copy()
    near[200] = "other"
    rows = [
        (1, " ".join(words), "en", "a"),
        (2, " ".join(near), "en", "a"),
        (3, " ".join(words), "en", "a"),
        (4, " ".join(f"v{i}" for i in range(400)), "en", "a"),
        (4, " ".join(f"v{i}" for i in range(400)), "en", "a"),
        (None, "q", "en", "a"),
    ]
    got = simhash.keep_one(docs(spark, rows))
    assert got.columns == docs(spark, rows).columns
    assert sorted((r["doc_id"] or 0) for r in got.collect()) == [0, 1, 4]
    assert simhash.keep_one(odd.limit(0)).count() == 0


def test_sketch_estimates_similarity():
    a = [f"w{i}" for i in range(1000)]
    b = a.copy()
    for i in range(0, 1000, 40):
        b[i] = "x"
    sh = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    true = len(sh(a) & sh(b)) / len(sh(a) | sh(b))
    x, y = (simhash.sketch(" ".join(w).encode()) for w in (a, b))
    assert abs(simhash.estimated(x[2], y[2]) - true) < 0.1 and simhash.estimated(x[2], x[2]) == 1.0
    assert simhash.sketch(None)[1] == [0] * (1 + simhash.TABLES) and simhash.estimated(simhash.sketch(None)[2], simhash.sketch(b"")[2]) == 1.0


def test_copies_that_are_like_their_base_only_are_all_linked(spark):
    """Same words in another order: the word fingerprints of all are equal, but two copies are less alike than either and the base."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(400)]
    rows = [(0, " ".join(base), "en", "a")]
    for n in range(1, 41):
        words = base.copy()
        for i in rng.choice(39, 3, replace=False) * 10 + 5:
            words[i], words[(i + 200) % 400] = words[(i + 200) % 400], words[i]
        rows.append((n, " ".join(words), "en", "a"))
    sketches = [simhash.sketch(r[1].encode()) for r in rows]
    bits = lambda x, y: [(p ^ q).bit_count() for p, q in zip(x[1], y[1])]
    comp, apart = list(range(len(rows))), 0
    for i, x in enumerate(sketches):
        for j, y in enumerate(sketches[:i]):
            near, alike = bits(x, y), simhash.estimated(x[2], y[2]) >= simhash.SIMILARITY
            apart += not alike
            if near[0] <= 3 or min(near[1:]) <= 3 and alike:
                comp = [min(comp[i], comp[j]) if c in (comp[i], comp[j]) else c for c in comp]
    assert apart > 400 and comp.count(0) > 30
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_groups(docs(spark, rows)).collect()}
    assert got == dict(enumerate(comp))
    assert sorted(r["doc_id"] for r in simhash.keep_one(docs(spark, rows)).collect()) == sorted(set(comp))


def edited(rng, words, n):
    """With n other words at the end, which changes the words more than the shingles."""
    return [*words[: len(words) - n], *(f"e{rng.integers(1e9)}" for _ in range(n))]


def far_but_alike(a, b):
    """Alike by the estimate, though no fingerprint is within the threshold."""
    x, y = (simhash.sketch(" ".join(w).encode()) for w in (a, b))
    return min((p ^ q).bit_count() for p, q in zip(x[1], y[1])) > simhash.THRESHOLD and simhash.estimated(x[2], y[2]) >= simhash.SIMILARITY


def test_alike_texts_are_linked_however_far_their_fingerprints(spark):
    rng = np.random.default_rng(8)
    rows, far = [], 0
    for group, size in enumerate((3, 6, 20, 60, 150, 400, 2000) * 4):
        base = [f"g{group}w{rng.integers(size)}" for _ in range(size)]
        copies = [base, *(edited(rng, base, max(1, size // 13)) for _ in range(4))]
        far += sum(far_but_alike(base, x) for x in copies[1:])
        rows += [(5 * group + i, " ".join(x), "en", "a") for i, x in enumerate(copies)]
    sketches, comp = [simhash.sketch(r[1].encode()) for r in rows], list(range(len(rows)))
    for i, x in enumerate(sketches):
        for j, y in enumerate(sketches[:i]):
            if (x[1][0] ^ y[1][0]).bit_count() <= 3 or simhash.estimated(x[2], y[2]) >= simhash.SIMILARITY:
                assert simhash.estimated(x[2], y[2]) < simhash.SIMILARITY or set(x[3].tolist()) & set(y[3].tolist())
                comp = [min(comp[i], comp[j]) if c in (comp[i], comp[j]) else c for c in comp]
    assert far > 10
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_groups(docs(spark, rows)).collect()}
    assert got == dict(enumerate(comp))


def test_texts_that_become_alike_are_compared_whole(spark):
    """Earlier texts differ by long passages; what stays of them is alike, though no fingerprint is within the threshold."""
    rng = np.random.default_rng(9)
    rows, earlier = [], []
    while len(rows) < 20:
        base = [f"w{rng.integers(1e9)}" for _ in range(200)]
        copy = edited(rng, base, 16)
        if far_but_alike(base, copy):
            for words in (base, copy):
                rows.append((len(rows), " ".join(words), "en", "a"))
                earlier.append((len(earlier), " ".join([*words, *(f"x{rng.integers(1e9)}" for _ in range(300))])))
    got = simhash.keep_one(docs(spark, rows), spark.createDataFrame(earlier, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in got.collect()) == list(range(0, 20, 2))


def test_bands_of_many_nodes_are_dealt_whole(spark):
    df = spark.createDataFrame([(i, [i % 2, 1000 + i // 3]) for i in range(90)], "node long, bands array<long>")
    for cell in (4096, 16):
        blocks = {}
        for r in simhash.band_blocks(df, cell).collect():
            blocks.setdefault(r["block"], set()).add(r["node"])
        met = {(x, y) for b in blocks.values() for x in b for y in b if x < y}
        assert met == {(x, y) for x in range(90) for y in range(x + 1, 90) if x % 2 == y % 2 or x // 3 == y // 3}
        assert max(map(len, blocks.values())) <= (45 if cell > 45 else 40)


@pytest.mark.parametrize("least", [0.05, 0.5, 0.7, 0.75, 0.8, 0.9, 0.99, 1.0])
def test_sketches_as_alike_as_asked_share_a_band(least):
    """With the fewest filled slots and with all, standing together as closely as they can."""
    rng, width = np.random.default_rng(4), simhash.band_width(least)
    for n in (*range(1, 20), 64, 255, 256):
        low = np.full(simhash.SLOTS, simhash.NOTHING)
        low[:n] = rng.integers(0, 2**60, n)
        other = low.copy()
        differ = int(np.floor((1 - least) * n + 1e-9))
        other[np.linspace(0, n - 1, differ).astype(int)] = 7
        assert set(simhash.bands(low, width).tolist()) & set(simhash.bands(other, width).tolist())


def test_url_parts(spark):
    urls = [
        None,
        "",
        "no scheme",
        "HTTP://A.Net",
        "x://a.net/p?q#f",
        "http://a.net?x=/y",
        "a://b://c/d",
        "http://éx.net/ü\n/z#",
        "http://notnet/",
        "https://example.net/en/x",
        "https://EXAMPLE.NET/de",
    ]
    df = spark.createDataFrame([(i, u, "v", "r") for i, u in enumerate(urls)], "page_id long, url string, verdict string, rule string")
    none = spark.createDataFrame([], "tokens array<string>, blocked boolean")
    got = {r["page_id"]: tuple(r)[1:5] for r in url_rules.judge(df, none).collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("a.net", "", None, "allow")
    assert got[4] == ("a.net", "/p", "net/", "block")
    assert got[5][:3] == ("a.net", "", None)
    assert got[6][:2] == ("b:", "//c/d")
    assert got[7][:3] == ("éx.net", "/ü\n/z", "net/")
    assert got[8] == ("notnet", "/", None, "allow")
    assert got[9][2:] == ("example.net/en/", "allow") and got[10][2:] == ("net/", "block")
    assert url_rules.judge(df.limit(0), none).count() == 0


def test_mined_rules_block_their_like(spark):
    rows = [(i, f"http://spam{i % 2}.example.org/buy/{i}" if i % 2 else f"http://fine.example.org/read/{i}") for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, 0 if i % 2 else 1, None) for i in range(0, 40)] + [(None, 0, 1), (1, 0, 0)], "doc_id long, quality int, toxic int")
    got = {r["page_id"]: r["verdict"] for r in url_rules.judge(pages, url_rules.page_labels(pages, labels), support=0.1).collect()}
    assert all(got[i] == ("block" if i % 2 else "allow") for i in range(60))


def brute_bound(k, n, z=1.64):
    p = k / n
    return (p + z * z / (2 * n) - z * (p * (1 - p) / n + z * z / (4 * n * n)) ** 0.5) / (1 + z * z / n)


def brute_rules(rows, floor, confidence):
    """Every token set of up to four tokens, counted on every row."""
    from itertools import combinations

    tokens = sorted({t for s, _ in rows for t in s})
    found = {}
    for size in range(1, 5):
        for needed in combinations(tokens, size):
            hit = [b for s, b in rows if set(needed) <= s]
            if sum(hit) >= floor and (bound := brute_bound(sum(hit), len(hit))) >= confidence:
                if not any(set(x) < set(needed) and y >= bound for x, y in found.items()):
                    found[needed] = bound
    return found


def test_mined_rules_and_verdicts_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    rows = []
    for _ in range(300):
        s = {t for t in "abcdefg" if rng.random() < 0.4} | {"z"}
        rows.append((s, bool(rng.random() < (0.95 if {"a", "b"} <= s or {"c", "d", "e"} <= s else 0.15))))
    labelled = spark.createDataFrame([(sorted(s), b) for s, b in rows] + [(None, True), (["a"], None)], "tokens array<string>, blocked boolean")
    want = brute_rules(rows, 5, 0.7)
    got = {tuple(r["tokens"]): r for r in url_rules.mine(labelled).collect()}
    assert set(got) == set(want) and len(want) > 1
    for t, r in got.items():
        assert r["confidence"] == pytest.approx(want[t]) and r["support"] == pytest.approx(sum(b and set(t) <= s for s, b in rows) / 300)
        assert r["rarest"] == min(t, key=lambda x: (sum(x in s for s, _ in rows), x))
    urls = [(i, f"http://x/?{'&'.join(sorted(s))}") for i, (s, _) in enumerate(rows)]
    of = lambda s: {f"q={x}" for x in s}
    pages = spark.createDataFrame(urls, "page_id long, url string")
    by_url = pages.select("page_id", url_rules.tokens_of(F.col("url")).alias("tokens")).join(
        spark.createDataFrame([(i, b) for i, (_, b) in enumerate(rows)], "page_id long, blocked boolean"), "page_id"
    )
    verdicts = {r["page_id"]: r["verdict"] for r in url_rules.judge(pages, by_url).collect()}
    assert all((verdicts[i] == "block") == any(of(w) <= of(s) for w in want) for i, (s, _) in enumerate(rows))


def planted_long(rng):
    """Of eight tokens five together tell, none fewer."""
    for _ in range(600):
        s = {t for t in "abcdefgh" if rng.random() < 0.75}
        yield s, bool(rng.random() < (0.99 if s >= set("abcde") else 0.2))


def planted_wide(rng):
    """Of twenty-two tokens two together tell; each of them alone tells less than any of the twelve that stand with them."""
    for i in range(400):
        noise = {t for t in "abcdefghijklmnopqrst" if rng.random() < (0.6, 0, 0, 0.2)[i % 4]}
        yield noise | ({"y", "z"}, {"y"}, {"z"}, set())[i % 4], i % 4 == 0 or i % 8 == 3


@pytest.mark.parametrize("planted, floor, told", [(planted_long, 12, "abcde"), (planted_wide, 30, "yz")])
def test_long_rules_and_those_of_urls_of_many_tokens_are_mined(spark, planted, floor, told):
    from itertools import combinations, count

    rows, want = [(frozenset(s), b) for s, b in planted(np.random.default_rng(3))], {}
    for size in count(1):
        hits = {x: [b for s, b in rows if x <= s] for x in map(frozenset, combinations(sorted(set().union(*(s for s, _ in rows))), size))}
        hits = {x: h for x, h in hits.items() if sum(h) >= floor}
        if not hits:
            break
        better = {x: y for x, h in hits.items() if (y := brute_bound(sum(h), len(h))) >= 0.7}
        want |= {x: y for x, y in better.items() if not any(x > w and z >= y for w, z in want.items())}
    labelled = spark.createDataFrame([(sorted(s), b) for s, b in rows], "tokens array<string>, blocked boolean")
    got = {frozenset(r["tokens"]): r for r in url_rules.mine(labelled, least_rows=floor).collect()}
    assert set(got) == set(want) and frozenset(told) in want
    for t, r in got.items():
        assert r["confidence"] == pytest.approx(want[t]) and r["size"] == len(t)
        assert r["rarest"] == min(t, key=lambda x: (sum(x in s for s, _ in rows), x))


def test_mined_verdicts_equal_sql(spark, tmp_path):
    import duckdb

    from talkloom.llm.queries import ORACLE_SQL, QUERIES

    rng, pages, labels = np.random.default_rng(4), [], []
    for i in range(400):
        host, word, key = rng.choice(["a.org", "B.com", "www.c.net", "d.example.org"]), rng.choice(["buy", "read", "fr"]), rng.choice(["x=1", "y=2", ""])
        pages.append((i, f"https://{host}/{word}/{i}.html?{key}&id={i}#top" if i % 50 else None if i else "no scheme"))
        if i % 3:
            bad = rng.random() < (0.97 if word == "buy" and key == "x=1" or host == "B.com" else 0.1)
            labels.append((i, int(not bad), 0))
    labels += [(None, 0, 1), (1, None, None)]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    con = duckdb.connect()
    for name in ("pages", "labels"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = sorted(con.sql(ORACLE_SQL["op4_url_filters"]).fetchall(), key=lambda r: r[0])
    got = sorted((tuple(r) for r in QUERIES["op4_url_filters"](spark, str(tmp_path)).collect()), key=lambda r: r[0])
    assert got == want
    mined = [r[4] for r in got if r[3] is None]
    assert 50 < mined.count("block") < len(mined) - 50


def test_few_labels_make_no_rules_and_many_parameters_no_explosion(spark):
    import time

    long = [f"q=k{i}" for i in range(40)]
    few = spark.createDataFrame([(long, True)] * 3 + [(["h=a"], False)] * 80, "tokens array<string>, blocked boolean")
    assert url_rules.mine(few).count() == 0
    began = time.perf_counter()
    many = spark.createDataFrame([(long, True)] * 30 + [(["h=a"], False)] * 80, "tokens array<string>, blocked boolean")
    rules = url_rules.mine(many).collect()
    assert time.perf_counter() - began < 60 and {r["size"] for r in rules} == {1} and 1 <= len(rules) <= 40
    assert url_rules.mine(few.limit(0)).count() == 0


def brute_top(rows, k):
    ok = [
        (i, tuple(int(x) for x in np.floor(256 * np.asarray(v, float))))
        for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(256 * np.asarray(v, float)).all()
    ]
    out = []
    for q, x in {(i, v) for i, v in ok if i % 5 == 0}:
        best = sorted((-sum(a * b for a, b in zip(x, v)), i) for i, v in ok if i != q and len(v) == len(x))[:k]
        out += [(q, n + 1, i, -s if -(1 << 63) <= -s < 1 << 63 else None) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("n", [1, 4, 60, 400])
def test_top_k_equals_brute_force(spark, n):
    rng = np.random.default_rng(n)
    rows = [(i, [float(x) for x in rng.normal(size=2)] if i % 9 else [0.5, 0.5]) for i in range(n)]
    rows += [(100_000, None), (100_001, [None, 1.0]), (100_002, [float("nan"), 1.0]), (100_003, []), (None, [1.0, 1.0]), *rows[:2]]
    rows += [(100_005, [1.0, 2.0, 3.0]), (100_006, [3.0, 2.0, 1.0])]  # another dimension
    df = spark.createDataFrame([(*r, 1, 1) for r in rows], "vec_id long, embedding array<double>, rank int, score int")
    got = metric_tree.top_k(df, lambda c: c % 5 == 0, tops=3, page=4, node_bytes=16 * 16)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 5)


@pytest.mark.parametrize("large", [2e6, 5e6, 2e7, 3e7, 1e9, 1e15, 1e30, 1e160, 1e300])
def test_top_k_of_vectors_of_any_size(spark, large):
    rng = np.random.default_rng(11)
    rows = [(i, [float(x) for x in rng.normal(size=4) * (large if i % 7 == 0 else 1)]) for i in range(300)]
    rows += [(1000, [1e9, 1.0, 0.0, 0.0]), (1005, [1e9, 1.0, 0.0, 0.0]), (1010, [1e308, 0.0, 0.0, 0.0]), (1015, [0.0] * 4), (1020, []), (1021, []), (1025, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = metric_tree.top_k(df, lambda c: c % 5 == 0, tops=4, page=4, node_bytes=16 * 32)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute_top(rows, 5), key=str)


def test_keys_of_scores_compare_as_scores_do():
    rng = np.random.default_rng(12)
    scores = sorted({0, 1, -1, 255, 256, -255, -256, *(int(x) ** p * s for x in rng.integers(1, 1 << 60, 50) for p in (1, 2, 9) for s in (1, -1))})
    keys = [metric_tree.order_key(x) for x in scores]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)


def test_top_k_of_one_vector_that_fills_a_third(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [0.25, -0.5] if i % 3 == 0 else [float(x) for x in rng.normal(size=2)]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = metric_tree.top_k(df, lambda c: c % 5 == 0, tops=4, page=4, node_bytes=16 * 16)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 5)


def test_nodes_spare_computations_and_lose_nothing():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 8)) * 400
    vectors = np.floor(np.repeat(centres, 100, axis=0) + rng.normal(size=(4000, 8)) * 4).astype(np.int64)
    vectors *= 1000 // max(1, int(np.sqrt((vectors**2).sum(axis=1)).mean()) // 100)
    norm = int((vectors**2).sum(axis=1).max())
    node = metric_tree.Node.build(list(range(4000)), vectors, norm, 64)
    places = {i: p for p, i in enumerate(node.ids)}
    for i, (a, b) in enumerate(zip(node.starts, [*node.starts[1:], 4000])):  # what is stored holds
        lifted = metric_tree.lift(node.vectors, norm)
        assert np.allclose(metric_tree.distances(lifted[a:b], lifted[[node.centres[i]]])[:, 0], node.inner[a:b]) and node.radii[i] == node.inner[a:b].max()
    own = list(range(0, 4000, 50))
    queries, computed = node.vectors[[places[i] for i in own]], []
    got = node.search(queries, own, np.full(len(own), np.inf), norm, 5, computed)
    for j, i in enumerate(own):
        scores = node.vectors @ queries[j]
        want = sorted((-int(s), node.ids[p]) for p, s in enumerate(scores) if node.ids[p] != i)[:5]
        assert [(-s, node.ids[p]) for q, p, s in got if q == j] == want
    assert sum(computed) < 0.5 * len(own) * 4000


def test_top_k_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert metric_tree.top_k(df, lambda c: c % 5 == 0).count() == 0


def test_mixing(spark, odd):
    got = mixing.mix(odd)
    assert got.count() == 9 and mixing.mix(odd.limit(0)).count() == 0
    t = got.toPandas()
    assert (t["taken"] <= 2 * t["size"]).all() and t[t["size"] == 0]["taken"].sum() == 0


def test_mixing_targets_are_reshared(spark):
    rows = [(i, "w " * 10, "en", s) for i, s in enumerate("a" * 10 + "b" * 10 + "c" * 80)]
    t = mixing.mix(docs(spark, rows)).toPandas()
    by = t.groupby("source_size")["target"].first()
    assert by[100] == 200.0  # the cap of both small sources
    assert by[800] == 1500 - 400
    assert abs(t.groupby("source_size")["taken"].sum()[800] - 1100) <= 1
    whole = mixing.mix(docs(spark, rows), whole=True).toPandas()
    assert (whole["taken"] % 10 == 0).all() and abs(whole["taken"].sum() - 1500) <= 30


def brute_mix(rows, labels, whole):
    """Keys, epochs and parts of each document, source after source."""
    import math

    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_, budget = {}, set(order), 1.5 * sum(sizes.values())
    while True:  # the excess over the cap is shared anew until none is above
        level = (budget - sum(2 * sizes[s] for s in order if s not in open_)) / max(1, sum(weight[s] for s in open_))
        over = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not over:
            break
        open_ -= over
    for s in order:
        target[s] = round(level * weight[s], 6) if s in open_ else 2.0 * sizes[s]
    out = []
    for s in order:
        mine = []
        for i, t, src in rows:
            if src == s:
                text_key = hashlib.md5((t or "").encode()).hexdigest()
                u = (int(hashlib.md5(f"{'' if i is None else i}|{text_key}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48
                q = labels.get(i)
                w = 1.0 if q is None else 0.5 + 1.5 * q
                mine.append((round(-math.log(u) / w, 12), i, len((t or "").split())))
        goal, before = math.floor(target[s]), 0
        epochs = goal // sizes[s] if sizes[s] else 0
        for _, i, size in sorted(mine):
            left = goal - epochs * sizes[s] - before
            part = (size if left >= size or 2 * left >= size and left > 0 else 0) if whole else max(0, min(size, left))
            out.append((i, size, epochs * size + part))
            before += size
    return sorted(out)


@pytest.mark.parametrize("whole", [False, True])
def test_mixing_equals_brute_force(spark, whole):
    rng = np.random.default_rng(5)
    rows = [(i, "w " * int(rng.integers(0, 60)), s) for i, s in enumerate(rng.choice(["a", "b", "c", "d", ""], 400))]
    labels = {i: i % 2 for i in range(0, 400, 3)}
    quality = spark.createDataFrame(list(labels.items()), "doc_id long, quality int")
    got = mixing.mix(docs(spark, [(i, t, "en", s) for i, t, s in rows]), quality, whole=whole, slice_rows=20)
    assert sorted((r["doc_id"], r["size"], r["taken"]) for r in got.collect()) == brute_mix(rows, labels, whole)


def test_quality_weights_draw_more(spark):
    rows = [(i, f"w{i} " * 10, "en", s) for i, s in enumerate("a" * 400 + "b" * 10)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(0, 0), (None, 1)], "doc_id long, quality int")
    t = mixing.mix(docs(spark, rows), labels, budget=0.5).toPandas()
    t = t[(t["doc_id"] < 400)]
    assert t[t["doc_id"] % 2 == 1]["taken"].sum() > 1.5 * t[t["doc_id"] % 2 == 0]["taken"].sum()


def brute_lines(rows):
    keys = {}
    strip = " \t\n\x0b\x0c\r"
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(strip))
    for i, t in rows:
        for x in (t or "").split("\n"):
            if i is not None and len(key(x)) >= 40:
                keys.setdefault(key(x), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if i is None or len(keys.get(key(x), ())) < 5 or max(keys[key(x)]) == i]
        out.append((-1 if i is None else i, len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("batches", "fanout"), [(1, 2), (3, 2), (7, 3)])
def test_line_dedup_equals_brute_force(spark, batches, fanout):
    rows = [(i, f"own {i}\n  {LINE.upper() if i % 2 else LINE}\t\n\nshort\n{LINE}") for i in range(8)] + [(i, "É" * 40 + "\n" + "é" * 40 + "\nx") for i in range(3, 9)] + [
        (20, None), (21, ""), (22, "\n"), (None, LINE), (3, LINE), (30, LINE[:39]), (31, "y" * 70_000)
    ]
    df = docs(spark, [(i, t, "en", "a") for i, t in rows])
    got = line_dedup.dedup_lines(df, batches, fanout).select(F.coalesce("doc_id", F.lit(-1)), "__n_lines", "__n_dropped", F.sha2("text", 256))
    assert sorted(map(tuple, got.collect())) == brute_lines(rows)
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_runs_are_compacted_and_decide(spark, tmp_path):
    store = line_dedup.RunStore(spark, 2)
    batch = lambda ids: spark.createDataFrame([(1, 1, i) for i in ids] + [(i, 2, i) for i in ids], "h1 long, h2 long, doc_id long")
    gone, rest = store.add(batch([1, 2, 8]))
    assert gone is None and rest.count() == 6 and store.settled().count() == 0
    gone, _ = store.add(batch([3, 5, 9]))  # two runs of three documents settle the line when they are compacted
    assert gone.count() == 0 and {level: len(r) for level, r in store.levels.items() if r} == {1: 1}
    assert [tuple(r) for r in store.settled().collect()] == [(1, 1, 9)]
    gone, rest = store.add(batch([4, 6, 20]))
    assert sorted(tuple(r) for r in gone.collect()) == [(1, 1, 4), (1, 1, 6)]
    assert sorted(tuple(r) for r in rest.collect()) == [(1, 1, 20), (4, 2, 4), (6, 2, 6), (20, 2, 20)]
    store.save(f"{tmp_path}/runs")
    again = line_dedup.RunStore.load(spark, f"{tmp_path}/runs", 2)
    gone, _ = again.add(batch([7, 30]))
    assert [tuple(r) for r in gone.collect()] == [(1, 1, 7)]
    totals = {(r["h1"], r["h2"]): (r["n"], r["last"]) for r in again.totals().collect()}
    assert totals[1, 1][0] >= 5 and totals[1, 1][1] == 30 and totals[20, 2] == (1, 20)


def test_batches_grow_with_the_rows():
    assert [line_dedup.batches_of(n) for n in (0, 1, 1 << 19, 1 << 22, 1 << 30)] == [2, 2, 2, 4, 12]


def test_documents_of_very_many_dropped_lines(spark):
    import time

    text = "\n".join(f"line number {i:06d} that is shared by all of the documents" for i in range(20_000))
    df = docs(spark, [(i, text, "en", "a") for i in range(6)])
    began = time.perf_counter()
    got = {r["doc_id"]: r["__n_dropped"] for r in line_dedup.dedup_lines(df).collect()}
    assert got == {**dict.fromkeys(range(5), 20_000), 5: 0}
    assert time.perf_counter() - began < 60


def test_language(spark, odd):
    model = language.fit(odd, F.lit(True))
    got = one(language.predict(odd, model, spans=True))
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 and got[i]["spans"] == [] for i in (1, 2, 3, 7))
    assert got[5]["lang_pred"] == "en"
    none = language.fit(odd.limit(0), F.lit(True))
    assert {r["lang_pred"] for r in language.predict(odd, none).collect()} == {"und"}
    kept = language.reject(odd, model)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} <= {None, 4, 5, 6}


def brute_path(scores, switch):
    from itertools import product

    best = max(
        product(range(scores.shape[1]), repeat=len(scores)),
        key=lambda p: sum(scores[i, x] for i, x in enumerate(p)) - switch * sum(a != b for a, b in zip(p, p[1:])),
    )
    return list(best)


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(60):
        s = rng.normal(size=(7, 3)) * 3
        got = list(language.label_words(s, 2.0))
        value = lambda p: sum(s[i, x] for i, x in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:]))
        assert value(got) == pytest.approx(value(brute_path(s, 2.0)))


def test_spans_of_mixed_text_and_scripts(spark):
    rows = [(i, "the cat sat on the mat with them", "en", "a") for i in range(5)] + [
        (i, "der hund und die katze sind nicht hier", "de", "a")
        for i in range(5, 10)
    ] + [(i, "это просто русский текст", "ru", "a") for i in range(10, 15)]
    model = language.fit(docs(spark, rows), F.lit(True))
    lang, score, spans = language.identify("the cat sat on the mat with them der hund und die katze sind nicht hier это русский", model, 4.0)
    assert [s[0] for s in spans] == ["en", "de", "ru"] and spans[0][2] == 8
    assert language.identify("русский cat", model)[0] == "ru"


def test_scripts_are_code_point_ranges():
    names = list(language.SCRIPTS)
    of = lambda text: [names[i] for i in language.grams(text)[2]]
    assert of("abc ạ где ไทย हिन्दी საქართველო 漢字 かな 한국 αβγ") == [
        "latin", "latin", "cyrillic", "thai", "devanagari", "georgian", "han", "kana", "hangul", "greek"
    ]
    code, begins, _, any_letter = language.grams("a — b ’ 12 «c» ¿d")
    assert len(begins) == 4 and len(code) == 4 and any_letter  # dashes, quotes and digits are no letters
    assert language.grams("12 — ’ !")[3] is False


def test_long_texts_are_scored_in_pieces(spark, monkeypatch):
    rows = [(i, "the cat sat on the mat with them", "en", "a") for i in range(5)] + [
        (i, "der hund und die katze sind nicht hier", "de", "a")
        for i in range(5, 10)
    ]
    model = language.fit(docs(spark, rows), F.lit(True))
    text = "the cat sat on the mat " * 40 + "der hund und die katze sind nicht " * 30
    whole = language.identify(text, model, 4.0)
    cut_up = list(language.pieces_of(text, 64))
    assert "".join(cut_up) == text and len(cut_up) > 20
    monkeypatch.setattr(language, "STEP", 7)
    monkeypatch.setattr(language, "pieces_of", lambda t: iter(cut_up))
    in_pieces = language.identify(text, model, 4.0)
    assert in_pieces[0] == whole[0] and in_pieces[2] == whole[2] and in_pieces[1] == pytest.approx(whole[1])


def test_sample_is_bounded_where_ids_are_null(spark):
    rows = [(None, f"word{i} of the", "en", "a") for i in range(50)] + [(None, "same of the", "en", "a")] * 50
    model = language.fit(docs(spark, rows), F.lit(True), sample=10)
    assert model.languages == ["en"] and language.fit(docs(spark, rows[:0]), F.lit(True)).languages == []


def test_quality_model(spark, odd):
    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 0), (6, None), (None, 1)], "doc_id long, quality int")
    model = quality_model.fit(odd, labels, F.lit(True))
    scores = [r["score"] for r in quality_model.score(odd, model).collect()]
    assert len(scores) == 9 and all(0 <= s <= 1 for s in scores)
    none = quality_model.fit(odd, labels.limit(0), F.lit(True))
    assert {r["score"] for r in quality_model.score(odd, none).collect()} == {0.5}
    assert quality_model.score(odd.limit(0), none).count() == 0


def test_contexts_equal_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(["ab", "Cd", "ef.", "x1", "gone"], 40)) for _ in range(30)] + [None, ""]
    df = docs(spark, [(i, t, "en", "a") for i, t in enumerate(texts)]).repartition(20)
    df_of, n = quality_model.document_counts(df, "text")
    assert n == 32 and df_of[b"ab"] == sum("ab" in (t or "").split() for t in texts)
    terms = [b"Cd", b"ab", b"ef.", quality_model.shape(b"x1")]  # "gone" is no term, nor its shape
    place, index = {t: i for i, t in enumerate(terms)}, np.stack([quality_model.index_vector(t) for t in terms])
    want = np.zeros(index.shape)
    for t in texts:
        ids = [i for w in (t or "").split() if (i := place.get(w.encode(), place.get(quality_model.shape(w.encode())))) is not None]
        for p, i in enumerate(ids):
            for q in range(max(0, p - 2), min(len(ids), p + 3)):
                if q != p:
                    want[i] += index[ids[q]]
    monkeypatch.setattr(quality_model, "SUMMED", 3)
    assert np.allclose(quality_model.contexts(df, "text", place, index), want)


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    z = rng.normal(size=4000) * 2
    y = (rng.random(4000) < 1 / (1 + np.exp(-z))).astype(float)
    assert abs(quality_model.fit_temperature(3 * z, y) - 3) < 0.5


PAGES = [
    (None, ""),
    ("", ""),
    ("plain text, no markup", "plain text, no markup"),
    ("<p>One.<p>Two &amp; three&nbsp; x", "One.\n\nTwo & three x"),
    ("<script>var a='<p>no</p>'</script><style>p{}</style><p>Yes, it is.</p><!-- <p>no</p> -->", "Yes, it is."),
    (
        "<nav><a href=x>Menu</a></nav><main><h2>Head</h2><p>Body text, with a comma.</p></main><aside>Side, bar.</aside><footer>Foot</footer>",
        "Head\n\nBody text, with a comma.",
    ),
    (
        "<article><h1>T</h1><div class='ad-banner'>Buy, now. It is cheap, really.</div><p>Text of the article, long enough.</p><div id=comments><p>I like it, a lot. Really.</p></div></article>",
        "T\n\nText of the article, long enough.",
    ),
    ("<p>a<br>b</p><form><input value=x>Send</form><p hidden>no</p>", "a b"),
    ("<div>x <b>y</b>z</div><unclosed <p>w", "x yz\n\nw"),
]


@pytest.mark.parametrize(("html", "text"), PAGES)
def test_main_text(html, text):
    assert html_text.main_text(html) == text


def test_extract(spark):
    df = spark.createDataFrame(
        [(1, None, None, "x"), (None, "u", "<p>" + "a, " * 50_000, "x"), (1, None, None, "x")],
        "page_id long, url string, html string, text string",
    )
    got = html_text.extract(df)
    assert sorted(r["n_chars"] for r in got.collect()) == [0, 0, 149_999]
    assert html_text.extract(df.limit(0)).count() == 0
