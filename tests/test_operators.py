"""Operators on small hand-made artifacts, one row for each trap."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkloom.operators import aggregates, alignment, chunks, hashes, links, matching, ordering, reports, retrieval, sessions, turns, validation
from talkloom.schemas import ddl, schema, to_json_schema


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def make_sessions(spark):
    data = [
        ("Kubernetes <b>at</b> scale", "abs one", [("Ann Lee", "Engineer, Acme"), ("Bob Ray", "(Independent)")], "Ops", "talk", "t", [], 0),
        ("kubernetes at scale", "dup", [], "Ops", "talk", "t", [], 1),
        ("  ", "blank", [], "", "", "", [], 2),
        ("Tracing with OpenTelemetry - Ann Lee", "abs two", [("Ann Lee", "CTO, Acme, Acme")], "Obs", "talk", "t", [], 3),
        ("Something else entirely", "", [], "", "", "", [], 4),
    ]
    return spark.createDataFrame(data, ddl("session") + ", _pos long")


def test_clean_and_dedup(spark):
    got = sessions.dedup(sessions.normalize(make_sessions(spark)))
    assert rows(got.orderBy("_pos"), "title") == [("Kubernetes at scale",), ("Tracing with OpenTelemetry - Ann Lee",), ("Something else entirely",)]
    assert sorted(rows(sessions.dedup(got), "title")) == sorted(rows(got, "title"))


def test_coerce_accepts_all_encodings(spark):
    data = [
        ("", "Named", None, "desc", '"A, B"', None, "Room", "f", None, "9:00", None),
        ("T", None, "a", None, '["A", "B"]', "Tr", None, "", "t", None, ["x"]),
        ("T2", None, "a", None, '[{"name": "A", "company": "C"}, {"name": "B"}]', "", "", "", "", "", []),
    ]
    got = sessions.coerce(spark.createDataFrame(data, schema("raw_session")))
    first, second, third = got.collect()
    assert (first["title"], first["abstract"], first["track"], first["time"]) == ("Named", "desc", "Room", "9:00")
    assert [s["name"] for s in first["speakers"]] == ["A", "B"] == [s["name"] for s in second["speakers"]]
    assert [(s["name"], s["company"]) for s in third["speakers"]] == [("A", "C"), ("B", "")]


def test_matching_is_greedy_and_one_to_one(spark):
    s = sessions.dedup(sessions.normalize(make_sessions(spark)))
    r = spark.createDataFrame(
        [
            ("v1", "Kubernetes at scale!", 900.0, "x"),
            ("v2", "kubernetes at scale", 900.0, "y"),
            ("v3", "Something else entirely", 90.0, "short"),
            ("v4", "", 0.0, "z"),
            ("v5", "Tracing with OpenTelemetry", 0.0, "w"),
        ],
        "video_id string, title string, duration_sec double, full_text string",
    )
    got = {x["title"]: x["video_id"] for x in matching.match_recordings(s, r).collect()}
    assert got["Kubernetes at scale"] == "v1"  # the first recording takes it though the second is closer
    assert got["Tracing with OpenTelemetry - Ann Lee"] == "v5"
    assert got["Something else entirely"] is None  # its recording is too short
    assert got["kubernetes at scale"] == "v2" and got["Recording v4"] == "v4"


def test_similar_pairs_equal_brute_force(spark):
    names = ["alpha beta gamma", "alpha beta gama", "beta alpha gamma", "delta", "delt", "a", "ab", "gamma rays and more", "gamma ray and more!"]
    df = spark.createDataFrame(list(enumerate(names)), "id long, title string")
    got = {(a, b) for a, b in rows(matching.similar_pairs(df, df), "left_id", "right_id")}
    assert got == {(i, j) for i, a in enumerate(names) for j, b in enumerate(names) if matching.ratio(a, b) > 0.6}


def test_alignment(spark):
    slides = spark.createDataFrame(
        [("v", 0, 10.0, "one", ""), ("v", 1, 20.0, "", "pic")], "video_id string, pos int, ts double, text string, description string"
    )
    said = spark.createDataFrame(
        [("v", 0, 5.0, "before", None), ("v", 1, 10.0, "on", "A"), ("v", 2, 20.0, "edge", None), ("v", 3, 99.0, " ", None)],
        "video_id string, seq int, start double, text string, speaker string",
    )
    text = alignment.aligned_text(slides, said).first()["slide_aligned"]
    assert text == "[SLIDE 1 at 0m10s]\nOCR: one\n[TRANSCRIPT]\n[A] on\n\n[SLIDE 2 at 0m20s]\nVLM: pic\n[TRANSCRIPT]\nedge"


def test_fold_segments():
    fold = lambda texts, **k: [t for _, t in chunks.fold_segments(iter([(float(i), t) for i, t in enumerate(texts)]), **k)]
    assert fold(["abc", "def"], window=100, overlap=2) == ["abc def"]
    assert fold(["x" * 10], window=10, overlap=4) == ["x" * 10]  # what is carried alone gives no chunk
    two = fold(["x" * 10, "y"], window=10, overlap=4)
    assert two == ["x" * 10, "xxxx y"]
    assert fold(["abc", "d"], window=3, overlap=400) == ["abc", "d"]
    assert fold([], window=3, overlap=1) == []


def test_frames_keep_first(spark):
    a = 0
    b, c = a ^ 0b111111, a ^ 0b111111111111  # 6 from a; c is 6 from b and 12 from a
    df = spark.createDataFrame([("v", 0, a), ("v", 1, b), ("v", 2, c), ("v", 3, a ^ 0b1111111), ("w", 0, a)], "video_id string, index int, dhash long")
    # The last frame of v is 7 bits from the first but 5 from the third, which was kept.
    assert sorted(rows(hashes.dedup_frames(df), "video_id", "index")) == [("v", 0), ("v", 2), ("w", 0)]


def test_presence_counts_slots(spark):
    assert rows(aggregates.company_presence(make_sessions(spark)), "company", "n") == [("Acme", 2), ("Independent", 1)]


def test_best_evidence_keeps_the_first_of_equals(spark):
    df = spark.createDataFrame(
        [("a", "case_study", 0), ("a", "case_study", 1), ("b", "what", 2), ("", "benchmarked", 3)],
        "technology string, evidence_quality string, pos int",
    )
    assert sorted(rows(aggregates.best_evidence(df), "technology", "pos")) == [("a", 0), ("b", 2)]


def test_resolve_three_tiers(spark):
    titles = spark.createDataFrame([("A - x", 0), ("A - y", 1), ("Abcdefghij long", 2)], "title string, pos int")
    w = spark.createDataFrame([("A - y",), ("A",), ("Abcdefghij",), ("zz",), ("",)], "wanted string")
    assert dict(rows(matching.resolve_titles(w, titles), "wanted", "resolved")) == {
        "A - y": "A - y", "A": "A - x", "Abcdefghij": "Abcdefghij long", "zz": None, "": None
    }


def test_knn_prefix_property(spark):
    df = spark.createDataFrame([(f"c{i}", [1.0, float(i % 5)]) for i in range(20)], "id string, embedding array<float>")
    five, six = (rows(retrieval.nearest(df, [1.0, 2.0], k), "id") for k in (5, 6))
    assert five == six[:5]


def test_filters_before_and_after(spark):
    df = spark.createDataFrame([("a", "x", None), ("b", "x", "T"), ("c", "y", "T")], "id string, chunk_type string, track string")
    assert rows(retrieval.where_metadata(df, ["x"], "T"), "id") == [("b",)]


def test_validation(spark):
    s = spark.createDataFrame(
        [("s1", "said Ann Lee and presented by Max Muster 40% {x_y}", [("Kubernetes", "c", True), ("Nope", "c", False), ("", "c", False)])],
        "section_id string, prose string, citations array<struct<talk_title:string,claim:string,needs_quote:boolean>>",
    )
    people = aggregates.known_people(make_sessions(spark))
    grounded = spark.createDataFrame([("41%",)], "percentage string")
    titles = spark.createDataFrame([("Kubernetes at scale",)], "title string")
    got = validation.stats(s, validation.warnings(s, people, grounded, titles)).first().asDict()
    assert got == {"sections_checked": 1, "unknown_speakers": 1, "ungrounded_metrics": 1, "template_artifacts": 1, "fabricated_citations": 1, "total": 4}


def test_appendix_by_cluster(spark):
    talks = spark.createDataFrame(
        [("A", "sum", ["k"], "e", "p", ["t"], 0)],
        "title string, summary string, key_takeaways array<string>, evidence_quality string, speaker_perspective string, tools_and_projects array<string>, _pos int",
    )
    agenda = spark.createDataFrame([([("deep", "", ["A", "B"], [], []), ("brief", "", ["A"], [], [])], [], "", {}, {})], schema("agenda"))
    outline = spark.createDataFrame([("", "by_cluster", 1, [("s", "t", "cluster_deep_dive", "deep", 1, 1, "", [])])], schema("outline"))
    got = rows(reports.appendix(talks, spark.createDataFrame([], schema("ranking")), agenda, outline, "by_cluster"), "title", "cluster", "summary")
    assert got == [("A", "deep", "sum"), ("B", "deep", ""), ("A", "brief", "")]


def test_appendix_of_many_agendas_is_dealt_out(spark):
    """All rows lie at one place, none resolves but by the beginning of a title; no task may get most of them."""
    talks = spark.createDataFrame(
        [("t7 - on", "sum", ["k"], "e", "p", ["t"], 1), ("t7 - of", "late", ["k"], "e", "p", ["t"], 2), ("n8xy", "n", ["k"], "e", "p", ["t"], 3)],
        "title string, summary string, key_takeaways array<string>, evidence_quality string, speaker_perspective string, tools_and_projects array<string>, _pos int",
    )
    agenda = spark.range(400).selectExpr("array(struct('c' || id AS name, array(CASE WHEN id = 8 THEN 'n8' ELSE 't' || id END) AS talks)) AS clusters")
    outline = spark.createDataFrame([([("cluster_deep_dive", "c7"), ("cluster_deep_dive", "c8")],)], "sections array<struct<section_type: string, cluster_name: string>>")
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        got = reports.appendix(talks, spark.createDataFrame([], schema("ranking")), agenda, outline, "by_cluster")
        got = got.select("title", "cluster", "summary", F.spark_partition_id().alias("part")).collect()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert {tuple(r)[:3] for r in got} == {("t7 - on", "c7", "sum"), ("n8xy", "c8", "n")} | {(f"t{i}", f"c{i}", "") for i in range(400) if i not in (7, 8)}
    parts = [r["part"] for r in got]
    assert len(got) == 400 and max(parts.count(p) for p in set(parts)) < 200


def test_enrichment_split(spark):
    s = spark.createDataFrame(
        [("a", "cluster_deep_dive", [("t", "c", True)] * 5), ("b", "landscape", [("t", "c", True)])],
        "section_id string, section_type string, citations array<struct<talk_title:string,claim:string,needs_quote:boolean>>",
    )
    deep, rest = reports.enrichment_split(s)
    assert rows(deep, "section_id", F.size("to_quote")) == [("a", 3)] and rows(rest, "section_id") == [("b",)]


def test_keep_first_ignores_empty_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("", 2), (None, 3)], "k string, p int")
    assert rows(ordering.keep_first(df, F.col("k"), F.col("p")), "k", "p") == [("a", 0)]


def test_json_schema():
    s = to_json_schema(schema("ranking"), {"name": ("x",)})
    assert s["properties"]["rank"] == {"type": "integer"} and s["properties"]["name"]["enum"] == ["x"]


def test_resolving_takes_the_part_before_the_speaker(spark):
    titles = spark.createDataFrame([("Scaling Kube - Jane, Acme", 0), ("Scaling Kube - Other", 1)], "title string, pos int")
    w = spark.createDataFrame([("Scaling Kube - Keynote",), ("Scaling",), ("Scaling Kubernetes",)], "wanted string")
    assert dict(rows(matching.resolve_titles(w, titles), "wanted", "resolved")) == {
        "Scaling Kube - Keynote": "Scaling Kube - Jane, Acme", "Scaling": "Scaling Kube - Jane, Acme", "Scaling Kubernetes": None
    }


def test_best_titles_equal_brute_force(spark):
    import random

    rng = random.Random(3)
    vocabulary = [f"word{i}" for i in range(12)]
    pick = lambda n: " ".join(rng.choice(vocabulary[: rng.randint(3, 12)]) for _ in range(n))
    titles = [pick(rng.randint(1, 6)) for _ in range(60)]
    asked = [(i, pick(rng.randint(1, 9))) for i in range(150)] + [(999, titles[0])]
    words = lambda x: set(x.split())
    for strict in (False, True):
        want = {}
        for i, x in asked:
            mine, scored = words(x), [(-2.0, y) for y in set(titles) if y == x]
            for y in set(titles):
                n = len(mine & words(y))
                if len(mine) >= (4 if strict else 2) and n / len(mine) >= 0.5 and n >= (3 if strict else 1):
                    scored.append((-n / len(mine), y))
            if scored:
                score, title = min(scored)
                want[i] = (title, min(1.0, -score))
        got = matching.best_titles(
            spark.createDataFrame(asked, "candidate_id long, text string"),
            spark.createDataFrame([(x,) for x in titles], "title string"),
            strict,
        )
        assert {r["candidate_id"]: (r["title"], r["score"]) for r in got.collect()} == want and want


def test_containing_equals_brute_force(spark):
    longer = ["anna meier", "jo", "max muster", "joanna smith", "x"]
    shorter = ["ann", "jo", "muster", "smith ", "er", "zz", "anna meier", "m"]
    got = validation.containing(spark.createDataFrame([(x,) for x in longer], "whole string"), spark.createDataFrame([(x,) for x in shorter], "part string"))
    assert sorted(map(tuple, got.collect())) == sorted((a, b) for a in longer for b in shorter if b in a)


def test_nearest_of_each_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = [[float(x) for x in rng.normal(size=8)] for _ in range(300)]
    vectors += vectors[:20]  # ties go to the smaller id
    chunk = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)] + [(1000, None), (1001, [])], "id long, embedding array<double>")
    claims = spark.createDataFrame([(i, vectors[i]) for i in range(0, 300, 7)], "claim_id long, claim_embedding array<double>")
    old, retrieval.CLAIMS = retrieval.CLAIMS, 10
    try:
        got = {(r["claim_id"], r["nth"]): r["id"] for r in retrieval.nearest_each(claims, chunk, 4).collect()}
    finally:
        retrieval.CLAIMS = old
    unit = np.array(vectors) / np.linalg.norm(vectors, axis=1)[:, None]
    for i in range(0, 300, 7):
        order = sorted(range(len(vectors)), key=lambda j: (round(float(1 - unit[i] @ unit[j]), 12), j))[:4]
        assert [got[i, n + 1] for n in range(4)] == order


def test_one_very_long_title_among_many(spark):
    a, b = ["short title"] * 2000 + ["x" * 300], ["short titel"] * 2000 + ["x" * 200_000]
    bounds = matching.common_bounds(a, b)
    assert (bounds[:2000] >= 10).all() and bounds[2000] == 300 and isinstance(bounds, np.ndarray)


def test_components_of_a_long_path(spark):
    from talkloom.operators.components import components

    n = 300
    got = dict(rows(components(spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001)], "u long, v long"), "u", "v"), "node", "root"))
    assert {got[i] for i in range(n + 1)} == {0} and got[1001] == 1000


def test_positions_follow_the_files(spark, tmp_path):
    from talkloom.sources import artifacts

    for name, rng in (("b", range(100, 200)), ("a", range(100)), ("c", range(200, 210))):
        (tmp_path / f"{name}.json").write_text("\n".join(f'{{"title": "{i}"}}' for i in rng))
    df = artifacts.read_json(spark, str(tmp_path), "session", lines=True)
    assert [r["title"] for r in artifacts.with_position(df).orderBy("_pos").collect()] == [str(i) for i in range(210)]
    assert artifacts.with_position(df.limit(0)).count() == 0


def test_hashed_terms_equal_a_plain_computation():
    import numpy as np
    import xxhash

    from talkloom.plans import providers

    got = providers.HashedTerms().embed(["One two two three; ONE x", ""])
    want = np.zeros(providers.DIMS)
    for word, n in {"one": 2, "two": 2, "three": 1, "x": 1}.items():
        h = xxhash.xxh64_intdigest(word)
        want[h % providers.DIMS] += n if h >> 32 & 1 else -n
    assert np.allclose(got[0], want / np.linalg.norm(want)) and got[1] == [0.0] * providers.DIMS


def greedy(pairs):
    taken, out = set(), []
    for left in sorted({p[0] for p in pairs}):
        for _, right, score in sorted((-p[2], p[1], p[2]) for p in pairs if p[0] == left):
            if right not in taken:
                taken.add(right)
                out.append((left, right, score))
                break
    return sorted(out)


def test_common_bounds_of_long_texts_hold():
    rng = random.Random(3)
    texts = ["".join(rng.choices("abcde ", k=n)) for n in (0, 1, 62, 63, 64, 126, 127, 200, 400)] + ["x" * 300, "é" * 130 + "a"]

    def longest(a, b):
        row = [0] * (len(b) + 1)
        for c in a:
            was = 0
            for j, d in enumerate(b):
                was, row[j + 1] = row[j + 1], was + 1 if c == d else max(row[j + 1], row[j])
        return row[-1]

    for a in texts:
        assert list(matching.common_bounds([a] * len(texts), texts)) == [longest(a, b) for b in texts]


@pytest.mark.parametrize("n", [0, 1, 30, 200])
def test_assignment_by_rounds_is_the_sequential_one(spark, n):
    rng = random.Random(n)
    pairs = list({(rng.randrange(n), rng.randrange(n)): (rng.choice([0.7, 0.8, 0.9, rng.random()])) for _ in range(3 * n)}.items())
    pairs = [(a, b, s) for (a, b), s in pairs]
    df = spark.createDataFrame(pairs, "left_id long, right_id long, score double")
    assert sorted(rows(matching.assign(df), "left_id", "right_id", "score")) == greedy(pairs)


def test_long_chains_of_alike_titles_are_assigned(spark):
    """Each row would rather have the one before it's partner: decided in order only."""
    pairs = [(i, i, 0.8) for i in range(300)] + [(i + 1, i, 0.9) for i in range(300)]
    pairs += [(1000 + i, 1000 + j, 0.7) for i in range(20) for j in range(25)]  # titles all alike
    df = spark.createDataFrame(pairs, "left_id long, right_id long, score double")
    assert sorted(rows(matching.assign(df), "left_id", "right_id", "score")) == greedy(pairs)


@pytest.mark.parametrize("most, n", [(3, 4), (6, 4), (24, 4), (6, 40), (24, 40)])
def test_frames_without_a_place_come_last(spark, most, n):
    """Each frame is near the one beside it; they are ordered from the last to the first, which has no place."""
    step = most * 2 // 3
    hs = [0]
    for i in range(n - 1):
        hs.append(hs[-1] ^ sum(1 << (i * step + k) % 63 for k in range(step)))
    frames = [("v", n - i if i else None, h) for i, h in enumerate(hs)]
    df = spark.createDataFrame(frames, "video_id string, index int, dhash long")
    want = slow_frames([(v, at or n, h) for v, at, h in frames], most)
    assert sorted(r["dhash"] for r in hashes.dedup_frames(df, most).collect()) == sorted(h for _, _, h in want)


def slow_frames(frames, most):
    kept, out = {}, []
    for video, at, h in sorted(frames, key=lambda f: (f[0] or "", f[1], f[2] if f[2] is not None else 0)):
        mine = kept.setdefault(video, [])
        if h is None:
            out.append((video, at, h))
        elif all(bin((h ^ k) & (1 << 64) - 1).count("1") > most for k in mine):
            mine.append(h)
            out.append((video, at, h))
    return sorted(out, key=str)


@pytest.mark.parametrize("most", [0, 3, 6, 24])
def test_frames_by_rounds_are_those_of_the_fold(spark, most):
    rng, frames = random.Random(most), []
    for video, n in (("a", 250), ("b", 40), (None, 30), ("", 3)):
        base = [rng.getrandbits(64) - (1 << 63) for _ in range(4)]
        for i in range(n):
            h = rng.choice(base)
            for _ in range(rng.randrange(9)):
                h ^= 1 << rng.randrange(63)
            frames.append((video, i // 2, h))
    frames += [("a", 3, None), ("c", 0, None), ("a", 7, frames[7][2]), frames[5], (frames[9][0], frames[9][1], frames[10][2])]
    frames = list(dict.fromkeys(frames))
    df = spark.createDataFrame(frames, "video_id string, index int, dhash long")
    assert sorted(rows(hashes.dedup_frames(df, most), "video_id", "index", "dhash"), key=str) == slow_frames(frames, most)


def test_frames_that_drift_and_wait_for_each_other(spark):
    """Each frame is near the one before it: every second stays, decided in order over more rounds than are taken."""
    h, frames = 0, []
    for i in range(120):
        frames.append(("v", i, h))
        for k in range(4):
            h ^= 1 << (i * 4 + k) % 63
    df = spark.createDataFrame(frames, "video_id string, index int, dhash long")
    assert sorted(rows(hashes.dedup_frames(df), "video_id", "index", "dhash"), key=str) == slow_frames(frames, 6)
    assert hashes.dedup_frames(df.limit(0)).count() == 0


@pytest.mark.parametrize("n, step, most", [(17, 4, 6), (13, 4, 7), (13, 3, 4), (15, 4, 6)])
def test_the_last_frame_of_a_chain_that_outlasts_the_rounds(spark, n, step, most):
    """Each frame is near the next one only, so that every other stays; the last is decided when nothing is left to wait for."""
    frames = [("v", i, (1 << step * i) - 1 if step * i < 63 else -1) for i in range(n)]
    df = spark.createDataFrame(frames, "video_id string, index int, dhash long")
    assert sorted(r["index"] for r in hashes.dedup_frames(df, most).collect()) == list(range(0, n, 2))


def test_the_last_of_a_chain_within_many_bits(spark):
    """As above, with a radius at which all frames of a video meet: thirteen hashes, each within 24 bits of the next one alone."""
    rng, chain = random.Random(7), [0]
    while len(chain) < 13:
        h = chain[-1]
        for bit in rng.sample(range(63), 20):
            h ^= 1 << bit
        if all((h ^ x).bit_count() > 24 for x in chain[:-1]):
            chain.append(h)
    df = spark.createDataFrame([("v", i, h) for i, h in enumerate(chain)], "video_id string, index int, dhash long")
    assert sorted(r["index"] for r in hashes.dedup_frames(df, 24).collect()) == list(range(0, 13, 2))


def test_links_in_one_pass(spark):
    pages = [
        (1, "**A** and *A* and ***A***, A, ****A****, * see *A B*"),
        (2, "*A.B* **a** *[A](x)* **A\n** * A* *A\nB* *A*B*"),
        (3, None),
        (4, ""),
        (5, "no titles *here*"),
        (6, "**Longer A** " + "word " * 30_000 + "*A*"),
    ]
    targets = [("A", "#a", 0), ("A", "#later", 1), ("A B", "#ab", 2), ("A.B", "#$1", 3), ("Longer A", "#l", 4), ("", "#none", 5), (None, "#null", 6), ("A\nB", "#two", 7)]
    df = spark.createDataFrame(pages, "page int, text string")
    got = dict(rows(links.linked(df, spark.createDataFrame(targets, "title string, target string, pos int")), "page", "text"))
    first = {}
    for title, target, _ in targets:
        first.setdefault(title, target)
    assert got == {i: links.linked_text(t, first.get) if t else t for i, t in pages}
    assert got[1] == "**[A](#a)** and *[A](#a)* and ***[A](#a)***, A, ****A****, * see *[A B](#ab)*"
    assert got[2].startswith("*[A.B](#$1)* **a** *[A](x)*") and got[6].startswith("**[Longer A](#l)** word")


def test_turns_by_longest_overlap(spark):
    heard = [("v", 0, 0.0, 10.0), ("v", 1, 9.5, 95.0), ("v", 2, 200.0, 201.0), ("v", 3, 30.0, 30.0), ("w", 0, 0.0, 9.0), (None, 0, 0.0, 5.0)]
    said = [("v", 0.0, 4.0, "B"), ("v", 4.0, 8.0, "A"), ("v", 8.0, 50.0, "C"), ("v", 50.0, 60.0, "B"), ("v", 60.0, 96.0, "B"), ("v", 210.0, 300.0, "A"), ("v", 0.0, 300.0, None)]
    got = turns.with_speakers(
        spark.createDataFrame(heard, "video_id string, i int, start double, end double"), spark.createDataFrame(said, "video_id string, start double, end double, speaker string")
    )
    # Of B and A with 4 seconds each B began first; C has 40.5 seconds of the second segment, B 45 in two turns.
    want = [("v", 0, "B"), ("v", 1, "B"), ("v", 2, None), ("v", 3, None), ("w", 0, None), (None, 0, None)]
    assert sorted(rows(got, "video_id", "i", "speaker"), key=str) == sorted(want, key=str)


def test_token_matches_deal_out_digests_not_texts(spark):
    """Candidates are grouped by digests (an id may hold its whole text, as titles in prose do), and long ones leave before that."""
    titles = spark.createDataFrame([("alpha beta gamma delta",), ("alpha beta gamma delta",), ("epsilon zeta theta kappa",)], "title string")
    texts = ["alpha beta gamma other", "zeta", "alpha beta gamma delta", "epsilon zeta " + " ".join(f"word{i}" for i in range(2000)), "epsilon zeta theta iota", ""]
    asked = spark.createDataFrame([(i, x) for i, x in enumerate(texts)] + [(0, texts[0])], "id int, text string")
    asked = asked.select(F.struct("id", "text").alias("candidate_id"), "text")
    got = matching.best_titles(asked, titles, strict=True)
    assert "hashpartitioning(candidate_id" not in got._jdf.queryExecution().toString()
    assert sorted((r[0]["id"], r[1], r[2]) for r in got.collect()) == [(0, "alpha beta gamma delta", 0.75), (2, "alpha beta gamma delta", 1.0), (4, "epsilon zeta theta kappa", 0.75)]
