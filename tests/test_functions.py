"""Expressions against values worked out by hand."""

import pytest
from pyspark.sql import functions as F

from talkloom.functions import entities, grounding, text, time
from talkloom.operators import matching


@pytest.fixture
def value(spark):
    return lambda column: spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("given", "wanted"),
    [("Engineer, Acme", "Acme"), ("CTO, Acme, Acme", "Acme"), ("(Independent)", "Independent"), ("", ""), ("Acme", "Acme")],
)
def test_company_of_affiliation(value, given, wanted):
    assert value(text.company_of_affiliation(F.lit(given))) == wanted


def test_company_tail_keeps_parentheses(value):
    assert value(text.company_tail(F.lit("(Independent)"))) == "(Independent)"


def test_clean(value):
    assert value(text.clean(F.lit(" <b>Ｆull</b>  width\n"))) == "Full width"
    assert value(text.clean(F.lit(None).cast("string"))) == ""


def test_every_alias_becomes_its_name(spark):
    assert len(entities.CANONICAL) == 112
    rows = spark.createDataFrame([(a, n) for a, n in entities.CANONICAL.items()], "alias string, name string")
    assert rows.where(entities.canonical(F.upper("alias")) != F.col("name")).count() == 0


def test_aliases_are_replaced_in_one_pass(value):
    assert value(entities.canonical(F.lit("kube-proxy, kata containers and otel"))) == "Kubernetes-proxy, Kata Containers and OpenTelemetry"


def test_urls_sorted_and_distinct(value):
    assert value(text.urls(F.lit("see http://b.x/1) and https://a.x and http://b.x/1"))) == ["http://b.x/1", "https://a.x"]


def test_slug_and_safe_id(value):
    assert value(text.slug(F.lit("--A b!! C--"))) == "a-b-c"
    assert value(text.safe_id(F.lit("A b"))) == "a-b-" + __import__("hashlib").md5(b"A b").hexdigest()[:8]


@pytest.mark.parametrize(("given", "wanted"), [("01:02", 62.0), ("1:00:01", 3601.0), ("12.5", 12.5), ("x", 0.0), (None, 0.0), ("1:x", 0.0), ("1:2:3:4", 0.0)])
def test_clock(value, given, wanted):
    assert value(time.clock(F.lit(given).cast("string"))) == wanted


def test_stamp_and_display(value):
    assert value(time.stamp(F.lit("00:01:02,500"))) == 62.5
    assert value(time.minutes(F.lit(125.9))) == "2:05"
    assert value(time.minutes_m(F.lit(125.9))) == "2m05s"
    assert value(time.percent(F.lit(0.025))) == "2%"


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        ("only 5% of teams", "only a small fraction of teams"),
        ("cut by 30%", "cut significantly"),
        ("achieved 99.9%", "achieved high"),
        ("40% of users", "many users"),
        ("20% reduction", "significant reduction"),
        ("20% faster", "notable faster"),
        ("(70% in Europe)", "(a significant proportion in Europe)"),
        ("in 3 hours and 20 ms", "in hours and sub-second"),
        ("3-6 months", "several months"),
        ("kept 41% here", "kept 41% here"),
        ("up 40%\u00a0of all", "up many all"),
        ("1\u00a0minute", "minutes"),
    ],
)
def test_scrub_metrics(value, given, wanted):
    assert value(grounding.scrub_metrics(F.lit(given), F.array(F.lit("41%")))) == wanted


def test_scrub_speakers():
    known = {"ann lee", "lee"}
    scrub = grounding.scrub_speakers_text
    assert scrub("It works, speaker Dr. Lena Martinez cautioned that it may not.", known) == "It works, though speakers cautioned that it may not."
    assert scrub("A tool by Ann Lee is used.", known) == "A tool by Ann Lee is used."
    # The phrase runs on to the next comma, full stop or bracket.
    assert scrub("A tool presented by Max Muster, engineer at X is used.", known) == "A tool ."


@pytest.mark.parametrize(
    ("prose", "wanted"),
    [
        ("Fast, said by Max Muster, CTO of X, and by Ann Lee.", "Fast, said, and by Ann Lee."),
        ("by Max Muster and by Eva Klein here", "and here"),
        ("Dr. Max Muster's talk and Prof. Ann Lee's talk", "and Prof. Ann Lee's talk"),
        ("speaker Max Muster noted it, speaker Ann Lee noted it", ", though speakers cautioned it, speaker Ann Lee noted it"),
        ("no names  at all", "no names  at all"),
    ],
)
def test_scrub_speakers_by_hand(prose, wanted):
    assert grounding.scrub_speakers_text(prose, {"ann lee", "lee"}).strip() == wanted


def test_unicode_spaces_and_case_count_in_patterns(value):
    assert value(text.non_analytical(F.lit("Closing\u00a0Remarks"))) is True
    assert value(text.title_prefix(F.lit("\u2003Title\u00a0 - Someone"))) == "Title"
    assert value(text.clean_each(F.array(F.lit("\uff2a\uff4f\uff48\uff4e <b>x</b>"), F.lit(None), F.lit("\ufb01rm")))) == ["John x", "", "firm"]


def test_rounding_is_that_of_the_binary_value(value):
    assert [value(time.rounded(F.lit(x), 2)) for x in (2.675, 0.125, 1.005)] == [round(x, 2) for x in (2.675, 0.125, 1.005)]


def test_titles_in_prose(value):
    title = "Scaling the control plane to ten thousand nodes"
    prose = f"See **{title[:38]} quickly** and *short*."
    found = value(grounding.title_candidates(F.lit(prose)))
    assert found == [f"{title[:38]} quickly"]
    swapped = value(grounding.put_titles(F.lit(prose), F.create_map(F.lit(found[0]), F.lit(title))))
    assert swapped == f"See **{title}** and *short*."


@pytest.mark.parametrize(
    ("given", "wanted"),
    [('a\n```json\n{"x": 1}\n```', '{"x": 1}'), ('say {"x": {"y": 1}} ok', '{"x": {"y": 1}}'), ("list [1, 2]", "[1, 2]"), ("none", None)],
)
def test_json_text(value, given, wanted):
    assert value(text.json_text(F.lit(given))) == wanted


@pytest.mark.parametrize(
    ("title", "skip"),
    [("Closing Remarks", True), ("Welcome & Opening Remarks", True), ("Sponsored Keynote: X", True), ("Award Ceremony", True), ("A talk", False)],
)
def test_non_analytical(value, title, skip):
    assert value(text.non_analytical(F.lit(title))) is skip


def test_ratio_depends_on_order_and_case_does_not_matter():
    assert matching.ratio("ABC", "abc") == 1.0
    assert matching.ratio("", "") == 1.0


def test_names_and_artifacts(value):
    assert value(text.person_names(F.lit("as presented by Ann Lee and Bob Ray, architect"))) == ["Ann Lee", "Bob Ray"]
    assert value(text.template_artifacts(F.lit("[needs_quote=true] {place_holder} {No}"))) == ["[needs_quote=true]", "{place_holder}"]


def test_bold_paragraphs_become_headings(value):
    assert value(text.promote_bold(F.lit("a\n\n**Head**\nb"))) == "a\n\n### Head\n\nb"


@pytest.mark.parametrize(
    "given, wanted",
    [(" plain \n", "plain"), ("```json\n {\"a\": 1}\n```", '{"a": 1}'), ("```\n```{}", ""), ("a [1, 2] b", "[1, 2]"), ("} {", "} {"), (None, "")],
)
def test_answer_text(value, given, wanted):
    assert value(text.answer_text(F.lit(given).cast("string"))) == wanted


def test_only_foreign_words_go_to_python_for_nfkc(spark):
    """Words between characters up to the space have their NFKC by themselves; texts of plain words aren't dealt out whole."""
    import random
    import unicodedata

    rng, some = random.Random(3), "a e ́ ̧ é ﬁ Ａ 　   ´ ᄀ ᅡ ᆨ 가 ͅ ① \U0001d400   \x85 $ \\".split(" ")
    texts = ["".join(rng.choice([*some, " ", "\n", "\t"]) for _ in range(rng.randrange(30))) for _ in range(300)]
    texts += ["", " ", "x" * 50_000 + " ﬁ", "ﬁ" * 20_000, "plain", " ́", "e\ń", None]
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    got = df.select("x", text.normalized("x").alias("y")).collect()
    assert all(r["y"] == (None if r["x"] is None else unicodedata.normalize("NFKC", r["x"])) for r in got) and len(got) == len(texts)
    plan = df.select(text.normalized("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert "nfkc(" not in plan


def test_vectors_leave_a_batch_in_slices(spark, monkeypatch):
    from talkloom.plans import providers

    class Largest:
        def embed(self, texts):
            return [[float(len(texts)), float(len(x))] for x in texts]

    df = spark.range(0, 1500, 1, 1).selectExpr("id", "repeat('x', cast(id as int) % 7) as text")
    got = {r["id"]: r["embedding"] for r in providers.embed(df, Largest).collect()}
    assert len(got) == 1500 and max(v[0] for v in got.values()) <= 256 and all(v[1] == i % 7 for i, v in got.items())
