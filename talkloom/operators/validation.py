"""Validation of drafted sections against their sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkloom.functions.text import filled, fold, percentages, person_names, template_artifacts, title_prefix

KINDS = ("unknown_speakers", "ungrounded_metrics", "template_artifacts", "fabricated_citations")


GRAM = 3


def _grams(x: str, sizes: Column) -> Column:
    """The different substrings of a column of the given sizes (an array)."""
    starts = lambda n: F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(x) - n + 1))
    each = F.flatten(F.transform(sizes, lambda n: F.transform(starts(n), lambda i: F.substring(F.col(x), i, n))))
    return F.array_distinct(each)


def containing(longer: DataFrame, shorter: DataFrame) -> DataFrame:
    """(whole, part): strings of ``longer`` (column whole) that hold one of ``shorter`` (column part), both different and not empty.

    A part meets wholes on the one of its three-character pieces that fewest wholes hold (a shorter part on itself), and
    what meets is compared, so neither table goes to every task and no pair is formed without a piece in common.
    """
    pieces = longer.select("whole", F.explode(_grams("whole", F.array(F.lit(1), F.lit(2), F.lit(GRAM)))).alias("piece"))
    held_by = pieces.groupBy("piece").agg(F.count("*").alias("n"))
    own = F.when(F.length("part") < GRAM, F.array("part")).otherwise(_grams("part", F.array(F.lit(GRAM))))
    rarest = shorter.select("part", F.explode(own).alias("piece")).join(held_by, "piece", "left")
    rarest = rarest.groupBy("part").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "piece")).alias("x")).select("part", "x.piece")
    return pieces.join(rarest, "piece").where(F.contains("whole", "part")).select("whole", "part")


def _contains_either(names: DataFrame, known: DataFrame) -> DataFrame:
    """names (n) that neither hold, nor are held by, a known name (k)."""
    holds = containing(names.select(F.col("n").alias("whole")), known.select(F.col("k").alias("part"))).select(F.col("whole").alias("n"))
    held = containing(known.select(F.col("k").alias("whole")), names.select(F.col("n").alias("part"))).select(F.col("part").alias("n"))
    return names.join(holds.unionByName(held).distinct(), "n", "left_anti")


def unknown_speakers(sections: DataFrame, people: DataFrame) -> DataFrame:
    """(section_id, name): names in prose that are in the schedule neither as a speaker nor as a company.

    Each different name is looked up once, however many sections hold it.
    """
    found = sections.select("section_id", F.explode(person_names("prose")).alias("name")).withColumn("n", fold("name"))
    names = found.where(F.length("n") >= 4).select("n").distinct()
    known = lambda kind: people.where(F.col("kind") == kind).select(fold("name").alias("k")).where("k <> ''").distinct()
    unknown = _contains_either(names, known("company").unionByName(known("speaker")).distinct())
    return found.join(unknown, "n", "left_semi").select("section_id", "name")


def ungrounded_metrics(sections: DataFrame, grounded: DataFrame) -> DataFrame:
    """(section_id, percentage), as often as it stands there; grounded has percentage."""
    rows = sections.select("section_id", F.explode(percentages("prose")).alias("percentage"))
    return rows.join(grounded.select("percentage").distinct(), "percentage", "left_anti").select("section_id", "percentage")


def artifacts(sections: DataFrame) -> DataFrame:
    return sections.select("section_id", F.explode(template_artifacts("prose")).alias("artifact"))


def fabricated_citations(sections: DataFrame, titles: DataFrame) -> DataFrame:
    """(section_id, cited): titles that no talk has or begins with (up to the first " - "). Beginnings meet by their first characters."""
    cited = sections.select("section_id", F.explode("citations").alias("c")).select("section_id", filled("c.talk_title").alias("cited")).where("cited <> ''")
    ask = cited.select("cited").distinct().select("cited", fold("cited").alias("w"), fold(title_prefix("cited")).alias("p"))
    real = titles.select(fold("title").alias("t")).where("t <> ''").distinct()
    open_ = ask.join(real, F.col("w") == F.col("t"), "left_anti")
    n = F.least(F.lit(6), F.length("p"))
    heads = real.select(
        "t", F.explode(F.sequence(F.lit(0), F.least(F.lit(6), F.length("t")))).alias("hn")
    ).withColumn("head", F.substring("t", F.lit(1), F.col("hn")))
    open_ = open_.withColumn("n", n).withColumn("own", F.substring("p", F.lit(1), F.col("n")))
    fake = open_.join(heads, (F.col("n") == F.col("hn")) & (F.col("own") == F.col("head")) & F.startswith("t", "p"), "left_anti")
    return cited.join(fake.select("cited"), "cited", "left_semi").select("section_id", "cited")


def warnings(sections: DataFrame, people: DataFrame, grounded: DataFrame, titles: DataFrame) -> DataFrame:
    """(section_id, kind, message) of all four checks."""
    say = lambda df, kind, message: df.select("section_id", F.lit(kind).alias("kind"), message.alias("message"))
    parts = [
        say(unknown_speakers(sections, people), KINDS[0], F.concat(F.lit('Unknown speaker: "'), F.col("name"), F.lit('" — not in schedule_clean.json'))),
        say(
            ungrounded_metrics(sections, grounded),
            KINDS[1],
            F.concat(F.lit("Ungrounded metric: "), F.col("percentage"), F.lit(" — not found in analysis_talks.json")),
        ),
        say(artifacts(sections), KINDS[2], F.concat(F.lit("Template artifact: "), F.col("artifact"))),
        say(fabricated_citations(sections, titles), KINDS[3], F.concat(F.lit('Fabricated citation: "'), F.substring("cited", 1, 60), F.lit('..."'))),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stats(sections: DataFrame, found: DataFrame) -> DataFrame:
    """One row: sections_checked, a count for each kind, total."""
    n = sections.agg(F.count("*").alias("sections_checked"))
    kinds = found.agg(*(F.count_if(F.col("kind") == k).alias(k) for k in KINDS), F.count("*").alias("total"))
    return n.join(kinds, F.lit(True))
