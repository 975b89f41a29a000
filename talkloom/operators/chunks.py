"""Chunks for retrieval: thirteen kinds, one layout of columns."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkloom.functions.text import bullets, companies_text, filled, or_else, safe_id, speakers_text, strip
from talkloom.operators.ordering import keep_first
from talkloom.schemas import schema

#: Production parameters: characters of a transcript chunk and of its overlap with the next, slides in a chunk.
WINDOW, OVERLAP, SLIDES = 2000, 400, 3
COLUMNS = ("id", "text", "chunk_type", "talk_title", "speakers", "companies", "track", "video_id", "source_file", "chunk_index", "start_time", "extra")
#: Kinds in the order of their union.
ORDER = (
    "transcript_segment",
    "talk_abstract",
    "talk_summary",
    "talk_takeaways",
    "talk_qa",
    "talk_signals",
    "cluster_summary",
    "conference_narrative",
    "slide_content",
    "maturity_assessment",
    "tension",
    "recommended_action",
    "technology_relationship",
)


def as_chunks(df: DataFrame, kind: str, **given: Column) -> DataFrame:
    """The columns of a chunk; what is not given is null. ``_pos`` keeps the order within the kind."""
    types = {f.name: f.dataType for f in schema("chunk").fields}
    cols = [given.get(c, F.lit(kind) if c == "chunk_type" else F.lit(None)).cast(types[c]).alias(c) for c in COLUMNS]
    return df.select(*cols, F.lit(ORDER.index(kind)).alias("_kind"), given.get("_pos", F.lit(0)).cast("long").alias("_pos"))


def lines(*parts: Column) -> Column:
    """Paragraphs, the null ones left out."""
    return F.concat_ws("\n\n", *parts)


def when_filled(label: str, x: Column | str) -> Column:
    return F.when(filled(x) != "", F.concat(F.lit(label), filled(x)))


def when_any(label: str, items: Column | str, separator: str) -> Column:
    items = F.col(items) if isinstance(items, str) else items
    return F.when(F.coalesce(F.size(items), F.lit(0)) > 0, F.concat(F.lit(label), F.array_join(items, separator)))


def fold_segments(texts: Iterator[tuple[float, str]], window: int = WINDOW, overlap: int = OVERLAP) -> Iterator[tuple[float, str]]:
    """(start, text) of each chunk of one transcript.

    Segments fill a buffer up to the window; the chunk's last ``overlap`` characters open the next buffer if the chunk is
    longer than that. A buffer that holds an overlap and no further segment gives no chunk.
    """
    buffer, began, last, fresh = "", 0.0, 0.0, False
    for start, text in texts:
        if not buffer:
            began = start
        buffer = f"{buffer} {text}" if buffer else text
        last, fresh = start, True
        if len(buffer) >= window:
            yield began, buffer.strip()
            fresh = False
            buffer, began = (buffer[-overlap:], last) if len(buffer) > overlap else ("", 0.0)
    if fresh:
        yield began, buffer.strip()


def windows(
    segments: DataFrame,
    key: str,
    order: str,
    text: str,
    start: str,
    window: int = WINDOW,
    overlap: int = OVERLAP,
    once: bool = False,
    together: bool = False,
) -> DataFrame:
    """(key, chunk_index, start_time, text): transcripts of any length stream through sorted; the state is one buffer.

    With ``once`` segments of one place go by their texts, and one of the same start and text as the one before it is left out.
    ``together``: each key's segments stand in one partition already, in order and one after another; then nothing is shuffled.
    """
    kind = segments.schema[key].dataType.simpleString()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in range(3)))

        stream, out = iter(rows()), []
        row = next(stream, None)
        while row is not None:
            now = row[0]

            def mine() -> Iterator[tuple[float, str]]:
                nonlocal row
                before = None
                while row is not None and row[0] == now:
                    if not (once and row == before):
                        yield row[1] or 0.0, row[2] or ""
                    before, row = row, next(stream, None)

            for i, (began, chunk) in enumerate(fold_segments(mine(), window, overlap)):
                out.append((now, i, began, chunk))
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, o)) for o in out], arrow)
                    out = []
        yield pa.RecordBatch.from_pylist([dict(zip(names, o)) for o in out], arrow)

    names = [key, "chunk_index", "start_time", "text"]
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = pa.schema([(key, to_arrow_type(segments.schema[key].dataType)), ("chunk_index", pa.int32()), ("start_time", pa.float64()), ("text", pa.string())])
    laid = segments.where(F.col(key).isNotNull()).select(
        key, F.col(start).cast("double").alias("__start"), F.col(text).alias("__text"), F.col(order).alias("__order")
    )
    if not together:
        laid = laid.repartition(key).sortWithinPartitions(key, "__order", *(["__text"] if once else []))
    laid = laid.drop("__order")
    return laid.mapInArrow(fold, f"`{key}` {kind}, chunk_index int, start_time double, text string")


def base(session: str = "") -> dict[str, Column]:
    return {"talk_title": filled("title"), "speakers": speakers_text("speakers"), "companies": companies_text("speakers"), "track": filled("track")}


def transcript_chunks(sessions: DataFrame, transcripts: DataFrame) -> DataFrame:
    s = sessions.where(filled("video_id") != "").select("video_id", "title", "speakers", "track", "_pos")
    segments = transcripts.select("video_id", F.posexplode("segments").alias("i", "s")).select("video_id", "i", "s.start", "s.text")
    got = windows(segments, "video_id", "i", "text", "start").join(s, "video_id")
    v, i = F.col("video_id"), F.col("chunk_index")
    return as_chunks(
        got,
        "transcript_segment",
        id=F.concat(F.lit("transcript_segment:"), v, F.lit(":"), i.cast("string")),
        text=F.col("text"),
        video_id=v,
        source_file=F.concat(F.lit("transcripts/"), v, F.lit(".json")),
        chunk_index=i,
        start_time=F.col("start_time"),
        _pos=F.col("_pos"),
        **base(),
    )


def slide_groups(slides: DataFrame, key: str, pos: str, ts: str, text: Column, n: int = SLIDES) -> DataFrame:
    """(key, chunk_index, start_time, text): groups of n slides; blank slides are left out, groups of none give no row."""
    rows = slides.withColumn("__t", text).where("__t is not null and __t <> ''").withColumn("chunk_index", F.floor(F.col(pos) / n).cast("int"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(ts).alias("ts"), F.col("__t").alias("t"))))
    got = rows.groupBy(key, "chunk_index").agg(ordered.alias("r"))
    return got.select(key, "chunk_index", F.col("r")[0]["ts"].alias("start_time"), F.array_join(F.transform("r", lambda r: r["t"]), "\n\n").alias("text"))


def slide_text() -> Column:
    text, seen = strip("text"), strip("description")
    return F.concat_ws("\n", F.when(text != "", text), F.when(seen != "", F.concat(F.lit("[Visual: "), seen, F.lit("]"))))


def slide_chunks(sessions: DataFrame, slides: DataFrame) -> DataFrame:
    from talkloom.functions.time import clock

    s = sessions.where(filled("video_id") != "").select("video_id", "title", "speakers", "track", "_pos")
    rows = slides.select("video_id", F.posexplode("slides").alias("i", "s")).select(
        "video_id", "i", clock(F.col("s.timestamp_sec")).alias("ts"), "s.text", "s.description"
    )
    got = slide_groups(rows, "video_id", "i", "ts", slide_text()).join(s, "video_id")
    v, i = F.col("video_id"), F.col("chunk_index")
    return as_chunks(
        got,
        "slide_content",
        id=F.concat(F.lit("slide_content:"), v, F.lit(":"), i.cast("string")),
        text=F.col("text"),
        video_id=v,
        source_file=F.concat(F.lit("slides/"), v, F.lit(".json")),
        chunk_index=i,
        start_time=F.col("start_time"),
        _pos=F.col("_pos"),
        **base(),
    )


def _id(kind: str, what: Column, n: Column | str = "0") -> Column:
    return F.concat(F.lit(f"{kind}:"), what, F.lit(":"), F.lit(n) if isinstance(n, str) else n.cast("string"))


def abstract_chunks(sessions: DataFrame) -> DataFrame:
    text = strip("abstract")
    rows = sessions.where(text != "")
    return as_chunks(
        rows,
        "talk_abstract",
        id=_id("talk_abstract", safe_id("title")),
        text=F.concat(filled("title"), F.lit("\n\n"), text),
        source_file=F.lit("schedule_clean.json"),
        _pos=F.col("_pos"),
        **base(),
    )


def talk_chunks(talks: DataFrame) -> DataFrame:
    """Summary, takeaways, questions and signals of talk analyses (with _pos)."""
    title = filled("title")
    some = lambda c: F.coalesce(F.size(c), F.lit(0)) > 0
    common = {"talk_title": title, "source_file": F.lit("analysis_talks.json"), "_pos": F.col("_pos")}
    make = lambda rows, kind, text: as_chunks(rows, kind, id=_id(kind, safe_id("title")), text=text, **common)
    headed = lambda head: F.concat(title, F.lit(f" — {head}"))
    signals = lines(
        headed("Signals & Tools"),
        when_any("Problems: ", "problems_discussed", "; "),
        when_any("Tools & Projects: ", "tools_and_projects", "; "),
        when_any("Emerging Signals: ", "emerging_signals", "; "),
    )
    parts = [
        make(talks.where(filled("summary") != ""), "talk_summary", lines(title, F.col("summary"))),
        make(talks.where(some("key_takeaways")), "talk_takeaways", lines(headed("Key Takeaways"), bullets("key_takeaways"))),
        make(talks.where(some("qa_highlights")), "talk_qa", lines(headed("Q&A Highlights"), bullets("qa_highlights"))),
        make(talks.where(some("problems_discussed") | some("tools_and_projects") | some("emerging_signals")), "talk_signals", signals),
    ]
    return reduce(DataFrame.unionByName, parts)


def cluster_chunks(ranking: DataFrame) -> DataFrame:
    rows = ranking.where(filled("summary") != "")
    text = lines(
        F.concat(F.lit("Cluster: "), filled("name")),
        F.col("summary"),
        when_filled("Relevance: ", "relevance_argument"),
        when_any("Recommended talks: ", "recommended_talks", ", "),
    )
    return as_chunks(
        rows,
        "cluster_summary",
        id=_id("cluster_summary", safe_id("name")),
        text=text,
        talk_title=filled("name"),
        source_file=F.lit("analysis_ranking.json"),
        extra=F.create_map(F.lit("relevance_score"), filled(F.col("relevance_score").cast("string"))),
        _pos=F.col("rank"),
    )


def narrative_chunks(agenda: DataFrame, recordings: DataFrame) -> DataFrame:
    def story(df: DataFrame, name: str, head: str, file: str, pos: int) -> DataFrame:
        text = F.concat(F.lit(f"Conference {head} Narrative\n\n"), F.col("narrative"))
        return as_chunks(
            df.where(filled("narrative") != ""),
            "conference_narrative",
            id=F.lit(f"conference_narrative:{name}:0"),
            text=text,
            source_file=F.lit(file),
            _pos=F.lit(pos),
        )

    themes = recordings.select(F.posexplode("cross_cutting_themes").alias("i", "t")).where(filled("t.description") != "")
    text = lines(
        F.concat(F.lit("Cross-cutting Theme: "), filled("t.theme")),
        F.col("t.description"),
        when_any("Supporting talks: ", F.col("t.supporting_talks"), ", "),
    )
    every = as_chunks(
        themes,
        "conference_narrative",
        id=F.concat(F.lit("conference_narrative:theme:"), F.col("i").cast("string")),
        text=text,
        talk_title=filled("t.theme"),
        source_file=F.lit("analysis_recordings.json"),
        _pos=F.col("i") + 2,
    )
    return story(agenda, "agenda", "Agenda", "analysis_agenda.json", 0).unionByName(
        story(recordings, "recordings", "Recordings", "analysis_recordings.json", 1)
    ).unionByName(every)


def signal_chunks(recordings: DataFrame) -> DataFrame:
    """Maturity, tensions, actions and relationships of the global synthesis."""
    file = F.lit("analysis_recordings.json")
    each = lambda column: recordings.select(F.posexplode(column).alias("i", "x"))
    x = lambda f: filled(f"x.{f}")
    or_ = lambda f, default: or_else(f"x.{f}", F.lit(default))
    talks = lambda c: F.coalesce(F.array_join(F.col(c), ", "), F.lit(""))
    say = lambda label, value: F.concat(F.lit(label), value)
    i = F.col("i")
    ring, urgency, category, severity = or_("ring", "assess"), or_("urgency", "long_term"), or_("category", "watch"), or_("severity", "minor")
    maturity = as_chunks(
        each("maturity_landscape").where(x("technology") != ""),
        "maturity_assessment",
        id=_id("maturity_assessment", safe_id("x.technology"), i),
        text=lines(
            say("Technology Maturity: ", x("technology")),
            say("Ring: ", ring),
            say("Evidence quality: ", or_("evidence_quality", "anecdotal")),
            when_filled("Rationale: ", "x.rationale"),
            when_any("Supporting talks: ", F.col("x.supporting_talks"), ", "),
        ),
        talk_title=x("technology"), source_file=file, extra=F.create_map(F.lit("ring"), ring), _pos=i,
    )
    tension = as_chunks(
        each("tensions").where(x("topic") != ""),
        "tension",
        id=_id("tension", safe_id("x.topic"), i),
        text=lines(
            say("Tension: ", x("topic")),
            say("Side A: ", x("side_a.position")),
            say("Supporting talks (A): ", talks("x.side_a.supporting_talks")),
            say("Side B: ", x("side_b.position")),
            say("Supporting talks (B): ", talks("x.side_b.supporting_talks")),
            say("Severity: ", severity),
            when_filled("Implication: ", "x.implication"),
        ),
        talk_title=x("topic"), source_file=file, extra=F.create_map(F.lit("severity"), severity), _pos=i,
    )
    action = as_chunks(
        each("recommended_actions").where(x("action") != ""),
        "recommended_action",
        id=_id("recommended_action", safe_id("x.action"), i),
        text=lines(
            say("Recommended Action: ", x("action")),
            say("Category: ", category),
            say("Urgency: ", urgency),
            when_filled("Evidence: ", "x.supporting_evidence"),
        ),
        talk_title=F.substring(x("action"), 1, 80), source_file=file, extra=F.create_map(F.lit("category"), category, F.lit("urgency"), urgency), _pos=i,
    )
    named = F.concat_ws(" ", x("entity_a"), x("relation"), x("entity_b"))
    relationship = as_chunks(
        each("technology_relationships").where((x("entity_a") != "") & (x("entity_b") != "")),
        "technology_relationship",
        id=_id("technology_relationship", F.concat(safe_id("x.entity_a"), F.lit("-"), safe_id("x.entity_b")), i),
        text=lines(say("Technology Relationship: ", named), when_any("Supporting talks: ", F.col("x.supporting_talks"), ", ")),
        talk_title=named, source_file=file, extra=F.create_map(F.lit("relation"), x("relation")), _pos=i,
    )
    return reduce(DataFrame.unionByName, [maturity, tension, action, relationship])


def union_chunks(*parts: DataFrame) -> DataFrame:
    """All chunks in order of kind and position; of equal ids the first stays."""
    every = reduce(DataFrame.unionByName, parts)
    return keep_first(every, F.col("id"), F.col("_kind"), F.col("_pos"), F.col("text")).select(*COLUMNS)


def union_places(*parts: DataFrame) -> DataFrame:
    """All chunks; of equal ids those of the first kind and position stay, all of them if several stand there."""
    w = Window.partitionBy("id").orderBy("_kind", "_pos")
    every = reduce(DataFrame.unionByName, parts).where("id is not null and id <> ''")
    return every.withColumn("_nth", F.rank().over(w)).where("_nth = 1").select(*COLUMNS)


def chunk_counts(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("chunk_type").agg(F.count("*").alias("n")).orderBy("chunk_type")
