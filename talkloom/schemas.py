"""Declared schemas of every artifact. Reads use them with FAILFAST; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_DDL = {
    "session": "title STRING, abstract STRING, speakers ARRAY<STRUCT<name: STRING, company: STRING>>, track STRING, format STRING, time STRING, tags ARRAY<STRING>",
    "raw_session": "title STRING, name STRING, abstract STRING, description STRING, speakers STRING, track STRING, venue STRING, format STRING, time STRING, event_start STRING, tags ARRAY<STRING>",
    "video_meta": "video_id STRING, title STRING, uploader STRING, upload_date STRING, duration DOUBLE",
    "transcript": "video_id STRING, title STRING, language STRING, duration_sec DOUBLE, model STRING, backend STRING, diarized BOOLEAN, full_text STRING, segments ARRAY<STRUCT<start: DOUBLE, end: DOUBLE, text: STRING, speaker: STRING>>",
    "cli_transcript": "transcription ARRAY<STRUCT<timestamps: STRUCT<`from`: STRING, `to`: STRING>, text: STRING>>, result STRUCT<language: STRING>",
    "slides": "video_id STRING, slides ARRAY<STRUCT<index: INT, timestamp_sec: STRING, image_file: STRING, text: STRING, description: STRING>>",
    "frame_hash": "video_id STRING, index INT, dhash BIGINT",
    "talk": "title STRING, summary STRING, key_takeaways ARRAY<STRING>, problems_discussed ARRAY<STRING>, tools_and_projects ARRAY<STRING>, qa_highlights ARRAY<STRING>, evidence_quality STRING, speaker_perspective STRING, `references` ARRAY<STRING>, maturity_assessments ARRAY<STRUCT<technology: STRING, maturity: STRING, evidence: STRING>>, caveats_and_concerns ARRAY<STRING>, technology_stance ARRAY<STRUCT<technology: STRING, stance: STRING, evidence: STRING>>, relationships ARRAY<STRUCT<entity_a: STRING, relation: STRING, entity_b: STRING>>, emerging_signals ARRAY<STRING>, speakers STRING",
    "agenda": "clusters ARRAY<STRUCT<name: STRING, description: STRING, talks: ARRAY<STRING>, keywords: ARRAY<STRING>, companies: ARRAY<STRING>>>, top_keywords ARRAY<STRING>, narrative STRING, company_presence MAP<STRING, INT>, track_distribution MAP<STRING, INT>",
    "ranking": "name STRING, rank INT, relevance_score DOUBLE, summary STRING, relevance_argument STRING, recommended_talks ARRAY<STRING>, skip_reason STRING",
    "synthesis": "cluster_name STRING, narrative STRING, cross_cutting_themes ARRAY<STRUCT<theme: STRING, description: STRING, supporting_talks: ARRAY<STRING>>>, common_problems ARRAY<STRING>, emerging_technologies ARRAY<STRUCT<technology: STRING, mentions: INT, context: STRING>>, technology_relationships ARRAY<STRUCT<entity_a: STRING, relation: STRING, entity_b: STRING, supporting_talks: ARRAY<STRING>>>, tensions ARRAY<STRUCT<topic: STRING, side_a: STRUCT<position: STRING, supporting_talks: ARRAY<STRING>>, side_b: STRUCT<position: STRING, supporting_talks: ARRAY<STRING>>, severity: STRING, implication: STRING>>, maturity_landscape ARRAY<STRUCT<technology: STRING, ring: STRING, evidence_quality: STRING, supporting_talks: ARRAY<STRING>, rationale: STRING>>, recommended_actions ARRAY<STRUCT<action: STRING, category: STRING, urgency: STRING, supporting_evidence: STRING>>, stakeholder_map ARRAY<STRUCT<role: STRING, talk_count: INT>>",
    "chunk": "id STRING, text STRING, chunk_type STRING, talk_title STRING, speakers STRING, companies STRING, track STRING, video_id STRING, source_file STRING, chunk_index INT, start_time DOUBLE, extra MAP<STRING, STRING>",
    "outline": "thesis STRING, appendix_strategy STRING, total_word_budget INT, sections ARRAY<STRUCT<section_id: STRING, title: STRING, section_type: STRING, cluster_name: STRING, word_budget: INT, priority: INT, guidance: STRING, source_talks: ARRAY<STRING>>>",
    "section": "section_id STRING, title STRING, prose STRING, citations ARRAY<STRUCT<talk_title: STRING, claim: STRING, needs_quote: BOOLEAN>>, key_takeaway STRING",
    "quote": "talk_title STRING, speaker STRING, quote STRING, timestamp_sec DOUBLE, video_id STRING",
    "summary": "summary STRING, key_findings ARRAY<STRING>, top_actions ARRAY<STRING>",
}
SCHEMAS: dict[str, T.StructType] = {}

#: The closed vocabularies of the analysis.
ENUMS = {
    "maturity": ("assess", "trial", "adopt", "hold"),
    "stance": ("enthusiastic", "cautious", "critical", "neutral"),
    "relation": ("replaces", "competes_with", "builds_on", "integrates_with", "extends"),
    "talk_evidence": ("production", "proof_of_concept", "theoretical", "vendor_demo"),
    "perspective": ("practitioner", "vendor", "maintainer", "academic"),
    "severity": ("fundamental", "significant", "minor"),
    "landscape_evidence": ("anecdotal", "case_study", "benchmarked", "production_proven"),
    "action_category": ("evaluate", "watch", "talk_to", "adopt", "avoid"),
    "urgency": ("immediate", "next_quarter", "long_term"),
    "section_type": ("cluster_deep_dive", "cluster_brief", "cross_cutting", "tensions", "maturity", "actions", "landscape"),
}


def schema(name: str) -> T.StructType:
    """The StructType of an artifact."""
    if name not in SCHEMAS:
        SCHEMAS[name] = T.StructType.fromDDL(_DDL[name])
    return SCHEMAS[name]


def ddl(name: str) -> str:
    return _DDL[name]


def to_json_schema(kind: T.DataType, enums: dict[str, tuple[str, ...]] | None = None) -> dict:
    """JSON Schema of a Spark type, for constrained output of a model; enums by field name."""
    enums = enums or {}
    if isinstance(kind, T.StructType):
        fields = {}
        for f in kind.fields:
            fields[f.name] = {"type": "string", "enum": list(enums[f.name])} if f.name in enums else to_json_schema(f.dataType, enums)
        return {"type": "object", "properties": fields, "required": [f.name for f in kind.fields]}
    if isinstance(kind, T.ArrayType):
        return {"type": "array", "items": to_json_schema(kind.elementType, enums)}
    if isinstance(kind, T.MapType):
        return {"type": "object", "additionalProperties": to_json_schema(kind.valueType, enums)}
    if isinstance(kind, T.BooleanType):
        return {"type": "boolean"}
    if isinstance(kind, (T.IntegerType, T.LongType)):
        return {"type": "integer"}
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return {"type": "number"}
    return {"type": "string"}
