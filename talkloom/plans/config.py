"""Configuration of an event: a TOML file as typed settings."""

from __future__ import annotations

import dataclasses
import os
import tomllib
import warnings
from dataclasses import dataclass, field
from pathlib import Path


@dataclass
class Recordings:
    source_url: str = ""
    video_ids: list[str] = field(default_factory=list)
    video_format: str = "mp4"  # in the file format; nothing reads it


@dataclass
class Conference:
    name: str = "Conference"
    schedule: str = ""
    schedule_url: str = ""
    sched_api_key: str = ""
    recordings: Recordings = field(default_factory=Recordings)


@dataclass
class Models:
    model: str = "local"
    num_parallel: int = 2


@dataclass
class Extract:
    device: str = "auto"
    compute_type: str = "auto"  # in the file format; for a speech provider
    scene_threshold: float = 27.0
    vlm_model: str = ""
    diarize: bool = True
    language: str = "en"


@dataclass
class Query:
    embedding_model: str = "hashed-terms"
    top_k: int = 15


@dataclass
class Analyze:
    eval_topics: list[str] = field(default_factory=lambda: ["general industry trends", "emerging technology", "practical applicability"])


@dataclass
class Report:
    word_budget: int = 8000
    max_quotes_per_section: int = 3
    appendix_strategy: str = "top_talks_only"
    skip_enrichment: bool = False


@dataclass
class Config:
    conference: Conference = field(default_factory=Conference)
    extract: Extract = field(default_factory=Extract)
    llm: Models = field(default_factory=Models)
    query: Query = field(default_factory=Query)
    analyze: Analyze = field(default_factory=Analyze)
    report: Report = field(default_factory=Report)
    data_dir: str = "data"


def _filled(kind: type, given: dict, where: str):
    """The dataclass with what is given; unknown keys are told of and left out."""
    known = {f.name: f for f in dataclasses.fields(kind)}
    for key in sorted(set(given) - set(known)):
        warnings.warn(f"unknown setting {where}{key}", stacklevel=3)
    values = {}
    for key, value in given.items():
        if key in known:
            default = known[key].default_factory() if known[key].default_factory is not dataclasses.MISSING else None
            values[key] = _filled(type(default), value, f"{where}{key}.") if dataclasses.is_dataclass(default) else value
    return kind(**values)


def load(path: str) -> Config:
    """Settings of a file; its data lies in the folder of the same name without the suffix. SCHED_API_KEY fills a missing key."""
    config = _filled(Config, tomllib.loads(Path(path).read_text(encoding="utf-8")), "")
    config.data_dir = str(Path(path).with_suffix(""))
    if not config.conference.sched_api_key:
        config.conference.sched_api_key = os.environ.get("SCHED_API_KEY", "")
    return config
