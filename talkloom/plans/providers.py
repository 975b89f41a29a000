"""Models behind small interfaces, with deterministic local defaults.

A provider is an object with one method over plain values. It is made once in each Python worker, runs over Arrow
batches, and its failures become rows (value null, error text) so that one bad item never stops the others.
"""

from __future__ import annotations

import json
import re
import time
from collections import Counter
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Seconds to wait before each further attempt of a call that failed.
RETRY_AFTER = (2, 5, 10)
DIMS = 64


class Completer(Protocol):
    def complete(self, system: str, prompt: str, max_tokens: int) -> str: ...


#: Texts whose vectors a task makes before it hands them on; a batch of Spark's has ten thousand.
EMBEDDED = 256


class Embedder(Protocol):
    def embed(self, texts: list[str]) -> list[list[float]]: ...


class MediaReader(Protocol):
    """Speech-to-text, scene detection, OCR and image description: bytes in, JSON text out."""

    def read(self, content: bytes, path: str) -> str: ...


class LocalCompleter:
    """Extractive: the sentences of the prompt that hold its most frequent words, up to the budget."""

    def complete(self, system: str, prompt: str, max_tokens: int) -> str:
        sentences = [s.strip() for s in re.split(r"(?<=[.!?])\s+|\n+", prompt) if s.strip()]
        words = Counter(w for w in re.findall(r"[a-z0-9]{4,}", prompt.lower()))
        worth = [(sum(words[w] for w in set(re.findall(r"[a-z0-9]{4,}", s.lower()))) / (8 + len(s.split())), -i) for i, s in enumerate(sentences)]
        chosen, used = [], 0
        for _, i in sorted(worth, reverse=True):
            size = len(sentences[-i].split())
            if used + size <= max(1, max_tokens // 8):
                chosen.append(-i)
                used += size
        return " ".join(sentences[i] for i in sorted(chosen)) or prompt[: 4 * max_tokens]


class HashedTerms:
    """Embedding by feature hashing of terms, of length 1."""

    def embed(self, texts: list[str]) -> list[list[float]]:
        out = []
        for text in texts:
            v = [0.0] * DIMS
            for word, n in Counter(re.findall(r"\w+", (text or "").lower())).items():
                h = xxhash.xxh64_intdigest(word)
                v[h % DIMS] += n if h >> 32 & 1 else -n
            size = sum(x * x for x in v) ** 0.5 or 1.0
            out.append([x / size for x in v])
        return out


class Unavailable:
    """Stands for a reader of media that this machine lacks."""

    def read(self, content: bytes, path: str) -> str:
        raise RuntimeError("no reader of media is configured")


def with_retries(call: Callable[[], str], waits: tuple[float, ...] = RETRY_AFTER) -> str:
    """The call's answer; an empty one is a failure. The last failure is raised."""
    for wait in (*waits, None):
        try:
            if answer := call():
                return answer
            raise ValueError("empty answer")
        except Exception:
            if wait is None:
                raise
            time.sleep(wait)
    raise AssertionError


def embed(df: DataFrame, make: Callable[[], Embedder] = HashedTerms, text_col: str = "text", out: str = "embedding") -> DataFrame:
    """Add the embedding of a text column."""

    @F.pandas_udf("array<float>")
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        provider = make()
        for texts in batches:
            for start in range(0, len(texts), EMBEDDED):
                made = provider.embed(texts.iloc[start : start + EMBEDDED].fillna("").tolist())
                yield pd.Series([np.asarray(v, np.float32) for v in made])

    return df.withColumn(out, vectors(F.col(text_col)))


def complete(
    df: DataFrame,
    system: str,
    make: Callable[[], Completer] = LocalCompleter,
    prompt_col: str = "prompt",
    max_tokens: int = 4096,
    out: str = "answer",
    waits: tuple[float, ...] = (),
) -> DataFrame:
    """Add struct(value, error) of one completion for each row."""

    @F.pandas_udf("struct<value:string,error:string>")
    def answers(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        provider = make()
        for prompts in batches:
            rows = []
            for p in prompts.fillna(""):
                try:
                    rows.append((with_retries(lambda p=p: provider.complete(system, p, max_tokens), waits), None))
                except Exception as e:
                    rows.append((None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["value", "error"])

    return df.withColumn(out, answers(F.col(prompt_col)))


def complete_json(
    df: DataFrame,
    system: str,
    kind: T.StructType,
    make: Callable[[], Completer] = LocalCompleter,
    prompt_col: str = "prompt",
    max_tokens: int = 4096,
    waits: tuple[float, ...] = (),
    said: str | None = None,
) -> DataFrame:
    """Add parsed (struct of the kind, null if the answer holds no such JSON), error, and under ``said`` the first answer as it
    is. A row that cannot be parsed is asked once more. Answers are cut once they are there, so no plan asks twice."""
    from talkloom.functions.text import json_text
    from talkloom.sources.artifacts import checkpointed

    first = checkpointed(complete(df, system, make, prompt_col, max_tokens, "__a", waits)).withColumn("__p", F.from_json(json_text("__a.value"), kind))
    again = F.when(F.col("__p").isNull(), F.concat(F.col(prompt_col), F.lit("\nAnswer with JSON only."))).otherwise(F.lit(""))
    need = first.withColumn("__again", again)

    @F.pandas_udf("string")
    def second(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        provider = make()
        for prompts in batches:
            out = []
            for p in prompts:
                try:
                    out.append(provider.complete(system, p, max_tokens) if p else None)
                except Exception:
                    out.append(None)
            yield pd.Series(out, dtype=object)

    final = need.withColumn("__q", F.from_json(json_text(second("__again")), kind))
    parsed = F.coalesce("__p", "__q")
    error = F.when(parsed.isNull(), F.coalesce("__a.error", F.lit("no JSON in the answer")))
    if said:
        final = final.withColumn(said, F.col("__a.value"))
    return final.withColumn("parsed", parsed).withColumn("error", error).drop("__a", "__p", "__again", "__q")


def read_media(files: DataFrame, kind: T.StructType, make: Callable[[], MediaReader] = Unavailable) -> DataFrame:
    """path, parsed, error of media rows (path, content)."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = make()
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    rows.append((path, reader.read(content, path), None))
                except Exception as e:
                    rows.append((path, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "raw", "error"])

    raw = files.select("path", "content").mapInPandas(each, "path string, raw string, error string")
    return raw.select("path", F.from_json("raw", kind).alias("parsed"), "error")


def capabilities() -> dict[str, bool]:
    """Which optional packages and tools this machine has."""
    from importlib.util import find_spec
    from shutil import which

    return {
        name: find_spec(name) is not None
        for name in ("matplotlib", "onnxruntime", "torch", "cv2")
    } | {tool: which(tool) is not None for tool in ("ffmpeg", "whisper-cli")}


def dumps(value: object) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True)
