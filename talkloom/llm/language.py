"""Language identification with spans of mixed-language text.

Words are runs of letters and the marks on them. The script ranges of a word's characters narrow its candidate languages
to those that were learned to use the script; character trigrams score it under each. Viterbi decoding over the words,
with a penalty for each switch of language, labels spans; the language that labels most letters is the document's.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom.llm.common import fresh_name, type_of

#: Production parameters. The model is fitted on at most SAMPLE documents, those of smallest hash.
SAMPLE = 20_000
BUCKETS = 1 << 15
SWITCH = 12.0
SMOOTHING = 0.5
#: A language may use a script if at least this share of its learned words is in it.
SCRIPT_SHARE = 0.01
UNKNOWN = "und"
#: Characters of a text, and letters, that are scored at once.
PIECE = 1 << 20
STEP = 1 << 18

#: Scripts by their Unicode ranges, first and last code point.
SCRIPTS = {
    "other": (),
    "latin": (
        (0x41, 0x5A),
        (0x61, 0x7A),
        (0xAA, 0xAA),
        (0xBA, 0xBA),
        (0xC0, 0x24F),
        (0x250, 0x2AF),
        (0x1E00, 0x1EFF),
        (0x2C60, 0x2C7F),
        (0xA720, 0xA7FF),
        (0xFB00, 0xFB06),
        (0xFF21, 0xFF5A),
    ),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "armenian": ((0x530, 0x58F), (0xFB13, 0xFB17)),
    "hebrew": ((0x590, 0x5FF), (0xFB1D, 0xFB4F)),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFC)),
    "syriac": ((0x700, 0x74F),),
    "thaana": ((0x780, 0x7BF),),
    "devanagari": ((0x900, 0x97F), (0xA8E0, 0xA8FF)),
    "bengali": ((0x980, 0x9FF),),
    "gurmukhi": ((0xA00, 0xA7F),),
    "gujarati": ((0xA80, 0xAFF),),
    "oriya": ((0xB00, 0xB7F),),
    "tamil": ((0xB80, 0xBFF),),
    "telugu": ((0xC00, 0xC7F),),
    "kannada": ((0xC80, 0xCFF),),
    "malayalam": ((0xD00, 0xD7F),),
    "sinhala": ((0xD80, 0xDFF),),
    "thai": ((0xE00, 0xE7F),),
    "lao": ((0xE80, 0xEFF),),
    "tibetan": ((0xF00, 0xFFF),),
    "myanmar": ((0x1000, 0x109F), (0xA9E0, 0xA9FF), (0xAA60, 0xAA7F)),
    "georgian": ((0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)),
    "ethiopic": ((0x1200, 0x139F), (0x2D80, 0x2DDF), (0xAB00, 0xAB2F)),
    "cherokee": ((0x13A0, 0x13FF), (0xAB70, 0xABBF)),
    "khmer": ((0x1780, 0x17FF),),
    "mongolian": ((0x1800, 0x18AF),),
    "kana": ((0x3041, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)),
    "hangul": ((0x1100, 0x11FF), (0x3131, 0x318E), (0xA960, 0xA97F), (0xAC00, 0xD7FB)),
    "han": ((0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)),
}


@cache
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Of each code point: whether it is a letter (1), a mark that belongs to a word (2) or neither; its script."""
    kinds = np.fromiter((1 if (c := unicodedata.category(chr(i))[0]) == "L" else 2 if c == "M" else 0 for i in range(0x110000)), np.uint8, 0x110000)
    scripts = np.zeros(0x110000, np.uint8)
    for i, ranges in enumerate(SCRIPTS.values()):
        for first, last in ranges:
            scripts[first : last + 1] = i
    return kinds, np.where(kinds == 1, scripts, 0).astype(np.uint8)


def pieces_of(text: str, size: int = PIECE) -> Iterator[str]:
    """A text in pieces of at most ``size`` characters, cut at spaces where there are any."""
    at = 0
    while at < len(text):
        end = at + size
        if end < len(text) and (space := text.rfind(" ", at, end)) > at:
            end = space
        yield text[at:end]
        at = end


def grams(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """Buckets of the trigrams centred on each character of a word, where each word begins in them, each word's script (that
    of its characters which comes last in SCRIPTS), and whether there is any letter."""
    kinds, scripts = tables()
    raw = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
    kind = kinds[raw]
    inside = kind > 0
    at = np.flatnonzero(inside)
    if not len(at):
        return at, at, at.astype(np.uint8), False
    data = np.where(inside, raw, 32).astype(np.uint32)
    with np.errstate(over="ignore"):
        code = (data[at - 1] * np.uint32(0x85EBCA6B) + data[at]) * np.uint32(0xC2B2AE35) + data[at + 1]
        code = (code ^ code >> np.uint32(15)) * np.uint32(2654435761) >> np.uint32(17)
    begins = np.flatnonzero(~inside[at - 1])
    return code & np.uint32(BUCKETS - 1), begins, np.maximum.reduceat(scripts[raw[at]], begins), bool((kind == 1).any())


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # log probability: bucket x language
    banned: np.ndarray  # script x language: what a word of the script is charged


def fit(docs: DataFrame, learn, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from rows where ``learn`` (a condition) holds and neither text nor language is null.

    Of these the ``sample`` of smallest hash of id and text; rows alike in both are one. Without any the model is empty.
    """
    rows = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), F.xxhash64(id_col, text_col).alias("h"))
    bound = rows.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    if bound is None:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPTS), 0), np.float32))
    rows = rows.where(F.col("h") <= bound).dropDuplicates(["h"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen = found.setdefault(lang, np.zeros(BUCKETS + len(SCRIPTS), np.int64))
                for piece in pieces_of(text):
                    code, _, script, _ = grams(piece)
                    if len(code):
                        seen[:BUCKETS] += np.bincount(code, minlength=BUCKETS)
                        seen[BUCKETS:] += np.bincount(script, minlength=len(SCRIPTS))
        for lang, seen in found.items():
            at = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(seen[at])],
                names=["lang", "feature", "n"],
            )

    counted = rows.select("text", "lang").mapInArrow(count, "lang string, feature int, n long")
    summed = counted.groupBy("lang", "feature").agg(F.sum("n").alias("n")).toArrow()  # at most a row for each language and bucket
    names = summed.column("lang").to_pylist()
    languages = sorted(set(names))
    place = {x: i for i, x in enumerate(languages)}
    counts = np.zeros((BUCKETS + len(SCRIPTS), len(languages)))
    counts[summed.column("feature").to_numpy(), [place[x] for x in names]] = summed.column("n").to_numpy()
    seen = counts[:BUCKETS] + SMOOTHING
    scores = np.log(seen / seen.sum(axis=0)).astype(np.float32)
    scripts = counts[BUCKETS:]
    used = scripts / np.maximum(1, scripts.sum(axis=0)) >= SCRIPT_SHARE
    used[~used.any(axis=1)] = True  # a script that nobody uses tells nothing
    return Model(languages, scores, np.where(used, 0, -50).astype(np.float32))


def label_words(scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The language of each word on the path of highest total score less ``switch`` for each change. Ties: the first language."""
    total = scores.sum(axis=0)
    lead = int(total.argmax())
    gain = np.cumsum(scores - scores[:, [lead]], axis=0, dtype=np.float64)
    least = np.minimum.accumulate(np.vstack([np.zeros((1, scores.shape[1])), gain[:-1]]), axis=0)
    if (gain - least).max() <= switch:  # no stretch of words gains what a single switch costs
        return np.full(len(scores), lead)
    best, back = scores[0].tolist(), []
    for row in scores[1:].tolist():
        top = max(best)
        other, came = top - switch, best.index(top)
        back.append([i if b >= other else came for i, b in enumerate(best)])
        best = [(b if b >= other else other) + s for b, s in zip(best, row)]
    path = [best.index(max(best))]
    for step in reversed(back):
        path.append(step[path[-1]])
    return np.array(path[::-1])


def word_scores(code: np.ndarray, begins: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """The score of each word under each language: the sum over its characters, STEP of them at once."""
    out = np.zeros((len(begins), scores.shape[1]))
    for a in range(0, len(code), STEP):
        b = min(a + STEP, len(code))
        first = int(np.searchsorted(begins, a, "right")) - 1
        inside = begins[first + 1 : np.searchsorted(begins, b)]
        out[first : first + 1 + len(inside)] += np.add.reduceat(scores[code[a:b]], np.r_[0, inside - a], axis=0)
    return out


def identify(text: str | None, model: Model, switch: float = SWITCH) -> tuple[str, float, list[tuple[str, int, int]]]:
    """Language, score in 0..1, and spans (language, first word, words) of runs of letters.

    The score is the share of letters that the language labels, times its posterior over the others for the words it labels.
    """
    if not text or not model.languages:
        return UNKNOWN, 0.0, []
    words, letters, lettered = [], [], False
    for piece in pieces_of(text):
        code, begins, script, any_letter = grams(piece)
        if len(code):
            lettered |= any_letter
            scored = word_scores(code, begins, model.scores)
            words.append(scored + model.banned[script] if model.banned[np.unique(script)].any() else scored)
            letters.append(np.diff(np.r_[begins, len(code)]))
    if not lettered:
        return UNKNOWN, 0.0, []
    words, letters = np.concatenate(words), np.concatenate(letters)
    path = label_words(words, switch)
    share = np.bincount(path, weights=letters, minlength=len(model.languages))
    first = int(share.argmax())
    own = words[path == first].sum(axis=0)
    posterior = 1 / np.exp(np.clip(own - own[first], -50, 50)).sum()
    edges = np.flatnonzero(np.r_[True, path[1:] != path[:-1]])
    spans = [(model.languages[path[a]], int(a), int(n)) for a, n in zip(edges, np.diff(np.r_[edges, len(path)]))]
    return model.languages[first], float(min(1.0, share[first] / letters.sum() * posterior)), spans


def predict(
    docs: DataFrame,
    model: Model,
    spans: bool = False,
    switch: float = SWITCH,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """id, the columns ``keep``, lang_pred, score and, if asked for, spans for each row of docs.

    Null and empty texts and those without a letter are ``und`` with score 0 and no span, as is everything under a model
    that learned from no row. Ties go to the language first by name. Repeated rows and null ids are rows like any other;
    an empty table gives an empty result. Columns not named are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [id_col, *(c for c in keep if c != id_col and c != text_col)]
    kind = pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int32()), ("n_words", pa.int32())]))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [identify(t, shared.value, switch) for t in batch.column(0).to_pylist()]
            columns = [*batch.columns[1:], pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            if spans:
                columns.append(pa.array([[dict(zip(("lang", "first_word", "n_words"), s)) for s in x[2]] for x in found], kind))
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "lang_pred", "score", *["spans"] * spans])

    schema = ", ".join(
        f"`{c}` {type_of(docs, c)}"
        for c in kept
    ) + ", lang_pred string, score double" + ", spans array<struct<lang:string,first_word:int,n_words:int>>" * spans
    return docs.select(F.col(text_col).alias(fresh_name(docs, "__text")), *kept).mapInArrow(each, schema)


def reject(docs: DataFrame, model: Model, least: float = 0.2, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of docs whose language is known with a score of at least ``least``, with that language in lang_col.

    Null, empty and letterless texts go, as do all under a model that learned from no row. Texts are read whole. Ties go to
    the language first by name; repeated rows and null ids are rows like any other; other columns are unchanged, whatever
    their names; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = docs.columns
    at = columns.index(text_col), columns.index(lang_col)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [identify(t, shared.value)[:2] for t in batch.column(at[0]).to_pylist()]
            stays = pa.array([lang != UNKNOWN and score >= least for lang, score in found], pa.bool_())
            arrays = list(batch.columns)
            arrays[at[1]] = pa.array([lang for lang, _ in found], pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=columns).filter(stays)

    schema = ", ".join(f"`{c}` {'string' if c == lang_col else type_of(docs, c)}" for c in columns)
    return docs.mapInArrow(each, schema)
