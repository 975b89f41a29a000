"""String expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkloom.functions.time import minutes

#: Patterns whose matches define results. (?U) gives Java's classes their Unicode meaning.
TAG = r"<[^>]+>"
SPACES = r"(?U)\s+"
URL = r"https?://[^\s<>\])\"']+"
PERCENT = r"(?U)\d+(?:\.\d+)?%"
NEEDS_QUOTE = r"(?U)\[needs_quote\s*=\s*\w+\]"
PLACEHOLDER = r"\{[a-z_]+\}"
VIDEO_ID = r"^[a-zA-Z0-9_-]{11}$"
NON_ANALYTICAL = (
    r"(?iUd)\bclosing\s+remarks?\b",
    r"(?iUd)\bawards?\s+ceremon",
    r"(?iUd)\bwelcome\b.*\bopening\s+remarks?\b",
    r"(?iUd)\bopening\s+keynote\s+remarks?\b",
    r"(?iUd)\bsponsored?\s+keynote\b",
)
NAME_CONTEXTS = (
    r"(?U)(?:presented by|according to|by|said|argues?|notes?|demonstrates?|shows?)\s+(?:(?:Dr|Prof)\.?\s+)?([A-Z][a-zà-ÿ]+(?:\s+[A-Z][a-zà-ÿ]+)+)",
    r"(?U)(?:(?:Dr|Prof)\.?\s+)?([A-Z][a-zà-ÿ]+(?:\s+[A-Z][a-zà-ÿ]+)+)(?:\s*,\s*(?:co-founder|engineer|architect|lead|director|CTO|CEO|VP))",
    r"(?U)\((?:presented by|by)\s+(?:(?:Dr|Prof)\.?\s+)?([A-Z][a-zà-ÿ]+(?:\s+[A-Z][a-zà-ÿ]+)+)\)",
)


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def filled(x: Column | str) -> Column:
    """The missing string is the empty string."""
    return F.coalesce(col(x), F.lit(""))


def or_else(*choices: Column | str) -> Column:
    """The first choice that is neither null nor empty, else the empty string."""
    return F.coalesce(*(F.nullif(col(c), F.lit("")) for c in choices), F.lit(""))


@F.pandas_udf(T.ArrayType(T.StringType()))
def nfkc_each(s: pd.Series) -> pd.Series:
    """Unicode NFKC. Spark has no builtin for it."""
    return s.map(lambda xs: [None if x is None else unicodedata.normalize("NFKC", x) for x in xs], na_action="ignore")


def _plain(x: Column) -> Column:
    return F.octet_length(x) == F.char_length(x)


#: Words that are not plain ASCII, between characters up to the space. Those neither compose nor let marks pass, so each word has
#: its NFKC by itself. It is tried at beginnings of words alone, and possessive, so that long words cost no more than others.
_FOREIGN = r"(?<![^\x00-\x20])[\x21-\x7F]*+[^\x00-\x7F][^\x00-\x20]*+"


def normalized(x: Column | str) -> Column:
    """NFKC. Only words that are not plain ASCII reach Python, so that its batches hold no whole texts of mostly plain words."""
    x = col(x)
    found = nfkc_each(F.when(~_plain(x), F.regexp_extract_all(x, F.lit(_FOREIGN), F.lit(0))))
    put = F.zip_with(F.split(x, _FOREIGN, -1), found, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return F.when(_plain(x), x).otherwise(F.array_join(put, ""))


def normalized_each(xs: Column | str) -> Column:
    """NFKC of each string of an array."""
    xs = col(xs)
    plain = F.forall(xs, lambda x: F.coalesce(_plain(x), F.lit(True)))
    return F.when(plain, xs).otherwise(nfkc_each(F.when(~plain, xs)))


def strip_tags(x: Column | str) -> Column:
    return F.regexp_replace(col(x), TAG, "")


def squeeze(x: Column | str) -> Column:
    """White space runs become one space; none at the ends."""
    return F.trim(F.regexp_replace(col(x), SPACES, " "))


def strip(x: Column | str) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(filled(x), r"(?U)^\s+|\s+\z", "")


def clean(x: Column | str, unicode: bool = True) -> Column:
    x = filled(x)
    return squeeze(strip_tags(normalized(x) if unicode else x))


def clean_each(xs: Column | str) -> Column:
    """Each string of an array as clean() gives it."""
    whole = F.transform(F.coalesce(col(xs), F.array().cast("array<string>")), lambda x: F.coalesce(x, F.lit("")))
    return F.transform(normalized_each(whole), lambda x: squeeze(strip_tags(x)))


def fold(x: Column | str) -> Column:
    """Lower case and single spaces, for comparison."""
    return squeeze(F.lower(filled(x)))


def urls(x: Column | str) -> Column:
    """Distinct URLs in code-point order."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(filled(x), F.lit(URL), F.lit(0))))


def company_of_affiliation(x: Column | str) -> Column:
    """As presence counts take it: surrounding parentheses go, then the part after the last ", "."""
    return F.trim(F.substring_index(F.btrim(F.trim(filled(x)), F.lit("()")), ", ", -1))


def company_tail(x: Column | str) -> Column:
    """As reports and charts take it: the part after the last ", ", parentheses kept."""
    return F.trim(F.substring_index(filled(x), ", ", -1))


def title_prefix(x: Column | str) -> Column:
    return strip(F.substring_index(filled(x), " - ", 1))


def safe_id(x: Column | str) -> Column:
    x = filled(x)
    return F.concat(F.substring(F.replace(F.lower(x), F.lit(" "), F.lit("-")), 1, 80), F.lit("-"), F.substring(F.md5(x), 1, 8))


def slug(x: Column | str) -> Column:
    return F.substring(F.btrim(F.regexp_replace(F.lower(filled(x)), "[^a-z0-9]+", "-"), F.lit("-")), 1, 60)


def tokens(x: Column | str) -> Column:
    """The set of lower-case ASCII words of more than two characters."""
    every = F.regexp_extract_all(F.lower(filled(x)), F.lit("[a-z0-9]+"), F.lit(0))
    return F.array_distinct(F.filter(every, lambda t: F.length(t) > 2))


def percentages(x: Column | str) -> Column:
    return F.regexp_extract_all(filled(x), F.lit(PERCENT), F.lit(0))


def template_artifacts(x: Column | str) -> Column:
    x = filled(x)
    return F.concat(F.regexp_extract_all(x, F.lit(NEEDS_QUOTE), F.lit(0)), F.regexp_extract_all(x, F.lit(PLACEHOLDER), F.lit(0)))


def person_names(x: Column | str) -> Column:
    """Distinct names in any of the three contexts of attribution."""
    found = [F.regexp_extract_all(filled(x), F.lit(p), F.lit(1)) for p in NAME_CONTEXTS]
    return F.array_distinct(F.concat(*found))


def non_analytical(title: Column | str) -> Column:
    title = filled(title)
    out = F.lit(False)
    for p in NON_ANALYTICAL:
        out = out | title.rlike(p)
    return out


def valid_video_id(x: Column | str) -> Column:
    return F.coalesce(col(x).rlike(VIDEO_ID), F.lit(False))


def event_id(url: Column | str) -> Column:
    """The part of an event URL after event/, up to the next slash; empty if there is none."""
    return F.regexp_extract(filled(url), r"event/([^/?#]+)", 1)


def without_venue(title: Column | str, venue: Column | str) -> Column:
    """The title without its venue, if it ends with it."""
    title, venue = F.trim(filled(title)), F.trim(filled(venue))
    ends = (venue != "") & F.endswith(title, venue)
    return F.trim(F.when(ends, F.substring(title, F.lit(1), F.length(title) - F.length(venue))).otherwise(title))


def time_text(x: Column | str) -> Column:
    """What stands before a run of two or more spaces."""
    return F.trim(F.element_at(F.split(F.trim(filled(x)), r"\s{2,}", 2), 1))


def speakers_text(speakers: Column | str, nobody: str = "") -> Column:
    """"name (company)" or "name", joined by ", "."""
    each = F.transform(
        col(speakers),
        lambda s: F.when(filled(s["company"]) != "", F.concat(filled(s["name"]), F.lit(" ("), s["company"], F.lit(")"))).otherwise(filled(s["name"])),
    )
    return or_else(F.array_join(each, ", "), F.lit(nobody))


def companies_text(speakers: Column | str) -> Column:
    each = F.filter(F.transform(col(speakers), lambda s: filled(s["company"])), lambda c: c != "")
    return F.coalesce(F.array_join(F.array_sort(F.array_distinct(each)), ", "), F.lit(""))


def bullets(items: Column | str) -> Column:
    return F.array_join(F.transform(col(items), lambda x: F.concat(F.lit("- "), x)), "\n")


def text_of(items: Column | str, kind: str = "array") -> Column:
    """A list joined by spaces, or a scalar, as text."""
    return F.coalesce(F.array_join(F.transform(col(items), lambda x: x.cast("string")), " ") if kind == "array" else col(items).cast("string"), F.lit(""))


def promote_bold(prose: Column | str) -> Column:
    """Bold phrases that stand alone between paragraphs become headings of level 3."""
    return F.regexp_replace(filled(prose), r"(?U)\n\n\*\*([^*]+)\*\*\s*\n", "\n\n### $1\n\n")


def bound(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x) with x computed once: expressions that use their argument several times would else double when nested."""
    return F.get(F.transform(F.array(x), lambda y: f(y)), F.lit(0))


def interleave(x: Column | str, pattern: str, replace: Callable[[Column], Column]) -> Column:
    """Replace every match by an expression of it, in a single pass. The pattern must not match the empty string."""

    def once(y: Column) -> Column:
        found = F.transform(F.regexp_extract_all(y, F.lit(pattern), F.lit(0)), lambda m: replace(m))
        return F.array_join(F.zip_with(F.split(y, pattern, -1), found, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")

    return bound(filled(x), once)


def json_text(x: Column | str) -> Column:
    """JSON in free text: a fenced block, else what the outermost braces hold, else the outermost brackets; null if none."""
    x = filled(x)
    fenced = strip(F.regexp_extract(x, r"(?s)```(?:json)?\s*\n(.*?)```", 1))

    def between(a: str, b: str) -> Column:
        start = F.instr(x, a)
        end = F.length(x) - F.instr(F.reverse(x), b) + 1
        return F.when((start > 0) & (F.instr(x, b) > 0) & (end > start), F.substring(x, start, end - start + 1))

    return F.coalesce(F.nullif(fenced, F.lit("")), between("{", "}"), between("[", "]"))


def answer_text(x: Column | str) -> Column:
    """What a model's answer says: what is in its fenced block, be it empty, else its JSON, else the stripped text."""
    x, fence = filled(x), r"(?s)```(?:json)?\s*\n(.*?)```"
    return F.when(x.rlike(fence), strip(F.regexp_extract(x, fence, 1))).otherwise(F.coalesce(json_text(x), strip(x)))


def context_block(n: Column, chunk_id: Column, talk: Column, track: Column, start_time: Column, video_id: Column, text: Column) -> Column:
    """One retrieved chunk as a header line and its text. The time shows only where it is not 0 and a video is known."""

    def some(label: str, x: Column) -> Column:
        return F.when(filled(x) != "", F.concat(F.lit(label), x))

    shown = (start_time != 0) & (filled(video_id) != "")
    time = F.when(shown, F.concat(F.lit("time="), minutes(start_time)))
    kind = F.concat(F.lit("type="), F.substring_index(chunk_id, ":", 1))
    head = F.concat_ws(" | ", F.concat(F.lit("["), n.cast("string"), F.lit("]")), kind, some("talk=", talk), some("track=", track), time)
    return F.concat(head, F.lit("\n"), filled(text))
