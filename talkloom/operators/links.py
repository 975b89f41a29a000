"""Cross references: titles set in bold or italics become links."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom.functions.text import filled, interleave
from talkloom.operators.ordering import keep_first

#: Text between equal runs of one to three asterisks; it begins and ends with no white space.
SPAN = r"(?<!\*)(\*{1,3})(?=[^\s*])([^*]+)(?<=[^\s*])\1(?!\*)"
_SPAN = re.compile(SPAN)


def linked_text(text: str, target_of: Callable[[str], str | None]) -> str:
    """The text with a link around each span that has a target: one pass, however many titles there are."""

    def link(m: re.Match) -> str:
        target = target_of(m[2])
        return f"{m[1]}[{m[2]}]({target}){m[1]}" if target else m[0]

    return _SPAN.sub(link, text)


def linked(pages: DataFrame, targets: DataFrame, key: str = "page", text: str = "text") -> DataFrame:
    """pages with links in their text. targets: title, target, pos; of equal titles the first by pos counts.

    A page's spans meet the titles by an equi-join, so that the work is that of the text and the titles, not of their product;
    then each page is rewritten in one pass, which makes no link in a link. Keys come once.
    """
    spans = pages.select(key, F.explode(F.array_distinct(F.regexp_extract_all(filled(text), F.lit(SPAN), F.lit(2)))).alias("title"))
    known = keep_first(targets, F.col("title"), F.col("pos"), F.col("target")).select("title", "target")
    found = spans.join(known, "title").groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("title", "target"))).alias("__targets"))

    def link(m):
        marks, title = F.regexp_extract(m, r"^\*+", 0), F.btrim(m, F.lit("*"))
        target = F.try_element_at("__targets", title)
        return F.when(target.isNull(), m).otherwise(F.concat(marks, F.lit("["), title, F.lit("]("), target, F.lit(")"), marks))

    every = pages.join(found, key, "left")
    return every.withColumn(text, F.when(F.col("__targets").isNull(), F.col(text)).otherwise(interleave(text, SPAN, link))).select(pages.columns)
