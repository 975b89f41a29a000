"""Schedule pages: HTML listing and detail pages as rows, and which provider serves a URL."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom.operators.ordering import keep_first

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class Node:
    """An element: name, classes, href, children (nodes and strings)."""

    def __init__(self, name: str, attributes: dict[str, str | None]):
        self.name, self.href = name, attributes.get("href") or ""
        self.classes = frozenset((attributes.get("class") or "").split())
        self.children: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        for c in self.children:
            if isinstance(c, Node):
                yield c
                yield from c.walk()

    def all(self, name: str, cls: str = "") -> list[Node]:
        return [n for n in self.walk() if n.name == name and (not cls or cls in n.classes)]

    def one(self, name: str, cls: str = "") -> Node | None:
        return next((n for n in self.walk() if n.name == name and (not cls or cls in n.classes)), None)

    def pieces(self, skip: Node | None = None) -> Iterator[str]:
        for c in self.children:
            if isinstance(c, str):
                if c.strip():
                    yield c.strip()
            elif c is not skip:
                yield from c.pieces(skip)

    def text(self, separator: str = "", skip: Node | None = None) -> str:
        return separator.join(self.pieces(skip))


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__()
        self.root = Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        node = Node(tag, dict(attrs))
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_endtag(self, tag):
        depth = next((i for i in range(len(self.open) - 1, 0, -1) if self.open[i].name == tag), None)
        if depth:
            del self.open[depth:]

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


#: Where the pages of a schedule site hold what. A path names elements (tag.class), each within the one before.
#: Of a field: its path, and what stands between its pieces of text, or the attribute that it is.
SESSION, SESSION_FIELDS = "span.event", {"href": ("a.name", "@href"), "title": ("a.name", ""), "venue": ("a.name span.vs", "")}
PAGE_FIELDS = {"abstract": ("div.tip-description", "\n"), "track": ("div.sched-event-type a", ""), "time": ("div.sched-event-details-timeandplace", " ")}
PERSON, PERSON_FIELDS = "div.tip-roles div.sched-person-session", {"name": ("h2 a", ""), "company": ("div.sched-event-details-role-company", "")}
TAG = "ul.tip-custom-fields li"
#: How links to sessions begin, and the first such element within an abstract is its label.
LINKS, LABEL = "event/", "strong"


def found(node: Node, path: str) -> list[Node]:
    """What a path leads to: all that the last step finds under the first that those before it find."""
    *steps, last = (step.partition(".")[::2] for step in path.split())
    for name, cls in steps:
        if (node := node.one(name, cls)) is None:
            return []
    return node.all(*last)


def fields_of(node: Node, fields: dict[str, tuple[str, str]]) -> dict[str, str | None]:
    """The value of each field, None where the page has no such element."""
    out: dict[str, str | None] = {}
    for name, (path, how) in fields.items():
        first = next(iter(found(node, path)), None)
        if first is None:
            out[name] = None
        else:
            out[name] = first.href if how == "@href" else first.text(how, skip=first.one(LABEL) if name == "abstract" else None)
    return out


def _read(pages: DataFrame, columns: list[str], each, shape: str) -> DataFrame:
    """Rows (dicts) that ``each`` makes of a page's values and its tree, under the given shape."""
    names = [x.split()[0] for x in shape.split(", ")]

    def batch_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [r for page, html in zip(batch[columns[0]], batch[columns[1]]) for r in each(page, parse(html))]
            yield pd.DataFrame(rows, columns=names)

    return pages.select(*columns).mapInPandas(batch_of, shape)


def listing_sessions(pages: DataFrame, base_col: str = "url", html_col: str = "html") -> DataFrame:
    """(url, title, venue, event_id, _page, _i) of the sessions on listing pages, each URL once."""
    from talkloom.functions.text import event_id, without_venue

    def each(page: str | None, tree: Node) -> Iterator[dict]:
        for i, session in enumerate(found(tree, SESSION)):
            yield {"_page": page or "", "_i": i} | fields_of(session, SESSION_FIELDS)

    raw = _read(pages, [base_col, html_col], each, "_page string, _i int, href string, title string, venue string")
    venue = F.coalesce("venue", F.lit(""))
    rows = raw.where(F.startswith("href", F.lit(LINKS))).select(
        "_page", "_i", F.concat("_page", F.lit("/"), "href").alias("url"), without_venue(F.col("title"), venue).alias("title"), venue.alias("venue")
    )
    return keep_first(rows, F.col("url"), F.col("_page"), F.col("_i")).withColumn("event_id", event_id("url"))


def detail_sessions(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The url and what its page tells: abstract, speakers, track, time and tags; what is not there is empty."""

    from talkloom.functions.text import time_text

    def each(url: str, tree: Node) -> Iterator[dict]:
        people = [fields_of(person, PERSON_FIELDS) for person in found(tree, PERSON)]
        yield {"url": url, "speakers": people, "tags": [tag.text() for tag in found(tree, TAG)]} | fields_of(tree, PAGE_FIELDS)

    shape = "url string, abstract string, speakers array<struct<name:string,company:string>>, track string, time string, tags array<string>"
    raw = _read(pages, [url_col, html_col], each, shape)
    named = F.filter("speakers", lambda s: s["name"].isNotNull())
    told = F.transform(named, lambda s: F.struct(s["name"].alias("name"), F.coalesce(s["company"], F.lit("")).alias("company")))
    text = lambda c: F.coalesce(c, F.lit(""))
    return raw.select("url", text("abstract").alias("abstract"), told.alias("speakers"), text("track").alias("track"), text(time_text("time")).alias("time"), "tags")


def providers(urls: DataFrame, patterns: DataFrame, url_col: str = "url") -> DataFrame:
    """urls with provider: the first pattern (domain, provider, place) whose domain is the URL's host or one above it.

    A host is exploded into the domains above it, so this is an equi-join.
    """
    host = F.lower(F.coalesce(F.try_parse_url(F.col(url_col), F.lit("HOST")), F.lit("")))
    labels = F.split(host, "[.]")
    n = F.size(labels)
    above = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    each = urls.select(url_col).distinct().select(url_col, F.explode(above).alias("domain"))
    best = each.join(patterns, "domain").groupBy(url_col).agg(F.min_by("provider", "place").alias("provider"))
    return urls.join(best, url_col, "left")


def fetch_plan(listing: DataFrame, cached: DataFrame, key: str = "event_id") -> DataFrame:
    """Sessions whose detail page is not in the cache yet."""
    return listing.join(cached.select(key).distinct(), key, "left_anti")


def video_ids(urls: DataFrame, configured: list[str], spark) -> DataFrame:
    """(video_id, _pos): the playlist's valid ids, each once in order, then the configured ones as they are."""
    from talkloom.functions.text import valid_video_id

    listed_ids = keep_first(
        urls.where(valid_video_id("video_id")), F.col("video_id"), F.col("_pos")
    ).select("video_id", F.col("_pos").cast("long").alias("_pos"))
    own = spark.createDataFrame([(v, 1 << 40 | i) for i, v in enumerate(configured)], "video_id string, _pos long")
    return listed_ids.unionByName(own)
