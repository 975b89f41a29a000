"""Main text of web pages by tag-path ratios.

A page becomes blocks of text, each under an element of the page's tree and with the tag path from the root to it. For
each path the page's text length (link text counts a tenth) and punctuation are summed over its blocks and divided by the
number of blocks. Both ratios are smoothed over the paths before and after, fused by the root of their product and
weighed by a prior of the path's tags and marks. Paths above a part of the page's best are content where they also hold a
share of the text of their zone (the outermost article or main around them, else the element around them), and zones a share
of that of the largest. A zone's content then brings in what stands between its blocks, paragraphs and list items of a
lower ratio at its edges, and headings that content follows. What only stands beside it (a closing line, remarks of readers,
lists of links and their headings) stays out, in an article too.

An ``article`` or ``main`` is a prior and no more: pages without one are read by their ratios alone. Class, id and role
tokens count as whole tokens, and less surely by their first and last part; never on inline elements or headings. Time and
memory are linear in the page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from math import sqrt

import pyarrow as pa
from pyspark.sql import DataFrame

from talkloom.llm.common import type_of

#: Elements whose content is no text of the page.
RAW = frozenset("script style noscript template textarea title iframe svg object canvas audio video xmp noembed noframes annotation annotation-xml".split())
#: Controls, whose text is left out without ending the block around them.
MUTE = frozenset("button select option optgroup datalist input".split())
#: Elements that are never main text. A header within an article or main is that part's own head and stays.
NEVER = frozenset("head nav header footer aside form menu dialog fieldset".split())
#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that do not begin a block of their own.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark math mfrac mi mn mo mover mrow ms msqrt mstyle msub msubsup"
    " msup mtext munder munderover output q ruby rb rt rp s samp semantics small span strike strong sub sup time tt u var wbr br img".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HOLDS = frozenset(["article", "main"])
#: Class, id and role tokens of parts that are never main text, and of parts that seldom are.
NEVER_MARKS = frozenset(
    "ad ads advert adverts advertisement advertising ad-slot ad-banner sponsored sidebar side-bar nav navbar navigation breadcrumb breadcrumbs"
    " footer site-footer page-footer site-header page-header menu comments comment-list comments-area comment disqus disqus_thread respond"
    " cookie cookies cookie-banner cookie-notice cookie-consent newsletter complementary contentinfo".split()
)
SELDOM_MARKS = frozenset(
    "banner sponsor promo promotion header masthead reply replies consent notice alert popup modal subscribe signup share sharing"
    " social related recommended pagination pager toolbar widget search dialog".split()
)
#: Marks of what readers write, which count on an article too, and parts of tokens that make a part of a page a seldom one.
READERS = frozenset("comment comments comment-list comments-area respond reply replies disqus disqus_thread".split())
SELDOM_PARTS = frozenset(
    "ad ads advert adverts comment comments consent cookie cookies gdpr newsletter popular promo promotion recommended related replies share sharing"
    " sidebar signup social sponsor sponsored subscribe trending".split()
)
#: Elements that hold text as such, and elements around them that are no boxes of their own.
TEXTUAL = frozenset("p li dd dt blockquote pre td th figcaption caption summary".split())
PLAIN = TEXTUAL | HOLDS | frozenset("ul ol dl table thead tbody tfoot tr section figure details hgroup".split())
#: Elements that end an open paragraph when they begin, and what bounds the search for it.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
P_BOUNDS = ("td", "th", "button", "table", "article", "main", "section", "div")
#: Elements that are ended by the beginning of the like: those that they end, and what bounds the search.
ENDS_LIKE = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
}

#: Production parameters: a path is content if its weighed ratio reaches this part of the page's highest (shares of text are held
#: to half of that part, and zones, paragraphs and list items at the edges to a fifth); blocks between a heading and the content
#: that it may head; the priors of holders, headings and seldom marks; what a character of link text counts for.
PART_OF_BEST = 0.5
AHEAD = 4
HOLDER, HEADING, SELDOM = 2.0, 2.0, 0.03
LINK = 0.1

# Possessive: no character is looked at twice by one match, whatever is left open.
_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_PLAIN_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?+")
_NO_SHOW = re.compile(r"display\s*+:\s*+none", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?…、。，！？]")


class Tree:
    """The block-level elements of a page by number; 0 is the page itself. ``path`` is equal for equal tag paths."""

    def __init__(self) -> None:
        self.parent, self.name, self.prior, self.path, self.held = [0], [""], [1.0], [0], [False]
        self.paths: dict[tuple[int, str, float], int] = {}

    def add(self, parent: int, name: str, prior: float) -> int:
        prior *= self.prior[parent]
        label = (self.path[parent], name, prior)
        self.path.append(self.paths.setdefault(label, len(self.paths) + 1))
        self.parent.append(parent)
        self.name.append(name)
        self.prior.append(prior)
        self.held.append(self.held[parent] or name in HOLDS)
        return len(self.parent) - 1


class Block:
    __slots__ = ("links", "node", "text")

    def __init__(self, node: int, text: str, links: int):
        self.node, self.text, self.links = node, text, links


def attributes_of(raw: str) -> dict[str, str]:
    """The attributes of a start tag; names are lower-cased, the first of a name counts."""
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(raw):
        out.setdefault(m[1].lower(), next((x for x in m.groups()[1:] if x is not None), ""))
    return out


def prior_of(name: str, attributes: dict[str, str], held: bool) -> float:
    """What an element makes of the ratio of the paths through it; 0 for what is never main text."""
    if name in NEVER and not (name == "header" and held):
        return 0.0
    prior = HOLDER if name in HOLDS and not held else HEADING if name in HEADINGS else 1.0
    if attributes and name not in HEADINGS and name not in ("html", "body"):
        marks = {t for a in ("class", "id", "role") for t in attributes.get(a, "").lower().split()}
        if not marks.isdisjoint(READERS if name in HOLDS and not held else NEVER_MARKS):
            return 0.0
        parts = {p for t in marks if "-" in t or "_" in t for p in (re.split("[-_]", t, maxsplit=1)[0], re.split("[-_]", t)[-1])}
        if not (marks.isdisjoint(SELDOM_MARKS) and parts.isdisjoint(SELDOM_PARTS)):
            prior *= SELDOM
    return prior


def blocks_of(html: str) -> tuple[Tree, list[Block]]:
    """The page's tree and its blocks of text in page order, all but those of parts that are never main text or not shown.

    Broken markup is repaired as browsers mostly do. A tag or comment that the page ends in is no text.
    """
    tree, out = Tree(), []
    stack: list[tuple[str, int, bool, bool]] = []  # name, node around it, mute, block-level
    where: dict[str, list[int]] = {}  # places in the stack of each open name
    block_at: list[int] = []  # places in the stack of block-level elements
    unended: set[str] = set()
    text: list[str] = []
    node = links = mute = at = 0
    tag, lower = _TAG, None

    def flush() -> None:
        nonlocal links
        if text:
            if joined := " ".join("".join(text).split()):
                out.append(Block(node, joined, min(links, len(joined))))
            text.clear()
        links = 0

    def say(piece: str) -> None:
        nonlocal links
        if piece and not mute and tree.prior[node]:
            piece = unescape(piece) if "&" in piece else piece
            text.append(piece)
            if where.get("a"):
                links += len(piece)

    def close(depth: int) -> None:
        nonlocal node, mute
        while len(stack) > depth:
            name, around, was_mute, is_block = stack.pop()
            where[name].pop()
            mute -= was_mute
            if is_block:
                block_at.pop()
                node = around

    def last(names: tuple[str, ...]) -> int:
        return max((where[n][-1] for n in names if where.get(n)), default=-1)

    def end_like(names: tuple[str, ...], bounds: tuple[str, ...]) -> None:
        if (depth := last(names)) > last(bounds):
            close(depth)

    size = len(html)
    while at < size:
        begin = html.find("<", at)
        if begin < 0:
            break
        say(html[at:begin])
        at = begin
        follows = html[begin + 1 : begin + 2]
        if follows in ("!", "?") and follows:
            end = html.find("-->", begin + 4) if html.startswith("<!--", begin) else html.find(">", begin)
            at = size if end < 0 else end + (3 if html.startswith("<!--", begin) else 1)
            continue
        m = tag.match(html, begin)
        if not m and tag is _TAG and (follows.isalpha() or follows == "/"):
            # A quote that is never closed: from here on quotes are characters like any other.
            if m := _PLAIN_TAG.match(html, begin):
                tag = _PLAIN_TAG
        if not m:
            if follows.isascii() and follows.isalpha() or follows == "/" and html[begin + 2 : begin + 3].isalpha():
                at = size if html.find(">", begin) < 0 else begin + 1
                if at == size:
                    break
            elif follows == "/":  # a comment of old
                end = html.find(">", begin)
                at = size if end < 0 else end + 1
                continue
            say("<")
            at = begin + 1
            continue
        at = m.end()
        name = m[2].lower()
        if name in VOID:
            if name == "br":
                say(" ")
            elif name not in INLINE and name not in MUTE:
                flush()
            if name == "hr" and not m[1]:
                end_like(("p",), P_BOUNDS)
            continue
        inline = name in INLINE or name in MUTE
        if m[1]:
            depth = last((name,))
            if not inline:
                flush()
            if depth >= 0 and (not inline or depth > (block_at[-1] if block_at else -1)):
                close(depth)
            continue
        if name in RAW:
            if name in unended:
                continue
            lower = lower if lower is not None else html.lower() if len(html.lower()) == size else html
            end = lower.find(f"</{name}", at)
            if end < 0:
                unended.add(name)
                if name in ("script", "style", "textarea", "title", "xmp", "iframe"):
                    break
                continue
            at = html.find(">", end) + 1 or size
            continue
        attributes = attributes_of(m[3]) if m[3] and not m[3].isspace() else {}
        hidden = "hidden" in attributes or bool(attributes.get("style") and _NO_SHOW.search(attributes["style"]))
        silent = hidden or name in MUTE
        if not inline:
            flush()
            if name in ENDS_P:
                end_like(("p",), P_BOUNDS)
            if name in ENDS_LIKE:
                end_like(*ENDS_LIKE[name])
            block_at.append(len(stack))
        where.setdefault(name, []).append(len(stack))
        stack.append((name, node, silent, not inline))
        mute += silent
        if not inline:
            node = tree.add(node, name, prior_of(name, attributes, tree.held[node]))
    else:
        at = size
    if at < size and html.find("<", at) < 0:
        say(html[at:])
    flush()
    return tree, out


def path_scores(tree: Tree, blocks: list[Block]) -> dict[int, float]:
    """The weighed ratio of each tag path: text and punctuation for each block, smoothed over neighbouring
    paths and fused; what is mostly links gains nothing from its neighbours."""
    chars: dict[int, float] = {}
    every: dict[int, int] = {}
    marks: dict[int, float] = {}
    count: dict[int, int] = {}
    prior: dict[int, float] = {}
    for b in blocks:
        p = tree.path[b.node]
        chars[p] = chars.get(p, 0) + len(b.text) - (1 - LINK) * b.links
        every[p] = every.get(p, 0) + len(b.text)
        marks[p] = marks.get(p, 0) + len(_PUNCTUATION.findall(b.text))
        count[p] = count.get(p, 0) + 1
        prior[p] = tree.prior[b.node]
    paths = list(count)  # in page order
    own = [(chars[p] / count[p], marks[p] / count[p]) for p in paths]
    scores = {}
    for i, p in enumerate(paths):
        near = own[max(0, i - 1) : i + 2]
        text, punctuation = (0.75 * own[i][k] + 0.25 * sum(x[k] for x in near) / len(near) for k in (0, 1))
        scores[p] = prior[p] * chars[p] / every[p] * sqrt(text * (1 + punctuation))
    return scores


def content_of(tree: Tree, blocks: list[Block], part_of_best: float = PART_OF_BEST) -> list[Block]:
    """Blocks of content paths, and those that they bring in: see the module's description."""
    if not blocks:
        return []
    scores = path_scores(tree, blocks)
    heading = [tree.name[b.node] in HEADINGS for b in blocks]
    best = max((scores[tree.path[b.node]] for b, h in zip(blocks, heading) if not h), default=0.0) or max(scores.values())
    holder, plain = [0], [True]  # of each element: the outermost article or main; whether there is no box between it and its zone
    top = [True]  # whether it is the page, html or body
    for n in range(1, len(tree.parent)):
        p = tree.parent[n]
        holder.append(holder[p] or (n if tree.name[n] in HOLDS else 0))
        top.append(top[p] and tree.name[n] in ("html", "body"))
        plain.append((plain[p] or not holder[n]) and tree.name[n] in PLAIN)
    zone = [holder[b.node] or (0 if top[tree.parent[b.node]] else tree.parent[b.node]) for b in blocks]
    own = [len(b.text) - (1 - LINK) * b.links for b in blocks]
    good = [not h and scores[tree.path[b.node]] >= part_of_best * best for b, h in zip(blocks, heading)]
    if not any(good):  # headings alone
        good = [scores[tree.path[b.node]] >= part_of_best * best for b in blocks]
    of_path: dict[tuple[int, int], float] = {}  # text of each zone's good paths, and of the largest of them
    of_zone: dict[int, float] = {}
    for b, z, size, g in zip(blocks, zone, own, good):
        if g:
            of_path[z, tree.path[b.node]] = of_path.get((z, tree.path[b.node]), 0) + size
            of_zone[z] = of_zone.get(z, 0) + size
    largest: dict[int, float] = {}
    for (z, _), size in of_path.items():
        largest[z] = max(largest.get(z, 0), size)
    most = max(of_zone.values())
    chosen = [
        g
        and of_zone[z] >= part_of_best / 5 * most
        and (plain[b.node] and tree.name[b.node] in TEXTUAL or of_path[z, tree.path[b.node]] >= part_of_best / 2 * largest[z])
        for b, z, g in zip(blocks, zone, good)
    ]
    first: dict[int, int] = {}
    last: dict[int, int] = {}
    for i, (z, c) in enumerate(zip(zone, chosen)):
        if c:
            first.setdefault(z, i)
            last[z] = i
    within = [0]  # of each element the nearest zone of content around it; boxed: whether a box stands between
    boxed = [False]
    for n in range(1, len(tree.parent)):
        p = tree.parent[n]
        within.append(n if n in first else within[p])
        boxed.append(n not in first and (boxed[p] or tree.name[n] not in PLAIN))
    out = list(chosen)
    for i, b in enumerate(blocks):
        z = within[b.node]
        if chosen[i] or heading[i] or z not in first or 2 * b.links > len(b.text) or tree.prior[b.node] < (tree.prior[z] if z else 1):
            continue
        edge = z and not boxed[b.node] and tree.name[b.node] in TEXTUAL and scores[tree.path[b.node]] >= part_of_best / 5 * best
        out[i] = first[z] < i < last[z] or bool(edge)
    for i in range(len(blocks) - 2, -1, -1):  # from the end, since a heading may head another
        b, z = blocks[i], within[blocks[i].node]
        if not heading[i] or out[i] or tree.prior[b.node] < HEADING * (tree.prior[z] if z else 1):
            continue
        for j in range(i + 1, min(len(blocks), i + 1 + AHEAD)):
            if out[j]:
                out[i] = j == i + 1 or within[blocks[j].node] == z
                break
            if 2 * blocks[j].links > len(blocks[j].text) or heading[j] and tree.name[blocks[j].node] <= tree.name[b.node]:
                break
    return [b for b, c in zip(blocks, out) if c]


def main_text(html: str | None, part_of_best: float = PART_OF_BEST) -> str:
    """The content blocks, joined by two line ends; empty for null, empty and pages without text."""
    return "\n\n".join(b.text for b in content_of(*blocks_of(html), part_of_best)) if html else ""


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text and n_chars for each row of pages.

    Null and empty html, and pages that have no text outside menus and the like, give the empty text. Pages of any
    length and depth are read whole; where a page is cut off inside a tag or comment, that tag is no text. Ties in ratio
    are all content. Null ids and urls pass through; repeated rows are returned as often as they come; an empty table
    gives an empty result. Columns other than those named are ignored.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x) for x in batch.column(2).to_pylist()]
            sizes = pa.array([len(x) for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], names=[id_col, url_col, "text", "n_chars"]
            )

    schema = f"`{id_col}` {type_of(pages, id_col)}, `{url_col}` {type_of(pages, url_col)}, text string, n_chars long"
    return pages.select(id_col, url_col, html_col).mapInArrow(each, schema)
