"""Tag-path extraction: hostile markup, marks, pages without an article, and path ratios against a plain computation."""

import re
import time
from html import unescape
from math import sqrt

import pytest

from talkloom.llm import html_text
from talkloom.llm.html_text import main_text

LONG = "A sentence of some length, with a comma, that is content. And another one; it ends here."


@pytest.mark.parametrize(
    "html",
    [
        "<p>x</p><a " + " ".join(f"a{i}='b'" for i in range(10_000)),
        "<p>x</p><a " + " ".join(f"a{i}" for i in range(10_000)) + " b='",
        "<a '" * 50_001,
        "<p \"'\">" * 30_000 + '"',
        "<div>x " * 30_000,
        "<!--" * 50_000,
        "<svg>" * 50_000,
        "<script>" * 50_000,
        "<u><div>" + "<b>" * 30_000 + "</u>" * 30_000,
        "<" * 200_000,
    ],
    ids=["attributes", "open quote", "quotes", "nested quotes", "deep", "comments", "svg", "script", "closes", "less-than"],
)
def test_time_is_linear(html):
    began = time.perf_counter()
    main_text(html)
    assert time.perf_counter() - began < 3


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<p data-title='a hidden gem'>We sell cars, and more.</p>", "We sell cars, and more."),
        ("<p data-id=ads data-role='nav'>We sell cars, and more.</p>", "We sell cars, and more."),
        (f"<section class='social-policy'><p>{LONG}</p></section>", LONG),
        (f"<h2 id='search'>Search</h2><p>{LONG}</p><h2 id='related-work'>Related work</h2><p>{LONG}</p>", f"Search\n\n{LONG}\n\nRelated work\n\n{LONG}"),
        ("<p>We <a class='share'>sell</a> <span class='hidden-x'>big</span> things</p>", "We sell big things"),
        ("<p>a <math><mi>x</mi><mo>+</mo><mn>1</mn><annotation>x+1</annotation></math> and <label>labels</label> stay.</p>", "a x+1 and labels stay."),
        (f"<p>{LONG}</p><p style='display: none'>no</p><div hidden>no</div>", LONG),
        (f"<div class='comments'><p>{LONG}</p></div>", ""),
        ("<nav>menu</nav><footer>foot</footer>", ""),
        ("<p>1 < 2 and <3</p>", "1 < 2 and <3"),
        ("<p>cut off <b>in a tag</b> <img src='x", "cut off in a tag"),
    ],
)
def test_marks_and_tags(html, text):
    assert main_text(html) == text


def test_pages_without_an_article():
    page = (
        "<body><div class='top'><ul><li><a href=/>Home</a></li><li><a href=/b>About us</a></li></ul></div>"
        f"<div id=c><h1>Title</h1><p>{LONG}</p><h2>Part</h2><p>{LONG} {LONG}</p><ul><li>short item</li></ul><p>Ok.</p></div>"
        f"<div class=related><p>{LONG}</p></div><div><a href=/x>Imprint</a></div></body>"
    )
    assert main_text(page) == f"Title\n\n{LONG}\n\nPart\n\n{LONG} {LONG}\n\nshort item\n\nOk."


def test_several_holders_and_text_outside_them_stay():
    page = f"<h1>Day</h1><article><p>{LONG}</p></article><div><p>{LONG} {LONG}</p></div><article><p>Short one, here.</p><p>{LONG}</p></article>"
    assert main_text(page) == "\n\n".join(["Day", LONG, f"{LONG} {LONG}", "Short one, here.", LONG])


def test_articles_are_found_by_their_ratios_alone(sf_dir, duck):
    for page, html in duck.sql("SELECT page_id, html FROM pages").fetchall():
        article = re.search(r"<article>(.*)</article>", html, re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"</?b>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        plain = html.replace("<article>", "<div class='x'>").replace("</article>", "</div>")
        assert main_text(plain) == "\n\n".join(b for b in blocks if b), page


def plain_scores(rows):
    """rows: (path, prior, text, characters of links), in page order."""
    paths = list(dict.fromkeys(r[0] for r in rows))
    own = {}
    for p in paths:
        mine = [r for r in rows if r[0] == p]
        own[p] = (sum(len(r[2]) - 0.9 * r[3] for r in mine) / len(mine), sum(sum(c in ".,;:!?" for c in r[2]) for r in mine) / len(mine))
    out = {}
    for i, p in enumerate(paths):
        near = [own[q] for q in paths[max(0, i - 1) : i + 2]]
        a, b = (0.75 * own[p][k] + 0.25 * sum(x[k] for x in near) / len(near) for k in (0, 1))
        share = own[p][0] * sum(r[0] == p for r in rows) / sum(len(r[2]) for r in rows if r[0] == p)
        out[p] = next(r[1] for r in rows if r[0] == p) * share * sqrt(a * (1 + b))
    return out


def test_path_ratios_equal_a_plain_computation():
    html = f"<body><div><a href=x>Link, one</a></div><main><h1>Head</h1><p>{LONG}</p><p>No. <a>Yes!</a></p></main><section class=widget>Tail: text</section></body>"
    rows = [
        ("body/div", 1, "Link, one", 9),
        ("body/main/h1", 2 * 2, "Head", 0),
        ("body/main/p", 2, LONG, 0),
        ("body/main/p", 2, "No. Yes!", 4),
        ("body/section", 0.03, "Tail: text", 0),
    ]
    tree, blocks = html_text.blocks_of(html)
    assert [(b.text, b.links) for b in blocks] == [(r[2], r[3]) for r in rows]
    got = html_text.path_scores(tree, blocks)
    assert [got[tree.path[b.node]] for b in blocks] == pytest.approx([plain_scores(rows)[r[0]] for r in rows])


@pytest.mark.parametrize(
    "beside",
    [
        "<div>Copyright 2024 Acme Corp. All rights reserved.</div>",
        "<div>Bob: Great read, thanks!</div><div>Eve: I don't agree.</div>",
        f"<article class='comment'><p>{LONG}</p></article>",
        "<div id='cookie-bar'><p>We use cookies, as all do. Accept them?</p></div>",
        f"<div class='ad-container'><p>{LONG}</p></div>",
        f"<div class='newsletter-signup'><p>{LONG}</p></div>",
        "<div class='related-posts'><h3>Related</h3><ul><li>One more thing</li></ul></div>",
        "<h3>Popular</h3><ul><li><a href=/1>One story</a></li><li><a href=/2>Another story</a></li></ul>",
        "<div><h3>Comments</h3><div>Nice one.</div></div>",
    ],
)
@pytest.mark.parametrize("around", ["article", "div", "main"])
def test_what_stands_beside_the_content_stays_out(beside, around):
    body = f"<h1>Title</h1><p>{LONG}</p><h2>Part</h2><p>{LONG} {LONG}</p><ul><li>one short item</li></ul><p>{LONG} Ok.</p>"
    page = f"<body><div><a href=/>Home</a> <a href=/b>About</a></div><{around}>{body}{beside}</{around}></body>"
    assert main_text(page) == "\n\n".join(["Title", LONG, "Part", f"{LONG} {LONG}", "one short item", f"{LONG} Ok."])


def made_page(rng):
    """(html, blocks of the article): a page of boxes without classes or telling tags."""
    words = lambda n: " ".join("".join(rng.choices("abcdefghiklmnoprstu", k=rng.randint(2, 9))) for _ in range(n))
    sentence = lambda: words(rng.randint(6, 18)).capitalize() + rng.choice([".", ".", ", " + words(5) + ".", "; " + words(7) + "?"])
    paragraph = lambda: " ".join(sentence() for _ in range(rng.randint(1, 6)))
    links = lambda n: "<ul>" + "".join(f"<li><a href=/{i}>{words(rng.randint(1, 6))}</a></li>" for i in range(n)) + "</ul>"
    blocks, body = [words(5)], []
    body.append(f"<h1>{blocks[0]}</h1>")
    for _ in range(rng.randint(1, 4)):
        for _ in range(rng.randint(1, 4)):
            blocks.append(paragraph())
            body.append(f"<p>{blocks[-1]}</p>")
        if rng.random() < 0.5:
            items = [words(rng.randint(3, 8)) for _ in range(rng.randint(2, 4))]
            blocks += items
            body.append("<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>")
            blocks.append(paragraph())
            body.append(f"<p>{blocks[-1]}</p>")
        blocks += [words(3), paragraph()]
        body.append(f"<h2>{blocks[-2]}</h2><p>{blocks[-1]}</p>")
    boxes = [
        f"<div>{links(rng.randint(4, 9))}</div>",
        f"<div>{words(4)}, {words(3)}. <a href=/c>{words(2)}</a></div>",
        f"<div>{''.join(body)}</div>",
        f"<div><h3>{words(1)}</h3>{links(rng.randint(3, 7))}</div>",
        f"<div><h3>{words(1)}</h3>" + "".join(f"<div>{words(1)}: {words(rng.randint(2, 9))}.</div>" for _ in range(rng.randint(1, 4))) + "</div>",
        f"<div>&copy; 2024 {words(2)}. {words(3)}. <a href=/i>{words(1)}</a></div>",
    ]
    return f"<html><body>{''.join(boxes)}</body></html>", blocks


def test_ratios_decide_on_pages_without_marks():
    import random

    rng, hit, given, wanted, differ = random.Random(7), 0, 0, 0, 0
    for _ in range(30):
        html, blocks = made_page(rng)
        got = main_text(html).split("\n\n")
        hit, given, wanted = hit + len(set(got) & set(blocks)), given + len(got), wanted + len(blocks)
        differ += main_text(html, 0) != main_text(html)
    assert 2 * hit / (given + wanted) >= 0.95 and differ == 30


def test_paragraphs_in_boxes_and_sections_are_content():
    page = f"<article><p>Short lead, here.</p><div><p>{LONG}</p><p>{LONG} {LONG}</p></div><section><h2>More</h2><p>Brief, too.</p></section></article>"
    assert main_text(page) == "\n\n".join(["Short lead, here.", LONG, f"{LONG} {LONG}", "More", "Brief, too."])
    boxes = f"<main><h1>Title</h1><div>{LONG}</div><div>{LONG} {LONG}</div><div>{LONG}</div></main><div>Terms, of use.</div>"
    assert main_text(boxes) == "\n\n".join(["Title", LONG, f"{LONG} {LONG}", LONG])
