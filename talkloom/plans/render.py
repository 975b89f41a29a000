"""Markdown reports and charts from small, ordered tables. Rows come to the driver one partition at a time."""

from __future__ import annotations

import re
from datetime import UTC, datetime

from pyspark.sql import DataFrame

from talkloom.operators.links import linked_text
from talkloom.sources.artifacts import read_text, remove_pages, write_text


def rows(df: DataFrame) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.toLocalIterator()]


def bullets(items: list[str] | None) -> str:
    return "\n".join(f"- {x}" for x in items or [])


def clock(seconds: float | None) -> str:
    return f" at {int(seconds) // 60}:{int(seconds) % 60:02d}" if seconds else ""


def percent(share: float) -> str:
    return f"{share * 100:.0f}%"


def appendix_entry(a: dict) -> str:
    marks = [
        f"*Cluster: {a['cluster']}*" if a.get("cluster") else "",
        f"Evidence: {a['evidence_quality']}" if a.get("evidence_quality") else "",
        f"Perspective: {a['speaker_perspective']}" if a.get("speaker_perspective") else "",
    ]
    parts = [f"### {a['title']}", " | ".join(m for m in marks if m), a.get("summary") or ""]
    if a.get("key_takeaways"):
        parts.append("**Key Takeaways:**\n" + bullets(a["key_takeaways"]))
    if a.get("tools_and_projects"):
        parts.append("**Tools & Projects:** " + ", ".join(a["tools_and_projects"]))
    return "\n\n".join(p for p in parts if p)


def sources(quotes: list[dict]) -> str:
    told = bullets([f"{q['talk_title']}{' (' + q['speaker'] + ')' if q.get('speaker') else ''}{clock(q.get('timestamp_sec'))}" for q in quotes])
    return f"<details>\n<summary>Sources</summary>\n\n{told}\n\n</details>" if quotes else ""


def pictures(images: dict[str, list[tuple[str, str]]] | None, section_type: str | None, base: str) -> str:
    """The charts of a type of section."""
    return "\n\n".join(f"![{caption}]({base}{path})" for path, caption in (images or {}).get(section_type or "", []))


def briefing(
    name: str,
    thesis: str,
    summary: dict,
    sections: list[dict],
    quotes: dict[str, list[dict]],
    appendix: list[dict],
    model: str,
    now: datetime | None = None,
    images: dict[str, list[tuple[str, str]]] | None = None,
    counts: dict | None = None,
    warnings: list[str] | None = None,
) -> str:
    """The whole report as Markdown."""
    parts = [f"# Intelligence Briefing: {name}", f"> {thesis}", "---", "## Executive Summary", summary.get("summary", "")]
    parts += ["### Key Findings", bullets(summary.get("key_findings")), "### Recommended Actions", bullets(summary.get("top_actions")), "---"]
    for i, s in enumerate(sections, 1):
        parts += [f"## {i}. {s['title']}", s["prose"], pictures(images, s.get("section_type"), "./"), sources(quotes.get(s["section_id"], [])), "---"]
    if appendix:
        parts += ["## Appendix: Selected Talk Summaries", *(f"{appendix_entry(a)}\n\n---" for a in appendix)]
    if warnings:
        parts += ["## Notes of the Validation", bullets(warnings)]
    told = f" {counts['sections']} sections, {counts['words']} words, {counts['appendix_talks']} talks in the appendix." if counts else ""
    parts.append(
        f"*Generated {(now or datetime.now(UTC)):%Y-%m-%d %H:%M} UTC using {model}.{told}*" if told else f"*Generated {(now or datetime.now(UTC)):%Y-%m-%d %H:%M} UTC using {model}*"
    )
    return "\n\n".join(p for p in parts if p) + "\n"


def ranking_report(name: str, ranking: list[dict]) -> str:
    parts = [f"# Cluster Ranking: {name}", "![Cluster Relevance](./images/cluster_relevance.svg)", "## Ranked Clusters"]
    for c in ranking:
        talks = c.get("recommended_talks") or []
        parts += [
            f"### {c['rank']}. {c['name']}",
            f"**Relevance Score:** {percent(c['relevance_score'])}",
            c.get("summary") or "",
            f"**Why it matters:** {c.get('relevance_argument') or ''}",
        ]
        parts += ["#### Recommended Talks", bullets(talks)] if talks else []
        parts += [f"> **Note:** {c['skip_reason']}"] if c.get("skip_reason") else []
        parts.append("---")
    table = ["| Rank | Cluster | Relevance | Top Pick |", "|------|---------|-----------|----------|"]
    table += [f"| {c['rank']} | {c['name']} | {percent(c['relevance_score'])} | {(c.get('recommended_talks') or ['—'])[0]} |" for c in ranking]
    return "\n\n".join(p for p in [*parts, "## Quick Reference", "\n".join(table)] if p) + "\n"


def agenda_report(name: str, agenda: dict) -> str:
    parts = [
        f"# Agenda Analysis: {name}",
        agenda.get("narrative") or "No narrative generated.",
        "## Topic Landscape",
        "![Keyword Cloud](./images/keyword_cloud.svg)",
        "![Topic Frequency](./images/topic_frequency.svg)",
        "### Top Keywords",
        bullets(agenda.get("top_keywords")),
        "## Topic Clusters",
    ]
    for c in agenda.get("clusters") or []:
        talks = c.get("talks") or []
        parts += [
            f"### {c['name']}",
            c.get("description") or "",
            f"**Keywords:** {', '.join(c.get('keywords') or [])}",
            f"**Companies:** {', '.join(c.get('companies') or [])}",
            f"<details>\n<summary>Talks ({len(talks)})</summary>\n\n{bullets(talks)}\n</details>",
        ]
    for head, image, key, n in (
        ("Company Presence", "company_presence", "Company", "Talks"), ("Track Distribution", "track_distribution", "Track", "Sessions")
    ):
        counts = agenda.get(image) or {}
        table = [f"| {key} | {n} |", "|---------|-------|" if key == "Company" else "|-------|----------|", *(f"| {k} | {v} |" for k, v in counts.items())]
        parts += [f"## {head}", f"![{head}](./images/{image}.svg)", "\n".join(table)]
    return "\n\n".join(p for p in parts if p) + "\n"


def cross_references(page: str, anchors: dict[str, str], links: dict[str, str], synthesis: bool) -> str:
    """Titles in bold or italics become links to the appendix; in syntheses titles of sections become links to chapters."""
    return linked_text(page, lambda title: anchors.get(title) or (links.get(title) if synthesis else None))


def slug(text: str) -> str:
    return re.sub(r"[^a-z0-9]+", "-", text.lower()).strip("-")[:60]


def book(
    folder: str,
    name: str,
    thesis: str,
    summary: dict,
    sections: list[dict],
    appendix: list[dict],
    guide: list[dict],
    images: dict[str, list[tuple[str, str]]] | None = None,
) -> list[str]:
    """A book's sources: index, a chapter for each section, thin briefs merged in one, appendix and table of contents. Old pages go."""
    remove_pages(f"{folder}/src")
    written: list[str] = []

    def write(page: str, text: str) -> None:
        write_text(f"{folder}/src/{page}", text)
        written.append(page)

    anchors = {a["title"]: f"appendix.md#{slug(a['title'])}" for a in appendix}
    thin = [s for s in sections if s.get("thin")]
    chapters = [s for s in sections if not s.get("thin")]
    links = {s["title"]: f"{slug(s['title'])}.md" for s in chapters} | {s["title"]: "briefs.md" for s in thin}
    toc = ["# Summary", "", "[Overview](index.md)", ""]
    read = "\n".join(
        f"- **{role}**: " + ", ".join(f"[{g['title']}]({links.get(g['title'], '')})" for g in guide if g["role"] == role)
        for role in dict.fromkeys(g["role"] for g in guide)
    )
    write(
        "index.md",
        "\n\n".join(
            p
            for p in [
                f"# {name}",
                f"> {thesis}",
                summary.get("summary", ""),
                bullets(summary.get("key_findings")),
                "## Reading Guide" if read else "",
                read,
            ] if p
        ) + "\n",
    )
    synthesis = {"landscape", "cross_cutting", "tensions", "maturity", "actions"}
    for s in chapters:
        page = cross_references(f"# {s['title']}\n\n{s['prose']}\n", anchors, links, s.get("section_type") in synthesis)
        shown = pictures(images, s.get("section_type"), "../../")
        write(links[s["title"]], page + (f"\n{shown}\n" if shown else ""))
        toc.append(f"- [{s['title']}]({links[s['title']]})")
    if thin:
        write(
            "briefs.md",
            "# Brief Notes\n\n" + "\n\n".join(cross_references(f"## {s['title']}\n\n{s['prose']}", anchors, links, False) for s in thin) + "\n",
        )
        toc.append("- [Brief Notes](briefs.md)")
    if appendix:
        write("appendix.md", "# Appendix\n\n" + "\n\n".join(appendix_entry(a) for a in appendix) + "\n")
        toc.append("- [Appendix](appendix.md)")
    write("SUMMARY.md", "\n".join(toc) + "\n")
    return sorted(set(written))


def add_to_summary(path: str, links: dict[str, str]) -> None:
    """Append links that an existing table of contents lacks."""
    text = read_text(path, "# Summary\n")
    new = [f"- [{title}]({target})" for title, target in links.items() if f"({target})" not in text]
    if new:
        write_text(path, text.rstrip("\n") + "\n" + "\n".join(new) + "\n")
