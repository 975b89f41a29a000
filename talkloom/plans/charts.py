"""Charts as SVG, drawn directly from small ordered tables: charts need no plotting library."""

from __future__ import annotations

from html import escape
from math import cos, pi, sin

from talkloom.sources.artifacts import write_text

COLOURS = ("#4a7ab5", "#e08b3c", "#5a9e6f", "#b5504a", "#8a6fb0", "#9a7b5f", "#d08fb8", "#7f7f7f", "#b9b44a", "#4fa7b0")
#: Scores from which clusters are told at length, and told at all.
THRESHOLDS = (("deep dive", 0.7), ("brief", 0.4))
RINGS = ("hold", "assess", "trial", "adopt")


def _write(path: str, width: int, height: int, title: str, body: list[str]) -> None:
    head = f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{height}" font-family="sans-serif" font-size="12">'
    write_text(path, "\n".join([head, _text(10, 24, title, size=16), *body, "</svg>"]) + "\n")


def _text(x: float, y: float, label: str, anchor: str = "start", size: int = 12, fill: str = "#222") -> str:
    return f'<text x="{x:.1f}" y="{y:.1f}" text-anchor="{anchor}" font-size="{size}" fill="{fill}">{escape(str(label))}</text>'


def _rect(x: float, y: float, width: float, fill: str) -> str:
    return f'<rect x="{x:.1f}" y="{y:.1f}" width="{width:.1f}" height="18" fill="{fill}"/>'


def bars(title: str, data: list[tuple[str, float]], path: str, marks: tuple[tuple[str, float], ...] = ()) -> None:
    """Horizontal bars, and a line with a label at each mark."""
    most = max([v for _, v in data] + [v for _, v in marks], default=1) or 1
    body = []
    for i, (label, v) in enumerate(data):
        y = 44 + 24 * i
        body += [
            _text(230, y + 13, str(label)[:36], "end"),
            _rect(240, y, 460 * max(0.0, v) / most, COLOURS[0]),
            _text(246 + 460 * max(0.0, v) / most, y + 13, f"{v:g}"),
        ]
    for label, v in marks:
        x = 240 + 460 * v / most
        body += [
            f'<line x1="{x:.1f}" y1="38" x2="{x:.1f}" y2="{44 + 24 * len(data)}" stroke="#888" stroke-dasharray="4"/>',
            _text(x, 36, f"{label} {v:g}", "middle", 10, "#666"),
        ]
    _write(path, 760, 60 + 24 * len(data), title, body)


def pie(title: str, data: list[tuple[str, float]], path: str) -> None:
    """Shares of a whole as sectors, with a legend."""
    total, at, body = sum(max(0.0, v) for _, v in data) or 1, 0.0, []
    for i, (label, v) in enumerate(data):
        share, colour = max(0.0, v) / total, COLOURS[i % len(COLOURS)]
        a, b = 2 * pi * at - pi / 2, 2 * pi * (at + share) - pi / 2
        at += share
        if share >= 0.9999:
            body.append(f'<circle cx="180" cy="210" r="150" fill="{colour}"/>')
        elif share > 0:
            ends = (180 + 150 * cos(a), 210 + 150 * sin(a), 180 + 150 * cos(b), 210 + 150 * sin(b))
            body.append(
                f'<path d="M180,210 L{ends[0]:.1f},{ends[1]:.1f} A150,150 0 {int(share > 0.5)} 1 {ends[2]:.1f},{ends[3]:.1f} Z" fill="{colour}" stroke="white"/>'
            )
        y = 50 + 22 * i
        body += [_rect(380, y, 18, colour), _text(406, y + 13, f"{str(label)[:40]} ({v:g}, {share * 100:.0f}%)")]
    _write(path, 760, max(390, 70 + 22 * len(data)), title, body)


def stacked(title: str, kinds: tuple[str, ...], data: list[tuple[str, tuple[float, ...]]], path: str) -> None:
    """Horizontal bars, each of one part for each kind."""
    most, body = max((sum(vs) for _, vs in data), default=1) or 1, []
    for k, kind in enumerate(kinds):
        body += [_rect(240 + 130 * k, 36, 18, COLOURS[k % len(COLOURS)]), _text(262 + 130 * k, 49, kind.replace("_", " "))]
    for i, (label, vs) in enumerate(data):
        x, y = 240.0, 66 + 24 * i
        body.append(_text(230, y + 13, str(label)[:36], "end"))
        for k, v in enumerate(vs):
            width = 460 * max(0.0, v) / most
            if width:
                body.append(_rect(x, y, width, COLOURS[k % len(COLOURS)]))
            x += width
        body.append(_text(x + 6, y + 13, f"{sum(vs):g}"))
    _write(path, 780, 84 + 24 * len(data), title, body)


def strip(title: str, data: list[tuple[str, str, str]], path: str, rings: tuple[str, ...] = RINGS) -> None:
    """A row for each technology, a column for each ring, and a dot, filled by the weight of the evidence."""
    body = [_text(290 + 110 * i, 48, ring, "middle") for i, ring in enumerate(rings)]
    shade = {"production_proven": 1.0, "benchmarked": 0.75, "case_study": 0.5}
    for i, (technology, ring, evidence) in enumerate(data):
        y = 66 + 22 * i
        at = rings.index(ring) if ring in rings else rings.index("assess")
        body += [_text(230, y + 4, technology[:36], "end"), f'<line x1="250" y1="{y}" x2="{270 + 110 * len(rings)}" y2="{y}" stroke="#eee"/>']
        body.append(f'<circle cx="{290 + 110 * at}" cy="{y}" r="7" fill="{COLOURS[0]}" fill-opacity="{shade.get(evidence, 0.25)}" stroke="{COLOURS[0]}"/>')
    _write(path, 760, 84 + 22 * len(data), title, body)


def cloud(title: str, data: list[tuple[str, float]], path: str) -> None:
    """Words in rows, heaviest first, their size by weight."""
    most, x, y, body = max((v for _, v in data), default=1) or 1, 20.0, 80.0, []
    for i, (word, v) in enumerate(data):
        size = int(12 + 30 * (max(0.0, v) / most) ** 0.5)
        width = 0.6 * size * len(word) + 14
        if x + width > 780 and x > 20:
            x, y = 20.0, y + 44
        body.append(_text(x, y, word, size=size, fill=COLOURS[i % len(COLOURS)]))
        x += width
    _write(path, 800, int(y + 40), title, body)
