"""Two charts in SVG, drawn from small collected tables."""

from __future__ import annotations

from html import escape

POPULATIONS = (("inspected_pct", "inspected", "#4c78a8"), ("accepted_pct", "accepted", "#f2a541"), ("retained_pct", "retained", "#54a24b"))


def _svg(width: int, height: int, body: list[str], title: str) -> str:
    head = f'<svg xmlns="http://www.w3.org/2000/svg" viewBox="0 0 {width} {height}" font-family="sans-serif" font-size="12"><title>{escape(title)}</title>'
    return "\n".join([head, f'<rect width="{width}" height="{height}" fill="white"/>', f'<text x="12" y="22" font-size="15">{escape(title)}</text>', *body, "</svg>\n"])


def domain_chart(rows: list[dict]) -> str:
    """Bars of three populations' percentages for each row of top_domains."""
    full = max([r[c] for r in rows for c, _, _ in POPULATIONS], default=0) or 1
    body = [f'<text x="{220 + 110 * k}" y="44" fill="{color}">{name}</text>' for k, (_, name, color) in enumerate(POPULATIONS)]
    for i, r in enumerate(rows):
        top = 56 + 44 * i
        body.append(f'<text x="150" y="{top + 20}" text-anchor="end">{escape(str(r["domain"]))}</text>')
        for k, (c, _, color) in enumerate(POPULATIONS):
            long = 480 * r[c] / full
            body.append(f'<rect x="160" y="{top + 12 * k}" width="{long:.1f}" height="10" fill="{color}"/><text x="{165 + long:.1f}" y="{top + 9 + 12 * k}" font-size="9">{r[c]:.2f}</text>')
    return _svg(720, 70 + 44 * len(rows), body, "Share of each domain, %")


def length_chart(bins: list[tuple[int, int]], width: int = 1000) -> str:
    """Columns of document counts by length; the last bin is open."""
    full = max([n for _, n in bins], default=0) or 1
    body = []
    for k, n in bins:
        high, x = 200 * n / full, 40 + 60 * k
        label = f"{k * width}+" if k == len(bins) - 1 else f"{k * width}"
        body.append(f'<rect x="{x}" y="{250 - high:.1f}" width="50" height="{high:.1f}" fill="#4c78a8"/><text x="{x + 25}" y="{245 - high:.1f}" text-anchor="middle">{n}</text><text x="{x + 25}" y="266" text-anchor="middle">{label}</text>')
    return _svg(60 + 60 * max(1, len(bins)), 280, body, "Documents by length in characters")
