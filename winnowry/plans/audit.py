"""A read-only audit of a release: measures, samples, drift, near duplicates, a packet to review."""

from __future__ import annotations

import csv
import os
import tempfile
from html import escape
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import charts, sinks
from ..functions.signals import SIGNALS, audit_signals
from ..functions.text import preview
from ..operators import drift, review, simhash, stats
from ..operators.sampling import smallest
from ..scratch import Scratch
from ..settings import SPLITS, Settings
from ..sources.corpus import read_distribution, read_splits


def _six(x):
    return round(x, 6) if isinstance(x, float) else x


def _stream_csv(rows: DataFrame, path: Path) -> None:
    """A table of any length as one CSV file; the driver holds one partition at a time."""
    path.parent.mkdir(parents=True, exist_ok=True)
    fd, temp = tempfile.mkstemp(prefix=f".{path.name}.", suffix=".tmp", dir=path.parent)
    with os.fdopen(fd, "w", encoding="utf-8", newline="") as f:
        w = csv.writer(f)
        w.writerow(rows.columns)
        w.writerows([_six(x) for x in r] for r in rows.toLocalIterator())
    os.replace(temp, path)


def review_html(packet: list[dict], columns: list[str]) -> str:
    cells = lambda tag, values: "<tr>" + "".join(f"<{tag}>{escape(str(v), quote=False)}</{tag}>" for v in values) + "</tr>"
    return "\n".join(['<!doctype html><meta charset="utf-8"><title>Review</title><table border="1">', cells("th", columns), *[cells("td", [r[c] for c in columns]) for r in packet], "</table>\n"])


def longest_markdown(rows: list[dict]) -> str:
    parts = ["# Longest documents\n"]
    for r in rows:
        parts.append(f"## {r['rank']}. {r['id']}\n\n{r['domain']}, {r['split']}: {r['character_count']} characters in {r['line_count']} lines\n\n> {r['preview']}\n")
    return "\n".join(parts)


def run_audit(spark: SparkSession, settings: Settings, chart: str | None = None, shown: int = 2000) -> dict:
    """Write the reports of ``settings.output_dir`` below ``audit_dir`` and ``review_dir``; return the summary.

    ``shown``: rows of the review packet that the HTML page has; the CSV has them all.
    """
    root, out, to_review = Path(settings.output_dir), Path(settings.audit_dir), Path(settings.review_dir)
    rows = read_splits(spark, str(root / "processed"))
    if settings.subset:
        rows = smallest(rows, "audit_subset", settings.seed, settings.subset)
    own = rows.select("pos", "split", "id", "domain", "text_hash", "text")
    signals = Scratch(spark, "audit").table(audit_signals(own), "signals")
    _stream_csv(signals.orderBy("pos").select("split", "id", "domain", "text_hash", *SIGNALS), out / "quality_signals.csv")

    picked = review.audit_samples(signals, settings.seed).select("id", "split", "domain", "reasons", *SIGNALS, preview(F.col("text"), 400).alias("preview"))
    _stream_csv(picked, out / "samples_to_review.csv")
    sinks.atomic_bytes(out / "longest_documents.md", longest_markdown([r.asDict() for r in review.longest(signals).collect()]).encode())

    summary: dict = {}
    listed = root / "statistics/domain_distribution.csv"
    if listed.exists():
        table = Scratch(spark, "drift").table(drift.domain_drift(read_distribution(spark, listed.as_uri()), signals.select("domain", "split")), "drift")
        _stream_csv(table.orderBy("domain"), out / "domain_drift.csv")
        summary["worst_drift"] = {k: r.asDict() if (r := drift.worst(table, k).first()) else None for k in ("drift_pp", "max_split_drift_pp")}
        sinks.atomic_bytes(chart or out / "domain_distribution.svg", charts.domain_chart([r.asDict() for r in drift.top_domains(table).collect()]).encode())
    sinks.atomic_bytes(out / "length_histogram.svg", charts.length_chart([tuple(r) for r in stats.length_histogram(signals).collect()]).encode())

    if settings.near_duplicates:
        scratch = Scratch(spark, "audit-near")
        found, grouped = simhash.find_near_duplicates(own, settings.seed, settings.simhash_threshold, settings.shingle_size)
        found, grouped = scratch.table(found, "pairs"), scratch.table(grouped, "clusters")
        order = found.orderBy("distance", F.desc("jaccard"), "id_a", "id_b").withColumn("jaccard", F.round("jaccard", 4))
        _stream_csv(order, out / "near_duplicate_pairs.csv")
        _stream_csv(grouped.orderBy("cluster", "id"), out / "near_duplicate_clusters.csv")
        summary["near_duplicates"] = simhash.summary(own, found, grouped).first().asDict()
        sinks.write_json(out / "near_duplicate_summary.json", summary["near_duplicates"])

    packet = review.review_packet(signals, settings.policy, settings.thresholds)
    columns = ["id", "split", "domain", "signals", "proposed", *SIGNALS, "preview"]
    packet = Scratch(spark, "review").table(packet.withColumn("preview", preview(F.col("text"), 400)).select(*columns), "packet").orderBy("signals", "id")
    _stream_csv(packet, to_review / "review_packet.csv")
    by = review.by_signal(packet).orderBy("signal")
    _stream_csv(by, to_review / "review_by_signal.csv")
    some = ["id", "domain", "signals", "proposed", "character_count", "preview"]
    sinks.atomic_bytes(to_review / "review_packet.html", review_html([r.asDict() for r in packet.limit(shown).collect()], some).encode())

    top = signals.agg(F.count("*").alias("audited"), F.max("character_count").alias("max_length"), F.median("character_count").alias("median_length")).first().asDict()
    verdict = packet.groupBy("proposed").count().collect()
    summary |= top | {
        "splits": {s: 0 for s in SPLITS} | {r["split"]: r["count"] for r in signals.groupBy("split").count().collect()},
        "sample_reasons": {r["reasons"]: r["count"] for r in picked.groupBy("reasons").count().orderBy("reasons").collect()},
        "proposed": {"reject": 0, "review": 0} | {r["proposed"]: r["count"] for r in verdict},
    }
    sinks.write_json(out / "audit_summary.json", summary)
    return summary
