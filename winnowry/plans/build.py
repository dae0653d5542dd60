"""Building a corpus: source, decisions, sample, splits, files, statistics, manifest, marker.

``output_dir`` is a folder that driver and executors share.
"""

from __future__ import annotations

import hashlib
import platform
import resource
import subprocess
import sys
import time
from datetime import UTC, datetime
from pathlib import Path

import pyspark
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..functions.text import shortened
from ..operators import stats
from ..operators.dedup import open_dedup
from ..scratch import Scratch
from ..settings import SPLITS, Settings
from ..sources.corpus import hadoop_path, read_source
from .decisions import decide


def peak_memory_mb() -> float:
    """Of the driver's Python process alone."""
    return round(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024, 1)


def git_commit(path: str | Path) -> str | None:
    try:
        found = subprocess.run(["git", "rev-parse", "HEAD"], cwd=path, capture_output=True, text=True, timeout=10)
    except (OSError, subprocess.TimeoutExpired):
        return None
    return found.stdout.strip() or None


def source_revision(spark: SparkSession, settings: Settings) -> str | None:
    """The pinned revision, or a hash over the names, sizes and times of a source's files."""
    if settings.revision:
        return settings.revision
    p, fs = hadoop_path(spark, settings.source)
    if not fs.exists(p):
        return None
    h = hashlib.sha256()
    for s in sorted(fs.listStatus(p), key=lambda s: s.getPath().getName()):
        h.update(f"{s.getPath().getName()}|{s.getLen()}|{s.getModificationTime()}\n".encode())
    return h.hexdigest()


def length_statistics(kept: DataFrame, settings: Settings) -> dict:
    found = stats.length_summary(kept, compat_percentiles=settings.compat_percentiles).first().asDict()
    return found | {"mean": None if found["mean"] is None else round(found["mean"], 2)}


def build_corpus(spark: SparkSession, settings: Settings) -> dict:
    """Write a release and return its manifest.  FileExistsError if there is one and it may not be overwritten."""
    settings = settings.resolved().checked()
    open_dedup(settings.dedup_backend)
    root = Path(settings.output_dir)
    there = [f for f in [*sinks.expected_files(), "manifest.json"] if (root / f).exists()]
    if there and not settings.overwrite:
        raise FileExistsError(f"{root} holds {', '.join(there)}; pass overwrite to replace them")
    (root / sinks.MARKER).unlink(missing_ok=True)
    sinks.sweep_temp_files(str(root))
    began = time.time()
    table = Scratch(spark, "build").table(decide(read_source(spark, settings), settings), "decided")
    kept = table.filter("retained")
    for s in SPLITS:
        sinks.write_split(kept, str(root / "processed"), s)
    run = stats.run_stats(table).first().asDict()
    run["split_counts"] = {r["split"]: r["n"] for r in stats.split_counts(kept).collect()}
    seconds = time.time() - began
    rate = lambda n: round(n / seconds, 1) if seconds else None
    performance = {"runtime_seconds": round(seconds, 1), "source_documents_per_second": rate(run["inspected"]), "accepted_documents_per_second": rate(run["retained"]), "driver_peak_memory_mb": peak_memory_mb()}
    sinks.write_json(root / "statistics/preprocessing_stats.json", run | performance)
    domains = stats.domain_distribution(table).orderBy("domain").collect()
    sinks.write_csv(root / "statistics/domain_distribution.csv", ["domain", "inspected", "accepted"], [tuple(r) for r in domains])
    removed = [tuple(r) for r in stats.removal_counts(table).collect()]
    sinks.write_csv(root / "statistics/removal_counts.csv", ["reason", "count"], [*removed, ("total", sum(n for _, n in removed))])
    sinks.write_json(root / "statistics/length_statistics.json", length_statistics(kept, settings))
    shown = [shortened(F.col("raw")).alias("before"), shortened(F.col("text")).alias("after")]
    first = table.filter(F.col("slot") < settings.max_documents).orderBy("i").limit(settings.sample_size).select("id", "domain", *shown).collect()
    sinks.write_csv(root / "samples/before_after_examples.csv", ["id", "domain", "before", "after"], [tuple(r) for r in first])
    bad = stats.rejected_examples(table, settings.rejected_sample_size).orderBy("reason", "place").select("reason", "id", "domain", shown[0].alias("text")).collect()
    sinks.write_csv(root / "samples/rejected_examples.csv", ["reason", "id", "domain", "text"], [tuple(r) for r in bad])
    counts = {f"processed/{s}.parquet": run["split_counts"][s] for s in SPLITS}
    manifest = {
        "status": "complete", "generated_at": datetime.now(UTC).isoformat(timespec="seconds"), "dataset": settings.source, "requested_dataset_revision": settings.revision,
        "resolved_dataset_revision": source_revision(spark, settings), "source_split": settings.source_split, "configuration": settings.effective(), "seed": settings.seed,
        "git_commit": git_commit(root), "environment": {"python": sys.version.split()[0], "platform": platform.platform(), "spark": spark.version, "pyspark": pyspark.__version__, "java": spark.sparkContext._jvm.System.getProperty("java.version")},
        "performance": performance, "run_summary": run, "dedup": {"backend": settings.dedup_backend, "ids_retained": run["candidates"], "hashes_retained": run["candidates"]},
        "outputs": {f: {"row_count": counts.get(f), "sha256": sinks.sha256_file(root / f)} for f in sinks.expected_files() if f != sinks.MARKER},
    }
    sinks.write_json(root / "manifest.json", manifest)
    sinks.atomic_bytes(root / sinks.MARKER, b"")
    return manifest
