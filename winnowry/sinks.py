"""Writing releases: single files per split, small tables and JSON, all by a temporary name and a rename."""

from __future__ import annotations

import csv
import hashlib
import io
import json
import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions.text import json_string
from .settings import SPLITS

MARKER = "RELEASE_COMPLETE"
SCHEMA = "id string, domain string, text string, text_hash string, character_count long"


def expected_files() -> list[str]:
    """What a complete release holds, the marker last."""
    return [
        *(f"processed/{s}.parquet" for s in SPLITS), *(f"processed/{s}.txt" for s in SPLITS), "statistics/preprocessing_stats.json", "statistics/domain_distribution.csv",
        "statistics/removal_counts.csv", "statistics/length_statistics.json", "samples/before_after_examples.csv", "samples/rejected_examples.csv", MARKER,
    ]


def release_status(output_dir: str) -> str:
    """complete: marker and a manifest that says so; incomplete: some file is there; missing: none."""
    root = Path(output_dir)
    manifest = root / "manifest.json"
    try:
        said = json.loads(manifest.read_text("utf-8")).get("status")
    except (OSError, ValueError):
        said = None
    if said == "complete" and (root / MARKER).exists():
        return "complete"
    return "incomplete" if manifest.exists() or any((root / f).exists() for f in expected_files()) else "missing"


def sha256_file(path: str | Path) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def atomic_bytes(path: str | Path, data: bytes) -> None:
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    fd, temp = tempfile.mkstemp(prefix=f".{path.name}.", suffix=".tmp", dir=path.parent)
    try:
        with os.fdopen(fd, "wb") as f:
            f.write(data)
        os.chmod(temp, 0o644)
        os.replace(temp, path)
    except BaseException:
        if os.path.exists(temp):
            os.unlink(temp)
        raise


def write_csv(path: str | Path, columns: list[str], rows: list[dict] | list[tuple]) -> None:
    out = io.StringIO(newline="")
    w = csv.writer(out)
    w.writerow(columns)
    w.writerows([r.get(c) for c in columns] if isinstance(r, dict) else r for r in rows)
    atomic_bytes(path, out.getvalue().encode("utf-8"))


def write_json(path: str | Path, value: object) -> None:
    atomic_bytes(path, json.dumps(value, ensure_ascii=False, indent=2, default=str).encode("utf-8"))


def leftover_temp_files(output_dir: str) -> list[str]:
    root = Path(output_dir)
    return sorted(str(p.relative_to(root)) for d in ("processed", "statistics", "samples") for p in (root / d).glob(".*.tmp"))


def sweep_temp_files(output_dir: str) -> int:
    found = leftover_temp_files(output_dir)
    for f in found:
        p = Path(output_dir, f)
        shutil.rmtree(p) if p.is_dir() else p.unlink(missing_ok=True)
    return len(found)


def _one_file(write, target: Path) -> None:
    """Let Spark write one part file into a hidden folder beside the target, then rename it."""
    target.parent.mkdir(parents=True, exist_ok=True)
    staging = target.parent / f".{target.name}.staging.tmp"
    shutil.rmtree(staging, ignore_errors=True)
    try:
        write(staging.as_uri())
        part = next(p for p in sorted(staging.iterdir()) if p.name.startswith("part-"))
        os.replace(part, target)
    finally:
        shutil.rmtree(staging, ignore_errors=True)


def write_split(rows: DataFrame, processed: str, split: str) -> None:
    """``split``.parquet and ``split``.txt (a JSON string a line) of rows with slot, in slot order.

    One file each is what the release layout asks for; its size is bounded by the sample.
    """
    own = rows.filter(F.col("split") == split).coalesce(1).sortWithinPartitions("slot")
    table = own.select("id", "domain", "text", "text_hash", "character_count")
    if table.isEmpty():
        table = rows.sparkSession.createDataFrame([], SCHEMA).coalesce(1)
    _one_file(lambda p: table.write.parquet(p), Path(processed, f"{split}.parquet"))
    lines = table.select(json_string(F.col("text")).alias("value"))
    if table.isEmpty():
        atomic_bytes(Path(processed, f"{split}.txt"), b"")
    else:
        _one_file(lambda p: lines.write.option("lineSep", "\n").text(p), Path(processed, f"{split}.txt"))
