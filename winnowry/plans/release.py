"""Checks of a finished release."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import from_json_string
from ..operators.stats import uniqueness
from ..settings import SPLITS
from ..sinks import leftover_temp_files, release_status, sha256_file
from ..sources.corpus import read_jsonl, read_splits


def mismatches(lines: DataFrame, rows: DataFrame) -> DataFrame:
    """How many lines (line, value: a JSON string) differ from the text of the row in the same place."""
    a = lines.select("line", from_json_string(F.col("value")).alias("a"), F.lit(True).alias("has_a"))
    b = rows.select("line", F.col("text").alias("b"), F.lit(True).alias("has_b"))
    wrong = F.col("has_a").isNull() | F.col("has_b").isNull() | ~F.col("a").eqNullSafe(F.col("b"))
    return a.join(b, "line", "full_outer").agg(F.count_if(wrong).alias("mismatches"))


def validate_release(spark: SparkSession, output_dir: str) -> dict:
    """A report with ``ok``: status, checksums, row counts, texts equal line by line, duplicates, leftovers.

    Duplicates within a split and overlaps across splits are reported apart.
    """
    root = Path(output_dir)
    report: dict = {"output_dir": output_dir, "status": release_status(output_dir)}
    if report["status"] != "complete":
        return report | {"ok": False}
    manifest = json.loads((root / "manifest.json").read_text("utf-8"))
    report |= {"dataset": manifest.get("dataset"), "revision": manifest.get("resolved_dataset_revision"), "requested_revision": manifest.get("requested_dataset_revision")}
    wrong = []
    for name, info in manifest["outputs"].items():
        if not (root / name).exists():
            wrong.append(f"{name}: missing")
        elif sha256_file(root / name) != info["sha256"]:
            wrong.append(f"{name}: checksum differs")
    report["checksum_mismatches"] = wrong
    rows = read_splits(spark, str(root / "processed"))
    extra = {r["split"]: r for r in uniqueness(rows).collect()}
    report["splits"] = {}
    for s in SPLITS:
        own = rows.filter(F.col("split") == s)
        place = own.select((F.col("pos") % (1 << 40)).alias("line"), "text")
        lines = read_jsonl(spark, str(root / "processed" / f"{s}.txt"))
        n, m = own.count(), lines.count()
        x = extra.get(s)
        report["splits"][s] = {
            "manifest_rows": manifest["outputs"][f"processed/{s}.parquet"]["row_count"], "parquet_rows": n, "jsonl_rows": m,
            "round_trip": mismatches(lines, place).first()["mismatches"] == 0, "duplicate_ids": x["extra_ids"] if x else 0, "duplicate_hashes": x["extra_hashes"] if x else 0,
        }
    every = extra["all"]
    within = lambda k: sum(e[k] for e in report["splits"].values())
    report |= {"total_rows": every["rows"], "cross_split_ids": every["extra_ids"] - within("duplicate_ids"), "cross_split_hashes": every["extra_hashes"] - within("duplicate_hashes")}
    report["leftover_temp_files"] = leftover_temp_files(output_dir)
    good = all(e["round_trip"] and e["parquet_rows"] == e["jsonl_rows"] == e["manifest_rows"] for e in report["splits"].values())
    report["ok"] = good and not wrong and not every["extra_ids"] and not every["extra_hashes"] and not report["leftover_temp_files"]
    return report
