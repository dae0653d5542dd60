"""A release from end to end: build, validate, audit, tamper, publish; and the stream."""

import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from winnowry.cli import main
from winnowry.plans import publish
from winnowry.plans.release import validate_release
from winnowry.settings import Settings
from winnowry.sinks import release_status
from winnowry.streaming.curate import write_screened


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    path = tmp_path_factory.mktemp("source")
    rows = [{"id": f"id-{i}", "domain": "news" if i % 3 else "wiki, odd", "text": f"Sentence number {i} of a story\r\nthat goes on for a while."} for i in range(150)]
    rows += [{"id": "id-x", "domain": "news", "text": rows[0]["text"]}, {"id": "id-y", "domain": "news", "text": None}, {"id": "id-z", "domain": "news", "text": "short"}]
    pq.write_table(pa.Table.from_pylist(rows[:80]), path / "a.parquet")
    pq.write_table(pa.Table.from_pylist(rows[80:]), path / "b.parquet")
    return str(path)


@pytest.fixture(scope="module")
def release(spark, source, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out") / "release")
    assert main(["build", source, "--output-dir", out, "--max-documents", "100"], spark) == 0
    return out


def test_build_validates(spark, release):
    manifest = json.load(open(f"{release}/manifest.json"))
    run = manifest["run_summary"]
    assert (run["inspected"], run["candidates"], run["retained"], run["duplicates"]) == (153, 150, 100, 1)
    assert run["inspected"] == run["candidates"] + run["rejected"] and sum(run["split_counts"].values()) == 100
    assert release_status(release) == "complete" and validate_release(spark, release)["ok"]


def test_built_again_it_is_the_same(spark, source, release, tmp_path):
    assert main(["build", source, "--output-dir", str(tmp_path), "--max-documents", "100"], spark) == 0
    for s in ("train", "validation", "test"):
        assert open(f"{release}/processed/{s}.txt").read() == open(tmp_path / f"processed/{s}.txt").read()


def test_no_overwrite_unless_asked(spark, source, release, capsys):
    assert main(["build", source, "--output-dir", release], spark) == 1
    assert "overwrite" in capsys.readouterr().err


def test_audit(spark, release, tmp_path):
    args = ["audit", "--output-dir", release, "--audit-dir", str(tmp_path / "a"), "--review-dir", str(tmp_path / "r"), "--near-duplicates"]
    assert main(args, spark) == 0
    summary = json.load(open(tmp_path / "a/audit_summary.json"))
    assert summary["audited"] == 100 and summary["worst_drift"]["drift_pp"]["domain"] in ("news", "wiki, odd")
    for f in ("a/quality_signals.csv", "a/samples_to_review.csv", "a/domain_drift.csv", "a/domain_distribution.svg", "a/length_histogram.svg", "a/near_duplicate_pairs.csv", "r/review_packet.csv", "r/review_packet.html"):
        assert os.path.getsize(tmp_path / f)


def test_publishing(spark, release, tmp_path):
    assert publish.verify_copy(spark, release, release)["ok"]
    plan = publish.plan_upload(release, publish.propose_repo_id("me", "base"))
    assert plan["private"] and "manifest.json" in plan["files"] and "RELEASE_COMPLETE" not in plan["files"]
    hits = publish.scan_for_secrets("hf_" + "a1B2" * 6 + " and /Users/me")
    assert len(hits) == 2 and "a1B2a1B2" not in hits[0]
    assert publish.scan_for_secrets("nothing here") == []
    for f in ("config.json", "model.safetensors", "tokenizer.json"):
        (tmp_path / f).write_text("{}")
    assert publish.validate_model_dir(str(tmp_path))["ok"]
    (tmp_path / "model.safetensors").unlink()
    assert not publish.validate_model_dir(str(tmp_path))["ok"]


def test_tampering_is_found(spark, release):
    path = f"{release}/processed/train.txt"
    kept = open(path).read()
    try:
        open(path, "w").write(kept.replace("story", "tale", 1))
        report = validate_release(spark, release)
        assert not report["ok"] and report["checksum_mismatches"] and not report["splits"]["train"]["round_trip"]
    finally:
        open(path, "w").write(kept)


def test_stream_screens_rows(spark, source, tmp_path):
    rows = spark.readStream.schema("id string, domain string, text string").parquet(source)
    write_screened(rows, str(tmp_path / "out"), str(tmp_path / "state"), Settings()).awaitTermination(120)
    found = spark.read.parquet(str(tmp_path / "out"))
    assert found.count() == 151 and "\r" not in found.first()["text"]
