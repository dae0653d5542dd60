"""python -m winnowry build | audit | validate | publish ...: exit code 0 if all went well, 1 if not."""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import fields

from pyspark.sql import SparkSession

from .plans import publish
from .plans.audit import run_audit
from .plans.build import build_corpus
from .plans.release import validate_release
from .settings import ALIASES, DEDUP_BACKENDS, LOADERS, MODES, RULE_REASONS, Policy, Settings


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="winnowry", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)
    b = sub.add_parser("build", help="make a release from a source")
    b.add_argument("source")
    b.add_argument("--mode", default="smoke", choices=[*MODES, *ALIASES])
    b.add_argument("--revision")
    b.add_argument("--output-dir", default="data")
    for name, kind in (("max-documents", int), ("scan-limit", int), ("seed", int), ("min-chars", int), ("max-chars", int), ("sample-size", int), ("rejected-sample-size", int), ("train-ratio", float), ("val-ratio", float)):
        b.add_argument(f"--{name}", type=kind)
    for name in ("text-field", "id-field", "domain-field", "source-split"):
        b.add_argument(f"--{name}")
    b.add_argument("--dedup-backend", choices=DEDUP_BACKENDS)
    b.add_argument("--loader", choices=LOADERS)
    b.add_argument("--overwrite", action="store_true")
    b.add_argument("--compat-percentiles", action="store_true", help="report the 91st and 92nd percentile as p95 and p99")
    for rule in RULE_REASONS:
        b.add_argument(f"--{rule.replace('_', '-')}", action=argparse.BooleanOptionalAction, default=None, help="whether this rule rejects")
    a = sub.add_parser("audit", help="measure a release")
    a.add_argument("--output-dir", default="data")
    a.add_argument("--audit-dir", default="audit")
    a.add_argument("--review-dir", default="review")
    a.add_argument("--chart")
    a.add_argument("--near-duplicates", action="store_true")
    for name in ("seed", "simhash-threshold", "shingle-size", "subset"):
        a.add_argument(f"--{name}", type=int)
    v = sub.add_parser("validate", help="check a release")
    v.add_argument("--output-dir", default="data")
    p = sub.add_parser("publish", help="plan an upload, compare a copy, check a model folder")
    step = p.add_subparsers(dest="step", required=True)
    d = step.add_parser("dataset")
    d.add_argument("release_dir")
    d.add_argument("--repo-id", required=True)
    d.add_argument("--public", action="store_true")
    c = step.add_parser("verify")
    c.add_argument("release_dir")
    c.add_argument("copy_dir")
    m = step.add_parser("model-check")
    m.add_argument("model_dir")
    return top


def settings_of(args: argparse.Namespace) -> Settings:
    """What was given on the command line; the rest as the settings have it."""
    names = {f.name for f in fields(Settings)}
    given = {k: v for k, v in vars(args).items() if k in names and v is not None}
    rules = {r: v for r in RULE_REASONS if (v := getattr(args, r, None)) is not None}
    return Settings(**given, policy=Policy(**rules))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    session = lambda: spark or SparkSession.builder.appName("winnowry").getOrCreate()
    try:
        if args.command == "build":
            said = build_corpus(session(), settings_of(args))["run_summary"]
        elif args.command == "audit":
            said = run_audit(session(), settings_of(args), args.chart)
        elif args.command == "validate":
            said = validate_release(session(), args.output_dir)
        elif args.step == "dataset":
            publish.write_checksums(args.release_dir)
            said = publish.plan_upload(args.release_dir, args.repo_id, not args.public)
        elif args.step == "verify":
            said = publish.verify_copy(session(), args.release_dir, args.copy_dir)
        else:
            said = publish.validate_model_dir(args.model_dir)
    except (OSError, RuntimeError, ValueError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    print(json.dumps(said, indent=2, ensure_ascii=False, default=str))
    return 0 if said.get("ok", True) else 1
