"""The four rejection rules: each a predicate on a text's signals, with thresholds and a policy."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import inspect
from ..settings import RULE_REASONS, Policy, Thresholds


def checks(signals: dict[str, Column], th: Thresholds = Thresholds()) -> dict[str, Column]:
    """Whether each rule is met, whatever the policy."""
    n = signals["character_count"]
    unusual = signals["unusual_unicode_count"]
    return {
        "encoding_corruption": signals["replacement_char_count"] >= th.replacement_chars,
        "binary_or_invalid_content": F.when(n > 0, (unusual >= th.unusual_count) & (unusual / n >= th.unusual_ratio)).otherwise(F.lit(False)),
        "foreign_script_dominant": signals["non_latin_script_share"] > th.non_latin_share,
        "concatenated_dump": signals["max_line_length"] > th.line_length,
    }


def rejection(met: dict[str, Column], policy: Policy = Policy()) -> Column:
    """The first rule that the policy enables and that is met; null if there is none."""
    on = policy.enabled()
    if not on:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.when(met[r], F.lit(r)) for r in RULE_REASONS if r in on])


def reason_of(raw: Column, cleaned: Column, signals: dict[str, Column], min_chars: int = 20, max_chars: int | None = None, policy: Policy = Policy(), th: Thresholds = Thresholds()) -> Column:
    """Why a document is turned away, by cleaning first and rules second."""
    first = inspect(raw, cleaned, min_chars, max_chars)
    if not policy.enabled():
        return first
    return F.coalesce(first, rejection(checks(signals, th), policy))
