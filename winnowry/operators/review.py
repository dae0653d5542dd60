"""What a person should look at: samples of extremes, long documents, flagged documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.hashing import stable_float
from ..functions.text import preview
from ..settings import Policy, Thresholds
from . import rules

#: name: (signal, descending, rows); random goes by a stable number.
SELECTIONS = {
    "shortest": ("character_count", False, 20),
    "longest": ("character_count", True, 50),
    "highest_url_ratio": ("url_char_ratio", True, 20),
    "highest_repeated_line_ratio": ("repeated_line_ratio", True, 20),
    "highest_punctuation_ratio": ("punctuation_ratio", True, 20),
    "lowest_alpha_ratio": ("alpha_ratio", False, 20),
    "most_unusual_unicode": ("unusual_unicode_count", True, 20),
    "html_heavy": ("html_tag_count", True, 20),
}
RANDOM = 100
#: Flags of a review, in order, and the bounds they use.
VERY_LOW_VI, LOW_VI, LOW_ALPHA, HUGE, FEW_LINES = 0.001, 0.05, 0.5, 100_000, 100


def audit_samples(signals: DataFrame, seed: int = 42, random: int = RANDOM) -> DataFrame:
    """Documents of nine selections, one row each, with the names of those they are in; ties in the order of ``pos``.

    Each selection is a top-k that keeps k rows per task; only ids, places and keys go through it, no text.  Ratios
    are compared as they are shown, to six places.
    """
    picked = [signals.select("id", "pos", stable_float("audit_random", seed, F.col("id")).alias("k")).orderBy("k", "pos").limit(random).select("id", F.lit("random").alias("name"))]
    for name, (signal, down, take) in SELECTIONS.items():
        key = F.round(F.col(signal), 6) if signal.endswith("_ratio") else F.col(signal)
        rows = signals.select("id", "pos", key.alias("k"))
        picked.append(rows.orderBy(F.desc("k") if down else F.asc("k"), "pos").limit(take).select("id", F.lit(name).alias("name")))
    names = picked[0]
    for p in picked[1:]:
        names = names.unionByName(p)
    # at most as many rows as the selections take together
    names = names.groupBy("id").agg(F.array_join(F.sort_array(F.collect_set("name")), "|").alias("reasons"))
    return signals.join(F.broadcast(names), "id").orderBy("reasons", "id")


def ranked_longest(signals: DataFrame, take: int = 15) -> DataFrame:
    """The longest rows, whatever columns they have, with their rank."""
    top = signals.orderBy(F.desc("character_count"), "pos").limit(take)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("character_count"), "pos")))


def longest(signals: DataFrame, take: int = 15, width: int = 400) -> DataFrame:
    """rank, id, domain, split, counts and a preview of the longest documents."""
    return ranked_longest(signals, take).select("rank", "id", "domain", "split", "character_count", "line_count", "paragraph_count", "url_count", "url_char_ratio", "repeated_line_ratio", "repeated_paragraph_ratio", "html_tag_count", preview(F.col("text"), width).alias("preview"))

#: The signals that flags are told by.
FLAG_SIGNALS = ("character_count", "line_count", "replacement_char_count", "unusual_unicode_count", "non_latin_script_share", "max_line_length", "vietnamese_diacritic_ratio", "alpha_ratio", "vni_pattern_count")


def flags(th: Thresholds = Thresholds()) -> tuple[Column, dict[str, Column]]:
    """An array of a document's flags, and the four rules, from the columns of the audit's signals."""
    c = {s: F.col(s) for s in ("character_count", "replacement_char_count", "unusual_unicode_count", "non_latin_script_share", "max_line_length")}
    met = rules.checks(c, th)
    vi = F.round("vietnamese_diacritic_ratio", 6)
    tests = {
        "very_low_vietnamese": vi < VERY_LOW_VI,
        "low_vietnamese": vi < LOW_VI,
        "low_alpha": F.round("alpha_ratio", 6) < LOW_ALPHA,
        "replacement_chars": F.col("replacement_char_count") >= 1,
        "unusual_unicode": F.col("unusual_unicode_count") >= 1,
        "vni_pattern": F.col("vni_pattern_count") >= 3,
        **met,
        "extreme_length_few_lines": (F.col("character_count") > HUGE) & (F.col("line_count") < FEW_LINES),
    }
    return F.array_compact(F.array(*[F.when(t, F.lit(k)) for k, t in tests.items()])), met


def review_packet(signals: DataFrame, policy: Policy = Policy(), th: Thresholds = Thresholds()) -> DataFrame:
    """One row for each flagged document: signals (sorted, by bars), proposed (reject or review), then its columns."""
    found, met = flags(th)
    reject = rules.rejection(met, policy).isNotNull()
    rows = signals.withColumn("_flags", found).filter(F.size("_flags") > 0)
    return rows.withColumn("signals", F.array_join(F.array_sort("_flags"), "|")).withColumn("proposed", F.when(reject, "reject").otherwise("review")).drop("_flags")


def by_signal(packet: DataFrame) -> DataFrame:
    return packet.select(F.explode(F.split("signals", r"\|")).alias("signal"), "proposed").groupBy("signal").agg(F.count("*").alias("documents"), F.count_if(F.col("proposed") == "reject").alias("proposed_reject"))
