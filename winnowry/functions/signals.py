"""Measures of a text: those that rules decide on and the twenty of an audit, as Column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import small_batches
from .text import CONTROLS, WS, ascii_only

#: Code point ranges of the scripts whose share is measured.
SCRIPTS = {
    "armenian": r"\x{530}-\x{58F}",
    "arabic": r"\x{600}-\x{6FF}\x{750}-\x{77F}\x{8A0}-\x{8FF}",
    "greek": r"\x{370}-\x{3FF}\x{1F00}-\x{1FFF}",
    "cyrillic": r"\x{400}-\x{52F}",
    "hebrew": r"\x{590}-\x{5FF}",
    "thai": r"\x{E00}-\x{E7F}",
    "devanagari": r"\x{900}-\x{97F}",
    "hangul": r"\x{AC00}-\x{D7AF}",
    "cjk": r"\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}",
    "hiragana": r"\x{3040}-\x{309F}",
    "katakana": r"\x{30A0}-\x{30FF}",
}
ANY_SCRIPT = "[" + "".join(SCRIPTS.values()) + "]"
#: Letter, question mark, lower-case letter: what a legacy encoding leaves behind.
VNI = r"[A-Za-z]\?[a-z\x{e0}-\x{1ef9}]"
REPLACEMENT = r"\x{FFFD}"
#: Format, private use and control characters; unassigned ones are not among them (see UNUSUAL_AUDIT).
UNUSUAL = r"[\p{Cf}\p{Co}\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]"
#: As the audit counts: every code point that is no letter, mark, number, punctuation, symbol or separator.
UNUSUAL_AUDIT = r"[^\p{L}\p{M}\p{N}\p{P}\p{S}\p{Z}\n\t\r]"
URL = rf"https?://[^{WS}<>'\"]+|www\.[^{WS}<>'\"]+"
TAG = r"<[a-zA-Z/][^>]*>"
DIACRITICS = (
    "ăâđêôơưáàảãạắằẳẵặấầẩẫậéèẻẽẹếềểễệíìỉĩị"
    "óòỏõọốồổỗộớờởỡợúùủũụứừửữựýỳỷỹỵ"
)
VIETNAMESE = f"[{DIACRITICS}{DIACRITICS.upper()}]"
#: Category P below U+0080.
PUNCTUATION = r"[!\x22#%&'()*,\-./:;?@\[\\\]_{}]"
PARAGRAPH = r"\n[ \t]*\n"
TOKEN_CAP = 5_000


def count(t: Column, pattern: str) -> Column:
    return F.regexp_count(t, F.lit(pattern)).cast("long")


def count_beyond(t: Column, pattern: str) -> Column:
    """``count`` of a pattern that no ASCII character meets."""
    return F.when(ascii_only(t), F.lit(0).cast("long")).otherwise(count(t, pattern))


def unusual(t: Column, pattern: str) -> Column:
    """``count`` of UNUSUAL or UNUSUAL_AUDIT, which in ASCII are the controls but for tab, line feed and carriage return."""
    return F.when(ascii_only(t), count(t, CONTROLS.replace(r"\x0d", ""))).otherwise(count(t, pattern))


def letters(t: Column) -> Column:
    """How many there are; what stands between words is taken out in runs, which is less to find than each letter."""
    return F.length(F.when(ascii_only(t), F.regexp_replace(t, "[^A-Za-z]+", "")).otherwise(F.regexp_replace(t, r"\P{L}+", ""))).cast("long")


def by_ascii(t: Column, ascii_pattern: str, pattern: str) -> Column:
    """``count`` of a pattern, which in ASCII is the simpler one."""
    return F.when(ascii_only(t), count(t, ascii_pattern)).otherwise(count(t, pattern))


def blanks(t: Column) -> Column:
    """Tabs, line feeds and category Zs: what a text is shorter by without the common ones, and the others."""
    bare = t
    for c in " \t\n":
        bare = F.replace(bare, F.lit(c), F.lit(""))
    return (F.length(t) - F.length(bare)).cast("long") + count_beyond(t, r"[\xa0\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]")


def vietnamese(t: Column) -> Column:
    """``count`` of VIETNAMESE in three parts, each by one table or range; the letters between them are rare, and looked for first."""
    letters_of = DIACRITICS + DIACRITICS.upper()
    low = "[" + "".join(c for c in letters_of if ord(c) < 0x100) + "]"
    rest = "[" + "".join(c for c in letters_of if 0x100 <= ord(c) < 0x1EA0) + "]"
    between = F.when(t.rlike(r"[\x{102}-\x{1b0}]"), count(t, rest)).otherwise(F.lit(0).cast("long"))
    return F.when(ascii_only(t), F.lit(0).cast("long")).otherwise(count(t, low) + count(t, r"[\x{1ea0}-\x{1ef9}]") + between)


def share(part: Column, t: Column) -> Column:
    return F.when(F.length(t) > 0, part / F.length(t)).otherwise(F.lit(0.0))


def non_latin_share(t: Column) -> Column:
    """The greatest share of a single script; texts without any such character are told by cheaper searches first."""
    most = F.greatest(*[F.regexp_count(t, F.lit(f"[{r}]")) for r in SCRIPTS.values()])
    return F.when(~ascii_only(t) & t.rlike(r"[^\x00-\x{36f}]") & t.rlike(ANY_SCRIPT), most / F.length(t)).otherwise(F.lit(0.0))


def vni_count(t: Column) -> Column:
    """Distinct matches: one broken word, repeated, is no broken text."""
    found = F.size(F.array_distinct(F.regexp_extract_all(t, F.lit(VNI), F.lit(0)))).cast("long")
    return F.when(~F.contains(t, F.lit("?")), F.lit(0).cast("long")).otherwise(found)


def max_line_length(t: Column) -> Column:
    return F.array_max(F.transform(F.split(t, "\n", -1), lambda x: F.length(x))).cast("long")


def rule_signals(t: Column) -> dict[str, Column]:
    return {
        "character_count": F.length(t).cast("long"),
        "replacement_char_count": count_beyond(t, REPLACEMENT),
        "unusual_unicode_count": unusual(t, UNUSUAL),
        "max_line_length": max_line_length(t),
        "non_latin_script_share": non_latin_share(t),
        "vni_pattern_count": vni_count(t),
    }


def _not_blank(units: Column) -> Column:
    return F.filter(units, lambda x: x.rlike(rf"[^{WS}]"))


def _runs(units: Column) -> Column:
    """Of a list: ``repeated``, how many units occur more than once, and ``distinct``.  One pass over the sorted list."""
    zero = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("repeated"), F.lit(0).alias("distinct"))

    def step(acc, x):
        same = x.eqNullSafe(acc["last"])
        more = F.when(same & (acc["run"] == 1), 2).when(same, 1).otherwise(0)
        return F.struct(x.alias("last"), F.when(same, acc["run"] + 1).otherwise(1).alias("run"), (acc["repeated"] + more).alias("repeated"), (acc["distinct"] + F.when(same, 0).otherwise(1)).alias("distinct"))

    return F.aggregate(F.sort_array(units), zero, step)


def repetition_ratio(units: Column) -> Column:
    return F.when(F.size(units) > 0, _runs(units)["repeated"] / F.size(units)).otherwise(F.lit(0.0))


def tokens(t: Column, cap: int = TOKEN_CAP) -> Column:
    return F.slice(F.filter(F.split(t, f"[{WS}]+", -1), lambda x: x != ""), 1, cap)


def repeated_ngrams(t: Column, cap: int = TOKEN_CAP) -> Column:
    """Of runs of three words, among the first ``cap`` words: the repeated ones over the distinct ones; can exceed 1.

    A Python function, as str.split() parts words where WS does; a lambda for each run costs ten times as much.  Batches
    of texts are as large as the session says (``small_batches``).
    """

    @F.pandas_udf("double")
    def ratio(texts: pd.Series) -> pd.Series:
        from collections import Counter

        def of(x: str | None) -> float:
            words = (x or "").split(None, cap)[:cap]
            found = Counter(zip(words, words[1:], words[2:]))
            distinct = len(found)
            # repeated: all occurrences of runs that are there more than once
            return sum(c for c in found.values() if c > 1) / distinct if distinct else 0.0

        return texts.map(of).astype("float64")

    return ratio(t)


#: The audit's measures in order; those that end in _ratio are doubles.
SIGNALS = (
    "character_count line_count paragraph_count url_count url_char_ratio repeated_line_ratio repeated_paragraph_ratio alpha_ratio digit_ratio "
    "whitespace_ratio punctuation_ratio replacement_char_count html_tag_count max_line_length unusual_unicode_count vietnamese_char_count "
    "vietnamese_diacritic_ratio repeated_ngram_ratio non_latin_script_share vni_pattern_count"
).split()


def audit_signals(df: DataFrame, text: str = "text", only: tuple[str, ...] = ()) -> DataFrame:
    """The rows with the twenty measures, unrounded; or with those of ``only``, in that order.

    Lists of lines, paragraphs and addresses become columns first, so that each is made once; they are dropped again.
    """
    t = F.col(text)
    rows = df.withColumn("_lines", F.split(t, "\n", -1)).withColumn("_paragraphs", _not_blank(F.split(t, PARAGRAPH, -1))).withColumn("_urls", F.regexp_extract_all(t, F.lit(URL), F.lit(0)))
    full = _not_blank(F.col("_lines"))
    diacritics = vietnamese(t) + count_beyond(t, r"\p{M}")
    made = {
        "character_count": F.length(t).cast("long"),
        "line_count": F.size("_lines").cast("long"),
        "paragraph_count": F.size("_paragraphs").cast("long"),
        "url_count": F.size("_urls").cast("long"),
        "url_char_ratio": share(F.aggregate("_urls", F.lit(0), lambda a, x: a + F.length(x)), t),
        "repeated_line_ratio": repetition_ratio(full),
        "repeated_paragraph_ratio": repetition_ratio(F.col("_paragraphs")),
        "alpha_ratio": share(letters(t), t),
        "digit_ratio": share(by_ascii(t, "[0-9]", r"\p{N}"), t),
        "whitespace_ratio": share(blanks(t), t),
        "punctuation_ratio": share(by_ascii(t, PUNCTUATION, r"\p{P}"), t),
        "replacement_char_count": count_beyond(t, REPLACEMENT),
        "html_tag_count": count(t, TAG),
        "max_line_length": F.array_max(F.transform("_lines", lambda x: F.length(x))).cast("long"),
        "unusual_unicode_count": unusual(t, UNUSUAL_AUDIT),
        "vietnamese_char_count": diacritics,
        "vietnamese_diacritic_ratio": share(diacritics, t),
        "non_latin_script_share": non_latin_share(t),
        "vni_pattern_count": vni_count(t),
    }
    names = only or SIGNALS
    if "repeated_ngram_ratio" in names:
        small_batches(df.sparkSession)
        made["repeated_ngram_ratio"] = repeated_ngrams(t)
    return rows.select(*df.columns, *[made[s].alias(s) for s in names])
