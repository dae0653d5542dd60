"""Cleaning of texts, as Column expressions.  Lengths are code points throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str.strip() sees it; Java's \\s knows ASCII alone.
WS_NO_LF = r"\t\x0b-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WS = r"\n" + WS_NO_LF


#: Category Cc but for line feeds and tabs, one by one: of these Java makes a table, of ranges a chain of tests.
CONTROLS = "[" + "".join(rf"\x{c:02x}" for c in (*range(0x00, 0x09), *range(0x0B, 0x20), *range(0x7F, 0xA0))) + "]"
#: What Unicode 16, which ICU knows, made combining or composing: unassigned to Python 3.13 and DuckDB, and inert there.
SINCE_16 = r"\x{897}\x{105C0}-\x{105FF}\x{10D40}-\x{10D8F}\x{11380}-\x{113FF}\x{16100}-\x{1613F}\x{16D40}-\x{16D7F}\x{1E5D0}-\x{1E5FF}"
#: A code point that composes with nothing.
INERT = "\uf8f0"


def _bound(t: Column, step) -> Column:
    """``step`` of a text that is worked out once, however often the step names it."""
    return F.transform(F.array(t), step)[0]


def _where(test, step):
    """Only texts that meet a cheap test take a costly step, which leaves the others as they are."""
    return lambda c: F.when(test(c), step(c)).otherwise(c)


def ascii_only(t: Column) -> Column:
    return F.octet_length(t) == F.length(t)


def line_endings(t: Column) -> Column:
    return _bound(t, _where(lambda c: F.contains(c, F.lit("\r")), lambda c: F.regexp_replace(c, r"\r\n?", "\n")))


def nfc(t: Column) -> Column:
    """Unicode NFC.  Only texts with a code point from U+0300 on can change.

    ICU, which is among Spark's own jars, composes them in the JVM: a Python function would be sent every row, as Spark
    evaluates those ahead of the branches of a condition, and would hold batches of whole texts in each worker.
    Code points that only ICU knows are kept apart: each is put between two inert ones, which are taken out again.
    """

    def icu(c: Column) -> Column:
        return F.call_function("java_method", F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(False))

    apart = lambda c: F.regexp_replace(icu(F.regexp_replace(c, f"([{SINCE_16}])", f"{INERT}$1{INERT}")), f"{INERT}([{SINCE_16}]){INERT}", "$1")
    return _bound(t, lambda c: F.when(ascii_only(c) | ~c.rlike(r"[^\x00-\x{2FF}]"), c).when(F.contains(c, F.lit("\u0897")) | c.rlike(r"[\x{10000}-\x{1FFFF}]"), apart(c)).when(c.isNotNull(), icu(c)))


def without_controls(t: Column) -> Column:
    """Category Cc goes, but for line feeds and tabs."""
    return F.regexp_replace(t, CONTROLS, "")


def collapsed_lines(t: Column) -> Column:
    """Runs of spaces and tabs to one space, none at the start of a line, no white space at its end.  The text has no other controls."""
    t = _bound(t, _where(lambda c: F.contains(c, F.lit("  ")) | F.contains(c, F.lit("\t")), lambda c: F.regexp_replace(c, r"[\t ]+", " ")))
    t = _bound(t, _where(lambda c: F.contains(c, F.lit("\n ")) | F.startswith(c, F.lit(" ")), lambda c: F.regexp_replace(c, r"(^|\n) ", "$1")))
    general = lambda c: F.regexp_replace(c, rf"[{WS_NO_LF}]+(\n|\z)", "$1")
    rare = lambda c: ~ascii_only(c) & (c.rlike(r"[\x{2000}-\x{205f}]") | F.contains(c, F.lit("\xa0")) | F.contains(c, F.lit("\u3000")) | F.contains(c, F.lit("\u1680")))
    spaces = _where(lambda c: F.contains(c, F.lit(" \n")) | F.endswith(c, F.lit(" ")), lambda c: F.regexp_replace(c, r" +(\n|\z)", "$1"))
    return _bound(t, lambda c: F.when(rare(c), general(c)).otherwise(spaces(c)))


def collapsed_blank_lines(t: Column) -> Column:
    """One blank line in a row at most, none at either end."""
    return F.btrim(_bound(t, _where(lambda c: F.contains(c, F.lit("\n\n\n")), lambda c: F.regexp_replace(c, r"\n{3,}", "\n\n"))), F.lit("\n"))


def clean(t: Column) -> Column:
    return collapsed_blank_lines(collapsed_lines(without_controls(nfc(line_endings(t)))))


def meaningful(t: Column) -> Column:
    """Whether there is a letter or a number."""
    return t.rlike(r"[\p{L}\p{N}]")


def blank(t: Column) -> Column:
    return t.isNull() | ~t.rlike(rf"[^{WS}]")


def inspect(raw: Column, cleaned: Column, min_chars: int = 20, max_chars: int | None = None) -> Column:
    """Why a document is turned away by its text alone; null if it is not.  Bounds are on the cleaned text."""
    n = F.length(cleaned)
    reason = F.when(blank(raw) | (cleaned == ""), "empty_text").when(~meaningful(cleaned), "invalid_text").when(n < min_chars, "too_short")
    return reason if max_chars is None else reason.when(n > max_chars, "too_long")


def shortened(t: Column, limit: int = 200) -> Column:
    """For display: the first characters, and a remark if there are more."""
    return F.when(F.length(t) > limit, F.concat(F.substring(t, 1, limit), F.lit("…[truncated]"))).otherwise(t)


def preview(t: Column, limit: int = 200) -> Column:
    """One line for a table cell: line breaks spelled out, then cut; an ellipsis if anything is hidden or was a break."""
    shown = F.substring(F.replace(F.replace(t, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r")), 1, limit)
    more = (F.length(t) > limit) | F.contains(F.substring(t, 1, limit), F.lit("\n"))
    return F.when(more, F.concat(shown, F.lit("…"))).otherwise(shown)


def json_string(t: Column) -> Column:
    """A text as a JSON string: what stands between the brackets of an array of it."""
    made = F.to_json(F.array(t))
    return F.substring(made, F.lit(2), F.length(made) - 2)


def from_json_string(line: Column) -> Column:
    return F.from_json(F.concat(F.lit("["), line, F.lit("]")), "array<string>")[0]
