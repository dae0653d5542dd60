"""Language identification by Bayesian fusion of evidence.

For each row, the posterior of a language multiplies
* the likelihood of its text: byte trigrams against each language's smoothed trigram distribution, tempered so that a
  long text counts as ``EFFECTIVE`` trigrams at most and other evidence keeps a say;
* the likelihood of the language that its markup declares, and of its address suffix, each from a table of how often
  they go with a language;
* a prior of its host, smoothed hierarchically: the host's counts toward those of its registered domain (the host
  without the labels in front), these toward the whole; a host that is its own domain, or has no dot, has no middle
  level.  The address suffix is evidence of its own.

All tables come from grouped aggregation over all rows: trigram counts from rows with a declared language, the others
from the posteriors that text and declaration alone give.  A row's own share is taken out of its host's counts.
Posteriors are summed as multiples of 2^-20, which add up exactly: no result depends on the order of rows.

The languages are those that rows declare, and ``UNKNOWN``: a class whose trigrams are all as likely, so that a text
whose trigrams no declared language has is its.

What is collected is bounded by the number of languages (codes of two or three letters), not by the rows: trigram
counts (``BUCKETS`` for each).  Declared codes, suffixes and hosts are joined by their true value, not collected; a
value with a third of all rows is summed up before the shuffle, and joined by broadcast if the table is small.

A row is rejected if its text has no letter, if it is of no known language, or if no language reaches ``least`` of the
posterior.

Edge cases: null text is empty; null or unknown declarations, suffixes and hosts add no evidence; rows that repeat
count as often as they stand; an empty table gives no row; further columns are kept by ``accepted`` and ignored by
``identify``.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: The class of texts in none of the declared languages.
UNKNOWN = "unknown"
BUCKETS = 1 << 12
#: Trigrams that a text's likelihood counts for at most.
EFFECTIVE = 60.0
#: Weight of the level above in the prior of a host, in rows.
SMOOTH = 5.0
#: Posteriors are rounded to one in so many.
SHARES = float(1 << 20)
#: The largest table of hosts, codes or suffixes that is broadcast, in bytes.
BROADCAST_BYTES = 16 << 20

_SKIP = re.compile(r"(?is)<(script|style|nav|head)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")


def visible(markup: str) -> str:
    """The text of a page: without tags, scripts, styles, navigation and comments."""
    return html_lib.unescape(_SKIP.sub(" ", markup))


_KEEP = np.zeros(256, np.uint8)
for _b in range(256):
    _c = chr(_b)
    _KEEP[_b] = ord(_c.lower()) if _b < 128 and _c.isalpha() else _b if _b >= 128 else 32


def trigrams(text: str) -> np.ndarray:
    """Buckets of the byte trigrams of the words of a text, each word with a space on either side."""
    b = np.frombuffer(b" " + text.lower().encode("utf-8", "surrogatepass") + b" ", np.uint8)
    b = _KEEP[b]
    keep = np.ones(len(b), bool)
    keep[1:] = (b[1:] != 32) | (b[:-1] != 32)  # one space in a row
    b = b[keep].astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.int64)
    h = b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]
    return ((h * np.uint32(0x9E3779B1)) >> np.uint32(20)).astype(np.int64)


def evidence_of_documents(docs: DataFrame) -> DataFrame:
    """Documents as rows of evidence: the declared language is ``lang``, the host is ``source``."""
    none = F.lit(None)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), none.cast("long").alias("page_id"), F.coalesce("text", F.lit("")).alias("text"), F.lit(False).alias("markup"), _code(F.col("lang")).alias("declared"), none.cast("string").alias("suffix"), F.col("source").alias("host"), _domain(F.col("source")).alias("parent"))


def evidence_of_pages(pages: DataFrame) -> DataFrame:
    """Pages as rows of evidence: the markup's lang attribute, the address's suffix and host, the host's parent."""
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1))
    rows = pages.select(F.lit(None).cast("long").alias("doc_id"), F.col("page_id").cast("long").alias("page_id"), F.coalesce("html", F.lit("")).alias("text"), F.lit(True).alias("markup"), _code(F.regexp_extract(F.coalesce("html", F.lit("")), r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", 1)).alias("declared"), F.nullif(host, F.lit("")).alias("host"))
    return rows.select("doc_id", "page_id", "text", "markup", "declared", F.regexp_extract("host", r"\.([a-z0-9-]+)$", 1).alias("suffix"), "host", _domain(F.col("host")).alias("parent"))


def _domain(host: Column) -> Column:
    """The last two labels of a host (three where a label of two or three letters stands before a country), null if it has no more."""
    found = F.regexp_extract(host, r"\.([^.]+\.(?:[a-z]{2,3}\.[a-z]{2}|(?![a-z]{2,3}\.[a-z]{2}$)[^.]+))$", 1)
    return F.nullif(found, F.lit(""))


def _code(c: Column) -> Column:
    c = F.lower(F.regexp_extract(F.coalesce(c, F.lit("")), r"^\s*([A-Za-z]{2,3})(?![A-Za-z])", 1))
    return F.nullif(c, F.lit(""))


def declared_languages(rows: DataFrame) -> tuple[str, ...]:
    return tuple(sorted(r[0] for r in rows.filter("declared is not null").select("declared").distinct().collect()))


def train(rows: DataFrame, languages: tuple[str, ...]) -> np.ndarray:
    """Log probabilities, languages and UNKNOWN x buckets, from the rows that declare one of ``languages``."""

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sums = np.zeros((len(languages), BUCKETS), np.int64)
        index = {x: i for i, x in enumerate(languages)}
        for batch in batches:
            for text, markup, lang in zip(batch.column("text").to_pylist(), batch.column("markup").to_pylist(), batch.column("declared").to_pylist(), strict=True):
                sums[index[lang]] += np.bincount(trigrams(visible(text) if markup else text), minlength=BUCKETS)
        lang, bucket = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(bucket), pa.array(sums[lang, bucket])], ["lang", "bucket", "n"])

    counted = rows.filter(F.col("declared").isin(*languages)).select("text", "markup", "declared").mapInArrow(count, "lang long, bucket long, n long")
    table = np.full((len(languages) + 1, BUCKETS), 0.5)
    for r in counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect():  # languages x buckets at most
        table[r["lang"], r["bucket"]] += r["n"]
    return np.log(table / table.sum(axis=1, keepdims=True))


def likelihoods(rows: DataFrame, model: np.ndarray, languages: tuple[str, ...]) -> DataFrame:
    """Adds t0.. (log likelihood of the text for each language, tempered, the greatest 0) and letters."""
    names = [f"t{i}" for i in range(len(languages))]
    keep = ["doc_id", "page_id", "declared", "suffix", "host", "parent"]

    def score(batches: Iterator) -> Iterator:
        import pyarrow as pa

        table = model.T.copy()
        for batch in batches:
            out = np.zeros((batch.num_rows, table.shape[1]))
            letters = np.zeros(batch.num_rows, bool)
            for i, (text, markup) in enumerate(zip(batch.column("text").to_pylist(), batch.column("markup").to_pylist(), strict=True)):
                if markup:
                    text = visible(text)
                t = trigrams(text)
                letters[i] = any(map(str.isalpha, text))
                if len(t):
                    s = np.bincount(t, minlength=BUCKETS) @ table
                    s *= min(1.0, EFFECTIVE / len(t))
                    out[i] = s - s.max()
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *[pa.array(out[:, k]) for k in range(out.shape[1])], pa.array(letters)], [*keep, *names, "letters"])

    return rows.select(*keep, "text", "markup").mapInArrow(score, "doc_id long, page_id long, declared string, suffix string, host string, parent string, " + "".join(f"{n} double, " for n in names) + "letters boolean")


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _matrix(batch, names: list[str]) -> np.ndarray:
    """Columns of a batch as doubles, null as 0."""
    return np.stack([batch.column(c).fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64) for c in names], axis=1) if names else np.zeros((batch.num_rows, 0))


def _small(table: DataFrame, columns: int) -> DataFrame:
    """A written table, to be broadcast if its size allows."""
    return F.broadcast(table) if table.count() * (32 + 8 * columns) <= BROADCAST_BYTES else table


def _evidence(rows: DataFrame, value: str, p: list[str], names: list[str], scratch: Scratch) -> DataFrame:
    """value, names: log of how a value's share among a language's rows compares with its share among all."""
    counts = scratch.table(rows.filter(F.col(value).isNotNull() & (F.col(value) != "")).groupBy(value).agg(*[F.sum(c).alias(c) for c in p]), f"{value}-counts")
    total = counts.agg(F.count("*"), *[F.sum(c) for c in p]).first()
    values, sums = total[0], [float(x or 0) for x in total[1:]]
    every = sum((F.col(c) for c in p), F.lit(0.0)) / max(1.0, sum(sums))
    shares = [(F.log((F.col(c) + 10 * every + 1e-6) / (n + 10 + 1e-6 * values)) - F.log(every + 1e-6)).alias(k) for c, k, n in zip(p, names, sums, strict=True)]
    return _small(scratch.table(counts.select(value, *shares), f"{value}-evidence"), len(p))


def identify(rows: DataFrame, languages: tuple[str, ...] | None = None, least: float = 0.5) -> DataFrame:
    """doc_id, page_id, lang, confidence, rejected for rows of evidence; ``languages`` are those declared if not given."""
    scratch = Scratch(rows.sparkSession, "langid")
    known = declared_languages(rows) if languages is None else tuple(languages)
    model, languages = train(rows, known), (*known, UNKNOWN)
    n = range(len(languages))
    scored = scratch.table(likelihoods(rows, model, languages), "scored")
    t, p, h, q, d, x = ([f"{c}{i}" for i in n] for c in "tphqdx")
    # The text alone tells how far a declaration is to be trusted
    told = with_posterior(scored.filter("letters"), t, p, None)
    by_code, by_suffix = _evidence(told, "declared", p, d, scratch), _evidence(told, "suffix", p, x, scratch)
    first = with_posterior(scored.join(by_code, "declared", "left"), t, p, d)
    # Counts by host, parent and all, each level smoothed toward the one above
    # A host that is null stands apart: no row joins it
    hosts = first.filter("host is not null").groupBy("host").agg(F.first("parent").alias("parent"), *[F.sum(x).alias(f"h{i}") for i, x in enumerate(p)])
    hosts = scratch.table(hosts, "hosts")
    whole = hosts.agg(*[F.sum(f"h{i}") for i in n]).first()
    whole = [float(x or 0) + 1 for x in whole]
    whole = [x / sum(whole) for x in whole]
    parents = hosts.filter("parent is not null").groupBy("parent").agg(*[F.sum(f"h{i}").alias(f"q{i}") for i in n])
    known = hosts.join(parents, "parent", "left")
    known = _small(scratch.table(known.select("host", *h, *q), "priors"), 2 * len(languages))
    joined = first.join(by_suffix, "suffix", "left").join(known, "host", "left").select("doc_id", "page_id", "letters", *d, *x, *t, *p, *h, *q)
    share = np.array(whole)

    def fuse(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            own = _matrix(batch, p)
            # a row's own share is no evidence for itself
            of_parent, of_host = (np.maximum(_matrix(batch, c) - own, 0) for c in (q, h))
            parent = (of_parent + SMOOTH * share) / (of_parent.sum(axis=1, keepdims=True) + SMOOTH)
            prior = (of_host + SMOOTH * parent) / (of_host.sum(axis=1, keepdims=True) + SMOOTH)
            post = _softmax(_matrix(batch, t) + _matrix(batch, d) + _matrix(batch, x) + np.log(prior))
            best = post.argmax(axis=1)
            sure = post[np.arange(len(best)), best]
            letters = batch.column("letters").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("page_id"), pa.array([languages[i] for i in best], pa.string()), pa.array(sure), pa.array(~letters | (best == len(languages) - 1) | (sure < least))], ["doc_id", "page_id", "lang", "confidence", "rejected"])

    return joined.mapInArrow(fuse, "doc_id long, page_id long, lang string, confidence double, rejected boolean")


def with_posterior(scored: DataFrame, t: list[str], p: list[str], d: list[str] | None) -> DataFrame:
    """Adds the posterior that the text and, if its columns are given, the declared language give."""
    names = scored.columns

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            scores = _matrix(batch, t)
            if d is not None:
                scores = scores + _matrix(batch, d)
            post = np.round(_softmax(scores) * SHARES) / SHARES if batch.num_rows else scores
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(post[:, i]) for i in range(len(p))]], [*names, *p])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in scored.schema.fields)
    return scored.mapInArrow(run, schema + "".join(f", {c} double" for c in p))


def accepted(docs: DataFrame, languages: tuple[str, ...] | None = None, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` (columns of documents) that are not rejected; rows without doc_id stay."""
    gone = identify(evidence_of_documents(docs), languages, least).filter("rejected and doc_id is not null").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
