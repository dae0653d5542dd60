"""Document quality by co-training two views: what a text says, and what its metadata say.

The text view has hashed words and shares of kinds of characters and lines; the metadata view has source, language and
length.  Each view has a logistic model.  In each round, each model scores all unlabelled rows; those of which it is
most sure (a share of all rows at either end, by quantiles of the scores, that grows with the rounds) are labelled so
for the other model, which learns from its labelled rows and these.  In the end each model is calibrated (Platt) on
labelled rows that neither has learned from (on all, if these lack a label), and the calibrated log odds are combined
by a logistic model on the same rows.  All documents are scored.

Labelled rows go to the driver, at most ``labelled`` of them, those with the least hash of their id (of rows that share
an id, one).  Pseudo-labelled rows do not: what a model learns from them is the gradient and the curvature of their
loss at its present weights, summed up by executors, so their number has no bound and the driver gets as many numbers
for any.  They weigh half as much as labelled rows each, and no more than these together.  Features are written once,
in half precision.

Edge cases: a null text is empty and scored by the same models; null metadata are a value of their own; labels that
are null are no labels, a document with several labels counts as often; without labels of both kinds every score is
0.5; rows that repeat are scored each; an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, lean

#: The most labelled rows that the models are fit on.
LABELLED = 8_000
WORDS = 512
STATS = 12
META = 64 + 16 + 12
ROUNDS, SHARE = 3, 0.05


class TextView:
    """Features of texts.  Words' hashes are remembered up to a bound."""

    def __init__(self):
        import xxhash

        class Words(dict):
            def __missing__(self, w: str) -> int:
                v = self[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) % WORDS
                return v

        self.known = Words()

    def of(self, text: str) -> np.ndarray:
        out = np.zeros(WORDS + STATS, np.float32)
        if len(self.known) > 500_000:
            self.known.clear()
        words = text.lower().split()
        n, chars = len(words), max(1, len(text))
        if n:
            out[:WORDS] = np.bincount(np.fromiter(map(self.known.__getitem__, words), np.int64, n), minlength=WORDS)
            out[:WORDS] = np.sqrt(out[:WORDS] / n) * 4
        b = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        upper = int(((b >= 65) & (b <= 90)).sum())
        digit = int(((b >= 48) & (b <= 57)).sum())
        alpha = int(((b >= 97) & (b <= 122)).sum()) + upper + int((b >= 192).sum())
        space = int(((b == 32) | (b == 10) | (b == 9)).sum())
        odd = len(b) - int(((b >= 128) & (b < 192)).sum()) - alpha - digit - space
        lines = text.split("\n")
        out[WORDS:] = [
            upper / chars * 5, digit / chars * 5, odd / chars * 5, space / chars * 3, alpha / chars,
            np.log1p(n) / 4, (chars / max(1, n)) / 10, len(set(words)) / max(1, n),
            1 - len(set(lines)) / len(lines), np.log1p(chars / len(lines)) / 5,
            sum(w.isalpha() for w in words) / max(1, n), 1.0,
        ]
        return out


def meta_of(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    import xxhash

    out = np.zeros(META, np.float32)
    out[xxhash.xxh3_64_intdigest(f"s{source}") % 64] = 1
    out[64 + xxhash.xxh3_64_intdigest(f"l{lang}") % 16] = 1
    out[80 + min(10, max(0, n_chars or 0).bit_length() // 2)] = 1
    out[-1] = 1
    return out


@dataclass
class Hints:
    """Pseudo-labelled rows as a model sees them: how many, gradient and curvature of their loss at its weights."""

    n: int
    gradient: np.ndarray
    curvature: np.ndarray
    at: np.ndarray


def fit(x: np.ndarray, y: np.ndarray, hints: Hints | None = None, steps: int = 150, penalty: float = 1e-3) -> np.ndarray:
    """Weights of a logistic model, by accelerated gradient steps."""
    w = np.zeros(x.shape[1])
    v = w.copy()
    share = min(0.5, len(y) / hints.n) if hints and hints.n else 0.0
    total = len(y) + (share * hints.n if share else 0)
    size = 4.0 / max(1e-9, float((x.astype(np.float64) ** 2).sum(axis=1).mean()))
    for k in range(steps):
        g = x.T @ (_sigmoid(x @ v) - y)
        if share:
            g = g + share * (hints.gradient + hints.curvature @ (v - hints.at))
        new = v - size * (g / total + penalty * v)
        v = new + k / (k + 3) * (new - w)
        w = new
    return w


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Model:
    """Weights of both views and of what calibrates and combines them."""

    text: np.ndarray
    meta: np.ndarray
    platt: np.ndarray  # (slope, offset) of either view
    mix: np.ndarray  # weights of the calibrated log odds, offset

    def views(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(self.platt[i, 0] * (x @ w) + self.platt[i, 1] for i, (x, w) in enumerate(((text, self.text), (meta, self.meta))))

    def score(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        a, b = self.views(text, meta)
        return _sigmoid(self.mix[0] * a + self.mix[1] * b + self.mix[2])


Exchange = Callable[[list[np.ndarray], float, float], tuple[Hints, Hints]]


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, exchange: Exchange, rounds: int = ROUNDS, share: float = SHARE) -> Model | None:
    """None without both labels.  Every fifth labelled row is held out for calibration.

    ``exchange(weights, share, good)`` labels the surest ``share`` of all rows by either model (``good`` of them as
    good) and gives what each model learns from the other's.
    """
    held = np.arange(len(y)) % 5 == 4
    if len(set(y[~held].tolist())) < 2:
        return None
    learn = ~held
    if len(set(y[held].tolist())) < 2:
        held[:] = True
    own, target = (text[learn], meta[learn]), y[learn].astype(float)
    weights = [fit(x, target) for x in own]
    for k in range(rounds):
        hints = exchange(weights, share * (k + 1), float(target.mean()))
        weights = [fit(x, target, h) for x, h in zip(own, hints, strict=True)]
    platt = []
    for x, w in zip((text[held], meta[held]), weights, strict=True):
        s = x @ w
        platt.append(fit(np.stack([s, np.ones_like(s)], axis=1), y[held].astype(float), steps=300))
    model = Model(*weights, np.array(platt), np.array([1.0, 1.0, 0.0]))
    a, b = model.views(text[held], meta[held])
    model.mix = fit(np.stack([a, b, np.ones_like(a)], axis=1), y[held].astype(float), steps=300)
    return model


def confident(scores: np.ndarray, low: float, high: float) -> np.ndarray:
    """1 or 0 where a model is sure, else -1: beyond the quantiles, and at odds of e to 1 at least."""
    return np.where((scores >= high) & (scores > 1), 1, np.where((scores <= low) & (scores < -1), 0, -1))


def sums(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Of the rows with a label (not -1): curvature, gradient and number, as one array of d rows and d + 2 columns."""
    x, y = x[y >= 0].astype(np.float64), y[y >= 0]
    p = _sigmoid(x @ w)
    out = np.zeros((len(w), len(w) + 2))
    out[:, :-2] = x.T @ (x * (p * (1 - p))[:, None])
    out[:, -2] = x.T @ (p - y)
    out[0, -1] = len(y)
    return out


def hints_of(total: np.ndarray, w: np.ndarray) -> Hints:
    return Hints(int(total[0, -1]), total[:, -2], total[:, :-2], w)


def _features(batches: Iterator) -> Iterator:
    import pyarrow as pa

    view = TextView()
    for batch in batches:
        t = [view.of(x).astype(np.float16).tobytes() for x in batch.column("text").to_pylist()]
        m = [meta_of(*r).astype(np.float16).tobytes() for r in zip(*(batch.column(c).to_pylist() for c in ("source", "lang", "n_chars")), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("chosen"), pa.array(t, pa.binary()), pa.array(m, pa.binary())], ["doc_id", "chosen", "t", "m"])


def _matrices(t: list[bytes], m: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(b"".join(x), np.float16).reshape(len(x), -1).astype(np.float32) for x in (t, m))


def _exchange(free: DataFrame) -> Exchange:
    """The exchange over all rows of ``free`` (t, m, a written table): one pass for the quantiles, one for the sums."""
    step = 32  # rows of a view's array that are summed in one place

    def run(weights: list[np.ndarray], share: float, good: float) -> tuple[Hints, Hints]:
        def score(batches: Iterator) -> Iterator:
            import pyarrow as pa

            for batch in batches:
                if batch.num_rows:
                    both = _matrices(batch.column("t").to_pylist(), batch.column("m").to_pylist())
                    yield pa.RecordBatch.from_arrays([pa.array(x @ w) for x, w in zip(both, weights, strict=True)], ["a", "b"])

        cuts = f"array({share * (1 - good)}D, {1 - share * good}D)"
        found = free.select("t", "m").mapInArrow(score, "a double, b double").selectExpr(f"percentile_approx(a, {cuts}) a", f"percentile_approx(b, {cuts}) b").first()

        def learn(batches: Iterator) -> Iterator:
            import pyarrow as pa

            total = [np.zeros((len(w), len(w) + 2)) for w in weights]
            for batch in batches:
                if batch.num_rows:
                    both = _matrices(batch.column("t").to_pylist(), batch.column("m").to_pylist())
                    y = [confident(x @ w, *cut) for x, w, cut in zip(both, weights, (found["a"], found["b"]), strict=True)]
                    for i in (0, 1):  # what the other view is sure of
                        total[i] += sums(both[i], y[1 - i], weights[i])
            rows = [(i, k, total[i][k : k + step].tobytes()) for i in (0, 1) for k in range(0, len(weights[i]), step)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.binary()), strict=True)], ["view", "first", "sums"])

        def add(key, rows):
            import pandas as pd

            return pd.DataFrame({"view": [key[0]], "first": [key[1]], "sums": [sum(np.frombuffer(x, np.float64) for x in rows["sums"]).tobytes()]})

        total = [np.zeros((len(w), len(w) + 2)) for w in weights]
        if found["a"] is not None:
            kind = "view int, first int, sums binary"
            for r in free.select("t", "m").mapInArrow(lean(learn), kind).groupBy("view", "first").applyInPandas(add, kind).collect():
                part = np.frombuffer(r["sums"], np.float64).reshape(-1, len(weights[r["view"]]) + 2)
                total[r["view"]][r["first"] : r["first"] + len(part)] = part
        return tuple(hints_of(x, w) for x, w in zip(total, weights, strict=True))

    return run


def train(found: DataFrame, some: DataFrame, rounds: int = ROUNDS) -> Model | None:
    """``found``: doc_id, chosen, t, m, a written table; ``some``: doc_id, label (0 or 1) of the chosen rows."""
    # one row for each id, however often an id stands
    rows = found.filter("chosen").groupBy("doc_id").agg(F.min(F.struct("t", "m")).alias("row"))
    own = rows.join(F.broadcast(some), "doc_id").select("label", "row.t", "row.m").toPandas()
    if not len(own):
        return None
    # the order in which rows arrive must not matter
    own = own.sort_values(["t", "m", "label"], kind="stable")
    text, meta = _matrices(list(own["t"]), list(own["m"]))
    y = own["label"].to_numpy().astype(int)
    mixed = np.random.default_rng(5).permutation(len(y))
    return co_train(text[mixed], meta[mixed], y[mixed], _exchange(found.filter("not chosen")), rounds)


def score(found: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, text_score, meta_score, quality_score, good.  No shuffle."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            n = batch.num_rows
            if model is None or not n:
                a = b = s = np.full(n, 0.5)
            else:
                t, m = _matrices(batch.column("t").to_pylist(), batch.column("m").to_pylist())
                a, b = map(_sigmoid, model.views(t, m))
                s = model.score(t, m)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(a), pa.array(b), pa.array(s), pa.array(s >= 0.5)], ["doc_id", "text_score", "meta_score", "quality_score", "good"])

    return found.select("doc_id", "t", "m").mapInArrow(run, "doc_id long, text_score double, meta_score double, quality_score double, good boolean")


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "quality", labelled: int = LABELLED, rounds: int = ROUNDS) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), "source", "lang", F.col("n_chars").cast("long").alias("n_chars"))
    given = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).filter("label is not null and doc_id is not null")
    scratch = Scratch(docs.sparkSession, "quality")
    # labels of rows that are there, at most ``labelled``: the bound of what is broadcast and of what the driver holds
    there = given.join(rows.select("doc_id").distinct(), "doc_id", "left_semi")
    some = scratch.table(there.withColumn("h", F.xxhash64(F.col("doc_id"), F.lit("quality"))).orderBy("h", "doc_id", "label").limit(labelled).select("doc_id", "label"), "some")
    ids = F.broadcast(some.select("doc_id").distinct().withColumn("chosen", F.lit(True)))
    own = rows.join(ids, "doc_id", "left").withColumn("chosen", F.coalesce("chosen", F.lit(False)))
    found = scratch.table(own.mapInArrow(lean(_features), "doc_id long, chosen boolean, t binary, m binary"), "features")
    return score(found, train(found, some, rounds))
