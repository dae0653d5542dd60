"""What queries cost as tables grow: no Python where none is needed, no text kept that nothing reads, few candidates."""

import random
import unicodedata

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from winnowry.functions import signals as S
from winnowry.functions.text import CONTROLS, clean, nfc
from winnowry.operators import simhash
from winnowry.queries import QUERIES


def written(monkeypatch) -> list[list[str]]:
    """The columns of each table that a query writes to the shared folder."""
    from winnowry.scratch import Scratch

    seen, table = [], Scratch.table
    monkeypatch.setattr(Scratch, "table", lambda self, df, *a, **b: seen.append(df.columns) or table(self, df, *a, **b))
    return seen


def no_python(monkeypatch) -> None:
    def refused(*_, **__):
        raise AssertionError("a Python function, or rows from Python")

    monkeypatch.setattr(F, "pandas_udf", refused)
    monkeypatch.setattr(SparkSession, "createDataFrame", refused)


NATIVE = ["length_stats", "run_stats", "rejected_examples", "too_long", "quality_signals_chars", "reservoir_sample", "policy_reasons", "split_counts", "removal_counts"]


@pytest.mark.parametrize("name", NATIVE)
def test_texts_stay_in_the_jvm(spark, sf_dir, monkeypatch, name):
    no_python(monkeypatch)
    seen = written(monkeypatch)
    assert QUERIES[name](spark, sf_dir).count()
    assert not [c for c in seen if {"raw", "text"} & set(c)]


def test_nfc_as_python_has_it(spark):
    rnd = random.Random(1)
    known = [chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    marks = [c for c in known if unicodedata.combining(c)]
    # what Unicode 16 composes, between and beside the marks that stand for what is kept apart
    pairs = ["\U000105d2\u0307", "\U00011382\U000113c9", "\U0001611e\U0001611e", "\U00016d67\U00016d67", "\uf8f0\U00016d67\uf8f0\U00016d67\uf8f0\uf8f0", "a\u0345\u0897\u0301"]
    texts = [None, "", "abc", *known, *pairs, *["".join(rnd.choices(["e", "a", "ᄀ", "ᅡ", "ᆨ", "\U00016d63", "\U00016d67"], k=3)) + "".join(rnd.choices(marks, k=4)) for _ in range(5_000)]]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", nfc(F.col("t")).alias("n"))
    assert not [i for i, n in rows.collect() if n != (texts[i] if texts[i] is None else unicodedata.normalize("NFC", texts[i]))]


def test_cleaning_and_counts_as_plain_patterns_have_them(spark):
    """What is told by a cheap test first is what the whole pattern would give."""
    rnd = random.Random(2)
    some = [" ", "  ", "\t", "\n", "\n\n\n", "\r", "\r\n", "\x0b", "\x1f", "\x7f", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u3000", "\u200b", "a", "E", "9", "?", "e?e", ".", "ạ", "Ơ", "é", "Ω", "я", "\ufffd", "\u0301", "\ud55c", "\U0001f600"]
    texts = [None, "", " ", "\n", *some, *["".join(rnd.choices(some, k=rnd.randint(2, 12))) for _ in range(4_000)]]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    t = F.col("t")
    plain = F.regexp_replace(F.regexp_replace(t, r"\r\n?", "\n"), r"[\x00-\x08\x0b-\x1f\x7f-\x9f]", "")
    ws = r"\t\x0b-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
    for pattern, by in ((r"[\t ]+", " "), (r"(^|\n) ", "$1"), (rf"[{ws}]+(\n|\z)", "$1"), (r"\n{3,}", "\n\n"), (r"^\n+|\n+\z", "")):
        plain = F.regexp_replace(plain, pattern, by)
    norm = [(i, x if x is None else unicodedata.normalize("NFC", x)) for i, x in enumerate(texts)]
    composed = spark.createDataFrame(norm, "i int, t string")
    assert rows.select("i", clean(t)).collect() == composed.select("i", plain).collect()
    assert CONTROLS.count("\\x") == 63
    more = [chr(c) for c in range(0x3100)]
    rows = rows.union(spark.createDataFrame([(-i, x) for i, x in enumerate(more)], "i int, t string"))
    pairs = [(S.by_ascii(t, "[0-9]", r"\p{N}"), S.count(t, r"\p{N}")), (S.by_ascii(t, S.PUNCTUATION, r"\p{P}"), S.count(t, r"\p{P}")), (S.blanks(t), S.count(t, r"[ \t\n\p{Zs}]")), (S.unusual(t, S.UNUSUAL), S.count(t, S.UNUSUAL)), (S.unusual(t, S.UNUSUAL_AUDIT), S.count(t, S.UNUSUAL_AUDIT)), (S.letters(t), S.count(t, r"\p{L}")),
             (S.vietnamese(t), S.count(t, S.VIETNAMESE)), (S.count_beyond(t, r"\p{M}"), S.count(t, r"\p{M}")), (S.vni_count(t), F.size(F.array_distinct(F.regexp_extract_all(t, F.lit(S.VNI), F.lit(0)))).cast("long"))]
    got = rows.filter(t.isNotNull()).select(*[F.count_if(~a.eqNullSafe(b)) for a, b in pairs]).first()
    assert tuple(got) == (0,) * len(pairs)


AUDITED = {"longest_docs": 2, "audit_samples": 7, "review_by_signal": 9, "review_packet": 9}


@pytest.mark.parametrize("name", AUDITED)
def test_an_audit_works_out_only_what_is_read(spark, sf_dir, monkeypatch, name):
    no_python(monkeypatch)
    seen = written(monkeypatch)
    assert QUERIES[name](spark, sf_dir).count()
    assert [len(c) for c in seen] == [2 + AUDITED[name]]  # pos, id and signals; no text


def flipped(rnd, base, bits):
    for b in rnd.sample(range(64), bits):
        base ^= 1 << b
    return base


def test_pairs_are_all_within_three_bits_and_few_meet(spark):
    """Fingerprints that share a band of 16 bits but no two blocks never meet; every pair within three bits is found once."""
    rnd = random.Random(3)
    prints = [rnd.getrandbits(64) for _ in range(300)]
    for base in prints[:40]:
        prints += [flipped(rnd, base, k) for k in (0, 1, 2, 3, 3, 4)]
    prints += [(rnd.getrandbits(48) << 16) | 7 for _ in range(1_500)]
    prints = [x - (1 << 64) if x >> 63 else x for x in prints]
    rows = spark.createDataFrame(list(enumerate(prints)) + [(-1, None)], "id long, fp long")
    want = {(i, j, d) for i, x in enumerate(prints) for j in range(i + 1, len(prints)) if (d := ((x ^ prints[j]) & (1 << 64) - 1).bit_count()) <= 3}
    found = simhash.pairs(rows)
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    # rows that meet by their keys, before the distance decides; by bands of 16 bits it is over a million
    pairs_met = simhash.keyed(rows).groupBy("at", "key").count().selectExpr("sum(count * (count - 1) / 2) AS n").first().n
    assert pairs_met < 20 * len(want)


def test_fingerprints_as_they_are_defined(spark):
    """Runs as numbers, many code points, short texts and long runs: all by the definition."""
    import hashlib

    def plain(t, n):
        if t is None or not t:
            return None if t is None else 0
        runs = {t[i : i + n] for i in range(max(1, len(t) - n + 1))}
        hashes = [int.from_bytes(hashlib.sha256(f"simhash|42|{r}".encode()).digest()[:8], "big") for r in runs]
        fp = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        return fp - (1 << 64) if fp >> 63 else fp

    rnd = random.Random(4)
    texts = [None, "", "a", "abcd", "abcde", "€\U0001f600" * 9, "x" * 900, *["".join(rnd.choices("ab éạ\U0001f600", k=rnd.randint(1, 700))) for _ in range(60)], "".join(map(chr, range(0x10000, 0x10000 + 70_000)))]
    for n in (2, 4, 6):
        rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", simhash.fingerprint(F.col("t"), 42, n).alias("fp"))
        assert [r.fp for r in rows.orderBy("i").collect()] == [plain(t, n) for t in texts]


@pytest.mark.parametrize("name", ["near_dup_clusters", "near_dup_members", "near_dup_summary"])
def test_clusters_need_no_likeness_of_sets(spark, sf_dir, monkeypatch, name):
    monkeypatch.setattr(simhash, "with_jaccard", None)
    seen = written(monkeypatch)
    assert QUERIES[name](spark, sf_dir).count()
    assert not [c for c in seen if "text" in c]


@pytest.mark.parametrize("name", ["simhash", "near_dup_pairs", "near_dup_ranked"])
def test_only_texts_of_pairs_are_shuffled(spark, sf_dir, monkeypatch, name):
    seen = written(monkeypatch)
    monkeypatch.setattr(simhash, "clusters", None)
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "text" not in "".join(x for x in plan.split("\n") if "Exchange" in x)
    assert [c for c in seen if "text" in c] == ([] if name == "simhash" else [["id", "split", "text"]])


def test_runs_of_words_take_no_lambda_each(spark, sf_dir):
    plan = QUERIES["quality_signals_repetition"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_join" not in plan and "ratio(" in plan


def test_repeated_runs_of_words(spark):
    from collections import Counter

    rnd = random.Random(5)
    ws = [" ", "\t", "\n", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", " ", " ", " ", " ", "　", "​", "᠎"]
    texts = [None, "", " ", "a b", "a b c", "a b c a b c", "a " * 9_000, *["".join(rnd.choice("ab") + rnd.choice(ws) * rnd.randint(0, 2) for _ in range(rnd.randint(0, 40))) for _ in range(2_000)]]
    t = F.col("t")
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", S.repeated_ngrams(t).alias("r"), S.tokens(t).alias("w")).orderBy("i").collect()
    for i, r, w in rows:
        c = Counter(zip(w or [], (w or [])[1:], (w or [])[2:]))
        assert r == (sum(n for n in c.values() if n > 1) / len(c) if c else 0.0), texts[i]
