"""Cleaning, rules, deduplication, sampling against plain Python models and stated values."""

import hashlib
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from winnowry import queries
from winnowry.functions import signals as S
from winnowry.functions.hashing import split_of, stable_float
from winnowry.functions.text import clean, inspect
from winnowry.operators import rules, simhash
from winnowry.operators.dedup import dedup, open_dedup
from winnowry.operators.sampling import reservoir, with_ordinal
from winnowry.settings import Policy, Settings


def plain_clean(t):
    t = unicodedata.normalize("NFC", re.sub("\r\n?", "\n", t))
    t = "".join(c for c in t if c in "\n\t" or unicodedata.category(c) != "Cc")
    lines = [" ".join(p for p in x.replace("\t", " ").split(" ") if p).rstrip() for x in t.split("\n")]
    return re.sub("\n{3,}", "\n\n", "\n".join(lines)).strip("\n")


def column(spark, values, expr, schema="t string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, " + schema)
    return [r[0] for r in rows.orderBy("i").select(expr).collect()]


def test_clean_equals_a_plain_model(spark):
    rng = random.Random(4)
    alphabet = "ab \t\n\r\x00\x1f  éé.\U0001f600\x85"
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(0, 40))) for _ in range(800)]
    assert column(spark, texts, clean(F.col("t"))) == [plain_clean(t) for t in texts]


def test_reasons(spark):
    texts = [None, "  \n ", "\x00", "!!! ???", "short", "just long enough to be kept", "x" * 60]
    got = column(spark, texts, inspect(F.col("t"), clean(F.col("t")), 20, 50))
    assert got == ["empty_text", "empty_text", "empty_text", "invalid_text", "too_short", None, "too_long"]


@pytest.mark.parametrize(
    ("text", "policy", "reason"),
    [
        ("a sentence that has ��� inside", Policy(), "encoding_corruption"),
        ("a sentence that has two �� inside it", Policy(), None),
        ("zero width " + "​" * 10 + " signs in it", Policy(), "binary_or_invalid_content"),
        ("Привет " * 10, Policy(), None),
        ("Привет " * 10, Policy(foreign_script_dominant=True), "foreign_script_dominant"),
        ("word " * 4001, Policy(concatenated_dump=True), "concatenated_dump"),
        ("a sentence that has ��� inside", Policy(encoding_corruption=False, binary_or_invalid_content=False), None),
    ],
)
def test_rules(spark, text, policy, reason):
    t = F.col("t")
    assert column(spark, [text], rules.reason_of(t, t, S.rule_signals(t), policy=policy)) == [reason]


def sequential(stream):
    ids, hashes, out = set(), set(), []
    for i, h in stream:
        why = "duplicate_id" if i in ids else "duplicate_text" if h in hashes else None
        if why is None:
            ids.add(i)
            hashes.add(h)
        out.append(why)
    return out


def decided(spark, stream, parts=3):
    rows = spark.createDataFrame([(k, *x) for k, x in enumerate(stream)], "seq long, id string, text_hash string").repartition(parts)
    return [r["duplicate"] for r in dedup(rows).orderBy("seq").collect()]


def test_rejected_rows_register_nothing(spark):
    stream = [("A", "1"), ("B", "1"), ("B", "2")]
    assert decided(spark, stream) == [None, "duplicate_text", None]


@pytest.mark.parametrize("seed", range(3))
def test_dedup_equals_the_stream(spark, seed):
    rng = random.Random(seed)
    stream = [(f"i{rng.randrange(25)}", f"h{rng.randrange(25)}") for _ in range(60)]
    assert decided(spark, stream, 1 + 4 * seed) == sequential(stream)


def test_dedup_of_nothing_and_backends(spark):
    assert decided(spark, []) == []
    assert open_dedup("sqlite") is open_dedup("memory")
    with pytest.raises(ValueError):
        open_dedup("tape")


def u(*parts):
    return int(hashlib.sha256("|".join(map(str, parts)).encode()).hexdigest()[:16], 16) / 2**64


def test_stable_float_and_split(spark):
    ids = [f"id-{i}" for i in range(2000)]
    assert column(spark, ids, stable_float("split", 7, F.col("t"))) == [u("split", 7, i) for i in ids]
    splits = column(spark, ids, split_of(F.col("t"), 7))
    assert 0.87 < splits.count("train") / 2000 < 0.93 and set(splits) == {"train", "validation", "test"}


@pytest.mark.parametrize("capacity", [1, 7, 5000])
def test_reservoir_equals_the_stream(spark, capacity):
    slots = {}
    for i in range(1, 2001):
        at = i - 1 if i <= capacity else int(u("reservoir", 42, i) * i)
        if at < capacity:
            slots[at] = i
    rows = with_ordinal(spark.range(2000).withColumn("seq", F.col("id") * 3).repartition(5), "seq")
    assert {r["slot"]: r["i"] for r in reservoir(rows, capacity).collect()} == slots


def plain_simhash(text, seed=42, n=4):
    grams = {text[i : i + n] for i in range(max(1, len(text) - n + 1))} if text else set()
    votes = [0] * 64
    for g in grams:
        h = int(hashlib.sha256(f"simhash|{seed}|{g}".encode()).hexdigest()[:16], 16)
        for b in range(64):
            votes[b] += 1 if h >> b & 1 else -1
    f = sum(1 << b for b in range(64) if votes[b] > 0)
    return f - (1 << 64) if f >= 1 << 63 else f


def test_fingerprints_and_shingles(spark):
    texts = ["", "abc", "the quick brown fox", "é😀xyz" * 20]
    assert column(spark, texts, simhash.fingerprint(F.col("t"))) == [plain_simhash(t) for t in texts]
    got = column(spark, texts, simhash.shingles(F.col("t")))
    assert [set(x) for x in got] == [{t[i : i + 4] for i in range(max(1, len(t) - 3))} if t else set() for t in texts]


def test_near_duplicate_chain_is_one_cluster(spark):
    base = "a long enough sentence about rivers, boats and the people on them. " * 6
    docs = spark.createDataFrame([("a", "train", base), ("b", "test", base + "!"), ("c", "train", base + "!!"), ("z", "train", "nothing of the kind is said in this other text, not at all")], "id string, split string, text string")
    pairs, clusters = simhash.find_near_duplicates(docs, threshold=5)
    assert {(r["id_a"], r["id_b"]) for r in pairs.collect()} >= {("a", "b")}
    assert {r["id"] for r in clusters.collect()} <= {"a", "b", "c"}
    cross = {(r["id_a"], r["id_b"]): r["cross_split"] for r in pairs.collect()}
    assert cross["a", "b"] is True


def test_every_copy_is_a_member_of_its_cluster(spark, tmp_path):
    base = "a long enough sentence about rivers, boats and the people on them. " * 6
    texts = ["nothing of the kind is said in this other text, not at all"] * 40 + [base, base, base, "alone in the world, as no other text has any of these words"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"file://{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.near_dup_members(spark, f"file://{tmp_path}").collect()}
    want = [(0, 40)] * 40 + [(40, 3)] * 3 + [(43, 1)]
    assert [(got[i]["label"], got[i]["size"]) for i in range(44)] == want == [(got[i]["id"], got[i]["size"]) for i in range(44)]
    assert [got[i]["fp"] for i in range(44)] == [plain_simhash(t) for t in texts]


def test_settings():
    s = Settings(mode="dev").resolved().checked()
    assert (s.max_documents, s.scan_limit, s.dedup_backend, s.loader) == (20_000, 500_000, "memory", "datasets")
    assert Settings(scan_limit=0).resolved().scan_limit is None
    with pytest.raises(ValueError):
        Settings(mode="none").resolved()
    with pytest.raises(ValueError):
        Settings(train_ratio=0.9, val_ratio=0.2).resolved().checked()
