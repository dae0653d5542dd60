"""The ten operators against brute force, the tokenizers library or held-out rows; nulls, ties, repeats, empty tables."""

import hashlib
import itertools
import math
import random
import re
import struct
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import oracle
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from winnowry.llm import bpe, kdsearch, langid, linededup, links, neardup, packing, quality, queries, secrets, spotsigs, token_store, tokens

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, label int, key long"
ODD = ["", None, " ", "  a  b ", "Ünïcode — ﬁne 😀 don't STOP 123,456", "x" * 5000, "tab\tand\nline  \n", "<|endoftext|> inside", "é ΑΣ", "word " * 3000]


def frame(spark, texts, ids=None):
    """Documents with columns whose names the operators use inside."""
    ids = ids or range(len(texts))
    return spark.createDataFrame([(d, t, "en", "s", len(t or ""), "clash", 7, 3) for d, t in zip(ids, texts, strict=True)], DOCS).repartition(3)


def components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def alike(sets, least=0.8):
    return [(a, b) for a, b in itertools.combinations(range(len(sets)), 2) if sets[a] and sets[b] and len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]) - 1e-12]


# ---- 1


def test_languages(spark):
    say = {"en": "the river and the boat are on the way to the sea with a man", "fr": "le chat et la maison sont dans la rue avec les enfants du village", "de": "der Hund und die Katze sind auf dem Weg nach Hause mit dem Kind", "es": "el perro y la casa están en la calle con los niños del pueblo"}
    rows = [(i, say[x] + f" {i}", x if i // 4 % 2 else None, f"h{i % 3}", 0, "c", 1, 2) for i, x in enumerate(list(say) * 10)]
    docs = spark.createDataFrame([*rows, (100, None, None, None, None, None, None, None), (101, "!!! 123", "en", "h1", 0, "c", 1, 2), (None, say["fr"], "fr", "h1", 0, "c", 1, 2)], DOCS)
    got = {r["doc_id"]: r for r in langid.identify(langid.evidence_of_documents(docs)).collect()}
    assert len(got) == 43 and all(got[i]["lang"] == x and not got[i]["rejected"] for i, x in enumerate(list(say) * 10))
    assert got[100]["rejected"] and got[101]["rejected"]
    kept = langid.accepted(docs)
    assert kept.columns == docs.columns and kept.count() == 41
    assert langid.identify(langid.evidence_of_documents(docs.limit(0))).count() == 0


def test_pages_by_markup_and_suffix(spark):
    pages = spark.createDataFrame([(1, "https://www.a.example.de/x", '<html lang="de"><body>der Hund und die Katze sind auf dem Weg</body></html>'), (2, None, None)], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in langid.identify(langid.evidence_of_pages(pages)).collect()}
    assert got[1]["lang"] == "de" and got[2]["rejected"]


def test_other_languages(spark):
    say = {"en": "the river and the boat are on the way to the sea with a man", "de": "der Hund und die Katze sind auf dem Weg nach Hause mit dem Kind", "ru": "река и лодка на пути к морю вместе с человеком и собакой", "nds": "de Hunnen lopen över de groten Straten un snackt platt mit de Lüüd"}
    rows = [(i, f"{say[x]} " * 20 + f" {i}", x if i // 4 % 2 else None, f"h{i % 3}", 0, "c", 1, 2) for i, x in enumerate(list(say) * 10)]
    strange = ["河流和船只正在前往大海的路上，人们都很高兴地看着它们", "Con thuyền trên sông đang đi ra biển với một người đàn ông", "η βάρκα και το ποτάμι πηγαίνουν προς τη θάλασσα με έναν άνθρωπο"]
    rows += [(100 + i, x, None, f"h{i}", 0, "c", 1, 2) for i, x in enumerate(strange)]
    got = {r["doc_id"]: r for r in langid.identify(langid.evidence_of_documents(spark.createDataFrame(rows, DOCS))).collect()}
    assert all(got[i]["lang"] == x and not got[i]["rejected"] for i, x in enumerate(list(say) * 10))
    assert all(got[100 + i]["rejected"] for i in range(3))


# ---- 2


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), max_size=300))
def test_elias_fano(values):
    values = sorted(values)
    ef = token_store.EliasFano.from_bytes(token_store.EliasFano.of(np.array(values, np.uint64)).to_bytes())
    assert ef.to_array().tolist() == values and [ef.select(i) for i in range(len(values))] == values


@pytest.mark.parametrize("shard_ids", [500, 10**6])
def test_token_store(spark, shard_ids, tmp_path):
    texts = [*ODD, *ODD[3:5]]
    path = queries.tokenizer_path("byte_bpe_50k.json")
    docs = frame(spark, texts)
    token_store.write_tokens(docs, f"file://{tmp_path}/s", path, 2, shard_ids=shard_ids)
    got = token_store.documents_of(token_store.read_tokens(spark, f"file://{tmp_path}/s")).orderBy("doc_id").collect()
    tok, at = tokens.load(path), 0
    for r, t in zip(got, texts, strict=True):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        at += len(ids)
    assert token_store.store(docs.limit(0), path, 2).count() == 0


def test_token_store_repeated_and_missing_ids(spark):
    path = queries.tokenizer_path("byte_bpe_50k.json")
    got = token_store.store(frame(spark, ["b c", "a", None, "a", "word", "x y z"], [5, 5, 5, None, None, 1]), path, 2).collect()
    tok = tokens.load(path)
    n = lambda t: len(tok.encode(t, add_special_tokens=False).ids) + 1
    rows = sorted(got, key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, None, 1, 5, 5, 5] and sorted(r["n_tokens"] for r in rows[3:]) == sorted([n("b c"), n("a"), 1])
    assert [r["start"] for r in rows] == [sum(x["n_tokens"] for x in rows[:k]) for k in range(6)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "Wort", " ", "  ", "\n", "\t", ".", ",", "é", "don't", "12", "\u2028", "<|endoftext|>", "ΑΣ", "\r", "\x1c", "x\ny"]), max_size=12))
def test_chunks_have_the_ids_of_the_whole(parts):
    for name, glued in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        enc = tokens.encoder(queries.tokenizer_path(name), glued) if glued else CHUNKED
        text = "".join(parts)
        ids = enc.tok.encode(text, add_special_tokens=False).ids
        assert enc.encode(text) == struct.pack(f"<{len(ids)}I", *ids)


CHUNKED = tokens.ChunkEncoder(tokens.load(queries.tokenizer_path("word_bpe_49k.json")), False)


# ---- 3


def test_quality_on_held_out_rows(spark):
    rng = random.Random(1)
    good = lambda: " ".join(rng.choices("the river ran past old stone houses while people walked home".split(), k=60))
    bad = lambda: " ".join(rng.choices("BUY!!! $$$ click 999 free>>> win# now!!".split(), k=60))
    texts = [good() if i % 2 else bad() for i in range(400)]
    docs = frame(spark, [*texts, None])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["good"] for r in quality.classify(docs, labels).collect()}
    assert len(got) == 401 and sum(got[i] == bool(i % 2) for i in range(200, 400)) > 190
    assert {r["quality_score"] for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(docs.limit(0), labels).count() == 0


def test_quality_exchange_over_all_rows(spark):
    """Each view learns from the other: the words of unlabelled rows are known through their sources alone, and the sums are those of plain arrays."""
    rng = random.Random(3)
    words = lambda good, old: " ".join(rng.choices(("stone river house" if good else "prize offer click").split() if old else ("meadow harbour lantern" if good else "jackpot casino bonus").split(), k=40))
    rows = [(i, words(i % 2, i < 80), "en", f"s{i % 2}", 200, "c", 7, 3) for i in range(600)]
    rows += [(1000 + i, words(i % 2, False), "en", f"t{i}", 200, "c", 7, 3) for i in range(60)] + [(3, words(1, True), "en", "s1", 200, "c", 7, 3)] * 5
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    right = lambda rounds: sum((r["text_score"] >= 0.5) == bool(r["doc_id"] % 2) for r in quality.classify(docs, labels, rounds=rounds).filter("doc_id >= 1000").collect())
    assert right(3) > 57 and right(0) < 50
    view = quality.TextView()
    t, m = quality._matrices([view.of(r[1]).astype(np.float16).tobytes() for r in rows], [quality.meta_of(r[3], r[2], r[4]).astype(np.float16).tobytes() for r in rows])
    w = [np.random.default_rng(1).normal(size=x.shape[1]) for x in (t, m)]
    found = spark.createDataFrame([(x.astype(np.float16).tobytes(), y.astype(np.float16).tobytes()) for x, y in zip(t, m, strict=True)], "t binary, m binary").repartition(3)
    got = quality._exchange(found)(w, 0.4, 0.5)
    y = [quality.confident(x @ v, *(float(np.sort(x @ v)[max(0, int(np.ceil(q * len(x))) - 1)]) for q in (0.2, 0.8))) for x, v in zip((t, m), w, strict=True)]
    for i, x in enumerate((t, m)):
        want = quality.hints_of(quality.sums(x, y[1 - i], w[i]), w[i])
        assert got[i].n == want.n > 0 and np.allclose(got[i].gradient, want.gradient, atol=1e-3) and np.allclose(got[i].curvature, want.curvature, atol=1e-3)


# ---- 4


def word_sets(texts, words):
    out = []
    for t in texts:
        w = [x for x in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        n = min(words, len(w))
        out.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set())
    return out


def copies(seed, n, length=60):
    """Texts, near and exact copies of them, and copies of copies."""
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        if texts and rng.random() < 0.6:
            w = rng.choice(texts[-8:]).split(" ")
            for _ in range(rng.randrange(0, 5)):
                w[rng.randrange(len(w))] = f"w{rng.randrange(500)}"
            texts.append(" ".join(w))
        else:
            texts.append(" ".join(f"w{rng.randrange(500)}" for _ in range(length)))
    return texts


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates(spark, words):
    texts = [*copies(3, 120), *ODD, "Two Words", "two words", "one", "ONE"]
    sets = word_sets(texts, words)
    want = components(len(texts), alike(sets))
    got = {r["doc_id"]: r for r in neardup.near_duplicates(frame(spark, texts), words).collect()}
    assert [(got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) for i in range(len(texts))] == [(len(s), c, c == i) for i, (s, c) in enumerate(zip(sets, want, strict=True))]


def test_near_duplicates_edges(spark):
    docs = frame(spark, ["a b c d e f", "a b c d e f", "a b c d e f", None], [5, 5, None, 7])
    got = sorted((r["doc_id"] or 0, r["component_id"], r["kept"]) for r in neardup.near_duplicates(docs).collect())
    assert got == [(0, None, True), (5, 5, True), (5, 5, True), (7, 7, True)]
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("turned", [False, True])
def test_near_duplicates_of_an_id_with_two_texts(spark, turned):
    a, b = (" ".join(f"{x}{i}" for i in range(30)) for x in "ab")
    rows = [(5, a), (5, b), (12, b + " end"), (13, a + " end"), (14, "c d e"), (3, None), (3, "f g h"), (20, "f g h")]
    docs = frame(spark, [t for _, t in rows][:: -1 if turned else 1], [d for d, _ in rows][:: -1 if turned else 1])
    got = sorted((r["doc_id"], r["component_id"], r["n_shingles"], r["kept"]) for r in neardup.near_duplicates(docs).collect())
    assert got == [(3, 3, 0, True), (3, 3, 2, True), (5, 5, 29, True), (5, 5, 29, True), (12, 5, 30, False), (13, 5, 30, False), (14, 14, 2, True), (20, 3, 2, False)]


def test_one_row_of_each_group_stays(spark):
    docs = frame(spark, ["a b c d e f", "a b c d e f", "a b c d e f", "x y", None], [1, 1, 2, 3, None])
    got = sorted(((r["doc_id"], r["text"]) for r in neardup.deduplicated(docs).collect()), key=str)
    assert got == [(1, "a b c d e f"), (3, "x y"), (None, None)] and neardup.deduplicated(docs).columns == docs.columns


def test_pairs_within_a_group_that_stars_leave_out(spark):
    """One text in many edits, most of them under the threshold from one another: prefixes find what is linked, and rows stay few."""
    rng = random.Random(4)
    base = [f"b{i}" for i in range(60)]
    texts = []
    for i in range(260):
        w = list(base)
        for k in rng.sample(range(60), rng.choice([2, 4, 5, 6, 6, 7])):
            w[k] = f"n{i}x{k}"
        texts.append(" ".join(w))
    sets = word_sets(texts, 2)
    want = components(len(texts), alike(sets))
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(frame(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == want and 1 < len(set(want)) < 250


# ---- 5


def test_bpe_equals_the_library(spark, sf_dir):
    path = queries.tokenizer_path("word_bpe_49k.json")
    tok = tokens.load(path)
    texts = ODD + [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(60).collect()]
    got = {r["doc_id"]: r for r in bpe.encode_decode(frame(spark, texts), path).collect()}
    for i, t in enumerate(texts):
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest())
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == want, t
    assert bpe.encode_decode(frame(spark, texts).limit(0), path).count() == 0


# ---- 6


def test_fuzzy_lines(spark):
    lines = [t[:150] for t in copies(8, 90)]
    texts = ["\n".join([*lines[i : i + 6], "short", ""]) for i in range(0, 90, 5)] + [None, "", lines[0]]
    flat = [(d, i, linededup.normal(x)) for d, t in enumerate(texts) for i, x in enumerate((t or "").split("\n")) if len(linededup.normal(x)) >= 30]
    sets = [{x[k : k + 5] for k in range(len(x) - 4)} for _, _, x in flat]
    keep = {flat[c][:2] for c in components(len(flat), alike(sets))}
    gone = {x[:2] for x in flat} - keep
    want = ["\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) if t is not None else None for d, t in enumerate(texts)]
    found = linededup.dedup_lines(frame(spark, texts), min_chars=30)
    assert {r["doc_id"]: r["text"] for r in found.collect()} == dict(enumerate(want))
    assert linededup.dedup_lines(frame(spark, texts).limit(0)).count() == 0


def test_every_line_that_is_not_blank_takes_part(spark, tmp_path):
    lines = [t[:150] for t in copies(8, 60)]
    short = ["All rights reserved.", "licensed under CC BY-NC 4.0.", "Licensed  under cc by-nc 4.0", "}", "ab", "ab c", "abcde", "abcdef", "--", " "]
    texts = ["\n".join([*lines[i : i + 6], *short[i % 3 :], "", short[i % 10]]) for i in range(0, 60, 5)] + [None, "", "all  RIGHTS reserved."]
    flat = [(d, i, n) for d, t in enumerate(texts) for i, x in enumerate((t or "").split("\n")) if (n := linededup.normal(x))]
    sets = [{x[k : k + 5] for k in range(max(1, len(x) - 4))} for _, _, x in flat]
    keep = {flat[c][:2] for c in components(len(flat), alike(sets))}
    gone = {x[:2] for x in flat} - keep
    want = ["\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) if t is not None else None for d, t in enumerate(texts)]
    frame(spark, texts).write.parquet(f"file://{tmp_path}/documents.parquet")
    assert {r["doc_id"]: r["text"] for r in queries.op6_line_dedup(spark, f"file://{tmp_path}").collect()} == dict(enumerate(want))


def test_pairs_of_lines_at_the_threshold_are_found(spark):
    rng = random.Random(9)
    word = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    pairs = [(w := word(36)) + word(4) + "\n" + w + word(4) for _ in range(1500)]  # 32 of 40 shingles in common
    got = linededup.dedup_lines(frame(spark, pairs)).agg(F.sum("n_removed")).first()[0]
    sets = [[{x[k : k + 5] for k in range(36)} for x in t.split("\n")] for t in pairs]
    assert got == sum(len(a & b) >= 0.8 * len(a | b) for a, b in sets) > 1400


def test_minima_of_lines_take_one_product_a_shingle():
    rng = random.Random(3)
    lines = ["".join(rng.choices("abcd eé😀", k=rng.randint(5, 90))) for _ in range(300)] + ["abcde", "x" * 700]
    mh = links.MinHash(links.Shape.for_rows(50_000, 0.8, linededup.SIGNED))
    got = linededup.minima_of(lines, mh)
    h, begin, count = linededup.codes_of(lines)
    assert list(count) == [len(x) - 4 for x in lines]
    for i in range(len(lines)):
        least = (mh.a * (h[begin[i] : begin[i] + count[i]] | np.uint32(1))[None]).min(axis=1) >> np.uint32(1)
        assert (got[i] == least ^ (least >> np.uint32(9))).all()


def test_minima_of_lines_agree_as_often_as_sets_are_alike():
    rng = np.random.default_rng(5)
    mh = links.MinHash(links.Shape.for_rows(250_000, 0.8, linededup.SIGNED))
    for n in [16, 60, 400]:
        off = []
        for _ in range(200):
            a = "".join(map(chr, rng.integers(97, 123, n)))
            b = a[: n * 9 // 10] + "".join(map(chr, rng.integers(97, 123, n - n * 9 // 10)))
            x, y = (linededup.shingle_hashes(t) for t in (a, b))
            j = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
            m = linededup.minima_of([a, b], mh)
            if 0 < j < 1:
                off.append(((m[0] == m[1]).sum() - j * mh.shape.minima) / (mh.shape.minima * j * (1 - j)) ** 0.5)
        assert len(off) > 150 and abs(np.mean(off)) < 0.3 and np.std(off) < 1.25, n


def test_blocks_are_compared_whole_whatever_the_batches(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(6)
    shape = links.Shape(5, 38)
    size = [1, 2, 3, 40, 5, 700, 2, 9] * 3
    n = sum(size)
    codes = rng.integers(0, 1 << 62, (12, shape.words))[rng.integers(0, 12, n)]
    label = rng.integers(0, 9, n)
    cols = {"key": np.repeat(np.arange(len(size)) // 2, size), "block": np.repeat(np.arange(len(size)) % 2, size), "id": np.arange(n), "label": label, "size": np.bincount(label)[label], "asks": rng.random(n) < 0.5, "split": np.zeros(n, bool)} | {f"s{w}": codes[:, w].copy() for w in range(shape.words)}
    table = pa.table(cols)
    monkeypatch.setattr(links, "MET", 50)
    found = set()
    for c, start, count in links._blocks(table.to_batches(max_chunksize=37), shape):
        for x, y, _ in links._nearest(c, start, count, c["asks"], shape, 0.9):
            found |= set(zip(c["id"][x].tolist(), c["id"][y].tolist(), strict=True))
    of = np.repeat(np.arange(len(size)), size)
    larger = lambda i, j: (cols["size"][j], label[j]) > (cols["size"][i], label[i])
    same = {(i, j) for i in range(n) if cols["asks"][i] for j in np.flatnonzero(of == of[i]).tolist() if larger(i, j) and (codes[i] == codes[j]).all()}
    assert found == same and len(same) > 1000


def test_white_space_that_is_collapsed_is_seen():
    rng = random.Random(2)
    for chars in ["aB \n", "a \n\t", "aΣ\n\xa0", "a \n\x1c\u2003", "é \n\x85\r"]:
        for _ in range(400):
            t = "".join(rng.choices(chars, k=rng.randint(0, 12)))
            for least in (1, 3):
                assert list(linededup.eligible(t, least)) == [(i, n) for i, x in enumerate(t.split("\n")) if len(x) >= least and len(n := linededup.normal(x)) >= least], repr(t)


def test_lines_below_the_threshold_do_not_meet_by_the_square_of_their_group(spark):
    # variants of one line by words of a small vocabulary, most of them alike by 0.5 to 0.75, some by 0.8 and more
    rng = random.Random(4)
    known = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 8))) for _ in range(25)]
    word = lambda: rng.choice(known)
    changed = lambda words, n: [word() if i in hit else w for hit in [set(rng.sample(range(len(words)), n))] for i, w in enumerate(words)]
    line = [word() for _ in range(60)]
    words = [changed(line, 6) for _ in range(150)]
    words += [changed(w, 2) for w in words[:20]]
    lines = [" ".join(w) for w in words]
    shape = links.Shape.for_rows(50_000, 0.8, linededup.SIGNED)
    mh = links.MinHash(shape)
    codes = mh.packed(linededup.minima_of(lines, mh)).view(np.int64)
    items = spark.createDataFrame([(i, i, True, x, *map(int, codes[i])) for i, x in enumerate(lines)], "id long, label long, asks boolean, text string, " + ", ".join(f"s{w} long" for w in range(shape.words)))
    got = {(r["a"], r["b"]) for r in links.prefix_pairs(items, shape, lambda: linededup.shingle_hashes, 0.8).collect()}
    sets = [set(linededup.shingle_hashes(x).tolist()) for x in lines]
    like = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in itertools.combinations(range(len(lines)), 2)}
    linked = {p for p, j in like.items() if j >= 0.8 - 1e-9}
    assert len(linked) > 15 and linked <= got
    assert sum(0.5 < j < 0.8 for j in like.values()) > 10_000
    assert len(got) < 500, (len(got), len(linked))


def test_parities_rule_out_no_pair_at_the_threshold():
    rng = np.random.default_rng(8)
    shape = links.Shape(5, 38)
    parities, mh = links.Parities(shape, 0.8), links.MinHash(shape)
    pairs = []
    for n in [1, 2, 5, 9, 40, 41, 42, 43, 85, 86, 300, 341, 342, 1365, 1366, 3700, 4096, 4097, 6000]:
        for m in {n, int(0.8 * n), int(0.9 * n)} - {0}:
            a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            least = math.ceil(0.8 * (n + m) / 1.8 - 1e-9)  # elements in common at the threshold
            if least <= m:
                pairs.append((a, np.concatenate((a[:least], rng.integers(0, 1 << 63, m - least, dtype=np.uint64)))))
        pairs.append((a, rng.integers(0, 1 << 63, n, dtype=np.uint64)))
    flat = [s for p in pairs for s in p]
    made = [parities.of(s, mh.packed(mh.minima(s)[None])[0]) for s in flat]
    count = np.array([len(w) for _, w in made])
    x = np.arange(0, len(flat), 2)
    n = np.array([len(s) for s in flat])
    ok = parities.allow(np.concatenate([w for _, w in made]), np.cumsum(count) - count, np.array([r for r, _ in made], np.uint8), n, x, x + 1)
    alike = np.array([len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b)) - 1e-9 for a, b in pairs])
    assert ok[alike].all() and not ok[~alike & (n[x] > 9)].any()


# ---- 7


def test_packing(spark):
    rng = random.Random(6)
    texts = [*ODD, *(" ".join(["river"] * rng.choice([5, 80, 700, 1400, 5000])) for _ in range(120))]
    path = queries.tokenizer_path("word_bpe_49k.json")
    got = packing.pack_documents(frame(spark, texts), path, 0, 2048).collect()
    tok = tokens.load(path)
    bins, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= 2048
    total = 0
    for d, t in enumerate(texts):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        total += len(ids)
        want = [(k, at, len(p), zlib.crc32(struct.pack(f"<{len(p)}I", *p))) for k, at in enumerate(range(0, len(ids), 2048)) for p in [ids[at : at + 2048]]]
        assert sorted(pieces[d]) == want
    assert len(bins) <= 1.12 * -(-total // 2048) + 1


def test_packing_by_levels(spark):
    rng = np.random.default_rng(3)
    rows = spark.createDataFrame([(i, 0, int(n)) for i, n in enumerate(rng.integers(1, 100, 40_000))], "doc_id long, piece int, length long")
    got = packing.pack(rows, 100, fan_in=2).groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).toPandas()
    assert (got.n == got.end).all() and got.n.max() <= 100 and got.n.sum() == rows.agg(F.sum("length")).first()[0]
    assert len(got) < 1.03 * got.n.sum() / 100


# ---- 8


def test_top_k(spark):
    rng = np.random.default_rng(2)
    vectors = [(int(i), [float(x) for x in rng.normal(size=6)], 0) for i in range(300)]
    vectors += [(1000 + i, vectors[0][1], 0) for i in range(12)]  # ties
    vectors += [(50, None, 0), (3000, [1.0, None, 1.0, 1.0, 1.0, 1.0], 0), (3001, [float("nan")] * 6, 0), (3050, [float("inf")] * 6, 0), (None, [9.0] * 6, 0), (3100, [], 0)]
    vectors += [(100, [3.0] * 6, 0), (100, [3.0] * 6, 0), (7, [2.0, 1.0, 0.0, 0.0, 0.0, 0.0], 0)]  # repeated ids, equal rows
    rows = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, score int")
    assert top_k(rows, 64) == brute_top_k(vectors)
    assert kdsearch.top_inner_products(rows.limit(0)).count() == 0


def test_top_k_of_large_components(spark):
    rng = np.random.default_rng(3)
    vectors = [(i, [float(x) for x in rng.normal(size=3) * 10.0 ** rng.integers(0, 7)], 0) for i in range(120)]
    vectors += [(150, [1e20, 1.0, -3.5], 0), (200, [1e300, 1e300, 0.25], 0), (201, [-1e20, 2.0**60, 2.0**53 + 2], 0)]
    rows = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, score int")
    assert top_k(rows, 40) == brute_top_k(vectors)


def top_k(rows, shard_rows):
    found = kdsearch.top_inner_products(rows.repartition(3), shard_rows=shard_rows).select("query_id", "rank", "vec_id", "score")
    return sorted(map(tuple, found.collect()))


def brute_top_k(vectors):
    """By all pairs, in whole numbers; a query is a row."""
    good = [(v[0], [int(Fraction(x) * 256 // 1) for x in v[1]]) for v in vectors if v[0] is not None and v[1] and all(x is not None and np.isfinite(x) for x in v[1])]
    want = []
    for r, (q, a) in enumerate(good):
        if q % 50 == 0:
            score = lambda b, a=a: max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b, strict=True))))
            order = sorted((-score(b), c) for s, (c, b) in enumerate(good) if s != r)[:5]
            want += [(q, k, c, -s) for k, (s, c) in enumerate(order, 1)]
    return sorted(want)


# ---- 9


def test_fingerprints(spark):
    texts = [*ODD, *copies(5, 40), "the cat sat on the mat and the dog ran to a house", "the cat sat on the mat and the dog ran to a house"]
    got = {r["doc_id"]: r for r in spotsigs.fingerprints(frame(spark, texts)).collect()}
    n, prints = len(texts), {}
    for d, r in got.items():
        t, following = texts[d] or "", texts[(d - 1) % n] or ""
        e = t[: len(t) - len(t) // 3] + following[: len(t) // 3]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        assert prints.setdefault(t, r["fingerprint"]) == r["fingerprint"] and 0 <= r["near_edited"] <= 1 and (e != t or r["near_edited"] == 1)
    assert len(got) == n and got[n - 1]["near_next"] == 1
    assert spotsigs.fingerprints(frame(spark, texts).limit(0)).count() == 0
    hashes = {d: set(spotsigs.read(r["fingerprint"]).tolist()) for d, r in got.items()}
    want = components(n, alike([hashes[d] for d in range(n)]))
    pairs = spotsigs.similar_pairs(spark.createDataFrame([(d, r["fingerprint"]) for d, r in got.items()], "doc_id long, fingerprint string"))
    assert components(n, [(r["id_a"], r["id_b"]) for r in pairs.collect()]) == want


# ---- 10

LEAKS = ["api_key = 'abcDEF123456' and token:short", "PassWord: hunter2hunter2 é😀 secret=\"x_y.z-12345\"", "AKIA" + "A1" * 10 + " " + "0af9" * 8, "ghp_" + "a" * 36 + " password=", "😀" * 5 + "APIKEY:='zzzzzzz'" * 2, "-----BEGIN RSA PRIVATE KEY-----", "ſecret = abcdefgh"]


def test_secrets(spark):
    texts = [*ODD, *LEAKS, LEAKS[0]]
    docs = frame(spark, texts, [*range(len(texts) - 1), None])
    got = {(r["doc_id"], r["text"]): [tuple(s) for s in r["spans"]] for r in secrets.scan(docs).collect()}
    assert got == {(d, t): secrets.matches(t or "") for d, t in zip([*range(len(texts) - 1), None], texts, strict=True)}
    out = {r["doc_id"]: r["text"] for r in secrets.redact(docs).collect()}
    assert out[len(ODD)] == "[SECRET]' and token:short" and out[1] is None
    assert secrets.scan(docs.limit(0)).count() == 0
    clash = docs.withColumn("spans", F.lit(1)).withColumn("kinds", F.lit("k")).withColumn("n_lines", F.lit(2)).withColumn("_spans_", F.lit(3))
    again = secrets.redact(clash)
    assert again.columns == clash.columns and {r["doc_id"]: (r["text"], r["spans"], r["kinds"]) for r in again.collect()} == {d: (t, 1, "k") for d, t in out.items()}
    assert sorted(map(str, (r["spans"] for r in secrets.scan(clash).collect()))) == sorted(map(str, (r["spans"] for r in secrets.scan(docs).collect())))


def test_trigram_queries_admit_every_match():
    for rule in secrets.RULES:
        for t in LEAKS:
            low = t.lower()
            if secrets.matches(t, (rule,)):
                assert any(all(g in low for g in c) for c in secrets.trigram_query(rule.pattern))
    assert secrets.trigram_query("[0-9a-f]{24,}") == secrets.ALWAYS


def test_secret_scan_runs_no_python(spark, sf_dir):
    plan = queries.op10_secrets(spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, sf_dir, name):
    assert oracle.spark_rows(queries.QUERIES[name](spark, sf_dir)) == oracle.duck(sf_dir, queries.SQL[name])


# ---- language fusion against a second account of it


def fused_by_hand(rows, least=0.5):
    """(lang, rejected, confidence) of rows (text, declared, suffix, host, parent), by dictionaries and whole tables in memory."""
    known = sorted({r[1] for r in rows if r[1]})
    langs = [*known, langid.UNKNOWN]
    table = np.full((len(langs), langid.BUCKETS), 0.5)
    for text, declared, *_ in rows:
        if declared:
            for t in langid.trigrams(text):
                table[langs.index(declared), t] += 1
    model = np.log(table / table.sum(axis=1, keepdims=True))
    soft = lambda s: np.exp(s - s.max()) / np.exp(s - s.max()).sum()
    grid = lambda p: np.round(p * langid.SHARES) / langid.SHARES
    texts, letters = [], []
    for text, *_ in rows:
        t = langid.trigrams(text)
        s = sum((model[:, x] for x in t), np.zeros(len(langs))) * (min(1, langid.EFFECTIVE / len(t)) if len(t) else 1)
        texts.append(s - s.max())
        letters.append(any(map(str.isalpha, text)))

    def evidence(place):
        counts = {}
        for r, s, ok in zip(rows, texts, letters, strict=True):
            if ok and r[place]:
                counts[r[place]] = counts.get(r[place], 0) + grid(soft(s))
        sums = sum(counts.values(), np.zeros(len(langs)))
        every = {v: c.sum() / max(1, sums.sum()) for v, c in counts.items()}
        return {v: np.log((c + 10 * every[v] + 1e-6) / (sums + 10 + 1e-6 * len(counts))) - np.log(every[v] + 1e-6) for v, c in counts.items()}

    none = np.zeros(len(langs))
    declared, suffix = evidence(1), evidence(2)
    first = [grid(soft(s + declared.get(r[1], none))) for r, s in zip(rows, texts, strict=True)]
    hosts, parents = {}, {}
    for r, p in zip(rows, first, strict=True):
        if r[3] is not None:
            hosts[r[3]] = hosts.get(r[3], 0) + p
            if r[4] is not None:
                parents[r[4]] = parents.get(r[4], 0) + p
    share = sum(hosts.values(), np.zeros(len(langs))) + 1
    share = share / share.sum()
    out = []
    for r, s, p, ok in zip(rows, texts, first, letters, strict=True):
        of_parent, of_host = (np.maximum(c - p, 0) for c in (parents.get(r[4], none), hosts.get(r[3], none)))
        middle = (of_parent + langid.SMOOTH * share) / (of_parent.sum() + langid.SMOOTH)
        prior = (of_host + langid.SMOOTH * middle) / (of_host.sum() + langid.SMOOTH)
        post = soft(s + declared.get(r[1], none) + suffix.get(r[2], none) + np.log(prior))
        best = int(post.argmax())
        out.append((langs[best], not ok or best == len(langs) - 1 or post[best] < least, float(post[best])))
    return out


def test_fusion_by_hand(spark):
    say = {"en": "the river and the boat are on the way to the sea with a man", "de": "der Hund und die Katze sind auf dem Weg nach Hause mit dem Kind", "nl": "de hond en de kat zijn op weg naar huis met het kind van de man"}
    rng, rows = random.Random(2), []
    for i in range(90):
        x = list(say)[i % 3]
        words = say[x].split() if i % 4 else ["in", "die", "was"]  # some texts alone tell little
        host = {"en": "www.shop.example.co.uk", "de": "a.beispiel.de", "nl": "b.voorbeeld.nl"}[x] if i % 5 else f"h{i}.beispiel.de"
        parent = {"www.shop.example.co.uk": "example.co.uk", "b.voorbeeld.nl": "voorbeeld.nl"}.get(host, "beispiel.de")
        rows.append((" ".join(rng.choices(words, k=12)) + f" {i}", x if i % 3 == 0 or i % 7 == 0 else None, host.rsplit(".", 1)[1], host, parent))
    rows += [("", None, "", None, None), ("in die was", None, "com", "solo.com", None), ("123 !!", "en", "", None, None)] * 2
    page = lambda r: f'<html{f" lang={chr(34)}{r[1]}{chr(34)}" if r[1] else ""}><body>{r[0]}</body></html>'
    pages = spark.createDataFrame([(i, f"https://{r[3]}/x" if r[3] else None, page(r)) for i, r in enumerate(rows)], "page_id long, url string, html string").repartition(3)
    seen = {r["page_id"]: r for r in langid.evidence_of_pages(pages).collect()}
    assert all((seen[i]["declared"], seen[i]["suffix"] or "", seen[i]["host"], seen[i]["parent"]) == r[1:] for i, r in enumerate(rows))
    got = {r["page_id"]: r for r in langid.identify(langid.evidence_of_pages(pages)).collect()}
    want = fused_by_hand(rows)
    assert [(got[i]["lang"], got[i]["rejected"]) for i in range(len(rows))] == [w[:2] for w in want]
    assert all(abs(got[i]["confidence"] - w[2]) < 1e-6 for i, w in enumerate(want))
    flat = fused_by_hand([(*r[:3], None, None) for r in rows])
    assert [w[0] for w in want] != [w[0] for w in flat]  # hosts decide some


# ---- fingerprints against a second account of them


def spots_by_hand(text):
    """Signatures as tuples of words: an anchor and the next content words, or else runs of words, or the text."""
    words = [w for w in ("".join(c for c in x.lower() if c.isalnum()) for x in text.split()) if w]
    if not words:
        return {text} if text else set()
    chains = set()
    for i, w in enumerate(words):
        content = [x for x in words[i + 1 :] if x not in spotsigs.ANCHORS][: spotsigs.CHAIN]
        if w in spotsigs.ANCHORS and len(content) == spotsigs.CHAIN:
            chains.add((w, *content))
    n = spotsigs.CHAIN + 1
    return chains or {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))}


def test_fingerprints_by_hand(spark):
    texts = [*ODD, "no anchors here whatsoever today", "two words", "the", "the cat sat on the mat and the dog ran to a house", *copies(6, 10), "The cat, sat on THE mat and the dog ran to a house!"]
    got = {r["doc_id"]: r for r in spotsigs.fingerprints(frame(spark, texts)).collect()}
    n = len(texts)
    sets = {d: spots_by_hand(texts[d] or "") for d in got}
    like = lambda a, b: 1.0 if not a and not b else len(a & b) / len(a | b)
    for d, r in got.items():
        t, after = texts[d] or "", (d - 1) % n
        e = spots_by_hand(spotsigs.edited(t, texts[after] or ""))
        assert len(r["fingerprint"]) == 16 * len(sets[d]) and len(r["edited_fingerprint"]) == 16 * len(e)
        assert abs(r["near_edited"] - like(sets[d], e)) < 1e-12 and abs(r["near_next"] - like(sets[d], sets[after])) < 1e-12
    assert all((got[a]["fingerprint"] == got[b]["fingerprint"]) == (sets[a] == sets[b]) for a, b in itertools.combinations(got, 2))
