"""The stages of the corpus pipeline, each on its predecessor's rows, against plain Python."""

import itertools
import re

import pytest

import corpus_pipeline
from winnowry.llm import linededup, secrets


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """name: (rows in, rows out), by doc_id."""
    path, found = tmp_path_factory.mktemp("stages"), {}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, f in corpus_pipeline.STAGES:
        f(spark, docs, sf_dir).write.parquet(f"file://{path}/{name}")
        out = spark.read.parquet(f"file://{path}/{name}")
        found[name] = (docs.collect(), out.collect())
        if name != "packing":
            assert out.columns == corpus_pipeline.COLUMNS
        docs = out
    return found


def by_id(rows):
    return {r["doc_id"]: r["text"] for r in rows}


def components(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def linked(sets):
    return [(a, b) for a, b in itertools.combinations(sorted(sets), 2) if sets[a] and sets[b] and len(sets[a]) * 0.79 <= len(sets[b]) <= len(sets[a]) / 0.79 and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]


def test_language_id_keeps_prose(stages):
    before, after = map(by_id, stages["language_id"])
    assert all(after[d] == before[d] for d in after) and len(after) > 0.9 * len(before)
    assert all(not re.search(r"[^\W\d_]", before[d]) for d in before if d not in after) or len(before) - len(after) < 0.05 * len(before)


def test_line_dedup(stages):
    before, after = map(by_id, stages["line_dedup"])
    flat = [(d, i, linededup.normal(x)) for d in sorted(before) for i, x in enumerate((before[d] or "").split("\n")) if linededup.normal(x)]
    sets = {k: {x[2][j : j + 5] for j in range(max(1, len(x[2]) - 4))} for k, x in enumerate(flat)}
    root = components(range(len(flat)), linked(sets))
    gone = {flat[k][:2] for k in root if root[k] != k}
    want = {d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in before.items()}
    assert after == {d: t for d, t in want.items() if t == before[d] or re.search(r"\S", t)}


def test_near_duplicates(stages):
    before, after = map(by_id, stages["near_duplicates"])
    sets = {}
    for d, t in before.items():
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "").split()
        n = min(5, len(w))
        sets[d] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()
    root = components(before, linked(sets))
    assert after == {d: t for d, t in before.items() if root[d] == d}


def test_secrets(stages):
    before, after = map(by_id, stages["secrets"])
    assert set(before) == set(after)
    for d, t in before.items():
        spans = secrets.matches(t or "")
        assert (after[d] == t) == (not spans) and not (spans and t[spans[0][0] : spans[0][2]] in after[d])


def test_packing(stages):
    before, after = stages["packing"]
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before}
    ends = {}
    for r in after:
        ends[r["sequence_id"]] = ends.get(r["sequence_id"], 0) + r["length"]
    assert max(ends.values()) <= 2048 and len(ends) <= 1.1 * sum(ends.values()) / 2048 + 1
