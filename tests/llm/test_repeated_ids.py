"""Rows that share an id, null ids and hot groups: near-duplicates, decontamination and the pipeline's decisions."""

import itertools
import random

import pytest

import corpus_pipeline
from stratum.llm import decontaminate, minhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def text(rng, n):
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


@pytest.fixture(scope="module")
def two_texts():
    rng = random.Random(1)
    return text(rng, 80), text(rng, 80)


def test_an_id_with_two_texts_joins_their_groups(spark, two_texts):
    t1, t2 = two_texts
    rows = [(5, t1), (9, t1), (9, t2), (12, t2), (20, "alone with other words")] + [(9, t2)] * 3
    got = sorted((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted([(5, 5, True), (12, 5, False), (20, 20, True)] + [(9, 5, False)] * 5)


def test_a_rep_with_two_texts_links_by_either(spark):
    rng = random.Random(6)
    a, b = text(rng, 120), text(rng, 120)
    near = lambda t: " ".join(t.split()[:118] + ["x", "y"])
    rows = [(1, a), (1, b), (2, near(a)), (3, near(b)), (4, text(rng, 50))]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4}


def brute_components(texts, width, percent):
    sets = {k: {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} or {tuple(w)} for k, t in texts.items() for w in [t.split()]}
    up = {k: k for k in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    return {k: find(k) for k in sets}


@pytest.mark.parametrize("cell,chunk", [(1024, 256), (7, 3)])
def test_a_hot_group_in_many_cells(spark, monkeypatch, cell, chunk):
    """One group of near copies at all distances, most of them not linked to the middle."""
    monkeypatch.setattr(minhash, "CELL", cell)
    monkeypatch.setattr(minhash, "CHUNK", chunk)
    rng = random.Random(9)
    base = text(rng, 60).split()
    rows = {}
    for k in range(260):
        w = list(base)
        for at in rng.sample(range(60), rng.choice([1, 2, 3, 4, 5, 6, 8])):
            w[at] = f"c{rng.randrange(4)}"
        rows[k] = " ".join(w)
    rows |= {1000 + k: text(rng, 40) for k in range(30)} | {2000 + k: rows[k] for k in range(5)}
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(list(rows.items()), "doc_id long, text string"), width=2).collect()}
    want = brute_components(rows, 2, 80)
    assert got == want and 10 < len(set(want.values()))


def test_benchmark_blocks_do_not_change_the_result(spark, monkeypatch):
    rng = random.Random(3)
    passages = [text(rng, 40) for _ in range(6)]
    docs = [(k, f"{text(rng, 10)} {passages[k % 6]} {text(rng, 5)} {passages[(k + 1) % 6]}") for k in range(12)] + [(99, text(rng, 60))]
    items = [(7, passages[0]), (7, passages[1]), (7, passages[2]), (8, passages[3]), (9, passages[4]), (9, passages[4]), (None, passages[5])]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(tuple, decontaminate.contaminated(d, b).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 20)
    assert sorted(map(tuple, decontaminate.contaminated(d, b).collect())) == one and len(one) >= 12
    assert decontaminate.contaminated(d.withColumnRenamed("doc_id", "k"), b, id_col="k").columns[0] == "k"


def test_the_pipeline_decides_about_rows(spark, two_texts):
    t1, t2 = two_texts
    rng = random.Random(12)
    leak = text(rng, 60)
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").first().text
    rows = [(5, t1), (9, t1), (9, t2), (12, t2), (None, t1), (None, leak), (None, leak), (30, f"{text(rng, 20)} {items} {text(rng, 20)}"),
            (None, f"{text(rng, 20)} {items}"), (40, "short and clean text of its own words here"), (40, text(rng, 30))]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows], SCHEMA)
    kept = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_dedup_stage(spark, docs, "").collect()), key=repr)
    assert kept == sorted([(5, t1), (9, t2), (None, leak), *rows[7:]], key=repr)
    clean = corpus_pipeline.decontamination_stage(spark, docs, "/root/testdata/sf0.001")
    assert clean.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=repr) == sorted([*rows[:7], *rows[9:]], key=repr)
    cut = corpus_pipeline.substring_stage(spark, docs, "")
    left = [r.text for r in cut.collect()]
    assert len(left) == len(rows) and sum(leak in t for t in left) == 1 and sum(t2 in t for t in left) == 1 and sum(t1 in t for t in left) == 1
