"""Texts far above the blocks that operators hash at a time: 256 KiB of bytes, 64 KiB of a tokenizer's chunk."""

import math
import random
import re
from collections import Counter

import pytest

from stratum.llm import chunks, decontaminate, lm, minhash, negatives, quality, ranked, sharding, tokens
from stratum.llm import wordhash as wh

DOCS = "doc_id long, text string"


def prose(rng, n):
    return " ".join("".join(rng.choice(["ba", "ko", "ti", "ré", "su", "Zu", "ch"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def long_docs():
    rng = random.Random(77)
    a = prose(rng, 90_000).split(" ")
    b = list(a)
    for at in rng.sample(range(len(b)), 500):
        b[at] = "changed"
    c = list(a)
    for at in rng.sample(range(len(c)), 9_000):
        c[at] = f"other{at}"
    rows = {1: " ".join(a), 2: " ".join(b), 3: " ".join(c), 4: prose(rng, 300), 5: "x" * 600_000 + " end", 6: prose(rng, 60_000)}
    assert len(rows[1].encode()) > 2 * wh.BLOCK and len(rows[6].encode()) > wh.BLOCK
    return rows


@pytest.fixture(scope="module")
def frame(spark, long_docs):
    return spark.createDataFrame(list(long_docs.items()), DOCS)


def test_near_duplicates_of_long_texts(frame, long_docs):
    sets = {}
    for k, t in long_docs.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets[k] = {tuple(w[i:i + 2]) for i in range(len(w) - 1)}
    got = {r.doc_id: r for r in minhash.near_duplicates(frame, width=2, percent=80).collect()}
    assert all(got[k].n_shingles == len(sets[k]) for k in sets)
    j = {p: len(sets[p[0]] & sets[p[1]]) / len(sets[p[0]] | sets[p[1]]) for p in ((1, 2), (1, 3), (2, 3))}
    assert j[1, 2] > 0.8
    assert got[2].component_id == 1 and got[3].component_id == (1 if max(j[1, 3], j[2, 3]) >= 0.8 else 3)
    assert all(got[k].component_id == k for k in (1, 4, 5, 6))


def test_benchmark_passages_far_inside(spark, frame, long_docs):
    w = long_docs[1].split(" ")
    items = [(1, " ".join(w[70_000:70_040])), (2, " ".join(w[89_980:])), (3, long_docs[4][:200])]
    got = {(r.doc_id, r.item_id): (r.n_matched, r.first_word) for r in decontaminate.contaminated(frame, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got[1, 1] == (40, 70_000) and got[1, 2] == (20, 89_980) and (4, 3) in got
    assert not any(k in (5, 6) for k, _ in got)


def test_repeats_far_inside(spark, long_docs):
    rng = random.Random(5)
    passage = prose(rng, 80)
    rows = [(1, f"{prose(rng, 50_000)} {passage} {prose(rng, 100)}"), (2, f"{prose(rng, 70_000)}\n{passage}\n{prose(rng, 40_000)}"), (3, prose(rng, 300))]
    raw = {k: t.encode() for k, t in rows}
    spans = chunks.repeated_spans(spark.createDataFrame(rows, DOCS)).collect()
    at = raw[2].index(passage.encode())
    assert [(r.doc_id, r.first_doc_id) for r in spans] == [(2, 1)]
    assert spans[0].start <= at and at + len(passage.encode()) <= spans[0].end
    assert raw[2][spans[0].start:spans[0].end] == raw[1][spans[0].first_start:spans[0].first_start + spans[0].end - spans[0].start]


def test_scores_of_long_texts(spark, frame, long_docs):
    """A long text scores as the sum of what its words score, block by block."""
    source = frame.withColumnRenamed("doc_id", "id")
    known, flat, rare, _ = lm.fit(source)
    counts = {r.word % 2**64: r.n for r in rare.collect()}
    totals = Counter()
    for w, n in counts.items():
        totals[w % (lm.SYMBOLS - lm.KNOWN)] += n
    got = {r.doc_id: r for r in lm.pseudo_likelihood(frame).collect()}
    import numpy as np

    for k in (1, 6):
        raw = np.frombuffer(long_docs[k].encode(), np.uint8)
        h = wh.hash_words(raw, np.array([0, len(raw)]))[2]
        s = lm.Vocabulary(known).symbols(h)
        logs = lm.forward(lm.unflatten(flat), lm.contexts(s, np.array([0, len(s)])), s)
        own = sum(math.log(counts[w] / totals[w % (lm.SYMBOLS - lm.KNOWN)]) for w in h.tolist() if w in counts)
        assert got[k].n_tokens == len(s) == len(long_docs[k].split(" "))
        assert got[k].log_likelihood == pytest.approx(float(logs.sum()) + own, rel=1e-4)
    assert got[5].n_tokens == 2


def test_token_counts_across_default_chunks(frame, long_docs):
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    got = {r.doc_id: r.n_tokens for r in tokens.token_counts(frame, path).collect()}
    for k in (1, 4, 6):
        assert got[k] == len(library.encode(long_docs[k], add_special_tokens=False).ids)


def test_search_shards_and_rules_on_long_texts(spark, frame, long_docs):
    items = spark.createDataFrame([(9, " ".join(long_docs[6].split(" ")[-30:]))], "item_id long, text string")
    hits = ranked.ranked(frame, items, k=3).collect()
    assert len(hits) == 3 and {r.rank for r in hits} == {1, 2, 3}
    sizes = {r.doc_id: r.size for r in sharding.sharded(frame, shards=3).collect()}
    assert sizes == {k: len(t.encode()) + 16 for k, t in long_docs.items()}
    judged = {r.doc_id: r for r in quality.quality(frame.selectExpr("*", "'en' AS lang", "'s' AS source")).collect()}
    assert judged[1].n_words == 90_000 and judged[5].base_failed


def test_wide_vectors(spark):
    import numpy as np
    from pyspark.sql import functions as F

    rng = np.random.default_rng(2)
    rows = [(k, rng.normal(0.2, 1, 5000).tolist(), k % 2) for k in range(24)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = negatives.hard_negatives(df, F.col("vec_id") % 12 == 0, low=0, high=100).collect()
    x = {k: np.floor(np.array(v, dtype=np.float32).astype(float) * 256).astype(object) for k, v, _ in rows}
    assert got and all(r.negative_score == int((x[r.anchor_id] * x[r.negative_id]).sum()) and r.positive_score == int((x[r.anchor_id] * x[r.positive_id]).sum()) for r in got)
