"""Ranked search, sharding and hard negatives against brute force, and on nulls, empty and long texts, ties, repeats and empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.llm import negatives, ranked, sharding

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
DOCS = "doc_id long, text string, n string, terms string, size string, shard string, block string"


def terms_of(text):
    return re.findall(TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_ranked(docs, items, k):
    tf = [Counter(terms_of(t)) for _, t in docs]
    n = [sum(c.values()) for c in tf]
    total, length = sum(x > 0 for x in n), sum(n)
    df = Counter(t for c in tf for t in c)
    out = []
    for item, text in items:
        scores = []
        for (doc, _), c, size in zip(docs, tf, n):
            m = 50 + 50 * size * total // length if length else 0
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in set(terms_of(text)) if t in c)
            if s > 0 and doc is not None:
                scores.append((-s, doc))
        out += [(item, r + 1, doc, -s) for r, (s, doc) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def words(rng, n, vocabulary=300):
    return " ".join(f"w{min(int(rng.expovariate(0.03)), vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    docs = [(k, words(rng, rng.randint(1, 120))) for k in range(700)]
    docs += [(1000 + k, docs[3][1]) for k in range(60)]                     # ties
    docs += [(2000, None), (2001, ""), (2002, "... - !"), (2003, "É x_y Ünï1 W1 w1 WI"), (None, docs[5][1]), (7, docs[7][1]),
             (2004, words(rng, 90_000, 2000))]
    items = [(k, words(rng, rng.randint(1, 60))) for k in range(300)]      # more than one slab
    items += [(3, "w1 w1 w2"), (3, "w1 w1 w2"), (None, "é w1"), (900, None), (901, "nowhere-else"), (902, "w1"), (903, docs[3][1])]
    return docs, items


def test_ranked_search_is_exact(spark, corpus, monkeypatch):
    docs, items = corpus
    monkeypatch.setattr(ranked, "SEEDS", 100)
    frame = spark.createDataFrame([(*d, "x", "x", "x", "x", "x") for d in docs], DOCS).repartition(5)
    asked = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, rank string")
    got = ranked.ranked(frame, asked, k=20)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_ranked(docs, list(dict.fromkeys(items)), 20)


def test_ranked_search_on_empty_tables(spark, corpus):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert ranked.ranked(docs, items).count() == 0
    assert ranked.ranked(docs, spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0
    assert ranked.ranked(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), items).count() == 0


def test_trees_prune_and_bound_every_score():
    rng = np.random.default_rng(3)
    items = [(k, np.unique(rng.integers(0, 400, 12)).tolist(), None) for k in range(37)]
    items = [(k, t, rng.integers(1, 9000, len(t)).tolist()) for k, t, _ in items]
    owner = np.repeat(np.arange(900), 20)
    terms = rng.integers(0, 500, len(owner))
    key = np.unique(owner * 1000 + terms)
    owner, terms = key // 1000, key % 1000
    impact = rng.integers(1, 10**6, len(owner))
    want = defaultdict(list)
    for number, t, w in items:
        weight = dict(zip(t, w))
        score = Counter()
        for o, x, c in zip(owner.tolist(), terms.tolist(), impact.tolist()):
            score[o] += weight.get(x, 0) * c
        want[number] = sorted(((s, -o) for o, s in score.items() if s), reverse=True)[:5]
    trees = ranked._trees(items)
    assert len(trees) == 1 and all((a >= b[0::2]).all() and (a >= b[1::2]).all() for a, b in zip(trees[0].levels, trees[0].levels[1:]))
    floors = {n: w[-1][0] for n, w in want.items()}
    search, seen = ranked._Search(trees[0], 5, floors, False), []
    full = search._score
    search._score = lambda alive, *rest: (seen.append(alive.mean()), full(alive, *rest))
    search.batch(np.arange(900), owner, terms, impact)
    assert {n: [(s, -i) for s, i in zip(*map(np.ndarray.tolist, b))] for n, b in zip(search.tree.numbers, search.best)} == want
    assert 0 < seen[0] < 0.7


def test_trees_are_cut_by_terms(monkeypatch):
    monkeypatch.setattr(ranked, "COLUMNS", 10)
    items = [(k, list(range(8 * k, 8 * k + 8)), [1] * 8) for k in range(4)] + [(9, list(range(100)), [2] * 100)]
    trees = ranked._trees(items)
    assert sorted(n for t in trees for n in t.numbers) == [0, 1, 2, 3, 9] and len(trees) == 5


def naive_best_fit(sizes, capacity, limit=None):
    room, out = [], []
    for s in sizes:
        fits = [(r, k) for k, r in enumerate(room) if s <= capacity and r >= s]
        if fits:
            k = min(fits)[1]
        else:
            k = len(room)
            if k == limit:
                return None
            room.append(capacity if s <= capacity else 0)
        if s <= capacity:
            room[k] -= s
        out.append(k)
    return out


def test_best_fit_equals_a_plain_scan():
    rng = random.Random(5)
    for _ in range(60):
        sizes = sorted((rng.choice([rng.randint(1, 30), rng.randint(1, 300)]) for _ in range(rng.randint(0, 80))), reverse=True)
        capacity = rng.randint(20, 250)
        assert sharding.best_fit(sizes, capacity) == naive_best_fit(sizes, capacity)
        shards = rng.randint(1, 12)
        least, placed = sharding.least_capacity(sizes, shards)
        assert placed == naive_best_fit(sizes, least, shards) and len(set(placed)) <= shards


def test_the_tree_stays_sorted_and_balanced():
    rng, tree, held = random.Random(2), None, []
    for k in range(3000):
        if held and rng.random() < 0.45:
            gone = held.pop(rng.randrange(len(held)))
            tree = sharding.tree_remove(tree, gone)
        else:
            held.append((rng.randint(0, 50), k))
            tree = sharding.tree_insert(tree, held[-1])
        probe = (rng.randint(0, 55), -1)
        assert sharding.tree_at_least(tree, probe) == min((x for x in held if x >= probe), default=None)
    assert tree[3] <= 1.45 * math.log2(len(held) + 2)


def brute_shards(rows, shards):
    digest = lambda t: hashlib.md5((t or "").encode()).hexdigest()
    size = lambda t: len((t or "").encode()) + 16                    # noqa: E731
    groups = Counter()
    for _, t in rows:
        groups[digest(t)] += size(t)
    bundles = sharding.GRAIN * shards
    units = Counter()
    unit = {g: g if s > sum(groups.values()) // bundles else str(int(g[:8], 16) % bundles) for g, s in groups.items()}
    for g, s in groups.items():
        units[unit[g]] += s
    order = sorted(units, key=lambda u: (-units[u], u))
    capacity = sharding.least_capacity([units[u] for u in order], shards)[0]
    place = dict(zip(order, naive_best_fit([units[u] for u in order], capacity, shards)))
    return {g: place[unit[g]] for g in groups}, digest, size


@pytest.mark.parametrize("grain", [128, 2])
def test_shards_match_brute_force(spark, corpus, monkeypatch, grain):
    monkeypatch.setattr(sharding, "GRAIN", grain)
    docs = corpus[0]
    frame = spark.createDataFrame([(*d, "x", "x", "x", "x", "x") for d in docs], DOCS).repartition(5)
    got = sharding.sharded(frame, shards=7).collect()
    where, digest, size = brute_shards(docs, 7)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard) for r in got) == Counter(
        (d, size(t), zlib.crc32((t or "").encode()), where[digest(t)]) for d, t in docs)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append((r.slot, r.text_md5, -1 if r.doc_id is None else r.doc_id))
        assert (r.law, r.grown_shard) == ("bytes", None)
    for rows in by.values():
        rows.sort()
        assert [r[0] for r in rows] == list(range(len(rows))) and [r[1:] for r in rows] == sorted(r[1:] for r in rows)


def test_shards_are_near_equal_and_hot_groups_whole(spark):
    rows = [(k, "the same text again " * 5) for k in range(3000)] + [(k + 5000, f"text {k} " * (k % 40)) for k in range(6000)]
    got = sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string"), shards=40)
    loads = {r.shard: r for r in got.groupBy("shard").agg(F.sum("size").alias("b"), F.count_distinct("text_md5").alias("g")).collect()}
    assert len(loads) == 40
    rest = [r.b for r in loads.values() if r.g > 1]
    assert len(rest) == 39 and max(rest) < 1.02 * min(rest)


def test_shards_of_a_given_capacity(spark):
    rows = [(k, "x" * (k % 50)) for k in range(2000)] + [(9000, "y" * 9000)]
    got = sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string"), capacity=8000).groupBy("shard").agg(
        F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect()
    total = sum(len(t) + 16 for _, t in rows)
    assert all(r.b <= 8000 or r.n == 1 for r in got) and len(got) <= 1.2 * total / 8000 + 2
    assert sharding.sharded(spark.createDataFrame([], "doc_id long, text string"), shards=4).count() == 0
    with pytest.raises(ValueError):
        sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string"))


def brute_negatives(rows, scale, anchors, n_pos=5, n_neg=3, low=50, high=95):
    clean = []
    for i, v, label in dict.fromkeys((i, None if v is None else tuple(v), label) for i, v, label in rows):
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        x = [math.floor(scale * c) for c in v]
        if sum(c * c for c in x) < 2**62:
            clean.append((i, x, label))
    dot = lambda a, b: sum(p * q for p, q in zip(a, b))
    out = []
    for k, (i, x, label) in enumerate(clean):
        if i % anchors:
            continue
        near = sorted((-dot(x, y), j) for m, (j, y, other) in enumerate(clean) if m != k and other == label)[:n_pos]
        far = sorted((-dot(x, y), j) for j, y, other in clean if other != label)
        for s, j in near:
            inside = [(t, n) for t, n in far if low * -s <= 100 * -t <= high * -s][:n_neg]
            out += [(i, j, r + 1, n, -s, -t) for r, (t, n) in enumerate(inside)]
    return sorted(out)


VECTORS = "vec_id long, embedding array<float>, label int, id string, block string, x string, anchor string"


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(12)
    rows = [(k, rng.normal(0.4, 0.3, 16).astype(np.float32).tolist(), int(rng.integers(0, 3)) if k % 3 else 0) for k in range(420)]
    same = rows[10][1]
    rows += [(1000 + k, same, k % 2) for k in range(80)]                     # ties over two labels
    rows += [(2000, None, 1), (2001, [1.0, None], 1), (2002, [float("nan")] * 16, 1), (2003, [float("inf")], 1), (2004, same, None),
             (None, same, 1), (2005, [], 1), (2010, [3.0, 2.0], 2), (2011, [1e30] * 16, 1), (2012, [-0.0] * 16, 0), rows[20], rows[20],
             (20, rows[21][1], rows[20][2]), (2013, rng.normal(1, 1, 300).tolist(), 1), (2020, [3e6] * 16, 2), (2030, [-5e6] * 16, 0)]
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]


@pytest.mark.parametrize("block", [1024, 33])
def test_hard_negatives_match_brute_force(spark, vectors, monkeypatch, block):
    monkeypatch.setattr(negatives, "BLOCK", block)
    frame = spark.createDataFrame([(*v, "a", "b", "c", "d") for v in vectors], VECTORS).repartition(4)
    got = negatives.hard_negatives(frame, F.col("vec_id") % 10 == 0)
    assert got.dtypes == [(c, "int" if c == "rank" else "bigint") for c in (
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")]
    want = brute_negatives(vectors, 256, 10)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 300


def test_hard_negatives_of_nothing(spark, vectors):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert negatives.hard_negatives(none, F.col("vec_id") % 10 == 0).count() == 0
    some = spark.createDataFrame(vectors[:50], "vec_id long, embedding array<float>, label int")
    assert negatives.hard_negatives(some, F.lit(False)).count() == 0


def test_residue_products_are_exact():
    rng = np.random.default_rng(4)
    for depth, top in ((1, 2**31), (64, 500), (64, 2**27), (256, 2**20), (700, 2**25)):
        a, b = (rng.integers(-top, top, (9, depth)) for _ in range(2))
        want = np.array([[sum(int(p) * int(q) for p, q in zip(x, y)) for y in b] for x in a], dtype=object)
        bound = int(max(abs(int(v)) for v in want.ravel())) + 1
        primes = negatives.moduli(min(depth, negatives.DEPTH), bound)
        assert min(depth, negatives.DEPTH) * (max(primes) // 2) ** 2 <= negatives.EXACT
        assert (negatives.products(negatives.residues(a, primes), negatives.residues(b, primes), primes) == want.astype(np.int64)).all()
