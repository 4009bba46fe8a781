"""Hard negatives from exact integer similarities, by residue-number-system matrix products in float32."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import store, unstore

BLOCK = 1024      # rows of a block
BLOCK_BYTES = 1 << 22
STRIPE = 4        # blocks of rows that meet one block of anchors in one task
DEPTH = 256       # components multiplied before a reduction
EXACT = 1 << 24   # float32 holds every integer up to here
TOO_LONG = 2.0**62
LOWEST = np.iinfo(np.int64).min


@lru_cache(maxsize=64)
def moduli(depth: int, bound: int) -> tuple[int, ...]:
    """The largest primes whose ``depth``-term products stay exact in float32, enough to tell all of -bound .. bound apart."""
    top = 2 * int((EXACT / depth) ** 0.5) + 1
    sieve = np.ones(top + 1, dtype=bool)
    sieve[:3] = False
    sieve[4::2] = False
    for k in range(3, int(top**0.5) + 1, 2):
        sieve[k * k::k] &= ~sieve[k]
    out, product = [], 1
    for p in np.flatnonzero(sieve)[::-1].tolist():
        if product > 2 * bound:
            break
        out.append(p)
        product *= p
    if product <= 2 * bound:
        raise OverflowError("scores are too large for the primes at this depth")
    return tuple(out)


def balanced(x: np.ndarray, p: int) -> np.ndarray:
    """Residues of ``x`` in -(p-1)/2 .. (p-1)/2."""
    x = x % p
    x[x > p // 2] -= p
    return x


def residues(x: np.ndarray, primes: tuple[int, ...]) -> list[np.ndarray]:
    return [balanced(x, p).astype(np.float32) for p in primes]


def products(a: list[np.ndarray], b: list[np.ndarray], primes: tuple[int, ...]) -> np.ndarray:
    """The signed integer products a @ b.T from both sides' residues, by balanced mixed-radix Chinese remaindering."""
    depth = min(a[0].shape[1], b[0].shape[1])
    score = np.zeros((len(a[0]), len(b[0])), dtype=np.int64)
    weight = 1
    for k, p in enumerate(primes):
        part = np.zeros(score.shape, dtype=np.int32)
        for i in range(0, depth, DEPTH):
            part = balanced(part + balanced((a[k][:, i:min(i + DEPTH, depth)] @ b[k][:, i:min(i + DEPTH, depth)].T).astype(np.int32), p), p)
        digit = balanced((part - score % p) * pow(weight, -1, p), p) if k else part.astype(np.int64)
        # the true score fits 64 bits, so wrapping in between does no harm
        score += digit * np.int64((weight + 2**63) % 2**64 - 2**63)
        weight *= p
    return score


def _quantised(scale: float):
    """id, label, anchor and the vector as 2, 4 or 8 byte integers; rows that take no part go."""
    def run(batches):
        for batch in batches:
            vectors = batch.column(3)
            keep, out = np.zeros(batch.num_rows, dtype=bool), []
            for r in range(batch.num_rows):
                x = vectors[r].values
                if x is None or x.null_count:
                    continue
                x = np.floor(x.to_numpy(zero_copy_only=False).astype(np.float64) * scale)
                with np.errstate(over="ignore"):
                    if not np.isfinite(x).all() or float((x * x).sum()) >= TOO_LONG:
                        continue
                top = np.abs(x).max(initial=0)
                out.append(x.astype("<i2" if top < 2**15 else "<i4" if top < 2**31 else "<i8"))
                keep[r] = True
            kept = batch.filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns[:3], pa.array([bytes([x.itemsize]) + x.tobytes() for x in out], pa.binary())], names=["id", "label", "anchor", "x"])
    return run


def _unpacked(x: bytes) -> np.ndarray:
    return np.frombuffer(x, f"<i{x[0]}", offset=1)


def _matrix(rows: list[bytes]) -> np.ndarray:
    vectors = [_unpacked(x) for x in rows]
    out = np.zeros((len(rows), max(map(len, vectors), default=0)), dtype=max((v.dtype for v in vectors), key=lambda t: t.itemsize, default=np.int16))
    for k, v in enumerate(vectors):
        out[k, :len(v)] = v
    return out


def _blocks(batches):
    """Rows sorted by block become one row a block: its number, ids, labels and matrix, rows in order of id."""
    held: dict = {"block": None, "rows": []}

    def made():
        rows = sorted(held["rows"], key=lambda r: (r[0], r[2]))
        x = _matrix([r[2] for r in rows])
        labels = np.array([r[1] for r in rows], dtype=np.int64)
        length = (x.astype(np.float64) ** 2).sum(axis=1).max(initial=0.0)
        return [held["block"], np.array([r[0] for r in rows], dtype=np.int64).tobytes(), labels.tobytes(),
                x.dtype.str.encode() + x.tobytes(), float(length) * (1 + 1e-9), np.unique(labels).tolist()]

    def given(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
            pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.list_(pa.int64())))],
            names=["block", "ids", "labels", "x", "length", "names"])

    for batch in batches:
        for block, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if block != held["block"]:
                if held["rows"]:
                    yield given([made()])
                held = {"block": block, "rows": []}
            held["rows"].append(row)
    if held["rows"]:
        yield given([made()])


def _blocked(rows: DataFrame, per_block: int, name: str) -> tuple[DataFrame, str]:
    """``rows(id, label, x)`` in blocks of ``per_block``, numbered in order of (label, id); equal rows count once."""
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    laid, path = store(
        rows.repartitionByRange(parts, "label", "id").dropDuplicates(["label", "id", "x"]).sortWithinPartitions("label", "id", "x")
        .withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), name)
    runs = laid.groupBy("part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("k"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)      # a row for each range partition
    runs = runs.select("part", (F.coalesce(F.sum("k").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    placed = laid.join(F.broadcast(runs), "part").select(
        F.floor((F.col("at") + F.col("shift")) / per_block).cast("long").alias("block"), "id", "label", "x")
    out = placed.repartition("block").sortWithinPartitions("block").mapInArrow(
        _blocks, "block long, ids binary, labels binary, x binary, length double, names array<long>")
    blocks, block_path = store(out, f"{name}-blocks", BLOCK)
    unstore(rows.sparkSession, path)
    return blocks, block_path


class _Block:
    def __init__(self, ids: bytes, labels: bytes, x: bytes, length: float):
        self.ids, self.labels, self.length = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64), length
        x_kind, x_data = x[:3].decode(), x[3:]
        self.x = np.frombuffer(x_data, x_kind).reshape(len(self.ids), -1).astype(np.int64)
        self._residues: dict = {}

    def residues(self, primes):
        if primes not in self._residues:
            self._residues = {primes: residues(self.x, primes)}
        return self._residues[primes]


def _scores(a: _Block, b: _Block) -> np.ndarray:
    bound = int((a.length * b.length) ** 0.5) + 1
    depth = max(1, min(a.x.shape[1], b.x.shape[1], DEPTH))
    primes = moduli(depth, bound)
    return products(a.residues(primes), b.residues(primes), primes)


class _Best:
    """The first ``n`` entries of every group, by score (higher first) and id."""

    def __init__(self, groups: int, n: int):
        self.n = n
        self.floor = np.full(groups, LOWEST, dtype=np.int64)      # the weakest score of a full group
        self.held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))

    def add(self, groups: np.ndarray, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """Entries of a score matrix, one row for each of ``groups``, where ``allowed``."""
        if not scores.size:
            return
        open_rows = allowed & (scores >= self.floor[groups][:, None])
        if scores.shape[1] > self.n:
            masked = np.where(open_rows, scores, LOWEST)
            open_rows &= scores >= np.partition(masked, -self.n, axis=1)[:, -self.n][:, None]
        r, c = np.nonzero(open_rows)
        g, s, i = (np.concatenate(x) for x in zip(self.held, (groups[r], scores[r, c], ids[c])))
        order = np.lexsort((i, -s, g))
        g, s, i = g[order], s[order], i[order]
        rank = np.arange(len(g)) - np.searchsorted(g, g)
        self.held = tuple(x[rank < self.n] for x in (g, s, i))
        last = rank == self.n - 1
        self.floor[g[last]] = s[last]


def _cells(batches, start):
    """Runs over the pairs of blocks in one task; ``start(row)`` opens a cell, which takes every block of rows and then yields."""
    cell, key = None, None
    for batch in batches:
        for row in batch.to_pylist():
            if (row["ablock"], row["stripe"]) != key:
                if cell:
                    yield from cell.out()
                cell, key = start(row), (row["ablock"], row["stripe"])
            cell.take(_Block(row["ids"], row["labels"], row["x"], row["length"]))
    if cell:
        yield from cell.out()


def _positives(n: int, per_block: int):
    class Cell:
        def __init__(self, row):
            self.a = _Block(row["a_ids"], row["a_labels"], row["a_x"], row["a_length"])
            self.first, self.best = row["ablock"] * per_block, _Best(len(self.a.ids), n)

        def take(self, b):
            allowed = self.a.labels[:, None] == b.labels[None, :]
            if not allowed.any():
                return
            r, c = np.nonzero(allowed & (self.a.ids[:, None] == b.ids[None, :]))
            width = max(self.a.x.shape[1], b.x.shape[1])
            x, y = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (self.a.x[r], b.x[c]))
            own = (x == y).all(axis=1)
            allowed[r[own], c[own]] = False
            self.best.add(np.arange(len(self.a.ids)), _scores(self.a, b), b.ids, allowed)

        def out(self):
            g, s, i = self.best.held
            yield pa.RecordBatch.from_arrays([pa.array(g + self.first), pa.array(self.a.ids[g]), pa.array(s), pa.array(i)],
                                             names=["anchor", "anchor_id", "score", "id"])

    return lambda batches: _cells(batches, Cell)


def _negatives(n: int, low: int, high: int, per_block: int):
    class Cell:
        def __init__(self, row):
            self.a = _Block(row["a_ids"], row["a_labels"], row["a_x"], row["a_length"])
            self.first = row["ablock"] * per_block
            wanted = row["wanted"]
            self.at = np.array([w["anchor"] - self.first for w in wanted], np.int64)
            self.place = np.array([w["place"] for w in wanted], np.int64)
            score = [w["score"] for w in wanted]
            self.low = np.array([-(-low * s // 100) for s in score], np.int64)
            self.high = np.array([high * s // 100 for s in score], np.int64)
            self.best = _Best(len(wanted), n)

        def take(self, b):
            other = self.a.labels[:, None] != b.labels[None, :]
            if not other.any():
                return
            scores = _scores(self.a, b)
            for place in np.unique(self.place):
                of = np.flatnonzero(self.place == place)
                mine = scores[self.at[of]]
                self.best.add(of, mine, b.ids, other[self.at[of]] & (mine >= self.low[of][:, None]) & (mine <= self.high[of][:, None]))

        def out(self):
            g, s, i = self.best.held
            yield pa.RecordBatch.from_arrays([pa.array(self.at[g] + self.first), pa.array(self.place[g]), pa.array(s), pa.array(i)],
                                             names=["anchor", "place", "score", "id"])

    return lambda batches: _cells(batches, Cell)


def _paired(rows: DataFrame, anchors: DataFrame, reach: DataFrame, cells: int) -> DataFrame:
    """Every block of ``rows`` next to each block of ``anchors`` that reaches it (ablock, first .. last), by (ablock, stripe)."""
    spans = reach.select("ablock", F.explode(F.sequence("first", "last")).alias("block"))
    copies = rows.select("block", "ids", "labels", "x", "length").join(spans, "block").withColumn("stripe", F.floor(F.col("block") / STRIPE))
    stripes = reach.select("ablock", F.explode(F.sequence(F.floor(F.col("first") / STRIPE), F.floor(F.col("last") / STRIPE))).alias("stripe"))
    given = anchors.join(stripes, "ablock")
    parts = max(1, min(cells, 1 << 15))
    keys = ["ablock", "stripe"]
    return copies.repartition(parts, *keys).join(given.repartition(parts, *keys), keys).sortWithinPartitions(*keys)


def hard_negatives(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   scale: float = 256, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """Per anchor, positive and rank: anchor_id, positive_id, rank, negative_id, positive_score, negative_score (exact integers).

    Components become floor(scale * x); a score is the integer inner product.  ``anchor`` says which rows are anchors.  An
    anchor's positives are its best ``positives`` other rows of the same label; each positive's negatives are the best ``negatives``
    rows of other labels with low * p <= 100 * score <= high * p, p being the positive's score.  Equal scores: smaller id first.

    Method: rows and anchors are sorted by label and cut into blocks of BLOCK rows.  Matrices of a pair of blocks are reduced modulo
    primes small enough for exact float32 products, as many as the blocks' longest vectors need, multiplied modulo each, and put
    together by Chinese remaindering.  A first run meets only blocks that share labels and finds the positives; a second one meets
    all other labels and selects inside each positive's window.  The anchors are a stated query set against all rows: every task
    holds one pair of blocks at a time and keeps the best entries of its cell (one block of anchors, STRIPE blocks of rows).

    Rows with a null id, label or vector or a null or non-finite component take no part, nor do vectors whose squared
    integer length reaches 2^62 (their scores need not fit 64 bits).  Shorter vectors count as padded with zeros.  Equal rows
    count once; rows that share an id but differ are rows of their own.  Other columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    source = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(vector_col).cast("array<double>").alias("v"))
    clean, clean_path = store(source.mapInArrow(_quantised(scale), "id long, label long, anchor boolean, x binary"), "vectors", BLOCK)
    width = clean.agg(F.max(F.octet_length("x"))).first()[0] or 1
    per_block = max(1, min(BLOCK, BLOCK_BYTES // width))
    rows, row_path = _blocked(clean.select("id", "label", "x"), per_block, "rows")
    anchors, anchor_path = _blocked(clean.where("anchor").select("id", "label", "x"), per_block, "anchors")
    unstore(spark, clean_path)
    anchors = anchors.select(F.col("block").alias("ablock"), F.col("ids").alias("a_ids"), F.col("labels").alias("a_labels"),
                             F.col("x").alias("a_x"), F.col("length").alias("a_length"), "names")
    # a label's rows stand in neighbouring blocks
    where = rows.select("block", F.explode("names").alias("label")).groupBy("label").agg(F.min("block").alias("first"), F.max("block").alias("last"))
    same = anchors.select("ablock", F.explode("names").alias("label")).join(where, "label").groupBy("ablock").agg(
        F.min("first").alias("first"), F.max("last").alias("last"))
    row_blocks, anchor_blocks = rows.count(), anchors.count()
    cells = anchor_blocks * -(-row_blocks // STRIPE)
    found = _paired(rows, anchors.drop("names"), same, cells).mapInArrow(
        _positives(positives, per_block), "anchor long, anchor_id long, score long, id long")
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    best, best_path = store(found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives), "positives", 16)
    wanted = best.groupBy(F.floor(F.col("anchor") / per_block).alias("ablock")).agg(
        F.collect_list(F.struct("anchor", "place", "score")).alias("wanted"))
    everywhere = wanted.select("ablock", F.lit(0).cast("long").alias("first"), F.lit(max(row_blocks - 1, 0)).cast("long").alias("last"))
    chosen = _paired(rows, anchors.drop("names").join(wanted, "ablock"), everywhere, cells).mapInArrow(
        _negatives(negatives, low, high, per_block), "anchor long, place long, score long, id long")
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id")
    kept, _ = store(chosen.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives), "negatives", 16)
    for path in (row_path, anchor_path):
        unstore(spark, path)
    return kept.join(best.select("anchor", F.col("place").cast("long").alias("place"), "anchor_id", F.col("id").alias("positive_id"),
                                 F.col("score").alias("positive_score")), ["anchor", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
