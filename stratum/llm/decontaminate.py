"""Benchmark decontamination by spaced seeds, verified along the hit's diagonal."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash as wh
from .store import store

# Every placement of 11 equal words within 13 consecutive ones contains one of these masks whole
# (tests/llm enumerates them all), so at most two substituted words cannot hide an overlap.
SPAN, NEED = 13, 11
MASKS = ((0, 1, 3, 4, 7, 8, 9), (0, 1, 2, 3, 5, 7, 8), (0, 1, 5, 6, 7, 9, 10))
SHORTEST = 5
BLOCK_WORDS = 2_000_000     # benchmark words held by a task at a time
SCHEMA = "doc_id long, item_id long, n_matched long, first_word long, last_word long"


def seeds(h: np.ndarray, mask: tuple, k: int) -> np.ndarray:
    n = len(h) - mask[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for j, at in enumerate(mask):
        out += h[at:at + n] * np.uint64(wh._odd(1000 + 16 * k + j))
    return wh.mix(out)


class Index:
    """Seed hashes of one block of benchmark items."""

    def __init__(self, items: list[tuple[int, str]]):
        kept, self.ids = [], []
        for item, text in items:
            raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
            h = wh.hash_words(raw, np.array([0, len(raw)]))[2]
            if len(h) >= SHORTEST:
                kept.append(h)
                self.ids.append(item)
        self.words = np.concatenate(kept) if kept else np.zeros(0, np.uint64)
        self.at = np.cumsum([0, *map(len, kept)])
        short = sorted({len(h) for h in kept if len(h) < NEED})
        self.masks = [*enumerate(MASKS), *((100 + n, tuple(range(n))) for n in short)]
        keys, where = [], []
        for k, mask in self.masks:
            for i, h in enumerate(kept):
                if (k >= 100) == (len(h) < NEED) and (k < 100 or len(h) == mask[-1] + 1):
                    keys.append(seeds(h, mask, k))
                    where.append(self.at[i] + np.arange(len(keys[-1])))
        keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.where = keys[order], (np.concatenate(where) if where else np.zeros(0, np.int64))[order]
        self._mark()

    def _mark(self):
        keys = self.keys
        self.shift = np.uint64(64 - min(24, max(16, int(len(keys)).bit_length() + 4)))
        self.seen = np.zeros(1 << (64 - int(self.shift)), dtype=bool)
        self.seen[self.keys >> self.shift] = True

    def parts(self) -> tuple:
        return self.ids, self.words, self.at, self.masks, self.keys, self.where

    @classmethod
    def of(cls, parts: tuple) -> Index:
        index = cls.__new__(cls)
        index.ids, index.words, index.at, index.masks, index.keys, index.where = parts
        index._mark()
        return index

    def hits(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in h, position in the items' words) of all equal seeds."""
        left, right = [], []
        for k, mask in self.masks:
            s = seeds(h, mask, k)
            p = np.flatnonzero(self.seen[s >> self.shift])
            a, b = np.searchsorted(self.keys, s[p], "left"), np.searchsorted(self.keys, s[p], "right")
            n = b - a
            left.append(np.repeat(p, n))
            right.append(self.where[np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())])
        return np.concatenate(left), np.concatenate(right)


def overlaps(h: np.ndarray, rows: np.ndarray, index: Index):
    """Verified (row, item, item positions, word positions) of word hashes ``h`` whose rows start at ``rows``."""
    p, q = index.hits(h)
    if not len(p):
        return
    row, item = np.searchsorted(rows, p, "right") - 1, np.searchsorted(index.at, q, "right") - 1
    for r, t, d in np.unique(np.stack([row, item, p - q], axis=1), axis=0):
        a, b = index.at[t], index.at[t + 1]
        low, high = max(a, rows[r] - d), min(b, rows[r + 1] - d)
        at = low + np.flatnonzero(index.words[low:high] == h[low + d:high + d])
        need = min(NEED, b - a)
        span = SPAN if need == NEED else need
        if len(at) < need:
            continue
        first = np.flatnonzero(at[need - 1:] - at[:len(at) - need + 1] < span)
        if len(first):
            inside = np.zeros(len(at) + 1, dtype=np.int64)
            np.add.at(inside, first, 1)
            np.add.at(inside, first + need, -1)
            at = at[np.cumsum(inside[:-1]) > 0]
            yield r, t, at - a, at + d - rows[r]


def _scan(held):
    def run(batches):
        index = Index.of(held.value)
        for batch in batches:
            buf, offsets = wh.text_bytes(batch.column(1))
            ids = batch.column(0)
            out = {}
            for i, j in wh.row_groups(offsets):
                base = offsets[i:j + 1] - offsets[i]
                starts, _, h = wh.hash_words(buf[offsets[i]:offsets[j]], base)
                rows = np.searchsorted(starts, base)
                for r, t, q, p in overlaps(h, rows, index):
                    key = (i + int(r), index.ids[t])
                    was = out.get(key)
                    out[key] = (q, p[0], p[-1]) if was is None else (
                        np.union1d(was[0], q), min(was[1], p[0]), max(was[2], p[-1]))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array([k[0] for k in out])), pa.array([k[1] for k in out], pa.int64()),
                     *(pa.array(x, pa.int64()) for x in zip(*((len(q), a, b) for q, a, b in out.values())))],
                    names=["doc_id", "item_id", "n_matched", "first_word", "last_word"])
    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, n_matched, first_word, last_word) of every document that overlaps a benchmark item.

    Words are maximal runs of non-blank characters, A-Z lower-cased.  A document overlaps an item when, along
    one alignment, 11 words within 13 consecutive ones are equal (up to two substitutions); an item of 5 to 10
    words must occur whole, shorter ones are ignored.  ``n_matched`` counts the item's words in such stretches,
    ``first_word`` and ``last_word`` are 0-based word positions in the document.

    Method: three fixed masks hash 7 of up to 11 positions, equal seeds of document and item give an alignment,
    and only there are the words compared.  The benchmark is hashed in blocks of about BLOCK_WORDS words, an item's rows in one
    block.  Each block is broadcast, searched and its result written before the next one is fetched, so the driver and
    the tasks hold one block at a time whatever the benchmark's size; documents are not shuffled.  Null or empty texts and null item ids overlap nothing; a null document id is reported as null;
    repeated documents are reported each, repeated item ids together.  Empty tables give no rows.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("body")).where(
        "item IS NOT NULL AND body IS NOT NULL")
    total = items.agg(F.sum(F.length("body"))).first()[0] or 0
    blocks = max(1, -(-total // (4 * BLOCK_WORDS)))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("body"))
    found = None
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k)
        held = spark.sparkContext.broadcast(Index([(r.item, r.body) for r in block.distinct().collect()]).parts())
        part, _ = store(source.mapInArrow(_scan(held), SCHEMA), "overlaps")
        held.destroy()
        found = part if found is None else found.unionAll(part)
    return found.withColumnRenamed("doc_id", id_col)
