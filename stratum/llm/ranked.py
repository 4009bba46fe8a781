"""Ranked lexical search by a dual tree: bounds of item nodes against document nodes prune whole batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import with_global_position
from . import wordhash as wh
from .store import store, unstore

SLAB = 256            # items searched in one run over the documents
COLUMNS = 1 << 15     # terms of a tree of items; a slab with more is cut into several trees
BATCH = 2048          # documents of a tree
ENTRIES = 1 << 17     # terms of all documents of a tree together, unless it is one document
LEAF = 32             # documents of a leaf
SEEDS = 1 << 17       # documents, by hash, whose best leaves give the first thresholds
BITS = 1 << 25        # of the filter of terms that occur in any item

# letters, digits and everything beyond ASCII
IS_TERM = np.zeros(256, dtype=bool)
for _first, _last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    IS_TERM[_first:_last + 1] = True


def _counted(h: np.ndarray, owner: np.ndarray):
    """Distinct (owner, term) pairs in that order, and how often each occurs."""
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    first = np.ones(len(h), dtype=bool)
    first[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    return owner[at], h[at], np.diff(np.append(at, len(h)))


def _vectors(known: np.ndarray | None):
    """id, n (terms with repeats), terms and how often each occurs; only terms that ``known``, a bit filter, holds."""
    def run(batches):
        for batch in batches:
            buf, at = wh.text_bytes(batch.column(1))
            for i, j in wh.row_groups(at):
                starts, _, h = wh.hash_words(buf[at[i]:at[j]], at[i:j + 1] - at[i], is_word=IS_TERM)
                owner = np.searchsorted(at[i:j + 1] - at[i], starts, side="right") - 1
                n = np.bincount(owner, minlength=j - i)
                if known is not None:
                    bit = h & np.uint64(BITS - 1)
                    hit = (known[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    h, owner = h[hit], owner[hit]
                owner, h, tf = _counted(h, owner)
                offsets = np.searchsorted(owner, np.arange(j - i + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), pa.array(n.astype(np.int64)),
                    pa.ListArray.from_arrays(offsets, h.view(np.int64)), pa.ListArray.from_arrays(offsets, tf.astype(np.int32))],
                    names=["id", "n", "terms", "tf"])
    return run


def _filter_bits(terms: DataFrame) -> np.ndarray:
    """A bit for each value of the terms' low bits that occurs: BITS bits, however many terms there are."""
    bit = F.col("term").bitwiseAND(F.lit(BITS - 1)) + 1
    rows = terms.select(F.bitmap_bucket_number(bit).alias("b"), F.bitmap_bit_position(bit).alias("p")) \
        .groupBy("b").agg(F.bitmap_construct_agg("p").alias("bits")).collect()
    out = np.zeros(BITS // 8, dtype=np.uint8)
    for r in rows:
        at = (r["b"] - 1) * 4096
        out[at:at + 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def _levels(leaves: np.ndarray, combine) -> list[np.ndarray]:
    """A binary tree's levels, root first, over a power of two of leaves."""
    out = [leaves]
    while len(out[0]) > 1:
        out.insert(0, combine(out[0][0::2], out[0][1::2]))
    return out


def _power(n: int) -> int:
    return 1 << max(0, n - 1).bit_length()


class _Tree:
    """Items with their term weights; every node holds the greatest weight of each term below it."""

    def __init__(self, numbers: list[int], terms: list[np.ndarray], weights: list[np.ndarray]):
        top = [t[w.argmax()] for t, w in zip(terms, weights)]
        order = sorted(range(len(numbers)), key=lambda k: (top[k], numbers[k]))
        self.numbers = [numbers[k] for k in order]
        self.vocabulary = np.unique(np.concatenate(terms))
        self.columns = [np.searchsorted(self.vocabulary, terms[k]) for k in order]
        self.weights = [weights[k] for k in order]
        leaves = np.zeros((_power(len(numbers)), len(self.vocabulary)), dtype=np.float32)
        for k, (c, w) in enumerate(zip(self.columns, self.weights)):
            leaves[k, c] = w
        self.levels = _levels(leaves, np.maximum)


def _trees(items: list) -> list[_Tree]:
    """Trees of at most COLUMNS terms, unless one item alone has more."""
    out, held, seen = [], [], set()
    for number, terms, weights in items:
        new = seen.union(terms)
        if held and len(new) > COLUMNS:
            out.append(_Tree(*zip(*held)))
            held, new = [], set(terms)
        held.append((number, np.array(terms, np.int64), np.array(weights, np.int64)))
        seen = new
    return [*out, _Tree(*zip(*held))] if held else out


class _Search:
    """One tree of items against batches of documents; keeps every item's ``k`` best."""

    def __init__(self, tree: _Tree, k: int, floors: dict[int, int], seed: bool):
        self.tree, self.k, self.seed = tree, k, seed
        self.floor = np.array([floors.get(n, 1) for n in tree.numbers], dtype=np.int64)
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in tree.numbers]

    def batch(self, ids, owner, terms, impact) -> None:
        """Documents' (owner, term, impact) entries, in order of owner."""
        tree = self.tree
        col = np.minimum(np.searchsorted(tree.vocabulary, terms), len(tree.vocabulary) - 1)
        hit = tree.vocabulary[col] == terms
        owner, col, impact = owner[hit], col[hit], impact[hit]
        if not len(owner):
            return
        # documents with the same dearest term stand next to each other
        dear = np.lexsort((tree.levels[0][0, col] * impact, owner))
        last = np.append(np.flatnonzero(np.diff(owner)), len(owner) - 1)
        docs, lead = owner[last], col[dear[last]]
        place = np.empty(int(docs[-1]) + 1, dtype=np.int64)
        by_lead = np.argsort(lead, kind="stable")
        place[docs[by_lead]] = np.arange(len(docs))
        order = np.argsort(place[owner], kind="stable")
        owner, col, impact = owner[order], col[order], impact[order]
        leaf = place[owner] // LEAF
        used, slim = np.unique(col, return_inverse=True)
        nodes = self._document_levels(leaf, slim, impact, _power(-(-len(docs) // LEAF)), len(used))
        alive = self._alive(nodes, used)
        if alive is not None:
            self._score(alive, ids, owner, leaf, col, impact)

    @staticmethod
    def _document_levels(leaf, slim, impact, leaves: int, width: int) -> list[np.ndarray]:
        key = leaf * width + slim
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.append(0, np.flatnonzero(np.diff(key)) + 1)
        out = np.zeros(leaves * width, dtype=np.float32)
        out[key[first]] = np.maximum.reduceat(impact[order], first)
        return _levels(out.reshape(leaves, width), np.maximum)

    def _alive(self, nodes: list[np.ndarray], used: np.ndarray) -> np.ndarray | None:
        """Which (item, document leaf) pairs no bound rules out."""
        items = self.tree.levels
        floors = np.full(len(items[-1]), np.inf)
        floors[:len(self.floor)] = self.floor
        weakest = _levels(floors, np.minimum)
        slack = 1 + (len(used) + 4) * 2.0**-22      # float32 sums of that many products, rounded down at worst
        alive = np.ones((1, 1), dtype=bool)
        for level in range(max(len(items), len(nodes))):
            if 0 < level < len(items):
                alive = np.repeat(alive, 2, axis=0)
            if 0 < level < len(nodes):
                alive = np.repeat(alive, 2, axis=1)
            a, b = min(level, len(items) - 1), min(level, len(nodes) - 1)
            rows, cols = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
            if not len(rows):
                return None
            bound = (items[a][np.ix_(rows, used)] @ nodes[b][cols].T).astype(np.float64) * slack
            alive[np.ix_(rows, cols)] &= bound >= weakest[a][rows][:, None]
        if self.seed and alive.any():
            bound = items[-1][:, used] @ nodes[-1].T
            alive &= np.arange(alive.shape[1]) == np.where(alive, bound, -1).argmax(axis=1)[:, None]
        return alive

    def _score(self, alive, ids, owner, leaf, col, impact) -> None:
        weight = np.zeros(len(self.tree.vocabulary), dtype=np.int64)
        for k in np.flatnonzero(alive.any(axis=1)):
            inside = alive[k][leaf]
            docs, columns = owner[inside], self.tree.columns[k]
            if not len(docs):
                continue
            weight[columns] = self.tree.weights[k]
            first = np.append(0, np.flatnonzero(np.diff(docs)) + 1)
            scores = np.add.reduceat(weight[col[inside]] * impact[inside], first)
            weight[columns] = 0
            good = scores >= self.floor[k]
            s, i = np.concatenate([self.best[k][0], scores[good]]), np.concatenate([self.best[k][1], ids[docs[first[good]]]])
            order = np.lexsort((i, -s))[:self.k]
            self.best[k] = s[order], i[order]
            if len(order) == self.k:
                self.floor[k] = max(self.floor[k], s[order[-1]])


def _searched(items: list, k: int, floors: dict[int, int], seed: bool, total: int, length: int):
    """The best documents of each item within one task's rows."""
    def run(batches):
        searches = [_Search(tree, k, floors, seed) for tree in _trees(items)]
        for batch in batches:
            ids = batch.column(0).to_numpy()
            norm = 50 + 50 * batch.column(1).to_numpy() * total // length
            lists = batch.column(2)
            at = lists.offsets.to_numpy().astype(np.int64)
            terms = lists.values.to_numpy()
            tf = batch.column(3).values.to_numpy().astype(np.int64)
            i = 0
            while i < len(ids):
                j = int(np.searchsorted(at, at[i] + ENTRIES, side="right")) - 1
                j = min(len(ids), max(i + 1, j))
                a, b = at[i], at[j]
                owner = np.repeat(np.arange(j - i), np.diff(at[i:j + 1]))
                impact = 10**9 * tf[a:b] // (1000 * tf[a:b] + 20 * norm[i:j][owner])
                for search in searches:
                    search.batch(ids[i:j], owner, terms[a:b], impact)
                i = j
        for search in searches:
            for number, (s, ids) in zip(search.tree.numbers, search.best):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), number, np.int64)), pa.array(ids), pa.array(s)],
                                                 names=["item", "doc", "score"])
    return run


def ranked(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per item: item_col, rank (from 1), id_col and score of its ``k`` best documents with a score above 0.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased.  N documents have a term, L terms
    stand in them, n in one document; df documents hold a term, tf times in the document.  With
    w = floor(1000 * ln((2N + 2) / (2df + 1))) and m = 50 + (50 * n * N) div L, a document's score is the sum of
    w * ((10^9 * tf) div (1000 * tf + 20 * m)) over the item's distinct terms.  Equal scores: smaller id first.

    Method: one pass over the texts writes each document's counts of the terms that occur in any item (a bit filter of fixed size
    says which; a false hit costs a row, no error).  Items go in slabs of SLAB, a stated query set against all rows.
    A task builds a tree over a slab's items and one over each batch of documents; nodes hold the greatest weight
    and the greatest impact of every term below them.  The product of two nodes bounds every score of their pairs: where it stays below the
    weakest k-th best score of the node's items, all the pairs are skipped, level by level; the others are scored in integers.  A first run scores
    only the best leaf of each batch, over at most about SEEDS documents chosen by hash; its k-th best scores are lower bounds for the
    second run, which covers every document.  The result is exact.

    Null or termless texts have no term and are not counted; rows with a null document id count in the statistics but are not
    returned.  Repeated document rows are documents of their own; equal item rows count once, items that share an id are ranked each on its
    own, a null item id is kept.  Other columns are ignored; an empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).cast("long").alias("id"), F.col(item_text_col).alias("text")).dropDuplicates()
    queries, query_path = store(asked.mapInArrow(_vectors(None), "id long, n long, terms array<long>, tf array<int>")
                                .where("n > 0").select("id", "terms", F.monotonically_increasing_id().alias("at")), "items")
    wanted = queries.select(F.explode("terms").alias("term")).distinct()
    vectors, path = store(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _vectors(_filter_bits(wanted)), "id long, n long, terms array<long>, tf array<int>").where("n > 0"), "vectors", 1000)
    total, length = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
    df = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(total) + 2) / (2 * F.col("df") + 1))).cast("long")
    weighed = queries.select("at", "id", F.explode("terms").alias("term")).join(df, "term").select("at", "id", F.struct(
        "term", weight.alias("w")).alias("tw")).where("tw.w > 0").groupBy("at", "id").agg(F.sort_array(F.collect_list("tw")).alias("tw"))
    numbered, _ = store(with_global_position(weighed, ["at"], "item").withColumn("slab", F.floor(F.col("item") / SLAB)), "numbered")
    unstore(spark, query_path)
    named = vectors.where("id IS NOT NULL AND size(terms) > 0").select("id", "n", "terms", "tf")
    found = None
    for slab in [r[0] for r in numbered.select("slab").distinct().orderBy("slab").collect()]:
        block = [(r["item"], [x["term"] for x in r["tw"]], [x["w"] for x in r["tw"]])
                 for r in numbered.where(F.col("slab") == slab).orderBy("item").collect()]
        floors: dict[int, int] = {}
        best = Window.partitionBy("item").orderBy(F.desc("score"), "doc")
        for seed in (True, False):
            some = named.where(F.pmod(F.xxhash64("id"), F.lit(max(1, total // SEEDS))) == 0) if seed else named
            hits = some.mapInArrow(_searched(block, k, floors, seed, total, length), "item long, doc long, score long")
            top, top_path = store(hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "ranked", BATCH)
            if seed:
                floors = {r["item"]: r["score"] for r in top.where(F.col("rank") == k).collect()}
                unstore(spark, top_path)
        found = top if found is None else found.unionAll(top)
    unstore(spark, path)
    if found is None:
        found = spark.createDataFrame([], "item long, doc long, score long, rank int")
    return found.join(numbered.select("item", F.col("id").alias("item_id")), "item").select(
        F.col("item_id").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("doc").alias(id_col), "score")
