"""Near-duplicate groups by b-bit MinHash, confirmed on full shingle sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash as wh
from .components import components
from .store import store, unstore

BITS = 2                    # low bits kept of every minimum's mixed value
BANDS, ROWS = 40, 5         # a pair at similarity 0.8 misses all bands once in 7 million
K = BANDS * ROWS
FINE = 2048                 # minima of a candidate's packed signature
LANES = 64 // BITS          # minima per packed long
LONGS = FINE // LANES
_rng = np.random.Generator(np.random.PCG64(77))
_XOR = _rng.integers(0, 2**32, (K + FINE, 1), dtype=np.uint32)
_MUL = _rng.integers(0, 2**32, (K + FINE, 1), dtype=np.uint32) | np.uint32(1)
_ODD = _rng.integers(0, 2**64, ROWS + 1, dtype=np.uint64) | np.uint64(1)
_EVEN_BITS = 0x5555555555555555
FILTER_BITS = 25            # log2 of the bits of the filter of ids that get a signature
CELL = 1024                 # documents on either side of a cell, about
CHUNK = 256                 # rows that a cell takes at a time


def minima(shingles: np.ndarray, first: int, count: int) -> np.ndarray:
    """The minima of one shingle set under permutations first .. first + count - 1."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(count, 0xFFFFFFFF, dtype=np.uint32)
    xor, mul = _XOR[first:first + count], _MUL[first:first + count]
    step = max(64, (1 << 18) // count)
    for i in range(0, len(x), step):
        np.minimum(low, ((x[i:i + step] ^ xor) * mul).min(axis=1), out=low)
    return low


def pack(low: np.ndarray) -> np.ndarray:
    """The lowest BITS bits of each minimum's mixed value, packed into longs.

    Unmixed, they would hang on the shingles' own low bits alone: two shingles would agree under all permutations or none.
    """
    bits = (wh.mix(low.astype(np.uint64)) & np.uint64(2**BITS - 1)).reshape(len(low), LONGS, LANES)
    return np.bitwise_or.reduce(bits << (np.arange(LANES, dtype=np.uint64) * np.uint64(BITS)), axis=2)


def band_keys(low: np.ndarray) -> np.ndarray:
    parts = low.reshape(len(low), BANDS, ROWS).astype(np.uint64)
    h = np.arange(BANDS, dtype=np.uint64)[None, :] * _ODD[ROWS]
    for k in range(ROWS):
        h = h + parts[:, :, k] * _ODD[k]
    return wh.mix(h)


def _lists(x: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(x.view(np.int64).ravel()), x.shape[1]).cast(pa.list_(pa.int64()))


def _sets(batches, width: int):
    for batch in batches:
        buf, at = wh.text_bytes(batch.column(1))
        for i, j in wh.row_groups(at):
            starts, _, h = wh.hash_words(buf[at[i]:at[j]], at[i:j + 1] - at[i])
            cut = np.searchsorted(starts, at[i:j + 1] - at[i])
            yield batch.column(0).slice(i, j - i), [wh.shingle_set(h[a:b], width) for a, b in zip(cut[:-1], cut[1:])]


def _bands(width: int):
    def run(batches):
        for ids, sets in _sets(batches, width):
            n = np.array([len(s) for s in sets], dtype=np.int64)
            d1 = np.array([s.sum() for s in sets], dtype=np.uint64)
            d2 = np.array([np.bitwise_xor.reduce(wh.mix(s * _ODD[0])) for s in sets], dtype=np.uint64)
            keys = _lists(band_keys(np.stack([minima(s, 0, K) for s in sets])))
            yield pa.RecordBatch.from_arrays([ids, pa.array(n), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), keys],
                                             names=["id", "n", "d1", "d2", "bands"])
    return run


def _payload(width: int, wanted: np.ndarray):
    """rep, n, signature and shingle set of the documents whose ids ``wanted``, a bit filter, may hold."""
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            bit = _id_bit(ids)
            hit = (wanted[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
            for found, sets in _sets([batch.filter(pa.array(hit))], width):
                keep = np.array([len(s) > 0 for s in sets], dtype=bool)
                sets = [s for s in sets if len(s)]
                if sets:
                    low = pack(np.stack([minima(s, K, FINE) for s in sets]))
                    yield pa.RecordBatch.from_arrays(
                        [found.filter(pa.array(keep)), pa.array([len(s) for s in sets], pa.int64()),
                         pa.array([x.tobytes() for x in low], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                        names=["rep", "n", "sig", "shingles"])
    return run


def _id_bit(ids: np.ndarray) -> np.ndarray:
    return ((ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _filter_of(reps: DataFrame) -> np.ndarray:
    """A bit for each place that an id of ``reps(rep)`` takes; its size is fixed, however many there are."""
    def bits(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_id_bit(batch.column(0).to_numpy()) + 1)], names=["bit"])

    rows = reps.mapInArrow(bits, "bit long").select(F.bitmap_bucket_number("bit").alias("b"), F.bitmap_bit_position("bit").alias("p")) \
        .groupBy("b").agg(F.bitmap_construct_agg("p").alias("bits")).collect()
    out = np.zeros(1 << FILTER_BITS - 3, dtype=np.uint8)
    for r in rows:
        out[(r["b"] - 1) * 4096:r["b"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def estimates(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Similarity of packed signatures, one row of ``one`` against each of ``many``, by bit counts corrected for chance agreement."""
    differ = np.zeros((len(one), len(many)), dtype=np.int32)
    for k in range(LONGS):
        x = one[:, None, k] ^ many[None, :, k]
        x |= x >> np.uint64(1)
        differ += np.bitwise_count(x & np.uint64(_EVEN_BITS)).astype(np.int32)
    chance = 2.0 ** -BITS
    return (1 - differ / FINE - chance) / (1 - chance)


class _Rows:
    """Some rows of a cell: ids, labels, sizes, signatures and sets."""

    def __init__(self, rows: list[dict]):
        self.rep = np.array([r["rep"] for r in rows], dtype=np.int64)
        self.comp = np.array([r["comp"] for r in rows], dtype=np.int64)
        self.out = np.array([r["is_out"] for r in rows], dtype=bool)
        self.n = np.array([r["n"] for r in rows], dtype=np.int64)
        self.sig = np.stack([np.frombuffer(r["sig"], np.uint64) for r in rows])
        self.sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]


def _candidates(a: _Rows, b: _Rows, percent: int, open_pairs: np.ndarray) -> np.ndarray:
    """Pairs among ``open_pairs`` that sizes and signatures leave possible, the likeliest first."""
    fits = open_pairs & (100 * a.n[:, None] >= percent * b.n[None, :]) & (100 * b.n[None, :] >= percent * a.n[:, None])
    rows, cols = np.flatnonzero(fits.any(axis=1)), np.flatnonzero(fits.any(axis=0))
    if not len(rows):
        return np.zeros((0, 2), dtype=np.int64)
    close = estimates(a.sig[rows], b.sig[cols])
    agree = 2.0 ** -BITS + (1 - 2.0 ** -BITS) * percent / 100
    slack = 5 * (agree * (1 - agree) / FINE) ** 0.5 / (1 - 2.0 ** -BITS)
    i, j = np.nonzero(fits[np.ix_(rows, cols)] & (close >= percent / 100 - slack))
    order = np.argsort(-close[i, j], kind="stable")
    return np.stack([rows[i[order]], cols[j[order]]], axis=1)


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


class _StarCell:
    """A lead against the members of its buckets: every link."""

    def __init__(self, percent: int):
        self.percent, self.held, self.links = percent, [], []

    def take(self, rows: list[dict], first: bool) -> None:
        rows = _Rows(rows)
        if first:
            self.held.append(rows)       # a lead has a row for each of its texts
            return
        for lead in self.held:
            for i, j in _candidates(lead, rows, self.percent, lead.rep[:, None] != rows.rep[None, :]):
                if _linked(lead.sets[i], rows.sets[j], self.percent):
                    self.links.append((lead.rep[i], rows.rep[j]))


class _RestCell:
    """Outsiders against members of other components: links between components, none twice."""

    def __init__(self, percent: int):
        self.percent, self.held, self.links, self.parent = percent, [], [], {}

    def root(self, c: int) -> int:
        while (up := self.parent.get(c, c)) != c:
            self.parent[c] = self.parent.get(up, up)
            c = up
        return c

    def take(self, rows: list[dict], first: bool) -> None:
        rows = _Rows(rows)
        if first:
            self.held.append(rows)
            return
        for outs in self.held:
            a, b = (np.array([self.root(c) for c in x.comp.tolist()]) for x in (outs, rows))
            # two outsiders meet in both roles; one order is enough
            open_pairs = (a[:, None] != b[None, :]) & (~rows.out[None, :] | (rows.rep[None, :] > outs.rep[:, None]))
            for i, j in _candidates(outs, rows, self.percent, open_pairs):
                u, v = self.root(int(outs.comp[i])), self.root(int(rows.comp[j]))
                if u != v and _linked(outs.sets[i], rows.sets[j], self.percent):
                    self.parent[max(u, v)] = min(u, v)
                    self.links.append((outs.comp[i], rows.comp[j]))


def _run_cells(kind, percent: int):
    """Rows sorted by (cell columns, role): a cell takes its first role's rows, then the others, CHUNK at a time."""
    def run(batches):
        cell, key, held, role = None, None, [], None

        def give(c):
            u, v = (np.array(x, dtype=np.int64) for x in (zip(*c.links) if c.links else ((), ())))
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["u", "v"])

        for batch in batches:
            for row in batch.to_pylist():
                now = (row["lead"], row["i"], row["j"])
                if held and (now != key or row["role"] != role or len(held) == CHUNK):
                    cell.take(held, role == 0)
                    held = []
                if now != key:
                    if cell and cell.links:
                        yield give(cell)
                    cell, key = kind(percent), now
                role = row["role"]
                held.append(row)
        if held:
            cell.take(held, role == 0)
        if cell and cell.links:
            yield give(cell)
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    percent: int = 80) -> DataFrame:
    """Per document: id_col, n_shingles, component_id (smallest id reachable over links), kept.

    Two documents are linked when 100 * |intersection| >= percent * |union| of their distinct
    ``width``-word shingle sets (A-Z lower-cased; a shorter text is one shingle).  Method:

    1. one pass makes each document's 64-bit shingle set, BANDS band keys from K minima and a 128-bit digest of the set;
    2. equal sets form one class by digest, so copies cost one aggregate row, not pairs; the rows of one id are joined by an edge;
    3. every band bucket has a lead, the member that meets most others in all its buckets; buckets of one lead make one
       group.  Documents in groups get a signature, the BITS low bits of FINE more minima packed in longs, beside their set;
    4. each group's members meet its lead: sizes and the signatures' bit counts, corrected for chance agreement (five
       standard deviations of slack), leave the likely pairs, which are confirmed on full sets; links give components;
    5. members outside their lead's component meet all members of other components of the group, in cells of at most
       about CELL by CELL documents, so no link between documents that share a bucket is lost.  Candidates come likeliest first, and a
       cell confirms no further pair of two components that it has joined.

    What is shuffled grows with the members of groups, never with pairs; links are the only output of a cell.  A group whose m members
    are mostly unlinked still costs up to m * m / 2 signature comparisons, dealt over its cells.

    Null or wordless text has an empty set and is linked with nothing.  A null id keeps its row with a null
    component and kept = true.  Rows that repeat an id are one document: linked if any of its texts is.
    Other columns are ignored, an empty table gives no rows.
    """
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sigs, _ = store(source.mapInArrow(
        _bands(width), "id long, n long, d1 long, d2 long, bands array<long>"), "sets", 1000)
    named = sigs.where("id IS NOT NULL AND n > 0")
    classes, class_path = store(named.groupBy("d1", "d2", "n", "bands").agg(F.min("id").alias("rep")), "classes")
    exploded = classes.select("rep", F.explode("bands").alias("key"))
    crowds, crowd_path = store(
        exploded.join(exploded.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "key"), "crowds")
    # the member that meets most others over all its buckets is closest to the middle of its group; ties by a hash
    crowd = crowds.groupBy("rep").agg((F.sum("size") * 1048576 + F.pmod(F.xxhash64("rep"), F.lit(1048576))).alias("crowd"))
    leads = crowds.join(crowd, "rep").groupBy("key").agg(F.max_by("rep", "crowd").alias("lead"))
    stars, star_path = store(crowds.join(leads, "key").select("lead", "rep").distinct(), "stars")
    unstore(spark, crowd_path)
    once = named.select("id", "d1", "d2", "n").distinct()
    # ids of several rows, and how many texts they have; one pass over ids alone
    twice, twice_path = store(named.groupBy("id", "d1", "d2", "n").agg(F.count(F.lit(1)).alias("rows")).groupBy("id").agg(
        F.count(F.lit(1)).alias("texts"), F.sum("rows").alias("rows")).where("rows > 1"), "twice")
    made = source.where("id IS NOT NULL").mapInArrow(
        _payload(width, _filter_of(stars.select("rep").distinct())), "rep long, n long, sig binary, shingles binary")
    # one row for each text of an id; where no id repeats there is nothing to drop
    payload, payload_path = store(made if twice.isEmpty() else made.dropDuplicates(["rep", "sig", "shingles"]), "payload", 1000)
    cells, schema = ["lead", "i", "j"], "u long, v long"

    def dealt(df: DataFrame) -> DataFrame:
        return df.select(*cells, "role", "rep", "comp", "is_out", "n", "sig", "shingles").repartition(parts, *cells) \
            .sortWithinPartitions(*cells, "role")

    none = [F.lit(0).cast("long").alias("comp"), F.lit(False).alias("is_out")]
    sizes = stars.groupBy("lead").agg(F.ceil(F.count(F.lit(1)) / CELL).alias("blocks"))
    first = stars.where("rep <> lead").join(sizes, "lead").select(
        "lead", F.pmod(F.xxhash64("rep"), "blocks").alias("i"), "rep", F.lit(1).alias("role")).unionAll(
        sizes.select("lead", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("i"), F.col("lead").alias("rep"), F.lit(0).alias("role")))
    met = first.withColumn("j", F.lit(0)).join(payload, "rep").select("*", *none)
    links, link_path = store(dealt(met).mapInArrow(_run_cells(_StarCell, percent), schema), "links", CHUNK)
    # rows of one id with different texts belong together as well: they share the id itself
    own = once.join(twice.where("texts > 1").select("id"), "id").join(classes.select("d1", "d2", "n", "rep"), ["d1", "d2", "n"]).select(
        F.col("rep").alias("u"), F.col("id").alias("v")).where("u <> v")
    of, of_path = components(links.unionAll(own.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))))

    label = of.select(F.col("node").alias("rep"), "component")
    main = of.select(F.col("node").alias("lead"), F.col("component").alias("main"))
    inside, inside_path = store(stars.join(label, "rep", "left").join(main, "lead", "left").select(
        "lead", "rep", F.coalesce("component", "rep").alias("comp"), (F.coalesce("component", "rep") != F.coalesce("main", "lead")).alias("is_out")), "inside")
    sizes = inside.groupBy("lead").agg(F.ceil(F.count(F.lit(1)) / CELL).alias("many"), F.ceil(F.count_if("is_out") / CELL).alias("outs")).where("outs > 0")
    numbered = inside.where("rep <> lead").join(sizes, "lead").select("*", F.pmod(F.xxhash64("rep"), "outs").alias("a"), F.pmod(F.xxhash64("rep"), "many").alias("b"))
    copies = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    second = numbered.where("is_out").select("lead", F.col("a").alias("i"), copies("many").alias("j"), "rep", "comp", "is_out", F.lit(0).alias("role")).unionAll(
        numbered.select("lead", copies("outs").alias("i"), F.col("b").alias("j"), "rep", "comp", "is_out", F.lit(1).alias("role")))
    more, more_path = store(dealt(second.join(payload, "rep")).mapInArrow(_run_cells(_RestCell, percent), schema), "links", CHUNK)
    for path in (star_path, twice_path, payload_path, link_path, inside_path):
        unstore(spark, path)
    final = classes.select("d1", "d2", "n", "rep").join(label, "rep", "left").select("d1", "d2", "n", F.coalesce("component", "rep").alias("component"))
    if not more.isEmpty():
        joined, _ = components(more)
        final = final.join(joined.select(F.col("node").alias("component"), F.col("component").alias("least")), "component", "left").select(
            "d1", "d2", "n", F.coalesce("least", "component").alias("component"))
    unstore(spark, more_path)

    return sigs.select("id", "n", "d1", "d2").join(final, ["d1", "d2", "n"], "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("component_id") == F.col(id_col), F.lit(True)))
