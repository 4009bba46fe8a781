"""Substring dedup by content-defined chunking with a gear rolling hash."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import minhash
from . import wordhash as wh
from .store import store, unstore

RADIUS = 24       # a cut is a byte whose gear hash is the largest within this distance
WINDOW = 32       # bytes that a 32-bit gear hash remembers
LONGEST = 256     # longer chunks (periodic text has no largest hash) are split evenly from their start
RUN = 2           # neighbouring chunks of a window at most
CONTEXT = 512     # bytes beside a run of equal stretches that are compared directly
BEFORE, AFTER = 2 * RADIUS + WINDOW, 2 * RADIUS + 1    # bytes on both sides of a cut that decide it, ties included
_GEAR = np.random.Generator(np.random.PCG64(5)).integers(0, 2**32, 256, dtype=np.uint32)


def gear(buf: np.ndarray) -> np.ndarray:
    """h[i] = sum of GEAR[buf[i-k]] << k over the last 32 bytes, by doubling."""
    h = _GEAR[buf]
    for s in (1, 2, 4, 8, 16):
        more = h[:-s] << np.uint32(s)
        h = h.copy()
        h[s:] += more
    return h


def cuts(buf: np.ndarray) -> np.ndarray:
    """Ends of the content-defined chunks inside ``buf``: they depend on nearby bytes alone."""
    n, reach = len(buf), 2 * RADIUS + 1
    if n < WINDOW + reach:
        return np.zeros(0, np.int64)
    h = gear(buf)[WINDOW - 1:]
    top, width = h, 1
    while 2 * width <= reach:
        top = np.maximum(top[:-width], top[width:])
        width *= 2
    rest = reach - width
    if rest:
        top = np.maximum(top[:-rest], top[rest:])
    mid = h[RADIUS:len(h) - RADIUS]
    at = np.flatnonzero(mid == top)
    if len(at) > 1:      # equal hashes within reach of each other: none of them cuts
        near = np.flatnonzero(np.diff(at) <= RADIUS)
        at = np.delete(at, np.union1d(near, near + 1))
    return at + (WINDOW - 1 + RADIUS + 1)


def bounds(buf: np.ndarray) -> np.ndarray:
    """All chunk bounds of one text, 0 and its length included."""
    if not len(buf):
        return np.zeros(1, np.int64)
    at = np.concatenate([[0], cuts(buf), [len(buf)]])
    wide = np.flatnonzero(np.diff(at) > LONGEST)
    if len(wide):
        at = np.unique(np.concatenate([at, *(np.arange(at[i], at[i + 1], LONGEST) for i in wide)]))
    return at


def digests(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit digests of the chunks between consecutive bounds, by prefix sums over blocks of chunks."""
    out, i = [], 0
    while i < len(at) - 1:
        j = max(i + 1, int(np.searchsorted(at, at[i] + wh.BLOCK, "right")) - 1)
        part, cut = buf[at[i]:at[j]], at[i:j + 1] - at[i]
        total = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(wh._CODES[part] * wh._pow(wh._ROOT, len(part))[:len(part)], out=total[1:])
        h = (total[cut[1:]] - total[cut[:-1]]) * wh._pow(wh._INVERSE, len(part))[cut[:-1]]
        out.append(wh.mix(h + np.diff(cut).astype(np.uint64)))
        i = j
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def least_stretches(text: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the shortest stretches of ``min_words`` words: from a word's last byte to the first byte of the
    word ``min_words`` - 1 further on.  Every stretch of so many words, whole or cut at its ends, contains one."""
    word = wh.IS_WORD[text]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    n = max(0, len(starts) - min_words + 1)
    return ends[:n] - 1, starts[min_words - 1:] + 1


class Windows:
    """The whole chunks inside each of a text's shortest stretches, as windows of neighbouring chunks.

    A chunk counts as inside when the stretch also holds the bytes that decide its two cuts.  Stretches with equal bytes have the
    same windows, wherever they stand.  A window of more than RUN chunks is looked at through its parts of RUN chunks.
    """

    def __init__(self, text: np.ndarray, min_words: int):
        self.text, self.at = text, cuts(text)
        self.s, self.e = least_stretches(text, min_words)
        low, high = self.at[:-1], self.at[1:]
        self.low = low
        # chunks of periodic text are not told apart
        self.wide = np.concatenate([[0], np.cumsum(high - low > LONGEST)]).astype(np.int64)
        self.a = np.searchsorted(low - BEFORE, self.s)
        self.n = np.maximum(0, np.searchsorted(high + AFTER, self.e, side="right") - self.a)

    def _known(self, first: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self.wide[first + n] == self.wide[first]

    def wanted(self) -> tuple[np.ndarray, np.ndarray]:
        """(first chunk, chunks) of the windows that decide about any stretch."""
        few = (self.n > 0) & (self.n < RUN)
        short = np.unique(self.a[few] * RUN + self.n[few])
        many = self.n >= RUN
        used = np.zeros(len(self.low) + 1, dtype=np.int64)
        np.add.at(used, self.a[many], 1)
        np.add.at(used, self.a[many] + self.n[many] - RUN + 1, -1)
        runs = np.flatnonzero(np.cumsum(used)[:-1])
        first, n = np.concatenate([short // RUN, runs]), np.concatenate([short % RUN, np.full(len(runs), RUN)])
        keep = self._known(first, n)
        return first[keep], n[keep]

    def digests(self, first: np.ndarray, n: np.ndarray) -> np.ndarray:
        d = digests(self.text, self.at)
        out = n.astype(np.uint64) * np.uint64(wh._odd(900))
        for k in range(RUN):
            inside = n > k
            out[inside] += d[first[inside] + k] * np.uint64(wh._odd(901 + k))
        return wh.mix(out)

    def codes(self, first: np.ndarray, n: np.ndarray) -> np.ndarray:
        """A number for each window of this text: where it starts, and how many chunks it has."""
        return self.low[first] * (RUN + 1) + n

    def may_repeat(self, repeated: np.ndarray) -> np.ndarray:
        """False for stretches that hold a window, among ``wanted``, whose code is not in ``repeated``; True for those without a chunk."""
        out = np.ones(len(self.s), dtype=bool)
        few = np.flatnonzero((self.n > 0) & (self.n < RUN))
        a, n = self.a[few], self.n[few]
        out[few] = ~self._known(a, n) | np.isin(self.codes(a, n), repeated)
        many = np.flatnonzero(self.n >= RUN)
        if len(many):
            first = np.arange(len(self.low) - RUN + 1)
            full = np.full(len(first), RUN)
            alone = self._known(first, full) & ~np.isin(self.codes(first, full), repeated)
            upto = np.concatenate([[0], np.cumsum(alone)])
            a = self.a[many]
            out[many] = upto[a + self.n[many] - RUN + 1] == upto[a]
        return out


def _windows(min_words: int):
    """(digest, id, code) of the windows of chunks that decide which stretches may repeat."""
    def run(batches):
        for batch in batches:
            buf, rows = wh.text_bytes(batch.column(1))
            for i, j in wh.row_groups(rows, 4 * wh.BLOCK):
                digest, code, n = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], []
                for r in range(i, j):
                    w = Windows(buf[rows[r]:rows[r + 1]], min_words)
                    wanted = w.wanted()
                    digest.append(w.digests(*wanted))
                    code.append(w.codes(*wanted))
                    n.append(len(wanted[0]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(digest).view(np.int64)), batch.column(0).take(pa.array(i + np.repeat(np.arange(j - i), n))),
                     pa.array(np.concatenate(code).astype(np.int64))], names=["digest", "id", "code"])
    return run


def stretch_digests(buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit digests of the stretches [s, e), both ascending, by prefix sums over blocks of them."""
    out, i = [np.zeros(0, np.uint64)], 0
    while i < len(s):
        j = max(i + 1, int(np.searchsorted(e, s[i] + wh.BLOCK, "right")))
        part, a, b = buf[s[i]:e[j - 1]], s[i:j] - s[i], e[i:j] - s[i]
        total = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(wh._CODES[part] * wh._pow(wh._ROOT, len(part))[:len(part)], out=total[1:])
        out.append(wh.mix((total[b] - total[a]) * wh._pow(wh._INVERSE, len(part))[a] + (b - a).astype(np.uint64)))
        i = j
    return np.concatenate(out)


def _rows_in(held, column: int, inside: bool):
    """The rows whose id a bit filter may hold, or, with ``inside`` false, the others; a null id is not held."""
    def run(batches):
        for batch in batches:
            ids = batch.column(column).cast(pa.int64())
            bit = minhash._id_bit(ids.fill_null(0).to_numpy())
            hit = ((held.value[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1) & ids.is_valid().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(hit == inside))
    return run


def _stretches(min_words: int, held=None):
    """(digest, id, s, n, prev) of the shortest stretches [s, s + n) that may repeat; prev: the same one's last place in the
    text, or -1.  With ``held``, of the rows alone that this filter does not hold."""
    def run(batches):
        for batch in _rows_in(held, 0, False)(batches) if held else batches:
            buf, rows = wh.text_bytes(batch.column(1))
            repeated = batch.column(2)
            for r in range(batch.num_rows):
                w = Windows(buf[rows[r]:rows[r + 1]], min_words)
                if not len(w.s):
                    continue
                here = repeated[r].values
                keep = w.may_repeat(here.to_numpy(zero_copy_only=False) if here is not None else np.zeros(0, np.int64))
                text, s, e = w.text, w.s[keep], w.e[keep]
                d = stretch_digests(text, s, e)
                order = np.argsort(d, kind="stable")
                same = d[order][1:] == d[order][:-1]
                prev = np.full(len(s), -1, np.int64)
                prev[order[1:][same]] = s[order[:-1][same]]
                if len(s):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(d.view(np.int64)), batch.column(0).take(pa.array(np.full(len(s), r))), pa.array(s.astype(np.int64)),
                         pa.array((e - s).astype(np.int64)), pa.array(prev)], names=["digest", "id", "s", "n", "prev"])
    return run


def _slices(batches):
    """For each wanted (s, e) of a text: the bytes beside it and what its words are."""
    for batch in batches:
        buf, rows = wh.text_bytes(batch.column(1))
        ids, wanted = batch.column(0).to_pylist(), batch.column(2)
        out = []
        for r, (doc, spans) in enumerate(zip(ids, wanted.to_pylist())):
            text = buf[rows[r]:rows[r + 1]]
            word = wh.IS_WORD[text]
            start = word.copy()
            start[1:] &= ~word[:-1]
            count = np.concatenate([[0], np.cumsum(start)])
            for x in spans:
                s, e = x["s"], x["e"]
                if e <= len(text):
                    out.append((doc, s, e, text[max(0, s - CONTEXT):s].tobytes(), text[e - 1:e + CONTEXT].tobytes(),
                                int(count[e] - count[s]), bool(word[s] and not start[s])))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(),
                                                            pa.int64(), pa.bool_()))],
                names=["id", "s", "e", "left", "right", "words", "broken"])


def _grow(min_words: int):
    def common(a: bytes, b: bytes, back: bool) -> int:
        n = min(len(a), len(b))
        if back:
            a, b = a[::-1], b[::-1]
        differ = np.flatnonzero(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)) if n else ()
        return int(differ[0]) if len(differ) else n

    def run(batches):
        for batch in batches:
            x = batch.to_pydict()
            out = []
            for k in range(batch.num_rows):
                left = common(x["left"][k], x["fleft"][k], True)
                right = common(x["right"][k][1:], x["fright"][k][1:], False)
                words = x["words"][k]
                if left:
                    w = wh.IS_WORD[np.frombuffer(x["left"][k][-left:], np.uint8)]
                    words += int(w[0]) + int((w[1:] & ~w[:-1]).sum())
                else:
                    words += x["broken"][k]
                w = wh.IS_WORD[np.frombuffer(x["right"][k][:right + 1], np.uint8)]
                words += int((w[1:] & ~w[:-1]).sum())
                if words >= min_words:
                    out.append((x["id"][k], x["s"][k] - left, x["e"][k] + right, words, x["fid"][k], x["fs"][k] - left))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)],
                                                 names=["id", "start", "end", "n_words", "first_id", "first_start"])
    return run


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50) -> DataFrame:
    """(id_col, start, end, n_words, first_doc_id, first_start) of every stretch that repeats an earlier one.

    Offsets are UTF-8 bytes.  A row says that bytes [start, end) of the document, holding at least ``min_words``
    words, are equal to those from ``first_start`` in ``first_doc_id``: a smaller id, or an earlier place in the
    same text.  The earliest copy of a passage is never reported as a repeat, so removing all spans keeps one.

    Method: each text is cut where the gear hash of the last 32 bytes is the largest within 24 bytes to either side; such cuts
    depend on nearby bytes alone and move with insertions.  Neighbouring chunks form windows of up to RUN, which are
    deduplicated by digest: windows that occur twice or more mark what may repeat.  Every stretch of ``min_words`` words contains a
    shortest one, from the last byte of its first word to the first byte of its last word, and that repeats only if all windows of
    whole chunks in it do.  The stretches inside repeated windows (and those that hold no whole chunk) are then confirmed by a digest of
    their own, so that the first holder is one of the whole stretch and pieces of earlier texts cannot hide it.  They are joined to their first holder, or
    in a text that has them before to their last place there; neighbours at one distance form runs, and each run is grown by comparing the
    bytes on both sides.

    Null and empty texts have no stretches; null ids are left out; rows that repeat an id and its text count as one; of
    different texts under one id, spans beyond a text's end are ignored.  Other columns are ignored.
    """
    if min_words < 2:
        raise ValueError("min_words must be 2 or more")
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL")
    windows = source.mapInArrow(_windows(min_words), "digest long, id long, code long")
    often = windows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    repeated, repeated_path = store(windows.join(often, "digest").groupBy("id").agg(F.collect_list("code").alias("repeated")), "windows")
    # texts without a repeated window stay where they are; the others meet their windows
    spark, both = docs.sparkSession, "id long, text string"
    marked = spark.sparkContext.broadcast(minhash._filter_of(repeated.select("id")))
    schema = "digest long, id long, s long, n long, prev long"
    alone = source.withColumn("repeated", F.lit(None).cast("array<bigint>")).mapInArrow(_stretches(min_words, marked), schema)
    shared = source.mapInArrow(_rows_in(marked, 0, True), both).join(repeated, "id", "left").select("id", "text", "repeated")
    found, found_path = store(alone.unionAll(shared.mapInArrow(_stretches(min_words), schema)), "stretches", 1000)
    unstore(spark, repeated_path)
    fresh = found.where("prev < 0").drop("prev")
    # the first holder of all 50 words, not of a part of them that some earlier text has alone
    firsts = fresh.groupBy("digest").agg(F.min("id").alias("fid"), F.min_by("s", "id").alias("fs"))
    again = fresh.join(firsts, "digest").where("id <> fid OR s > fs").select(
        "id", "s", (F.col("s") + F.col("n")).alias("e"), "fid", (F.col("s") - F.col("fs")).alias("far")).unionAll(
        found.where("prev >= 0").select("id", "s", (F.col("s") + F.col("n")).alias("e"), F.col("id").alias("fid"),
                                        (F.col("s") - F.col("prev")).alias("far")))
    # runs: overlapping stretches at one distance; the rows of one document's text only
    runs, run_path = store(_runs(again), "runs")
    unstore(docs.sparkSession, found_path)
    wanted = runs.select("id", "s", "e").unionAll(
        runs.select(F.col("fid").alias("id"), (F.col("s") - F.col("far")).alias("s"), (F.col("e") - F.col("far")).alias("e"))
    ).distinct().groupBy("id").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    wanted, wanted_path = store(wanted, "wanted")
    held = spark.sparkContext.broadcast(minhash._filter_of(wanted.select("id")))
    slices, slice_path = store(source.mapInArrow(_rows_in(held, 0, True), both).join(wanted, "id").select("id", "text", "spans").mapInArrow(
        _slices, "id long, s long, e long, left binary, right binary, words long, broken boolean"), "slices", 1000)
    there = slices.select(F.col("id").alias("fid"), F.col("s").alias("fs"), F.col("e").alias("fe"),
                          F.col("left").alias("fleft"), F.col("right").alias("fright"))
    pairs = runs.withColumn("fs", F.col("s") - F.col("far")).withColumn("fe", F.col("e") - F.col("far")) \
        .join(slices, ["id", "s", "e"]).join(there, ["fid", "fs", "fe"])
    grown, _ = store(pairs.mapInArrow(
        _grow(min_words), "id long, start long, end long, n_words long, first_id long, first_start long").distinct(), "spans", 2000)
    for path in (run_path, wanted_path, slice_path):
        unstore(docs.sparkSession, path)
    return grown.select(F.col("id").alias(id_col), "start", "end", "n_words", F.col("first_id").alias("first_doc_id"),
                        "first_start")


def _runs(again: DataFrame) -> DataFrame:
    """Join stretches that overlap at one distance from one earlier text into runs (id, fid, far, s, e).

    A stretch starts a run when the one before it ends earlier; equal ones change nothing.  The window's key
    holds the distance, so its groups are stretches of one text pair.
    """
    from pyspark.sql import Window

    w = Window.partitionBy("id", "fid", "far").orderBy("s", "e")
    new = again.withColumn("new", (F.coalesce(F.lag("e").over(w), F.lit(-1)) < F.col("s")).cast("long"))
    return new.withColumn("run", F.sum("new").over(w)).groupBy("id", "fid", "far", "run").agg(
        F.min("s").alias("s"), F.max("e").alias("e")).drop("run")


def remove_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the spans of ``repeated_spans`` cut out of the texts, as many columns and rows as before.

    A cut that falls inside a character keeps the character.  Documents without spans pass unchanged (null texts
    stay null).
    """
    from pyspark.sql.types import StructField, StructType

    from .store import free_name

    col = free_name(docs, "spans_to_cut")
    by_doc, _ = store(spans.groupBy(F.col(id_col).cast("long").alias(col + "id")).agg(F.collect_list(F.struct("start", "end")).alias(col)), "cuts")
    held = docs.sparkSession.sparkContext.broadcast(minhash._filter_of(by_doc.select(col + "id")))
    key = [c.lower() for c in docs.columns].index(id_col.lower())
    # rows that no span names are not moved
    kept, touched = (docs.mapInArrow(_rows_in(held, key, inside), docs.schema) for inside in (False, True))
    wide = touched.join(by_doc, F.col(id_col).cast("long") == F.col(col + "id"), "left").drop(col + "id")
    at = [c.lower() for c in docs.columns].index(text_col.lower())
    name = docs.columns[at]

    def run(batches):
        for batch in batches:
            texts, cut = batch.column(at).to_pylist(), batch.column(batch.num_columns - 1)
            for r in np.flatnonzero(cut.is_valid().to_numpy(zero_copy_only=False)):
                if texts[r] is not None:
                    texts[r] = without(texts[r].encode(), [(x["start"], x["end"]) for x in cut[int(r)].as_py()])
            arrays = [pa.array(texts, pa.string()) if k == at else batch.column(k) for k in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names[:-1])

    schema = StructType([StructField(f.name, f.dataType, True) for f in docs.schema.fields])
    assert wide.columns[at] == name
    return kept.unionAll(wide.mapInArrow(run, schema))


def without(raw: bytes, spans: list[tuple[int, int]]) -> str:
    """Text of ``raw`` less the spans, whose ends move inwards to whole characters."""
    out, at = [], 0
    for s, e in sorted(spans):
        e = min(e, len(raw))
        while s < e and raw[s] & 0xC0 == 0x80:
            s += 1
        while e > s and e < len(raw) and raw[e] & 0xC0 == 0x80:
            e -= 1
        if e > max(s, at):
            out.append(raw[at:max(s, at)])
            at = e
    return b"".join([*out, raw[at:]]).decode()
