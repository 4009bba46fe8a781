"""Masked pseudo-likelihood scores from a bidirectional window network."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash as wh
from .store import store, unstore

SIDE = 48                       # classes, and words within each class: SIDE * SIDE predicted symbols
SYMBOLS = SIDE * SIDE
KNOWN = SYMBOLS - 256           # the most frequent words have a symbol of their own, others share 256 by hash
DIM, WINDOW = 16, 2             # hidden size; words seen on each side
RATE, STEP = 0.1, 16384         # Adagrad rate; tokens of one update
SHARD = 1 << 22                 # tokens that train one copy of the model, about
PIECE, FAN_IN = 1 << 14, 64     # floats in a row of a model; models that one group sums
_SHAPES = {"emb": (2 * WINDOW, SYMBOLS + 1, DIM), "hid": (DIM,), "wc": (DIM, SIDE), "bc": (SIDE,),
           "ww": (SIDE, DIM, SIDE), "bw": (SIDE, SIDE)}


def unflatten(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in _SHAPES.items():
        n = int(np.prod(shape))
        out[name] = flat[at:at + n].reshape(shape)
        at += n
    return out


SIZE = sum(int(np.prod(s)) for s in _SHAPES.values())


class Vocabulary:
    """Symbols of word hashes: the known words by rank of hash, the rest by hash."""

    def __init__(self, known: np.ndarray):
        self.known = np.sort(known)
        self.seed = 1
        while True:       # a table without collisions among the known words: one lookup per token
            slot = (self.known * np.uint64(wh._odd(self.seed))) >> np.uint64(42)
            if len(np.unique(slot)) == len(slot):
                break
            self.seed += 1
        self.table = np.zeros(1 << 22, dtype=np.int16)
        self.table[slot] = np.arange(len(slot))

    def symbols(self, h: np.ndarray) -> np.ndarray:
        other = (KNOWN + (h % np.uint64(SYMBOLS - KNOWN)).astype(np.int64)).astype(np.int32)
        if not len(self.known):
            return other
        at = self.table[(h * np.uint64(wh._odd(self.seed))) >> np.uint64(42)]
        return np.where(self.known[at] == h, at.astype(np.int32), other)


def initial(vocabulary: Vocabulary, counts: np.ndarray, rest: int) -> np.ndarray:
    """Start of training: small random embeddings, and output biases at the corpus's word frequencies."""
    flat = np.random.Generator(np.random.PCG64(11)).normal(0, 0.1, SIZE).astype(np.float32)
    p = unflatten(flat)
    freq = np.full(SYMBOLS, 0.1)
    freq[:len(counts)] += counts
    freq[KNOWN:] += rest / (SYMBOLS - KNOWN)
    freq = freq.reshape(SIDE, SIDE)
    p["bc"][:] = np.log(freq.sum(1) / freq.sum())
    p["bw"][:] = np.log(freq / freq.sum(1, keepdims=True))
    p["hid"][:] = 0
    return flat


def contexts(symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """(2 * WINDOW, n) symbols on both sides of each token; SYMBOLS where the text has ended."""
    n = len(symbols)
    out = np.full((2 * WINDOW, n), SYMBOLS, dtype=np.int32)
    for k, d in enumerate(range(1, WINDOW + 1)):
        before, after = out[WINDOW - d], out[WINDOW - 1 + d]
        before[d:], after[:-d] = symbols[:-d], symbols[d:]
        for back in range(d):          # the first d words of a text have no word d before them, the last none after
            first, last = rows[:-1] + back, rows[1:] - 1 - back
            before[first[first < n]] = SYMBOLS
            after[last[last >= 0]] = SYMBOLS
    return out


def _softmax(x: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log-probability of each row's target, sums of the exponentials that replace ``x``)."""
    at = np.arange(len(x))
    picked = x[at, target]
    np.exp(x, out=x)
    total = x.sum(axis=1)
    return picked - np.log(total), total


def forward(p: dict, around: np.ndarray, target: np.ndarray, grad: dict | None = None, weight: np.ndarray | None = None) -> np.ndarray:
    """log P(target | both sides) per token; with ``grad``, adds the gradients of the mean loss, weighted by ``weight``, to it."""
    n = len(target)
    order = np.argsort(target.astype(np.int16), kind="stable")     # by class, so each class is one slice
    target, around = target[order], around[:, order]
    share = np.full(n, 1 / n, dtype=np.float32) if weight is None else (weight[order] / weight.sum()).astype(np.float32)
    z = p["emb"][0][around[0]]
    for k in range(1, 2 * WINDOW):
        z += p["emb"][k][around[k]]
    z += p["hid"]
    h = np.tanh(z, out=z)
    cls, within = target // SIDE, target % SIDE
    cut = np.searchsorted(target, np.arange(SIDE + 1) * SIDE)
    x = h @ p["wc"]
    x += p["bc"]
    logs, total = _softmax(x, cls)
    dh = None
    if grad is not None:
        x *= (share / total)[:, None]
        x[np.arange(n), cls] -= share
        grad["wc"] += h.T @ x
        grad["bc"] += x.sum(0)
        dh = x @ p["wc"].T
    for c in range(SIDE):
        a, b = cut[c], cut[c + 1]
        if a == b:
            continue
        hs = h[a:b]
        x = hs @ p["ww"][c]
        x += p["bw"][c]
        more, total = _softmax(x, within[a:b])
        logs[a:b] += more
        if grad is not None:
            x *= (share[a:b] / total)[:, None]
            x[np.arange(b - a), within[a:b]] -= share[a:b]
            grad["ww"][c] += hs.T @ x
            grad["bw"][c] += x.sum(0)
            dh[a:b] += x @ p["ww"][c].T
    if grad is not None:
        dh *= 1 - h * h
        grad["hid"] += dh.sum(0)
        for k in range(2 * WINDOW):
            by = np.argsort(around[k].astype(np.int16), kind="stable")
            ids = around[k][by]
            first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            grad["emb"][k][ids[first]] += np.add.reduceat(dh[by], first, axis=0)
    out = np.empty(n, dtype=logs.dtype)
    out[order] = logs
    return out


def _texts(batches, vocabulary):
    """Blocks of texts as (ids, symbols, word hashes, row offsets in symbols)."""
    for batch in batches:
        buf, at = wh.text_bytes(batch.column(1))
        for i, j in wh.row_groups(at):
            base = at[i:j + 1] - at[i]
            starts, _, h = wh.hash_words(buf[at[i]:at[j]], base)
            yield batch.column(0).slice(i, j - i), vocabulary.symbols(h), h, np.searchsorted(starts, base)


def _digests(h: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each row's word sequence, (n,); rows without words have 0."""
    n = np.diff(rows)
    place = np.arange(len(h)) - np.repeat(rows[:-1], n)
    sums = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(h * wh._pow(wh._ROOT, int(n.max(initial=0)) + 1)[place], out=sums[1:])
    return np.where(n > 0, wh.mix(sums[rows[1:]] - sums[rows[:-1]] + n.astype(np.uint64)), np.uint64(0))


def _symbolised(held, shards: int):
    """(shard, digest, copies, symbols) of the texts: a task gives a text's symbols once, and its further copies as a number."""
    def run(batches):
        vocabulary, seen = Vocabulary(held.value), {}
        for _, symbols, h, rows in _texts(batches, vocabulary):
            digest, out = _digests(h, rows), []
            for r in np.flatnonzero(np.diff(rows)).tolist():
                d = int(digest[r])
                if d in seen:
                    seen[d] += 1
                else:
                    seen[d] = 0
                    out.append((d, symbols[rows[r]:rows[r + 1]].astype(np.int16).tobytes()))
            yield _shard_rows([d for d, _ in out], [1] * len(out), [x for _, x in out], shards)
        more = {d: k for d, k in seen.items() if k}
        yield _shard_rows(list(more), list(more.values()), [b""] * len(more), shards)
    return run


def _shard_rows(digests: list, copies: list, symbols: list, shards: int) -> pa.RecordBatch:
    d = np.array(digests, dtype=np.uint64)
    return pa.RecordBatch.from_arrays([pa.array((d % np.uint64(shards)).astype(np.int64)), pa.array(d.view(np.int64)), pa.array(copies, pa.int64()),
                                       pa.array(symbols, pa.binary())], names=["shard", "digest", "copies", "symbols"])


def _distinct_texts(batches):
    """(shard, symbols, copies) of every distinct text, from rows sorted by (shard, digest)."""
    key, copies, symbols = None, 0, b""
    for batch in batches:
        for shard, digest, more, part in zip(*(c.to_pylist() for c in batch.columns)):
            if (shard, digest) != key:
                if key:
                    yield key[0], np.frombuffer(symbols, np.int16).astype(np.int32), copies
                key, copies, symbols = (shard, digest), 0, b""
            copies, symbols = copies + more, symbols or part
    if key:
        yield key[0], np.frombuffer(symbols, np.int16).astype(np.int32), copies


def _blocks(texts):
    """(symbols, rows, copies of each token) for every STEP tokens or more, whole texts."""
    held, size = [], 0
    for symbols, copies in texts:
        held.append((symbols, copies))
        size += len(symbols)
        if size >= STEP:
            yield _joined(held)
            held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held):
    n = [len(s) for s, _ in held]
    return np.concatenate([s for s, _ in held]), np.concatenate([[0], np.cumsum(n)]), np.repeat([float(c) for _, c in held], n)


def train_words(flat: np.ndarray, blocks) -> tuple[np.ndarray, int]:
    """One Adagrad pass over (symbols, rows, copies) blocks; the new model and the tokens seen, copies included."""
    flat = flat.copy()
    p, seen = unflatten(flat), 0
    squares, gradient = np.full(SIZE, 1e-8, dtype=np.float32), np.zeros(SIZE, dtype=np.float32)
    grad = unflatten(gradient)
    for symbols, rows, copies in blocks:
        around = contexts(symbols, rows)
        cut = np.linspace(0, len(symbols), max(1, round(len(symbols) / STEP)) + 1).astype(int)
        for i, j in zip(cut[:-1], cut[1:]):
            gradient[:] = 0
            forward(p, around[:, i:j], symbols[i:j], grad, copies[i:j])
            squares += gradient * gradient
            flat -= RATE * gradient / np.sqrt(squares)
        seen += int(copies.sum())
    return flat, seen


def _count_words(batches):
    for batch in batches:
        buf, at = wh.text_bytes(batch.column(1))
        parts = [wh.hash_words(buf[at[i]:at[j]], at[i:j + 1] - at[i])[2] for i, j in wh.row_groups(at)]
        if parts:
            word, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])


def known_words(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, int, int]:
    """(words, their counts, least count, tokens of all words): the words at or above the least count of which KNOWN or fewer have.

    The least count comes from the histogram of counts, a row for each different count: at most the square root of twice the
    corpus's tokens.  Only the KNOWN words themselves are fetched after that.
    """
    histogram = sorted(((r.n, r.words) for r in counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).collect()), reverse=True)
    least, room = (histogram[0][0] + 1 if histogram else 1), KNOWN
    for n, words in histogram:
        if words > room:
            break
        least, room = n, room - words
    top = sorted((r.word % 2**64, r.n) for r in counts.where(F.col("n") >= least).collect())
    total = sum(n * words for n, words in histogram)
    return np.array([w for w, _ in top], dtype=np.uint64), np.array([n for _, n in top], dtype=np.int64), least, total


def fit(source: DataFrame, rounds: int = 1) -> tuple[np.ndarray, np.ndarray, DataFrame, str]:
    """(known word hashes, model, counts of the other words, their path) from every text of ``source(id, text)``.

    Word counts are one aggregate over the corpus.  Texts fall into shards of about SHARD tokens by a digest of their words, and
    inside a shard they stand in order of that digest; equal texts are one, with the number of copies as weight.  So the
    model does not hang on how the texts are stored or split into tasks.  In each round every shard trains a copy of the model;
    the copies, weighted by tokens, are averaged in groups of FAN_IN until one is left.  Only the
    known words and the final model, both of fixed size, reach the driver.
    """
    spark = source.sparkSession
    counts, count_path = store(source.mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")),
                               "words")
    known, n, least, total = known_words(counts)
    flat = initial(Vocabulary(known), n, total - int(n.sum()))
    rare = counts.where(F.col("n") < least)
    if not total:
        return known, flat, rare, count_path
    shards = -(-total // SHARD)
    words = spark.sparkContext.broadcast(known)
    texts, text_path = store(source.mapInArrow(_symbolised(words, shards), "shard long, digest long, copies long, symbols binary"), "symbols", 1000)
    dealt = texts.repartitionByRange(shards, "shard").sortWithinPartitions("shard", "digest", "copies")
    for _ in range(rounds):
        held = spark.sparkContext.broadcast(flat)

        def local(batches, held=held):
            from itertools import groupby

            for shard, rows in groupby(_distinct_texts(batches), key=lambda x: x[0]):
                model, seen = train_words(held.value, _blocks((s, c) for _, s, c in rows))
                for k in range(0, SIZE, PIECE):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([shard], pa.int64()), pa.array([k], pa.int64()), pa.array([seen], pa.int64()),
                         pa.array([(model[k:k + PIECE].astype(np.float64) * seen).tobytes()], pa.binary())],
                        names=["shard", "piece", "seen", "part"])

        def add(table: pa.Table) -> pa.Table:
            table = table.sort_by("shard")
            total = np.sum([np.frombuffer(x.as_py()) for x in table.column("part")], axis=0)
            return pa.table({"shard": [table.column("shard")[0].as_py() // FAN_IN], "piece": [table.column("piece")[0].as_py()],
                             "seen": [sum(table.column("seen").to_pylist())], "part": [total.tobytes()]}, schema=table.schema)

        schema = "shard long, piece long, seen long, part binary"
        models, path = store(dealt.mapInArrow(local, schema), "models", 256)
        width = shards
        while width > 1:
            fewer, new_path = store(models.groupBy("piece", F.floor(F.col("shard") / FAN_IN)).applyInArrow(add, schema), "models")
            unstore(spark, path)
            models, path, width = fewer, new_path, -(-width // FAN_IN)
        rows = models.collect()
        flat = np.empty(SIZE, dtype=np.float32)
        for r in rows:
            flat[r.piece:r.piece + PIECE] = np.frombuffer(r.part) / r.seen
        unstore(spark, path)
        held.destroy()
    unstore(spark, text_path)
    return known, flat, rare, count_path


def _scored(held):
    """id, tokens, network log-probability, and the unknown words with their occurrences, of every text."""
    def run(batches):
        known, flat = held.value
        vocabulary, p = Vocabulary(known), unflatten(flat)
        for ids, symbols, h, rows in _texts(batches, vocabulary):
            around = contexts(symbols, rows)
            logs = np.concatenate([np.zeros(1), *(forward(p, around[:, i:i + STEP], symbols[i:i + STEP])
                                                  for i in range(0, len(symbols), STEP))])
            sums = np.cumsum(logs)
            n = np.diff(rows)
            other = symbols >= KNOWN
            owner, word = np.repeat(np.arange(len(n)), n)[other], h[other]
            order = np.lexsort((word, owner))
            owner, word = owner[order], word[order]
            first = np.flatnonzero(np.concatenate([np.ones(min(1, len(word)), bool), (word[1:] != word[:-1]) | (owner[1:] != owner[:-1])]))
            times = np.diff(np.append(first, len(word))).astype(np.int32)
            offsets = np.searchsorted(owner[first], np.arange(len(n) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n.astype(np.int64)), pa.array(sums[rows[1:]] - sums[rows[:-1]]),
                 pa.ListArray.from_arrays(offsets, word[first].view(np.int64)), pa.ListArray.from_arrays(offsets, times)],
                names=["id", "n", "net", "words", "times"])
    return run


def pseudo_likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 1) -> DataFrame:
    """Per row of ``docs``: id_col, n_tokens, log_likelihood, mean_log_likelihood.

    Every word is predicted from the two words on either side by a network trained on all of ``docs`` (embeddings
    by position, one hidden layer, a softmax over word classes and one within the class); a document's score
    is the sum of the log-probabilities of its words.  At most KNOWN of the most frequent words have a symbol of their own.  The others share
    symbols by hash; such a word's probability is its symbol's times the word's share of the symbol's occurrences in the
    corpus, log(count(word) / count(symbol)), from the counts of all words, which are joined and never leave the executors.  So what is known
    grows with the corpus, word by word, while the network keeps its size.

    Null and empty texts have 0 tokens, sum 0 and a null mean; null ids and repeated rows are scored like any row;
    an empty table gives no rows.  Scores do not depend on how texts are split into tasks, up to rounding.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    known, flat, rare, count_path = fit(source, rounds)
    held = spark.sparkContext.broadcast((known, flat))
    scored, _ = store(source.mapInArrow(_scored(held), "id long, n long, net double, words array<long>, times array<int>")
                      .withColumn("row", F.monotonically_increasing_id()), "scored", 1000)
    symbol = F.pmod(F.col("word"), F.lit(SYMBOLS - KNOWN))
    totals = rare.groupBy(symbol.alias("symbol")).agg(F.sum("n").alias("total"))       # one row a shared symbol
    shares = rare.join(F.broadcast(totals), symbol == F.col("symbol")).select("word", F.log(F.col("n") / F.col("total")).alias("share"))
    used = scored.select("row", F.inline(F.arrays_zip(F.col("words").alias("word"), "times")))
    # shares has one row a word, so a partition's hash table is the words over the partitions; the many uses need no sort
    own, _ = store(used.join(shares.hint("shuffle_hash"), "word").groupBy("row").agg(F.sum(F.col("times") * F.col("share")).alias("own")), "shares")
    unstore(spark, count_path)
    total = F.col("net") + F.coalesce("own", F.lit(0.0))
    return scored.select("row", "id", "n", "net").join(own, "row", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_tokens"), F.when(F.col("n") > 0, total).otherwise(0.0).alias("log_likelihood"),
        F.when(F.col("n") > 0, total / F.col("n")).alias("mean_log_likelihood"))
