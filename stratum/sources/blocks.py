"""Files of any size, read by split: a digest that merges over blocks, and contents in parts.

A ``binaryFile`` row holds a whole file, at most 2 GB of it.  Here a file is read as raw lines, whose bytes
Spark's text source hands out unchanged, so many tasks share it and none holds it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# tasks carry this module's functions themselves, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PART_BYTES = 4 << 20
_MOD = 2**64
_rng = np.random.Generator(np.random.PCG64(5))
_CODES = _rng.integers(1, 2**64, (2, 256), dtype=np.uint64)
_CODES[:, 10] = 0            # a line end is a gap: the places of the bytes after it and the file's size tell of it
_BASES = tuple(int(x) | 3 for x in _rng.integers(0, 2**64, 2, dtype=np.uint64))


def raw_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, block, line) of files' lines as bytes, in order inside a block; ``path`` is a URI, ``block`` where the split starts."""
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array]]:
    """The neighbouring lines of one block within a batch."""
    path, block = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    first = 0
    for k in range(1, batch.num_rows + 1):
        if k == batch.num_rows or (path[k], block[k]) != (path[first], block[first]):
            yield path[first], block[first], batch.column(2).slice(first, k - first)
            first = k


def _bytes_of(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The lines' bytes in one array, and each byte's place when every line is followed by one line end."""
    n = np.array([0 if x is None else x for x in pa.compute.binary_length(lines).to_pylist()], dtype=np.int64)
    raw = np.frombuffer(b"".join(x for x in lines.to_pylist() if x), dtype=np.uint8)
    return raw, np.arange(len(raw)) + np.repeat(np.arange(len(n)), n)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _digests(batches):
    """Per block: its bytes, line ends included, and two sums of code * base^place."""
    held: dict = {}
    for batch in batches:
        for path, block, lines in _runs(batch):
            if (path, block) not in held:
                if held:
                    yield _digest_rows(held)
                held = {(path, block): [0, 0, 0]}
            state = held[path, block]
            raw, place = _bytes_of(lines)
            for k, base in enumerate(_BASES):
                part = int((_CODES[k][raw] * _powers(base, int(place[-1]) + 1 if len(place) else 1)[place]).sum(dtype=np.uint64)) if len(raw) else 0
                state[k + 1] = (state[k + 1] + part * pow(base, state[0], _MOD)) % _MOD
            state[0] += len(raw) + len(lines)
    if held:
        yield _digest_rows(held)


def _digest_rows(held: dict) -> pa.RecordBatch:
    rows = [(p, b, n, h1.to_bytes(8, "big") + h2.to_bytes(8, "big")) for (p, b), (n, h1, h2) in held.items()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.binary()))],
                                      names=["path", "block", "bytes", "sums"])


def merge(blocks: list[tuple[int, bytes]]) -> bytes:
    """The sums of blocks (bytes, sums) that follow one another."""
    at, out = 0, [0, 0]
    for n, sums in blocks:
        for k, base in enumerate(_BASES):
            out[k] = (out[k] + int.from_bytes(sums[8 * k:8 * k + 8], "big") * pow(base, at, _MOD)) % _MOD
        at += n
    return b"".join(x.to_bytes(8, "big") for x in out)


def _combine(table: pa.Table) -> pa.Table:
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("block", "bytes", "sums"))))
    return pa.table({"path": [table.column("path")[0].as_py()], "sums": [merge([r[1:] for r in rows]).hex()]})


def file_digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, sums): 32 hex digits for each file, the same however it is split into blocks.

    Each task sums its blocks; a file's blocks, one row for each split, are merged in order of their places.  Together with the file's size
    the digest tells any two contents apart but for a chance of about one in 2^64 (it is no protection against
    crafted files).  A line is held whole, so a file without line ends is one line.  A byte order mark at the start counts by its size only.
    """
    blocks = raw_lines(spark, paths).mapInArrow(_digests, "path string, block long, bytes long, sums binary")
    return blocks.groupBy("path").applyInArrow(_combine, "path string, sums string")


def _parts(batches):
    """Lines put together into parts of about PART_BYTES that end at line ends; ``part`` grows along the file."""
    key, held, size, k = None, [], 0, 0

    def given():
        return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1] + k], pa.int64()), pa.array([b"".join(held)], pa.binary())],
                                          names=["path", "part", "content"])

    for batch in batches:
        for path, block, lines in _runs(batch):
            if (path, block) != key:
                if held:
                    yield given()
                key, held, size, k = (path, block), [], 0, 0
            for line in lines.to_pylist():
                held.append((line or b"") + b"\n")
                size += len(held[-1])
                if size >= PART_BYTES:
                    yield given()
                    held, size, k = [], 0, k + 1
    if held:
        yield given()


def file_parts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, part, content) of files' contents in parts that end at line ends; in order of ``part`` they give the file.

    The last line has a line end even if the file's has none, and a byte order mark at the start is gone.
    """
    return raw_lines(spark, paths).mapInArrow(_parts, "path string, part long, content binary")
