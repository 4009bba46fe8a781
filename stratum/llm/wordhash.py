"""64-bit hashes of the words of Arrow text columns, by whole-array arithmetic.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D.  All separators
are ASCII, so working on UTF-8 bytes gives the same words as working on code
points.  A word's hash is a polynomial over random 64-bit byte codes, taken
from prefix sums, so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 18
_SEED = 20240611
_rng = np.random.Generator(np.random.PCG64(_SEED))
_CODES = _rng.integers(1, 2**64, 256, dtype=np.uint64)
_ROOT = 0x9E3779B97F4A7C15 | 3
_INVERSE = pow(_ROOT, -1, 2**64)

IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class _Cache(dict):
    """Filled where it is used; travels empty."""

    def __reduce__(self):
        return _Cache, ()


_powers = _Cache()


def _pow(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(n, base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= 2 * BLOCK:
            _powers[base] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """A fixed 64-bit finaliser (bijective)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its row offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, dtype=kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def _pieces(buf: np.ndarray, rows: np.ndarray, is_word: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut ``buf`` into pieces of about BLOCK bytes, at row starts or separators."""
    n, at = len(buf), 0
    while at < n:
        end = min(n, at + BLOCK)
        if end < n:
            k = int(np.searchsorted(rows, end, side="right")) - 1
            if rows[k] > at:
                end = int(rows[k])
            else:
                while end < n:
                    ahead = is_word[buf[end:end + 65536]]
                    if not ahead.all():
                        end += int(ahead.argmin())
                        break
                    end += len(ahead)
                end = min(end, int(rows[k + 1]))
        yield at, end
        at = end


def hash_words(buf: np.ndarray, rows: np.ndarray, lower: bool = True, is_word: np.ndarray = IS_WORD):
    """(starts, ends, hashes) of all words; ``rows`` are the rows' offsets in ``buf``, ``is_word`` says which bytes make words."""
    out = []
    for a, b in _pieces(buf, rows, is_word):
        part = buf[a:b]
        if lower:
            part = LOWER[part]
        word = is_word[part]
        first = word.copy()
        first[1:] &= ~word[:-1]
        last = word.copy()
        last[:-1] &= ~word[1:]
        inside = rows[np.searchsorted(rows, a, side="left"):np.searchsorted(rows, b, side="left")] - a
        first[inside] = word[inside]
        last[inside[inside > 0] - 1] = word[inside[inside > 0] - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        total = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_CODES[part] * _pow(_ROOT, len(part))[:len(part)], out=total[1:])
        h = (total[ends] - total[starts]) * _pow(_INVERSE, len(part))[starts]
        out.append((starts + a, ends + a, mix(h)))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


def row_groups(offsets: np.ndarray, limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Consecutive rows [i, j) of about ``limit`` bytes together, one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


def grams(h: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """Hashes of all ``width``-word windows of one word sequence."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        out += h[k:k + n] * np.uint64(_odd(seed * 64 + k))
    return mix(out)


def _odd(k: int) -> int:
    z = (k + 1) * 0x9E3779B97F4A7C15 % 2**64
    z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 % 2**64
    z = (z ^ z >> 27) * 0x94D049BB133111EB % 2**64
    return (z ^ z >> 31) | 1


def shingle_set(h: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct ``width``-word shingles; shorter texts give their whole sequence as one."""
    if not len(h):
        return np.zeros(0, np.uint64)
    return np.unique(grams(h, width) if len(h) >= width else grams(h, len(h), seed=2 + len(h)))
