"""Token counts by overlap resynchronisation."""

from __future__ import annotations

import json
import re
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash as wh

CHUNK, OVERLAP = 1 << 16, 1 << 10      # bytes
# A non-blank character before a space or newline always ends a piece of the split pattern, whatever stands
# further left or right: no alternative goes on past a blank, and none looks behind itself.
STABLE = re.compile(r"(?<=\S)(?=[ \n])")


def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def read_vocabulary(path: str) -> dict:
    """What tasks need of a vocabulary file: ranks of a byte-level BPE .json, else the file itself."""
    with open(path, "rb") as f:
        raw = f.read()
    if path.endswith(".model"):
        return {"kind": "sentencepiece", "raw": raw, "name": path}
    spec = json.loads(raw)
    pre, added = spec.get("pre_tokenizer") or {}, spec.get("added_tokens") or []
    plain = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) \
        and not pre.get("add_prefix_space") and spec["model"].get("type") == "BPE" \
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added)
    if not plain:
        return {"kind": "tokenizers", "raw": raw, "name": path}
    byte, special = _byte_of_char(), [t["content"] for t in added]
    ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    return {"kind": "byte_bpe", "ranks": ranks, "special": special, "name": path}


class ByteBpe:
    """Token ends of texts under a byte-level BPE with the usual split pattern."""

    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, vocabulary: dict):
        import tiktoken

        ranks = vocabulary["ranks"]
        self.encoding = tiktoken.Encoding("byte_bpe", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, i in ranks.items():
            self.size[i] = len(token)
        special = sorted(vocabulary["special"], key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

    def ends(self, text: str) -> np.ndarray:
        """Byte offsets at which the tokens of ``text`` end."""
        return np.cumsum(self.size[self.encoding.encode_ordinary(text)])

    def count(self, text: str) -> int:
        if self.special is None:
            return self.plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self.plain, parts))

    def plain(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        if len(text) <= chunk:
            return len(self.encoding.encode_ordinary(text))
        return spliced_count(text.encode(), self.ends, chunk, overlap)


def _char_start(raw: bytes, at: int) -> int:
    while 0 < at < len(raw) and raw[at] & 0xC0 == 0x80:
        at -= 1
    return at


def spliced_count(raw: bytes, ends, chunk: int, overlap: int) -> int:
    """Tokens of ``raw`` from encodings of overlapping chunks.

    Neighbouring chunks are spliced at a byte offset in their overlap that is a stable boundary of the text and a
    token end in both encodings.  Where there is none the overlap is widened, at last to the whole left chunk.
    """
    total, spliced, a = 0, 0, 0
    b = _char_start(raw, min(len(raw), chunk))
    left = ends(raw[:b].decode())
    while b < len(raw):
        width = overlap
        while True:
            s = max(a, _char_start(raw, b - width))
            e = _char_start(raw, min(len(raw), s + max(chunk, 2 * width)))
            if s == a:        # no boundary in all of the left chunk: go on from its start with a longer one
                b, left = e, a + ends(raw[a:e].decode())
                break
            right = s + ends(raw[s:e].decode())
            shared = raw[s:b].decode()
            at, found = 0, []
            for m in STABLE.finditer(shared):
                found.append(m.start())
            if found:
                sizes = np.concatenate([[0], np.cumsum([len(shared[i:j].encode()) for i, j in
                                                        zip([0, *found], found)])])[1:]
                common = np.intersect1d(np.intersect1d(s + sizes, left), right)
                common = common[common > spliced]
                at = int(common[len(common) // 2]) if len(common) else 0
            if at:
                total += int(np.searchsorted(left, at, "right") - np.searchsorted(left, spliced, "right"))
                spliced, a, b, left = at, s, e, right
                break
            width *= 2
    return total + int(len(left) - np.searchsorted(left, spliced, "right"))


class Library:
    """Vocabularies of other shapes, through their own libraries on whole texts."""

    def __init__(self, vocabulary: dict):
        if vocabulary["kind"] == "sentencepiece":
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_proto=vocabulary["raw"])
            self.count = lambda text: len(model.encode(text, num_threads=1))
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_str(vocabulary["raw"].decode())
            model.no_truncation()
            model.no_padding()
            self.count = lambda text: len(model.encode(text, add_special_tokens=False).ids)


def counter(vocabulary: dict):
    """The counter of a vocabulary, made once in each Python process."""
    held = sys.__dict__.setdefault("_token_counters", {})
    if vocabulary["name"] not in held:
        held[vocabulary["name"]] = (ByteBpe if vocabulary["kind"] == "byte_bpe" else Library)(vocabulary)
    return held[vocabulary["name"]]


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024) -> DataFrame:
    """Per row of ``docs``: id_col, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    ``tokenizer`` is the path of a vocabulary file.  Counts are those of the file's own library on the whole text,
    without begin, end or added special tokens; the strings of special tokens inside texts count as that library
    counts them by default (one token each).  Byte-level BPE files are encoded through their ranks; texts above 64 KiB
    in overlapping chunks whose encodings are spliced at stable common boundaries, so memory follows the chunk.
    Null and empty texts have 0 bytes and tokens.  Every row, repeated or with a null id, gives one row.
    """
    held = docs.sparkSession.sparkContext.broadcast(read_vocabulary(tokenizer))

    def run(batches):
        count = counter(held.value).count
        for batch in batches:
            _, at = wh.text_bytes(batch.column(1))
            tokens = np.fromiter((count(t.as_py()) if t.is_valid else 0 for t in batch.column(1)), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(at)), pa.array(tokens),
                                              pa.array(tokens > limit)], names=["id", "n_bytes", "n_tokens", "over_limit"])

    out = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, "id long, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("id", id_col)
