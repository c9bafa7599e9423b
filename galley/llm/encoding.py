"""Encoding of whole texts with a public tokenizer, by content-defined chunk reuse.

A text is cut where a rolling hash over its last code points has a fixed pattern, so equal passages of
different documents are cut alike, and each distinct chunk of a task is encoded once. A cut moves on to the
next place, if one is near, where a new pre-token is certain to begin; there the ids of the two chunks join
as they are. Where none is near (a long run of one class of characters), the join is repaired: the window
between the certain places around the cut is encoded again, and the chunks' ids outside it, which must end
exactly at its edges, stay. Results are those of encoding the whole text at once.

The operator is a pure map: no shuffle, no collect; a task holds one Arrow batch and a bounded cache.

Defined cases: a null or empty text gives an empty list; the strings of special tokens are ordinary text;
repeated rows are encoded alike; very long texts need memory in proportion to their own length only.
"""

from __future__ import annotations

import base64
import os
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import spread, table

TOKENIZERS = "/opt/tokenizers"
WINDOW, MASK, SNAP = 12, 0x1FF, 160
CACHE = 60_000
LETTER, NUMBER, SPACE, OTHER, UNKNOWN = range(5)
# How byte-level BPE vocabularies of this family cut a text before merging (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def tokenizer(name: str = "byte_bpe_50k", folder: str = TOKENIZERS):
    """The tokenizer of a ``<name>.tiktoken`` file in ``folder``."""
    import tiktoken

    with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def token_bytes(name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> np.ndarray:
    """The number of bytes of each token."""
    t = tokenizer(name, folder)
    return np.array([len(t.decode_single_token_bytes(i)) for i in range(t.max_token_value + 1)], dtype=np.int64)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of every code point, as the pre-tokenizer's pattern tells them apart."""
    out = np.full(sys.maxunicode + 1, OTHER, dtype=np.uint8)
    for i in range(sys.maxunicode + 1):
        c = unicodedata.category(chr(i))
        if c[0] == "L":
            out[i] = LETTER
        elif c[0] == "N":
            out[i] = NUMBER
        elif c == "Cn":
            out[i] = UNKNOWN  # a newer Unicode version may know it
    for i in (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000):
        out[i] = SPACE
    return out


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def certain(points: np.ndarray) -> np.ndarray:
    """The places, in order, where a pre-token begins whatever stands further to the left or right.

    No alternative of the pattern holds a character that is no white space before white space, nor characters
    of two other classes, except an apostrophe before a letter.
    """
    c = _classes()[points]
    a, b = c[:-1], c[1:]
    ok = (a != SPACE) & (a != b) & (a != UNKNOWN) & (b != UNKNOWN) & ~((points[:-1] == 0x27) & (b == LETTER))
    return np.flatnonzero(ok) + 1


def rolling(points: np.ndarray) -> np.ndarray:
    """The hash of the last WINDOW code points at each place from WINDOW on."""
    n = len(points)
    if n <= WINDOW:
        return np.empty(0, dtype=np.uint32)
    mixed = (points * np.uint32(0x9E3779B1)) ^ (points >> np.uint32(7))
    out = mixed[WINDOW - 1 :].copy()
    for j in range(1, WINDOW):
        out += mixed[WINDOW - 1 - j : n - j] * np.uint32(pow(0x01000193, j, 1 << 32))
    return out


def landmarks(hashes: np.ndarray, mask: int) -> np.ndarray:
    """The places after which the rolling hash has the landmark pattern."""
    return np.flatnonzero(((hashes >> np.uint32(11)) & np.uint32(mask)) == 0) + WINDOW


def rolling_hits(points: np.ndarray, mask: int) -> np.ndarray:
    return landmarks(rolling(points), mask)


class ChunkEncoder:
    """Encodes texts with the ids of chunks seen before; exact."""

    def __init__(self, name: str = "byte_bpe_50k", folder: str = TOKENIZERS):
        self.encode = tokenizer(name, folder).encode_ordinary
        self.name, self.folder = name, folder
        self.known: dict[str, list[int]] = {}
        self.reused = self.fresh = self.repaired = 0

    def _chunk(self, part: str) -> list[int]:
        ids = self.known.get(part)
        if ids is None:
            if len(self.known) >= CACHE:
                self.known.clear()
            ids = self.known[part] = self.encode(part)
            self.fresh += 1
        else:
            self.reused += 1
        return ids

    def ids(self, text: str | None) -> list[int]:
        if not text:
            return []
        points = code_points(text)
        hits = rolling_hits(points, MASK)
        hits = hits[hits < len(points)]
        if not len(hits):
            return self._chunk(text)
        sure = certain(points)
        at = np.searchsorted(sure, hits)
        snapped = sure[np.minimum(at, len(sure) - 1)] if len(sure) else hits
        near = (at < len(sure)) & (snapped - hits <= SNAP) if len(sure) else np.zeros(len(hits), bool)
        out: list[int] = []
        start = 0  # out holds the ids of text[:start] unless a repair is open
        loose: list[int] = []  # cuts since the last certain one
        begin = 0
        for cut, good in [*zip(np.where(near, snapped, hits).tolist(), near.tolist(), strict=True), (len(text), True)]:
            if cut <= start:
                continue
            if not good:
                loose.append(cut)
                start = cut
                continue
            out += self._repaired(text, sure, begin, loose, cut) if loose else self._chunk(text[begin:cut])
            loose, begin, start = [], cut, cut
        return out

    def _repaired(self, text: str, sure: np.ndarray, begin: int, loose: list[int], end: int) -> list[int]:
        """ids of text[begin:end], whose ends are certain, from its chunks between loose cuts."""
        windows: list[list[int]] = []
        for cut in loose:
            k = int(np.searchsorted(sure, cut))
            p = max(begin, int(sure[k - 1]) if k else 0)
            q = min(end, int(sure[k]) if k < len(sure) else end)
            if windows and p <= windows[-1][1]:
                windows[-1][1] = max(q, windows[-1][1])
            else:
                windows.append([p, q])
        edges = np.array([begin, *loose, end])
        out: list[int] = []
        done = begin
        for p, q in [*windows, [end, end]]:
            if p > done:  # no cut lies in it, so one chunk holds it
                i = int(np.searchsorted(edges, done, "right")) - 1
                out += self._cut(self._chunk(text[edges[i] : edges[i + 1]]), text, int(edges[i]), done, p)
            if q > p:
                out += self.encode(text[p:q])
                self.repaired += 1
            done = q
        return out

    def _cut(self, ids: list[int], text: str, start: int, lo: int, hi: int) -> list[int]:
        """The ids of text[lo:hi], both certain places, from those of the chunk that begins at ``start``.

        They must begin and end exactly there; else the passage is encoded again.
        """
        ends = np.concatenate(([0], np.cumsum(token_bytes(self.name, self.folder)[ids])))
        a = len(text[start:lo].encode())
        b = a + len(text[lo:hi].encode())
        i, j = int(np.searchsorted(ends, a)), int(np.searchsorted(ends, b))
        if i < len(ends) and j < len(ends) and ends[i] == a and ends[j] == b:
            return ids[i:j]
        return self.encode(text[lo:hi])


def _encode(name: str, folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ChunkEncoder(name, folder)
        for b in batches:
            ids, offsets = [], [0]
            flat: list[np.ndarray] = []
            for text in b.column(1).to_pylist():
                ids = coder.ids(text)
                flat.append(np.asarray(ids, dtype=np.int32))
                offsets.append(offsets[-1] + len(ids))
            values = pa.array(np.concatenate(flat) if flat else np.empty(0, np.int32), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)], names=[b.schema.names[0], "ids"])

    return run


def encoded(docs: DataFrame, id_col: str, text: str, *, name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """id and ids (array of int) of every row's text."""
    rows = docs.select(F.col(id_col), F.col(text).alias("__text"))
    schema = T.StructType([T.StructField(id_col, rows.schema[0].dataType), T.StructField("ids", T.ArrayType(T.IntegerType(), False))])
    return rows.mapInArrow(_encode(name, folder), schema)


def _sizes(name: str, folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(name, folder).encode_ordinary
        for b in batches:
            n = [len(encode(t)) if t else 0 for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int32())], names=[b.schema.names[0], "n_tokens"])

    return run


def token_counts(docs: DataFrame, id_col: str, text: str, *, name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """id and n_tokens of every row's text; null and empty texts have 0."""
    rows = docs.select(F.col(id_col), F.col(text).alias("__text"))
    schema = T.StructType([T.StructField(id_col, rows.schema[0].dataType), T.StructField("n_tokens", T.IntegerType())])
    return rows.mapInArrow(_sizes(name, folder), schema)


def ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p8_ids: doc_id and ids of each document."""
    return encoded(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), "doc_id", "text")


QUERIES = {"p8_ids": ids}
SQL: dict[str, str] = {}
