"""Cutting long texts into pieces within a limit of tokens, at content-defined natural boundaries, with overlap.

A rolling hash over the last code points of a text marks landmarks. From the start of a piece, the first
landmark beyond the least size moves to the nearest natural boundary between the least and the greatest size: the end of a
paragraph, else of a line or sentence, else of a word. Where there is no landmark, the last boundary of the best kind before
the greatest size is taken; where there is no boundary either (one long run), the last code point that fits and does not begin with a combining
sign. Cuts thus depend on the text around them and not on what stands far before, so after an edit they soon fall on the old
places again and only pieces next to it alter.

A piece is its own stretch of the text and, but for the first, the tokens before it that the overlap names: as
many as stated, and a few more where a code point would be split. A cut stands before the blanks that
separate, so that the stretches together are the text, and the tokens of a piece are those it has in the text; where a cut
is not at such a place, the ends of the piece are encoded again to count them. The limit holds for the
piece with its overlap, as it is encoded by itself.

A pure map: no shuffle, no collect. Defined cases: null and empty texts give no piece; a text within the limit is one
piece; an overlap of half the limit or more is taken as half the limit; texts of any length, repeated rows and extra columns
are treated alike.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import spread, table
from .encoding import SPACE, TOKENIZERS, _classes, certain, code_points, landmarks, rolling, token_bytes, tokenizer
from .packing import budgets

ANY, WORD, SENTENCE, PARAGRAPH = range(4)
KINDS = ["any", "word", "sentence", "paragraph"]
_TERMINAL, _CLOSING = np.array([ord(c) for c in ".!?…"], np.uint32), np.array([ord(c) for c in "\"”’»“)]"], np.uint32)
_EAST, _EAST_CLOSING, _EAST_PAUSE = (np.array([ord(c) for c in x], np.uint32) for x in ("。！？", "」』）", "、，；"))
_LINE = np.uint32(10)


def boundaries(points: np.ndarray) -> np.ndarray:
    """The kind of cut that each place of a text allows, 0 where it is none."""
    n = len(points)
    level = np.zeros(n + 1, np.int8)
    space = _classes()[points] == SPACE
    starts = np.flatnonzero(space[1:] & ~space[:-1]) + 1  # where white space begins after something
    level[starts] = WORD
    if len(starts):
        lines = np.concatenate(([0], np.cumsum(points == _LINE)))
        after = np.flatnonzero(~space)
        k = np.searchsorted(after, starts)
        ends = np.where(k < len(after), after[np.minimum(k, len(after) - 1)], n)
        breaks = lines[ends] - lines[starts]
        last = starts - 1
        for _ in range(4):  # closing signs after the end of a sentence
            last = np.where((last > 0) & np.isin(points[last], _CLOSING), last - 1, last)
        level[starts[np.isin(points[last], _TERMINAL) | (breaks >= 1)]] = SENTENCE
        level[starts[breaks >= 2]] = PARAGRAPH
    east = np.flatnonzero(np.isin(points, _EAST)) + 1
    for _ in range(3):
        east = np.where((east < n) & np.isin(points[np.minimum(east, n - 1)], _EAST_CLOSING), east + 1, east)
    pause = np.flatnonzero(np.isin(points[:-1], _EAST_PAUSE)) + 1 if n else np.zeros(0, np.int64)
    level[pause] = np.maximum(level[pause], WORD)
    level[east] = np.maximum(level[east], SENTENCE)
    level[0] = level[n] = 0
    return level


@lru_cache(maxsize=1)
def _joined() -> frozenset[int]:
    """Code points that belong to the one before."""
    return frozenset([0x200D, *(i for i in range(0x30000) if unicodedata.combining(chr(i)) or 0xFE00 <= i <= 0xFE0F)])


class Splitter:
    """Pieces of one text after another."""

    def __init__(self, name: str = "byte_bpe_50k", folder: str = TOKENIZERS):
        self.encode, self.name, self.folder = tokenizer(name, folder).encode_ordinary, name, folder

    def pieces(self, text: str | None, limits: list[tuple[int, int]]) -> list[list[tuple[int, int, int, int, int, str]]]:
        """For each (limit, overlap): (start of the piece, start of its own stretch, end, tokens, tokens of overlap, kind of its end)."""
        if not text:
            return [[] for _ in limits]
        ids = self.encode(text)
        n = len(ids)
        if all(n <= limit for limit, _ in limits):
            return [[(0, 0, len(text), n, 0, "end")] for _ in limits]
        points = code_points(text)
        bytes_before = np.concatenate(([0], np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)))).astype(np.int64)
        ends = np.concatenate(([0], np.cumsum(token_bytes(self.name, self.folder)[np.asarray(ids)])))
        known = {
            "text": text,
            "points": points,
            "sure": np.concatenate(([0], certain(points), [len(text)])),
            # tokens that end at or before each place of the text, and the last place at or before each end of a token
            "at": np.searchsorted(ends, bytes_before, "right") - 1,
            "place": np.searchsorted(bytes_before, ends, "right") - 1,
        }
        known["level"] = boundaries(points)
        known["hashes"] = rolling(points)
        return [[(0, 0, len(text), n, 0, "end")] if n <= limit else self._cut(known, limit, min(overlap, limit // 2)) for limit, overlap in limits]

    def _count(self, k: dict, a: int, b: int) -> int:
        """Tokens of text[a:b] as encoded by itself."""
        sure, at, text = k["sure"], k["at"], k["text"]
        i, j = int(np.searchsorted(sure, a)), int(np.searchsorted(sure, b, "right")) - 1
        if i > j:
            return len(self.encode(text[a:b]))
        x, y = int(sure[i]), int(sure[j])
        return (len(self.encode(text[a:x])) if a < x else 0) + int(at[y] - at[x]) + (len(self.encode(text[y:b])) if y < b else 0)

    def _cut(self, k: dict, limit: int, overlap: int) -> list[tuple[int, int, int, int, int, str]]:
        text, at, place = k["text"], k["at"], k["place"]
        core = limit - overlap
        marks = landmarks(k["hashes"], (1 << (core - 1).bit_length()) - 1)
        boundary = np.flatnonzero(k["level"] >= SENTENCE)
        out, own, begin = [], 0, 0
        while True:
            kept = int(at[own] - at[begin])
            if at[-1] - at[begin] <= limit + 8 and (n := self._count(k, begin, len(text))) <= limit:
                out.append((begin, own, len(text), n, kept, "end"))
                return out
            room = limit - kept
            while True:
                end, kind = self._end(k, own, room, core, marks, boundary)
                n = self._count(k, begin, end)
                if n <= limit:
                    break
                room -= max(1, n - limit)
                if room < 1:  # a few code points of many tokens each: the overlap gives way
                    begin, kept, room = own, 0, limit
            out.append((begin, own, end, n, kept, KINDS[kind]))
            own = end
            begin = int(place[max(0, int(at[own]) - overlap)])

    def _end(self, k: dict, own: int, room: int, core: int, marks: np.ndarray, boundary: np.ndarray) -> tuple[int, int]:
        at, place, level, points = k["at"], k["place"], k["level"], k["points"]
        least = min(int(place[min(len(place) - 1, int(at[own]) + core // 2)]), len(points) - 1)
        most = max(own + 1, min(int(place[min(len(place) - 1, int(at[own]) + room)]), len(points) - 1))
        least = max(own + 1, min(least, most))
        i = int(np.searchsorted(marks, least))
        if i < len(marks) and marks[i] <= most:
            mark = int(marks[i])
            lo, hi = np.searchsorted(boundary, least), np.searchsorted(boundary, most, "right")
            if hi > lo:
                near = boundary[lo:hi]
                best = int(near[np.argmin(np.abs(near - mark))])
                return best, int(level[best])
            near = least + np.flatnonzero(level[least : most + 1])
            if len(near):
                best = int(near[np.argmin(np.abs(near - mark))])
                return best, WORD
        for kind in (PARAGRAPH, SENTENCE, WORD):
            found = np.flatnonzero(level[least : most + 1] >= kind)
            if len(found):
                return least + int(found[-1]), kind
        cut = most
        while cut > own + 1 and (int(points[cut]) in _joined() or int(points[cut - 1]) == 0x200D):
            cut -= 1
        return (cut if cut > own + 1 else most), ANY


def _split(limits: list[tuple[str, int, int]], name: str, folder: str):
    names = ["id", "budget_name", "piece_no", "n_pieces", "start_char", "own_char", "end_char", "n_tokens", "overlap_tokens", "cut_kind", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(name, folder)
        for whole in batches:
            for b in (whole.slice(i, 500) for i in range(0, whole.num_rows, 500)):
                row, cols = [], [[] for _ in names[1:]]
                for r, text in enumerate(b.column(1).to_pylist()):
                    for (budget, _, _), pieces in zip(limits, splitter.pieces(text, [x[1:] for x in limits]), strict=True):
                        for i, p in enumerate(pieces):
                            row.append(r)
                            for c, v in zip(cols, (budget, i, len(pieces), *p, text[p[0] : p[2]]), strict=True):
                                c.append(v)
                kinds = [pa.string(), *[pa.int32()] * 7, pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row, pa.int64())), *[pa.array(c, t) for c, t in zip(cols, kinds, strict=True)]], names=names)

    return run


def split(docs: DataFrame, id_col: str, text: str, limits: list[tuple[str, int, int]], *, name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """Pieces of every text for each (budget name, limit, overlap): id, budget_name, piece_no, n_pieces, start_char, own_char, end_char, n_tokens, overlap_tokens, cut_kind, text.

    The piece is text[start_char:end_char] in code points; from own_char on it is not in the piece before.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, budget_name string, piece_no int, n_pieces int, start_char int, own_char int, end_char int, n_tokens int, overlap_tokens int, cut_kind string, text string"
    return rows.mapInArrow(_split(limits, name, folder), schema)


def pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p10_pieces: the pieces of every document for each piece_* budget."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return split(docs, "doc_id", "text", budgets(spark, sf_dir, "piece_")).withColumnRenamed("id", "doc_id")


QUERIES = {"p10_pieces": pieces}
SQL: dict[str, str] = {}
