"""The registered queries of the training-data operators and their SQL counterparts."""

from __future__ import annotations

from . import cut_texts, encoding, garbled, languages, near_duplicates, packing, repeated_lines, residue, splitting

_MODULES = (repeated_lines, near_duplicates, encoding, packing, splitting, garbled, cut_texts, languages, residue)

QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
SQL = {k: v for m in _MODULES for k, v in m.SQL.items()}
