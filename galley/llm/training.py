"""What the models of this subpackage are fitted on: sums over all rows, and bounded samples of rows."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 16


def summed(rows: DataFrame, counts: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int) -> np.ndarray:
    """The sum over all tasks of the flat array of ``size`` integers that ``counts`` makes of a task's batches; tasks add up what tasks sent."""

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = counts(batches)
        for k in range(0, size, CHUNK):
            if (part := whole[k : k + CHUNK]).any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([zlib.compress(part.astype(np.int64).tobytes(), 1)], pa.binary())], names=["at", "part"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, part in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                part = np.frombuffer(zlib.decompress(part), np.int64)
                total[k] = total[k] + part if k in total else part
        for k, part in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], names=["at", "part"])

    out = np.zeros(size, np.int64)
    for r in rows.mapInArrow(sent, "at bigint, part binary").repartition("at").mapInArrow(added, "at bigint, part binary").collect():
        part = np.frombuffer(zlib.decompress(bytes(r.part)), np.int64)
        out[r["at"] : r["at"] + len(part)] = part
    return out


def sample(df: DataFrame, key: str, rows: int, chars: dict[str, int] | None = None) -> list:
    """At most ``rows`` rows of ``df``, the same at every call, chosen by the hash of ``key``.

    ``chars`` bounds the length of text columns, so what reaches the driver has a bound in bytes as well. For fitting
    models only; nothing else is counted on a sample.
    """
    total = df.count()
    if total > 2 * rows:
        df = df.where(F.pmod(F.xxhash64(F.lit(11), F.col(key)), F.lit(total // rows)) == 0)
    for c, n in (chars or {}).items():
        df = df.withColumn(c, F.substring(c, 1, n))
    return df.orderBy(F.xxhash64(F.lit(13), F.col(key)), key).limit(rows).collect()
