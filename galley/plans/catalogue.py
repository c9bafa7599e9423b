"""The registered queries of the core and their SQL counterparts."""

from __future__ import annotations

import io
import os
import zipfile

from pyspark.sql import SparkSession

from ..operators import instants
from ..runtime import shared_dir
from . import editions, groups, protocols, quality, relations, streams, texts

_MODULES = (texts, relations, groups, protocols, streams, quality, editions)

QUERIES = {
    "p3_found": instants.found,
    "p3_normalised": instants.normalised,
    "p3_iso": instants.readable,
}
QUERIES |= {k: v for m in _MODULES for k, v in m.QUERIES.items()}
SQL: dict[str, str] = {"p3_iso": instants.ISO_SQL} | {k: v for m in _MODULES for k, v in m.SQL.items()}


def ship(spark: SparkSession, root: str) -> None:
    """Sends the package to the executors as one archive, for clusters that do not share this folder."""
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(os.path.join(root, "galley")):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, root))
    import tempfile

    path = os.path.join(tempfile.mkdtemp(prefix="galley-ship-"), "galley-package.zip")
    with open(path, "wb") as out:
        out.write(archive.getvalue())
    spark.sparkContext.addPyFile(path)
    shared_dir(spark)
