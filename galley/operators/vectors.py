"""Similarity of vectors: exact joins and searches above a threshold without comparing all with all.

Rows of one vector are one class, and only classes are compared. They are dealt to groups of bounded size, and each pair of groups meets in one
task, which holds one of them and reads the other. The held group falls to the nearest of some pivots: by the triangle inequality on angles, a
vector is compared only with the pivots' cells whose radius, widened by the angle of the threshold, reaches it. Products of matrices in single precision,
with their bound of error, tell which pairs are worth the exact product. The result is exact whatever groups and pivots are; they decide only how much
is compared. The rows of the classes come in at the end, and only as far as they are asked for.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import written
from .graph import components

PIVOTS = 32
#: Bytes of the vectors that a task holds, and classes from which on a table is dealt to more groups.
HELD, DEALT = 32_000_000, 2000


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Null where one is the zero vector."""
    n = norm(a) * norm(b)
    return F.when(n > 0, dot(a, b) / n)


def classes(df: DataFrame) -> DataFrame:
    """id, class, n, v of the rows of (id, v) but zero and null vectors: rows of one vector have one class, v stands at one of them, beside the number of them."""
    rows = df.select("id", "v").where(norm(F.col("v")) > 0).withColumn("uid", F.monotonically_increasing_id())
    same = Window.partitionBy(F.xxhash64("v"), "v")
    rows = rows.withColumn("class", F.min("uid").over(same)).withColumn("n", F.count(F.lit(1)).over(same))
    return written(rows.select("id", "class", "n", F.when(F.col("uid") == F.col("class"), F.col("v")).alias("v")), "classes")


def _dealt(members: DataFrame) -> tuple[DataFrame, int]:
    """(class, v, group) of the classes, and the number of groups."""
    firsts = members.where("v is not null").select("class", "v")
    n, size = firsts.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    groups = max(1, min(6, n // DEALT), -(-n * (size or 0) * 8 // HELD))
    return firsts.withColumn("group", F.pmod(F.xxhash64("class"), F.lit(groups)).cast("int")), groups


def _unit(column: pa.Array) -> np.ndarray:
    """The vectors of a list column, of length 1; sums run from the first coordinate to the last as in ``dot``."""
    v = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)
    return v / np.sqrt(_products(v, v))[:, None]


def _products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x))
    for k in range(x.shape[1]):
        out += x[:, k] * y[:, k]
    return out


class _Held:
    """The classes of one group in the cells of their pivots."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray]], threshold: float, pivots: int):
        self.ids, self.v, self.threshold = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), threshold
        self.pivots = self.v[:pivots]
        self.reach = math.acos(max(-1.0, min(1.0, threshold))) + 1e-6
        # what rounding to single precision and summing in it can take from a product of vectors of length 1
        self.least = np.float32(threshold - 1.3e-7 * (self.v.shape[1] + 8))
        at = self._angles(self.v)
        own = at.argmin(1)
        self.cells = []
        for c in range(len(self.pivots)):
            rows = np.flatnonzero(own == c)
            for part in (rows[i : i + 4096] for i in range(0, len(rows), 4096)):
                self.cells.append((c, part, self.v[part].astype(np.float32), at[part, c].max()))

    def _angles(self, v: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(v @ self.pivots.T, -1, 1))

    def meet(self, ids: np.ndarray, v: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Class, class and similarity of the pairs; of one group with itself every pair once. What is not a number counts as similar, as in SQL."""
        at, single = self._angles(v), v.astype(np.float32)
        for c, part, held, radius in self.cells:
            near = np.flatnonzero(~(at[:, c] > radius + self.reach))
            for rows in (near[i : i + 1024] for i in range(0, len(near), 1024)):
                p, q = np.nonzero(~(held @ single[rows].T < self.least))
                p, q = part[p], rows[q]
                if same:
                    keep = self.ids[p] <= ids[q]
                    p, q = p[keep], q[keep]
                for i in range(0, len(p), 50_000):
                    x, y = p[i : i + 50_000], q[i : i + 50_000]
                    s = _products(self.v[x], v[y])
                    keep = ~(s < self.threshold)
                    yield self.ids[x][keep], ids[y][keep], s[keep]


def _met(threshold: float, one: bool, pivots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, held = None, [], None
        for b in batches:
            cell, side, ids = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy()
            starts = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (side[1:] != side[:-1])]) if len(cell) else []
            for s, e in zip(starts, [*starts[1:], len(cell)], strict=True):
                if cell[s] != at:
                    at, parts, held = cell[s], [], None
                v = _unit(b.column(3).slice(s, e - s))
                if side[s] == 0:
                    parts.append((ids[s:e], v))
                elif parts:
                    held = held or _Held(parts, threshold, pivots)
                    for x, y, similarity in held.meet(ids[s:e], v, one and side[s] == 1):
                        yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.array(similarity)], names=["x", "y", "similarity"])

    return run


def class_pairs(left: DataFrame, threshold: float, right: DataFrame | None = None, *, pivots: int = PIVOTS) -> DataFrame:
    """x, y, similarity of all pairs of classes with at least this cosine, from tables of ``classes``: within one table (each pair once, and every class with itself), or between two."""
    x, groups = _dealt(left)
    if right is None:
        # side 1 is the held group itself, side 2 another
        others = F.sequence(F.lit(0), F.lit(groups - 1))
        held = x.select(F.explode(F.filter(others, lambda k: k >= F.col("group"))).alias("k"), (F.col("group") * groups + F.col("k")).alias("cell"), F.lit(0).alias("side"), "class", "v")
        read = x.select(F.explode(F.filter(others, lambda k: k <= F.col("group"))).alias("k"), (F.col("k") * groups + F.col("group")).alias("cell"), F.when(F.col("k") == F.col("group"), 1).otherwise(2).alias("side"), "class", "v")
        cells = groups * groups
    else:
        y, many = _dealt(right)
        held = x.select(F.explode(F.sequence(F.lit(0), F.lit(many - 1))).alias("k"), (F.col("group") * many + F.col("k")).alias("cell"), F.lit(0).alias("side"), "class", "v")
        read = y.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("k"), (F.col("k") * many + F.col("group")).alias("cell"), F.lit(2).alias("side"), "class", "v")
        cells = groups * many
    met = held.drop("k").unionAll(read.drop("k")).repartition(cells, "cell").sortWithinPartitions("cell", "side")
    return written(met.mapInArrow(_met(threshold, right is None, pivots), "x bigint, y bigint, similarity double"), "pairs")


def similar_pairs(left: DataFrame, threshold: float, right: DataFrame | None = None, *, pivots: int = PIVOTS) -> DataFrame:
    """a, b, similarity of all pairs with at least this cosine, from (id, v): within one table (a < b), or between two."""
    one = right is None
    left = classes(left)
    right = left if one else classes(right)
    pairs = class_pairs(left, threshold, None if one else right, pivots=pivots)
    pairs = pairs.join(left.select(F.col("class").alias("x"), F.col("id").alias("a")), "x").join(right.select(F.col("class").alias("y"), F.col("id").alias("b")), "y")
    if not one:
        return pairs.select("a", "b", "similarity")
    # of two classes both orders of rows come once, of one class only a < b
    pairs = pairs.where((F.col("a") < F.col("b")) | (F.col("x") != F.col("y")) & (F.col("a") != F.col("b")))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "similarity")


def nearest_later(df: DataFrame, threshold: float, k: int) -> DataFrame:
    """What ``top_edges`` gives for the ``similar_pairs`` of (id, v), without all pairs of rows: of each class, a row meets the first k rows after it."""
    members = classes(df)
    pairs = class_pairs(members, threshold)
    pairs = pairs.unionAll(pairs.where("x <> y").select(F.col("y").alias("x"), F.col("x").alias("y"), "similarity"))
    rows = members.select("id", "class", "n")
    asked = pairs.join(rows.select(F.col("class").alias("x"), F.col("id").alias("a")), "x").select(F.col("y").alias("class"), "a", "similarity")
    # classes of one row are met as they are
    single = asked.join(rows.where("n = 1").select("class", F.col("id").alias("b")), "class").where("a < b").select("a", "b", "similarity")
    several = rows.where("n > 1").select("class", F.col("id").alias("at"), F.lit(None).cast("double").alias("similarity"), F.lit(0).alias("asks"))
    asked = asked.join(several.select("class").distinct(), "class", "left_semi").select("class", F.col("a").alias("at"), "similarity", F.lit(1).alias("asks"))
    upto = F.sum(1 - F.col("asks")).over(Window.partitionBy("class").orderBy("at", "asks").rowsBetween(Window.unboundedPreceding, 0))
    placed = written(several.unionAll(asked).withColumn("place", upto), "places")
    asked = placed.where("asks = 1").select("class", F.col("at").alias("a"), "similarity", F.explode(F.sequence(F.col("place") + 1, F.col("place") + k)).alias("place"))
    met = asked.join(placed.where("asks = 0").select("class", "place", F.col("at").alias("b")), ["class", "place"]).select("a", "b", "similarity")
    return top_edges(single.unionAll(met), k)


def linked(df: DataFrame, threshold: float) -> DataFrame:
    """a, b of edges that connect what the ``similar_pairs`` of (id, v) connect, for thresholds below 1: one edge a row and one a pair of classes."""
    members = classes(df)
    pairs = class_pairs(members, threshold)
    first = members.where("v is not null").select("class", F.col("id").alias("first"))
    stars = members.join(first, "class").select(F.col("first").alias("a"), F.col("id").alias("b"))
    between = pairs.where("x <> y").join(first.select(F.col("class").alias("x"), F.col("first").alias("a")), "x").join(first.select(F.col("class").alias("y"), F.col("first").alias("b")), "y")
    return stars.unionAll(between.select("a", "b")).where("a <> b")


def best_of_labels(left: DataFrame, right: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """a, component, similarity: of each row of (id, v) the component (node, component) whose best member in the other table is nearest; the least component where several tie at 6 digits."""
    left, right = classes(left), classes(right)
    of = right.join(labels.withColumnRenamed("node", "id"), "id").select(F.col("class").alias("y"), "component").distinct()
    best = class_pairs(left, threshold, right).join(of, "y").groupBy("x", "component").agg(F.max("similarity").alias("similarity"))
    order = [F.round("similarity", 6).desc(), F.col("component")]
    rows = top_k(best, "x", order, 1).drop("rn").join(left.select(F.col("class").alias("x"), F.col("id").alias("a")), "x")
    return top_k(rows, "a", order, 1).select("a", "component", "similarity")


def top_edges(pairs: DataFrame, k: int) -> DataFrame:
    """Of each a, the k most similar b (later ids only compete for the places of earlier ones)."""
    rn = F.row_number().over(Window.partitionBy("a").orderBy(F.col("similarity").desc(), "b"))
    return pairs.withColumn("rn", rn).where(F.col("rn") <= k).drop("rn")


def best_per_group(pairs: DataFrame, of_a: DataFrame, of_b: DataFrame) -> DataFrame:
    """row, piece, similarity: the greatest similarity between the members of each row and piece, from (id, row) and (id, piece)."""
    joined = pairs.join(of_a.withColumnRenamed("id", "a"), "a").join(of_b.withColumnRenamed("id", "b"), "b")
    return joined.groupBy("row", "piece").agg(F.max("similarity").alias("similarity"))


def top_k(df: DataFrame, key: str, order: list[Column], k: int) -> DataFrame:
    rn = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("rn", rn).where(F.col("rn") <= k)


def groups_of(edges: DataFrame, least: int = 2) -> DataFrame:
    """node, component of the connected components with at least ``least`` nodes."""
    c = components(edges)
    big = c.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("component")
    return c.join(big, "component", "left_semi").select("node", "component")


def cohesion(edges: DataFrame, labels: DataFrame, k: int) -> DataFrame:
    """component, size, n_edges, density, and cohesion (density against the greatest that k neighbours each allow, at most 1)."""
    n = labels.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    e = edges.join(labels.withColumnRenamed("node", "a"), "a").groupBy("component").agg(F.count(F.lit(1)).alias("n_edges"))
    density = F.col("n_edges") / (F.col("size") * (F.col("size") - 1) / 2)
    most = F.least(F.lit(1.0), F.lit(float(k)) / (F.col("size") - 1))
    return n.join(e, "component").select("component", "size", "n_edges", density.alias("density"), F.least(F.lit(1.0), density / most).alias("cohesion"))
