"""Filling containers of fixed capacity with whole items by exact-complement hashing, then best fit.

The plan is made on the counts of items by length, never on items: lengths lie between 0 and the capacity, so
the counts, and with them all the driver holds, are bounded by the capacity at any number of items. For
each length, the longest first, the room left beside it is looked up among the sums of one, two and three
lengths that are still available; each hit fills as many containers exactly as the counts allow, at once.
What no exact combination takes goes, the longest first, where the least room is left that holds it.

Every step of the plan says: items of this length with these ranks go into these containers, one each. Items
get their rank within their length by two counts, in the rows of (length, salt) and in the salts before, so a length
that a third of all items have is spread over all tasks. The steps are looked up by (length, rank).

Defined cases: an item longer than the capacity is cut into pieces of the capacity and a rest (no other
item is cut); items of length 0 (null and empty texts) take no room and are dealt to the containers in turn, or to
container 0 if there is no other; repeated rows with the same id are items of their own; no items, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..runtime import spread, table, written
from .encoding import token_counts

RANK_BITS = 46


class Plan:
    """Steps (length, first rank, count, first container) that place all items of a histogram."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            if length:
                self.left[length] = n
        self.ranked = np.zeros(capacity + 1, np.int64)
        self.containers = 0
        self.steps: list[tuple[int, int, int, int]] = []
        self.exact = 0
        opened = self._fill_exactly()
        self._best_fit(opened)

    def _put(self, length: int, n: int, container: int) -> None:
        self.steps.append((length, int(self.ranked[length]), n, container))
        self.ranked[length] += n

    def _take(self, lengths: tuple[int, ...]) -> int:
        """Fills as many containers with these lengths, each once for every time it is named, as there are items."""
        n = min(int(self.left[x]) // lengths.count(x) for x in lengths)
        if n:
            for x in lengths:
                self.left[x] -= n
                self._put(x, n, self.containers)
            self.containers += n
            self.exact += n
        return n

    def _pairs(self, total: int, most: int) -> np.ndarray:
        """The longer lengths b of available pairs b >= total - b > 0 with b <= most."""
        b = np.arange((total + 1) // 2, min(most, total - 1) + 1)
        return b[(self.left[b] > 0) & (self.left[total - b] > 0)] if len(b) else b

    def _fill_exactly(self) -> list[tuple[int, int]]:
        """Returns (length, count) of the items that found no exact complement."""
        over = []
        self._take((self.capacity,))
        for a in range(self.capacity - 1, 0, -1):
            if not self.left[a]:
                continue
            gap = self.capacity - a
            if gap <= a:
                self._take((a, gap))
            if self.left[a]:
                for b in self._pairs(gap, a)[::-1].tolist():
                    self._take((a, b, gap - b))
                    if not self.left[a]:
                        break
            if self.left[a] and gap >= 3:
                here = (self.left > 0).astype(np.float64)
                size = 2 * len(here)
                sums = np.fft.irfft(np.fft.rfft(here, size) ** 2, size)[: gap + 1] > 0.5
                d = np.arange(1, gap // 3 + 1)
                for x in d[(here[d] > 0) & sums[gap - d]][::-1].tolist():
                    for b in self._pairs(gap - x, min(a, gap - 2 * x))[::-1].tolist():
                        self._take((a, b, gap - x - b, x))
                        if not self.left[a]:
                            break
                    if not self.left[a]:
                        break
            if self.left[a]:
                over.append((a, int(self.left[a])))
                self.left[a] = 0
        return over

    def _best_fit(self, items: list[tuple[int, int]]) -> None:
        room: dict[int, list[tuple[int, int]]] = {}  # by room left: (first container, count)
        for length, n in items:
            while n:
                fits = [g for g in room if g >= length]
                if fits:
                    gap = min(fits)
                    first, m = room[gap].pop()
                    k = min(n, m)
                    if m > k:
                        room[gap].append((first + k, m - k))
                    if not room[gap]:
                        del room[gap]
                else:
                    gap, first, k = self.capacity, self.containers, -(-n // (self.capacity // length))
                    self.containers += k
                self._put(length, k, first)
                n -= k
                if gap > length:
                    room.setdefault(gap - length, []).append((first, k))

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys (length and first rank in one number) in order, and container less rank of each."""
        s = np.array(self.steps, np.int64).reshape(-1, 4)
        key = (s[:, 0] << RANK_BITS) + s[:, 1]
        order = np.argsort(key)
        return key[order], (s[:, 3] - s[:, 1])[order]


def _container(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, shift, containers = shared.value
        for b in batches:
            length, rank = b.column(2).to_numpy().astype(np.int64), b.column(3).to_numpy()
            if len(key):
                at = np.searchsorted(key, (length << RANK_BITS) + rank, "right") - 1
                found = np.where(length > 0, shift[np.maximum(at, 0)] + rank, rank % max(containers, 1))
            else:
                found = np.zeros(len(rank), np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(found)], names=["item", "piece_no", "n_tokens", "container_id"])

    return run


def ranked(items: DataFrame, salts: int) -> DataFrame:
    """item, piece_no, n_tokens and rank (from 0, without gaps) within n_tokens."""
    salted = items.withColumn("salt", F.pmod(F.xxhash64("item", "piece_no"), F.lit(salts)).cast("int"))
    counts = salted.groupBy("n_tokens", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("n_tokens").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offset = counts.select("n_tokens", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    local = salted.withColumn("row", F.row_number().over(Window.partitionBy("n_tokens", "salt").orderBy("item", "piece_no")))
    return local.join(offset, ["n_tokens", "salt"]).select("item", "piece_no", "n_tokens", (F.col("offset") + F.col("row") - 1).alias("rank"))


def packed(sizes: DataFrame, capacity: int) -> DataFrame:
    """From (item, n_tokens): item, piece_no (from 0), n_tokens of the piece, container_id (from 0)."""
    spark = sizes.sparkSession
    n = F.coalesce(F.col("n_tokens"), F.lit(0))
    pieces = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(n / capacity).cast("int") - 1))
    items = sizes.select("item", n.alias("total"), F.explode(pieces).alias("piece_no"))
    items = items.select("item", "piece_no", F.least(F.lit(capacity), F.col("total") - F.col("piece_no") * capacity).cast("int").alias("n_tokens"))
    # at most capacity + 1 rows
    plan = Plan({r.n_tokens: r.n for r in items.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()}, capacity)
    shared = spark.sparkContext.broadcast((*plan.arrays(), plan.containers))
    salts = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    kind = items.schema["item"].dataType.simpleString()
    return ranked(items, salts).mapInArrow(_container(shared), f"item {kind}, piece_no int, n_tokens int, container_id bigint")


def budgets(spark: SparkSession, sf_dir: str, prefix: str) -> list[tuple[str, int, int]]:
    """(name, capacity, overlap) of the token budgets whose name has this prefix; a table of a few rows."""
    rows = table(spark, sf_dir, "token_budgets").where(F.col("budget_name").startswith(prefix)).select("budget_name", "capacity_tokens", "overlap_tokens")
    return sorted((r[0], r[1], r[2] or 0) for r in rows.collect())


def pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p9_packed: every document, or piece of one above the capacity, with its container, for each pack_* budget."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    sizes = written(token_counts(docs, "doc_id", "text").withColumnRenamed("doc_id", "item"), "sizes")
    out = None
    for name, capacity, _ in budgets(spark, sf_dir, "pack_"):
        one = packed(sizes, capacity).select(F.lit(name).alias("budget_name"), F.col("item").alias("doc_id"), "piece_no", "n_tokens", "container_id")
        out = one if out is None else out.unionAll(one)
    return out


def fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p9_fill: containers, items, tokens and the share of room unused, for each pack_* budget."""
    size = table(spark, sf_dir, "token_budgets").select("budget_name", "capacity_tokens")
    each = pack(spark, sf_dir).groupBy("budget_name", "container_id").agg(F.sum("n_tokens").alias("used"), F.count(F.lit(1)).alias("n"))
    total = each.groupBy("budget_name").agg(F.count(F.lit(1)).alias("containers"), F.sum("n").alias("items"), F.sum("used").alias("tokens"), F.max("used").alias("fullest"))
    return total.join(size, "budget_name").select("budget_name", "containers", "items", "tokens", "fullest", (1 - F.col("tokens") / (F.col("containers") * F.col("capacity_tokens"))).alias("unused_share"))


QUERIES = {"p9_packed": pack, "p9_fill": fill}
SQL: dict[str, str] = {}
