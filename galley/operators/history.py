"""Deduplication against history, snapshots, comparisons of two states, and runs of events."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import written
from .graph import components

LEAST_TITLE = 30


def dedup_keys(items: DataFrame, id_col: str, source: str, parent: str, url: str, title_key: str) -> DataFrame:
    """(id, kind, key) of the keys under which an item is known: source and address, parent and address, and a long title by itself."""
    key = lambda *c: F.xxhash64(*[F.coalesce(F.col(x), F.lit("\0")) for x in c])
    long = F.length(title_key) >= LEAST_TITLE
    keys = F.array(
        F.struct(F.lit("s").alias("kind"), F.when(F.col(url).isNotNull(), key(source, url)).alias("key")),
        F.struct(F.lit("p").alias("kind"), F.when(F.col(url).isNotNull() & F.col(parent).isNotNull(), key(parent, url)).alias("key")),
        F.struct(F.lit("t").alias("kind"), F.when(long, key(title_key)).alias("key")),
    )
    return items.select(F.col(id_col).alias("id"), F.explode(keys).alias("k")).select("id", "k.kind", "k.key").where("key is not null")


def unknown_to(candidates: DataFrame, history: DataFrame, id_col: str, source: str, parent: str, url: str, title_key: str) -> DataFrame:
    """The candidates that share no key with the history. One equi-join on keys stands for the three conditions."""
    args = (id_col, source, parent, url, title_key)
    known = dedup_keys(history, *args).select("kind", "key").distinct()
    seen = dedup_keys(candidates, *args).join(known, ["kind", "key"], "left_semi").select(F.col("id").alias(id_col)).distinct()
    return candidates.join(seen, id_col, "left_anti")


def absorb_within(items: DataFrame, parent: str) -> DataFrame:
    """From (id, url, title_key, ord, a timestamp) and a parent: id, winner, kept.

    The items of a parent are taken in order of (ord, id). One whose address is known goes where the first item of that address went; else one
    whose long title is known goes where the last item of that title went; else it is a survivor. So every item points to one earlier item or to itself,
    and the winner is the end of its path: the one item of its component that points to itself. The item before, of the same title, is looked up in two steps,
    within days and between them, so that a title which many items share is not one task's.
    """
    d = items.select("id", "url", F.when(F.length("title_key") >= LEAST_TITLE, F.col("title_key")).alias("title"), "ord", F.coalesce(F.col(parent), F.lit("\0")).alias("p")).withColumn("ord", F.coalesce("ord", F.timestamp_seconds(F.lit(-62135596800))))
    spot = F.struct("ord", "id")
    first = d.where("url is not null").groupBy("p", "url").agg(F.min(spot).alias("first"))
    d = d.join(first, ["p", "url"], "left").withColumn("known", F.col("first.id") != F.col("id"))
    titled = d.where("title is not null").withColumn("day", F.date_trunc("day", "ord"))
    local = Window.partitionBy("p", "title", "day").orderBy("ord", "id")
    titled = titled.withColumn("before", F.lag("id").over(local))
    ends = titled.groupBy("p", "title", "day").agg(F.max(spot).alias("last"))
    # one row for each title and day
    ends = ends.withColumn("earlier", F.lag("last.id").over(Window.partitionBy("p", "title").orderBy("day"))).select("p", "title", "day", "earlier")
    titled = titled.join(ends, ["p", "title", "day"], "left").select("id", F.coalesce("before", "earlier").alias("before"))
    pointed = d.join(titled, "id", "left").select("id", F.when(F.coalesce("known", F.lit(False)), F.col("first.id")).otherwise(F.coalesce("before", "id")).alias("to"))
    pointed = written(pointed, "pointers")
    groups = components(pointed.select(F.col("id").alias("a"), F.col("to").alias("b")))
    roots = pointed.where("id = to").join(groups, F.col("id") == F.col("node")).select("component", F.col("id").alias("winner"))
    went = groups.join(roots, "component").select(F.col("node").alias("id"), "winner")
    return pointed.join(went, "id", "left").select("id", F.coalesce("winner", "id").alias("winner"), (F.col("id") == F.col("to")).alias("kept"))


def as_of(left: DataFrame, right: DataFrame, key: str, at: str, valid_from: str, values: list[str]) -> DataFrame:
    """Each left row with the values of the last right row of its key at or before its time; null where there is none.

    One sort of both sides together, by key and time, instead of a join on an inequality.
    """
    a = left.withColumn("__side", F.lit(1)).withColumn("__t", F.col(at))
    b = right.select(F.col(key), F.col(valid_from).alias("__t"), F.struct(*values).alias("__v")).withColumn("__side", F.lit(0))
    both = a.unionByName(b, allowMissingColumns=True)
    w = Window.partitionBy(key).orderBy("__t", "__side").rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("__last", F.last("__v", ignorenulls=True).over(w)).where("__side = 1")
    return out.select(*left.columns, *[F.col(f"__last.{v}").alias(v) for v in values])


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    from .ranking import first_of

    return first_of(df, [F.col(k) for k in keys], order)


def changes(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """key, side (both, only_before, only_after), and of each column the two values."""
    a = before.select(F.col(key), *[F.col(c).alias(f"{c}_before") for c in columns], F.lit(1).alias("__a"))
    b = after.select(F.col(key), *[F.col(c).alias(f"{c}_after") for c in columns], F.lit(1).alias("__b"))
    side = F.when(F.col("__a").isNull(), "only_after").when(F.col("__b").isNull(), "only_before").otherwise("both")
    return a.join(b, key, "full_outer").select(key, side.alias("side"), *[f"{c}_{s}" for c in columns for s in ("before", "after")])


def insert_ignore(table: DataFrame, new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """``table`` and the new rows whose key it does not hold, the first of each key."""
    from .ranking import first_of

    fresh = first_of(new, [F.col(k) for k in keys], order).join(table.select(*keys), keys, "left_anti")
    return table.unionByName(fresh.select(*table.columns))


def upsert(table: DataFrame, new: DataFrame, keys: list[str], keep_old: Column | None = None) -> DataFrame:
    """New rows replace those of their key. Where ``keep_old``, on columns old.* and new.*, holds, the old row stays."""
    if keep_old is None:
        return table.join(new.select(*keys), keys, "left_anti").unionByName(new.select(*table.columns))
    rest = [c for c in table.columns if c not in keys]
    o, n = table.select(*keys, F.struct(*rest).alias("old")), new.select(*keys, F.struct(*rest).alias("new"))
    both = o.join(n, keys, "full_outer")
    pick = F.when(F.col("new").isNull() | (F.col("old").isNotNull() & F.coalesce(keep_old, F.lit(False))), F.col("old")).otherwise(F.col("new"))
    return both.select(*keys, pick.alias("row")).select(*keys, "row.*").select(*table.columns)


def failure_runs(df: DataFrame, partition: list[str], order: list[Column], failed: Column, threshold: int) -> DataFrame:
    """Rows with ``run`` (failures in a row up to here) and ``tripped`` (whether a run has reached the threshold here or before)."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("__island", F.sum(F.when(failed, 0).otherwise(1)).over(w))
    inside = Window.partitionBy(*partition, "__island").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("run", F.sum(F.when(failed, 1).otherwise(0)).over(inside).cast("int"))
    return df.withColumn("tripped", F.max("run").over(w) >= threshold).drop("__island")


def sittings(df: DataFrame, key: str, at: str, gap: str) -> DataFrame:
    """key, start, end and number of events of each stretch without a gap as long as ``gap``."""
    s = df.groupBy(key, F.session_window(at, gap).alias("s")).agg(F.count(F.lit(1)).alias("n_events"), F.max(at).alias("last"))
    return s.select(key, F.col("s.start").alias("start"), F.col("last").alias("end"), "n_events")
