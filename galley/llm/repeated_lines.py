"""Lines repeated across the documents of one source, and documents without them.

Documents of a source with the same text are one cluster with a weight (its rows) and its publication dates. Lines are counted
over clusters: ``n_clusters`` and ``n_dates`` by once each, ``n_rows`` by weight. p1_found asks for a share of rows; cleaning asks for
clusters and dates (``by="clusters"``), so that a republished article cannot make its own lines look repeated.

The texts are split once. Each line is written as (id, line_no, key of source and line, and the document's source, text and date as numbers), never as
text; all counts come from that table. Counts are taken with map-side partial aggregation, so a line that a third of all rows hold
costs one partial row per task. The repeated lines number at most 1/min_share times a source's lines per row, whatever the
number of rows; they are joined back on their key without a broadcast hint.

Defined cases: null and empty texts have no lines, their rows count in their source; a null source is a source of its own; a line that occurs
twice in one row counts once; empty lines never count; a null date is no date; extra columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import spread, table, written


def line_key(line: Column | str) -> Column:
    """The text under which lines are the same: lower case, single blanks, trimmed, digit runs as one sign."""
    blank = F.regexp_replace(F.lower(line), r"[ \t]+", " ")
    trimmed = F.regexp_replace(blank, r"^[\s ]+|[\s ]+$", "")
    return F.regexp_replace(trimmed, r"[0-9]+", "0")


def _hashed(*c: str) -> Column:
    """128 bits of some texts, for equality only; null is a value of its own."""
    parts = [F.coalesce(F.col(x), F.lit("\0")) for x in c]
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(7), *parts).alias("b"))


def line_table(docs: DataFrame, id_col: str, source: str, text: str, published: str) -> DataFrame:
    """One row per non-empty line: id, line_no (from 0), key, and of its document source_key, doc (the text) and day."""
    doc = docs.where(F.col(text).isNotNull()).select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(source), F.lit("\0")).alias("source"),
        F.xxhash64(F.coalesce(F.col(source), F.lit("\0"))).alias("source_key"),
        _hashed(text).alias("doc"),
        F.unix_date(F.to_date(F.col(published))).alias("day"),
        F.posexplode(F.split(F.col(text), "\n", -1)).alias("line_no", "line"),
    )
    keyed = doc.withColumn("line", line_key("line")).where(F.col("line") != "")
    return keyed.select("id", "line_no", _hashed("source", "line").alias("key"), "source_key", "doc", "day")


def source_sizes(docs: DataFrame, source: str, text: str) -> DataFrame:
    """source_key, source_rows, source_clusters."""
    base = docs.select(F.xxhash64(F.coalesce(F.col(source), F.lit("\0"))).alias("source_key"), _hashed(text).alias("doc"))
    each = base.groupBy("source_key", "doc").agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy("source_key").agg(F.sum("n").alias("source_rows"), F.count(F.lit(1)).alias("source_clusters"))


def repeated(lines: DataFrame, sizes: DataFrame, *, min_rows: int = 3, min_share: float = 0.1, by: str = "rows", dates: bool = True) -> DataFrame:
    """The repeated lines of each source: key, source_key, n_rows, n_clusters, share, and with ``dates`` n_dates."""
    member = lines.select("id", "source_key", "doc", "day").distinct()
    cluster = member.groupBy("source_key", "doc").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight"))
    # the lines of one document stand for all of its cluster
    held = lines.select("id", "key").join(cluster, "id").select("key", "source_key", "doc", "weight").distinct()
    often = held.groupBy("key").agg(F.first("source_key").alias("source_key"), F.sum("weight").alias("n_rows"), F.count(F.lit(1)).alias("n_clusters")).where(F.col("n_rows") >= min_rows)
    often = often.join(sizes, "source_key").where(F.col("n_rows") >= F.col("source_rows") * min_share)
    if by == "clusters":
        often = often.where((F.col("n_clusters") >= min_rows) & (F.col("n_clusters") >= F.col("source_clusters") * min_share))
    often = often.select("key", "source_key", "n_rows", "n_clusters", (F.col("n_rows") / F.col("source_rows")).alias("share"))
    if not (dates or by == "clusters"):
        return often
    often = written(often, "repeated")
    day = held.join(often.select("key"), "key", "left_semi").join(member.select("source_key", "doc", "day").distinct(), ["source_key", "doc"])
    n_dates = day.groupBy("key", "day").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(F.count("day").alias("n_dates"))
    out = often.join(n_dates, "key")
    return out.where("n_dates <> 1") if by == "clusters" else out


def occurrences(lines: DataFrame, marked: DataFrame) -> DataFrame:
    """Each occurrence of a marked line: id, line_no."""
    return lines.select("id", "line_no", "key").join(marked.select("key"), "key", "left_semi").select("id", "line_no")


def without(docs: DataFrame, cut: DataFrame, id_col: str, text: str, out: str) -> DataFrame:
    """``docs`` with the text less the lines (id, line_no) in ``out``, and the number of lines taken in ``<out>_lines_removed``.

    Where lines were taken, the empty lines around them become one, and none at either end; other empty lines stay. ``id_col`` must be unique.
    """
    cut = cut.groupBy("id").agg(F.collect_set("line_no").alias("__cut")).withColumnRenamed("id", "__id")
    joined = docs.join(cut, docs[id_col] == F.col("__id"), "left")
    # taken lines become a sign; a stretch is a run of them and of empty lines
    signed = F.array_join(F.transform(F.split(F.col(text), "\n", -1), lambda x, i: F.when(F.array_contains(F.col("__cut"), i), "\1").otherwise(F.replace(x, F.lit("\1"), F.lit("")))), "\n")
    more = r"(?:\n[ \t\x01]*(?=\n|\z))*"
    cleaned = F.regexp_replace(signed, rf"^(?:[ \t]*\n)*\x01{more}\n?", "")
    cleaned = F.regexp_replace(cleaned, rf"{more}\n\x01{more}\z", "")
    cleaned = F.regexp_replace(cleaned, r"(?<=[^\n\x01])\n\x01(?:\n\x01)*(?=\n[^\n])", "")
    cleaned = F.regexp_replace(cleaned, rf"(?<=\n)(?:[ \t]*\n)*\x01{more}", "")
    return joined.select(*[docs[f"`{c}`"] for c in docs.columns], F.when(F.col("__cut").isNull(), F.col(text)).otherwise(cleaned).alias(out), F.coalesce(F.size("__cut"), F.lit(0)).alias(f"{out}_lines_removed"))


def _packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "packet_articles")


def _lines(docs: DataFrame) -> DataFrame:
    return written(line_table(spread(docs), "article_id", "source_name", "text", "published_at"), "lines")


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p1_found: article_id and line_no of every repeated line."""
    docs = _packets(spark, sf_dir).select("article_id", "source_name", "text", "published_at")
    lines = _lines(docs)
    marked = repeated(lines, source_sizes(docs, "source_name", "text"), dates=False)
    return occurrences(lines, marked).select(F.col("id").alias("article_id"), "line_no")


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p1_lines: the repeated lines of each source with their counts over rows, clusters and dates."""
    docs = _packets(spark, sf_dir).select("article_id", "source_name", "text", "published_at")
    lines = _lines(docs)
    marked = written(repeated(lines, source_sizes(docs, "source_name", "text")), "marked")
    # their text is fetched once they are few: one occurrence each
    where = lines.join(marked.select("key"), "key", "left_semi").groupBy("key").agg(F.min(F.struct("id", "line_no")).alias("at"))
    text = docs.join(where.withColumn("article_id", F.col("at.id")), "article_id").select("key", "source_name", line_key(F.get(F.split("text", "\n", -1), F.col("at.line_no"))).alias("line"))
    return marked.join(text, "key").select("source_name", "line", "n_rows", "n_clusters", "n_dates", F.round("share", 6).alias("share"))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p1_cleaned: every article's text without the lines that many clusters of its source repeat on several dates."""
    docs = _packets(spark, sf_dir).select("article_id", "source_name", "text", "published_at")
    lines = _lines(docs)
    marked = repeated(lines, source_sizes(docs, "source_name", "text"), by="clusters")
    out = without(docs, occurrences(lines, marked), "article_id", "text", "clean_text")
    return out.select("article_id", "clean_text", F.col("clean_text_lines_removed").alias("lines_removed"))


QUERIES = {"p1_found": found, "p1_lines": report, "p1_cleaned": cleaned}

_LINES_SQL = r"""
with l as (
  select article_id, source_name, published_at, text, unnest(range(len(string_split(text, chr(10)))))::int as line_no, unnest(string_split(text, chr(10))) as line
  from packet_articles where text is not null
), k as (
  select *, regexp_replace(regexp_replace(regexp_replace(lower(line), '[ \t]+', ' ', 'g'), '^[\s\x{00a0}]+|[\s\x{00a0}]+$', '', 'g'), '[0-9]+', '0', 'g') as key from l
), n as (select source_name, count(*) as source_rows, count(distinct coalesce(text, chr(0))) as source_clusters from packet_articles group by 1
), r as (
  select k.source_name, key, count(distinct article_id) as n_rows, count(distinct md5(text)) as n_clusters, count(distinct cast(published_at at time zone 'UTC' as date)) as n_dates, any_value(source_rows) as source_rows, any_value(source_clusters) as source_clusters
  from k join n on k.source_name is not distinct from n.source_name where key <> '' group by 1, 2
  having count(distinct article_id) >= 3 and count(distinct article_id) >= 0.1 * any_value(source_rows)
)
"""
SQL = {
    "p1_found": _LINES_SQL + "select k.article_id, k.line_no from k join r on k.source_name is not distinct from r.source_name and k.key = r.key",
    "p1_lines": _LINES_SQL + "select source_name, key as line, n_rows, n_clusters, n_dates, round(n_rows / source_rows, 6) as share from r",
    "p1_cleaned": _LINES_SQL
    + """, m as (select * from r where n_clusters >= 3 and n_clusters >= 0.1 * source_clusters and n_dates <> 1),
  c as (select k.article_id, list(distinct k.line_no) as cut from k join m on k.source_name is not distinct from m.source_name and k.key = m.key group by 1),
  d as (select p.article_id, text, cut, unnest(string_split(text, chr(10))) as x, unnest(range(len(string_split(text, chr(10)))))::int as i from packet_articles p join c on p.article_id = c.article_id),
  e as (select *, list_contains(cut, i) as gone, trim(x, chr(32) || chr(9)) = '' as empty from d),
  f as (select *, sum((not gone and not empty)::int) over (partition by article_id order by i) as g from e),
  h as (select *, bool_or(gone) over (partition by article_id, g) as taken, max(g) over (partition by article_id) as last, row_number() over (partition by article_id, g, gone, empty order by i) as n from f),
  t as (select article_id, string_agg(case when empty and taken then '' else x end, chr(10) order by i) as body from h where not gone and (not empty or not taken or (n = 1 and g > 0 and g < last)) group by 1)
  select p.article_id, case when cut is null then text else coalesce(body, '') end as clean_text, coalesce(len(cut), 0)::int as lines_removed from packet_articles p left join c on p.article_id = c.article_id left join t on p.article_id = t.article_id""",
}
