"""Feeds, sitemaps and pages as tables.

Bytes become text by the declared encoding first, XML becomes rows by the built-in reader (one row an item), and pages become their main text
in Arrow batches. Nothing is fetched: addresses and bytes come from files or tables.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import col
from ..functions.urls import excluded_path, is_url

_DECLARED = re.compile(rb"""(?:<\?xml[^>]*?encoding|<meta[^>]*?charset)\s*=\s*["']?\s*([A-Za-z0-9_.:\-]+)""", re.I)
_LOST = "�"


def decode_bytes(data: bytes | None, header: str | None = None) -> str | None:
    """Bytes as text: by the header's charset, else the declared one, else UTF-8.

    Where that loses characters (five and more, one in 2,000), the declared charset and then windows-1252 are tried, unless their text looks wrongly read.
    """
    if data is None:
        return None
    m = _DECLARED.search(data[:2048])
    declared = m[1].decode("ascii") if m else None

    def read(charset: str | None) -> str | None:
        try:
            return data.decode(charset, "replace") if charset else None
        except LookupError:
            return None

    h = re.search(r"charset=[\"']?([\w.:-]+)", header or "", re.I)
    first = read(h[1] if h else None) or read(declared) or data.decode("utf-8", "replace")
    lost = first.count(_LOST)
    if lost >= 5 and lost * 2000 >= len(first):
        for other in (declared, "windows-1252"):
            text = read(other)
            if text and text.count(_LOST) < lost and len(re.findall("[ÃÂâ][\x80-¿€‚ƒ„…†‡ˆ‰Š‹Œ]", text)) * 200 < len(text):
                return text
    return first


def decoded(rows: DataFrame, data: str, header: str, out: str = "text") -> DataFrame:
    """``rows`` with the text of a binary column."""

    @F.pandas_udf("string")
    def text(d, h):
        return d.combine(h, lambda a, b: decode_bytes(bytes(a) if a is not None else None, b if isinstance(b, str) else None))

    return rows.withColumn(out, text(col(data), col(header)))


def rss_items(spark: SparkSession, path: str) -> DataFrame:
    """item_guid, original_url, title, body, author, published_at (as written) of the items of RSS files.

    The address is the link, else an identifier that is one; an item without either is left out. A missing title is "(no title)". Files that are no XML give no rows.
    """
    schema = "title string, link string, guid string, description string, `content:encoded` string, author string, `dc:creator` string, pubDate string, `dc:date` string"
    d = spark.read.format("xml").option("rowTag", "item").option("mode", "PERMISSIVE").option("ignoreNamespace", "false").schema(schema).load(path)
    url = F.coalesce(F.nullif(F.trim("link"), F.lit("")), F.when(F.col("guid").rlike("^https?://"), F.col("guid")))
    d = d.withColumn("original_url", url).where("original_url is not null")
    return d.select(
        F.coalesce("guid", "original_url").alias("item_guid"), "original_url", F.coalesce(F.nullif(F.trim("title"), F.lit("")), F.lit("(no title)")).alias("title"),
        F.coalesce(F.col("`content:encoded`"), F.col("description")).alias("body"), F.coalesce(F.col("`dc:creator`"), F.col("author")).alias("author"), F.coalesce("pubDate", "`dc:date`").alias("published_at"),
    )


def sitemap_entries(spark: SparkSession, path: str) -> DataFrame:
    """url, title, published_at (as written) of news sitemaps; entries without an address or title are left out."""
    schema = "loc string, lastmod string, `news:news` struct<`news:title`: string, `news:publication_date`: string>"
    d = spark.read.format("xml").option("rowTag", "url").option("ignoreNamespace", "false").schema(schema).load(path)
    d = d.select(F.trim("loc").alias("url"), F.trim(F.col("`news:news`.`news:title`")).alias("title"), F.coalesce(F.col("`news:news`.`news:publication_date`"), F.col("lastmod")).alias("published_at"))
    return d.where(is_url("url") & (F.col("title") != ""))


def is_sitemap_index(xml: Column | str) -> Column:
    return col(xml).rlike(r"(?is)<sitemapindex[\s>]")


def within_age(at: Column | str, hours: float, now: Column) -> Column:
    """Not older than so many hours, the limit included; no limit where hours are 0 or less; a null date stays."""
    return F.lit(True) if hours <= 0 else col(at).isNull() | (col(at) >= now - F.make_dt_interval(F.lit(0), F.lit(int(hours))))


def admitted(items: DataFrame, at: str, url: str, hours: float, now: Column, paths: list[str]) -> DataFrame:
    """Items within the age window whose path is not excluded."""
    return items.where(within_age(at, hours, now) & ~excluded_path(url, paths))


class _Main(HTMLParser):
    """Collects the paragraphs of article-like elements; falls back on nothing."""

    SKIP = {"script", "style", "noscript", "figure", "nav", "aside", "footer", "header", "form", "svg", "button"}
    HOME = {"article", "main"}
    BLOCK = {"p", "h1", "h2", "h3", "h4", "blockquote", "li", "pre"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.skip = self.home = self.block = 0
        self.parts: list[str] = []
        self.blocks: list[tuple[bool, str]] = []
        self.title, self.in_title = "", False

    def handle_starttag(self, tag, attrs):
        self.skip += tag in self.SKIP
        self.home += tag in self.HOME
        self.in_title |= tag == "title"
        if tag in self.BLOCK:
            self._close()
            self.block = 1
        if tag == "br":
            self.parts.append("\n")

    def handle_endtag(self, tag):
        if tag in self.BLOCK:
            self._close()
        self.skip -= tag in self.SKIP and self.skip > 0
        self.home -= tag in self.HOME and self.home > 0
        self.in_title &= tag != "title"

    def handle_data(self, data):
        if self.in_title:
            self.title += data
        elif self.block and not self.skip:
            self.parts.append(data)

    def _close(self):
        text = re.sub(r"[^\S\n]+", " ", "".join(self.parts)).strip()
        if text and not self.skip:
            self.blocks.append((self.home > 0, text))
        self.parts, self.block = [], 0


def main_text(html: str | None) -> tuple[str | None, str]:
    """(title, main text): the paragraphs inside article or main, else those of 80 characters and more if there are two; else an empty text."""
    p = _Main()
    try:
        p.feed(html or "")
        p.close()
    except Exception:
        return None, ""
    p._close()
    inside = [t for home, t in p.blocks if home]
    long = [t for _, t in p.blocks if len(t) >= 80]
    chosen = inside or (long if len(long) >= 2 else [])
    return p.title.strip() or None, "\n\n".join(chosen)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [main_text(h) for h in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.string())], names=["id", "title", "text"])


def extracted(pages: DataFrame, id_col: str, html: str) -> DataFrame:
    """id, title and main text of pages; a page without one has an empty text."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(html).alias("html"))
    return rows.mapInArrow(_extract, f"id {rows.schema['id'].dataType.simpleString()}, title string, text string")


def source_dimension(spark: SparkSession, path: str) -> DataFrame:
    """Sources from JSON lines: name, type, parent, group, track; an unknown track is news, a missing type journalism."""
    d = spark.read.schema("name string, type string, parent string, `group` string, track string, url string").json(path)
    return d.select("name", F.coalesce("type", F.lit("journalism")).alias("type"), "parent", "group", F.when(F.col("track").isin("news", "analysis"), F.col("track")).otherwise("news").alias("track"), "url")
