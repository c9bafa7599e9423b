"""Feeds, sitemaps, pages, encodings and sinks on small files."""

from datetime import datetime

from pyspark.sql import functions as F

from galley.sources import feeds, sinks

RSS = """<?xml version="1.0"?><rss xmlns:content="http://c" xmlns:dc="http://d"><channel><title>Feed</title>
<item><title>One</title><link>https://a.example/1</link><guid>g1</guid><description>short</description><content:encoded><![CDATA[<p>long</p>]]></content:encoded><dc:creator>Ann</dc:creator><pubDate>Tue, 02 Jan 2024 10:00:00 GMT</pubDate></item>
<item><guid>https://a.example/2</guid><description>two</description></item>
<item><title>lost</title><guid>no-address</guid></item></channel></rss>"""
SITEMAP = """<?xml version="1.0"?><urlset xmlns:news="http://n"><url><loc>https://a.example/1</loc><news:news><news:title>T</news:title><news:publication_date>2024-01-02</news:publication_date></news:news></url>
<url><loc>https://a.example/2</loc><lastmod>2024-01-03</lastmod></url><url><loc>nonsense</loc><news:news><news:title>T</news:title></news:news></url></urlset>"""


def test_rss(spark, tmp_path):
    (tmp_path / "a.xml").write_text(RSS)
    rows = {r.item_guid: r for r in feeds.rss_items(spark, str(tmp_path)).collect()}
    assert set(rows) == {"g1", "https://a.example/2"}
    assert rows["g1"].body == "<p>long</p>" and rows["g1"].author == "Ann" and rows["g1"].published_at.startswith("Tue")
    assert rows["https://a.example/2"].title == "(no title)" and rows["https://a.example/2"].original_url == "https://a.example/2"


def test_sitemap(spark, tmp_path):
    (tmp_path / "s.xml").write_text(SITEMAP)
    assert [tuple(r) for r in feeds.sitemap_entries(spark, str(tmp_path)).collect()] == [("https://a.example/1", "T", "2024-01-02")]
    x = spark.createDataFrame([("<sitemapindex xmlns='x'>",), ("<urlset>",)], "x string").select(feeds.is_sitemap_index("x")).collect()
    assert [r[0] for r in x] == [True, False]


def test_bytes():
    t = "déjà vu à Orléans — ça va " * 20
    assert feeds.decode_bytes(t.encode(), None) == t
    assert feeds.decode_bytes(t.encode("cp1252"), "text/html; charset=windows-1252") == t
    assert feeds.decode_bytes(t.encode("cp1252"), None) == t
    assert feeds.decode_bytes(b'<?xml version="1.0" encoding="koi8-r"?>' + "Городской совет".encode("koi8-r")).endswith("Городской совет")
    assert feeds.decode_bytes(None) is None and feeds.decode_bytes(b"", "charset=nonsense") == ""


def test_decoded_column(spark):
    rows = spark.createDataFrame([(1, bytearray("é".encode()), None), (2, None, None)], "id int, data binary, header string")
    assert [r.text for r in feeds.decoded(rows, "data", "header").orderBy("id").collect()] == ["é", None]


def test_main_text(spark):
    page = "<html><head><title>T</title><script>x</script></head><body><nav><p>menu</p></nav><article><h1>Head</h1><p>One&nbsp;two<br>three</p><figure><p>no</p></figure></article><footer><p>foot</p></footer></body></html>"
    assert feeds.main_text(page) == ("T", "Head\n\nOne two\nthree")
    assert feeds.main_text("<p>short</p>") == (None, "") and feeds.main_text(None) == (None, "")
    rows = spark.createDataFrame([(1, page), (2, None)], "id int, html string")
    assert [r.text for r in feeds.extracted(rows, "id", "html").orderBy("id").collect()] == ["Head\n\nOne two\nthree", ""]


def test_age_window_and_paths(spark):
    now = F.lit(datetime(2026, 8, 29, 12))
    rows = spark.createDataFrame([(1, "https://a.example/x", datetime(2026, 8, 28, 12)), (2, "https://a.example/x", datetime(2026, 8, 28, 11, 59)), (3, "https://a.example/news//", None), (4, "https://a.example/x", None), (5, "no address", None)], "id int, url string, at timestamp")
    assert [r.id for r in feeds.admitted(rows, "at", "url", 24, now, ["/news"]).orderBy("id").collect()] == [1, 4, 5]
    assert feeds.admitted(rows, "at", "url", 0, now, []).count() == 5


def test_sources_from_json(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"name": "A", "track": "sports"}\n{"name": "B", "type": "wire", "track": "analysis"}\n')
    assert [(r.name, r.type, r.track) for r in feeds.source_dimension(spark, str(tmp_path)).orderBy("name").collect()] == [("A", "journalism", "news"), ("B", "wire", "analysis")]


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.append(spark.createDataFrame([(1, "a"), (2, "b")], "n int, d string"), path, ["d"])
    sinks.replace_partitions(spark.createDataFrame([(3, "b")], "n int, d string"), path, ["d"])
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [1, 3]
    kept = sinks.retained(spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 2, 1)), (3, None)], "n int, at timestamp"), "at", F.lit(datetime(2024, 2, 10)), 30)
    assert sorted(r.n for r in kept.collect()) == [2, 3]
    assert spark.read.parquet(sinks.new_generation(kept, str(tmp_path))).count() == 2
    sinks.export_tsv(kept.select("n"), str(tmp_path / "e"))
    assert sinks.read_tsv(spark, str(tmp_path / "e"), "n int").count() == 2
