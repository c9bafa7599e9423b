"""Operators on small frames: the vectors of the reference's rules, order-dependent forms against brute force, nulls and hot keys."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from galley.functions import text as t
from galley.functions import urls as u
from galley.operators import history as h
from galley.operators import ranking as r
from galley.operators import replies as p
from galley.operators import vectors as v


def _one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "url, want",
    [
        ("https://amp.example.com/x", "https://www.example.com/x"),
        ("https://example.com/amp/x", "https://example.com/x"),
        ("https://example.com/x/amp", "https://example.com/x"),
        ("https://Example.com:443/x?utm_source=a&b=1#", "https://example.com/x?b=1"),
        ("http://example.com:80/x/", "http://example.com/x/"),
        ("https://redir.example/a/*https://b.example/y?ref=z", "https://b.example/y"),
        ("https://a.example/x?u=https://b.example/y", "https://a.example/x?u=https://b.example/y"),
        ("no address", "no address"),
        (None, None),
    ],
)
def test_canonical_url(spark, url, want):
    assert _one(spark, url, u.canonical_url) == want


def test_titles_and_texts(spark):
    assert _one(spark, "  A  Title ", t.normalize_title) == "a title"
    assert _one(spark, "What happened in the county court - apnews.com", t.clean_title) == "What happened in the county court"
    assert _one(spark, "Short - apnews.com", t.clean_title) == "Short - apnews.com"
    assert _one(spark, "What happened in the county - Willamette Week", t.clean_title) == "What happened in the county - Willamette Week"
    assert [_one(spark, x, t.ends_mid_sentence) for x in ("Done.", "Done.”", "not don", "more…", "", "終わり。", None)] == [False, False, True, True, False, False, None]
    assert _one(spark, "a s12 and C3, s12", t.references) == ["S12", "C3"]
    text = "First sentence here. Second one goes on.\n\nThird paragraph"
    assert _one(spark, text, lambda c: t.trim_to_boundary(c, 50)) == "First sentence here. Second one goes on."
    assert _one(spark, "word " * 30, lambda c: t.trim_to_boundary(c, 20)) == ("word " * 30)[:20]
    assert _one(spark, "<p>A &amp; B<br>C</p><script>x</script>", t.strip_html) == "A & B\nC"
    assert _one(spark, "<p> </p>", t.strip_html) is None


def test_host_of(spark):
    assert [_one(spark, x, u.host_of) for x in ("https://www.A.example:8080/x", "nonsense", "https://h/a b|c")] == ["a.example", "(unparseable)", "h"]


def test_rank_formula_and_tiers(spark):
    d = spark.createDataFrame([(80, 5), (90, 1), (90, 0)], "s int, n int").select(F.round(r.combined_score(F.col("s"), F.col("n")), 6)).collect()
    assert [x[0] for x in d] == [94.484941, 90.0, 90.0]
    caps = [None, 1, None, None, 2, None, None]
    d = spark.createDataFrame([(i, c) for i, c in enumerate(caps)], "i int, cap int")
    want = ["feature", "standard", "feature", "feature", "brief", "standard", "standard"]
    assert [x.tier for x in r.assign_tiers(d, [F.col("i")], F.col("cap"), (3, 3)).orderBy("i").collect()] == want
    assert [x.tier for x in r.assign_tiers(d.withColumn("g", F.lit(1)), [F.col("i")], F.col("cap"), (3, 3), partition=["g"]).orderBy("i").collect()] == want


def test_tiers_against_the_greedy_rule(spark):
    rng = random.Random(1)
    rows, want = [], {}
    for g in range(30):
        caps = [rng.choice([0, 0, 1, 2, None]) for _ in range(rng.randint(0, 12))]
        f, s = 3, 2
        for i, c in enumerate(caps):
            rows.append((g, i, c))
            tier = "feature" if not c and f else "standard" if (c or 0) <= 1 and s else "brief"
            f -= tier == "feature"
            s -= tier == "standard"
            want[g, i] = tier
    d = r.assign_tiers(spark.createDataFrame(rows, "g int, i int, cap int"), [F.col("i")], F.col("cap"), (3, 2), partition=["g"])
    assert {(x.g, x.i): x.tier for x in d.collect()} == want


def test_ranks_over_all_tasks(spark):
    rows = [(i, (i * 7919) % 1000) for i in range(1000)]
    d = r.ranked(spark.createDataFrame(rows, "id int, s int"), [F.col("s").desc(), F.col("id")])
    assert all(x["rank"] == 1000 - x.s for x in d.collect())


def test_water_fill(spark):
    def fill(lengths, total, floor, per):
        d = spark.createDataFrame([(1, i, n) for i, n in enumerate(lengths)], "g int, i int, n bigint")
        return [x.granted for x in r.water_fill(d, ["g"], [F.col("i")], F.col("n"), total=total, floor=floor, per_item=per).orderBy("i").collect()]

    assert fill([100, 100, 30000], None, 0, 0) == [100, 100, 30000]
    got = fill([9892] * 5, 12000, 800, 4000)
    assert sum(got) == 12000 and max(got) <= 4000
    assert sum(fill([500, 500], 100, 300, 400)) == 600  # floors may exceed a small total


def _sequential(items):
    """The rule as written: in order, with the winner known under the keys of what it absorbs."""
    urls, titles, out = {}, {}, {}
    for i, url, title in items:
        long = title is not None and len(title) >= 30
        win = urls.get(url) if url is not None else None
        if win is None and long:
            win = titles.get(title)
        win = i if win is None else win
        out[i] = win
        if url is not None:
            urls[url] = win
        if long:
            titles[title] = win
    return out


def test_absorb_within_is_the_sequential_rule(spark):
    rng = random.Random(5)
    start, rows, want = datetime(2024, 1, 1), [], {}
    for parent in [None, *range(1, 41)]:
        items = []
        for _ in range(rng.randint(1, 12) if parent else 60):
            i = len(rows)
            url = rng.choice([None, *[f"u{k}" for k in range(4)]])
            title = rng.choice([None, "short", *["long title " * 3 + str(k) for k in range(3)]])
            at = start + timedelta(hours=rng.randint(0, 200))
            rows.append((i, url, title, at, str(parent) if parent else None))
            items.append((at, i, url, title))
        want |= _sequential([x[1:] for x in sorted(items, key=lambda x: x[:2])])
    got = h.absorb_within(spark.createDataFrame(rows, "id bigint, url string, title_key string, ord timestamp, parent string"), "parent").collect()
    assert {x.id: x.winner for x in got} == want
    assert all(x.kept == (x.id == x.winner) for x in got)


def test_unknown_to(spark):
    schema = "id int, source string, parent string, url string, title string"
    old = spark.createDataFrame([(1, "a", "P", "u1", "t" * 30), (2, "b", None, None, "short")], schema)
    new = spark.createDataFrame([(10, "a", "P", "u1", None), (11, "c", "P", "u1", None), (12, "c", "Q", "u1", None), (13, "z", "Z", "u9", "t" * 30), (14, "b", None, None, "short"), (15, None, None, None, None)], schema)
    assert sorted(x.id for x in h.unknown_to(new, old, "id", "source", "parent", "url", "title").collect()) == [12, 14, 15]


def test_upserts(spark):
    a = spark.createDataFrame([(1, "ok"), (2, "skipped")], "k int, status string")
    b = spark.createDataFrame([(1, "skipped"), (2, "ok"), (3, "skipped")], "k int, status string")
    keep = (F.col("new.status") == "skipped") & (F.col("old.status") != "skipped")
    assert {x.k: x.status for x in h.upsert(a, b, ["k"], keep).collect()} == {1: "ok", 2: "ok", 3: "skipped"}
    assert {x.k: x.status for x in h.upsert(a, b, ["k"]).collect()} == {1: "skipped", 2: "ok", 3: "skipped"}


def test_similar_pairs_against_all_pairs(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    x = rng.normal(size=(150, 6))
    x[50:100] = x[0] + rng.normal(scale=0.1, size=(50, 6))  # a hot cell
    x[100] = 0
    rows = [(i, q.tolist()) for i, q in enumerate(x)]
    n = np.linalg.norm(x, axis=1)
    with np.errstate(invalid="ignore"):
        c = x @ x.T / n[:, None] / n[None]
    want = {(i, j) for i in range(150) for j in range(i + 1, 150) if c[i, j] >= 0.8}
    d = spark.createDataFrame(rows, "id bigint, v array<double>")
    assert {(q.a, q.b) for q in v.similar_pairs(d, 0.8, pivots=8).collect()} == want
    between = {(q.a, q.b) for q in v.similar_pairs(d.where("id < 20"), 0.8, d.where("id >= 20"), pivots=4).collect()}
    assert between == {(i, j) for i, j in want if i < 20 <= j}
    assert v.similar_pairs(d.limit(0), 0.8).count() == 0


def _copied(spark, n=40, copies=9):
    """(id, v) with ids that go round and round over the vectors, and all cosines."""
    import numpy as np

    x = np.random.default_rng(5).normal(size=(n, 6))
    x[7] = 0
    x = np.concatenate([x] * copies + [x[:1]] * 60 + [np.random.default_rng(6).normal(size=(20, 6))])
    m = np.linalg.norm(x, axis=1)
    with np.errstate(invalid="ignore"):
        c = x @ x.T / m[:, None] / m[None]
    return spark.createDataFrame([(i, q.tolist()) for i, q in enumerate(x)], "id bigint, v array<double>"), c


def test_similar_pairs_compare_copies_once(spark):
    d, c = _copied(spark)
    want = sorted((i, j) for i in range(len(c)) for j in range(i + 1, len(c)) if c[i, j] >= 0.7)
    assert sorted((q.a, q.b) for q in v.similar_pairs(d, 0.7).collect()) == want
    members = v.classes(d)
    assert members.where("v is not null").count() == 59
    # what is compared follows the vectors and not their copies
    met = v.class_pairs(members, 0.7)
    assert met.count() < len(want) / 30 and met.count() == met.select("x", "y").distinct().count()


def test_groups_meet_whatever_their_number(spark, monkeypatch):
    d, c = _copied(spark)
    want = sorted((i, j) for i in range(len(c)) for j in range(i + 1, len(c)) if c[i, j] >= 0.7)
    monkeypatch.setattr(v, "HELD", 700)  # five groups
    assert sorted((q.a, q.b) for q in v.similar_pairs(d, 0.7, pivots=3).collect()) == want
    between = sorted((q.a, q.b) for q in v.similar_pairs(d.where("id % 3 = 0"), 0.7, d.where("id % 3 > 0")).collect())
    assert between == sorted((i, j) if i % 3 == 0 else (j, i) for i, j in want if (i % 3 == 0) != (j % 3 == 0))


def test_vectors_of_single_precision_and_no_number(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, [float("nan"), 1.0]), (5, None)]
    d = spark.createDataFrame(rows, "id bigint, v array<float>")
    assert sorted((q.a, q.b) for q in v.similar_pairs(d, 0.5).collect()) == [(1, 2), (1, 4), (2, 4), (3, 4)]


@pytest.mark.parametrize("k", [1, 5])
def test_nearest_later_rows_among_copies(spark, k):
    d, c = _copied(spark)
    # copies of one vector are equally near, whatever the last digit
    want = {(i, j) for i in range(len(c)) for j in sorted((j for j in range(i + 1, len(c)) if c[i, j] >= 0.7), key=lambda j: (-round(c[i, j], 9), j))[:k]}
    got = [(q.a, q.b) for q in v.nearest_later(d, 0.7, k).collect()]
    assert len(got) == len(want) and set(got) == want


def test_linked_rows_are_those_of_similar_pairs(spark):
    d, _ = _copied(spark)
    one, other = (sorted(map(tuple, v.groups_of(e).collect())) for e in (v.linked(d, 0.8), v.similar_pairs(d, 0.8).select("a", "b")))
    assert one == other and len({q[1] for q in one}) > 5


def test_best_of_labels_against_all_rows(spark):
    d, c = _copied(spark)
    n, label = len(c), lambda i: (i * 7 + i // 40) % 11
    labels = spark.createDataFrame([(i, label(i)) for i in range(n) if i % 2], "node bigint, component bigint")
    want = {}
    for i in range(0, n, 2):
        best = {}
        for j in range(1, n, 2):
            if c[i, j] >= 0.6:
                best[label(j)] = max(best.get(label(j), -1), round(c[i, j], 6))
        if best:
            want[i] = min(best, key=lambda g: (-best[g], g))
    got = v.best_of_labels(d.where("id % 2 = 0"), d.where("id % 2 = 1"), labels, 0.6).collect()
    assert {q.a: q.component for q in got} == want and len(got) == len(want)


def test_cohesion(spark):
    def density(edges):
        e = spark.createDataFrame(edges, "a bigint, b bigint")
        return round(v.cohesion(e, v.components(e), 5).first().density, 6)

    assert density([(1, 2), (2, 3), (1, 3)]) == 1
    assert density([(1, 2), (2, 3)]) == 0.666667
    assert density([(1, 2), (2, 3), (3, 4), (4, 5)]) == 0.4


def test_claims(spark):
    valid = spark.createDataFrame([(1, 4), (2, 4), (3, 4)], "reply int, n int")
    replies = spark.createDataFrame([(1, "1,2,99\n0,3,4"), (2, "1,2,3\n3,4"), (3, "1\n1,2\nnone\n2,3,4")], "reply int, raw string")
    got = {(x.reply, x.pos, x.member) for x in p.split_lines(replies, valid).collect()}
    assert got == {(1, 0, 1), (1, 0, 2), (1, 1, 3), (1, 1, 4), (2, 0, 1), (2, 0, 2), (2, 0, 3), (3, 1, 1), (3, 1, 2), (3, 3, 3), (3, 3, 4)}


def test_threads(spark):
    valid = spark.createDataFrame([(1, "S1"), (1, "S2"), (1, "C3"), (1, "S4")], "reply int, member string")
    replies = spark.createDataFrame([(1, "One;;s1;;sum;;s2, c9\nTwo;;S2;;sum;;C3\nThree;;C3;;sum;;S4")], "reply int, raw string")
    got = {(x.title, x.member) for x in p.threads(replies, valid).collect()}
    assert got == {("One", "S1"), ("One", "S2"), ("Three", "C3"), ("Three", "S4")}


def test_verdicts(spark):
    replies = spark.createDataFrame([(1, "1;;cut;;old\n2;;opinion;;view; of\n2;;cut;;again\n3;;maybe;;?\n4;;news;;\n99;;cut;;x\ntalk")], "reply int, raw string")
    expected = spark.createDataFrame([(1, i) for i in range(1, 6)], "reply int, id bigint")
    got = {x.id: (x.keep, x.kind, x.missing) for x in p.verdicts(replies, expected).collect()}
    assert got == {1: (False, "news", False), 2: (True, "opinion", False), 3: (True, "news", False), 4: (True, "news", True), 5: (True, "news", True)}


def test_as_of_and_failure_runs(spark):
    left = spark.createDataFrame([("a", 1), ("a", 5), ("b", 5)], "k string, at int")
    right = spark.createDataFrame([("a", 2, "x"), ("a", 5, "y"), ("b", 6, "z")], "k string, since int, val string")
    assert {(x.k, x.at): x.val for x in h.as_of(left, right, "k", "at", "since", ["val"]).collect()} == {("a", 1): None, ("a", 5): "y", ("b", 5): None}
    d = spark.createDataFrame([("a", i, f) for i, f in enumerate([True, True, False, True])], "k string, i int, f boolean")
    assert [(x.run, x.tripped) for x in h.failure_runs(d, ["k"], [F.col("i")], F.col("f"), 2).orderBy("i").collect()] == [(1, False), (2, True), (0, True), (1, True)]


def test_records_without_news(spark):
    from galley.plans.texts import junk_reason

    rows = [
        ("Explore calendar May 30-June", None, "event-calendar"), ("Photos of the week", None, "photo-gallery"), ("Things to do this weekend", None, "events-listing"), ("A title", "This member-supported station. Donate today.", "house-ad"),
        ("A title", "Donate today. " + "x" * 400, None), ("August 10, 2026", None, "link-dump-digest"), ("10 August 2026", None, "link-dump-digest"), ("A title", "A curated weekday guide to the news", "link-dump-digest"), ("August 10 vote", None, None), (None, None, None),
    ]
    d = spark.createDataFrame(rows, "t string, b string, want string").select("want", junk_reason(F.col("t"), F.col("b")).alias("got"))
    assert all(x.want == x.got for x in d.collect())


def test_tokens_and_resolution(spark):
    import base64

    def token(url):
        inner = b"\x08\x01" + b"\x12" + bytes([len(url)]) + url.encode()
        return base64.urlsafe_b64encode(b"\x22" + bytes([len(inner)]) + inner).decode().rstrip("=")

    assert u.token_url(token("https://a.example/story")) == "https://a.example/story"
    assert u.token_url(token("https://feed.example/x"), "feed.example") is None
    assert u.token_url("!!") is None and u.token_url("") is None and u.token_url(None) is None and u.token_url("AAAA") is None
    page = "see https://feed.example/a and https://b.example/ then https://b.example/story.html"
    rows = [(token("https://a.example/story"), None, None), (token("https://feed.example/x"), "https://c.example/z", page), (None, "https://c.example/", page), (None, None, None)]
    d = spark.createDataFrame(rows, "t string, r string, p string").select(u.resolved("t", "r", "p", "feed.example").alias("x"))
    assert [x.x for x in d.collect()] == ["https://a.example/story", "https://c.example/z", "https://b.example/story.html", None]
