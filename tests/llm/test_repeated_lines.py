"""p1: against brute force, and republished articles."""

import random
import re
from collections import Counter, defaultdict

from galley.llm import repeated_lines as rl

FURNITURE = ["Read more on our site", "Share  this\tstory", "Copyright 2024", "copyright 2025 "]
SCHEMA = "article_id bigint, source_name string, text string, published_at timestamp, clean_text string"


def _key(line):
    return re.sub(r"[0-9]+", "0", re.sub(r"[ \t]+", " ", line.lower()).strip("\xa0 \t\r\n\f\v"))


def _rows(rng, n):
    from datetime import datetime

    out = []
    for i in range(n):
        lines = [f"Own line {rng.getrandbits(40):x} {'abc'[i % 3]}" for _ in range(rng.randint(0, 5))]
        for f in FURNITURE:
            if rng.random() < 0.3:
                lines.insert(rng.randint(0, len(lines)), f)
        lines.insert(rng.randint(0, len(lines)), "")
        text = rng.choice([None, ""]) if rng.random() < 0.05 else "\n".join(lines)
        out.append((i, rng.choice(["a", "a", "b", None]), text, datetime(2024, 1, rng.randint(1, 5)) if rng.random() < 0.9 else None, "x"))
    return out + [(n + k, *rng.choice(out)[1:]) for k in range(n // 10)]


def _brute(rows):
    size, held = Counter(r[1] for r in rows), defaultdict(set)
    for i, source, text, *_ in rows:
        for line in (text or "").split("\n"):
            if _key(line):
                held[source, _key(line)].add(i)
    marked = {k for k, v in held.items() if len(v) >= 3 and len(v) >= 0.1 * size[k[0]]}
    return {(i, no) for i, source, text, *_ in rows for no, line in enumerate((text or "").split("\n")) if (source, _key(line)) in marked}


def _lines(docs):
    return rl.line_table(docs, "article_id", "source_name", "text", "published_at"), rl.source_sizes(docs, "source_name", "text")


def test_occurrences_against_brute_force(spark):
    rows = _rows(random.Random(1), 150)
    docs = spark.createDataFrame(rows, SCHEMA)
    lines, sizes = _lines(docs)
    assert {tuple(r) for r in rl.occurrences(lines, rl.repeated(lines, sizes, dates=False)).collect()} == _brute(rows)


def test_a_republished_article_keeps_its_lines_in_cleaning(spark):
    from datetime import datetime

    once = "First own line\nSecond own line\n\nRead more on our site"
    rows = [(i, "a", once, datetime(2024, 1, 1 + i), "") for i in range(4)]
    rows += [(10 + i, "a", f"Other {'xyzuvw'[i]}\n\n\nkept\n\nRead more on our site\n\n", datetime(2024, 2, 1 + i), "") for i in range(6)]
    docs = spark.createDataFrame(rows, SCHEMA)
    lines, sizes = _lines(docs)
    by_rows = {r.line_no for r in rl.occurrences(lines, rl.repeated(lines, sizes)).where("id = 0").collect()}
    assert by_rows == {0, 1, 3}
    out = rl.without(docs, rl.occurrences(lines, rl.repeated(lines, sizes, by="clusters")), "article_id", "text", "out")
    got = {r.article_id: r for r in out.collect()}
    assert got[0].out.startswith("First own line\nSecond own line") and "Read more" not in got[0].out
    # empty lines away from what was taken stay; "kept" is repeated over clusters and dates as well
    assert got[10].out == "Other x" and got[10].out_lines_removed == 2
    assert out.columns == [*docs.columns, "out", "out_lines_removed"]


def test_empty_lines_away_from_a_removal_stay(spark):
    docs = spark.createDataFrame([(1, "a", "one\n\n\ntwo\n\ncut\n\nthree", None, "")], SCHEMA)
    cut = spark.createDataFrame([(1, 5)], "id bigint, line_no int")
    assert rl.without(docs, cut, "article_id", "text", "out").first().out == "one\n\n\ntwo\n\nthree"


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    lines, sizes = _lines(docs)
    assert rl.occurrences(lines, rl.repeated(lines, sizes)).count() == 0
