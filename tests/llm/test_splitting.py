"""p10: limits, overlap, round trip, and cuts that an edit leaves where they were."""

import random

import pytest

from galley.llm.encoding import tokenizer
from galley.llm.splitting import Splitter, split

LIMITS = [(64, 8), (256, 32)]
WORDS = "harbour council voted against plans bridge library costs river spring report figures mayor audit".split()


def _prose(rng, sentences):
    out = []
    for i in range(sentences):
        s = " ".join(rng.choice(WORDS) for _ in range(rng.randint(5, 14)))
        out.append(s.capitalize() + ("." if i % 7 else ".\n\n"))
    return " ".join(out)


TEXTS = [
    _prose(random.Random(1), 150),
    "x" * 3000,
    "漢字かな" * 900,
    "".join(random.Random(2).choice("añé漢\U0001f600́ \r\n\t") for _ in range(2000)),
    "「会議は続く」と述べた。" * 200,
    "word " * 2000,
    "\n" * 500 + "end",
    "👩‍👩‍👧‍👦" * 300,
]


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_pieces_keep_to_limit_overlap_and_text(text):
    encode = tokenizer().encode_ordinary
    for (limit, overlap), pieces in zip(LIMITS, Splitter().pieces(text, LIMITS), strict=True):
        assert "".join(text[own:end] for _, own, end, *_ in pieces) == text
        for begin, own, end, n, kept, _ in pieces:
            assert n == len(encode(text[begin:end])) <= limit
            assert begin <= own < end
        for a, b in zip(pieces, pieces[1:]):
            assert b[1] == a[2]
            assert b[4] >= overlap or b[4] == 0 and len(encode(text[b[1] : b[1] + 1])) > 1


def test_prose_is_cut_at_sentences():
    for pieces in Splitter().pieces(TEXTS[0], LIMITS):
        assert {p[5] for p in pieces} <= {"sentence", "paragraph", "end"}


def test_an_edit_alters_only_pieces_near_it():
    rng = random.Random(5)
    altered = []
    for k in range(30):
        text = _prose(rng, 400)
        at = rng.randrange(len(text) // 4, len(text) // 2)
        old, new = (Splitter().pieces(t, LIMITS)[0] for t in (text, text[:at] + "an edit " + text[at:]))
        after = {e + 8 for _, _, e, *_ in old if e > at}
        same = {e for _, _, e, *_ in new}
        altered.append(len(after - same))
        assert {p[:3] for p in old if p[2] <= at - 200} <= {p[:3] for p in new}
    assert sorted(altered)[len(altered) // 2] <= 3
    assert max(altered) <= 20


def test_table_of_null_empty_repeated_and_short_texts(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "short", "x"), (3, "short", "x"), (4, TEXTS[0], "x")], "id bigint, text string, budget_name string")
    rows = split(docs, "id", "text", [("a", 64, 8)]).collect()
    assert sorted(r.id for r in rows if r.id < 4) == [3, 3]
    assert all(r.n_pieces == 1 and r.text == "short" for r in rows if r.id == 3)
    assert split(docs.limit(0), "id", "text", [("a", 64, 8)]).count() == 0
