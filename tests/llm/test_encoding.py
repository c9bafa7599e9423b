"""p8: chunk reuse gives the ids of the whole text."""

import random

import pytest

from galley.llm.encoding import ChunkEncoder, encoded, tokenizer

RNG = random.Random(3)
WORDS = "the of harbour council mañana déjà Straße 東京 город 1234 don't I'll ... \r\n \t   ​ 👩‍🔬 é".split(" ")
TEXTS = [
    "",
    "a",
    " ".join(RNG.choice(WORDS) for _ in range(4000)),
    "".join(RNG.choice(WORDS) for _ in range(4000)),
    "x" * 9000,
    " " * 5000 + "end" + "\n" * 4000,
    "漢" * 3000 + "字かな" * 1500,
    "!?" * 4000 + "'s" * 2000,
    "<|endoftext|> is ordinary text " * 50,
    "1" * 3000 + "a1" * 3000,
]


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_ids_are_those_of_the_whole_text(text):
    coder = ChunkEncoder()
    assert coder.ids(text) == tokenizer().encode_ordinary(text)
    assert coder.ids(text) == tokenizer().encode_ordinary(text)


def test_shared_passages_are_encoded_once_and_joins_repaired():
    coder = ChunkEncoder()
    passage = " ".join(RNG.choice(WORDS[:8]) for _ in range(3000))
    for i in range(5):
        text = f"intro {i} {passage} outro {i}"
        assert coder.ids(text) == tokenizer().encode_ordinary(text)
    assert coder.reused > 3 * coder.fresh / 2
    runs = "".join(RNG.choice("abcdefgh") for _ in range(30_000))
    assert coder.ids(runs) == tokenizer().encode_ordinary(runs)
    assert coder.repaired > 0


def test_table(spark):
    rows = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (3, TEXTS[2], "a"), (3, TEXTS[2], "a")], "doc_id bigint, text string, ids string")
    got = {r.doc_id: r.ids for r in encoded(rows, "doc_id", "text").collect()}
    assert got == {1: [], 2: [], 3: tokenizer().encode_ordinary(TEXTS[2])}
    assert encoded(rows.limit(0), "doc_id", "text").count() == 0
