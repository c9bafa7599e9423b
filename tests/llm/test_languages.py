"""p2: held-out accuracy of the network, mixed items, and the defined cases."""

import random

import numpy as np
import pytest

from galley.llm import languages as l

# a few words of each language, enough to write sentences with
WORDS = {
    "en": "the of and that was with for which council bridge after report voted against people their about would",
    "fr": "le la les des une dans pour avec qui été conseil pont après rapport voté contre leurs environ",
    "de": "der die das und nicht mit für von wurde eine rat nach bericht gegen ihre etwa über sich",
    "es": "el los las una con para que fue por consejo puente después informe votó contra sus unos desde",
    "pt": "o os as uma com para que foi pelo conselho ponte depois relatório votou contra seus não até",
    "it": "il gli le una con per che è stato consiglio ponte dopo rapporto votato contro loro circa dal",
    "nl": "de het een van met voor dat werd raad brug na verslag stemde tegen hun ongeveer niet over",
    "ru": "и в на не что это был для совет мост после доклад против около как его от они",
}


def _sentence(rng, lang, n=None):
    ws = [rng.choice(WORDS[lang].split()) for _ in range(n or rng.randint(6, 14))]
    if rng.random() < 0.5:
        ws[rng.randrange(1, len(ws))] = rng.choice(["Lumane", "Orvélie", "Stenström", "Talović"])
    return " ".join(ws).capitalize() + "."


def _text(rng, lang):
    return " ".join(_sentence(rng, lang) for _ in range(rng.randint(1, 6)))


@pytest.fixture(scope="module")
def fitted():
    rng = random.Random(1)
    rows = [(_text(rng, k), k, _sentence(rng, k)) for _ in range(60) for k in WORDS] + [("市議会は橋の計画を延期した。" * rng.randint(1, 4), "ja", None) for _ in range(60)]
    return l.fit(rows, max_windows=5000, epochs=5)


def test_held_out_accuracy(fitted):
    judge, figures = fitted
    assert figures["wrong_language"] <= 1 and figures["mixed_missed"] + figures["single_held_mixed"] <= 6
    rng = random.Random(2)
    langs = [k for k in WORDS for _ in range(30)]
    found = judge.items([None] * len(langs), [_text(rng, k) for k in langs])
    assert np.mean([f["languages"] == [k] for f, k in zip(found, langs, strict=True)]) > 0.97


def test_a_whole_foreign_sentence_makes_an_item_mixed_and_a_name_or_quoted_title_does_not(fitted):
    rng, judge = random.Random(3), fitted[0]
    mixed = whole = 0
    for _ in range(40):
        body = " ".join(_sentence(rng, "en") for _ in range(5))
        found = judge.items([None, None], [f"{body} {_sentence(rng, 'de', 12)}", f'{body} The report “{_sentence(rng, "de", 3)[:-1]}” was about the bridge and which people voted for. Orvélie, Talović.'])
        mixed += found[0]["languages"] == ["en", "de"]
        whole += found[1]["languages"] == ["en"]
    assert mixed >= 37 and whole >= 37


def test_segments_cover_the_text(fitted):
    rng = random.Random(4)
    body = " ".join(_sentence(rng, "fr") for _ in range(4)) + "\n\n" + " ".join(_sentence(rng, "ru") for _ in range(4))
    (found,) = fitted[0].items(["(no title)"], [body])
    assert [s[0] for s in found["segments"]] == ["body", "body"]
    assert "".join(body[s[1] : s[2]] for s in found["segments"]) == body
    assert [s[3] for s in found["segments"]] == ["fr", "ru"]


def test_labels():
    assert [l.label(x) for x in ("fr", "FR", "fr-CA", "fra", "es_ES", "eng", "und", "", None, " xx ")] == ["fr", "fr", "fr", "fr", "es", "en", None, None, None, "xx"]


def test_table(fitted, spark):
    rng = random.Random(5)
    long = " ".join(_sentence(rng, "it") for _ in range(1500))
    rows = spark.createDataFrame([(1, None, None, 1), (2, "", " ", 1), (3, None, long, 1), (3, None, long, 1), (4, "(no title)", None, 1)], "id bigint, title string, body string, lang int")
    got = {r.id: r for r in l.judged(rows, fitted[0]).collect()}
    assert got[1].lang is None and got[2].languages == [] and got[4].confidence == 0.0
    assert got[3].languages == ["it"] and got[3].confidence > 0.5
    assert l.judged(rows.limit(0), fitted[0], "segments").count() == 0


def test_all_documents_are_learned_from(spark, tmp_path, monkeypatch):
    rng = random.Random(6)
    monkeypatch.setattr(l, "TRAINING_WINDOWS", 3000)
    # more documents than the start takes, and longer ones than it takes of a text
    text = lambda k: " ".join(_sentence(rng, "en") for _ in range(60)) if k == "long" else _text(rng, k)
    rows = [(i, text(k), "en" if k == "long" else k, _sentence(rng, "en" if k == "long" else k)) for i, k in enumerate([*WORDS] * 40 + ["long"] * 20)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, title string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    items = [(i, r[3], r[1]) for i, r in enumerate(rows[:50])]
    spark.createDataFrame(items, "id bigint, title string, body_text string").write.parquet(str(tmp_path / "preprocessed_items.parquet"))
    judge, figures = l.trained(spark, str(tmp_path), training_rows=60)
    rest = [r for r in rows if not l.held_out(r[1])]
    step = l.Pass(l.Network(), [], np.ones(len(l.LANGUAGES)))
    least = sum(len(l.units_of(r[1], l.LANGUAGES.index(r[2]))) + 1 for r in rest)
    step.add([(r[1], l.LANGUAGES.index(r[2]), r[3]) for r in rest])
    assert figures["documents"] == len(rows) and figures["held_out"] == len(rows) - len(rest)
    assert figures["windows"] >= least and step.seen >= least and 0 < figures["learned"] < figures["windows"]
    assert figures["wrong_language"] <= 2
