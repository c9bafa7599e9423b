"""p4: restoring what wrong readings did, and leaving right text alone."""

import random

import pytest

from galley.llm import garbled as g

NAMES = ["Zoë", "Jürgen", "Søren", "Núñez", "São", "Ångström", "Čapek", "Lefèvre", "Müller", "Françoise"]
FRAMES = [
    "The council said “{} agreed” – the café paid £{} at {} °C.",
    "Die Behörde für Gewässer prüft mit {} die Straße über {} Brücken nach {} Jahren.",
    "L’été à Montréal, {} a présenté «un projet déjà prêt» de {} € après {} heures.",
    "El año pasado {} rechazó la reunión con {} señores de {} países: ¿y mañana?",
    "Городской совет и {} отложили решение о мосте на {} дней из {} возможных.",
    "市議会は{}の計画を{}日延期し、{}億円の予算を承認した。",
]


def _texts(rng, n):
    return [rng.choice(FRAMES).format(rng.choice(NAMES), rng.randint(2, 900), rng.randint(2, 99)) for _ in range(n)]


@pytest.fixture(scope="module")
def repairer():
    model, margins, info = g.fit(_texts(random.Random(1), 1500))
    assert info["false"] <= 2 and info["missed"] <= 0.1 * info["held_out_garbled"]
    return g.Repairer(model, margins)


def test_clean_texts_are_left_alone(repairer):
    texts = _texts(random.Random(2), 400)
    assert sum(map(repairer.garbled, texts)) <= 2
    for t in [None, "", "plain ASCII", "Is it so? Yes.", "caf&eacute; &#8220;x&#8221;", "see https://a.example/?q=é?b", "√2 × 3 – Notes", "où va Lumane ?"]:
        assert repairer.restored(t)[:2] == (t, False)


def test_wrong_readings_of_utf8_are_undone(repairer):
    rng, wrong = random.Random(3), 0
    for chain in [("utf-8", a) for a in ("cp1252", "latin-1", "mac_roman", "cp850", "cp1251")]:
        for twice in (False, True):
            for t in _texts(rng, 20):
                s = g.spoilt(t, chain, twice)
                if s is not None:
                    wrong += repairer.restored(s)[:3] != (t, True, False)
    assert wrong <= 10


def test_one_garbled_passage_in_a_long_text(repairer):
    t = " ".join(_texts(random.Random(4), 300))
    assert repairer.restored(t + " the cafÃ© of ZoÃ«")[0] == t + " the café of Zoë"


def test_another_alphabet_is_read_back(repairer):
    t = "Городской совет отложили решение"
    assert repairer.restored(t.encode("cp1251").decode("latin-1"))[0] == t
    assert repairer.restored(t.encode("koi8_r").decode("cp1251"))[0] == t


def test_lost_characters_are_found_and_not_invented(repairer):
    for s in ("Die Beh?rde f?r Gew?sser", "Die Beh�rde", "the caf? paid ?5", "?????? ???? ??"):
        text, found, lost, _ = repairer.restored(s)
        assert (text, found, lost) == (s, True, True)


def test_table(spark):
    rows = spark.createDataFrame([(1, "cafÃ©", None), (1, "cafÃ©", ""), (2, None, "ok")], "id bigint, title string, body string")
    model, margins, _ = g.fit(_texts(random.Random(1), 600))
    assert [tuple(r) for r in g.garbled(rows, "id", ["title", "body"], model, margins).collect()] == [(1, "title")] * 2
    assert [tuple(r) for r in g.garbled(rows, "id", ["title", "body"], model, margins, full=True).collect()] == [(1, "title", "café", False, "cp1252>utf-8")] * 2
    assert g.garbled(rows.limit(0), "id", ["title", "body"], *g.fit([])[:2]).count() == 0


def test_all_rows_are_counted_whole(spark):
    rng = random.Random(8)
    texts = [" ".join(_texts(rng, 40)) + f" Ort Nr. {i}: Żagań 🙂" * (i % 50 == 0) for i in range(400)]
    texts += [g.spoilt(t, ("utf-8", "cp1252")) or t for t in texts[:40]]
    rows = spark.createDataFrame(list(enumerate(texts)), "id bigint, body string").repartition(7)
    model, margins = g.trained(rows, ["body"])
    clean = g.Clean()
    clean.alphabet = g.ASCII.union(*map(clean.undoubted, texts))
    want = {}
    for t in texts:
        if clean(t) and not g.held_out(t):
            for x in g.styles(t):
                x = "\n\n\n" + x + "\n"
                for n in range(1, 5):
                    for i in range(4 - n, len(x) - n + 1):
                        want[x[i : i + n]] = want.get(x[i : i + n], 0) + 1
    assert model.counts == {k: v for k, v in want.items() if v > 1 or len(k) < 3}
    one = g.fit(texts)
    assert model.counts == one[0].counts and model.kinds == one[0].kinds and margins == pytest.approx(one[1], abs=0.02)
