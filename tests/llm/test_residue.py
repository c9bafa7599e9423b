"""p5: held-out hosts, placeholders and the cases that are none."""

import random

import pytest

from galley.llm import residue as r

SUBJECTS = "council mayor committee harbour library court guild museum bank clinic".split()
VERBS = "approved rejected delayed funded closed opened reviewed expanded".split()
ERRORS = ["Page not found", "The server returned code {}", "Please enable JavaScript to read this page", "Try again in {} minutes", "Access denied", "Your session has expired, log in again", "Check the address you typed", "Too many requests, error {}"]
FILLER = ["Lorem ipsum dolor sit amet", "Body text goes here", "This is placeholder copy", "Dummy text dummy text", "Second paragraph to come"]
NAMES = ["headline", "BYLINE_NAME", "story.title", "deck", "pub_date", "article_body", "0"]
FORMS = ["{{{{ {} }}}}", "${{{}}}", "[[{}]]", "<%= {} %>", "%%{}%%", "[{}]", "__{}__"]


def _sentence(rng):
    a, b = rng.choice(SUBJECTS), rng.choice(SUBJECTS)
    return f"The {a} of {rng.choice(['Orvik', 'Lumane', 'Stenholm'])} {rng.choice(VERBS)} the plans of the {b} after {rng.randint(2, 900)} days of debate."


def _article(rng, n):
    return "\n\n".join(" ".join(_sentence(rng) for _ in range(3)) for _ in range(n))


def _page(rng):
    return rng.choice(["\n", ". ", "\n\n"]).join(rng.choice(ERRORS).format(rng.randint(400, 504)) for _ in range(rng.randint(1, 5)))


def _expression(rng):
    return rng.choice(FORMS).format(rng.choice(NAMES))


def _records(rng, n):
    """(host, http_status, title, text), is a case"""
    out = []
    for _ in range(n):
        host, x, title = f"h{rng.randrange(40)}.example", rng.random(), _sentence(rng)[:-1]
        if x < 0.08:
            page = _page(rng)
            out.append(((host, rng.choice([200, 404, 503]), rng.choice([title, page.split("\n")[0][:60]]), page), True))
        elif x < 0.12:
            out.append(((host, 200, title, "\n\n".join(rng.choice(FILLER) + "." for _ in range(rng.randint(2, 6)))), True))
        elif x < 0.17:
            out.append(((host, 200, title, f"{_expression(rng)}\n\n{_expression(rng)}\n\n{_article(rng, rng.randint(1, 4))}"), True))
        elif x < 0.2:
            out.append(((host, 200, _expression(rng), _article(rng, 4)), True))
        elif x < 0.26:
            extra = rng.choice(["Readers saw only the words “page not found” for 20 minutes, said the mayor.", "“They [the farmers] never asked for it,” said the mayor.", "The set {2, 45, 30} appears in the proof.", "For the map, please enable JavaScript.", "In the manual, `{{ town }}` stands for a town."])
            out.append(((host, 200, title, _article(rng, 4) + "\n\n" + extra), False))
        else:
            out.append(((host, 200, title, _article(rng, rng.randint(1, 6))), False))
    return out


@pytest.fixture(scope="module")
def fitted():
    return r.fit([x for x, _ in _records(random.Random(1), 1500)])


def test_unseen_hosts(fitted):
    judge, figures = fitted
    assert figures["held_out"] > 100 and figures["unlike_weak_label"] <= 0.03 * figures["held_out"]
    records = [(("new.example", *x[1:]), y) for x, y in _records(random.Random(2), 800)]
    got = [bool(judge.reasons(x[2], x[3])) for x, _ in records]
    truth = [y for _, y in records]
    hit = sum(g and t for g, t in zip(got, truth, strict=True))
    assert hit >= 0.95 * sum(truth) and hit >= 0.95 * sum(got)


def test_placeholders_in_prose_and_quoted(fitted):
    judge, article, title = fitted[0], _article(random.Random(3), 3), _sentence(random.Random(6))[:-1]
    assert judge.reasons(title, article.replace("of debate", "{{ story.title }} of debate", 1)) == ["placeholder"]
    assert judge.reasons(title, article + "\n\nShe explains that `{{ name }}` is swapped for a name when the page is built.") == []


def test_defined_cases(fitted, spark):
    judge = fitted[0]
    assert judge.reasons("Page not found", None) == judge.reasons("Page not found", "") == judge.reasons(None, " \n") == []
    assert judge.reasons(None, "Page not found. Try again in 5 minutes.") == ["text"]
    long = _article(random.Random(4), 2000)
    assert judge.reasons(None, long) == []
    rows = spark.createDataFrame([(1, None, "Page not found", 0), (1, None, "Page not found", 0), (2, "x", None, 0)], "id bigint, title string, text string, reasons int")
    assert [r_.id for r_ in r.excluded(rows, judge).collect()] == [1, 1]
    assert r.fit([])[0].reasons("Page not found", "Page not found") == []
