"""p6 against brute force over all pairs."""

import random

from galley.llm import near_duplicates as nd
from galley.runtime import written


def _edited(rng, ws, edits):
    """``ws`` with so many words replaced by ones that no other record holds."""
    out = list(ws)
    for i in rng.sample(range(len(ws)), edits):
        out[i] = f"own{rng.getrandbits(60)}"
    return out


def _records(rng, n, families):
    """n records (id, title, body): families of edited copies of the given sizes, then unrelated ones."""
    vocabulary = [f"w{i}" for i in range(3000)]
    bodies = []
    for size in families:
        base = [rng.choice(vocabulary) for _ in range(70)]
        bodies += [_edited(rng, base, rng.randint(1, 3)) for _ in range(size)]
    bodies += [[rng.choice(vocabulary) for _ in range(70)] for _ in range(n - len(bodies))]
    return [(i, None if i % 5 == 0 else "a title", " ".join(b)) for i, b in enumerate(bodies)]


def _brute(records):
    runs = {}
    for i, t, b in records:
        if b is None or len(nd.words(b)) < 30:
            continue
        w = nd.words(f"{t or ''} {b}".lower())
        runs[i] = set(zip(w, w[1:], w[2:]))
    ids = sorted(runs)
    return {(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if 2 * len(runs[a] & runs[b]) >= len(runs[a] | runs[b])}


def _pairs(spark, records):
    items = spark.createDataFrame(records, "id bigint, title string, body string")
    members, links = nd.classes_and_links(items, **nd.ASKED)
    return {tuple(r) for r in nd.pairs(written(members, "members"), links).collect()}


def test_family_above_any_share_of_the_records_keeps_its_links(spark):
    rng = random.Random(1)
    records = _records(rng, 300, [12])
    base = records[0][2].split(" ")
    records += [(1000 + i, None, " ".join(base)) for i in range(15)]  # exact copies, and edited versions of them
    records += [(2000 + i, None, " ".join(_edited(rng, base, 2))) for i in range(6)]
    want = _brute(records)
    assert len(want) > 200
    assert _pairs(spark, records) == want


def test_families_are_found_alike_in_small_and_large_inputs(spark):
    for n in (90, 600):
        records = _records(random.Random(n), n, [3, 10, n // 3])
        assert _pairs(spark, records) == _brute(records)
