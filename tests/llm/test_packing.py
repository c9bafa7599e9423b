"""p9: the plan against the items it places."""

import random
from collections import Counter

from galley.llm.packing import Plan, packed


def _rows(spark, sizes):
    return spark.createDataFrame(list(enumerate(sizes)), "item bigint, n_tokens int")


def _checked(rows, sizes, capacity):
    used, seen = Counter(), Counter()
    for r in rows:
        used[r.container_id] += r.n_tokens
        seen[r.item] += r.n_tokens
    assert max(used.values(), default=0) <= capacity
    assert seen == Counter({i: n or 0 for i, n in enumerate(sizes)})
    if used:
        assert set(used) == set(range(max(used) + 1))
    return len(used)


def test_exact_complements_are_filled_exactly(spark):
    sizes = [100] * 3 + [60, 40] * 50 + [50, 30, 20] * 40 + [25] * 80
    n = _checked(packed(_rows(spark, sizes), 100).collect(), sizes, 100)
    assert n == -(-sum(sizes) // 100)


def test_random_sizes_leave_little_room(spark):
    rng = random.Random(3)
    sizes = [min(3000, int(rng.lognormvariate(5, 1.2))) for _ in range(3000)] + [0, 0, None] + [77] * 1500
    n = _checked(packed(_rows(spark, sizes), 1024).collect(), sizes, 1024)
    assert n <= 1.01 * sum(s or 0 for s in sizes) / 1024 + 1


def test_only_items_above_the_capacity_are_cut(spark):
    rows = packed(_rows(spark, [10, 11, 35]), 10).collect()
    assert Counter(r.item for r in rows) == {0: 1, 1: 2, 2: 4}
    assert all(r.n_tokens == 10 for r in rows if r.item == 2 and r.piece_no < 3)


def test_empty_table_and_only_empty_items(spark):
    assert packed(_rows(spark, [1]).limit(0), 10).count() == 0
    assert [tuple(r) for r in packed(_rows(spark, [0, None]), 10).orderBy("item").collect()] == [(0, 0, 0, 0), (1, 0, 0, 0)]


def test_items_with_one_id_are_items_of_their_own(spark):
    rows = packed(spark.createDataFrame([(1, 6), (1, 6), (1, 4)], "item bigint, n_tokens int"), 10).collect()
    assert sorted(r.n_tokens for r in rows) == [4, 6, 6]


def test_the_plan_does_not_grow_with_the_number_of_items():
    rng = random.Random(4)
    counts = Counter(rng.randint(1, 1024) for _ in range(5000))
    small, large = Plan(dict(counts), 1024), Plan({k: 10**6 * v for k, v in counts.items()}, 1024)
    assert len(large.steps) < 5 * len(small.steps)
    placed = Counter()
    for length, _, n, _ in large.steps:
        placed[length] += n
    assert placed == {k: 10**6 * v for k, v in counts.items()}
