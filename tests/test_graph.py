"""Connected components on small graphs."""

import pytest

from galley.operators.graph import components


def _edges(spark, pairs):
    return spark.createDataFrame(pairs, "a bigint, b bigint")


def test_components_of_a_chain_and_a_star(spark):
    chain, star = [(i, i + 1) for i in range(40)], [(100, 100 + i) for i in range(1, 30)]
    got = {r.node: r.component for r in components(_edges(spark, chain + star)).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}


def test_an_unsettled_graph_is_an_error(spark):
    with pytest.raises(RuntimeError, match="not settled"):
        components(_edges(spark, [(i, i + 1) for i in range(40)]), max_rounds=2)
