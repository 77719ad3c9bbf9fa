"""Connected components with hubs, chains and noise, against union by loops."""

import random

import pytest

from kinveil.operators import skew
from kinveil.operators.components import components


def label(edges):
    of = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            of[a], of[b] = of.get(a, a), of.get(b, b)
    moved = True
    while moved:
        moved = False
        for a, b in edges:
            if a in of and b in of and of[a] != of[b]:
                of[a] = of[b] = min(of[a], of[b])
                moved = True
    return of


@pytest.mark.parametrize("share", [256, 4])
def test_hubs_and_chains(spark, monkeypatch, share):
    """With a share of 4 nearly every hub is hot."""
    monkeypatch.setattr(skew, "SHARE", share)
    rng = random.Random(share)
    edges = [(1000, i) for i in range(300)] + [(2000 + i, 9999) for i in range(200)] + [(i, i + 1) for i in range(3000, 3040)]
    edges += [(rng.randrange(4000, 4100), rng.randrange(4000, 4100)) for _ in range(60)] + [(5, 5), (None, 1), (7000, 7001)]
    rng.shuffle(edges)
    got = components(spark.createDataFrame(edges, "a long, b long").repartition(3)).collect()
    assert len(got) == len({r.node for r in got}) and {r.node: r.component for r in got} == label(edges)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
