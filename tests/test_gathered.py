"""Components of graphs with few nodes for their edges, and households without rounds over them."""

import random

import pyarrow as pa
import pytest

from kinveil.operators import components, households
from tests.test_components import label


def graph(seed):
    rng = random.Random(seed)
    edges = [(i, i + 1) for i in range(300, 340)] + [(1000, i) for i in range(60)] + [(5, 5), (None, 1), (7000, 7001)]
    edges += [(rng.randrange(400, 440), rng.randrange(400, 440)) for _ in range(500)]
    rng.shuffle(edges)
    return edges


@pytest.mark.parametrize("at_once", [1 << 20, 150, 40])
def test_forests(spark, monkeypatch, at_once):
    """150 takes several passes, with 40 the forest doesn't shrink and goes on in rounds."""
    monkeypatch.setattr(components, "AT_ONCE", at_once)
    got = components.gathered(spark.createDataFrame(graph(at_once), "a long, b long").repartition(5)).collect()
    assert len(got) == len({r.node for r in got}) and {r.node: r.component for r in got} == label(graph(at_once))
    assert components.gathered(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_task_holds_few_edges(monkeypatch):
    monkeypatch.setattr(components, "AT_ONCE", 30)
    edges = [e for e in graph(1) if None not in e]
    batches = [pa.RecordBatch.from_pydict({"a": [a for a, _ in edges[i : i + 10]], "b": [b for _, b in edges[i : i + 10]]}) for i in range(0, len(edges), 10)]
    out = list(components._forest(iter(batches)))
    left = [e for b in out for e in zip(*(c.to_pylist() for c in b.columns))]
    assert len(out) > 1 and len(left) < len(edges) and label(left) == label(edges)


def test_households_need_no_rounds(spark, monkeypatch):
    """900,000 people spent a third of the time in rounds of written tables over their kinds."""

    def rounds(*_):
        raise AssertionError("rounds of stars")

    monkeypatch.setattr(households, "components", rounds)
    columns = "position long, record_id string, family_name string, phone_number string, household_street_address string, household_zip string"
    rows = [(i, f"P{i}", "KIM", f"555010000{i % 3}", "5 OAK ST" if i % 4 else "", "1") for i in range(12)]
    found = households.households(spark.createDataFrame(rows, columns)).collect()
    assert sorted(r.members for r in found) == [[0], [1, 2, 3, 5, 6, 7, 9, 10, 11], [4], [8]]
    assert [r.household_position for r in sorted(found, key=lambda r: r.members)] == [0, 1, 2, 3]
