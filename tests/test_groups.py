"""Households from groups of kinds: few pairs are formed, and none that links two groups is missed."""

import random

from kinveil.functions.similarity import jaro_winkler
from kinveil.operators import blocking, households
from tests.test_components import label

COLUMNS = "position long, family_name string, phone_number string, household_street_address string, household_zip string"


def by_pairs(people, empty):
    found = label([tuple(r) for r in households.matches(people, empty_similarity=empty).collect()])
    return {r.position: found.get(r.position, r.position) for r in people.collect()}


def assigned(people, empty):
    return {r.position: r.household for r in households.assign(people, empty_similarity=empty).collect()}


def test_few_pairs_are_formed(spark, monkeypatch):
    """Two places of 60 phones each had 1,830 pairs each and 3,600 with each other; 60 times sf0.1 had some 36 million."""
    sizes, gathered = [], households.gathered
    monkeypatch.setattr(households, "gathered", lambda edges, *more: sizes.append(edges.count()) or gathered(edges, *more))
    rows = [(i, "KIM", f"55501000{i % 60:02}", "5 OAK ST" if i < 60 else "5 OAK STREET", "1") for i in range(120)]
    people = spark.createDataFrame(rows, COLUMNS)
    assert assigned(people, 0.0) == dict.fromkeys(range(120), 0)
    assert sizes and sum(sizes) < 120


def test_groups_whose_first_kinds_differ(spark):
    """Surnames so unlike that nearly equal phones don't do; only the last kinds of the groups have equal ones."""
    rows = [(i, "SALMON", f"55501000{n}", "5 OAK ST", "1") for i, n in enumerate(("11", "22", "33", ""))]
    rows += [(i, f, f"55501000{n}", "5 OAK ST", "1") for i, (f, n) in enumerate([("OLIVE", "44"), ("OLIVE", "55"), ("OLIVE", "33"), ("OLIVE", "")], 10)]
    rows += [(i, "OLIVE", f"55501000{n}", "5 OAK ST", "2") for i, n in enumerate(("11", "22"), 20)]
    people = spark.createDataFrame(rows, COLUMNS)
    want = by_pairs(people, 0.0)
    assert 0.4 < jaro_winkler("SALMON", "OLIVE") < 0.464 and want[12] == 0
    assert assigned(people, 0.0) == want


def test_groups_in_pieces_and_blanks(spark, monkeypatch):
    monkeypatch.setattr(blocking, "CHUNK", 5)
    rng = random.Random(3)
    for empty in (0.0, 1.0):
        rows = [
            (i, rng.choice(["SALMON", "OLIVE", "OLIVES", "", None]), rng.choice(["", None, "7", *(f"55{rng.randrange(10)}01{rng.randrange(1000):03}" for _ in range(9))]), rng.choice(["5 OAK ST", "5 OAK STREET", "5 OKA ST", "6 OAK ST", "OAK", ""]), rng.choice("12"))
            for i in rng.sample(range(1000), 150)
        ]
        people = spark.createDataFrame(rows, COLUMNS)
        want = by_pairs(people, empty)
        assert 1 < len(set(want.values())) < 150 and assigned(people, empty) == want
