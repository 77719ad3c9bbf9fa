"""People of equal matching fields are compared as one kind; pairs and households against loops over all people."""

import random

import pytest

from kinveil.functions.similarity import Parts, address_similarity, jaro_winkler
from kinveil.operators import blocking, households

COLUMNS = "position long, family_name string, phone_number string, household_street_address string, household_zip string"


def blank_aware(a, b, empty):
    return empty if a == b == "" else jaro_winkler(a, b)


@pytest.mark.parametrize("empty,chunk", [(0.0, 1024), (1.0, 4)])
def test_kinds_give_all_pairs_of_their_members(spark, monkeypatch, empty, chunk):
    monkeypatch.setattr(blocking, "CHUNK", chunk, raising=False)
    rng = random.Random(chunk)
    pick = lambda *values: rng.choice(values)
    some = [(pick("LI", "KIM", "LIN", "", None), pick("5550100001", "5550100002", "9", "", None), pick("5 OAK ST", "5 OKA ST", "5 OAK STREET", "5 OAK ST APT 1", "6 ELM RD", "OAK", "", None), pick("1", "2", None)) for _ in range(40)]
    rows = [(i, *pick(*some)) for i in rng.sample(range(1000), 240)]
    people = spark.createDataFrame(rows, COLUMNS)
    sizes, likely = [], blocking.likely
    monkeypatch.setattr(blocking, "likely", lambda own, *more: sizes.append(own.count()) or likely(own, *more))
    found = households.scored(people, empty).collect()
    got = {(r.a, r.b): r for r in found}
    assert len(got) == len(found) and sizes and max(sizes) <= len(set(some))
    parts = {r.position: (r.household_zip, r.family_name, r.phone_number, Parts(**r.parsed.asDict())) for r in households.prepared(people).collect()}
    want = {}
    for a in sorted(parts):
        for b in sorted(parts):
            (za, fa, pa, x), (zb, fb, pb, y) = parts[a], parts[b]
            if a < b and za == zb and x.raw and y.raw and ((x.street, x.number) == (y.street, y.number) or fa == fb):
                if (near := address_similarity(x, y)) > households.ADDRESS_ABOVE:
                    f, p = blank_aware(fa, fb, empty), blank_aware(pa, pb, empty)
                    want[a, b] = (f, p, near, 0.25 * f + 0.2 * p + 0.55 * near)
    assert len(want) > 300 and got.keys() == want.keys()
    assert all((r.family_name, r.phone_number, r.address, r.score) == want[k] for k, r in got.items())
    passing = {k for k, v in want.items() if v[3] > households.TOTAL_ABOVE}
    assert {tuple(r) for r in households.matches(people, empty_similarity=empty).collect()} == passing
    of = {p: p for p in parts}
    while moved := [(a, b) for a, b in passing if of[a] != of[b]]:
        for a, b in moved:
            of[a] = of[b] = min(of[a], of[b])
    assert {r.position: r.household for r in households.assign(people, empty_similarity=empty).collect()} == of
