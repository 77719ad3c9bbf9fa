"""Queries that give every household a link and pivot every person over every site."""

from kinveil.plans import linkage

SF = "/root/testdata/sf0.001"


def test_every_household_has_a_link(spark):
    got = linkage.QUERIES["household_link_resolve"](spark, SF).collect()
    assert sorted(r.PATID for r in got) == sorted(r.record_id for r in linkage.pii(spark, SF).collect())
    assert len({r.HOUSEHOLD_ID for r in got}) == linkage.QUERIES["household_table"](spark, SF).count()


def test_every_person_is_pivoted(spark):
    got = linkage.QUERIES["answer_pivot"](spark, SF).collect()
    want = {(f"site_{r.position % 3}", r.household_zip) for r in linkage.pii(spark, SF).collect()}
    assert {(s, r[s]) for r in got for s in ("site_0", "site_1", "site_2") if r[s] is not None} == want
