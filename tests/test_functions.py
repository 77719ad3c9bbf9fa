import datetime
import random

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinveil.functions import address, clean
from kinveil.functions.similarity import Parts, address_similarity, hamming, jaro_winkler
from kinveil.operators.blocking import metaphone


def parts(number="", street="", suffix="", prefix="", value=""):
    return Parts(number, street, suffix, prefix, value, " ".join(x for x in (number, street, suffix, prefix, value) if x))


@pytest.mark.parametrize(("a", "b", "want"), [
    (parts("205", "GARDEN", "ST"), parts("206", "GARDEN", "ST"), 0.83333),
    (parts("205", "GARDEN", "ST"), parts("205", "GAREDN", "ST"), 0.98444),
    (parts("205", "GARDEN", "STREET"), parts("205", "GAREDN", "ST"), 0.96667),
    (parts("205", "GARDEN", "ST", "APT", "5F"), parts("205", "GARDEN", "ST", "APT", "5J"), 0.9472),
    (parts(), parts("1", "A"), 0.0),
    (parts("1", "A"), parts("1", "A"), 1.0),
])
def test_address_similarity(a, b, want):
    assert address_similarity(a, b) == pytest.approx(want, abs=1e-5) and address_similarity(b, a) == pytest.approx(want, abs=1e-5)


def test_jaro_winkler_is_duckdbs():
    rng = random.Random(1)
    pairs = [("".join(rng.choices("ABCD", k=rng.randrange(9))), "".join(rng.choices("ABCD", k=rng.randrange(9)))) for _ in range(3000)]
    con = duckdb.connect()
    con.execute("create table p (i int, a varchar, b varchar)")
    con.executemany("insert into p values (?, ?, ?)", [(i, *p) for i, p in enumerate(pairs)])
    for (a, b), (want,) in zip(pairs, con.execute("select jaro_winkler_similarity(a, b) from p order by i").fetchall(), strict=True):
        assert jaro_winkler(a, b) == pytest.approx(want)


@given(st.text(max_size=12), st.text(max_size=12))
@settings(max_examples=200)
def test_similarities_are_symmetric_shares(a, b):
    assert 0 <= jaro_winkler(a, b) <= 1 and jaro_winkler(a, b) == pytest.approx(jaro_winkler(b, a)) and hamming(a, b) == hamming(b, a)


def test_cleaning(spark):
    rows = [(None, None, None), ("", "", ""), (" \tJosé\n", "(555) 010-0001 x9", " 01234 "), ("ﬁ²Ⅷ ß", "١٢", " a"), ("\x1fx\x1c", "12", "1")]
    df = spark.createDataFrame(rows, "s string, p string, z string")
    got = df.select(clean.clean_string(F.col("s")), clean.clean_phone(F.col("p")), clean.clean_zip(F.col("z"))).collect()
    assert [tuple(r) for r in got] == [(None, None, None), ("", "", ""), ("JOSE", "55501000019", "01234"), ("FI2VIII", "", "a"), ("X", "12", "1")]


def test_dates(spark):
    df = spark.createDataFrame([("5/7/1977",), (" 05/07/1977 ",), ("",), (None,), (" ",)], "d string")
    assert [r[0] for r in df.select(clean.clean_dob(F.col("d"), "%m/%d/%Y")).collect()] == ["1977-05-07", "1977-05-07", "", "", ""]
    with pytest.raises(Exception, match="(?i)pars|cast|format"):
        spark.createDataFrame([("13/40/1977",)], "d string").select(clean.clean_dob(F.col("d"), "%m/%d/%Y")).collect()
    two = spark.createDataFrame([("300101",), ("290101",), ("xx",), (None,)], "d string").select(clean.century_date(F.col("d")).alias("d")).collect()
    assert [r.d for r in two] == [datetime.date(1930, 1, 1), datetime.date(2029, 1, 1), None, None]
    with pytest.raises(ValueError, match="%Q"):
        clean.java_format("%Q")


def test_predicates_and_shapes(spark):
    df = spark.createDataFrame([("",), (" ",), ("a\x07",), ("é",), ("12-Ab",), (None,)], "s string")
    got = [tuple(r) for r in df.select(clean.is_blank_text(F.col("s")), clean.is_printable(F.col("s")), clean.is_ascii(F.col("s")), clean.shape(F.col("s"))).collect()]
    assert got == [(False, True, True, ""), (True, True, True, " "), (False, False, True, "X\x07"), (False, True, False, "X"), (False, True, True, "##-XX"), (None, None, None, "")]


def test_addresses(spark):
    want = {
        "205 GARDEN ST": ("205", "GARDEN", "ST", "", ""), "12 Old Mill Rd. Apt. 5F": ("12", "MILL", "RD", "APT", "5F"), "7 ELM #9": ("7", "ELM", "", "", "9"),
        "BROADWAY": ("", "BROADWAY", "", "", ""), "": ("", "", "", "", ""), "9 STREET": ("9", "STREET", "", "", ""), "SUITE": ("", "SUITE", "", "", ""), "1 A AVE, UNIT B": ("1", "A", "AVE", "UNIT", "B"),
    }
    df = spark.createDataFrame([(k,) for k in want], "a string").select("a", address.parse(F.col("a")).alias("p")).collect()
    assert {r.a: tuple(r.p)[:5] for r in df} == want


def test_metaphone():
    assert [metaphone(x) for x in ("Thompson", "Knight", "Philip", "Wright", "Smith", "Church", "")] == ["0MPSN", "NT", "FLP", "RT", "SM0", "XRX", ""]
