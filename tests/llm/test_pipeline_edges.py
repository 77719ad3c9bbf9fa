"""Every stage on empty tables, repeated rows, ties, nulls and columns that clash with what the stage makes."""

import collections

import pytest

import corpus_pipeline as cp
from kinveil.operators import staging

NAMES = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ", n_words int, N_REMOVED string, lang_pred string, score int, class_id long, n_links long, copies int, size string, tie long, spans int, row string"
EXTRA = (3, "r", "p", 4, 5, 6, 7, "s", 8, 9, "w")


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), *EXTRA) for i, t, lang, s in rows], NAMES + CLASH)


def passages():
    a, b = (" ".join(f"{x}{i}" for i in range(70)) for x in ("alpha", "beta"))
    english, french = "the cat sat on the mat and the dog slept by the fire", "le chat dort sur le lit et le chien mange dans la cour"
    return [
        (1, a, "en", "s"), (1, a, "en", "s"), (2, b + " " + a, "en", "s"), (2, b + " " + a, "en", "s"), (3, english, "en", "t"), (4, french, "fr", None),
        (5, None, "en", "s"), (6, "", None, None), (7, " \n", "fr", "t"), (None, english, None, "s"), (None, None, None, None), (3, french, "fr", "t"), (8, "12 345", "en", "t"),
    ]


@pytest.mark.parametrize("name", [n for n, _ in cp.STAGES])
def test_empty_table(spark, name):
    docs = table(spark, [])
    got = dict(cp.STAGES)[name](spark, docs, "")
    assert got.collect() == [] and (name == "encoding" or got.columns == docs.columns)


def run(spark, name, rows):
    docs = table(spark, rows).repartition(3)
    got = dict(cp.STAGES)[name](spark, docs, "")
    if name != "encoding":
        assert got.schema.names == docs.schema.names and [f.dataType for f in got.schema] == [f.dataType for f in docs.schema]
    out = got.collect()
    if name != "encoding":
        assert all(tuple(r)[5:] == EXTRA for r in out)
    return collections.Counter((r.doc_id, r.source, *((r.text, r.n_chars) if name != "encoding" else (r.n_tokens, r.n_tokens == len(r.ids)))) for r in out)


def all_of(rows):
    return collections.Counter((i, s, t, None if t is None else len(t)) for i, t, _, s in rows)


def test_language(spark):
    rows = passages()
    assert run(spark, "language", rows) == all_of([r for r in rows if any(map(str.isalpha, r[1] or ""))])


def test_near_duplicates(spark):
    rows = passages()
    keep = [rows[0], rows[2], rows[4], rows[11], rows[6], rows[7], rows[8], rows[10], rows[12]]
    assert run(spark, "near_duplicates", rows) == all_of(keep)


def test_substrings(spark):
    rows = passages()
    cut = rows[2][1][: rows[2][1].index(" alpha0")]
    keep = [rows[0], rows[1], rows[4], rows[5], rows[9], rows[11], rows[12], (2, cut, "en", "s"), (2, cut, "en", "s")]
    assert run(spark, "substrings", rows) == all_of(keep)


def test_mixture(spark):
    rows = passages()
    got = run(spark, "mixture", rows)
    given = all_of(rows)
    assert got and all(n <= 2 * given[r] and (r[2] or "").split() for r, n in got.items()) and got == run(spark, "mixture", rows)


def test_encoding(spark):
    rows = passages()
    got = run(spark, "encoding", rows)
    assert sum(got.values()) == len(rows) and all(r[3] for r in got)
    assert got[(5, "s", 0, True)] == got[(6, None, 0, True)] == got[(None, None, 0, True)] == 1 and got[(8, "t", 0, True)] == 0


def test_a_run_leaves_one_table(spark):
    before = set(staging._held)
    out = cp.run(spark, "/root/testdata/sf0.001")
    assert out.count() and len(set(staging._held) - before) == 1
    staging.discard(out)
    assert set(staging._held) == before
