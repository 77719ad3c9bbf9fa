"""Which row of a class stays: rows without an id, and rows that repeat one."""

import collections

import corpus_pipeline as cp


def test_rows_count_one_by_one(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    near = a.replace("a39", "z")
    rows = [(1, a), (2, near), (None, a), (3, b), (3, b), (3, near), (4, c), (3, c), (None, d), (None, d), (5, b), (6, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "src", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = collections.Counter((r.doc_id, r.text) for r in cp.near_duplicates(spark, docs, "").collect())
    assert got == collections.Counter([(1, a), (3, b), (3, c), (None, d), (6, None), (None, None)])
