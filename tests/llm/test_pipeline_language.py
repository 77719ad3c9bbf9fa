"""What the language stage rejects, and what it leaves alone."""

import base64
import random

import corpus_pipeline as cp

SF = "/root/testdata/sf0.01"


def test_text_of_no_learned_language_goes(spark):
    rng = random.Random(1)
    words = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(3, 9))) for _ in range(40))
    odd = [words("qwxzjvkfbpmcd"), words("абвгдежзийклмнопрст"), words("ابتثجحخدذرزسش"), base64.b64encode(rng.randbytes(200)).decode(), rng.randbytes(150).hex()]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(90001 + i, t, None, "src1", len(t)) for i, t in enumerate(odd)], docs.schema)
    own = {r.doc_id for r in docs.collect() if any(map(str.isalpha, r.text or ""))}
    assert {r.doc_id for r in cp.language(spark, docs.unionByName(extra), SF).collect()} == own


def test_without_labels_letters_stay(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "the cat sat on the mat and slept", None, "a", 32), (2, "12 !!", None, "a", 5), (3, None, None, "a", 0), (4, "日本語", None, "a", 3)]
    assert {r.doc_id for r in cp.language(spark, spark.createDataFrame(rows, schema), SF).collect()} == {1, 4}
    one = [(i, t, t and "en", s, n) for i, t, _, s, n in rows]
    assert {r.doc_id for r in cp.language(spark, spark.createDataFrame(one, schema), SF).collect()} == {1, 4}
