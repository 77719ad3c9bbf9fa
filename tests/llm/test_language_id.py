import math
import random

import numpy as np
import pytest

from kinveil.llm import language_id as li

TESTDATA = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = li.op2_language_id(spark, TESTDATA).join(spark.read.parquet(f"{TESTDATA}/documents.parquet").select("doc_id", "lang", "text"), "doc_id").where("held_out").toPandas()
    real = got[got.lang_pred != "und"]
    assert len(got) > 200 and (real.lang_pred == real.lang).mean() > 0.97
    assert ((got.score >= 0) & (got.score <= 1)).all() and (real.score.mean() - (real.lang_pred == real.lang).mean()) < 0.05


def test_edges(spark):
    schema = "doc_id long, text string, lang string, lang_x string, h long"
    assert li.fit(spark.createDataFrame([], schema)).labels == []
    rows = [(1, "the cat sat", "en", "a", 1), (2, "le chat noir", "fr", None, 2), (3, None, "fr", None, 3), (4, "12 !!", "en", "b", 4), (5, "", None, "c", 5), (None, "abc", "en", "c", 5), (1, "the cat sat", "en", "a", 1)]
    docs = spark.createDataFrame(rows, schema)
    model = li.fit(docs)
    out = {(r.doc_id, r.text): r for r in li.predict(docs, model).collect()}
    assert out[(3, None)].lang_pred == out[(4, "12 !!")].lang_pred == out[(5, "")].lang_pred == "und"
    assert out[(1, "the cat sat")].lang_pred in ("en", "fr") and out[(1, "the cat sat")].lang_x == "a"
    assert li.predict(spark.createDataFrame([], schema), model).count() == 0
    assert li.Model([], np.ones(li.BUCKETS), np.zeros((li.BUCKETS, 0)), np.zeros(0)).predict("abc") == ("und", 0.0)
    long = "the cat sat on the mat " * 40000
    assert model.predict(long)[0] == "en"


def plain_grams(text):
    """Counts of n-grams by loops: white space runs count as one space, and one stands at both ends."""
    t = " " + " ".join(text.lower().split()) + " "
    out = {}
    for n in (1, 2, 3):
        for i in range(len(t) - n + 1):
            out[t[i : i + n]] = out.get(t[i : i + n], 0) + 1
    return out


def column(gram):
    """The bucket of one n-gram, from a text of it alone."""
    x, mask = [ord(c) for c in gram], 0xFFFFFFFF
    key = x[0] * 0x9E3779B1 & mask
    for c in x[1:]:
        key = ((key ^ key >> 15) * 0x85EBCA77 + c * 0xC2B2AE3D) & mask
    return ((key ^ key >> 16) * 0x27D4EB2F & mask) >> 17


def test_features_equal_loops(monkeypatch):
    for part in (li.PART, 5):
        monkeypatch.setattr(li, "PART", part)
        for text in ("The  cat sat\n\ton the mat.", "Ä日本語 テキスト x", "a", " b ", "aaaa bbbb aaaa"):
            want = np.zeros(li.BUCKETS, int)
            for g, n in plain_grams(text).items():
                want[column(g)] += n
            assert li.grams(text).tolist() == want.tolist()


def test_fit_equals_loops():
    """FTRL-proximal, TF-IDF and temperature against plain loops over dictionaries."""
    rng = random.Random(2)
    texts = [("".join(rng.choice(a) for _ in range(30)), y) for y, a in enumerate(("abcd e", "cdxy z", "pqab r")) for _ in range(12)]
    rng.shuffle(texts)
    counts = [(li.grams(t), y) for t, y in texts]
    df = sum((c > 0).astype(int) for c, _ in counts)
    idf = (np.log((1 + len(counts)) / (1 + df)) + 1).astype(np.float32)
    rows = [(np.flatnonzero(c).astype(np.int32), c[np.flatnonzero(c)], y) for c, y in counts]
    model = li.Model(["a", "b", "c"], idf, np.zeros((li.BUCKETS, 3), np.float32), np.zeros(3, np.float32))
    alpha, beta, l1, l2 = 0.5, 1.0, 0.02, 0.1
    li._follow(model, rows, 2, alpha, beta, l1, l2)

    z, n = {}, {}
    weight = lambda i, k: 0.0 if abs(z.get((i, k), 0.0)) <= l1 else -(z[i, k] - math.copysign(l1, z[i, k])) / ((beta + math.sqrt(n[i, k])) / alpha + l2)
    order = np.random.Generator(np.random.PCG64(7))
    for _ in range(2):
        for r in order.permutation(len(rows)).tolist():
            at, c, y = rows[r]
            v = {int(i): math.log1p(x) * math.log((1 + len(rows)) / (1 + df[i])) + math.log1p(x) for i, x in zip(at, c, strict=True)}
            length = math.sqrt(sum(x * x for x in v.values()))
            v = {i: x / length for i, x in v.items()} | {li.BUCKETS: 1.0}
            logit = [sum(x * weight(i, k) for i, x in v.items()) for k in range(3)]
            odds = [math.exp(x - max(logit)) for x in logit]
            for k in range(3):
                err = odds[k] / sum(odds) - (k == y)
                for i, x in v.items():
                    g, w, old = x * err, weight(i, k), n.get((i, k), 0.0)
                    z[i, k] = z.get((i, k), 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / alpha * w
                    n[i, k] = old + g * g
    for k in range(3):
        assert math.isclose(model.bias[k], weight(li.BUCKETS, k), rel_tol=1e-3, abs_tol=1e-4)
        for i in {i for at, _, _ in rows for i in at.tolist()}:
            assert math.isclose(model.weights[i, k], weight(i, k), rel_tol=2e-3, abs_tol=2e-4)
    assert (model.weights == 0).mean() > 0.9

    li._calibrate(model, rows)
    loss = lambda t: -sum(math.log(li._softmax(model.logits(at, c).astype(float) / t)[y]) for at, c, y in rows)
    assert loss(model.temperature) <= min(loss(t) for t in np.geomspace(0.05, 10, 25)) + 1e-2


def test_sample_is_bounded_and_has_rare_languages(spark):
    """One id on very many rows counts once; a language of few rows is learned."""
    rng = random.Random(6)
    word = lambda a: "".join(rng.choice(a) for _ in range(5))
    rows = [(1, "the cat sat on the mat", "en")] * 3000 + [(i, " ".join(word("abcdefgh") for _ in range(8)), "en") for i in range(10, 800)]
    rows += [(9000 + i, " ".join(word("żółćęś") for _ in range(8)), "pl") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = li.fit(df, train_rows=40, least=8)
    assert model.labels == ["en", "pl"] and model.predict("żółćęś ółćęśż ćęśż")[0] == "pl" and model.predict("abc def gha")[0] == "en"
    few = li.fit(df, train_rows=40, languages=1)
    assert few.labels == ["en"] and few.predict("żółć") == ("en", pytest.approx(1.0))


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "the cat", "en", 7, "x"), (2, "le chat", "fr", 8, "y")], "doc_id long, text string, lang string, Score int, lang_pred string")
    model = li.fit(df)
    assert li.predict(df, model).columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    assert li.known(df, model).columns == df.columns and li.known(df, model).count() == 2
