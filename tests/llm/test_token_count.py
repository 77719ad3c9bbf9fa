import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, normalizers

from kinveil.llm import token_count as tc

PATH = public_tokenizers.path("piece_bpe_32k.model")


def library(pieces, unk):
    tool = Tokenizer(models.Unigram(pieces, unk_id=unk))
    tool.normalizer = normalizers.Replace(" ", "▁")
    return lambda t: len(tool.encode(t, add_special_tokens=False).ids)


@pytest.mark.parametrize("seed", range(4))
def test_ties_as_in_the_library(seed):
    rng = random.Random(seed)
    pieces = [("<unk>", 0.0), ("▁", -3.0)] + [(p, float(-rng.randrange(1, 5))) for p in {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 5))) for _ in range(25)}]
    pieces += [("▁" + "".join(rng.choice("abc") for _ in range(k)), float(-rng.randrange(1, 6))) for k in (1, 2, 3)]
    pieces = list(dict(pieces).items())
    want, ours = library(pieces, 0), tc.Unigram(pieces, 0)
    texts = ["".join(rng.choice("abcabcabcx  é▁") for _ in range(rng.randrange(30))) for _ in range(1500)]
    assert ours.counts(texts).tolist() == [want(t) for t in texts]
    assert [ours.count(t.replace(" ", "▁")) for t in texts] == [want(t) for t in texts]


def test_ties_of_fractional_scores_as_in_the_library():
    """Sums of tenths round; only counting from the text's start rounds as the library does."""
    rng = random.Random(11)
    pieces = [("<unk>", 0.0), ("▁", -0.3)] + [(p, -rng.randrange(1, 9) / 10) for p in sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 4))) for _ in range(30)})]
    pieces += [("▁" + "".join(rng.choice("abc") for _ in range(k)), -rng.randrange(1, 9) / 10) for k in (1, 2, 2, 3)]
    pieces = list(dict(pieces).items())
    want, ours = library(pieces, 0), tc.Unigram(pieces, 0)
    texts = ["".join(rng.choice("abcabcabc  ") for _ in range(rng.randrange(120))) for _ in range(1500)]
    assert not ours.whole and ours.counts(texts).tolist() == [want(t) for t in texts]


def test_words_of_equal_polynomials_are_different():
    one = "".join("ab"[i.bit_count() % 2] for i in range(32))
    pieces = [("<unk>", 0.0), ("▁", -3.0), ("a", -1.0), ("b", -1.0), ("abba", -1.0), (one * 32, -1.0)]
    two = one.translate(str.maketrans("ab", "ba"))
    want, ours = library(pieces, 0), tc.Unigram(pieces, 0)
    texts = [one * 32, two * 32, one + two]
    assert ours.counts(texts).tolist() == [want(t) for t in texts]


def test_file_and_edges(spark):
    want = library(*tc.pieces(PATH))
    rows = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    rows += [None, "", " ", "日本語 テキスト 😀😀 ok", "a" * 20000, "<unk> <s>", "the same", "the same"]
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(rows)], "doc_id long, text string, score int")
    got = {r.doc_id: r.n_tokens for r in tc.count_tokens(df, PATH).collect()}
    assert [got[i] for i in range(len(rows))] == [want(t or "") for t in rows]
    assert tc.count_tokens(df.limit(0), PATH).count() == 0
    clash = tc.count_tokens(spark.createDataFrame([(1, "the", 5)], "doc_id long, text string, N_tokens int"), PATH)
    assert [tuple(r) for r in clash.collect()] == [(1, "the", want("the"))]
    with pytest.raises(ValueError):
        tc.Unigram([("▁", 0.0), ("a▁", 0.0)], 0)
