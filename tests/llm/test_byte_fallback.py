"""Unknown characters as byte pieces, against the library's Unigram with byte fallback."""

import random

import public_tokenizers
from tokenizers import Tokenizer, models, normalizers

from kinveil.llm import token_count as tc

PATH = public_tokenizers.path("piece_bpe_32k.model")


def library(pieces, unk, fallback):
    tool = Tokenizer(models.Unigram([*pieces, *((f"<0x{b:02X}>", 0.0) for b in sorted(fallback))], unk_id=unk, byte_fallback=True))
    tool.normalizer = normalizers.Replace(" ", "▁")
    return lambda t: len(tool.encode(t, add_special_tokens=False).ids)


def test_the_file(spark):
    texts = ["a\n\n\nb", "\t\t", "\n", "०१२", "ጤና ይስጥልኝ" * 50, "x\n\n日本語\t😀", "<unk>", "<unk>\n", "", "plain text\r\n\r\n"]
    want = library(*tc.pieces(PATH), tc.byte_pieces(PATH))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in tc.count_tokens(df, PATH).collect()}
    assert [got[i] for i in range(len(texts))] == [want(t) for t in texts]
    assert got[2] == 1 and got[1] == 2 and got[3] == 9


def test_random_paths():
    rng = random.Random(9)
    for fallback in (frozenset(range(256)), frozenset(range(128)), frozenset()):
        pieces = [("<unk>", 0.0), ("▁", -3.0)] + [(p, float(-rng.randrange(1, 5))) for p in sorted({"".join(rng.choice("abcé") for _ in range(rng.randrange(1, 4))) for _ in range(12)} - {"c", "é"})]
        want, ours = library(pieces, 0, fallback), tc.Unigram(pieces, 0, fallback)
        texts = ["".join(rng.choice("abccéé \n日") for _ in range(rng.randrange(25))) for _ in range(1500)]
        assert ours.counts(texts).tolist() == [want(t) for t in texts]


def test_long_unknown_run():
    assert tc.unigram(PATH).count("ጤ" * 300_000) == 900_000
