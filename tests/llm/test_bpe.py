import hashlib
import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from kinveil.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


def samples(seed, n):
    rng = random.Random(seed)
    alphabet = ["'", "'", "'s", "'re", "'ll", "'t", "'LL", "l", "s", "re", "ve", "d", "m", "a", "Z", "é", "ñ", "日本", "1", "٣", "²", "½", " ", " ", "  ", "\n", "\t", "\r", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", "　", "​", " ", ".", ",", "!!", "_", "😀", "é", "ǅ", "ª", "̀", "<|endoftext|>", "<|", "\x00", "\x7f", "﻿", "᠎"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 25))) for _ in range(n)]


def test_words_equal_the_library():
    """Encoding word by word gives what the library gives for whole texts."""
    tool, ours = Tokenizer.from_file(PATH), bpe.tokens(PATH)
    texts = samples(3, 6000)
    for t, e in zip(texts, tool.encode_batch(texts, add_special_tokens=False), strict=True):
        words = [w for part in ours.words(t) for w in part]
        assert "".join(words) == t
        got = [i for w in words for i in ours.encode([w])[0]]
        assert got == e.ids, (t, e.tokens)
        assert bpe.decoded(np.array(got, np.int32), ours.pieces) == tool.decode(e.ids, skip_special_tokens=False)


def test_parts_of_a_text_give_the_same_words(monkeypatch):
    monkeypatch.setattr(bpe, "PART", 7)
    ours = bpe.tokens(PATH)
    for t in [*(" ".join(samples(8 + k, 40)) for k in range(60)), "a" * 100, " " * 100 + "b", "x   " * 50]:
        assert [w for part in ours.words(t) for w in part] == [w for piece in [t] for part in whole(ours, piece) for w in part]


def whole(ours, text):
    for k, piece in enumerate(ours.find.split(text)):
        yield [piece] if k % 2 else bpe._WORD.findall(piece)


def rows(texts):
    return [(i, t, 1, i) for i, t in enumerate(texts)], "doc_id long, text string, word int, n_Tokens long"


def test_rows_equal_the_library(spark):
    tool = Tokenizer.from_file(PATH)
    one = "".join("ab"[i.bit_count() % 2] for i in range(1024))
    texts = [*samples(5, 300), None, "", "the cat's hat " * 3000, "the cat's hat " * 3000, one, one.translate(str.maketrans("ab", "ba"))]
    df = spark.createDataFrame(*rows(texts)).repartition(3)
    got = {r.doc_id: r for r in bpe.digest(df, PATH).collect()}
    assert sorted(got) == list(range(len(texts)))
    for i, t in enumerate(texts):
        e = tool.encode(t or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(e) and got[i].ids_sha256 == hashlib.sha256(",".join(map(str, e)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(tool.decode(e, skip_special_tokens=False).encode()).hexdigest()
    both = bpe.decode(bpe.encode(df, PATH), PATH).collect()
    assert len(both) == len(texts) and all(r.decoded == (r.text or "") and r.n_Tokens == r.doc_id for r in both)
    lean = bpe.encode(df, PATH, out="N_TOKENS", keep_text=False)
    assert lean.columns == ["doc_id", "word", "N_TOKENS"] and lean.count() == len(texts)


def test_edges(spark):
    empty = spark.createDataFrame([], rows([])[1])
    assert bpe.digest(empty, PATH).count() == 0 and bpe.encode(empty, PATH).columns == [*empty.columns, "ids"]
    same = spark.createDataFrame([(1, "x y"), (1, "x y"), (None, "x y"), (2, None)], "doc_id long, text string")
    assert sorted(r.n_tokens for r in bpe.digest(same, PATH).collect()) == [0, 2, 2, 2]
    back = spark.createDataFrame([(1, [464, 3797]), (2, None), (3, [])], "id int, ids array<int>")
    assert [r.decoded for r in bpe.decode(back, PATH).orderBy("id").collect()] == ["The cat", None, ""]


def test_blocks_and_buckets(spark):
    """Many blocks and a text of several parts: same ids."""
    rng = random.Random(1)
    texts = [" ".join(f"w{rng.randrange(10**5)}" for _ in range(400_000)), *samples(6, 50), "the cat " * 300_000]
    tool = Tokenizer.from_file(PATH)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.n_tokens for r in bpe.digest(df, PATH).collect()}
    assert [got[i] for i in range(len(texts))] == [len(tool.encode(t, add_special_tokens=False).ids) for t in texts]
