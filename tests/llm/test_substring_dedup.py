import hashlib
import random
import re

import pytest

from kinveil.llm import substring_dedup as sd

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=50):
    """rows of (doc_id, text) to {doc_id: (words, removed, sha of what stays)}."""
    first = {}
    for d, t in rows:
        w = WORD.findall(t or "")
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            if d is not None:
                first[k] = min(d, first.get(k, d))
    out = []
    for d, t in rows:
        w = WORD.findall(t or "")
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i : i + window])] < d:
                gone |= set(range(i, i + window))
        stay = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(stay.encode()).hexdigest()))
    return sorted(out, key=str)


def texts(seed, n=60, vocabulary=40):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["é", "日本", "a" * 300]
    prose = lambda k: [rng.choice(words) for _ in range(k)]
    shared = [prose(rng.choice([49, 50, 51, 70, 200])) for _ in range(5)] + [["x"] * 120, ["a", "b"] * 60]
    out = []
    for d in range(n):
        t = prose(rng.randrange(0, 150))
        for _ in range(rng.randrange(3)):
            p = list(rng.choice(shared))
            if rng.random() < 0.3:
                p[rng.randrange(len(p))] = "odd"
            k = rng.randrange(len(t) + 1)
            t[k:k] = p
        out.append((d, rng.choice([" ", "\n", "  ", "\t "]).join(t)))
    out += [(n, out[3][1]), (n + 1, out[3][1]), (n + 2, ""), (n + 3, None), (n + 4, "  \n"), (n + 5, "x " * 500), (n + 6, "x " * 77)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_matches_brute_force(spark, seed):
    rows = texts(seed)
    got = sd.digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(rows)


def test_rows_that_repeat_an_id(spark):
    """Each row loses words of its own text only."""
    rng = random.Random(3)
    rows = [(i // 3, t) for i, t in texts(5) if t is not None]
    rows += [(7, rows[4][1]), (7, rows[4][1]), (2, " ".join(f"u{rng.randrange(9)}" for _ in range(300)))] * 2
    got = sd.digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(rows)


def test_small_windows(spark):
    rows = texts(9)
    got = sd.digest(spark.createDataFrame(rows, "doc_id long, text string"), window=7).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(rows, 7)


def thue_morse(n):
    return "".join("ab"[i.bit_count() % 2] for i in range(n))


@pytest.mark.parametrize("n", [1024, 2048])
def test_words_of_equal_polynomials_are_different(spark, n):
    """A Thue-Morse word and its complement have equal polynomial hashes modulo 2**64 for any odd base."""
    one = thue_morse(n)
    two = one.translate(str.maketrans("ab", "ba"))
    words = [f"w{i}" for i in range(49)]
    rows = [(1, " ".join([*words, one])), (2, " ".join([*words, two])), (3, " ".join([*words, one]))]
    got = {r.doc_id: r.n_removed for r in sd.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 0, 3: 50}
    alphabet = {"a": "one", "b": "two"}
    rows = [(1, " ".join(alphabet[c] for c in one)), (2, " ".join(alphabet[c] for c in two))]
    assert sorted(map(tuple, sd.digest(spark.createDataFrame(rows, "doc_id long, text string"), window=n).collect())) == brute(rows, n)


def test_long_text_in_parts(spark):
    rng = random.Random(4)
    long = [f"w{rng.randrange(9)}{rng.randrange(10**rng.randrange(1, 5))}" for _ in range(800_000)]
    text = " ".join(long)
    assert len(text) > 4_000_000
    other = list(long)
    for i in range(0, len(other), 977):
        other[i] = "odd"
    rows = [(1, " ".join(long[200_000:200_300])), (2, text), (3, "\n".join(long[399_000:401_000])), (4, " ".join(other)), (5, "z" * 3_000_000 + " " + " ".join(long[:80]))]
    got = sd.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(rows)


def test_empty_clashing_and_extra_columns(spark):
    schema = "doc_id long, text string, doc string, start int, name string"
    clash = spark.createDataFrame([(1, "a b", 9, "x")], "doc_id long, text string, N_words int, spans string")
    assert [tuple(r) for r in sd.dedup(clash).collect()] == [(1, "a b", "x", 2, 0)]
    clash = sd.dedup(clash, out=("u", "v"))
    assert [tuple(r) for r in clash.collect()] == [(1, "a b", 9, "x", 2, 0)]
    empty = sd.dedup(spark.createDataFrame([], schema))
    assert empty.count() == 0 and empty.columns[:5] == ["doc_id", "text", "doc", "start", "name"]
    t = " ".join(f"v{i}" for i in range(60))
    rows = [(2, t, "a", 1, None), (1, t, "b", 2, "n"), (None, t, "c", 3, "m"), (3, "short", None, None, None)]
    got = {(r.doc_id, r.doc): r for r in sd.dedup(spark.createDataFrame(rows, schema)).collect()}
    assert got[(2, "a")].text == "" and got[(2, "a")].n_removed == 60
    assert got[(1, "b")].text == t and got[(None, "c")].n_removed == 0 and got[(3, None)].n_words == 1
