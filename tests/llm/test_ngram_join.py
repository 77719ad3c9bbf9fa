import random
import re

import numpy as np
import pytest

from kinveil.llm import ngram_join as nj
from kinveil.operators.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    def grams(t):
        w = WORD.findall(t or "")
        return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()

    g = {d: grams(t) for d, t in rows}
    near = {d: {e for e in g if e != d and g[d] & g[e] and len(g[d] & g[e]) / len(g[d] | g[e]) >= 0.8} for d in g}
    out = []
    for d in g:
        seen, todo = {d}, [d]
        while todo:
            for e in near[todo.pop()] - seen:
                seen.add(e), todo.append(e)
        out.append((d, min(seen), len(near[d])))
    return sorted(out)


def texts(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    out = []
    for _ in range(60):
        t = [rng.choice(words) for _ in range(rng.choice([3, 6, 40, 90, 200]))]
        out.append(t)
        for _ in range(rng.choice([0, 0, 1, 3])):
            t = list(t)
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                t[rng.randrange(len(t))] = rng.choice(words)
            out.append(t)
    hub = [rng.choice(words) for _ in range(150)]
    out += [[*hub[: 140 + i % 7], f"z{i}"] for i in range(70)] + [hub] * 20
    rng.shuffle(out)
    rows = [(i, " ".join(t)) for i, t in enumerate(out)]
    return rows + [(9000, None), (9001, ""), (9002, " \n"), (9003, "x " * 3000), (9004, "x " * 10)]


@pytest.mark.parametrize("blocks", [(1024, 256), (10, 16)])
def test_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(nj, "BUCKET_BLOCK", blocks[0])
    monkeypatch.setattr(nj, "TEXT_BLOCK", blocks[1])
    rows = texts(blocks[0])
    got = nj.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_edges(spark):
    schema = "doc_id long, text string, doc int, n int, a string"
    assert nj.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "a b c d e f", 1, 1, "x"), (None, "a b c d e f", 1, 1, "x"), (2, "a b c d e f", 2, 2, None), (2, "a b c d e f", 2, 2, None)]
    got = sorted(map(tuple, nj.near_duplicates(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == [(1, 1, 2), (2, 1, 2), (2, 1, 2), (None, None, 0)]


def by_rows(rows):
    """What near_duplicates() gives for rows that may repeat ids: brute() over row numbers."""
    found = brute([(i, t) for i, (_, t) in enumerate(rows)])
    classes = {}
    for i, c, _ in found:
        classes[c] = min(classes.get(c, 1 << 60), rows[i][0])
    return sorted((rows[i][0], classes[c], n) for i, c, n in found)


def test_rows_that_repeat_an_id(spark):
    x = " ".join(f"w{i}" for i in range(60))
    y, z = x + " more", "one two three four five six seven"
    rows = [(1, x), (1, x), (2, y), (3, z), (1, z), (4, z + " eight"), (5, z), (5, x), (9, ""), (9, "")]
    got = nj.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(map(tuple, got)) == by_rows(rows)
    assert [r.n_links for r in got if r.doc_id == 2] == [3]
    rows = [(i // 3, t) for i, t in texts(3)]
    got = nj.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(map(tuple, got)) == by_rows(rows)


def test_words_of_equal_polynomials_are_different(spark):
    one = "".join("ab"[i.bit_count() % 2] for i in range(1024))
    two = one.translate(str.maketrans("ab", "ba"))
    for a, b in ((one, two), (" ".join(one), " ".join(two))):
        rows = [(1, a), (2, b), (3, a)]
        got = nj.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert sorted(map(tuple, got)) == brute(rows)


def test_long_texts_in_parts(spark):
    rng = random.Random(8)
    long = [f"w{rng.randrange(10**6)}" for _ in range(450_000)]
    near = ["odd" if i % 60 == 3 else w for i, w in enumerate(long)]
    rows = [(1, " ".join(long)), (2, " ".join(near)), (3, " ".join(long[:200_000])), (4, " \n ".join(long)), (5, "a b c d")]
    got = nj.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_pruning_keeps_what_is_near():
    least = nj.least_matches(0.8, 1e-9)
    assert list(least) == sorted(least) and least[0] <= 2 and least[-1] < 0.6 * nj.HASHES
    a = np.arange(nj.HASHES, dtype=np.uint32)
    b = np.tile(a, (3, 1))
    b[1, ::5] += 1000
    b[2] += 1000
    assert nj.survivors(a, b, least).tolist() == [0, 1]


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(5, 5), (None, 1), (3, None)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            label[a], label[b] = label.get(a, a), label.get(b, b)
    for _ in label:
        for a, b in edges:
            if a in label and b in label:
                label[a] = label[b] = min(label[a], label[b])
    assert got == label
