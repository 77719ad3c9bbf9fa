import random
import re

import pytest

from kinveil.llm import mixing as mx


def fill(sizes, weights=(3, 1, 2)):
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    goal, target, open_ = 1.5 * sum(sizes.values()), dict.fromkeys(order, 0.0), set(order)
    while True:
        left, weight = goal - sum(target[s] for s in order if s not in open_), sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / weight > 2 * sizes[s] + 1e-9}
        if not over:
            return target | {s: left * w[s] / weight for s in open_}
        target |= {s: 2.0 * sizes[s] for s in over}
        open_ -= over


def docs(seed, n, sources):
    rng = random.Random(seed)
    return [(i, None if rng.random() < 0.02 else " ".join("w" * rng.randrange(1, 4) for _ in range(rng.choice([0, 1, 5, 40, 400]))), rng.choice(sources)) for i in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_takes_near_targets(spark, monkeypatch, seed):
    monkeypatch.setattr(mx, "CELL", 16)
    rows = docs(seed, 900, ["a"] * 20 + ["b", "Ä", None, "", "z", "c"])
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    run = lambda d: sorted(map(tuple, mx.copies(mx.sized(d)).select("id", "source", "size", "source_size", "target", "copies").collect()), key=str)
    got = run(df.repartition(5))
    assert got == run(df.coalesce(1)) and [r[0] for r in sorted(got)] == list(range(900))
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    sums, taken, biggest = {}, {}, {}
    for i, _, s in rows:
        sums[s] = sums.get(s, 0) + size[i]
    want = fill(sums)
    for i, s, n, total, target, c in got:
        assert n == size[i] and total == sums[s] and abs(target - want[s]) < 1e-6 * max(1, want[s]) and 0 <= c <= 2
        taken[s], biggest[s] = taken.get(s, 0) + n * c, max(biggest.get(s, 0), n)
    assert all(abs(taken[s] - want[s]) <= biggest[s] + 1e-6 for s in sums), (taken, want)


def test_rates_are_fair(spark):
    """Documents of any size are taken at the source's rate, over 60 like sources."""
    rows = [(100 * k + i, f"s{k}", 1 + i % 7, i, 0, 0.3) for k in range(60) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, source string, size long, tie long, nth long, p double")
    n = [0] * 40
    for r in mx.rounded(df).collect():
        n[r.id % 100] += r.bit
    assert 0.25 < sum(n) / 2400 < 0.35 and max(n) < 36 and min(n) > 3


def test_edges(spark):
    schema = "doc_id long, text string, source string, size int, copies int"
    assert mx.mix(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "a b", "x", 1, 1)] * 3 + [(2, None, "y", 2, 2), (3, "", "x", 3, None), (None, "c d e", None, 4, 4), (4, "q " * 50000, "x", 5, 5)]
    df = spark.createDataFrame(rows, schema)
    got = mx.mix(df).collect()
    assert got == mx.mix(df).collect() and all(r.doc_id not in (2, 3) for r in got) and got[0].asDict().keys() == set(df.columns)
    assert sum(r.doc_id is None for r in got) <= 2


def test_repeated_rows_fall_into_many_cells(spark, monkeypatch):
    """2,000 equal rows of a source: what is taken of them is near the target, and the same each time."""
    monkeypatch.setattr(mx, "CHUNK", 100)
    rows = [(7, "a b c", "x")] * 2000 + [(i, "d e", "x") for i in range(50)] + [(i, "w " * 900, s) for i, s in enumerate("yzuvw")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = sorted(map(tuple, mx.mix(df).collect()))
    assert got == sorted(map(tuple, mx.mix(df.coalesce(1)).collect()))
    sizes = {"x": 6100} | dict.fromkeys("yzuvw", 900)
    want, taken = fill(sizes), dict.fromkeys(sizes, 0)
    for _, t, s in got:
        taken[s] += len(t.split())
    assert 0 < want["x"] / sizes["x"] % 1 < 1 and abs(taken["x"] - want["x"]) <= 3


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_loops(spark, seed):
    rng = random.Random(seed)
    names = [*(chr(rng.randrange(33, 0x3000)) + str(i) for i in range(60)), None, "", "\U0001f600", "\uffee"]
    sizes = {s: rng.choice([0, 1, 10, 1000, 10**6]) * rng.randrange(1, 9) for s in names}
    got = mx.targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()
    want = fill(sizes)
    assert len(got) == len(names) and all(abs(r.target - want[r.source]) <= 1e-6 * max(1, want[r.source]) for r in got)
