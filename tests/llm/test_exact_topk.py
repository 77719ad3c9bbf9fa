import math
from fractions import Fraction

import numpy as np
import pytest

from kinveil.llm import exact_topk as tk


def whole(v, dims):
    return [math.floor(256 * Fraction(float(x))) for x in v] + [0] * (dims - len(v))


def brute(rows, k=5, asks=lambda i: i % 50 == 0):
    good = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dims = max((len(v) for _, v in good), default=0)
    good = [(i, whole(v, dims)) for i, v in good]
    out = []
    for q in sorted({i for i, _ in good if asks(i)}):
        mine = {tuple(v) for i, v in good if i == q}
        best = sorted((-max(sum(map(int.__mul__, m, x)) for m in mine), i) for i, x in good if i != q)[:k]
        out += [(q, r + 1, i, -s if -(2**63) <= -s < 2**63 else None) for r, (s, i) in enumerate(best)]
    return out


def run(spark, rows, k=5, kind="float", asks="id % 50 = 0"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)
    v = df.select(tk.F.col("vec_id").alias("id"), tk.finite(tk.F.col("embedding")).alias("v"))
    return sorted(tuple(r) for r in tk.knn(v, v.where(asks), k).collect())


@pytest.mark.parametrize("block", [4096, 50])
def test_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(tk, "BLOCK", block)
    monkeypatch.setattr(tk, "CELL_ROWS", 20)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] * (1 + i % 3) + rng.normal(size=8) * 0.02).astype(np.float32).tolist()) for i in range(600)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)]
    rows += [(2000, None), (2050, []), (2100, [float("nan")] * 8), (2150, [float("inf")] * 8), (2200, [None] * 8), (2250, [1.0, 2.0]), (2251, [0.0] * 8)]
    rows += [(None, [1.0] * 8), (3000, rows[3][1]), (3000, rows[3][1]), (3050, rows[3][1]), (3050, rows[4][1]), (3051, rows[3][1]), (3051, rows[3][1])]
    assert run(spark, rows) == brute(rows)


def test_small(spark):
    assert run(spark, []) == [] and run(spark, [(0, [1.0])]) == [] and run(spark, [(1, [1.0])]) == []
    rows = [(0, [1.0, -1.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0])]
    assert run(spark, rows) == brute(rows) == [(0, 1, 1, 65536), (0, 2, 2, 65536)]
    assert run(spark, [(0, []), (1, []), (2, None)]) == [(0, 1, 1, 0)]


def test_very_large_components(spark):
    """Every finite vector takes part; sums that no 64-bit integer holds are ranked by value."""
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(60)]
    rows += [(60, [1e12, 1e6, 0.0, 0.0]), (61, [2e16, 0.0, 0.0, 0.0]), (62, [-1e300, 0.0, 0.0, 0.0]), (63, [1e300, 1.0, 0.0, 0.0]), (64, [1.7e308, 0.0, 0.0, 1.0])]
    rows += [(65, [1e300, 2.0, 0.0, 0.0]), (100, [1e300, -1.0, 0.0, 0.0]), (150, [-2e16, 0.5, 0.0, 0.0]), (200, [0.0, 0.0, 0.0, 1.0])]
    got = run(spark, rows, 70, "double")
    assert got == brute(rows, 70) and len({r[3] for r in got if r[0] == 200}) > 20


def test_a_query_id_on_many_rows_and_a_large_cell(spark, monkeypatch):
    monkeypatch.setattr(tk, "CELL_ROWS", 500)
    rng = np.random.default_rng(5)
    rows = [(1 + i, rng.normal(size=3).round(2).tolist()) for i in range(6000) if (i + 1) % 50]
    rows += [(100_000, [0.5, 0.5, 0.5])] * 6 + [(7, [0.1, 0.2, 0.3])] * 5000
    assert run(spark, rows, kind="double") == brute(rows)


@pytest.mark.parametrize("copies", [1, 6, 30])
def test_own_rows_fill_a_cell(spark, monkeypatch, copies):
    """A query's own rows are no neighbours, so they say nothing of the floor."""
    monkeypatch.setattr(tk, "CELL_ROWS", 1)
    rng = np.random.default_rng(4)
    centres = 4 * np.eye(8)
    rows = [(i + 1, (centres[i % 6] * 0.3 + rng.normal(size=8) * 0.02).tolist()) for i in range(40)]
    tight = (centres[7] * 3).tolist()
    rows += [*[(1000, tight)] * copies, *((2001 + j, tight) for j in range(2))]
    assert run(spark, rows, kind="double", asks="id = 1000") == brute(rows, asks=lambda i: i == 1000)


def test_bounds_prune_clusters(spark):
    """Of clustered vectors, queries go to few cells (and results stay exact)."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(8, 16)) * 4
    c = tk.pivots_of(np.vstack([x + rng.normal(size=(40, 16)) * 0.01 for x in centres]), 8)
    assert len(c) == 8 and all(np.abs(c - x).max(axis=1).min() < 0.05 for x in centres)
