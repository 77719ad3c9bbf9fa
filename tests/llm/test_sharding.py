import itertools
import zlib

import numpy as np

from kinveil.llm import _number
from kinveil.llm import sharding as sh


def check(rows, got, shards):
    assert len(got) == len(rows)
    sizes = {}
    for r in got:
        sizes.setdefault(r.shard, []).append((r.slot, r.size))
    for s in sizes.values():
        assert sorted(x[0] for x in s) == list(range(len(s)))
    where = {}
    for r in got:
        where.setdefault(r.text_crc32, set()).add(r.shard)
    assert all(len(x) == 1 for x in where.values())
    return [sum(x[1] for x in sizes.get(k, [])) for k in range(shards)]


def test_difference_two_ways():
    to, sums = sh.difference(np.array([[8, 0], [7, 0], [6, 0], [5, 0], [4, 0]]))
    assert sorted(sums.tolist()) == [14, 16]  # the textbook example
    for seed in range(20):
        x = np.random.default_rng(seed).integers(1, 50, 8)
        parts = np.zeros((8, 3), int)
        parts[:, 0] = x
        to, sums = sh.difference(parts)
        assert [x[to[:, 0] == k].sum() for k in range(3)] == sums.tolist()
        best = min(max(np.bincount(p, x, 3)) for p in itertools.product(range(3), repeat=8))
        assert sums.max() <= best * 7 / 6 + 1


def test_shards(spark, monkeypatch):
    monkeypatch.setattr(sh, "CELL", 16)
    monkeypatch.setattr(sh, "FAN", 4)
    monkeypatch.setattr(_number, "SALTED", 8)
    rng = np.random.default_rng(1)
    rows = [(i, "x" * int(rng.integers(0, 400)) + str(i)) for i in range(1500)]
    rows += [(2000 + i, "same") for i in range(100)] + [(3000, None), (3001, ""), (3001, ""), (None, "no id")]
    df = spark.createDataFrame([(*r, 1, "y") for r in rows], "doc_id long, text string, n int, part string")
    got = sh.shard(df.repartition(3), 5).collect()
    sums = check(rows, got, 5)
    assert max(sums) - min(sums) <= 0.002 * sum(sums) / 5  # cells of 16 groups leave more than those of 4096
    assert {r.size for r in got if r.doc_id == 3000} == {8} and all(r.text_crc32 == zlib.crc32(b"same") for r in got if 2000 <= (r.doc_id or 0) < 2100)
    again = {r.text_crc32: r.shard for r in sh.shard(df, 5).collect()}
    assert all(again[r.text_crc32] == r.shard for r in got)
    assert sh.shard(spark.createDataFrame([], df.schema), 5).count() == 0
    assert {r.shard for r in sh.shard(df.limit(1), 5).collect()} <= set(range(5))


def test_repeated_rows_are_split_and_columns_may_clash(spark, monkeypatch):
    """Rows that repeat id and text are dealt over shares too; input columns give way to outputs."""
    monkeypatch.setattr(_number, "SALTED", 50)
    rows = [(7, "same", 1, "x")] * 1000 + [(i, f"t{i}", 2, None) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, Size int, slot string").repartition(4)
    got = sh.shard(df, 3)
    assert got.columns == ["doc_id", "size", "text_crc32", "shard", "slot"]
    check(rows, got.collect(), 3)
    numbers = spark.range(1000).selectExpr("id as row", "0 as k", "1000L as n")
    dealt = _number.numbered(numbers, ["k"], "n", "row", "at")
    assert sorted(r.at for r in dealt.collect()) == list(range(1000))
