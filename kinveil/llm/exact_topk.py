"""Exact top-k by inner product: a Voronoi kNN join.

Pivots (at most PIVOTS, and one for each CELL_ROWS vectors) come from a k-means++ start and a few Lloyd
steps over a bounded sample: the SAMPLE vectors a pivot of the least id hashes, SAMPLE_BYTES at most.
Every vector belongs to its nearest pivot. A cell is summed up by its count, its radius and its least
and greatest norm. For a query q and a member x of the cell of pivot c, with d = |q - c| and radius r,
the inner product is at most the least of q.c + |q| r, |q| max|x|, and (|q|^2 + max|x|^2 - max(0, d - r)^2) / 2
(its distance form, in which large norms rank as near), and lower ends follow alike. The lower ends,
counted up over cells until k members besides the query's own rows are held, give a score that k
members certainly reach; only cells whose upper end is no lower get the query. Summaries are bounded
by the number of pivots, whatever the data.

Cells are solved in blocks: a cell's rows are dealt over blocks of about BLOCK by row number, so that a
vector that makes up a third of all rows is many blocks. Data stay in their block, queries are sent to
every block of the cells they need; a task holds one block and lets the queries pass by in batches. A
window that Spark limits in each task first merges the k best per block.

Scores are exact: components are integers, multiplied in floating point where all sums stay below
2**53, else (vectors with very large components, kept in a cell that every query visits) as Python
integers. A score that no 64-bit integer holds is ranked by its value and returned as null.

Edge cases: vectors that are null or hold a null or a non-finite component take no part, as query or
candidate; empty vectors have score 0 with all others; vectors of other lengths are extended by zeros; a
query's own row is no candidate, rows that repeat its id are none either; queries that repeat an id are
one query, whose score with a candidate is the best of its vectors'; candidate rows that repeat an id
count one by one; fewer than k candidates give fewer rows; ties go to the smaller id; no queries or no
data give an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinveil.llm._text import arrow_map
from kinveil.operators.staging import stage

PIVOTS = 1024
BLOCK = 4096
#: Spread over fewer cells than these many rows each, pivots say nothing.
CELL_ROWS = 1024
#: Vectors of the sample for each pivot, and most bytes of the sample.
SAMPLE, SAMPLE_BYTES = 32, 32 << 20
STEPS = 5
#: Queries that are multiplied with a block at a time.
TURN = 256


def finite(embedding: Column) -> Column:
    """The vector as array<double>; null for one that takes no part."""
    x = embedding.cast("array<double>")
    ok = F.forall(x, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < float("inf")), F.lit(False)))
    return F.when(ok, x)


class Vectors:
    """Vectors as rows of whole numbers: a matrix of doubles, and for those with components beyond `limit`
    (zero rows there) lists of Python integers."""

    def __init__(self, column: pa.Array, dims: int, scale: int):
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        flat, per = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
        self.w = np.zeros((len(column), dims))
        row = np.repeat(np.arange(len(per)), per)
        at = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
        with np.errstate(over="ignore"):
            self.w[row, at] = np.floor(flat * scale)
        limit = math.sqrt(2**52 / max(dims, 1))
        self.large = {}
        for i in np.flatnonzero((np.abs(self.w) > limit).any(axis=1)).tolist():
            self.large[i] = [
                math.floor(Fraction(float(x)) * scale) for x in flat[row == i]
            ] + [0] * (dims - int(per[i]))
            self.w[i] = 0

    def integers(self, i: int) -> list[int]:
        return self.large[i] if i in self.large else [int(x) for x in self.w[i]]


def _wide(score: int) -> bytes:
    """Byte strings that sort as the integers they stand for, among those of one sign."""
    size = (abs(score).bit_length() + 7) // 8
    raw = size.to_bytes(4, "big") + abs(score).to_bytes(size, "big")
    return raw if score >= 0 else bytes(255 - x for x in raw)


def best(w: np.ndarray, row: np.ndarray, ids: np.ndarray, me: int, k: int) -> list[tuple[int, int, int]]:
    """The k best (score, id, row) of one query; w: its scores with rows in order of id."""
    own = int(np.searchsorted(ids, me, "right") - np.searchsorted(ids, me, "left"))
    n = min(len(w), k + own)
    low = np.partition(w, len(w) - n)[len(w) - n] if n else 0
    at = np.flatnonzero(w >= low)
    at = at[ids[at] != me]
    at = at[np.argsort(-w[at], kind="stable")][:k]
    return [(int(w[i]), int(ids[i]), int(row[i])) for i in at.tolist()]


def pivots_of(sample: np.ndarray, n: int) -> np.ndarray:
    """At most n centres of the sample: k-means++ and STEPS Lloyd steps, from a fixed start."""
    rng = np.random.Generator(np.random.PCG64(8))
    sample = np.unique(sample, axis=0)
    square = (sample * sample).sum(1)
    far = lambda c: np.maximum(square[:, None] - 2 * sample @ c.T + (c * c).sum(1), 0)
    chosen = [int(rng.integers(len(sample)))]
    near = far(sample[chosen])[:, 0]
    while len(chosen) < min(n, len(sample)) and near.sum() > 0:
        chosen.append(int(rng.choice(len(sample), p=near / near.sum())))
        near = np.minimum(near, far(sample[chosen[-1:]])[:, 0])
    c = sample[chosen]
    for _ in range(STEPS):
        at = far(c).argmin(1)
        count = np.bincount(at, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, at, sample)
        c = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], c)
    return c


PLACED = "row long, id long, v array<double>, cell int, far double, norm double"
LOCAL = "query_id long, row long, vec_id long, side int, score long, wide binary"


def knn(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, pivots: int = PIVOTS) -> DataFrame:
    """vectors, queries: (id long, v array<double> or null). Inner products of floor(scale * component).
    Returns query_id, rank, vec_id, score."""
    vectors = stage(
        vectors.where("id is not null and v is not null").select(
            F.monotonically_increasing_id().alias("row"), "id", "v"
        ),
        "vectors",
    )
    queries = stage(
        queries.where("id is not null and v is not null").select("id", "v").dropDuplicates(["id", "v"]), "queries"
    )
    schema = "query_id long, rank int, vec_id long, score long"
    spark = vectors.sparkSession
    total, dims = vectors.agg(F.count("*"), F.max(F.size("v"))).first()
    asking, several, q_dims = queries.agg(
        F.count("*"), F.count("*") > F.countDistinct("id"), F.max(F.size("v"))
    ).first()
    if not total or not asking:
        return spark.createDataFrame([], schema)
    dims = max(dims, q_dims)
    wanted = int(min(pivots, max(1, total // CELL_ROWS)))
    rows = int(min(SAMPLE * wanted, max(wanted, SAMPLE_BYTES // (8 * max(dims, 1)))))
    some = Vectors(vectors.orderBy(F.xxhash64("id"), "row").limit(rows).select("v").toArrow().column(0), dims, scale)
    ordinary = np.delete(some.w, list(some.large), axis=0)
    c = pivots_of(ordinary, wanted) if len(ordinary) else np.zeros((1, dims))
    c_norm, apart = (c * c).sum(1), len(c)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = Vectors(batch.column(2), dims, scale)
            at = np.maximum((x.w * x.w).sum(1)[:, None] - 2 * x.w @ c.T + c_norm, 0).argmin(1).astype(np.int32)
            # The distance itself without cancellation, and a little more than it.
            far, norm = np.sqrt(((x.w - c[at]) ** 2).sum(1)) * (1 + 1e-9), np.sqrt((x.w * x.w).sum(1))
            large = list(x.large)
            at[large], far[large], norm[large] = apart, np.inf, np.inf
            yield pa.record_batch(
                [*batch.columns, pa.array(at), pa.array(far), pa.array(norm)],
                names=[f.split()[0] for f in PLACED.split(", ")],
            )

    placed = stage(arrow_map(vectors, nearest, PLACED), "cells")
    n, far, least, most = np.zeros(apart + 1, np.int64), *(np.zeros(apart + 1) for _ in range(3))
    for r in placed.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("far").alias("far"), F.min("norm").alias("least"), F.max("norm").alias("most")
    ).collect():
        n[r.cell], far[r.cell], least[r.cell], most[r.cell] = r.n, r.far, r.least, r.most
    blocks = np.maximum(1, -(-n // BLOCK))
    own = placed.groupBy("id").agg(F.count("*").alias("own")).join(queries.select("id").distinct(), "id", "left_semi")

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = Vectors(batch.column(1), dims, scale)
            q, q2 = x.w, (x.w * x.w).sum(1)[:, None]
            qn, mid = np.sqrt(q2), q @ c.T
            d = np.sqrt(np.maximum(q2 - 2 * mid + c_norm, 0))
            r, lo, hi = far[:apart], least[:apart], most[:apart]
            # A little slack for rounding: bounds only choose cells.
            slack = 1e-3 + 1e-9 * (q2 + hi**2 + c_norm)
            high = np.minimum(np.minimum(mid + qn * r, qn * hi), (q2 + hi**2 - np.maximum(d - r, 0) ** 2) / 2) + slack
            low = np.maximum(np.maximum(mid - qn * r, -qn * hi), (q2 + lo**2 - (d + r) ** 2) / 2) - slack
            ends = np.full((len(q), 1), np.inf)
            low, high = np.hstack([low, -ends]), np.hstack([high, ends])
            large = list(x.large)
            low[large], high[large] = -np.inf, np.inf
            order = np.argsort(-low, axis=1)
            held = np.cumsum(n[order], axis=1)
            need = k + np.nan_to_num(batch.column(2).to_numpy(zero_copy_only=False).astype(np.float64))[:, None]
            floor = np.take_along_axis(low, order, 1)[np.arange(len(q)), (held >= need).argmax(1)]
            floor = np.where((held >= need).any(axis=1), floor, -np.inf)
            row, cell = np.nonzero((high >= floor[:, None]) & (n > 0))
            yield pa.record_batch(
                [
                    batch.column(0).take(pa.array(row)),
                    batch.column(1).take(pa.array(row)),
                    pa.array(cell.astype(np.int32)),
                    pa.array(blocks[cell]),
                ],
                names=["id", "v", "cell", "blocks"],
            )

    asked = arrow_map(
        queries.join(own, "id", "left").select("id", "v", "own"),
        reach,
        "id long, v array<double>, cell int, blocks long",
    )
    asked = asked.select(
        "cell",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        F.lit(1).alias("kind"),
        F.lit(None).cast("long").alias("row"),
        "id",
        "v",
    )
    of = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), F.col("cell") + 1)
    data = placed.select(
        "cell", F.pmod(F.xxhash64("row"), of).cast("long").alias("block"), F.lit(0).alias("kind"), "row", "id", "v"
    )
    both = data.unionByName(asked).repartition("cell", "block").sortWithinPartitions(
        "cell", "block", "kind", "id", "row"
    )

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, x, ids, rows = None, [], None, None, None
        for batch in batches:
            cell, block, kind = (batch.column(i).to_numpy() for i in range(3))
            edge = np.flatnonzero(
                np.concatenate(
                    [[True], (cell[1:] != cell[:-1]) | (block[1:] != block[:-1]) | (kind[1:] != kind[:-1]), [True]]
                )
            )
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                part = batch.slice(a, b - a)
                if (cell[a], block[a]) != key:
                    key, held, x = (cell[a], block[a]), [], None
                if not kind[a]:
                    held.append(part)
                    continue
                if not held and x is None:
                    continue
                if x is None:
                    table = pa.Table.from_batches(held)
                    x, ids, rows, held = (
                        Vectors(table.column("v"), dims, scale),
                        table.column("id").to_numpy(),
                        table.column("row").to_numpy(),
                        [],
                    )
                for t in range(0, len(part), TURN):
                    yield from _solved(part.slice(t, TURN), x, ids, rows, k, dims, scale)

    local = arrow_map(both, solve, LOCAL)
    order = [F.desc("side"), F.desc("score"), F.desc("wide"), F.asc("vec_id")]
    if several:
        local = local.withColumn(
            "nth", F.row_number().over(W.partitionBy("query_id", "row").orderBy(*order))
        ).where("nth = 1")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(*order))
    return local.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _solved(
    part: pa.RecordBatch, x: Vectors, ids: np.ndarray, rows: np.ndarray, k: int, dims: int, scale: int
) -> Iterator[pa.RecordBatch]:
    q, own, out = Vectors(part.column(5), dims, scale), part.column(4).to_numpy(), []
    plain = np.ones(len(ids), bool)
    plain[list(x.large)] = False
    scores = q.w @ x.w[plain].T
    for i, me in enumerate(own.tolist()):
        if i in q.large:
            found, exact = [], range(len(ids))
        else:
            found, exact = best(scores[i], rows[plain], ids[plain], me, k), x.large
        if len(exact):
            mine = q.integers(i)
            found += [
                (sum(a * b for a, b in zip(mine, x.integers(j), strict=True)), int(ids[j]), int(rows[j]))
                for j in exact if ids[j] != me
            ]
            found = sorted(found, key=lambda f: (-f[0], f[1]))[:k]
        for score, vec, row in found:
            side = 0 if -(2**63) <= score < 2**63 else 1 if score > 0 else -1
            out.append((me, row, vec, side, None if side else score, _wide(score) if side else None))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
    yield pa.record_batch(
        [pa.array([o[c] for o in out], t) for c, t in enumerate(kinds)], names=[f.split()[0] for f in LOCAL.split(", ")]
    )


def op8_exact_topk(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        F.col("vec_id").cast("long").alias("id"), finite(F.col("embedding")).alias("v")
    )
    return knn(rows, rows.where("id % 50 = 0"), 5)


OP8_SQL = """
with e as (select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) v from embeddings
           where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id query_id, e.vec_id, cast(list_sum(list_transform(generate_series(1, len(q.v)), lambda i: q.v[i] * e.v[i])) as bigint) score
      from e q, e where q.vec_id % 50 = 0 and e.vec_id <> q.vec_id),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) "rank" from s)
select query_id, "rank", vec_id, score from r where "rank" <= 5
"""
