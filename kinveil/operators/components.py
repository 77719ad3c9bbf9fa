"""Connected components of an edge table, by alternating large and small stars.

Each round every node tells its larger neighbours, then its smaller ones, the least node it knows.
Rounds grow with the logarithm of the longest path; each ends in a written table, so lineage stays
short and a lost executor costs one round. Sums and minima combine before the shuffle. A node of very
many edges (a star's centre) gets its answer by broadcast, so its edges are never gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinveil.operators.skew import hot_keys, join_least
from kinveil.operators.staging import discard, stage


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an edge; component is its least node. Edges with a null end
    and loops are ignored (a node with a loop only is no row); repeated edges count once."""
    ends = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"), F.col(a), F.col(b))
    now = ends.where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("hi") > F.col("lo"))
    ).select("hi", "lo").distinct()
    now = stage(now, "edges")
    total, before = now.count(), None
    for _ in range(rounds):
        ends = F.col("hi").alias("u"), F.col("lo").alias("v")
        both = now.select(*ends).unionAll(now.select(ends[1].alias("u"), ends[0].alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = join_least(both, least, "u", hot_keys(both, "u", 2 * total)).where("v > u and v <> m")
        # Every edge of the large star leaves a node for a smaller one.
        large = stage(large.select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct(), "large")
        down = large.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = join_least(large, down, "hi", hot_keys(large, "hi", large.count())).where("lo <> m")
        moved = moved.select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        small = stage(moved.unionAll(down.select("hi", F.col("m").alias("lo"))).distinct(), "stars")
        discard(now, large)
        now = small
        total, mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first()
        if (total, mark) == before:
            break
        before = total, mark
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )


#: Edges that one task holds together, about.
AT_ONCE = 1 << 20


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) for the nodes of these edges that aren't least."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v, of = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    while len(u):
        u, v = of[u], of[v]
        apart = u != v
        u, v = u[apart], v[apart]
        np.minimum.at(of, np.maximum(u, v), np.minimum(u, v))
        while (of[of] != of).any():
            of = of[of]
    moved = of != np.arange(len(nodes))
    return nodes[moved], nodes[of[moved]]


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: fewer edges of the same components; whenever AT_ONCE are held they are reduced, and given out
    if that leaves more than half of them."""

    def give(hi: np.ndarray, lo: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"hi": hi, "lo": lo})

    held, n = [], 0
    for batch in batches:
        a, b = (batch.column(i).drop_null().to_numpy() for i in (0, 1))
        held.append((a, b))
        n += len(a)
        if n >= AT_ONCE:
            hi, lo = roots(*map(np.concatenate, zip(*held, strict=True)))
            held, n = [(hi, lo)], len(hi)
            if 2 * n > AT_ONCE:
                yield give(hi, lo)
                held, n = [], 0
    if n:
        yield give(*roots(*map(np.concatenate, zip(*held, strict=True))))


def gathered(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """components() of a graph with few nodes for its edges. Each task leaves a forest of its edges, which fewer tasks
    take in turn, none more than about AT_ONCE. The last forest is the answer; one too large for a task goes on in
    the rounds of components()."""
    schema = "hi long, lo long"
    ends = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    now = stage(ends.select(F.col(a).cast("long"), F.col(b).cast("long")).mapInArrow(_forest, schema), "forest")
    total = now.count()
    while True:
        tasks = -(-total // AT_ONCE)
        fewer = stage(now.coalesce(max(1, tasks)).mapInArrow(_forest, schema), "forest")
        discard(now)
        now, before = fewer, total
        if tasks <= 1:
            break
        total = now.count()
        if total > AT_ONCE and 2 * total > before:
            return components(now.toDF("a", "b"))
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )
