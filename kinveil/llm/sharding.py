"""Sharding by Karmarkar-Karp differencing: shards of nearly equal bytes, equal texts kept together.

Every group of equal texts is a partial partition: its bytes in one part, nothing in the others. Two
partial partitions combine by adding the largest part of one to the smallest of the other, and so on
(oppositely ordered); differencing always combines those of the largest spread. That needs a queue,
so it works in levels: groups are dealt by hash into cells of about CELL, each cell differences its
own into one partial partition, and those meet again FAN at a time until one is left. What a task
holds is bounded at each level and the last level's spread is that of a few small numbers.

Shard and slot come back down by joins: group -> part of its cell -> ... -> shard. Slots count up by
cell, group, and a share of the group's rows (kinveil.llm._number), so that a group of copies that holds
a third of all rows is numbered by many tasks.

Edge cases: null text counts as no bytes and shares a group with empty text; a group larger than a
shard's fair share has its shard to itself as far as differencing can tell; rows of one id are rows
like any others; extra columns pass through; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinveil.llm._number import numbered
from kinveil.llm._text import replaced
from kinveil.operators.skew import join_groups
from kinveil.operators.staging import stage

CELL = 4096
FAN = 128


def difference(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """parts[i, j]: bytes of part j of partial partition i. Returns to[i, j], the part of the result
    that takes part j of i, and the result's bytes. Ties go by position, so equal input, equal output."""
    n, k = parts.shape
    sums, heap = list(parts.astype(np.int64)), []
    for i in range(n):
        heapq.heappush(heap, (-int(sums[i].max() - sums[i].min()), i))
    made = []
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        pa, pb = np.argsort(-sums[a], kind="stable"), np.argsort(sums[b], kind="stable")
        both = sums[a][pa] + sums[b][pb]
        made.append((a, b, pa, pb))
        sums[a] = sums[b] = None
        sums.append(both)
        heapq.heappush(heap, (-int(both.max() - both.min()), len(sums) - 1))
    to: list = [None] * len(sums)
    to[-1] = np.arange(k)
    for at in range(len(made) - 1, -1, -1):
        a, b, pa, pb = made[at]
        here = to[n + at]
        for child, order in ((a, pa), (b, pb)):
            to[child] = np.empty(k, np.int64)
            to[child][order] = here
    return np.array(to[:n]), sums[-1]


def _cell(shards: int):
    """One cell's groups (cell, g1, g2, n, bytes) with their part, and the rows and bytes before them in it."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["g1", "g2"], ignore_index=True)
        parts = np.zeros((len(pdf), shards), np.int64)
        parts[:, 0] = pdf["bytes"]
        pdf["part"] = difference(parts)[0][:, 0].astype(np.int32)
        pdf["before"] = pdf.groupby("part")["n"].cumsum() - pdf["n"]
        return pdf

    return run


def _meet(shards: int):
    """Partial partitions (cell, part, bytes) of one upper cell: to which part of it each part goes."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        wide = pdf.pivot_table(
            index="cell", columns="part", values="bytes", aggfunc="sum", fill_value=0
        ).reindex(columns=range(shards), fill_value=0).sort_index()
        to, sums = difference(wide.to_numpy(np.int64))
        n = len(wide)
        return pd.DataFrame(
            {
                "upper": np.full(n * shards, pdf["upper"].iloc[0]),
                "cell": np.repeat(wide.index.to_numpy(), shards),
                "part": np.tile(np.arange(shards, dtype=np.int32), n),
                "to": to.ravel().astype(np.int32),
                "bytes": sums[to.ravel()],
            }
        )

    return run


def shard(docs: DataFrame, shards: int = 24, text_col: str = "text") -> DataFrame:
    """docs without the text, with `size`, `text_crc32`, `shard` and `slot`."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    others = replaced([c for c in docs.columns if c != text_col], ("size", "text_crc32", "shard", "slot"))
    g1, g2, size, row = "__sh_g1", "__sh_g2", "__sh_size", "__sh_row"
    measures = (
        (F.octet_length(text).cast("long") + 8).alias(size),
        F.crc32(text.cast("binary")).alias("__sh_crc"),
        F.xxhash64(text).alias(g1),
        F.xxhash64(F.lit(17), text).alias(g2),
    )
    rows = stage(docs.select(*others, *measures, F.monotonically_increasing_id().alias(row)), "sizes")
    groups = rows.groupBy(F.col(g1).alias("g1"), F.col(g2).alias("g2")).agg(
        F.count("*").alias("n"), F.sum(size).alias("bytes")
    )
    groups = stage(groups, "groups")
    cells = max(1, -(-groups.count() // CELL))
    leaf = stage(
        groups.withColumn("cell", F.pmod("g1", F.lit(cells))).groupBy("cell").applyInPandas(
            _cell(shards), "g1 long, g2 long, n long, bytes long, cell long, part int, before long"
        ),
        "cells",
    )

    level = leaf.groupBy("cell", "part").agg(F.sum("bytes").alias("bytes"))
    goes, width = None, cells
    while True:
        met = level.withColumn("upper", F.expr(f"cell div {FAN}")).groupBy("upper").applyInPandas(
            _meet(shards), "upper long, cell long, part int, to int, bytes long"
        )
        met = stage(met, "met")
        step = met.select("upper", "cell", "part", "to")
        goes = step if goes is None else goes.join(
            step.select(
                F.col("upper").alias("u2"),
                F.col("cell").alias("upper"),
                F.col("part").alias("to"),
                F.col("to").alias("t2"),
            ),
            ["upper", "to"],
        ).select(F.col("u2").alias("upper"), "cell", "part", F.col("t2").alias("to"))
        width = -(-width // FAN)
        if width <= 1:
            break
        level = met.select(F.col("upper").alias("cell"), F.col("to").alias("part"), "bytes").distinct()

    counts = leaf.groupBy("cell", "part").agg(F.sum("n").alias("n"))
    base = counts.join(goes, ["cell", "part"]).withColumn(
        "base", F.sum("n").over(W.partitionBy("to").orderBy("cell").rowsBetween(W.unboundedPreceding, 0)) - F.col("n")
    )
    ends = base.select("cell", "part", F.col("to").alias("shard"), "base")
    first = (F.col("base") + F.col("before")).alias("__sh_slot")
    placed = leaf.join(ends, ["cell", "part"]).select(
        F.col("g1").alias(g1),
        F.col("g2").alias(g2),
        F.col("shard").alias("__sh_to"),
        first,
        F.col("n").alias("__sh_n"),
        F.col("n").alias("__sh_rows"),
    )
    placed = stage(placed, "placed")
    both = join_groups(rows, placed, [g1, g2], "__sh_rows", rows.count())
    copied = stage(both.where("__sh_n > 1"), "copied")
    many = numbered(copied, [g1, g2], "__sh_n", row, "__sh_rank").withColumn(
        "__sh_slot", F.col("__sh_slot") + F.col("__sh_rank")
    )
    keep = [
        *(F.col(c) for c in others),
        F.col(size).alias("size"),
        F.col("__sh_crc").alias("text_crc32"),
        F.col("__sh_to").cast("int").alias("shard"),
        F.col("__sh_slot").cast("long").alias("slot"),
    ]
    return reduce(DataFrame.unionAll, [both.where("__sh_n = 1").select(*keep), many.select(*keep)])


def op3_sharding(spark, sf_dir: str) -> DataFrame:
    out = shard(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), 24)
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
