"""Numbers for the rows of a key, however many rows the key has."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows of one key that one task numbers, about, and most shares of one key.
SALTED, SHARES = 512, 1 << 14


def numbered(rows: DataFrame, keys: list[str], count: str, row: str, out: str) -> DataFrame:
    """rows, a written table, with `out`: 0, 1, 2, .. within each key (keys are never null), in no particular
    order. `count`: how many rows the key has; `row`: a number of its own for every row.

    A key's rows are dealt over shares by row number, which also splits rows that are all equal; shares
    are counted, and each numbers its own rows from where the shares before it end."""
    share, ahead, at = "__nm_share", "__nm_ahead", "__nm_at"
    # Dealt anew: else a partitioning by key alone would do for what follows.
    dealt = rows.withColumn(
        share, F.pmod(F.xxhash64(row), F.expr(f"least(`{count}` div {SALTED}, {SHARES - 1}) + 1"))
    ).repartition(*keys, share)
    sums = dealt.groupBy(*keys, share).agg(F.count("*").alias("__nm_n"))
    before = F.sum("__nm_n").over(
        W.partitionBy(*keys).orderBy(share).rowsBetween(W.unboundedPreceding, 0)
    ) - F.col("__nm_n")
    within = F.row_number().over(W.partitionBy(*keys, share).orderBy(row)) - 1
    both = dealt.withColumn(at, within).join(sums.select(*keys, share, before.alias(ahead)), [*keys, share])
    return both.withColumn(out, F.col(ahead) + F.col(at)).drop(share, ahead, at)
