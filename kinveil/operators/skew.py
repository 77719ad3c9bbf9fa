"""Joins of many rows to one row a key, where a few keys may have most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys of more than one in SHARE of all rows are hot; there are fewer than SHARE of them, whatever the data.
SHARE = 256


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """rows joined (inner) with groups, without groups' column `count`.

    groups has one row a key, and in `count` how many of the `total` rows have that key. Rows of hot keys
    meet their group by broadcast and stay where they are; all others meet in a shuffle in which no key
    has more than a SHARE-th of the rows. Both tables are read more than once and should be staged."""
    hot = groups.where(F.col(count) * SHARE > total).drop(count)
    rest = groups.where(F.col(count) * SHARE <= total).drop(count)
    there = rows.join(F.broadcast(hot), keys)
    others = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(rest, keys)
    return there.unionByName(others)


def hot_keys(rows: DataFrame, key: str, total: int) -> list[int]:
    """The keys of more than one in SHARE of `total` rows; fewer than SHARE, so they can go by the driver."""
    counted = rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") * SHARE > total)
    return sorted(r[0] for r in counted.select(key).limit(SHARE).collect())


def join_least(rows: DataFrame, groups: DataFrame, key: str, hot: list[int]) -> DataFrame:
    """rows joined (inner) with groups, one row a key, where hot_keys() were found: those meet by broadcast."""
    if not hot:
        return rows.join(groups, key)
    few = F.broadcast(rows.sparkSession.createDataFrame([(k,) for k in hot], f"{key} long"))
    there = rows.join(few, key).join(F.broadcast(groups.join(few, key, "left_semi")), key)
    return there.unionByName(rows.join(few, key, "left_anti").join(groups.join(few, key, "left_anti"), key))
