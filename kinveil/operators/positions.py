"""Dense row numbers without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinveil.operators.staging import stage


def with_position(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """df with 0, 1, .. in the order of columns that together tell rows apart. Ranges are numbered each
    by itself, after the rows of the ranges before; there are at most as many as shuffle partitions, and AQE joins
    small ones that are neighbours."""
    dealt = stage(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "ranges")
    ahead = dealt.groupBy("__range").agg(F.count("*").alias("__n"))
    ahead = ahead.select(
        "__range",
        (F.sum("__n").over(W.orderBy("__range").rowsBetween(W.unboundedPreceding, 0)) - F.col("__n")).alias("__ahead"),
    )
    nth = F.row_number().over(W.partitionBy("__range").orderBy(*order)) - 1
    return dealt.join(F.broadcast(ahead), "__range").withColumn(
        name, (F.col("__ahead") + nth).cast("long")
    ).drop("__range", "__ahead")
