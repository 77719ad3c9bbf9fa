"""Resolving what a linkage agent returns, and comparing metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _whole(out: DataFrame, missing: str) -> DataFrame:
    """An error at run time if a position has no row, as dropped rows would go unnoticed."""
    return out.where(
        F.when(
            F.col(missing).isNull(),
            F.raise_error(
                F.concat(F.lit("no row for position "), F.coalesce(F.col("position").cast("string"), F.lit("null")))
            ),
        ).otherwise(F.lit(True))
    )


def resolve_links(links: DataFrame, people: DataFrame) -> DataFrame:
    """links (LINK_ID, position), people (position, record_id): LINK_ID, PATID."""
    out = links.join(people.select("position", "record_id"), "position", "left")
    return _whole(out, "record_id").select("LINK_ID", F.col("record_id").alias("PATID"))


def resolve_households(links: DataFrame, households: DataFrame) -> DataFrame:
    """links (HOUSEHOLD_ID, position), households (household_position, record_ids): a row for each member."""
    own = households.select(F.col("household_position").alias("position"), "record_ids")
    out = _whole(links.join(own, "position", "left"), "record_ids")
    return out.select("HOUSEHOLD_ID", F.explode(F.split("record_ids", ",")).alias("PATID"))


def metadata_issues(source: dict, linkage: dict) -> list[str]:
    """What differs between two metadata documents, key by key."""
    out = []
    for key in sorted(source.keys() | linkage.keys()):
        if key not in linkage:
            out.append(f"{key} is in the source only")
        elif key not in source:
            out.append(f"{key} is in the linkage archive only")
        elif source[key] != linkage[key]:
            out.append(f"{key} differs: {source[key]} and {linkage[key]}")
    return out


def metadata_diff(source: DataFrame, linkage: DataFrame) -> DataFrame:
    """The same on tables (key, value): key, issue, source_value, linkage_value."""
    both = source.select("key", F.col("value").alias("source_value"), F.lit(True).alias("s")).join(
        linkage.select("key", F.col("value").alias("linkage_value"), F.lit(True).alias("l")), "key", "full_outer"
    )
    issue = F.when(F.col("l").isNull(), "source only").when(F.col("s").isNull(), "linkage only").when(
        ~F.col("source_value").eqNullSafe(F.col("linkage_value")), "differs"
    )
    return both.withColumn("issue", issue).where("issue is not null").select(
        "key", "issue", "source_value", "linkage_value"
    )
