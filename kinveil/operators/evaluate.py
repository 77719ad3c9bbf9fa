"""Scoring households against an answer key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = "map<string, array<struct<record_id: string, seed_record_id: string, household_id: string, file_name: string>>>"


def answer_key(documents: DataFrame, column: str = "value") -> DataFrame:
    """Rows of answer-key documents (JSON text): distinct record_id, seed_record_id, household_id, file_name."""
    parsed = documents.select(F.from_json(column, KEY).alias("m"))
    return parsed.select(
        F.explode(F.map_values("m")).alias("a")
    ).select(F.explode("a").alias("r")).select("r.*").distinct()


def site_key(key: DataFrame, site_ids: DataFrame) -> DataFrame:
    return key.join(site_ids.select("record_id").distinct(), "record_id", "left_semi")


def position_households(pos_pid: DataFrame, key: DataFrame) -> DataFrame:
    """HOUSEHOLD_POSITION, HOUSEHOLD_ID: pos_pid (household_position, pid), key (record_id, household_id,
    line); of several lines of a record the last counts. A pid without a key is an error."""
    last = key.groupBy(F.col("record_id").alias("pid")).agg(F.max_by("household_id", "line").alias("hid"))
    out = pos_pid.join(last, "pid", "left")
    ok = F.when(
        F.col("hid").isNull(), F.raise_error(F.concat(F.lit("no key for "), F.coalesce("pid", F.lit("null"))))
    ).otherwise(F.lit(True))
    return out.where(ok).select(
        F.col("household_position").alias("HOUSEHOLD_POSITION"), F.col("hid").alias("HOUSEHOLD_ID")
    )


def by_site(ids: DataFrame, sites: list[str]) -> DataFrame:
    """ids (site, household_id): a row for each household id, which stands in the columns of its sites."""
    return ids.groupBy("household_id").pivot("site", sites).agg(F.first("household_id")).select(*sites)


def score(scored: DataFrame, mapping: DataFrame, key: DataFrame) -> DataFrame:
    """precision, recall, fscore. scored (household_position, pid, line): the last pid of a household
    counts; mapping (household_position, household_id); key (pid, household_id). Recall is over all
    pairs of the key although one pid a household is looked at, so it can't reach 1 with larger ones."""
    last = scored.groupBy("household_position").agg(F.max_by("pid", "line").alias("pid"))
    true = key.select("pid", "household_id", F.lit(1).alias("hit")).distinct()
    seen = last.join(mapping, "household_position").join(true, ["pid", "household_id"], "left")
    sums = seen.agg(
        F.count("hit").alias("tp"), F.count("*").alias("n")
    ).join(F.broadcast(true.agg(F.count("*").alias("total"))))
    rates = sums.select(
        "tp",
        (F.col("n") - F.col("tp")).alias("fp"),
        (F.col("total") - F.col("tp")).alias("fn"),
        F.try_divide("tp", "n").alias("precision"),
        F.try_divide("tp", "total").alias("recall"),
    )
    return rates.withColumn(
        "fscore", F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    )


def pair_score(found: DataFrame, true: DataFrame) -> DataFrame:
    """Precision and recall over pairs in one household, by counts; found, true: (pid, household)."""
    pairs = (
        lambda df,
        *by: df.groupBy(*by).agg(F.count("*").alias("n")).agg(
            F.coalesce(F.sum(F.expr("n * (n - 1) div 2")), F.lit(0)).alias("p")
        )  # noqa: E731,
    )
    both = found.withColumnRenamed("household", "f").join(true.withColumnRenamed("household", "t"), "pid")
    out = pairs(both, "f", "t").withColumnRenamed("p", "tp").join(
        F.broadcast(pairs(both, "f").withColumnRenamed("p", "found"))
    ).join(F.broadcast(pairs(both, "t").withColumnRenamed("p", "true")))
    return out.select(
        "tp",
        "found",
        "true",
        F.try_divide("tp", "found").alias("precision"),
        F.try_divide("tp", "true").alias("recall"),
    )
