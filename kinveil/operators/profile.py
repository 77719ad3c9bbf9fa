"""Data profiles: counts, frequencies, lengths, characters, dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinveil.functions import clean
from kinveil.operators.staging import discard, stage

#: Texts that CSV readers commonly take for missing.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
PROFILED = ("given_name", "family_name", "household_street_address", "household_zip", "phone_number")
FLOOR = 3
OTHERS = "(others)"


def missing_as_null(df: DataFrame, tokens=NA_TOKENS) -> DataFrame:
    return df.select(
        *(F.when(~F.col(c).isin(*tokens), F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes)
    )


def counts(df: DataFrame, id_col: str = "record_id") -> DataFrame:
    """rows, distinct ids, ids that repeat; the last is null unless it is above 0 and below a fifth of the distinct ids."""
    per = df.groupBy(F.col(id_col).alias("id")).agg(F.count("*").alias("n"))
    out = per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count("id").alias("distinct_ids"),
        F.count_if(F.col("id").isNotNull() & (F.col("n") > 1)).alias("dups"),
    )
    told = (F.col("dups") > 0) & (F.col("dups") * 5 < F.col("distinct_ids"))
    return out.select("row_count", "distinct_ids", F.when(told, F.col("dups")).alias("repeated_ids"))


def top(df: DataFrame, column: Column, n: int = 0, floor: int = 1) -> DataFrame:
    """(value, n): the n most frequent values (0: all) that occur floor times or more; nulls don't count."""
    out = df.select(column.alias("value")).where("value is not null").groupBy("value").agg(
        F.count("*").alias("n")
    ).where(F.col("n") >= floor)
    return out.orderBy(F.desc("n"), F.asc("value")).limit(n) if n else out


def dates(df: DataFrame, column: str = "DOB") -> DataFrame:
    c = F.col(column)
    return df.agg(
        F.min(c).cast("string").alias("min_dob"),
        F.max(c).cast("string").alias("max_dob"),
        F.count_if(c.isNull()).alias("missing"),
    )


def century_dates(df: DataFrame, column: str = "DOB") -> DataFrame:
    d = clean.century_date(F.col(column))
    return df.agg(F.min(d).alias("min_dob"), F.max(d).alias("max_dob"))


def long(df: DataFrame, fields=PROFILED) -> DataFrame:
    return df.select(
        F.explode(
            F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
        ).alias("x")
    ).select("x.*")


def lengths(df: DataFrame, fields=PROFILED) -> DataFrame:
    """Per field: missing or blank values, and what describes the lengths of those that are not null."""
    size = F.length("value")
    blank = F.col("value").isNull() | (clean.strip(F.col("value")) == "")
    cut = F.percentile(size, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    out = long(df, fields).groupBy("field").agg(
        F.count_if(blank).alias("blank"),
        F.count("value").alias("n"),
        F.avg(size).alias("mean"),
        F.stddev_samp(size).alias("std"),
        F.min(size).alias("least"),
        cut.alias("q"),
        F.max(size).alias("most"),
    )
    return out.select(
        "field",
        "blank",
        "n",
        "mean",
        "std",
        "least",
        *(F.col("q")[i].alias(k) for i, k in enumerate(("q25", "q50", "q75"))),
        "most",
    )


def characters(df: DataFrame, fields=PROFILED) -> DataFrame:
    return long(df, fields).where("value is not null").select(
        "field", F.explode(F.split("value", "")).alias("character")
    ).where("character <> ''").groupBy("field", "character").agg(F.count("*").alias("n"))


def summed(counted: DataFrame, value: str, most: int) -> dict[str, int]:
    """(value, n) as a dictionary of the `most` most frequent values; what the others count is one more, OTHERS."""
    found = {r[value]: r.n for r in counted.orderBy(F.desc("n"), value).limit(most).collect()}
    rest = (counted.agg(F.sum("n")).first()[0] or 0) - sum(found.values()) if len(found) == most else 0
    return found | ({OTHERS: rest} if rest else {})


def profile(df: DataFrame, from_csv: bool = True, position: str | None = None, most: int = 1000) -> tuple[dict, dict]:
    """(aggregate results, private results with values) as small dictionaries: tables of values, shapes and
    characters hold the `most` most frequent ones and the sum of the others. The columns it needs are written
    once, and every table is made from them."""
    df = stage(
        df.select(*dict.fromkeys(["record_id", "DOB", "sex", *PROFILED, *([position] if position else [])])), "profiled"
    )
    rows = lambda d: [r.asDict() for r in d.collect()]

    def table(c: Column, n: int = 0, floor: int = 1) -> dict:
        counted = stage(top(df, c, n, floor), "table")
        found = summed(counted, "value", n or most)
        discard(counted)
        return found

    stats: dict = rows(counts(df))[0] | {"DOB": rows(dates(df))[0]}
    dob = df.where("DOB is not null")
    first = (dob.orderBy(position) if position else dob).select("DOB").first()
    if from_csv and first and "-" not in str(first[0]):
        stats["DOB"] |= {k: None if v is None else str(v) for k, v in rows(century_dates(df))[0].items()}
    stats |= {
        "sex": table(F.col("sex")),
        "zip_format": table(clean.shape(F.col("household_zip"))),
        "phone_format": table(clean.shape(F.col("phone_number"))),
        "zip": table(F.col("household_zip"), 10),
    }
    found: dict[str, dict] = {r["field"]: r for r in rows(lengths(df))}
    letters = stage(characters(df), "characters")
    for field, r in found.items():
        if of := summed(letters.where(F.col("field") == field), "character", most):
            r["characters"] = of
    stats["fields"] = found
    private = {
        f: table(F.col(f), 10, FLOOR) for f in ("given_name", "family_name", "household_street_address", "phone_number")
    }
    discard(df, letters)
    return stats, private
