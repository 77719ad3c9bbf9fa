"""From documents to token ids in five stages; each returns a table that the next one reads.

All but the last return the columns of their input, whatever other columns these are and whatever their
names; an empty table gives an empty table. Tests hold each stage against a brute-force version; as
language prediction and random mixing aren't SQL, ORACLE_SQL is None.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinveil.llm import bpe, language_id, mixing, ngram_join, substring_dedup
from kinveil.operators.staging import discard, scratch, stage

ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts that are null or without a letter, and texts that fit no language the model has learned
    (language_id.known says by which score). A text of any learned language stays, and so does its label;
    where no language could be learned, every text with a letter stays."""
    model = language_id.fit(docs.where(~language_id.held_out()))
    return language_id.known(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of texts linked at a 5-word Jaccard similarity of 0.8 or more, one row stays: that of the
    least id, and of several rows of this id the least by text fingerprint and row number. Rows count one by
    one, also where they repeat an id: an exact repeat goes, another text under the id is judged by its own
    class. Rows without an id come after all ids, so one stays only if its class has no row with an id."""
    rows = stage(docs.withColumn("__row", F.monotonically_increasing_id()), "rows", "zstd")
    found = ngram_join.near_duplicates(rows, id_col="__row", row_col="__row").select(
        F.col("doc_id").alias("__row"), "class_id"
    )
    order = rows.select("__row", F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), "__row").alias("o"))
    kept = found.join(order, "__row").groupBy("class_id").agg(F.min("o").alias("o")).select("o.__row")
    return rows.join(kept.hint("shuffle_hash"), "__row", "left_semi").select(*docs.columns)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that a document of a smaller id has are taken out of the text, and n_chars
    counts anew; documents of which nothing is left go, and so do null, empty and wordless texts. Rows that
    repeat an id lose nothing that only other rows of this id have; rows without an id stay as they are."""
    out = substring_dedup.dedup(docs, out=("__sd_words", "__sd_removed")).where("__sd_removed < __sd_words")
    n_chars = F.when(F.col("__sd_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix of sources takes them (not at all, once or twice). Null, empty and wordless
    texts have no size and aren't taken; null sources are one source; rows that repeat each other are taken
    one by one, with or without an id."""
    return mixing.mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, token ids and their number for every row; null and empty texts have no ids."""
    out = bpe.encode(
        docs.select("doc_id", "source", "lang", "text"), public_tokenizers.path("byte_bpe_50k.json"), keep_text=False
    )
    return out.select("doc_id", "source", "lang", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("mixture", mixture),
    ("encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What a stage writes on its way goes when its result is written, and a
    result when the next one's is."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        with scratch(spark) as keep:
            out = stage(function(spark, docs, sf_dir), name)
            keep.append(out)
        discard(docs)
        docs = out
    return docs
