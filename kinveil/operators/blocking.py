"""Candidate pairs of records, and blocks of Bloom filters.

Each rule is an equi-join of its own; the second leaves out what the first has, so the union needs no
distinct. Arrays of rows are paired and dealt out by the number of their pairs; in the join of likely() for long
house numbers AQE splits the partitions of frequent keys, and Spark streams both sides.
"""

from __future__ import annotations

import hashlib
import random
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinveil.operators.staging import stage


def _sides(people: DataFrame, keys: list[str], carry: list[str]) -> tuple[DataFrame, DataFrame]:
    left = people.select(*keys, F.col("position").alias("a"), *(F.col(c).alias(f"{c}_a") for c in carry))
    right = people.select(*keys, F.col("position").alias("b"), *(F.col(c).alias(f"{c}_b") for c in carry))
    return left, right


#: Rows of a block that are held together, about; and pairs that one task makes, about.
CHUNK, PAIRS_A_TASK = 1024, 4_000_000
#: Pairs of a batch, about.
AT_ONCE = 1 << 18


def tasks(spark: SparkSession, pairs: int | None) -> int:
    """So many tasks for so many pairs."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(pairs or 0) // PAIRS_A_TASK))


def chunked(rows: DataFrame, keys: list[str], item: Column) -> DataFrame:
    """keys, part, parts, items: the items of each block, sorted. A block of more than CHUNK rows is dealt into
    `parts` rows by a hash of position, so that no task has to hold or pair all of it."""
    large = rows.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > CHUNK)
    large = large.select(*keys, F.ceil(F.col("n") / CHUNK).cast("int").alias("parts"))
    parts = F.coalesce("parts", F.lit(1))
    dealt = rows.join(F.broadcast(large), keys, "left").withColumns(
        {"parts": parts, "part": F.pmod(F.xxhash64("position"), parts).cast("int")}
    )
    return dealt.groupBy(*keys, "parts", "part").agg(F.array_sort(F.collect_list(item)).alias("items"))


def spread(start: np.ndarray, count: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) for each i and the count[i] numbers j from start[i] on, some AT_ONCE at a time."""
    ahead = np.concatenate([[0], np.cumsum(count)])
    s = 0
    while s < len(count):
        e = max(s + 1, int(np.searchsorted(ahead, ahead[s] + AT_ONCE, "right")) - 1)
        n = count[s:e]
        yield np.repeat(np.arange(s, e), n), np.arange(ahead[e] - ahead[s]) + np.repeat(start[s:e] - (ahead[s:e] - ahead[s]), n)
        s = e


#: Batches of pairs to batches of what is kept of them.
Then = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _pairer(carry: list[str], differ: str | None, two: bool):
    """For mapInArrow: the pairs of each row's items, or (two) of its items with its others."""

    def field(items: pa.Array, name: str) -> pa.Array:
        return pc.struct_field(items, name)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [batch.column("items"), batch.column("others" if two else "items")]
            xs, ys = (c.flatten() for c in lists)
            nx, ny = (c.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) for c in lists)
            at_x, at_y = field(xs, "position").to_numpy(), field(ys, "position").to_numpy()
            if differ:
                values = pa.chunked_array([field(xs, differ), field(ys, differ)]).combine_chunks().dictionary_encode()
                codes = values.indices.to_numpy(zero_copy_only=False)
                code_x, code_y = codes[: len(xs)], codes[len(xs) :]
            # Each x meets the ys of its row from `start` on: all, or those behind it.
            end = np.repeat(np.cumsum(ny), nx)
            start = end - np.repeat(ny, nx) if two else np.arange(1, len(xs) + 1)
            count = end - start
            for i, j in spread(start, count):
                if differ:
                    keep = code_x[i] != code_y[j]
                    i, j = i[keep], j[keep]
                a, b = at_x[i], at_y[j]
                if (a == b).any():
                    keep = a != b
                    i, j, a, b = i[keep], j[keep], a[keep], b[keep]
                columns = {"a": np.minimum(a, b), "b": np.maximum(a, b)}
                if carry:
                    turned = pa.array(a > b)
                    for c in carry:
                        x, y = field(xs, c).take(pa.array(i)), field(ys, c).take(pa.array(j))
                        columns[f"{c}_a"], columns[f"{c}_b"] = pc.if_else(turned, y, x), pc.if_else(turned, x, y)
                yield pa.RecordBatch.from_pydict(columns)

    return pairs


def _block_pairs(
    rows: DataFrame, keys: list[str], carry: list[str], differ: str | None = None, then: tuple[Then, str] | None = None
) -> DataFrame:
    """Pairs (a < b) of rows of equal keys, of unequal `differ` if given. Pairs are made from two arrays at a time,
    each array with itself and with the others of its block, and dealt out by their number: blocks are few bytes and
    many pairs, so a join by the keys would leave most of the work to few tasks. then: what each task gives instead of
    its pairs, and the schema of that."""
    more = [differ] if differ else []
    chunks = stage(chunked(rows, keys, F.struct("position", *more, *carry)), "chunks")
    n = F.size("items").cast("long")
    blocks = chunks.groupBy(*keys).agg(F.sum(n).alias("n"), F.sum(n * n).alias("own"))
    own, others = blocks.agg(F.sum(F.expr("own div 2")), F.sum(F.expr("(n * n - own) div 2"))).first()
    kinds = {f.name: f.dataType for f in rows.select(*carry).schema}
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    for c in carry:
        schema = schema.add(f"{c}_a", kinds[c]).add(f"{c}_b", kinds[c])
    # What is kept of pairs is little to write: fewer tasks, as each starts a Python worker's caches anew.
    least = 2 * rows.sparkSession.sparkContext.defaultParallelism
    many = lambda n: max(least, -(-(n or 0) // PAIRS_A_TASK)) if then else tasks(rows.sparkSession, n)
    single = chunks.where("size(items) > 1").select("items").repartition(many(own))
    each = lambda two: _pairer(carry, differ, two)
    if then:
        keep, schema = then
        each = lambda two: lambda batches: keep(_pairer(carry, differ, two)(batches))
    out = single.mapInArrow(each(False), schema)
    if not others:
        return out
    side = chunks.where("parts > 1")
    two = side.select(*keys, "part", "items").join(
        side.select(*keys, F.col("part").alias("other"), F.col("items").alias("others")), keys
    )
    two = two.where("part < other").select("items", "others").repartition(many(others))
    return out.unionByName(two.mapInArrow(each(True), schema))


def candidates(people: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Pairs (a < b) of records with an address that share zip, street and number, or zip and surname;
    people: position, household_zip, family_name, parsed (struct of address parts). Blanks are equal to
    blanks, nulls count as blanks."""
    carry = carry or []
    blank = {c: F.coalesce(c, F.lit("")) for c in ("household_zip", "family_name")}
    own = people.withColumns(
        blank | {"street": F.col("parsed.street"), "number": F.col("parsed.number")}
    ).where("parsed.raw <> ''")
    by_address = _block_pairs(own, ["household_zip", "street", "number"], carry)
    # Street and number as one value; the length keeps two different pairs apart.
    own = own.withColumn("spot", F.concat(F.length("street").cast("string"), F.lit(" "), "street", "number"))
    return by_address.unionByName(_block_pairs(own, ["household_zip", "family_name"], carry, "spot"))


#: A house number of fewer characters has to be equal for two different addresses to score above 0.95: with a
#: unit a number weighs 0.3, so it may lose 1/6 at most, one character of six. Segments of SEGMENT characters
#: then outnumber what differs, so one of them is the same on both sides.
LONG_NUMBER, SEGMENT = 6, 3


def likely(people: DataFrame, carry: list[str] | None = None, then: tuple[Then, str] | None = None) -> DataFrame:
    """Those pairs of candidates() whose address similarity can be above 0.95: of equal text, or with house
    numbers that are equal or long and nearly equal. Blank streets and numbers thus form no block.
    people: as in candidates(). then: as in _block_pairs()."""
    carry = carry or []
    blank = {c: F.coalesce(c, F.lit("")) for c in ("household_zip", "family_name")}
    own = people.withColumns(
        blank | {"street": F.col("parsed.street"), "number": F.col("parsed.number"), "raw": F.col("parsed.raw")}
    ).where("raw <> ''")
    numbered = own.where("number <> ''")

    # The blocks of three rules at once: of one street, of one surname (on another street), of one text.
    spot = F.concat(F.lit("at "), "position")
    rule = lambda n, x, y, apart: F.struct(F.lit(n).alias("rule"), x.alias("x"), y.alias("y"), apart.alias("apart"))
    street, number, raw = F.col("street"), F.col("number"), F.col("raw")
    by_number = F.array(rule(1, street, number, spot), rule(2, F.col("family_name"), number, F.concat(F.lit("on "), street)))
    rules = F.when(number != "", by_number).otherwise(F.array(rule(3, raw, F.lit(""), spot)))
    ruled = own.select("position", "household_zip", *carry, F.explode(rules).alias("r")).select("*", "r.*").drop("r")
    blocks = _block_pairs(ruled, ["household_zip", "rule", "x", "y"], carry, "apart", then)
    segment = f"substring(number, {SEGMENT} * k + 1, {SEGMENT})"
    long = numbered.where(F.length("number") >= LONG_NUMBER - 1).withColumn(
        "k", F.explode(F.expr(f"sequence(0, length(number) div {SEGMENT} - 1)"))
    ).withColumn("segment", F.expr(segment))
    side = lambda s: f"substring(number_{s}, {SEGMENT} * j + 1, {SEGMENT})"
    # Of several equal segments the first counts. The segment before k are full on both sides.
    first = f"(k = 0 or not exists(sequence(0, k - 1), j -> {side('a')} = {side('b')}))"
    left, right = _sides(long, ["household_zip", "family_name", "k", "segment"], [*carry, "number"])
    near = left.join(right, ["household_zip", "family_name", "k", "segment"])
    near = near.where(
        f"a < b and number_a <> number_b and greatest(length(number_a), length(number_b)) >= {LONG_NUMBER} and {first}"
    )
    near = near.drop("household_zip", "family_name", "k", "segment", "number_a", "number_b")
    return blocks.unionByName(near.mapInArrow(*then) if then else near)


def exact(people: DataFrame) -> DataFrame:
    """Pairs (a < b) of equal zip and address."""
    own = people.where("household_street_address <> ''").withColumn(
        "household_zip", F.coalesce("household_zip", F.lit(""))
    )
    left, right = _sides(own, ["household_zip", "household_street_address"], [])
    return left.join(right, ["household_zip", "household_street_address"]).where("a < b").select("a", "b")


def bit(filter_: Column, index: int) -> Column:
    """A bit of a binary column: the index-th from the start, most significant first."""
    byte = F.conv(F.hex(F.substring(filter_, index // 8 + 1, 1)), 16, 10).cast("int")
    return F.shiftright(byte, 7 - index % 8).bitwiseAND(F.lit(1))


def lambda_fold(
    clks: DataFrame, tables: int = 3, bits: int = 5, seed: int = 0, length: int = 4096, clk: str = "clk"
) -> DataFrame:
    """clks with a row for each of `tables` hash tables: `block` is the table and `bits` sampled bits."""
    rng = random.Random(seed)
    keys = [
        F.concat(F.lit(f"{t}:"), *[bit(F.col(clk), i).cast("string") for i in rng.sample(range(length), bits)])
        for t in range(tables)
    ]
    return clks.withColumn("block", F.explode(F.array(*keys)))


_VOWELS = "AEIOU"


@lru_cache(1 << 16)
def metaphone(name: str) -> str:
    """Lawrence Philips' first metaphone code of an English name."""
    w = "".join(c for c in name.upper() if "A" <= c <= "Z")
    w = "".join(c for i, c in enumerate(w) if i == 0 or c != w[i - 1] or c == "C")
    if w[:2] in ("AE", "GN", "KN", "PN", "WR"):
        w = w[1:]
    elif w[:1] == "X":
        w = "S" + w[1:]
    elif w[:2] == "WH":
        w = "W" + w[2:]
    out, i = [], 0
    at = lambda k: w[k] if 0 <= k < len(w) else ""
    while i < len(w):
        c, following, before = w[i], at(i + 1), at(i - 1)
        soft = following != "" and following in "EIY"
        code, step = "", 1
        if c in _VOWELS:
            code = c if i == 0 else ""
        elif c == "B":
            code = "" if before == "M" and i == len(w) - 1 else "B"
        elif c == "C":
            if following == "I" and at(i + 2) == "A":
                code = "X"
            elif following == "H":
                code, step = ("K" if before == "S" or at(i + 2) in ("R", "L") and i == 0 else "X"), 2
            else:
                code = ("" if before == "S" else "S") if soft else "K"
        elif c == "D":
            code = "J" if following == "G" and at(i + 2) in tuple("EIY") else "T"
        elif c == "G":
            if following == "H" and (at(i + 2) == "" or at(i + 2) not in _VOWELS):
                code = ""
            elif following == "N" and at(i + 2) in ("", "S") or (following == "N" and w[i : i + 4] == "GNED"):
                code = ""
            elif before == "D" and soft:
                code = ""
            else:
                code = "J" if soft else "K"
        elif c == "H":
            code = "H" if following and following in _VOWELS and before not in tuple("CSPTG") else ""
        elif c == "K":
            code = "" if before == "C" else "K"
        elif c == "P":
            code, step = ("F", 2) if following == "H" else ("P", 1)
        elif c == "Q":
            code = "K"
        elif c == "S":
            if following == "H":
                code, step = "X", 2
            else:
                code = "X" if following == "I" and at(i + 2) in ("O", "A") else "S"
        elif c == "T":
            if following == "H":
                code, step = "0", 2
            elif following == "I" and at(i + 2) in ("O", "A"):
                code = "X"
            else:
                code = "" if following == "C" and at(i + 2) == "H" else "T"
        elif c == "V":
            code = "F"
        elif c in "WY":
            code = c if following and following in _VOWELS else ""
        elif c == "X":
            code = "KS"
        elif c == "Z":
            code = "S"
        else:  # F, J, L, M, N, R
            code = c
        out.append(code)
        i += step
    return "".join(out)


@F.pandas_udf(T.StringType())
def _metaphone(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else metaphone(v))


def signature(df: DataFrame, spec: list[dict]) -> Column:
    """One signature: its parts joined; feature-idx counts columns of df from 1. Null if any part is blank."""
    parts = []
    for part in spec:
        c = F.coalesce(F.col(f"`{df.columns[part['feature-idx'] - 1]}`").cast("string"), F.lit(""))
        if part["type"] == "characters-at":
            pos = part.get("config", {}).get("pos", [])
            parts.append(F.concat(*[F.substring(c, p + 1, 1) for p in pos]))
        elif part["type"] == "metaphone":
            parts.append(_metaphone(c))
        elif part["type"] == "feature-value":
            parts.append(c)
        else:
            raise ValueError(f"signature {part['type']}")
    filled = reduce(lambda x, y: x & y, [p != "" for p in parts])
    return F.when(filled, F.concat_ws("_", *parts))


def p_sig(df: DataFrame, config: dict) -> tuple[DataFrame, DataFrame]:
    """(df with a row for each signature as `block`, the blocks' Bloom bits as (block, bits)). Blocks of a
    share of the rows outside the filter's range are dropped: that is the method's own filter. Config:
    the `config` object of a p-sig file, keys with - or _."""
    conf = {k.replace("_", "-"): v for k, v in config.items()}
    named = [F.concat(F.lit(f"{i}_"), signature(df, s)) for i, s in enumerate(conf["signatureSpecs"])]
    rows = df.withColumn("block", F.explode(F.array(*named))).where("block is not null")
    total = df.agg(F.count("*").alias("total"))
    low, high = conf["filter"]["min"], conf["filter"]["max"]
    sizes = rows.groupBy("block").agg(F.count("*").alias("n")).join(F.broadcast(total))
    kept = sizes.where((F.col("n") >= low * F.col("total")) & (F.col("n") <= high * F.col("total"))).select("block")
    hashes, length = conf["blocking-filter"]["number-hash-functions"], conf["blocking-filter"]["bf-len"]

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def bits(values: pd.Series) -> pd.Series:
        return values.map(lambda v: bloom_bits(v, hashes, length))

    return rows.join(kept, "block"), kept.withColumn("bits", bits("block"))


def bloom_bits(value: str, hashes: int, length: int) -> list[int]:
    """Double hashing with two halves of one digest."""
    a, b = struct.unpack("<QQ", hashlib.blake2b(value.encode(), digest_size=16).digest())
    return [(a + i * b) % length for i in range(hashes)]
