"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only.

A source's target over its size is the mean number of copies of each of its documents. The whole part
is taken; the fractional rest is a probability p. Pivotal rounding pairs documents: of two, words are
moved from one to the other (p times size keeps its sum) until one p is 0 or 1, in the direction that
a fixed pseudo-random number chooses so that every p keeps its expectation. The words a source takes
therefore stay at the target all the way, up to the last document left over.

The pairs form a tree. Documents are dealt by hash into cells of about CELL of one source; one pass of
`aggregate` over a cell's sorted array decides all of it but one residual document. Residuals meet in
cells again, level by level, until each source has one, which its own p decides. Every level is one
groupBy of bounded arrays; a source that holds a third of all rows is many cells like any other.

Sources are ranked by range partitions and the level that fills the targets is found by a few sums over
the table of sources, so that their number may grow too.

Edge cases: null text has size 0; documents of size 0 take no part and take nothing (0 words); null
sources are one source, last in order; repeated rows are documents like any others (rows equal in all
that counts here are counted first and numbered, so they fall into many cells, and which of them is taken
says nothing); an empty table gives an empty table; other columns pass through `mix`, which repeats or
leaves out whole rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinveil.llm._number import numbered
from kinveil.operators.staging import stage

CELL = 128
#: Copies of one row that are numbered at a time.
CHUNK = 4096
#: The weights of the sources in order, repeating.
WEIGHTS = (3.0, 1.0, 2.0)


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def ranked(table: DataFrame, key: str, out: str) -> DataFrame:
    """A written table with `out`: the rank, from 0, of its distinct keys in order, nulls last."""
    order = F.col(key).asc_nulls_last()
    parts = stage(table.repartitionByRange(order).withColumn("__mx_part", F.spark_partition_id()), "mix-order")
    sums = parts.groupBy("__mx_part").agg(F.count("*").alias("__mx_n"))
    before = F.sum("__mx_n").over(W.orderBy("__mx_part").rowsBetween(W.unboundedPreceding, 0)) - F.col("__mx_n")
    within = F.row_number().over(W.partitionBy("__mx_part").orderBy(order)) - 1
    both = parts.withColumn("__mx_at", within).join(sums.select("__mx_part", before.alias("__mx_before")), "__mx_part")
    return both.withColumn(out, F.col("__mx_before") + F.col("__mx_at")).drop("__mx_part", "__mx_at", "__mx_before")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """sizes (source, size) of any number of rows to source, source_size, target.

    Filling by weight under the caps has one level: target = min(most * size, level * weight). It starts
    with no source at its cap; each turn sums up the sources beyond theirs and reshares the rest, until
    none more is beyond."""
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.pmod(F.col("__mx_rank"), F.lit(len(weights))) + 1
    given = stage(
        ranked(total, "source", "__mx_rank").withColumn(
            "weight", F.element_at(F.array(*map(F.lit, weights)), turn.cast("int"))
        ),
        "mix-sources",
    )
    whole = given.agg(F.sum("source_size")).first()[0] or 0
    level, beyond = 0.0, -1
    while True:
        cap = most * F.col("source_size")
        over = F.lit(level) * F.col("weight") > cap
        r = given.agg(
            F.count(F.when(over, 1)).alias("n"),
            F.sum(F.when(over, cap)).alias("full"),
            F.sum(F.when(~over, F.col("weight"))).alias("open"),
        ).first()
        if r.n == beyond:
            break
        beyond, level = r.n, (share * whole - (r.full or 0)) / r.open if r.open else float("inf")
    return given.select(
        "source",
        "source_size",
        F.least(most * F.col("source_size"), F.lit(level) * F.col("weight")).cast("double").alias("target"),
    )


def _round(items: Column) -> Column:
    """One cell's array of structs (id, size, p, u, ...) to struct(done: array of (item, bit), last: item)."""

    def pair(state: Column, b: Column) -> Column:
        a = state["last"]
        # Words that can move to a (a full or b empty), and away from a (a empty or b full).
        up = F.least(a["size"] * (1 - a["p"]), b["size"] * b["p"])
        down = F.least(a["size"] * a["p"], b["size"] * (1 - b["p"]))
        rise = (a["u"] + b["u"]) % 1 * (up + down) < down
        a_ends = F.when(
            rise, a["size"] * (1 - a["p"]) <= b["size"] * b["p"]
        ).otherwise(a["size"] * a["p"] <= b["size"] * (1 - b["p"]))
        a_p = F.when(rise, a["p"] + up / a["size"]).otherwise(a["p"] - down / a["size"])
        b_p = F.when(rise, b["p"] - up / b["size"]).otherwise(b["p"] + down / b["size"])
        ended = F.when(a_ends, a).otherwise(b)
        bit = F.when(a_ends, rise).otherwise(~rise).cast("int")
        rest = F.when(a_ends, b.withField("p", b_p)).otherwise(a.withField("p", a_p))
        rest = rest.withField("p", F.greatest(F.lit(0.0), F.least(F.lit(1.0), rest["p"]))).withField(
            "u", F.pmod(rest["u"] * 7919 + 0.618033988749895, F.lit(1.0))
        )
        done = F.concat(state["done"], F.array(F.struct(ended["row"].alias("row"), bit.alias("bit"))))
        return F.struct(done.alias("done"), rest.alias("last"))

    first = items[0]
    empty = F.expr("cast(array() as array<struct<row:struct<id:bigint,tie:bigint,size:bigint,nth:bigint>,bit:int>>)")
    return F.aggregate(
        F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0))),
        F.struct(empty.alias("done"), first.alias("last")),
        pair,
    )


def rounded(docs: DataFrame, seed: int = 0) -> DataFrame:
    """docs (source, id, tie, size, nth, p) to (source, id, tie, size, nth, bit), one row each, with size > 0 and
    0 < p < 1. tie and nth tell rows of one id apart."""
    hashed = F.xxhash64("id", "tie", "nth", F.lit(seed))
    u = F.pmod(F.shiftrightunsigned(hashed, 11), F.lit(1 << 50)) / F.lit(float(1 << 50))
    item = F.struct(
        F.shiftrightunsigned(hashed, 3).alias("key"),
        F.struct("id", "tie", "size", "nth").alias("row"),
        F.col("size").cast("double").alias("size"),
        "p",
        u.alias("u"),
    )
    level = docs.select("source", item.alias("item"))
    counted = stage(level, "mix-items")
    out = []
    most = counted.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    while True:
        cells = counted.groupBy("source").agg((F.expr(f"count(*) div {CELL}") + 1).alias("cells"))
        dealt = counted.join(cells, "source").select(
            "source", "item", F.expr("pmod(xxhash64(item.key, item.row), cells)").alias("cell")
        )
        made = dealt.groupBy("source", "cell").agg(
            F.array_sort(F.collect_list("item")).alias("items")
        ).select("source", _round(F.col("items")).alias("r"))
        made = stage(made, "mix-level")
        out.append(made.select("source", F.explode("r.done").alias("d")).select("source", "d.row.*", "d.bit"))
        if most < CELL:
            return reduce(
                DataFrame.unionAll,
                [
                    *out,
                    made.select(
                        "source", "r.last.row.*", (F.col("r.last.u") < F.col("r.last.p")).cast("int").alias("bit")
                    ),
                ],
            )
        counted, most = made.select("source", F.col("r.last").alias("item")), most // CELL + 1


def copies(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 0) -> DataFrame:
    """docs (id, source, size, tie) to the same with source_size, target and copies (int)."""
    # "0" and the name, or "1" for null: never null, and in the order of the sources.
    docs = docs.withColumn("source", F.when(F.col("source").isNull(), "1").otherwise(F.concat(F.lit("0"), "source")))
    given = stage(targets(docs, weights, share, most), "mix-targets")
    rate = F.col("target") / F.col("source_size")
    equal = docs.groupBy("source", "id", "size", "tie").agg(F.count("*").alias("m"))
    chunks = equal.withColumn("c", F.explode(F.expr(f"sequence(0, (m - 1) div {CHUNK})")))
    each = chunks.withColumn(
        "nth", F.explode(F.expr(f"sequence(c * {CHUNK}, least((c + 1) * {CHUNK}, m) - 1)"))
    ).drop("c", "m")
    counts = F.col("size") > 0
    rows = each.join(given, "source").withColumn("whole", F.when(counts, F.floor(rate)).otherwise(0).cast("int"))
    rows = stage(rows.withColumn("p", F.when(counts, rate - F.floor(rate)).otherwise(0.0)), "mix-rates")
    part = rounded(rows.where("p > 0").select("source", "id", "tie", "size", "nth", "p"), seed)
    settled = rows.where("p = 0").withColumnRenamed("whole", "copies").drop("p")
    moved = part.join(given, "source").withColumn("copies", (F.floor(rate) + F.col("bit")).cast("int")).drop("bit")
    out = settled.unionByName(moved).drop("nth")
    return out.withColumn("source", F.when(F.col("source") != "1", F.expr("substring(source, 2)")))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    return stage(
        docs.select(
            F.col(id_col).cast("long").alias("id"),
            F.col(source_col).alias("source"),
            words(F.col(text_col)).alias("size"),
            F.xxhash64(text_col).alias("tie"),
        ),
        "mix-sizes",
    )


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how
) -> DataFrame:
    """docs with every row as many times as the mix takes it (not at all, once or twice by default).

    Rows that repeat an id, source and text are drawn apart from each other, and what is taken of them in
    all is dealt back over them evenly, so the mix has the same rows each time."""
    counted = copies(sized(docs, id_col, text_col, source_col), **how)
    key = lambda a, b, c: F.struct(a.alias("a"), b.alias("b"), c.alias("c")).alias("__mx_key")
    pooled = counted.groupBy(key(*map(F.col, ("id", "source", "tie")))).agg(
        F.sum("copies").alias("__mx_sum"), F.count("*").alias("__mx_n")
    )
    keyed = docs.select("*", key(F.col(id_col).cast("long"), F.col(source_col), F.xxhash64(text_col)))
    both = keyed.join(pooled, "__mx_key")
    single = both.where("__mx_n = 1").withColumn("__mx_c", F.col("__mx_sum"))
    several = stage(both.where("__mx_n > 1").withColumn("__mx_row", F.monotonically_increasing_id()), "mix-several")
    several = numbered(several, ["__mx_key"], "__mx_n", "__mx_row", "__mx_nth").drop("__mx_row")
    several = several.withColumn(
        "__mx_c", F.expr("__mx_sum div __mx_n + if(__mx_nth < __mx_sum % __mx_n, 1, 0)")
    ).drop("__mx_nth")
    out = single.unionByName(several).where("__mx_c > 0")
    return out.withColumn("__mx_c", F.explode(F.expr("sequence(1, int(__mx_c))"))).select(*docs.columns)


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    out = copies(sized(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")))
    return out.select(
        F.col("id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "source",
        "copies",
    )
