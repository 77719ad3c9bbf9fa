"""N-gram Jaccard join: near-duplicate texts, found by MinHash and pruned by posterior probability.

A text is the set of its runs of `n` words (a shorter text: of all its words, as one). Rows of equal
sets are one representative from here on, told apart by a number of its own. MinHash values in BANDS
bands of ROWS find candidates (a pair at the threshold 0.8 goes unfound with a probability of 4e-9);
buckets with the same members count once. Inside a bucket, MinHash values of two texts are compared a
few at a time; a pair is dropped as soon as the posterior probability that its Jaccard similarity
reaches the threshold (from a uniform prior) is below `tolerance`. What survives joins representatives
into groups, and within a group every pair is verified exactly on the sets of the whole texts.

No table of pairs is ever made. A bucket or group is worked on in blocks of bounded rows and bytes, each
pair of blocks by itself, and yields sums of links and a spanning forest; Spark connects the forests.
A bucket, group or set of copies with very many rows meets its sums by broadcast.

Edge cases: a null or wordless text is its own class without links; copies link to each other and to
all that any of them links to, and are counted, not paired; rows that repeat an id count one by one: an
exact repeat is a copy, another text under the id has its own links, and class ids are least ids of
the rows' classes; rows without an id have a null class and no links; other columns are not used; an
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinveil.llm._text import U, Words, arrow_map, mix, signed, units, windows
from kinveil.operators.components import components
from kinveil.operators.skew import join_groups
from kinveil.operators.staging import discard, stage

BANDS, ROWS = 27, 3
HASHES = BANDS * ROWS
#: Most rows of one bucket, and texts and bytes of one group, that a block holds, about.
BUCKET_BLOCK, TEXT_BLOCK, TEXT_BYTES = 1024, 1024, 4_000_000
STEP = 9
_rng = np.random.Generator(np.random.PCG64(5))
_A = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * U(2) + U(1)
_B = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def shingles(words: Words, n: int, whole: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Shingle names of each text, and where each text's begin. A text of fewer words than n has one
    shingle; a part of a text (not whole) has none then."""
    per = np.where(words.count == 0, 0, np.maximum(words.count - n + 1, int(whole)))
    d = np.repeat(np.arange(len(per)), per)
    local = np.arange(len(d)) - np.repeat(np.cumsum(per) - per, per)
    start, full = words.first[d] + local, words.count[d] >= n
    name = np.empty(len(d), U)
    name[full] = windows(words.name, n)[start[full]]
    for c in np.unique(words.count[d[~full]]).tolist():
        short = words.count[d] == c
        name[short] = windows(words.name, c)[start[short]]
    return name, np.concatenate([[0], np.cumsum(per)])


def sets(texts: pa.Array, n: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, names, edge): the distinct shingle names of each text, ascending."""
    held: list[np.ndarray] = []
    for a, b, base, words, last in units(texts, n - 1):
        name, edge = shingles(words, n, not base)
        if held or not last:
            held.append(name)
            if not last:
                continue
            name = np.concatenate(held)
            edge, held = np.array([0, len(name)]), []
        keep = np.zeros(len(name), bool)
        for i in np.flatnonzero(np.diff(edge)):
            part = name[edge[i] : edge[i + 1]]
            part.sort()
            keep[edge[i]] = True
            np.not_equal(part[1:], part[:-1], out=keep[edge[i] + 1 : edge[i + 1]])
        yield a, b, name[keep], np.concatenate([[0], np.cumsum(keep)])[edge]


def signatures(name: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """MinHash values (texts x HASHES, uint32) of non-empty sets; 0 for empty ones."""
    out = np.zeros((len(edge) - 1, HASHES), np.uint32)
    full = np.flatnonzero(np.diff(edge))
    if not len(full):
        return out
    # Few texts at a time, so that a row of values stays in the processor's cache.
    for part in np.array_split(full, max(1, len(name) // 30_000)):
        if not len(part):
            continue
        a = edge[part[0]]
        mine, at = name[a : edge[part[-1] + 1]], edge[part] - a
        if len(part) == 1 and len(mine) > 1 << 20:  # one long text, some at a time
            some = [signatures(x, np.array([0, len(x)])) for x in np.array_split(mine, len(mine) >> 19)]
            out[part[0]] = np.minimum.reduce(some)[0]
            continue
        work = np.empty_like(mine)
        for k in range(HASHES):
            np.multiply(mine, _A[k], out=work)
            np.add(work, _B[k], out=work)
            out[part, k] = np.minimum.reduceat(work, at) >> U(32)
    return out


@lru_cache(8)
def least_matches(threshold: float, tolerance: float) -> tuple[int, ...]:
    """Of STEP, 2 STEP, .. values compared: the fewest equal ones with which the posterior probability
    of reaching the threshold, P(Binomial(n + 1, threshold) <= m), is not below tolerance."""
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


def survivors(one: np.ndarray, others: np.ndarray, least: tuple[int, ...]) -> np.ndarray:
    """Which of others (signatures) are not dropped when compared with one."""
    at, same = np.arange(len(others)), np.zeros(len(others), np.int32)
    for k, m in enumerate(least):
        cut = slice(k * STEP, (k + 1) * STEP)
        same = same + (others[at, cut] == one[cut]).sum(1)
        ok = same >= m
        at, same = at[ok], same[ok]
        if not len(at):
            break
    return at


def forest(n: int, linked) -> list[tuple[int, int]]:
    """A spanning forest of 0..n-1; linked(i, js): which of js are linked to i. Each node asks only
    about nodes that nothing has reached yet."""
    open_, edges = np.arange(n), []
    while len(open_):
        queue, open_ = [int(open_[0])], open_[1:]
        while queue and len(open_):
            i = queue.pop()
            hit = linked(i, open_)
            if len(hit):
                edges += [(i, int(j)) for j in open_[hit]]
                queue += open_[hit].tolist()
                open_ = np.delete(open_, hit)
    return edges


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int, rows: int = 2048) -> Iterator[pa.Table]:
    """Tables of whole groups of sorted batches; the first `keys` columns are the group."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        for at in range(0, batch.num_rows, rows):
            held.append(batch.slice(at, min(rows, batch.num_rows - at)))
            key = [held[-1].column(k).to_numpy() for k in range(keys)]
            new = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
            if len(new):
                last = held.pop()
                yield pa.Table.from_batches([*held, last.slice(0, int(new[-1]))])
                held = [last.slice(int(new[-1]))]
            elif len(held) > 1 and any(held[-2].column(k)[-1].as_py() != key[k][0] for k in range(keys)):
                last = held.pop()
                yield pa.Table.from_batches(held)
                held = [last]
    if held:
        yield pa.Table.from_batches(held)


def _bounds(table: pa.Table, keys: int) -> np.ndarray:
    key = [table.column(k).to_numpy() for k in range(keys)]
    return np.concatenate([[0], np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1, [table.num_rows]])


def _fixed(column, dtype, width: int) -> np.ndarray:
    c = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(c.to_pylist()), dtype).reshape(len(c), width)


SETS = "row long, doc long, k1 long, k2 long, size long, sig binary"


def _sets(n: int):
    """(row, doc, text) to SETS; k1 and k2 name the set, and are null for a wordless text."""

    def run(batches):
        for batch in batches:
            for a, b, name, edge in sets(batch.column(2), n):
                full = np.flatnonzero(np.diff(edge))
                k1, k2 = np.zeros(b - a, U), np.zeros(b - a, U)
                if len(full):
                    k1[full] = np.add.reduceat(mix(name), edge[full])
                    k2[full] = np.add.reduceat(mix(name ^ U(0x5851F42D4C957F2D)), edge[full])
                sig, empty = signatures(name, edge), np.diff(edge) == 0
                keys = [pa.array(k.view(np.int64), mask=empty) for k in (k1, k2)]
                marks = pa.array([None if e else s.tobytes() for s, e in zip(sig, empty, strict=True)], pa.binary())
                yield pa.record_batch(
                    [*(batch.column(k).slice(a, b - a) for k in (0, 1)), *keys, pa.array(np.diff(edge) * 8), marks],
                    names=[x.split()[0] for x in SETS.split(", ")],
                )

    return run


def _bands(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = _fixed(batch.column(1), np.uint32, HASHES).astype(U).reshape(-1, BANDS, ROWS)
        key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) * U(0x9FB21C651E98DF25), sig.shape[:2])
        for k in range(ROWS):
            key = mix((key ^ sig[:, :, k]) * U(0xA24BAED4963EE407) + U(k))
        yield pa.record_batch(
            [signed(np.ascontiguousarray(key).ravel()), pa.array(np.repeat(batch.column(0).to_numpy(), BANDS))],
            names=["bucket", "node"],
        )


def _buckets(least):
    """Sorted (bucket, i, j, node, sig) to the forest of what survives in each."""

    def run(batches):
        for table in whole_groups(batches, 3):
            doc, sig, out = table.column("node").to_numpy(), _fixed(table.column("sig"), np.uint32, HASHES), []
            edge = _bounds(table, 3)
            size = np.diff(edge)
            two = edge[:-1][size == 2]
            if len(two):
                same = np.cumsum(sig[two] == sig[two + 1], 1, dtype=np.int32)[:, STEP - 1 :: STEP]
                ok = two[(same >= np.array(least)).all(1)]
                out += list(zip(doc[ok].tolist(), doc[ok + 1].tolist(), strict=True))
            for a, b in zip(edge[:-1][size > 2].tolist(), edge[1:][size > 2].tolist(), strict=True):
                part = sig[a:b]
                out += [
                    (int(doc[a + x]), int(doc[a + y]))
                    for x, y in forest(b - a, lambda i, js, part=part: survivors(part[i], part[js], least))
                ]
            yield pa.record_batch(
                [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], names=["a", "b"]
            )

    return run


def overlaps(name: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Sizes of all intersections of the sets name[edge[i]:edge[i + 1]]."""
    n = len(edge) - 1
    _, at, count = np.unique(name, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), np.diff(edge))
    shared = count[at] > 1
    number = np.cumsum(count > 1) - 1
    row, col = row[shared], number[at[shared]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    out, width = np.zeros((n, n)), 8192
    for a in range(0, int(col[-1]) + 1 if len(col) else 0, width):
        i, j = np.searchsorted(col, (a, a + width))
        m = np.zeros((n, width if n > 8 else min(width, int(col[-1]) + 1 - a)), np.float32)
        m[row[i:j], col[i:j] - a] = 1
        out += m @ m.T
    return out


def _verify(n: int, threshold: float):
    """Sorted (group, i, j, block, node, copies, text) to (a, b, links): b null and the links of a, or an edge of the forest."""

    def run(batches):
        for table in whole_groups(batches, 3, 256):
            table = table.combine_chunks()
            doc, copies, block = (table.column(c).to_numpy() for c in ("node", "copies", "block"))
            i, j = table.column(1).to_numpy(), table.column(2).to_numpy()
            names, sizes = [], []
            for _, _, x, e in sets(table.column("text"), n):
                names.append(x), sizes.append(np.diff(e))
            name, at = np.concatenate(names), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            bounds, out = _bounds(table, 3), []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                both = overlaps(name[at[a] : at[b]], at[a : b + 1] - at[a])
                size = np.diff(at[a : b + 1])
                near = both / np.maximum(size[:, None] + size[None, :] - both, 1) >= threshold
                np.fill_diagonal(near, False)
                if i[a] != j[a]:  # pairs within a block belong to the block's own cell
                    near &= block[a:b, None] != block[None, a:b]
                links = near @ copies[a:b]
                out += [(int(doc[a + x]), None, int(links[x])) for x in np.flatnonzero(links)]
                out += [
                    (int(doc[a + x]), int(doc[a + y]), None)
                    for x, y in forest(b - a, lambda x, ys, near=near: np.flatnonzero(near[x, ys]))
                ]
            yield pa.record_batch(
                [pa.array([x[k] for x in out], pa.int64()) for k in range(3)], names=["a", "b", "links"]
            )

    return run


def _cells(df: DataFrame, blocks) -> DataFrame:
    """One row of df for each pair (i, j) of its group's `blocks` blocks that its own block is part of."""
    df = df.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    df = df.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # With more than one block, pairs of different blocks cover a block's own pairs only in (i, i).
    return df.withColumn("i", F.least("block", "k")).withColumn("j", F.greatest("block", "k"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = 5,
    threshold: float = 0.8,
    tolerance: float = 1e-9,
    row_col: str | None = None,
) -> DataFrame:
    """One row for each row of docs: doc_id, class_id (the least id of those linked by any chain of
    similarities of threshold or more) and n_links (rows that are that similar to this one). row_col: a
    column of distinct longs, none null, of a docs that is written down; else rows are numbered and written here."""
    columns = F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")
    if row_col:
        texts = docs.select(F.col(row_col).alias("row"), *columns)
    else:
        texts = stage(docs.select(F.monotonically_increasing_id().alias("row"), *columns), "texts", "zstd")
    every = stage(arrow_map(texts, _sets(n), SETS), "sets", "zstd")
    real = every.where("doc is not null and k1 is not null")
    # Any row can speak for its set; the class's id is the least of all rows.
    chosen = real.groupBy("k1", "k2").agg(
        F.min("row").alias("node"), F.min("doc").alias("least"), F.count("*").alias("copies")
    )
    chosen = stage(chosen, "representatives")
    reps = stage(
        real.join(
            chosen.select(F.col("node").alias("row")), "row", "left_semi"
        ).select(F.col("row").alias("node"), "size", "sig"),
        "signatures",
        "zstd",
    )

    bands = stage(arrow_map(reps.select("node", "sig"), _bands, "bucket long, node long"), "bands", "zstd")
    members = F.bit_xor(F.xxhash64("node")), F.bit_xor(F.xxhash64("node", F.lit(1)))
    buckets = bands.groupBy("bucket").agg(
        F.count("*").alias("n"), members[0].alias("x"), members[1].alias("y"), F.min("node").alias("first")
    ).where("n > 1")
    buckets = stage(
        buckets.groupBy("n", "x", "y", "first").agg(F.min("bucket").alias("bucket")).select(
            "bucket", "n", F.col("n").alias("many")
        ),
        "buckets",
    )
    live = join_groups(bands, buckets, ["bucket"], "many", bands.count()).join(reps.select("node", "sig"), "node")
    cells = _cells(live, F.expr(f"int((n - 1) div {BUCKET_BLOCK}) + 1")).select("bucket", "i", "j", "node", "sig")
    pairs = arrow_map(
        cells.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j"),
        _buckets(least_matches(threshold, tolerance)),
        "a long, b long",
    )
    groups = stage(components(pairs).join(reps.select("node", "size"), "node"), "groups")
    discard(bands, buckets, reps)

    weight = stage(
        groups.groupBy("component").agg(
            F.count("*").alias("n"), F.count("*").alias("many"), F.sum("size").alias("bytes")
        ),
        "weights",
    )
    members = join_groups(groups, weight, ["component"], "many", groups.count()).drop("size")
    members = members.join(
        chosen.select("node", "copies"), "node"
    ).withColumnRenamed("node", "row").withColumnRenamed("component", "group")
    asked = texts.select("row", "text").join(members.hint("shuffle_hash"), "row").withColumnRenamed("row", "node")
    blocks = F.expr(f"int(greatest((n - 1) div {TEXT_BLOCK}, bytes div {TEXT_BYTES})) + 1")
    cells = _cells(asked, blocks).select("group", "i", "j", "block", "node", "copies", "text")
    found = stage(
        arrow_map(
            cells.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j", "node"),
            _verify(n, threshold),
            "a long, b long, links long",
        ),
        "verified",
    )

    tied = stage(components(found.where("b is not null")).join(chosen.select("node", "least"), "node"), "classes")
    least = stage(tied.groupBy("component").agg(F.min("least").alias("class_id"), F.count("*").alias("n")), "least")
    classes = join_groups(
        tied.select("node", "component"), least, ["component"], "n", tied.count()
    ).select("node", "class_id")
    links = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    known = chosen.join(classes, "node", "left").join(links, "node", "left")
    known = known.select(
        "k1",
        "k2",
        "copies",
        F.coalesce("class_id", "least").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    known = stage(known, "known")
    discard(groups, weight, found, tied, least, *([] if row_col else [texts]))
    out = join_groups(
        real.select("doc", "k1", "k2"), known, ["k1", "k2"], "copies", every.count()
    ).select(F.col("doc").alias("doc_id"), "class_id", "n_links")
    return out.unionAll(every.where("doc is null or k1 is null").select("doc", "doc", F.lit(0).cast("long")))


def op9_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP9_SQL = r"""
with recursive w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') ws from documents),
s as (select doc_id, case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
      else list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))) end g from w),
x as (select doc_id, len(g) n, unnest(g) t from s),
p as (select a.doc_id a, b.doc_id b, count(*) c, any_value(a.n) na, any_value(b.n) nb from x a join x b on a.t = b.t and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from p where c / (na + nb - c) >= 0.8),
e as (select a, b from l union all select b, a from l),
r as (select doc_id a, doc_id c from s union select e.b, r.c from r join e on e.a = r.a)
select doc_id, (select min(c) from r where r.a = doc_id) class_id, (select count(*) from e where e.a = doc_id) n_links from s
"""
