"""Substring dedup by recompression.

Every text is a sequence of word names. A round either names maximal runs of one symbol or names
pairs (a symbol of the left class followed by one of the right class; a hash bit of the symbol
decides the class). A name is a hash of what it stands for, so one name means one content in the
whole corpus: naming is global without a dictionary to exchange, and the rounds run within one pass
over the texts. Each symbol carries the span of words that its existence depends on; a window that
covers that span must contain the symbol wherever the window occurs. So every window picks an anchor
from its own content alone: the longest of the symbols of the highest level that it determines, by
least name among equals (single words at worst, so no window goes without).

Equal windows have equal anchors. Runs of consecutive windows under one anchor make one row, a
stretch. Spark keeps the stretches whose anchor stands in several documents (the shared symbols), and
compares those by `print`, the 128-bit BLAKE2 hash of the stretch's words themselves: that settles
stretches that are copied whole. Only where one anchor stands in different stretches are the single
windows compared, again by the hash of their words. Names thus only bring windows together; no word
is removed on the name of a symbol. Nothing is gathered per name: all groups are sums and minima that
combine before the shuffle, and the rows of a name or print that is very frequent meet its sums by
broadcast (kinveil.operators.skew).

Edge cases: a null or wordless text has no words and loses none; texts shorter than the window lose
none; equal windows in one document alone lose none; a row without an id neither loses words nor
makes others lose any; rows that repeat an id are one document as far as others go, and none of its rows
loses what another of its rows has, but each row loses words of its own text only. Long texts are worked on in parts that overlap by a window. Other columns pass through; one that has the name of
an output is replaced by it. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinveil.llm._text import U, Words, arrow_map, combine, mix, replaced, units
from kinveil.operators.skew import join_groups
from kinveil.operators.staging import discard, stage

#: One letter a round: r names runs, p names pairs. The symbols after each level in LEVELS can be anchors.
ROUNDS = "rppprpppp"
LEVELS = (0, 4, 9)


class Symbols:
    """A level of the parse: names; how many words each stands for; [cs, ce) of words that decide it;
    [lo, hi) of its document."""

    def __init__(self, name, size, cs, ce, lo, hi):
        self.name, self.size, self.cs, self.ce, self.lo, self.hi = name, size, cs, ce, lo, hi

    def around(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether the next symbol is of the same document; from where the previous, to where the next
        symbol is decided. A neighbour beyond the document's ends is decided by no window."""
        joined = self.lo[1:] == self.lo[:-1]
        before, after = self.lo - 1, self.hi + 1
        before[1:][joined] = self.cs[:-1][joined]
        after[:-1][joined] = self.ce[1:][joined]
        return joined, before, after

    def runs(self, salt: U) -> Symbols:
        joined, before, after = self.around()
        first = np.flatnonzero(np.concatenate([[True], (self.name[1:] != self.name[:-1]) | ~joined]))
        size = np.diff(np.append(first, len(self.name)))
        named = np.where(size == 1, self.name[first], combine(self.name[first] ^ salt, size.astype(U)))
        return Symbols(
            named,
            np.add.reduceat(self.size, first),
            before[first],
            after[first + size - 1],
            self.lo[first],
            self.hi[first],
        )

    def pairs(self, salt: U) -> Symbols:
        joined, before, after = self.around()
        left = mix(self.name ^ salt) < U(1 << 63)
        paired = np.zeros(len(left), bool)
        paired[:-1] = left[:-1] & ~left[1:] & joined
        named = self.name.copy()
        at = np.flatnonzero(paired)
        named[at] = combine(self.name[at] ^ salt, self.name[at + 1])
        keep = np.ones(len(left), bool)
        keep[at + 1] = False
        total = self.size.copy()
        total[at] += self.size[at + 1]
        return Symbols(
            named[keep],
            total[keep],
            np.where(left, self.cs, before)[keep],
            np.where(left, after, self.ce)[keep],
            self.lo[keep],
            self.hi[keep],
        )


def parse(words: Words) -> list[Symbols]:
    """The levels that anchors come from, lowest first."""
    n = np.arange(len(words))
    lo, hi = np.repeat(words.first[:-1], words.count), np.repeat(words.first[1:], words.count)
    now = Symbols(words.name, np.ones(len(n), np.int64), n, n + 1, lo, hi)
    out = [now]
    for k, kind in enumerate(ROUNDS, 1):
        salt = mix(np.array([k], U))[0]
        now = now.runs(salt) if kind == "r" else now.pairs(salt)
        if k in LEVELS:
            out.append(now)
    return out


def anchors(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows, and the name of each window's anchor."""
    n = np.arange(len(words))
    starts = n[n + window <= np.repeat(words.first[1:], words.count)]
    name, open_ = np.zeros(len(starts), U), np.arange(len(starts))
    for level in reversed(parse(words)) if len(starts) else ():
        a = np.searchsorted(level.cs, starts[open_], "left")
        b = np.searchsorted(level.ce, starts[open_] + window, "right")
        has = b > a
        at, a, b = open_[has], a[has], b[has]
        power = np.frexp((b - a).astype(np.float64))[1] - 1
        # The least key is the longest symbol's: it stands in the fewest texts.
        least = [(U(63) - np.minimum(level.size, 63).astype(U)) << U(58) | level.name >> U(6)]
        for k in range(int(power.max(initial=0))):
            least.append(np.minimum(least[-1][: -(1 << k)], least[-1][1 << k :]))
        for k, column in enumerate(least):
            mine = power == k
            name[at[mine]] = np.minimum(column[a[mine]], column[b[mine] - (1 << k)])
        open_ = open_[~has]
        if not len(open_):
            break
    return starts, name


def prints(words: Words, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """128-bit hashes of words[start:end] joined by spaces, as two columns of longs."""
    flat, begin = words.flat
    raw, hashed = memoryview(flat), hashlib.blake2b
    spans = zip(begin[start].tolist(), (begin[end] - 1).tolist(), strict=True)
    made = np.frombuffer(b"".join([hashed(raw[i:j], digest_size=16).digest() for i, j in spans]), "<i8").reshape(-1, 2)
    return [np.ascontiguousarray(made[:, 0]), np.ascontiguousarray(made[:, 1])]


STRETCH = "name long, p1 long, p2 long, doc long, key long, start int, n int"
WINDOW = "p1 long, p2 long, doc long, key long, start int"


def _batch(schema: str, columns: list) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c) for c in columns], names=[x.split()[0] for x in schema.split(", ")])


def _stretches(window: int):
    """(doc, key, text) to STRETCH."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for a, _, base, words, _ in units(batch.column(2), window - 1):
                starts, name = anchors(words, window)
                if not len(starts):
                    continue
                doc = np.searchsorted(words.first, starts, "right") - 1
                new = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
                cut = np.flatnonzero(np.concatenate([[True], new]))
                size = np.diff(np.append(cut, len(starts)))
                begin, d = starts[cut], doc[cut]
                whole = prints(words, begin, begin + size + window - 1)
                place = (begin - words.first[d] + base).astype(np.int32), size.astype(np.int32)
                yield _batch(STRETCH, [name[cut].view(np.int64), *whole, ids[a + d], keys[a + d], *place])

    return run


def _windows(window: int):
    """(doc, key, text, at: start, n) to one row a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, at = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(3)
            for a, b, base, words, _ in units(batch.column(2), window - 1):
                part = at.slice(a, b - a)
                flat, per = part.flatten(), np.diff(part.offsets.to_numpy())
                d = np.repeat(np.arange(b - a), per)
                start, n = (flat.field(k).to_numpy().astype(np.int64) - (base if k == 0 else 0) for k in (0, 1))
                end = np.minimum(start + n, words.count[d] - window + 1)
                start = np.maximum(start, 0)
                ok = end > start
                d, start, n = d[ok], start[ok], (end - start)[ok]
                row = np.repeat(np.arange(len(d)), n)
                local = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + start[row]
                begin = words.first[d[row]] + local
                # A few at a time: what is held doesn't grow with the text.
                for k in range(0, len(begin), 1 << 16):
                    x = slice(k, k + (1 << 16))
                    of, place = a + d[row[x]], (local[x] + base).astype(np.int32)
                    yield _batch(WINDOW, [*prints(words, begin[x], begin[x] + window), ids[of], keys[of], place])

    return run


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, out: str = "spans"
) -> DataFrame:
    """docs with `spans`: the runs of word windows (first word, number of windows) that also start in a
    document of a smaller id; null where there are none."""
    spans, own = "__sd_runs", ["__sd_doc", "__sd_key"]
    # Rows are told apart by id and text: where both are equal, so are the spans.
    row = F.col(id_col).cast("long"), F.xxhash64(F.col(id_col).cast("long"), F.col(text_col))
    lean = docs.select(row[0].alias("doc"), row[1].alias("key"), F.col(text_col).alias("text"))
    lean = lean.where("doc is not null and text is not null")
    rows = stage(arrow_map(lean, _stretches(window), STRETCH), "stretches", "zstd")
    # Most names stand in one document alone, which no other can repeat: they go before anything else.
    ends = F.min("doc").alias("least"), F.max("doc").alias("most"), F.count("*").alias("rows")
    names = stage(rows.groupBy("name").agg(*ends).where("most > least").select("name", "rows"), "names")
    met = stage(join_groups(rows, names, ["name"], "rows", rows.count()), "met", "zstd")
    discard(rows, names)

    whole = stage(met.groupBy("name", "p1", "p2").agg(*ends), "whole")
    forms = stage(whole.groupBy("name").agg(F.count("*").alias("forms")).where("forms > 1"), "forms")
    many = forms.select("name", "forms", F.lit(True).alias("many"))
    many = join_groups(whole, many, ["name"], "forms", whole.count())
    once = whole.join(forms.select("name"), "name", "left_anti").where("most > least").withColumn("many", F.lit(False))
    live = stage(many.unionByName(once).select("p1", "p2", "least", "many", "rows"), "live")
    shared = join_groups(met, live, ["p1", "p2"], "rows", met.count()).where("doc > least or many")
    place = ["doc", "key", "start", "n"]
    found = stage(shared.select(*place, (F.col("doc") > F.col("least")).alias("copied")), "shared", "zstd")
    discard(met, whole, forms, live)

    # Sets, as equal rows have equal spans.
    listed = F.collect_set(F.struct("start", "n"))
    ask = found.where("not copied").groupBy("doc", "key").agg(listed.alias("at"))
    asked = lean.join(ask.hint("shuffle_hash"), ["doc", "key"]).select("doc", "key", "text", "at")
    single = stage(arrow_map(asked, _windows(window), WINDOW), "windows", "zstd")
    least = single.groupBy("p1", "p2").agg(*ends).where("most > least").select("p1", "p2", "least", "rows")
    least = stage(least, "least")
    late = join_groups(single, least, ["p1", "p2"], "rows", single.count()).where("doc > least")
    runs = found.where("copied").select(*place).unionByName(late.select("doc", "key", "start", F.lit(1).alias("n")))
    runs = runs.groupBy(*(F.col(c).alias(o) for c, o in zip(("doc", "key"), own, strict=True))).agg(listed.alias(spans))
    keyed = docs.select(*(c.alias(o) for c, o in zip(row, own, strict=True)), *docs.columns)
    joined = keyed.join(runs.hint("shuffle_hash"), own, "left")
    return joined.select(*replaced(docs.columns, (out,)), F.col(spans).alias(out))


def keep_mask(words: Words, base: int, spans: pa.Array, window: int) -> np.ndarray:
    """Which words stay; spans: those of each document of the unit, `base`: words before it."""
    step = np.zeros(int(words.first[-1]) + 1, np.int32)
    flat, per = spans.flatten(), np.diff(spans.offsets.to_numpy()) if len(spans) else np.zeros(0, int)
    d = np.repeat(np.arange(len(spans)), per)
    start, n = (flat.field(k).to_numpy().astype(np.int64) - (base if k == 0 else 0) for k in (0, 1))
    a = words.first[d] + np.clip(start, 0, words.count[d])
    b = words.first[d] + np.clip(start + n + window - 1, 0, words.count[d])
    np.add.at(step, a, 1)
    np.add.at(step, b, -1)
    return np.cumsum(step[:-1]) == 0


def kept(text: pa.Array, spans: pa.Array, window: int) -> Iterator[tuple[int, int, bytes, bool]]:
    """(words, words removed, what is kept: words joined by one space, whether the row ends) of every row,
    of a long one part by part."""
    for a, b, base, words, last in units(text):
        stay = keep_mask(words, base, spans.slice(a, b - a), window)
        flat, begin = words.flat
        for d in range(b - a):
            i, j = int(words.first[d]), int(words.first[d + 1])
            x, y = int(begin[i]), int(begin[j])
            gone = j - i - int(stay[i:j].sum())
            mine = flat[x:y] if not gone else flat[x:y][np.repeat(stay[i:j], np.diff(begin[i : j + 1]))]
            yield j - i, gone, mine[:-1].tobytes(), last


def dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 50,
    out: tuple[str, str] = ("n_words", "n_removed"),
) -> DataFrame:
    """docs with the repeated words taken out of the text (the rest joined by one space; a text that
    loses nothing stays as it is), and with `n_words` and `n_removed` (or the names in `out`)."""
    found = repeated_spans(docs, id_col, text_col, window, "__sd_spans")
    names = replaced(docs.columns, out)
    found = found.select(*names, F.col(text_col).alias("__sd_text"), "__sd_spans")
    schema = T.StructType([*(docs.schema[c] for c in names), *(T.StructField(c, T.LongType()) for c in out)])

    def run(batches):
        for batch in batches:
            text, rows, parts, words, removed = batch.column(len(names)), [], [], 0, 0
            for n, gone, some, last in kept(text, batch.column(len(names) + 1), window):
                words, removed = words + n, removed + gone
                if some:
                    parts.append(some)
                if last:
                    rows.append((b" ".join(parts) if removed else None, words, removed))
                    parts, words, removed = [], 0, 0
            old = text.to_pylist()
            new = pa.array([t if r[0] is None else r[0].decode() for t, r in zip(old, rows, strict=True)], text.type)
            columns = [new if c == text_col else batch.column(k) for k, c in enumerate(names)]
            yield pa.record_batch(
                [*columns, *(pa.array([r[k] for r in rows], pa.int64()) for k in (1, 2))], names=schema.names
            )

    return arrow_map(found, run, schema)


DIGEST = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def digest(docs: DataFrame, window: int = 50) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row of (doc_id, text)."""
    found = repeated_spans(docs.select("doc_id", "text"), "doc_id", "text", window)

    def run(batches):
        for batch in batches:
            rows, sha, words, removed, some = [], hashlib.sha256(), 0, 0, False
            for n, gone, part, last in kept(batch.column(1), batch.column(2), window):
                words, removed = words + n, removed + gone
                if part:
                    sha.update(b" " + part if some else part)
                    some = True
                if last:
                    rows.append((words, removed, sha.hexdigest()))
                    sha, words, removed, some = hashlib.sha256(), 0, 0, False
            columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string()))]
            yield pa.record_batch([batch.column(0), *columns], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return arrow_map(found, run, DIGEST)


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
