"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are n-grams of the lower-cased text, 1 to 3 code points, hashed to BUCKETS columns; weights
are log(1 + count) times the inverse document frequency, scaled to length 1. Document frequencies
cover every training document. The regression is fitted on the driver on a bounded sample by
follow-the-regularised-leader (FTRL-proximal: per-coordinate rates, L1 and L2), which leaves most
weights at zero. The sample has each language's share of `train_rows` documents, and `least` of every
language if it has them, so that rare languages are learned too; `languages` (the most frequent ones)
are learned at most. So it has train_rows + least * languages rows at most, whatever the corpus. Its
documents are those of the least hashes, each once however often a row is repeated. One in five of them is
kept from the fit and sets the temperature by which scores are calibrated. The model is a BUCKETS x
languages array.

Edge cases: text that is null, empty or without a letter gets `und` with score 0; rows without a
language or an id are never learned from; without any row to learn from every prediction is `und`;
with one language that language has score 1. Whole texts count, however long. Repeated rows are predicted
alike. Other columns pass through, but for those with an output's name, which the output replaces. An
empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinveil.llm._text import arrow_map, replaced

BUCKETS = 1 << 15
#: A text fits no learned language if its score is less than this share of the way from even odds to certainty
#: (0.4 with four languages); texts of fewer letters than SHORT say too little to be rejected.
FIT = 0.2
SHORT = 20
_U = np.uint32


#: Code points of one text that are turned into arrays at a time.
PART = 1 << 18
_BLANK = np.array([chr(i).isspace() for i in range(0x3002)])


def _buckets(x: np.ndarray, seen: int) -> np.ndarray:
    """Counts by bucket of the n-grams of x that end at or after its code point `seen`."""
    at, key = [], x * _U(0x9E3779B1)
    for n in range(1, 4):
        if n > 1:
            key = (key[:-1] ^ (key[:-1] >> _U(15))) * _U(0x85EBCA77) + x[n - 1 :] * _U(0xC2B2AE3D)
        fresh = key[max(0, seen - n + 1) :]
        at.append(((fresh ^ (fresh >> _U(16))) * _U(0x27D4EB2F)) >> _U(17))
    return np.bincount(np.concatenate(at), minlength=BUCKETS)


def grams(text: str | None) -> np.ndarray | None:
    """Counts by bucket of the whole text's n-grams; None without a letter. White space counts as one
    space, and one stands at both ends. A long text is read part by part, each with the two code points
    before it, so memory does not grow with its length."""
    if not text or not any(map(str.isalpha, text)):
        return None
    total, held, text = 0, np.zeros(0, _U), f" {text.lower()} "
    for a in range(0, len(text), PART):
        x = np.concatenate([held, np.frombuffer(text[a : a + PART].encode("utf-32-le", "surrogatepass"), _U)])
        blank = _BLANK[np.minimum(x, len(_BLANK) - 1)]
        x[blank] = 0x20
        blank[1:] &= blank[:-1]
        blank[: max(len(held), 1)] = False
        x = x[~blank]
        total = total + _buckets(x, len(held))
        held = x[-2:]
    return total


@dataclass
class Model:
    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray  # BUCKETS x labels
    bias: np.ndarray
    temperature: float = 1.0

    def vector(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The unit vector of n counts at the buckets at."""
        v = np.log1p(n).astype(np.float32) * self.idf[at]
        return v / max(float(np.sqrt(v @ v)), 1e-12)

    def logits(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self.vector(at, n) @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = grams(text)
        if counts is None or not self.labels:
            return "und", 0.0
        at = np.flatnonzero(counts)
        p = _softmax(self.logits(at, counts[at]).astype(np.float64) / self.temperature)
        k = int(p.argmax())
        return self.labels[k], float(p[k])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def _follow(
    model: Model,
    rows: list[tuple[np.ndarray, np.ndarray, int]],
    epochs: int,
    alpha: float,
    beta: float,
    l1: float,
    l2: float,
) -> None:
    """FTRL-proximal on (buckets, counts, label): z and n by coordinate, weights from them in closed form."""
    k = len(model.labels)
    z, n = np.zeros((BUCKETS + 1, k)), np.zeros((BUCKETS + 1, k))

    def solve(at):
        zz = z[at]
        return np.where(np.abs(zz) <= l1, 0.0, -(zz - np.sign(zz) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    order = np.random.Generator(np.random.PCG64(7))
    vectors = [
        (np.append(at, BUCKETS), np.append(v, 1.0), y)
        for at, v, y in ((at, model.vector(at, n), y) for at, n, y in rows)
    ]
    for _ in range(epochs):
        for i in order.permutation(len(vectors)):
            at, v, y = vectors[i]
            w = solve(at)
            err = _softmax(v @ w)
            err[y] -= 1
            g = v[:, None] * err[None, :]
            g2 = g * g
            old = n[at]
            z[at] += g - (np.sqrt(old + g2) - np.sqrt(old)) / alpha * w
            n[at] = old + g2
    full = solve(np.arange(BUCKETS + 1))
    model.weights, model.bias = full[:-1].astype(np.float32), full[-1].astype(np.float32)


def _calibrate(model: Model, rows: list[tuple[np.ndarray, np.ndarray, int]]) -> None:
    """The temperature of least log loss on rows kept from the fit, over a grid."""
    if not rows:
        return
    z, y = np.array([model.logits(*x[:2]) for x in rows], np.float64), np.array([x[2] for x in rows])

    def loss(t):
        s = z / t
        s = s - s.max(1, keepdims=True)
        return float((np.log(np.exp(s).sum(1)) - s[np.arange(len(y)), y]).mean())

    model.temperature = min(np.geomspace(0.05, 10, 60).tolist(), key=loss)


_SUMMED = T.StructType([T.StructField("n", T.LongType()), T.StructField("df", T.BinaryType())])


def fit(
    train: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    train_rows: int = 1536,
    least: int = 64,
    languages: int = 256,
    epochs: int = 4,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.1,
) -> Model:
    """Learn from the rows of train that have an id, a text with a letter and a language."""
    train = train.select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    train = train.where("id is not null and text is not null and lang is not null").where(F.col("text").rlike(r"\p{L}"))

    def frequencies(batches):
        df, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                c = grams(text.as_py())
                if c is not None:
                    df += c > 0
                    n += 1
        if n:
            yield pa.record_batch(
                [pa.array([n], pa.int64()), pa.array([df.tobytes()], pa.binary())],
                schema=pa.schema([("n", pa.int64()), ("df", pa.binary())]),
            )

    def fold(batches):
        df, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n, df = n + k, df + np.frombuffer(raw, np.int64)
        if n:
            yield pa.record_batch(
                [pa.array([n], pa.int64()), pa.array([df.tobytes()], pa.binary())],
                schema=pa.schema([("n", pa.int64()), ("df", pa.binary())]),
            )

    # One array a task; folded over 32 tasks before the driver adds the rest.
    parts = arrow_map(arrow_map(train.select("text"), frequencies, _SUMMED).repartition(32), fold, _SUMMED).collect()
    n = sum(p.n for p in parts)
    df = sum((np.frombuffer(p.df, np.int64) for p in parts), np.zeros(BUCKETS, np.int64))
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)

    keyed = train.withColumn("h", F.xxhash64("id", "text"))
    single = keyed.groupBy("lang", "h", "id").agg(F.lit(1).alias("one"))
    known = single.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()
    every = sum(r.n for r in known)
    quota = {r.lang: max(least, train_rows * r.n // every) for r in known}
    if not quota:
        return Model([], idf, np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32))
    allowed = train.sparkSession.createDataFrame(list(quota.items()), "lang string, quota int")
    rank = F.row_number().over(W.partitionBy("lang").orderBy("h", "id"))
    ranked = single.withColumn("rank", rank).where(
        F.col("rank") <= max(quota.values())
    ).join(F.broadcast(allowed), "lang").where("rank <= quota")
    chosen = {(r.id, r.h, r.lang) for r in ranked.select("id", "h", "lang").collect()}

    def counted(batches):
        seen = set()
        for batch in batches:
            rows = []
            for i, h, lang, t in zip(*(batch.column(k).to_pylist() for k in range(3)), batch.column(3), strict=True):
                if (i, h, lang) not in seen and (c := grams(t.as_py())) is not None:
                    seen.add((i, h, lang))
                    at = np.flatnonzero(c)
                    rows.append((i, h, lang, at.astype(np.int32).tobytes(), c[at].astype(np.int32).tobytes()))
            kinds = (pa.string(), pa.int64(), pa.string(), pa.binary(), pa.binary())
            yield pa.record_batch(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["id", "h", "lang", "at", "n"]
            )

    ids = train.sparkSession.createDataFrame(sorted(chosen), "id string, h long, lang string")
    asked = keyed.join(F.broadcast(ids), ["id", "h", "lang"], "left_semi").select("id", "h", "lang", "text")
    # Each task gives a chosen row once, and so does the sum of all tasks.
    sample = arrow_map(asked, counted, "id string, h long, lang string, at binary, n binary")
    sample = sample.groupBy("id", "h", "lang").agg(F.first("at").alias("at"), F.first("n").alias("n")).collect()
    sample.sort(key=lambda r: (zlib.crc32(r.id.encode()), r.id, r.lang, r.at, r.n))
    model = Model(sorted({r.lang for r in sample}), idf, np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32))
    number = {x: i for i, x in enumerate(model.labels)}
    rows = [(np.frombuffer(r.at, np.int32), np.frombuffer(r.n, np.int32), number[r.lang]) for r in sample]
    aside = [x for i, x in enumerate(rows) if i % 5 == 4]
    _follow(model, [x for i, x in enumerate(rows) if i % 5 != 4], epochs, alpha, beta, l1, l2)
    _calibrate(model, aside)
    return model


def predict(
    docs: DataFrame, model: Model, text_col: str = "text", out: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """docs with `lang_pred` and `score` (or the names in `out`)."""
    names = replaced(docs.columns, out)
    source = docs.select(*names, F.col(text_col).alias("__li_text"))
    schema = T.StructType(
        [*source.schema.fields[:-1], T.StructField(out[0], T.StringType()), T.StructField(out[1], T.DoubleType())]
    )

    def run(batches):
        for batch in batches:
            got = [model.predict(t.as_py()) for t in batch.column(len(names))]
            yield pa.record_batch(
                [
                    *batch.columns[:-1],
                    pa.array([g[0] for g in got], pa.string()),
                    pa.array([g[1] for g in got], pa.float64()),
                ],
                names=schema.names,
            )

    return arrow_map(source, run, schema)


def known(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of docs whose text has a letter and fits a learned language: its calibrated score is at
    least FIT of the way from even odds to certainty, or it has fewer than SHORT letters. Here the temperature
    is 1 at least: on a small corpus the rows kept from the fit are told apart without error, the temperature
    falls to the grid's end, and noise would be certain too. With one language or none there are no odds to
    reject by: every text with a letter stays."""
    if not model.labels:
        model = Model(
            ["und?"], np.ones(BUCKETS, np.float32), np.zeros((BUCKETS, 1), np.float32), np.zeros(1, np.float32)
        )
    k = len(model.labels)
    out = predict(docs, replace(model, temperature=max(1.0, model.temperature)), text_col, ("__li_lang", "__li_score"))
    letters = F.length(F.regexp_replace(F.col(text_col), r"\P{L}+", ""))
    fits = (F.col("__li_score") >= 1 / k + FIT * (1 - 1 / k)) | (letters < SHORT) | F.lit(k == 1)
    return out.where(F.col("__li_lang") != "und").where(fits).select(*docs.columns)


def held_out(id_col: str = "doc_id"):
    """A fixed quarter of the ids that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.where(~held_out()))
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")
