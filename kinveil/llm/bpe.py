"""Byte-level BPE by a distinct-word table.

1. Split: each task splits its texts into words (the pieces that merges never cross, by the published
   pattern) and writes them down as positions in a block's word list; a block is some 32 million
   characters of one task, and the list is in order of frequency, so positions are small numbers. Texts
   are split once and the rest works on positions and words. The table is bucketed by block.
2. Table: the word lists of all blocks are dealt by the words' checksums into BUCKETS buckets. A task
   goes through its buckets one after the other and encodes each distinct word of a bucket once, by
   the tokenizers library, whatever the number of blocks that ask; equal words are found by comparing
   the words themselves. Lists travel packed, some hundred words a row, which is what keeps the
   exchange a fraction of the text.
3. Join: the ids go back to their blocks, whose rows are read where they are and take them by position.
4. Decoding is a join of ids with the (id, piece) table; as ids are dense and the table is bounded by
   the vocabulary, it is broadcast and joined by position (Arrow's take). join_pieces() does it, for
   decode() and for the query alike.

Every exchange is written by tasks and read by tasks; nothing goes through the driver. A task holds one
block's positions and word list, or one bucket's distinct words (all distinct words over BUCKETS).

Edge cases: null is encoded as empty text (no ids); special tokens written in a text become their id,
as in the library; repeated rows and any other columns pass through, but for columns with an output's
name, which the output replaces; an empty table gives an empty table. A text longer than PART characters
is split part by part. Tokenizer files with other pre-tokenization than byte level with its regex, with
a normalizer, or with added tokens that strip or match whole words are refused.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kinveil.llm._text import arrow_map, replaced
from kinveil.operators.staging import stage_buckets

#: A block ends at so many characters, or so many distinct words.
BLOCK_CHARS, BLOCK_WORDS = 32_000_000, 1 << 20
#: Parts of the distinct-word table that are encoded one at a time.
BUCKETS = 4096
#: Characters of one text that are split at a time, and ids that are laid out or decoded at a time, about.
PART, IDS = 1 << 20, 1 << 20
#: Fixed value: the published pattern of byte-level pre-tokenization.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WORD = regex.compile(PATTERN)
#: White space after something else: no word goes across its start.
_CUT = regex.compile(r"(?<=\S)\s")


class Tokens:
    """A tokenizer file: its vocabulary, and ids of words from the library itself."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        spec = json.loads(open(path, encoding="utf-8").read())
        pre = spec["pre_tokenizer"]
        if pre["type"] != "ByteLevel" or pre.get(
            "add_prefix_space"
        ) or not pre.get("use_regex", True) or spec["normalizer"]:
            raise ValueError(f"{path} is not a plain byte-level tokenizer")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} has added tokens that look around them")
        self.tool = Tokenizer.from_file(path)
        self.tool.no_truncation()
        self.tool.no_padding()
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.find = re.compile(
            "(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")"
        ) if self.added else None
        # Byte level: printable bytes stand for themselves, the rest for code points from 256 on.
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        byte = {chr(b): b for b in plain} | {
            chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in plain)
        }
        vocabulary = self.tool.get_vocab(with_added_tokens=True)
        pieces: list[bytes] = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            pieces[i] = piece.encode() if piece in self.added else bytes(byte[c] for c in piece)
        self.pieces = pa.array(pieces, pa.large_binary())
        self.decimals = pa.array([b"%d," % i for i in range(len(pieces))], pa.large_binary())

    def encode(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tool.encode_batch_fast(words, add_special_tokens=False)]

    def words(self, text: str) -> Iterator[list[str]]:
        """The words of a text in order, a list for each part of it; special tokens are words."""
        for k, piece in enumerate(self.find.split(text) if self.find else [text]):
            if k % 2:
                yield [piece]
                continue
            at = 0
            while at < len(piece):
                cut = _CUT.search(piece, at + PART) if len(piece) - at > 2 * PART else None
                end = cut.start() if cut else len(piece)
                yield _WORD.findall(piece[at:end] if at or end < len(piece) else piece)
                at = end


@lru_cache(4)
def tokens(path: str) -> Tokens:
    return Tokens(path)


@lru_cache(1)
def _codec() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _packed(*parts: bytes) -> bytes:
    """Byte strings in one, compressed."""
    head = np.array([len(parts), *map(len, parts)], np.uint64).tobytes()
    return _codec()[0].compress(head + b"".join(parts))


def _unpacked(raw: bytes) -> list[memoryview]:
    body = memoryview(_codec()[1].decompress(raw))
    n = int.from_bytes(body[:8], "little")
    edge = np.cumsum([8 * (n + 1), *np.frombuffer(body, np.uint64, n, 8).astype(np.int64)]).tolist()
    return [body[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]


def _planes(x: np.ndarray) -> bytes:
    """Numbers by byte planes, as high bytes are mostly zero."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unplaned(raw: memoryview) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()


class _Block:
    """Rows of one task with the words of their texts, until the block is full."""

    def __init__(self, number: int):
        self.number, self.words, self.chars, self.rows, self.at = number, {}, 0, [], []

    def add(self, text: str, tool: Tokens) -> np.ndarray:
        words = self.words
        parts = [
            np.fromiter((words.setdefault(w, len(words)) for w in some), np.uint32, len(some))
            for some in tool.words(text)
        ]
        self.chars += len(text)
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)

    def batches(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """The rows, bucket null; then for each bucket of the block's list its words and their positions."""
        every = [np.zeros(0, np.uint32), *(y for x in self.at for y in x)]
        count = np.bincount(np.concatenate(every), minlength=len(self.words))
        order = np.argsort(-count, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        for columns, x in zip(self.rows, self.at, strict=True):
            n = len(x)
            data = [_packed(_planes(rank[y])) for y in x]
            yield pa.record_batch(
                [
                    *columns,
                    pa.array([self.number] * n, pa.int64()),
                    pa.nulls(n, pa.int32()),
                    pa.array(data, pa.binary()),
                    pa.nulls(n, pa.binary()),
                ],
                schema=schema,
            )
        raw = [w.encode() for w in self.words]
        of = np.array([zlib.crc32(w) % BUCKETS for w in raw], np.int64)[order]
        size = np.array(list(map(len, raw)), np.uint32)[order]
        place = np.argsort(of, kind="stable")
        edge = np.flatnonzero(np.diff(of[place], prepend=-1, append=-1))
        each = [place[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]
        data = [_packed(_planes(np.diff(x, prepend=0))) for x in each]
        words = [_packed(_planes(size[x]), b"".join([raw[i] for i in order[x].tolist()])) for x in each]
        n = len(each)
        mine = [
            pa.array([self.number] * n, pa.int64()),
            pa.array(of[place][edge[:-1]].astype(np.int32)),
            pa.array(data, pa.binary()),
            pa.array(words, pa.binary()),
        ]
        yield pa.record_batch([*(pa.nulls(n, f.type) for f in list(schema)[:-4]), *mine], schema=schema)


def _split(path: str, width: int):
    """Rows (.., text) to (.., block, bucket, data, words), see _Block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, schema, block = tokens(path), None, _Block(TaskContext.get().partitionId() << 32)
        for batch in batches:
            schema = pa.schema(
                [
                    *(batch.schema.field(k) for k in range(width)),
                    *((n, t) for n, t in zip(EXTRA, (pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)),
                ]
            )
            first, at = 0, []
            for i in range(len(batch)):
                at.append(block.add(batch.column(width)[i].as_py() or "", tool))
                full = block.chars >= BLOCK_CHARS or len(block.words) >= BLOCK_WORDS
                if full or i + 1 == len(batch):
                    # A copy, as what it is cut from is gone with the next batch.
                    block.rows.append(
                        [pa.concat_arrays([batch.column(k).slice(first, i + 1 - first)]) for k in range(width)]
                    )
                    block.at.append(at)
                    first, at = i + 1, []
                if full:
                    yield from block.batches(schema)
                    block = _Block(block.number + 1)
        if block.rows:
            yield from block.batches(schema)

    return run


def _encoded(path: str):
    """(bucket, block, words) sorted by bucket to (block, bucket, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, known, now = tokens(path), {}, None
        for batch in batches:
            out = []
            for bucket, raw in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if bucket != now:
                    known, now = {}, bucket
                size, text = _unpacked(raw)
                end, text = np.cumsum(_unplaned(size)).tolist(), bytes(text)
                words = [text[a:b] for a, b in zip([0, *end], end, strict=False)]
                new = [w for w in dict.fromkeys(words) if w not in known]
                known.update(
                    zip(
                        new,
                        (np.asarray(x, "<u4").tobytes() for x in tool.encode([w.decode() for w in new])),
                        strict=True,
                    )
                )
                ids = [known[w] for w in words]
                out.append(
                    _packed(_planes(np.array(list(map(len, ids))) // 4), _planes(np.frombuffer(b"".join(ids), "<u4")))
                )
            yield pa.record_batch(
                [batch.column(1), batch.column(0), pa.array(out, pa.binary())],
                names=["__b_block", "__b_bucket", "__b_ids"],
            )

    return run


class _Table:
    """A block's ids by position, gathered from its buckets."""

    def __init__(self, place: dict[int, bytes], ids: dict[int, bytes]):
        if place.keys() != ids.keys():
            raise ValueError("a block's word list and its ids don't belong together")
        parts = [
            [np.cumsum(_unplaned(_unpacked(place[k])[0])), *map(_unplaned, _unpacked(ids[k]))] for k in sorted(place)
        ]
        at, size, pool = (
            np.concatenate(x) if x else np.zeros(0, np.uint32)
            for x in (zip(*parts, strict=True) if parts else ([], [], []))
        )
        at, size, self.pool = at.astype(np.int64), size.astype(np.int64), pool.astype(np.int32)
        self.start, self.size = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        self.size[at], self.start[at] = size, np.cumsum(size) - size

    def lay_out(self, at: np.ndarray) -> np.ndarray:
        """ids of the words at these positions, in order."""
        out = [np.zeros(0, np.int32)]
        for k in range(0, len(at), IDS):
            x = at[k : k + IDS]
            per = self.size[x]
            end = np.cumsum(per)
            out.append(self.pool[np.repeat(self.start[x] - (end - per), per) + np.arange(int(end[-1]))])
        return np.concatenate(out)


def join_pieces(ids: np.ndarray, pieces: pa.Array) -> Iterator[memoryview]:
    """The pieces of ids in order, joined; IDS of them at a time. Ids without a piece are an error."""
    for k in range(0, len(ids), IDS):
        part = pieces.take(pa.array(ids[k : k + IDS]))
        edge = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
        yield memoryview(part.buffers()[2])[int(edge[0]) : int(edge[-1])] if edge[-1] > edge[0] else memoryview(b"")


def decoded(ids: np.ndarray, pieces: pa.Array) -> str:
    return b"".join(join_pieces(ids, pieces)).decode("utf-8", "replace")


EXTRA = ("__b_block", "__b_bucket", "__b_data", "__b_words")


def _joined(path: str, width: int, columns: Callable, schema: pa.Schema):
    """A block's rows and positions (.., block, bucket, data), and its ids (block, bucket, ids)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        tool = tokens(path)
        of, data = left.column(width + 1).to_pylist(), left.column(width + 2).to_pylist()
        table = _Table(
            {k: x for k, x in zip(of, data, strict=True) if k is not None},
            dict(zip(right.column(1).to_pylist(), right.column(2).to_pylist(), strict=True)),
        )
        rows = [i for i, k in enumerate(of) if k is None]
        made = columns(tool, [table.lay_out(_unplaned(_unpacked(data[i])[0])) for i in rows])
        mine = left.select(list(range(width))).take(pa.array(rows, pa.int64()))
        return pa.table([*mine.columns, *made], schema=schema)

    return run


def _mapped(
    docs: DataFrame, path: str, text_col: str, added: T.StructType, columns: Callable, keep_text: bool
) -> DataFrame:
    """docs with what columns(tool, ids of every row) makes."""
    names = replaced(docs.columns, tuple(added.names))
    names = [c for c in names if keep_text or c != text_col]
    # Names of their own while written, whatever the table's are.
    source = docs.select(*(F.col(c).alias(f"__b_{k}") for k, c in enumerate(names)), F.col(text_col).alias("__b_text"))
    width = len(names)
    fields = [T.StructField(f.name, f.dataType, True) for f in source.schema.fields[:-1]]
    kinds = (T.LongType(), T.IntegerType(), T.BinaryType(), T.BinaryType())
    schema = T.StructType([*fields, *(T.StructField(n, t) for n, t in zip(EXTRA, kinds, strict=True))])
    parts = stage_buckets(
        arrow_map(source, _split(path, width), schema),
        "words",
        "__b_block",
        min(max(source.rdd.getNumPartitions(), 1), 50_000),
    )
    lists = parts.where("__b_bucket is not null").select(
        "__b_bucket", "__b_block", "__b_words"
    ).repartition("__b_bucket").sortWithinPartitions("__b_bucket")
    table = arrow_map(lists, _encoded(path), "__b_block long, __b_bucket int, __b_ids binary")
    out = T.StructType([*fields, *added.fields])
    both = parts.drop("__b_words").groupBy("__b_block").cogroup(table.groupBy("__b_block"))
    made = both.applyInArrow(_joined(path, width, columns, to_arrow_schema(out)), out)
    return made.select(*(F.col(f"__b_{k}").alias(c) for k, c in enumerate(names)), *added.names)


def encode(docs: DataFrame, path: str, text_col: str = "text", out: str = "ids", keep_text: bool = True) -> DataFrame:
    """docs, in any order, with `ids`: array<int>; without the text if keep_text is false."""

    def columns(tool: Tokens, ids: list[np.ndarray]) -> list[pa.Array]:
        edge = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
        return [
            pa.ListArray.from_arrays(
                pa.array(edge), pa.array(np.concatenate([np.zeros(0, np.int32), *ids]), pa.int32())
            )
        ]

    added = T.StructType([T.StructField(out, T.ArrayType(T.IntegerType(), True))])
    return _mapped(docs, path, text_col, added, columns, keep_text)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """encoded with the text of its ids; null ids give null, ids outside the vocabulary are an error."""
    names = replaced(encoded.columns, (out,))
    source = encoded.select(*names, F.col(ids_col).alias("__b_ids"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField(out, T.StringType())])

    def run(batches):
        pieces = tokens(path).pieces
        for batch in batches:
            each = (batch.column(len(names))[i] for i in range(len(batch)))
            text = [decoded(x.values.to_numpy(zero_copy_only=False), pieces) if x.is_valid else None for x in each]
            yield pa.record_batch([*batch.columns[:-1], pa.array(text, pa.string())], names=schema.names)

    return arrow_map(source, run, schema)


def _digest(tool: Tokens, ids: list[np.ndarray]) -> list[pa.Array]:
    n, ids_sha, text_sha = [], [], []
    for x in ids:
        n.append(len(x))
        numbers = hashlib.sha256()
        for k, part in enumerate(join_pieces(x, tool.decimals)):
            if k:
                numbers.update(b",")
            numbers.update(part[:-1])
        ids_sha.append(numbers.hexdigest())
        text_sha.append(hashlib.sha256(decoded(x, tool.pieces).encode()).hexdigest())
    return [pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]


def digest(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """docs with, in place of the text, n_tokens, ids_sha256 and decoded_sha256 of what encode() and decode()
    give, taken where they are made: ids don't travel."""
    added = T.StructType(
        [
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )
    return _mapped(docs, path, text_col, added, _digest, False)


def op4_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digest(
        spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"),
        public_tokenizers.path("byte_bpe_50k.json"),
    )
