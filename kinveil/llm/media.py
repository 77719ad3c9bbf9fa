"""Media columns: Netpbm and BMP images decoded to arrays, resized by area, kept as NPY tiles.

Decoders take the binary formats Netpbm P4, P5 and P6 (8 or 16 bits a sample) and the ASCII P1 to P3,
and uncompressed BMP of 1, 4, 8, 24 and 32 bits, bottom-up or top-down. Resizing averages exactly over
each target pixel's area, fractions of source pixels included, by differences of an integral image.
The difference hash has a bit for each pair of neighbours in a row of a 9 x 8 area-resized grey tile.
The integral image is kept only at the rows that a resize asks for, so large images cost little more
than their samples.

Edge cases: null or malformed media give null tiles and hashes (`ok` false), never an error; images
without pixels, and those that claim more samples than their bytes can hold, count as malformed; samples
are scaled to their greatest value (P2, P3, P5 and P6 with any maximum); equal bytes give equal results;
empty tables give empty tables; extra columns pass through, but for those with an output's name, which
the output replaces.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinveil.llm._text import arrow_map, replaced

#: The op5 payload is laid out as grey rows of this many samples; 576 is a multiple of it.
WIDTH = 24
BLOCK = 576
_TOKEN = re.compile(rb"(?:\s|#[^\n\r]*[\n\r])*([0-9]+)")


def to_pgm(samples: np.ndarray) -> bytes:
    """A binary greymap of 8 bits a sample; samples: 2-d uint8."""
    return b"P5\n%d %d\n255\n" % samples.shape[::-1] + samples.tobytes()


def to_bmp(samples: np.ndarray) -> bytes:
    """A bottom-up BMP: 2-d uint8 with a grey palette, or h x w x 3 as 24 bits."""
    h, w = samples.shape[:2]
    grey = samples.ndim == 2
    row = samples if grey else samples[:, :, ::-1].reshape(h, -1)
    padded = np.zeros((h, -(-row.shape[1] // 4) * 4), np.uint8)
    padded[:, : row.shape[1]] = row[::-1]
    palette = b"".join(bytes((i, i, i, 0)) for i in range(256)) if grey else b""
    at = 54 + len(palette)
    return struct.pack(
        "<2sIHHIIiiHHIIiiII",
        b"BM",
        at + padded.nbytes,
        0,
        0,
        at,
        40,
        w,
        h,
        1,
        8 if grey else 24,
        0,
        padded.nbytes,
        2835,
        2835,
        256 if grey else 0,
        0,
    ) + palette + padded.tobytes()


def _netpbm(raw: bytes) -> tuple[np.ndarray, int]:
    kind, at, head = raw[1] - 48, 2, []
    while len(head) < (2 if kind in (1, 4) else 3):
        m = _TOKEN.match(raw, at)
        if len(m[1]) > 9:
            raise ValueError("numbers too large")
        head.append(int(m[1]))
        at = m.end()
    w, h, top = (*head, 1)[:3]
    depth = 3 if kind in (3, 6) else 1
    if w * h == 0 or not 0 < top < 65536 or w * h * depth > 8 * len(raw):
        raise ValueError("no pixels, or more than there are bytes for")
    if kind in (1, 2, 3):
        body = re.sub(rb"#[^\n\r]*", b"", raw[at:])
        x = np.array(
            [int(n) for n in re.findall(rb"[01]" if kind == 1 else rb"[0-9]+", body)[: w * h * depth] if len(n) < 10],
            np.int64,
        )
    elif kind == 4:
        stride = -(-w // 8)
        x = np.unpackbits(np.frombuffer(raw, np.uint8, stride * h, at + 1).reshape(h, stride), axis=1)[:, :w].ravel()
    else:
        x = np.frombuffer(raw, np.dtype(">u2") if top > 255 else np.uint8, w * h * depth, at + 1)
    if len(x) < w * h * depth or int(x.max()) > top:
        raise ValueError("samples missing or too large")
    x = (1 - x) * 255 if kind in (1, 4) else x
    x = x.astype(np.uint16 if top > 255 else np.uint8, copy=False)
    return x.reshape((h, w, 3) if depth == 3 else (h, w)), 255 if kind in (1, 4) else top


def _bmp(raw: bytes) -> np.ndarray:
    at, size, w, h, _, bits, packing = struct.unpack_from("<IIiiHHI", raw, 10)
    used = struct.unpack_from("<I", raw, 46)[0]
    up, h = h > 0, abs(h)
    if packing or bits not in (1, 4, 8, 24, 32) or w <= 0 or not h:
        raise ValueError("not a plain BMP")
    stride = (w * bits + 31) // 32 * 4
    rows = np.frombuffer(raw, np.uint8, stride * h, at).reshape(h, stride)
    rows = rows[::-1] if up else rows
    if bits >= 24:
        return np.ascontiguousarray(rows[:, : w * bits // 8].reshape(h, w, bits // 8)[:, :, 2::-1])
    if bits < 8:
        each = np.unpackbits(rows, axis=1).reshape(h, -1, bits)
        rows = (each * (1 << np.arange(bits)[::-1])).sum(2)
    n = used or 1 << bits
    palette = np.frombuffer(raw, np.uint8, 4 * n, 14 + size).reshape(n, 4)[:, 2::-1]
    index = rows[:, :w]
    if int(index.max()) >= n:
        raise ValueError("beyond the palette")
    x = palette[index]
    return np.ascontiguousarray(x[:, :, 0]) if (palette == palette[:, :1]).all() else x


def measured(raw: bytes | None) -> tuple[np.ndarray, int] | None:
    """h x w (grey) or h x w x 3 samples and what they are at most; None for what is no image of the formats above."""
    try:
        if raw and raw[:1] == b"P" and raw[1:2] in b"123456":
            return _netpbm(raw)
        return (_bmp(raw), 255) if raw and raw[:2] == b"BM" else None
    except (ValueError, TypeError, IndexError, OverflowError, MemoryError, struct.error):
        return None


def decode(raw: bytes | None) -> np.ndarray | None:
    """The samples alone, as they are stored; bitmaps (P1 and P4) are 255 where white."""
    found = measured(raw)
    return None if found is None else found[0]


def resize(x: np.ndarray, height: int, width: int) -> np.ndarray:
    """Exact area averages as float64: differences of the integral image at the target's edges."""
    flat = x.ndim == 2
    x = x[:, :, None] if flat else x
    edge = np.arange(height + 1) * (x.shape[0] / height)
    low = np.minimum(edge.astype(int), x.shape[0] - 1)
    rows = np.union1d(low, low + 1)
    # Sums of all rows before each of these, which is all that the edges ask of the integral image.
    each = [x[a:b].sum(0, dtype=np.float64) for a, b in zip([0, *rows[:-1].tolist()], rows.tolist(), strict=True)]
    total = np.zeros((len(rows), x.shape[1] + 1, x.shape[2]))
    np.cumsum(np.cumsum(each, 0), 1, out=total[:, 1:])
    part = (edge - low)[:, None, None]
    down = np.diff(
        total[np.searchsorted(rows, low)] * (1 - part) + total[np.searchsorted(rows, low + 1)] * part, axis=0
    )
    edge = np.arange(width + 1) * (x.shape[1] / width)
    low = np.minimum(edge.astype(int), x.shape[1] - 1)
    part = (edge - low)[None, :, None]
    out = np.diff(
        down[:, low] * (1 - part) + down[:, low + 1] * part, axis=1
    ) / ((x.shape[0] / height) * (x.shape[1] / width))
    return out[:, :, 0] if flat else out


def grey(x: np.ndarray) -> np.ndarray:
    return x if x.ndim == 2 else x @ np.array([0.299, 0.587, 0.114])


def difference_hash(x: np.ndarray) -> str:
    """16 hex digits. Averages are rounded to 1/1024 first, so that ties are ties on any machine."""
    t = np.rint(grey(resize(x, 8, 9)) * 1024)
    return np.packbits(t[:, 1:] > t[:, :-1]).tobytes().hex()


def npy(x: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, x, allow_pickle=False)
    return out.getvalue()


TILES = "ok boolean, height int, width int, channels int, tile binary, dhash string"


def tiles(df: DataFrame, media_col: str = "media", height: int = 32, width: int = 32) -> DataFrame:
    """df with `ok`, `height`, `width`, `channels`, `tile` (NPY of uint8, height x width or with a
    third axis; scaled so that the greatest sample is 255, rounded half to even) and `dhash`."""
    new = T._parse_datatype_string(TILES)
    names = replaced(df.columns, tuple(new.names))
    source = df.select(*names, F.col(media_col).alias("__md"))
    kinds = (pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.string())

    def one(raw):
        found = measured(raw)
        if found is None:
            return False, None, None, None, None, None
        x, top = found
        small = np.rint(resize(x, height, width) * (255 / top)).clip(0, 255).astype(np.uint8)
        return True, x.shape[0], x.shape[1], 1 if x.ndim == 2 else 3, npy(small), difference_hash(x)

    def run(batches):
        for batch in batches:
            rows = [one(v.as_py()) for v in batch.column(len(names))]
            yield pa.record_batch(
                [*batch.columns[:-1], *(pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds))],
                names=[*names, *new.names],
            )

    return arrow_map(source, run, T.StructType([*source.schema.fields[:-1], *new.fields]))


OP5 = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, tile_sha256 string"


def text_media(docs: DataFrame) -> DataFrame:
    """The op5 digest: each text's bytes as a P5 image of WIDTH columns, decoded again and measured."""

    def one(text):
        raw = (text or "").encode()
        payload = raw + b"\xff" * (-len(raw) % BLOCK if raw else BLOCK)
        media = to_pgm(np.frombuffer(payload, np.uint8).reshape(-1, WIDTH))
        image = decode(media)
        back = image.tobytes()
        tile = npy(np.rint(resize(image, 32, WIDTH)).astype(np.uint8))
        sha = lambda b: hashlib.sha256(b).hexdigest()
        return len(raw), len(back), sha(back), zlib.crc32(
            back[-32:]
        ), len(media), sha(media), difference_hash(image), sha(tile)

    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
    names = [x.split()[0] for x in OP5.split(", ")]

    def run(batches):
        for batch in batches:
            rows = [one(t.as_py()) for t in batch.column(1)]
            yield pa.record_batch(
                [batch.column(0), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds))], names=names
            )

    return arrow_map(docs.select("doc_id", "text"), run, OP5)


def op5_media(spark, sf_dir: str) -> DataFrame:
    return text_media(spark.read.parquet(f"{sf_dir}/documents.parquet"))
