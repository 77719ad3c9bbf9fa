import hashlib
import io
import struct
import zlib

import numpy as np
import pytest

from kinveil.llm import media as m

RNG = np.random.default_rng(4)


def area(x, h, w):
    """Averages by brute force on a grid that both sizes divide."""
    big = np.repeat(np.repeat(x.astype(float), h, 0), w, 1)
    return big.reshape(h, x.shape[0], w, x.shape[1]).mean((1, 3))


def test_round_trips():
    for shape in ((1, 1), (3, 5), (7, 4), (24, 24)):
        x = RNG.integers(0, 256, shape, dtype=np.uint8)
        c = RNG.integers(0, 256, (*shape, 3), dtype=np.uint8)
        assert (m.decode(m.to_pgm(x)) == x).all() and (m.decode(m.to_bmp(x)) == x).all() and (m.decode(m.to_bmp(c)) == c).all()
        assert (m.decode(b"P6 # note\n%d %d 255\n" % shape[::-1] + c.tobytes()) == c).all()
        deep = RNG.integers(0, 60000, shape)
        assert (m.decode(b"P5\n%d %d\n60000\n" % shape[::-1] + deep.astype(">u2").tobytes()) == deep).all()
    assert m.decode(b"P1\n3 2\n1 0 1\n010").tolist() == [[0, 255, 0], [255, 0, 255]]
    assert m.decode(b"P4\n3 1\n\xa0").tolist() == [[0, 255, 0]]
    assert m.decode(b"P2\n# c\n2 1 9\n3 9").tolist() == [[3, 9]]
    assert m.decode(b"P3 1 1 255 1 2 3").tolist() == [[[1, 2, 3]]]
    four = b"BM" + struct.pack("<IHHIIiiHHIIiiII", 0, 0, 0, 62, 40, 3, -1, 1, 4, 0, 0, 0, 0, 2, 0) + bytes((9, 9, 9, 0, 7, 7, 7, 0)) + b"\x01\x10\0\0"
    assert m.decode(four).tolist() == [[9, 7, 7]]


@pytest.mark.parametrize("bad", [None, b"", b"P5", b"P5\n2 2\n255\nab", b"P5\n0 2\n255\n", b"BM123", b"GIF89a", b"P9\n1 1\n255\na", b"P5\n-1 2\n255\nabcd", b"P5\n99999999999 99999999999\n255\nab", b"P5 999999999 999999999 255 ab", b"P2 1 1 255 99999999999999999999999", b"P6 70000 70000 255\n" + b"a" * 99, m.to_bmp(np.ones((4, 4), np.uint8))[:-5]])
def test_malformed(bad):
    assert m.decode(bad) is None


def test_resize_is_exact():
    for (h, w), (a, b) in (((5, 7), (3, 2)), ((24, 24), (8, 9)), ((1, 1), (8, 9)), ((2, 3), (5, 4))):
        x = RNG.integers(0, 256, (h, w))
        assert np.allclose(m.resize(x, a, b), area(x, a, b))
        c = np.stack([x, x + 1, x * 2], 2)
        assert np.allclose(m.resize(c, a, b)[:, :, 2], area(c[:, :, 2], a, b))
    assert m.difference_hash(np.tile(np.arange(9), (8, 1))) == "f" * 16 and m.difference_hash(np.ones((50, 3))) == "0" * 16


def test_greatest_sample_is_white(spark):
    x = RNG.integers(0, 10, (8, 8), dtype=np.uint8)
    deep = (RNG.integers(0, 1001, (8, 8))).astype(">u2")
    rows = [(1, b"P5\n8 8\n9\n" + x.tobytes(), "a", True), (2, b"P5 8 8 1000\n" + deep.tobytes(), "b", None)]
    got = m.tiles(spark.createDataFrame(rows, "doc_id long, media binary, dHash string, ok boolean"), height=8, width=8).collect()
    assert got[0].asDict().keys() == {"doc_id", "media", "ok", "height", "width", "channels", "tile", "dhash"}
    assert np.load(io.BytesIO(got[0].tile)).tolist() == np.rint(x * (255 / 9)).tolist()
    assert np.load(io.BytesIO(got[1].tile)).tolist() == np.rint(deep * (255 / 1000)).tolist()


def test_columns_and_texts(spark):
    x = RNG.integers(0, 256, (40, 30), dtype=np.uint8)
    df = spark.createDataFrame([(1, m.to_pgm(x), 5), (2, None, 6), (3, b"no", 7), (1, m.to_pgm(x), 5)], "doc_id long, media binary, tile_x int")
    got = m.tiles(df, height=4, width=5).collect()
    assert [r.ok for r in got] == [True, False, False, True] and got[0] == got[3]
    assert np.load(io.BytesIO(got[0].tile)).tolist() == np.rint(area(x, 4, 5)).tolist()
    texts = [None, "", "a", "é" * 288, "é" * 289, "x" * 100000]
    out = {r.doc_id: r for r in m.text_media(spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, feature int")).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        p = raw + b"\xff" * max(-len(raw) % 576, 0 if raw else 576)
        assert (out[i].n_bytes, out[i].payload_bytes, out[i].payload_sha256, out[i].tail_crc32) == (len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]))
    assert out[0].feature == out[1].feature and out[0].media_sha256 == out[1].media_sha256
    assert m.text_media(df.selectExpr("doc_id", "'' as text").limit(0)).count() == 0
