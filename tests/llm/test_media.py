import hashlib
import io
import struct
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from codexlake.llm import media, queries
from tests.llm.helpers import ODD, none, odd


def slow_resize(pixels, height, width):
    """Area means with exact fractions."""
    h, w = pixels.shape
    out = np.zeros((height, width))
    share = lambda n, m, i, k: max(Fraction(0), min(Fraction((i + 1) * n, m), Fraction(k + 1)) - max(Fraction(i * n, m), Fraction(k)))
    for i in range(height):
        for j in range(width):
            total = sum(share(h, height, i, y) * share(w, width, j, x) * int(pixels[y, x]) for y in range(h) for x in range(w))
            out[i, j] = float(total / (Fraction(h, height) * Fraction(w, width)))
    return out


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(1, 9), st.integers(1, 10), st.integers(1, 10), st.integers(0, 10**6))
def test_area_resize(h, w, height, width, seed):
    pixels = np.random.default_rng(seed).integers(0, 256, (h, w)).astype(np.uint8)
    assert np.allclose(media.area_resize(pixels, height, width), slow_resize(pixels, height, width))


def test_netpbm_of_all_kinds():
    want = np.array([[0, 255], [255, 0]], np.uint8)
    assert (media.decode(b"P1\n# note\n2 2\n10\n0 1") == want).all()
    assert (media.decode(b"P4 2 2\n" + bytes([0b10000000, 0b01000000])) == want).all()
    assert (media.decode(b"P2 2 2 #x\n255\n0 255\n255 0") == want).all()
    assert (media.decode(b"P5\n2 2\n255\n" + want.tobytes()) == want).all()
    assert media.decode(b"P3 1 1 255 1 2 3").tolist() == [[[1, 2, 3]]]
    assert media.decode(b"P6 1 2 255\n" + bytes(range(6))).tolist() == [[[0, 1, 2]], [[3, 4, 5]]]
    assert media.decode(b"P5 1 1 65535\n\x01\x02").tolist() == [[258]]


def test_netpbm_maxima():
    assert media.decode(b"P2 3 1 15 0 7 15").tolist() == [[0, 119, 255]]
    assert media.decode(b"P5 2 1 1023\n\x03\xff\x00\x00").tolist() == [[65535, 0]]
    assert media.decode(b"P3 1 1 1 1 0 1").tolist() == [[[255, 0, 255]]]
    tile = np.load(io.BytesIO(media.npy_tile(media.decode(b"P5 1 1 1023\n\x03\xff"), 1, 1)))
    assert tile.tolist() == [[255]]
    with pytest.raises(ValueError):
        media.decode(b"P2 1 1 15 16")


def bitfields(bits, masks, values, packing=3):
    body = np.array(values, f"<u{bits // 8}").tobytes()
    body += b"\0" * (-len(body) % 4)
    head = struct.pack("<IiiHHIIiiII", 40, len(values), 1, 1, bits, packing, len(body), 0, 0, 0, 0)
    extra = struct.pack("<III", *masks) if packing == 3 else b""
    return struct.pack("<2sIHHI", b"BM", 54 + len(extra) + len(body), 0, 0, 54 + len(extra)) + head + extra + body


def test_bmp_masks():
    assert media.decode(bitfields(32, (0xFF, 0xFF00, 0xFF0000), [0x0000FF, 0x00FF00])).tolist() == [[[255, 0, 0], [0, 255, 0]]]
    assert media.decode(bitfields(32, (0x3FF00000, 0xFFC00, 0x3FF), [0x3FF00000])).tolist() == [[[255, 0, 0]]]
    assert media.decode(bitfields(16, (0xF800, 0x07E0, 0x001F), [0xF800, 0x07E0, 0x001F])).tolist() == [[[255, 0, 0], [0, 255, 0], [0, 0, 255]]]
    assert media.decode(bitfields(16, (), [0x7C00, 0x03E0], 0)).tolist() == [[[255, 0, 0], [0, 255, 0]]]
    with pytest.raises(ValueError):
        media.decode(bitfields(32, (0xF0F, 0xF0, 0), [1]))


@pytest.mark.parametrize("shape", [(3, 5), (2, 3, 3), (4, 4), (1, 7, 3)])
def test_bmp_round_trip(shape):
    pixels = np.random.default_rng(0).integers(0, 256, shape).astype(np.uint8)
    assert (media.decode(media.encode_bmp(pixels)) == pixels).all()


@pytest.mark.parametrize("data", [b"", b"P", b"P7 1 1 255\n1", b"P5 2 2 255\n1", b"P5 0 2 255\n", b"BM", b"BM" + b"\0" * 60, b"P2 2 2 255 1 2", b"text", b"P5 x"])
def test_what_is_no_picture(data):
    with pytest.raises(ValueError):
        media.decode(data)


def test_difference_hash():
    ramp = np.tile(np.arange(90, dtype=np.uint8), (16, 1))
    assert media.difference_hash(ramp) == (1 << 64) - 1 and media.difference_hash(ramp[:, ::-1]) == 0
    assert media.difference_hash(np.zeros((1, 1), np.uint8)) == 0


def test_tiles_are_npy():
    tile = np.load(io.BytesIO(media.npy_tile(np.full((40, 50, 3), 7, np.uint8), 4, 6)))
    assert tile.shape == (4, 6) and tile.dtype == np.uint8 and (tile == 7).all()


def test_frame_of_pictures(spark):
    good = media.encode_pgm(np.arange(12, dtype=np.uint8).reshape(3, 4))
    rows = [(1, good), (2, None), (3, b"junk"), (4, media.encode_bmp(np.zeros((2, 2, 3), np.uint8))), (1, good)]
    out = media.media_features(spark.createDataFrame(rows, "id long, media binary"), "id", "media").collect()
    by = {r["id"]: r for r in out}
    assert len(out) == 5 and (by[1]["height"], by[1]["width"], by[1]["error"]) == (3, 4, None)
    assert by[2]["error"] == "null" and by[3]["tile"] is None and by[3]["error"] and by[4]["dhash"] == "0" * 16
    assert media.media_features(spark.createDataFrame([], "id long, media binary"), "id", "media").count() == 0


def check(rows, texts):
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        n = max(1, -(-len(raw) // 576)) * 576
        payload = raw + b"\xff" * (n - len(raw))
        assert (r["n_bytes"], r["payload_bytes"]) == (len(raw), n)
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest() and r["tail_crc32"] == zlib.crc32(payload[-32:])
        stored = b"P5\n24 %d\n255\n" % (n // 24) + payload
        bitmap = media.encode_bmp(np.frombuffer(payload, np.uint8).reshape(-1, 24))
        assert r["formats_agree"] and r["bmp_sha256"] == hashlib.sha256(bitmap).hexdigest()
        assert r["media_bytes"] == len(stored) and r["media_sha256"] == hashlib.sha256(stored).hexdigest()


def test_query_and_odd_rows(spark, tiny):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    rows = queries.op9_media_tiles(spark, tiny).collect()
    check(rows, texts)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(texts[r["doc_id"]], r["feature"]) == r["feature"]
    out = media.text_media(odd(spark)).collect()
    check(out, dict(ODD))
    assert len(out) == len(ODD) and media.text_media(none(spark)).count() == 0
