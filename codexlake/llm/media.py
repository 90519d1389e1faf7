"""Media columns: Netpbm and BMP bytes to arrays, NPY tiles and difference hashes.

Defined cases: null media gives null features and the error ``null``; bytes that
are no readable picture give null features and say why in ``error``; a picture
without pixels is refused the same way.  Rows are handled one by one, so repeated
rows give repeated results, and an empty table gives an empty one.  Only the id and
the media or text column are read, whatever other columns are called.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from codexlake.llm.common import bytes_of, on_workers

_TOKEN = re.compile(rb"(?:\s|#[^\n\r]*[\n\r])*([^\s#]+)")
#: Rows of the payload pictures: 24 x 24 = 576 samples to a block.
PAYLOAD_WIDTH, PAYLOAD_BLOCK = 24, 576


def decode_netpbm(data: bytes) -> np.ndarray:
    """P1 to P6 as an (h, w) or (h, w, 3) array of uint8, or uint16 for maxima above 255.

    Samples are scaled so that the file's maximum becomes 255 or 65535.
    """
    if data[:1] != b"P" or data[1:2] not in b"123456" or len(data) < 2:
        raise ValueError("no Netpbm magic")
    kind, at, head = int(data[1:2]), 2, []
    for _ in range(2 if kind in (1, 4) else 3):
        m = _TOKEN.match(data, at)
        if not m or not m[1].isdigit():
            raise ValueError("bad Netpbm header")
        head.append(int(m[1]))
        at = m.end()
    width, height, top = head[0], head[1], head[2] if len(head) > 2 else 1
    if not width or not height or not 0 < top < 65536:
        raise ValueError("bad Netpbm size")
    planes = 3 if kind in (3, 6) else 1
    n = width * height * planes
    if kind <= 3:
        body = re.sub(rb"#[^\n\r]*", b"", data[at:])
        if kind == 1:  # digits need no space between them
            values = np.frombuffer(re.sub(rb"\s+", b"", body)[:n], np.uint8) - 48
        else:
            values = np.array(body.split()[:n], dtype=np.int64)
    elif kind == 4:
        row = (width + 7) // 8
        raw = np.frombuffer(data, np.uint8, row * height, at + 1) if len(data) >= at + 1 + row * height else np.empty(0)
        if not raw.size:
            raise ValueError("Netpbm data ends early")
        values = np.unpackbits(raw.reshape(height, row), axis=1)[:, :width].ravel()
    else:
        size = 2 if top > 255 else 1
        if len(data) < at + 1 + n * size:
            raise ValueError("Netpbm data ends early")
        values = np.frombuffer(data, ">u2" if size == 2 else np.uint8, n, at + 1)
    if len(values) < n:
        raise ValueError("Netpbm data ends early")
    if kind in (1, 4):
        values = (1 - values) * 255  # a set bit is black
    elif values.max() > top or values.min() < 0:
        raise ValueError("a Netpbm sample is beyond the maximum")
    full = 255 if top <= 255 else 65535
    if kind not in (1, 4) and top != full:
        values = (values.astype(np.int64) * (2 * full) + top) // (2 * top)
    out = values.astype(np.uint16 if top > 255 else np.uint8)
    return out.reshape((height, width, 3) if planes == 3 else (height, width))


def encode_pgm(pixels: np.ndarray) -> bytes:
    """An (h, w) uint8 array as raw P5."""
    return b"P5\n%d %d\n255\n" % (pixels.shape[1], pixels.shape[0]) + pixels.tobytes()


def decode_bmp(data: bytes) -> np.ndarray:
    """Uncompressed BMP of 1, 4, 8, 16, 24 or 32 bits; grey palettes give (h, w).

    16 and 32 bits are read by the file's channel masks, where it has any.
    """
    if data[:2] != b"BM" or len(data) < 54:
        raise ValueError("no BMP header")
    (start,), (info, width, height) = struct.unpack_from("<I", data, 10), struct.unpack_from("<Iii", data, 14)
    bits, packing = struct.unpack_from("<HI", data, 28)
    if info < 40 or width <= 0 or not height or bits not in (1, 4, 8, 16, 24, 32) or packing not in ((0, 3) if bits in (16, 32) else (0,)):
        raise ValueError("unsupported BMP")
    flip, height = height > 0, abs(height)
    row = (width * bits + 31) // 32 * 4
    if len(data) < start + row * height:
        raise ValueError("BMP data ends early")
    lines = np.frombuffer(data, np.uint8, row * height, start).reshape(height, row)
    if flip:
        lines = lines[::-1]
    if packing == 3 or bits == 16:
        if packing == 3 and len(data) < 66:
            raise ValueError("BMP masks end early")
        masks = struct.unpack_from("<III", data, 54) if packing == 3 else (0x7C00, 0x03E0, 0x001F)
        whole = np.ascontiguousarray(lines[:, : width * bits // 8]).view(f"<u{bits // 8}").astype(np.int64)
        return np.stack([_channel(whole, m) for m in masks], 2)
    if bits >= 24:
        step = bits // 8
        return np.ascontiguousarray(lines[:, : width * step].reshape(height, width, step)[:, :, 2::-1])
    colours = struct.unpack_from("<I", data, 46)[0] or 1 << bits
    if len(data) < 14 + info + 4 * colours:
        raise ValueError("BMP palette ends early")
    palette = np.zeros((256, 3), np.uint8)
    palette[:colours] = np.frombuffer(data, np.uint8, 4 * min(colours, 256), 14 + info).reshape(-1, 4)[:, 2::-1]
    if bits == 8:
        index = lines[:, :width]
    else:
        spread = np.unpackbits(lines, axis=1).reshape(height, -1, bits)
        index = (spread @ (1 << np.arange(bits - 1, -1, -1)).astype(np.uint8))[:, :width]
    if (palette[:, :1] == palette).all():
        return palette[index, 0]
    return palette[index]


def _channel(whole: np.ndarray, mask: int) -> np.ndarray:
    """The samples under a mask of adjacent bits, scaled to 0 to 255."""
    low = mask & -mask
    top = mask // low if mask else 0
    if top & (top + 1):
        raise ValueError("a BMP mask has gaps")
    if not mask:
        return np.zeros(whole.shape, np.uint8)
    return (((whole & mask) // low * 510 + top) // (2 * top)).astype(np.uint8)


def encode_bmp(pixels: np.ndarray) -> bytes:
    """(h, w) as 8-bit grey palette, (h, w, 3) as 24-bit, bottom row first."""
    grey = pixels.ndim == 2
    height, width = pixels.shape[:2]
    step = 1 if grey else 3
    row = (width * step + 3) // 4 * 4
    lines = np.zeros((height, row), np.uint8)
    lines[:, : width * step] = (pixels if grey else pixels[:, :, ::-1].reshape(height, -1))[::-1]
    palette = np.repeat(np.arange(256, dtype=np.uint8)[:, None], 4, 1) if grey else np.empty((0, 4), np.uint8)
    if grey:
        palette[:, 3] = 0
    start = 54 + palette.size
    head = struct.pack("<2sIHHI", b"BM", start + lines.size, 0, 0, start)
    head += struct.pack("<IiiHHIIiiII", 40, width, height, 1, 8 * step, 0, lines.size, 2835, 2835, 256 * grey, 0)
    return head + palette.tobytes() + lines.tobytes()


def decode(data: bytes) -> np.ndarray:
    return decode_bmp(data) if data[:2] == b"BM" else decode_netpbm(data)


def luma(pixels: np.ndarray) -> np.ndarray:
    """Grey values; colour by the ITU-R 601 weights."""
    return pixels if pixels.ndim == 2 else pixels @ np.array([0.299, 0.587, 0.114])


def area_resize(pixels: np.ndarray, height: int, width: int) -> np.ndarray:
    """Exact area means of a grey picture, from its integral image.

    The integral of a picture of constant cells is linear between grid lines, so
    interpolating the integral image at the cuts is exact for any ratio, up or
    down.  It is needed on the rows beside the cuts only, so those are all that is
    kept, and a very tall picture costs no more memory than a small one.
    """
    h, w = pixels.shape
    cuts_y, cuts_x = np.arange(height + 1) * h / height, np.arange(width + 1) * w / width
    low = np.minimum(cuts_y.astype(np.int64), h - 1)
    rows = np.unique(np.concatenate([[0], low, low + 1]))
    dtype = np.int64 if pixels.dtype.kind in "ui" else np.float64
    integral = np.zeros((len(rows), w + 1), dtype)
    strips = np.add.reduceat(pixels, rows[:-1], axis=0, dtype=dtype) if rows[-1] == h else np.add.reduceat(pixels, rows, axis=0, dtype=dtype)[:-1]
    integral[1:, 1:] = strips.cumsum(0).cumsum(1)
    at = np.searchsorted(rows, low)
    part = (cuts_y - low)[:, None]
    integral = integral[at] * (1 - part) + integral[at + 1] * part
    left = np.minimum(cuts_x.astype(np.int64), w - 1)
    part = cuts_x - left
    integral = integral[:, left] * (1 - part) + integral[:, left + 1] * part
    return np.diff(np.diff(integral, axis=0), axis=1) / ((h / height) * (w / width))


def difference_hash(pixels: np.ndarray) -> int:
    """64 bits: whether each of 8 x 8 area means is above its left neighbour."""
    small = area_resize(luma(pixels), 8, 9)
    return int.from_bytes(np.packbits(np.round(small[:, 1:], 6) > np.round(small[:, :-1], 6)).tobytes(), "big")


def npy_tile(pixels: np.ndarray, height: int, width: int) -> bytes:
    """The picture resized and rounded to uint8, as the bytes of a .npy file."""
    small = area_resize(luma(pixels), height, width)
    if pixels.dtype == np.uint16:
        small = small / 257.0
    out = io.BytesIO()
    np.save(out, np.clip(np.rint(small), 0, 255).astype(np.uint8), allow_pickle=False)
    return out.getvalue()


def media_features(df: DataFrame, id_col: str, media_col: str, tile_height: int = 16, tile_width: int = 16) -> DataFrame:
    """Per row: size, NPY tile and difference hash of a binary picture column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for data in batch.column(1).to_pylist():
                try:
                    if data is None:
                        raise ValueError("null")
                    pixels = decode(data)
                    rows.append((*pixels.shape[:2], npy_tile(pixels, tile_height, tile_width), f"{difference_hash(pixels):016x}", None))
                except (ValueError, struct.error) as e:
                    rows.append((None, None, None, None, str(e)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.binary(), pa.string(), pa.string()), strict=True))],
                ["id", "height", "width", "tile", "dhash", "error"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    out = on_workers(df).select(id_col, media_col).mapInArrow(run, f"id {kind}, height int, width int, tile binary, dhash string, error string")
    return out.withColumnRenamed("id", id_col)


def text_payload(text: bytes) -> bytes:
    """The bytes, with 255 appended up to a positive multiple of the block."""
    return text + b"\xff" * (max(1, -(-len(text) // PAYLOAD_BLOCK)) * PAYLOAD_BLOCK - len(text))


def text_media(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile: int = 16) -> DataFrame:
    """Store each text losslessly as a grey PGM, read it back, and describe it.

    A null text counts as empty; a very long one is a very tall picture.  ``feature``
    joins the difference hash and the SHA-256 of the NPY tile.  The same picture is
    stored as BMP as well (``bmp_sha256``), and ``formats_agree`` says whether both
    read back alike.  Every value depends on the text alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for text in bytes_of(batch.column(1)):
                payload = text_payload(text)
                picture = np.frombuffer(payload, np.uint8).reshape(-1, PAYLOAD_WIDTH)
                media, bitmap = encode_pgm(picture), encode_bmp(picture)
                pixels = decode(media)
                back = pixels.tobytes()
                tiles = npy_tile(pixels, tile, tile)
                feature = f"{difference_hash(pixels):016x}:{hashlib.sha256(tiles).hexdigest()}"
                rows.append((len(text), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature, hashlib.sha256(bitmap).hexdigest(), np.array_equal(decode(bitmap), pixels)))
            columns = list(zip(*rows, strict=True)) or [()] * 9
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))],
                ["id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "bmp_sha256", "formats_agree"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    out = on_workers(df).select(id_col, text_col).mapInArrow(
        run, f"id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, bmp_sha256 string, formats_agree boolean"
    )
    return out.withColumnRenamed("id", id_col)
