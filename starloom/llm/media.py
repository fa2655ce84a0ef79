"""Media columns: Netpbm and BMP images as numpy arrays, thumbnails by integral images, NPY tiles, difference hashes.

Defined cases: a null payload is empty; an empty payload is stored as one padded block; a payload of any length is
stored whole, and resized in strips of rows.  `decode_image` raises ValueError for bytes that are no image of these
kinds; `image_columns` then gives nulls and the fault as text.  Samples on another scale than 255 are brought to it.
Equal payloads give equal values; repeated rows, ties and extra columns don't matter; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import io
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import map_rows

BLOCK = 64
#: Rows that are resized at once.
STRIP = 1024
BYTE_MASKS = [0xFF << (8 * k) for k in range(4)]


def decode_netpbm(raw: bytes) -> np.ndarray:
    """P1 to P6 as (height, width) or (height, width, 3); bitmaps are 0 for black and 255 for white."""
    kind = int(raw[1:2]) if raw[:1] == b"P" and raw[1:2] in b"123456" and len(raw) > 1 else 0
    if not kind:
        raise ValueError("no Netpbm header")
    fields, at = [], 2
    while len(fields) < (2 if kind in (1, 4) else 3):
        m = re.compile(rb"(?:\s|#[^\n]*\n)*(\d+)").match(raw, at)
        if m is None:
            raise ValueError("incomplete Netpbm header")
        fields.append(int(m.group(1)))
        at = m.end()
    width, height = fields[:2]
    shape = (height, width, 3) if kind in (3, 6) else (height, width)
    n = math.prod(shape)
    if kind == 1:
        values = np.array([c - 48 for c in re.sub(rb"[^01]", b"", raw[at:])][:n], np.uint8)
    elif kind == 4:
        rows = np.frombuffer(raw, np.uint8, offset=at + 1)[: height * -(-width // 8)]
        values = np.unpackbits(rows.reshape(height, -1), axis=1)[:, :width].reshape(-1)
    elif kind in (2, 3):
        values = np.array(raw[at:].split()[:n], np.uint16)
    else:
        values = np.frombuffer(raw, np.uint8 if fields[2] < 256 else ">u2", count=n, offset=at + 1)
    if values.size != n:
        raise ValueError("Netpbm samples are missing")
    if kind in (1, 4):
        values = (1 - values) * np.uint8(255)
    elif fields[2] != 255:
        if not fields[2]:
            raise ValueError("Netpbm samples have no scale")
        values = (np.minimum(values.astype(np.int64), fields[2]) * 255 + fields[2] // 2) // fields[2]
    return values.astype(np.uint8).reshape(shape)


def decode_bmp(raw: bytes) -> np.ndarray:
    """Uncompressed BMP of 8, 24 or 32 bits as (height, width, 3); bit fields must be whole bytes."""
    if raw[:2] != b"BM":
        raise ValueError("no BMP header")
    word = lambda at, n=4, signed=False: int.from_bytes(raw[at : at + n], "little", signed=signed)
    offset, head, width, height, bits = word(10), word(14), word(18, 4, True), word(22, 4, True), word(28, 2)
    if bits not in (8, 24, 32) or word(30) not in (0, 3) or width <= 0 or height == 0:
        raise ValueError("this kind of BMP is not read")
    stride = (width * bits // 8 + 3) // 4 * 4
    rows = np.frombuffer(raw, np.uint8, count=stride * abs(height), offset=offset).reshape(abs(height), stride)
    rows = rows[::-1] if height > 0 else rows
    if bits == 8:
        colours = np.frombuffer(raw, np.uint8, count=4 * (word(46) or 256), offset=14 + head).reshape(-1, 4)
        return colours[rows[:, :width], 2::-1]
    order = [2, 1, 0]
    if word(30) == 3:
        masks = [word(at) for at in (54, 58, 62)]
        if bits != 32 or any(m not in BYTE_MASKS for m in masks):
            raise ValueError("these bit fields are not read")
        order = [BYTE_MASKS.index(m) for m in masks]
    return rows[:, : width * bits // 8].reshape(abs(height), width, bits // 8)[:, :, order]


def decode_image(raw: bytes) -> np.ndarray:
    return decode_bmp(raw) if raw[:2] == b"BM" else decode_netpbm(raw)


def encode_pgm(samples: np.ndarray) -> bytes:
    return b"P5\n%d %d\n255\n" % (samples.shape[1], samples.shape[0]) + samples.tobytes()


def between(total: np.ndarray, axis: int, n: int) -> np.ndarray:
    """Cumulated sums at n + 1 even places of an axis, linear between its grid points, as differences."""
    edge = np.linspace(0, total.shape[axis] - 1, n + 1)
    low = np.minimum(edge.astype(np.int64), total.shape[axis] - 2)
    part = (edge - low).reshape((-1, 1) if axis == 0 else (1, -1))
    return np.diff(np.take(total, low, axis) * (1 - part) + np.take(total, low + 1, axis) * part, axis=axis)


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean of the exact source area of each target pixel, from the integral image, of which a strip of rows is held at a time."""
    rows, columns = image.shape[:2]
    down = np.zeros((rows + 1, width))
    for at in range(0, rows, STRIP):
        grey = image[at : at + STRIP].astype(np.float64)
        grey = grey if grey.ndim == 2 else grey.mean(axis=2)
        total = np.zeros((len(grey), columns + 1))
        np.cumsum(grey, axis=1, out=total[:, 1:])
        down[at + 1 : at + 1 + len(grey)] = between(total, 1, width)
    np.cumsum(down, axis=0, out=down)
    return between(down, 0, height) * (height * width / (rows * columns))


def difference_hash(image: np.ndarray) -> str:
    """64 bits: is each of 8x8 pixels brighter than its right neighbour in a 9x8 thumbnail?"""
    small = np.rint(area_resize(image, 8, 9) * 256)
    return np.packbits(small[:, :-1] > small[:, 1:]).tobytes().hex()


def npy_tile(image: np.ndarray, size: int = 32) -> bytes:
    out = io.BytesIO()
    np.save(out, np.clip(np.rint(area_resize(image, size, size)), 0, 255).astype(np.uint8), allow_pickle=False)
    return out.getvalue()


def image_columns(df: DataFrame, key: str, image: str, tile: int = 32) -> DataFrame:
    """(id, height, width, dhash, tile, error) of a binary column of Netpbm or BMP images; all null for a null image."""

    def make():
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.string())

        def one(raw: bytes | None) -> tuple:
            if raw is None:
                return (None,) * 5
            try:
                x = decode_image(raw)
                if 0 in x.shape:
                    raise ValueError("the image has no pixels")
            except (ValueError, IndexError, OverflowError) as e:
                return (*((None,) * 4), str(e) or type(e).__name__)
            return (*x.shape[:2], difference_hash(x), npy_tile(x, tile), None)

        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            cols = zip(*map(one, b.column(1).to_pylist()))
            return pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], names=["id", "height", "width", "dhash", "tile", "error"])

        return run

    return map_rows(df.select(F.col(key).cast("long").alias("id"), F.col(image).cast("binary")), make, "id long, height int, width int, dhash string, tile binary, error string")


def store_payload(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): the UTF-8 bytes, padded to blocks, as the samples of a 64 wide PGM image."""

    def make():
        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            size, media = [], []
            for t in b.column(1).to_pylist():
                raw = (t or "").encode("utf-8")
                padded = raw + bytes(max(BLOCK, -(-len(raw) // BLOCK) * BLOCK) - len(raw))
                size.append(len(raw))
                media.append(encode_pgm(np.frombuffer(padded, np.uint8).reshape(-1, BLOCK)))
            return pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

        return run

    return map_rows(df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), make, "doc_id long, n_bytes long, media binary")


def read_back(stored: DataFrame) -> DataFrame:
    """Decode the stored images and compute digests and features of what they hold."""
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"

    def make():
        names = [x.split()[0] for x in schema.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for raw in b.column(2).to_pylist():
                image = decode_image(raw)
                payload = image.tobytes()
                feature = difference_hash(image) + "-" + format(zlib.crc32(npy_tile(image)), "08x")
                sha = hashlib.sha256(payload).hexdigest()
                rows.append((len(payload), sha, zlib.crc32(payload[-BLOCK:]), len(raw), hashlib.sha256(raw).hexdigest(), feature))
            return pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))], names=names)

        return run

    return map_rows(stored, make, schema)
