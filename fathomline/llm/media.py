"""Media columns: Netpbm and BMP decoded to numpy arrays, area-resized by integral images, written as NPY tiles.

Decoding covers P5/P6 (8 and 16 bit) and P2/P3 Netpbm and uncompressed 8-bit (grey palette), 24- and 32-bit BMP.
Area resize takes exact box means from an integral image (fractional edges weighted). The feature of an image is
its difference hash: resized to 9 x 8, one bit per pair of horizontal neighbours, left < right.

The query makes a media column of texts (each a 64-column grey image, by its checksum a PGM or a BMP), decodes it, writes its
NPY tiles to the shared folder and computes all values from the tiles read back.

Edge cases: a null image or a malformed one gives one row without a tile, the latter with its reason in ``error`` (``decode``
itself raises ``ValueError``); an image of one row or one column is resized like any other; a null or empty text is 64
bytes 0; very long texts are one image each; repeated rows and equal images give equal values; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fathomline.llm.common import dicts, lean, small_batches, staged, text_or_empty

ROW = 64


def encode_pgm(gray: np.ndarray) -> bytes:
    h, w = gray.shape
    return b"P5\n%d %d\n255\n" % (w, h) + gray.tobytes()


def _header(data: bytes, n: int) -> tuple[list[int], int]:
    """The first n integers after the magic number, comments skipped, and the offset after the one separator."""
    found, i = [], 2
    while len(found) < n:
        while i < len(data) and data[i : i + 1].isspace():
            i += 1
        if data[i : i + 1] == b"#":
            i = data.index(b"\n", i) + 1
            continue
        j = i
        while j < len(data) and data[j : j + 1].isdigit():
            j += 1
        if j == i:
            raise ValueError("Netpbm header is cut short")
        found.append(int(data[i:j]))
        i = j
    return found, i + 1


def decode_netpbm(data: bytes) -> np.ndarray:
    kind = data[:2]
    if kind not in (b"P2", b"P3", b"P5", b"P6"):
        raise ValueError(f"not a supported Netpbm kind: {kind!r}")
    (w, h, top), at = _header(data, 3)
    bands = 3 if kind in (b"P3", b"P6") else 1
    dtype = np.dtype("u1") if top < 256 else np.dtype(">u2")
    if kind in (b"P2", b"P3"):
        pixels = np.array(data[at - 1 :].split(), dtype=dtype)
    else:
        if len(data) - at < w * h * bands * dtype.itemsize:
            raise ValueError("Netpbm samples are cut short")
        pixels = np.frombuffer(data, dtype, w * h * bands, at)
    return pixels.reshape((h, w) if bands == 1 else (h, w, 3))


def encode_bmp(gray: np.ndarray) -> bytes:
    h, w = gray.shape
    stride = -(-w // 4) * 4
    body = np.zeros((h, stride), np.uint8)
    body[:, :w] = gray[::-1]
    palette = b"".join(bytes((i, i, i, 0)) for i in range(256))
    at = 54 + len(palette)
    head = struct.pack("<2sIHHI", b"BM", at + body.size, 0, 0, at) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 8, 0, body.size, 2835, 2835, 256, 0)
    return head + palette + body.tobytes()


def decode_bmp(data: bytes) -> np.ndarray:
    if data[:2] != b"BM":
        raise ValueError("not a BMP")
    at, size, w, h, _, bits, packed = struct.unpack_from("<I", data, 10) + struct.unpack_from("<IiiHHI", data, 14)
    if packed or bits not in (8, 24, 32):
        raise ValueError(f"BMP with {bits} bits, compression {packed} is not supported")
    stride = -(-w * bits // 32) * 4
    rows = np.frombuffer(data, np.uint8, stride * abs(h), at).reshape(abs(h), stride)
    rows = rows[::-1] if h > 0 else rows
    if bits == 8:
        n = (at - 14 - size) // 4
        palette = np.frombuffer(data, np.uint8, n * 4, 14 + size).reshape(n, 4)
        rows = rows[:, :w]
        return palette[rows, 0] if (palette[:, 0] == palette[:, 1]).all() and (palette[:, 0] == palette[:, 2]).all() else palette[rows][..., 2::-1]
    return rows[:, : w * bits // 8].reshape(abs(h), w, bits // 8)[..., 2::-1]


def decode(data: bytes) -> np.ndarray:
    return decode_bmp(data) if data[:2] == b"BM" else decode_netpbm(data)


def to_gray(image: np.ndarray) -> np.ndarray:
    return image if image.ndim == 2 else image.astype(np.float64) @ np.array([0.299, 0.587, 0.114])


def _edges(cumulative: np.ndarray, n: int) -> np.ndarray:
    """The integral along axis 0 at n + 1 evenly spaced places, linear between samples; cumulative starts with 0."""
    at = np.arange(n + 1) * ((len(cumulative) - 1) / n)
    low = np.minimum(at.astype(np.int64), len(cumulative) - 2)
    part = (at - low)[:, None]
    return cumulative[low] * (1 - part) + cumulative[low + 1] * part


def area_resize(gray: np.ndarray, height: int, width: int) -> np.ndarray:
    """Exact box means. Column edges are interpolated first so that only ``width + 1`` columns are integrated down."""
    h, w = gray.shape
    across = np.zeros((w + 1, h))
    np.cumsum(gray.T, axis=0, out=across[1:])
    columns = _edges(across, width).T
    down = np.zeros((h + 1, width + 1))
    np.cumsum(columns, axis=0, out=down[1:])
    corner = _edges(down, height)
    return np.diff(np.diff(corner, axis=0), axis=1) * (height * width / (h * w))


def difference_hash(gray: np.ndarray) -> str:
    small = np.round(area_resize(gray, 8, 9), 6)
    return np.packbits(small[:, :-1] < small[:, 1:]).tobytes().hex()


def npy_tiles(gray: np.ndarray, edge: int = 64) -> list[tuple[int, int, bytes]]:
    """(row, column, NPY bytes) of each tile; tiles at the lower and right edges are smaller."""
    found = []
    for r in range(0, gray.shape[0], edge):
        for c in range(0, gray.shape[1], edge):
            np.save(out := io.BytesIO(), np.ascontiguousarray(gray[r : r + edge, c : c + edge]), allow_pickle=False)
            found.append((r // edge, c // edge, out.getvalue()))
    return found


def tiles(images: DataFrame, key: str, column: str, edge: int = 64) -> DataFrame:
    """Explode an image column into rows (key, tile_row, tile_col, npy, dhash, error)."""
    kinds = [images.schema[key].dataType.simpleString(), "int", "int", "binary", "string", "string"]

    def rows(k: object, data: bytes | None) -> list[tuple]:
        if data is None:
            return [(k, None, None, None, None, None)]
        try:
            gray = to_gray(decode(data))
        except (ValueError, struct.error, IndexError, OverflowError) as e:
            return [(k, None, None, None, None, str(e))]
        return [(k, r, c, npy, difference_hash(np.load(io.BytesIO(npy))), None) for r, c, npy in npy_tiles(gray, edge)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in dicts(batches):
            for k, data in zip(b[key], b[column], strict=True):
                found = zip(*rows(k, data), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(found, (None if k is not None else pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.string(), pa.string()), strict=True)], [key, "tile_row", "tile_col", "npy", "dhash", "error"])

    small_batches(images.sparkSession)
    names = (f"`{key}`", "tile_row", "tile_col", "npy", "dhash", "error")
    return images.select(key, column).mapInArrow(run, ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True)))


def text_image(text: str) -> tuple[int, bytes]:
    """The UTF-8 length of a text and its image: rows of 64 bytes, padded with 0; a PGM or, at an odd checksum, a BMP."""
    raw = text.encode("utf-8", "surrogatepass")
    payload = raw + bytes(-len(raw) % ROW if raw else ROW)
    gray = np.frombuffer(payload, np.uint8).reshape(-1, ROW)
    return len(raw), encode_bmp(gray) if zlib.crc32(payload) & 1 else encode_pgm(gray)


def text_tiles(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, tiles): the NPY tiles of each text's image from top to bottom."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in dicts(batches):
            sizes, images = zip(*map(text_image, b["text"]), strict=True)
            made = [[npy for _, _, npy in npy_tiles(decode(data), ROW * ROW)] for data in images]
            yield pa.RecordBatch.from_arrays([pa.array(b["doc_id"], pa.int64()), pa.array(sizes, pa.int64()), pa.array(made, pa.list_(pa.binary()))], ["doc_id", "n_bytes", "tiles"])

    small_batches(docs.sparkSession)
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(lean(run), "doc_id long, n_bytes long, tiles array<binary>")


def described(stored: DataFrame) -> DataFrame:
    """What ``text_tiles`` stored, read back: the payload's digests, the tiles' own and the difference hash of the whole image."""

    def one(found: list[bytes]) -> tuple:
        gray = np.concatenate([np.load(io.BytesIO(x), allow_pickle=False) for x in found])
        payload, media = gray.tobytes(), b"".join(found)
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-ROW:]), len(media), hashlib.sha256(media).hexdigest(), difference_hash(gray)

    names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in dicts(batches):
            found = zip(*map(one, b["tiles"]), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(b["doc_id"], pa.int64()), pa.array(b["n_bytes"], pa.int64()), *(pa.array(x, t) for x, t in zip(found, kinds, strict=True))], ["doc_id", "n_bytes", *names])

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return stored.mapInArrow(lean(run), schema)


def query(docs: DataFrame) -> DataFrame:
    return described(staged(text_tiles(docs), "media-tiles"))
