"""Minimal PNG writer and structural check (stdlib zlib + numpy), used per image inside tasks.

Spark's ``image`` source decodes PNGs (BGR(A) byte order); writing cropped
pixels back needs an encoder, and Pillow is not available, so this is a small
helper called per image inside a UDF.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

SIGNATURE = b"\x89PNG\r\n\x1a\n"
_COLOR_TYPE = {1: 0, 2: 4, 3: 2, 4: 6}  # channels -> PNG colour type (gray, gray+a, rgb, rgba)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data) & 0xFFFFFFFF)


def encode_png(pixels: np.ndarray, level: int = 6) -> bytes:
    """HxW (gray) or HxWxC (C in 1..4, RGB(A) order) uint8 -> PNG bytes."""
    arr = np.ascontiguousarray(pixels, dtype=np.uint8)
    if arr.ndim == 2:
        arr = arr[:, :, None]
    h, w, c = arr.shape
    if h == 0 or w == 0:
        raise ValueError("empty image")
    ihdr = struct.pack(">IIBBBBB", w, h, 8, _COLOR_TYPE[c], 0, 0, 0)
    raw = np.concatenate([np.zeros((h, 1), np.uint8), arr.reshape(h, w * c)], axis=1).tobytes()
    return SIGNATURE + _chunk(b"IHDR", ihdr) + _chunk(b"IDAT", zlib.compress(raw, level)) + _chunk(b"IEND", b"")


def png_problem(data: bytes | None) -> str | None:
    """Structural check of a PNG without decoding pixels (signature, chunk
    lengths, CRCs, IHDR first, IDAT present, IEND last); None when sound."""
    if not data:
        return "zero-size file"
    if not data.startswith(SIGNATURE):
        return "not a PNG signature"
    pos, first, seen_idat = 8, True, False
    while pos + 12 <= len(data):
        (n,) = struct.unpack(">I", data[pos:pos + 4])
        kind = data[pos + 4:pos + 8]
        if pos + 12 + n > len(data):
            return "truncated chunk"
        body = data[pos + 8:pos + 8 + n]
        (crc,) = struct.unpack(">I", data[pos + 8 + n:pos + 12 + n])
        if zlib.crc32(kind + body) & 0xFFFFFFFF != crc:
            return f"bad CRC in {kind.decode('latin-1')}"
        if first and kind != b"IHDR":
            return "IHDR is not the first chunk"
        first = False
        seen_idat |= kind == b"IDAT"
        if kind == b"IEND":
            return None if seen_idat else "no image data"
        pos += 12 + n
    return "missing IEND"
