"""PNG decoder for the image tests (8-bit, non-interlaced)."""

import struct
import zlib

import numpy as np

from furiframe.functions.png import SIGNATURE

_CHANNELS = {0: 1, 4: 2, 2: 3, 6: 4}  # PNG colour type -> channels


def _paeth(a: int, b: int, c: int) -> int:
    p = a + b - c
    pa, pb, pc = abs(p - a), abs(p - b), abs(p - c)
    if pa <= pb and pa <= pc:
        return a
    return b if pb <= pc else c


def decode_png(data: bytes) -> np.ndarray:
    """PNG bytes (8-bit, non-interlaced) -> HxWxC uint8 in RGB(A) order."""
    if not data.startswith(SIGNATURE):
        raise ValueError("not a PNG")
    pos, idat, meta = 8, b"", None
    while pos < len(data):
        (n,) = struct.unpack(">I", data[pos:pos + 4])
        kind, body = data[pos + 4:pos + 8], data[pos + 8:pos + 8 + n]
        (crc,) = struct.unpack(">I", data[pos + 8 + n:pos + 12 + n])
        if zlib.crc32(kind + body) & 0xFFFFFFFF != crc:
            raise ValueError("bad CRC")
        if kind == b"IHDR":
            meta = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            idat += body
        elif kind == b"IEND":
            break
        pos += 12 + n
    w, h, depth, ctype, _, _, interlace = meta
    if depth != 8 or interlace:
        raise ValueError("unsupported PNG")
    c = _CHANNELS[ctype]
    raw = np.frombuffer(zlib.decompress(idat), np.uint8).reshape(h, 1 + w * c)
    out = np.zeros((h, w * c), np.int32)
    for y in range(h):
        f, line = raw[y, 0], raw[y, 1:].astype(np.int32)
        prev = out[y - 1] if y else np.zeros(w * c, np.int32)
        if f == 0:
            out[y] = line
        elif f == 2:
            out[y] = (line + prev) & 0xFF
        else:
            cur = np.zeros(w * c, np.int32)
            for x in range(w * c):
                a = cur[x - c] if x >= c else 0
                b, cc = prev[x], (prev[x - c] if x >= c else 0)
                pred = a if f == 1 else (a + b) // 2 if f == 3 else _paeth(a, b, cc)
                cur[x] = (line[x] + pred) & 0xFF
            out[y] = cur
    return out.astype(np.uint8).reshape(h, w, c)
