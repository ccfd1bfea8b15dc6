"""Image bytes to levels and back: 8-bit PNG, and other formats where a codec is installed."""

from __future__ import annotations

import io
import struct
import zlib

import numpy as np

try:  # a full codec, where the cluster has one
    from PIL import Image as _pillow
except ImportError:
    _pillow = None

SIGNATURE = b"\x89PNG\r\n\x1a\n"
# Channels by PNG colour type, and the reverse.
CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}
COLOUR_TYPES = {1: 0, 3: 2, 2: 4, 4: 6}


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode_png(levels: np.ndarray) -> bytes:
    """PNG bytes of an HWC array of levels."""
    h, w, c = levels.shape
    rows = np.zeros((h, 1 + w * c), np.uint8)
    rows[:, 1:] = levels.reshape(h, w * c)
    header = struct.pack(">IIBBBBB", w, h, 8, COLOUR_TYPES[c], 0, 0, 0)
    return (
        SIGNATURE
        + _chunk(b"IHDR", header)
        + _chunk(b"IDAT", zlib.compress(rows.tobytes(), 6))
        + _chunk(b"IEND", b"")
    )


def full_codec() -> bool:
    """True where formats beyond plain PNG can be decoded here."""
    return _pillow is not None


def _unfilter(kind: int, row: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    if kind == 0:
        return row
    if kind == 1:
        return np.cumsum(row.reshape(-1, step), axis=0, dtype=np.uint8).reshape(-1)
    if kind == 2:
        return row + above
    raise ValueError("a row filter that needs a full codec")


def decode_png(data: bytes) -> np.ndarray:
    """HWC levels of a plain 8-bit PNG, as :func:`encode_png` writes it; ValueError for anything else."""
    if not data.startswith(SIGNATURE):
        raise ValueError("not a PNG")
    at, packed, head = len(SIGNATURE), [], None
    try:
        while True:
            size, kind = struct.unpack(">I4s", data[at : at + 8])
            body = data[at + 8 : at + 8 + size]
            if kind == b"IHDR":
                head = struct.unpack(">IIBBBBB", body)
            elif kind == b"IDAT":
                packed.append(body)
            elif kind == b"IEND":
                break
            at += 12 + size
        w, h, depth, colour, _, _, interlace = head
        if depth != 8 or interlace or colour not in CHANNELS:
            raise ValueError("unsupported PNG layout")
        step = CHANNELS[colour]
        rows = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(h, 1 + w * step)
    except (struct.error, zlib.error, TypeError) as e:
        raise ValueError(f"damaged PNG: {e}") from e
    out = np.zeros((h, w * step), np.uint8)
    above = np.zeros(w * step, np.uint8)
    for y in range(h):
        above = out[y] = _unfilter(int(rows[y, 0]), rows[y, 1:], above, step)
    return out.reshape(h, w, step)


def decode_bytes(data: bytes | None) -> np.ndarray | None:
    """RGB levels of image bytes, or None where they cannot be decoded."""
    if data is None:
        return None
    try:
        if _pillow is not None:
            return np.array(_pillow.open(io.BytesIO(data)).convert("RGB"))
        levels = decode_png(data)
    except (ValueError, OSError):
        return None
    if levels.shape[-1] in (2, 4):
        levels = levels[..., :-1]
    return np.repeat(levels, 3, axis=-1) if levels.shape[-1] == 1 else levels
