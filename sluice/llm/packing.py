"""Packed lists of numbers and bytes for rows that carry many values."""

from __future__ import annotations

import numpy as np
import zstandard


def squeeze(*arrays: np.ndarray | bytes) -> bytes:
    """Arrays of uint32 (in byte planes, which compress well) and bytes, in one payload."""
    parts = []
    for a in arrays:
        raw = a if isinstance(a, bytes) else np.ascontiguousarray(a.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()
        parts += [len(raw).to_bytes(8, "little"), raw]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def expand(payload: bytes) -> list[bytes]:
    """The parts of a payload; ``numbers`` turns those that were arrays back."""
    raw, parts, at = zstandard.ZstdDecompressor().decompress(payload), [], 0
    while at < len(raw):
        size = int.from_bytes(raw[at : at + 8], "little")
        parts.append(raw[at + 8 : at + 8 + size])
        at += 8 + size
    return parts


def numbers(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()
