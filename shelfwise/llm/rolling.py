"""Hashes of all stretches of a byte string at once, and arrays packed for a shuffle."""

from __future__ import annotations

import marshal
import math

import numpy as np
import zstandard

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    known = _POWERS.get(base)
    if known is None or len(known[0]) < size:
        size = max(size, 1 << 20)
        inverse = pow(base, -1, 1 << 64)
        up, down = (np.cumprod(np.append(np.uint64(1), np.full(size, x, np.uint64))) for x in (base, inverse))
        known = _POWERS[base] = (up, down)
    return known


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values, so that their high bits and their order look random."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(29))


class Rolling:
    """Sums over the bytes that give the hash of any stretch by two look-ups."""

    def __init__(self, data: np.ndarray, which: int = 0):
        up, self.down = _powers(_BASES[which], len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def grams(self, size: int) -> np.ndarray:
        n = max(0, len(self.sums) - size)
        return mix((self.sums[size : size + n] - self.sums[:n]) * self.down[:n])


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """The smallest of each ``size`` consecutive values."""
    if len(values) < size:
        return values[:0]
    done = 1
    while done * 2 <= size:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = size - done
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def aranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, ``counts`` of them, joined."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


_PACKER, _UNPACKER = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack(*arrays: np.ndarray | bytes) -> bytes:
    """Arrays in one blob: kinds and shapes first, then each array's first bytes, second bytes and so on, as they pack well."""
    kinds, parts = [], []
    for a in arrays:
        if isinstance(a, bytes):
            kinds.append(("", len(a)))
            parts.append(a)
        else:
            kinds.append((a.dtype.str, a.shape))
            parts.append(np.frombuffer(a.tobytes(), np.uint8).reshape(-1, a.itemsize).T.tobytes())
    head = marshal.dumps(kinds)
    return _PACKER.compress(b"".join([len(head).to_bytes(4, "little"), head, *parts]))


def unpack(blob: bytes) -> tuple:
    data = _UNPACKER.decompress(blob)
    at = 4 + int.from_bytes(data[:4], "little")
    out: list[np.ndarray | bytes] = []
    for kind, shape in marshal.loads(data[4:at]):
        if not kind:
            out.append(data[at : at + shape])
            at += shape
            continue
        size, n = int(kind[2:]), math.prod(shape)
        planes = np.frombuffer(data, np.uint8, n * size, at).reshape(size, n)
        out.append(np.frombuffer(planes.T.tobytes(), kind).reshape(shape))
        at += n * size
    return tuple(out)
