"""Words and lines of many texts at once, as spans of one byte array."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 21  # bytes of text looked at together; a longer text is a chunk of its own
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True


@dataclass
class Chunk:
    """Some rows of a batch: ``first`` row, their bytes joined, and where each text begins and ends."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def text(self, row: int) -> bytes:
        return self.data[self.bounds[row] : self.bounds[row + 1]].tobytes()

    def per_text(self, mask: np.ndarray) -> np.ndarray:
        """How many bytes of each text are marked."""
        total = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=total[1:])
        return total[self.bounds[1:]] - total[self.bounds[:-1]]


def chunks(texts: pa.Array, size: int = CHUNK) -> Iterator[Chunk]:
    """The texts of an Arrow column in order, about ``size`` bytes at a time; a null is an empty text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    if not len(texts):
        return
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    every = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + size, "right")) - 1)
        yield Chunk(first, every[at[first] : at[last]], at[first : last + 1] - at[first])
        first = last


def word_spans(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text number) of the runs of bytes that are no white space."""
    inside = ~BLANK[chunk.data]
    edge = np.zeros(len(inside) + 1, bool)
    edge[chunk.bounds] = True  # texts adjoin
    before = np.append(False, inside[:-1])[: len(inside)]
    after = np.append(inside[1:], False)[: len(inside)]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(chunk.bounds, starts, "right") - 1


def line_spans(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text number) of the lines between line feeds; every text has one at least."""
    breaks = np.flatnonzero(chunk.data == 0x0A)
    of_break = np.searchsorted(chunk.bounds, breaks, "right") - 1
    owner = np.concatenate([np.arange(len(chunk)), of_break])
    starts = np.concatenate([chunk.bounds[:-1], breaks + 1])
    order = np.lexsort((starts, owner))
    starts, owner = starts[order], owner[order]
    last = np.append(owner[1:] != owner[:-1], True)[: len(owner)]
    ends = np.append(starts[1:] - 1, 0)[: len(owner)]
    ends[last] = chunk.bounds[1:]
    return starts, ends, owner


def span_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each span, equal exactly where the bytes are equal; spans follow each other."""
    if not len(starts):
        return np.zeros(0, np.int64)
    offsets = np.empty(2 * len(starts), np.int64)
    offsets[::2], offsets[1::2] = starts, ends
    # Spans and the gaps between them take turns, so that the bytes need no copy.
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    parts = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, buffers)
    return parts.dictionary_encode().indices.to_numpy()[::2].astype(np.int64)


def pair_codes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A number for each pair of small numbers, equal exactly where the pairs are equal."""
    if not len(a):
        return np.zeros(0, np.int64)
    return pd.factorize(a.astype(np.int64) * (int(b.max()) + 1) + b)[0].astype(np.int64)
