"""Maximal periodic runs of words, found on harmonic grids with longest common extensions.

A run of period q that is at least 2q long holds two neighbouring points of the grid 0, q, 2q, ... whose words are
equal. All such pairs (n/1 + n/2 + ... of them) are compared; from each equal pair the run is as long as the
common extensions to both sides. An extension compares words until both sides reach a position of a difference
cover, which happens within ``COVER`` words; only suffixes at such positions are sorted, and the least common
prefix between their ranks answers the rest.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.rolling import aranges
from shelfwise.llm.words import Chunk, chunks, span_codes, word_spans

LEAST = 12  # words of a run
COVER = 13
_IN_COVER = (0, 1, 3, 9)  # every difference modulo COVER is one between two of these
PAIRS = 1 << 21  # grid pairs compared at a time


def _steps() -> np.ndarray:
    """[a, b]: the fewest steps after which positions with residues a and b both lie in the cover."""
    member = np.isin(np.arange(2 * COVER) % COVER, _IN_COVER)
    return np.array([[next(s for s in range(COVER) if member[a + s] and member[b + s]) for b in range(COVER)] for a in range(COVER)])


STEPS = _steps()


class Extensions:
    """Longest common extensions to the right between positions of an integer array.

    Equal stretches must end before the array does: the caller puts values that occur once between its texts
    and at the end.
    """

    def __init__(self, values: np.ndarray):
        n = len(values)
        top = int(values.max(initial=0)) + 1
        # Beyond the end every value is new.
        self.values = np.append(values.astype(np.int64), top + np.arange(2 * COVER))
        places = np.flatnonzero(np.isin(np.arange(n) % COVER, _IN_COVER))
        self.slot = np.full(n + 1, len(places), np.int64)
        self.slot[places] = np.arange(len(places))
        self._sort(places, n)

    def _sort(self, places: np.ndarray, n: int) -> None:
        """Rank the suffixes at ``places``: first by their words up to ``COVER``, then doubling among the tied ones."""
        size = len(places)
        rank = np.zeros(size, np.int64)
        for t in range(COVER):
            key = rank * (int(self.values.max()) + 1) + self.values[places + t]
            rank = np.unique(key, return_inverse=True)[1]
            if size and rank.max() == size - 1:
                break
        # A rank is the number of smaller suffixes; levels[k] tells suffixes apart by COVER * 2 ** k words.
        rank = np.searchsorted(np.sort(rank), rank)
        levels, reach = [], COVER
        while True:
            levels.append(np.append(rank, -1))
            shared = np.bincount(rank, minlength=size)[rank] > 1
            tied = np.flatnonzero(shared)
            if not len(tied):
                break
            # ``reach`` is a multiple of COVER, so the later position lies in the cover, too.
            later = places[tied] + reach
            second = levels[-1][self.slot[np.minimum(later, n)]]
            order = np.lexsort((second, rank[tied]))
            first_key, second_key = rank[tied][order], second[order]
            new_group = np.append(True, first_key[1:] != first_key[:-1])
            new_part = new_group | np.append(True, second_key[1:] != second_key[:-1])
            index = np.arange(len(order))
            group_at = np.maximum.accumulate(np.where(new_group, index, 0))
            part_at = np.maximum.accumulate(np.where(new_part, index, 0))
            rank = rank.copy()
            rank[tied[order]] = first_key + part_at - group_at
            reach *= 2
        self.rank = rank
        ordered = np.empty(size, np.int64)
        ordered[rank] = places
        self._table(self._neighbours(ordered, levels, n))

    def _neighbours(self, ordered: np.ndarray, levels: list[np.ndarray], n: int) -> np.ndarray:
        """The common prefix of each sorted suffix with the one before it, by descending through the levels."""
        a, b = ordered[:-1].copy(), ordered[1:].copy()
        start = a.copy()
        for k in reversed(range(len(levels))):
            level = levels[k]
            same = (level[self.slot[np.minimum(a, n)]] == level[self.slot[np.minimum(b, n)]]) & (np.maximum(a, b) < n)
            step = np.where(same, COVER << k, 0)
            a += step
            b += step
        a, b = np.minimum(a, n), np.minimum(b, n)
        equal = np.ones(len(a), bool)
        for _ in range(COVER):
            equal &= self.values[a] == self.values[b]
            a = a + equal
            b = b + equal
        return a - start

    def _table(self, prefix: np.ndarray) -> None:
        """Least prefixes over stretches of every power of two."""
        self.least = [prefix.astype(np.int32)]
        while 2 << (len(self.least) - 1) <= len(prefix):
            last, half = self.least[-1], 1 << (len(self.least) - 1)
            self.least.append(np.minimum(last[:-half], last[half:]))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from positions ``a`` on equal those from ``b`` on; a and b differ."""
        to_cover = STEPS[a % COVER, b % COVER]
        length = np.zeros(len(a), np.int64)
        equal = np.arange(len(a))
        for t in range(COVER):
            equal = equal[(to_cover[equal] > t) & (self.values[a[equal] + t] == self.values[b[equal] + t])]
            length[equal] += 1
        rest = np.flatnonzero(length == to_cover)
        x, y = (self.rank[self.slot[p[rest] + to_cover[rest]]] for p in (a, b))
        low, high = np.minimum(x, y), np.maximum(x, y)  # prefixes low .. high - 1
        level = np.frexp((high - low).astype(float))[1] - 1
        for k in np.unique(level):
            here = level == k
            table = self.least[k]
            length[rest[here]] += np.minimum(table[low[here]], table[high[here] - (1 << k)])
        return length


def _grid(sizes: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text number, position, period) of all neighbouring grid points, about ``PAIRS`` at a time."""
    # One row for each text and period.
    text = np.repeat(np.arange(len(sizes)), sizes // 2)
    period = aranges(np.ones(len(sizes), np.int64), sizes // 2)
    points = (sizes[text] - 1) // period
    total = np.cumsum(points)
    first = 0
    while first < len(text):
        done = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, done + PAIRS, "right")))
        part = slice(first, last)
        q = np.repeat(period[part], points[part])
        t = np.repeat(text[part], points[part])
        k = aranges(np.zeros(last - first, np.int64), points[part])
        yield t, starts[t] + k * q, q
        first = last


def _few(values: np.ndarray, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """How many of the next ``COVER`` words in this direction are equal."""
    length = np.zeros(len(a), np.int64)
    equal = np.arange(len(a))
    for t in range(COVER):
        equal = equal[values[a[equal] + step * t] == values[b[equal] + step * t]]
        length[equal] += 1
    return length


def find_runs(texts: list[np.ndarray]) -> np.ndarray:
    """Rows (text number, start, length, period), sorted: the runs of each array of word codes.

    Runs have at least ``LEAST`` words and two periods; their period is the smallest.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    # A value that occurs once precedes each text, and some follow the last.
    top = max((int(t.max(initial=0)) for t in texts), default=0) + 1
    starts = np.cumsum(sizes + 1) - sizes
    values = np.full(int((sizes + 1).sum()) + 1, -1, np.int64)
    values[aranges(starts, sizes)] = np.concatenate([np.zeros(0, np.int64), *texts])
    marks = np.flatnonzero(values < 0)
    values[marks] = top + np.arange(len(marks))
    padded = np.concatenate([top + len(marks) + np.arange(COVER), values, top + len(marks) + COVER + np.arange(COVER)])

    found = []
    for text, at, period in _grid(sizes, starts):
        equal = np.flatnonzero(values[at] == values[at + period])
        text, at, period = text[equal], at[equal], period[equal]
        ahead = _few(padded, at + COVER, at + COVER + period, 1)
        behind = _few(padded, at + COVER - 1, at + COVER - 1 + period, -1)
        # Both ends known: the run is. One end open: it may be long enough.
        is_open = (ahead == COVER) | (behind == COVER)
        keep = is_open | (ahead + behind >= np.maximum(period, LEAST - period))
        found.append(np.stack([text, at, period, ahead, behind, is_open])[:, keep])
    text, at, period, ahead, behind, is_open = np.concatenate([np.zeros((6, 0), np.int64), *found], 1)

    rest = np.flatnonzero(is_open)
    if len(rest):
        # Extensions are prepared for the texts that need them only.
        needed = np.unique(text[rest])
        parts = aranges(starts[needed] - 1, sizes[needed] + 1)
        some = np.append(values[parts], -1)
        some[-1] = values.max() + 1
        shift = np.zeros(len(sizes), np.int64)
        shift[needed] = np.cumsum(sizes[needed] + 1) - sizes[needed] - starts[needed]
        a = at[rest] + shift[text[rest]]
        b = a + period[rest]
        ahead[rest] = Extensions(some).common(a, b)
        end = len(some) - 1
        behind[rest] = Extensions(some[::-1]).common(end - (a - 1), end - (b - 1))
    length = period + ahead + behind
    good = length >= np.maximum(LEAST, 2 * period)
    rows = np.stack([text, at - starts[text] - behind, length, period], 1)[good]
    # Multiples of a period find the same stretch: the smallest names it. Then by start and period.
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    again = (rows[1:, :3] == rows[:-1, :3]).all(1)
    rows = rows[np.append(True, ~again)[: len(rows)]]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def after_first_period(size: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``size`` words lie in a run, but not in its first period."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, runs[:, 1] + runs[:, 3], 1)
    np.add.at(change, runs[:, 1] + runs[:, 2], -1)
    return np.cumsum(change)[:-1] > 0


def planted_order(doc_id: int | None, size: int) -> np.ndarray | None:
    """Which word stands where after a document's tail has been made periodic; None: as it was.

    Decided by crc32 of the id as text, for one id in ten. A null id changes nothing.
    """
    if doc_id is None or not size:
        return None
    tens, last = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if last:
        return None
    a = tens % size
    period = 1 + (size - a) // (3 + tens % 8)
    order = np.arange(size)
    order[a:] = a + (order[a:] - a) % period
    return order


SCHEMA = (
    "doc_id long, n_words long, n_runs long, n_dropped long, start long, length long, period long,"
    " exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)


def detect_runs(docs: DataFrame, planted: bool = False) -> DataFrame:
    """One row per document: its words, runs, dropped words, longest run and digests of the runs and the kept words.

    Words are runs of characters other than space and U+0009 to U+000D, numbered from 0; a run of words has a
    smallest period q and at least max(``LEAST``, 2q) words, and no neighbouring word continues it. Of runs with
    equal length the first, then the one of smallest period is named; without a run these four are null. A word
    is dropped if some run holds it after that run's first q words; the others, joined by one space, are digested.
    ``planted`` makes tails periodic first, as :func:`planted_order` says.

    A null or empty text has no words and the digests of nothing. Repeated rows and ids are rows like others; other
    columns are not read. Every text is taken whole by the task that reads it; nothing is shuffled.
    """

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                ids = batch.column("doc_id").slice(chunk.first, len(chunk)).to_pylist()
                yield _rows(ids, chunk, planted)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(detect, SCHEMA)


def _rows(ids: list[int | None], chunk: Chunk, planted: bool) -> pa.RecordBatch:
    starts, ends, owner = word_spans(chunk)
    code = span_codes(chunk.data, starts, ends)
    cuts = np.searchsorted(owner, np.arange(len(chunk) + 1))
    orders = [planted_order(i, int(n)) if planted else None for i, n in zip(ids, np.diff(cuts), strict=True)]
    texts = []
    for row, order in enumerate(orders):
        words = code[cuts[row] : cuts[row + 1]]
        texts.append(words if order is None else words[order])
    runs = find_runs(texts)
    places = np.searchsorted(runs[:, 0], np.arange(len(chunk) + 1))
    out = []
    for row, doc_id in enumerate(ids):
        own = runs[places[row] : places[row + 1]]
        words = chunk.text(row).split()  # of bytes: at space and 09 to 0D
        if orders[row] is not None:
            words = [words[i] for i in orders[row].tolist()]
        n, n_dropped, best = len(words), 0, (None,) * 4
        if len(own):
            dropped = after_first_period(n, own)
            n_dropped = int(dropped.sum())
            words = compress(words, (~dropped).tolist())
            _, start, length, period = (int(x) for x in own[np.lexsort((own[:, 3], own[:, 1], -own[:, 2]))[0]])
            best = start, length, period, 1000 * length // period
        listing = "".join(f"{s},{m},{q}\n" for _, s, m, q in own.tolist())
        digests = hashlib.sha256(listing.encode()).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest()
        out.append((doc_id, n, len(own), n_dropped, *best, *digests))
    kinds = [pa.string() if "string" in c else pa.int64() for c in SCHEMA.split(",")]
    columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
    return pa.record_batch(columns, names=[c.split()[0] for c in SCHEMA.split(",")])
