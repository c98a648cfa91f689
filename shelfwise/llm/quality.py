"""Quality rules: counted rules first, then boosted trees over statistics of the document.

The trees are grown on histograms of a bounded sample of labelled documents. A statistic that only ever speaks
against a document (repeats, symbols) is bound to a monotonic effect. For scoring, all trees are flattened into
node arrays, through which all documents of a batch descend together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.words import Chunk, chunks, line_spans, pair_codes, span_codes, word_spans

WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATS = 20  # per cent of the words
SYMBOLS = b"#*$%&|<>"
SAMPLE = 20_000  # labelled documents of each label that the trees are grown on, at most
TREES, DEPTH, BINS, RATE = 120, 4, 64, 0.1
PENALTY, LEAST_WEIGHT = 1.0, 1.0
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: The statistics, and the sign of their effect on quality: -1 never raises it, 0 is free.
STATISTICS = {
    "log_words": 0,
    "word_length": 0,
    "symbols_per_word": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "echo_share": -1,  # words equal to the word before
    "capital_share": 0,
    "digit_share": 0,
    "stops_per_word": 0,
    "shouts_per_word": 0,
    "distinct_share": 0,
    "words_per_line": 0,
    "longest_word": 0,
}


def _mask(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_SYMBOL, _STOP, _SHOUT = _mask(SYMBOLS), _mask(b".,;:?"), _mask(b"!")
_CAPITAL, _DIGIT = _mask(bytes(range(65, 91))), _mask(b"0123456789")


def text_statistics(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Per text the counts of ``BASE`` (integers) and the ``STATISTICS`` (floats)."""
    n = len(chunk)
    data = chunk.data
    starts, ends, owner = word_spans(chunk)
    n_words = np.bincount(owner, minlength=n)
    first_byte = (data & 0xC0) != 0x80
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum(first_byte, out=points[1:])
    length = points[ends] - points[starts]
    word_chars = np.bincount(owner, length, n).astype(np.int64)
    n_symbols = chunk.per_text(_SYMBOL[data])

    line_start, line_end, line_owner = line_spans(chunk)
    # A line counts if a word begins in it: words hold no line feed.
    words_before = np.searchsorted(starts, np.stack([line_start, line_end]))
    real = words_before[1] > words_before[0]
    line = pair_codes(line_owner, span_codes(data, line_start, line_end))[real]
    repeated = pd.Series(line).duplicated().to_numpy()
    lines = np.bincount(line_owner[real], minlength=n)
    n_dup_lines = np.bincount(line_owner[real][repeated], minlength=n)

    # Codes of (text, word): equal windows are then windows of one text.
    word = pair_codes(owner, span_codes(data, starts, ends))
    n_repeat_words = np.bincount(owner[_in_repeated_window(word, owner)], minlength=n)
    echo = np.append(False, word[1:] == word[:-1])[: len(word)]
    fresh = ~pd.Series(word).duplicated().to_numpy()
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, owner, length)

    base = np.stack([n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words], 1).astype(np.int64)
    some_words, some_chars = np.maximum(n_words, 1), np.maximum(word_chars, 1)
    statistics = np.stack(
        [
            np.log1p(n_words),
            word_chars / some_words,
            n_symbols / some_words,
            n_dup_lines / np.maximum(lines, 1),
            n_repeat_words / some_words,
            np.bincount(owner[echo], minlength=n) / some_words,
            chunk.per_text(_CAPITAL[data]) / some_chars,
            chunk.per_text(_DIGIT[data]) / some_chars,
            chunk.per_text(_STOP[data]) / some_words,
            chunk.per_text(_SHOUT[data]) / some_words,
            np.bincount(owner[fresh], minlength=n) / some_words,
            n_words / np.maximum(lines, 1),
            np.log1p(longest),
        ],
        1,
    )
    return base, statistics


def _in_repeated_window(word: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Which words lie in a window of ``WINDOW`` words that its text holds twice or more; ``word`` tells texts apart."""
    covered = np.zeros(len(word) + 1, np.int64)
    windows = len(word) - WINDOW + 1
    if windows < 1:
        return covered[:-1] > 0
    two = pair_codes(word[:-1], word[1:])
    four = pair_codes(two[:-2], two[2:])
    # The words of one text have codes of their own, so equal windows never belong to two texts.
    window = pair_codes(four[:windows], word[WINDOW - 1 :])
    whole = owner[:windows] == owner[WINDOW - 1 :]
    twice = np.flatnonzero(pd.Series(window).duplicated(keep=False).to_numpy() & whole)
    covered[:-1] += np.bincount(twice, minlength=len(word))
    covered -= np.bincount(twice + WINDOW, minlength=len(word) + 1)
    return np.cumsum(covered)[:-1] > 0


def base_failed(base: np.ndarray) -> np.ndarray:
    return (base[:, 0] < LEAST_WORDS) | (100 * base[:, 4] > MOST_REPEATS * base[:, 0])


@dataclass
class Trees:
    """All trees as one run of nodes: a leaf leads to itself, ``root`` has the first node of each tree."""

    root: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    start: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row of statistics; all rows descend all trees at once."""
        node = np.repeat(self.root[None, :], len(rows), 0)
        at = np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            low = rows[at, self.feature[node]] <= self.threshold[node]
            node = np.where(low, self.left[node], self.right[node])
        z = self.start + self.value[node].sum(1)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def grow(rows: np.ndarray, label: np.ndarray, signs: np.ndarray) -> Trees:
    """Boosted trees on the logistic loss, by second-order gains over ``BINS`` quantile bins.

    A feature of sign s is split only if s times the right child's value is at least s times the left one's; the
    middle of both then bounds all values below, so that the sum of trees is monotonic in it. No rows, or rows
    of one label: no trees, the score is the smoothed share of label 1.
    """
    share = (label.sum() + 0.5) / (len(label) + 1)
    start = float(np.log(share / (1 - share)))
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots: list[int] = []
    if len(np.unique(label)) == 2:
        quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
        cuts = [np.unique(np.quantile(rows[:, f], quantiles, method="lower")) for f in range(rows.shape[1])]
        # Bin b holds the values above cut b - 1 up to cut b.
        bins = np.stack([np.searchsorted(c, rows[:, f], "left") for f, c in enumerate(cuts)], 1)
        flat = bins + np.arange(rows.shape[1]) * BINS
        z = np.full(len(rows), start)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-z))
            roots.append(len(nodes))
            _grow_node(nodes, bins, flat, np.arange(len(rows)), p - label, p * (1 - p), cuts, signs, DEPTH, -np.inf, np.inf, z)
    columns = list(zip(*nodes, strict=True)) or [()] * 5
    feature, threshold, left, right, value = (np.array(c, t) for c, t in zip(columns, (int, float, int, int, float), strict=True))
    return Trees(np.array(roots, int), feature, threshold, left, right, value, DEPTH, start)


def _grow_node(nodes, bins, flat, members, slope, bend, cuts, signs, depth, low, high, z) -> None:
    """Append the node of ``members`` and those below it; leaves add their value to ``z``."""
    number = len(nodes)
    g, h = slope[members].sum(), bend[members].sum()
    value = float(np.clip(-g / (h + PENALTY), low, high))
    nodes.append([0, np.inf, number, number, RATE * value])
    split = _best_split(flat[members], slope[members], bend[members], signs, low, high) if depth else None
    if split is None:
        z[members] += RATE * value
        return
    feature, cut, left_value, right_value = split
    middle = (left_value + right_value) / 2
    goes_left = bins[members, feature] <= cut
    nodes[number][:2] = feature, float(cuts[feature][cut])
    for side, part in ((2, members[goes_left]), (3, members[~goes_left])):
        down, up = low, high
        if signs[feature]:
            # With sign 1 the left side stays below the middle, with sign -1 above it.
            if (signs[feature] > 0) == (side == 2):
                up = min(up, middle)
            else:
                down = max(down, middle)
        nodes[number][side] = len(nodes)
        _grow_node(nodes, bins, flat, part, slope, bend, cuts, signs, depth - 1, down, up, z)


def _best_split(flat, slope, bend, signs, low, high) -> tuple[int, int, float, float] | None:
    """(feature, bin, left value, right value) of the split with the greatest gain; the first of equal ones."""
    features = flat.shape[1]
    size = features * BINS
    sums = (np.bincount(flat.ravel(), np.repeat(w, features), size).reshape(features, BINS) for w in (slope, bend))
    (gl, hl), (g, h) = (np.cumsum(s, 1) for s in sums), (slope.sum(), bend.sum())
    gr, hr = g - gl, h - hl
    left, right = (np.clip(-a / (b + PENALTY), low, high) for a, b in ((gl, hl), (gr, hr)))
    whole = np.clip(-g / (h + PENALTY), low, high)

    def loss(a, b, value):
        return a * value + 0.5 * (b + PENALTY) * value**2

    gain = loss(g, h, whole) - loss(gl, hl, left) - loss(gr, hr, right)
    allowed = (hl >= LEAST_WEIGHT) & (hr >= LEAST_WEIGHT) & (signs[:, None] * (right - left) >= 0)
    gain = np.where(allowed, gain, -np.inf)
    best = int(gain.argmax())
    feature, cut = divmod(best, BINS)
    if not gain[feature, cut] > 1e-9:
        return None
    return feature, cut, float(left[feature, cut]), float(right[feature, cut])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees for ``labels.quality``, grown on at most ``sample`` documents of each label: the smallest hashes of ids.

    Rows whose crc32(doc_id as text) mod 5 is 0 are held out. Ids with both labels count once for each; null ids
    and labels that are not 0 or 1 are left out. At most 2 * ``sample`` rows of statistics, the smallest by id,
    reach the driver, also where one id has many texts.
    """
    name = F.col("doc_id").cast("string")
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).filter(
        F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (F.crc32(name) % 5 != 0)
    )
    parts = [
        marks.filter(F.col("quality") == mark).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for mark in (0, 1)
    ]
    # At most 2 * sample ids: a bounded broadcast, and no text is shuffled.
    chosen = F.broadcast(parts[0].unionByName(parts[1]))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(chosen, "doc_id")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_statistics(chunk)[1] for chunk in chunks(batch.column("text"))]
            rows = np.concatenate([np.zeros((0, len(STATISTICS))), *found])
            packed = pa.array([r.tobytes() for r in rows], pa.binary())
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "quality": batch.column("quality"), "row": packed})

    rows = texts.select("doc_id", "quality", "text").mapInArrow(measure, "doc_id long, quality int, row binary")
    table = rows.distinct().orderBy("doc_id", "quality", "row").limit(2 * sample).toArrow()
    values = np.frombuffer(b"".join(table["row"].to_pylist()), float).reshape(-1, len(STATISTICS))
    return grow(values, table["quality"].to_numpy().astype(float), np.array(list(STATISTICS.values())))


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " base_failed boolean, score double, kept boolean"
)


def judge_documents(docs: DataFrame, trees: Trees) -> DataFrame:
    """One row per document: doc_id, the counts of ``BASE``, base_failed, score and kept.

    A document is kept if it does not fail the counted rules (``LEAST_WORDS``, ``MOST_REPEATS``) and its score is
    0.5 or more. A null or empty text has no words and fails. Labels, language, source and id are no inputs of a
    score. Repeated rows are judged alike; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)  # at most TREES * 2 ** (DEPTH + 1) nodes

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                base, statistics = text_statistics(chunk)
                failed = base_failed(base)
                score = shared.value.scores(statistics)
                columns = {"doc_id": batch.column("doc_id").slice(chunk.first, len(chunk))}
                columns |= {name: pa.array(base[:, i]) for i, name in enumerate(BASE)}
                columns |= {"base_failed": pa.array(failed), "score": pa.array(score), "kept": pa.array(~failed & (score >= 0.5))}
                yield pa.record_batch(columns)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(judge, SCHEMA)


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge_documents(docs, train(docs, labels))


def keep_good(docs: DataFrame, labelled_docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; the trees are grown on ``labelled_docs``.

    A null or empty text is never kept. The rows stay where they are: nothing is shuffled.
    """
    trees = train(labelled_docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            verdicts = [np.zeros(0, bool)]
            for chunk in chunks(batch.column("text")):
                base, statistics = text_statistics(chunk)
                verdicts.append(~base_failed(base) & (shared.value.scores(statistics) >= 0.5))
            yield batch.filter(pa.array(np.concatenate(verdicts)))

    return docs.mapInArrow(filtered, docs.schema)
