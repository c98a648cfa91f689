"""Spelling variants: words one edit apart, found in bidirectional FM-indexes over shards of the vocabulary.

Of two words one edit apart, the edit lies in one half of the first or in the other, so the other half occurs in
the second word unchanged, at its beginning or at its end. A search scheme of two searches finds all: match the
first half exactly and extend to the right with one error, and match the second half and extend to the left.

The vocabulary is dealt twice, to shards that hold stretches of the words in order (for the first search) and of
the reversed words in order (for the second). A word is sought only in the shards that can hold words with its
half, and each shard has an index of its own.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.rolling import aranges
from shelfwise.operators.joins import lookup_join
from shelfwise.session import settle

LEAST_LENGTH, LEAST_COUNT, RATIO = 5, 3, 2
RUN = re.compile("[a-zÀ-ÿ]+")
SHARD = 4096  # words of a shard, about
MOST_SHARDS = 1 << 15  # of each order; beyond that shards grow
PER_SHARD = 24  # sampled words that decide the borders, for each shard
BATCH = 4096  # words sought together
HELD = 200_000  # words counted in memory, about
BROADCAST_BYTES = 16 << 20  # of the words whose forms are followed
END = 0  # the code of the delimiter


class Index:
    """Bidirectional FM-index over words in code-point order, each between two delimiters.

    A pattern's state is (low, reverse low, size): its occurrences are ``size`` consecutive suffixes of the text
    and as many of the reversed text. Extending by a letter to the left narrows the first stretch by the counts of
    letters before the suffixes, and moves the second by the number of smaller letters; to the right likewise.
    """

    def __init__(self, words: list[str]):
        self.words = words
        lengths = np.array([len(w) for w in words], np.int64)
        joined = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        self.letters = np.unique(joined)
        text = np.full(len(joined) + len(words) + 1, END, np.int64)
        begins = np.cumsum(lengths + 1) - lengths
        text[aranges(begins, lengths)] = self.codes(joined)
        self.sigma = len(self.letters) + 1
        # Words are in order, so delimiters compare by position as what follows them does. The text is a ring:
        # the last delimiter is followed by the first one, hence smallest.
        self.suffixes = _suffix_array(text)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.sigma))])
        self.before = self._counts(text, self.suffixes)
        backward = text[::-1]
        self.after = self._counts(backward, _suffix_array(backward))
        #: The word that begins behind each delimiter, in order of the delimiters' suffixes.
        numbers = np.full(len(text), -1, np.int64)
        numbers[begins - 1] = np.arange(len(words))
        self.word_at = numbers[self.suffixes[: self.first[1]]]

    def codes(self, points: np.ndarray) -> np.ndarray:
        """Letter codes from 1; 0 for the delimiter, -1 for letters that no word has."""
        at = np.searchsorted(self.letters, points)
        found = self.letters[np.minimum(at, len(self.letters) - 1)] == points
        return np.where(found, at + 1, -1)

    def _counts(self, text: np.ndarray, suffixes: np.ndarray) -> np.ndarray:
        """[i, c]: how many of the first i suffixes follow letter c."""
        previous = text[suffixes - 1]
        counts = np.zeros((len(text) + 1, self.sigma), np.int32)
        counts[np.arange(1, len(text) + 1), previous] = 1
        return np.cumsum(counts, 0, out=counts)

    def whole(self, n: int) -> np.ndarray:
        """The state of the empty pattern, ``n`` times."""
        return np.repeat(np.array([[0], [0], [len(self.suffixes)]], np.int64), n, 1)

    def extend_all(self, state: np.ndarray, right: bool) -> tuple[np.ndarray, np.ndarray]:
        """Each state extended by every letter that occurs there: (which state, letter), and the new states."""
        counts, (near, far) = (self.after, (1, 0)) if right else (self.before, (0, 1))
        low = counts[state[near]]
        sizes = counts[state[near] + state[2]] - low
        which, letter = np.nonzero(sizes)
        smaller = np.cumsum(sizes, 1) - sizes
        out = np.empty((3, len(which)), np.int64)
        out[near] = self.first[letter] + low[which, letter]
        # Suffixes that end with the pattern are in order of the letter behind it: the delimiter first.
        out[far] = state[far][which] + smaller[which, letter]
        out[2] = sizes[which, letter]
        return np.stack([which, letter]), out

    def extend(self, state: np.ndarray, letter: np.ndarray, right: bool) -> np.ndarray:
        """Each state extended by one letter; a letter of -1, or one that does not occur there, gives size 0."""
        counts, (near, far) = (self.after, (1, 0)) if right else (self.before, (0, 1))
        known = np.maximum(letter, 0)
        rows, ends = counts[state[near]], counts[state[near] + state[2]]
        at = np.arange(len(letter))
        sizes = ends - rows
        out = np.empty_like(state)
        out[near] = self.first[known] + rows[at, known]
        out[far] = state[far] + (np.cumsum(sizes, 1) - sizes)[at, known]
        out[2] = np.where(letter >= 0, sizes[at, known], 0)
        return out

    def near(self, words: list[str], right: bool) -> tuple[np.ndarray, np.ndarray]:
        """(number in ``words``, number of an indexed word): pairs at most one edit apart that share the half.

        ``right``: the first half, floor(length / 2) letters, is matched after a delimiter and extended to the
        right; else the second half is matched before a delimiter and extended to the left. A pair may occur
        more than once, and a word finds itself.
        """
        lengths = np.array([len(w) for w in words], np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        begins = np.cumsum(lengths) - lengths
        # Row i: delimiter, the half to match, the half that may differ, delimiter; read outwards.
        pattern = np.full((len(words), int(lengths.max()) + 3), -1, np.int64)
        row = np.repeat(np.arange(len(words)), lengths)
        place = aranges(np.zeros(len(words), np.int64), lengths)
        if not right:
            place = lengths[row] - 1 - place
        pattern[row, place + 1] = self.codes(points[aranges(begins, lengths)])
        pattern[:, 0] = END
        pattern[np.arange(len(words)), lengths + 1] = END
        exact = (lengths // 2 if right else lengths - lengths // 2) + 1

        query, state = np.arange(len(words)), self.whole(len(words))
        for step in range(int(exact.max())):
            moving = exact[query] > step
            new = self.extend(state[:, moving], pattern[query[moving], step], right)
            alive = np.ones(len(query), bool)
            alive[moving] = new[2] > 0
            state[:, moving] = new
            query, state = query[alive], state[:, alive]
        done_query, done_low = [], []
        # Without an error so far: (query, place, state); with one: the same, to be finished exactly.
        place = exact[query]
        waiting = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((3, 0), np.int64))]
        while len(query):
            wanted = pattern[query, place]
            inner = place <= lengths[query]
            (which, letter), child = self.extend_all(state, right)
            hit = letter == wanted[which]
            here = place[which]
            inside = letter != END
            replaced = inside & ~hit & inner[which]
            waiting.append((query[which[replaced]], here[replaced] + 1, child[:, replaced]))
            added = inside & ~hit
            waiting.append((query[which[added]], here[added], child[:, added]))
            waiting.append((query[inner], place[inner] + 1, state[:, inner]))  # left out
            over = hit & (here == lengths[query[which]] + 1)
            done_query.append(query[which[over]])
            done_low.append(child[0, over])
            on = hit & ~over
            query, place, state = query[which[on]], here[on] + 1, child[:, on]
        query, place = (np.concatenate([w[i] for w in waiting]) for i in (0, 1))
        state = np.concatenate([w[2] for w in waiting], 1)
        while len(query):
            state = self.extend(state, pattern[query, place], right)
            over = (state[2] > 0) & (place == lengths[query] + 1)
            done_query.append(query[over])
            done_low.append(state[0, over])
            on = (state[2] > 0) & ~over
            query, place, state = query[on], place[on] + 1, state[:, on]
        # Patterns with both delimiters occur once: their suffix begins with the one before the word.
        return np.concatenate([np.zeros(0, np.int64), *done_query]), self.word_at[np.concatenate([np.zeros(0, np.int64), *done_low])]


def _suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling; equal stretches end at delimiters, which compare by position, the last one first."""
    n, ends = len(text), int((text == END).sum())
    rank = np.where(text == END, np.cumsum(text == END) % ends, text + ends)
    rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
    step = 1
    while rank.max() < n - 1:
        later = np.zeros(n, np.int64)
        later[:-step] = rank[step:] + 1
        rank = np.unique(rank * (n + 1) + later, return_inverse=True)[1].astype(np.int64)
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order


def count_words(docs: DataFrame) -> DataFrame:
    """word, n: the spellings of ``docs`` (doc_id, text) with at least ``LEAST_LENGTH`` letters and ``LEAST_COUNT`` uses.

    Runs of A-Z, a-z and U+00C0 to U+00FF in whole texts; A-Z in lower case. Where 97 divides the crc32 of
    "doc_id:run", the run loses the letter at that crc32 modulo its length. A null id is written ``null``, a null
    text has no words.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                known = zlib.crc32(f"{'null' if doc_id is None else doc_id}:".encode())
                # Lower case of bytes touches A-Z alone.
                runs = Counter(RUN.findall((text.as_py() or "").encode().lower().decode()))
                for run, n in runs.items():
                    h = zlib.crc32(run.encode(), known)
                    if not h % 97:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                    if len(run) >= LEAST_LENGTH:
                        seen[run] += n
                if len(seen) > HELD:  # counts so far leave the task and are added up behind it
                    yield out()
                    seen.clear()
        yield out()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _borders(words: DataFrame, total: int, shards: int) -> list[str]:
    """First words of all shards but the first: quantiles of a sample by hash."""
    if shards < 2:
        return []
    rate = max(1, total // (PER_SHARD * shards))
    # About PER_SHARD * shards words, and shards are at most MOST_SHARDS, however large the vocabulary.
    sample = sorted(r[0] for r in words.filter(F.pmod(F.xxhash64("word"), F.lit(rate)) == 0).select("word").collect())
    return sorted({sample[len(sample) * i // shards] for i in range(1, shards)}) if sample else []


def near_words(counted: DataFrame, shard: int = SHARD) -> DataFrame:
    """word, n, n_near, form, form_n for a table of distinct words and counts (word, n), all of them at least 2 letters.

    n_near counts the words one inserted, deleted or replaced letter away; form is the one with the largest n, of
    equal ones the smallest in code-point order, if that n is at least ``RATIO`` x the word's own, else null.
    """
    spark = counted.sparkSession
    words = settle(counted, "words")
    total = words.count()
    shards = int(min(MOST_SHARDS, -(-total // shard)))
    borders = {
        False: _borders(words.select(F.reverse("word").alias("word")), total, shards),
        True: _borders(words, total, shards),
    }
    # Fewer than MOST_SHARDS words each: a bounded broadcast.
    shared = spark.sparkContext.broadcast(borders)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[bool, int, bool, str, int]] = []
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                half = len(word) // 2
                for right, whole, known in ((True, word, word[:half]), (False, word[::-1], word[half:][::-1])):
                    cuts = shared.value[right]
                    rows.append((right, bisect_right(cuts, whole), False, word, n))
                    # Shards whose stretch meets the words that begin with the half.
                    first, last = bisect_right(cuts, known), bisect_left(cuts, known + "\U0010ffff")
                    rows.extend((right, s, True, word, n) for s in range(first, last + 1))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.bool_(), pa.int32(), pa.bool_(), pa.string(), pa.int64())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.record_batch(arrays, names=["ahead", "shard", "sought", "word", "n"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, index, counts, words, ns = None, None, None, [], []
        sought: list[str] = []

        def answer() -> Iterator[pa.RecordBatch]:
            if sought and index is not None:
                yield _nearest(index, counts, sought, at[0])
            sought.clear()

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("ahead", "shard", "sought", "word", "n"))
            for ahead, number, wanted, word, n in zip(*columns, strict=True):
                if (ahead, number) != at:
                    yield from answer()
                    at, index, words, ns = (ahead, number), None, [], []
                if not wanted:
                    words.append(word)
                    ns.append(n)
                    continue
                if index is None and words:
                    index, counts = Index(words), np.array(ns, np.int64)
                sought.append(word)
                if len(sought) == BATCH:
                    yield from answer()
        yield from answer()

    dealt = words.mapInArrow(deal, "ahead boolean, shard int, sought boolean, word string, n long")
    tasks = max(1, min(2 * shards, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    # Indexed words come first and in order; the words sought stream past the index of one shard at a time.
    ordered = dealt.repartition(tasks, "ahead", "shard").sortWithinPartitions("ahead", "shard", "sought", "word")
    found = ordered.mapInArrow(search, "word string, near long, best_n long, best string")
    # Largest count first; of equal counts the smallest word.
    per_word = found.groupBy("word").agg(
        F.sum("near").alias("n_near"),
        F.max("best_n").alias("best_n"),
        F.min_by("best", F.struct(-F.col("best_n"), F.col("best"))).alias("best"),
    )
    joined = words.join(per_word, "word", "left")
    strong = F.col("best_n") >= RATIO * F.col("n")
    return joined.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(strong, F.col("best")).alias("form"),
        F.when(strong, F.col("best_n")).alias("form_n"),
    )


def _nearest(index: Index, counts: np.ndarray, sought: list[str], ahead: bool) -> pa.RecordBatch:
    """Per word sought that has near words here: their number and the best of them.

    The search to the left leaves out words that share the first half, too: the other search finds those.
    """
    query, hit = index.near(sought, ahead)
    pairs = np.unique(query * len(index.words) + hit)
    query, hit = np.divmod(pairs, max(1, len(index.words)))
    keep = np.array(
        [
            sought[q] != index.words[v] and (ahead or not index.words[v].startswith(sought[q][: len(sought[q]) // 2]))
            for q, v in zip(query.tolist(), hit.tolist(), strict=True)
        ],
        bool,
    )
    query, hit = query[keep], hit[keep]
    # Indexed words are in order: the first of the largest counts is the smallest word.
    order = np.lexsort((hit, -counts[hit], query))
    query, hit = query[order], hit[order]
    first = np.flatnonzero(np.append(True, query[1:] != query[:-1])[: len(query)])
    near = np.diff(np.append(first, len(query)))
    return pa.record_batch(
        {
            "word": pa.array([sought[q] for q in query[first].tolist()], pa.string()),
            "near": pa.array(near, pa.int64()),
            "best_n": pa.array(counts[hit[first]], pa.int64()),
            "best": pa.array([index.words[v] for v in hit[first].tolist()], pa.string()),
        }
    )


def with_roots(forms: DataFrame) -> DataFrame:
    """``forms`` (word, form, ...) with root: the word at which following forms ends.

    Forms are at least twice as frequent, so there is no cycle and a path has at most log2 of the largest count
    steps; every round doubles the steps that are behind a word.
    """
    forms = settle(forms, "forms")
    ends = forms.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        # Many words may share a root; the look-up side has each word once.
        step = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = lookup_join(ends, step, ["root"], max_bytes=BROADCAST_BYTES)
        moved = settle(moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("on")), "roots")
        ends = moved.drop("on")
        if moved.filter("on").isEmpty():
            break
    return forms.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def group_spellings(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row per word of ``docs``; only doc_id and text are read.

    An empty table, or one without such words, gives no rows. Repeated rows count as often as they occur.
    """
    rows = with_roots(near_words(count_words(docs)))
    return rows.select("word", "form", "root", "n", "n_near", "form_n")
