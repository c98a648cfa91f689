"""Toxicity by multiple-instance learning: a document is toxic if any of its sentences is.

Sentence scores come from a logistic model over hashed words and word beginnings; a document's score is their
noisy-or, 1 - prod(1 - p). Only documents are labelled: the gradient of the document's likelihood flows to
the sentences, so the model also tells which ones offend.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import settle

WORD = re.compile(r"\w+")
SENTENCE = re.compile(r"(?<=[.!?\n])\s+")
BITS = 18
PREFIXES = (4, 5)
SAMPLE = 3000  # labelled documents of each label that the model is fitted on, at most
COUNTED = 50_000  # labelled documents of each label that features are counted over, at most
STEPS = 300
RATE = 0.1
PENALTY = 1e-4
SURE, LEAST_RATE = 5.0, 0.01


class _Features(dict):
    """Word to its feature numbers; emptied when large."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        keys = {word, *(f"{word[:n]}*" for n in PREFIXES if len(word) >= n)}
        out = tuple(sorted({zlib.crc32(k.encode()) >> (32 - BITS) for k in keys}))
        if len(self) < 200_000:
            self[word] = out
        return out


def sentences(text: str | None) -> list[str]:
    """Parts that end with . ! ? or a line break; an empty text is one empty sentence."""
    return SENTENCE.split(text or "")


def _bag(sentence: str, features: _Features) -> set[int]:
    return {f for word in WORD.findall(sentence.lower()) for f in features[word]}


def _encode(text: str | None, features: _Features) -> tuple[np.ndarray, np.ndarray]:
    """The features of each sentence, joined, and how many each sentence has."""
    bags = [np.fromiter(_bag(s, features), np.int32) for s in sentences(text)]
    return np.concatenate(bags), np.array([len(b) for b in bags], np.int32)


def fit(labelled: list[tuple[str | None, int]]) -> np.ndarray:
    """The weights, last the bias, fitted on these documents alone."""
    features = _Features()
    coded = [(*_encode(text, features), mark) for text, mark in labelled]
    seen = np.zeros((2, 2**BITS))
    for column, _, mark in coded:
        seen[mark, np.unique(column)] += 1
    docs = np.bincount([m for _, _, m in coded], minlength=2)
    kept = more_toxic(seen, docs)
    return fit_encoded(coded, kept, reliance(seen, docs, kept))


def more_toxic(seen: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Features in a larger share of the toxic than of the clean documents, however few: the fit's penalty weighs them.

    Shares do not depend on how many documents have either label.
    """
    share = seen / np.maximum(docs, 1)[:, None]
    return np.flatnonzero(share[1] > share[0])


def reliance(seen: np.ndarray, docs: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """How fast the weights of the features ``kept`` may grow: their smoothed log-odds in standard errors, squared.

    A word seen in one toxic document says little, one seen in many of them and in few clean ones a lot. Nothing is
    cut: every feature has a rate above 0.
    """
    toxic, clean = seen[1, kept] + 0.5, seen[0, kept] + 0.5
    odds = np.log(toxic / (docs[1] + 1)) - np.log(clean / (docs[0] + 1))
    return np.minimum((np.maximum(odds, 0.0) / np.sqrt(1 / toxic + 1 / clean) / SURE) ** 2, 1.0) + LEAST_RATE


def fit_encoded(coded: list[tuple[np.ndarray, np.ndarray, int]], kept: np.ndarray, rate: np.ndarray | None = None) -> np.ndarray:
    """The weights, last the bias, by gradient ascent (Adam) on the documents' noisy-or likelihood.

    ``coded`` has each document's ``_encode`` and label; only the features ``kept`` can make a sentence offend, and
    their weights are ``rate`` times what is learned for them.
    """
    rate = np.ones(len(kept)) if rate is None else rate
    weights = np.zeros(2**BITS + 1)
    if not coded:
        weights[-1] = -3.0
        return weights
    place = np.full(2**BITS, -1, np.int32)
    place[kept] = np.arange(len(kept), dtype=np.int32)
    column = place[np.concatenate([c for c, _, _ in coded])]
    of_doc = np.repeat(np.arange(len(coded), dtype=np.int32), [len(n) for _, n, _ in coded])
    instances = len(of_doc)
    of_instance = np.repeat(np.arange(instances, dtype=np.int32), np.concatenate([n for _, n, _ in coded]))[column >= 0]
    column = column[column >= 0]
    label = np.array([mark for _, _, mark in coded], float)
    share = np.clip(label.mean(), 0.01, 0.99)
    balance = np.where(label == 1, 0.5 / share, 0.5 / (1 - share))
    theta = np.zeros(len(kept) + 1)
    theta[-1] = -3.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        z = theta[-1] + np.bincount(of_instance, (rate * theta[:-1])[column], instances)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        # log(1 - p) summed over a document is the log-probability that nothing offends.
        clean = np.bincount(of_doc, np.log1p(-np.minimum(p, 1 - 1e-12)), len(label))
        toxic = -np.expm1(clean)
        pull = np.where(label == 1, np.exp(clean) / np.maximum(toxic, 1e-9), -1.0) * balance
        dz = pull[of_doc] * p
        slope = np.append(rate * np.bincount(column, dz[of_instance], len(kept)), dz.sum()) / len(label)
        slope[:-1] -= PENALTY * theta[:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        theta += RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    weights[kept] = rate * theta[:-1]
    weights[-1] = theta[-1]
    return weights


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, counted: int = COUNTED) -> np.ndarray:
    """Fit on at most ``sample`` documents of each label, those with the smallest hashes of their ids.

    Which features can mark toxic documents is counted over at most ``counted`` documents of each label, chosen
    alike. The ids are chosen on the labels' side and broadcast: the documents are scanned, no text is shuffled.

    Rows whose crc32(doc_id as text) mod 5 is 0 are held out and never seen. Ids with both labels, or with
    more than one text, count once per pair. Null labels and ids are left out.
    """
    name = F.col("doc_id").cast("string")
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (F.crc32(name) % 5 != 0)
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]

    def smallest(n: int) -> DataFrame:
        parts = [marks.filter(F.col("toxic") == mark).distinct().orderBy(*order).limit(n) for mark in (0, 1)]
        # At most 2 * n ids.
        return settle(parts[0].unionByName(parts[1]), "chosen-ids")

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    seen, numbers = _document_counts(texts.join(F.broadcast(smallest(counted)), "doc_id"))
    kept = more_toxic(seen, numbers)
    chosen = smallest(sample)
    # At most 2 * sample ids: a bounded broadcast, and as many arrays for the driver.
    shared = docs.sparkSession.sparkContext.broadcast(kept.astype(np.int32))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, known = _Features(), np.zeros(2**BITS, bool)
        known[shared.value] = True
        for batch in batches:
            columns, counts = [], []
            for text in batch["text"]:
                column, n = _encode(text.as_py(), features)
                good = known[column]
                of = np.repeat(np.arange(len(n)), n)[good]
                columns.append(column[good].astype(np.int32).tobytes())
                counts.append(np.bincount(of, minlength=len(n)).astype(np.int32).tobytes())
            arrays = [batch["doc_id"], pa.array(columns, pa.binary()), pa.array(counts, pa.binary()), batch["toxic"]]
            yield pa.record_batch(arrays, ["doc_id", "columns", "counts", "toxic"])

    # Rows are encoded where they are read; one id may have many texts, so as many rows as ids are taken.
    rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")
    coded = rows.mapInArrow(encode, "doc_id long, columns binary, counts binary, toxic int")
    table = coded.orderBy("doc_id", "toxic", F.xxhash64("columns", "counts")).limit(2 * sample).drop("doc_id").toArrow()
    columns = (np.frombuffer(c.as_py(), np.int32) for c in table["columns"])
    counts = (np.frombuffer(c.as_py(), np.int32) for c in table["counts"])
    return fit_encoded(list(zip(columns, counts, table["toxic"].to_pylist(), strict=True)), kept, reliance(seen, numbers, kept))


def _document_counts(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """In how many rows of ``labelled`` (text, toxic) of each label every feature occurs, and the rows of each label.

    Each task adds up its own rows, so only feature numbers and counts leave it.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, seen = _Features(), np.zeros((2, 2**BITS + 1), np.int64)
        for batch in batches:
            for text, mark in zip(batch["text"], batch["toxic"].to_pylist(), strict=True):
                words = set(WORD.findall((text.as_py() or "").lower()))
                own = {f for word in words for f in features[word]}
                seen[mark, np.fromiter(own, np.int32)] += 1
                seen[mark, -1] += 1
        mark, feature = np.nonzero(seen)
        yield pa.record_batch({"toxic": mark.astype(np.int32), "feature": feature.astype(np.int32), "n": seen[mark, feature]})

    rows = labelled.select("text", "toxic").mapInArrow(count, "toxic int, feature int, n long")
    # At most 2 * (2 ** BITS + 1) rows, however large the corpus.
    table = rows.groupBy("toxic", "feature").agg(F.sum("n").alias("n")).toArrow()
    seen = np.zeros((2, 2**BITS + 1))
    seen[table["toxic"].to_numpy(), table["feature"].to_numpy()] = table["n"].to_numpy()
    return seen[:, :-1], seen[:, -1]


def score_documents(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, n_sentences, offending (sentence numbers from 0).

    Null and empty texts have one empty sentence and get its score. Labels, language, source and id are no
    inputs. Repeated rows are ordinary rows; a null doc_id counts as held out.
    """
    kept = np.flatnonzero(weights[:-1])
    # The learned weights: at most 2 ** 18 of them, however large the corpus.
    shared = docs.sparkSession.sparkContext.broadcast((kept, weights[kept], float(weights[-1])))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, value, bias = shared.value
        weight_of = dict(zip(at.tolist(), value.tolist(), strict=True))
        features = _Features()
        word_features: dict[str, tuple[int, ...]] = {}

        def known(word: str) -> tuple[int, ...]:
            found = word_features.get(word)
            if found is None:
                found = tuple(f for f in features.__missing__(word) if f in weight_of)
                features.clear()
                if len(word_features) >= 300_000:
                    word_features.clear()
                word_features[word] = found
            return found

        for batch in batches:
            scores, counts, offending = [], [], []
            for text in batch.column("text"):
                parts = sentences(text.as_py())
                clean, bad = 1.0, []
                for number, part in enumerate(parts):
                    bag = {f for word in WORD.findall(part.lower()) for f in known(word)}
                    z = bias + sum(weight_of[f] for f in bag)
                    p = 1 / (1 + np.exp(-min(30.0, max(-30.0, z))))
                    clean *= 1 - p
                    if p >= 0.5:
                        bad.append(number)
                scores.append(float(min(1.0, max(0.0, 1 - clean))))
                counts.append(len(parts))
                offending.append(bad)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "held_out": batch.column("held_out"),
                    "score": pa.array(scores, pa.float64()),
                    "predicted": pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                    "n_sentences": pa.array(counts, pa.int32()),
                    "offending": pa.array(offending, pa.list_(pa.int32())),
                }
            )

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    return rows.mapInArrow(
        score, "doc_id long, held_out boolean, score double, predicted int, n_sentences int, offending array<int>"
    )


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_documents(docs, train(docs, labels))


def drop_toxic(docs: DataFrame, labelled_docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, unchanged; the model is learned from ``labelled_docs``."""
    weights = train(labelled_docs, labels)
    key = "toxic_row"
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce("text", F.lit(""))))
    # Equal texts have equal scores, so rows are kept by text.
    scored = score_documents(keyed.select(F.col(key).alias("doc_id"), "text"), weights)
    rejected = scored.filter("predicted = 1").select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(rejected, key, "left_anti").drop(key)
