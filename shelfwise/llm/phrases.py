"""Document fingerprints from the phrases of a Lempel-Ziv parse.

A document is parsed by LZ78 over its words: each phrase is the longest one seen before plus one word. Texts
that would compress each other share phrases, so the smallest hashes of the phrase set estimate that likeness.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKETCH = 64
TOKEN = re.compile(r"\s*\S{1,16}|\s+\Z")


def lz_phrases(text: str) -> set[str]:
    """The phrases of the LZ78 parse; tokens are words with the white space before them, cut after 16 characters."""
    phrases: set[str] = set()
    phrase = ""
    for token in TOKEN.findall(text):
        phrase += token
        if phrase not in phrases:
            phrases.add(phrase)
            phrase = ""
    return phrases


def sketch(phrases: set[str]) -> np.ndarray:
    """The ``SKETCH`` smallest distinct 32-bit hashes of the phrases, ascending."""
    hashes = np.fromiter((xxhash.xxh32_intdigest(p) for p in phrases), np.uint32, len(phrases))
    return np.unique(hashes)[:SKETCH]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two phrase sets, from the smallest hashes of their union; two empty sets are alike."""
    union = np.union1d(a, b)[:SKETCH]
    if not len(union):
        return 1.0
    return float(np.isin(union, np.intersect1d(a, b, assume_unique=True), assume_unique=True).mean())


def _hex(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u4").tobytes().hex()


def fingerprint_documents(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text with its last floor(n/2) code points replaced by as many, or all, of the
    first of the next document's, in descending order of doc_id (null last; rows with equal ids by a hash
    of the text, then at random among copies); after the last comes the first. A null text is empty. A
    lone document is its own next one. An empty table gives no rows. Only doc_id and text are read.

    Rows are dealt to ranges of ids and stream through each in order, with one row in memory besides the
    current one; the first row of each range also goes to the range before, as the next of its last row.
    """
    spark = docs.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"))
    low = F.lit(-(2**63))
    key = F.coalesce("doc_id", low)
    # At most ``ranges`` cuts: a bounded list.
    cuts = rows.agg(F.percentile_approx(key, [i / ranges for i in range(1, ranges)], 100 * ranges)).first()[0] if ranges > 1 else None
    cuts = sorted(set(cuts or []), reverse=True)
    # Range 0 holds the largest ids.
    number = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c > key)) if cuts else F.lit(0)
    dealt = rows.withColumn("range", number)
    order = F.struct(key.alias("k"), "tie")
    heads = dealt.groupBy("range").agg(F.max(order).alias("head"))  # one row per range
    found = [(r["range"], r["head"]["k"], r["head"]["tie"]) for r in heads.orderBy("range").collect()]
    if not found:
        return spark.createDataFrame([], SCHEMA)
    before = [found[i - 1][0] for i in range(len(found))]
    table = spark.createDataFrame(
        [(k, t, b) for (_, k, t), b in zip(found, before, strict=True)], "head_key long, head_tie long, range int"
    )
    sent = (
        rows.join(F.broadcast(table), (key == F.col("head_key")) & (F.col("tie") == F.col("head_tie")))
        .groupBy("range")
        .agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.first("tie").alias("tie"))
        .withColumn("follows", F.lit(1))
    )
    every = dealt.withColumn("follows", F.lit(0)).unionByName(sent)
    # Range numbers are partition numbers, so no task gets two ranges.
    ordered = every.repartitionById(ranges, F.col("range").cast("int")).sortWithinPartitions("range", "follows", F.col("doc_id").desc_nulls_last(), F.desc("tie"))
    return ordered.select("range", "follows", "doc_id", "text").mapInArrow(_parse_in_order, SCHEMA)


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def _parse_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in SCHEMA.split(",")]
    last: tuple[int | None, str, np.ndarray] | None = None
    for batch in batches:
        out: list[tuple] = []
        for follows, doc_id, text in zip(
            batch.column("follows").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text"), strict=True
        ):
            text = text.as_py() or ""
            own = sketch(lz_phrases(text))
            if last is not None:
                last_id, last_text, last_own = last
                half = len(last_text) // 2
                edited = last_text[: len(last_text) - half] + text[:half]
                changed = sketch(lz_phrases(edited))
                digest = hashlib.sha256(edited.encode()).hexdigest()
                near = likeness(last_own, changed), likeness(last_own, own)
                out.append((last_id, len(last_text), digest, _hex(last_own), _hex(changed), *near))
            # A following head ends its range: the next row begins another one.
            last = None if follows else (doc_id, text, own)
            if len(out) == 512:
                yield _batch(names, out)
                out = []
        yield _batch(names, out)


def _batch(names: list[str], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
