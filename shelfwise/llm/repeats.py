"""Removal of byte strings that occur in an earlier document, by a radix sort limited to the threshold depth.

Every window of ``min_bytes`` bytes is keyed by the smallest hash among its short grams. Equal windows have equal
keys, and neighbouring windows mostly share theirs, so they travel as runs. The most significant digits of the
key deal the runs to buckets (first pass), the rest sorts each bucket (second pass), and within a key the hash
of the run's whole content separates the groups (third pass): equal runs hold equal windows only. Where one key
has several contents, the contents themselves are dealt again by key and sorted window by window
(last pass). Groups that lie in one document leave the sort after each pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.rolling import Rolling, aranges, mix, pack, sliding_min, unpack

GRAM = 24
CHUNK = 1 << 19  # bytes hashed at once; longer texts are hashed in overlapping parts
BUCKET_BYTES = 8 << 20
BLOCK_BYTES = 2 << 20
MOST_BLOCK_BYTES = 8 << 20
BLOCKS = 400
BLOB_BYTES = 8 << 10  # of text whose runs go to one bucket at once
HELD_BYTES = 32 << 20  # of text whose runs a task holds at most
LAST = 2**63 - 1


def _runs(parts: list[np.ndarray], depth: int) -> tuple[np.ndarray, ...]:
    """part, start, number of windows, key and content hash of each run of windows with one key."""
    data = np.concatenate(parts)
    sizes = np.array([len(p) for p in parts])
    windows = np.maximum(0, sizes - depth + 1)
    offsets = np.cumsum(sizes) - sizes
    gram = min(GRAM, (depth + 1) // 2)
    rolling = Rolling(data)
    smallest = sliding_min(rolling.grams(gram), depth - gram + 1)
    at = aranges(offsets, windows)
    part = np.repeat(np.arange(len(parts)), windows)
    if not len(at):
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    key = smallest[at]
    first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (part[1:] != part[:-1])]))
    count = np.diff(np.append(first, len(at)))
    start = at[first]
    content = rolling.spans(start, start + count - 1 + depth)
    # The smallest of many hashes is small: mixed again, its digits are even.
    return part[first], start - offsets[part[first]], count, mix(key[first]), content


def _dealing(total: int) -> tuple[int, int]:
    """The digits that name a bucket, and the number of blocks, for so many bytes of text.

    Every bucket has rows for every block: blocks grow to 8 MB first, so that they are fewer where buckets are many.
    """
    bits = max(6, (total // BUCKET_BYTES).bit_length())
    return bits, max(16, total // min(MOST_BLOCK_BYTES, max(BLOCK_BYTES, total // BLOCKS)))


def _hash_runs(depth: int, bits: int):
    """Map side of the first pass: the runs of many documents, dealt by the key's first digits.

    Texts are hashed some at a time, and their runs are held until each bucket gets a fair share: the blobs of a task are
    as many as its buckets, not as its buckets times its texts.
    """
    hold = min(HELD_BYTES, max(CHUNK, BLOB_BYTES << bits))

    def hashed(parts: list[np.ndarray], owner: list[int], shift: list[int]) -> tuple[np.ndarray, ...]:
        part, start, count, key, content = _runs(parts, depth)
        start = start + np.array(shift, np.int64)[part]
        bucket = (key >> np.uint64(64 - bits)).astype(np.uint16 if bits <= 16 else np.uint32)
        rest = ((key << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
        low, high = (content >> np.uint64(48)).astype(np.uint16), (content >> np.uint64(16)).astype(np.uint32)
        return bucket, rest, low, high, np.array(owner, np.int32)[part], start.astype(np.int32), count.astype(np.uint32)

    def emit(ids: list[tuple[int, int]], held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        bucket, rest, low, high, doc, start, count = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(2**bits + 1))
        table = np.array(ids, np.int64).reshape(-1, 2)
        name, check = table[:, 1], ((table[:, 0] ^ table[:, 1]) >> 31).astype(np.uint32)
        out: dict[str, list] = {"bucket": [], "runs": []}
        for b in np.flatnonzero(np.diff(cuts)):
            own = order[cuts[b] : cuts[b + 1]]
            used, local = np.unique(doc[own], return_inverse=True)
            out["bucket"].append(int(b))
            # Differences of what rises, so that the blob packs well.
            rising = [np.diff(x, prepend=0).astype(np.int32) for x in (local, start[own])]
            names = np.diff(name[used], prepend=0)
            out["runs"].append(pack(names, check[used], rest[own], low[own], high[own], *rising, count[own]))
        return pa.record_batch({"bucket": pa.array(out["bucket"], pa.int32()), "runs": pa.array(out["runs"], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, owner, shift, fresh, held, size = [], [], [], [], 0, [], 0
        for batch in batches:
            for row, doc_id, text in zip(batch["row"].to_pylist(), batch["doc_id"].to_pylist(), batch["text"], strict=True):
                data = np.frombuffer((text.as_py() or "").encode(), np.uint8)
                if len(data) < depth:
                    continue
                ids.append((row, LAST if doc_id is None else doc_id))
                for begin in range(0, len(data) - depth + 1, CHUNK):
                    parts.append(data[begin : begin + CHUNK + depth - 1])
                    owner.append(len(ids) - 1)
                    shift.append(begin)
                    fresh += len(parts[-1])
                    if fresh >= CHUNK:
                        held.append(hashed(parts, owner, shift))
                        size += fresh
                        parts, owner, shift, fresh = [], [], [], 0
                        if size >= hold:
                            yield emit(ids, held)
                            # The text may go on: its number in the new table is 0.
                            ids, held, size = ids[-1:], [], 0
        if parts:
            held.append(hashed(parts, owner, shift))
        if held:
            yield emit(ids, held)

    return run


def _sort_bucket(blocks: int):
    """Second and third pass: runs whose content occurs in an earlier document, and keys of several contents."""

    def sort(bucket: pd.DataFrame) -> pd.DataFrame:
        pieces = []
        for blob in bucket["runs"]:
            name, check, rest, low, high, local, start, count = unpack(blob)
            local = np.cumsum(local)
            owner = np.cumsum(name)[local]
            row = owner ^ (check[local].astype(np.int64) << 31)
            pieces.append((rest, high.astype(np.uint64) << np.uint64(16) | low, row, owner, np.cumsum(start), count))
        rest, content, row, doc, start, count = (np.concatenate(c) for c in zip(*pieces, strict=True))
        order = np.lexsort((doc, content, rest))
        rest, content, row, doc, start, count = (x[order] for x in (rest, content, row, doc, start, count))
        new_key = np.append(True, rest[1:] != rest[:-1])
        new_group = new_key | np.append(True, content[1:] != content[:-1])
        group = np.cumsum(new_group) - 1
        key = np.cumsum(new_key) - 1
        earliest = doc[new_group][group]
        several = np.bincount(key[new_group])[key] > 1
        across = (np.maximum.reduceat(doc, np.flatnonzero(new_key)) != np.minimum.reduceat(doc, np.flatnonzero(new_key)))[key]
        covered = doc > earliest
        edge = several & across & ~covered
        # The sort key of the last pass: the bucket's digits and the rest.
        number = (np.int64(bucket["bucket"].iloc[0]) << np.int64(32)) | rest.astype(np.int64)
        return _to_blocks(row, blocks, covered | edge, (start, count, np.where(edge, number, -1)))

    return sort


def _to_blocks(row: np.ndarray, blocks: int, chosen: np.ndarray, columns: tuple[np.ndarray, ...]) -> pd.DataFrame:
    chosen = np.flatnonzero(chosen)
    columns = tuple(x.astype(np.uint32) if x.max(initial=0) < 2**32 and x.min(initial=0) >= 0 else x for x in columns)
    block = row[chosen] % blocks
    # By row and first column within a block, so that the blobs pack well.
    order = np.lexsort((columns[0][chosen], row[chosen], block))
    chosen, block = chosen[order], block[order]
    found, first = np.unique(block, return_index=True)
    blobs = [pack(row[c], *(x[c] for x in columns)) for c in np.split(chosen, first[1:])] if len(chosen) else []
    return pd.DataFrame({"block": found.astype(np.int64), "found": pd.Series(blobs, dtype=object)})


def _found(frame: pd.DataFrame, width: int) -> tuple[np.ndarray, ...]:
    """The blobs of a block as columns sorted by row."""
    if not len(frame):
        return tuple(np.empty(0, np.int64) for _ in range(width))
    columns = [np.concatenate(c).astype(np.int64) for c in zip(*map(unpack, frame["found"]), strict=True)]
    order = np.argsort(columns[0], kind="stable")
    return tuple(c[order] for c in columns)


def _union(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Maximal runs of covered bytes, as rows (start, end)."""
    if not len(start):
        return np.empty((0, 2), np.int64)
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.append(True, start[1:] > reach[:-1])
    return np.stack([start[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1)]], axis=1)


def _kept(data: bytes, spans: np.ndarray) -> bytes:
    out, at = [], 0
    for begin, end in spans.tolist():
        out.append(data[at:begin])
        at = end
    return b"".join([*out, data[at:]])


def _whole_letters(data: bytes, spans: np.ndarray) -> np.ndarray:
    """The spans without the parts of letters at their ends."""
    out = []
    for begin, end in spans.tolist():
        while begin < end and data[begin] & 0xC0 == 0x80:
            begin += 1
        while end > begin and end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        if begin < end:
            out.append((begin, end))
    return np.array(out, np.int64).reshape(-1, 2)


def _finish(texts: pd.DataFrame, spans_of, keep: bool) -> pd.DataFrame:
    out = texts.drop(columns=["block", "row", "text"])
    rows = []
    for number, text in enumerate(texts["text"]):
        data = (text or "").encode()
        spans = spans_of(number)
        kept = _kept(data, spans)
        cut = _kept(data, _whole_letters(data, spans)).decode() if keep and len(spans) else text if keep else None
        rows.append((len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), cut, spans.ravel().tolist()))
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "removed"]
    return out.assign(**{n: [r[i] for r in rows] for i, n in enumerate(names)})


def remove_repeats(docs: DataFrame, min_bytes: int = 50, keep: tuple[str, ...] = (), keep_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed, and ``keep`` columns.

    A byte is removed if a string of ``min_bytes`` bytes that covers it also starts in a document with a
    smaller doc_id; strings are judged on the input and never cross documents. ``removed`` lists the
    maximal removed runs as start, end, start, end, ... With ``keep_text``, ``kept_text`` is the rest of the
    text, letters whose bytes are removed only in part staying whole.

    A null text is empty. A null doc_id comes after all others. Rows with one doc_id are one
    document to each other: they never remove each other's bytes. An empty table gives no rows.
    """
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "removed"]
    # Names a row in few bits: rows of one doc_id differ by their text's checksum.
    check = F.crc32(F.coalesce("text", F.lit("")))
    row: Column = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).bitwiseXOR(F.shiftleft(check, 31))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", row.alias("row"), *keep)
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits, blocks = _dealing(total)
    block = F.pmod("row", F.lit(blocks)).alias("block")
    runs = rows.select("row", "doc_id", "text").mapInArrow(_hash_runs(min_bytes, bits), "bucket int, runs binary")
    found = runs.groupBy("bucket").applyInPandas(_sort_bucket(blocks), "block long, found binary")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    passed = ", ".join(f"`{c}` {kinds[c]}" for c in ("doc_id", *keep))
    result = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string, removed array<long>"
    by_block = rows.withColumn("block", block).groupBy("block")

    def split(texts: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        """One row with the sure spans of a block, and the contents of undecided runs by bucket."""
        of, start, count, number = _found(marks, 4)
        sure = number < 0
        spans = [_union(start[own], start[own] + count[own] - 1 + min_bytes) for own in _by_row(of, sure)]
        names = np.repeat(np.unique(of[sure]), [len(s) for s in spans])
        both = np.concatenate(spans) if spans else np.empty((0, 2), np.int64)
        out: list[tuple] = [(None, None, pack(names, both[:, 0], both[:, 1]))] if len(names) else []
        ids, columns, data = [], [], []
        undecided = dict(zip(np.unique(of[~sure]).tolist(), _by_row(of, ~sure), strict=True))
        for row, doc, text in zip(texts["row"].tolist(), texts["doc_id"].tolist(), texts["text"], strict=True):
            own = undecided.pop(row, None)  # of repeated rows, one speaks for all
            if own is not None:
                whole_text = (text or "").encode()
                size = count[own] - 1 + min_bytes
                columns.append((np.full(len(own), len(ids)), number[own], start[own], size))
                ids.append((row, LAST if pd.isna(doc) else int(doc)))
                data += [whole_text[s : s + n] for s, n in zip(start[own], size, strict=True)]
        if ids:
            out += [(bucket, contents, None) for bucket, contents in _deal_contents(ids, columns, b"".join(data))]
        frame = pd.DataFrame(out, columns=["bucket", "contents", "found"], dtype=object)
        at = texts["block"].iloc[0] if len(texts) else marks["block"].iloc[0]
        return frame.assign(block=int(at))[["block", "bucket", "contents", "found"]]

    parts = by_block.cogroup(found.groupBy("block")).applyInPandas(
        split, "block long, bucket int, contents binary, found binary"
    )
    dealt = parts.filter("contents is not null").select("bucket", "contents")
    more = dealt.groupBy("bucket").applyInPandas(_sort_contents(min_bytes, blocks), "block long, found binary")
    marked = parts.filter("found is not null").select("block", "found").unionByName(more)
    whole = [c for c in keep if kinds[c] in ("bigint", "int")]

    def join(texts: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        of, start, end = _found(marks, 3)
        first, last = (np.searchsorted(of, texts["row"].to_numpy(), side) for side in ("left", "right"))

        def spans_of(i: int) -> np.ndarray:
            own = slice(first[i], last[i])
            return _union(start[own], end[own])

        texts = texts.astype({c: "Int64" for c in ("doc_id", *whole)})
        return _finish(texts, spans_of, keep_text)[["doc_id", *keep, *names]]

    # The texts are shuffled once: both passes over the blocks read the same exchange.
    out = by_block.cogroup(marked.groupBy("block")).applyInPandas(join, f"{passed}, {result}")
    return out if keep_text else out.drop("kept_text")


def _by_row(of: np.ndarray, chosen: np.ndarray) -> list[np.ndarray]:
    """The chosen positions of each row that has some; ``of`` is sorted."""
    at = np.flatnonzero(chosen)
    return np.split(at, np.flatnonzero(np.diff(of[at])) + 1) if len(at) else []


def _deal_contents(ids: list[tuple[int, int]], columns: list[tuple[np.ndarray, ...]], data: bytes) -> Iterator[tuple[int, bytes]]:
    """The contents of a block's undecided runs, packed by the bucket of their keys."""
    table = np.array(ids, np.int64)
    owner, number, start, size = (np.concatenate(c) for c in zip(*columns, strict=True))
    joined = np.frombuffer(data, np.uint8)
    offset = np.cumsum(size) - size
    bucket = number >> 32
    order = np.argsort(bucket, kind="stable")
    found, first = np.unique(bucket[order], return_index=True)
    for b, own in zip(found, np.split(order, first[1:]), strict=True):
        used, local = np.unique(owner[own], return_inverse=True)
        content = joined[aranges(offset[own], size[own])].tobytes()
        yield int(b), pack(table[used], local, number[own], start[own], size[own], content)


def _window_hashes(joined: np.ndarray, offset: np.ndarray, size: np.ndarray, n: np.ndarray, depth: int) -> np.ndarray:
    """Two hashes of each window of some contents; a key may have many contents, so few bytes are taken at once."""
    last = np.cumsum(n)
    out = np.empty((2, last[-1]), np.uint64)
    piece = np.cumsum(size) // CHUNK
    for few in np.split(np.arange(len(n)), np.flatnonzero(np.diff(piece)) + 1):
        content = joined[aranges(offset[few], size[few])]
        at_byte = aranges(np.cumsum(size[few]) - size[few], n[few])
        own = slice(last[few[0]] - n[few[0]], last[few[-1]])
        for which in (0, 1):
            out[which, own] = Rolling(content, which).spans(at_byte, at_byte + depth)
    return out


def _late(hashes: np.ndarray, doc: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which windows also lie in an earlier document; ``doc`` is each content's. Sorted by the hash's first digits, some at a time."""
    late = np.zeros(last[-1], bool)
    parts = int(last[-1]) // CHUNK + 1
    digit = ((hashes[0] >> np.uint64(48)) * np.uint64(parts) >> np.uint64(16)).astype(np.uint16)
    for part in range(parts):
        at = np.flatnonzero(digit == part)
        if not len(at):
            continue
        own, a, b = doc[np.searchsorted(last, at, side="right")], hashes[0][at], hashes[1][at]
        by = np.lexsort((own, b, a))
        own, a, b = own[by], a[by], b[by]
        fresh = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
        late[at[by]] = own > own[fresh][np.cumsum(fresh) - 1]
    return late


def _sort_contents(depth: int, blocks: int):
    """Last pass: the windows of contents that share a key, by two hashes of all their bytes."""

    def sort(bucket: pd.DataFrame) -> pd.DataFrame:
        tables, pieces, data, at = [], [], [], 0
        for blob in bucket["contents"]:
            table, local, number, start, size, joined = unpack(blob)
            tables.append(table)
            pieces.append((local + at, number, start, size))
            data.append(joined)
            at += len(table)
        table = np.concatenate(tables)
        local, number, start, size = (np.concatenate(c) for c in zip(*pieces, strict=True))
        joined = np.frombuffer(b"".join(data), np.uint8)
        del data
        offset = np.cumsum(size) - size
        row, doc = table[local, 0], table[local, 1]
        marks: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        # Keys in turn, some at a time, so that the bytes in memory stay few: a run has up to ``depth`` bytes a window.
        order = np.argsort(number, kind="stable")
        new = np.append(True, number[order][1:] != number[order][:-1])
        group = np.cumsum(new) - 1
        per_key = np.bincount(group, size[order])
        turn = (np.cumsum(per_key) // CHUNK).astype(np.int64)[group]
        for some in np.split(order, np.flatnonzero(np.diff(turn)) + 1):
            n = size[some] - depth + 1
            last = np.cumsum(n)  # the windows up to each content's end
            late = _late(_window_hashes(joined, offset[some], size[some], n, depth), doc[some], last)
            # Neighbouring windows of one run as one span.
            hit = np.flatnonzero(late)
            if len(hit):
                of = np.searchsorted(last, hit, side="right")
                cut = np.append(True, (hit[1:] != hit[:-1] + 1) | (of[1:] != of[:-1]))
                begin = np.flatnonzero(cut)
                end = np.append(begin[1:] - 1, len(hit) - 1)
                place = start[some[of]] + hit - (last - n)[of]
                marks.append((row[some[of[begin]]], place[begin], place[end] + depth))
        if not marks:
            return pd.DataFrame({"block": pd.Series(dtype="int64"), "found": pd.Series(dtype=object)})
        of, begin, end = (np.concatenate(c) for c in zip(*marks, strict=True))
        return _to_blocks(of, blocks, np.ones(len(of), bool), (begin, end))

    return sort


def cut_repeats(docs: DataFrame, min_bytes: int = 200) -> DataFrame:
    """The documents without their repeats, with the columns of ``docs``; n_chars is that of the rest.

    200 bytes are about 35 words, less than any passage of 50. Documents of which nothing is left go.
    """
    others = {f"carried_{i}": c for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    plain = docs.select("doc_id", "text", *[F.col(c).alias(n) for n, c in others.items()])
    out = remove_repeats(plain, min_bytes, tuple(others), keep_text=True)
    out = out.filter("not (n_removed > 0 and length(kept_text) = 0)")
    back = {c: F.col(n) for n, c in others.items()} | {"doc_id": F.col("doc_id"), "text": F.col("kept_text")}
    if "n_chars" in back:
        back["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(back["n_chars"])
    return out.select(*[back[c].cast(docs.schema[c].dataType).alias(c) for c in docs.columns])
