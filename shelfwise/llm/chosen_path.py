"""N-gram Jaccard join by chosen paths: documents whose five-word shingle sets have a similarity of 0.8 or more.

Every document's shingle set is embedded in ``WIDTH`` minimum hashes, so that two sets agree in a coordinate
with the probability of their similarity. A run splits all sets along sampled coordinates: each node of the
run's tree samples coordinates at the rate 1 / (similarity * WIDTH), and a set goes on to the child of its own
value in each of them. Small nodes are leaves, whose members are compared; large ones are split again. A pair
of the threshold similarity shares a leaf of one run with a chance of at least 0.6 (0.35 below several splits); the
runs are repeated until the chance to miss it is below 2e-4 there, and 1e-8 elsewhere. A pair is judged in
the first leaf that it shares, by the exact sets. Large leaves are cut into blocks, and pairs of blocks are
separate work; links are counted and never written out as pairs. Near copies meet in large leaves of every run:
each set therefore belongs to the bundle of its largest leaf, pairs of one bundle are judged in that leaf alone,
and the blocks of other leaves that hold one bundle only are not compared with each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.components import components
from shelfwise.llm.rolling import Rolling, mix
from shelfwise.session import settle

SHINGLE = 5
WIDTH = 64
RUNS = 20
LEAF = 32
DEPTH = 4
DENSE = 0.75  # of the members above: a node that keeps as many is a leaf, whatever its size
BUNDLE = 64  # members at least of a leaf that makes a bundle
BLOCK = 512
CHUNK = 1 << 20
#: Pairs with fewer equal minimum hashes are not compared: five standard deviations below 0.8.
LEAST_EQUAL = int(WIDTH * 0.55)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, joined, and where each text's begin (one more at the end).

    Words are divided by ASCII white space. A text of fewer words than a shingle has one shingle of them all.
    """
    ends = np.cumsum([len(t) + 1 for t in texts])
    data = np.frombuffer(b"".join(t + b" " for t in texts), np.uint8)
    blank = SPACE[data]
    before = np.append(True, blank[:-1])
    begin, end = np.flatnonzero(~blank & before), np.flatnonzero(blank & ~before)
    word = Rolling(data).spans(begin, end) if len(begin) else np.empty(0, np.uint64)
    owner = np.searchsorted(ends, begin, side="right")
    words = np.bincount(owner, minlength=len(texts))
    turns = [np.uint64(pow(0x9E3779B97F4A7C15, j + 1, 1 << 64)) for j in range(size)]
    n = max(0, len(word) - size + 1)
    full = np.zeros(n, np.uint64)
    for j in range(size):
        full += word[j : j + n] * turns[j]
    whole = np.flatnonzero(owner[:n] == owner[size - 1 : size - 1 + n]) if n else np.empty(0, np.int64)
    value, of = [mix(full[whole])], [owner[whole]]
    first = np.cumsum(words) - words
    for d in np.flatnonzero((words > 0) & (words < size)):
        own = word[first[d] : first[d] + words[d]]
        total = sum(int(w) * int(t) for w, t in zip(own, turns, strict=False)) + int(words[d])
        value.append(mix(np.array([total % (1 << 64)], np.uint64)))
        of.append(np.array([d]))
    value, of = np.concatenate(value), np.concatenate(of).astype(np.int64)
    order = np.lexsort((value, of))
    value, of = value[order], of[order]
    new = np.append(True, (value[1:] != value[:-1]) | (of[1:] != of[:-1])) if len(value) else np.empty(0, bool)
    return value[new], np.searchsorted(of[new], np.arange(len(texts) + 1))


def set_ids(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set; the empty set is 0."""
    sums = np.append(np.uint64(0), np.cumsum(mix(values ^ np.uint64(0xD6E8FEB86659FD93))))
    total = sums[bounds[1:]] - sums[bounds[:-1]]
    return np.where(np.diff(bounds) > 0, mix(total + np.diff(bounds).astype(np.uint64)), 0).astype(np.uint64).view(np.int64)


def minimum_hashes(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """``WIDTH`` minimum hashes of each set, as 32-bit numbers; those of the empty set are 0."""
    out = np.zeros((len(bounds) - 1, WIDTH), np.int32)
    some = np.flatnonzero(np.diff(bounds) > 0)
    if len(some):
        for i in range(WIDTH):
            seed = np.uint64(pow(0xC2B2AE3D27D4EB4F, i + 1, 1 << 64))
            h = values ^ seed
            h *= seed | np.uint64(1)
            h ^= h >> np.uint64(32)
            h *= np.uint64(0x9E3779B97F4A7C15)
            out[some, i] = (np.minimum.reduceat(h, bounds[:-1][some]) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of the batches with about ``CHUNK`` bytes of text each."""
    for batch in batches:
        held, first, texts = 0, 0, []
        for number, text in enumerate(batch["text"]):
            texts.append((text.as_py() or "").encode())
            held += len(texts[-1])
            if held >= CHUNK or number == len(batch) - 1:
                yield batch.slice(first, number + 1 - first), texts
                held, first, texts = 0, number + 1, []


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in _chunks(batches):
        values, bounds = shingle_sets(texts)
        hashes = minimum_hashes(values, bounds)
        offsets = np.arange(len(texts) + 1, dtype=np.int32) * WIDTH
        yield pa.record_batch(
            {
                "doc_id": part["doc_id"],
                "row": part["row"],
                "sid": pa.array(set_ids(values, bounds)),
                "sig": pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes.ravel())),
            }
        )


def _dense(members: DataFrame) -> DataFrame:
    """key: the nodes whose children would keep ``DENSE`` of the members in the mean of all coordinates.

    One bit of each minimum hash, as ``_low_bits`` has them, is counted as 1 or -1. Members that differ cancel out and
    equal ones add up, so the mean's size is the share of the most frequent value; no value is kept.
    """
    shares = [F.abs(F.avg(1 - 2 * F.shiftrightunsigned("bits", i).bitwiseAND(1))) for i in reversed(range(WIDTH))]
    total = sum(shares[1:], shares[0])
    return members.groupBy("key").agg(total.alias("kept")).filter(F.col("kept") >= DENSE * WIDTH).select("key")


def _low_bits() -> Column:
    """The lowest bit of each minimum hash, in one number: paths carry it, so that no signature is joined to them."""
    return F.aggregate("sig", F.lit(0).cast("long"), lambda bits, h: F.shiftleft(bits, 1).bitwiseOR(h.bitwiseAND(1)))


def _leaves(reps: DataFrame) -> DataFrame:
    """key, sid, m: the leaves of all runs that have two members or more, and their sizes."""
    rate = 1 / (0.8 * WIDTH)
    roots = []
    for run in range(RUNS):
        chance = np.random.default_rng([20, run]).random(WIDTH)
        roots += [(run, i) for i in np.flatnonzero(chance < max(rate, chance.min() + 1e-12)).tolist()]
    split = F.explode(F.array(*[F.xxhash64(F.lit(run), F.lit(i), F.col("sig")[i]) for run, i in roots]))
    signs = reps.select("sid", "sig")
    marked = reps.select("sid", "sig", _low_bits().alias("bits"))  # once per set, not per path
    rows = settle(marked.select("sid", "bits", split.alias("key"), F.lit(None).cast("long").alias("above")), "paths")
    leaves = None
    for depth in range(1, DEPTH + 1):
        counts = rows.groupBy("key").agg(F.count("*").alias("m"), F.first("above").alias("above")).filter("m > 1")
        # A node that kept nearly all members of the one above holds near copies: splitting it again would only
        # repeat them.
        dense = F.coalesce(F.col("m") >= DENSE * F.col("above"), F.lit(False))
        ends = F.lit(depth == DEPTH) | (F.col("m") <= LEAF) | dense
        sizes = settle(counts.select("key", "m", ends.alias("ends")), "path-sizes")
        if depth == 1:
            # A root's child has no node above to be compared with: its members tell how many of them a child would keep.
            near = _dense(rows.join(sizes.filter("not ends").select("key"), "key"))
            told = sizes.join(near.withColumn("near", F.lit(True)), "key", "left")
            sizes = settle(told.select("key", "m", (F.col("ends") | F.col("near").isNotNull()).alias("ends")), "path-sizes")
        found = rows.select("key", "sid").join(sizes.filter("ends").select("key", "m"), "key")
        leaves = found if leaves is None else leaves.unionByName(found)
        large = sizes.filter("not ends").select("key", F.col("m").alias("above"))
        if depth == DEPTH or large.isEmpty():
            break
        chosen = F.filter(
            F.sequence(F.lit(0), F.lit(WIDTH - 1)),
            lambda i: F.shiftrightunsigned(F.xxhash64("node.key", i), 11) / F.lit(float(2**53)) < rate,
        )
        child = F.explode(F.transform(chosen, lambda i: F.xxhash64("node.key", i, F.element_at("sig", i + 1))))
        # All nodes of a set together, so that its signature is moved once and not once per node: a near copy is in many.
        nodes = rows.select("key", "sid").join(large, "key").groupBy("sid").agg(F.collect_list(F.struct("key", "above")).alias("nodes"))
        members = nodes.join(signs, "sid").select("sid", "sig", F.explode("nodes").alias("node"))
        rows = settle(members.select("sid", child.alias("key"), F.col("node.above").alias("above")), "paths")
    return settle(leaves.select("key", "sid", "m"), "leaves")


def _bundle() -> Column:
    """The largest of a set's leaves, if it is large at all."""
    size = F.struct("m", "key")
    return F.max_by(F.when(F.col("m") > BUNDLE, F.col("key")), size)


def _parts(leaves: DataFrame) -> DataFrame:
    """The leaves' members with their bundle and how their leaf is cut: ``majors`` blocks of its most frequent bundle
    (``major`` members, in their ``own`` leaf or not) and ``rests`` blocks of all others. Leaves of one bundle alone
    have no pair left to judge but their own."""
    bundles = leaves.filter(F.col("m") > BUNDLE).groupBy("sid").agg(_bundle().alias("bundle"))
    rows = leaves.join(bundles, "sid", "left")
    counts = rows.filter((F.col("m") > LEAF) & F.col("bundle").isNotNull()).groupBy("key", "bundle").agg(F.count("*").alias("n"))
    most = counts.groupBy("key").agg(F.max(F.struct("n", "bundle")).alias("most")).select("key", "most.*").withColumnRenamed("bundle", "top")
    major = F.coalesce(F.col("bundle") == F.col("top"), F.lit(False))
    n = F.coalesce("n", F.lit(0))
    blocks = [F.ceil(c / BLOCK).cast("long").alias(a) for c, a in ((n, "majors"), (F.col("m") - n, "rests"))]
    cut = rows.join(most, "key", "left").select("sid", "bundle", "key", *blocks, major.alias("major"), (F.col("key") == F.col("top")).alias("own"))
    return cut.withColumn("own", F.coalesce("own", F.lit(False)))


def _rows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple]:
    """The rows of sorted batches: cell, block, sid, copies, keys, the sig or the set, and the bundle."""
    for batch in batches:
        cells = zip(batch["key"].to_pylist(), batch["lo"].to_pylist(), batch["hi"].to_pylist(), strict=True)
        keys = [np.asarray(k.values) for k in batch["keys"]]
        if width:
            last = batch["sig"].flatten().to_numpy().reshape(-1, width)
        else:
            last = [np.frombuffer(s.as_py(), np.uint64) for s in batch["shingles"]]
        plain = [batch[c].to_pylist() for c in ("mine", "sid", "copies")]
        yield from zip(cells, *plain, keys, last, batch["bundle"].to_pylist(), strict=True)


def _met_before(key: int, left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Whether two members share an earlier leaf than ``key``."""
    a, b = ([k[k < key] for k in side] for side in (left, right))
    common = np.intersect1d(np.concatenate(a), np.concatenate(b))
    if not len(common):
        return np.zeros((len(left), len(right)), bool)

    def members(side: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(side), len(common)), np.float32)
        for row, own in enumerate(side):
            out[row, np.searchsorted(common, own[np.isin(own, common)])] = 1
        return out

    return members(a) @ members(b).T > 0


def _sides(cell: tuple, rows: list[tuple]) -> tuple[list[tuple], list[tuple], np.ndarray]:
    """The two blocks of a cell, and which pairs of them are to be judged in it."""
    key, lo, hi = cell
    left = [r for r in rows if r[1] == lo]
    right = left if lo == hi else [r for r in rows if r[1] == hi]
    if not left or not right:
        return left, right, np.zeros((len(left), len(right)), bool)
    # Bundles by number: those without one differ from all others.
    names = {b: i for i, b in enumerate({r[6] for r in left + right if r[6] is not None})}
    a, b = (np.array([names.get(r[6], none) for r in side]) for side, none in ((left, -1), (right, -2)))
    own = names.get(key, -3)
    same = a[:, None] == b[None, :]
    pairs = np.where(same, (a == own)[:, None], True)
    if (pairs & ~same).any():
        pairs &= same | ~_met_before(key, [r[4] for r in left], [r[4] for r in right])
    return left, right, np.triu(pairs, 1) if lo == hi else pairs


def _select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of each cell that may have a link there."""
    names = ["key", "lo", "hi", "mine", "sid"]
    out: list[tuple] = []
    for cell, rows in groupby(_rows(batches, WIDTH), key=lambda r: r[0]):
        rows = list(rows)
        if len(rows) > 1:
            left, right, pairs = _sides(cell, rows)
            if pairs.any():
                a, b = (np.stack([r[5] for r in side]) for side in (left, right))
                equal = np.zeros(pairs.shape, np.uint8)
                for i in range(WIDTH):
                    equal += a[:, i, None] == b[None, :, i]
                pairs &= equal >= LEAST_EQUAL
                chosen = {(left[i][1], left[i][2]) for i in np.flatnonzero(pairs.any(axis=1))}
                chosen |= {(right[i][1], right[i][2]) for i in np.flatnonzero(pairs.any(axis=0))}
                out += [(*cell, *c) for c in sorted(chosen)]
        if len(out) >= 4096:
            yield _longs(names, out)
            out = []
    yield _longs(names, out)


def _longs(names: list[str], rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=names)


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two sets share, by bits of the shingles that occur on both sides."""
    both = np.intersect1d(np.concatenate(left), np.concatenate(right))

    def bits(side: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(side), len(both) + 1), bool)
        for row, own in enumerate(side):
            place = np.minimum(np.searchsorted(both, own), max(0, len(both) - 1))
            out[row, place[both[place] == own] if len(both) else []] = True
        packed = np.packbits(out, axis=1)
        return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)

    a, b = bits(left), bits(right)
    return np.stack([np.bitwise_count(row & b).sum(axis=1, dtype=np.int64) for row in a])


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sid, links, parent: the links found in each cell, and tree edges that connect what is linked."""
    names = ["sid", "links", "parent"]
    out: list[tuple] = []
    for cell, rows in groupby(_rows(batches, 0), key=lambda r: r[0]):
        left, right, pairs = _sides(cell, list(rows))
        if pairs.any():
            sizes = [np.array([len(r[5]) for r in side]) for side in (left, right)]
            common = _common([r[5] for r in left], [r[5] for r in right])
            union = sizes[0][:, None] + sizes[1][None, :] - common
            link = pairs & (5 * common >= 4 * union)
            copies = [np.array([r[3] for r in side]) for side in (left, right)]
            for side, counts in ((left, link @ copies[1]), (right, link.T @ copies[0])):
                out += [(r[2], int(n), None) for r, n in zip(side, counts, strict=True) if n]
            out += _forest([r[2] for r in left], [r[2] for r in right], link)
        if len(out) >= 4096:
            yield _longs(names, out)
            out = []
    yield _longs(names, out)


def _forest(left: list[int], right: list[int], link: np.ndarray) -> list[tuple]:
    sids = sorted(set(left) | set(right))
    number = {s: i for i, s in enumerate(sids)}
    near = np.zeros((len(sids), len(sids)), bool)
    a, b = (np.array([number[s] for s in side]) for side in (left, right))
    i, j = np.nonzero(link)
    near[a[i], b[j]] = near[b[j], a[i]] = True
    new, out = np.ones(len(sids), bool), []
    for root in range(len(sids)):
        waiting = [root] if new[root] else []
        new[root] = False
        while waiting:
            at = waiting.pop()
            found = np.flatnonzero(near[at] & new)
            new[found] = False
            waiting += found.tolist()
            out += [(sids[f], 0, sids[at]) for f in found]
    return out


def _by_cell(df: DataFrame) -> DataFrame:
    return df.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")


def join_near(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, sid, class_id, n_links.

    ``n_links`` counts the other documents whose similarity is 0.8 or more, copies included; ``class_id`` is
    the smallest doc_id among all that are connected by links. ``sid`` names the shingle set: documents
    of equal sets are linked. Texts without words, null ones among them, are equal to each other. A
    text of fewer than five words has one shingle. Repeated rows are documents of their own. Null ids count
    as larger than others. An empty table gives no rows. Only doc_id and text are read.
    """
    return _classes(docs).drop("root")


def _classes(docs: DataFrame) -> DataFrame:
    """The columns of ``join_near`` and root, which tells classes apart that share a class_id, or have none."""
    doc_id = F.col("doc_id").cast("long")
    # Ids may be null or have several texts; the row's hash finds the text of a set.
    rows = docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, F.coalesce("text", F.lit(""))).alias("row"), "text")
    signed = settle(rows.mapInArrow(_sign, "doc_id long, row long, sid long, sig array<int>"), "near-signed")
    own = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("own")
    reps = settle(
        signed.groupBy("sid")
        .agg(own, F.count("*").alias("copies"), F.first("sig").alias("sig"))
        .select("sid", F.col("own.doc_id").alias("rep"), F.col("own.row").alias("rep_row"), "copies", "sig"),
        "near-sets",
    )
    leaves = _leaves(reps.filter("sid <> 0"))
    homes = (
        _parts(leaves)
        .groupBy("sid", "bundle")
        .agg(F.collect_set(F.struct("key", "majors", "rests", "major", "own")).alias("homes"))
        .join(reps, "sid")
    )
    last = F.col("home.majors") + F.col("home.rests") - 1
    mixed = F.xxhash64("sid", "home.key")
    mine = F.when(F.col("home.major"), F.pmod(mixed, "home.majors")).otherwise(F.col("home.majors") + F.pmod(mixed, "home.rests"))
    # Blocks of one bundle meet the others, and each other only in their own leaf.
    first = F.when(F.col("home.major") & ~F.col("home.own"), F.col("home.majors")).otherwise(F.lit(0).cast("long"))
    cells = (
        homes.select("sid", "copies", "sig", "bundle", F.array_sort("homes.key").alias("keys"), F.explode("homes").alias("home"))
        .filter(first <= last)
        .select("*", mine.alias("mine"), F.explode(F.sequence(first, last)).alias("other"))
        .select(
            F.col("home.key").alias("key"), F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"),
            "mine", "sid", "copies", "keys", "bundle", "sig",
        )
    )
    place = "key long, lo long, hi long, mine long, sid long"
    chosen = settle(_by_cell(cells).mapInArrow(_select, place), "near-chosen")
    wanted = (
        chosen.groupBy("sid")
        .agg(F.collect_list(F.struct("key", "lo", "hi", "mine")).alias("cells"))
        .join(leaves.groupBy("sid").agg(F.array_sort(F.collect_set("key")).alias("keys"), _bundle().alias("bundle")), "sid")
        .join(reps.select("sid", "rep_row", "copies"), "sid")
    )
    texts = rows.join(wanted, F.col("row") == F.col("rep_row")).select("text", "sid", "copies", "keys", "bundle", "cells")

    carried = ["sid", "copies", "keys", "bundle", "cells"]

    def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _chunks(batches):
            values, bounds = shingle_sets(texts)
            # Another text with the same hash is not the set's own.
            right = set_ids(values, bounds) == part["sid"].to_numpy()
            own = [values[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            keep = part.filter(pa.array(right))
            yield pa.record_batch(
                [*(keep[c] for c in carried), pa.array([s for s, r in zip(own, right, strict=True) if r], pa.binary())],
                names=[*carried, "shingles"],
            )

    cell = "array<struct<key:long,lo:long,hi:long,mine:long>>"
    # Repeated rows of the set's own document give the same set; one is enough.
    sets = texts.mapInArrow(with_sets, f"sid long, copies long, keys array<long>, bundle long, cells {cell}, shingles binary").dropDuplicates(["sid"])
    laid = sets.select("sid", "copies", "keys", "bundle", "shingles", F.inline("cells"))
    judged = settle(_by_cell(laid).mapInArrow(_judge, "sid long, links long, parent long"), "near-judged")
    links = judged.groupBy("sid").agg(F.sum("links").alias("links"))
    roots = components(judged.filter("parent is not null").select(F.col("sid").alias("u"), F.col("parent").alias("v")))
    rooted = (
        reps.select("sid", "rep", "copies")
        .join(roots.select(F.col("u").alias("sid"), F.col("v").alias("root")), "sid", "left")
        .join(links, "sid", "left")
        .withColumn("root", F.coalesce("root", "sid"))
    )
    smallest = rooted.groupBy("root").agg(F.min("rep").alias("class_id"))
    classes = rooted.join(smallest, "root").select(
        "sid", "root", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    return signed.select("doc_id", "sid").join(classes, "sid").select("doc_id", "sid", "root", "class_id", "n_links")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each class of near copies, the one with the smallest doc_id; columns as in ``docs``.

    Of rows that share that id within a class, the one with the smallest row hash stays. Classes are told apart by their
    links, not by that id: two unrelated texts with one id, or without, both stay.
    """
    first = _classes(docs).filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).select("doc_id", "root", "sid").distinct()
    key = "near_row"
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce("text", F.lit("")), *[F.col(c) for c in docs.columns if c != "text"]))
    # Ids are unique in ordinary tables; ids with several rows are settled by the rows' hashes.
    repeated = docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id")
    single = keyed.join(repeated.withColumnRenamed("doc_id", "near_id"), F.col("doc_id").eqNullSafe(F.col("near_id")), "left_anti")
    ids = first.select(F.col("doc_id").alias("near_id")).distinct()
    kept = single.join(ids, F.col("doc_id").eqNullSafe(F.col("near_id")), "left_semi").drop(key)
    if repeated.isEmpty():
        return kept
    several = keyed.join(repeated.withColumnRenamed("doc_id", "near_id"), F.col("doc_id").eqNullSafe(F.col("near_id")), "left_semi")
    named = several.select(key, F.col("doc_id").cast("long").alias("named_id"), "text").mapInArrow(
        _name_rows, f"{key} long, named_id long, sid long"
    )
    best = (
        named.join(first, (named["sid"] == first["sid"]) & F.col("named_id").eqNullSafe(F.col("doc_id")))
        .groupBy("root")
        .agg(F.min(key).alias(key))
        .select(key)
    )
    return kept.unionByName(several.join(best, key, "left_semi").dropDuplicates([key]).drop(key))


def _name_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in _chunks(batches):
        sids = pa.array(set_ids(*shingle_sets(texts)))
        yield pa.record_batch({"near_row": part["near_row"], "named_id": part["named_id"], "sid": sids})
