"""Exact top-k search by no-random-access aggregation over sorted lists, in blocks of queries and candidates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import settle

SAFE = 2.0**50  # up to here float64 sums of whole numbers, and of their gaps, are exact
NO_FLOOR = -(2**63)  # scores are never below
STEPS = 4  # parts in which a list is read
RESOLVED = 8  # reading ends when no more than this part of the items are candidates


class SortedLists:
    """A cell's items as one ascending list a component: ``order`` names the items, ``values`` what they hold there."""

    def __init__(self, items: np.ndarray) -> None:
        self.items = items
        self.order = np.argsort(items, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(items.T, self.order, axis=1)
        kind = np.int16 if len(items) < 1 << 15 else np.int32
        self.place = np.empty(items.shape, kind)
        np.put_along_axis(self.place, self.order.T, np.arange(len(items), dtype=kind)[:, None], axis=0)

    def top(self, weights: np.ndarray, k: int, own: int, tie: np.ndarray, floor: int | None = None) -> tuple[np.ndarray, int]:
        """The positions of the k best inner products with ``weights``, best first, and how many entries were read.

        Lists of positive weight are read from the high end, of negative weight from the low end, a part at a time, always
        the one whose unread rest leaves the widest gap between what it can add at most and at least. An item's lower bound
        is what was read of it, and the far ends of the other lists; its upper bound exceeds that by the gaps of the
        lists in which it was not read. Items never met have one common upper bound: once it is below the k-th best
        lower bound, only items met so far stay, and each whose upper bound falls below goes for good. When few are
        left, or nothing is unread, their scores are resolved. ``own`` is the query's own position or -1, ``tie``
        orders items of equal score. Items below ``floor`` may be left out.
        """
        n = len(self.items)
        high = weights > 0
        far = np.where(high, self.values[:, 0], self.values[:, -1])
        gap = weights * (np.where(high, self.values[:, -1], self.values[:, 0]) - far)
        least = (weights * far).sum()
        lower = np.full(n, least, self.items.dtype)
        depth = np.zeros(len(weights), np.int64)
        met, alive, all_met = np.zeros(n, bool), np.ones(n, bool), False
        if own >= 0:
            alive[own] = False
        part, read, closed, unread = -(-n // STEPS), 0, False, gap.sum()
        while unread > 0:
            goal = unread - unread // 3
            while unread > 0 and unread >= goal:
                j = int(gap.argmax())
                begin = int(depth[j])
                end = min(n, begin + part)
                span = slice(n - end, n - begin) if high[j] else slice(begin, end)
                entries, values = self.order[j, span], self.values[j, span]
                lower[entries] += weights[j] * (values - far[j])
                if not all_met:
                    met[entries] = True
                depth[j], read = end, read + end - begin
                all_met = all_met or end == n
                rest = weights[j] * ((values[0] if high[j] else values[-1]) - far[j]) if end < n else 0
                unread += rest - gap[j]
                gap[j] = rest
            candidates = np.flatnonzero(alive & met)
            if len(candidates) < k and floor is None:
                continue
            low = lower[candidates]
            reached = floor
            if len(low) >= k:
                own_kth = np.partition(low, len(low) - k)[len(low) - k]
                reached = own_kth if floor is None else max(floor, own_kth)
            if not closed and least + unread < reached:
                closed = True
                alive &= met
            if closed:
                place = self.place[candidates]
                first, last = np.where(high, n - depth, 0), np.where(high, n, depth)
                seen = (place >= first.astype(place.dtype)) & (place < last.astype(place.dtype))
                alive[candidates[low + (unread - seen @ gap) < reached]] = False
                if np.count_nonzero(alive) <= max(k, n // RESOLVED):
                    break
        candidates = np.flatnonzero(alive)
        scores = self.items[candidates] @ weights
        if len(scores) > k:
            some = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            candidates, scores = candidates[some], scores[some]
        best = sorted(range(len(candidates)), key=lambda i: (-scores[i], tie[candidates[i]]))[:k]
        return candidates[best], read


def nra_top(
    queries: np.ndarray, items: np.ndarray, k: int, skip: np.ndarray, tie: np.ndarray, floors: list[int | None] | None = None
) -> list[np.ndarray]:
    """For each query, positions in ``items`` of its k best inner products, by sequential reads of sorted lists."""
    lists = SortedLists(items)
    floors = floors or [None] * len(queries)
    return [lists.top(q, k, int(own), tie, floor)[0] for q, own, floor in zip(queries, skip, floors, strict=True)]


def _longs(scores: np.ndarray) -> np.ndarray:
    """Scores as longs; those beyond the range are held at its ends."""
    return np.clip(scores, -(2**63), 2**63 - 1).astype(np.int64) if scores.dtype == object else scores.astype(np.int64)


def _search_cells(cells: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    for cell in cells:
        queries, items = cell[cell["is_query"]], cell[~cell["is_query"]]
        if not len(queries) or not len(items):
            continue
        width = max(map(len, cell["vector"]))

        def matrix(rows: pd.DataFrame) -> np.ndarray:
            if all(len(v) == width for v in rows["vector"]):
                return np.stack(rows["vector"].to_numpy())
            out = np.zeros((len(rows), width))
            for at, v in enumerate(rows["vector"]):
                out[at, : len(v)] = v
            return out

        q, x = matrix(queries), matrix(items)
        # Smaller ids first, so that position breaks ties; null ids last.
        tie = np.argsort(np.argsort(items["vec_id"].fillna(np.inf).to_numpy(), kind="stable"), kind="stable")
        place = {row: at for at, row in enumerate(items["row"])}
        skip = np.array([place.get(row, -1) for row in queries["row"]], dtype=np.int64)
        if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * width >= SAFE:
            # float64 could round: whole Python numbers go through the same lists.
            q, x = (np.vectorize(int, otypes=[object])(side) for side in (q, x))
        floors = [None if f == NO_FLOOR else int(f) for f in queries["floor"]]
        best = [(at, _longs(x[at] @ query)) for query, at in zip(q, nra_top(q, x, k, skip, tie, floors), strict=True)]
        times = [len(at) for at, _ in best]
        at = np.concatenate([at for at, _ in best])
        yield pd.DataFrame(
            {
                "row": np.repeat(queries["row"].to_numpy(), times),
                "query_id": np.repeat(queries["vec_id"].to_numpy(), times),
                "vec_id": items["vec_id"].to_numpy()[at],
                "score": np.concatenate([s for _, s in best]),
            }
        )


def top_k(
    vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256, query_block: int = 1024, item_block: int = 8192
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best inner products among all other rows.

    Components become floor(scale * x). Queries are the rows whose vec_id is divisible by ``every``; ties go to
    the smaller vec_id (null last). Null vectors and vectors with null or non-finite components take no
    part; of vectors of unlike length, the missing components count as 0. A row is never its own result,
    another row with the same vec_id may be. Scores beyond the range of a long are held at its ends. An
    empty table, or one without queries, gives no rows.

    Both sides are cut into blocks of bounded size; each pair of blocks is one cell of the search. The first block of
    items is searched before the others: the k-th best score there is a floor for theirs. The work is that of
    all pairs of a query and a row, less what the bounds leave unread (about half of the entries, where components are random).
    """
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    rows = settle(
        vectors.filter(F.col("embedding").isNotNull() & ~bad)
        .select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("vector"))
        .withColumn("row", F.monotonically_increasing_id()),
        "topk-rows",
    )
    is_query = F.coalesce(F.pmod("vec_id", F.lit(every)) == 0, F.lit(False))
    size = rows.agg(F.count("*").alias("items"), F.count_if(is_query).alias("queries")).first()
    item_blocks = -(-size["items"] // item_block) or 1
    query_blocks = -(-size["queries"] // query_block) or 1
    mixed = F.xxhash64("row")
    # The smaller side is copied to each block of the other: rows times blocks, not rows times rows.
    schema = "row long, query_id long, vec_id long, score long"

    def search(cell: pd.DataFrame) -> pd.DataFrame:
        out = list(_search_cells(iter([cell]), k))
        return out[0] if out else pd.DataFrame({c.split()[0]: pd.Series(dtype="int64") for c in schema.split(", ")})

    def cells(first: int, last: int, floors: DataFrame | None) -> DataFrame:
        """The best of each query in the item blocks from ``first`` to ``last``."""
        none, own = F.lit(NO_FLOOR), rows.filter(is_query)
        own = own.withColumn("floor", none) if floors is None else own.join(floors, "row", "left").withColumn("floor", F.coalesce("floor", none))
        every = [F.explode(F.sequence(F.lit(a).cast("long"), F.lit(b).cast("long"))) for a, b in ((first, last), (0, query_blocks - 1))]
        queries = own.select(
            F.lit(True).alias("is_query"), "row", "vec_id", "vector", "floor", F.pmod(mixed, F.lit(query_blocks)).alias("qb"), every[0].alias("ib")
        )
        items = rows.select(
            F.lit(False).alias("is_query"), "row", "vec_id", "vector", none.alias("floor"),
            every[1].alias("qb"), F.pmod(mixed, F.lit(item_blocks)).alias("ib"),
        ).filter(F.col("ib").between(first, last))
        return queries.unionByName(items).groupBy("qb", "ib").applyInPandas(search, schema)

    found = cells(0, 0, None)
    if item_blocks > 1:
        found = settle(found, "topk-first")
        floors = found.groupBy("row").agg(F.count("*").alias("n"), F.min("score").alias("floor")).filter(F.col("n") >= k).select("row", "floor")
        found = found.unionByName(cells(1, item_blocks - 1, floors))
    best = Window.partitionBy("row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


COMPARISON = """
with rows_ as (
    select row_number() over () as row_, vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
    from embeddings
    where embedding is not null
        and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), scored as (
    select q.row_ as row_, q.vec_id as query_id, i.vec_id, cast(list_inner_product(cast(q.v as double[]), cast(i.v as double[])) as bigint) as score
    from rows_ q join rows_ i on q.row_ <> i.row_
    where q.vec_id % 50 = 0
), ranked as (
    select *, row_number() over (partition by row_ order by score desc, vec_id) as rank from scored
)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 5
"""
