"""Exact, repeatable samples and stratified splits by hashed key order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.functions.text import quoted
from shelfwise.operators.joins import lookup_join
from shelfwise.session import settle

# Leading hex digits of the hash: 16**4 buckets per group.
BUCKET_DIGITS = 4


def key_hash(key: list[str], seed: int) -> Column:
    return F.md5(F.concat_ws("\x1f", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]))


def mark_smallest_hashes(
    df: DataFrame, by: list[str], key: list[str], quota: Column, seed: int, flag: str
) -> DataFrame:
    """Flag, per group, the ``quota`` rows with the smallest hash of ``key``.

    ``quota`` may use ``_total``, the row count of the group. The rows are stored once and then counted per distinct
    key, on the map side first. Running counts over hash buckets tell in which bucket the quota ends, and only the
    distinct keys of that bucket are ranked, copies as one key with a count. So a group is known by the key at which
    its quota ends, and a row is flagged by comparing its key with that one. Of the copies of that last key the first
    as stored are taken. Rows of a null group are not flagged.
    """
    stored = settle(df.withColumn("_hash", key_hash(key, seed)), "hashed")
    order = ["_hash", *key]
    copies = stored.groupBy(*dict.fromkeys([*by, *order])).agg(F.count(F.lit(1)).alias("_n"))
    ends = settle(_quota_ends(copies, by, order, quota), "quota_ends")
    file, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    placed = _with_group(stored.withColumns({"_file": file, "_row": row}), ends, by)
    position = F.struct(*order)
    last = F.coalesce(position == F.col("_end"), F.lit(False))
    inside = F.coalesce(F.col("_all") | (position < F.col("_end")), F.lit(False))
    if ends.filter("_take < _n").isEmpty():
        return placed.withColumn(flag, inside | last).select(*[F.col(quoted(c)) for c in df.columns], flag)
    # Copies of the last key: whole files first, then rows up to one in the file where the number is reached.
    split = placed.filter(last & (F.col("_take") < F.col("_n")))
    per_file = split.groupBy(*by, "_take", "_file").agg(F.count(F.lit(1)).alias("_here"))
    so_far = F.sum("_here").over(W.partitionBy(*by).orderBy("_file").rowsBetween(W.unboundedPreceding, W.currentRow))
    wanted = settle(
        per_file.withColumn("_left", F.least("_here", F.col("_take") - so_far + F.col("_here"))).select(*by, "_file", "_here", "_left"),
        "copies_per_file",
    )
    partly = wanted.filter("_left > 0 and _left < _here")
    rank = F.row_number().over(W.partitionBy(*by, "_file").orderBy("_row"))
    cut = lookup_join(split, partly.select(*by, "_file", "_left"), [*by, "_file"], "inner").withColumn("_rank", rank)
    rows = cut.filter("_rank = _left").select(*by, "_file", F.col("_row").alias("_until"))
    limits = wanted.filter("_left > 0").join(rows, [*by, "_file"], "left")
    limits = limits.select(*by, "_file", F.coalesce("_until", F.lit(2**62)).alias("_until"))
    marked = lookup_join(placed, limits, [*by, "_file"])
    whole = F.col("_take") >= F.col("_n")
    of_last = last & (whole | F.coalesce(F.col("_row") <= F.col("_until"), F.lit(False)))
    return marked.withColumn(flag, inside | of_last).select(*[F.col(quoted(c)) for c in df.columns], flag)


def _quota_ends(copies: DataFrame, by: list[str], order: list[str], quota: Column) -> DataFrame:
    """Per group: ``_all`` if its quota covers it, else the key ``_end`` at which it ends and how many of its ``_n`` copies count."""
    bucketed = copies.withColumn("_bucket", F.substring("_hash", 1, BUCKET_DIGITS))
    counts = settle(bucketed.groupBy(*by, "_bucket").agg(F.sum("_n").alias("_rows")), "hash_counts")
    whole = W.partitionBy(*by)
    running = whole.orderBy("_bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    totals = counts.groupBy(*by).agg(F.sum("_rows").alias("_total")).withColumn("_quota", quota)
    cuts = (
        counts.withColumns({"_until": F.sum("_rows").over(running), "_total": F.sum("_rows").over(whole)})
        .withColumn("_quota", quota)
        .filter((F.col("_until") - F.col("_rows") < F.col("_quota")) & (F.col("_quota") <= F.col("_until")))
        .select(*by, "_bucket", (F.col("_quota") - F.col("_until") + F.col("_rows")).alias("_rest"))
    )
    # One bucket per group: its distinct keys are ranked, whatever their numbers of copies.
    edge = bucketed.join(cuts, [*by, "_bucket"])
    ranked = W.partitionBy(*by, "_bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    reached = edge.withColumn("_sum", F.sum("_n").over(ranked))
    at_end = reached.filter((F.col("_sum") - F.col("_n") < F.col("_rest")) & (F.col("_rest") <= F.col("_sum"))).select(
        *by, F.struct(*order).alias("_end"), "_n", (F.col("_rest") - F.col("_sum") + F.col("_n")).alias("_take")
    )
    groups = totals.select(*by, (F.col("_quota") >= F.col("_total")).alias("_all"))
    if not by:
        return groups.crossJoin(F.broadcast(at_end)) if not at_end.isEmpty() else groups.select(
            "_all", F.lit(None).cast(copies.select(F.struct(*order)).dtypes[0][1]).alias("_end"), F.lit(0).cast("bigint").alias("_n"), F.lit(0).cast("bigint").alias("_take")
        )
    return groups.join(at_end, by, "left").fillna(0, ["_n", "_take"])


def _with_group(stored: DataFrame, ends: DataFrame, by: list[str]) -> DataFrame:
    """Every row with the end of its group; without groups that is one row."""
    if by:
        return lookup_join(stored, ends, by, stored=True)
    return stored.join(F.broadcast(ends.limit(1)), F.lit(True), "left")


def stratified_split(df: DataFrame, label: str, key: list[str], test_share: float, seed: int = 42) -> DataFrame:
    """``df`` with ``is_test``: per label exactly ``round(test_share * rows)`` rows are held out."""
    quota = F.round(F.lit(test_share) * F.col("_total")).cast("bigint")
    return mark_smallest_hashes(df, [label], key, quota, seed, "is_test")


def sample_rows(df: DataFrame, n: int, key: list[str], seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows, or all if there are fewer; the same rows for the same seed."""
    marked = mark_smallest_hashes(df, [], key, F.lit(n).cast("bigint"), seed, "_taken")
    return marked.filter("_taken").drop("_taken")
