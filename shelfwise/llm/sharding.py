"""Sharding by sampled splitters: equal bytes per shard, equal texts together, no group in one task.

Records are ordered by (hash of the text, doc_id). A size-weighted sample of the keys gives quantile
boundaries of many fine ranges; ranges that turn out overfull are sampled again, more densely, and
subdivided. Running sums inside the ranges and over their totals then place each record exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import settle

LOWEST = -(2**63)
CELL_BITS = 12
SAMPLES_PER_RANGE = 8
REFINEMENTS = 4


def _uniform(*columns: Column) -> Column:
    """A number in [0, 1) that only depends on the columns."""
    return (F.shiftrightunsigned(F.xxhash64(*columns), 11)) / F.lit(float(2**53))


def _new_splitters(ranged: DataFrame, overfull: DataFrame, rate: float, per_piece: float) -> DataFrame:
    """Boundaries inside the overfull ranges, about one per ``per_piece`` bytes, from a size-weighted sample."""
    weight = F.greatest(F.lit(1.0), F.col("size") * rate)
    running = Window.partitionBy("range").orderBy("key", "cut")
    return (
        ranged.join(F.broadcast(overfull), "range")
        .filter(_uniform(F.col("key"), F.col("doc_id"), F.lit(17)) < F.col("size") * rate)
        .select("range", "key", "cut", F.sum(weight).over(running).alias("w"))
        .groupBy("range", F.floor(F.col("w") / (per_piece * rate)).alias("piece"))
        .agg(F.min(F.struct("key", "cut")).alias("s"))
        .filter("piece > 0")
        .select("s.key", "s.cut")
        .distinct()
    )


def _assign(rows: DataFrame, splitters: DataFrame) -> DataFrame:
    """``range``: the number of splitters at or below the record's key.

    The splitters are dealt into 4096 cells of the key space, so a record compares with its own cell's only.
    """
    shift = 64 - CELL_BITS
    half = 2 ** (CELL_BITS - 1)
    cells = (
        rows.sparkSession.range(-half, half)
        .withColumnRenamed("id", "cell")
        .join(
            splitters.groupBy(F.shiftright("key", shift).alias("cell")).agg(
                F.collect_list(F.struct("key", "cut")).alias("own")
            ),
            "cell",
            "left",
        )
        .withColumn("own", F.coalesce("own", F.array().cast("array<struct<key:bigint,cut:bigint>>")))
        .withColumn(
            "below",
            F.sum(F.size("own")).over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)),
        )
    )
    at_or_below = F.filter(
        "own", lambda s: (s["key"] < F.col("key")) | ((s["key"] == F.col("key")) & (s["cut"] <= F.col("cut")))
    )
    # At most 4096 cells and as many splitters as there are ranges: a bounded broadcast.
    return (
        rows.withColumn("cell", F.shiftright("key", shift))
        .join(F.broadcast(cells), "cell")
        .withColumn("range", F.coalesce("below", F.lit(0)) + F.size(at_or_below))
        .drop("cell", "own", "below")
    )


def shard_documents(
    docs: DataFrame, shards: int = 16, fine_ranges: int = 512, rows_per_range: int = 1_000_000, whole_group: float = 0.005
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the UTF-8 bytes of the text plus 1 (null: 1). The law is ``bytes``: the shards' sizes are
    equal up to about a document. Rows of equal texts (null counts as empty) are neighbours and share a
    shard, unless they weigh more than ``whole_group`` of a shard: such groups are cut where the boundary
    falls. ``slot`` counts from 0 in each shard without gaps. Nulls, repeated rows and repeated ids are
    ordinary rows; an empty table gives no rows. Other columns are not read.
    """
    text = F.coalesce("text", F.lit(""))
    base = settle(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("key"),
        ),
        "shard-base",
    )
    stats = base.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count("*").alias("rows")).first()
    total = max(1, stats["bytes"])
    ranges = max(fine_ranges, -(-stats["rows"] // rows_per_range))
    fair = total / ranges
    # At most shards / whole_group groups can be this heavy: a bounded broadcast.
    heavy = (
        base.groupBy("key")
        .agg(F.sum("size").alias("weight"))
        .filter(F.col("weight") > whole_group * total / shards)
        .select("key", F.lit(True).alias("heavy"))
    )
    rows = (
        base.join(F.broadcast(heavy), "key", "left")
        .withColumn("heavy", F.coalesce("heavy", F.lit(False)))
        .withColumn("cut", F.when(F.col("heavy"), F.coalesce("doc_id", F.lit(LOWEST))).otherwise(F.lit(LOWEST)))
    )
    spark = docs.sparkSession
    ranged = rows.withColumn("range", F.lit(0))
    overfull = spark.range(1).select(F.col("id").cast("int").alias("range"))
    splitters, rate = None, SAMPLES_PER_RANGE * ranges / total
    for _ in range(REFINEMENTS):
        new = settle(_new_splitters(ranged, overfull, rate, fair), "shard-splitters")
        splitters = new if splitters is None else splitters.unionByName(new).distinct()
        ranged = _assign(rows, splitters)
        key = F.struct("key", "cut")
        measured = settle(
            ranged.groupBy("range").agg(
                F.sum("size").alias("bytes"), F.count("*").alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")
            ),
            "shard-ranges",
        )
        # Fewer than half of the ranges can hold more than twice the fair share.
        overfull = measured.filter((F.col("bytes") > 2 * fair) & (F.col("lo") != F.col("hi"))).select("range")
        if overfull.isEmpty():
            break
        rate *= 16
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = measured.select(
        "range",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes0"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows0"),
    )
    in_range = Window.partitionBy("range").orderBy("key", "doc_id")
    upto = in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    group = Window.partitionBy("range", "key")
    placed = (
        ranged.join(F.broadcast(offsets), "range")
        .withColumn("start", F.col("bytes0") + F.sum("size").over(upto) - F.col("size"))
        .withColumn("place", F.col("rows0") + F.row_number().over(in_range) - 1)
        .withColumn("g_start", F.min("start").over(group))
        .withColumn("g_size", F.sum("size").over(group))
        .withColumn(
            "twice_middle",
            F.when(F.col("heavy"), 2 * F.col("start") + F.col("size")).otherwise(2 * F.col("g_start") + F.col("g_size")),
        )
        .withColumn("shard", F.least(F.lit(shards - 1), F.floor(F.col("twice_middle") * shards / (2 * total))).cast("int"))
        .select("doc_id", "size", "text_crc32", "shard", "place")
    )
    placed = settle(placed, "shard-placed")
    first = placed.groupBy("shard").agg(F.min("place").alias("first_place"))  # one row per shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("place") - F.col("first_place")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str) -> None:
    """Write the documents as one folder per shard, each row with its slot.

    ``placed`` comes from :func:`shard_documents`. Rows that agree in id and text take their slots in turn.
    """
    turn = Window.partitionBy("doc_id", "crc").orderBy("slot")
    left = docs.withColumn("crc", F.crc32(F.coalesce("text", F.lit(""))))
    left = left.withColumn("turn", F.row_number().over(Window.partitionBy("doc_id", "crc").orderBy(F.xxhash64(*docs.columns))))
    right = placed.select("doc_id", F.col("text_crc32").alias("crc"), "shard", "slot").withColumn(
        "turn", F.row_number().over(turn)
    )
    same = [left[c].eqNullSafe(right[c]) for c in ("doc_id", "crc", "turn")]
    (
        left.join(right, same)
        .select(*[left[c] for c in docs.columns if c not in ("shard", "slot")], "shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
