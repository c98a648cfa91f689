"""Mixing sources to target weights by entropy balancing.

Among all document rates that give every source its target of words, the balanced ones are nearest to one
copy per document in relative entropy. They are exponentially tilted, ``rate = min(cap, exp(lambda_s * size))``,
and ``lambda`` solves a convex dual with one constraint per source, found by Newton steps whose sums are
Spark aggregates. Rates become whole copies by systematic rounding along the documents' sizes.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import settle

WORD = r"[^\x20\x09-\x0D]+"
UNIT = 2**20  # rates are rounded to this fraction, so that their running sums are exact
CORRECTIONS = 3


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """source, sid, source_size, n_words_docs, target: the sources by code point, null last.

    Targets share the words of all by weight; none exceeds ``cap`` times its source, and what is above is
    shared again. With sources ordered by size per weight, the level found after filling the first k tells
    whether the next one is full, so one pass of running sums settles all of them.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") - 1) % len(weights) + 1)
    sources = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count_if(F.col("size") > 0).alias("worded"))
        .withColumn("sid", F.row_number().over(by_name))
        .withColumn("weight", turn.cast("double"))
        .withColumn("most", F.col("source_size") * float(cap))
    )
    everything = Window.partitionBy()
    filling = Window.orderBy(F.col("most") / F.col("weight"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(filling), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filling), F.lit(0.0))
    )
    sources = sources.withColumn("full", level * F.col("weight") > F.col("most"))
    free = F.when(~F.col("full"), F.col("weight"))
    rest = F.sum("source_size").over(everything) - F.coalesce(
        F.sum(F.when(F.col("full"), F.col("most"))).over(everything), F.lit(0.0)
    )
    return sources.withColumn(
        "target", F.when(F.col("full"), F.col("most")).otherwise(rest * F.col("weight") / F.sum(free).over(everything))
    ).select("source", "sid", "source_size", "worded", "target")


def tilts(sizes: DataFrame, targets: DataFrame, cap: int = 3, tolerance: float = 1e-7, most_steps: int = 60) -> DataFrame:
    """sid, tilt: Newton on the dual, kept inside a bracket. ``sizes``: sid, size, n, z (size over its source's mean)."""
    state = settle(
        targets.filter((F.col("source_size") > 0) & (F.col("target") > 0))
        .join(sizes.groupBy("sid").agg(F.min("z").alias("z0")), "sid")
        .withColumn("log_ratio", F.log(F.col("target") / F.col("source_size")))
        .select(
            "sid",
            "target",
            F.lit(0.0).alias("tilt"),
            F.least(F.lit(0.0), F.col("log_ratio") / F.col("z0")).alias("lo"),
            F.greatest(F.lit(0.0), F.sign("log_ratio") * math.log(cap) / F.col("z0")).alias("hi"),
        ),
        "mix-state",
    )
    exponent = F.col("tilt") * F.col("z")
    rate = F.exp(F.least(F.lit(math.log(cap)), exponent))
    words = F.col("n") * F.col("size") * rate
    for _ in range(most_steps):
        summed = (
            sizes.join(state, "sid")
            .groupBy("sid", "target", "tilt", "lo", "hi")
            .agg(
                F.sum(words).alias("got"),
                F.sum(F.when(exponent < math.log(cap), words * F.col("z")).otherwise(0.0)).alias("slope"),
            )
            .withColumn("lo", F.when(F.col("got") < F.col("target"), F.col("tilt")).otherwise(F.col("lo")))
            .withColumn("hi", F.when(F.col("got") >= F.col("target"), F.col("tilt")).otherwise(F.col("hi")))
            .withColumn("off", F.abs(F.col("got") - F.col("target")) / F.col("target"))
            .withColumn(
                "newton",
                F.when(F.col("slope") > 0, F.col("tilt") + (F.col("target") - F.col("got")) / F.col("slope")),
            )
        )
        inside = (F.col("newton") > F.col("lo")) & (F.col("newton") < F.col("hi"))
        moved = F.when(F.col("off") <= tolerance, F.col("tilt")).when(inside, F.col("newton"))
        state = settle(
            summed.withColumn("tilt", moved.otherwise((F.col("lo") + F.col("hi")) / 2)).select(
                "sid", "target", "tilt", "lo", "hi", "off"
            ),
            "mix-state",
        )
        if (state.agg(F.max("off")).first()[0] or 0.0) <= tolerance:
            break
        state = state.drop("off")
    return state.select("sid", "tilt")


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, key: str = "doc_id"
) -> DataFrame:
    """One row per document: ``key``, source, size, source_size, target, rate, copies, taken.

    ``size`` is the number of words (null text: 0). ``copies`` is 0 to ``cap`` and ``taken`` = copies * size;
    the taken words of a source differ from its target by about its smallest documents' size. Documents
    without words take nothing and count as one copy. A null source is a source of its own, after all
    others. Repeated rows are rows of their own. An empty table gives no rows.
    """
    sized = settle(
        docs.select(
            F.col(key).alias("key"),
            "source",
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        ),
        "mix-sized",
    )
    targets = settle(source_targets(sized, weights, cap), "mix-targets")
    rows = sized.join(targets.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    # The tilt depends on source and size only: the Newton sums run over the distinct sizes.
    sizes = settle(
        rows.filter("size > 0")
        .groupBy("sid", "size")
        .agg(F.count("*").alias("n"), F.first("source_size").alias("s"), F.first("worded").alias("w"))
        .select("sid", "size", "n", (F.col("size") * F.col("w") / F.col("s")).alias("z")),
        "mix-sizes",
    )
    solved = tilts(sizes, targets, cap)
    full = F.col("target") >= F.col("source_size") * (cap - 1e-9)
    rate = F.when(full, F.lit(float(cap))).otherwise(F.exp(F.least(F.lit(math.log(cap)), F.col("tilt") * F.col("z"))))
    large_first = Window.partitionBy("sid").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    classes = settle(
        sizes.join(solved, "sid")
        .join(targets.select("sid", "target", "source_size"), "sid")
        .withColumn("rate", rate)
        .withColumn("step", F.round(F.col("rate") * UNIT).cast("long"))
        .withColumn("base", F.coalesce(F.sum(F.col("n") * F.col("step")).over(large_first), F.lit(0)))
        .select("sid", "size", "rate", "step", "base", F.ceil(F.sqrt("n")).alias("buckets")),
        "mix-classes",
    )
    # Ranks inside a class of equal size go by hash buckets, so that no class is one task.
    dealt = rows.join(classes, ["sid", "size"], "left").withColumn(
        "bucket", F.pmod(F.xxhash64("key"), F.coalesce("buckets", F.lit(1)))
    )
    per_bucket = dealt.filter("step is not null").groupBy("sid", "size", "bucket").agg(F.count("*").alias("m"))
    up_to = Window.partitionBy("sid", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_bucket.select("sid", "size", "bucket", F.coalesce(F.sum("m").over(up_to), F.lit(0)).alias("rank0"))
    in_bucket = Window.partitionBy("sid", "size", "bucket").orderBy(F.xxhash64("key"), "key")
    worded = (
        dealt.filter("step is not null")
        .join(starts, ["sid", "size", "bucket"])
        .withColumn("rank", F.col("rank0") + F.row_number().over(in_bucket) - 1)
    )
    point = F.col("base") + F.col("rank") * F.col("step") + UNIT // 2
    copies = F.floor((point + F.col("step")) / UNIT) - F.floor(point / UNIT)
    columns = ["key", "source", "sid", "size", "source_size", "target", "rate"]
    rounded = worded.select(*columns, "rank", copies.cast("long").alias("copies"))
    wordless = dealt.filter("step is null").select(
        *columns[:-1], F.lit(1.0).alias("rate"), F.lit(None).cast("long").alias("rank"), F.lit(1).cast("long").alias("copies")
    )
    mixed = settle(rounded.unionByName(wordless), "mix-rounded")
    for _ in range(CORRECTIONS):
        mixed = _nearer(mixed, cap)
    return mixed.withColumnRenamed("key", key).select(
        key, "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def _nearer(mixed: DataFrame, cap: int) -> DataFrame:
    """Change one document by one copy in each source where that brings its words nearer to the target."""
    missing = settle(
        mixed.groupBy("sid").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("missing")), "mix-missing"
    )
    off = F.abs(F.col("missing"))
    better = F.abs(F.col("size") - off) < off
    open_ = F.when(F.col("missing") > 0, F.col("copies") < cap).otherwise(F.col("copies") > 0)
    changes = settle(
        mixed.filter("size > 0")
        .join(missing, "sid")
        .filter(better & open_)
        .groupBy("sid")
        .agg(
            F.min_by(F.struct("size", "rank"), F.struct(F.abs(F.col("size") - off), "size", "rank")).alias("at"),
            F.first(F.sign("missing")).cast("long").alias("change"),
        )
        .select("sid", "at.size", "at.rank", "change"),
        "mix-change",
    )
    return (
        mixed.join(changes, ["sid", "size", "rank"], "left")
        .withColumn("copies", F.col("copies") + F.coalesce("change", F.lit(0)))
        .drop("change")
    )


def repeat_documents(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """The mix itself: every document as often as :func:`mix_sources` takes it, with the columns of ``docs``."""
    row = "mix_row"
    keyed = docs.withColumn(row, F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in docs.columns]))
    copies = mix_sources(keyed, weights, cap, key=row).groupBy(row).agg(F.sum("copies").alias("mix_copies"))
    # Rows alike in every column are one key with the sum of their copies.
    once = keyed.dropDuplicates([row]).join(copies, row).filter("mix_copies > 0")
    return once.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int"))).alias("mix_copy")).drop(
        "mix_copy"
    )
