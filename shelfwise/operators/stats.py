"""Counts, distinct values and classification metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.functions.text import quoted
from shelfwise.operators.joins import lookup_join
from shelfwise.session import settle

ROWS_PER_CHUNK = 50_000
LG_K = 12


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def distinct_counts(df: DataFrame, cols: list[str], rsd: float | None = None) -> DataFrame:
    """Number of distinct values per column, in one row; approximate if ``rsd`` is given."""
    if rsd is None:
        counts = [F.countDistinct(F.col(quoted(c))).alias(c) for c in cols]
    else:
        counts = [F.approx_count_distinct(F.col(quoted(c)), rsd).alias(c) for c in cols]
    return df.agg(*counts)


def distinct_sketches(df: DataFrame, by: list[str], cols: list[str], lg_k: int = LG_K) -> DataFrame:
    """Per ``by`` one sketch per column of its distinct values, to be stored and united later.

    A sketch of 2 ** ``lg_k`` registers is at most a few kilobytes, however many values it has seen; with 12 the
    standard error of a count is 1.6 %. Nulls are not counted.
    """
    rows = df.select(*[F.col(quoted(c)) for c in by], *[F.col(quoted(c)).cast("string").alias(f"_{c}") for c in cols])
    sketches = [F.hll_sketch_agg(F.col(quoted(f"_{c}")), lg_k).alias(c) for c in cols]
    return rows.groupBy(*[F.col(quoted(c)) for c in by]).agg(*sketches)


def united_counts(sketches: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """Distinct values per ``by``, any of the columns the sketches were made by, or none: over all of them.

    Rows are not read again: a value found in several periods counts once.
    """
    united = sketches.groupBy(*[F.col(quoted(c)) for c in by]).agg(*[F.hll_union_agg(F.col(quoted(c))).alias(c) for c in cols])
    return united.select(*[F.col(quoted(c)) for c in by], *[F.hll_sketch_estimate(F.col(quoted(c))).alias(c) for c in cols])


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """(value, count), most frequent first; nulls are not counted."""
    return (
        df.filter(F.col(quoted(col)).isNotNull())
        .groupBy(F.col(quoted(col)).alias("value"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "value")
    )


def _label_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))


def drop_rare_classes(df: DataFrame, label: str, at_least: int) -> DataFrame:
    """Rows of labels with ``at_least`` rows."""
    frequent = _label_counts(df, label).filter(F.col("_n") >= at_least).select(label)
    return lookup_join(df, frequent, [label], "left_semi")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, class_weight): rows / (labels * rows of the label)."""
    counts = settle(_label_counts(df, label), "label_counts")
    rows, labels = counts.agg(F.sum("_n"), F.count(F.lit(1))).first()
    return counts.select(label, (F.lit(rows) / (F.lit(labels) * F.col("_n"))).alias("class_weight"))


def balanced_class_weights(df: DataFrame, label: str) -> DataFrame:
    """``df`` with a ``class_weight`` that lets every label count the same in total."""
    return lookup_join(df, class_weights(df, label), [label], "left")


def confusion_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """(actual, predicted, count)."""
    return df.groupBy(
        F.col(quoted(actual)).alias("actual"), F.col(quoted(predicted)).alias("predicted")
    ).agg(F.count(F.lit(1)).alias("count"))


def accuracy(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: the share of rows predicted right."""
    hit = F.col(quoted(actual)).eqNullSafe(F.col(quoted(predicted))).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"))


def skill(df: DataFrame, actual: str, predicted: str, rows: str | None = None) -> DataFrame:
    """(label, support, beats_majority): rows per actual label, and whether all predictions together are right
    more often than naming the most frequent label would be. ``rows`` names a column of row counts.
    """
    n = F.lit(1) if rows is None else F.col(quoted(rows))
    hit = F.col(quoted(actual)).eqNullSafe(F.col(quoted(predicted)))
    per_label = df.groupBy(F.col(quoted(actual)).alias("label")).agg(
        F.sum(n).alias("support"), F.sum(F.when(hit, n).otherwise(0)).alias("hits")
    )
    every = W.partitionBy()  # as many rows as there are labels
    better = F.sum("hits").over(every) > F.max("support").over(every)
    return per_label.select("label", "support", better.alias("beats_majority"))


def classification_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """(label, precision, recall, f1, support): every class, accuracy, macro and weighted mean.

    Undefined ratios are 0. All rows come from the confusion counts, whose size depends on the
    number of classes only: each cell adds to its row class and to its column class.
    """
    cells = confusion_counts(df, actual, predicted)
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("actual").alias("label"),
                    F.when(F.col("actual") == F.col("predicted"), F.col("count")).otherwise(0).alias("hits"),
                    F.col("count").alias("support"),
                    F.lit(0).cast("bigint").alias("claimed"),
                ),
                F.struct(
                    F.col("predicted").alias("label"),
                    F.lit(0).cast("bigint").alias("hits"),
                    F.lit(0).cast("bigint").alias("support"),
                    F.col("count").alias("claimed"),
                ),
            )
        ).alias("side")
    ).select("side.*")
    sums = sides.groupBy("label").agg(
        F.sum("hits").alias("hits"), F.sum("support").alias("support"), F.sum("claimed").alias("claimed")
    )

    def ratio(top: str, bottom: str):
        return F.coalesce(F.try_divide(F.col(top).cast("double"), F.col(bottom).cast("double")), F.lit(0.0))

    classes = (
        sums.withColumn("precision", ratio("hits", "claimed"))
        .withColumn("recall", ratio("hits", "support"))
        .withColumn("both", F.col("precision") + F.col("recall"))
        .withColumn("product", 2 * F.col("precision") * F.col("recall"))
        .withColumn("f1", ratio("product", "both"))
    )
    metrics = ["precision", "recall", "f1"]
    overall = classes.agg(
        F.sum("support").alias("support"),
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        *[F.avg(m).alias(f"macro_{m}") for m in metrics],
        *[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(f"weighted_{m}") for m in metrics],
    )
    summary = overall.select(
        F.explode(
            F.array(
                F.struct(F.lit("accuracy").alias("label"), *[F.col("accuracy").alias(m) for m in metrics], "support"),
                *[
                    F.struct(
                        F.lit(f"{kind} avg").alias("label"),
                        *[F.col(f"{kind}_{m}").alias(m) for m in metrics],
                        "support",
                    )
                    for kind in ("macro", "weighted")
                ],
            )
        ).alias("row")
    ).select("row.*")
    return classes.select("label", *metrics, "support").unionByName(summary)


def non_empty_guard(df: DataFrame, what: str = "training set") -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} is empty after filtering")
    return df


def load_summary(df: DataFrame, file_col: str, added: list[str]) -> DataFrame:
    """(file, chunks, rows, added_columns) per source file."""
    return (
        df.groupBy(F.col(quoted(file_col)).alias("file"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(
            "file",
            F.ceil(F.col("rows") / ROWS_PER_CHUNK).alias("chunks"),
            "rows",
            F.lit(len(added)).cast("bigint").alias("added_columns"),
        )
    )
