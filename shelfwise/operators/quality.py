"""Data-quality rules on the standard sales record.

A rule is a SQL predicate that is true on a violating row, so all row rules together are one
aggregation over one scan, and the clean view is one filter.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.text import quoted
from shelfwise.operators.joins import lookup_join
from shelfwise.schema import LIMITED, MANDATORY
from shelfwise.session import settle

# Defaults where the standard names no number.
TOLERANCE = 0.01
FIRST_DATE, LAST_DATE = "1990-01-01", "2100-01-01"
HALF_GRAM_UNIT = 0.0005


def _apart(actual: str, expected: str, tolerance: float, slack: float = 0.0) -> str:
    bound = f"{tolerance!r}BD * greatest(abs({actual}), abs({expected}))"
    if slack:
        bound = f"greatest({bound}, {slack!r}BD)"
    return f"coalesce(abs({actual} - ({expected})) > {bound}, false)"


def completeness_rules() -> dict[str, str]:
    return {f"completeness:{name}": f"{name} is null" for name in MANDATORY}


def length_rules() -> dict[str, str]:
    return {f"length:{f.name}": f"coalesce(length({f.name}) > {f.max_length}, false)" for f in LIMITED}


def sales_amount_rule(tolerance: float = TOLERANCE) -> dict[str, str]:
    return {"sales_amount": _apart("sales_amount_rub", "avg_sell_price * sales_quantity", tolerance)}


def margin_rule(tolerance: float = TOLERANCE) -> dict[str, str]:
    expected = "sales_amount_rub - avg_cost_price * sales_quantity"
    return {"margin": _apart("margin_amount_rub", expected, tolerance)}


def weight_rules(tolerance: float = TOLERANCE) -> dict[str, str]:
    """Pack weights that are no number, kilograms against pack weight times quantity, tons against kilograms.

    Both figures have three decimals, so half a unit of the last one is always allowed.
    """
    grams = "try_cast(weight as decimal(18,3))"
    pack = f"{grams} * sales_quantity * 0.001BD"
    return {
        "weight:text": f"weight is not null and {grams} is null",
        "weight:kg": _apart("sales_weight_kg", pack, tolerance, HALF_GRAM_UNIT),
        "weight:tons": _apart("sales_tons", "sales_weight_kg * 0.001BD", tolerance, HALF_GRAM_UNIT),
    }


def date_rules(first: str = FIRST_DATE, last: str = LAST_DATE) -> dict[str, str]:
    return {
        "date:bounds": f"coalesce(sale_date not between date'{first}' and date'{last}', false)",
        "date:month": "coalesce(sale_month not between 1 and 12, false)",
    }


def row_rules(tolerance: float = TOLERANCE, first: str = FIRST_DATE, last: str = LAST_DATE) -> dict[str, str]:
    return {
        **completeness_rules(),
        **length_rules(),
        **sales_amount_rule(tolerance),
        **margin_rule(tolerance),
        **weight_rules(tolerance),
        **date_rules(first, last),
    }


def count_violations(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """(rule, violations, rows, rate) for all rules in one pass."""
    names = list(rules)
    sums = [F.count_if(F.expr(rules[name])).alias(f"r{i}") for i, name in enumerate(names)]
    totals = df.agg(F.count(F.lit(1)).alias("rows"), *sums)
    listed = F.array(
        *[F.struct(F.lit(n).alias("rule"), F.col(f"r{i}").alias("violations"), "rows") for i, n in enumerate(names)]
    )
    return _with_rate(totals.select(F.explode(listed).alias("r")).select("r.*"))


def _with_rate(df: DataFrame) -> DataFrame:
    rate = F.coalesce(F.try_divide(F.col("violations").cast("double"), F.col("rows").cast("double")), F.lit(0.0))
    return df.withColumn("rate", rate)


def check_completeness(df: DataFrame) -> DataFrame:
    return count_violations(df, completeness_rules())


def check_lengths(df: DataFrame) -> DataFrame:
    return count_violations(df, length_rules())


def check_sales_amount(df: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    return count_violations(df, sales_amount_rule(tolerance))


def check_margin(df: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    return count_violations(df, margin_rule(tolerance))


def check_weight(df: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    return count_violations(df, weight_rules(tolerance))


def check_date_bounds(df: DataFrame, first: str = FIRST_DATE, last: str = LAST_DATE) -> DataFrame:
    return count_violations(df, date_rules(first, last))


def _key_pairs(df: DataFrame, *counts: Column) -> DataFrame:
    """Row counts, and others, per (product_article, barcode): far fewer rows than sales."""
    return df.groupBy("product_article", "barcode").agg(F.count(F.lit(1)).alias("n"), *counts)


def _row_report(pairs: DataFrame, names: list[str]) -> DataFrame:
    """(rule, violations, rows, rate) from the rule counts ``r0``, ``r1`` ... of the key pairs."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", *[f"r{i}" for i in range(len(names))])]
    listed = F.array(
        *[F.struct(F.lit(n).alias("rule"), F.col(f"r{i}").alias("violations"), F.col("n").alias("rows")) for i, n in enumerate(names)]
    )
    return _with_rate(pairs.agg(*sums).select(F.explode(listed).alias("r")).select("r.*"))


def check_uniqueness(df: DataFrame) -> DataFrame:
    """Repeated articles and barcodes, and barcodes or articles that do not pair one to one.

    (rule, violations, rows, rate) where violations and rows count key values. The sales rows
    are aggregated once, to pairs; both keys are checked on those.
    """
    return _unique_report(settle(_key_pairs(df), "key_pairs"))


def _unique_report(pairs: DataFrame) -> DataFrame:
    def keys(key: str, other: str) -> DataFrame:
        per_key = (
            pairs.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum("n").alias("n"), F.count(other).alias("others"))
        )
        totals = per_key.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("n") > 1).alias("repeated"),
            F.count_if(F.col("others") > 1).alias("mixed"),
        )
        listed = F.array(
            F.struct(F.lit(f"unique:{key}").alias("rule"), F.col("repeated").alias("violations"), "rows"),
            F.struct(F.lit(f"one {other} per {key}").alias("rule"), F.col("mixed").alias("violations"), "rows"),
        )
        return totals.select(F.explode(listed).alias("r")).select("r.*")

    return _with_rate(keys("product_article", "barcode").unionByName(keys("barcode", "product_article")))


def quality_report(df: DataFrame, tolerance: float = TOLERANCE, first: str = FIRST_DATE, last: str = LAST_DATE) -> DataFrame:
    """All rules from one pass over the rows: rule counts per (product_article, barcode), summed up afterwards."""
    rules = row_rules(tolerance, first, last)
    counts = [F.count_if(F.expr(test)).alias(f"r{i}") for i, test in enumerate(rules.values())]
    pairs = settle(_key_pairs(df, *counts), "rule_counts")
    return _row_report(pairs, list(rules)).unionByName(_unique_report(pairs))


def mixed_barcodes(df: DataFrame) -> DataFrame:
    """Barcodes that carry more than one article."""
    pairs = _key_pairs(df).filter("barcode is not null and product_article is not null")
    return pairs.groupBy("barcode").agg(F.count(F.lit(1)).alias("articles")).filter("articles > 1").select("barcode")


def clean_sales(df: DataFrame, tolerance: float = TOLERANCE, first: str = FIRST_DATE, last: str = LAST_DATE) -> DataFrame:
    """Rows that violate no row rule and whose barcode names one article.

    Meant for a stored table: on computed columns Spark would work each column out again in
    every predicate that uses it.
    """
    broken = " or ".join(f"({p})" for p in row_rules(tolerance, first, last).values())
    return lookup_join(df.filter(f"not ({broken})"), mixed_barcodes(df), ["barcode"], "left_anti")


def publish_clear_view(df: DataFrame, name: str = "clear_sales", **limits) -> DataFrame:
    """Register the clean rows as a view for analysts; returns them, too."""
    clean = clean_sales(df, **limits)
    clean.createOrReplaceTempView(name)
    return clean


def publish_lasting_view(
    df: DataFrame, schema: str, folder: str, name: str = "clear_sales", **limits
) -> dict[str, str]:
    """Store the record and its mixed barcodes, and let a catalog view give the clean rows to any session.

    The record is evaluated and written once; the view is SQL over the stored files and filters as it is read, so
    readers need neither this library nor its session. Both folders are new versions below ``folder`` and the view's
    text names them: replacing the view is the one step that readers see. Returns the names and folders.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex
    places = {part: f"{folder.rstrip('/')}/{part}/{version}" for part in ("record", "mixed_barcodes")}
    df.write.parquet(places["record"])
    record = spark.read.schema(df.schema).parquet(places["record"])
    mixed_barcodes(record).write.parquet(places["mixed_barcodes"])
    broken = " or ".join(f"({p})" for p in row_rules(**limits).values())
    columns = ", ".join(f"r.{quoted(c)}" for c in df.columns)
    view = f"{quoted(schema)}.{quoted(name)}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(schema)}")
    spark.sql(
        f"CREATE OR REPLACE VIEW {view} AS SELECT {columns} FROM parquet.{quoted(places['record'])} r "
        f"LEFT ANTI JOIN parquet.{quoted(places['mixed_barcodes'])} m ON r.barcode = m.barcode WHERE NOT ({broken})"
    )
    return {"view": view, **places}
