"""Reports on the standard sales record, and its star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GEOGRAPHY = ("branch", "region", "city", "address")
PRODUCT_LEVELS = ("product_level_1", "product_level_2", "product_level_3", "product_level_4")
MEASURES = (
    "sales_quantity",
    "sales_amount_rub",
    "margin_amount_rub",
    "sales_weight_kg",
    "sales_tons",
)


def _sums(columns: list[str] | tuple[str, ...]) -> list[Column]:
    return [F.sum(c).alias(c) for c in columns]


def monthly_sales(df: DataFrame, *by: str) -> DataFrame:
    """Measures per month, and per ``by``."""
    return df.groupBy("sale_year", "sale_month", *by).agg(F.count(F.lit(1)).alias("rows"), *_sums(MEASURES))


def rollup_sums(df: DataFrame, levels: tuple[str, ...]) -> DataFrame:
    """Measures at every level of a hierarchy, with ``level_id`` telling the levels apart.

    Rows are summed to the finest level first; the roll-up then multiplies only those sums.
    """
    finest = df.groupBy(*levels).agg(F.count(F.lit(1)).alias("rows"), *_sums(MEASURES))
    return finest.rollup(*levels).agg(F.grouping_id().alias("level_id"), *_sums(("rows", *MEASURES)))


def geo_rollup(df: DataFrame) -> DataFrame:
    return rollup_sums(df, GEOGRAPHY)


def product_rollup(df: DataFrame) -> DataFrame:
    return rollup_sums(df, PRODUCT_LEVELS)


def weighted_prices(df: DataFrame, *by: str) -> DataFrame:
    """Prices of an aggregate: sums of money over sums of units, not means of prices."""
    quantity = F.sum("sales_quantity")
    cost = F.sum(F.col("avg_cost_price") * F.col("sales_quantity"))
    units = F.nullif(quantity, F.lit(0)).cast("double")
    return df.groupBy(*by).agg(
        quantity.alias("sales_quantity"),
        (F.sum("sales_amount_rub").cast("double") / units).alias("avg_sell_price"),
        (cost.cast("double") / units).alias("avg_cost_price"),
    )


DIMENSIONS: dict[str, tuple[str, ...]] = {
    "product": (
        "product_article", "product_code", "barcode", "product_name", "brand", "flavor", "weight", "product_type",
        *PRODUCT_LEVELS, "product_family_code", "product_family_name",
        "factory_code", "factory_name", "material", "vendor",
    ),
    "store": ("retail_chain", *GEOGRAPHY, "store_format", "store_name"),
    "supplier": ("supplier", "warehouse_supplier"),
    "date": ("sale_date", "sale_year", "sale_month"),
}


def surrogate_key(dimension: str) -> Column:
    """A key made of the attributes alone, so facts get it without a join.

    Attributes are written with their length in front: no two rows share a text.
    """
    parts = [F.col(c).cast("string") for c in DIMENSIONS[dimension]]
    return F.md5(F.concat(*[F.coalesce(F.concat(F.length(p), F.lit(":"), p), F.lit("-")) for p in parts]))


def build_dimension(df: DataFrame, dimension: str) -> DataFrame:
    """Distinct attribute combinations with their key."""
    distinct = df.select(*DIMENSIONS[dimension]).distinct()
    return distinct.select(surrogate_key(dimension).alias(f"{dimension}_key"), *DIMENSIONS[dimension])


def build_dimensions(df: DataFrame) -> dict[str, DataFrame]:
    return {name: build_dimension(df, name) for name in DIMENSIONS}


def build_facts(df: DataFrame) -> DataFrame:
    """Dimension keys and measures, one row per sales row."""
    keys = [surrogate_key(name).alias(f"{name}_key") for name in DIMENSIONS]
    return df.select(*keys, *MEASURES, "avg_cost_price", "avg_sell_price")
