"""The given tables seen as sales: the standard record, a drop file, and label sets.

Field expressions are SQL text that Spark and DuckDB read alike, so the comparison SQL starts
from the same sales rows. Only the tables a query's fields need are joined: dimensions have
one row per key and are left-joined, so leaving one out changes no other field.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.schema import STANDARD
from shelfwise.session import spread

# Intermediate decimals stay within 18 digits, which Spark computes as whole numbers.
QUANTITY = "cast(l_quantity as int)"
PAID = "cast(cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2))) as decimal(14,2))"
UNIT_COST = "cast(cast(p_retailprice as decimal(10,2)) * cast(0.6 as decimal(2,1)) as decimal(12,4))"
AMOUNT = f"cast({PAID} as decimal(18,2))"
COST = f"cast({UNIT_COST} as decimal(18,4))"
GRAMS = "(p_size * 10)"
SOLD_GRAMS = f"cast({GRAMS} * {QUANTITY} as decimal(10,0))"
MONTH = "cast(date_trunc('month', l_shipdate) as date)"
PRODUCT_NAME = (
    "concat(p_name, ' ', lower(p_type), ' ', case p_type "
    "when 'LARGE' then concat(replace(cast(cast(p_size / 100 as decimal(10,2)) as string), '.', ','), ' КГ') "
    f"when 'PROMO' then concat('туба ', cast({GRAMS} as string), 'г') "
    f"else concat(cast({GRAMS} as string), ' гр') end)"
)
CITY = "concat('город ', n_name)"
ADDRESS = "concat('г.', n_name, ', ул. ', s_name)"

# field: (expression, dimensions it needs)
SALES: dict[str, tuple[str, tuple[str, ...]]] = {
    "retail_chain": ("c_mktsegment", ("orders",)),
    "sale_year": (f"cast(year({MONTH}) as int)", ()),
    "sale_month": (f"cast(month({MONTH}) as int)", ()),
    "sale_date": (MONTH, ()),
    "branch": ("r_name", ("store",)),
    "region": ("n_name", ("store",)),
    "city": (CITY, ("store",)),
    "address": (ADDRESS, ("store",)),
    "store_format": ("o_orderpriority", ("orders",)),
    "store_name": ("s_name", ("store",)),
    "product_name": (PRODUCT_NAME, ("part",)),
    "brand": ("p_brand", ("part",)),
    "weight": (f"cast({GRAMS} as string)", ("part",)),
    "product_type": ("p_type", ("part",)),
    "product_level_1": ("p_type", ("part",)),
    "product_level_2": ("p_brand", ("part",)),
    "product_level_3": ("p_name", ("part",)),
    "product_article": ("l_partkey", ()),
    "product_code": ("l_partkey", ()),
    "barcode": ("lpad(cast(l_partkey as string), 13, '0')", ()),
    "supplier": ("s_name", ("store",)),
    "sales_quantity": (QUANTITY, ()),
    "sales_amount_rub": (AMOUNT, ()),
    "avg_cost_price": (COST, ("part",)),
    "avg_sell_price": (f"cast({AMOUNT} / cast({QUANTITY} as decimal(10,0)) as decimal(18,4))", ()),
    "margin_amount_rub": (f"cast({PAID} - {UNIT_COST} * cast({QUANTITY} as decimal(5,0)) as decimal(18,2))", ("part",)),
    "sales_tons": (f"cast({SOLD_GRAMS} * cast(0.000001 as decimal(7,6)) as decimal(18,3))", ("part",)),
    "sales_weight_kg": (f"cast({SOLD_GRAMS} * cast(0.001 as decimal(4,3)) as decimal(18,3))", ("part",)),
}

# The same record as a careless chain would report it: every quality rule finds something.
REPORTED: dict[str, tuple[str, tuple[str, ...]]] = {
    **SALES,
    "address": (f"case when s_acctbal >= 2500 then {ADDRESS} end", ("store",)),
    "weight": (f"cast(case when p_type = 'PROMO' then {GRAMS} + p_size else {GRAMS} end as string)", ("part",)),
    "product_level_4": ("case when l_linestatus = 'O' then repeat(p_name, 12) else p_name end", ("part",)),
    "barcode": (
        "case when p_type = 'SMALL' then concat('20-', p_brand) "
        "else lpad(cast(l_partkey as string), 13, '0') end",
        ("part",),
    ),
    "avg_sell_price": (
        f"case when l_tax > 0.065 then cast(p_retailprice as decimal(18,4)) else {SALES['avg_sell_price'][0]} end",
        ("part",),
    ),
    "margin_amount_rub": (
        f"case when l_returnflag = 'R' then {AMOUNT} else {SALES['margin_amount_rub'][0]} end",
        ("part",),
    ),
}
FIRST_DATE, LAST_DATE = "1995-07-01", "2001-06-30"

DIMENSION_JOINS = {
    "orders": "left join (select o_orderkey, o_orderpriority, c_mktsegment from orders "
    "left join customer on o_custkey = c_custkey) o on l_orderkey = o_orderkey",
    "part": "left join part on l_partkey = p_partkey",
    "store": "left join (select s_suppkey, s_name, s_acctbal, n_name, r_name from supplier "
    "left join nation on s_nationkey = n_nationkey left join region on n_regionkey = r_regionkey) s "
    "on l_suppkey = s_suppkey",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _source(needed: set[str]) -> str:
    return " ".join(["lineitem", *[j for d, j in DIMENSION_JOINS.items() if d in needed]])


def sales_sql(fields: tuple[str, ...], binding: dict[str, tuple[str, tuple[str, ...]]] = SALES) -> str:
    """A query for the chosen fields of the standard record; fields the tables lack are null."""
    kinds = {f.name: f.type for f in STANDARD}
    needed = {d for f in fields if f in binding for d in binding[f][1]}
    listed = [f"{binding[f][0] if f in binding else f'cast(null as {kinds[f]})'} as {f}" for f in fields]
    return f"select {', '.join(listed)} from {_source(needed)}"


def _with_views(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    for name in ("lineitem", "orders", "customer", "part", "supplier", "nation", "region"):
        rows = table(spark, sf_dir, name)
        (spread(rows) if name == "lineitem" else rows).createOrReplaceTempView(name)
    return spark.sql(sql)


def sales(
    spark: SparkSession,
    sf_dir: str,
    *fields: str,
    binding: dict[str, tuple[str, tuple[str, ...]]] = SALES,
) -> DataFrame:
    """The standard record of every line item, or only some of its fields."""
    chosen = fields or tuple(f.name for f in STANDARD)
    return _with_views(spark, sf_dir, sales_sql(chosen, binding))


def reported_sales(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    return sales(spark, sf_dir, *fields, binding=REPORTED)


DROP_FIELDS = ("product_name", "product_code", "address", "city", "region", "branch", "supplier", "sales_quantity")


def drop_rows(spark: SparkSession, sf_dir: str, *headers: str) -> DataFrame:
    """Line items as a chain would drop them: the first ``DROP_FIELDS`` under free-form headers."""
    chosen = DROP_FIELDS[: len(headers)] if headers else DROP_FIELDS
    rows = sales(spark, sf_dir, *chosen)
    return rows.toDF(*headers) if headers else rows


# Label sets: text and label columns of the seven models.
PRODUCT_LABELS = (
    f"select {PRODUCT_NAME} as product_name, split_part(p_name, ' ', 2) as flavor, "
    f"split_part(p_name, ' ', 1) as brand, p_type as product_type, cast({GRAMS} as string) as weight from part"
)
ADDRESS_LABELS = (
    f"select {ADDRESS.replace('s_name', 'c_name')} as address, {CITY} as city, n_name as region, r_name as branch "
    "from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"
)
TOWN_LABELS = (
    "select concat('город ', n_name, ' ', lower(c_mktsegment)) as city, n_name as region, r_name as branch "
    "from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"
)


def product_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_views(spark, sf_dir, PRODUCT_LABELS)


def address_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_views(spark, sf_dir, ADDRESS_LABELS)


def town_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_views(spark, sf_dir, TOWN_LABELS)
