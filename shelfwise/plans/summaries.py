"""Registered queries: the standard record, its quality rules, and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.text import packaging_type
from shelfwise.operators import quality, reports, standard
from shelfwise.plans.bindings import FIRST_DATE, LAST_DATE, REPORTED, SALES, reported_sales, sales, table
from shelfwise.plans.load import load_chain
from shelfwise.plans.registry import query, sales_cte
from shelfwise.profiles import MAGNIT, ChainProfile
from shelfwise.schema import LIMITED, MANDATORY, STANDARD
from shelfwise.session import scratch_path
from shelfwise.sources import published
from shelfwise.sources.files import CSV_OPTIONS

ALL_FIELDS = tuple(f.name for f in STANDARD)
MEASURES = reports.MEASURES
MEASURE_SQL = ", ".join(f"cast(sum({m}) as double) as {m}" for m in MEASURES)


def _plain_measures(df: DataFrame) -> DataFrame:
    """Exact decimal sums as doubles, the one type both engines print alike."""
    return df.withColumns({m: F.col(m).cast("double") for m in MEASURES if m in df.columns})


PACK_CASE = "case when lower(product_name) like '%туба%' then 'Туба' else 'Пакет' end"


@query(
    f"with {sales_cte('sale_year', 'sale_month', 'product_name', *MEASURES)} "
    f"select sale_year, sale_month, {PACK_CASE} as package_type, count(*) as rows, {MEASURE_SQL} "
    "from sales group by 1, 2, 3"
)
def monthly_sales_by_packaging(spark, sf_dir):
    rows = sales(spark, sf_dir, "sale_year", "sale_month", "product_name", *MEASURES)
    packed = rows.withColumn("package_type", packaging_type("product_name"))
    return _plain_measures(reports.monthly_sales(packed, "package_type"))


@query(
    f"with {sales_cte('sale_year', 'sale_month', *MEASURES)} "
    f"select sale_year, sale_month, count(*) as rows, {MEASURE_SQL} from sales group by 1, 2"
)
def monthly_sales(spark, sf_dir):
    return _plain_measures(reports.monthly_sales(sales(spark, sf_dir, "sale_year", "sale_month", *MEASURES)))


def _rollup_sql(levels: tuple[str, ...]) -> str:
    listed = ", ".join(levels)
    return (
        f"with {sales_cte(*levels, *MEASURES)} select {listed}, cast(grouping_id({listed}) as bigint) as level_id, "
        f"count(*) as rows, {MEASURE_SQL} from sales group by rollup({listed})"
    )


@query(_rollup_sql(reports.GEOGRAPHY))
def geo_rollup(spark, sf_dir):
    return _plain_measures(reports.geo_rollup(sales(spark, sf_dir, *reports.GEOGRAPHY, *MEASURES)))


def _product_rollup_sql() -> str:
    levels = ", ".join(reports.PRODUCT_LEVELS)
    return (
        f"with {sales_cte(*reports.PRODUCT_LEVELS, *MEASURES, binding=REPORTED)} "
        f"select {levels}, cast(grouping_id({levels}) as bigint) as level_id, count(*) as rows, {MEASURE_SQL} "
        f"from sales group by rollup({levels})"
    )


@query(_product_rollup_sql())
def product_rollup(spark, sf_dir):
    return _plain_measures(reports.product_rollup(reported_sales(spark, sf_dir, *reports.PRODUCT_LEVELS, *MEASURES)))


PRICE_FIELDS = ("retail_chain", "sale_year", "sales_quantity", "sales_amount_rub", "avg_cost_price")


@query(
    f"with {sales_cte(*PRICE_FIELDS)} select retail_chain, sale_year, cast(sum(sales_quantity) as bigint) as sales_quantity, "
    "round(cast(sum(sales_amount_rub) as double) / sum(sales_quantity), 6) as avg_sell_price, "
    "round(cast(sum(avg_cost_price * sales_quantity) as double) / sum(sales_quantity), 6) as avg_cost_price "
    "from sales group by 1, 2"
)
def weighted_prices(spark, sf_dir):
    prices = reports.weighted_prices(sales(spark, sf_dir, *PRICE_FIELDS), "retail_chain", "sale_year")
    return prices.withColumns({c: F.round(c, 6) for c in ("avg_sell_price", "avg_cost_price")})


# The standard record.


def _printed(name: str) -> str:
    kind = next(f.type for f in STANDARD if f.name == name)
    if kind == "date":
        return f"cast({name} as string) as {name}"
    return f"cast({name} as double) as {name}" if kind.startswith("decimal") else name


@query(f"with {sales_cte(*ALL_FIELDS)} select {', '.join(_printed(f) for f in ALL_FIELDS)} from sales")
def to_standard(spark, sf_dir):
    rows = sales(spark, sf_dir, *SALES).withColumnRenamed("sales_tons", "tons")
    record = standard.to_standard(rows, {"sales_tons": "tons", "product_level_1": F.col("product_type")})
    return record.selectExpr(*[_printed(f) for f in ALL_FIELDS])


@query(
    "select cast(year(l_shipdate) as int) as sale_year, cast(month(l_shipdate) as int) as sale_month, "
    "cast(cast(date_trunc('month', l_shipdate) as date) as varchar) as sale_date, count(*) as rows "
    "from lineitem group by 1, 2, 3"
)
def derive_dates(spark, sf_dir):
    dated = standard.derive_dates(table(spark, sf_dir, "lineitem").select("l_shipdate"), "l_shipdate")
    counted = dated.groupBy("sale_year", "sale_month", "sale_date").agg(F.count(F.lit(1)).alias("rows"))
    return counted.withColumn("sale_date", F.col("sale_date").cast("string"))


@query(
    "select case when p_size > 45 then null when p_size > 5 then p_partkey end as product_article, "
    "cast(p_size as int) as sales_quantity, cast(cast(p_retailprice as decimal(18,2)) as double) as sales_amount_rub, "
    "case when p_type = 'PROMO' then null else '2024-12-01' end as sale_date, p_brand as brand from part"
)
def cast_types(spark, sf_dir):
    texts = table(spark, sf_dir, "part").selectExpr(
        "case when p_size > 45 then 'x' when p_size > 5 then concat(' ', cast(p_partkey as string)) end as product_article",
        "concat(cast(p_size as string), '.0') as sales_quantity",
        "replace(cast(cast(p_retailprice as decimal(18,2)) as string), '.', ',') as sales_amount_rub",
        "case p_type when 'PROMO' then '31.31.2024' when 'SMALL' then '01.12.2024' else '2024-12-01' end as sale_date",
        "p_brand as brand",
    )
    typed = standard.cast_types(texts)
    return typed.withColumns(
        {"sale_date": F.col("sale_date").cast("string"), "sales_amount_rub": F.col("sales_amount_rub").cast("double")}
    )


# Quality rules, on the record as a careless chain reports it.

MARGIN_SQL = "sales_amount_rub - avg_cost_price * sales_quantity"
PAID_SQL = "avg_sell_price * sales_quantity"
PACK_SQL = "cast(weight as decimal(10,0)) * sales_quantity * cast(0.001 as decimal(4,3))"


def _apart_sql(a: str, b: str, slack: str = "0") -> str:
    return f"abs({a} - ({b})) > greatest(greatest(abs({a}), abs({b})) * cast(0.01 as decimal(3,2)), {slack})"


SLACK = "cast(0.0005 as decimal(5,4))"
COMPLETENESS_SQL = {f"completeness:{name}": f"{name} is null" for name in MANDATORY}
LENGTH_SQL = {f"length:{f.name}": f"length({f.name}) > {f.max_length}" for f in LIMITED}
AMOUNT_SQL = {"sales_amount": _apart_sql("sales_amount_rub", PAID_SQL)}
MARGIN_RULE_SQL = {"margin": _apart_sql("margin_amount_rub", MARGIN_SQL)}
WEIGHT_SQL = {
    "weight:text": "weight is not null and try_cast(weight as decimal(18,3)) is null",
    "weight:kg": _apart_sql("sales_weight_kg", PACK_SQL, SLACK),
    "weight:tons": _apart_sql("sales_tons", "sales_weight_kg * cast(0.001 as decimal(4,3))", SLACK),
}
DATE_SQL = {
    "date:bounds": f"sale_date < date '{FIRST_DATE}' or sale_date > date '{LAST_DATE}'",
    "date:month": "sale_month < 1 or sale_month > 12",
}
ROW_RULES_SQL = {**COMPLETENESS_SQL, **LENGTH_SQL, **AMOUNT_SQL, **MARGIN_RULE_SQL, **WEIGHT_SQL, **DATE_SQL}
REPORTED_CTE = sales_cte(*ALL_FIELDS, binding=REPORTED)


def _violations_sql(rules: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{name}' as rule, count(*) filter ({test}) as violations, count(*) as rows, "
        f"round(count(*) filter ({test}) / count(*), 8) as rate from sales"
        for name, test in rules.items()
    )


def _uniqueness_sql() -> str:
    parts = []
    for key, other in (("product_article", "barcode"), ("barcode", "product_article")):
        per_key = (
            f"(select {key}, count(*) as n, count(distinct {other}) as others from sales where {key} is not null group by 1)"
        )
        for rule, test in ((f"unique:{key}", "n > 1"), (f"one {other} per {key}", "others > 1")):
            parts.append(
                f"select '{rule}' as rule, count(*) filter ({test}) as violations, count(*) as rows, "
                f"round(count(*) filter ({test}) / count(*), 8) as rate from {per_key}"
            )
    return " union all ".join(parts)


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("rate", F.round("rate", 8))


@query(f"with {REPORTED_CTE} {_violations_sql(COMPLETENESS_SQL)}")
def check_completeness(spark, sf_dir):
    return _rounded(quality.check_completeness(reported_sales(spark, sf_dir, *MANDATORY)))


@query(f"with {REPORTED_CTE} {_violations_sql(LENGTH_SQL)}")
def check_lengths(spark, sf_dir):
    return _rounded(quality.check_lengths(reported_sales(spark, sf_dir, *[f.name for f in LIMITED])))


@query(f"with {REPORTED_CTE} {_uniqueness_sql()}")
def check_uniqueness(spark, sf_dir):
    return _rounded(quality.check_uniqueness(reported_sales(spark, sf_dir, "product_article", "barcode")))


@query(f"with {REPORTED_CTE} {_violations_sql(AMOUNT_SQL)}")
def check_sales_amount(spark, sf_dir):
    return _rounded(
        quality.check_sales_amount(reported_sales(spark, sf_dir, "sales_amount_rub", "avg_sell_price", "sales_quantity"))
    )


@query(f"with {REPORTED_CTE} {_violations_sql(MARGIN_RULE_SQL)}")
def check_margin(spark, sf_dir):
    fields = ("margin_amount_rub", "sales_amount_rub", "avg_cost_price", "sales_quantity")
    return _rounded(quality.check_margin(reported_sales(spark, sf_dir, *fields)))


@query(f"with {REPORTED_CTE} {_violations_sql(WEIGHT_SQL)}")
def check_weight(spark, sf_dir):
    fields = ("weight", "sales_quantity", "sales_weight_kg", "sales_tons")
    return _rounded(quality.check_weight(reported_sales(spark, sf_dir, *fields)))


@query(f"with {REPORTED_CTE} {_violations_sql(DATE_SQL)}")
def check_date_bounds(spark, sf_dir):
    rows = reported_sales(spark, sf_dir, "sale_date", "sale_month")
    return _rounded(quality.check_date_bounds(rows, FIRST_DATE, LAST_DATE))


@query(f"with {REPORTED_CTE} {_violations_sql(ROW_RULES_SQL)} union all {_uniqueness_sql()}")
def quality_report(spark, sf_dir):
    return _rounded(quality.quality_report(reported_sales(spark, sf_dir), first=FIRST_DATE, last=LAST_DATE))


BROKEN_SQL = " or ".join(f"coalesce({test}, false)" for test in ROW_RULES_SQL.values())


CLEAN_SQL = (
    f"not ({BROKEN_SQL}) and barcode not in "
    "(select barcode from sales where barcode is not null group by 1 having count(distinct product_article) > 1)"
)


@query(
    f"with {REPORTED_CTE} select retail_chain, product_type, count(*) as rows, {MEASURE_SQL} from sales "
    f"where {CLEAN_SQL} group by 1, 2"
)
def publish_clear_view(spark, sf_dir):
    """The lasting view, read by another session."""
    record = reported_sales(spark, sf_dir)
    folder = scratch_path(spark, "clear")
    made = quality.publish_lasting_view(record, "shelfwise_clear", folder, first=FIRST_DATE, last=LAST_DATE)
    clear = spark.newSession().table(made["view"]).groupBy("retail_chain", "product_type")
    return _plain_measures(clear.agg(F.count(F.lit(1)).alias("rows"), *[F.sum(m).alias(m) for m in MEASURES]))


# Star schema.


def _key_sql(dimension: str) -> str:
    parts = [
        f"case when {c} is null then '-' else concat(length(cast({c} as varchar)), ':', cast({c} as varchar)) end"
        for c in reports.DIMENSIONS[dimension]
    ]
    return f"md5(concat({', '.join(parts)}))"


def _dimension_sql(dimension: str) -> str:
    fields = reports.DIMENSIONS[dimension]
    return (
        f"with {sales_cte(*fields)} select distinct {_key_sql(dimension)} as {dimension}_key, "
        f"{', '.join(_printed(f) for f in fields)} from sales"
    )


def _dimension(spark, sf_dir, name: str) -> DataFrame:
    fields = reports.DIMENSIONS[name]
    built = reports.build_dimension(sales(spark, sf_dir, *fields), name)
    return built.selectExpr(f"{name}_key", *[_printed(f) for f in fields])


@query(_dimension_sql("product"))
def product_dimension(spark, sf_dir):
    return _dimension(spark, sf_dir, "product")


@query(_dimension_sql("store"))
def store_dimension(spark, sf_dir):
    return _dimension(spark, sf_dir, "store")


@query(_dimension_sql("supplier"))
def supplier_dimension(spark, sf_dir):
    return _dimension(spark, sf_dir, "supplier")


@query(_dimension_sql("date"))
def date_dimension(spark, sf_dir):
    return _dimension(spark, sf_dir, "date")


KEYS_SQL = ", ".join(f"{_key_sql(d)} as {d}_key" for d in reports.DIMENSIONS)
FACT_SUMS = ", ".join(f"cast(sum({m}) as double) as {m}" for m in (*MEASURES, "avg_cost_price"))


def _summed(facts: DataFrame, keys: list[str]) -> DataFrame:
    """Rows and sums of measures per combination of keys. Nearly every row has its own, so the digests are shuffled
    as bytes, at half the length of their digits."""
    packed = facts.withColumns({k: F.unhex(k) for k in keys})
    sums = [F.sum(m).cast("double").alias(m) for m in (*MEASURES, "avg_cost_price")]
    summed = packed.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *sums)
    return summed.withColumns({k: F.lower(F.hex(k)) for k in keys})


@query(
    f"with {sales_cte(*ALL_FIELDS)} select {KEYS_SQL}, count(*) as rows, {FACT_SUMS} from sales group by 1, 2, 3, 4"
)
def build_facts(spark, sf_dir):
    return _summed(reports.build_facts(sales(spark, sf_dir)), [f"{d}_key" for d in reports.DIMENSIONS])


# From files to facts: every field of the record as a chain would name it; the rest keep their names.
DROP_NAMES = {
    "product_name": "Наименование", "product_code": "Код", "address": "Адрес", "city": "Город", "region": "Регион",
    "branch": "Филиал", "supplier": "Поставщик", "product_article": "мерчандайзинг", "product_type": "вид",
    "product_level_1": "уровень 1", "product_level_2": "уровень 2", "product_level_3": "уровень 3", "product_level_4": "уровень 4",
}
READ_AS = {"supplier": "supplier_name"} | {f: n for f, n in DROP_NAMES.items() if f.startswith("product_") and n not in ("Наименование", "Код")}
DROP_RECORDS = 500_000
FACT_KEYS = ("product", "store", "supplier", "date")


@query(
    f"with {REPORTED_CTE} select {', '.join(f'{_key_sql(d)} as {d}_key' for d in FACT_KEYS)}, count(*) as rows, {FACT_SUMS} "
    f"from sales where {CLEAN_SQL} group by 1, 2, 3, 4"
)
def files_to_facts(spark, sf_dir):
    """The whole path: drop files of every line, loaded and published, read as the standard record, checked, and as facts."""
    drop, sink, clear = (scratch_path(spark, name) for name in ("drop", "sink", "clear"))
    fields = tuple(REPORTED)
    rows = reported_sales(spark, sf_dir, *fields)
    texts = rows.select([F.col(f).cast("string").alias(DROP_NAMES.get(f, f)) for f in fields])
    # Files that cannot be split, hence many: plain text would take most of the disk.
    compressed = {"compression": "gzip", "maxRecordsPerFile": DROP_RECORDS}
    texts.write.options(**CSV_OPTIONS, header=True, emptyValue="", **compressed).csv(drop)
    load_chain(spark, drop, ChainProfile("facts", "part-", "facts", MAGNIT.rules, ".csv.gz"), {}, sink, register=False)
    kinds = {f.name: f.type for f in STANDARD}
    mapping = {f: standard.typed(READ_AS.get(f, f), kinds[f]) for f in fields}
    record = standard.to_standard(published.read(spark, sink), mapping)
    made = quality.publish_lasting_view(record, "shelfwise_facts", clear, first=FIRST_DATE, last=LAST_DATE)
    return _summed(reports.build_facts(spark.table(made["view"])), [f"{d}_key" for d in FACT_KEYS])
