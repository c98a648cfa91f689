"""Registered queries: drop files and sink tables, written from the given tables and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.text import table_name_for as table_name_column
from shelfwise.operators.cleaning import cast_all_to_string
from shelfwise.plans import load
from shelfwise.plans.bindings import PRODUCT_LABELS, drop_rows, product_labels, sales, table
from shelfwise.plans.learning import GRAMS_SQL, PACK_CASE
from shelfwise.plans.registry import query, sales_cte
from shelfwise.plans.rows import DROP_CTE
from shelfwise.profiles import MAGNIT, ChainProfile
from shelfwise.session import scratch_path
from shelfwise.sources import files, published, sinks
from shelfwise.streaming import ingest

# Spark names the files it writes; this profile finds them.
WRITTEN = ChainProfile("written", "part-", "written", ())
STAGE = "shelfwise_stage"

# Product rows with quotes and line breaks inside cells.
NAME_SQL = "concat('\"', p_brand, '\" ', case p_type when 'PROMO' then 'два\nслова ' else '' end, p_name)"


def _assortment(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(
        F.expr("concat('\"', p_brand, '\" ', case p_type when 'PROMO' then 'два\\nслова ' else '' end, p_name)").alias(
            "name"
        ),
        F.col("p_partkey").cast("string").alias("article"),
        F.col("p_type").alias("kind"),
    )


ASSORTMENT_SQL = f"select {NAME_SQL} as name, cast(p_partkey as varchar) as article, p_type as kind from part"


def _write_drop(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).options(**files.CSV_OPTIONS).option("header", True).csv(path)


def _written(spark: SparkSession, path: str) -> list[str]:
    return [r["path"] for r in files.discover_files(spark, path, WRITTEN.file_prefix).collect()]


@query(ASSORTMENT_SQL)
def read_chain_csv(spark, sf_dir):
    path = scratch_path(spark, "drop")
    _write_drop(_assortment(spark, sf_dir), path)
    return files.read_chain_csv(spark, _written(spark, path))


@query(
    "select 'bad' as state, concat_ws(';', p_name, cast(p_partkey as varchar), p_type, p_brand) as row from part "
    "where p_type = 'PROMO' union all select 'good', concat_ws(';', p_name, cast(p_partkey as varchar), p_type) from part "
    "where p_type <> 'PROMO'"
)
def quarantine_bad_rows(spark, sf_dir):
    """Every promotion row has a surplus cell."""
    path = scratch_path(spark, "drop")
    line = "concat_ws(';', p_name, cast(p_partkey as string), p_type, if(p_type = 'PROMO', p_brand, null))"
    lines = table(spark, sf_dir, "part").select(F.expr(line).alias("name;article;kind"))
    lines.write.options(sep="\x01", header=True).csv(path)
    raw = files.read_raw(spark, _written(spark, path))[0]
    good, bad = files.quarantine_bad_rows(raw)
    joined = good.select(F.lit("good").alias("state"), F.concat_ws(";", "name", "article", "kind").alias("row"))
    return joined.unionByName(bad.select(F.lit("bad").alias("state"), "row"))


@query(f"select kind, count(*) as rows from ({ASSORTMENT_SQL}) group by 1")
def discover_files(spark, sf_dir):
    """Rows of the discovered files, per kind: a file of another name in the folder is not read."""
    path = scratch_path(spark, "drop")
    assortment = _assortment(spark, sf_dir)
    _write_drop(assortment, path)
    assortment.select("name").write.mode("append").text(path)
    found = files.read_chain_csv(spark, _written(spark, path))
    return found.groupBy("kind").agg(F.count(F.lit(1)).alias("rows"))


@query("select distinct p_type as folder from part")
def discover_files_recursive(spark, sf_dir):
    path = scratch_path(spark, "drop")
    _assortment(spark, sf_dir).write.partitionBy("kind").options(**files.CSV_OPTIONS).csv(path)
    found = files.discover_files_recursive(spark, path)
    return found.select(F.regexp_extract("path", "kind=([^/]+)/", 1).alias("folder")).distinct()


TABLE_NAME_SQL = r"regexp_replace(lower(replace(concat('magnit_', url, '.csv'), '.csv', '')), '[^a-zA-Z0-9_]', '_', 'g')"


@query(f"select page_id, {TABLE_NAME_SQL} as table_name from pages")
def table_name_for(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").selectExpr("page_id", "concat('magnit_', url, '.csv') as name")
    return pages.select("page_id", table_name_column("name").alias("table_name"))


COLLISION_SQL = "regexp_replace(lower(concat(p_name, ' ', p_brand)), '[^a-zA-Z0-9_]', '_', 'g')"


@query(f"select {COLLISION_SQL} as table_name, count(*) as files from part group by 1 having count(*) > 1")
def table_collisions(spark, sf_dir):
    return files.table_collisions(table(spark, sf_dir, "part").selectExpr("concat(p_name, ' ', p_brand, '.csv') as name"))


@query(
    f"{ASSORTMENT_SQL.replace(' from part', ', null as supplier from part')} union all "
    "select null, null, null, s_name from supplier"
)
def load_many_files(spark, sf_dir):
    """Files with two different headers in one folder."""
    path = scratch_path(spark, "drop")
    _write_drop(_assortment(spark, sf_dir), path)
    _write_drop(table(spark, sf_dir, "supplier").selectExpr("s_name as supplier"), path)
    loaded = files.load_many_files(spark, path, WRITTEN)
    return loaded.select("name", "article", "kind", "supplier")


@query("select distinct product_name, product_type from (" + PRODUCT_LABELS + ") where product_type <> 'PROMO'")
def read_labels(spark, sf_dir):
    """Labels written with copies and, for promotions, without a label."""
    path = scratch_path(spark, "labels")
    rows = product_labels(spark, sf_dir).selectExpr(
        "product_name", "case when product_type <> 'PROMO' then product_type end as product_type"
    )
    _write_drop(rows.unionByName(rows), path)
    return files.read_labels(spark, path, "product_name", "product_type")


# Sinks.


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")


LINES_SQL = (
    "select cast(l_orderkey as varchar) as l_orderkey, cast(l_linenumber as varchar) as l_linenumber, "
    "cast(l_partkey as varchar) as l_partkey, cast(l_quantity as varchar) as l_quantity, l_returnflag from lineitem"
)


@query("select p_type, count(*) as rows from part group by 1")
def ensure_schema(spark, sf_dir):
    """A schema asked for twice, and a table in it."""
    for _ in range(2):
        sinks.ensure_schema(spark, STAGE, scratch_path(spark, STAGE))
    part = table(spark, sf_dir, "part").select("p_type", "p_partkey")
    sinks.write_replace(part, STAGE, "kinds", scratch_path(spark, "kinds"))
    return spark.table(sinks.table_id(STAGE, "kinds")).groupBy("p_type").agg(F.count(F.lit(1)).alias("rows"))


@query("select p_name, p_brand, cast(p_partkey as varchar) as article, 'part.csv' as file from part")
def ensure_table(spark, sf_dir):
    """An all-text table, filled, then asked for again: its rows stay."""
    part = table(spark, sf_dir, "part").selectExpr("p_name", "p_brand", "p_partkey as article", "'part.csv' as file")
    sinks.ensure_schema(spark, STAGE, scratch_path(spark, STAGE))
    created = f"created_{uuid.uuid4().hex}"
    place = scratch_path(spark, "created")
    sinks.ensure_table(spark, STAGE, created, part.columns, place)
    sinks.write_append(part, STAGE, created, "file")
    sinks.ensure_table(spark, STAGE, created, part.columns, place)
    return spark.table(sinks.table_id(STAGE, created))


@query(LINES_SQL)
def write_replace(spark, sf_dir):
    """Two loads of one file leave the second."""
    lines = _lines(spark, sf_dir)
    sinks.ensure_schema(spark, STAGE, scratch_path(spark, STAGE))
    place = scratch_path(spark, "replaced")
    for rows in (lines.filter("l_quantity > 25"), lines):
        sinks.write_replace(rows, STAGE, "replaced", place)
    return spark.table(sinks.table_id(STAGE, "replaced"))


@query(f"select *, l_returnflag || '.csv' as file from ({LINES_SQL}) union all select *, 'again.csv' from ({LINES_SQL})")
def write_append(spark, sf_dir):
    """A load that broke off and one that repeats it leave every row once; equal rows of another file stay."""
    lines = _lines(spark, sf_dir).withColumn("file", F.concat("l_returnflag", F.lit(".csv")))
    sinks.ensure_schema(spark, STAGE, scratch_path(spark, STAGE))
    sinks.write_replace(lines.filter("l_quantity > 25"), STAGE, "appended", scratch_path(spark, "appended"))
    for rows in (lines, lines, lines.withColumn("file", F.lit("again.csv"))):
        sinks.write_append(rows, STAGE, "appended", "file")
    return spark.table(sinks.table_id(STAGE, "appended"))


CHAIN_CTE = sales_cte("retail_chain")


@query(
    f"with {CHAIN_CTE} select lower(retail_chain) as table_name, count(*) as source_rows, count(*) as sink_rows "
    "from sales group by 1"
)
def reconcile_counts(spark, sf_dir):
    rows = sales(spark, sf_dir, "retail_chain", "product_article").selectExpr(
        "'all' as chain", "lower(retail_chain) as table_name", "product_article"
    )
    path = scratch_path(spark, "tables")
    sinks.write_tables(rows, path)
    counts = sinks.reconcile_counts(rows, spark.read.parquet(path))
    sinks.require_reconciled(counts)
    return counts


@query(
    "select p_name as \"Name\", cast(p_size as varchar) as size, p_brand as brand, replace(p_type, ' ', '_') as kind from part"
)
def export_csv(spark, sf_dir):
    path = scratch_path(spark, "export")
    part = table(spark, sf_dir, "part")
    rows = part.selectExpr("p_name as `'Name'`", "p_size as `size`", "p_brand as ` brand []`", "p_type as kind")
    sinks.export_csv(rows.withColumnRenamed(" brand []", "(brand)"), path, sheet="kind")
    back = spark.read.options(**files.CSV_OPTIONS).option("header", True).csv(path)
    return cast_all_to_string(back)


LOADED = ChainProfile("loaded", "part-", "loaded", MAGNIT.rules)
LOADED_SQL = (
    f"cast({GRAMS_SQL} as varchar) as weight_extracted_regex, {PACK_CASE} as package_type, '' as city_predicted"
)


@query(
    f"with {sales_cte('retail_chain', 'product_name', 'product_article', 'address', 'sales_quantity', 'barcode')} "
    "select product_name, cast(product_article as varchar) as product_code, "
    "case when retail_chain in ('BUILDING', 'MACHINERY') then cast(sales_quantity as varchar) end as amount, "
    f"case when coalesce(retail_chain not in ('BUILDING', 'MACHINERY'), true) then address end as address, {LOADED_SQL}, "
    "count(*) as rows, 0 as bad_rows from sales group by all "
    "union all select barcode, null, null, null, null, null, null, null, count(*) from sales "
    "where retail_chain = 'MACHINERY' group by 1"
)
def stream_new_files(spark, sf_dir):
    """Files of two headers and with malformed rows that arrive in two waves, loaded by three runs: every row once.

    Machinery rows are also dropped with a surplus cell; those are quarantined.
    """
    drop, sink, state = (scratch_path(spark, name) for name in ("drop", "sink", "state"))
    rows = sales(spark, sf_dir, "retail_chain", "product_name", "product_article", "address", "sales_quantity", "barcode")
    first = F.coalesce(F.col("retail_chain").isin("BUILDING", "MACHINERY"), F.lit(False))
    early = rows.filter(first).selectExpr("product_name as `Наименование`", "product_article as `Артикул`", "sales_quantity as amount")
    late = rows.filter(~first).selectExpr("address as `Адрес`", "product_article as `Артикул`", "product_name as `Товар`")
    surplus = rows.filter("retail_chain = 'MACHINERY'").select(F.concat("barcode", F.lit(";1;2;3")).alias("Наименование;Артикул;amount"))
    for wave in (early, late, None):
        if wave is not None:
            _write_drop(wave, drop)
        if wave is early:
            surplus.write.mode("append").options(sep="\x01", header=True).csv(drop)
        query = ingest.stream_new_files(spark, drop, LOADED, {}, sink, state, register=False)
        query.awaitTermination()
    columns = ("product_name", "product_code", "amount", "address", "weight_extracted_regex", "package_type", "city_predicted")
    good = published.read(spark, sink).groupBy(*columns).agg(F.count(F.lit(1)).alias("rows")).withColumn("bad_rows", F.lit(0))
    bad = published.quarantined(spark, sink).groupBy(F.split("row", ";")[0].alias("product_name"))
    return good.unionByName(bad.agg(F.count(F.lit(1)).alias("bad_rows")), allowMissingColumns=True)


@query(
    f"with {DROP_CTE} select product_name, cast(product_code as varchar) as product_code, address, city, region, branch, "
    f"supplier as supplier_name, cast(sales_quantity as varchar) as amount, {LOADED_SQL}, count(*) as rows, 0 as bad_rows "
    "from sales where sales_quantity > 20 group by all "
    "union all select product_name, null, null, null, null, branch, null, null, "
    f"{LOADED_SQL}, count(*), 0 from sales where sales_quantity <= 20 group by all "
    "union all select supplier, null, null, null, null, null, null, null, null, null, null, null, count(*) "
    "from sales where sales_quantity = 1 group by 1"
)
def load_chain(spark, sf_dir):
    """Drop files of every line item under two headers, one with malformed rows, read back after two loads.

    The second load finds the first one's files again, with others beside them: it replaces every table.
    """
    path, sink = scratch_path(spark, "drop"), scratch_path(spark, "sink")
    headers = ("Наименование", "Артикул", "Адрес", "Город", "Регион", "Филиал", "Поставщик", "amount")
    rows = drop_rows(spark, sf_dir, *headers)
    _write_drop(rows.filter("amount > 20"), path)
    rows.filter("amount = 1").select(F.concat("Поставщик", F.lit(";x;y")).alias("Товар;Филиал")).write.mode("append").options(
        sep="\x01", header=True
    ).csv(path)
    load.load_chain(spark, path, LOADED, {}, sink, "quarantine", register=False)
    _write_drop(rows.filter("amount <= 20").selectExpr("`Филиал` as branch", "`Наименование` as `[product]`"), path)
    load.load_chain(spark, path, LOADED, {}, sink, "quarantine", register=False)
    columns = ("product_name", "product_code", "address", "city", "region", "branch", "supplier_name", "amount")
    columns += ("weight_extracted_regex", "package_type", "city_predicted")
    good = published.read(spark, sink).groupBy(*columns).agg(F.count(F.lit(1)).alias("rows")).withColumn("bad_rows", F.lit(0))
    bad = published.quarantined(spark, sink).groupBy(F.split("row", ";")[0].alias("product_name"))
    return good.unionByName(bad.agg(F.count(F.lit(1)).alias("bad_rows")), allowMissingColumns=True)
