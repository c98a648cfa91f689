"""Tables and files out."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.text import literal, quoted
from shelfwise.operators.cleaning import cast_all_to_string, truncate_strings
from shelfwise.operators.headers import dedupe_names, export_header
from shelfwise.operators.joins import semi_join
from shelfwise.operators.sampling import mark_smallest_hashes
from shelfwise.sources.files import CSV_OPTIONS

# Column width and insert batch of a database sink.
SINK_COLUMN_TYPE = "NVARCHAR(255)"
INSERT_BATCH = 1000
# End of fixed values.

EXPORT_SEED = 42


def table_id(chain: str, table: str) -> str:
    return f"{quoted(chain)}.{quoted(table)}"


def ensure_schema(spark: SparkSession, chain: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(chain)}{where}")


def ensure_table(spark: SparkSession, chain: str, table: str, columns: list[str], location: str | None = None) -> None:
    """An all-text table; an existing one is left as it is."""
    ensure_schema(spark, chain)
    typed = ", ".join(f"{quoted(c)} STRING" for c in columns)
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table_id(chain, table)} ({typed}) USING PARQUET{where}")


def sink_text(df: DataFrame) -> DataFrame:
    """All columns as text of at most the sink's length; nulls stay nulls."""
    return truncate_strings(cast_all_to_string(df))


def point_table(spark: SparkSession, chain: str, table: str, columns: list[tuple[str, str]], location: str) -> None:
    """Let a catalog table read ``location``; it is created if there is none, and its files are left alone.

    With the columns it has, the table changes over in one statement. With others it is made anew, as its columns
    are part of it.
    """
    ensure_schema(spark, chain)
    name = table_id(chain, table)
    if spark.catalog.tableExists(name):
        if spark.table(name).dtypes == columns:
            spark.sql(f"ALTER TABLE {name} SET LOCATION {literal(location)}")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")
    typed = ", ".join(f"{quoted(c)} {kind}" for c, kind in columns)
    spark.sql(f"CREATE TABLE {name} ({typed}) USING PARQUET LOCATION {literal(location)}")


def write_replace(df: DataFrame, chain: str, table: str, location: str | None = None) -> None:
    """Replace a chain table by the rows of ``df``.

    The rows are written to a folder of their own below ``location`` (default: the warehouse) and counted there;
    only then the table is pointed at it. A write that fails, or that stores another number of rows than it was
    given, leaves the table as it was.
    """
    spark = df.sparkSession
    base = location or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{chain}.db/{table}"
    version = f"{base.rstrip('/')}/version-{uuid.uuid4().hex}"
    rows, seen = observed(sink_text(df))
    rows.write.parquet(version)
    stored = spark.read.schema(rows.schema).parquet(version).count()
    if stored != seen.get["rows"]:
        raise ValueError(f"{seen.get['rows']} rows written but {stored} stored in {version}")
    point_table(spark, chain, table, rows.dtypes, version)


def missing_rows(df: DataFrame, present: DataFrame) -> DataFrame:
    """Rows of ``df`` not yet in ``present``, copies counted.

    Both sides are counted per distinct row before they meet, so copies cost one row per task.
    """
    return df.exceptAll(present.select(*[F.col(quoted(c)) for c in df.columns]))


def write_append(df: DataFrame, chain: str, table: str, file_col: str) -> None:
    """Append what the table does not hold yet of the same files: a repeated load adds nothing.

    ``file_col`` names the file (or load) a row came from. An equal row of another file is a row of its own.
    """
    spark = df.sparkSession
    rows = sink_text(df)
    present = semi_join(spark.table(table_id(chain, table)), rows, [file_col])
    missing_rows(rows, present).write.mode("append").format("parquet").saveAsTable(table_id(chain, table))


def write_tables(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder per chain and table; every task writes the tables of its own rows, no shuffle."""
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("chain", "table_name").parquet(path)


def jdbc_writer(df: DataFrame, url: str, table: str, **options: str) -> DataFrameWriter:
    """A database writer for the caller to save with; connection options come from the caller."""
    rows = sink_text(df)
    types = ", ".join(f"{quoted(c)} {SINK_COLUMN_TYPE}" for c in rows.columns)
    settings = {
        "url": url,
        "dbtable": table,
        "batchsize": str(INSERT_BATCH),
        "truncate": "true",
        "createTableColumnTypes": types,
        **options,
    }
    return rows.write.format("jdbc").options(**settings)


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` and a count of its rows taken while some action runs over it."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def table_counts(df: DataFrame, table_col: str, name: str) -> DataFrame:
    return df.groupBy(F.col(quoted(table_col)).alias("table_name")).agg(F.count(F.lit(1)).alias(name))


def reconcile_counts(source: DataFrame, sink: DataFrame, table_col: str = "table_name") -> DataFrame:
    """(table_name, source_rows, sink_rows): per-table counts side by side."""
    left = table_counts(source, table_col, "source_rows")
    right = table_counts(sink, table_col, "sink_rows")
    joined = left.join(right, "table_name", "full_outer")
    return joined.select(
        "table_name", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("source_rows", "sink_rows")]
    )


def require_reconciled(counts: DataFrame) -> None:
    """Raise if any table holds another number of rows than its source."""
    wrong = counts.filter("source_rows <> sink_rows").limit(20).collect()
    if wrong:
        raise ValueError("row counts differ: " + ", ".join(str(r.asDict()) for r in wrong))


def sheet_suffix(col: str):
    return F.translate(F.col(quoted(col)), " /", "__")


def export_csv(df: DataFrame, path: str, max_rows: int | None = None, sheet: str | None = None) -> None:
    """Text files with cleaned headers, every cell quoted; ``sheet`` makes one folder per value.

    ``max_rows`` caps the export, as a whole or per sheet, to the same rows each time: those whose cells have the
    smallest hashes. All sheets are capped together, and none is sorted.
    """
    names = dedupe_names([c if c == sheet else export_header(c) for c in df.columns])
    out = cast_all_to_string(df).toDF(*names)
    if sheet is not None:
        out = out.withColumn(sheet, sheet_suffix(sheet))
    if max_rows is not None:
        cells = F.to_json(F.struct(*[F.col(quoted(c)) for c in names]))
        group = F.lit("") if sheet is None else F.to_json(F.struct(F.col(quoted(sheet))))
        keyed = out.withColumns({"_cells": cells, "_group": group})
        marked = mark_smallest_hashes(keyed, ["_group"], ["_cells"], F.lit(max_rows).cast("bigint"), EXPORT_SEED, "_taken")
        out = marked.filter("_taken").select(*[F.col(quoted(c)) for c in names])
    writer = out.write.mode("overwrite").options(**CSV_OPTIONS).options(header=True, quoteAll=True)
    (writer.partitionBy(sheet) if sheet else writer).csv(path)
