"""Chain tables under a sink folder, published as a whole.

Each load writes a version folder of its own; nothing reads it until one file is added to the log, which names the
version of every table of the load. A load that breaks off leaves no entry, so readers go on with what they had.
A table's rows, and the malformed rows of its file, are replaced only by a later load of that same file.

``data/load=*/chain=*/table_name=*`` holds the rows as text, ``quarantine/load=*/chain=*/table_name=*`` the malformed
rows and ``log`` one row per load and table. Folders that are no longer current stay until their owner removes them.
"""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.text import quoted
from shelfwise.operators.joins import semi_join
from shelfwise.sources import sinks

LOG_SCHEMA = (
    "load string, version bigint, published_at timestamp, chain string, table_name string, file string,"
    " columns array<string>, added_columns bigint, rows bigint, bad_rows bigint"
)
PLACE = ("load", "chain", "table_name")
BAD_COLUMNS = ("file", "row")


def new_load() -> str:
    return uuid.uuid4().hex


def _folder(sink: str, part: str) -> str:
    return f"{sink.rstrip('/')}/{part}"


def version_folder(sink: str, load: str, part: str = "data") -> str:
    return f"{_folder(sink, part)}/load={load}"


def table_folder(sink: str, load: str, chain: str, table: str) -> str:
    """Where one version of one table lies, as Spark names partition folders."""
    return f"{version_folder(sink, load)}/chain={chain}/table_name={table}"


def is_shuffled(rows: DataFrame) -> bool:
    """Whether the plan deals rows out anew; a broadcast leaves them where they are."""
    return re.search(r"\bExchange\b", rows._jdf.queryExecution().executedPlan().toString()) is not None


def write_version(rows: DataFrame, sink: str, load: str, part: str = "data") -> None:
    """Write a load's rows, with ``chain`` and ``table_name``, to its version folder; a repetition replaces it.

    Rows still lie as they were parsed, file by file, unless something shuffled them: then a table's rows are in few
    tasks, and are written from there. Shuffled rows are rebalanced by table first: small tables take one file each, large
    ones as many as they need, however many tasks had rows of them. A small table that shares a shuffle partition with a
    large one may be cut with it.
    """
    if is_shuffled(rows):
        rows = rows.hint("rebalance", "chain", "table_name")
    rows.write.mode("overwrite").partitionBy("chain", "table_name").parquet(version_folder(sink, load, part))


def version_counts(spark: SparkSession, sink: str, load: str, part: str = "data") -> DataFrame:
    """(table_name, rows) as stored in a version folder."""
    # Partition values only: the counts come from the files' footers.
    rows = spark.read.schema("chain string, table_name string").parquet(version_folder(sink, load, part))
    return rows.groupBy("table_name").agg(F.count(F.lit(1)).alias("rows"))


def open_sink(spark: SparkSession, sink: str) -> None:
    """Begin an empty log if the sink has none."""
    spark.createDataFrame([], LOG_SCHEMA).write.mode("ignore").parquet(_folder(sink, "log"))


def log(spark: SparkSession, sink: str) -> DataFrame:
    """All publications; empty if there was none."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(_folder(sink, "log"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def publish(entries: DataFrame, sink: str, load: str) -> None:
    """Make a load current: (chain, table_name, file, columns, added_columns, rows, bad_rows) of its tables.

    One file is the whole commit: readers see all its tables or none. A load is published once.
    """
    spark = entries.sparkSession
    known = log(spark, sink)
    if not known.filter(F.col("load") == load).isEmpty():
        return
    version = known.agg(F.coalesce(F.max("version"), F.lit(0)) + 1).first()[0]
    stamped = entries.withColumns(
        {"load": F.lit(load), "version": F.lit(version).cast("bigint"), "published_at": F.current_timestamp()}
    )
    names = [f.name for f in T.StructType.fromDDL(LOG_SCHEMA)]
    stamped.select(*names).coalesce(1).write.mode("append").parquet(_folder(sink, "log"))


def current(spark: SparkSession, sink: str, chain: str | None = None) -> DataFrame:
    """The latest log entry of each table."""
    entries = log(spark, sink)
    if chain is not None:
        entries = entries.filter(F.col("chain") == chain)
    newest = entries.groupBy("chain", "table_name").agg(
        F.max_by(F.struct("*"), F.struct("version", "load")).alias("entry")
    )
    return newest.select("entry.*")


def _stored(spark: SparkSession, sink: str, part: str, columns: list[str], entries: DataFrame) -> DataFrame:
    """The rows of the versions that ``entries`` name; ``columns`` are all text."""
    fields = [T.StructField(c, T.StringType()) for c in (*columns, *PLACE)]
    # One folder per load that is still needed: older versions are not even listed.
    loads = [r["load"] for r in entries.select("load").distinct().collect()]
    if not loads:
        return spark.createDataFrame([], T.StructType(fields))
    reader = spark.read.schema(T.StructType(fields)).option("basePath", _folder(sink, part))
    rows = reader.parquet(*[version_folder(sink, load, part) for load in loads])
    return semi_join(rows, entries, list(PLACE)).select(*[F.col(quoted(f.name)) for f in fields])


def _all_columns(entries: DataFrame) -> list[str]:
    """The columns of all tables, each once, in the order of their first headers."""
    headers = entries.select("columns").distinct().orderBy(F.concat_ws(";", "columns")).collect()
    return list(dict.fromkeys(c for r in headers for c in r["columns"]))


def read(spark: SparkSession, sink: str, chain: str | None = None) -> DataFrame:
    """The current rows of all tables, of one chain or of all, with ``load``, ``chain`` and ``table_name``.

    Tables may have unlike headers: a column that a table lacks is null in its rows. The columns come from the log,
    so that no file is opened to find them.
    """
    entries = current(spark, sink, chain)
    return _stored(spark, sink, "data", _all_columns(entries), entries)


def read_table(spark: SparkSession, sink: str, chain: str, table: str) -> DataFrame:
    """The current rows of one table under its own columns."""
    entries = current(spark, sink, chain).filter(F.col("table_name") == table)
    columns = _all_columns(entries)
    return _stored(spark, sink, "data", columns, entries).select(*[F.col(quoted(c)) for c in columns])


def quarantined(spark: SparkSession, sink: str, chain: str | None = None, history: bool = False) -> DataFrame:
    """(file, row, load, chain, table_name): malformed rows of the current versions, or of all ever published."""
    entries = log(spark, sink) if history else current(spark, sink, chain)
    if chain is not None:
        entries = entries.filter(F.col("chain") == chain)
    return _stored(spark, sink, "quarantine", list(BAD_COLUMNS), entries.filter("bad_rows > 0"))


def register_tables(spark: SparkSession, sink: str, chain: str, load: str | None = None) -> list[str]:
    """Point a catalog table per drop file at its current version, or only those of one load; their names.

    Metadata only: one statement or a few for each file.
    """
    entries = current(spark, sink, chain)
    if load is not None:
        entries = entries.filter(F.col("load") == load)
    found = entries.select("load", "table_name", "columns").collect()
    for row in found:
        place = table_folder(sink, row["load"], chain, row["table_name"])
        sinks.point_table(spark, chain, row["table_name"], [(c, "string") for c in row["columns"]], place)
    return sorted(row["table_name"] for row in found)
