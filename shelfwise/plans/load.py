"""The load of a chain: files in, enriched text tables out, counts reconciled before anything is published."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.enrich import enrich_columns
from shelfwise.operators.headers import free_name, standardize_columns
from shelfwise.operators.stats import ROWS_PER_CHUNK
from shelfwise.profiles import ChainProfile
from shelfwise.session import settle
from shelfwise.sources import files, published, sinks
from shelfwise.sources.files import BAD_ROW, FILE

SUMMARY = "file string, chunks bigint, rows bigint, added_columns bigint, bad_rows bigint"


def load_chain(
    spark: SparkSession,
    folder: str,
    profile: ChainProfile,
    models: Mapping[str, PipelineModel],
    sink: str,
    mode: str = "strict",
    rules: str = "compat",
    register: bool = True,
) -> DataFrame:
    """Load all drop files of a chain that lie in a folder; see :func:`load_files`. An empty day loads nothing."""
    found = files.discover_files(spark, folder, profile.file_prefix, profile.file_suffix)
    paths = sorted(r["path"] for r in found.select("path").collect())
    return load_files(spark, paths, profile, models, sink, mode, rules, register=register)


def load_files(
    spark: SparkSession,
    paths: list[str],
    profile: ChainProfile,
    models: Mapping[str, PipelineModel],
    sink: str,
    mode: str = "strict",
    rules: str = "compat",
    register: bool = True,
    load: str | None = None,
) -> DataFrame:
    """Load drop files to ``sink``; returns (file, chunks, rows, added_columns, bad_rows), one row per table.

    The files are parsed once. Every header is renamed and enriched by itself, all rows are written to a new
    version, and only if each table holds as many rows as its file had, the version becomes current: see
    :mod:`shelfwise.sources.published`. On a malformed row (unless ``mode='quarantine'``, which keeps it aside), on
    two files for one table and on a count that differs it raises, and the sink stays as it was. Loading a file
    again replaces its table and its malformed rows, also by none; a file without a header changes nothing.

    ``register`` points a catalog table per file, in a schema per chain, at its rows. ``load`` names the load: one
    that was published before is not done again.
    """
    load = load or published.new_load()
    if not paths:
        return spark.createDataFrame([], SUMMARY)
    published.open_sink(spark, sink)
    if published.log(spark, sink).filter(F.col("load") == load).isEmpty():
        _load_version(spark, paths, profile, models, sink, mode, rules, load)
    if register:
        published.register_tables(spark, sink, profile.schema, load)
    return _summary(published.log(spark, sink).filter(F.col("load") == load))


def _load_version(
    spark: SparkSession,
    paths: list[str],
    profile: ChainProfile,
    models: Mapping[str, PipelineModel],
    sink: str,
    mode: str,
    rules: str,
    load: str,
) -> None:
    collisions = files.table_collisions(_listed(spark, paths)).limit(20).collect()
    if collisions:
        raise ValueError("several files map to the same table: " + ", ".join(r["table_name"] for r in collisions))
    rows, bad, entries = [], [], []
    for group in files.header_groups(spark, paths, skip_empty=True):
        raw = files.read_group(spark, group)
        parsed = settle(files.prepare(raw, mode, lambda df: _canonical(df, profile, rules)), "parsed")
        is_bad = F.col(BAD_ROW).isNotNull()
        per_file = parsed.groupBy(FILE).agg(F.count_if(~is_bad).alias("rows"), F.count_if(is_bad).alias("bad_rows"))
        # A table's name is made once per file, not once per row.
        per_file = settle(per_file.withColumn("table_name", files.table_name_for(FILE)), "file_counts")
        counts = per_file.groupBy("table_name").agg(F.sum("rows").alias("rows"), F.sum("bad_rows").alias("bad_rows"))
        parsed = parsed.join(F.broadcast(per_file.select(FILE, "table_name")), FILE).withColumn("chain", F.lit(profile.schema))
        good = sinks.sink_text(enrich_columns(parsed.filter(~is_bad).drop(BAD_ROW, FILE), models))
        rows.append(good)
        bad.append(parsed.filter(is_bad).select(F.col(FILE).alias("file"), F.col(BAD_ROW).alias("row"), "chain", "table_name"))
        columns = [c for c in good.columns if c not in published.PLACE]
        added = [c for c in columns if c not in parsed.columns]
        # One row per file of the group, also for one without rows.
        entries.append(
            _listed(spark, group.paths)
            .select(F.lit(profile.schema).alias("chain"), files.table_name_for("name").alias("table_name"), F.col("name").alias("file"))
            .join(counts, "table_name", "left")
            .na.fill(0, ["rows", "bad_rows"])
            .withColumns(
                {"columns": F.array(*[F.lit(c) for c in columns]), "added_columns": F.lit(len(added)).cast("bigint")}
            )
        )
    if not entries:
        return
    published.write_version(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows), sink, load)
    published.write_version(reduce(DataFrame.unionByName, bad), sink, load, "quarantine")
    counted = settle(reduce(DataFrame.unionByName, entries), "counts")
    stored = published.version_counts(spark, sink, load).withColumnRenamed("rows", "sink_rows")
    both = counted.select("table_name", F.col("rows").alias("source_rows")).join(stored, "table_name", "full_outer")
    sinks.require_reconciled(both.na.fill(0))
    published.publish(counted, sink, load)


def _listed(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(name) of files."""
    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    return listed.select(F.element_at(F.split("path", "/"), -1).alias("name"))


def _canonical(df: DataFrame, profile: ChainProfile, rules: str) -> DataFrame:
    """Canonical names; a header that the sink uses for itself is numbered."""
    named = standardize_columns(df, profile, rules).columns
    taken = {*(c.lower() for c in named), *published.PLACE}
    return df.toDF(*[free_name(c, taken) if c.lower() in published.PLACE else c for c in named])


def _summary(entries: DataFrame) -> DataFrame:
    chunks = F.ceil(F.col("rows") / ROWS_PER_CHUNK).alias("chunks")
    return entries.select(F.col("table_name").alias("file"), chunks, "rows", "added_columns", "bad_rows")
