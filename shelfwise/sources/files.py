"""Reading the chains' drop files and the label files."""

from __future__ import annotations

import csv
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.text import literal, quoted, table_name_for
from shelfwise.operators.cleaning import drop_unnamed_columns, normalize_null_tokens
from shelfwise.operators.headers import BOM, dedupe_names, standardize_columns
from shelfwise.profiles import ChainProfile
from shelfwise.session import settle

CSV_OPTIONS = {"sep": ";", "quote": '"', "escape": '"', "encoding": "UTF-8"}
BAD_ROW, FILE = "_bad_row", "_file"


def literal_path(path: str) -> str:
    """A path as a reader takes it that must mean this one file or folder: glob characters are escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def discover_files(spark: SparkSession, folder: str, prefix: str, suffix: str = ".csv") -> DataFrame:
    """(path, name, length, modified) of the files ``prefix*.csv``, or of another ``suffix``, directly in a folder."""
    literal_folder = literal_path(folder.rstrip("/"))
    try:
        return _listing(spark.read.format("binaryFile").load(f"{literal_folder}/{prefix}*{suffix}"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, name string, length bigint, modified timestamp")


def discover_files_recursive(spark: SparkSession, folder: str) -> DataFrame:
    """All .csv, .xlsx and .xlsb files below a folder, in any letter case."""
    pattern = "*.{[cC][sS][vV],[xX][lL][sS][xX],[xX][lL][sS][bB]}"
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return _listing(reader.option("pathGlobFilter", pattern).load(literal_path(folder)))


def _listing(found: DataFrame) -> DataFrame:
    # The content column is pruned: nothing but the listing is read.
    return found.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        "length",
        F.col("modificationTime").alias("modified"),
    )


def table_collisions(files: DataFrame) -> DataFrame:
    """(table_name, files): sink table names that more than one file name maps to."""
    named = files.select(table_name_for("name").alias("table_name"))
    return named.groupBy("table_name").agg(F.count(F.lit(1)).alias("files")).filter("files > 1")


def _header_names(cells: list[str | None]) -> tuple[str, ...]:
    """Column names for header cells; blank cells are named as Spark names them."""
    named = [(c or "").lstrip(BOM) for c in cells]
    return tuple(dedupe_names([c if c.strip() else f"_c{i}" for i, c in enumerate(named)]))


def _header_cells(spark: SparkSession, path: str, line: str) -> list[str | None]:
    """The cells of a file's first line that is not blank; a cell may go on in the next lines."""
    if line.count('"') % 2:
        return list(spark.read.options(**CSV_OPTIONS).option("multiLine", True).csv(literal_path(path)).first())
    return next(csv.reader([line.lstrip(BOM)], delimiter=CSV_OPTIONS["sep"], quotechar=CSV_OPTIONS["quote"]))


def first_lines(spark: SparkSession, paths: list[str]) -> dict[str, tuple[str, bool]]:
    """Per file its first line that is not blank, and whether a line break lies inside quotes somewhere.

    One scan of the text for all files, with one short row per file as its result. A line of text with an
    odd number of quotes goes on in the next one: Spark cannot split such a file, so only these are
    read whole, each by one task. Files without a line are left out.
    """
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    lines = spark.read.text([literal_path(p) for p in paths]).select(
        F.col("_metadata.file_path").alias("path"), place.alias("place"), "value"
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    found = lines.groupBy("path").agg(
        F.min_by("value", F.when(F.col("value").rlike(r"[^\x00-\x20]"), F.col("place"))).alias("line"),
        F.max(quotes % 2 == 1).alias("broken"),
    )
    return {_same_file(r["path"]): (r["line"], r["broken"]) for r in found.filter("line is not null").collect()}


def file_name() -> Column:
    """The name of a row's file as it is on disk; Spark's metadata has it percent-encoded."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def _same_file(path: str) -> str:
    """Listings and file metadata spell a path differently (``file:/a b``, ``file:///a%20b``)."""
    return re.sub(r"^file:/*", "/", unquote(path))


@dataclass(frozen=True)
class HeaderGroup:
    """Files with the same header; ``whole`` ones cannot be split, as a line break lies inside quotes."""

    names: tuple[str, ...]
    split: tuple[str, ...]
    whole: tuple[str, ...]

    @property
    def paths(self) -> tuple[str, ...]:
        return self.split + self.whole


def header_groups(
    spark: SparkSession, paths: list[str], multi_line: bool | None = None, skip_empty: bool = False
) -> list[HeaderGroup]:
    """The files by their headers; ``multi_line=None`` finds out which files must be read whole.

    A file without a header raises, or is left out with ``skip_empty``.
    """
    if not paths:
        return []
    found = first_lines(spark, paths)
    groups: dict[tuple[str, ...], dict[bool, list[str]]] = {}
    for path in paths:
        if _same_file(path) not in found:
            if skip_empty:
                continue
            raise ValueError(f"{path} is empty")
        line, broken = found[_same_file(path)]
        names = _header_names(_header_cells(spark, path, line))
        whole = broken if multi_line is None else multi_line
        groups.setdefault(names, {False: [], True: []})[whole].append(path)
    return [HeaderGroup(names, tuple(ways[False]), tuple(ways[True])) for names, ways in groups.items()]


def read_group(spark: SparkSession, group: HeaderGroup) -> DataFrame:
    """The rows of a header group as text, with ``_file`` and, where a row is malformed, ``_bad_row``."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*group.names, BAD_ROW)])
    reader = spark.read.schema(schema).options(**CSV_OPTIONS).option("header", True)
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_ROW)
    # Without pruning, whether a row is malformed does not depend on the columns a query uses.
    reader = reader.option("columnPruning", False)
    parts = []
    for whole, paths in ((False, group.split), (True, group.whole)):
        if paths:
            rows = reader.option("multiLine", whole).csv([literal_path(p) for p in paths])
            parts.append(rows.select(*[F.col(quoted(c)) for c in rows.columns], file_name().alias(FILE)))
    return reduce(DataFrame.unionByName, parts)


def read_raw(spark: SparkSession, paths: list[str], multi_line: bool | None = None) -> list[DataFrame]:
    """Rows of drop files as text, one DataFrame per distinct header; none for no files."""
    return [read_group(spark, group) for group in header_groups(spark, paths, multi_line)]


def _data_columns(raw: DataFrame) -> list[str]:
    return [c for c in raw.columns if c not in (BAD_ROW, FILE)]


def too_many_cells(n_columns: int) -> Column:
    """True for a malformed row with surplus cells; a row that is merely short is padded with nulls."""
    # Possessive, without alternatives: a long cell needs no stack.
    unquoted = f"regexp_replace({BAD_ROW}, {literal('\"[^\"]*+(?:\"\"[^\"]*+)*+\"')}, '')"
    return F.coalesce(F.expr(f"size(split({unquoted}, ';')) > {n_columns}"), F.lit(False))


def quarantine_bad_rows(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, (file, row) of rows with more cells than the header) of one header group.

    The files are parsed once and kept: both parts read the parsed rows.
    """
    parsed = settle(raw, "parsed")
    bad = too_many_cells(len(_data_columns(raw)))
    return parsed.filter(~bad).drop(BAD_ROW), parsed.filter(bad).select(F.col(FILE).alias("file"), F.col(BAD_ROW).alias("row"))


def bad_rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, row) of the rows with more cells than their header, of all files."""
    parts = [quarantine_bad_rows(raw)[1] for raw in read_raw(spark, paths)]
    return reduce(DataFrame.unionByName, parts, spark.createDataFrame([], "file string, row string"))


def _with_verdict(raw: DataFrame, mode: str) -> DataFrame:
    """``_bad_row`` is kept where the row has surplus cells, else null; ``mode='strict'`` raises instead."""
    if mode not in ("strict", "quarantine"):
        raise ValueError(f"unknown mode {mode!r}")
    bad = too_many_cells(len(_data_columns(raw)))
    verdict = F.when(bad, F.col(BAD_ROW))
    if mode == "strict":
        message = F.concat(F.lit("malformed row in "), F.col(FILE), F.lit(": "), F.col(BAD_ROW))
        verdict = F.when(bad, F.raise_error(message).cast("string"))
    return raw.withColumn(BAD_ROW, verdict)


def prepare(
    raw: DataFrame, mode: str = "strict", rename: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame:
    """One header group cleaned and renamed, with ``_file``, and ``_bad_row`` set on malformed rows.

    Rows without any value and columns without a header are gone.
    """
    judged = _with_verdict(raw, mode)
    data = _data_columns(judged)
    rows = normalize_null_tokens(judged, columns=data)
    rows = rows.dropna(how="all", subset=[quoted(c) for c in (*data, BAD_ROW)])
    return rename(drop_unnamed_columns(rows))


def read_files(
    spark: SparkSession,
    paths: list[str],
    mode: str = "strict",
    multi_line: bool | None = None,
    rename: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Cleaned text rows of drop files, with the file name in ``_file``.

    Files may differ in their headers: each header is renamed by itself, then columns are united
    by name. ``mode='strict'`` raises on a row with more cells than the header, ``'quarantine'``
    leaves such rows out.
    """
    parts = [prepare(raw, mode, rename) for raw in read_raw(spark, paths, multi_line)]
    if not parts:
        raise ValueError("no files to read")
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return united.filter(F.col(BAD_ROW).isNull()).drop(BAD_ROW)


def read_chain_csv(
    spark: SparkSession, path: str | list[str], mode: str = "strict", multi_line: bool | None = None
) -> DataFrame:
    """Cleaned text rows of one or several drop files."""
    paths = [path] if isinstance(path, str) else list(path)
    return read_files(spark, paths, mode, multi_line).drop(FILE)


def load_many_files(
    spark: SparkSession, folder: str, profile: ChainProfile, mode: str = "strict", rules: str = "compat"
) -> DataFrame:
    """Rows of every drop file of a chain under canonical names, with ``_file`` and ``table_name``."""
    found = discover_files(spark, folder, profile.file_prefix, profile.file_suffix).select("path").collect()
    paths = sorted(r["path"] for r in found)
    rows = read_files(spark, paths, mode, rename=lambda df: standardize_columns(df, profile, rules))
    return rows.withColumn("table_name", table_name_for(FILE))


def read_labels(spark: SparkSession, path: str, text: str, label: str) -> DataFrame:
    """(text, label) of a label file or folder, without copies and incomplete rows.

    Read like drop files: line breaks in quotes belong to their cell, and null tokens are no labels.
    """
    found = _listing(spark.read.format("binaryFile").load(literal_path(path))).select("path").collect()
    rows = read_chain_csv(spark, sorted(r["path"] for r in found))
    return rows.select(F.col(quoted(text)), F.col(quoted(label))).dropDuplicates().dropna(how="any")
