"""Row and column cleaning."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.text import quoted

# Cell texts that mean "missing".
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Fixed value: longest text the sink keeps.
SINK_TEXT_LENGTH = 250
# Columns enrichment adds.
PRODUCT_COLUMNS = (
    "weight_extracted_regex",
    "package_type",
    "flavor_predicted",
    "brand_predicted",
    "weight_predicted",
    "product_type_predicted",
)
ADDRESS_COLUMNS = ("city_predicted", "region_predicted", "branch_predicted")

BLANK_HEADER = re.compile(r"^(_c\d+|Unnamed.*)$")


def _strings(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind == "string"]


def drop_all_null_rows(df: DataFrame) -> DataFrame:
    return df.dropna(how="all")


def drop_unnamed_columns(df: DataFrame) -> DataFrame:
    """Drop columns whose header cell was blank."""
    return df.select([F.col(quoted(c)) for c in df.columns if not BLANK_HEADER.match(c)])


def normalize_null_tokens(df: DataFrame, trimmed: bool = False, columns: list[str] | None = None) -> DataFrame:
    """Cells that spell a missing value become null, in all text columns or some; ``trimmed`` also ignores outer blanks."""

    def cleaned(name: str):
        cell = F.col(quoted(name))
        tested = F.trim(cell) if trimmed else cell
        return F.when(~tested.isin(*NULL_TOKENS), cell)

    return df.withColumns({name: cleaned(name) for name in (_strings(df) if columns is None else columns)})


def cast_all_to_string(df: DataFrame) -> DataFrame:
    return df.select([F.col(quoted(c)).cast("string").alias(c) for c in df.columns])


def truncate_strings(df: DataFrame, n: int = SINK_TEXT_LENGTH) -> DataFrame:
    return df.withColumns({c: F.substring(F.col(quoted(c)), 1, n) for c in _strings(df)})


def ensure_enrichment_columns(df: DataFrame) -> DataFrame:
    """'' for the enrichment columns whose input column is missing."""
    wanted: tuple[str, ...] = ()
    if "product_name" not in df.columns:
        wanted = PRODUCT_COLUMNS + ADDRESS_COLUMNS
    elif "address" not in df.columns:
        wanted = ADDRESS_COLUMNS
    return df.withColumns({c: F.lit("") for c in wanted if c not in df.columns})


def filter_min_length(df: DataFrame, col: str, more_than: int) -> DataFrame:
    return df.filter(F.length(F.col(quoted(col))) > more_than)


def drop_null_labels(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Drop rows with a null in ``cols``, or in any column."""
    return df.dropna(how="any", subset=cols)
