"""Projection to the standard sales record."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.text import quoted
from shelfwise.schema import STANDARD


def derive_dates(df: DataFrame, date: str) -> DataFrame:
    """``sale_date`` (first of the month), ``sale_year`` and ``sale_month`` from a date column."""
    month = F.trunc(F.col(quoted(date)), "MM")
    return df.withColumns({"sale_year": F.year(month), "sale_month": F.month(month), "sale_date": month})


def to_standard(df: DataFrame, mapping: Mapping[str, Column | str]) -> DataFrame:
    """The 37 fields in order and typed; ``mapping`` gives an expression per field.

    A field without an expression takes the column of the same name, or null.
    """

    def value(name: str) -> Column:
        given = mapping.get(name)
        if given is None:
            return F.col(name) if name in df.columns else F.lit(None)
        return F.expr(given) if isinstance(given, str) else given

    return df.select([value(f.name).cast(f.type).alias(f.name) for f in STANDARD])


def typed(col: str, kind: str) -> Column:
    """Text to ``kind``, null if it does not parse: decimal commas, blanks, ``N.0`` integers."""
    text = F.regexp_replace(F.col(quoted(col)).cast("string"), r"(?U)\s", "")
    if kind == "string":
        return F.col(quoted(col)).cast("string")
    if kind == "date":
        plain = F.trim(F.col(quoted(col)).cast("string"))
        return F.coalesce(plain.try_cast("date"), F.try_to_date(plain, "dd.MM.yyyy"))
    text = F.replace(text, F.lit(","), F.lit("."))
    if kind in ("int", "bigint"):
        text = F.regexp_replace(text, r"\.0+$", "")
    return text.try_cast(kind)


def cast_types(df: DataFrame) -> DataFrame:
    """Text columns named as standard fields get the type of the field."""
    kinds = {f.name: f.type for f in STANDARD}
    return df.withColumns({c: typed(c, kinds[c]) for c in df.columns if c in kinds})
