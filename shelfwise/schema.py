"""The standard sales record: 37 fields, their types, obligations and length limits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    mandatory: bool = False
    max_length: int | None = None


def _text(name: str, max_length: int, mandatory: bool = False) -> Field:
    return Field(name, "string", mandatory, max_length)


# The published record layout.
STANDARD: tuple[Field, ...] = (
    _text("retail_chain", 50, True),
    Field("sale_year", "int", True),
    Field("sale_month", "int", True),
    Field("sale_date", "date", True),
    _text("branch", 100),
    _text("region", 100),
    _text("city", 100),
    _text("address", 200, True),
    _text("store_format", 50, True),
    _text("store_name", 100, True),
    _text("product_name", 200, True),
    _text("brand", 100, True),
    _text("flavor", 100),
    _text("weight", 50),
    _text("product_type", 100),
    _text("product_level_1", 100, True),
    _text("product_level_2", 100, True),
    _text("product_level_3", 100, True),
    _text("product_level_4", 100),
    Field("product_family_code", "int"),
    _text("product_family_name", 100),
    Field("product_article", "bigint", True),
    Field("product_code", "bigint", True),
    _text("barcode", 50, True),
    Field("factory_code", "int"),
    _text("factory_name", 100),
    Field("material", "int"),
    _text("vendor", 100),
    _text("supplier", 100, True),
    _text("warehouse_supplier", 100),
    Field("sales_quantity", "int", True),
    Field("sales_amount_rub", "decimal(18,2)", True),
    Field("avg_cost_price", "decimal(18,4)", True),
    Field("avg_sell_price", "decimal(18,4)", True),
    Field("margin_amount_rub", "decimal(18,2)", True),
    Field("sales_tons", "decimal(18,3)"),
    Field("sales_weight_kg", "decimal(18,3)"),
)

MANDATORY = tuple(f.name for f in STANDARD if f.mandatory)
LIMITED = tuple(f for f in STANDARD if f.max_length is not None)


def standard_struct() -> T.StructType:
    """Nullable throughout: obligations are checked and reported, not enforced by the type."""
    return T.StructType.fromDDL(", ".join(f"{f.name} {f.type}" for f in STANDARD))
