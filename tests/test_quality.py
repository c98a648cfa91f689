"""One violating row per rule; types; the clean view."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import quality, reports, standard
from shelfwise.schema import STANDARD, standard_struct

GOOD = {
    "retail_chain": "Магнит", "sale_year": 2024, "sale_month": 12, "sale_date": date(2024, 12, 1),
    "address": "ул. Мира", "store_format": "МД", "store_name": "Скрепка", "product_name": "Семечки", "brand": "Б",
    "weight": "2000", "product_level_1": "Снэки", "product_level_2": "Семечки", "product_level_3": "Семечки",
    "product_article": 1, "product_code": 1, "barcode": "46", "supplier": "ООО",
    "sales_quantity": 37, "sales_amount_rub": Decimal("4879.65"), "avg_cost_price": Decimal("82.8660"),
    "avg_sell_price": Decimal("131.8824"), "margin_amount_rub": Decimal("1813.91"),
    "sales_tons": Decimal("0.074"), "sales_weight_kg": Decimal("74.000"),
}
VIOLATIONS = [
    ({"supplier": None}, "completeness:supplier"),
    ({"store_format": "х" * 51}, "length:store_format"),
    ({"sales_amount_rub": Decimal("5123.63"), "margin_amount_rub": Decimal("2057.59")}, "sales_amount"),
    ({"margin_amount_rub": Decimal("1904.61")}, "margin"),
    ({"weight": "200"}, "weight:kg"),
    ({"weight": "два кг"}, "weight:text"),
    ({"sales_tons": Decimal("0.080")}, "weight:tons"),
    ({"sale_date": date(1924, 12, 1)}, "date:bounds"),
    ({"sale_month": 13}, "date:month"),
]


def _table(spark, *rows):
    return spark.createDataFrame([tuple({**GOOD, **r}.get(f.name) for f in STANDARD) for r in rows], standard_struct())


def _broken(report):
    return {r["rule"] for r in report.collect() if r["violations"] and not r["rule"].startswith("unique:")}


def test_good_row_passes(spark):
    df = _table(spark, {})
    assert _broken(quality.quality_report(df)) == set()
    assert quality.clean_sales(df).count() == 1


@pytest.mark.parametrize("change, rule", VIOLATIONS, ids=[r for _, r in VIOLATIONS])
def test_each_rule(spark, change, rule):
    df = _table(spark, change)
    assert _broken(quality.count_violations(df, quality.row_rules())) == {rule}
    assert quality.clean_sales(df).count() == 0


def test_uniqueness(spark):
    df = _table(spark, {}, {"product_article": 2}, {"product_article": 3, "barcode": "47"}, {"product_article": 3, "barcode": "47"})
    got = {r["rule"]: (r["violations"], r["rows"]) for r in quality.check_uniqueness(df).collect()}
    assert got == {
        "unique:product_article": (1, 3), "one barcode per product_article": (0, 3),
        "unique:barcode": (2, 2), "one product_article per barcode": (1, 2),
    }
    assert {r["product_article"] for r in quality.clean_sales(df).collect()} == {3}


def test_clear_view(spark):
    quality.publish_clear_view(_table(spark, {}, {"supplier": None}), "clear_unit")
    assert spark.table("clear_unit").count() == 1


def test_types(spark):
    df = spark.createDataFrame([(" 1 234,50", "37.0", "007", "01.12.2024", "х")], "sales_amount_rub string, sales_quantity string, product_article string, sale_date string, barcode string")
    got = standard.cast_types(df).first()
    assert tuple(got) == (Decimal("1234.50"), 37, 7, date(2024, 12, 1), "х")
    dirty = spark.createDataFrame([("много", "3.5", "1e", "31.02.2024", None)], df.schema)
    assert tuple(standard.cast_types(dirty).first()) == (None, None, None, None, None)


def test_standard_fills_missing_fields(spark):
    record = standard.to_standard(spark.createDataFrame([("м",)], "name string"), {"store_name": "name"})
    assert record.schema.simpleString() == standard_struct().simpleString()
    assert record.first()["store_name"] == "м" and record.first()["vendor"] is None


def test_rollup_totals(spark):
    df = _table(spark, {"branch": "а", "city": "x"}, {"branch": "а", "city": "y"}, {"branch": "б"})
    rows = reports.geo_rollup(df).collect()
    total = next(r for r in rows if r["level_id"] == 15)
    assert total["rows"] == sum(r["rows"] for r in rows if r["level_id"] == 0) == 3


def test_surrogate_keys_tell_rows_apart(spark):
    df = _table(spark, {"supplier": "а", "warehouse_supplier": None}, {"supplier": "а-"}, {"supplier": "а", "warehouse_supplier": ""})
    keys = {r["supplier_key"] for r in reports.build_dimension(df, "supplier").collect()}
    assert len(keys) == 3
    assert {r["supplier_key"] for r in reports.build_facts(df).collect()} == keys


def test_a_lasting_view(spark, tmp_path):
    """Another session reads it; a new record replaces what it shows, and one that fails does not."""
    folder = str(tmp_path / "it's clear")
    rows = ({}, {"supplier": None}, {"barcode": "47"}, {"product_article": 2, "barcode": "47"})
    made = quality.publish_lasting_view(_table(spark, *rows), "unit_clear", folder)
    session = spark.newSession()
    assert [tuple(r) for r in session.table("unit_clear.clear_sales").collect()] == [tuple(_table(spark, {}).first())]
    broken = _table(spark, {}).withColumn("brand", F.raise_error(F.lit("broken row")).cast("string"))
    with pytest.raises(Exception, match="broken row"):
        quality.publish_lasting_view(broken, "unit_clear", folder)
    assert session.table("unit_clear.clear_sales").count() == 1
    again = quality.publish_lasting_view(_table(spark, {}, {}), "unit_clear", folder, tolerance=0.5)
    assert spark.newSession().table("unit_clear.clear_sales").count() == 2
    assert again["record"] != made["record"] and spark.read.parquet(made["record"]).count() == 4
