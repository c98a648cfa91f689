"""Header mapping per chain."""

import pytest
from hypothesis import given
from hypothesis import strategies as st

from shelfwise.operators.headers import canonical_names, clean_header, dedupe_names, export_header
from shelfwise.profiles import PROFILES

CASES = [
    ("magnit", "Наименование;Артикул;Адрес;Город;Регион;Филиал", "product_name;product_code;address;city;region;branch"),
    ("magnit", "Код товара;Наименование", "product_name;product_name_1"),
    ("magnit", "product_code", "product_name"),
    ("magnit", "product_name;region;Регион", "product_name;region;region_1"),
    ("magnit", "Код поставщика;Штрих-код", "supplier_name;product_code"),
    ("diksi", "Поставщик;Наименование поставщика", "Поставщик;supplier_name"),
    ("diksi", "Код поставщика", "product_code"),
    ("pyaterochka", "Уни наименование;Отделение", "product_name;branch"),
    ("perekrestok", "Материал2;Штрих-код", "product_name;product_code"),
    ("okey", "Наименование;Код товара", "product_name;product_code"),
    ("okey", "Код товара;Наименование", "product_name;Наименование"),
    ("okey", "address;Адрес", "address;address_1"),
    ("okey", "Цена регион;Регион", "Цена регион;region"),
    ("x5", "product_name;address", "product_name;address"),
    ("ashan", "Наименование;Наименование поставщика;Код", "product_name;supplier_name;Код"),
    ("ashan", "Наименование;Наименование 2", "product_name;product_name_1"),
]


@pytest.mark.parametrize("chain, header, expected", CASES)
def test_canonical_names(chain, header, expected):
    assert canonical_names(header.split(";"), PROFILES[chain]) == expected.split(";")


def test_strict_rules_put_codes_first():
    got = canonical_names(["Код товара", "Наименование"], PROFILES["magnit"], rules="strict")
    assert got == ["product_code", "product_name"]


def test_clean_forms():
    assert clean_header('\ufeff"Город"') == "город"
    assert export_header(" [Цена] (руб)'\" ") == "Цена руб"


@given(st.lists(st.sampled_from(["Код", "код", "Товар", "Адрес", "address", "region", "Регион", "a", "A", "a_1"])))
def test_names_are_unique(headers):
    for profile in PROFILES.values():
        names = [n.lower() for n in canonical_names(headers, profile)]
        assert len(names) == len(set(names)) == len(headers)


def test_dedupe_ignores_case():
    assert dedupe_names(["a", "A", "b", "a"]) == ["a", "A_1", "b", "a_2"]
