"""Chain profiles: all differences between the retail chains, as data."""

from __future__ import annotations

from dataclasses import dataclass

# Header keywords of the drop files.
SUPPLIER = ("поставщика", "поставщик")
NAME = ("наименование", "товар")
CODE = ("код товара", "артикул", "код")
BRANCH = ("филиал", "отделение")
ADDRESS, CITY, REGION = ("адрес",), ("город",), ("регион",)
LATIN_NAME = ("product",)


@dataclass(frozen=True)
class HeaderRule:
    """A header maps to ``target`` if it holds any of ``any_of``, all of ``all_of``, none of ``none_of``."""

    target: str
    any_of: tuple[str, ...]
    all_of: tuple[str, ...] = ()
    none_of: tuple[str, ...] = ()
    only_if_free: bool = False

    def matches(self, header: str, used: set[str]) -> bool:
        return (
            any(word in header for word in self.any_of)
            and all(word in header for word in self.all_of)
            and not any(word in header for word in self.none_of)
            and not (self.only_if_free and self.target in used)
        )


@dataclass(frozen=True)
class ChainProfile:
    name: str
    file_prefix: str
    schema: str
    rules: tuple[HeaderRule, ...]
    file_suffix: str = ".csv"

    @property
    def file_glob(self) -> str:
        return f"{self.file_prefix}*{self.file_suffix}"


def _place_rules(region_none_of: tuple[str, ...] = ()) -> tuple[HeaderRule, ...]:
    return (
        HeaderRule("address", ADDRESS),
        HeaderRule("city", CITY),
        HeaderRule("region", REGION, none_of=region_none_of),
        HeaderRule("branch", BRANCH),
    )


def _usual_rules(supplier: HeaderRule, names: tuple[str, ...] = NAME) -> tuple[HeaderRule, ...]:
    return (
        supplier,
        HeaderRule("product_name", names),
        HeaderRule("product_code", CODE),
        *_place_rules(),
        HeaderRule("product_name", LATIN_NAME),
    )


ANY_SUPPLIER = HeaderRule("supplier_name", SUPPLIER)
NAMED_SUPPLIER = HeaderRule("supplier_name", SUPPLIER, all_of=("наименование",))

MAGNIT = ChainProfile("magnit", "magnit_", "magnit", _usual_rules(ANY_SUPPLIER))
DIKSI = ChainProfile("diksi", "diksi_", "diksi", _usual_rules(NAMED_SUPPLIER))
PYATEROCHKA = ChainProfile("pyaterochka", "pyaterochka_", "pyaterochka", _usual_rules(ANY_SUPPLIER))
PEREKRESTOK = ChainProfile(
    "perekrestok", "perekrestok_", "perekrestok", _usual_rules(ANY_SUPPLIER, (*NAME, "материал2"))
)
OKEY = ChainProfile(
    "okey",
    "okey_",
    "okey",
    (
        ANY_SUPPLIER,
        HeaderRule("product_name", (*NAME, "материал2"), only_if_free=True),
        HeaderRule("product_code", CODE),
        *_place_rules(region_none_of=("цена",)),
    ),
)
X5 = ChainProfile("x5", "x5_", "x5", ())
ASHAN = ChainProfile(
    "ashan",
    "aushan_",
    "ashan",
    (NAMED_SUPPLIER, HeaderRule("product_name", ("наименование",)), *_place_rules()),
)

PROFILES: dict[str, ChainProfile] = {
    p.name: p for p in (MAGNIT, DIKSI, PYATEROCHKA, PEREKRESTOK, OKEY, X5, ASHAN)
}


def strict_rules(rules: tuple[HeaderRule, ...]) -> tuple[HeaderRule, ...]:
    """The same rules with product codes tested before product names."""
    codes = tuple(r for r in rules if r.target == "product_code")
    rest = tuple(r for r in rules if r.target != "product_code")
    return codes + rest
