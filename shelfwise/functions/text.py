"""Text expressions.

Each ``*_sql`` helper takes and returns SQL text, so that the same expression serves the
DataFrame API (``F.expr``) and a saved ``SQLTransformer`` stage. Regular expressions carry
``(?u)``/``(?U)`` because Java folds case and finds word bounds in ASCII only by default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weight pattern, pack keywords, punctuation and abbreviation patterns, city marker.
WEIGHT_PATTERN = r"(?iu)(\d+(?:[.,]\d+)?)[ ]?(г|гр|грамм|кг|кгм)"
KILO_UNIT = "кг"
TUBE_WORDS = ("туба", "тубус", "tube", "can", "pringles", "stax", "lays stax", "big bon chips", "just brutal")
TUBE, BAG = "Туба", "Пакет"
QUOTE_MARKS = "«»\"“”"
SEPARATORS = ".,;:/-"
BRAND_QUANTITY = r"\d+[ггмлштлк]*"
BRAND_NOISE = r"(?U)[^a-zа-яё\s]"
ADDRESS_WORDS = (
    (r"(?U)\bг\.\b", "город "),
    (r"(?U)\bгор\b", "город "),
    (r"(?U)\bул\b", "улица "),
    (r"(?U)\bпр-кт\b", "проспект "),
    (r"(?U)\bресп\b", "республика "),
)
CITY_MARK = "город"
CITY_FEATURE_MARK = " natasha:"
# End of fixed values.

CITY_SEPARATOR = "\x1f"

SPACES = r"(?U)[\s\x1c-\x1f]+"
EDGE_SPACES = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
CASED_RUNS = r"[\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+"


def quoted(name: str) -> str:
    """A column name as a SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A Python string as a SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fill_missing_sql(x: str) -> str:
    return f"coalesce({x}, '')"


def extract_weight_sql(x: str) -> str:
    number = f"regexp_extract({x}, {literal(WEIGHT_PATTERN)}, 1)"
    unit = f"lower(regexp_extract({x}, {literal(WEIGHT_PATTERN)}, 2))"
    grams = (
        f"try_cast(replace({number}, ',', '.') as double)"
        f" * if(contains({unit}, '{KILO_UNIT}'), 1000D, 1D)"
    )
    return f"try_cast({grams} as bigint)"


def packaging_type_sql(x: str) -> str:
    found = " or ".join(f"contains(lower({x}), {literal(word)})" for word in TUBE_WORDS)
    return f"case when {found} then '{TUBE}' else '{BAG}' end"


def squeeze_sql(x: str) -> str:
    return f"trim(regexp_replace({x}, {literal(SPACES)}, ' '))"


def preprocess_sql(x: str) -> str:
    return f"regexp_replace(lower({fill_missing_sql(x)}), {literal(EDGE_SPACES)}, '')"


def _strip_marks_sql(x: str) -> str:
    blanks = " " * len(SEPARATORS)
    return squeeze_sql(f"translate({x}, {literal(SEPARATORS + QUOTE_MARKS)}, '{blanks}')")


def clean_place_sql(x: str) -> str:
    return _strip_marks_sql(f"lower({fill_missing_sql(x)})")


def clean_brand_sql(x: str) -> str:
    without_quantity = f"regexp_replace(lower({fill_missing_sql(x)}), {literal(BRAND_QUANTITY)}, ' ')"
    return squeeze_sql(f"regexp_replace({without_quantity}, {literal(BRAND_NOISE)}, ' ')")


def normalize_address_sql(x: str) -> str:
    text = f"lower({fill_missing_sql(x)})"
    for pattern, word in ADDRESS_WORDS:
        text = f"regexp_replace({text}, {literal(pattern)}, '{word}')"
    return _strip_marks_sql(text)


def normalize_brand_label_sql(x: str) -> str:
    """Title case: every run of letters starts with a capital, also after a hyphen or digit."""
    runs = f"regexp_extract_all({x}, {literal(CASED_RUNS)}, 0)"
    titled = f"array_join(transform({runs}, run -> initcap(run)), '')"
    return f"regexp_replace({titled}, {literal(EDGE_SPACES)}, '')"


def city_after_marker_sql(x: str, words: int = 1) -> str:
    """The ``words`` words that follow the city marker in an address, or ''."""
    more = f"(?: [^ ]+){{{words - 1}}}"
    pattern = literal(rf"(?U)\b{CITY_MARK} ([^ ]+{more})")
    return f"regexp_extract({normalize_address_sql(x)}, {pattern}, 1)"


def city_name_sql(x: str) -> str:
    """A city as addresses name it behind the marker: normalised, without the marker itself."""
    return f"regexp_replace({normalize_address_sql(x)}, {literal(f'^{CITY_MARK}(?: |$)')}, '')"


def city_prefixes_sql(clean: str, longest: int) -> str:
    """What follows the city marker in a normalised address: its first ``longest`` words, then fewer, down to one."""
    rest = f"regexp_extract({clean}, {literal(rf'(?U)\b{CITY_MARK} (.+)')}, 1)"
    cuts = f"transform(sequence(least({longest}, size(w)), 1), n -> array_join(slice(w, 1, n), ' '))"
    # The words are bound once, as the only element of an array.
    return f"flatten(transform(array(split({rest}, ' ')), w -> if(w[0] = '', cast(array() as array<string>), {cuts})))"


def listed_city_sql(clean: str, cities: Sequence[str]) -> str:
    """The longest of ``cities`` that follows the marker in a normalised address, or ''; the list is part of the text."""
    if not cities:
        return "''"
    longest = max(len(c.split(" ")) for c in cities)
    listed = f"split({literal(CITY_SEPARATOR.join(cities))}, {literal(CITY_SEPARATOR)})"
    # No coalesce: Spark does not fold constants inside conditions, and would split the list anew for every row.
    return f"array_join(slice(filter({city_prefixes_sql(clean, longest)}, p -> array_contains({listed}, p)), 1, 1), '')"


def compose_features_sql(x: str, cities: Sequence[str] | None = None) -> str:
    """Without a list, the one word behind the marker counts as the city."""
    found = city_after_marker_sql(x) if cities is None else listed_city_sql(normalize_address_sql(x), cities)
    return f"concat({normalize_address_sql(x)}, {literal(CITY_FEATURE_MARK)}, {found})"


def compose_clean_sql(clean: str, cities: Sequence[str]) -> str:
    """The same for an address that is normalised already."""
    return f"concat({clean}, {literal(CITY_FEATURE_MARK)}, {listed_city_sql(clean, cities)})"


def table_name_sql(x: str) -> str:
    return f"regexp_replace(lower(replace({x}, '.csv', '')), '[^a-zA-Z0-9_]', '_')"


def fill_missing_text(col: str) -> Column:
    """Missing text becomes ''."""
    return F.expr(fill_missing_sql(quoted(col)))


def extract_weight_g(col: str) -> Column:
    """Grams from the leftmost ``number unit`` in a product name; null where there is none."""
    return F.expr(extract_weight_sql(quoted(col)))


def packaging_type(col: str) -> Column:
    """Tube or bag by keyword; missing names count as bags."""
    return F.expr(packaging_type_sql(quoted(col)))


def preprocess_text(col: str) -> Column:
    """Lower case without outer whitespace; missing text becomes ''."""
    return F.expr(preprocess_sql(quoted(col)))


def clean_place_text(col: str) -> Column:
    """Lower case, quotes dropped, punctuation to blanks, blanks squeezed."""
    return F.expr(clean_place_sql(quoted(col)))


def clean_brand_text(col: str) -> Column:
    """Letters only: quantities with their units and all other characters become blanks."""
    return F.expr(clean_brand_sql(quoted(col)))


def normalize_address(col: str) -> Column:
    """Abbreviations spelled out, then cleaned as a place text."""
    return F.expr(normalize_address_sql(quoted(col)))


def normalize_brand_label(col: str) -> Column:
    return F.expr(normalize_brand_label_sql(quoted(col)))


def city_after_marker(col: str, words: int = 1) -> Column:
    return F.expr(city_after_marker_sql(quoted(col), words))


def city_name(col: str) -> Column:
    """A city as addresses name it: normalised, without the marker word."""
    return F.expr(city_name_sql(quoted(col)))


def city_prefixes(col: str, longest: int) -> Column:
    """Candidates for the city of a normalised address, the longest first."""
    return F.expr(city_prefixes_sql(quoted(col), longest))


def compose_features(col: str, cities: Sequence[str] | None = None) -> Column:
    """Cleaned address followed by the city found in it: the longest of ``cities``, or one word without a list."""
    return F.expr(compose_features_sql(quoted(col), cities))


def table_name_for(col: str) -> Column:
    """Sink table name of a drop file name."""
    return F.expr(table_name_sql(quoted(col)))
