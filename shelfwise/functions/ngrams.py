"""Tokens and n-grams as built-in array expressions (SQL text, see ``text``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.text import SPACES, literal, quoted

# Fixed value: a word is two or more word characters.
WORD_PATTERN = r"(?U)\b\w\w+\b"
# Pack units that say nothing about a brand.
BRAND_STOP_WORDS = ("шт", "уп", "г", "гр", "мл")


def word_tokens_sql(x: str, stop_words: tuple[str, ...] = ()) -> str:
    words = f"regexp_extract_all(lower({x}), {literal(WORD_PATTERN)}, 0)"
    if stop_words:
        listed = ", ".join(literal(w) for w in stop_words)
        words = f"filter({words}, w -> w not in ({listed}))"
    return words


def word_ngrams_sql(tokens: str, low: int, high: int) -> str:
    """N-grams of a token array.

    Neighbours are looked up by position: slicing per start would copy the array each time.
    The outer lambda names the tokens, so that an optimizer that inlines their expression
    still has them computed once per row.
    """

    def grams(n: int) -> str:
        if n == 1:
            return "words"
        following = "".join(f", ' ', get(words, i + {k})" for k in range(1, n))
        joined = f"transform(words, (word, i) -> concat(word{following}))"
        return f"slice({joined}, 1, greatest(0, size(words) - {n - 1}))"

    sizes = [grams(n) for n in range(low, high + 1)]
    united = sizes[0] if len(sizes) == 1 else f"concat({', '.join(sizes)})"
    return f"transform(array({tokens}), words -> {united})[0]"


def sized_ngrams_sql(tokens: str, n: int, parts: dict[int, list[str]] | None = None) -> str:
    """The n-grams of one size by the position of their first word, null beyond the last.

    ``parts`` lists, by size, shorter n-grams: an n-gram that contains another one of these sizes is null, too.
    """

    def grams(k: int) -> str:
        if k == 1:
            return "words"
        if parts is None or k - 1 not in parts:
            following = "".join(f", ' ', get(words, i + {j})" for j in range(1, k))
            return f"transform(words, (word, i) -> concat(word{following}))"
        listed = ", ".join(literal(p) for p in parts[k - 1]) or "null"
        shorter = f"transform({grams(k - 1)}, g -> if(g in ({listed}), g, cast(null as string)))"
        # Both parts must be listed; the second gives the last word. As the only element of an array, they are found once.
        longer = f"if(get(part, i + 1) is null, cast(null as string), concat(g, ' ', get(words, i + {k - 1})))"
        return f"transform(array({shorter}), part -> transform(part, (g, i) -> {longer}))[0]"

    return f"transform(array({tokens}), words -> {grams(n)})[0]"


def char_ngrams_sql(x: str, low: int, high: int) -> str:
    """Character n-grams of each blank-padded word; a word shorter than n counts once."""
    # Each word is padded once, not once per gram.
    words = f"transform(filter(split(lower({x}), {literal(SPACES)}), w -> w <> ''), w -> concat(' ', w, ' '))"
    sizes = f"sequence({low}, least({high}, greatest({low}, length(w))))"
    starts = "sequence(0, greatest(0, length(w) - n))"
    grams = f"transform({starts}, i -> substring(w, i + 1, n))"
    return f"flatten(transform({words}, w -> flatten(transform({sizes}, n -> {grams}))))"


def word_tokens(col: str, stop_words: tuple[str, ...] = ()) -> Column:
    return F.expr(word_tokens_sql(quoted(col), stop_words))


def word_ngrams(tokens: str, low: int, high: int) -> Column:
    """All n-grams, ``low`` to ``high`` words long, of a token array column."""
    return F.expr(word_ngrams_sql(quoted(tokens), low, high))


def char_ngrams(col: str, low: int, high: int) -> Column:
    return F.expr(char_ngrams_sql(quoted(col), low, high))
