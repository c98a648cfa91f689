"""Joins and set operations that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.text import quoted
from shelfwise.session import settle

BROADCAST_BYTES = 64 << 20
# A key is hot if it holds more than this share of all rows, so there are at most 1/HOT_SHARE.
HOT_SHARE = 1e-4
# Rows of a repeated key on either side that one task joins with each other.
CELL = 2000


def data_bytes(df: DataFrame) -> int:
    """Rough size of ``df`` in memory: lengths of texts and of nested values written out, plus 16 bytes per value."""

    def length(field: T.StructField) -> Column | None:
        col, kind = F.col(quoted(field.name)), field.dataType
        if isinstance(kind, T.UserDefinedType):
            col, kind = F.unwrap_udt(col), kind.sqlType()
        if isinstance(kind, (T.StringType, T.BinaryType)):
            return F.octet_length(col)
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            return F.octet_length(F.to_json(F.struct(col.alias("v"))))
        return None

    lengths = [F.coalesce(x, F.lit(0)) for f in df.schema.fields if (x := length(f)) is not None]
    per_row = reduce(Column.__add__, lengths, F.lit(16 * len(df.columns)).cast("bigint"))
    return df.agg(F.coalesce(F.sum(per_row), F.lit(0))).first()[0]


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "left",
    max_bytes: int = BROADCAST_BYTES,
    stored: bool = False,
) -> DataFrame:
    """Join ``small``, one row per key, to a large table.

    ``small`` is materialised once and measured: up to ``max_bytes`` it is broadcast, so that
    ``big`` is not shuffled at all; beyond that the join is shuffled with hot keys split off.
    ``stored`` says that ``small`` is materialised already.
    """
    if not stored:
        small = settle(small, "lookup")
    if data_bytes(small) <= max_bytes:
        return big.join(F.broadcast(small), on, how)
    return hot_split_join(big, small, on, how)


def hot_keys(df: DataFrame, on: list[str], share: float = HOT_SHARE) -> DataFrame:
    """The keys holding more than ``share`` of the rows: at most ``1/share`` rows."""
    counts = settle(df.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows")), "key_counts")
    total = counts.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    return settle(counts.filter(F.col("_rows") > total * share).select(*on), "hot_keys")


def hot_split_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "left",
    share: float = HOT_SHARE,
) -> DataFrame:
    """Join ``small``, one row per key, with the hot keys of ``big`` kept out of the shuffle.

    There are at most ``1/share`` hot keys, hence as many matching rows in ``small``: those
    are broadcast, after a check that there are no more. All other rows meet in an ordinary shuffled join.
    """
    hot = hot_keys(big, on, share)
    marked = hot.select(*[F.col(c).alias(f"_hot_{c}") for c in on], F.lit(True).alias("_hot"))
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_hot_{c}")) for c in on])
    tagged = big.join(F.broadcast(marked), same, "left").drop(*[f"_hot_{c}" for c in on])
    few = settle(small.join(F.broadcast(hot), on, "left_semi"), "hot_rows")
    if few.count() > hot.count():
        raise ValueError(f"the looked-up table has several rows for one value of {', '.join(on)}")
    from_hot = tagged.filter("_hot").drop("_hot").join(F.broadcast(few), on, how)
    from_rest = tagged.filter("_hot is null").drop("_hot").join(small.hint("shuffle_merge"), on, how)
    return from_hot.unionByName(from_rest)


def semi_join(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys``."""
    return lookup_join(df, keys.select(*on).distinct(), on, "left_semi")


def join_by_key(left: DataFrame, right: DataFrame, key: str, cell: int = CELL, most_rows: int | None = None) -> DataFrame:
    """Inner join of two tables on ``product_article`` or ``barcode``: all pairs of rows that share a key.

    Rows per key are counted on both sides first, so the size of the result is known: more than ``most_rows`` rows
    are refused. A key of more than ``cell`` x ``cell`` pairs is cut: its rows are numbered into parts of ``cell`` rows
    on either side, each part of the left meets each part of the right in a group of its own, and only the rows of
    such keys are copied. All other keys meet in a plain equi-join.
    """
    counts = settle(
        left.groupBy(key).agg(F.count(F.lit(1)).alias("_l")).join(right.groupBy(key).agg(F.count(F.lit(1)).alias("_r")), key),
        "pairs",
    )
    pairs = F.col("_l") * F.col("_r")
    if most_rows is not None:
        rows = counts.agg(F.coalesce(F.sum(pairs.cast("decimal(38,0)")), F.lit(0))).first()[0]
        if rows > most_rows:
            raise ValueError(f"joining by {key} would give {rows} rows, more than {most_rows}: aggregate one side first")
    hot = counts.filter(pairs > cell * cell).select(key, *[F.ceil(F.col(c) / cell).alias(f"{c}_parts") for c in ("_l", "_r")])
    if hot.isEmpty():
        return left.join(right, key, "inner")
    hot = settle(hot, "hot_keys")
    cold = [lookup_join(side, hot.select(key), [key], "left_anti", stored=True) for side in (left, right)]
    # Rows are numbered as they are stored, so a part is the same whenever a task is run again.
    place = F.xxhash64("_metadata.file_name", "_metadata.row_index")
    cut = []
    for side, own, other in ((left, "_l", "_r"), (right, "_r", "_l")):
        stored = settle(lookup_join(side, hot, [key], "inner", stored=True), "hot_rows")
        parted = stored.withColumn(f"{own}_part", F.pmod(place, F.col(f"{own}_parts")))
        copied = parted.withColumn(f"{other}_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(f"{other}_parts") - 1)))
        cut.append(copied.drop("_l_parts", "_r_parts"))
    met = cut[0].join(cut[1].hint("shuffle_merge"), [key, "_l_part", "_r_part"]).drop("_l_part", "_r_part")
    return cold[0].join(cold[1], key, "inner").unionByName(met)


def pair_sums(left: DataFrame, right: DataFrame, key: str, a: str, b: str, cell: int = CELL, most_rows: int | None = None) -> DataFrame:
    """(key, pairs, a, b, product): per key the number of pairs of rows that share it, and the sums over these pairs of the
    left's ``a``, of the right's ``b`` and of ``a * b``.

    A sum over all pairs is a product of the sides' own counts and sums, so each side is summed up first and one row
    per key meets one: the work is that of the rows, not of their pairs. Null values are left out of the sums.
    """

    def totals(side: DataFrame, value: str, n: str) -> DataFrame:
        return side.groupBy(key).agg(F.count(F.lit(1)).alias(n), F.sum(value).alias(value))

    met = join_by_key(totals(left, a, "_l_rows"), totals(right, b, "_r_rows"), key, cell, most_rows)
    own, other, product = F.col(a) * F.col("_r_rows"), F.col(b) * F.col("_l_rows"), F.col(a) * F.col(b)
    return met.select(key, (F.col("_l_rows") * F.col("_r_rows")).alias("pairs"), own.alias(a), other.alias(b), product.alias("product"))


def join_article_or_barcode(
    left: DataFrame,
    right: DataFrame,
    article: str = "product_article",
    barcode: str = "barcode",
) -> DataFrame:
    """Match ``left`` to a product table by article, and by barcode where no article matches.

    Two look-ups on ``left`` as it passes instead of an ``OR`` predicate, which would compare all pairs. ``right`` must
    have one row per article and per barcode: it raises otherwise. Rows without an article match by barcode.
    """
    details = [c for c in right.columns if c not in (article, barcode)]
    stored = settle(right, "products")
    for key in (article, barcode):
        if not stored.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1").isEmpty():
            raise ValueError(f"the product table has several rows for one {key}")

    def keyed(key: str, prefix: str) -> DataFrame:
        found = F.struct(*[F.col(quoted(c)) for c in details]).alias(prefix)
        return stored.filter(F.col(key).isNotNull()).select(key, found)

    both = lookup_join(left, keyed(article, "_by_article"), [article])
    both = lookup_join(both, keyed(barcode, "_by_barcode"), [barcode])
    matched = F.when(F.col("_by_article").isNotNull(), "article").when(F.col("_by_barcode").isNotNull(), "barcode")
    chosen = F.coalesce("_by_article", "_by_barcode")
    rows = both.withColumns({"_chosen": chosen, "matched_by": matched}).filter("matched_by is not null")
    return rows.select(*left.columns, *[F.col("_chosen")[c].alias(c) for c in details], "matched_by")


def union_chains(tables: dict[str, DataFrame]) -> DataFrame:
    """All chains in one table; columns a chain lacks are null."""
    parts = [df.withColumn("retail_chain", F.lit(chain)) for chain, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def append_chunks(chunks: list[DataFrame]) -> DataFrame:
    """Chunks of one file under each other, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), chunks)


def new_dictionary_values(df: DataFrame, col: str, dictionary: DataFrame) -> DataFrame:
    """Values a dictionary lacks, with their row counts: (value, count).

    Values are counted before the anti join, so a frequent value is one row in it.
    """
    counts = (
        df.filter(F.col(quoted(col)).isNotNull())
        .groupBy(F.col(quoted(col)).alias("value"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    known = dictionary.toDF("value").distinct()
    return counts.join(known, "value", "left_anti")
