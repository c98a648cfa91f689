"""Vocabulary and TF-IDF."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, SQLTransformer
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import ngrams, text
from shelfwise.session import settle

# Cleaning applied inside a model, by name.
CLEANERS = {
    "none": text.fill_missing_sql,
    "product": text.preprocess_sql,
    "brand": text.clean_brand_sql,
    "place": text.clean_place_sql,
    "address": text.compose_features_sql,
}

# Frequent n-grams, in multiples of ``max_terms``, up to which longer ones are sought by them.
LISTED = 4


@dataclass(frozen=True)
class TextSpec:
    """How a text becomes terms, and which terms a model keeps."""

    cleaner: str = "none"
    analyzer: str = "word"
    low: int = 1
    high: int = 1
    stop_words: tuple[str, ...] = ()
    min_df: int = 1
    max_df: float = 1.0
    max_terms: int = 5000
    cities: tuple[str, ...] = ()  # of the cleaner "address": the names it looks for

    def cleaned_sql(self, x: str) -> str:
        return CLEANERS[self.cleaner](x)


def text_stages(spec: TextSpec, source: str) -> list[SQLTransformer]:
    """Model stages from the raw text column to ``terms``; intermediate columns stay separate
    projections, so that tokens are computed once per row."""

    def column(sql: str, name: str) -> SQLTransformer:
        return SQLTransformer(statement=f"SELECT *, {sql} AS {name} FROM __THIS__")

    if spec.cleaner == "address":
        clean = [
            column(text.normalize_address_sql(text.quoted(source)), "address_clean"),
            column(text.compose_clean_sql("address_clean", spec.cities), "clean"),
        ]
    else:
        clean = [column(spec.cleaned_sql(text.quoted(source)), "clean")]
    if spec.analyzer == "char":
        return [*clean, column(ngrams.char_ngrams_sql("clean", spec.low, spec.high), "terms")]
    return [
        *clean,
        column(ngrams.word_tokens_sql("clean", spec.stop_words), "tokens"),
        column(ngrams.word_ngrams_sql("tokens", spec.low, spec.high), "terms"),
    ]


def with_terms(df: DataFrame, spec: TextSpec, source: str) -> DataFrame:
    for stage in text_stages(spec, source):
        df = stage.transform(df)
    return df


def term_counts(df: DataFrame, terms: str = "terms") -> DataFrame:
    """(term, tf, df): occurrences and documents per term.

    Each row sends its terms in order, the first of equal ones marked as the document's, through one
    aggregation that combines on the map side, so a term found everywhere costs one row per task. Exploding
    with ``outer`` keeps Spark from testing the array for emptiness first, which would compute it twice.
    """
    first = "if(i > 0 and get(s, i - 1) = t, 0L, 1L)"
    # As the only element of an array, the sorted terms are computed once.
    ordered = f"transform(array(sort_array(array_compact({text.quoted(terms)}))), s -> transform(s, (t, i) -> struct(t as term, {first} as df)))[0]"
    return (
        df.select(F.explode_outer(F.expr(ordered)).alias("e"))
        .select("e.*")
        .filter("term is not null")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("tf"), F.sum("df").alias("df"))
    )


def vocabulary(df: DataFrame, spec: TextSpec, n_docs: int, terms: str = "terms") -> DataFrame:
    """The ``max_terms`` most frequent terms within the document-frequency bounds, with their idf.

    Word n-grams of several sizes are counted size by size, from the tokens that ``with_terms`` leaves beside its terms.
    """
    if spec.analyzer == "word" and spec.low < spec.high and terms == "terms" and "tokens" in df.columns:
        kept = _kept_by_size(df.select("tokens"), spec, n_docs)
    else:
        kept = _within_bounds(term_counts(df, terms), spec, n_docs)
    return _most_frequent(kept, spec).withColumn("idf", F.log((1 + F.lit(n_docs)) / (1 + F.col("df"))) + 1)


def _within_bounds(counts: DataFrame, spec: TextSpec, n_docs: int) -> DataFrame:
    return counts.filter((F.col("df") >= spec.min_df) & (F.col("df") <= F.lit(spec.max_df * n_docs)))


def _most_frequent(counts: DataFrame, spec: TextSpec) -> DataFrame:
    return counts.orderBy(F.desc("tf"), "term").limit(spec.max_terms)


def _kept_by_size(df: DataFrame, spec: TextSpec, n_docs: int) -> DataFrame:
    """(term, tf, df): the terms within the bounds that may be among the ``max_terms`` most frequent.

    An n-gram occurs no more often than the two shorter ones within it. Once ``max_terms`` terms are found, one that is
    rarer than the last of them is left out, and so are all longer ones that contain it: most long n-grams are rare, and
    these are never built or shuffled. Until then, or if too many are as frequent as the last, all are counted.
    """
    kept, parts = None, None
    for n in range(spec.low, spec.high + 1):
        grams = F.expr(ngrams.sized_ngrams_sql("tokens", n, parts))
        counts = settle(term_counts(df.select(grams.alias("terms"))), "term_counts")
        best = _most_frequent(_within_bounds(counts, spec, n_docs), spec)
        kept = settle(best if kept is None else _most_frequent(kept.unionByName(best), spec), "kept_terms")
        if n < spec.high:
            found, least = kept.agg(F.count(F.lit(1)), F.min("tf")).first()
            frequent = counts.filter((F.col("tf") >= least) & (F.col("df") >= spec.min_df)) if found == spec.max_terms else None
            most = LISTED * spec.max_terms
            listed = [] if frequent is None else [r["term"] for r in frequent.select("term").limit(most + 1).collect()]
            usable = frequent is not None and len(listed) <= most
            parts = {**({} if parts is None else parts), n: listed} if usable else None
    return kept


def fit_tfidf(df: DataFrame, spec: TextSpec, source: str) -> list:
    """Stages from raw text to ``features``: term counts times smoothed idf, unit length.

    The vocabulary, at most ``max_terms`` rows, is the only thing the driver sees.
    """
    n_docs = df.count()
    rows = settle(vocabulary(with_terms(df.select(source), spec, source), spec, n_docs), "vocabulary").collect()
    if not rows:
        raise ValueError("no term meets the document-frequency bounds")
    rows.sort(key=lambda r: (-r["tf"], r["term"]))
    counter = CountVectorizerModel.from_vocabulary([r["term"] for r in rows], "terms", "counts")
    weigher = ElementwiseProduct(
        scalingVec=Vectors.dense([r["idf"] for r in rows]), inputCol="counts", outputCol="weighted"
    )
    return [
        *text_stages(spec, source),
        counter,
        weigher,
        Normalizer(p=2.0, inputCol="weighted", outputCol="features"),
    ]


def long_features(df: DataFrame, key: str, terms: list[str], features: str = "features") -> DataFrame:
    """(key, term, weight) for every non-zero feature; ``terms`` is a model's bounded vocabulary."""
    names = df.sparkSession.createDataFrame(list(enumerate(terms)), "i int, term string")
    vector = F.unwrap_udt(F.col(features))
    cells = df.select(key, vector["indices"].alias("i"), vector["values"].alias("weight"))
    return (
        cells.select(key, F.explode_outer(F.arrays_zip("i", "weight")).alias("e"))
        .select(key, "e.i", "e.weight")
        .join(F.broadcast(names), "i")
        .select(key, "term", "weight")
    )
