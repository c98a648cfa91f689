"""Enrichment: derived columns and predictions on a chain's rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.text import (
    city_name,
    city_prefixes,
    extract_weight_g,
    fill_missing_text,
    normalize_address,
    packaging_type,
)
from shelfwise.operators.cleaning import ensure_enrichment_columns
from shelfwise.operators.headers import standardize_columns
from shelfwise.operators.joins import lookup_join
from shelfwise.operators.models import PRODUCT_MODELS, SPECS, predict
from shelfwise.profiles import ChainProfile
from shelfwise.session import settle


def extract_city(df: DataFrame, address: str, known: DataFrame, out: str = "city_found") -> DataFrame:
    """City named after the city marker of an address if ``known`` (one column) lists it, else ''.

    Each distinct address is normalised once and tried with as many words as the longest known city has, then with
    fewer, in one join; the longest wins.
    """
    listed = known.select(city_name(known.columns[0]).alias("_tried")).filter("_tried <> ''").distinct()
    listed = settle(listed, "cities")
    longest = listed.agg(F.max(F.size(F.split("_tried", " ")))).first()[0] or 1

    def score(addresses: DataFrame, name: str) -> DataFrame:
        clean = addresses.withColumn("_clean", normalize_address(name))
        tried = clean.select(name, F.explode(city_prefixes("_clean", longest)).alias("_tried"))
        hits = lookup_join(tried, listed, ["_tried"], "left_semi")
        return hits.groupBy(name).agg(F.max_by("_tried", F.length("_tried")).alias(out))

    return score_distinct(df, address, score).fillna("", [out])


def score_distinct(df: DataFrame, in_col: str, score: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Add the columns ``score`` derives from a text, scoring each distinct text once.

    ``score`` gets the distinct texts and their column name, and keeps that column.
    """
    # Named after its source: scores may score another column within.
    key = f"_text_{in_col}"
    keyed = df.withColumn(key, fill_missing_text(in_col))
    texts = keyed.select(key).distinct()
    return lookup_join(keyed, score(texts, key), [key]).drop(key)


def _predict_all(df: DataFrame, in_col: str, models: Mapping[str, PipelineModel], names: tuple[str, ...]) -> DataFrame:
    if not any(name in models for name in names):
        return df.withColumns({SPECS[name].output_col: F.lit("") for name in names})

    def score(texts: DataFrame, text: str) -> DataFrame:
        for name in names:
            texts = predict(texts, models.get(name), text, SPECS[name].output_col)
        return texts

    return score_distinct(df, in_col, score)


def predict_product(df: DataFrame, models: Mapping[str, PipelineModel]) -> DataFrame:
    """Flavour, brand, weight and type from the product name."""
    return _predict_all(df, "product_name", models, PRODUCT_MODELS)


def predict_address(df: DataFrame, models: Mapping[str, PipelineModel]) -> DataFrame:
    """City from the address, then region and branch from the predicted city.

    All three depend on the address alone, so the chain runs over the distinct addresses, and
    its second step over the distinct predicted cities; the rows are joined once.
    """
    city = SPECS["city"].output_col
    if "city" not in models:
        return _predict_all(df.withColumn(city, F.lit("")), city, models, ("region", "branch"))

    def score(addresses: DataFrame, name: str) -> DataFrame:
        with_city = settle(predict(addresses, models["city"], name, city), "cities")
        return _predict_all(with_city, city, models, ("region", "branch"))

    return score_distinct(df, "address", score)


def enrich_columns(df: DataFrame, models: Mapping[str, PipelineModel]) -> DataFrame:
    """Pack weight and packaging, product and address predictions for canonical columns."""
    if "product_name" not in df.columns:
        return ensure_enrichment_columns(df)
    df = df.withColumns(
        {"weight_extracted_regex": extract_weight_g("product_name"), "package_type": packaging_type("product_name")}
    )
    df = predict_product(df, models)
    if "address" not in df.columns:
        return ensure_enrichment_columns(df)
    return predict_address(df, models)


def enrich(
    df: DataFrame, models: Mapping[str, PipelineModel], profile: ChainProfile, rules: str = "compat"
) -> DataFrame:
    """Canonical names by the chain's rules, then all enrichment columns."""
    return enrich_columns(standardize_columns(df, profile, rules), models)
