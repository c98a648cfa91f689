"""Training, saving, loading and applying the seven text classifiers."""

from __future__ import annotations

import re
import uuid
import warnings
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import text
from shelfwise.functions.ngrams import BRAND_STOP_WORDS
from shelfwise.functions.text import quoted
from shelfwise.operators import sampling, stats
from shelfwise.operators.boosting import SoftmaxBoosting
from shelfwise.operators.cleaning import drop_null_labels, filter_min_length
from shelfwise.operators.features import TextSpec, fit_tfidf
from shelfwise.session import settle


@dataclass(frozen=True)
class ModelSpec:
    """One classifier: its columns, text treatment, row filters and learner."""

    name: str
    text_col: str
    label_col: str
    output_col: str
    text_spec: TextSpec
    learner: str
    params: Mapping[str, float] = field(default_factory=dict)
    balanced: bool = True
    test_share: float | None = 0.2
    min_class_rows: int = 2
    longer_than: int = -1
    sample: int | None = None
    title_labels: bool = False
    seed: int = 42

    def with_params(self, **params: float) -> ModelSpec:
        return replace(self, params={**self.params, **params})


# Text treatment and filters of the seven models, and learners that need few passes: boosting takes trees x depth jobs
# one after the other, so flavour and type are multinomial here and boosted in ``BOOSTED``.
SPECS: dict[str, ModelSpec] = {
    s.name: s
    for s in (
        ModelSpec(
            "flavor", "product_name", "flavor", "flavor_predicted",
            TextSpec("product", "word", 1, 3, min_df=3, max_df=0.9, max_terms=8000),
            "logistic", {"C": 1.0, "iterations": 200},
        ),
        ModelSpec(
            "brand", "product_name", "brand", "brand_predicted",
            TextSpec("brand", "word", 1, 2, BRAND_STOP_WORDS, min_df=2, max_df=0.95, max_terms=10000),
            "forest", {"trees": 100, "depth": 15}, title_labels=True,
        ),
        ModelSpec(
            "weight", "product_name", "weight", "weight_predicted",
            TextSpec("none", "word", 1, 3, max_terms=5000),
            "forest", {"trees": 100, "depth": 15}, balanced=False, test_share=None, min_class_rows=1,
        ),
        ModelSpec(
            "type", "product_name", "product_type", "product_type_predicted",
            TextSpec("product", "word", 1, 3, min_df=3, max_df=0.9, max_terms=5000),
            "logistic", {"C": 1.0, "iterations": 200},
        ),
        ModelSpec(
            "city", "address", "city", "city_predicted",
            TextSpec("address", "char", 3, 6, max_terms=20000),
            "logistic", {"C": 3.0, "iterations": 200}, test_share=0.3, min_class_rows=3, longer_than=5, sample=10000,
        ),
        ModelSpec(
            "region", "city", "region", "region_predicted",
            TextSpec("place", "word", 1, 3, min_df=2, max_df=0.95, max_terms=20000),
            "logistic", {"C": 1.0, "iterations": 200}, test_share=0.4, longer_than=1,
        ),
        ModelSpec(
            "branch", "city", "branch", "branch_predicted",
            TextSpec("place", "word", 1, 3, min_df=2, max_df=0.95, max_terms=10000),
            "logistic", {"C": 1.0, "iterations": 200}, test_share=0.4, longer_than=1,
        ),
    )
}
PRODUCT_MODELS = ("flavor", "brand", "weight", "type")
# Numbers of trees (for each class) and the learning rate of the boosted models.
BOOSTED: dict[str, ModelSpec] = {
    name: replace(SPECS[name], learner="boosting", params={"trees": trees, "rate": 0.1, "depth": 2})
    for name, trees in (("flavor", 1200), ("type", 200))
}


@dataclass
class Trained:
    spec: ModelSpec
    model: PipelineModel
    labels: list[str]
    report: DataFrame | None
    scored: DataFrame | None


def label_rows(df: DataFrame, spec: ModelSpec) -> DataFrame:
    """(text, label) rows a model learns from: distinct, complete, sampled, long enough, no rare class.

    Copies go before the sample is drawn, so that they do not crowd out other rows.
    """
    rows = df.select(F.col(quoted(spec.text_col)).alias("text"), F.col(quoted(spec.label_col)).cast("string").alias("label"))
    rows = drop_null_labels(stats.drop_duplicate_rows(rows))
    if spec.sample is not None:
        rows = sampling.sample_rows(rows, spec.sample, ["text", "label"], spec.seed)
    if spec.title_labels:
        rows = rows.withColumn("label", text.normalize_brand_label("label"))
    if spec.longer_than >= 0:
        # A city is measured without the part the feature text appends to it.
        measured = text.normalize_address_sql if spec.text_spec.cleaner == "address" else spec.text_spec.cleaned_sql
        rows = filter_min_length(rows.withColumn("_clean", F.expr(measured("text"))), "_clean", spec.longer_than)
        rows = rows.drop("_clean")
    if spec.min_class_rows > 1:
        rows = stats.drop_rare_classes(rows, "label", spec.min_class_rows)
    return stats.non_empty_guard(settle(rows, f"labels_{spec.name}"))


def known_cities(df: DataFrame, city: str) -> tuple[str, ...]:
    """The distinct cities of label rows, as addresses name them: at most one per label, so a list for a model to carry."""
    names = df.select(text.city_name(city).alias("name")).filter("name <> ''").distinct()
    return tuple(sorted(r["name"] for r in names.collect()))


def learner(spec: ModelSpec, weight_sum: float):
    """The unfitted classifier of a spec over ``features``, ``label_index`` and ``class_weight``."""
    common = {"featuresCol": "features", "labelCol": "label_index", "predictionCol": "prediction"}
    if spec.balanced:
        common["weightCol"] = "class_weight"
    p = spec.params
    if spec.learner == "boosting":
        return SoftmaxBoosting(trees=int(p["trees"]), rate=p["rate"], depth=int(p["depth"]), **common)
    if spec.learner == "forest":
        return RandomForestClassifier(
            numTrees=int(p["trees"]), maxDepth=int(p["depth"]), seed=spec.seed, maxMemoryInMB=512, **common
        )
    if spec.learner == "logistic":
        # Loss summed over rows and scaled by C equals loss averaged over weights with this penalty.
        return LogisticRegression(
            family="multinomial", regParam=1.0 / (p["C"] * weight_sum), standardization=False,
            maxIter=int(p["iterations"]), tol=1e-4, **common,
        )
    raise ValueError(f"unknown learner {spec.learner!r}")


def train(df: DataFrame, spec: ModelSpec) -> Trained:
    """Fit one model on labelled rows and report on the held-out part.

    Cleaning is part of the saved model and the vocabulary is fitted after the split, so that
    serving sees the text as training did and the report does not leak.
    """
    rows = label_rows(df, spec)
    held_out = None
    if spec.test_share is not None:
        split = settle(sampling.stratified_split(rows, "label", ["text", "label"], spec.test_share, spec.seed), "split")
        held_out = split.filter("is_test").drop("is_test")
        rows = split.filter("not is_test").drop("is_test")
    weighted = stats.balanced_class_weights(rows, "label") if spec.balanced else rows
    if spec.text_spec.cleaner == "address":
        spec = replace(spec, text_spec=replace(spec.text_spec, cities=known_cities(rows, "label")))
    stages = fit_tfidf(rows, spec.text_spec, "text")
    indexer = StringIndexer(inputCol="label", outputCol="label_index", stringOrderType="frequencyDesc").fit(rows)
    ready = PipelineModel([*stages, indexer]).transform(weighted)
    wanted = ["features", "label_index"] + (["class_weight"] if spec.balanced else [])
    # Learners pass over their rows many times: materialise the vectors once.
    ready = settle(ready.select("text", *wanted), "features").repartition("text").drop("text")
    if len(indexer.labels) < 2:
        raise ValueError("at least two classes are needed")
    weight_sum = ready.agg(F.sum("class_weight")).first()[0] if spec.balanced else ready.count()
    fitted = learner(spec, float(weight_sum)).fit(ready)
    namer = IndexToString(inputCol="prediction", outputCol="predicted", labels=indexer.labels)
    model = PipelineModel([*stages, fitted, namer])
    if held_out is None:
        return Trained(spec, model, list(indexer.labels), None, None)
    scored = model.transform(held_out).select("text", "label", "predicted")
    report = stats.classification_report(scored, "label", "predicted")
    return Trained(spec, model, list(indexer.labels), report, scored)


def save_model(model: PipelineModel, folder: str, name: str) -> str:
    """Save a version, then point to it; readers never see a half-written model."""
    spark = SparkSession.active()
    version = uuid.uuid4().hex
    path = f"{folder.rstrip('/')}/{name}/{version}"
    model.write().save(path)
    moved = spark.createDataFrame([(name, path)], "name string, path string").withColumn(
        "saved_at", F.current_timestamp()
    )
    moved.coalesce(1).write.mode("append").parquet(f"{folder.rstrip('/')}/_current")
    return path


def load_models(folder: str, names: tuple[str, ...] = tuple(SPECS)) -> dict[str, PipelineModel]:
    """The latest saved version of each model; a warning names the models never saved, which are left out."""
    spark = SparkSession.active()
    try:
        pointers = spark.read.parquet(f"{folder.rstrip('/')}/_current")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        pointers = spark.createDataFrame([], "name string, path string, saved_at timestamp")
    latest = pointers.groupBy("name").agg(F.max_by("path", "saved_at").alias("path"))
    paths = {r["name"]: r["path"] for r in latest.filter(F.col("name").isin(*names)).collect()}
    missing = [name for name in names if name not in paths]
    if missing:
        warnings.warn(f"no saved model in {folder}: {', '.join(missing)}", stacklevel=2)
    return {name: PipelineModel.load(path) for name, path in paths.items()}


def predict(df: DataFrame, model: PipelineModel | None, in_col: str, out_col: str) -> DataFrame:
    """``df`` with the predicted label of ``in_col``; '' if there is no such model."""
    if model is None:
        return df.withColumn(out_col, F.lit(""))
    # The caller's columns step aside under names that no stage of a model uses.
    kept = {f"_kept_{i}": c for i, c in enumerate(df.columns) if c != out_col}
    aside = [F.col(quoted(c)).alias(n) for n, c in kept.items()]
    source = df.select(*aside, F.expr(text.fill_missing_sql(quoted(in_col))).alias("text"))
    return model.transform(source).select(*[F.col(n).alias(c) for n, c in kept.items()], F.col("predicted").alias(out_col))
