"""Registered queries: text features, model training and enrichment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import ngrams, text
from shelfwise.operators import enrich as enriching
from shelfwise.operators import features, models, sampling, stats
from shelfwise.operators.features import TextSpec
from shelfwise.operators.headers import standardize_columns
from shelfwise.plans.bindings import (
    ADDRESS_LABELS,
    PRODUCT_LABELS,
    TOWN_LABELS,
    address_labels,
    drop_rows,
    product_labels,
    sales,
    table,
    town_labels,
)
from shelfwise.plans.registry import query, sales_cte
from shelfwise.plans.rows import DROP_CTE, PACK_SQL, WEIGHT_SQL
from shelfwise.profiles import MAGNIT
from shelfwise.session import scratch_path, settle, spread

TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
STOPPED = ("гр", "small")


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", *columns))


def _grams_sql(tokens: str, low: int, high: int) -> str:
    def grams(n: int) -> str:
        joined = " || ' ' || ".join(f"{tokens}[i + {k}]" for k in range(n))
        return f"[{joined} for i in range(1, len({tokens}) - {n} + 2)]"

    return f"flatten([{', '.join(grams(n) for n in range(low, high + 1))}])"


def _digest(df: DataFrame, array: str) -> DataFrame:
    """Length and digest of an array per document, which pin down its whole content."""
    return df.select("doc_id", F.size(array).alias("n"), F.md5(F.array_join(array, "|")).alias("digest"))


@query(f"select doc_id, len(t) as n, md5(array_to_string(t, '|')) as digest from (select doc_id, {TOKENS} as t from documents)")
def word_tokens(spark, sf_dir):
    rows = _documents(spark, sf_dir)
    return _digest(rows.select("doc_id", ngrams.word_tokens("text").alias("t")), "t")


@query(
    "select doc_id, len(g) as n, md5(array_to_string(g, '|')) as digest from "
    f"(select doc_id, {_grams_sql('t', 1, 3)} as g from (select doc_id, {TOKENS} as t from documents))"
)
def word_ngrams(spark, sf_dir):
    rows = _documents(spark, sf_dir).select("doc_id", ngrams.word_tokens("text").alias("t"))
    return _digest(rows.select("doc_id", ngrams.word_ngrams("t", 1, 3).alias("g")), "g")


@query(
    "select doc_id, len(g) as n, md5(array_to_string(g, '|')) as digest from (select doc_id, flatten([flatten("
    "[[substring(concat(' ', w, ' '), i, n) for i in range(1, greatest(2, length(w) + 4 - n))] "
    "for n in range(3, least(6, greatest(3, length(w) + 2)) + 1)]) for w in "
    r"regexp_extract_all(lower(text), '[^\s\v\x1c-\x1f\x85\p{Z}]+')]) as g from documents)"
)
def char_ngrams(spark, sf_dir):
    rows = _documents(spark, sf_dir)
    return _digest(rows.select("doc_id", ngrams.char_ngrams("text", 3, 6).alias("g")), "g")


@query(
    "select product_name, array_to_string([w for w in regexp_extract_all(lower(product_name), "
    rf"'[\p{{L}}\p{{N}}_]{{2,}}') if w not in {STOPPED}], ' ') as words from ({PRODUCT_LABELS})"
)
def stop_words(spark, sf_dir):
    names = product_labels(spark, sf_dir)
    return names.select("product_name", F.array_join(ngrams.word_tokens("product_name", STOPPED), " ").alias("words"))


DOCUMENT_SPEC = TextSpec("none", "word", 1, 2, min_df=2, max_df=0.95, max_terms=10000)


def _vocabulary_sql(spec: TextSpec) -> str:
    return (
        f"docs as (select doc_id, {TOKENS} as t from documents), size as (select count(*) as n from documents), "
        f"terms as (select doc_id, unnest({_grams_sql('t', spec.low, spec.high)}) as term from docs), "
        "counts as (select doc_id, term, count(*) as tf from terms group by 1, 2), "
        "vocabulary as (select term, cast(sum(tf) as bigint) as tf, count(*) as df, "
        "ln((1 + any_value(n)) / (1 + count(*))) + 1 as idf from counts, size group by 1 "
        f"having count(*) >= {spec.min_df} and count(*) <= {spec.max_df} * any_value(n) "
        f"order by sum(tf) desc, term limit {spec.max_terms})"
    )


@query(f"with {_vocabulary_sql(DOCUMENT_SPEC)} select term, tf, df, round(idf, 8) as idf from vocabulary")
def vocabulary(spark, sf_dir):
    rows = _documents(spark, sf_dir)
    termed = features.with_terms(rows, DOCUMENT_SPEC, "text")
    kept = features.vocabulary(termed, DOCUMENT_SPEC, rows.count())
    return kept.withColumn("idf", F.round("idf", 8))


WEIGHT_SPEC = TextSpec("none", "word", 1, 3, min_df=3, max_df=0.9, max_terms=5000)


@query(
    f"with {_vocabulary_sql(WEIGHT_SPEC)}, weights as (select doc_id, term, c.tf * idf as w "
    "from counts c join vocabulary using (term)) "
    "select doc_id, term, round(w / sqrt(sum(w * w) over (partition by doc_id)), 7) as weight from weights"
)
def tfidf(spark, sf_dir):
    rows = _documents(spark, sf_dir)
    stages = features.fit_tfidf(rows, WEIGHT_SPEC, "text")
    vectors = rows
    for stage in stages:
        vectors = stage.transform(vectors)
    terms = next(s for s in stages if hasattr(s, "vocabulary")).vocabulary
    weights = features.long_features(vectors, "doc_id", terms)
    return weights.withColumn("weight", F.round("weight", 7))


@query(
    "select doc_id, lang, cast(row_number() over (partition by lang order by "
    "md5(concat('42', chr(31), cast(doc_id as varchar))), doc_id) <= round(0.3 * count(*) over (partition by lang)) "
    "as int) as is_test from documents"
)
def stratified_split(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang")
    split = sampling.stratified_split(rows, "lang", ["doc_id"], 0.3, seed=42)
    return split.withColumn("is_test", F.col("is_test").cast("int"))


# Models.

def _label_set(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "city":
        return address_labels(spark, sf_dir)
    return town_labels(spark, sf_dir) if name in ("region", "branch") else product_labels(spark, sf_dir)


_TRAINED: dict[tuple[str, str, str], models.Trained] = {}


def _trained(spark: SparkSession, sf_dir: str, name: str) -> models.Trained:
    """The model of a data folder, trained once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _TRAINED:
        _TRAINED[key] = models.train(_label_set(spark, sf_dir, name), models.SPECS[name])
    return _TRAINED[key]


def _held_out(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Held-out rows per label, and whether the model is right more often than the most frequent label is."""
    return stats.skill(_trained(spark, sf_dir, name).scored, "label", "predicted")


def _held_out_sql(name: str, labels: str) -> str:
    """The same from the label rows alone: how many of each label are held out, and that a model must have skill.

    No given text is too short for a model.
    """
    spec = models.SPECS[name]
    rows = f"select distinct {spec.text_col} as text, cast({spec.label_col} as varchar) as label from ({labels})"
    rows = f"select * from ({rows}) where text is not null and label is not null"
    if spec.sample is not None:
        order = f"md5('{spec.seed}' || chr(31) || text || chr(31) || label)"
        rows += f" qualify row_number() over (order by {order}) <= {spec.sample}"
    if spec.title_labels:
        rows = f"select text, upper(label[1]) || lower(label[2:]) as label from ({rows})"
    held = f"cast(round(cast({spec.test_share} as double) * count(*)) as bigint)"
    return (
        f"select label, support, true as beats_majority from (select label, {held} as support from ({rows}) "
        f"group by label having count(*) >= {spec.min_class_rows}) where support > 0"
    )


@query(_held_out_sql("flavor", PRODUCT_LABELS))
def train_flavor(spark, sf_dir):
    return _held_out(spark, sf_dir, "flavor")


@query(_held_out_sql("brand", PRODUCT_LABELS))
def train_brand(spark, sf_dir):
    return _held_out(spark, sf_dir, "brand")


@query(_held_out_sql("type", PRODUCT_LABELS))
def train_type(spark, sf_dir):
    return _held_out(spark, sf_dir, "type")


@query(_held_out_sql("type", PRODUCT_LABELS))
def train_boosted_type(spark, sf_dir):
    """The type model by boosting, on the rows that ``train_type`` learns from: 34 rounds, about 200 trees for six classes.

    ``models.BOOSTED`` has the rounds of a production model; a round takes a second, however few rows there are.
    """
    trained = models.train(product_labels(spark, sf_dir), models.BOOSTED["type"].with_params(trees=34))
    return stats.skill(trained.scored, "label", "predicted")


@query(f"select weight as label, count(*) as support, true as beats_majority from ({PRODUCT_LABELS}) group by 1")
def train_weight(spark, sf_dir):
    """The weight model has no held-out part; this judges its predictions on its own labels."""
    trained = _trained(spark, sf_dir, "weight")
    rows = product_labels(spark, sf_dir).select("product_name", "weight")
    guessed = models.predict(rows, trained.model, "product_name", "weight_predicted")
    return stats.skill(guessed, "weight", "weight_predicted")


@query(_held_out_sql("city", ADDRESS_LABELS))
def train_city(spark, sf_dir):
    return _held_out(spark, sf_dir, "city")


@query(_held_out_sql("region", TOWN_LABELS))
def train_region(spark, sf_dir):
    return _held_out(spark, sf_dir, "region")


@query(_held_out_sql("branch", TOWN_LABELS))
def train_branch(spark, sf_dir):
    return _held_out(spark, sf_dir, "branch")


_FOLDERS: dict[tuple[str, str], str] = {}
_SAVED: set[tuple[str, str]] = set()


def _loaded(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = tuple(models.SPECS)) -> dict:
    """Models of a data folder, each trained and saved once per application, then loaded."""
    folder = _FOLDERS.setdefault((spark.sparkContext.applicationId, sf_dir), scratch_path(spark, "models"))
    for name in names:
        if (folder, name) not in _SAVED:
            models.save_model(_trained(spark, sf_dir, name).model, folder, name)
            _SAVED.add((folder, name))
    return models.load_models(folder, names)


@query(f"select true as same, count(distinct city) as rows from ({TOWN_LABELS})")
def save_and_load_model(spark, sf_dir):
    """A saved and loaded model against the one in memory: every row must agree."""
    trained = _trained(spark, sf_dir, "region")
    folder = scratch_path(spark, "models")
    models.save_model(trained.model, folder, "region")
    loaded = models.load_models(folder)["region"]
    towns = town_labels(spark, sf_dir).select("city").distinct()
    both = models.predict(models.predict(towns, trained.model, "city", "before"), loaded, "city", "after")
    return both.groupBy((F.col("before") == F.col("after")).alias("same")).agg(F.count(F.lit(1)).alias("rows"))


# What each prediction should be, from columns that the models do not see as labels: Spark's SQL and DuckDB's.
TRUTH = {
    "flavor": ("split_part(product_name, ' ', 2)",) * 2,
    "brand": ("initcap(split_part(product_name, ' ', 1))", "upper(product_name[1]) || lower(split_part(product_name, ' ', 1)[2:])"),
    "type": ("upper(split_part(product_name, ' ', 3))",) * 2,
    "weight": ("weight",) * 2,
    "city": ("city",) * 2,
    "region": ("region",) * 2,
    "branch": ("branch",) * 2,
}
ADDRESS_MODELS = ("city", "region", "branch")


def _judged(rows: DataFrame, names: tuple[str, ...], n_rows: Column | None = None) -> DataFrame:
    """(model, label, support, beats_majority): rows per true label, and whether the predictions beat the most frequent one.

    ``n_rows`` counts the rows of a group that are counted already.
    """
    truth = {f"_{n}": F.expr(TRUTH[n][0]) for n in names}
    outputs = [models.SPECS[n].output_col for n in names]
    counted = settle(rows.withColumns(truth).groupBy(*truth, *outputs).agg((F.count(F.lit(1)) if n_rows is None else n_rows).alias("n")), "judged")
    parts = [
        stats.skill(counted.withColumnRenamed(f"_{n}", "label"), "label", output, "n").select(F.lit(n).alias("model"), "*")
        for n, output in zip(names, outputs, strict=True)
    ]
    return reduce(DataFrame.unionByName, parts)


def _judged_apart(rows: DataFrame) -> DataFrame:
    """``_judged`` for all models; each side counts its own distinct inputs and predictions first."""
    sides = []
    for names, inputs in ((models.PRODUCT_MODELS, ("product_name", "weight")), (ADDRESS_MODELS, ADDRESS_MODELS)):
        counted = rows.groupBy(*inputs, *[models.SPECS[n].output_col for n in names]).agg(F.count(F.lit(1)).alias("n"))
        sides.append(_judged(counted, names, F.sum("n")))
    return sides[0].unionByName(sides[1])


def _trained_labels(rows: DataFrame, labels: dict[str, list[str]]) -> bool | None:
    """Whether every prediction of every row is a label that its model was trained on."""
    known = [F.coalesce(F.col(models.SPECS[n].output_col).isin(own), F.lit(False)) for n, own in labels.items()]
    return rows.agg(F.bool_and(reduce(Column.__and__, known))).first()[0]


def _judged_sql(names: tuple[str, ...], *fields: str, more: str = "") -> str:
    parts = [
        f"select '{n}' as model, {TRUTH[n][1]} as label, count(*) as support, true as beats_majority{more} from sales group by 2"
        for n in names
    ]
    return f"with {sales_cte(*fields)} {' union all '.join(parts)}"


@query(_judged_sql(models.PRODUCT_MODELS, "product_name", "weight"))
def predict_product(spark, sf_dir):
    """The four predictions for every line item, judged by what its product is."""
    rows = sales(spark, sf_dir, "product_name", "weight")
    return _judged(enriching.predict_product(rows, _loaded(spark, sf_dir, models.PRODUCT_MODELS)), models.PRODUCT_MODELS)


@query(_judged_sql(ADDRESS_MODELS, "address", *ADDRESS_MODELS, more=", true as trained_labels"))
def predict_address(spark, sf_dir):
    """The three predictions for every line item, the last two from the predicted city, and whether all are trained labels."""
    rows = sales(spark, sf_dir, "address", *ADDRESS_MODELS)
    outputs = [models.SPECS[n].output_col for n in ADDRESS_MODELS]
    predicted = enriching.predict_address(rows, _loaded(spark, sf_dir, ADDRESS_MODELS))
    counted = settle(predicted.groupBy(*ADDRESS_MODELS, *outputs).agg(F.count(F.lit(1)).alias("n")), "predicted")
    sound = _trained_labels(counted, {n: _trained(spark, sf_dir, n).labels for n in ADDRESS_MODELS})
    return _judged(counted, ADDRESS_MODELS, F.sum("n")).withColumn("trained_labels", F.lit(sound))


DROP_HEADERS = ("Наименование", "Артикул", "Адрес", "Город", "Регион", "Филиал")

GRAMS_SQL = (
    f"cast(trunc(try_cast(replace(regexp_extract(product_name, '{WEIGHT_SQL}', 1), ',', '.') as double) * "
    f"case when lower(regexp_extract(product_name, '{WEIGHT_SQL}', 2)) like '%кг%' then 1000 else 1 end) as bigint)"
)
PACK_CASE = f"case when {PACK_SQL.replace('lower(text)', 'lower(product_name)')} then 'Туба' else 'Пакет' end"
NO_MODELS = ", ".join(
    f"'' as {c}"
    for c in (
        "flavor_predicted", "brand_predicted", "weight_predicted", "product_type_predicted",
        "city_predicted", "region_predicted", "branch_predicted",
    )
)


SKILLS = ", ".join(f"true as {spec.output_col}" for spec in models.SPECS.values())


@query(
    f"with {DROP_CTE} select product_name, product_code, address, city, region, branch, "
    f"{GRAMS_SQL} as weight_extracted_regex, {PACK_CASE} as package_type, {SKILLS} from sales"
)
def enrich(spark, sf_dir):
    """Every row enriched. A prediction has no SQL form: its column says whether the model's predictions for all rows,
    judged by what the products and places are, beat the most frequent label."""
    rows = enriching.enrich(drop_rows(spark, sf_dir, *DROP_HEADERS), _loaded(spark, sf_dir), MAGNIT)
    rows = settle(rows, "enriched")
    names = tuple(models.SPECS)
    # Products and places are judged by themselves: together, their values would be as many as their pairs.
    judged = _judged_apart(rows.withColumn("weight", F.col("weight_extracted_regex").cast("string")))
    skilled = dict(judged.groupBy("model").agg(F.bool_and("beats_majority")).collect())
    return rows.withColumns({models.SPECS[n].output_col: F.lit(skilled[n]) for n in names})


@query(
    f"with {DROP_CTE} select product_name, product_code, address, city, region, branch, "
    f"{GRAMS_SQL} as weight_extracted_regex, {PACK_CASE} as package_type, {NO_MODELS} from sales"
)
def enrich_without_models(spark, sf_dir):
    return enriching.enrich(drop_rows(spark, sf_dir, *DROP_HEADERS), {}, MAGNIT)


@query(
    f"with {DROP_CTE} select product_name, branch, {GRAMS_SQL} as grams, {PACK_CASE} as package_type from sales"
)
def score_distinct(spark, sf_dir):
    def score(texts: DataFrame, name: str) -> DataFrame:
        return texts.withColumns({"grams": text.extract_weight_g(name), "package_type": text.packaging_type(name)})

    rows = standardize_columns(drop_rows(spark, sf_dir, *DROP_HEADERS), MAGNIT).select("product_name", "branch")
    return enriching.score_distinct(rows, "product_name", score)
