"""Features against brute force; training, prediction and enrichment on miniature labels."""

import math
import random
import re
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import enrich, features, models, stats
from shelfwise.operators.cleaning import ADDRESS_COLUMNS, PRODUCT_COLUMNS
from shelfwise.operators.features import TextSpec
from shelfwise.plans import learning
from shelfwise.plans.load import load_chain
from shelfwise.profiles import MAGNIT
from shelfwise.sources import published

random.seed(1)
KINDS = {"чипсы": "Картофельные", "сухарики": "Хлебные", "семечки": "Подсолнечные"}
TASTES = ["краб", "сыр", "бекон", "лук"]
NAMES = [
    (f"{kind} {taste} Бренд{n} {weight}г", label, taste)
    for kind, label in KINDS.items()
    for taste in TASTES
    for n, weight in enumerate((40, 80, 120, 150, 200))
]
SMALL = {"forest": {"trees": 8, "depth": 6}, "logistic": {"iterations": 30}}


def _small(name):
    spec = models.SPECS[name]
    return spec.with_params(**SMALL[spec.learner])


@pytest.mark.parametrize("max_terms", [2, 4, 9, 50])
def test_vocabulary_by_size_equals_brute_force(spark, monkeypatch, max_terms):
    """Rare n-grams are left out before they are counted, and the terms are those of a full count all the same."""
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["лук", "сыр", "краб", "it's", "соль", "мак"]) for _ in range(rng.randrange(9))) for _ in range(40)]
    texts += [None, "", "лук лук лук лук лук"] + [f"редкий{i} слово{i} лук" for i in range(30)]
    spec = TextSpec("none", "word", 1, 3, min_df=2, max_df=0.4, max_terms=max_terms)
    counted, settle = [], features.settle

    def kept(df, name):
        out = settle(df, name)
        counted.append((name, out.count()))
        return out

    monkeypatch.setattr(features, "settle", kept)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r) for r in features.vocabulary(features.with_terms(df, spec, "t"), spec, len(texts)).select("term", "tf", "df").collect()]

    docs = []
    for t in texts:
        words = re.findall(r"\b\w\w+\b", (t or "").lower())
        docs.append(Counter(" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)))
    tf, n_docs = sum(docs, Counter()), Counter(term for d in docs for term in d)
    bounded = [(t, n, n_docs[t]) for t, n in tf.items() if 2 <= n_docs[t] <= 0.4 * len(docs)]
    assert got == sorted(bounded, key=lambda r: (-r[1], r[0]))[:max_terms]
    if max_terms == 4:
        assert [n for name, n in counted if name == "term_counts"][1] < len({t for t in tf if t.count(" ") == 1})


def test_products_and_places_are_judged_apart(spark, monkeypatch):
    """The judgement of all models equals that on whole rows, but no pair of a product and a place is kept."""
    names = tuple(models.SPECS)
    fields = ["product_name", "weight", "city", "region", "branch", *[models.SPECS[n].output_col for n in names]]
    rng, rows = random.Random(5), []
    for _ in range(400):
        product, place = rng.randrange(15), rng.randrange(15)
        right = "a" if product % 2 else "b"
        outputs = [right, "X", right.upper(), "10"] if product else [None] * 4
        values = dict(zip(["flavor", "brand", "type", "weight"], outputs, strict=True)) | {n: f"{n}{place % 5}" for n in ("city", "region", "branch")}
        own = (f"x{product} {right} {right}" if product != 3 else None, "10", f"city{place % 5}", f"region{place % 4}", None if place == 2 else "branch1")
        rows.append((*own, *[values[n] for n in names]))
    df = spark.createDataFrame(rows, ", ".join(f"{f} string" for f in fields))
    whole = sorted(map(str, learning._judged(df, names).collect()))
    most, settle = [], learning.settle

    def kept(part, name):
        out = settle(part, name)
        most.append(out.count())
        return out

    monkeypatch.setattr(learning, "settle", kept)
    assert sorted(map(str, learning._judged_apart(df).collect())) == whole
    assert max(most) <= 15


def test_tfidf_equals_brute_force(spark):
    texts = ["красный лук лук", "лук сыр", "сыр краб сыр бекон", "", "краб лук сыр", "бекон"]
    spec = TextSpec("product", "word", 1, 2, min_df=2, max_df=0.9, max_terms=50)
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    stages = features.fit_tfidf(df, spec, "t")
    vectors = df
    for stage in stages:
        vectors = stage.transform(vectors)
    terms = next(s for s in stages if hasattr(s, "vocabulary")).vocabulary
    got = {(r["id"], r["term"]): r["weight"] for r in features.long_features(vectors, "id", terms).collect()}

    docs = []
    for t in texts:
        words = re.findall(r"\b\w\w+\b", t.lower())
        docs.append(Counter(words + [" ".join(p) for p in zip(words, words[1:])]))
    df_counts = Counter(term for d in docs for term in d)
    kept = {t for t, n in df_counts.items() if 2 <= n <= 0.9 * len(docs)}
    expected = {}
    for i, d in enumerate(docs):
        raw = {t: n * (math.log((1 + len(docs)) / (1 + df_counts[t])) + 1) for t, n in d.items() if t in kept}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        expected.update({(i, t): w / norm for t, w in raw.items()})
    assert got.keys() == expected.keys()
    assert all(got[k] == pytest.approx(expected[k]) for k in got)


@pytest.fixture(scope="module")
def trained(spark):
    rows = [(n, kind, taste.title(), "Бренд", re.search(r"(\d+)г", n)[1]) for n, kind, taste in NAMES]
    df = spark.createDataFrame(rows, "product_name string, product_type string, flavor string, brand string, weight string")
    return {name: models.train(df, _small(name)) for name in ("type", "weight")}


@pytest.fixture(scope="module")
def places(spark):
    cities = {"Омск": "Сибирь", "Казань": "Волга", "Пермь": "Урал"}
    rows = [(f"г.{c}, ул. Мира, {i}", c, r) for c, r in cities.items() for i in range(12)]
    city = models.train(spark.createDataFrame(rows, "address string, city string, region string"), _small("city"))
    towns = [(f"{c}{s}", r) for c, r in cities.items() for s in ("", " центр", " север", " юг")]
    region = models.train(spark.createDataFrame(towns, "city string, region string"), _small("region"))
    return {"city": city, "region": region}


def test_type_model_beats_the_majority(trained):
    score = stats.accuracy(trained["type"].scored, "label", "predicted").first()["accuracy"]
    assert score > 0.6
    assert trained["weight"].report is None


def test_a_constant_has_no_skill(trained):
    scored = trained["type"].scored
    real = {r["label"]: (r["support"], r["beats_majority"]) for r in stats.skill(scored, "label", "predicted").collect()}
    assert real == {kind: (4, True) for kind in KINDS.values()}
    for kind in KINDS.values():
        constant = scored.withColumn("predicted", F.lit(kind))
        assert {r["beats_majority"] for r in stats.skill(constant, "label", "predicted").collect()} == {False}


def test_report_is_complete(trained):
    report = {r["label"]: r for r in trained["type"].report.collect()}
    assert set(report) == {*KINDS.values(), "accuracy", "macro avg", "weighted avg"}
    assert report["accuracy"]["support"] == sum(report[k]["support"] for k in KINDS.values())


def test_address_models(spark, places):
    df = spark.createDataFrame([("г.Казань, ул. Новая",), ("г.Пермь",)], "address string")
    loaded = {name: t.model for name, t in places.items()}
    rows = enrich.predict_address(df, loaded).orderBy("address").collect()
    assert [(r["city_predicted"], r["region_predicted"], r["branch_predicted"]) for r in rows] == [
        ("Казань", "Волга", ""), ("Пермь", "Урал", ""),
    ]


def test_city_model_knows_two_word_cities(spark, tmp_path):
    cities = ["Нижний Новгород", "Нижний Тагил", "Великий Новгород", "Омск"]
    rows = [(f"г.{c}, ул. Мира, {i}", f"город {c}") for c in cities for i in range(12)]
    trained = models.train(spark.createDataFrame(rows, "address string, city string"), _small("city"))
    assert trained.spec.text_spec.cities == ("великий новгород", "нижний новгород", "нижний тагил", "омск")
    folder = str(tmp_path / "models")
    models.save_model(trained.model, folder, "city")
    loaded = models.load_models(folder, ("city",))["city"]
    df = spark.createDataFrame([("г.Нижний Тагил, пр-кт Нижний",), ("г.Нижний, ул. 1",), ("Омск",), (None,)], "text string")
    shown = {r["text"]: r["clean"] for r in loaded.transform(df).select("text", "clean").collect()}
    assert shown["г.Нижний Тагил, пр-кт Нижний"].endswith(" natasha:нижний тагил")
    assert shown["г.Нижний, ул. 1"].endswith(" natasha:") and shown["Омск"] == "омск natasha:"
    score = stats.accuracy(trained.scored, "label", "predicted").first()["accuracy"]
    assert score > 0.9


def test_saved_model_predicts_the_same(spark, trained, tmp_path):
    folder = str(tmp_path / "models")
    with pytest.warns(UserWarning, match="no saved model .*: type, brand"):
        assert models.load_models(folder, ("type", "brand")) == {}
    models.save_model(trained["type"].model, folder, "type")
    models.save_model(trained["type"].model, folder, "type")
    with pytest.warns(UserWarning, match="no saved model"):
        loaded = models.load_models(folder)
    assert set(loaded) == {"type"}
    df = spark.createDataFrame([(n,) for n, _, _ in NAMES] + [(None,)], "t string")
    both = models.predict(models.predict(df, trained["type"].model, "t", "a"), loaded["type"], "t", "b")
    assert both.filter("a <> b or a is null").count() == 0 and both.count() == len(NAMES) + 1


def test_enrichment(spark, trained, places):
    loaded = {"type": trained["type"].model, "city": places["city"].model}
    df = spark.createDataFrame(
        [("чипсы краб туба 150г", "г.Омск"), (None, None), ("чипсы краб туба 150г", "г.Омск")], "`Товар` string, `Адрес` string"
    )
    rows = enrich.enrich(df, loaded, MAGNIT).filter("product_name is not null").collect()
    assert len(rows) == 2
    assert rows[0]["weight_extracted_regex"] == 150 and rows[0]["package_type"] == "Туба"
    assert rows[0]["product_type_predicted"] == "Картофельные" and rows[0]["city_predicted"] == "Омск"
    assert rows[0]["flavor_predicted"] == "" and rows[0]["region_predicted"] == ""


def test_columns_without_inputs(spark):
    df = spark.createDataFrame([("1",)], "`Артикул` string")
    row = enrich.enrich(df, {}, MAGNIT).first().asDict()
    assert all(row[c] == "" for c in PRODUCT_COLUMNS + ADDRESS_COLUMNS)
    named = spark.createDataFrame([("чипсы",)], "`Товар` string")
    assert set(enrich.enrich(named, {}, MAGNIT).columns) == {"product_name", *PRODUCT_COLUMNS, *ADDRESS_COLUMNS}


def test_longest_city_wins(spark):
    addresses = ["г.Нижний Новгород, ул. 1", "г.Омск", "г.Нигде", "г.Старый Большой Новый Двор, ул. 2", None]
    df = spark.createDataFrame([(a,) for a in addresses], "address string")
    known = spark.createDataFrame([("Нижний Новгород",), ("Нижний",), ("омск",), ("Старый Большой Новый Двор",)], "city string")
    got = {r["address"]: r["city_found"] for r in enrich.extract_city(df, "address", known).collect()}
    expected = ["нижний новгород", "омск", "", "старый большой новый двор", ""]
    assert got == dict(zip(addresses, expected, strict=True))
    assert {r["city_found"] for r in enrich.extract_city(df, "address", known.limit(0)).collect()} == {""}


def test_guards(spark):
    empty = spark.createDataFrame([], "product_name string, product_type string")
    with pytest.raises(ValueError, match="empty"):
        models.train(empty, _small("type"))


def test_class_weights_balance(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 2, "label string")
    sums = stats.balanced_class_weights(df, "label").groupBy("label").agg(F.sum("class_weight").alias("w")).collect()
    assert {r["label"]: r["w"] for r in sums} == {"a": pytest.approx(4.0), "b": pytest.approx(4.0)}


def test_load_with_models(spark, trained, places, drop, tmp_path):
    drop("magnit_a.csv", "Наименование;Адрес\nсемечки лук 80г;г.Пермь\nчипсы сыр 40г;г.Омск\nчипсы сыр 40г;\n")
    loaded = {"type": trained["type"].model, "city": places["city"].model, "region": places["region"].model}
    load_chain(spark, str(tmp_path), MAGNIT, loaded, str(tmp_path / "sink"))
    rows = published.read(spark, str(tmp_path / "sink")).filter("address is not null")
    got = {(r["product_type_predicted"], r["city_predicted"], r["region_predicted"]) for r in rows.collect()}
    assert got == {("Подсолнечные", "Пермь", "Урал"), ("Картофельные", "Омск", "Сибирь")}
    assert published.read(spark, str(tmp_path / "sink")).count() == 3


@pytest.mark.parametrize("name", ["flavor", "brand", "type", "weight", "city"])
def test_a_constant_prediction_is_judged_without_skill(spark, name):
    """What the model queries show turns false for any one model that always says the same."""
    rows = [(f"{t} {b} {k}", str(w), f"город {t}") for t in ("red", "blue") for b in ("ring", "bolt") for k in ("small", "promo") for w in (10, 20)]
    df = spark.createDataFrame(rows, "product_name string, weight string, city string")
    names = ("flavor", "brand", "type", "weight", "city")
    right = {models.SPECS[n].output_col: F.expr(learning.TRUTH[n][0]) for n in names}
    assert {r["beats_majority"] for r in learning._judged(df.withColumns(right), names).collect()} == {True}
    output = models.SPECS[name].output_col
    constant = df.withColumns(right | {output: F.lit(df.select(right[output]).first()[0])})
    judged = learning._judged(constant, names).collect()
    assert {r["model"] for r in judged if not r["beats_majority"]} == {name}
    assert sum(r["support"] for r in judged) == len(rows) * len(names)


def test_predictions_outside_the_trained_labels_are_told(spark):
    rows = [("Омск", "Сибирь", ""), ("Казань", "Волга", "Центр")]
    df = spark.createDataFrame(rows, "city_predicted string, region_predicted string, branch_predicted string")
    labels = {"city": ["Омск", "Казань"], "region": ["Сибирь", "Волга"], "branch": ["", "Центр"]}
    assert learning._trained_labels(df, labels) is True
    assert learning._trained_labels(df, labels | {"branch": ["Центр"]}) is False
    missing = df.unionByName(df.limit(1).withColumn("region_predicted", F.lit(None).cast("string")))
    assert learning._trained_labels(missing, labels) is False
    assert "trained_labels" in learning._judged_sql(learning.ADDRESS_MODELS, "address", more=", true as trained_labels")
