"""Boosted trees for many classes against the same trees grown in plain numpy."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from shelfwise.operators import models, stats
from shelfwise.operators.boosting import LEAST_CURVATURE, LEAST_GAIN, BoostedTrees, SoftmaxBoosting

ROWS, TERMS, CLASSES = 180, 9, 3


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(11)
    x = np.where(rng.random((ROWS, TERMS)) < 0.5, rng.random((ROWS, TERMS)), 0.0)
    label = (x[:, 0] > 0.3).astype(int) + (x[:, 1] + 0.3 * x[:, 2] > 0.4)
    return x, label, 0.5 + rng.random(ROWS)


@pytest.fixture(scope="module")
def table(spark, data):
    x, label, weight = data
    rows = [
        (i, Vectors.sparse(TERMS, {int(t): float(x[i, t]) for t in np.flatnonzero(x[i])}), float(label[i]), float(weight[i]))
        for i in range(ROWS)
    ]
    return spark.createDataFrame(rows, ["id", "features", "label_index", "class_weight"]).repartition(3)


def grow(x, label, weight, cuts, rounds, depth, rate, l2):
    """Scores after some rounds: every node takes the best of all terms and cuts, tried one by one."""
    share = np.array([weight[label == k].sum() for k in range(CLASSES)])
    scores = np.repeat(np.log(share / share.sum())[None], len(x), 0)
    for _ in range(rounds):
        e = np.exp(scores - scores.max(1, keepdims=True))
        p = e / e.sum(1, keepdims=True)
        added = np.zeros_like(scores)
        for k in range(CLASSES):
            g = weight * (p[:, k] - (label == k))
            h = weight * p[:, k] * (1 - p[:, k])

            def node(rows, level, k=k, g=g, h=h):
                best, gs, hs = None, g[rows].sum(), h[rows].sum()
                if level < depth:
                    for t in range(TERMS):
                        for cut in cuts[t]:
                            right = rows[x[rows, t] > cut]
                            gr, hr = g[right].sum(), h[right].sum()
                            if hr < LEAST_CURVATURE or hs - hr < LEAST_CURVATURE:
                                continue
                            gain = gr**2 / (hr + l2) + (gs - gr) ** 2 / (hs - hr + l2) - gs**2 / (hs + l2)
                            if gain > LEAST_GAIN and (best is None or gain > best[0] + 1e-12):
                                best = gain, t, cut
                if best is None:
                    added[rows, k] = -rate * (CLASSES - 1) / CLASSES * gs / (hs + l2)
                    return
                over = x[rows, best[1]] > best[2]
                node(rows[over], level + 1)
                node(rows[~over], level + 1)

            node(np.arange(len(x)), 0)
        scores = scores + added
    return scores


def _cuts(x):
    """Zero, and the quartiles of a term's values above zero as the smallest value that covers the share."""
    found = []
    for t in range(TERMS):
        values = np.sort(x[x[:, t] > 0, t])
        found.append([0.0, *sorted({values[int(np.ceil(q * len(values))) - 1] for q in (0.25, 0.5, 0.75)})])
    return found


def _scores(model, table):
    rows = table.select("id", model.scores().alias("s")).orderBy("id").collect()
    return np.array([r["s"] for r in rows])


@pytest.mark.parametrize(("rounds", "depth"), [(12, 1), (3, 3)])
def test_equals_plain_trees(table, data, rounds, depth):
    x, label, weight = data
    model = SoftmaxBoosting(trees=rounds, rate=0.3, depth=depth, weightCol="class_weight").fit(table)
    want = grow(x, label, weight, _cuts(x), rounds, depth, 0.3, 1.0)
    assert model.node_arrays()["term"].shape == (rounds, CLASSES, 2 << depth)
    assert _scores(model, table) == pytest.approx(want, abs=1e-9)


def test_learns_saves_and_loads(spark, table, data, tmp_path):
    model = SoftmaxBoosting(trees=6, rate=0.5, depth=3).fit(table)
    predicted = model.transform(table)
    assert predicted.columns == [*table.columns, "prediction"]
    assert predicted.filter("prediction = label_index").count() > 0.9 * ROWS
    PipelineModel([model]).write().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    assert isinstance(loaded.stages[0], BoostedTrees)
    both = loaded.transform(predicted.withColumnRenamed("prediction", "before"))
    assert both.filter("prediction <> before").count() == 0


def test_stops_where_nothing_can_be_split(spark):
    same = spark.createDataFrame([(Vectors.sparse(2, [0], [1.0]), float(i % 3)) for i in range(9)] , ["features", "label_index"])
    model = SoftmaxBoosting(trees=5, depth=2).fit(same)
    assert model.node_arrays()["term"].shape[0] == 0
    assert model.transform(same).count() == 9
    empty = spark.createDataFrame([(Vectors.sparse(2, [], []), 0.0), (Vectors.sparse(2, [], []), 1.0)], ["features", "label_index"])
    assert SoftmaxBoosting(trees=2, depth=1).fit(empty).transform(empty).filter("prediction = 0").count() == 2


def test_rounds_beyond_a_stored_state(spark, table, data, monkeypatch):
    from shelfwise.operators import boosting

    whole = SoftmaxBoosting(trees=5, rate=0.3, depth=1).fit(table)
    monkeypatch.setattr(boosting, "ROUNDS_PER_STORE", 2)
    parts = SoftmaxBoosting(trees=5, rate=0.3, depth=1).fit(table)
    assert _scores(parts, table) == pytest.approx(_scores(whole, table), abs=1e-9)


def test_a_boosted_model_of_names(spark, tmp_path):
    kinds = {"чипсы": "Картофельные", "сухарики": "Хлебные", "семечки": "Подсолнечные", "орехи": "Ореховые"}
    rows = [(f"{word} {taste} бренд{n}", kind) for word, kind in kinds.items() for taste in ("краб", "сыр") for n in range(8)]
    df = spark.createDataFrame(rows, "product_name string, product_type string")
    assert models.BOOSTED["type"].params["trees"] == 200
    spec = replace(models.BOOSTED["type"], params={"trees": 8, "rate": 0.3, "depth": 2})
    trained = models.train(df, spec)
    assert {r["beats_majority"] for r in stats.skill(trained.scored, "label", "predicted").collect()} == {True}
    models.save_model(trained.model, str(tmp_path), "type")
    loaded = models.load_models(str(tmp_path), ("type",))["type"]
    got = models.predict(df, loaded, "product_name", "predicted_type")
    assert got.filter(F.col("predicted_type") == F.col("product_type")).count() >= 0.9 * len(rows)
