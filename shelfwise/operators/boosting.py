"""Boosted trees for any number of classes, grown for all classes together by DataFrame aggregates.

Every round adds one tree per class to the class's score; a softmax turns scores into probabilities. A level of all
trees of a round takes one pass: each row sends its gradient and curvature, per class and node, to every term it
has, the sums per (class, node, term) are combined on the map side, and the best split of each node is all that
the driver sees.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.session import settle

QUANTILES = (0.25, 0.5, 0.75)
BINS = len(QUANTILES) + 1  # bins of the values above zero; absent terms are bin 0
ROUNDS_PER_STORE = 10
LEAST_CURVATURE, LEAST_GAIN = 1e-3, 1e-9
ALL = -1  # the term that stands for every row


def _numbers(values, kind: str) -> Column:
    """A constant array: as one literal, however long it is."""
    return F.split(F.lit(",".join(map(repr, np.asarray(values).ravel().tolist()))), ",").cast(f"array<{kind}>")


def _leaf(trees: int, depth: int, goes_right) -> Column:
    """Per tree the number of the node reached after ``depth`` steps; children of node n are 2n and 2n + 1."""
    size = 1 << (depth + 1)

    def walk(tree: Column) -> Column:
        def step(node: Column, _: Column) -> Column:
            return node * 2 + goes_right(tree * size + node).cast("int")

        return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(1), step)

    return F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), walk)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is named there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


class BoostedTrees(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """The fitted trees: adds ``prediction``, the class of the largest score, as the position of its label.

    Its parameters are the model, so it is saved and loaded like any stage.
    """

    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "class number", TypeConverters.toString)
    depth = Param(Params._dummy(), "depth", "levels of splits", TypeConverters.toInt)
    start = Param(Params._dummy(), "start", "score of each class before the first round", TypeConverters.toListFloat)
    trees = Param(Params._dummy(), "trees", "terms, cuts and values of all nodes, as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, featuresCol="features", predictionCol="prediction", depth=1, start=(), trees=None):
        super().__init__()
        self._setDefault(featuresCol="features", predictionCol="prediction")
        given = {k: v for k, v in self._input_kwargs.items() if v is not None and k not in ("start",)}
        self._set(**given, start=list(start))

    def node_arrays(self) -> dict[str, np.ndarray]:
        """term, cut and value of the nodes: [round, class, node]."""
        shape = (-1, len(self.getOrDefault(self.start)), 1 << (self.getOrDefault(self.depth) + 1))
        stored = json.loads(self.getOrDefault(self.trees))
        return {name: np.array(stored[name], float).reshape(shape) for name in ("term", "cut", "value")}

    def scores(self) -> Column:
        """The scores of all classes."""
        start, depth = self.getOrDefault(self.start), self.getOrDefault(self.depth)
        nodes = self.node_arrays()
        rounds, classes, size = nodes["term"].shape
        begin = _numbers(start, "double")
        if not rounds:
            return begin
        term, cut, value = (
            _numbers(nodes[n].astype(t), k) for n, t, k in (("term", int, "int"), ("cut", float, "double"), ("value", float, "double"))
        )
        k_of = F.sequence(F.lit(0), F.lit(classes - 1))

        def totals(leaves: Column) -> Column:
            def total(k: Column) -> Column:
                # Trees are numbered round by round.
                of_class = F.sequence(k, F.lit((rounds - 1) * classes) + k, F.lit(classes))
                return F.aggregate(of_class, F.get(begin, k), lambda s, t: s + F.get(value, t * size + F.get(leaves, t)))

            return F.transform(k_of, total)

        def leaves_of(x: Column) -> Column:
            return _leaf(rounds * classes, depth, lambda at: F.get(x, F.get(term, at)) > F.get(cut, at))

        return _bound(_bound(vector_to_array(F.col(self.getOrDefault(self.featuresCol))), leaves_of), totals)

    def _transform(self, df: DataFrame) -> DataFrame:
        scored = df.withColumn("_scores", self.scores())
        best = F.array_position("_scores", F.array_max("_scores")) - 1
        return scored.withColumn(self.getOrDefault(self.predictionCol), best.cast("double")).drop("_scores")


@dataclass(frozen=True)
class SoftmaxBoosting:
    """Learner for ``features`` (sparse vectors of values from 0), ``label_index`` and, if named, a weight column."""

    trees: int = 200
    rate: float = 0.1
    depth: int = 3
    l2: float = 1.0
    weightCol: str | None = None
    featuresCol: str = "features"
    labelCol: str = "label_index"
    predictionCol: str = "prediction"

    def fit(self, df: DataFrame) -> BoostedTrees:
        """``trees`` rounds, or fewer if no node of a round can be split."""
        weight = F.col(self.weightCol).cast("double") if self.weightCol else F.lit(1.0)
        vector = F.unwrap_udt(F.col(self.featuresCol))
        places = F.coalesce(vector["indices"], F.sequence(F.lit(0), F.size(vector["values"]) - 1))
        rows = df.select(
            F.col(self.labelCol).cast("int").alias("label"),
            weight.alias("weight"),
            F.filter(F.arrays_zip(places.alias("i"), vector["values"].alias("v")), lambda z: z["v"] > 0).alias("cells"),
        )
        totals = {r["label"]: r["w"] for r in rows.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
        classes = max(totals) + 1
        share = np.array([totals.get(k, 0.0) for k in range(classes)])
        start = np.log(np.maximum(share, 1e-9) / share.sum())
        cuts = self._cuts(rows)
        state = settle(self._binned(rows, cuts, start), "boosting")
        size = 1 << (self.depth + 1)
        stored: dict[str, list[np.ndarray]] = {"term": [], "cut": [], "value": []}
        pending: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for _ in range(self.trees):
            term, above, value = self._round(state, _scores_sql(pending, classes, self.depth), classes)
            if not (term >= 0).any():
                break
            pending.append((term, above, value))
            cut = np.array([[cuts.get((int(t), int(b)), np.inf) for t, b in zip(*row, strict=True)] for row in zip(term, above, strict=True)])
            for name, nodes in (("term", np.maximum(term, 0)), ("cut", cut), ("value", value)):
                stored[name].append(nodes.reshape(classes, size))
            if len(pending) == ROUNDS_PER_STORE:
                # Later rounds start from stored scores: the plan stays short, a lost executor costs a re-read.
                scores = _scores_sql(pending, classes, self.depth)
                state = settle(state.selectExpr("label", "weight", "terms", "bins", "bin_of", f"{scores} as scores"), "boosting")
                pending = []
        # JSON has no infinity: a cut no value exceeds.
        flat = {n: np.minimum(np.concatenate([np.zeros(0), *(a.ravel() for a in parts)]), 1e300).tolist() for n, parts in stored.items()}
        return BoostedTrees(
            featuresCol=self.featuresCol, predictionCol=self.predictionCol, depth=self.depth, start=start.tolist(), trees=json.dumps(flat)
        )

    def _cuts(self, rows: DataFrame) -> dict[tuple[int, int], float]:
        """{(term, bin): value}: a value lies in a later bin if it exceeds this one. One entry per term and quantile."""
        cells = rows.select(F.explode("cells").alias("c")).select("c.i", "c.v")
        found = cells.groupBy("i").agg(F.percentile_approx("v", list(QUANTILES), 1000).alias("q")).collect()
        cuts = {(r["i"], 0): 0.0 for r in found}
        for r in found:
            cuts |= {(r["i"], b): q for b, q in enumerate(sorted(set(r["q"])), 1)}
        return cuts

    def _binned(self, rows: DataFrame, cuts: dict[tuple[int, int], float], start: np.ndarray) -> DataFrame:
        """label, weight, terms (first ``ALL``), their bins, bin_of (term to bin) and the scores before the first round."""
        width = max((t for t, _ in cuts), default=0) + 1
        table = np.full((width, BINS), np.inf)
        for (t, b), q in cuts.items():
            table[t, b] = q
        flat = _numbers(np.minimum(table, 1e300), "double")

        def number(z: Column) -> Column:
            return sum(((z["v"] > F.get(flat, z["i"] * BINS + b)).cast("int") for b in range(BINS)), F.lit(0))

        binned = rows.select(
            "label",
            "weight",
            F.concat(F.array(F.lit(ALL)), F.transform("cells", lambda z: z["i"])).alias("terms"),
            F.concat(F.array(F.lit(0)), F.transform("cells", number)).alias("bins"),
            _numbers(start, "double").alias("scores"),
        )
        return binned.withColumn("bin_of", F.map_from_arrays("terms", "bins"))

    def _round(self, state: DataFrame, scores: str, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One tree per class: (term, bin, value) of its nodes; term -1 where a node is not split."""
        size = 1 << (self.depth + 1)
        term = np.full((classes, size), ALL)
        above = np.zeros((classes, size), int)
        value = np.zeros((classes, size))
        known: dict[tuple[int, int], float] = {}
        for level in range(self.depth):
            nodes = _node_sql(classes, self.depth, level, term, above)
            for r in self._best_splits(state, scores, nodes).collect():
                k, node = r["k"], r["node"]
                known.setdefault((k, node), self._value(r["g"], r["h"], classes))
                if r["gain"] is None or not r["gain"] > LEAST_GAIN:
                    continue
                term[k, node], above[k, node] = r["term"], r["bin"]
                known[k, 2 * node] = self._value(r["g"] - r["gr"], r["h"] - r["hr"], classes)
                known[k, 2 * node + 1] = self._value(r["gr"], r["hr"], classes)
            if not (term[:, 1 << level : 2 << level] >= 0).any():
                break
        for (k, node), v in known.items():
            # Rows of a node that is not split go left down to a leaf.
            while node < size // 2 and term[k, node] < 0:
                node *= 2
            if node >= size // 2:
                value[k, node] = v
        return term, above, value

    def _value(self, g: float, h: float, classes: int) -> float:
        return -self.rate * (classes - 1) / classes * g / (h + self.l2)

    def _best_splits(self, state: DataFrame, scores: str, nodes: str) -> DataFrame:
        """(k, node, g, h) of every node of a level and its best split: (gain, term, bin, gr, hr), right side's sums.

        Said in SQL, because the plan is built once per level.
        """
        bins = range(BINS + 1)
        sums = ", ".join(f"sum(if(b = {b}, {x}, 0D)) as {x}{b}" for b in bins for x in "gh")
        right = ", ".join(
            "struct(" + ", ".join(f"{' + '.join(f'{x}{c}' for c in bins if c > b)} as {x}r" for x in "gh") + f", {b} as bin)" for b in bins if b < BINS
        )
        # Per (class, node, term) sums are combined on the map side; then a node has as many rows as the vocabulary
        # has terms: a bounded group.
        return state.sparkSession.sql(
            f"""
            with scored as (select label, weight, terms, bins, bin_of, {scores} as scores from {{state}}),
            shared as (select *, transform(scores, s -> exp(s - array_max(scores))) as e from scored),
            pulled as (
                select terms, bins, inline(transform(e, (x, k) -> struct(
                    k, {nodes} as node, x / aggregate(e, 0D, (a, y) -> a + y) as p,
                    weight as w, int(k = label) as hit))) from shared),
            cells as (
                select k, node, w * (p - hit) as g, w * p * (1 - p) as h, inline(arrays_zip(terms, bins)) as (t, b)
                from pulled),
            per_term as (select k, node, t, {sums} from cells group by k, node, t),
            whole as (
                select *, max(if(t = {ALL}, g0, null)) over (partition by k, node) as g,
                    max(if(t = {ALL}, h0, null)) over (partition by k, node) as h from per_term),
            tried as (select k, node, t, g, h, inline(array({right})) from whole),
            best as (
                select k, node, first(g) as g, first(h) as h, max(struct(
                    if(t <> {ALL} and hr >= {LEAST_CURVATURE}D and h - hr >= {LEAST_CURVATURE}D,
                        gr * gr / (hr + {self.l2}D) + (g - gr) * (g - gr) / (h - hr + {self.l2}D) - g * g / (h + {self.l2}D),
                        null) as gain,
                    -t as t, -bin as b, gr, hr)) as s
                from tried group by k, node)
            select k, node, g, h, s.gain, -s.t as term, -s.b as bin, s.gr, s.hr from best
            """,
            state=state,
        )


def _list_sql(values: np.ndarray, kind: str) -> str:
    """A constant array as one literal, however long it is."""
    return f"cast(split('{','.join(map(repr, values.ravel().tolist()))}', ',') as array<{kind}>)"


def _node_sql(classes: int, depth: int, level: int, term: np.ndarray, above: np.ndarray) -> str:
    """The node of class ``k`` that a row reaches after ``level`` steps, from ``bin_of``; children of n are 2n, 2n + 1."""
    if not level:
        return "1"
    at = f"k * {1 << (depth + 1)} + n"
    # No coalesce: Spark does not fold constants inside conditions, and would read the lists anew for every row.
    over = f"try_element_at(bin_of, get({_list_sql(term, 'int')}, {at})) > get({_list_sql(above, 'int')}, {at})"
    return f"aggregate(sequence(1, {level}), 1, (n, l) -> 2 * n + int(({over}) <=> true))"


def _scores_sql(pending: list[tuple[np.ndarray, np.ndarray, np.ndarray]], classes: int, depth: int) -> str:
    """The scores that the trees of ``pending`` rounds lead to from the stored ones."""
    if not pending:
        return "scores"
    size = 1 << (depth + 1)
    steps = [
        f"get({_list_sql(value, 'double')}, k * {size} + {_node_sql(classes, depth, depth, term, above)})"
        for term, above, value in pending
    ]
    return f"transform(scores, (s, k) -> s + {' + '.join(steps)})"
