"""Joins, samples and splits agree with brute force when one key owns a third of the rows."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from shelfwise.operators import joins, sampling, stats

random.seed(7)
KEYS = ["hot"] * 400 + [None] * 100 + [f"k{random.randrange(60)}" for _ in range(700)]


@pytest.fixture(scope="module")
def big(spark):
    return spark.createDataFrame([(i, k) for i, k in enumerate(KEYS)], "id int, key string").repartition(7)


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame([("hot", 1), *[(f"k{i}", i) for i in range(0, 60, 2)]], "key string, value int")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("max_bytes", [0, 1 << 20], ids=["shuffled", "broadcast"])
def test_lookup_join(big, small, how, max_bytes):
    expected = sorted(map(str, big.join(small, ["key"], how).collect()))
    got = joins.lookup_join(big, small, ["key"], how, max_bytes=max_bytes)
    assert sorted(map(str, got.collect())) == expected


def test_hot_keys_are_few(big):
    hot = {r["key"] for r in joins.hot_keys(big, ["key"], share=0.05).collect()}
    assert hot == {"hot", None}


def _digest(seed, *key):
    return hashlib.md5("\x1f".join([str(seed), *map(str, key)]).encode()).hexdigest()


@pytest.mark.parametrize("share", [0.0, 0.2, 0.5, 1.0])
def test_stratified_split(spark, share):
    rows = [(i, f"l{0 if i % 3 else i % 11}") for i in range(900)]
    df = spark.createDataFrame(rows, "id int, label string")
    got = {r["id"] for r in sampling.stratified_split(df, "label", ["id"], share).filter("is_test").collect()}
    expected = set()
    for label in {b for _, b in rows}:
        ids = sorted((i for i, b in rows if b == label), key=lambda i: _digest(42, i))
        expected |= set(ids[: int(share * len(ids) + 0.5)])
    assert got == expected


def test_split_keeps_all_rows(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, "a"), (3, "a")], "id int, label string")
    assert sampling.stratified_split(df, "label", ["id"], 0.5).count() == 4


@pytest.mark.parametrize("n", [0, 1, 137, 500, 2000])
def test_sample_rows(spark, n):
    df = spark.range(500)
    got = {r["id"] for r in sampling.sample_rows(df, n, ["id"], seed=3).collect()}
    assert got == set(sorted(range(500), key=lambda i: _digest(3, i))[:n])


def test_sample_of_copies(spark):
    df = spark.createDataFrame([("x",)] * 300 + [(str(i),) for i in range(100)], "t string")
    assert sampling.sample_rows(df, 250, ["t"]).count() == 250


def test_article_or_barcode(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (9, "b"), (9, "z"), (None, None)], "product_article int, barcode string")
    right = spark.createDataFrame([(1, "q", "one"), (2, "b", "two")], "product_article int, barcode string, name string")
    got = joins.join_article_or_barcode(left, right).select("product_article", "name", "matched_by").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "one", "article"), (None, "two", "barcode"), (9, "two", "barcode")], key=str)


def test_several_products_for_one_key_are_refused(spark):
    left = spark.createDataFrame([(1, "a")], "product_article int, barcode string")
    right = spark.createDataFrame([(1, "q", "one"), (2, "q", "two")], "product_article int, barcode string, name string")
    with pytest.raises(ValueError, match="several rows for one barcode"):
        joins.join_article_or_barcode(left, right)


def test_a_look_up_with_repeated_keys_is_refused(big, spark):
    twice = spark.createDataFrame([("hot", 1), ("hot", 2)], "key string, value int")
    with pytest.raises(ValueError, match="several rows for one value of key"):
        joins.hot_split_join(big, twice, ["key"], share=0.2)


def test_all_pairs_of_a_hot_key(spark):
    """Two keys, one null, hold most rows of both sides; copies included."""
    left = spark.createDataFrame([(("hot" if i % 3 else "warm" if i % 2 else f"k{i}"), i // 4) for i in range(900)] + [(None, 1)], "key string, a int")
    right = spark.createDataFrame([(("hot" if i % 2 else "warm" if i % 3 else f"k{i}"), i // 5) for i in range(700)] + [(None, 2)], "key string, b int")
    want = Counter(map(tuple, left.join(right, "key").collect()))
    for cell in (50, 7, 10**6):
        joined = joins.join_by_key(left.repartition(3), right.repartition(2), "key", cell=cell)
        assert joined.columns == ["key", "a", "b"]
        assert Counter(map(tuple, joined.collect())) == want
    with pytest.raises(ValueError, match=rf"{sum(want.values())} rows, more than 1000"):
        joins.join_by_key(left, right, "key", most_rows=1000)


def test_a_hot_key_spreads_over_tasks(spark):
    left = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as key", "1 as a")
    right = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', cast(-id as string)) as key", "2 as b")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = joins.join_by_key(left, right, "key", cell=100)
        per_task = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(per_task) == 1000 * 1000
    assert max(per_task) < 250_000


def test_nested_values_are_measured(spark):
    flat = spark.range(100).select(F.col("id"))
    wide = spark.range(100).select(F.array_repeat(F.lit("x" * 50), 40).alias("a"))
    assert joins.data_bytes(flat) == 1600
    assert joins.data_bytes(wide) > 100 * 40 * 50
    vectors = spark.createDataFrame([(Vectors.dense([0.123456789] * 300),)] * 5, ["v"])
    assert joins.data_bytes(vectors) > 5 * 300 * 8


@pytest.mark.parametrize("quota", [0, 1, 250, 399, 400, 401, 650, 900])
def test_copies_of_the_last_key_are_cut_by_number(spark, quota):
    """One key holds most rows of a group: exactly the quota is taken, whole keys in the order of their hashes."""
    rows = [("a", "hot", i) for i in range(400)] + [("a", f"k{i % 90}", i) for i in range(300)] + [("b", f"k{i}", i) for i in range(40)]
    df = spark.createDataFrame(rows, "g string, k string, v int").repartition(6)
    out = sampling.mark_smallest_hashes(df, ["g"], ["k"], F.lit(quota), 5, "taken")
    assert out.columns == ["g", "k", "v", "taken"] and out.count() == len(rows)
    taken = [r for r in out.collect() if r["taken"]]
    for group, total in (("a", 700), ("b", 40)):
        chosen = Counter(r["k"] for r in taken if r["g"] == group)
        assert sum(chosen.values()) == min(quota, total)
        sizes = Counter(k for g, k, _ in rows if g == group)
        rest = quota
        for k in sorted(sizes, key=lambda k: _digest(5, k)):
            assert chosen[k] == max(0, min(rest, sizes[k]))
            rest -= sizes[k]
    assert len({(r["g"], r["k"], r["v"]) for r in taken}) == len(taken)


def test_sample_of_one_key(spark):
    df = spark.range(1000).selectExpr("'x' as t", "id").repartition(5)
    assert sampling.sample_rows(df, 333, ["t"]).select("id").distinct().count() == 333
    assert sampling.sample_rows(df.limit(0), 3, ["t"]).count() == 0


def test_stored_sketches_answer_for_any_period(spark):
    """Each article is sold in two months: counts per month cannot be added up, sketches can be united."""
    months = "explode(array(id % 4, (id + 1) % 4)) as month"
    rows = spark.range(20_000).selectExpr("id % 2 as chain", months, "id as article", "cast(null as string) as none")
    stored = stats.distinct_sketches(rows, ["chain", "month"], ["article", "none"])
    assert stored.count() == 8
    for by in (["chain"], ["month"], ["chain", "month"], []):
        exact = {tuple(r[c] for c in by): r["n"] for r in rows.groupBy(*by).agg(F.countDistinct("article").alias("n")).collect()}
        got = stats.united_counts(stored, by, ["article", "none"]).collect()
        assert len(got) == len(exact)
        for r in got:
            assert r["article"] == pytest.approx(exact[tuple(r[c] for c in by)], rel=0.05)
            assert r["none"] == 0


def test_pair_sums_equal_the_pairs_without_making_them(spark):
    """A key of a million pairs, keys of one side, a null key and null values."""
    left = spark.createDataFrame([("hot", i % 7 + 0.0) for i in range(1000)] + [("a", 2.0), ("a", None), (None, 1.0), ("l", 1.0)], "key string, a double")
    right = spark.createDataFrame([("hot", i % 5 + 0.0) for i in range(1000)] + [("a", 3.0), ("a", 4.0), (None, 1.0), ("r", 1.0)], "key string, b double")
    product = (F.col("a") * F.col("b")).alias("p")
    pairs = joins.join_by_key(left, right, "key").select("key", "a", "b", product)
    want = pairs.groupBy("key").agg(F.count("*"), F.sum("a"), F.sum("b"), F.sum("p")).collect()
    # More pairs than these rows are refused where pairs are made.
    got = joins.pair_sums(left, right, "key", "a", "b", most_rows=2)
    assert got.columns == ["key", "pairs", "a", "b", "product"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want))
    none = joins.pair_sums(left.filter("key = 'l'"), right, "key", "a", "b")
    assert none.count() == 0
