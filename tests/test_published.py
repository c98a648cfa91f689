"""Publishing: whole or not at all, a ledger of malformed rows, unlike headers, catalog tables, file sizes."""

import pytest
from pyspark.sql import functions as F

from shelfwise.plans import load as loading
from shelfwise.plans.load import load_chain
from shelfwise.profiles import PROFILES
from shelfwise.sources import files, published, sinks

MAGNIT, DIKSI = PROFILES["magnit"], PROFILES["diksi"]


@pytest.fixture
def sink(tmp_path):
    return str(tmp_path / "sink")


def _load(spark, folder, sink, mode="quarantine", profile=MAGNIT, register=False):
    return load_chain(spark, str(folder), profile, {}, sink, mode, register=register)


def _names(df):
    return sorted(r["product_name"] for r in df.collect())


@pytest.fixture
def day(tmp_path, drop):
    """Drop files of a day into a folder of their own."""

    def write(name, **contents):
        (tmp_path / name).mkdir(exist_ok=True)
        for file, content in contents.items():
            drop(f"{name}/{file}.csv", content)
        return tmp_path / name

    return write


def test_quarantined_rows_stay_until_their_file_is_loaded_again(spark, day, sink):
    first = day("first", magnit_1="Товар;Код\nа;1\nб;2;3\n")
    _load(spark, first, sink)
    _load(spark, day("second", magnit_2="Товар;Код\nв;1\n"), sink)
    bad = published.quarantined(spark, sink)
    assert [(r["file"], r["row"], r["table_name"]) for r in bad.collect()] == [("magnit_1.csv", "б;2;3", "magnit_1")]
    assert _names(published.read(spark, sink)) == ["а", "в"]
    _load(spark, day("first", magnit_1="Товар;Код\nа;1\nб;2\n"), sink)
    assert published.quarantined(spark, sink).count() == 0
    assert [r["row"] for r in published.quarantined(spark, sink, history=True).collect()] == ["б;2;3"]
    assert _names(published.read(spark, sink)) == ["а", "б", "в"]


def test_unlike_headers_keep_their_columns(spark, day, sink):
    folder = day("day", magnit_1="Товар;Город\nа;Омск\n", magnit_2="Товар;Цена;load;CHAIN\nб;5;x;y\n")
    _load(spark, folder, sink)
    rows = {r["product_name"]: r for r in published.read(spark, sink).collect()}
    assert (rows["а"]["city"], rows["а"]["Цена"], rows["б"]["Цена"], rows["б"]["load_1"], rows["б"]["CHAIN_1"]) == ("Омск", None, "5", "x", "y")
    own = published.read_table(spark, sink, "magnit", "magnit_1").columns
    assert own[:2] == ["product_name", "city"] and "Цена" not in own and len(own) == 11


def test_an_empty_day_and_empty_files(spark, day, sink):
    empty = day("empty")
    assert _load(spark, empty, sink).count() == 0
    assert published.read(spark, sink).count() == 0
    assert files.bad_rows(spark, []).count() == 0
    folder = day("day", magnit_1="Товар\nа\n", magnit_2="Товар\nб\n")
    _load(spark, folder, sink)
    # A file that lost its rows replaces its table by none; one that lost its header, too, is left alone.
    day("day", magnit_1="Товар\n\n")
    (folder / "magnit_2.csv").write_text("", encoding="utf-8")
    summary = {r["file"]: (r["rows"], r["chunks"]) for r in _load(spark, folder, sink).collect()}
    assert summary == {"magnit_1": (0, 0)}
    assert _names(published.read(spark, sink)) == ["б"]
    assert published.read_table(spark, sink, "magnit", "magnit_1").count() == 0


def test_a_load_that_fails_leaves_everything(spark, day, sink, monkeypatch):
    folder = day("day", magnit_1="Товар\nа\n", magnit_2="Товар\nб\n")
    _load(spark, folder, sink)
    day("day", magnit_1="Товар\nновая\n", magnit_2="Товар\nв\nг;1\n")
    with pytest.raises(Exception, match="malformed row"):
        _load(spark, folder, sink, "strict")
    assert _names(published.read(spark, sink)) == ["а", "б"]

    def lose(rows, *args):
        # One file's rows go missing, another's are doubled: the total is right.
        other = rows.filter("table_name = 'magnit_1'")
        written(other.unionByName(other), *args)

    written = published.write_version
    with monkeypatch.context() as patched:
        patched.setattr(loading.published, "write_version", lambda rows, s, i, part="data": (lose if part == "data" else written)(rows, s, i, part))
        with pytest.raises(ValueError, match="magnit_2"):
            _load(spark, folder, sink)
    assert _names(published.read(spark, sink)) == ["а", "б"]
    _load(spark, folder, sink)
    assert _names(published.read(spark, sink)) == ["в", "новая"]
    assert published.log(spark, sink).select("version").distinct().count() == 2


def test_chains_share_a_sink(spark, day, sink):
    folder = day("day", magnit_1="Товар\nа\n", diksi_1="Товар\nб\n")
    for profile in (MAGNIT, DIKSI):
        _load(spark, folder, sink, profile=profile)
    assert _names(published.read(spark, sink)) == ["а", "б"]
    assert _names(published.read(spark, sink, "diksi")) == ["б"]


def test_catalog_tables_follow_the_files(spark, day, sink):
    folder = day("day", magnit_cat="Товар;Код\nа;1\n", magnit_other="Товар\nв\n", magnit_none="Товар\n")
    _load(spark, folder, sink, register=True)
    assert _names(spark.table("magnit.magnit_cat")) == ["а"]
    assert spark.table("magnit.magnit_none").count() == 0
    session = spark.newSession()
    day("day", magnit_cat="Товар;Код\nб;1\nв;2\n")
    _load(spark, folder, sink, register=True)
    assert _names(session.table("magnit.magnit_cat")) == ["б", "в"]
    day("day", magnit_cat="Товар;Цена\nг;1\n")
    _load(spark, folder, sink, register=True)
    assert spark.table("magnit.magnit_cat").columns[:2] == ["product_name", "Цена"]
    assert published.register_tables(spark, sink, "magnit") == ["magnit_cat", "magnit_none", "magnit_other"]


def test_replace_keeps_the_old_table_on_failure(spark, tmp_path):
    place = str(tmp_path / "t")
    sinks.write_replace(spark.range(5), "unit", "kept", place)
    broken = spark.range(9).withColumn("id", F.when(F.col("id") == 8, F.raise_error(F.lit("broken row"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="broken row"):
        sinks.write_replace(broken, "unit", "kept", place)
    assert spark.table("unit.kept").count() == 5
    sinks.write_replace(spark.range(3), "unit", "kept", place)
    assert spark.table("unit.kept").count() == 3
    sinks.write_replace(spark.range(2).withColumn("more", F.lit("x")), "unit", "kept", place)
    assert spark.table("unit.kept").columns == ["id", "more"]
    sinks.write_append(spark.range(4).withColumn("more", F.lit("y")), "unit", "kept", "more")
    assert spark.table("unit.kept").count() == 6
    # A table can be replaced by rows read from itself.
    sinks.write_replace(spark.table("unit.kept").filter("more = 'y'"), "unit", "kept", place)
    assert spark.table("unit.kept").count() == 4


def test_tables_get_as_many_files_as_they_need(spark, sink, tmp_path):
    """After a shuffled join every task holds rows of every table: still one file per small table, several per large one."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 > 0, F.lit("large")).otherwise(F.concat(F.lit("t"), F.col("id") % 20)).alias("table_name"),
        F.lit("c").alias("chain"),
        F.sha2(F.col("id").cast("string"), 512).alias("text"),
        (F.col("id") % 1000).alias("k"),
    )
    joined = rows.join(spark.range(1000).withColumnRenamed("id", "k").hint("shuffle_merge"), "k")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        published.write_version(joined, sink, "one")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    counts = {p.name.removeprefix("table_name="): len(list(p.glob("*.parquet"))) for p in (tmp_path / "sink").rglob("table_name=*")}
    assert len(counts) == 21
    large = counts.pop("large")
    assert 2 <= large <= 12
    # Those that share a shuffle partition with the large table may be cut where it is cut.
    assert sorted(counts.values())[len(counts) // 2] == 1 and max(counts.values()) <= large
    stored = {r["table_name"]: r["rows"] for r in published.version_counts(spark, sink, "one").collect()}
    assert stored["large"] == 40_000 and sum(stored.values()) == 60_000


def test_rows_that_lie_as_parsed_are_not_dealt_out_again(spark, day, sink, tmp_path, monkeypatch):
    """The shuffle of all rows took more disk than what it sorted; a table's rows are together unless something shuffled them."""
    frame = type(spark.range(0))
    seen, hint = [], frame.hint
    monkeypatch.setattr(frame, "hint", lambda rows, name, *on: seen.append(name) or hint(rows, name, *on))
    folder = day("day", **{f"magnit_{i}": f"Товар\nа{i}\nб{i}\n" for i in range(6)})
    _load(spark, folder, sink)
    assert "rebalance" not in seen
    files = [p.parent.name for p in (tmp_path / "sink").rglob("table_name=*/*.parquet")]
    assert len(files) == len(set(files)) == 6
    assert _names(published.read(spark, sink)) == sorted(f"{x}{i}" for x in "аб" for i in range(6))
    rows = spark.range(20).selectExpr("'c' as chain", "concat('t', id % 3) as table_name", "id as k")
    assert not published.is_shuffled(rows.join(spark.range(9).withColumnRenamed("id", "k").hint("broadcast"), "k", "left"))
    for shuffled in (rows.join(spark.range(9).withColumnRenamed("id", "k").hint("shuffle_merge"), "k", "left"), rows.repartition(3)):
        assert published.is_shuffled(shuffled)
        published.write_version(shuffled, sink, "two")
        assert seen.pop() == "rebalance"


def test_compressed_drop_files_are_found_by_their_suffix(spark, day, sink):
    import gzip
    from dataclasses import replace
    from pathlib import Path

    folder = day("day", magnit_1="Товар\nа\n\"б\nв\"\n")
    with gzip.open(f"{folder}/magnit_2.csv.gz", "wt", encoding="utf-8-sig") as file:
        file.write('Товар\nг\n"д\nе"\n')
    _load(spark, folder, sink)
    assert _names(published.read(spark, sink)) == ["а", "б\nв"]
    packed = replace(MAGNIT, file_suffix=".csv.gz")
    assert Path(f"{folder}/magnit_2.csv.gz").match(packed.file_glob)
    _load(spark, folder, sink, profile=packed)
    assert _names(published.read(spark, sink)) == ["а", "б\nв", "г", "д\nе"]


def test_files_to_facts_keeps_no_plain_text_on_disk(spark, tmp_path, monkeypatch):
    """Drop files as plain text were half of its disk."""
    from shelfwise.plans import summaries

    monkeypatch.setattr(summaries, "scratch_path", lambda spark, name: str(tmp_path / name))
    summaries.files_to_facts(spark, "/root/testdata/sf0.001")
    assert {p.name.split(".", 1)[1] for p in (tmp_path / "drop").glob("part-*")} == {"csv.gz"}


def test_the_latest_publication_counts(spark, sink):
    columns = "chain string, table_name string, file string, columns array<string>, added_columns bigint, rows bigint, bad_rows bigint"
    for load, names in (("z", ["a", "b"]), ("y", ["b"]), ("z", ["a"])):
        rows = spark.createDataFrame([("c", t, f"{load}{t}") for t in names], "chain string, table_name string, v string")
        if published.log(spark, sink).filter(F.col("load") == load).isEmpty():
            published.write_version(rows, sink, load)
        entries = [("c", t, f"{t}.csv", ["v"], 0, 1, 0) for t in names]
        published.publish(spark.createDataFrame(entries, columns), sink, load)
    assert sorted(r["v"] for r in published.read(spark, sink).collect()) == ["yb", "za"]
    assert sorted(r["version"] for r in published.log(spark, sink).collect()) == [1, 1, 2]
