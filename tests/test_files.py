"""Drop files: reading, bad rows, different headers, exports, tables."""

import pytest
from pyspark.sql import functions as F

from shelfwise.plans.load import load_chain
from shelfwise.profiles import PROFILES
from shelfwise.session import require_local
from shelfwise.sources import files, published, sinks

DIRTY = (
    "Наименование;;Код\n"
    '"Чипсы ""Краб""";x;007\n'
    ";;\n"
    '"два\nслова";;NA\n'
    f"{'д' * 300};;None\n"
    "короткая\n"
)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("multi_line", [None, True])
def test_dirty_file(spark, drop, multi_line):
    df = files.read_chain_csv(spark, drop("magnit_a.csv", DIRTY), multi_line=multi_line)
    assert df.columns == ["Наименование", "Код"]
    expected = [('Чипсы "Краб"', "007"), ("два\nслова", None), ("д" * 300, None), ("короткая", None)]
    assert _rows(df) == sorted(expected, key=str)


def test_surplus_cells(spark, drop):
    path = drop("magnit_a.csv", 'a;b\n1;"x;y"\n2;3;4\n5\n')
    with pytest.raises(Exception, match="malformed row"):
        files.read_chain_csv(spark, path).collect()
    assert _rows(files.read_chain_csv(spark, path, mode="quarantine")) == [("1", "x;y"), ("5", None)]
    good, bad = files.quarantine_bad_rows(files.read_raw(spark, [path])[0])
    assert good.count() == 2
    assert [tuple(r) for r in bad.collect()] == [("magnit_a.csv", "2;3;4")]
    # The verdict does not depend on the columns a query uses.
    assert good.select("a").count() == 2


def test_files_are_found_by_prefix(spark, drop, tmp_path):
    for name in ("magnit_1.csv", "magnit_2.CSV", "Magnit_3.csv", "x5_magnit_4.csv", "magnit_5.txt"):
        drop(name, "a\n1\n")
    (tmp_path / "sub").mkdir()
    drop("sub/magnit_6.CSV", "a\n1\n")
    drop("sub/b.XlsB", "")
    flat = files.discover_files(spark, str(tmp_path), "magnit_")
    assert [r["name"] for r in flat.collect()] == ["magnit_1.csv"]
    assert files.discover_files(spark, str(tmp_path), "okey_").count() == 0
    deep = {r["name"] for r in files.discover_files_recursive(spark, str(tmp_path)).collect()}
    assert deep == {"magnit_1.csv", "magnit_2.CSV", "Magnit_3.csv", "x5_magnit_4.csv", "magnit_6.CSV", "b.XlsB"}


def test_many_files_with_different_headers(spark, drop, tmp_path):
    drop("magnit_Январь 24.csv", "Наименование;Код\nа;1\n")
    drop("magnit_b.csv", 'Код;Товар;Город\n2;"б\nв";Омск\n')
    loaded = files.load_many_files(spark, str(tmp_path), PROFILES["magnit"])
    rows = loaded.select("product_name", "product_code", "city", "table_name")
    assert _rows(rows) == [("а", "1", None, "magnit________24"), ("б\nв", "2", "Омск", "magnit_b")]


def test_labels(spark, drop):
    path = drop("labels.csv", "product_name;brand\nа;Б\nа;Б\nв;\n;Г\n")
    assert _rows(files.read_labels(spark, path, "product_name", "brand")) == [("а", "Б")]
    broken = drop("broken.csv", 'product_name;brand\n"а\nб";Б\nв;NA\n')
    assert _rows(files.read_labels(spark, broken, "product_name", "brand")) == [("а\nб", "Б")]


def test_export_caps_each_sheet(spark, tmp_path):
    df = spark.range(20).select(F.col("id").alias("[id]"), F.concat(F.lit("s "), F.col("id") % 3).alias("sheet"))
    sinks.export_csv(df, str(tmp_path / "out"), max_rows=4, sheet="sheet")
    back = spark.read.options(**files.CSV_OPTIONS).option("header", True).csv(str(tmp_path / "out"))
    assert back.columns == ["id", "sheet"]
    assert {(r["sheet"], r["count"]) for r in back.groupBy("sheet").count().collect()} == {("s_0", 4), ("s_1", 4), ("s_2", 4)}


def test_export_is_capped_to_the_same_rows(spark, tmp_path):
    df = spark.range(30).selectExpr("id as `a.b`", "if(id < 20, null, 'x') as sheet")
    for name, parts in (("one", 2), ("two", 5)):
        sinks.export_csv(df.repartition(parts), str(tmp_path / name), max_rows=6, sheet="sheet")
    one, two = (_rows(spark.read.options(**files.CSV_OPTIONS).option("header", True).csv(str(tmp_path / n))) for n in ("one", "two"))
    assert one == two and len(one) == 12
    sinks.export_csv(df, str(tmp_path / "all"), max_rows=7)
    assert spark.read.options(**files.CSV_OPTIONS).option("header", True).csv(str(tmp_path / "all")).count() == 7


def test_append_keeps_copies_and_repeats_nothing(spark, tmp_path):
    df = spark.createDataFrame([("f", "a"), ("f", "a"), ("g", "b")], "file string, v string")
    sinks.write_replace(df.limit(1), "unit", "appended", str(tmp_path / "t"))
    for _ in range(2):
        sinks.write_append(df, "unit", "appended", file_col="file")
    assert _rows(spark.table("unit.appended")) == _rows(df)
    sinks.write_append(df.limit(1).withColumn("file", F.lit("h")), "unit", "appended", file_col="file")
    assert spark.table("unit.appended").count() == 4


def test_options_of_a_database_writer(spark, monkeypatch):
    """Without a connection: what the writer would be given."""
    given = {}
    kind = type(spark.range(1).write)
    monkeypatch.setattr(kind, "options", lambda self, **options: given.update(options) or self)
    monkeypatch.setattr(kind, "format", lambda self, name: given.update(format=name) or self)
    sinks.jdbc_writer(spark.range(1).selectExpr("id as `a``b`", "id as c"), "jdbc:x://h/db", "s.t", user="u", batchsize="7")
    assert given == {
        "format": "jdbc", "url": "jdbc:x://h/db", "dbtable": "s.t", "batchsize": "7", "truncate": "true", "user": "u",
        "createTableColumnTypes": "`a``b` NVARCHAR(255), `c` NVARCHAR(255)",
    }


def test_sink_text_is_cut(spark):
    df = spark.createDataFrame([("x" * 300, 1, None)], "a string, b int, c string")
    assert tuple(sinks.sink_text(df).first()) == ("x" * 250, "1", None)


def test_reconcile_raises_on_a_difference(spark):
    a = spark.createDataFrame([("t",), ("t",)], "table_name string")
    sinks.require_reconciled(sinks.reconcile_counts(a, a))
    with pytest.raises(ValueError, match="row counts differ"):
        sinks.require_reconciled(sinks.reconcile_counts(a, a.limit(1)))


def test_observed_counts_rows_on_the_way(spark):
    df, seen = sinks.observed(spark.range(7))
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 7


def test_load_chain(spark, drop, tmp_path):
    drop("magnit_a.csv", "Наименование;Адрес\nЧипсы туба 0,15 кг;г.Омск\nСемечки;\n")
    drop("magnit_b.csv", "Товар;Код\nСухарики 50г;7\n")
    sink = str(tmp_path / "sink")
    for _ in range(2):
        summary = load_chain(spark, str(tmp_path), PROFILES["magnit"], {}, sink)
        assert {(r["file"], r["rows"], r["chunks"], r["added_columns"]) for r in summary.collect()} == {
            ("magnit_a", 2, 1, 9), ("magnit_b", 1, 1, 9),
        }
    rows = published.read(spark, sink).select("table_name", "product_name", "weight_extracted_regex", "package_type", "chain")
    assert _rows(rows) == sorted([
        ("magnit_a", "Чипсы туба 0,15 кг", "150", "Туба", "magnit"),
        ("magnit_a", "Семечки", None, "Пакет", "magnit"),
        ("magnit_b", "Сухарики 50г", "50", "Пакет", "magnit"),
    ], key=str)


def test_load_refuses_colliding_tables(spark, drop, tmp_path):
    for name in ("magnit_я.csv", "magnit_ю.csv"):
        drop(name, "Товар\nа\n")
    with pytest.raises(ValueError, match="same table"):
        load_chain(spark, str(tmp_path), PROFILES["magnit"], {}, str(tmp_path / "sink"))


def test_bracketed_name_is_its_own_file(spark, drop):
    paths = [drop("magnit_1.csv", "a;b\n1;2\n"), drop("magnit_[1].csv", "a;b\n3;4\n")]
    got = {r["a"] for raw in files.read_raw(spark, paths) for r in raw.collect()}
    assert got == {"1", "3"}


def test_hard_headers(spark, drop):
    blank = drop("magnit_blank.csv", "\n \na;b\n1;2\n")
    doubled = drop("magnit_doubled.csv", '"a ""x""";b\n3;4\n')
    broken = drop("magnit_broken.csv", '"a\nx";b\n5;6\n')
    read = {path: files.read_chain_csv(spark, path) for path in (blank, doubled, broken)}
    assert [df.columns for df in read.values()] == [["a", "b"], ['a "x"', "b"], ["a\nx", "b"]]
    assert [_rows(df) for df in read.values()] == [[("1", "2")], [("3", "4")], [("5", "6")]]
    with pytest.raises(ValueError, match="empty"):
        files.read_chain_csv(spark, drop("magnit_empty.csv", "", "utf-8"))


def test_headers_of_many_files_are_one_read(spark, drop):
    paths = [drop(f"magnit_{i}.csv", f"a;b{i % 2}\n{i};x\n") for i in range(40)]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    parts = files.read_raw(spark, paths)
    jobs = len(tracker.getJobIdsForGroup("headers"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(tuple(df.columns[:2]) for df in parts) == [("a", "b0"), ("a", "b1")]
    assert jobs <= 4


def test_long_quoted_cell_in_a_short_row(spark, drop):
    path = drop("magnit_long.csv", 'a;b;c\n"' + "x;" * 50_000 + '"\n1;2;3;4\n')
    assert [r["row"] for r in files.bad_rows(spark, [path]).collect()] == ["1;2;3;4"]


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"])
def test_no_temporary_folder_on_a_cluster(master):
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        require_local(master)
    require_local("local[4]")


def test_a_load_names_tables_once_per_file(spark, drop, tmp_path, monkeypatch):
    """Table names reach the rows by a look-up: rewriting the file name for every row took longer than parsing it."""
    written = []
    write = published.write_version
    monkeypatch.setattr(published, "write_version", lambda rows, *where: (written.append(rows), write(rows, *where)))
    drop("magnit_a b.csv", "Артикул;Город\n1;Омск\n2;Пермь\n")
    drop("magnit_c+d.csv", "Артикул;Город\n3;Омск\n4;5;6\n")
    summary = load_chain(spark, str(tmp_path), PROFILES["magnit"], {}, str(tmp_path / "sink"), "quarantine", register=False)
    assert sorted((r["file"], r["rows"], r["bad_rows"]) for r in summary.collect()) == [("magnit_a_b", 2, 0), ("magnit_c_d", 1, 1)]
    assert len(written) == 2
    assert all("regexp_replace" not in rows._jdf.queryExecution().optimizedPlan().toString() for rows in written)
