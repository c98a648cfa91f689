"""Incremental loading: each file once, under any header, archived later; a repeated batch loads nothing."""

import pytest

from shelfwise.profiles import PROFILES
from shelfwise.sources import published
from shelfwise.streaming import ingest

MAGNIT = PROFILES["magnit"]


@pytest.fixture
def places(tmp_path):
    (tmp_path / "in").mkdir()
    return {name: str(tmp_path / name) for name in ("in", "sink", "state", "archive")}


def _run(spark, places, **more):
    query = ingest.stream_new_files(
        spark, places["in"], MAGNIT, {}, places["sink"], places["state"], places["archive"], register=False, **more
    )
    query.awaitTermination()
    return published.read(spark, places["sink"])


def test_each_file_is_loaded_once(spark, drop, tmp_path, places):
    drop("in/magnit_1.csv", 'Наименование;Код\n"чипсы\nтуба 50г";1\n\n;\nлишняя;2;3\n')
    drop("in/x5_1.csv", "Наименование;Код\nчужая;9\n")
    assert _run(spark, places).count() == 1
    drop("in/magnit_2.csv", "Адрес;Товар;Цена\nг.Омск;в 1кг;NA\n")
    assert _run(spark, places).count() == 2
    assert _run(spark, places).count() == 2
    drop("in/magnit_3.csv", "Наименование;Код\nг;3\n")
    rows = _run(spark, places)
    columns = ("table_name", "product_name", "product_code", "address", "Цена", "weight_extracted_regex", "package_type")
    assert sorted(map(tuple, rows.select(*columns).collect())) == [
        ("magnit_1", "чипсы\nтуба 50г", "1", None, None, "50", "Туба"),
        ("magnit_2", "в 1кг", None, "г.Омск", None, "1000", "Пакет"),
        ("magnit_3", "г", "3", None, None, None, "Пакет"),
    ]
    assert [(r["file"], r["row"]) for r in published.quarantined(spark, places["sink"]).collect()] == [("magnit_1.csv", "лишняя;2;3")]
    archived = {p.name for p in (tmp_path / "archive").rglob("*.csv")}
    assert {"magnit_1.csv", "magnit_2.csv"} <= archived
    assert "x5_1.csv" not in archived


def test_files_of_one_run_with_unlike_headers(spark, drop, places):
    for i in range(6):
        drop(f"in/magnit_{i}.csv", ("Товар;Код\nа;1\n", "Город;Товар\nОмск;б\nПермь;в\n")[i % 2])
    rows = _run(spark, places, files_per_batch=4)
    assert {(r["table_name"], r["count"]) for r in rows.groupBy("table_name").count().collect()} == {
        (f"magnit_{i}", 1 + i % 2) for i in range(6)
    }
    assert published.log(spark, places["sink"]).select("load").distinct().count() == 2


def test_a_batch_run_again_loads_nothing(spark, drop, places):
    path = drop("in/magnit_1.csv", "Товар\nа\nб\n")
    write = ingest.batch_loader(MAGNIT, {}, places["sink"], "stream", register=False)
    batch = spark.createDataFrame([(path,)], "path string")
    for _ in range(2):
        write(batch, 0)
    assert published.read(spark, places["sink"]).count() == 2
    assert published.log(spark, places["sink"]).count() == 1


def test_a_batch_that_failed_is_done_by_the_next_run(spark, drop, places, monkeypatch):
    drop("in/magnit_1.csv", "Товар\nа\n")

    def fail(*args):
        raise OSError("disk full")

    with monkeypatch.context() as patched:
        patched.setattr(published, "publish", fail)
        with pytest.raises(Exception, match="disk full"):
            _run(spark, places)
    assert published.read(spark, places["sink"]).count() == 0
    assert _run(spark, places).count() == 1
