from __future__ import annotations

import datetime as dt
from types import SimpleNamespace

import pytest

from footfall.operators import cleaning, quality
from footfall.params import RANGE_END, RANGE_START
from footfall.sources import (
    RAW_SCHEMA,
    fresh_folder,
    load_clean,
    read_log,
    save,
    write_clean,
)
from tests.micro import rows_of


@pytest.fixture()
def raw_file(tmp_path):
    lines = [
        f"1,10,100,pv,{RANGE_START}",
        f"1,10,100,buy,{RANGE_END}",
        f"1,10,100,pv,{RANGE_START - 1}",
        f"1,10,100,pv,{RANGE_END + 1}",
        f"2,11,100,cart,{RANGE_START + 86400}",
        f"2,11,100,cart,{RANGE_START + 86400}",
        f"x,11,100,fav,{RANGE_START + 5}",
        "3,12,100,pv,soon",
        f"3,12,100,wish,{RANGE_START + 9}",
    ]
    (tmp_path / "raw.csv").write_text("\n".join(lines) + "\n")
    return str(tmp_path / "raw.csv")


def test_malformed_fields_become_null(spark, raw_file):
    raw = read_log(spark, raw_file)
    assert raw.schema == RAW_SCHEMA
    assert raw.count() == 9
    assert raw.where("user_id IS NULL").count() == 1
    assert raw.where("timestamp IS NULL").count() == 1


def test_range_is_closed_and_drops_null_times(spark, raw_file):
    kept = cleaning.clip_time(read_log(spark, raw_file))
    assert kept.count() == 6
    assert {r.timestamp for r in kept.collect()} >= {RANGE_START, RANGE_END}


def test_dedup_keeps_one_copy(spark, raw_file):
    assert cleaning.dedup(cleaning.clip_time(read_log(spark, raw_file))).count() == 5


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Shanghai"])
def test_time_fields_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        raw = spark.createDataFrame(
            [(1, 1, 1, "pv", RANGE_START), (1, 1, 1, "pv", RANGE_END)], RAW_SCHEMA
        )
        fields = cleaning.derive_time(raw).select("datetime", "hour", "date")
        assert rows_of(fields) == [
            ("2017-11-25 00:00:00", 0, dt.date(2017, 11, 25)),
            ("2017-12-03 23:59:59", 23, dt.date(2017, 12, 3)),
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_clean_log_round_trip(spark, raw_file, tmp_path):
    path = str(tmp_path / "clean")
    cleaned = cleaning.clean(read_log(spark, raw_file))
    for _ in range(2):  # a second write replaces the first
        write_clean(cleaned, path)
    back = load_clean(spark, path)
    assert back.count() == 5
    assert back.schema["date"].dataType.typeName() == "date"
    assert sorted(map(str, rows_of(back.select(*cleaned.columns)))) == sorted(
        map(str, rows_of(cleaned))
    )


def test_date_is_derived_when_the_log_has_none(spark, raw_file, tmp_path):
    path = str(tmp_path / "flat")
    cleaning.clean(read_log(spark, raw_file)).drop("date").write.parquet(path)
    assert {r.date for r in load_clean(spark, path, cache=True).collect()} == {
        dt.date(2017, 11, 25),
        dt.date(2017, 11, 26),
        dt.date(2017, 12, 3),
    }


def test_save_overwrites(spark, tmp_path):
    path = str(tmp_path / "result")
    save(spark.range(5), path)
    save(spark.range(3), path)
    assert spark.read.json(path).count() == 3
    with pytest.raises(Exception):
        save(spark.range(1).selectExpr("raise_error('no') AS x"), path)
    assert spark.read.json(path).count() == 3  # a failed write leaves the old table


def _session_with(**settings):
    named = {key.replace("_", "."): value for key, value in settings.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=named.get))


def test_work_folder_follows_the_session_setting():
    cluster = _session_with(spark_checkpoint_dir="/shared/work/", spark_master="spark://host:7077")
    assert fresh_folder(cluster, "x").startswith("/shared/work/footfall/x-")
    assert fresh_folder(cluster, "x") != fresh_folder(cluster, "x")
    with pytest.raises(ValueError):
        fresh_folder(_session_with(spark_master="yarn"), "x")
    assert "/footfall/x-" in fresh_folder(_session_with(spark_master="local[2]"), "x")


def test_quality(spark, raw_file):
    raw = read_log(spark, raw_file)
    assert rows_of(quality.range_report(raw)) == [(9, 2)]
    assert rows_of(quality.duplicate_report(raw)) == [(9, 8, 1)]
    assert dict(rows_of(quality.null_counts(raw))) == {
        "user_id": 1,
        "item_id": 0,
        "category_id": 0,
        "behavior": 0,
        "timestamp": 1,
    }
    domain = {r.behavior: (r.n, r.is_valid) for r in quality.behavior_domain(raw).collect()}
    assert domain["wish"] == (1, False)
    assert domain["pv"] == (4, True)


def test_nan_counts_as_missing_and_null_behavior_is_invalid(spark):
    frame = spark.createDataFrame(
        [(1.0, "pv"), (float("nan"), None), (None, "pv")], "v double, behavior string"
    )
    assert dict(rows_of(quality.null_counts(frame))) == {"v": 2, "behavior": 1}
    assert (None, 1, False) in rows_of(quality.behavior_domain(frame))


def test_heavy_days_are_written_by_many_tasks_and_quiet_ones_by_few(spark, tmp_path):
    path = str(tmp_path / "clean")
    raw = spark.range(0, 300000, 1, 8).selectExpr(
        "CAST(id AS INT) AS user_id",
        "CAST(id * 7919 % 100003 AS INT) AS item_id",
        "1 AS category_id",
        "'pv' AS behavior",
        f"CAST({RANGE_START} + IF(id % 1000 = 0, 86400, id % 86400) AS INT) AS timestamp",
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, str(512 * 1024))
    try:
        write_clean(cleaning.clean(raw), path)
    finally:
        spark.conf.unset(size)
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "clean").glob("date=*")}
    assert files["date=2017-11-25"] > 1  # by size, not one task per date
    assert files["date=2017-11-26"] == 1
    assert load_clean(spark, path).count() == 300000
