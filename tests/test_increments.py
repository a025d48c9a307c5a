"""Results that a log is added to part by part."""

from __future__ import annotations

import random

import pytest

from footfall import increments, jobs
from footfall.__main__ import options
from footfall.operators import cleaning, cohorts, lookups, quality, ranges, sessions
from footfall.params import RANGE_END, RANGE_START
from footfall.sources import load_clean, read_log
from tests.micro import DAY, T0, make_log, rows_of, visits

US = 1_000_000


def _same(left, right):
    assert sorted(map(str, rows_of(left))) == sorted(map(str, rows_of(right)))


@pytest.mark.parametrize("gap", [30, 360, 2000])
def test_sessions_day_by_day_equal_the_whole_log(spark, tmp_path, gap):
    rnd = random.Random(2)
    rows = [
        (u, rnd.choice(["pv", "buy", "odd", None]), rnd.randint(0, 4 * DAY))
        for u in (1, 2, 3, None)
        for _ in range(60)
    ]
    # one session over two borders, and rows just inside and outside the gap of a border
    rows += [(9, "pv", s) for s in range(DAY - 100, 3 * DAY + 100, 1500)]
    rows += [(8, "pv", DAY - 1), (8, "buy", DAY - 1 + gap * 60), (7, "pv", DAY - 2)]
    rows += [(7, "pv", DAY - 2 + gap * 60 + 1)]
    log, store = visits(spark, *rows), str(tmp_path / "sessions")
    for day in range(6):
        start, until = (T0 + day * DAY) * US, (T0 + (day + 1) * DAY) * US
        part = log.where(f"ts_us >= {start} AND ts_us < {until}")
        increments.add_to_sessions(part, store, until, gap)
        if day == 2:  # a step that is repeated replaces itself
            increments.add_to_sessions(part, store, until, gap)
    found = increments.stored_sessions(spark, store)
    _same(sessions.rollup_of_spans(found), sessions.session_rollup(log, gap))
    with pytest.raises(ValueError):
        increments.add_to_sessions(log, store, (T0 + 9 * DAY) * US, gap)


def test_bitmaps_hold_the_days_of_each_user(spark):
    rows = [(u, "pv", d * DAY) for u, d in [(1, 0), (1, 63), (1, 64), (1, 200), (2, 5), (2, 5)]]
    log = visits(spark, *rows, (None, "pv", 3))
    bitmaps = cohorts.activity_bitmaps(log)
    _same(cohorts.user_days_of(bitmaps), cohorts.user_days(log))
    assert {r.user_id: sum(bin(w % 2**64).count("1") for w in r.words) for r in bitmaps.collect()} == {1: 4, 2: 1}


def test_bitmaps_merge_in_any_order(spark):
    rnd = random.Random(8)
    rows = [(rnd.randint(1, 9), "pv", rnd.randint(-90, 300) * DAY) for _ in range(150)]
    log = visits(spark, *rows)
    parts = [visits(spark, *rows[i::3]) for i in range(3)]
    first, second, third = map(cohorts.activity_bitmaps, parts)
    for merged in (
        cohorts.merge_bitmaps(cohorts.merge_bitmaps(first, second), third),
        cohorts.merge_bitmaps(third, cohorts.merge_bitmaps(second, cohorts.merge_bitmaps(first, second))),
    ):
        _same(cohorts.user_days_of(merged), cohorts.user_days(log))
        _same(cohorts.retention_of(merged), cohorts.retention(log))
        _same(cohorts.lifecycle_of(merged), cohorts.lifecycle(log))
        _same(cohorts.active_days_of(merged), cohorts.active_days(log))


def test_ranges_equal_the_log_of_those_days(spark, tmp_path):
    rnd = random.Random(4)
    users = [None, 0, 1, 32768, 32769, 10**12]
    rows = [
        (rnd.choice(users), rnd.randint(1, 3), rnd.choice([1, 2, None]),
         rnd.choice(["pv", "cart", "fav", "buy", "odd"]), rnd.randint(0, 4) * DAY)
        for _ in range(200)
    ]
    log = make_log(spark, [*rows, (5, 1, 3, "odd", 0), (None, 1, 4, "pv", 0)])
    for first, last in [("2017-11-25", "2017-11-27"), ("2017-11-26", "2017-11-26"), (None, None)]:
        part = lookups.in_dates(log, first, last)
        for keys in [(), ("category_id",)]:
            path = str(tmp_path / f"ranges-{len(keys)}")
            if first == "2017-11-25":
                increments.save_ranges(log, path, *keys)
            stored = [lookups.in_dates(f, first, last) for f in increments.load_ranges(spark, path)]
            if keys:
                from footfall.functions import activity

                _same(ranges.activity_of(*stored, *keys), activity(part, *keys))
            else:
                _same(ranges.overview_of(*stored), lookups.overview(part))


def test_a_day_of_the_ranges_is_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "ranges")
    increments.save_ranges(visits(spark, (1, "pv", 0), (2, "pv", DAY)), path)
    increments.save_ranges(visits(spark, *((u, "buy", DAY) for u in (3, 4))), path, only_days=True)
    found = ranges.overview_of(*increments.load_ranges(spark, path)).first()
    assert tuple(found) == (3, 3, 1, 2, 200.0)


@pytest.fixture()
def raw(tmp_path):
    def write(name, *lines):
        (tmp_path / name).write_text("".join(f"{line}\n" for line in lines))
        return str(tmp_path / name)

    return write


def _files(path):
    return {f.name: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_one_day_is_cleaned_again_alone(spark, raw, tmp_path):
    day = [RANGE_START + i * DAY for i in range(3)]
    clean = tmp_path / "clean"
    jobs.clean_log(spark, raw("a", *(f"1,1,1,pv,{t}" for t in day)), str(clean))
    before = {d.name: _files(d) for d in clean.glob("date=*")}
    counts = jobs.clean_log(
        spark, raw("b", f"1,1,1,buy,{day[1]}", f"2,1,1,pv,{day[0]}"), str(clean),
        day[1], day[1] + DAY - 1, only_days=True,
    )
    after = {d.name: _files(d) for d in clean.glob("date=*")}
    assert [n for n in before if before[n] != after[n]] == ["date=2017-11-26"]
    assert counts["kept_rows"] == 1 and counts["out_of_range_rows"] == 1
    log = load_clean(spark, str(clean))
    assert sorted((r.timestamp, r.behavior) for r in log.collect()) == [
        (day[0], "pv"), (day[1], "buy"), (day[2], "pv"),
    ]


def test_batches_with_copies_equal_one_log(spark, raw, tmp_path):
    rows = [f"{u},1,1,pv,{RANGE_START + s}" for u in (1, 2) for s in (0, 1, DAY, DAY)]
    rows += [f",1,1,pv,{RANGE_START}", "x,1,1,pv,z", f"1,1,1,pv,{RANGE_END + 1}"]
    clean, whole = str(tmp_path / "parts"), str(tmp_path / "whole")
    jobs.clean_log(spark, raw("a", *rows[:5], *rows[8:]), clean)
    for _ in range(2):
        jobs.add_batch(spark, raw("b", *rows[3:]), clean)
    jobs.clean_log(spark, raw("c", *rows), whole)
    _same(load_clean(spark, clean), load_clean(spark, whole))
    assert load_clean(spark, clean).count() == 7


@pytest.mark.parametrize("clustered", [False, True])
def test_counts_are_those_of_a_report(spark, raw, tmp_path, clustered):
    rows = [f"{u},1,1,pv,{RANGE_START + u % 7}" for u in range(40)] * 2
    rows += ["x,1,1,pv,4000000000", "1,1,1,odd,z", "1,1,1,pv,-9223372036854775808", ""]
    path = raw("a", *rows)
    counts = jobs.clean_log(spark, path, str(tmp_path / "clean"), clustered=clustered)
    assert counts == cleaning.report(read_log(spark, path)).first().asDict()
    assert load_clean(spark, str(tmp_path / "clean")).count() == counts["kept_rows"]
    saved = spark.read.json(str(tmp_path / "clean_report")).first().asDict()
    assert saved == counts


def test_shared_reports_equal_each_on_its_own(spark, raw):
    rows = [f"{u},1,1,pv,{RANGE_START + u % 7}" for u in range(9)] * 2
    log = read_log(spark, raw("a", *rows, "x,1,1,pv,4000000000", "1,,1,odd,z", "1,1,1,,5"))
    shared = quality.reports(quality.facts(log))
    alone = {
        "range_report": quality.range_report(log),
        "null_counts": quality.null_counts(log),
        "behavior_domain": quality.behavior_domain(log),
        "duplicate_report": quality.duplicate_report(log),
        "clean_report": cleaning.report(log),
    }
    assert set(shared) == set(alone)
    for name, report in alone.items():
        assert shared[name].columns == report.columns
        _same(shared[name], report)
    nothing = quality.reports(quality.facts(log.where("false")))
    for name in ("range_report", "duplicate_report", "clean_report"):
        assert set(nothing[name].first()) == {0}


def test_command_line_passes_range_and_zone():
    chosen = options(["clean", "a", "b", "--start", "1", "--end", "2", "--zone", "UTC"])
    assert (chosen.start, chosen.end, chosen.zone, chosen.only_days) == (1, 2, "UTC", False)
    assert options(["analyse", "a", "b", "x", "--validate"]).validate


def test_analyse_validates_first(spark, tmp_path):
    jobs.analyse(visits(spark, (1, "pv", 0)), str(tmp_path), ["daily_uv_pv"], (0, 2**40))
    assert spark.read.json(str(tmp_path / "checks" / "behavior_domain")).count() == 1
