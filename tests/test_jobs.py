from __future__ import annotations

import pytest

from footfall import jobs
from footfall.functions import rollup
from footfall.operators import diagnostics, items, lookups, rfm
from footfall.params import RANGE_START
from footfall.plans.catalogue import _raw
from footfall.sources import events_log, load_clean, read_log
from tests.micro import rows_of


def test_from_raw_csv_to_saved_results(spark, sf_dir, tmp_path):
    raw, clean, out = (str(tmp_path / name) for name in ("raw", "clean", "out"))
    _raw(events_log(spark, sf_dir)).write.csv(raw)
    jobs.clean_log(spark, raw, clean, 0, 2**31 - 1)
    log = load_clean(spark, clean, cache=True)
    jobs.analyse(log, out)
    jobs.analyse(log, out, ["daily_uv_pv", "rfm_segments"])  # again, over the first run
    jobs.export(log, out)

    on_the_log = {**jobs.ROW_ANALYSES, **jobs.USER_ANALYSES, **jobs.ITEM_ANALYSES}
    for name, analysis in on_the_log.items():
        expected = analysis(log)
        saved = spark.read.schema(expected.schema).json(f"{out}/{name}")
        assert sorted(map(str, rows_of(saved))) == sorted(map(str, rows_of(expected))), name
    detail = rfm.rfm_detail(log)
    assert sorted(rows_of(spark.read.parquet(f"{out}/rfm_detail"))) == sorted(rows_of(detail))
    for name, analysis in jobs.SEGMENT_ANALYSES.items():
        saved = spark.read.json(f"{out}/{name}").select(*analysis(detail).columns)
        assert sorted(rows_of(saved)) == sorted(rows_of(analysis(detail))), name
    for name, table in jobs.EXPORTS.items():
        assert spark.read.json(f"{out}/{name}").count() == table(log).count() > 0
    log.unpersist()


def test_lookups_and_diagnostics_agree_on_rollups(spark, sf_dir):
    log = events_log(spark, sf_dir)
    by_user, by_item = rollup(log, *jobs.USER_KEYS), rollup(log, *jobs.ITEM_KEYS)
    pairs = [
        *((f, by_user) for f in (lookups.overview, diagnostics.purchases_without_view)),
        *((f, by_user) for f in (diagnostics.behavior_level_cvr, lookups.available_dates)),
        *((f, by_item) for f in (items.item_details, items.category_items)),
        *((f, by_item) for f in (items.category_stats, diagnostics.buyers_without_view)),
        (rollup_of_dates, by_user),
    ]
    for operator, reduced in pairs:
        assert sorted(rows_of(operator(reduced))) == sorted(rows_of(operator(log)))
    assert rows_of(diagnostics.behavior_level_cvr(by_user.where("false"))) == [(0, 0, 0.0)]


def rollup_of_dates(log):
    return rollup(log, "date")


def test_check_saves_the_quality_reports(spark, tmp_path):
    lines = [f"3000000000,1,1,pv,{RANGE_START}"] * 2 + ["x,1,1,pv,4000000000", "1,1,1,odd,z"]
    (tmp_path / "raw.csv").write_text("\n".join(lines))
    raw = read_log(spark, str(tmp_path / "raw.csv"))
    assert raw.agg({"user_id": "max", "timestamp": "max"}).first()[:] == (3_000_000_000, 4 * 10**9)
    jobs.check(raw, str(tmp_path / "out"))
    saved = spark.read.json(str(tmp_path / "out" / "clean_report")).first().asDict()
    assert saved == {
        "raw_rows": 4,
        "malformed_rows": 2,
        "out_of_range_rows": 2,
        "duplicate_rows": 1,
        "kept_rows": 1,
    }
    for name in ("range_report", "null_counts", "behavior_domain", "duplicate_report"):
        assert spark.read.json(str(tmp_path / "out" / name)).count() > 0


def test_default_range_is_the_business_period(spark, tmp_path):
    (tmp_path / "raw.csv").write_text(f"1,1,1,pv,{RANGE_START}\n1,1,1,pv,1\n")
    jobs.clean_log(spark, str(tmp_path / "raw.csv"), str(tmp_path / "clean"))
    assert load_clean(spark, str(tmp_path / "clean")).count() == 1


def test_unknown_analysis_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="nothing_like_it"):
        jobs.analyse(spark.range(1), str(tmp_path), ["nothing_like_it"])
