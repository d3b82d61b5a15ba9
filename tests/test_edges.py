"""Edge inputs: empty facts and a run date outside the calendar still build a mart."""

import dataclasses
import datetime as dt

from pyspark.sql import functions as F

from shelfscope.plans.job import MartJob
from shelfscope.sources.schemas import MART_COLUMNS
from shelfscope.sources.testviews import adapter_params, build_sources

SF = "/root/testdata/sf0.001"


def test_empty_facts_build_location_rows_only(spark):
    src = build_sources(spark, SF)
    empty = {n: getattr(src, n).filter(F.lit(False))
             for n in ("pos_weekly", "shipments", "visit_audit", "priority_stat")}
    job = MartJob(spark, dataclasses.replace(src, **empty), adapter_params())
    mart = job.mart_final
    assert mart.columns == [c for c, _ in MART_COLUMNS]
    metrics = {r.metrc_nm for r in mart.select("metrc_nm").distinct().collect()}
    assert "POS" in metrics  # location master rows (and zero-filled grid rows) remain
    assert mart.filter(F.col("sale_val") > 0).count() == 0


def test_run_date_outside_calendar(spark):
    src = build_sources(spark, SF)
    job = MartJob(spark, src, adapter_params(pos_run_date=dt.date(1980, 1, 5), visit_run_date=dt.date(1980, 1, 5)))
    frames = {f.tmfrm_cd: f for f in job.pos_frames.frames}
    assert set(frames) == {"L4W", "L13W", "YTD"} and frames["YTD"].pd_start_yr_wk is None
    assert job.mart_final.filter(F.col("metrc_nm") == "SHP").count() == 0
    assert job.mart_final.count() > 0
