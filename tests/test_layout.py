"""Facts by week: only the frames' partitions are opened; kept roll-ups equal a full run."""

import os
import re
import shutil

import pytest
from pyspark.sql import functions as F

from shelfscope.plans.job import MartJob
from shelfscope.sources.layout import ShipmentWeekStore, WeekStore, lay_out
from shelfscope.sources.martstore import manifests
from shelfscope.sources.tables import read_sources
from shelfscope.sources.testviews import adapter_params, build_sources

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def laid_out(spark, scratch):
    root = f"{scratch}/laid_out"
    lay_out(build_sources(spark, SF), root)
    return root


@pytest.fixture(scope="module")
def plain(spark):
    return MartJob(spark, build_sources(spark, SF), adapter_params())


def spoil(folder):
    """Files that no reader gets through, at the same length and time."""
    for name in os.listdir(folder):
        path = f"{folder}/{name}"
        s = os.stat(path)
        with open(path, "r+b") as f:
            f.write(b"\0" * s.st_size)
        os.utime(path, ns=(s.st_atime_ns, s.st_mtime_ns))


def rows(df):
    return sorted(map(str, df.collect()))


def test_only_the_frames_partitions_are_opened(spark, scratch, laid_out, plain):
    root = f"{scratch}/pruned"
    shutil.copytree(laid_out, root)
    lo, hi = (plain.pos_frames + plain.pos_weekly_frames).week_bounds()
    sources, outside = read_sources(spark, root), 0
    for week in os.listdir(f"{root}/pos_weekly"):
        if "=" in week and not lo <= week.split("=")[1] <= hi:
            spoil(f"{root}/pos_weekly/{week}")
            outside += 1
    weeks = {(r["fisc_yr"], r["fisc_wk"]) for r in plain.src.cal_wk.filter(
        F.col("fisc_wk_end_dt").between(*[F.lit(d) for d in (plain.pos_frames.date_bounds()[0] - __import__("datetime").timedelta(days=364), plain.pos_frames.date_bounds()[1])])).collect()}
    for year in [x for x in os.listdir(f"{root}/shipments") if "=" in x]:
        for week in os.listdir(f"{root}/shipments/{year}"):
            if (int(year.split("=")[1]), int(week.split("=")[1])) not in weeks:
                spoil(f"{root}/shipments/{year}/{week}")
                outside += 1
    assert outside > 20
    job = MartJob(spark, sources, adapter_params())
    assert rows(job.pos_base) == rows(plain.pos_base)
    assert rows(job.shipment_detail.drop("kortex_upld_ts")) == rows(plain.shipment_detail.drop("kortex_upld_ts"))
    assert rows(job.visit_detail) == rows(plain.visit_detail)
    from shelfscope.operators import pos, shipment, visits

    for df, column in (
        (pos.pos_base(job.src.pos_weekly, job.pos_frames, job.spr_stores), "fisc_yr_wk"),
        (shipment.shipment_detail(job.src.shipments, job.src.cal_wk, job.cust_hier, job.matrl_hier, job.pos_frames), "fisc_wk"),
        (visits.visit_audit_detail(job.src.visit_audit, job.cal_day, job.src.prod_matrl, job.covered_stores, job.psd_frames), "visit_dt"),
    ):
        spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
        p = df._jdf.queryExecution().executedPlan().toString()
        assert any(column in x for x in re.findall(r"PartitionFilters: \[([^\]]+)\]", p))
    job.drop_stages()


def test_kept_weeks_equal_a_full_run_and_only_changed_weeks_are_scanned(spark, scratch, laid_out, plain):
    root, store = f"{scratch}/kept", f"{scratch}/week_store"
    shutil.copytree(laid_out, root)
    frames = plain.pos_frames + plain.pos_weekly_frames
    lo, hi = frames.week_bounds()

    def run(sources):
        job = MartJob(spark, sources, adapter_params(), WeekStore(spark, f"{root}/pos_weekly", store))
        got = rows(job.pos_ic), rows(job.pos_plain)
        job.drop_stages()
        return got

    full = rows(plain.pos_ic), rows(plain.pos_plain)
    assert run(read_sources(spark, root)) == full
    weeks = sorted(x.split("=")[1] for x in os.listdir(f"{root}/pos_weekly") if "=" in x and lo <= x.split("=")[1] <= hi)
    assert sorted(manifests(spark, store)[-1].families) == weeks
    # A revised week and a new file: the other weeks are spoilt, so scanning one of them would fail.
    changed = f"{root}/pos_weekly/fisc_yr_wk={weeks[-1]}"
    spark.read.parquet(changed).limit(5).write.mode("append").parquet(changed)
    sources = read_sources(spark, root)
    revised = MartJob(spark, sources, adapter_params())
    want = rows(revised.pos_ic), rows(revised.pos_plain)
    revised.drop_stages()
    for week in weeks[:-1]:
        spoil(f"{root}/pos_weekly/fisc_yr_wk={week}")
    assert WeekStore(spark, f"{root}/pos_weekly", store).stale(lo, hi) == weeks[-1:]
    assert run(sources) == want != full
    assert WeekStore(spark, f"{root}/pos_weekly", store).stale(lo, hi) == []
    assert run(sources) == want


def test_kept_shipment_weeks_equal_a_full_run_and_only_changed_weeks_are_scanned(spark, scratch, laid_out, plain):
    from shelfscope.operators.shipment import fiscal_weeks

    root, at = f"{scratch}/kept_ship", f"{scratch}/ship_store"
    shutil.copytree(laid_out, root)
    held = fiscal_weeks(plain.src.cal_wk, plain.pos_frames)[1]
    store = ShipmentWeekStore(spark, f"{root}/shipments", at)

    def run(weeks):
        job = MartJob(spark, read_sources(spark, root), adapter_params(), None, weeks)
        got = [rows(df.drop("kortex_upld_ts")) for df in (job.shipment_current, job.shipment_year_ago, job.shipment_plan_level)]
        job.drop_stages()
        return got

    full = [rows(df.drop("kortex_upld_ts")) for df in (plain.shipment_current, plain.shipment_year_ago, plain.shipment_plan_level)]
    assert run(store) == full and all(full)
    names = sorted(store.week_of(str(y), str(w)) for y, w in held)
    kept = sorted(manifests(spark, at)[-1].families)
    assert kept == sorted(w for w in store.folders() if names[0] <= w <= names[-1]) and len(kept) < len(store.folders())
    # A revised week and one that is gone: the other weeks are spoilt, so scanning one of them would fail.
    folders = store.folders()
    changed = f"{root}/shipments/{folders[kept[-1]]}"
    spark.read.parquet(changed).limit(7).write.mode("append").parquet(changed)
    shutil.rmtree(f"{root}/shipments/{folders[kept[0]]}")
    want = run(None)
    for week in kept[1:-1]:
        spoil(f"{root}/shipments/{folders[week]}")
    assert store.stale(names[0], names[-1]) == kept[-1:]
    assert run(store) == want != full
    assert store.stale(names[0], names[-1]) == [] and run(store) == want


def test_a_shipment_fact_without_weeks(spark, scratch, laid_out, plain):
    store = ShipmentWeekStore(spark, f"{laid_out}/shipments", f"{scratch}/ship_none")
    none = store.of_frames([])
    assert none.columns == store.of_frames([(1901, 1)]).columns and none.count() == 0 == store.of_frames([(1901, 1)]).count()
    assert store.week_of("1998", "7") == "199807" and store.week_of("1998", "__HIVE_DEFAULT_PARTITION__") is None
