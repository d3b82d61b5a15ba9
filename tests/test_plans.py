"""Plan checks: literal frame bounds reach the scans, facts never meet a cartesian product,
and the schema / sink helpers behave."""

import os

import pytest

from shelfscope.plans.job import MartJob
from shelfscope.sources.schemas import MART_COLUMNS, empty_mart
from shelfscope.sources.martstore import latest, publish_mart, read_mart
from shelfscope.sources.tables import SOURCE_NAMES, read_sources
from shelfscope.sources.testviews import build_sources, adapter_params

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def parquet_job(spark, scratch):
    """Sources written as Parquet tables (as in production), read back with read_sources."""
    root = f"{scratch}/sources"
    src = build_sources(spark, SF)
    for n in SOURCE_NAMES:
        if not os.path.exists(f"{root}/{n}"):
            getattr(src, n).write.mode("overwrite").parquet(f"{root}/{n}")
    return MartJob(spark, read_sources(spark, root), adapter_params())


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return df._jdf.queryExecution().executedPlan().toString()


def test_pos_base_pushes_week_bounds_and_is_the_only_scan(parquet_job):
    from shelfscope.operators import pos

    j = parquet_job
    p = plan(pos.pos_base(j.src.pos_weekly, j.pos_frames + j.pos_weekly_frames, j.spr_stores))
    assert "GreaterThanOrEqual(fisc_yr_wk" in p and "LessThanOrEqual(fisc_yr_wk" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p and "SortAggregate" not in p
    assert "sale_vol_lb_val" in [x for x in p.splitlines() if "ReadSchema" in x and "pos_weekly" in x][0]
    frames = j.pos_frames + j.pos_weekly_frames
    for df in (pos.pos_rollup_ic(j.pos_base, frames, j.grid_catgs, j.params), pos.pos_rollup_plain(j.pos_base, j.pos_frames, j.grid_catgs)):
        p = plan(df)
        assert "SortAggregate" not in p and not [x for x in p.splitlines() if "FileScan" in x and "/pos_weekly" in x]


def test_shipment_and_visits_have_no_cartesian_on_facts(parquet_job):
    for df in (parquet_job.shipment_detail, parquet_job.visit_detail, parquet_job.oos):
        p = plan(df)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("threshold", ["-1", "1MB", "10MB"])
def test_grid_rows_are_never_shuffled_or_windowed(spark, threshold):
    """Whatever Spark broadcasts: above the generator of the grid rows there is no exchange, sort or window."""
    from shelfscope.operators import pos
    from shelfscope.plans.queries import job_for

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        j = job_for(spark, SF)
        level, metrics = j.pos_store_level, pos.pos_share_growth(
            j.spr_stores, j.products, j.pos_frames, j.pos_ic, j.pos_sparse, j.pos_totals, j.pos_store_level, j.pos_ranks, j.params)
        df = pos.pos_summary_rows(metrics, j.pos_placeholders, j.pos_ranks, j.spr_stores)
        rows = df.collect()
        p = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(rows) > level.count()
    p = p.split("Initial Plan")[0]
    assert "isFinalPlan=true" in p and "Window" not in p
    lines = p.splitlines()
    at = [i for i, x in enumerate(lines) if "Generate explode(transform(filter(_members" in x]
    assert at
    for i in at:
        depth, above = lines[i].find("Generate"), []
        for x in reversed(lines[:i]):
            here = len(x) - len(x.lstrip(" :+-*(0123456789)"))
            if here < depth:
                above.append(x.lstrip(" :+-"))
                depth = here
        assert not [x for x in above if "Exchange" in x or "Sort" in x]


def test_empty_mart_has_the_mart_schema(spark):
    df = empty_mart(spark)
    assert df.count() == 0
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
        (c, {"int": "int", "timestamp_ntz": "timestamp_ntz"}.get(t, t)) for c, t in MART_COLUMNS]


def test_publish_replaces_and_a_failed_run_leaves_the_old_mart(spark, scratch):
    from pyspark.sql import functions as F

    from shelfscope.plans.queries import job_for

    out = f"{scratch}/mart"
    mart = job_for(spark, SF).mart_final
    assert read_mart(spark, out).count() == 0
    publish_mart(mart, out)
    publish_mart(mart, out)  # a rerun replaces, never appends
    back = read_mart(spark, out)
    assert back.columns == [c for c, _ in MART_COLUMNS] and back.count() == mart.count()
    assert {r.metrc_nm for r in back.select("metrc_nm").distinct().collect()} >= {"SHP", "POS", "KEY_BRAND"}
    before = latest(spark, out)
    with pytest.raises(Exception):
        publish_mart(mart.withColumn("sale_val", F.raise_error(F.lit("boom")).cast("double")), out)
    assert latest(spark, out) == before and read_mart(spark, out).count() == mart.count()


def test_catalog_source_and_target(spark):
    from shelfscope.plans.queries import job_for

    src = build_sources(spark, SF)
    spark.sql("CREATE DATABASE IF NOT EXISTS shelf_src")
    for n in SOURCE_NAMES:
        spark.sql(f"DROP TABLE IF EXISTS shelf_src.{n}")
        getattr(src, n).write.mode("overwrite").saveAsTable(f"shelf_src.{n}", format="parquet")
    read = read_sources(spark, "catalog:shelf_src")
    assert read.cal_day.count() == src.cal_day.count()
    rows = job_for(spark, SF).location_rows
    from shelfscope.sources.schemas import to_mart_rows

    for _ in range(2):
        publish_mart(to_mart_rows(rows), "catalog:shelf_mart")
    assert read_mart(spark, "catalog:shelf_mart").count() == rows.count()


def test_run_publishes_and_drops_stage_tables_also_on_failure(spark, scratch, monkeypatch):
    from shelfscope.plans import job as job_module
    from shelfscope.plans.stages import stage_root

    job = MartJob(spark, build_sources(spark, SF), adapter_params())
    out = f"{scratch}/mart_run"
    job.run(out)
    assert read_mart(spark, out).count() > 0
    root = stage_root(spark, job.params).replace("file:", "")
    assert not os.path.exists(root)
    job = MartJob(spark, build_sources(spark, SF), adapter_params())
    job.spr_stores

    def fail(*_):
        raise OSError("no space")

    monkeypatch.setattr(job_module, "publish_families", fail)
    with pytest.raises(OSError):
        job.run(out)
    assert not os.path.exists(stage_root(spark, job.params).replace("file:", ""))


def test_library_needs_a_shared_folder(monkeypatch):
    from shelfscope.session import checkpoint_dir

    class Nothing:
        def getCheckpointDir(self):
            return None

        def get(self, *_):
            return None

    class Session:
        sparkContext = conf = Nothing()

    with pytest.raises(RuntimeError):
        checkpoint_dir(Session())


def _window_partitions(plan: str) -> list[str]:
    import re

    return re.findall(r"windowspecdefinition\(([^,]+(?:, [^,]+)*?), (?:specifiedwindowframe|[a-z_]+#\d+ (?:ASC|DESC))", plan)


def test_key_brand_store_windows_only(spark):
    from shelfscope.operators import key_brand
    from shelfscope.plans.queries import job_for

    j = job_for(spark, SF)
    specs = _window_partitions(plan(key_brand.key_brand_metrics(j.key_brand_base, j.params)))
    assert specs and all("sold_to_nbr" in s and "chain_nbr" not in s for s in specs)


def test_audit_scan_gets_day_range(parquet_job):
    from shelfscope.operators import visits

    j = parquet_job
    p = plan(visits.visit_audit_detail(j.src.visit_audit, j.cal_day, j.src.prod_matrl, j.covered_stores,
                                       j.psd_frames))
    assert "GreaterThanOrEqual(actl_start_dt_time" in p and "LessThan(actl_start_dt_time" in p


def test_shipments_partitioned_by_year_are_pruned(spark, scratch, parquet_job):
    import re

    from shelfscope.operators import shipment

    j = parquet_job
    path = f"{scratch}/shipments_by_year"
    j.src.shipments.write.mode("overwrite").partitionBy("fisc_yr").parquet(path)
    facts = spark.read.parquet(path)
    p = plan(shipment.shipment_detail(facts, j.src.cal_wk, j.cust_hier, j.matrl_hier, j.pos_frames))
    parts = re.findall(r"PartitionFilters: \[([^\]]*)\]", p)
    assert any("fisc_yr" in x for x in parts)


def test_hot_keys_are_dealt_by_their_own_number_of_rows(spark, monkeypatch):
    """A key with a third of all rows spreads over more than 8 tasks; small keys are not repeated."""
    from pyspark.sql import functions as F

    from shelfscope.plans import stages

    monkeypatch.setattr(stages, "ROWS_PER_SALT", 100)
    many = spark.range(6000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 97)).alias("k"), "id")
    many = many.unionByName(spark.createDataFrame([(None, -1)], "k string, id long"))
    few = many.where("id >= 0").select("k").distinct().withColumn("v", F.length("k")).withColumn("r", F.explode(F.array(F.lit(1), F.lit(2))))
    params = adapter_params()
    salts = {r["k"]: r["_salts"] for r in stages.key_salts(many, ["k"], 100).collect()}
    assert salts == {"hot": 20}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        out = stages.salted_join(many, few, ["k"], ["id"], params)
        tasks = out.where("k = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
        assert out.exceptAll(many.join(few, "k").select(*out.columns)).count() == 0 and out.count() == 12_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert tasks > 8


def test_driver_lists_have_no_window_over_the_dense_rows(spark):
    from shelfscope.plans.queries import job_for
    from shelfscope.operators import drivers

    j = job_for(spark, SF)
    p = plan(drivers.store_category_lists(j.drv_individual, j.drv_active, j.drv_event_cats))
    assert "Window" not in p
    p = plan(drivers.driver_summary(j.drv_store_facts, j.drv_chain_facts, j.drv_store_level, j.drv_chain_level))
    joins = [x for x in p.splitlines() if "Join" in x and "_list" in x]
    assert joins and "CartesianProduct" not in p
