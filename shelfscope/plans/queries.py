"""Registered queries: one per operator of the inventory, each over the test tables.

Every query builds the stand-in sources from ``sf_dir`` with Spark, runs the
operator (and what it depends on) and returns a DataFrame whose columns match
the DuckDB oracle in ``shelfscope.oracle``.  Decimal sums are exact; they are
returned as doubles.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from shelfscope.operators import calendar, mart, pos, shipment, visits
from shelfscope.plans.job import MartJob
from shelfscope.plans.stages import stage_root
from shelfscope.sources.martstore import clone_schema, publish_family, read_mart
from shelfscope.sources.schemas import to_mart_rows
from shelfscope.sources.testviews import build_sources, adapter_params

_JOBS: dict[tuple, MartJob] = {}


def job_for(spark: SparkSession, sf_dir: str, **overrides) -> MartJob:
    """One ``MartJob`` per session, data folder and parameters (stages are reused until ``release_jobs``)."""
    key = (spark.sparkContext.applicationId, sf_dir, tuple(sorted(overrides.items())))
    if key not in _JOBS:
        _JOBS[key] = MartJob(spark, build_sources(spark, sf_dir), adapter_params(**overrides))
    return _JOBS[key]


def release_jobs() -> None:
    """Forget all jobs of this process and drop their stage tables."""
    while _JOBS:
        _JOBS.popitem()[1].drop_stages()


def doubles(df: DataFrame) -> DataFrame:
    """Cast decimal columns to double (the mart's measure type)."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ])


def q_schema_clone(spark, sf_dir):
    """An empty mart beside the published one, written and read back."""
    return clone_schema(spark, f"{stage_root(spark, job_for(spark, sf_dir).params)}/clone-{uuid.uuid4().hex}")


def q_publish(spark, sf_dir):
    """The mart published by families and read back."""
    j = job_for(spark, sf_dir)
    target = f"{stage_root(spark, j.params)}/publish-{uuid.uuid4().hex}"
    j.publish(target)
    return read_mart(spark, target)


def q_replace_family(spark, sf_dir):
    """A stored mart whose weekly POS rows are stale, after that one family is replaced."""
    j = job_for(spark, sf_dir)
    target = f"{stage_root(spark, j.params)}/replace-{uuid.uuid4().hex}"
    base = j.publish(target)
    stale = j.stored("POS_WEEKLY").withColumn("sale_val", F.lit(-1.0))
    publish_family(spark, target, "POS_WEEKLY", stale, mart.category_totals(stale.withColumn("catg_nm", F.col(mart.PRUNE_KEY))))
    now = publish_family(spark, target, "POS_WEEKLY", j.stored("POS_WEEKLY"), j.family_totals("POS_WEEKLY"))
    assert all(now.families[f] == base.families[f] for f in base.families if f != "POS_WEEKLY")
    return read_mart(spark, target)


def q_strict_key(spark, sf_dir):
    """P53 with the hash key as written: NULL wherever a raw part is."""
    j = job_for(spark, sf_dir)
    params = dataclasses.replace(j.params, strict_hash_key=True)
    rows = mart.enrich_with_store(to_mart_rows(j.pos_weekly_rows), j.spr_stores, params)
    return mart.final_projection(rows, j.pos_run_dt, params)


def q_merged_year_ago(spark, sf_dir):
    """P13 with one row per key instead of one per source."""
    j = job_for(spark, sf_dir)
    return doubles(shipment.shipment_year_ago(j.shipment_detail, j.pos_frames, dataclasses.replace(j.params, merge_sources=True)))


def q_run_date(spark, sf_dir):
    j = job_for(spark, sf_dir)
    params = adapter_params(visit_run_date=None, today=dt.date(2024, 2, 10))
    return calendar.run_date_frame(j.cal_day, params)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "run_date": q_run_date,
    "period_frames": lambda s, d: job_for(s, d).pos_frames_df,
    "weekly_frames": lambda s, d: job_for(s, d).pos_weekly_frames_df,
    "store_master": lambda s, d: job_for(s, d).all_stores,
    "store_hierarchy": lambda s, d: job_for(s, d).spr_stores,
    "product_master": lambda s, d: job_for(s, d).products,
    "store_product_grid": lambda s, d: job_for(s, d).store_product_grid,
    "pos_rollup_ic": lambda s, d: doubles(job_for(s, d).pos_ic),
    "pos_rollup_plain": lambda s, d: doubles(job_for(s, d).pos_plain),
    "category_share": lambda s, d: job_for(s, d).category_share,
    "pos_store_facts": lambda s, d: doubles(job_for(s, d).pos_facts),
    "pos_share_growth": lambda s, d: doubles(job_for(s, d).pos_metrics.select(*pos.CALC_COLUMNS)),
    "pos_placeholder_rows": lambda s, d: job_for(s, d).pos_placeholders,
    "pos_chain_rank": lambda s, d: job_for(s, d).pos_ranks,
    "chain_store_count": lambda s, d: pos.chain_store_count(job_for(s, d).spr_stores),
    "pos_summary": lambda s, d: doubles(job_for(s, d).pos_rows),
    "pos_weekly": lambda s, d: doubles(job_for(s, d).pos_weekly_rows),
    "shipment_detail": lambda s, d: doubles(job_for(s, d).shipment_detail),
    "shipment_current": lambda s, d: doubles(job_for(s, d).shipment_current),
    "shipment_year_ago": lambda s, d: doubles(job_for(s, d).shipment_year_ago),
    "shipment_summary": lambda s, d: doubles(job_for(s, d).shipment_summary),
    "key_brand_base": lambda s, d: doubles(job_for(s, d).key_brand_base),
    "key_brand_metrics": lambda s, d: doubles(job_for(s, d).key_brand_metrics.drop("_ck")),
    "key_brand_chain_rank": lambda s, d: doubles(job_for(s, d).key_brand_ranked.drop("_ck")),
    "key_brand_emit": lambda s, d: doubles(job_for(s, d).key_brand_rows),
    "visit_audit": lambda s, d: visits.with_visit_rank(job_for(s, d).visit_detail),
    "oos_summary": lambda s, d: job_for(s, d).oos,
    "priority_latest": lambda s, d: job_for(s, d).visit_priority,
    "priority_weeks": lambda s, d: job_for(s, d).priority_weeks,
    "priority_rollup": lambda s, d: job_for(s, d).priority_rollup,
    "events_split": lambda s, d: job_for(s, d).events,
    "driver_active_categories": lambda s, d: job_for(s, d).drv_active,
    "driver_event_categories": lambda s, d: job_for(s, d).drv_event_cats,
    "driver_category_list": lambda s, d: job_for(s, d).drv_store_lists,
    "driver_matrix": lambda s, d: job_for(s, d).drv_matrix,
    "driver_event_facts": lambda s, d: job_for(s, d).drv_event_facts,
    "driver_store_facts": lambda s, d: job_for(s, d).drv_store_facts,
    "driver_chain_facts": lambda s, d: job_for(s, d).drv_chain_facts,
    "driver_rank": lambda s, d: job_for(s, d).drv_store_level,
    "driver_chain_totals": lambda s, d: job_for(s, d).drv_chain_level,
    "driver_summary": lambda s, d: job_for(s, d).driver_rows,
    "mart_union": lambda s, d: job_for(s, d).mart_union,
    "prune_categories": lambda s, d: job_for(s, d).mart_pruned,
    "location_master": lambda s, d: job_for(s, d).location_rows,
    "enrich_store": lambda s, d: job_for(s, d).mart_enriched,
    "mart_final": lambda s, d: job_for(s, d).mart_final,
    "mart_schema_clone": q_schema_clone,
    "mart_publish": q_publish,
    "mart_replace_family": q_replace_family,
    "mart_strict_hash_key": q_strict_key,
    "shipment_year_ago_merged": q_merged_year_ago,
}
