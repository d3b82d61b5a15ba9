"""The mart build: wires the operators into one DAG and materialises shared stages.

``MartJob`` holds the source tables and parameters; each stage is a cached
property, so a stage read by several metric families is defined and written
exactly once, also when families are built side by side.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope.operators import calendar, drivers, key_brand, mart, masters, pos, shipment, visits
from shelfscope.operators.calendar import FrameSet
from shelfscope.params import HIER_COVERED, MartParams
from shelfscope.plans.stages import Shared, drop_stages, materialize, shared_property, side_by_side
from shelfscope.sources.layout import ShipmentWeekStore, WeekStore
from shelfscope.sources.martstore import RETAIN, Manifest, latest, publish_families, publish_family
from shelfscope.sources.tables import SourceTables, read_sources


#: Families whose rows are made where they are written, in parts dealt by store.
DENSE = ("POS", "SHP")


def run_mart(spark: SparkSession, run_date: dt.date, source_root: str, target: str, week_store: str | None = None, **params) -> None:
    """The production entry: one run date for POS and visits, sources and target by name.

    ``source_root`` is a folder of Parquet tables or a catalog database
    (``catalog:<database>``); ``target`` a folder or a table (``catalog:<table>``).
    ``week_store`` names a folder of week roll-ups kept between runs, for sources
    whose POS and shipment facts are partitioned by week: only new and revised weeks
    are scanned.
    """
    p = MartParams(pos_run_date=run_date, visit_run_date=run_date, **params)
    weeks = WeekStore(spark, f"{source_root}/pos_weekly", week_store) if week_store else None
    shipped = ShipmentWeekStore(spark, f"{source_root}/shipments", f"{week_store}_shipments") if week_store else None
    MartJob(spark, read_sources(spark, source_root), p, weeks, shipped).run(target)


class MartJob(Shared):
    def __init__(self, spark: SparkSession, sources: SourceTables, params: MartParams, weeks: WeekStore | None = None,
                 shipment_weeks: ShipmentWeekStore | None = None):
        super().__init__()
        self.weeks, self.shipment_weeks = weeks, shipment_weeks
        self.spark = spark
        self.src = sources
        if params.run_id == "adhoc":
            params = dataclasses.replace(params, run_id=uuid.uuid4().hex)
        if params.load_ts is None:
            params = dataclasses.replace(params, load_ts=dt.datetime.now().replace(microsecond=0))
        self.params = params

    def run(self, target: str) -> None:
        """Build the mart and publish it; the stage tables go, also when it fails.

        Raises ``PublishConflict`` if another run publishes meanwhile.
        """
        base = latest(self.spark, target)
        try:
            self.publish(target, base)
        finally:
            self.drop_stages()

    def make_stages(self) -> None:
        """Make the stages of all families, those that do not depend on each other side by side."""
        side_by_side([lambda f=f: (self.family_rows(f), self.family_totals(f)) for f in ("POS", "DRIVERS", "SHP", "KEY_BRAND", "POS_WEEKLY", "POS_CATG_AMPS")])

    def publish(self, target: str, base: Manifest | None = None) -> Manifest:
        """Write every family once, with its category totals, and publish them together."""
        self.make_stages()
        return publish_families(self.spark, target, {k: self.stored(k) for k in mart.FAMILIES},
                                {k: self.family_totals(k) for k in mart.FAMILIES}, base, RETAIN, DENSE)

    def refresh_family(self, target: str, family: str) -> Manifest:
        """Build, write and replace one metric family of the stored mart; the others are neither built nor touched."""
        try:
            return publish_family(self.spark, target, family, self.stored(family), self.family_totals(family), dealt=family in DENSE)
        finally:
            self.drop_stages()

    def drop_stages(self) -> None:
        drop_stages(self.spark, self.params)

    # ---- calendar -------------------------------------------------------------------
    @shared_property
    def cal_day(self) -> DataFrame:
        """The day calendar, read by the run-date resolver, every frame and the visit join."""
        return materialize(self.src.cal_day, self.params)

    @shared_property
    def run_dates(self):
        return calendar.resolve_run_dates(self.cal_day, self.params)

    @property
    def pos_run_dt(self):
        return self.run_dates[0]

    @property
    def psd_run_dt(self):
        return self.run_dates[1]

    @shared_property
    def pos_frames_df(self) -> DataFrame:
        return calendar.period_frames(self.cal_day, self.pos_run_dt)

    @shared_property
    def pos_weekly_frames_df(self) -> DataFrame:
        return calendar.weekly_frames(self.cal_day, self.pos_run_dt)

    @shared_property
    def psd_frames_df(self) -> DataFrame:
        return calendar.period_frames(self.cal_day, self.psd_run_dt)

    @shared_property
    def pos_frames(self) -> FrameSet:
        return FrameSet.collect(self.pos_frames_df)

    @shared_property
    def pos_weekly_frames(self) -> FrameSet:
        return FrameSet.collect(self.pos_weekly_frames_df)

    @shared_property
    def psd_frames(self) -> FrameSet:
        return FrameSet.collect(self.psd_frames_df)

    # ---- masters --------------------------------------------------------------------
    @shared_property
    def all_stores(self) -> DataFrame:
        return masters.all_stores(self.src.cust_pivot, self.src.src_pref)

    @shared_property
    def spr_stores(self) -> DataFrame:
        return materialize(masters.store_hierarchy(self.all_stores), self.params)

    @shared_property
    def covered_stores(self) -> DataFrame:
        return self.spr_stores.filter(F.col("hier_type_cd") == HIER_COVERED)

    @shared_property
    def products(self) -> DataFrame:
        return materialize(masters.product_master(self.src.prod_gtin), self.params)

    @shared_property
    def store_product_grid(self) -> DataFrame:
        return masters.store_product_grid(self.spr_stores, self.products)

    @shared_property
    def grid_catgs(self) -> DataFrame:
        return masters.grid_categories(self.products)

    # ---- POS ------------------------------------------------------------------------
    @shared_property
    def pos_base(self) -> DataFrame:
        frames = self.pos_frames + self.pos_weekly_frames
        fact = self.weeks.rollups(*frames.week_bounds()) if self.weeks else self.src.pos_weekly
        return materialize(pos.pos_base(fact, frames, self.spr_stores), self.params)

    @shared_property
    def pos_ic(self) -> DataFrame:
        frames = self.pos_frames + self.pos_weekly_frames
        return materialize(pos.pos_rollup_ic(self.pos_base, frames, self.grid_catgs, self.params), self.params)

    @shared_property
    def pos_plain(self) -> DataFrame:
        return materialize(pos.pos_rollup_plain(self.pos_base, self.pos_frames, self.grid_catgs), self.params)

    @shared_property
    def pos_sparse(self) -> DataFrame:
        return materialize(pos.pos_sparse_facts(self.spr_stores, self.products, self.pos_frames, self.pos_ic,
                                                self.params), self.params)

    @shared_property
    def pos_totals(self) -> dict[str, DataFrame]:
        return {k: materialize(v, self.params) for k, v in pos.pos_totals(self.pos_sparse).items()}

    @shared_property
    def pos_store_level(self) -> DataFrame:
        return materialize(pos.pos_store_level(self.spr_stores, self.products, self.pos_frames, self.pos_ic,
                                               self.pos_sparse, self.pos_totals, self.params), self.params)

    @shared_property
    def pos_ranks(self) -> DataFrame:
        return pos.pos_chain_rank(self.pos_store_level, self.pos_sparse, self.pos_totals, self.params)

    @shared_property
    def pos_metrics(self) -> DataFrame:
        return pos.pos_share_growth(self.spr_stores, self.products, self.pos_frames, self.pos_ic, self.pos_sparse,
                                    self.pos_totals, self.pos_store_level, self.pos_ranks, self.params)

    def pos_rows_with_stores(self) -> DataFrame:
        """The POS rows, each with its store's attributes, which are attached before the zero rows are made."""
        metrics = pos.pos_share_growth(self.spr_stores, self.products, self.pos_frames, self.pos_ic, self.pos_sparse,
                                       self.pos_totals, self.pos_store_level, self.pos_ranks, self.params, self.store_attributes)
        return pos.pos_summary_emit(pos.pos_summary_rows(metrics, self.pos_placeholders, self.pos_ranks, self.spr_stores, self.store_attributes))

    @shared_property
    def pos_facts(self) -> DataFrame:
        return self.pos_metrics.select(*pos.FACT_COLUMNS)

    @shared_property
    def pos_placeholders(self) -> DataFrame:
        return pos.pos_placeholder_rows(self.spr_stores, self.pos_frames, self.params)

    @shared_property
    def pos_final(self) -> DataFrame:
        return pos.pos_summary_rows(self.pos_metrics, self.pos_placeholders, self.pos_ranks, self.spr_stores)

    @shared_property
    def pos_rows(self) -> DataFrame:
        return pos.pos_summary_emit(self.pos_final)

    @shared_property
    def pos_weekly_rows(self) -> DataFrame:
        return pos.pos_weekly_rows(self.spr_stores, self.products, self.pos_weekly_frames,
                                   self.pos_ic, self.params)

    @shared_property
    def category_share(self) -> DataFrame:
        return pos.category_share(self.pos_plain, self.spr_stores, self.pos_frames, self.params)

    @shared_property
    def category_share_rows(self) -> DataFrame:
        return pos.category_share_emit(self.category_share)

    # ---- shipments ------------------------------------------------------------------
    @shared_property
    def matrl_hier(self) -> DataFrame:
        return shipment.material_hierarchy(self.src.prod_matrl)

    @shared_property
    def cust_hier(self) -> DataFrame:
        return shipment.customer_hierarchy(self.src.cust_pivot)

    @shared_property
    def shipment_detail(self) -> DataFrame:
        fact = self.src.shipments
        if self.shipment_weeks:
            fact = self.shipment_weeks.of_frames(shipment.fiscal_weeks(self.src.cal_wk, self.pos_frames)[1])
        return materialize(shipment.shipment_detail(
            fact, self.src.cal_wk, self.cust_hier, self.matrl_hier, self.pos_frames),
            self.params)

    @shared_property
    def shipment_current(self) -> DataFrame:
        return shipment.shipment_current(self.shipment_detail, self.pos_frames)

    @shared_property
    def shipment_year_ago(self) -> DataFrame:
        return shipment.shipment_year_ago(self.shipment_detail, self.pos_frames, self.params)

    @shared_property
    def shipment_plan_level(self) -> DataFrame:
        return materialize(shipment.shipment_plan_level(
            self.covered_stores, self.matrl_hier, self.shipment_current, self.shipment_year_ago,
            self.pos_frames), self.params)

    @shared_property
    def shipment_summary(self) -> DataFrame:
        return shipment.shipment_summary(self.covered_stores, self.shipment_plan_level, self.params)

    @shared_property
    def shipment_rows(self) -> DataFrame:
        return shipment.shipment_emit(self.shipment_summary)

    def shipment_rows_with_stores(self) -> DataFrame:
        """The shipment rows, each with its store's attributes, which are attached before the stores are multiplied."""
        return shipment.shipment_emit(shipment.shipment_summary(self.covered_stores, self.shipment_plan_level, self.params, self.store_attributes))

    # ---- key brands -----------------------------------------------------------------
    @shared_property
    def key_brand_base(self) -> DataFrame:
        return key_brand.key_brand_base(self.spr_stores, self.products, self.pos_frames, self.pos_ic,
                                        self.params)

    @shared_property
    def key_brand_metrics(self) -> DataFrame:
        return materialize(key_brand.key_brand_metrics(self.key_brand_base, self.params), self.params)

    @shared_property
    def key_brand_ranked(self) -> DataFrame:
        return key_brand.key_brand_chain_rank(self.key_brand_metrics, self.params)

    @shared_property
    def key_brand_rows(self) -> DataFrame:
        return key_brand.key_brand_emit(self.key_brand_ranked, self.spr_stores)

    # ---- visits and priorities ------------------------------------------------------
    @shared_property
    def visit_detail(self) -> DataFrame:
        return materialize(visits.visit_audit_detail(
            self.src.visit_audit, self.cal_day, self.src.prod_matrl, self.covered_stores,
            self.psd_frames), self.params)

    @shared_property
    def latest_visits(self) -> DataFrame:
        return visits.latest_visits(self.visit_detail)

    @shared_property
    def oos(self) -> DataFrame:
        return materialize(visits.oos_summary(self.visit_detail, self.psd_frames), self.params)

    @shared_property
    def visit_priority(self) -> DataFrame:
        return visits.priority_latest(self.src.priority_stat, self.latest_visits, self.psd_frames,
                                      self.covered_stores)

    @shared_property
    def priority_weeks(self) -> DataFrame:
        return visits.priority_weeks(self.visit_priority, self.latest_visits)

    @shared_property
    def priority_rollup(self) -> DataFrame:
        return visits.priority_rollup(self.priority_weeks)

    @shared_property
    def events(self) -> DataFrame:
        return materialize(visits.events_split(self.priority_rollup, self.params.priority_max_parts), self.params)

    # ---- drivers --------------------------------------------------------------------
    @shared_property
    def drv_individual(self) -> DataFrame:
        return drivers.individual_categories(self.covered_stores, self.products, self.psd_frames)

    @shared_property
    def drv_active(self) -> DataFrame:
        return materialize(drivers.active_categories(
            self.covered_stores, self.products, self.psd_frames, self.events, self.oos, self.pos_plain, self.params), self.params)

    @shared_property
    def drv_event_cats(self) -> DataFrame:
        return drivers.event_categories(self.drv_active)

    @shared_property
    def drv_store_lists(self) -> DataFrame:
        return materialize(drivers.store_category_lists(self.drv_individual, self.drv_active,
                                                        self.drv_event_cats), self.params)

    @shared_property
    def drv_chain_lists(self) -> DataFrame:
        return materialize(drivers.chain_lists(self.drv_store_lists), self.params)

    @shared_property
    def drv_matrix(self) -> DataFrame:
        """The whole matrix (P41); the mart needs its EVENTS rows only."""
        return drivers.driver_matrix(self.drv_store_lists, self.drv_chain_lists, self.drv_active, self.params)

    @shared_property
    def drv_event_facts(self) -> DataFrame:
        # The matrix is not materialised: the EVENTS filter reaches its three inputs.
        return drivers.event_facts(self.drv_matrix, self.events)

    @shared_property
    def drv_store_facts(self) -> DataFrame:
        return materialize(drivers.store_facts(
            self.drv_store_lists, self.drv_chain_lists, self.drv_active, self.drv_event_facts, self.oos,
            self.pos_plain, self.params), self.params)

    @shared_property
    def drv_chain_facts(self) -> DataFrame:
        return drivers.chain_facts(self.drv_store_facts)

    @shared_property
    def drv_store_level(self) -> DataFrame:
        return drivers.store_level(self.drv_store_facts)

    @shared_property
    def drv_chain_level(self) -> DataFrame:
        return drivers.chain_level(self.drv_store_level)

    @shared_property
    def drv_summary(self) -> DataFrame:
        return drivers.driver_summary(self.drv_store_facts, self.drv_chain_facts, self.drv_store_level,
                                      self.drv_chain_level)

    @shared_property
    def driver_rows(self) -> DataFrame:
        return drivers.driver_emit(self.drv_summary)

    # ---- mart -----------------------------------------------------------------------
    @shared_property
    def sparse_families(self) -> dict[str, DataFrame]:
        """The families that have rows where there is activity only: stage tables, read for
        their rows and for their totals."""
        return _Stages(self, {"KEY_BRAND": "key_brand_rows", "POS_WEEKLY": "pos_weekly_rows",
                              "POS_CATG_AMPS": "category_share_rows", "DRIVERS": "driver_rows"})

    def family_rows(self, family: str) -> DataFrame:
        """One family's rows. The dense families (SHP, POS) are never staged: they are computed where they are written."""
        if family == "SHP":
            return self.shipment_rows
        if family == "POS":
            return self.pos_rows
        if family == "POS_LOCATION":
            return self.location_rows
        return self.sparse_families[family]

    def family_with_stores(self, family: str) -> DataFrame:
        """One family's rows to be enriched: no row of the dense families is shuffled for it."""
        dense = {"POS": self.pos_rows_with_stores, "SHP": self.shipment_rows_with_stores}
        return dense[family]() if family in dense else self.family_rows(family)

    def family_totals(self, family: str) -> DataFrame:
        """Exact category totals of one family; those of the dense families come from their sparse inputs."""
        if family == "SHP":
            return shipment.shipment_totals(self.covered_stores, self.shipment_plan_level)
        if family == "POS":
            return pos.pos_category_totals(self.pos_sparse, self.products)
        if family == "POS_LOCATION":
            return mart.zero_totals(self.location_rows.select(F.lit(None).cast("string").alias("catg_nm")).limit(0))
        return mart.category_totals(self.sparse_families[family])

    @shared_property
    def store_attributes(self) -> DataFrame:
        return materialize(mart.store_attributes(self.spr_stores), self.params)

    def stored(self, family: str) -> DataFrame:
        """One family as the published mart stores it."""
        rows = self.family_with_stores(family)
        if family != "POS_LOCATION":
            rows = mart.drop_blank_store_rows(rows)
        return mart.stored_family(rows, self.spr_stores, self.store_attributes, self.pos_run_dt, self.params)

    @property
    def metric_families(self) -> list[str]:
        return [f for f in mart.FAMILIES if f != "POS_LOCATION"]

    @shared_property
    def empty_categories(self) -> DataFrame:
        totals = reduce(lambda a, b: a.unionByName(b), [self.family_totals(f) for f in self.metric_families])
        return materialize(mart.empty_of_totals(totals), self.params)

    @shared_property
    def mart_union(self) -> DataFrame:
        self.make_stages()
        return mart.mart_union([self.family_rows(f) for f in self.metric_families])

    @shared_property
    def mart_pruned(self) -> DataFrame:
        return mart.prune_empty_categories(self.mart_union, self.empty_categories)

    @shared_property
    def location_rows(self) -> DataFrame:
        return mart.location_rows(self.spr_stores, self.params)

    @shared_property
    def mart_enriched(self) -> DataFrame:
        self.make_stages()
        parts = [mart.enriched_family(mart.drop_blank_store_rows(self.family_with_stores(f)), self.spr_stores, self.store_attributes,
                                      self.params, self.empty_categories) for f in self.metric_families]
        parts.append(mart.enriched_family(self.location_rows, self.spr_stores, self.store_attributes, self.params))
        return reduce(lambda a, b: a.unionByName(b), parts)

    @shared_property
    def mart_final(self) -> DataFrame:
        """The whole mart in one plan: every family finished on its own, then the union."""
        self.make_stages()
        parts = [mart.finish_family(mart.drop_blank_store_rows(self.family_with_stores(f)), self.spr_stores, self.store_attributes,
                                    self.pos_run_dt, self.params, self.empty_categories) for f in self.metric_families]
        parts.append(mart.finish_family(self.location_rows, self.spr_stores, self.store_attributes, self.pos_run_dt, self.params))
        return reduce(lambda a, b: a.unionByName(b), parts)


class _Stages(dict):
    """Stage tables made when they are first asked for."""

    def __init__(self, job: MartJob, attributes: dict[str, str]):
        super().__init__()
        self.job, self.attributes = job, attributes

    def __missing__(self, family: str) -> DataFrame:
        return self.job.once(self, family, lambda: materialize(getattr(self.job, self.attributes[family]), self.job.params))
