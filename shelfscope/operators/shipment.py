"""Shipment (gross sales value) family: P09-P14 and the SHP mart rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscope.functions.columns import not_in_upper, not_like_upper
from shelfscope.operators.calendar import FrameSet
from shelfscope.operators.mart import STORE_STRUCT, with_store_struct
from shelfscope.params import (
    BLOCKED_CHANNELS, EXCLUDED_CATG_CODES, SALES_ORG, SHIPMENT_INACTIVE_PATTERN, WIP_CODE,
    YEAR_AGO_DAYS, MartParams,
)
from shelfscope.plans.stages import densify, grid_partitions, salted_join

KEYS = ["plan_to_nbr", "catg_nm", "brand_nm", "tmfrm_cd"]
#: Stores of a plan-to that share a salt: each becomes hundreds of rows, so a salt's rows are some hundred thousand.
STORES_PER_SALT = 256


def material_hierarchy(prod_matrl: DataFrame) -> DataFrame:
    """Distinct material -> (category, brand); no upper-casing of the WIP code here."""
    return prod_matrl.filter(
        ((F.col("spin_ind") == 1) | (F.col("klnva_retn_brand_ind") == 1))
        & (F.col("comrcl_catg_cd") != WIP_CODE)
        & ~F.col("catg_cd").isin(*EXCLUDED_CATG_CODES)
        & F.col("brand_nm").isNotNull()
    ).select("matrl_nbr", "catg_nm", "brand_nm").distinct()


def customer_hierarchy(cust_pivot: DataFrame) -> DataFrame:
    """P10: sold-to -> plan-to/chain with NULL keys as ''; only '%INACTIVE%' names are dropped."""
    return cust_pivot.filter(
        (F.col("sales_org_cd") == SALES_ORG)
        & not_in_upper("hier_d_sales_mgmt_a_nm", BLOCKED_CHANNELS)
        & not_like_upper("plan_to_nm", SHIPMENT_INACTIVE_PATTERN)
        & not_like_upper("sold_to_nm", SHIPMENT_INACTIVE_PATTERN)
    ).select(
        F.coalesce("sold_to_nbr", F.lit("")).alias("sold_to_nbr"),
        F.coalesce("plan_to_nbr", F.lit("")).alias("plan_to_nbr"),
        F.coalesce("chain_nbr", F.lit("")).alias("chain_nbr"),
        "chain_nm",
    ).distinct()


def fiscal_weeks(cal_wk: DataFrame, frames: FrameSet) -> tuple[DataFrame, list[tuple[int, int]]]:
    """Weeks from the earliest frame start less 52 weeks to the latest frame end, and their fiscal years and weeks."""
    lo, hi = frames.date_bounds()
    weeks = cal_wk.select(
        F.col("fisc_yr").alias("_yr"), F.col("fisc_wk").alias("_wk"), "fisc_yr_wk", "fisc_wk_end_dt")
    if lo is not None and hi is not None:
        weeks = weeks.filter(F.col("fisc_wk_end_dt").between(
            F.lit(lo - dt.timedelta(days=YEAR_AGO_DAYS)), F.lit(hi)))
    else:
        weeks = weeks.filter(F.lit(False))
    return weeks, sorted((int(r["_yr"]), int(r["_wk"])) for r in weeks.select("_yr", "_wk").distinct().dropna().collect())


def week_rollup(shipments: DataFrame) -> DataFrame:
    """Shipments by fiscal week, store, material and source.

    It depends on the fact alone (no frame, no hierarchy), so a week's roll-up holds
    until the week's fact rows change. Decimal values are summed exactly.
    """
    return shipments.filter(F.col("sales_org_cd") == SALES_ORG).groupBy(
        "sales_org_cd", F.col("fisc_yr").cast("int").alias("fisc_yr"), F.col("fisc_wk").cast("int").alias("fisc_wk"),
        "sold_to_nbr", "matrl_nbr", "src_nm",
    ).agg(
        F.sum("dir_indir_gsv").alias("dir_indir_gsv"),
        F.max("kortex_upld_ts").alias("kortex_upld_ts"),
        F.max("kortex_dprct_ts").alias("kortex_dprct_ts"),
    )


def shipment_detail(shipments: DataFrame, cal_wk: DataFrame, cust_hier: DataFrame,
                    matrl_hier: DataFrame, frames: FrameSet) -> DataFrame:
    """Shipment lines with fiscal week, plan-to and product, within
    [earliest frame start - 52 weeks, latest frame end].  The bounds are literals
    applied to the week dimension before the join.

    ``shipments`` is the fact or its kept week roll-ups."""
    weeks, held = fiscal_weeks(cal_wk, frames)
    s = shipments.filter(F.col("sales_org_cd") == SALES_ORG)
    # The fiscal years and weeks of the range (as many as it has) as literal filters on the
    # fact, so a fact partitioned by them is pruned; the join stays the exact test.
    year, week = F.col("fisc_yr").cast("int"), F.col("fisc_wk").cast("int")
    s = s.filter(year.isin(sorted({y for y, _ in held})) & (year * 100 + week).isin(sorted({y * 100 + w for y, w in held})))
    j = (
        s.join(weeks, (F.col("fisc_yr").cast("int") == F.col("_yr"))
               & (F.col("fisc_wk").cast("int") == F.col("_wk")))
        .join(cust_hier.select("sold_to_nbr", "plan_to_nbr"), "sold_to_nbr")
        .join(matrl_hier, "matrl_nbr")
    )
    return j.select("plan_to_nbr", "catg_nm", "brand_nm", "fisc_yr_wk", "fisc_wk_end_dt",
                    "dir_indir_gsv", "src_nm", "kortex_upld_ts", "kortex_dprct_ts")


def shipment_current(detail: DataFrame, frames: FrameSet) -> DataFrame:
    """Value per frame (a week counts in every frame that holds it)."""
    return frames.by_week(detail, "fisc_yr_wk").groupBy(
        "tmfrm_cd", "plan_to_nbr", "catg_nm", "brand_nm", "src_nm"
    ).agg(
        F.sum("dir_indir_gsv").alias("gsv"),
        F.max("kortex_upld_ts").alias("kortex_upld_ts"),
        F.max("kortex_dprct_ts").alias("kortex_dprct_ts"),
    )


def shipment_year_ago(detail: DataFrame, frames: FrameSet, params: MartParams) -> DataFrame:
    """Value in the frame shifted back 364 days.

    Grouped by source but the source is not kept (one row per source, as in the
    original), unless ``params.merge_sources`` asks for one row per key.
    """
    framed = frames.by_year_ago_date(detail, "fisc_wk_end_dt")
    group = KEYS if params.merge_sources else [*KEYS, "src_nm"]
    return framed.groupBy(*group).agg(F.sum("dir_indir_gsv").alias("gsv_yr_ago")).select(
        *KEYS, "gsv_yr_ago")


def shipment_plan_level(covered_stores: DataFrame, matrl_hier: DataFrame, current: DataFrame,
                        year_ago: DataFrame, frames: FrameSet) -> DataFrame:
    """P14 at plan-to level: covered plan-tos x (category, brand) x frames seen in the current
    roll-up, with current and year-ago value (NULL when absent)."""
    plan_tos = covered_stores.select("plan_to_nbr").distinct()
    pairs = matrl_hier.select("catg_nm", "brand_nm").distinct()
    seen = current.select("tmfrm_cd").distinct()
    grid = frames.with_each_code(densify(plan_tos, pairs, ["plan_to_nbr"])).join(seen, "tmfrm_cd", "left_semi")
    cur = current.select(*KEYS, "gsv", F.col("src_nm").alias("_cur_src"), "kortex_upld_ts",
                         "kortex_dprct_ts")
    return grid.join(cur, KEYS, "left").join(year_ago, KEYS, "left")


def shipment_summary(covered_stores: DataFrame, plan_level: DataFrame, params: MartParams, attrs: DataFrame | None = None) -> DataFrame:
    """Every covered store with the rows of its plan-to (value 0 when absent).

    With ``attrs`` (one row a store) the store rows get their attributes as ``STORE_STRUCT``
    before they are multiplied, so that no row of the summary need meet them.

    A plan-to may hold most stores: its stores are dealt over as many salts as its
    own number of stores asks for, and its rows are repeated for each.
    """
    stores = covered_stores.select("sold_to_nbr", "plan_to_nbr", "chain_nbr", "src_nm")
    if attrs is not None:
        stores = with_store_struct(stores, attrs)
    # A fixed number of parts: the few store rows of a small input must not meet in one task before they multiply.
    parts = grid_partitions(stores.sparkSession)
    return salted_join(stores, plan_level, ["plan_to_nbr"], ["sold_to_nbr"], params, STORES_PER_SALT, parts).select(
        "sold_to_nbr", "plan_to_nbr", "chain_nbr", "tmfrm_cd", "catg_nm", "brand_nm",
        F.coalesce("gsv", F.lit(0)).alias("gsv"),
        F.coalesce("gsv_yr_ago", F.lit(0)).alias("gsv_yr_ago"),
        F.coalesce("_cur_src", "src_nm").alias("src_nm"),
        "kortex_upld_ts", "kortex_dprct_ts", *[c for c in stores.columns if c == STORE_STRUCT],
    )


def shipment_totals(covered_stores: DataFrame, plan_level: DataFrame) -> DataFrame:
    """The SHP family's category totals without its store rows: a plan-to's values times its store rows."""
    stores = covered_stores.groupBy("plan_to_nbr").agg(F.count(F.lit(1)).alias("_n"))
    value = F.col("gsv").cast("double").cast("decimal(28,6)") * F.col("_n").cast("decimal(10,0)")
    sums = plan_level.join(stores, "plan_to_nbr").groupBy("catg_nm").agg(F.coalesce(F.sum(value), F.lit(0)).cast("decimal(38,6)").alias("_v"))
    return sums.select("catg_nm", "_v", *[F.lit(0).cast("decimal(38,6)").alias(t) for t in ("_t", "_o")])


def shipment_emit(summary: DataFrame) -> DataFrame:
    return summary.select(
        F.lit("SHP").alias("metrc_nm"), "tmfrm_cd", "sold_to_nbr", "plan_to_nbr", "chain_nbr",
        "catg_nm", "brand_nm", F.col("gsv").alias("sale_val"),
        F.col("gsv_yr_ago").alias("sale_yr_ago_val"), "src_nm", "kortex_upld_ts", "kortex_dprct_ts",
        *[c for c in summary.columns if c == STORE_STRUCT],
    )
