"""Store-visit family: audits, out-of-stock summary and priority answers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfscope.functions.columns import not_in_upper, not_like_upper
from shelfscope.operators.calendar import FrameSet
from shelfscope.sources.tables import VISIT_DAY
from shelfscope.sources.schemas import TS
from shelfscope.params import (
    EXCLUDED_CATG_CODES, OOS_ALERT_VALUES, PRIORITY_BLOCKED, PRIORITY_BLOCKED_PATTERN,
    PRIORITY_SOURCE,
)

AUDIT_COLUMNS = [
    "visit_guid", "sold_to_nbr", "chain_nbr", "actl_start_dt_time", "actn_desc",
    "orchestro_item_alert_val", "rep_item_alert_val", "oos_alert_ind", "prod_pack_extrnl_nbr",
    "prod_pack_gtin", "catg_nm", "fisc_yr_wk", "fisc_wk_end_dt", "src_nm", "kortex_upld_ts",
    "kortex_dprct_ts",
]


def visit_audit_detail(audit: DataFrame, cal_day: DataFrame, prod_matrl: DataFrame,
                       covered_stores: DataFrame, frames: FrameSet) -> DataFrame:
    """Audit rows of covered stores within the visit frames' weeks, with category
    (material number left-padded to 18) and the out-of-stock alert flag.

    Product and store rows are joined as listed (duplicates fan out, as in the
    original); the week bounds are literals applied to the calendar side.
    """
    lo, hi = frames.week_bounds()
    cal = cal_day.select(F.col("fisc_dt").alias("_day"), "fisc_yr_wk", "fisc_wk_end_dt")
    cal = cal.filter(F.col("fisc_yr_wk").between(F.lit(lo), F.lit(hi))) if lo else cal.filter(F.lit(False))
    products = prod_matrl.filter(
        ((F.col("spin_ind") == 1) | (F.col("klnva_retn_brand_ind") == 1))
        & ~F.col("catg_cd").isin(*EXCLUDED_CATG_CODES)
    ).select(F.col("matrl_nbr").alias("_matrl"), "catg_nm")
    # The exact day range of those weeks, as a timestamp range the audit scan can use.
    span = cal.agg(F.min("_day").alias("lo"), F.max("_day").alias("hi")).first()
    if span["lo"] is not None:
        t = F.col("actl_start_dt_time")
        audit = audit.filter((t >= F.lit(span["lo"]).cast(TS))
                             & (t < F.lit(span["hi"] + dt.timedelta(days=1)).cast(TS)))
        if VISIT_DAY in audit.columns:  # a fact laid out by day: only these days' partitions are opened
            audit = audit.filter(F.col(VISIT_DAY).between(F.lit(span["lo"]), F.lit(span["hi"])))
    a = audit.withColumn("_day", F.to_date("actl_start_dt_time")).withColumn(
        "_matrl", F.lpad("prod_pack_extrnl_nbr", 18, "0"))
    j = (
        a.join(cal, "_day").join(products, "_matrl")
        .join(covered_stores.select("sold_to_nbr", "chain_nbr"), "sold_to_nbr")
    )
    alert = F.col("orchestro_item_alert_val").isin(*OOS_ALERT_VALUES) | (F.col("rep_item_alert_val") == 1)
    return j.select(
        "visit_guid", "sold_to_nbr", "chain_nbr", "actl_start_dt_time", "actn_desc",
        "orchestro_item_alert_val", "rep_item_alert_val", F.when(alert, F.lit(1)).alias("oos_alert_ind"),
        "prod_pack_extrnl_nbr", "prod_pack_gtin", "catg_nm", "fisc_yr_wk", "fisc_wk_end_dt",
        F.lower("src_nm").alias("src_nm"), "kortex_upld_ts", "kortex_dprct_ts",
    )


def with_visit_rank(detail: DataFrame) -> DataFrame:
    """The visit rank per store-week (earliest visit = 1, NULL times last)."""
    w = Window.partitionBy("sold_to_nbr", "fisc_yr_wk").orderBy(F.col("actl_start_dt_time").asc_nulls_last())
    return detail.withColumn("visit_rank", F.rank().over(w).cast("bigint"))


def latest_visits(detail: DataFrame) -> DataFrame:
    """Distinct visits ranked 1 in their store-week (the earliest; ties kept).

    Computed as a ``min`` per store-week joined back, which aggregates map-side,
    instead of ranking every audit row of a store-week in one task.
    """
    first = detail.groupBy("sold_to_nbr", "fisc_yr_wk").agg(F.min("actl_start_dt_time").alias("_first"))
    t = F.col("actl_start_dt_time")
    return detail.join(first, ["sold_to_nbr", "fisc_yr_wk"]).filter(
        (t == F.col("_first")) | (F.col("_first").isNull() & t.isNull())
    ).select("visit_guid", "sold_to_nbr", "fisc_yr_wk").distinct()


def oos_summary(detail: DataFrame, frames: FrameSet) -> DataFrame:
    """Alert count per store, category and frame; distinct visits per store and frame."""
    framed = frames.by_week(detail, "fisc_yr_wk")
    visits = framed.groupBy("sold_to_nbr", "tmfrm_cd").agg(F.countDistinct("visit_guid").alias("visit_cnt"))
    alerts = framed.groupBy("sold_to_nbr", "chain_nbr", "catg_nm", "tmfrm_cd", "src_nm").agg(
        F.sum("oos_alert_ind").cast("bigint").alias("oos_alert_cnt"),
        F.max("kortex_upld_ts").alias("kortex_upld_ts"),
        F.max("kortex_dprct_ts").alias("kortex_dprct_ts"),
    )
    return alerts.join(visits, ["sold_to_nbr", "tmfrm_cd"]).select(
        "sold_to_nbr", "chain_nbr", "catg_nm", "tmfrm_cd", "oos_alert_cnt", "visit_cnt", "src_nm",
        "kortex_upld_ts", "kortex_dprct_ts",
    )


def priority_latest(priority: DataFrame, latest: DataFrame, frames: FrameSet,
                    covered_stores: DataFrame) -> DataFrame:
    """Answers given on a store's latest visits, per visit frame; for each store and
    answer week only the rows of the latest visit week are kept (ties kept)."""
    pri = priority.filter(
        (F.col("src_nm") == PRIORITY_SOURCE)
        & not_in_upper("mult_catg_nm", PRIORITY_BLOCKED)
        & not_like_upper("mult_catg_nm", PRIORITY_BLOCKED_PATTERN)
    ).select("visit_guid", "sold_to_nbr", "mult_catg_nm", F.col("fisc_yr_wk").alias("actl_yr_wk"),
             "priorty_nbr", "up_in_store_ind")
    j = pri.join(latest.withColumnRenamed("fisc_yr_wk", "vst_yr_wk"), ["visit_guid", "sold_to_nbr"])
    j = frames.by_week(j, "actl_yr_wk")
    j = j.join(covered_stores.select("sold_to_nbr", "chain_nbr"), "sold_to_nbr")
    # rank() over (store, answer week) by visit week DESC NULLS FIRST, keep rank 1
    top = j.groupBy("sold_to_nbr", "actl_yr_wk").agg(
        F.max("vst_yr_wk").alias("_top"), F.max(F.col("vst_yr_wk").isNull().cast("int")).alias("_any_null"))
    v = F.col("vst_yr_wk")
    kept = j.join(top, ["sold_to_nbr", "actl_yr_wk"]).filter(
        F.when(F.col("_any_null") == 1, v.isNull()).otherwise(v == F.col("_top")))
    return kept.select("visit_guid", "sold_to_nbr", "chain_nbr", "mult_catg_nm", "actl_yr_wk",
                       "priorty_nbr", "up_in_store_ind", F.col("vst_yr_wk").alias("fisc_yr_wk"), "tmfrm_cd")


WEEK_COLUMNS = ["wk_type_cd", "visit_guid", "sold_to_nbr", "chain_nbr", "mult_catg_nm", "actl_yr_wk",
                "priorty_nbr", "up_in_store_ind", "tmfrm_cd"]


def priority_weeks(visit_priority: DataFrame, latest: DataFrame) -> DataFrame:
    """Answers tagged 'visit_weeks' (one row per latest visit in the answer week) and
    'ans_weeks' (store-weeks whose answers sum to more than 0)."""
    visit_weeks = visit_priority.join(
        latest.select("sold_to_nbr", F.col("fisc_yr_wk").alias("actl_yr_wk")), ["sold_to_nbr", "actl_yr_wk"]
    ).withColumn("wk_type_cd", F.lit("visit_weeks"))
    answered = visit_priority.groupBy("sold_to_nbr", "actl_yr_wk").agg(
        F.sum("up_in_store_ind").alias("_up")).filter(F.col("_up") > 0).drop("_up")
    ans_weeks = visit_priority.join(answered, ["sold_to_nbr", "actl_yr_wk"]).withColumn(
        "wk_type_cd", F.lit("ans_weeks"))
    return visit_weeks.select(*WEEK_COLUMNS).unionByName(ans_weeks.select(*WEEK_COLUMNS))


def priority_rollup(weeks: DataFrame) -> DataFrame:
    """Per frame, store, chain and category list: answers and visit rows, plus the
    store's answered / visited week counts (the greater is the 'true' week count).

    ``(tmfrm_cd, sold_to_nbr, chain_nbr, mult_catg_nm)`` is unique here and serves
    as the row identity the original numbered with an unordered row number.
    """
    ans = F.col("wk_type_cd") == "ans_weeks"
    vis = F.col("wk_type_cd") == "visit_weeks"
    per_list = weeks.groupBy("tmfrm_cd", "sold_to_nbr", "chain_nbr", "mult_catg_nm").agg(
        F.sum(F.when(ans, F.col("up_in_store_ind"))).cast("bigint").alias("up_in_store_val"),
        F.sum(F.when(ans, F.lit(1))).cast("bigint").alias("ans_in_store_val"),
        F.sum(F.when(vis, F.lit(1))).cast("bigint").alias("visit_in_store_val"),
    )
    per_store = weeks.groupBy("tmfrm_cd", "sold_to_nbr").agg(
        F.countDistinct(F.when(ans, F.col("actl_yr_wk"))).alias("ans_wk_cnt"),
        F.countDistinct(F.when(vis, F.col("actl_yr_wk"))).alias("visit_wk_cnt"),
    ).withColumn(
        "true_in_store_wk_cnt",
        F.when(F.col("ans_wk_cnt").isNotNull() & F.col("visit_wk_cnt").isNotNull(),
               F.greatest("ans_wk_cnt", "visit_wk_cnt")),
    )
    return per_list.join(per_store, ["tmfrm_cd", "sold_to_nbr"])


def events_split(rollup: DataFrame, max_parts: int | None = 7) -> DataFrame:
    """One row per category of the list: the first ``max_parts`` comma parts (the
    original's rule; None takes all), trimmed; blank and block-listed parts dropped
    (a repeated category repeats the row)."""
    parts = F.split(F.col("mult_catg_nm"), ",")
    if max_parts is not None:
        parts = F.slice(parts, 1, max_parts)
    exploded = rollup.select("*", F.posexplode(parts).alias("_pos", "_part"))
    catg = F.trim(F.col("_part"))
    return exploded.select(
        *rollup.columns, (F.col("_pos") + 1).cast("bigint").alias("part_nbr"), catg.alias("catg_nm")
    ).filter(
        F.col("catg_nm").isNotNull() & (F.col("catg_nm") != "")
        & not_in_upper("catg_nm", PRIORITY_BLOCKED) & not_like_upper("catg_nm", PRIORITY_BLOCKED_PATTERN)
    )
