"""Performance drivers: EVENTS, OOS and POS_PRFM at store and chain level.

The driver matrix lists, per metric, frame and store, three kinds of category
rows: every category ('(Individual)'), the categories with activity for the
metric ('(All)') and those also active for EVENTS ('(Event Categories)');
chain rows re-use store lists (or one list per chain for OOS/POS '(All)').
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscope.functions.columns import sorted_distinct_list, typed_null
from shelfscope.functions.joins import join_back
from shelfscope.functions.ranking import rank_within
from shelfscope.operators.calendar import FrameSet
from shelfscope.params import (
    CATG_ALL, CATG_EVENT, CATG_INDIVIDUAL, DRIVER_SOURCE, METRIC_EVENTS, METRIC_OOS, METRIC_POS_PRFM,
    MartParams,
)
from shelfscope.plans.stages import densify, salted_join

METRICS = (METRIC_EVENTS, METRIC_OOS, METRIC_POS_PRFM)
MATRIX_KEYS = ["metrc_nm", "tmfrm_cd", "sold_to_nbr", "chain_nbr", "catg_nm"]


def individual_categories(covered_stores: DataFrame, products: DataFrame, frames: FrameSet) -> DataFrame:
    """Covered store x category x visit frame x metric."""
    grid = densify(covered_stores.select("sold_to_nbr", "chain_nbr").distinct(),
                   products.select("catg_nm").distinct(), ["sold_to_nbr"])
    grid = frames.with_each_code(grid)
    return grid.withColumn("metrc_nm", F.explode(F.array(*[F.lit(m) for m in METRICS]))).select(*MATRIX_KEYS)


def active_categories(covered_stores: DataFrame, products: DataFrame, frames: FrameSet, events: DataFrame,
                      oos: DataFrame, pos_plain: DataFrame, params: MartParams) -> DataFrame:
    """Individual rows with activity in their metric's own facts.

    They are made from the activity keys, which meet the covered stores and the grid's
    categories and frames: the dense individual rows are not dealt to find them.
    """
    keys = ["metrc_nm", "tmfrm_cd", "sold_to_nbr", "catg_nm"]
    act = (
        events.filter(F.col("ans_in_store_val") > 0).select(F.lit(METRIC_EVENTS).alias("metrc_nm"), *keys[1:])
        .unionByName(oos.select(F.lit(METRIC_OOS).alias("metrc_nm"), *keys[1:]))
        .unionByName(pos_plain.filter(
            (F.col("corp_nm") == params.own_corp) & ((F.col("sale_val") + F.col("sale_yr_ago_val")) > 0)
        ).select(F.lit(METRIC_POS_PRFM).alias("metrc_nm"), *keys[1:]))
        .filter(F.col("tmfrm_cd").isin(*frames.codes())).distinct()
    )
    act = act.join(products.select("catg_nm"), "catg_nm", "left_semi")
    return act.join(covered_stores.select("sold_to_nbr", "chain_nbr").distinct(), "sold_to_nbr").select(*MATRIX_KEYS)


def event_categories(active: DataFrame) -> DataFrame:
    """Active rows whose (frame, store, category) is also active for EVENTS."""
    evt = active.filter(F.col("metrc_nm") == METRIC_EVENTS).select("tmfrm_cd", "sold_to_nbr", "catg_nm").distinct()
    return active.join(evt, ["tmfrm_cd", "sold_to_nbr", "catg_nm"], "left_semi")


def store_category_lists(indiv: DataFrame, active: DataFrame, events_cats: DataFrame) -> DataFrame:
    """The three category sets tagged, each row with its store's ordered distinct list.

    An individual row's list is its own category, so the dense rows take no part in
    any grouping; the active and event sets are gathered by store, a store's few rows with
    its list, and taken apart again.
    """
    keys = ["metrc_nm", "tmfrm_cd", "sold_to_nbr"]

    def listed(rows: DataFrame, label: str) -> DataFrame:
        own = rows.filter(F.col("metrc_nm").isNotNull() & F.col("tmfrm_cd").isNotNull()).groupBy(*keys).agg(
            F.collect_list(F.struct("chain_nbr", "catg_nm")).alias("_rows"))
        names = F.array_sort(F.array_distinct(F.array_compact(F.col("_rows.catg_nm"))))
        own = own.select(*keys, F.array_join(names, ", ").alias("mult_catg_nm"), F.inline("_rows"))
        return own.select(F.lit(label).alias("catg_type_cd"), *MATRIX_KEYS, "mult_catg_nm")

    own = indiv.select(F.lit(CATG_INDIVIDUAL).alias("catg_type_cd"), *MATRIX_KEYS, F.coalesce("catg_nm", F.lit("")).alias("mult_catg_nm"))
    return own.unionByName(listed(active, CATG_ALL)).unionByName(listed(events_cats, CATG_EVENT))


def chain_lists(store_lists: DataFrame) -> DataFrame:
    """The category lists of a chain: its stores' lists (distinct) for individual and
    event rows and for EVENTS '(All)'; one list per chain for OOS/POS '(All)',
    by ``groupBy`` (partial aggregation of category sets)."""
    is_all = F.col("catg_type_cd") == CATG_ALL
    per_store = store_lists.filter(~is_all | (F.col("metrc_nm") == METRIC_EVENTS)).select(
        "catg_type_cd", "metrc_nm", "tmfrm_cd", "chain_nbr", "catg_nm",
        F.col("mult_catg_nm").alias("chain_mult_catg_nm"),
    ).distinct()
    all_rows = store_lists.filter(is_all & (F.col("metrc_nm") != METRIC_EVENTS))
    lists = all_rows.groupBy("metrc_nm", "tmfrm_cd", "chain_nbr").agg(
        sorted_distinct_list("catg_nm").alias("chain_mult_catg_nm"))
    per_chain = join_back(
        all_rows.select("catg_type_cd", "metrc_nm", "tmfrm_cd", "chain_nbr", "catg_nm").distinct(),
        lists, ["metrc_nm", "tmfrm_cd", "chain_nbr"], "inner", ["chain_nbr"],
    )
    return per_store.unionByName(per_chain.select(*per_store.columns))


MATRIX_COLUMNS = ["metrc_nm", "tmfrm_cd", "sold_to_nbr", "chain_nbr", "catg_nm", "mult_catg_nm", "catg_type_cd"]
def driver_matrix(store_lists: DataFrame, lists: DataFrame, active: DataFrame, params: MartParams) -> DataFrame:
    """Store rows plus chain rows: the chain's lists on each active store row of the
    chain and category (a NULL chain never matches). One chain may hold most stores: its
    rows are dealt over as many salts as their number asks for. The mart needs only the
    EVENTS part (see ``store_facts``)."""
    chain_rows = salted_join(active, lists, ["metrc_nm", "tmfrm_cd", "chain_nbr", "catg_nm"], ["sold_to_nbr"], params)
    return (
        store_lists.select(F.lit("store").alias("store_chain_ind"), *MATRIX_COLUMNS)
        .unionByName(chain_rows.select(
            F.lit("chain").alias("store_chain_ind"), *MATRIX_COLUMNS[:5],
            F.col("chain_mult_catg_nm").alias("mult_catg_nm"), "catg_type_cd"))
    )


def _catg_key():
    return F.when(F.col("catg_type_cd") == CATG_INDIVIDUAL, F.col("catg_nm")).otherwise(F.col("catg_type_cd"))


def event_facts(matrix: DataFrame, events: DataFrame) -> DataFrame:
    """EVENTS matrix rows with each matching priority row counted once
    (a category repeated in one list matches twice; MAX de-duplicates)."""
    m = matrix.filter(F.col("metrc_nm") == METRIC_EVENTS)
    e = events.select(
        "tmfrm_cd", "catg_nm", "sold_to_nbr", F.col("chain_nbr").alias("pri_chain_nbr"),
        F.col("mult_catg_nm").alias("pri_mult_catg_nm"), "up_in_store_val", "ans_in_store_val",
        "visit_in_store_val", "true_in_store_wk_cnt")
    j = m.join(e, ["sold_to_nbr", "tmfrm_cd", "catg_nm"], "left")
    return j.groupBy(
        "metrc_nm", "tmfrm_cd", "sold_to_nbr", "chain_nbr", "store_chain_ind",
        _catg_key().alias("catg_nm"), "mult_catg_nm", "pri_chain_nbr", "pri_mult_catg_nm",
    ).agg(*[F.max(c).alias(c) for c in
            ("up_in_store_val", "ans_in_store_val", "visit_in_store_val", "true_in_store_wk_cnt")])


FACT_MEASURES = ["up_in_store_val", "rollup_ans_in_store_val", "rollup_visit_in_store_val",
                 "true_in_store_val", "true_in_store_wk_cnt", "sale_val", "sale_yr_ago_val", "sale_qty",
                 "sale_yr_ago_qty", "sale_vol_lb_val", "sale_yr_ago_vol_lb_val", "oos_alert_cnt", "visit_cnt"]
FACT_KEYS = ["metrc_nm", "tmfrm_cd", "store_chain_ind", "sold_to_nbr", "chain_nbr", "catg_nm", "mult_catg_nm"]
POS_MEASURES = ["sale_val", "sale_yr_ago_val", "sale_qty", "sale_yr_ago_qty", "sale_vol_lb_val",
                "sale_yr_ago_vol_lb_val"]


def store_facts(store_lists: DataFrame, lists: DataFrame, active: DataFrame, ev_facts: DataFrame,
                oos: DataFrame, pos_plain: DataFrame, params: MartParams) -> DataFrame:
    """EVENTS roll-up per matrix row, and OOS / POS sums per matrix row (chain rows
    of OOS and POS_PRFM are summed over the chain with the store blanked).

    The chain rows of OOS and POS_PRFM never meet single stores: the facts of the
    active stores are summed per chain and category first, and the chain's lists
    are joined to those sums.
    """
    ev = ev_facts.groupBy(*FACT_KEYS).agg(
        F.sum("up_in_store_val").alias("up_in_store_val"),
        F.sum("ans_in_store_val").alias("rollup_ans_in_store_val"),
        F.sum("visit_in_store_val").alias("rollup_visit_in_store_val"),
        F.max("true_in_store_wk_cnt").alias("true_in_store_wk_cnt"),
    ).withColumn(
        "true_in_store_val",
        F.when(F.col("rollup_ans_in_store_val").isNotNull() & F.col("rollup_visit_in_store_val").isNotNull(),
               F.greatest("rollup_ans_in_store_val", "rollup_visit_in_store_val")),
    )
    # The store comes first: dense rows that are sorted by these keys differ in its first characters.
    keys = ["sold_to_nbr", "metrc_nm", "tmfrm_cd", "catg_nm"]
    oos_k = oos.groupBy(F.lit(METRIC_OOS).alias("metrc_nm"), "tmfrm_cd", "catg_nm", "sold_to_nbr").agg(
        F.sum("oos_alert_cnt").alias("oos_alert_cnt"), F.max("visit_cnt").alias("visit_cnt"))
    pos_k = pos_plain.filter(
        (F.col("corp_nm") == params.own_corp) & ~F.col("tmfrm_cd").startswith("WEEKLY")
    ).groupBy(F.lit(METRIC_POS_PRFM).alias("metrc_nm"), "tmfrm_cd", "catg_nm", "sold_to_nbr").agg(
        *[F.sum(c).alias(c) for c in POS_MEASURES])
    sums = [*[F.sum(c).alias(c) for c in POS_MEASURES], F.sum("oos_alert_cnt").alias("oos_alert_cnt"),
            F.max("visit_cnt").alias("visit_cnt")]
    # A key is of one metric, so the dense rows are sorted and joined once for both.
    both = oos_k.unionByName(pos_k, allowMissingColumns=True)

    def with_facts(rows: DataFrame) -> DataFrame:
        return rows.filter(F.col("metrc_nm") != METRIC_EVENTS).join(both, keys, "left")

    stores = with_facts(store_lists).groupBy(
        "metrc_nm", "tmfrm_cd", F.lit("store").alias("store_chain_ind"), "sold_to_nbr", "chain_nbr",
        _catg_key().alias("_key"), "mult_catg_nm").agg(*sums)
    per_chain = with_facts(active).groupBy("metrc_nm", "tmfrm_cd", "chain_nbr", "catg_nm").agg(*sums)
    chains = lists.join(per_chain, ["metrc_nm", "tmfrm_cd", "chain_nbr", "catg_nm"]).groupBy(
        "metrc_nm", "tmfrm_cd", F.lit("chain").alias("store_chain_ind"), F.lit("").alias("sold_to_nbr"), "chain_nbr",
        _catg_key().alias("_key"), F.col("chain_mult_catg_nm").alias("mult_catg_nm")).agg(*sums)
    other = stores.unionByName(chains).withColumnRenamed("_key", "catg_nm")
    return (
        ev.select(*FACT_KEYS, *[(F.col(c) if c in ev.columns else F.lit(None)).cast("double").alias(c)
                                for c in FACT_MEASURES])
        .unionByName(other.select(*FACT_KEYS, *[
            (F.col(c) if c in other.columns else F.lit(None)).cast("double").alias(c) for c in FACT_MEASURES]))
    )


CHAIN_COLUMNS = ["chain_up_in_store_val", "chain_ans_in_store_val", "chain_true_in_store_val",
                 "chain_sale_val", "chain_sale_yr_ago_val", "chain_sale_qty", "chain_sale_yr_ago_qty",
                 "chain_sale_vol_lb_val", "chain_sale_yr_ago_vol_lb_val", "chain_oos_alert_cnt"]


def chain_facts(facts: DataFrame) -> DataFrame:
    """EVENTS chain rows summed over their stores; OOS/POS chain rows as they are."""
    chain = facts.filter(F.col("store_chain_ind") == "chain")
    keys = ["metrc_nm", "tmfrm_cd", "chain_nbr", "catg_nm", "mult_catg_nm"]
    ev = chain.filter(F.col("metrc_nm") == METRIC_EVENTS).groupBy(*keys).agg(
        F.sum("up_in_store_val").alias("chain_up_in_store_val"),
        F.sum("rollup_ans_in_store_val").alias("chain_ans_in_store_val"),
        F.sum("true_in_store_val").alias("chain_true_in_store_val"),
    )
    other = chain.filter(F.col("metrc_nm") != METRIC_EVENTS).select(
        *keys, *[F.col(m).alias(f"chain_{m}") for m in POS_MEASURES],
        F.col("oos_alert_cnt").alias("chain_oos_alert_cnt"))

    def full(df):
        return df.select(*keys, *[(F.col(c) if c in df.columns else F.lit(None)).cast("double").alias(c)
                                  for c in CHAIN_COLUMNS])

    return full(ev).unionByName(full(other))


def store_level(facts: DataFrame) -> DataFrame:
    """The '(All)' store rows with each metric's criterion and the driver rank in
    the chain (best execution / fewest alerts / highest growth = 1, NULL last),
    computed by ``rank_within`` so a large chain is not ranked in one task."""
    s = facts.filter((F.col("catg_nm") == CATG_ALL) & (F.col("store_chain_ind") == "store")).select(
        "metrc_nm", "tmfrm_cd", "sold_to_nbr", "chain_nbr",
        F.col("sale_val").alias("store_sale_val"), F.col("sale_yr_ago_val").alias("store_sale_yr_ago_val"),
        F.col("oos_alert_cnt").alias("store_oos_alert_cnt"), F.col("visit_cnt").alias("store_visit_cnt"),
        F.col("up_in_store_val").alias("store_up_in_store_val"),
        F.col("true_in_store_val").alias("store_true_in_store_val"),
        F.col("true_in_store_wk_cnt").alias("store_true_in_store_wk_cnt"),
    )
    true_v, up = F.col("store_true_in_store_val"), F.col("store_up_in_store_val")
    visits, alerts = F.col("store_visit_cnt"), F.col("store_oos_alert_cnt")
    cur, ya = F.col("store_sale_val"), F.col("store_sale_yr_ago_val")
    s = s.select(
        "*",
        F.when(F.coalesce(true_v, F.lit(0.0)) == 0, F.lit(0.0)).otherwise(F.lit(-1.0) * up / true_v)
        .alias("events_rank_critra"),
        F.when(F.coalesce(visits, F.lit(0.0)) == 0, F.lit(0.0)).otherwise(F.lit(1.0) * alerts / visits)
        .alias("oos_rank_critra"),
        F.when(ya == 0, F.lit(0.0)).otherwise(F.lit(-100.0) * (cur - ya) / ya).alias("pos_rank_critra"),
    )
    metric = F.col("metrc_nm")
    crit = (F.when(metric == METRIC_EVENTS, F.col("events_rank_critra"))
            .when(metric == METRIC_OOS, F.coalesce(F.col("oos_rank_critra"), F.lit(0.0)))
            .when(metric == METRIC_POS_PRFM, F.col("pos_rank_critra")))
    return rank_within(s, ["metrc_nm", "tmfrm_cd", "chain_nbr"], crit, "prfmnc_drvr_rank",
                       descending=False, nulls_first=False)


def chain_level(store_lvl: DataFrame) -> DataFrame:
    """Distinct stores, visits and true weeks per metric, frame and chain."""
    return store_lvl.groupBy("metrc_nm", "tmfrm_cd", "chain_nbr").agg(
        F.countDistinct("sold_to_nbr").cast("bigint").alias("chain_store_cnt"),
        F.sum("store_visit_cnt").alias("chain_visit_cnt"),
        F.sum("store_true_in_store_wk_cnt").alias("chain_true_in_store_wk_cnt"),
    )


def driver_summary(facts: DataFrame, chain_f: DataFrame, store_lvl: DataFrame,
                   chain_lvl: DataFrame) -> DataFrame:
    """Store rows with chain category facts, store and chain driver facts.

    A chain row for '(Event Categories)' or any EVENTS row must carry the same
    category list as the store row; unmatched store rows stay.
    """
    # Rows that must agree on the list meet on its id: a chain's stores never meet its other lists.
    must_match = (F.col("catg_nm") == CATG_EVENT) | (F.col("metrc_nm") == METRIC_EVENTS)
    list_id = F.when(must_match, F.xxhash64("mult_catg_nm")).otherwise(F.lit(0).cast("bigint"))
    keys = ["metrc_nm", "tmfrm_cd", "chain_nbr", "catg_nm"]
    s = facts.filter(F.col("store_chain_ind") == "store").withColumn("_list", list_id)
    c = chain_f.withColumn("_list", list_id).withColumnRenamed("mult_catg_nm", "_chn_mult").withColumn("_chn", F.lit(True))
    has = chain_f.filter(must_match).select(*keys).distinct().withColumn("_has", F.lit(True))
    j = s.join(c, [*keys, "_list"], "left").join(has, keys, "left")
    same = F.col("_chn").isNotNull() & (F.col("_chn_mult") == F.col("mult_catg_nm"))
    j = j.filter(F.col("_has").isNull() | same).drop("_list", "_has")
    j = j.join(store_lvl, ["sold_to_nbr", "metrc_nm", "tmfrm_cd", "chain_nbr"], "left")
    j = j.join(chain_lvl, ["metrc_nm", "tmfrm_cd", "chain_nbr"], "left")
    return j.drop("_chn", "_chn_mult").withColumn("ans_in_store_val", F.col("rollup_ans_in_store_val"))


def driver_emit(summary: DataFrame) -> DataFrame:
    """EVENTS / OOS / POS_PRFM mart rows."""
    return summary.select(
        "metrc_nm", "tmfrm_cd", "sold_to_nbr", "chain_nbr", "catg_nm", "mult_catg_nm",
        "up_in_store_val", "ans_in_store_val", "true_in_store_val",
        F.col("store_true_in_store_wk_cnt").alias("true_in_store_wk_cnt"),
        "chain_up_in_store_val", "chain_ans_in_store_val", "chain_true_in_store_val",
        "chain_true_in_store_wk_cnt", "sale_val", "sale_yr_ago_val", "sale_qty", "sale_yr_ago_qty",
        "chain_sale_val", "chain_sale_yr_ago_val", "chain_sale_qty", "chain_sale_yr_ago_qty",
        "oos_alert_cnt", F.col("store_visit_cnt").alias("visit_cnt"), "chain_oos_alert_cnt",
        "chain_visit_cnt", "chain_store_cnt", "prfmnc_drvr_rank",
        F.lit(DRIVER_SOURCE).alias("src_nm"), typed_null("timestamp_ntz").alias("kortex_upld_ts"),
        typed_null("timestamp_ntz").alias("kortex_dprct_ts"),
    )
