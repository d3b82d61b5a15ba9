"""KEY_BRAND family: brand ranking and share within store and chain."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfscope.functions.columns import money, share_or_zero, typed_null
from shelfscope.functions.joins import join_back
from shelfscope.operators.calendar import FrameSet
from shelfscope.params import HIER_COVERED, HIER_NON_COVERED, MartParams
from shelfscope.plans.stages import densify, materialize

MEASURES = ["sale_val", "sale_yr_ago_val", "sale_qty", "sale_yr_ago_qty"]
BASE_COLUMNS = ["type_cd", "sold_to_nbr", "chain_nbr", "catg_nm", "brand_nm", "corp_nm", "tmfrm_cd",
                *MEASURES, "src_nm", "kortex_upld_ts", "kortex_dprct_ts"]


def key_brand_base(spr_stores: DataFrame, products: DataFrame, frames: FrameSet,
                   pos_ic: DataFrame, params: MartParams) -> DataFrame:
    """Own POS per non-covered store x IC category x brand ('Brands' rows) and per
    store x IC category ('Categories' rows, brand 'KEY') for each rolling frame.

    The original densifies store x product x frame, left-joins POS and filters
    after the join.  Equivalent result without the dense grid for brands:
    * a brand row exists only where own POS exists for that brand (brand rows
      without a match fail the post-join filter), so brand rows come from the
      POS side joined to the stores and the grid's (IC category, brand) pairs;
    * a 'KEY' row is dropped exactly when its (store, IC category, frame) has POS
      rows but none of them is own; otherwise it carries the own totals (0 if none).
    """
    stores = spr_stores.filter(F.col("hier_type_cd") == HIER_NON_COVERED).select(
        "sold_to_nbr", "chain_nbr", "src_nm").distinct()
    rolling = pos_ic.filter(F.col("tmfrm_cd").isin(*frames.codes()))
    kept = (F.col("corp_nm") == params.own_corp) | F.col("corp_nm").isNull()

    def own_sum(m: str):
        return F.sum(F.when(kept, F.col(m))).alias(m)

    ts = [F.max(F.when(kept, F.col(c))).alias(c) for c in ("kortex_upld_ts", "kortex_dprct_ts")]

    brand_pos = rolling.filter(kept).groupBy("sold_to_nbr", "ic_catg_nm", "brand_nm", "tmfrm_cd").agg(
        *[F.sum(m).alias(m) for m in MEASURES],
        *[F.max(c).alias(c) for c in ("kortex_upld_ts", "kortex_dprct_ts")])
    brands = (
        brand_pos.join(products.select("ic_catg_nm", "brand_nm").distinct(), ["ic_catg_nm", "brand_nm"],
                       "left_semi")
        .join(stores, "sold_to_nbr")
        .withColumn("type_cd", F.lit("Brands"))
    )

    status = rolling.groupBy("sold_to_nbr", "ic_catg_nm", "tmfrm_cd").agg(
        *[own_sum(m) for m in MEASURES], *ts,
        F.max(kept.cast("int")).alias("_has_kept"),
    )
    key_grid = frames.with_each_code(
        densify(stores, products.select("ic_catg_nm").distinct(), ["sold_to_nbr"]))
    keys = key_grid.join(status, ["sold_to_nbr", "ic_catg_nm", "tmfrm_cd"], "left").filter(
        F.col("_has_kept").isNull() | (F.col("_has_kept") == 1)
    ).withColumn("brand_nm", F.lit("KEY")).withColumn("type_cd", F.lit("Categories"))

    cols = [
        "type_cd", "sold_to_nbr", "chain_nbr", F.col("ic_catg_nm").alias("catg_nm"), "brand_nm",
        F.lit(params.own_corp).alias("corp_nm"), "tmfrm_cd",
        *[F.coalesce(F.col(m), F.lit(0)).alias(m) for m in MEASURES],
        "src_nm", "kortex_upld_ts", "kortex_dprct_ts",
    ]
    return brands.select(*cols).unionByName(keys.select(*cols))


def _catg_key():
    return F.when(F.col("type_cd") == "Brands", F.col("catg_nm"))


METRIC_COLUMNS = [
    "brand_sale_rank", "store_sale_val", "store_sale_qty", "chain_brand_sale_val",
    "chain_brand_sale_yr_ago_val", "sale_val_share_pct", "sale_vs_yr_ago_val",
    "sale_vs_yr_ago_val_pct", "sale_qty_share_pct", "sale_vs_yr_ago_qty", "sale_vs_yr_ago_qty_pct",
    "actl_store_sale_val", "actl_store_sale_yr_ago_val", "actl_store_sale_qty",
    "actl_store_sale_yr_ago_qty",
]


def key_brand_metrics(base: DataFrame, params: MartParams) -> DataFrame:
    """Brand row number and share within the store, growth, chain brand totals and
    the store's actual category totals.

    Store windows are bounded by the product dimension; chain brand totals come
    from a ``groupBy`` joined back (NULL chains match, as in a window partition).
    """
    b = base.withColumn("_ck", _catg_key())
    w = Window.partitionBy("type_cd", "sold_to_nbr", "_ck", "tmfrm_cd")
    order = [F.col("sale_val").desc(), F.col("sale_yr_ago_val").desc(), F.col("catg_nm").asc_nulls_first(),
             F.col("brand_nm").asc_nulls_first(), F.col("chain_nbr").asc_nulls_first(),
             F.col("src_nm").asc_nulls_first()]
    b = b.select(
        "*",
        F.row_number().over(w.orderBy(*order)).cast("bigint").alias("brand_sale_rank"),
        F.sum("sale_val").over(w).alias("store_sale_val"),
        F.sum("sale_qty").over(w).alias("store_sale_qty"),
    )
    chain_keys = ["type_cd", "chain_nbr", "brand_nm", "tmfrm_cd"]
    chain_tot = b.groupBy(*chain_keys).agg(
        F.sum("sale_val").alias("chain_brand_sale_val"),
        F.sum("sale_yr_ago_val").alias("chain_brand_sale_yr_ago_val"))
    b = join_back(b, materialize(chain_tot, params), chain_keys, "left", ["chain_nbr"])
    actual = base.filter(F.col("type_cd") == "Categories").groupBy("sold_to_nbr", "tmfrm_cd").agg(
        *[F.sum(m).alias(f"actl_store_{m}") for m in MEASURES])
    b = b.join(actual, ["sold_to_nbr", "tmfrm_cd"], "left")
    vs_val = F.col("sale_val") - F.col("sale_yr_ago_val")
    vs_qty = F.col("sale_qty") - F.col("sale_yr_ago_qty")
    return b.select(
        *BASE_COLUMNS, "_ck", "brand_sale_rank", "store_sale_val", "store_sale_qty",
        "chain_brand_sale_val", "chain_brand_sale_yr_ago_val",
        share_or_zero(money("sale_val"), money("store_sale_val")).alias("sale_val_share_pct"),
        vs_val.alias("sale_vs_yr_ago_val"),
        share_or_zero(money(vs_val), money("sale_yr_ago_val")).alias("sale_vs_yr_ago_val_pct"),
        share_or_zero(money("sale_qty"), money("store_sale_qty")).alias("sale_qty_share_pct"),
        vs_qty.alias("sale_vs_yr_ago_qty"),
        share_or_zero(money(vs_qty), money("sale_yr_ago_qty")).alias("sale_vs_yr_ago_qty_pct"),
        *[f"actl_store_{m}" for m in MEASURES],
    )


def key_brand_chain_rank(metrics: DataFrame, params: MartParams) -> DataFrame:
    """Dense rank of chain brand totals within (type, chain, category if brands, frame).

    Ranked on the distinct chain-level values (dense rank depends only on them),
    then joined back; a chain's store count never enters one window task.
    """
    part = ["type_cd", "chain_nbr", "_ck", "tmfrm_cd"]
    values = metrics.select(*part, "brand_nm", "chain_brand_sale_val", "chain_brand_sale_yr_ago_val").distinct()
    w = Window.partitionBy(*part).orderBy(F.col("chain_brand_sale_val").desc(),
                                          F.col("chain_brand_sale_yr_ago_val").desc())
    ranks = values.select(*part, "brand_nm", F.dense_rank().over(w).cast("bigint").alias("chain_brand_sale_rank"))
    return join_back(metrics, materialize(ranks, params), [*part, "brand_nm"], "left", ["chain_nbr", "_ck"])


def key_brand_emit(ranked: DataFrame, spr_stores: DataFrame) -> DataFrame:
    """P20: every key-brand row under each hierarchy type present in the store list.

    The hierarchy types are the two fixed codes, so the cross join is an explode
    of two literals restricted (semi join) to the codes present.
    """
    present = spr_stores.select("hier_type_cd").distinct()
    rows = ranked.withColumn(
        "hier_type_cd", F.explode(F.array(F.lit(HIER_COVERED), F.lit(HIER_NON_COVERED)))
    ).join(F.broadcast(present), "hier_type_cd", "left_semi")
    nc = F.col("hier_type_cd") == HIER_NON_COVERED
    return rows.select(
        "hier_type_cd", F.lit("KEY_BRAND").alias("metrc_nm"), "tmfrm_cd", "sold_to_nbr", "chain_nbr",
        "catg_nm", typed_null("string").alias("mult_catg_nm"),
        F.when(nc & (F.col("brand_nm") == "KEY"), F.lit("TOTAL")).otherwise(F.col("brand_nm")).alias("brand_nm"),
        "corp_nm", *[money(m).alias(m) for m in MEASURES],
        F.when(nc, F.col("chain_brand_sale_rank")).otherwise(F.col("brand_sale_rank")).alias("brand_sale_rank"),
        "sale_val_share_pct", money("sale_vs_yr_ago_val").alias("sale_vs_yr_ago_val"), "sale_vs_yr_ago_val_pct",
        *[money(f"actl_store_{m}").alias(f"store_{m}") for m in MEASURES],
        "src_nm", "kortex_upld_ts", "kortex_dprct_ts",
    )
