"""Store and product masters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscope.functions.columns import blank_to, is_filled, not_in_upper, not_like_upper
from shelfscope.params import (
    BLOCKED_CHANNELS, EXCLUDED_CATG_CODES, HIER_COVERED, HIER_NON_COVERED, IC_LABEL,
    RETAIL_ORDER_BLOCK, RETAIL_ORG_BLOCK, SALES_ORG, STORE_INACTIVE_PATTERN, WIP_CODE,
)
from shelfscope.plans.stages import densify

STORE_COLUMNS = [
    "rgn_nm", "rgn_nbr", "zn_nm", "zn_nbr", "terr_nm", "terr_nbr", "chnl_nbr", "chnl_nm",
    "plan_to_nm", "plan_to_nbr", "chain_nm", "chain_nbr", "sales_org_cd", "sold_to_nm",
    "sold_to_nbr", "sold_to_desc", "tdlinx_nbr", "store_nm", "street_nm", "city_nm", "rgn_cd",
    "pstl_cd", "store_nbr", "prev_acct_nbr", "vndr_nm", "retl_ind", "non_retl_ind", "src_nm",
]


def all_stores(cust_pivot: DataFrame, src_pref: DataFrame) -> DataFrame:
    """Distinct store list of the sales org, active, in a preferred-source plan-to."""
    c = cust_pivot
    level4 = F.col("hier_b_level4_misc_nbr")
    kept = c.join(src_pref.select("plan_to_nbr"), "plan_to_nbr", "left_semi").filter(
        (F.col("sales_org_cd") == SALES_ORG)
        & not_in_upper("hier_d_sales_mgmt_a_nm", BLOCKED_CHANNELS)
        & not_like_upper("plan_to_nm", STORE_INACTIVE_PATTERN)
        & not_like_upper("sold_to_nm", STORE_INACTIVE_PATTERN)
    )
    return kept.select(
        F.col("hier_b_rgn_nm").alias("rgn_nm"),
        F.col("hier_b_rgn_nbr").alias("rgn_nbr"),
        F.col("hier_b_area_nm").alias("zn_nm"),
        F.col("hier_b_area_nbr").alias("zn_nbr"),
        F.col("hier_b_terr_nm").alias("terr_nm"),
        F.col("hier_b_terr_nbr").alias("terr_nbr"),
        F.col("hier_d_sales_mgmt_a_nbr").alias("chnl_nbr"),
        F.col("hier_d_sales_mgmt_a_nm").alias("chnl_nm"),
        "plan_to_nm", "plan_to_nbr", "chain_nm", "chain_nbr", "sales_org_cd", "sold_to_nm",
        "sold_to_nbr",
        F.concat(F.col("sold_to_nm"), F.lit("-"), F.col("sold_to_nbr")).alias("sold_to_desc"),
        "tdlinx_nbr",
        F.col("sold_to_nm").alias("store_nm"),
        "street_nm", "city_nm", "rgn_cd", "pstl_cd",
        F.col("tdlinx_store_nbr").alias("store_nbr"),
        F.col("tdlinx_nbr").alias("prev_acct_nbr"),
        F.lit("").alias("vndr_nm"),
        F.when(is_filled(level4), 1).otherwise(0).alias("retl_ind"),
        F.when(
            ~is_filled(level4)
            & (F.col("sales_org_order_blok_cd") == RETAIL_ORG_BLOCK)
            & (F.col("order_blok_cd") == RETAIL_ORDER_BLOCK), 1,
        ).otherwise(0).alias("non_retl_ind"),
        "src_nm",
    ).distinct()


def store_hierarchy(stores: DataFrame) -> DataFrame:
    """Retail stores under both hierarchy types, non-retail ones only as non-covered.

    One pass with a per-row array of hierarchy codes instead of a 3-way union.
    """
    codes = (
        F.when(F.col("retl_ind") == 1, F.array(F.lit(HIER_COVERED), F.lit(HIER_NON_COVERED)))
        .when(F.col("non_retl_ind") == 1, F.array(F.lit(HIER_NON_COVERED)))
    )
    return stores.select(F.explode(codes).alias("hier_type_cd"), *STORE_COLUMNS)


def product_master(prod_gtin: DataFrame) -> DataFrame:
    """Distinct (category, immediate-consumption category, brand) of valid GTINs."""
    p = prod_gtin.filter(
        F.col("gtin").isNotNull() & (F.trim("gtin") != "")
        & (F.upper("comrcl_catg_cd") != WIP_CODE)
        & ~F.col("catg_cd").isin(*EXCLUDED_CATG_CODES)
        & ((F.col("spin_ind") == 1) | (F.col("klnva_retn_brand_ind") == 1))
    )
    return p.select(
        blank_to("catg_nm").alias("catg_nm"),
        F.when(is_filled("immed_cnsmptn_prod_type_cd"), F.lit(IC_LABEL))
        .otherwise(blank_to("catg_nm")).alias("ic_catg_nm"),
        blank_to("brand_nm").alias("brand_nm"),
    ).distinct()


GRID_STORE_COLUMNS = [
    "sold_to_nbr", "sold_to_nm", "tdlinx_nbr", "plan_to_nbr", "plan_to_nm", "chain_nbr",
    "hier_type_cd",
]


def store_product_grid(spr_stores: DataFrame, products: DataFrame,
                       store_columns=None, product_columns=None) -> DataFrame:
    """Distinct store columns x distinct product columns.

    The cross product of two distinct projections is itself distinct, so each
    consumer densifies only the columns it needs.
    """
    sc = store_columns or [*GRID_STORE_COLUMNS, "src_nm"]
    pc = product_columns or ["catg_nm", "ic_catg_nm", "brand_nm"]
    return densify(spr_stores.select(*sc).distinct(), products.select(*pc).distinct(), ["sold_to_nbr"])


def grid_categories(products: DataFrame) -> DataFrame:
    """``SELECT DISTINCT catg_nm FROM store_prod_mstr`` (the grid's categories)."""
    return products.select("catg_nm").distinct()
