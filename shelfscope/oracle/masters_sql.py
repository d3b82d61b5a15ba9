"""Oracle SQL: run dates, frames, store and product masters.

Frames come from one table of day offsets, hierarchy rows from an unnested list of
codes, and every rule about which store or product counts is a flag of its own.
"""

from __future__ import annotations

from shelfscope.oracle.registry import cte, final
from shelfscope.params import (
    BLOCKED_CHANNELS, EXCLUDED_CATG_CODES, IC_LABEL, RETAIL_ORDER_BLOCK, RETAIL_ORG_BLOCK, SALES_ORG, WIP_CODE,
)
from shelfscope.sources.testviews import POS_RUN_DATE, VISIT_RUN_DATE

RESOLVER_TODAY = "DATE '2024-02-10'"


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def date(d) -> str:
    return f"DATE '{d.isoformat()}'"


for _tag, _run in (("pos", date(POS_RUN_DATE)), ("psd", date(VISIT_RUN_DATE))):
    cte(f"{_tag}_frames", f"""
  WITH offsets(tmfrm_cd, days_back) AS (VALUES ('L4W', 21), ('L13W', 84), ('YTD', NULL)),
  run AS (SELECT any_value(fisc_yr) AS fisc_yr FROM src_cal_day WHERE fisc_dt = {_run})
  SELECT min(d.fisc_wk_start_dt) AS pd_start_dt, min(d.fisc_yr_wk) AS pd_start_yr_wk,
    max(d.fisc_wk_end_dt) AS pd_end_dt, max(d.fisc_yr_wk) AS pd_end_yr_wk, o.tmfrm_cd
  FROM offsets o, run r, src_cal_day d
  WHERE d.fisc_dt <= {_run}
    AND CASE WHEN o.days_back IS NULL THEN d.fisc_yr = r.fisc_yr ELSE d.fisc_dt >= {_run} - o.days_back END
  GROUP BY o.tmfrm_cd""")

cte("pos_weekly_frames", f"""
  WITH spans(tmfrm_cd, first_back, last_back) AS (VALUES ('WEEKLY_L13W', 84, 0), ('WEEKLY_N13W', 357, 273))
  SELECT any_value(d.fisc_wk_start_dt) AS pd_start_dt, d.fisc_yr_wk AS pd_start_yr_wk,
    any_value(d.fisc_wk_end_dt) AS pd_end_dt, d.fisc_yr_wk AS pd_end_yr_wk, s.tmfrm_cd
  FROM spans s JOIN src_cal_day d
    ON date_diff('day', d.fisc_dt, {date(POS_RUN_DATE)}) BETWEEN s.last_back AND s.first_back
  GROUP BY s.tmfrm_cd, d.fisc_yr_wk""")

# Which rolling frames a fiscal week lies in: the only range test of the oracle.
cte("week_frames", """
  SELECT w.fisc_yr_wk, f.tmfrm_cd, f.pd_end_yr_wk, f.pd_end_dt
  FROM (SELECT DISTINCT fisc_yr_wk FROM src_cal_day) w
  JOIN pos_frames f ON w.fisc_yr_wk >= f.pd_start_yr_wk AND w.fisc_yr_wk <= f.pd_end_yr_wk""")

final("run_date", f"""
  SELECT {date(POS_RUN_DATE)} AS pos_run_dt, arg_max(fisc_wk_end_dt, fisc_dt) AS psd_run_dt
  FROM src_cal_day WHERE fisc_dt = {RESOLVER_TODAY} - 14""")
final("period_frames", "SELECT * FROM pos_frames")
final("weekly_frames", "SELECT * FROM pos_weekly_frames")

# new name: source column (or expression)
STORE_MAP = {
    "rgn_nm": "hier_b_rgn_nm", "rgn_nbr": "hier_b_rgn_nbr", "zn_nm": "hier_b_area_nm", "zn_nbr": "hier_b_area_nbr",
    "terr_nm": "hier_b_terr_nm", "terr_nbr": "hier_b_terr_nbr", "chnl_nbr": "hier_d_sales_mgmt_a_nbr",
    "chnl_nm": "hier_d_sales_mgmt_a_nm", "plan_to_nm": "plan_to_nm", "plan_to_nbr": "plan_to_nbr", "chain_nm": "chain_nm",
    "chain_nbr": "chain_nbr", "sales_org_cd": "sales_org_cd", "sold_to_nm": "sold_to_nm", "sold_to_nbr": "sold_to_nbr",
    "sold_to_desc": "sold_to_nm || '-' || sold_to_nbr", "tdlinx_nbr": "tdlinx_nbr", "store_nm": "sold_to_nm",
    "street_nm": "street_nm", "city_nm": "city_nm", "rgn_cd": "rgn_cd", "pstl_cd": "pstl_cd", "store_nbr": "tdlinx_store_nbr",
    "prev_acct_nbr": "tdlinx_nbr", "vndr_nm": "''", "retl_ind": "retail::INT", "non_retl_ind": "(NOT retail AND blocked)::INT",
    "src_nm": "src_nm",
}

cte("live_customers", f"""
  SELECT *, coalesce(hier_b_level4_misc_nbr, '') <> '' AS retail,
    coalesce(sales_org_order_blok_cd = '{RETAIL_ORG_BLOCK}' AND order_blok_cd = '{RETAIL_ORDER_BLOCK}', false) AS blocked
  FROM src_cust_pivot
  WHERE sales_org_cd = '{SALES_ORG}'
    AND NOT contains(upper(plan_to_nm), 'INACT') AND NOT contains(upper(sold_to_nm), 'INACT')
    AND upper(hier_d_sales_mgmt_a_nm) NOT IN ({quoted(BLOCKED_CHANNELS)})""")

cte("all_stores", f"""
  SELECT DISTINCT {", ".join(f"{e} AS {c}" for c, e in STORE_MAP.items())}
  FROM live_customers SEMI JOIN src_pref USING (plan_to_nbr)""")

cte("stores", """
  SELECT unnest(CASE WHEN retl_ind = 1 THEN ['REX_COVERED', 'REX_NON_COVERED']
                     WHEN non_retl_ind = 1 THEN ['REX_NON_COVERED'] ELSE [] END) AS hier_type_cd, *
  FROM all_stores""")

cte("products", f"""
  SELECT catg_nm, CASE WHEN ic THEN '{IC_LABEL}' ELSE catg_nm END AS ic_catg_nm, brand_nm
  FROM (
    SELECT coalesce(catg_nm, '') AS catg_nm, coalesce(brand_nm, '') AS brand_nm,
      length(coalesce(immed_cnsmptn_prod_type_cd, '')) > 0 AS ic
    FROM src_prod_gtin
    WHERE length(trim(gtin)) > 0 AND upper(comrcl_catg_cd) <> '{WIP_CODE}' AND 1 IN (spin_ind, klnva_retn_brand_ind)
      AND catg_cd NOT IN ({quoted(EXCLUDED_CATG_CODES)}))
  GROUP BY ALL""")

cte("grid", """
  SELECT * FROM (
    SELECT sold_to_nbr, sold_to_nm, tdlinx_nbr, plan_to_nbr, plan_to_nm, chain_nbr, hier_type_cd, src_nm
    FROM stores GROUP BY ALL) AS s, products""")

final("store_master", "SELECT * FROM all_stores")
final("store_hierarchy", "SELECT * FROM stores")
final("product_master", "SELECT * FROM products")
final("store_product_grid", "SELECT * FROM grid")
