"""DuckDB versions of the test-data adapters (see ``sources.testviews``)."""

from __future__ import annotations

from shelfscope.oracle.registry import cte
from shelfscope.params import OWN_CORP
from shelfscope.sources.testviews import PRIORITY_LABELS


def wk_end(d: str) -> str:
    return f"(({d}) + CAST(6 - dayofweek({d}) AS INTEGER))"


def wk_start(d: str) -> str:
    return f"({wk_end(d)} - 6)"


def fyear(d: str) -> str:
    return f"CAST(year({wk_end(d)}) AS INTEGER)"


def fweek(d: str) -> str:
    return f"CAST((dayofyear({wk_end(d)}) - 1) // 7 + 1 AS INTEGER)"


def fyearweek(d: str) -> str:
    return f"(CAST({fyear(d)} AS VARCHAR) || lpad(CAST({fweek(d)} AS VARCHAR), 2, '0'))"


def pad(x: str, n: int) -> str:
    return f"lpad(CAST({x} AS VARCHAR), {n}, '0')"


def s(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


cte("src_cal_span", """
  SELECT min(d) AS lo, max(d) AS hi FROM (
    SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem
    UNION ALL SELECT CAST(o_orderdate AS DATE) FROM orders
    UNION ALL SELECT CAST(ts AS DATE) FROM events
  ) spans""")

cte("src_cal_day", f"""
  SELECT fisc_dt,
    {wk_start('fisc_dt')} AS fisc_wk_start_dt,
    {wk_end('fisc_dt')} AS fisc_wk_end_dt,
    {fyear('fisc_dt')} AS fisc_yr,
    {fweek('fisc_dt')} AS fisc_wk,
    {fyearweek('fisc_dt')} AS fisc_yr_wk
  FROM (
    SELECT CAST(g.generate_series AS DATE) AS fisc_dt
    FROM src_cal_span,
      generate_series(CAST({wk_start('lo')} AS TIMESTAMP), CAST({wk_end('hi')} AS TIMESTAMP), INTERVAL 1 DAY) g
  ) days""")

cte("src_cal_wk", """
  SELECT DISTINCT fisc_yr, fisc_wk, fisc_yr_wk, fisc_wk_end_dt FROM src_cal_day""")

cte("src_cust_base", f"""
  SELECT
    r_name AS hier_b_rgn_nm,
    {pad('r_regionkey', 2)} AS hier_b_rgn_nbr,
    r_name || ' ZONE ' || {s('n_nationkey % 2')} AS hier_b_area_nm,
    {pad('r_regionkey', 2)} || {s('n_nationkey % 2')} AS hier_b_area_nbr,
    CASE WHEN n_nationkey % 12 <> 11 THEN n_name END AS hier_b_terr_nm,
    CASE WHEN n_nationkey % 12 <> 11 THEN {pad('n_nationkey', 4)} END AS hier_b_terr_nbr,
    substr(c_mktsegment, 1, 3) AS hier_d_sales_mgmt_a_nbr,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'Specialty' ELSE c_mktsegment END AS hier_d_sales_mgmt_a_nm,
    CASE WHEN n_nationkey = 24 THEN n_name || ' INACT' ELSE n_name END AS plan_to_nm,
    {pad('n_nationkey', 10)} AS plan_to_nbr,
    CASE WHEN c_custkey % 40 <> 0 THEN 'CHAIN ' || {s('c_custkey % 40')} END AS chain_nm,
    CASE WHEN c_custkey % 40 <> 0 THEN {pad('c_custkey % 40', 5)} END AS chain_nbr,
    CASE WHEN c_custkey % 50 = 7 THEN '2002' ELSE '1001' END AS sales_org_cd,
    CASE WHEN c_custkey % 97 = 5 THEN c_name || ' INACTIVE' ELSE c_name END AS sold_to_nm,
    {pad('c_custkey', 10)} AS sold_to_nbr,
    'TD' || {pad('c_custkey', 7)} AS tdlinx_nbr,
    {pad('c_custkey % 1000', 4)} AS tdlinx_store_nbr,
    {s('c_custkey % 900 + 100')} || ' MAIN ST' AS street_nm,
    'CITY ' || {s('n_nationkey')} AS city_nm,
    substr(r_name, 1, 2) AS rgn_cd,
    {pad('c_custkey % 99991', 5)} AS pstl_cd,
    CASE WHEN c_custkey % 6 = 3 THEN '' WHEN c_custkey % 6 <> 0 THEN 'L4-' || {s('c_custkey % 7')} END
      AS hier_b_level4_misc_nbr,
    CASE WHEN c_custkey % 2 = 0 THEN '01' ELSE '00' END AS sales_org_order_blok_cd,
    CASE WHEN c_custkey % 4 = 0 THEN '04' ELSE '00' END AS order_blok_cd,
    'kna_ecc' AS src_nm,
    c_custkey AS k
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")

cte("src_cust_pivot", """
  SELECT * EXCLUDE (k) FROM src_cust_base
  UNION ALL
  SELECT * EXCLUDE (k) REPLACE (
    'ANNEX ' || street_nm AS street_nm,
    CASE WHEN k % 500 = 1 THEN '00099' ELSE chain_nbr END AS chain_nbr,
    CASE WHEN k % 500 = 1 THEN 'CHAIN 99' ELSE chain_nm END AS chain_nm)
  FROM src_cust_base WHERE k % 250 = 1""")

cte("src_pref", f"""
  SELECT DISTINCT {pad('n_nationkey', 10)} AS plan_to_nbr FROM nation WHERE n_nationkey <> 3""")

_PROD_COLS = """
    CASE WHEN p_type = 'MEDIUM' THEN 'Frozen Meals' ELSE p_type END AS catg_nm,
    CASE WHEN p_type = 'PROMO' THEN '2040' ELSE '1000' END AS catg_cd,
    CASE WHEN p_partkey % 50 = 1 THEN 'WIP' WHEN p_partkey % 50 = 2 THEN 'wip'
         WHEN p_partkey % 50 <> 3 THEN 'RTL' END AS comrcl_catg_cd,
    CASE WHEN p_partkey % 211 <> 0 THEN p_brand END AS brand_nm,
    CASE WHEN p_type = 'MEDIUM' OR p_partkey % 7 = 0 THEN 0 ELSE 1 END AS spin_ind,
    CASE WHEN p_type <> 'MEDIUM' AND p_partkey % 14 = 0 THEN 1 ELSE 0 END AS klnva_retn_brand_ind"""

cte("src_prod_gtin", f"""
  SELECT
    CASE WHEN p_partkey % 97 = 13 THEN ' ' ELSE {pad('p_partkey', 14)} END AS gtin,
    {_PROD_COLS},
    CASE WHEN p_size > 40 THEN 'IC' WHEN p_size > 35 THEN '' END AS immed_cnsmptn_prod_type_cd
  FROM part""")

cte("src_prod_matrl", f"""
  SELECT {pad('p_partkey', 18)} AS matrl_nbr, {_PROD_COLS}
  FROM part""")

cte("src_shipments", f"""
  SELECT
    {s(fyear('CAST(l_shipdate AS DATE)'))} AS fisc_yr,
    {s(fweek('CAST(l_shipdate AS DATE)'))} AS fisc_wk,
    {pad('o_custkey', 10)} AS sold_to_nbr,
    {pad('l_partkey', 18)} AS matrl_nbr,
    CASE WHEN l_orderkey % 19 = 0 THEN '2002' ELSE '1001' END AS sales_org_cd,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS dir_indir_gsv,
    CASE WHEN l_orderkey % 5 = 0 THEN 'kna_bw' ELSE 'kna_ecc' END AS src_nm,
    CAST(l_shipdate AS TIMESTAMP) AS kortex_upld_ts,
    CAST(NULL AS TIMESTAMP) AS kortex_dprct_ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")

cte("src_pos_lines", f"""
  SELECT
    CAST(l_shipdate AS DATE) AS d,
    {pad('o_custkey', 10)} AS sold_to_nbr,
    {pad('c_nationkey', 10)} AS plan_to_nbr,
    CASE WHEN p_size <= 2 THEN 'Others' WHEN p_type = 'MEDIUM' THEN 'Frozen Meals' ELSE p_type END AS catg_nm,
    p_brand AS brand_nm,
    CASE WHEN l_suppkey % 2 = 0 THEN '{OWN_CORP}' WHEN l_suppkey % 31 = 3 THEN NULL
         WHEN l_suppkey % 4 = 1 THEN 'COMPETITOR A' ELSE 'COMPETITOR B' END AS corp_nm,
    CASE WHEN p_size > 40 THEN 'IC' END AS immed_cnsmptn_prod_type_cd,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS v,
    CAST(l_quantity AS DECIMAL(18,2)) AS q,
    CAST(l_quantity * p_size AS DECIMAL(18,2)) AS lb,
    CAST(l_shipdate AS TIMESTAMP) AS ts
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey""")

cte("src_pos_weekly", f"""
  SELECT fisc_yr_wk, sold_to_nbr, plan_to_nbr, catg_nm, brand_nm, corp_nm, immed_cnsmptn_prod_type_cd,
    sum(sale_val) AS sale_val, sum(sale_yr_ago_val) AS sale_yr_ago_val,
    sum(sale_qty) AS sale_qty, sum(sale_yr_ago_qty) AS sale_yr_ago_qty,
    sum(sale_vol_lb_val) AS sale_vol_lb_val, sum(sale_yr_ago_vol_lb_val) AS sale_yr_ago_vol_lb_val,
    'nielsen' AS src_nm, max(ts) AS kortex_upld_ts, CAST(NULL AS TIMESTAMP) AS kortex_dprct_ts
  FROM (
    SELECT {fyearweek('d')} AS fisc_yr_wk, sold_to_nbr, plan_to_nbr, catg_nm, brand_nm, corp_nm,
      immed_cnsmptn_prod_type_cd, v AS sale_val, CAST(0 AS DECIMAL(18,2)) AS sale_yr_ago_val,
      q AS sale_qty, CAST(0 AS DECIMAL(18,2)) AS sale_yr_ago_qty,
      lb AS sale_vol_lb_val, CAST(0 AS DECIMAL(18,2)) AS sale_yr_ago_vol_lb_val, ts
    FROM src_pos_lines
    UNION ALL
    SELECT {fyearweek('d + 364')}, sold_to_nbr, plan_to_nbr, catg_nm, brand_nm, corp_nm,
      immed_cnsmptn_prod_type_cd, CAST(0 AS DECIMAL(18,2)), v, CAST(0 AS DECIMAL(18,2)), q,
      CAST(0 AS DECIMAL(18,2)), lb, ts
    FROM src_pos_lines
  ) both_years
  GROUP BY ALL""")

_GUID = "CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR)"

cte("src_visit_audit", f"""
  SELECT
    {_GUID} AS visit_guid,
    {pad('user_id', 10)} AS sold_to_nbr,
    CAST(ts AS TIMESTAMP) AS actl_start_dt_time,
    event_type AS actn_desc,
    CASE WHEN event_type = 'error' THEN 'Phantom' WHEN event_type = 'click' THEN 'Price Check' END
      AS orchestro_item_alert_val,
    CASE WHEN event_type = 'signup' AND value > 50 THEN 1 ELSE 0 END AS rep_item_alert_val,
    CAST(event_id % (SELECT count(*) FROM part) AS VARCHAR) AS prod_pack_extrnl_nbr,
    lpad(CAST(event_id % (SELECT count(*) FROM part) AS VARCHAR), 14, '0') AS prod_pack_gtin,
    'SIF_Raw' AS src_nm,
    CAST(ts AS TIMESTAMP) AS kortex_upld_ts,
    CAST(NULL AS TIMESTAMP) AS kortex_dprct_ts
  FROM events""")

_LABELS = "[" + ", ".join("'" + x + "'" for x in PRIORITY_LABELS) + "]"

cte("src_priority", f"""
  SELECT
    {_GUID} AS visit_guid,
    {pad('user_id', 10)} AS sold_to_nbr,
    array_to_string(list_transform(range(event_id % 8 + 1), lambda j: {_LABELS}[CAST((event_id + j) % 8 + 1 AS INTEGER)]), ', ')
      AS mult_catg_nm,
    {fyearweek('CAST(ts AS DATE)')} AS fisc_yr_wk,
    'P' || {s('event_id % 5')} AS priorty_nbr,
    CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS up_in_store_ind,
    CASE WHEN event_id % 23 = 0 THEN 'manual' ELSE 'sif_raw' END AS src_nm
  FROM events""")
