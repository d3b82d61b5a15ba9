
import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfscope.functions.columns import growth_or_zero, share_or_null
from shelfscope.operators import calendar, drivers, key_brand, mart, masters, pos, shipment, visits
from shelfscope.operators.calendar import Frame, FrameSet
from shelfscope.params import MartParams
from shelfscope.sources.schemas import ENRICHED_COLUMNS, to_mart_rows

P = MartParams(pos_run_date=dt.date(2001, 7, 28), visit_run_date=dt.date(2001, 7, 28), load_ts=dt.datetime(2000, 1, 1))
L4W = FrameSet((Frame("L4W", dt.date(2001, 7, 1), "200127", dt.date(2001, 7, 28), "200130"),))
D = Decimal

POS_IC_SCHEMA = (
    "tmfrm_cd string, pd_end_yr_wk string, pd_end_dt date, sold_to_nbr string, chain_nbr string, "
    "ic_catg_nm string, brand_nm string, corp_nm string, sale_val decimal(38,2), "
    "sale_yr_ago_val decimal(38,2), sale_qty decimal(38,2), sale_yr_ago_qty decimal(38,2), "
    "sale_vol_lb_val decimal(38,2), sale_yr_ago_vol_lb_val decimal(38,2), src_nm string, "
    "kortex_upld_ts timestamp_ntz, kortex_dprct_ts timestamp_ntz"
)


def pos_ic_rows(spark, rows):
    """rows: (store, ic_catg, brand, corp, value)."""
    return spark.createDataFrame(
        [("L4W", "200130", dt.date(2001, 7, 28), s, "CH", c, b, corp, D(v), D(0), D(1), D(0), D(0), D(0),
          "n", None, None) for s, c, b, corp, v in rows],
        POS_IC_SCHEMA,
    )


def spr_store_rows(spark, rows):
    """rows: (hier, sold_to, chain)."""
    return spark.createDataFrame([(h, s, c, "x") for h, s, c in rows],
                                 "hier_type_cd string, sold_to_nbr string, chain_nbr string, src_nm string")


# ---- T1 null order in ranks -----------------------------------------------------------------
def test_t1_store_growth_rank_nulls_first(spark):
    """A store without a year-ago total (NULL growth) ranks before any growth."""
    totals = [("S1", 110, 100), ("S2", 1, None), ("S3", 105, 100)]
    level = spark.createDataFrame(
        [("REX_NON_COVERED", s, "CH", "KELLANOVA", "L4W", "200130", True, v, ya, v, ya) for s, v, ya in totals],
        "hier_type_cd string, sold_to_nbr string, chain_nbr string, corp_nm string, tmfrm_cd string, pd_end_yr_wk string, "
        "_has_rows boolean, store_sale_val int, store_sale_yr_ago_val int, store_sale_qty int, store_sale_yr_ago_qty int")
    none = level.limit(0)
    r = {x.sold_to_nbr: x.chain_store_sale_val_rank for x in pos.pos_chain_rank(level, none, {"store": none.drop("chain_nbr")}, P).collect()}
    assert r == {"S2": 1, "S1": 2, "S3": 3}


def _driver_fact_rows(spark, rows):
    cols = ", ".join(f"{c} double" for c in drivers.FACT_MEASURES)
    schema = ("metrc_nm string, tmfrm_cd string, store_chain_ind string, sold_to_nbr string, "
              "chain_nbr string, catg_nm string, mult_catg_nm string, " + cols)
    out = []
    for sold_to, cur, ya in rows:
        vals = {c: None for c in drivers.FACT_MEASURES}
        vals.update(sale_val=cur, sale_yr_ago_val=ya)
        out.append(("POS_PRFM", "L4W", "store", sold_to, "CH", "(All)", "a",
                    *[vals[c] for c in drivers.FACT_MEASURES]))
    return spark.createDataFrame(out, schema)


def test_t1_driver_rank_ascending_nulls_last(spark):
    facts = _driver_fact_rows(spark, [("S1", 110.0, 100.0), ("S2", 120.0, None), ("S3", 90.0, 100.0)])
    r = {x.sold_to_nbr: x.prfmnc_drvr_rank for x in drivers.store_level(facts).collect()}
    assert r == {"S1": 1, "S3": 2, "S2": 3}


# ---- T2 hash key ----------------------------------------------------------------------------
def test_t2_hash_key_strict_and_default(spark):
    row = spark.createDataFrame(
        [("POS", "L4W", "S1", "C", "B")],
        "metrc_nm string, tmfrm_cd string, sold_to_nbr string, catg_nm string, brand_nm string")
    rows = to_mart_rows(row)
    strict = mart.final_projection(rows, dt.date(2001, 7, 28), MartParams(strict_hash_key=True)).first()
    assert strict.hash_key is None
    default = mart.final_projection(rows, dt.date(2001, 7, 28), MartParams()).first()
    expected = hashlib.md5("kna_eccPOSL4W0S1CBKELLANOVA".encode()).hexdigest()
    assert default.hash_key == expected


# ---- T3 post-join filter (key brands) -------------------------------------------------------
def _key_brand(spark, pos_rows):
    stores = spr_store_rows(spark, [("REX_NON_COVERED", "S1", "CH")])
    products = spark.createDataFrame([("A", "A", "b1"), ("A", "A", "b2")],
                                     "catg_nm string, ic_catg_nm string, brand_nm string")
    base = key_brand.key_brand_base(stores, products, L4W, pos_ic_rows(spark, pos_rows), P)
    return sorted((r.brand_nm, float(r.sale_val)) for r in base.collect())


def test_t3_brand_rows_need_own_pos(spark):
    assert _key_brand(spark, [("S1", "A", "b1", "KELLANOVA", 5)]) == [("KEY", 5.0), ("b1", 5.0)]


def test_t3_competitor_only_drops_everything(spark):
    assert _key_brand(spark, [("S1", "A", "x", "COMP", 7)]) == []


def test_t3_no_pos_keeps_key_row_with_zero(spark):
    empty = pos_ic_rows(spark, []).limit(0)
    stores = spr_store_rows(spark, [("REX_NON_COVERED", "S1", "CH")])
    products = spark.createDataFrame([("A", "A", "b1")], "catg_nm string, ic_catg_nm string, brand_nm string")
    rows = key_brand.key_brand_base(stores, products, L4W, empty, P).collect()
    assert [(r.brand_nm, float(r.sale_val)) for r in rows] == [("KEY", 0.0)]


# ---- T4 prune with NULL category ------------------------------------------------------------
def test_t4_prune_keeps_null_category(spark):
    rows = to_mart_rows(spark.createDataFrame([("a", 5.0), ("b", 0.0), (None, 0.0)],
                                              "catg_nm string, sale_val double"))
    kept = sorted((r.catg_nm or "<null>") for r in mart.prune_empty_categories(rows).collect())
    assert kept == ["<null>", "a"]


# ---- T5 enrichment never fans out -----------------------------------------------------------
def test_t5_enrich_one_row_per_store(spark):
    attrs = {c: f"v_{c}" for c in ENRICHED_COLUMNS}
    attrs["sold_to_nbr"] = "S1"
    cols = ["hier_type_cd", *ENRICHED_COLUMNS]
    store_rows = [("REX_COVERED", *[attrs[c] for c in ENRICHED_COLUMNS]),
                  ("REX_NON_COVERED", *[attrs[c] for c in ENRICHED_COLUMNS])]
    spr = spark.createDataFrame(store_rows, ", ".join(f"{c} string" for c in cols))
    rows = to_mart_rows(spark.createDataFrame([("S1", "POS"), ("S1", "SHP"), ("S1", "OOS")],
                                              "sold_to_nbr string, metrc_nm string"))
    out = mart.enrich_with_store(rows, spr, P).collect()
    assert len(out) == 3
    assert all(r.city_nm == "v_city_nm" and r.chain_nbr == "v_chain_nbr" for r in out)


# ---- T6 two sources in the year-ago roll-up -------------------------------------------------
def test_t6_year_ago_rows_per_source(spark):
    detail = spark.createDataFrame(
        [("P1", "C", "B", "200030", dt.date(2000, 7, 29), D("3.00"), src, None, None) for src in ("s1", "s2")],
        "plan_to_nbr string, catg_nm string, brand_nm string, fisc_yr_wk string, fisc_wk_end_dt date, "
        "dir_indir_gsv decimal(18,2), src_nm string, kortex_upld_ts timestamp_ntz, kortex_dprct_ts timestamp_ntz")
    assert shipment.shipment_year_ago(detail, L4W, P).count() == 2
    merged = shipment.shipment_year_ago(detail, L4W, MartParams(merge_sources=True)).collect()
    assert len(merged) == 1 and float(merged[0].gsv_yr_ago) == 6.0


# ---- T7 weekly rows repeat per category sharing an IC category and brand --------------------
def test_t7_weekly_multiplicity(spark):
    weekly = FrameSet((Frame("WEEKLY_L13W", dt.date(2001, 7, 22), "200130", dt.date(2001, 7, 28), "200130"),))
    pos_ic = pos_ic_rows(spark, [("S1", "Immediate Consumption", "B", "KELLANOVA", 4)]).withColumn(
        "tmfrm_cd", F.lit("WEEKLY_L13W"))
    products = spark.createDataFrame([("C1", "Immediate Consumption", "B"), ("C2", "Immediate Consumption", "B")],
                                     "catg_nm string, ic_catg_nm string, brand_nm string")
    stores = spark.createDataFrame(
        [("REX_NON_COVERED", "S1", "n", "t", "P", "pn", "CH", "x")],
        "hier_type_cd string, sold_to_nbr string, sold_to_nm string, tdlinx_nbr string, plan_to_nbr string, "
        "plan_to_nm string, chain_nbr string, src_nm string")
    rows = pos.pos_weekly_rows(stores, products, weekly, pos_ic, P).collect()
    assert len(rows) == 2
    assert {(r.fisc_yr, r.tmfrm_cd, r.tmfrm_desc) for r in rows} == {(2001, "30", "Jul 22, 2001")}


# ---- T8 IN sub-query under OR ---------------------------------------------------------------
def test_t8_or_in_filter(spark):
    schema = ("fisc_yr_wk string, sold_to_nbr string, plan_to_nbr string, catg_nm string, brand_nm string, "
              "corp_nm string, immed_cnsmptn_prod_type_cd string, sale_val decimal(18,2), "
              "sale_yr_ago_val decimal(18,2), sale_qty decimal(18,2), sale_yr_ago_qty decimal(18,2), "
              "sale_vol_lb_val decimal(18,2), sale_yr_ago_vol_lb_val decimal(18,2), src_nm string, "
              "kortex_upld_ts timestamp_ntz, kortex_dprct_ts timestamp_ntz")
    cases = [("listed", "KELLANOVA"), ("unlisted", "KELLANOVA"), ("Others", "COMP"), ("other", "COMP"),
             ("listed", None)]
    posw = spark.createDataFrame(
        [("200130", "S1", "P1", c, f"b{i}", corp, None, D(1), D(0), D(1), D(0), D(0), D(0), "n", None, None)
         for i, (c, corp) in enumerate(cases)], schema)
    stores = spr_store_rows(spark, [("REX_NON_COVERED", "S1", "CH")])
    cats = spark.createDataFrame([("listed",)], "catg_nm string")
    out = sorted((r.ic_catg_nm, r.corp_nm) for r in pos.pos_rollup_ic(pos.pos_base(posw, L4W, stores), L4W, cats, P).collect())
    assert out == [("listed", "KELLANOVA"), ("other", "COMP")]


def test_measures_are_summed_at_their_own_scale(spark):
    """Four decimals: nothing is rounded before the sum."""
    m = ", ".join(f"{c} decimal(18,4)" for c in pos.ALL_MEASURES)
    schema = ("fisc_yr_wk string, sold_to_nbr string, plan_to_nbr string, catg_nm string, brand_nm string, corp_nm string, "
              f"immed_cnsmptn_prod_type_cd string, {m}, src_nm string, kortex_upld_ts timestamp_ntz, kortex_dprct_ts timestamp_ntz")
    rows = [("200130", "S1", f"P{i}", "c", "b", "KELLANOVA", None, *[D(v)] * 6, src, None, None)
            for i, (v, src) in enumerate([("0.0040", "a"), ("0.0040", "b"), ("0.0040", None), ("1.3333", "a")])]
    base = pos.pos_base(spark.createDataFrame(rows, schema), L4W, spr_store_rows(spark, [("REX_NON_COVERED", "S1", "CH")]))
    cats = spark.createDataFrame([("c",)], "catg_nm string")
    for out in (pos.pos_rollup_ic(base, L4W, cats, P), pos.pos_rollup_plain(base, L4W, cats)):
        r = out.collect()
        assert len(r) == 1 and r[0].sale_val == D("1.3453") == r[0].sale_yr_ago_vol_lb_val and r[0].src_nm == "b"


def test_chain_facts_of_a_hot_chain_equal_the_matrix_sums(spark):
    """A third of the stores in one chain: sums per chain and category first, then lists, as over the pairs."""
    stores = [(f"S{i}", "HOT" if i % 3 == 0 else f"C{i % 5}" if i % 7 else None) for i in range(60)]
    cells = [(mt, "L4W", s, c, k) for mt in ("EVENTS", "OOS", "POS_PRFM") for s, c in stores for k in ("a", "b", "c")]
    keys = "metrc_nm string, tmfrm_cd string, sold_to_nbr string, chain_nbr string, catg_nm string"
    indiv = spark.createDataFrame(cells, keys)
    active = spark.createDataFrame([x for i, x in enumerate(cells) if i % 4], keys)
    lists = drivers.store_category_lists(indiv, active, drivers.event_categories(active))
    chains = drivers.chain_lists(lists)
    matrix = drivers.driver_matrix(lists, chains, active, P)
    oos = spark.createDataFrame([("L4W", k, s, i % 5, i % 3, src) for src in "xy" for i, (s, _) in enumerate(stores) for k in ("a", "c")],
                                "tmfrm_cd string, catg_nm string, sold_to_nbr string, oos_alert_cnt bigint, visit_cnt bigint, src string")
    measures = ", ".join(f"{c} decimal(18,2)" for c in drivers.POS_MEASURES)
    plain = spark.createDataFrame([("L4W", k, s, "KELLANOVA", b, *[D(i)] * 6) for b in "pq" for i, (s, _) in enumerate(stores) for k in ("b", "c")],
                                  f"tmfrm_cd string, catg_nm string, sold_to_nbr string, corp_nm string, brand string, {measures}")
    events = spark.createDataFrame([], "tmfrm_cd string, catg_nm string, sold_to_nbr string, chain_nbr string, mult_catg_nm string, "
                                       "up_in_store_val bigint, ans_in_store_val bigint, visit_in_store_val bigint, true_in_store_wk_cnt bigint")
    got = drivers.store_facts(lists, chains, active, drivers.event_facts(matrix, events), oos, plain, P).filter("metrc_nm <> 'EVENTS'")
    joined = matrix.filter("metrc_nm <> 'EVENTS'").join(
        oos.select(F.lit("OOS").alias("metrc_nm"), "tmfrm_cd", "catg_nm", "sold_to_nbr", "oos_alert_cnt", "visit_cnt"),
        ["metrc_nm", "tmfrm_cd", "catg_nm", "sold_to_nbr"], "left").join(
        plain.select(F.lit("POS_PRFM").alias("metrc_nm"), "tmfrm_cd", "catg_nm", "sold_to_nbr", "sale_val"),
        ["metrc_nm", "tmfrm_cd", "catg_nm", "sold_to_nbr"], "left")
    want = joined.groupBy(
        "metrc_nm", "store_chain_ind", F.when(F.col("store_chain_ind") == "store", F.col("sold_to_nbr")).otherwise("").alias("s"), "chain_nbr",
        F.when(F.col("catg_type_cd") == "(Individual)", F.col("catg_nm")).otherwise(F.col("catg_type_cd")).alias("c"), "mult_catg_nm",
    ).agg(F.sum("oos_alert_cnt").cast("double").alias("o"), F.max("visit_cnt").cast("double").alias("v"), F.sum("sale_val").cast("double").alias("p"))
    cols = ["metrc_nm", "store_chain_ind", "sold_to_nbr", "chain_nbr", "catg_nm", "mult_catg_nm", "oos_alert_cnt", "visit_cnt", "sale_val"]
    assert sorted(map(str, (tuple(r) for r in got.select(*cols).collect()))) == sorted(map(str, (tuple(r) for r in want.collect())))


def test_all_parts_of_a_category_list(spark):
    r = spark.createDataFrame([("S1", "a,b,c,d,e,f,g,h,i")], "sold_to_nbr string, mult_catg_nm string")
    assert visits.events_split(r).count() == 7 and visits.events_split(r, None).count() == 9


def test_families_have_only_their_rows(spark):
    """The conditions that tell families apart hold on the rows that each family makes."""
    from shelfscope.plans.queries import job_for

    job = job_for(spark, "/root/testdata/sf0.001")
    for name in mart.FAMILIES:
        rows = mart.final_projection(to_mart_rows(job.family_rows(name)), job.pos_run_dt, job.params)
        assert rows.filter(~F.coalesce(F.expr(mart.FAMILIES[name]), F.lit(False))).count() == 0


def test_t9_t17_split_first_seven_parts(spark):
    r = spark.createDataFrame([("L4W", "S1", "CH", "a, b,,a,c,d,e,f", 1, 1, 1, 1, 1, 1)],
                              "tmfrm_cd string, sold_to_nbr string, chain_nbr string, mult_catg_nm string, "
                              "up_in_store_val bigint, ans_in_store_val bigint, visit_in_store_val bigint, "
                              "ans_wk_cnt bigint, visit_wk_cnt bigint, true_in_store_wk_cnt bigint")
    parts = [x.catg_nm for x in visits.events_split(r).orderBy("part_nbr").collect()]
    assert parts == ["a", "b", "a", "c", "d", "e"]


# ---- T10 ordered distinct lists -------------------------------------------------------------
def test_t10_category_list(spark):
    keys = "metrc_nm string, tmfrm_cd string, sold_to_nbr string, chain_nbr string, catg_nm string"
    active = spark.createDataFrame([("EVENTS", "L4W", "S1", "CH", c) for c in ("b", "a", "a")], keys)
    empty = active.limit(0)
    lists = drivers.store_category_lists(empty, active, empty).collect()
    assert {r.mult_catg_nm for r in lists} == {"a, b"}


# ---- T11 zero guards ------------------------------------------------------------------------
def test_t11_zero_guards(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, None)], "v double, t double")
    got = df.select(growth_or_zero("v", "t").alias("g"), share_or_null("v", "t").alias("s")).collect()
    assert [(r.g, r.s) for r in got] == [(0.0, None), (None, None)]


# ---- T12 different inactive patterns --------------------------------------------------------
def test_t12_inactive_patterns(spark):
    cols = ["hier_b_rgn_nm", "hier_b_rgn_nbr", "hier_b_area_nm", "hier_b_area_nbr", "hier_b_terr_nm",
            "hier_b_terr_nbr", "hier_d_sales_mgmt_a_nbr", "hier_d_sales_mgmt_a_nm", "plan_to_nm", "plan_to_nbr",
            "chain_nm", "chain_nbr", "sales_org_cd", "sold_to_nm", "sold_to_nbr", "tdlinx_nbr",
            "tdlinx_store_nbr", "street_nm", "city_nm", "rgn_cd", "pstl_cd", "hier_b_level4_misc_nbr",
            "sales_org_order_blok_cd", "order_blok_cd", "src_nm"]
    v = {c: "x" for c in cols}
    v.update(plan_to_nm="ACME INACT", plan_to_nbr="P1", sales_org_cd="1001", sold_to_nm="Store",
             sold_to_nbr="S1", hier_d_sales_mgmt_a_nm="GROCERY")
    cust = spark.createDataFrame([tuple(v[c] for c in cols)], ", ".join(f"{c} string" for c in cols))
    pref = spark.createDataFrame([("P1",)], "plan_to_nbr string")
    assert masters.all_stores(cust, pref).count() == 0
    assert shipment.customer_hierarchy(cust).count() == 1


# ---- T15 brand row-number tie-break ---------------------------------------------------------
def test_t15_tie_orders_by_category_then_brand(spark):
    base = spark.createDataFrame(
        [("Brands", "S1", "CH", "A", b, "KELLANOVA", "L4W", D(5), D(5), D(1), D(1), "x", None, None)
         for b in ("zeta", "alpha")],
        "type_cd string, sold_to_nbr string, chain_nbr string, catg_nm string, brand_nm string, corp_nm string, "
        "tmfrm_cd string, sale_val decimal(38,2), sale_yr_ago_val decimal(38,2), sale_qty decimal(38,2), "
        "sale_yr_ago_qty decimal(38,2), src_nm string, kortex_upld_ts timestamp_ntz, kortex_dprct_ts timestamp_ntz")
    m = {r.brand_nm: r.brand_sale_rank for r in key_brand.key_brand_metrics(base, P).collect()}
    assert m == {"alpha": 1, "zeta": 2}


# ---- T16 / T19 frames and the 52-week year-ago ----------------------------------------------
@pytest.fixture(scope="module")
def cal_day(spark):
    from shelfscope.sources.testviews import calendar_day, load_tables

    return calendar_day(load_tables(spark, "/root/testdata/sf0.001"))


def test_t16_rolling_frames(cal_day):
    f = {r.tmfrm_cd: r for r in calendar.period_frames(cal_day, dt.date(2001, 7, 28)).collect()}
    assert (f["L4W"].pd_start_dt, f["L4W"].pd_end_dt) == (dt.date(2001, 7, 1), dt.date(2001, 7, 28))
    assert f["L13W"].pd_start_dt == dt.date(2001, 4, 29)
    assert f["YTD"].pd_start_dt == dt.date(2000, 12, 31)
    assert (f["L4W"].pd_start_yr_wk, f["L4W"].pd_end_yr_wk) == ("200127", "200130")


def test_t16_weekly_frames(cal_day):
    w = calendar.weekly_frames(cal_day, dt.date(2001, 7, 28)).collect()
    assert sum(r.tmfrm_cd == "WEEKLY_L13W" for r in w) == 13
    assert sum(r.tmfrm_cd == "WEEKLY_N13W" for r in w) == 13


def test_t19_year_ago_is_364_days(spark):
    # frame 2001-07-01..2001-07-28 shifted by 364 days is 2000-07-02..2000-07-29
    days = [dt.date(2000, 7, 1), dt.date(2000, 7, 2), dt.date(2000, 7, 29), dt.date(2000, 7, 30)]
    df = spark.createDataFrame([(d,) for d in days], "fisc_wk_end_dt date")
    got = sorted(r.fisc_wk_end_dt for r in L4W.by_year_ago_date(df, "fisc_wk_end_dt").collect())
    assert got == [dt.date(2000, 7, 2), dt.date(2000, 7, 29)]


# ---- Whole-mart checks (T13, T14, T20, invariants) on the smallest test tables ----------------
@pytest.fixture(scope="module")
def built(spark):
    from shelfscope.plans.queries import job_for

    return job_for(spark, "/root/testdata/sf0.001").mart_final


def test_t13_null_chain_has_sums_but_no_rank(built):
    pos_rows = built.filter((F.col("metrc_nm") == "POS") & (F.col("sub_metrc_nm") == "")
                            & (F.col("sold_to_nbr") != "") & (F.col("brand_nm") != ""))
    no_chain = pos_rows.filter(F.col("chain_nm") == "")
    assert no_chain.count() > 0
    assert no_chain.filter(F.col("chain_store_sale_val_rank").isNotNull()).count() == 0
    assert no_chain.filter(F.col("chain_store_cnt").isNotNull()).count() == 0
    assert no_chain.filter(F.col("chain_sale_val").isNull()).count() == 0


def test_t14_key_rows_rank_first_in_chain(built):
    total = built.filter((F.col("metrc_nm") == "KEY_BRAND") & (F.col("brand_nm") == "TOTAL"))
    assert total.count() > 0
    assert total.filter(F.col("brand_sale_rank") != 1).count() == 0


def test_t20_unused_columns_stay_null(built):
    assert built.filter(F.col("visit_in_store_val").isNotNull()
                        | F.col("chain_visit_in_store_val").isNotNull()).count() == 0


def test_invariant_shares_sum_to_100_or_0(built):
    pos_rows = built.filter((F.col("metrc_nm") == "POS") & (F.col("sub_metrc_nm") == "")
                            & F.col("sale_val_share_pct").isNotNull())
    sums = pos_rows.groupBy("hier_type_cd", "sold_to_nbr", "catg_nm", "tmfrm_cd").agg(
        F.sum("sale_val_share_pct").alias("s")).collect()
    assert sums and all(abs(r.s) < 1e-6 or abs(r.s - 100) < 1e-6 for r in sums)


def test_invariant_ranks_start_at_one(built):
    pos_rows = built.filter(F.col("chain_store_sale_val_rank").isNotNull())
    mins = pos_rows.groupBy("hier_type_cd", "chain_nbr", "corp_nm", "tmfrm_cd").agg(
        F.min("chain_store_sale_val_rank").alias("m")).collect()
    assert mins and all(r.m == 1 for r in mins)


def test_invariant_l4w_within_l13w(built):
    shp = built.filter(F.col("metrc_nm") == "SHP").groupBy("sold_to_nbr", "catg_nm", "brand_nm").pivot(
        "tmfrm_cd", ["L4W", "L13W"]).agg(F.sum("sale_val"))
    assert shp.filter(F.col("L4W") > F.col("L13W") + 1e-6).count() == 0


def test_t18_key_brand_rows_under_both_hierarchies(built):
    kb = built.filter(F.col("metrc_nm") == "KEY_BRAND")
    by_hier = {h: {r.sold_to_nbr for r in kb.filter(F.col("hier_type_cd") == h).select("sold_to_nbr").distinct().collect()}
               for h in ("REX_COVERED", "REX_NON_COVERED")}
    assert by_hier["REX_COVERED"] and by_hier["REX_COVERED"] == by_hier["REX_NON_COVERED"]
    brands = {(r.hier_type_cd, r.brand_nm) for r in kb.filter(F.col("brand_nm").isin("KEY", "TOTAL"))
              .select("hier_type_cd", "brand_nm").distinct().collect()}
    assert brands == {("REX_COVERED", "KEY"), ("REX_NON_COVERED", "TOTAL")}
