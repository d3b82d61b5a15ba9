"""Stand-in source tables derived from the driver's TPC-H-style test data.

The mart's real inputs (fiscal calendar, customer pivot, product hierarchy and
four fact tables) do not exist in the test data, so each role is derived from
the given tables by Spark.  Every derivation is a lazy DataFrame over the
Parquet files, so the work of every query grows with the test tables.  The
same derivations exist as DuckDB SQL in ``shelfscope.oracle.sql``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope.functions import fiscal
from shelfscope.params import OWN_CORP, MartParams
from shelfscope.plans.stages import grid_partitions
from shelfscope.sources.schemas import TS
from shelfscope.sources.tables import SourceTables

# Run dates that put the test data inside every time frame.
POS_RUN_DATE = dt.date(2001, 7, 28)
VISIT_RUN_DATE = dt.date(2024, 1, 27)
LOAD_TS = dt.datetime(2001, 8, 1, 6, 0, 0)

# Labels cycled through to build the comma-separated priority category lists.
PRIORITY_LABELS = (
    "ECONOMY", "SMALL", "LARGE", "STANDARD", "", "ECONOMY", "Other", "Cereal Bars",
)


def adapter_params(**overrides) -> MartParams:
    base = dict(pos_run_date=POS_RUN_DATE, visit_run_date=VISIT_RUN_DATE, load_ts=LOAD_TS)
    base.update(overrides)
    return MartParams(**base)


def _pad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def _s(c: Column) -> Column:
    return c.cast("string")


def load_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    names = ("region", "nation", "customer", "part", "orders", "lineitem", "events")
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def calendar_day(t: dict[str, DataFrame]) -> DataFrame:
    """One row per day over whole weeks spanning every date in the fact tables."""
    spans = (
        t["lineitem"].select(F.to_date("l_shipdate").alias("d"))
        .unionByName(t["orders"].select(F.to_date("o_orderdate").alias("d")))
        .unionByName(t["events"].select(F.to_date("ts").alias("d")))
        .agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    )
    days = spans.select(
        F.explode(F.sequence(fiscal.week_start(F.col("lo")), fiscal.week_end(F.col("hi")))).alias("fisc_dt")
    )
    d = F.col("fisc_dt")
    return days.select(
        d,
        fiscal.week_start(d).alias("fisc_wk_start_dt"),
        fiscal.week_end(d).alias("fisc_wk_end_dt"),
        fiscal.fiscal_year(d).alias("fisc_yr"),
        fiscal.fiscal_week(d).alias("fisc_wk"),
        fiscal.fiscal_year_week(d).alias("fisc_yr_wk"),
    )


def calendar_week(cal_day: DataFrame) -> DataFrame:
    return cal_day.select("fisc_yr", "fisc_wk", "fisc_yr_wk", "fisc_wk_end_dt").distinct()


def customer_pivot(t: dict[str, DataFrame]) -> DataFrame:
    c = t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey")).join(
        t["region"], F.col("n_regionkey") == F.col("r_regionkey")
    )
    k = F.col("c_custkey")
    no_terr = F.col("n_nationkey") % 12 == 11
    no_chain = k % 40 == 0
    rows = c.select(
        F.col("r_name").alias("hier_b_rgn_nm"),
        _pad(F.col("r_regionkey"), 2).alias("hier_b_rgn_nbr"),
        F.concat(F.col("r_name"), F.lit(" ZONE "), _s(F.col("n_nationkey") % 2)).alias("hier_b_area_nm"),
        F.concat(_pad(F.col("r_regionkey"), 2), _s(F.col("n_nationkey") % 2)).alias("hier_b_area_nbr"),
        F.when(~no_terr, F.col("n_name")).alias("hier_b_terr_nm"),
        F.when(~no_terr, _pad(F.col("n_nationkey"), 4)).alias("hier_b_terr_nbr"),
        F.substring("c_mktsegment", 1, 3).alias("hier_d_sales_mgmt_a_nbr"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("Specialty"))
        .otherwise(F.col("c_mktsegment")).alias("hier_d_sales_mgmt_a_nm"),
        F.when(F.col("n_nationkey") == 24, F.concat(F.col("n_name"), F.lit(" INACT")))
        .otherwise(F.col("n_name")).alias("plan_to_nm"),
        _pad(F.col("n_nationkey"), 10).alias("plan_to_nbr"),
        F.when(~no_chain, F.concat(F.lit("CHAIN "), _s(k % 40))).alias("chain_nm"),
        F.when(~no_chain, _pad(k % 40, 5)).alias("chain_nbr"),
        F.when(k % 50 == 7, F.lit("2002")).otherwise(F.lit("1001")).alias("sales_org_cd"),
        F.when(k % 97 == 5, F.concat(F.col("c_name"), F.lit(" INACTIVE")))
        .otherwise(F.col("c_name")).alias("sold_to_nm"),
        _pad(k, 10).alias("sold_to_nbr"),
        F.concat(F.lit("TD"), _pad(k, 7)).alias("tdlinx_nbr"),
        _pad(k % 1000, 4).alias("tdlinx_store_nbr"),
        F.concat(_s(k % 900 + 100), F.lit(" MAIN ST")).alias("street_nm"),
        F.concat(F.lit("CITY "), _s(F.col("n_nationkey"))).alias("city_nm"),
        F.substring("r_name", 1, 2).alias("rgn_cd"),
        _pad(k % 99991, 5).alias("pstl_cd"),
        F.when(k % 6 == 3, F.lit("")).when(k % 6 != 0, F.concat(F.lit("L4-"), _s(k % 7)))
        .alias("hier_b_level4_misc_nbr"),
        F.when(k % 2 == 0, F.lit("01")).otherwise(F.lit("00")).alias("sales_org_order_blok_cd"),
        F.when(k % 4 == 0, F.lit("04")).otherwise(F.lit("00")).alias("order_blok_cd"),
        F.lit("kna_ecc").alias("src_nm"),
        k.alias("_k"),
    )
    # A few stores are listed twice with a different street (attribute variants);
    # some of those second rows also sit in another chain.
    moved = F.col("_k") % 500 == 1
    variants = rows.filter(F.col("_k") % 250 == 1).select(
        *[F.concat(F.lit("ANNEX "), F.col("street_nm")).alias("street_nm") if c == "street_nm"
          else F.when(moved, F.lit("00099")).otherwise(F.col(c)).alias(c) if c == "chain_nbr"
          else F.when(moved, F.lit("CHAIN 99")).otherwise(F.col(c)).alias(c) if c == "chain_nm"
          else F.col(c) for c in rows.columns]
    )
    return rows.unionByName(variants).drop("_k")


def source_preference(t: dict[str, DataFrame]) -> DataFrame:
    return (
        t["nation"].filter(F.col("n_nationkey") != 3)
        .select(_pad(F.col("n_nationkey"), 10).alias("plan_to_nbr")).distinct()
    )


def _product_columns(p: Column) -> dict[str, Column]:
    medium = F.col("p_type") == "MEDIUM"
    return {
        "catg_nm": F.when(medium, F.lit("Frozen Meals")).otherwise(F.col("p_type")),
        "catg_cd": F.when(F.col("p_type") == "PROMO", F.lit("2040")).otherwise(F.lit("1000")),
        "comrcl_catg_cd": F.when(p % 50 == 1, F.lit("WIP")).when(p % 50 == 2, F.lit("wip"))
        .when(p % 50 != 3, F.lit("RTL")),
        "brand_nm": F.when(p % 211 != 0, F.col("p_brand")),
        "spin_ind": F.when(medium | (p % 7 == 0), F.lit(0)).otherwise(F.lit(1)),
        "klnva_retn_brand_ind": F.when(~medium & (p % 14 == 0), F.lit(1)).otherwise(F.lit(0)),
    }


def product_by_gtin(t: dict[str, DataFrame]) -> DataFrame:
    p = F.col("p_partkey")
    cols = _product_columns(p)
    return t["part"].select(
        F.when(p % 97 == 13, F.lit(" ")).otherwise(_pad(p, 14)).alias("gtin"),
        cols["catg_nm"].alias("catg_nm"),
        cols["catg_cd"].alias("catg_cd"),
        cols["comrcl_catg_cd"].alias("comrcl_catg_cd"),
        cols["brand_nm"].alias("brand_nm"),
        F.when(F.col("p_size") > 40, F.lit("IC")).when(F.col("p_size") > 35, F.lit(""))
        .alias("immed_cnsmptn_prod_type_cd"),
        cols["spin_ind"].alias("spin_ind"),
        cols["klnva_retn_brand_ind"].alias("klnva_retn_brand_ind"),
    )


def product_by_material(t: dict[str, DataFrame]) -> DataFrame:
    p = F.col("p_partkey")
    cols = _product_columns(p)
    return t["part"].select(
        _pad(p, 18).alias("matrl_nbr"),
        *[v.alias(k) for k, v in cols.items()],
    )


def shipments(t: dict[str, DataFrame]) -> DataFrame:
    j = t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
    d = F.to_date("l_shipdate")
    return j.select(
        _s(fiscal.fiscal_year(d)).alias("fisc_yr"),
        _s(fiscal.fiscal_week(d)).alias("fisc_wk"),
        _pad(F.col("o_custkey"), 10).alias("sold_to_nbr"),
        _pad(F.col("l_partkey"), 18).alias("matrl_nbr"),
        F.when(F.col("l_orderkey") % 19 == 0, F.lit("2002")).otherwise(F.lit("1001")).alias("sales_org_cd"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("dir_indir_gsv"),
        F.when(F.col("l_orderkey") % 5 == 0, F.lit("kna_bw")).otherwise(F.lit("kna_ecc")).alias("src_nm"),
        F.col("l_shipdate").cast(TS).alias("kortex_upld_ts"),
        F.lit(None).cast(TS).alias("kortex_dprct_ts"),
    )


def pos_weekly(t: dict[str, DataFrame]) -> DataFrame:
    """Weekly POS at store x category x brand x corporation; year-ago = same grain 364 days earlier.

    A line's current and year-ago rows are united before the joins, so that orders, customers and
    parts are read and shuffled once; a filter on the week still reaches both scans of the lines.
    The joined lines are dealt by store, as they are and before the six measures are made of them, over all
    partitions: several aggregations follow in the same tasks, which must not be merged to few large ones.
    """
    lines = t["lineitem"].select(
        "l_orderkey", "l_partkey", "l_suppkey", F.to_date("l_shipdate").alias("d"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("v"), "l_quantity", F.col("l_shipdate").cast(TS).alias("ts"))
    lines = lines.select(fiscal.fiscal_year_week(F.col("d")).alias("fisc_yr_wk"), F.lit(False).alias("ya"), *lines.columns).unionByName(
        lines.select(fiscal.fiscal_year_week(F.date_add(F.col("d"), 364)).alias("fisc_yr_wk"), F.lit(True).alias("ya"), *lines.columns)).drop("d")
    bought = t["orders"].select("o_orderkey", "o_custkey").join(
        t["customer"].select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    j = lines.join(bought, F.col("l_orderkey") == F.col("o_orderkey")).join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
    s = F.col("l_suppkey")
    base = j.select(
        "fisc_yr_wk", "ya",
        _pad(F.col("o_custkey"), 10).alias("sold_to_nbr"),
        _pad(F.col("c_nationkey"), 10).alias("plan_to_nbr"),
        F.when(F.col("p_size") <= 2, F.lit("Others"))
        .when(F.col("p_type") == "MEDIUM", F.lit("Frozen Meals"))
        .otherwise(F.col("p_type")).alias("catg_nm"),
        F.col("p_brand").alias("brand_nm"),
        F.when(s % 2 == 0, F.lit(OWN_CORP)).when(s % 31 == 3, F.lit(None))
        .when(s % 4 == 1, F.lit("COMPETITOR A")).otherwise(F.lit("COMPETITOR B")).alias("corp_nm"),
        F.when(F.col("p_size") > 40, F.lit("IC")).alias("immed_cnsmptn_prod_type_cd"),
        "v",
        F.col("l_quantity").cast("decimal(18,2)").alias("q"),
        (F.col("l_quantity") * F.col("p_size")).cast("decimal(18,2)").alias("lb"),
        "ts",
    )
    zero = F.lit(0).cast("decimal(18,2)")
    keys = ["sold_to_nbr", "plan_to_nbr", "catg_nm", "brand_nm", "corp_nm", "immed_cnsmptn_prod_type_cd"]
    sides = [F.when(F.col("ya") == side, F.col(c)).otherwise(zero).alias(name) for c, pair in (
        ("v", ("sale_val", "sale_yr_ago_val")), ("q", ("sale_qty", "sale_yr_ago_qty")), ("lb", ("sale_vol_lb_val", "sale_yr_ago_vol_lb_val")))
        for side, name in zip((False, True), pair)]
    measures = ["sale_val", "sale_yr_ago_val", "sale_qty", "sale_yr_ago_qty",
                "sale_vol_lb_val", "sale_yr_ago_vol_lb_val"]
    return (
        base.repartition(grid_partitions(base.sparkSession), "sold_to_nbr").select("fisc_yr_wk", *keys, *sides, "ts")
        .groupBy("fisc_yr_wk", *keys)
        .agg(*[F.sum(m).alias(m) for m in measures], F.max("ts").alias("kortex_upld_ts"))
        .select(
            "fisc_yr_wk", *keys, *measures, F.lit("nielsen").alias("src_nm"),
            "kortex_upld_ts", F.lit(None).cast(TS).alias("kortex_dprct_ts"),
        )
    )


def _visit_guid() -> Column:
    return F.concat(_s(F.col("user_id")), F.lit("-"), _s(F.to_date("ts")))


def visit_audit(t: dict[str, DataFrame], n_parts: int) -> DataFrame:
    item = _s(F.col("event_id") % F.lit(n_parts))
    et = F.col("event_type")
    return t["events"].select(
        _visit_guid().alias("visit_guid"),
        _pad(F.col("user_id"), 10).alias("sold_to_nbr"),
        F.col("ts").cast(TS).alias("actl_start_dt_time"),
        et.alias("actn_desc"),
        F.when(et == "error", F.lit("Phantom")).when(et == "click", F.lit("Price Check"))
        .alias("orchestro_item_alert_val"),
        F.when((et == "signup") & (F.col("value") > 50), F.lit(1)).otherwise(F.lit(0))
        .alias("rep_item_alert_val"),
        item.alias("prod_pack_extrnl_nbr"),
        F.lpad(item, 14, "0").alias("prod_pack_gtin"),
        F.lit("SIF_Raw").alias("src_nm"),
        F.col("ts").cast(TS).alias("kortex_upld_ts"),
        F.lit(None).cast(TS).alias("kortex_dprct_ts"),
    )


def priority_stat(t: dict[str, DataFrame]) -> DataFrame:
    labels = F.array(*[F.lit(x) for x in PRIORITY_LABELS])
    eid = F.col("event_id")
    n = (eid % 8 + 1).cast("int")
    parts = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda j: F.element_at(labels, ((eid + j) % 8 + 1).cast("int")),
    )
    return t["events"].select(
        _visit_guid().alias("visit_guid"),
        _pad(F.col("user_id"), 10).alias("sold_to_nbr"),
        F.array_join(parts, ", ").alias("mult_catg_nm"),
        fiscal.fiscal_year_week(F.to_date("ts")).alias("fisc_yr_wk"),
        F.concat(F.lit("P"), _s(eid % 5)).alias("priorty_nbr"),
        F.when(F.col("event_type") == "purchase", F.lit(1)).otherwise(F.lit(0)).alias("up_in_store_ind"),
        F.when(eid % 23 == 0, F.lit("manual")).otherwise(F.lit("sif_raw")).alias("src_nm"),
    )


def build_sources(spark: SparkSession, sf_dir: str) -> SourceTables:
    t = load_tables(spark, sf_dir)
    cal_day = calendar_day(t)
    n_parts = t["part"].count()  # one scalar, used as the item-number modulus
    return SourceTables(
        cal_day=cal_day,
        cal_wk=calendar_week(cal_day),
        cust_pivot=customer_pivot(t),
        src_pref=source_preference(t),
        prod_gtin=product_by_gtin(t),
        prod_matrl=product_by_material(t),
        shipments=shipments(t),
        pos_weekly=pos_weekly(t),
        visit_audit=visit_audit(t, n_parts),
        priority_stat=priority_stat(t),
    )
