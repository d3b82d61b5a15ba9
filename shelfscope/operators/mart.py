"""Mart assembly: family union, pruning, location rows, enrichment, final projection."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfscope.functions.columns import blank_to
from shelfscope.params import (
    CURRENCY_CODE, DRIVER_SOURCE, HIER_COVERED, HIER_NON_COVERED, NON_COVERED_GEO_LABEL, QTY_UOM,
    MartParams,
)
from shelfscope.plans.stages import materialize
from shelfscope.sources.schemas import ENRICHED_COLUMNS, MART_COLUMNS, TS, to_mart_rows


def mart_union(families: list[DataFrame]) -> DataFrame:
    """Every family's rows aligned to the mart columns (missing columns NULL).

    Each family is built once and inserted once, so the per-family "delete then
    insert" of the original is a plain union here.
    """
    return reduce(lambda a, b: a.unionByName(b), [to_mart_rows(f) for f in families])


#: Exact totals by category that decide whether a category is empty, and the measures they add up.
TOTALS = {"_v": "sale_val", "_t": "true_in_store_val", "_o": "oos_alert_cnt"}
#: In stored family rows: the category before its default, by which empty categories are left out.
PRUNE_KEY = "prune_catg_nm"


def category_totals(rows: DataFrame) -> DataFrame:
    """Exact additive totals by category of rows that have some of the measures.

    Decimal sums: independent of order, and exact where positives and negatives cancel.
    """
    def measure(c: str):
        value = F.col(c).cast("double").cast("decimal(28,6)") if c in rows.columns else F.lit(None).cast("decimal(28,6)")
        return F.coalesce(F.sum(value), F.lit(0)).cast("decimal(38,6)")

    return rows.groupBy("catg_nm").agg(*[measure(c).alias(t) for t, c in TOTALS.items()])


def zero_totals(catgs: DataFrame) -> DataFrame:
    """Totals of categories (catg_nm) that have rows, but no values."""
    return catgs.select("catg_nm", *[F.lit(0).cast("decimal(38,6)").alias(t) for t in TOTALS]).distinct()


def empty_of_totals(totals: DataFrame) -> DataFrame:
    """Categories whose value, true-in-store and alert totals are all <= 0 across every family's totals."""
    sums = totals.groupBy("catg_nm").agg(*[F.sum(t).alias(t) for t in TOTALS])
    return sums.filter(~((F.col("_v") > 0) | (F.col("_t") > 0) | (F.col("_o") > 0))).select("catg_nm")


def prune_empty_categories(rows: DataFrame, empty: DataFrame | None = None) -> DataFrame:
    """P50: drop rows of empty categories (an anti join, so a NULL category stays)."""
    empty = empty_of_totals(category_totals(rows)) if empty is None else empty
    return rows.join(empty, "catg_nm", "left_anti")


def drop_blank_store_rows(rows: DataFrame) -> DataFrame:
    """``DELETE ... WHERE sold_to_nbr = ''`` before the location rows are added (NULL stays)."""
    return rows.filter(F.col("sold_to_nbr").isNull() | (F.col("sold_to_nbr") != ""))


LOCATION_COLUMNS = ["hier_type_cd", "metrc_nm", "chain_nbr", "chain_nm", "rgn_nbr", "rgn_nm", "zn_nbr",
                    "zn_nm", "terr_nbr", "terr_nm", "plan_to_nbr", "plan_to_nm", "sales_org_cd", "corp_nm",
                    "sold_to_nbr", "chain_store_cnt", "src_nm"]


def location_rows(spr_stores: DataFrame, params: MartParams) -> DataFrame:
    """Location master rows at four grains (not grouping sets: filters, the store
    number and the store count differ per grain)."""
    null_s = F.lit(None).cast("string")

    def grain(df: DataFrame, chain: bool, plan_to: bool, sold_to, count) -> DataFrame:
        return df.select(
            "hier_type_cd", F.lit("POS").alias("metrc_nm"),
            (F.col("chain_nbr") if chain else null_s).alias("chain_nbr"),
            (F.col("chain_nm") if chain else null_s).alias("chain_nm"),
            "rgn_nbr", "rgn_nm", "zn_nbr", "zn_nm", "terr_nbr", "terr_nm",
            (F.col("plan_to_nbr") if plan_to else null_s).alias("plan_to_nbr"),
            (F.col("plan_to_nm") if plan_to else null_s).alias("plan_to_nm"),
            "sales_org_cd", F.lit(params.own_corp).alias("corp_nm"), sold_to.alias("sold_to_nbr"),
            count.cast("bigint").alias("chain_store_cnt"), "src_nm",
        ).distinct()

    covered = spr_stores.filter(F.col("hier_type_cd") == HIER_COVERED)
    counts = covered.groupBy("chain_nbr").agg(F.countDistinct("sold_to_nbr").alias("_cnt"))
    nc = spr_stores.filter(F.col("hier_type_cd") == HIER_NON_COVERED)
    parts = [
        grain(covered.join(counts, "chain_nbr"), True, True, F.lit(""), F.col("_cnt")),
        grain(nc, False, False, null_s, F.lit(None)),
        grain(nc, False, True, null_s, F.lit(None)),
        grain(nc, True, True, null_s, F.lit(None)),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def store_attributes(spr_stores: DataFrame) -> DataFrame:
    """One attribute row per store (the UPDATE source); a store listed with differing
    attributes takes the first row in column order, so reruns are deterministic."""
    cols = [c for c in ENRICHED_COLUMNS if c != "sold_to_nbr"]
    w = Window.partitionBy("sold_to_nbr").orderBy(*[F.col(c).asc_nulls_first() for c in cols])
    return spr_stores.select("sold_to_nbr", *cols).withColumn("_rn", F.row_number().over(w)).filter(
        F.col("_rn") == 1).drop("_rn")


#: The store's attributes on rows that met them before they were multiplied (NULL: the store is not in the master).
STORE_STRUCT = "_store"


def with_store_struct(rows: DataFrame, attrs: DataFrame) -> DataFrame:
    """``rows`` with their store's attribute row as one struct; one row per store, so no row fans out."""
    a = attrs.select("sold_to_nbr", F.struct(*ENRICHED_COLUMNS).alias(STORE_STRUCT))
    return rows.join(a, "sold_to_nbr", "left")


def enrich_with_store(rows: DataFrame, spr_stores: DataFrame, params: MartParams,
                      attrs: DataFrame | None = None, extra: list[str] = ()) -> DataFrame:
    """Overwrite the 25 store columns on rows whose store is in the master.

    The attribute side has one row per store, so the mart never fans out.  It is a
    stage table: Spark picks the join by its size in bytes.  Rows of the dense families
    bring the attributes along (``STORE_STRUCT``) and meet nothing.
    """
    if STORE_STRUCT in rows.columns:
        hit = F.col(STORE_STRUCT).isNotNull()
        return rows.select(*[
            F.when(hit, F.col(f"{STORE_STRUCT}.{c}")).otherwise(F.col(c)).alias(c) if c in ENRICHED_COLUMNS else F.col(c)
            for c, _ in MART_COLUMNS
        ], *extra)
    attrs = materialize(store_attributes(spr_stores), params) if attrs is None else attrs
    a = attrs.select(F.col("sold_to_nbr").alias("_e_key"), F.lit(True).alias("_e_hit"),
                     *[F.col(c).alias(f"_e_{c}") for c in ENRICHED_COLUMNS])
    j = rows.join(a, F.col("sold_to_nbr") == F.col("_e_key"), "left")
    hit = F.col("_e_hit").isNotNull()
    return j.select(*[
        F.when(hit, F.col(f"_e_{c}")).otherwise(F.col(c)).alias(c) if c in ENRICHED_COLUMNS else F.col(c)
        for c, _ in MART_COLUMNS
    ], *extra)


def final_projection(rows: DataFrame, pos_run_dt: dt.date, params: MartParams, extra: list[str] = ()) -> DataFrame:
    """Defaults, non-covered geography label, constants, run date, hash key, load time."""
    own = params.own_corp
    geo_blank = (F.col("hier_type_cd") == HIER_NON_COVERED) & (blank_to("terr_nbr") == "")

    def geo(c: str):
        return F.when(geo_blank, F.lit(NON_COVERED_GEO_LABEL)).otherwise(blank_to(c))

    defaulted = {
        "hier_type_cd": blank_to("hier_type_cd", HIER_COVERED),
        "fisc_yr": F.coalesce(F.col("fisc_yr"), F.lit(0)),
        "corp_nm": blank_to("corp_nm", own),
        "src_nm": blank_to("src_nm", DRIVER_SOURCE),
    }
    text_default = ["metrc_nm", "sub_metrc_nm", "tmfrm_cd", "tmfrm_desc", "sold_to_nbr", "chain_nbr",
                    "chain_nm", "plan_to_nm", "plan_to_nbr", "sales_org_cd", "catg_nm", "mult_catg_nm",
                    "brand_nm", "sold_to_nm", "sold_to_desc", "chnl_nm", "chnl_nbr", "tdlinx_nbr",
                    "store_nm", "street_nm", "city_nm", "rgn_cd", "pstl_cd", "store_nbr", "prev_acct_nbr",
                    "vndr_nm"]
    for c in text_default:
        defaulted[c] = blank_to(c)
    for c in ("rgn_nm", "rgn_nbr", "zn_nm", "zn_nbr", "terr_nm", "terr_nbr"):
        defaulted[c] = geo(c)
    key_parts = ["src_nm", "metrc_nm", "sub_metrc_nm", "tmfrm_cd", "tmfrm_desc", "fisc_yr", "sold_to_nbr",
                 "catg_nm", "mult_catg_nm", "brand_nm", "corp_nm"]
    source = {c: F.col(c) for c in key_parts} if params.strict_hash_key else defaulted
    hash_key = F.md5(F.concat(*[source[c].cast("string") for c in key_parts]))
    load_ts = (F.lit(params.load_ts.isoformat(sep=" ")) if params.load_ts else F.current_timestamp()).cast(TS)
    defaulted.update({
        "val_curr_cd": F.lit(CURRENCY_CODE),
        "qty_uom": F.lit(QTY_UOM),
        "latst_data_avail_dt": F.lit(pos_run_dt).cast("date"),
        "hash_key": hash_key,
        "kortex_cre_ts": load_ts,
        "kortex_updt_ts": load_ts,
    })
    return rows.select(*[
        defaulted.get(c, F.col(c)).cast(t).alias(c) for c, t in MART_COLUMNS
    ], *extra)


def _mart_rows(rows: DataFrame) -> DataFrame:
    """``to_mart_rows`` that keeps the store's attributes where the rows have them."""
    kept = [F.col(STORE_STRUCT)] if STORE_STRUCT in rows.columns else []
    return to_mart_rows(rows, kept)


def enriched_family(rows: DataFrame, spr_stores: DataFrame, attrs: DataFrame, params: MartParams, empty: DataFrame | None = None) -> DataFrame:
    """P50 and P52 on one family's rows: prune (where ``empty`` is given) and enrich."""
    rows = _mart_rows(rows)
    if empty is not None:
        rows = prune_empty_categories(rows, empty)
    return enrich_with_store(rows, spr_stores, params, attrs)


def finish_family(rows: DataFrame, spr_stores: DataFrame, attrs: DataFrame, pos_run_dt: dt.date, params: MartParams,
                  empty: DataFrame | None = None) -> DataFrame:
    """P50-P53 on one family's rows: prune (where ``empty`` is given), drop blank stores, enrich, project.

    Each family keeps its own narrow plan, so the (mostly NULL) mart columns
    constant-fold per family instead of being evaluated on the 83-column union.
    """
    return final_projection(enriched_family(rows, spr_stores, attrs, params, empty), pos_run_dt, params)


def stored_family(rows: DataFrame, spr_stores: DataFrame, attrs: DataFrame, pos_run_dt: dt.date, params: MartParams) -> DataFrame:
    """A family as it is stored: finished but not pruned, with the category that pruning goes by."""
    rows = _mart_rows(rows)
    enriched = enrich_with_store(rows.withColumn(PRUNE_KEY, F.col("catg_nm")), spr_stores, params, attrs, [PRUNE_KEY])
    return final_projection(enriched, pos_run_dt, params, [PRUNE_KEY])


#: The families that the original deletes and inserts one at a time, as conditions on the mart's rows.
FAMILIES = {
    "SHP": "metrc_nm = 'SHP'",
    "KEY_BRAND": "metrc_nm = 'KEY_BRAND'",
    "POS": "metrc_nm = 'POS' AND sub_metrc_nm = '' AND tmfrm_cd <> ''",
    "POS_WEEKLY": "metrc_nm = 'POS' AND sub_metrc_nm <> ''",
    "POS_LOCATION": "metrc_nm = 'POS' AND sub_metrc_nm = '' AND tmfrm_cd = ''",
    "POS_CATG_AMPS": "metrc_nm = 'POS_CATG_AMPS'",
    "DRIVERS": "metrc_nm IN ('EVENTS', 'OOS', 'POS_PRFM')",
}
