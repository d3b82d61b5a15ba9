"""Schemas of the mart (sink) and of the intermediate mart rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TS = "timestamp_ntz"

_KEYS = [
    ("hier_type_cd", "string"), ("metrc_nm", "string"), ("sub_metrc_nm", "string"),
    ("tmfrm_cd", "string"), ("tmfrm_desc", "string"), ("fisc_yr", "int"),
    ("sold_to_nbr", "string"), ("chain_nbr", "string"), ("chain_nm", "string"),
    ("plan_to_nm", "string"), ("plan_to_nbr", "string"), ("sales_org_cd", "string"),
    ("catg_nm", "string"), ("mult_catg_nm", "string"), ("brand_nm", "string"),
    ("corp_nm", "string"),
]
_POS = [(c, "double") for c in (
    "sale_val", "sale_yr_ago_val", "sale_qty", "sale_yr_ago_qty", "sale_val_share_pct",
    "sale_yr_ago_val_share_pct", "store_sale_val", "store_sale_yr_ago_val", "store_sale_qty",
    "store_sale_yr_ago_qty", "store_sale_vs_yr_ago_val_pct", "store_sale_vs_yr_ago_qty_pct",
    "chain_sale_val", "chain_sale_yr_ago_val", "chain_sale_qty", "chain_sale_yr_ago_qty",
    "chain_sale_vs_yr_ago_val_pct", "chain_sale_vs_yr_ago_qty_pct",
)]
_RANKS = [
    ("chain_store_sale_val_rank", "bigint"), ("chain_store_sale_qty_rank", "bigint"),
    ("brand_sale_rank", "bigint"), ("sale_vs_yr_ago_val", "double"),
    ("sale_vs_yr_ago_val_pct", "double"), ("prfmnc_drvr_rank", "bigint"),
    ("chain_store_cnt", "bigint"),
]
_DRIVERS = [(c, "double") for c in (
    "up_in_store_val", "ans_in_store_val", "visit_in_store_val", "true_in_store_val",
    "true_in_store_wk_cnt", "chain_up_in_store_val", "chain_ans_in_store_val",
    "chain_visit_in_store_val", "chain_true_in_store_val", "chain_true_in_store_wk_cnt",
    "visit_cnt", "oos_alert_cnt", "chain_visit_cnt", "chain_oos_alert_cnt",
)]
STORE_ATTRIBUTES = [
    "sold_to_nm", "sold_to_desc", "rgn_nm", "rgn_nbr", "zn_nm", "zn_nbr", "terr_nm", "terr_nbr",
    "chnl_nm", "chnl_nbr", "tdlinx_nbr", "store_nm", "street_nm", "city_nm", "rgn_cd", "pstl_cd",
    "store_nbr", "prev_acct_nbr", "vndr_nm",
]
_AUDIT = [
    ("val_curr_cd", "string"), ("qty_uom", "string"), ("latst_data_avail_dt", "date"),
    ("src_nm", "string"), ("hash_key", "string"), ("kortex_upld_ts", TS),
    ("kortex_dprct_ts", TS), ("kortex_cre_ts", TS), ("kortex_updt_ts", TS),
]

MART_COLUMNS: list[tuple[str, str]] = (
    _KEYS + _POS + _RANKS + _DRIVERS + [(c, "string") for c in STORE_ATTRIBUTES] + _AUDIT
)
MART_TYPES = dict(MART_COLUMNS)

# Columns the UPDATE-from-store-master step overwrites (25 columns).
ENRICHED_COLUMNS = [
    "rgn_nm", "rgn_nbr", "zn_nm", "zn_nbr", "terr_nm", "terr_nbr", "chnl_nm", "chnl_nbr",
    "plan_to_nm", "plan_to_nbr", "chain_nm", "chain_nbr", "sales_org_cd", "sold_to_nm",
    "sold_to_nbr", "sold_to_desc", "tdlinx_nbr", "store_nm", "street_nm", "city_nm", "rgn_cd",
    "pstl_cd", "store_nbr", "prev_acct_nbr", "vndr_nm",
]


def mart_struct():
    from pyspark.sql.types import StructType, _parse_datatype_string

    return StructType.fromDDL(", ".join(f"{c} {t}" for c, t in MART_COLUMNS)) if hasattr(
        StructType, "fromDDL") else _parse_datatype_string(", ".join(f"{c} {t}" for c, t in MART_COLUMNS))


def empty_mart(spark) -> DataFrame:
    """The mart's schema with no rows (the original clones it with an always-false select)."""
    return spark.createDataFrame([], mart_struct())


def to_mart_rows(df: DataFrame, extra: list = ()) -> DataFrame:
    """Align a family's insert to the full mart column list; missing columns are NULL.

    Equivalent of ``INSERT INTO mart (subset of columns) SELECT ...``.
    """
    present = set(df.columns)
    return df.select(*[
        (F.col(c) if c in present else F.lit(None)).cast(t).alias(c) for c, t in MART_COLUMNS
    ], *extra)
