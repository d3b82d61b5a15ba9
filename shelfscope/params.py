"""Job parameters and the fixed values the mart must reproduce."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# --- Fixed values (must equal the original job's literals for identical results) ---
OWN_CORP = "KELLANOVA"
METRIC_EVENTS = "EVENTS"
METRIC_OOS = "OOS"
METRIC_POS_PRFM = "POS_PRFM"
CATG_INDIVIDUAL = "(Individual)"
CATG_ALL = "(All)"
CATG_EVENT = "(Event Categories)"
HIER_COVERED = "REX_COVERED"
HIER_NON_COVERED = "REX_NON_COVERED"
SALES_ORG = "1001"
BLOCKED_CHANNELS = ("CANADA L3", "REMARKETING", "PUREPLAY E-COMMERCE", "SPECIALTY")
STORE_INACTIVE_PATTERN = "%INACT%"
SHIPMENT_INACTIVE_PATTERN = "%INACTIVE%"
RETAIL_ORG_BLOCK = "01"
RETAIL_ORDER_BLOCK = "04"
IC_LABEL = "Immediate Consumption"
EXCLUDED_CATG_CODES = ("2040",)
WIP_CODE = "WIP"
EXCLUDED_POS_PLAN_TOS = ("0000300850",)
COMPETITOR_EXCLUDED_CATG = "Others"
EXTRA_PLAIN_CATG = "Frozen Meals"
OOS_ALERT_VALUES = (
    "Phantom", "Zero Inventory", "LowSales", "Low Sales", "Off Shelf",
    "Phantom Alert", "Neg Inventory", "Innov No Sales", "Distro Void",
)
PRIORITY_SOURCE = "sif_raw"
PRIORITY_BLOCKED = (
    "#REF!", "_XFFFF__XFFFF_", "PWS", "FROZEN", "NEW", "", "CIRCULAR AD", "CHECK FOR",
    "FEATURE & DISPLAY", "WINCO ORDER CODE", "OTHER", "#REF!", "NULL",
)
PRIORITY_BLOCKED_PATTERN = "%CEREAL%"
DRIVER_SOURCE = "kna_ecc"
CURRENCY_CODE = "dol"
QTY_UOM = "each"
NON_COVERED_GEO_LABEL = "RETAIL NON-COVERED STORES"
FRAME_DESCRIPTIONS = {"L4W": "Last 4 Weeks", "L13W": "Last 13 Weeks", "YTD": "Year to Date"}
WEEKLY_LABELS = {"WEEKLY_N13W": "Next 13 Weeks", "WEEKLY_L13W": "Last 13 Weeks"}
YEAR_AGO_DAYS = 364
# --- end of fixed values ---


@dataclass(frozen=True)
class MartParams:
    """Run parameters.

    ``pos_run_date``/``visit_run_date`` are the procedure argument; when unset
    they resolve to the fiscal week end of ``today - 14 days``.  ``load_ts`` is
    the load timestamp written to the audit columns; unset, it is the job's start.
    """

    pos_run_date: dt.date | None = None
    visit_run_date: dt.date | None = None
    today: dt.date | None = None
    load_ts: dt.datetime | None = None
    own_corp: str = OWN_CORP
    strict_hash_key: bool = False
    merge_sources: bool = False
    # Parts of a priority's category list that count, as in the original job; None: all.
    priority_max_parts: int | None = 7
    # Folder name of this run's stage tables (set by MartJob).
    run_id: str = "adhoc"
