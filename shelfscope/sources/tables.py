"""The source tables the mart is built from: Parquet folders or catalog tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SOURCE_NAMES = (
    "cal_day",        # fiscal day calendar
    "cal_wk",         # fiscal week calendar
    "cust_pivot",     # customer (store) hierarchy
    "src_pref",       # plan-to source preference
    "prod_gtin",      # product hierarchy by GTIN
    "prod_matrl",     # product hierarchy by material number
    "shipments",      # shipment (gross sales value) detail
    "pos_weekly",     # weekly point-of-sale by store/category/brand/corporation
    "visit_audit",    # store visit item audits
    "priority_stat",  # store priority answers
)


@dataclass(frozen=True)
class SourceTables:
    cal_day: DataFrame
    cal_wk: DataFrame
    cust_pivot: DataFrame
    src_pref: DataFrame
    prod_gtin: DataFrame
    prod_matrl: DataFrame
    shipments: DataFrame
    pos_weekly: DataFrame
    visit_audit: DataFrame
    priority_stat: DataFrame


CATALOG = "catalog:"

#: The day of a visit, as a partition column of a fact that is laid out by day.
VISIT_DAY = "visit_dt"
#: Columns that the facts may be partitioned by (see ``sources.layout``).
FACT_PARTITIONS = {"pos_weekly": ["fisc_yr_wk"], "shipments": ["fisc_yr", "fisc_wk"], "visit_audit": [VISIT_DAY]}


def read_table(spark: SparkSession, path: str, partitions: list[str] = (), only: list[str] = ()) -> DataFrame:
    """A Parquet folder, or ``only`` some of its partition folders; partition values that look like numbers stay the strings they were (a fiscal week has no leading zeros)."""
    df = spark.read.option("basePath", path).parquet(*[f"{path}/{o}" for o in only]) if only else spark.read.parquet(path)
    texts = {c for c, t in df.dtypes if c in partitions and c == "fisc_yr_wk" and t != "string"}
    return df.select(*[F.col(c).cast("string").alias(c) if c in texts else F.col(c) for c in df.columns])


def read_sources(spark: SparkSession, root: str) -> SourceTables:
    """The ten source tables: Parquet folders ``<root>/<name>``, or the tables of ``catalog:<database>``."""
    if root.startswith(CATALOG):
        return SourceTables(**{n: spark.table(f"{root[len(CATALOG):]}.{n}") for n in SOURCE_NAMES})
    return SourceTables(**{n: read_table(spark, f"{root}/{n}", FACT_PARTITIONS.get(n, [])) for n in SOURCE_NAMES})
