"""SQL ``RANK()`` within groups, without sending a whole large group to one task.

``RANK() OVER (PARTITION BY g ORDER BY v)`` is ``1 +`` the number of rows of the
group that sort strictly before the row.  The group's rows are collapsed to
distinct values with counts (partial aggregation), the value range of each group
is cut into about ``buckets`` ranges at approximate quantiles, and the prefix
counts come from two bounded windows: one over the buckets of a group, one over
the distinct values of a bucket.  The ranks are exact; the quantiles only
balance the work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfscope.functions.joins import join_back


def rank_within(df: DataFrame, groups: Sequence[str], order: Column, out: str, *,
                descending: bool, nulls_first: bool, buckets: int = 64) -> DataFrame:
    """Add ``out`` = RANK() over ``groups`` ordered by the numeric ``order`` expression.

    NULL group keys form one group (as in a window partition); NULL order values
    sort first or last as requested.
    """
    g = list(groups)
    key = (-order if descending else order).cast("double")
    keyed = df.withColumn("_rk_key", key)
    vals = keyed.select(*g, "_rk_key")
    counts = vals.filter(F.col("_rk_key").isNotNull()).groupBy(*g, "_rk_key").agg(F.count(F.lit(1)).alias("_c"))
    nulls = vals.filter(F.col("_rk_key").isNull()).groupBy(*g).agg(F.count(F.lit(1)).alias("_nulls"))
    cuts = [i / buckets for i in range(1, buckets)]
    per_group = counts.groupBy(*g).agg(
        F.percentile_approx("_rk_key", cuts).alias("_splits"), F.sum("_c").alias("_nonnull"))
    bucketed = join_back(counts, per_group, g, "inner", g).withColumn(
        "_b", F.size(F.filter("_splits", lambda s: s < F.col("_rk_key"))))
    before = Window.unboundedPreceding, -1
    bucket_tot = bucketed.groupBy(*g, "_b").agg(F.sum("_c").alias("_bt"))
    bucket_off = bucket_tot.withColumn(
        "_bo", F.coalesce(F.sum("_bt").over(Window.partitionBy(*g).orderBy("_b").rowsBetween(*before)), F.lit(0)))
    within = bucketed.withColumn(
        "_wp", F.coalesce(F.sum("_c").over(Window.partitionBy(*g, "_b").orderBy("_rk_key").rowsBetween(*before)),
                          F.lit(0)))
    value_rank = join_back(within, bucket_off.drop("_bt"), [*g, "_b"], "inner", g)
    value_rank = join_back(value_rank, nulls, g, "left", g).select(
        *g, "_rk_key",
        (F.lit(1) + F.col("_bo") + F.col("_wp")
         + (F.coalesce(F.col("_nulls"), F.lit(0)) if nulls_first else F.lit(0))).cast("bigint").alias(out))
    null_rank = join_back(nulls, per_group.drop("_splits"), g, "left", g).select(
        *g, F.lit(None).cast("double").alias("_rk_key"),
        (F.lit(1) if nulls_first else F.lit(1) + F.coalesce(F.col("_nonnull"), F.lit(0))).cast("bigint").alias(out))
    ranks = value_rank.unionByName(null_rank)
    return join_back(keyed, ranks, [*g, "_rk_key"], "left", [*g, "_rk_key"]).drop("_rk_key")
