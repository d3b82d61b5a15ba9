"""Helpers shared by the training-data operators: stage tables, words, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but these six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def stage_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; raises where it is unset.

    Stage tables must be readable by every executor and by the driver, so there
    is no machine-local fallback here: tests and the entry module set a folder.
    """
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise RuntimeError("spark.checkpoint.dir is unset: name a folder that all executors share")
    return root.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    It cuts the lineage: a lost executor costs its running tasks only, and a
    table that is read several times is computed once.
    """
    spark = df.sparkSession
    path = f"{stage_root(spark)}/llm-stages/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def word_count(col: str = "text") -> Column:
    """Number of words of a text, 0 for null."""
    return F.regexp_count(text_or_empty(col), F.lit(WORD)).cast("long")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node reachable.

    Alternating large-star and small-star steps. Each step is one aggregation
    (partial, so a hub costs one row per task) and one sort-merge join whose
    hub keys the adaptive engine may split. Nothing is collected but one
    checksum row per round. Converges in O(log^2) rounds.
    """
    e = stage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )

    def checksum(df: DataFrame):
        return tuple(df.select(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    seen = checksum(e)
    while seen[0]:
        # Large star: every larger neighbour of u is linked to the smallest of u's neighbourhood.
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        large = stage(large, "large-star")
        # Small star: u and all its smaller neighbours are linked to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("p")
        )
        e = stage(small.select("p.u", "p.v").where("u <> v").distinct(), "small-star")
        now = checksum(e)
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return stage(e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots), "components")
