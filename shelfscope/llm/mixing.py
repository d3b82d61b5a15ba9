"""Mixing sources to target weights by weighted fair queueing.

Every document copy gets a virtual finish time: the words its source has issued
up to and including it, divided by the source's target. Copies are ordered by
that time over all sources, and the mix ends at the total word budget.

Defined results
---------------
* null or blank text: size 0, taken 0; the row is returned.
* null source: a source of its own, ordered last.
* null doc_id and repeated rows: each row is a document of its own.
* ties in finish time: source order, then shuffle key, then copy number.
* empty table: empty result. Other columns of the input are ignored.

Scale
-----
The text is read once; what is shuffled is (source, size, key) per document.
A source's running total is a sum of hash-range buckets (pre-aggregated) plus a
window inside one bucket, so a source with a third of all rows is spread over
all tasks. Only the finish-time bucket that holds the cut is sorted. The driver
sees one row of totals and one row for the cut.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfscope.llm.common import stage, text_or_empty, word_count

WEIGHTS = (5, 2, 1)
#: Budget as a fraction of all words, and the most passes over one source.
BUDGET = (3, 2)
MAX_PASSES = 2
SEED = "mix-1"
#: Rows that one window partition holds on average.
BUCKET_ROWS = 8192


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget=BUDGET, passes: int = MAX_PASSES) -> DataFrame:
    """source, source_size, rank, target: the budget shared by weight, no target above ``passes`` times its source.

    Water filling in closed form: in order of cap per weight, a source is capped
    while its share of what is left reaches its cap. The integers are exact.
    """
    num, den = budget
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    per = (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
        .withColumn("w", w.cast("long"))
        .withColumn("cap", F.col("source_size") * passes)
    )
    order = Window.orderBy(F.col("cap") / F.col("w"), "rank")
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = (
        per.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("caps_before", F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"))
        .withColumn("w_left", F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("capped", F.col("cap") * F.col("w_left") * den <= F.col("w") * (F.col("total") * num - F.col("caps_before") * den))
        .withColumn("caps", F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(everything))
        .withColumn("w_free", F.sum(F.when(F.col("capped"), 0).otherwise(F.col("w"))).over(everything))
    )
    share = (F.col("w") * (F.col("total") * num - F.col("caps") * den)).cast("double") / (F.col("w_free") * den).cast("double")
    return per.select(
        "source", "source_size", "rank", "total",
        F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share).alias("target"),
    )


def mix_plan(docs: DataFrame, weights=WEIGHTS, budget=BUDGET, passes: int = MAX_PASSES, seed: str = SEED) -> DataFrame:
    """Per document: doc_id, source, text_key, size, source_size, target, taken, copies, finish."""
    text_key = F.md5(F.col("text").cast("string").cast("binary"))
    sizes = stage(
        docs.select(
            "doc_id", F.col("source").cast("string").alias("source"), word_count("text").alias("size"), text_key.alias("text_key"),
            F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"), text_key).cast("binary")).alias("key"),
        ),
        "mix-sizes",
    )
    targets = stage(source_targets(sizes, weights, budget, passes), "mix-targets")
    n_rows = sizes.count()
    total = targets.agg(F.max("total")).first()[0] or 0
    limit = total * budget[0] // budget[1]

    digits = max(2, math.ceil(math.log(max(1, n_rows / BUCKET_ROWS), 16)))
    sizes = sizes.withColumn("bucket", F.substring("key", 1, digits))
    before = (
        sizes.groupBy("source", "bucket").agg(F.sum("size").alias("s"))
        .withColumn("before", F.sum("s").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("s"))
        .select(F.col("source").alias("s_source"), F.col("bucket").alias("s_bucket"), "before")
    )
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    t = targets.select(F.col("source").alias("t_source"), "source_size", "target", "rank")
    rows = stage(
        sizes.withColumn("running", F.sum("size").over(inside))
        .join(before, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("bucket") == F.col("s_bucket")))
        .join(t, F.col("source").eqNullSafe(F.col("t_source")))
        .select("doc_id", "source", "text_key", "key", "size", "source_size", "target", "rank", (F.col("before") + F.col("running")).alias("issued")),
        "mix-rows",
    )

    def entry(copy: int):
        finish = F.when(F.col("target") > 0, (F.col("issued") + F.col("source_size") * copy).cast("double") / F.col("target"))
        return F.struct(finish.alias("finish"), F.col("rank"), F.col("key"), F.lit(copy).alias("copy"))

    # Finish times below 2 in equal ranges, the tail in ranges of 2/time: a bounded number of ranges.
    ranges = max(64, math.ceil(passes * n_rows / BUCKET_ROWS))
    f = F.col("e.finish")
    at = F.when(f < 2, F.floor(f * ranges)).otherwise(2 * ranges + F.floor((1 - F.lit(2.0) / f) * ranges))
    entries = rows.select("size", F.explode(F.array(*[entry(c) for c in range(passes)])).alias("e")).where("size > 0").withColumn("at", at)
    ends = entries.groupBy("at").agg(F.sum("size").alias("s")).withColumn("end", F.sum("s").over(Window.orderBy("at")))
    edge = ends.where(F.col("end") > limit).agg(F.min_by("at", "at"), F.min_by(F.col("end") - F.col("s"), "at")).first()
    if edge[0] is None:  # the budget covers every copy
        taken = [F.lit(1)] * passes
    else:
        run = F.sum("size").over(Window.partitionBy("at").orderBy("e").rowsBetween(Window.unboundedPreceding, 0))
        cut = entries.where(F.col("at") == edge[0]).withColumn("run", run).where(F.col("run") + edge[1] <= limit).agg(F.max("e")).first()[0]
        if cut is None:  # the cut lies exactly before this range
            taken = [(at_range < edge[0]).cast("int") for at_range in (_range_of(entry(c), ranges) for c in range(passes))]
        else:
            last = F.struct(F.lit(cut["finish"]).alias("finish"), F.lit(cut["rank"]).alias("rank"), F.lit(cut["key"]).alias("key"), F.lit(cut["copy"]).alias("copy"))
            taken = [(entry(c) <= last).cast("int") for c in range(passes)]
    copies = F.when((F.col("size") > 0) & (F.col("target") > 0), F.coalesce(sum(taken[1:], taken[0]), F.lit(0))).otherwise(0)
    return rows.select(
        "doc_id", "source", "text_key", "size", "source_size", "target", copies.cast("int").alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"), entry(0)["finish"].alias("finish"),
    )


def _range_of(entry, ranges: int):
    f = entry["finish"]
    return F.when(f < 2, F.floor(f * ranges)).otherwise(2 * ranges + F.floor((1 - F.lit(2.0) / f) * ranges))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the input's rows, once per copy taken, in order of virtual finish time.

    Adds ``mix_copy`` and ``mix_finish``; replaces input columns of these names.
    """
    options = dict(options)
    p = mix_plan(docs, **options).where("copies > 0").groupBy("doc_id", "source", "text_key").agg(
        F.max("copies").alias("p_copies"), F.min("finish").alias("p_finish"), F.first("source_size").alias("p_size"), F.first("target").alias("p_target")
    ).select(F.col("doc_id").alias("p_id"), F.col("source").alias("p_source"), "text_key", "p_copies", "p_finish", "p_size", "p_target")
    names = [c for c in docs.columns if c not in ("mix_copy", "mix_finish")]
    key = F.md5(F.col("text").cast("string").cast("binary"))
    hit = F.col("doc_id").eqNullSafe(F.col("p_id")) & F.col("source").cast("string").eqNullSafe(F.col("p_source")) & key.eqNullSafe(F.col("text_key"))
    copy = F.explode(F.sequence(F.lit(0), F.col("p_copies") - 1)).alias("mix_copy")
    out = docs.select(*names).join(p, hit).select(*names, "p_finish", "p_size", "p_target", copy)
    return out.select(*names, "mix_copy", (F.col("p_finish") + F.col("mix_copy") * F.col("p_size") / F.col("p_target")).alias("mix_finish")).orderBy("mix_finish", "doc_id")


def query(spark, sf_dir: str) -> DataFrame:
    from shelfscope.llm.common import documents

    return mix_plan(documents(spark, sf_dir)).select("doc_id", "source", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(concat_ws(':', 'mix-1', doc_id::VARCHAR, md5(text))) AS key
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM d GROUP BY source
), w AS (
  SELECT *, [5, 2, 1][(rank % 3 + 1)::INT]::BIGINT AS w, 2 * source_size AS cap, (sum(source_size) OVER ())::BIGINT AS total FROM s
), o AS (
  SELECT *, (sum(cap) OVER (ORDER BY cap / w, rank) - cap)::BIGINT AS caps_before,
         (sum(w) OVER (ORDER BY cap / w DESC, rank DESC))::BIGINT AS w_left
  FROM w
), c AS (
  SELECT *, cap * w_left * 2 <= w * (3 * total - 2 * caps_before) AS capped FROM o
), t AS (
  SELECT source, source_size, rank, total,
         CASE WHEN capped THEN cap::DOUBLE
              ELSE (w * (3 * total - 2 * (sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ())::BIGINT))::DOUBLE
                   / (2 * (sum(CASE WHEN capped THEN 0 ELSE w END) OVER ())::BIGINT)::DOUBLE END AS target
  FROM c
), r AS (
  SELECT d.*, t.source_size, t.target, t.rank, t.total,
         (sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING))::BIGINT AS issued
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), e AS (
  SELECT *, (issued + source_size * copy)::DOUBLE / target AS finish
  FROM r, (VALUES (0), (1)) AS v(copy) WHERE size > 0 AND target > 0
), q AS (
  SELECT *, sum(size) OVER (ORDER BY finish, rank, key, copy, doc_id ROWS UNBOUNDED PRECEDING) <= total * 3 // 2 AS fits FROM e
), n AS (
  SELECT key, doc_id, source, count(*) FILTER (fits) AS copies FROM q GROUP BY ALL
)
SELECT r.doc_id, r.source, r.size, r.source_size, r.target, (r.size * coalesce(n.copies, 0))::BIGINT AS taken
FROM r LEFT JOIN n ON r.key = n.key AND r.doc_id IS NOT DISTINCT FROM n.doc_id AND r.source IS NOT DISTINCT FROM n.source
"""
