"""Exact top-k inner products by ball-tree branch and bound.

Vectors are spread over shards; each shard builds one ball tree. A block of
queries goes down a tree together: a node is opened for the queries whose upper
bound q.c + |q| r reaches their current k-th score, children in order of their
bounds. The k-th score is shared between shards: every query first searches one
home shard, and what it finds there bounds the search of all others.

Defined results
---------------
* a vector that is null, or holds null, NaN or an infinity, takes no part.
* vectors of different lengths do not meet; a vector of length 0 scores 0.
* repeated vec_ids are rows of their own; a query skips its own row only.
  Ties go to the smaller vec_id, a null vec_id last.
* null vec_id: a candidate, never a query. Empty table: empty result.
* a score beyond 64 bits is cut to the largest or smallest long.

Scale
-----
Work is a grid of (shard, query block) groups of bounded size, so neither all
vectors nor all queries meet in one task. A group returns at most k rows a query.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfscope.llm.common import stage

TOP_K = 20
QUERY_EVERY = 20
SCALE = 64.0
SHARD_ROWS = 8192
BLOCK_QUERIES = 2048
LEAF = 256
#: Stands for a null vec_id (a null would turn 64-bit ids into doubles in pandas); ordered last.
NO_ID = 2**63 - 1


def build_tree(x: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, list[tuple]]:
    """Row order and nodes (center, radius, start, end, left, right); a leaf has left -1."""
    order = np.arange(len(x))
    nodes: list[list] = []
    todo = [(0, len(x), -1, 0)]
    while todo:
        start, end, parent, side = todo.pop()
        part = x[order[start:end]]
        center = part.mean(0) if len(part) else np.zeros(x.shape[1])
        radius = float(np.sqrt(((part - center) ** 2).sum(1).max())) if len(part) else 0.0
        me = len(nodes)
        nodes.append([center, radius, start, end, -1, -1])
        if parent >= 0:
            nodes[parent][4 + side] = me
        if end - start > leaf and radius > 0:
            # Split at the median of the projection on the line between two far points.
            far = part[((part - center) ** 2).sum(1).argmax()]
            away = part[((part - far) ** 2).sum(1).argmax()]
            by = np.argsort(part @ (far - away), kind="stable")
            order[start:end] = order[start:end][by]
            mid = (start + end) // 2
            todo += [(start, mid, me, 0), (mid, end, me, 1)]
    return order, [tuple(n) for n in nodes]


def _inner(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of integral doubles as int64."""
    if len(q) and len(x) and x.shape[1]:
        if np.sqrt((q**2).sum(1).max()) * np.sqrt((x**2).sum(1).max()) * 2 < 2.0**53:
            return (q @ x.T).astype(np.int64)
        big = np.frompyfunc(int, 1, 1)
        top = np.iinfo(np.int64)
        return np.clip(big(q).dot(big(x).T), top.min, top.max).astype(np.int64)
    return np.zeros((len(q), len(x)), np.int64)


def search(tree: dict, q: np.ndarray, uid: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Best k scores and tree rows of each query, worst filled with row -1; scores under ``floor`` may be left out."""
    x, ids, uids = tree["x"], tree["vec_id"], tree["uid"]
    norm = np.sqrt((q**2).sum(1))
    low = np.iinfo(np.int64).min
    best = np.full((len(q), k), low, np.int64)
    rows = np.full((len(q), k), -1, np.int64)
    kth = floor.astype(np.int64).copy()

    def bound(node, act):
        return (q[act] @ node[0] + norm[act] * node[1]) * (1 + 1e-9 * np.sign(q[act] @ node[0] + norm[act] * node[1])) + 1e-6

    def visit(at: int, act: np.ndarray) -> None:
        node = tree["nodes"][at]
        act = act[bound(node, act) >= kth[act]]
        if not len(act):
            return
        if node[4] >= 0:
            # Children by upper bound: the one that promises more to these queries goes first.
            for child in sorted(node[4:6], key=lambda c: -float(bound(tree["nodes"][c], act).sum())):
                visit(child, act)
            return
        span = np.arange(node[2], node[3])
        s = _inner(q[act], x[span])
        own = uids[span][None, :] == uid[act][:, None]
        open_ = (s >= kth[act][:, None]) & ~own
        some = np.flatnonzero(open_.any(1))
        if not len(some):
            return
        a = act[some]
        s, ok = s[some], open_[some]
        all_s = np.concatenate([best[a], np.where(ok, s, low)], 1)
        all_r = np.concatenate([rows[a], np.where(ok, span[None, :], -1)], 1)
        all_id = np.where(all_r >= 0, ids[all_r], NO_ID)
        take = np.lexsort((all_id, all_r < 0, -all_s.astype(np.float64)), axis=1)[:, :k] if abs(all_s[all_r >= 0]).max(initial=0) < 2**53 else np.lexsort((all_id, ~all_s, all_r < 0), axis=1)[:, :k]
        best[a] = np.take_along_axis(all_s, take, 1)
        rows[a] = np.take_along_axis(all_r, take, 1)
        full = rows[a, k - 1] >= 0
        kth[a[full]] = np.maximum(kth[a[full]], best[a[full], k - 1])

    visit(0, np.arange(len(q)))
    return best, rows


def _vectors(raw) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in raw]) if len(raw) else np.zeros((0, 0))


def top_k(vectors: DataFrame, k: int = TOP_K, query_every: int = QUERY_EVERY, scale: float = SCALE,
          shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best rows among all others."""
    e = F.col("embedding")
    sound = e.isNotNull() & ~F.exists(e, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    x = F.transform(e, lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("double"))
    rows = stage(
        vectors.where(sound).select(F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("vec_id"), F.monotonically_increasing_id().alias("uid"), x.alias("x")).withColumn("dim", F.size("x")),
        "topk-rows",
    )
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("vec_id") % query_every == 0, 1))).first()
    shards = max(1, -(-n // shard_rows))
    blocks = max(1, -(-n_queries // block_queries))

    def build(part: pd.DataFrame) -> pd.DataFrame:
        m = _vectors(part["x"].to_list())
        order, nodes = build_tree(m)
        tree = {"x": m[order], "vec_id": part["vec_id"].to_numpy(np.int64)[order], "uid": part["uid"].to_numpy(np.int64)[order], "nodes": nodes}
        return pd.DataFrame({"dim": [part["dim"].iloc[0]], "shard": [part["shard"].iloc[0]], "tree": [pickle.dumps(tree)]})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int"))
    trees = stage(dealt.groupBy("dim", "shard").applyInPandas(build, "dim int, shard int, tree binary"), "topk-trees")
    asked = rows.where(F.col("vec_id") % query_every == 0).withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int"))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "uid", "block", "dim", "vec_id", "score"]
        if not len(left) or not len(right):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in columns})
        tree = pickle.loads(left["tree"].iloc[0])
        q = _vectors(right["x"].to_list())
        best, at = search(tree, q, right["uid"].to_numpy(np.int64), right["floor"].to_numpy(np.int64), k)
        i, j = np.nonzero(at >= 0)
        vec = tree["vec_id"][at[i, j]]
        return pd.DataFrame({
            "query_id": right["vec_id"].to_numpy(np.int64)[i], "uid": right["uid"].to_numpy(np.int64)[i], "block": right["block"].to_numpy()[i],
            "dim": right["dim"].to_numpy()[i], "vec_id": vec, "score": best[i, j],
        })

    def visit(jobs: DataFrame) -> DataFrame:
        """Run (query, shard) jobs in groups of one query block and one shard."""
        t = trees.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        return jobs.groupBy("dim", "shard", "block").cogroup(t.groupBy("dim", "shard", "block")).applyInPandas(
            lambda left, right: run(right, left), "query_id long, uid long, block int, dim int, vec_id long, score long"
        )

    lowest = np.iinfo(np.int64).min
    home = asked.select("vec_id", "uid", "x", "dim", "block", F.pmod(F.xxhash64(F.lit("home"), "block"), F.lit(shards)).cast("int").alias("shard"), F.lit(lowest).cast("long").alias("floor"))
    first = stage(visit(home), "topk-home")
    bounds = first.groupBy("uid").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s")).select("uid", F.when(F.col("n") >= k, F.col("s")).alias("s"))
    rest = (
        asked.join(bounds, "uid", "left").join(home.select("uid", F.col("shard").alias("done")), "uid")
        .select("vec_id", "uid", "x", "dim", "block", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.coalesce("s", F.lit(lowest)).alias("floor"), "done")
        .where("shard <> done").drop("done")
    )
    found = first.unionByName(visit(rest)) if shards > 1 else first
    rank = F.row_number().over(Window.partitionBy("uid").orderBy(F.col("score").desc(), F.col("vec_id")))
    found = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return found.select("query_id", "rank", F.when(F.col("vec_id") != NO_ID, F.col("vec_id")).alias("vec_id"), "score")


def query(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = """
WITH v AS (
  SELECT vec_id, [floor(x::DOUBLE * 64) for x in embedding] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
