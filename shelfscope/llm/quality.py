"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A document's hashed words and word shapes carry one shared weight vector;
ordered thresholds cut its score into grades: P(grade >= k) = sigmoid(score -
threshold_k). From these come the expected grade and the tail probability that
selects documents.

The test tables' labels give three grades: 0 toxic, 1 poor, 2 good.

Defined results
---------------
* null, empty or blank text: expected grade 0, all tail probabilities 0, rejected.
* null doc_id: scored like any other; never joins a rating.
* ratings that repeat a doc_id: the lowest grade holds. Ratings without a grade
  or a document are ignored. Without any rating nothing is rejected.
* repeated rows: scored each. Empty table: empty result.
* ``filter_documents`` returns the input's columns, whatever their names.

Scale
-----
Training reads at most ``max_ratings`` rated documents (a bounded sample by hash
of the id: the only bound here, a parameter) and runs in one task; the weights,
of fixed size, are broadcast. Scoring is one pass over all whole texts without a
shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscope.llm.common import documents

BUCKETS = 1 << 17
MAX_RATINGS = 15_000
ROUNDS = 400
L2 = 1e-5
#: Share of the rated documents that a bucket must occur in to get a weight.
MIN_SHARE = 0.002
KEEP_PROBABILITY = 0.5
#: Words a worker remembers the buckets of.
CACHE_WORDS = 300_000

_SHAPE = (
    (re.compile(r"[^\W\d_]*[a-zß-öø-ÿ][^\W\d_]*"), "a"),
    (re.compile(r"[^\W\d_]+"), lambda m: m[0] if m[0] == "a" else "A"),
    (re.compile(r"\d+"), "0"),
    (re.compile(r"(\W)\1+"), r"\1"),
)


@dataclass(frozen=True)
class Model:
    """Weights per bucket and ascending thresholds; empty thresholds: nothing was rated."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1.. in columns."""
        return 1.0 / (1.0 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -500, 500)))


class Hasher:
    """Buckets of a text's words: the bare word, its shape (case, digits, punctuation), its beginning, and whether it repeats the one before."""

    def __init__(self, buckets: int = BUCKETS):
        self.buckets, self.cache = buckets, {}
        self.repeat = xxhash.xxh64_intdigest("word repeats the one before") % buckets

    def _of(self, word: bytes) -> tuple[int, int, int]:
        if len(self.cache) >= CACHE_WORDS:
            self.cache.clear()
        text = word.decode("utf-8", "replace")
        shape = text
        for pattern, to in _SHAPE:
            shape = pattern.sub(to, shape)
        core = text.lower().strip("\"'.,;:!?()[]{}<>#$%&*|-_/\\")
        got = tuple(xxhash.xxh64_intdigest(x) % self.buckets for x in ("w " + core, "s " + shape[:32], "b " + core[:4]))
        self.cache[word] = got
        return got

    def features(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Buckets and values; values are square roots of word shares, so a text's length does not count."""
        words = (text or "").encode("utf-8", "replace").split()
        if not words:
            return np.zeros(0, np.int32), np.zeros(0, np.float32)
        counts = Counter(words)
        get = self.cache.get
        at = np.array([get(w) or self._of(w) for w in counts], np.int32)
        n = np.fromiter(counts.values(), np.float64, len(counts))
        again = sum(map(bytes.__eq__, words, words[1:]))
        flat, tf = np.append(at.ravel(), self.repeat), np.append(np.repeat(n, 3), again)
        ids, back = np.unique(flat, return_inverse=True)
        tf = np.bincount(back, tf, len(ids))
        return ids.astype(np.int32), np.sqrt(tf / len(words)).astype(np.float32)


def _train(ids: list[np.ndarray], values: list[np.ndarray], grades: np.ndarray, buckets: int, rounds: int, l2: float) -> Model:
    """Full-batch Adam on the ordinal log likelihood; thresholds stay ordered through exponentials of their gaps."""
    kinds = int(grades.max())
    start = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    col = np.concatenate(ids).astype(np.int64)
    val = np.concatenate(values).astype(np.float64) * 8
    # Buckets of few rated documents say nothing that carries over.
    used = np.flatnonzero(np.bincount(col, minlength=buckets) >= max(3, MIN_SHARE * len(ids)))
    place = np.full(buckets, -1)
    place[used] = np.arange(len(used))
    row = np.repeat(np.arange(len(ids)), np.diff(start))
    ok = place[col] >= 0
    row, col, val = row[ok], place[col[ok]], val[ok]
    n, m = len(ids), len(used)
    share = np.array([(grades >= k).mean() for k in range(1, kinds + 1)]).clip(1e-3, 1 - 1e-3)
    first = -np.log(share / (1 - share))
    gaps = np.log(np.maximum(np.diff(first), 1e-2))
    p = np.concatenate([np.zeros(m), first[:1], gaps])
    m1, m2 = np.zeros_like(p), np.zeros_like(p)
    y = grades.astype(int)
    for t in range(1, rounds + 1):
        w, cut = p[:m], p[m] + np.concatenate([[0.0], np.cumsum(np.exp(p[m + 1:]))])
        s = np.bincount(row, w[col] * val, n)
        tail = 1 / (1 + np.exp(-np.clip(s[:, None] - cut[None, :], -60, 60)))
        wide = np.hstack([np.ones((n, 1)), tail, np.zeros((n, 1))])
        lo, hi = wide[np.arange(n), y], wide[np.arange(n), y + 1]
        prob = np.maximum(lo - hi, 1e-12)
        # d log(lo - hi) / d score; each tail moves by tail (1 - tail).
        d_lo, d_hi = lo * (1 - lo) / prob, hi * (1 - hi) / prob
        g_s = -(d_lo - d_hi) / n
        g_cut = np.zeros(kinds)
        for k in range(1, kinds + 1):
            g_cut[k - 1] = (d_lo[y == k].sum() - d_hi[y == k - 1].sum()) / n
        g = np.concatenate([
            np.bincount(col, g_s[row] * val, m) + l2 * w, [g_cut.sum()], np.exp(p[m + 1:]) * np.cumsum(g_cut[::-1])[::-1][1:],
        ])
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        p -= 0.15 * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.99**t)) + 1e-9)
    weights = np.zeros(buckets, np.float32)
    weights[used] = p[:m] * 8
    return Model(weights, p[m] + np.concatenate([[0.0], np.cumsum(np.exp(p[m + 1:]))]))


def fit(docs: DataFrame, ratings: DataFrame, max_ratings: int = MAX_RATINGS, buckets: int = BUCKETS, rounds: int = ROUNDS, l2: float = L2) -> Model:
    """Model from ``ratings`` (doc_id, grade from 0 up) of ``docs``."""
    rated = (
        ratings.where("doc_id is not null and grade >= 0").groupBy(F.col("doc_id").alias("rated_id")).agg(F.min("grade").cast("int").alias("grade"))
        .orderBy(F.xxhash64("rated_id"), "rated_id").limit(max_ratings)
    )
    # At most max_ratings rows of two numbers: a proven bound for the broadcast.
    sample = docs.join(F.broadcast(rated), F.col("doc_id") == F.col("rated_id")).select("rated_id", "grade", F.col("text").cast("string").alias("text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(buckets)
        for b in batches:
            got = [hasher.features(x.as_py()) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([i.tobytes() for i, _ in got], pa.binary()), pa.array([v.tobytes() for _, v in got], pa.binary())],
                names=["rated_id", "grade", "ids", "vals"],
            )

    def train(part: pd.DataFrame) -> pd.DataFrame:
        part = part.assign(n=part["ids"].map(len)).query("n > 0").sort_values(["rated_id", "ids"])
        if not len(part) or part["grade"].nunique() < 2:
            return pd.DataFrame({"weights": [b""], "thresholds": [b""]})
        m = _train([np.frombuffer(x, np.int32) for x in part["ids"]], [np.frombuffer(x, np.float32) for x in part["vals"]], part["grade"].to_numpy(), buckets, rounds, l2)
        return pd.DataFrame({"weights": [m.weights.tobytes()], "thresholds": [m.thresholds.astype(np.float64).tobytes()]})

    kind = sample.schema["rated_id"].dataType.simpleString()
    rows = (
        sample.mapInArrow(features, f"rated_id {kind}, grade int, ids binary, vals binary")
        .groupBy(F.lit(1).alias("all")).applyInPandas(train, "weights binary, thresholds binary").collect()
    )
    if not rows or not rows[0]["thresholds"]:
        return Model(np.zeros(buckets, np.float32), np.zeros(0))
    return Model(np.frombuffer(rows[0]["weights"], np.float32), np.frombuffer(rows[0]["thresholds"], np.float64))


def _score_batches(model: Model, keep: float, text_at: int):
    """Per batch: (expected grade, tail of the highest grade, kept) of its texts."""

    def of(batch: pa.RecordBatch, hasher: Hasher):
        n = batch.num_rows
        if not len(model.thresholds):
            return np.zeros(n), np.ones(n), np.ones(n, bool)
        score, some = np.zeros(n), np.zeros(n, bool)
        for i, x in enumerate(batch.column(text_at)):
            ids, values = hasher.features(x.as_py())
            some[i] = len(ids) > 0
            score[i] = float((model.weights[ids].astype(np.float64) * values).sum())
        tails = model.tails(score) * some[:, None]
        return tails.sum(1), tails[:, -1], tails[:, -1] >= keep

    return of


def score_documents(docs: DataFrame, model: Model, keep: float = KEEP_PROBABILITY) -> DataFrame:
    """doc_id, expected_grade, p_top (tail probability of the highest grade), kept."""
    given = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = given.value
        hasher, of = Hasher(len(m.weights)), _score_batches(m, keep, 1)
        for b in batches:
            e, p, k = of(b, hasher)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(e), pa.array(p), pa.array(k)], names=["doc_id", "expected_grade", "p_top", "kept"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, expected_grade double, p_top double, kept boolean")


def filter_documents(docs: DataFrame, model: Model, keep: float = KEEP_PROBABILITY) -> DataFrame:
    """The rows of ``docs`` that the model keeps, all columns as they are."""
    given = docs.sparkSession.sparkContext.broadcast(model)
    text_at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = given.value
        hasher, of = Hasher(len(m.weights)), _score_batches(m, keep, text_at)
        for b in batches:
            yield b.filter(pa.array(of(b, hasher)[2]))

    return docs.mapInArrow(run, docs.schema)


def label_grades(labels: DataFrame) -> DataFrame:
    """doc_id, grade of the test tables' labels: 0 toxic, 1 poor, 2 good; no quality, no grade unless toxic."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade")).where("grade is not null")


def query(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs, label_grades(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return score_documents(docs, model)
