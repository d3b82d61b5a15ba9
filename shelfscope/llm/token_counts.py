"""Token counts as delta-maintained rollups.

A store (a folder) keeps one entry per document and tokenizer version, and
additive totals by source, language and version. A batch of changes is turned
into signed rows: an insert adds a document, a delete takes its stored entry
back, a revision takes the old one back and adds the new count. Totals are the
sum of all committed batches.

A batch is committed under its id. Its deltas and entries are written to a new
folder first; the commit is one small file, named by the commit's number alone and
created only if there is none, so of two writers that saw the same state one gets
the number. The other looks again: where the winner committed its batch it is done,
else it works its deltas out anew (its texts stay counted). A batch that is
committed already changes nothing when it runs again, and one that failed half way
leaves folders that no commit names and nobody reads.

Defined results
---------------
* null or empty text: 0 tokens, counted as a document.
* null source or language: a group of its own. Null doc_id: counted as an
  insert; such rows cannot be revised or deleted.
* a batch that repeats a doc_id: rows agree or the largest (op, source, lang,
  text) wins, whatever the order; a delete or revision of an unknown document is
  a no-op or an insert; an insert of a known one is a revision.
* empty batch: committed, changes nothing. Other columns are ignored.

Scale
-----
Texts are tokenised once per version, in Arrow batches; the counts are a stage table; the rest are aggregations and
joins on (doc_id, version), whose entries are 40 bytes. Totals are partial sums.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope.llm.common import documents, stage, stage_root
from shelfscope.sources.martstore import create_once

VERSIONS = {n: f"/opt/tokenizers/{n}.tiktoken" for n in ("byte_bpe_50k", "byte_bpe_multi_50k")}
ENTRY = "doc_id long, version string, source string, lang string, n_tokens long, batch_no long, live boolean"
DELTA = "source string, lang string, version string, n_docs long, n_tokens long"


@lru_cache(maxsize=4)
def _encoding(path: str):
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(changes: DataFrame, versions: dict[str, str]) -> DataFrame:
    """``changes`` (doc_id, op, source, lang, text) with version and n_tokens, a row for each version; the text goes."""
    names, paths = list(versions), list(versions.values())
    rows = changes.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("op").cast("string").alias("op"), F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"), F.col("text").cast("string").alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, path in zip(names, paths):
                enc = _encoding(path)
                n = [len(enc.encode_ordinary(t)) if (t := x.as_py()) else 0 for x in b.column(5)]
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(i) for i in range(5)), pa.array([name] * b.num_rows), pa.array(n, pa.int64())],
                    names=["doc_id", "op", "source", "lang", "text_hash", "version", "n_tokens"],
                )

    return rows.mapInArrow(run, "doc_id long, op string, source string, lang string, text_hash long, version string, n_tokens long")


class Rollup:
    """The store under one folder that all executors and the driver share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _committed(self) -> list[tuple[int, str, str]]:
        """(number, batch id, data folder) of each commit, in order; a file without whole content is none."""
        log = self._path(f"{self.path}/commits")
        if not self._fs.exists(log):
            return []
        out = []
        for s in self._fs.listStatus(log):
            if s.getPath().getName().isdigit():
                text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(self._fs.open(s.getPath()), "UTF-8")
                if text.endswith("}"):
                    held = json.loads(text)
                    out.append((int(s.getPath().getName()), held["batch"], held["folder"]))
        return sorted(out)

    def _next_number(self) -> int:
        """The number after all that are taken, also by writers that died before their content was there."""
        log = self._path(f"{self.path}/commits")
        taken = [int(s.getPath().getName()) for s in self._fs.listStatus(log) if s.getPath().getName().isdigit()] if self._fs.exists(log) else []
        return max(taken, default=-1) + 1

    def _read(self, kind: str, schema: str) -> DataFrame:
        folders = [f"{self.path}/{kind}/{folder}" for _, _, folder in self._committed()]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def entries(self) -> DataFrame:
        """doc_id, version, source, lang, n_tokens of the documents that are there now."""
        newest = F.max_by(F.struct("source", "lang", "n_tokens", "live"), "batch_no").alias("e")
        return self._read("entries", ENTRY).groupBy("doc_id", "version").agg(newest).where("e.live").select("doc_id", "version", "e.source", "e.lang", "e.n_tokens")

    def totals(self) -> DataFrame:
        """source, lang, version, n_docs, n_tokens over all commits; groups that are back at zero are left out."""
        sums = self._read("deltas", DELTA).groupBy("source", "lang", "version").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return sums.where("n_docs <> 0 or n_tokens <> 0")

    def apply(self, batch_id: str, changes: DataFrame, versions: dict[str, str]) -> bool:
        """Commit ``changes`` (doc_id, op in insert/revise/delete, source, lang, text); False if the id is there already."""
        counted = None
        while True:
            number, done = self._next_number(), self._committed()
            if any(b == batch_id for _, b, _ in done):
                return False
            if counted is None:  # each text is counted once, whatever reads the counts
                counted = stage(count_tokens(changes, versions), "rollup-counted")
            folder = f"{number}-{uuid.uuid4().hex}"
            self._write(counted, folder, number, bool(done))
            if create_once(self.spark, f"{self.path}/commits/{number}", json.dumps({"batch": batch_id, "folder": folder})):
                return True

    def _write(self, counted: DataFrame, folder: str, number: int, any_before: bool) -> None:
        """The batch's changes, deltas and entries against what is committed now."""
        pick = F.max(F.struct("op", "source", "lang", "text_hash", "n_tokens")).alias("c")
        known_ids = counted.where("doc_id is not null").groupBy("doc_id", "version").agg(pick)
        known_ids = known_ids.select("doc_id", "version", "c.op", "c.source", "c.lang", "c.n_tokens")
        if any_before:
            old = self.entries().select("doc_id", "version", F.col("source").alias("old_source"), F.col("lang").alias("old_lang"), F.col("n_tokens").alias("old_tokens"), F.lit(True).alias("known"))
            signed = known_ids.join(old, ["doc_id", "version"], "left")
        else:
            signed = known_ids.withColumns({"old_source": F.lit(None).cast("string"), "old_lang": F.lit(None).cast("string"), "old_tokens": F.lit(None).cast("long"), "known": F.lit(None).cast("boolean")})
        nameless = counted.where("doc_id is null and op <> 'delete'").select(
            "doc_id", "version", "op", "source", "lang", "n_tokens", F.lit(None).cast("string").alias("old_source"), F.lit(None).cast("string").alias("old_lang"),
            F.lit(None).cast("long").alias("old_tokens"), F.lit(None).cast("boolean").alias("known"),
        )
        signed.unionByName(nameless).write.parquet(f"{self.path}/changes/{folder}")
        signed = self.spark.read.parquet(f"{self.path}/changes/{folder}")
        plus = F.struct("source", "lang", "version", F.lit(1).alias("sign"), F.col("n_tokens").alias("n"))
        minus = F.struct(F.col("old_source").alias("source"), F.col("old_lang").alias("lang"), "version", F.lit(-1).alias("sign"), F.col("old_tokens").alias("n"))
        moves = signed.select(F.explode(F.array(F.when(F.col("op") != "delete", plus), F.when(F.col("known"), minus))).alias("m")).where("m is not null")
        deltas = moves.groupBy("m.source", "m.lang", "m.version").agg(F.sum("m.sign").cast("long").alias("n_docs"), F.sum(F.col("m.sign") * F.col("m.n")).cast("long").alias("n_tokens"))
        deltas.write.parquet(f"{self.path}/deltas/{folder}")
        signed.where("doc_id is not null").select("doc_id", "version", "source", "lang", "n_tokens", F.lit(number).cast("long").alias("batch_no"), (F.col("op") != "delete").alias("live")).write.parquet(f"{self.path}/entries/{folder}")


def query(spark, sf_dir: str) -> DataFrame:
    """Totals after three batches over all documents.

    The first inserts every document; the second revises each document whose text
    changes when it is trimmed and stripped of repeated white space; the third
    deletes exact copies (all but the smallest doc_id of each text). The first
    batch is sent twice, as after a lost acknowledgement.
    """
    docs = documents(spark, sf_dir).select("doc_id", "source", "lang", "text")
    store = Rollup(spark, f"{stage_root(spark)}/llm-stages/rollup-{uuid.uuid4().hex}")
    inserts = docs.withColumn("op", F.lit("insert"))
    store.apply("load", inserts, VERSIONS)
    store.apply("load", inserts, VERSIONS)
    clean = F.regexp_replace(F.trim("text"), r"[\x20\x09-\x0D]+", " ")
    store.apply("clean", docs.withColumn("was", F.col("text")).withColumn("text", clean).where("text <> was").withColumn("op", F.lit("revise")), VERSIONS)
    hashes = stage(docs.select("doc_id", "source", "lang", F.md5(F.col("text").cast("binary")).alias("h")), "rollup-hashes")
    first = stage(hashes.groupBy("h").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"), "rollup-first")
    copies = hashes.join(first, "h").where("doc_id > first")
    store.apply("dedup", copies.select("doc_id", "source", "lang", F.lit("").alias("text"), F.lit("delete").alias("op")), VERSIONS)
    return store.totals()
