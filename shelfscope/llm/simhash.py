"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into two 32-bit segments. Two fingerprints at
distance 2 or less have one segment that differs in at most one bit, so they
share one of the 64 signatures "segment with one bit deleted". Signatures are
joined on equality and every candidate pair is verified by its bit distance.

A signature shared by more than ``crowd`` different fingerprints is not paired
up. Its members instead take all 2,016 signatures "whole fingerprint with two
bits deleted": two fingerprints share one of these exactly if they are within
distance 2, so each member links to the smallest of its signature. That is
exact as well, and its size is linear in the number of members.

Defined results
---------------
* null or wordless text: fingerprint zero, linked like any other.
* fewer than three words: the whole sequence is the one shingle.
* null doc_id: keeps its row; it never is a component's smallest doc_id, which
  is null only where every id of the component is null.
* repeated rows: one output row each. Empty table: empty result.
* other columns, whatever their names, are ignored.

Scale
-----
The text is read once, in Arrow batches, and leaves each task as 24 bytes a
document. Exact copies and equal fingerprints collapse before the signature
join. Components are found by star contraction (``common``), nothing is
collected.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscope.llm.common import connected_components, documents, stage

SHINGLE = 3
MAX_DISTANCE = 2
SEED = 42
#: Signatures with more members than this take the two-deletion signatures.
CROWD = 64
#: Most signature keys that a broadcast may hold.
BROADCAST_KEYS = 500_000


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles, repeats included."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    n = len(words) - shingle + 1
    if not words:
        return 0
    if n <= 1:
        grams = [b" ".join(words)]
    else:
        grams = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
    counts = np.zeros(64, np.int64)
    # Blocks bound the memory of very long texts.
    for at in range(0, len(grams), 4096):
        part = grams[at:at + 4096]
        h = np.fromiter(map(xxhash.xxh64_intdigest, part, repeat(seed)), np.uint64, len(part))
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    bits = (2 * counts > len(grams)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash (of the raw text), fp (the fingerprint as a signed long) per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(x.as_py(), shingle) for x in b.column(2)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))], ["doc_id", "text_hash", "fp"])

    text = F.col("text").cast("string")
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, fp long")


def links(fps: DataFrame, distance: int = MAX_DISTANCE, crowd: int = CROWD) -> DataFrame:
    """Edges (a < b) that connect exactly the fingerprints (column fp, distinct) within ``distance`` bits.

    Pairs of uncrowded signatures are all there; crowded ones give spanning stars.
    """
    if distance != 2:
        raise ValueError("two segments with one deleted bit are complete for distance 2")
    fps = stage(fps, "simhash-fps")
    segment = F.when(F.col("p") < 32, F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).otherwise(F.shiftrightunsigned("fp", 32))
    keep = F.expr("~shiftleft(1L, p % 32)")
    sig = F.shiftleft(F.col("p").cast("long"), 32).bitwiseOR(segment.bitwiseAND(keep))
    signed = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("p")).select(sig.alias("sig"), "fp")
    shared = stage(
        signed.groupBy("sig").agg(F.count("fp").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"), F.bit_xor("fp").alias("x")).where("n > 1"),
        "simhash-shared",
    )
    # Two members are the extremes, a third is what is left of the exclusive or: only larger signatures meet their members again.
    third = F.expr("x ^ a ^ b")
    pairs = shared.where("n = 2").select("a", "b").unionByName(
        shared.where("n = 3").select(F.explode(F.array(
            F.struct("a", "b"), F.struct("a", third.alias("b")), F.struct(third.alias("a"), "b"))).alias("p")).select("p.a", "p.b")
    )
    larger = shared.where("n > 3").select("sig", "n")
    # Counted before it is broadcast (12 bytes a key); beyond the bound the same join shuffles. Spark must not choose: it
    # takes the exploded side for as small as the fingerprints that it is made from.
    larger = larger.hint("broadcast" if larger.count() <= BROADCAST_KEYS else "merge")
    many = stage(signed.join(larger, "sig"), "simhash-many")
    few = many.where(F.col("n") <= crowd)
    pairs = pairs.unionByName(
        few.select("sig", F.col("fp").alias("a")).join(few.select("sig", F.col("fp").alias("b")), "sig").where("a < b").select("a", "b")
    )
    pairs = pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    dense = many.where(F.col("n") > crowd).select("fp").distinct()
    masks = F.expr("flatten(transform(sequence(0, 62), i -> transform(sequence(i + 1, 63), j -> struct(i as i, j as j))))")
    # At most four fingerprints have the same other 62 bits: a bit each tells which are there, so no row meets another one.
    there = F.expr("shiftleft(1, cast(2 * (shiftrightunsigned(fp, m.i) & 1) + (shiftrightunsigned(fp, m.j) & 1) as int))")
    stars = dense.select(F.explode(masks).alias("m"), "fp").select(
        F.expr("m.i * 64 + m.j").alias("at"), F.expr("fp & ~shiftleft(1L, m.i) & ~shiftleft(1L, m.j)").alias("rest"), there.alias("there"))
    stars = stars.groupBy("at", "rest").agg(F.bit_or("there").alias("there")).where("bit_count(there) > 1")
    members = F.expr(
        "transform(filter(sequence(0, 3), k -> (shiftright(there, k) & 1) = 1), "
        "k -> rest | shiftleft(cast(shiftright(k, 1) as bigint), at div 64) | shiftleft(cast(k & 1 as bigint), at % 64))")
    stars = stars.select(F.sort_array(members).alias("fps"))
    starred = stars.select(F.col("fps")[0].alias("a"), F.explode(F.slice("fps", 2, 3)).alias("b"))
    return pairs.unionByName(starred).distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = MAX_DISTANCE) -> DataFrame:
    """doc_id, text_hash, fp, component_id, root for every row; component_id is the smallest
    doc_id reachable, root the smallest fingerprint: it names the component also where
    ids are null or stand for several texts."""
    rows = stage(fingerprints(docs, shingle), "simhash-rows")
    ids = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-ids")
    comp = connected_components(links(ids.select("fp"), distance))
    rooted = ids.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    by_fp = stage(rooted.select("fp", "root").join(lowest, "root").select("fp", "component_id", "root"), "simhash-components")
    return rows.join(by_fp, "fp").select("doc_id", "text_hash", "fp", "component_id", "root")


def representatives(docs: DataFrame, shingle: int = SHINGLE, distance: int = MAX_DISTANCE) -> DataFrame:
    """The input's rows with one row of each component: the one of the smallest doc_id.

    Components are told apart by their root, so a doc_id that occurs with several
    texts, or is null, joins no groups; its rows are told apart by the text's hash.
    Exact repeats of the kept row go.
    """
    found = near_duplicates(docs, shingle, distance)
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "fp")
    kept = stage(
        found.groupBy("root").agg(F.min(first).alias("k"))
        .select(F.col("k.doc_id").alias("kept_id"), F.col("k.text_hash").alias("kept_hash")),
        "simhash-kept",
    )
    hit = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("kept_hash"))
    names = docs.columns
    out = docs.join(kept, hit, "left_semi").withColumn("_hash", F.xxhash64(F.col("text").cast("string")))
    return out.dropDuplicates(["doc_id", "_hash"]).select(*names)


def query(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
