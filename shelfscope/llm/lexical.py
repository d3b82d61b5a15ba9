"""Ranked lexical search over an inverted index in shards, by Block-Max MaxScore (operator 11).

Index: each task cuts its rows into shards of a bounded number of text bytes and
writes one row per shard and term (sorted by term) and one with the shard's
documents. A posting list is cut into blocks of 128 documents; a block holds
delta-coded document numbers and term frequencies in the narrowest of 1, 2 or 4
bytes, and in the open its last document and its impact points: the (frequency,
length) pairs that no other posting of the block beats in both. They give the
block's exact maximum under any corpus statistics, so the index is built in one
pass, before the number and mean length of the documents are known, and without
a shuffle.

Search: the posting lists of the queries' terms meet the queries in (shard, query
block) groups, both bounded. For each query lists are ordered by their bound in
the shard; those whose bounds together stay below the k-th score so far are
non-essential. Documents come from the essential lists only, in windows of
document numbers. Non-essential lists are then looked up in order of falling
bound: a candidate that its score so far, the block maximum of this list and the
bounds of the rest leave below the k-th score goes before the block is
decompressed. A shard's heap holds k documents and those equal to the k-th.
Heaps merge in two steps, by (query, part of the shards) and by query.

Scores are the integers of the contract: N counts documents with a term, L their
terms, w = floor(1000 ln((2N+2)/(2df+1))), m = 10 + (90 n N) div L, and a term adds
w ((10^9 tf) div (1000 tf + 8 m)).

Defined results:

* null and empty texts, and texts without a term, are no documents: they count nowhere;
* an item (row of the queries) with a null text, without terms or with unknown terms only has no rows;
* equal scores go by doc_id, null last; rows that repeat a doc_id are documents of their own;
* items that repeat an item_id are searched one by one, exact repeats of an item once;
* a text of any length is indexed whole (a long one is a shard of its own);
* an empty documents or benchmark table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfscope.llm.common import documents, stage, text_or_empty

K = 10
#: A shard closes at so many bytes of text.
SHARD_BYTES = 16 << 20
#: Postings of a block.
BLOCK = 128
#: Queries that meet a shard in one group.
QUERY_BLOCK = 1024
#: Document numbers that are scored together.
WINDOW = 4096
#: Parts in which the shards' heaps are merged first.
MERGE_PARTS = 64

#: ASCII letters and digits, and every byte of other characters, belong to terms; only A-Z change.
_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """The maximal matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` in UTF-8, A-Z lower-cased."""
    return text.translate(_TABLE).split()


# ---- index ------------------------------------------------------------------------------


def _widths(largest: np.ndarray) -> np.ndarray:
    return np.where(largest < 1 << 8, 1, np.where(largest < 1 << 16, 2, 4))


def _scatter(out: np.ndarray, at: np.ndarray, values: np.ndarray, width: np.ndarray) -> None:
    """Write each value in little-endian ``width`` bytes at ``at``."""
    for w in (1, 2, 4):
        hit = width == w
        if hit.any():
            data = values[hit].astype("<u4").view(np.uint8).reshape(-1, 4)[:, :w]
            out[at[hit][:, None] + np.arange(w)] = data


def encode_lists(term: np.ndarray, doc: np.ndarray, tf: np.ndarray, length: np.ndarray) -> dict[str, tuple]:
    """Posting lists, sorted by (term, doc): per term its df, its blocks and its bytes.

    ``length`` is each posting's document length. Returned are offsets by term
    (term numbers are 0, 1, ... without a gap) and the flat values behind them.
    """
    starts = np.flatnonzero(np.diff(term, prepend=-1))
    df = np.diff(np.append(starts, len(term)))
    n_blocks = -(-df // BLOCK)
    block_of_term = np.repeat(np.arange(len(df)), n_blocks)
    nth = np.arange(len(block_of_term)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
    first = starts[block_of_term] + nth * BLOCK
    size = np.minimum(BLOCK, df[block_of_term] - nth * BLOCK)
    block = np.repeat(np.arange(len(first)), size)
    # A block's first delta is its first document number itself.
    delta = np.diff(doc, prepend=0)
    delta[first] = doc[first]
    wide_doc, wide_tf = _widths(np.maximum.reduceat(delta, first)), _widths(np.maximum.reduceat(tf, first))
    nbytes = size * (wide_doc + wide_tf)
    at = np.cumsum(nbytes) - nbytes
    within = np.arange(len(doc)) - first[block]
    data = np.empty(int(nbytes.sum()), np.uint8)
    _scatter(data, at[block] + within * wide_doc[block], delta, wide_doc[block])
    _scatter(data, at[block] + (size * wide_doc)[block] + within * wide_tf[block], tf, wide_tf[block])
    # Impact points: by length, those with a higher frequency than all shorter ones of their block.
    order = np.lexsort((-tf, length, block))
    raised = np.maximum.accumulate(block[order] << 32 | tf[order])
    keep = order[np.diff(raised, prepend=-1) > 0]
    points = np.bincount(block[keep], minlength=len(first))
    by_term = lambda counts: np.concatenate([[0], np.cumsum(np.bincount(block_of_term, counts, len(df)))]).astype(np.int64)
    return {
        "df": (None, df),
        "last": (by_term(np.ones(len(first))), doc[first + size - 1]),
        "size": (by_term(np.ones(len(first))), size),
        "widths": (by_term(np.ones(len(first))), wide_doc * 8 + wide_tf),
        "points": (by_term(np.ones(len(first))), points),
        "point_tf": (by_term(points), tf[keep]),
        "point_n": (by_term(points), length[keep]),
        "data": (by_term(nbytes), data),
    }


INDEX_SCHEMA = ("shard long, term string, df int, last array<int>, size array<short>, widths array<byte>, points array<short>,"
                " point_tf array<int>, point_n array<int>, data binary, n_docs long, n_terms long, doc_ids array<long>")


def _list(offsets: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.astype(kind.to_pandas_dtype()), kind))


def shard_batches(shard: int, ids: list, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
    """The rows of one shard: its documents (term null) and a row for each term, in the order of terms."""
    vocabulary: dict[bytes, int] = defaultdict()
    vocabulary.default_factory = vocabulary.__len__  # a new term takes the next number
    words: list[bytes] = []
    docs, lengths = [], []
    for i, text in enumerate(texts):
        found = terms_of(text)
        if found:
            docs.append(ids[i])
            lengths.append(len(found))
            words += found
    if not docs:
        return
    n = np.array(lengths, np.int64)
    number = np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words))
    del words
    names = pa.array(list(vocabulary), pa.binary())
    ordered = pc.sort_indices(names)
    order = ordered.to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    key = np.sort(place[number] << 32 | np.repeat(np.arange(len(n)), n))
    first = np.flatnonzero(np.diff(key, prepend=-1))
    tf = np.diff(np.append(first, len(key)))
    term, doc = key[first] >> 32, key[first] & 0xFFFFFFFF
    made = encode_lists(term, doc, tf, n[doc])
    rows = len(order)
    kinds = {"last": pa.int32(), "size": pa.int16(), "widths": pa.int8(), "points": pa.int16(), "point_tf": pa.int32(), "point_n": pa.int32()}
    lists = [_list(*made[c], kind) for c, kind in kinds.items()]
    offsets, data = made["data"]
    held = pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])
    schema = pa.schema([("shard", pa.int64()), ("term", pa.string()), ("df", pa.int32()), *[(c, pa.list_(k)) for c, k in kinds.items()],
                        ("data", pa.binary()), ("n_docs", pa.int64()), ("n_terms", pa.int64()), ("doc_ids", pa.list_(pa.int64()))])
    one = [[shard], [None], [None], *[[None]] * 6, [n.astype("<i8").tobytes()], [len(n)], [int(n.sum())], [docs]]
    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(one, schema)], schema=schema)
    none = pa.nulls(rows, pa.int64())
    terms = names.take(ordered).cast(pa.string())
    table = pa.RecordBatch.from_arrays([pa.array(np.full(rows, shard)), terms, pa.array(made["df"][1], pa.int32()), *lists, held,
                                        none, none, pa.nulls(rows, pa.list_(pa.int64()))], schema=schema)
    for at in range(0, rows, 10_000):
        yield table.slice(at, 10_000)


def build_index(docs: DataFrame) -> DataFrame:
    """The index of (doc_id, text) as a written table: see ``INDEX_SCHEMA``.

    A shard's row without a term holds its documents: their ids, and their lengths
    in ``data``. A document's number is its place there.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                text = text.as_py()
                if texts and size + len(text) > SHARD_BYTES:
                    yield from shard_batches(shard, ids, texts)
                    shard, ids, texts, size = shard + 1, [], [], 0
                ids.append(doc)
                texts.append(text)
                size += len(text)
        yield from shard_batches(shard, ids, texts)

    return stage(rows.mapInArrow(run, INDEX_SCHEMA), "lexical-index")


# ---- search -----------------------------------------------------------------------------


class PostingList:
    """One term's postings in one shard, weighted: block bounds in the open, blocks decompressed on demand."""

    def __init__(self, weight: int, row: dict, impact):
        self.weight, self.data = weight, row["data"]
        self.last = np.asarray(row["last"], np.int64)
        self.size, widths = np.asarray(row["size"], np.int64), np.asarray(row["widths"], np.int64)
        self.wide_doc, self.wide_tf = widths >> 3, widths & 7
        self.at = np.cumsum(self.size * (self.wide_doc + self.wide_tf)) - self.size * (self.wide_doc + self.wide_tf)
        points = np.asarray(row["points"], np.int64)
        best = impact(np.asarray(row["point_tf"], np.int64), np.asarray(row["point_n"], np.int64))
        self.block_max = weight * np.maximum.reduceat(best, np.cumsum(points) - points)
        self.bound = int(self.block_max.max())
        self.impact = impact
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, i: int, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of a block; kept, since queries of a shard share lists."""
        if i not in self.open:
            a, b, n, at = int(self.wide_doc[i]), int(self.wide_tf[i]), int(self.size[i]), int(self.at[i])
            doc = np.cumsum(np.frombuffer(self.data, f"<u{a}", n, at).astype(np.int64))
            tf = np.frombuffer(self.data, f"<u{b}", n, at + a * n).astype(np.int64)
            self.open[i] = doc, self.weight * self.impact(tf, lengths[doc])
        return self.open[i]


def search_shard(lists: list[PostingList], lengths: np.ndarray, k: int, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Block-Max MaxScore: (document numbers, scores) of the k best and of all equal to the k-th, above 0."""
    lists = sorted((x for x in lists if x.bound > 0), key=lambda x: x.bound)
    below = np.cumsum([0, *[x.bound for x in lists]])
    kept_docs, kept_scores = np.empty(0, np.int64), np.empty(0, np.int64)
    least, essential = 1, 0  # a document needs this score; lists before ``essential`` cannot reach it together
    for low in range(0, len(lengths), window):
        high = min(low + window, len(lengths))
        while essential < len(lists) and below[essential + 1] < least:
            essential += 1
        score = np.zeros(high - low, np.int64)
        for x in lists[essential:]:
            first, last = np.searchsorted(x.last, [low, high - 1]).tolist()
            for i in range(first, min(last + 1, len(x.last))):
                d, s = x.block(i, lengths)
                a, b = np.searchsorted(d, [low, high])
                score[d[a:b] - low] += s[a:b]
        found = np.flatnonzero(score)
        docs, total = found + low, score[found]
        for j in range(essential - 1, -1, -1):
            # Without this list's block maximum and the bounds of the rest a candidate cannot stay.
            x = lists[j]
            at = np.searchsorted(x.last, docs)
            has = at < len(x.last)
            bound = np.where(has, x.block_max[np.minimum(at, len(x.last) - 1)], 0)
            stay = total + bound + below[j] >= least
            docs, total, at, has = docs[stay], total[stay], at[stay], has[stay]
            for i in np.unique(at[has]).tolist():
                where = np.flatnonzero(at == i)
                d, s = x.block(i, lengths)
                p = np.minimum(np.searchsorted(d, docs[where]), len(d) - 1)
                total[where] += np.where(d[p] == docs[where], s[p], 0)
        stay = total >= least
        kept_docs, kept_scores = np.append(kept_docs, docs[stay]), np.append(kept_scores, total[stay])
        if len(kept_scores) > k:
            least = max(least, int(np.partition(kept_scores, -k)[-k]))
            stay = kept_scores >= least
            kept_docs, kept_scores = kept_docs[stay], kept_scores[stay]
    return kept_docs, kept_scores


def queries_of(items: DataFrame) -> DataFrame:
    """query, item_id, block and the item's different terms, for each different (item_id, text)."""
    rows = items.select("item_id", text_or_empty().alias("text")).distinct()
    kind = rows.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            terms = [sorted({t.decode() for t in terms_of(x.as_py().encode())}) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(terms, pa.list_(pa.string()))], ["item_id", "text", "terms"])

    found = rows.mapInArrow(run, f"item_id {kind}, text string, terms array<string>").where(F.size("terms") > 0)
    # A query is known by its text's hash; so many hash blocks that one holds about QUERY_BLOCK queries.
    found = stage(found.withColumn("query", F.sha2(F.concat_ws("\x00", F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.col("text")), 256)).drop("text"), "lexical-queries")
    blocks = -(-found.count() // QUERY_BLOCK) or 1
    return found.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int"))


def search(index: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of the index for each item."""
    spark = index.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    totals = index.where("term is null").agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    n_docs, n_terms = int(totals["n"] or 0), int(totals["l"] or 0)
    if not n_docs:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    queries = queries_of(items)
    # Written first: its size is known when Spark chooses the join, and the index need not move for few terms.
    wanted = stage(queries.select("block", F.explode("terms").alias("term")).distinct(), "lexical-wanted")
    postings = stage(index.where("term is not null").drop("n_docs", "n_terms", "doc_ids").join(wanted, "term"), "lexical-postings")
    df = postings.dropDuplicates(["shard", "term"]).groupBy("term").agg(F.sum("df").alias("total"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("total") + 1).cast("double"))).cast("long")
    asked = (
        queries.select("query", "block", F.explode("terms").alias("term")).join(df, "term")
        .groupBy("block", "query").agg(F.collect_list(F.struct("term", weight.alias("w"))).alias("terms"))
        .groupBy("block").agg(F.collect_list(F.struct("query", "terms")).alias("queries"))
    )
    # Every shard meets every block of queries: an equi-join, with the shards dealt so that one block is no hot key.
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked = stage(asked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), "lexical-asked")
    shards = index.where("term is null").select(
        "shard", F.pmod(F.xxhash64("shard"), F.lit(salts)).cast("int").alias("salt"), "doc_ids", F.col("data").alias("lengths"))
    shards = shards.join(asked, "salt").drop("salt")

    def run(key: tuple, lists: pa.Table, shard: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query": [], "shard": [], "doc_id": [], "score": []}
        if lists.num_rows and shard.num_rows:
            lengths = np.frombuffer(shard["lengths"][0].as_py(), "<i8").astype(np.int64)
            ids = shard["doc_ids"][0].as_py()
            rows = {r["term"]: r for r in lists.to_pylist()}
            opened: dict[str, PostingList] = {}

            def impact(tf: np.ndarray, n: np.ndarray) -> np.ndarray:
                return 10**9 * tf // (1000 * tf + 8 * (10 + 90 * n * n_docs // n_terms))

            for q in shard["queries"][0].as_py():
                for t in q["terms"]:
                    if t["term"] in rows and t["term"] not in opened:
                        opened[t["term"]] = PostingList(t["w"], rows[t["term"]], impact)
                docs, scores = search_shard([opened[t["term"]] for t in q["terms"] if t["term"] in opened], lengths, k)
                best = sorted(zip((-scores).tolist(), (ids[d] for d in docs.tolist())), key=lambda x: (x[0], x[1] is None, x[1]))[:k]
                out["query"] += [q["query"]] * len(best)
                out["shard"] += [key[0].as_py()] * len(best)
                out["score"] += [-x for x, _ in best]
                out["doc_id"] += [x for _, x in best]
        return pa.table(out, pa.schema([("query", pa.string()), ("shard", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())]))

    heaps = postings.groupBy("shard", "block").cogroup(shards.groupBy("shard", "block")).applyInArrow(
        run, "query string, shard long, doc_id long, score long")
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    some = Window.partitionBy("query", "part").orderBy(*best)
    heaps = heaps.withColumn("part", F.pmod(F.xxhash64("shard"), F.lit(MERGE_PARTS))).withColumn("n", F.row_number().over(some)).where(F.col("n") <= k)
    heaps = heaps.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*best))).where(F.col("rank") <= k)
    return heaps.join(queries.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return search(build_index(documents(spark, sf_dir)), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE = r"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
sizes AS (SELECT rid, doc_id, len(terms)::BIGINT AS n FROM docs WHERE len(terms) > 0),
corpus AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
tfs AS (SELECT rid, term, count(*)::BIGINT AS tf FROM (SELECT rid, unnest(terms) AS term FROM docs) GROUP BY 1, 2),
weights AS (
    SELECT term, floor(1000.0 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM tfs CROSS JOIN corpus GROUP BY term, n_docs),
items AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scored AS (
    SELECT item_id, doc_id, rid, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM items JOIN tfs USING (term) JOIN weights USING (term) JOIN sizes USING (rid) CROSS JOIN corpus
    GROUP BY item_id, doc_id, rid),
ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
    FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
