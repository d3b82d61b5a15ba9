"""Substring deduplication with a compressed FM-index per shard.

A window is ``WINDOW`` consecutive words. Every word covered by a window whose
words also start anywhere else goes; windows are judged on the input.

1. Texts are cut into pieces: maximal runs of windows that share the smallest
   hash of their ``GRAM``-word grams (the route). Equal windows have equal
   routes, and every window lies in exactly one piece.
2. Pieces that occur more than once become one piece with a weight. Routes
   that occur once, without a repeat inside, cannot hold a repeated window.
3. The other pieces go to the shard of their route. A shard indexes its pieces:
   k-order Burrows-Wheeler transform, wavelet matrix of packed bits with rank
   counts, weights summed in suffix order.
4. The shard's pieces are streamed against its index by backward search. A
   piece all of whose words match with weight two or more is covered at once;
   of the others, each window's match is extended until its weight falls under
   two, and windows that reach ``WINDOW`` words are reported.

Defined results
---------------
* null, empty or wordless text: 0 words, 0 removed, the hash of nothing.
* null doc_id, repeated rows: documents of their own, so repeats remove each
  other's windows. Empty table: empty result. Other columns are ignored.
* words are compared by 64-bit hashes, whole windows word by word.

Scale
-----
A piece travels as 40 bytes; only one copy of each possibly repeated piece
travels with its words. A hot text's pieces are pre-aggregated before the
shuffle. A route with more than ``HOT_PIECES`` different pieces is cut into
single windows, pre-aggregated by window and spread by window hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscope.llm.common import documents, stage

WINDOW = 35
GRAM = 8
#: Context of the index's order; longer patterns are searched window by window.
CONTEXT = 64
SHARD_WORDS = 400_000
HOT_PIECES = 4096
BLOCK_BYTES = 1 << 20
BROADCAST_KEYS = 500_000

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


class Hashes:
    """Polynomial hashes of ranges; powers and inverse powers are kept for reuse."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.zeros(0, np.uint64)

    def ranges(self, values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        n = len(values)
        if len(self.up) < n + 1:
            self.up, self.down = _powers(self.base, 2 * n + 2), _powers(self.inverse, 2 * n + 2)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(values * self.up[:n], out=total[1:])
        return _mix((total[end] - total[start]) * self.down[start] + (end - start).astype(np.uint64))


def split_words(raw: bytes, hashes: Hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end bytes of the words, and a 64-bit hash of each."""
    b = np.frombuffer(raw, np.uint8)
    edge = np.diff(np.concatenate([[True], _SPACE[b], [True]]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    return start, end, hashes.ranges(b.astype(np.uint64) + np.uint64(1), start, end)


def blocks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about BLOCK_BYTES together; a longer text is a block of its own."""
    lo = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BLOCK_BYTES:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    out, have = x, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[:len(x) - width + 1], out[width - have:]) if have < width else out


def pieces(words: np.ndarray, first: np.ndarray, hashes: Hashes):
    """Pieces of texts whose word hashes are laid end to end; ``first`` has the texts' first words and the end.

    Arrays: text, start (within all words), windows, route, pid, inner (a window may repeat inside).
    """
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64, bool))
    n = len(words)
    if n < WINDOW:
        return none
    at = np.arange(n - GRAM + 1)
    gram = hashes.ranges(words, at, at + GRAM)
    low = _window_min(gram, WINDOW - GRAM + 1)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    p = np.arange(n - WINDOW + 1)
    ok = text[p] == text[p + WINDOW - 1]
    p = p[ok]
    if not len(p):
        return none
    route, owner = low[p], text[p]
    new = np.ones(len(p), bool)
    new[1:] = (route[1:] != route[:-1]) | (owner[1:] != owner[:-1]) | (np.diff(p) != 1)
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(p)))
    start = p[head]
    pid = hashes.ranges(words, start, start + count + WINDOW - 1)
    # The route's gram twice in a piece: its windows may repeat each other.
    grams = count + WINDOW - GRAM
    offset = np.repeat(start - np.concatenate([[0], np.cumsum(grams)[:-1]]), grams) + np.arange(grams.sum())
    same = np.add.reduceat((gram[offset] == np.repeat(route[head], grams)).astype(np.int32), np.concatenate([[0], np.cumsum(grams)[:-1]]))
    return owner[head], start, count, route[head], pid, same > 1


class FMIndex:
    """Weighted FM-index over pieces: counts how often (by weight) a pattern of up to CONTEXT symbols occurs."""

    def __init__(self, symbols: np.ndarray, weights: np.ndarray):
        """``symbols``: pieces laid end to end, each closed by 0; ``weights``: of each position."""
        n = len(symbols)
        rank = symbols.astype(np.int64)
        step = 1
        while step < CONTEXT:
            after = np.zeros(n, np.int64)
            after[:n - step] = rank[step:] + 1
            _, rank = np.unique(rank * (n + int(symbols.max()) + 2) + after, return_inverse=True)
            step *= 2
            if step > 1 and rank.max() == n - 1:
                break
        order = np.argsort(rank, kind="stable")
        self.n = n
        self.weight = np.concatenate([[0], np.cumsum(weights[order])])
        last = symbols[order - 1]  # the symbol before each suffix; the first suffix follows the closing 0
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=int(symbols.max()) + 1))])
        # Wavelet matrix: a packed bit vector with rank counts per level, high bit first.
        self.levels = max(1, int(symbols.max()).bit_length())
        self.bits, self.counts, self.zeros = [], [], []
        seq = last
        for level in range(self.levels - 1, -1, -1):
            bit = (seq >> level & 1).astype(np.uint8)
            packed = np.packbits(np.concatenate([bit, np.zeros(-n % 64 + 64, np.uint8)]), bitorder="little").view(np.uint64)
            self.bits.append(packed)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed))]).astype(np.int32))
            self.zeros.append(n - int(bit.sum()))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])
        # Where each symbol's run begins on the last level: a rank is a position there less this.
        every = np.arange(len(self.first) - 1)
        self.begin = self._follow(every, np.zeros(len(every), np.int64))

    def _follow(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Position on the last level that position ``at`` of the transform leads to by the symbol's bits."""
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            word = at >> 6
            mask = np.left_shift(np.uint64(1), (at & 63).view(np.uint64))
            mask -= np.uint64(1)
            mask &= self.bits[k].take(word)
            ones = self.counts[k].take(word) + np.bitwise_count(mask)
            at = np.where(symbol >> level & 1, ones + self.zeros[k], at - ones)
        return at

    def step(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Interval of the pattern with ``symbol`` put before it."""
        got = self._follow(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        base = self.first[symbol] - self.begin[symbol]
        return base + got[:len(lo)], base + got[len(lo):]

    def reach(self, text: np.ndarray, end: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Longest match (weight two or more) that ends before ``end``, going back ``most`` symbols at most."""
        length = np.zeros(len(end), np.int64)
        act = np.flatnonzero(most > 0)
        last = text[end[act] - 1]
        lo, hi, first = self.first[last], self.first[last + 1], True  # one symbol: its run of the suffix order
        while len(act):
            if not first:
                lo, hi = self.step(text[end[act] - length[act] - 1], lo, hi)
            first = False
            ok = self.weight[hi] - self.weight[lo] >= 2
            act, lo, hi = act[ok], lo[ok], hi[ok]
            length[act] += 1
            more = length[act] < most[act]
            act, lo, hi = act[more], lo[more], hi[more]
        return length


def covered(words: list[np.ndarray], weights: np.ndarray) -> list[np.ndarray]:
    """Per piece, the offsets of its windows that occur twice or more (by weight) in all the pieces."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.concatenate(words)
    _, ids = np.unique(flat, return_inverse=True)
    closed = np.zeros(len(flat) + len(words), np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    place = np.arange(len(flat)) + np.repeat(np.arange(len(words)), sizes)
    closed[place] = ids + 1
    index = FMIndex(closed, np.repeat(weights, sizes + 1))
    whole = np.flatnonzero(sizes <= CONTEXT)
    full = np.zeros(len(words), bool)
    full[whole] = index.reach(closed, (begin + sizes)[whole], sizes[whole]) == sizes[whole]
    out = [np.zeros(0, np.int32)] * len(words)
    for i in np.flatnonzero(full):
        out[i] = np.arange(sizes[i] - WINDOW + 1, dtype=np.int32)
    rest = np.flatnonzero(~full)
    if len(rest):
        count = sizes[rest] - WINDOW + 1
        owner = np.repeat(rest, count)
        offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        hit = np.zeros(len(owner), bool)
        for a in range(0, len(owner), 500_000):
            part = slice(a, a + 500_000)
            end = begin[owner[part]] + offset[part] + WINDOW
            hit[part] = index.reach(closed, end, np.full(len(end), WINDOW)) == WINDOW
        for i, got in pd.Series(offset[hit]).groupby(owner[hit]):
            out[i] = got.to_numpy(np.int32)
    return out


def _raw(column) -> list[bytes]:
    return [(x.as_py() or "").encode("utf-8", "surrogatepass") for x in column]


def _block_words(texts: list[bytes], hashes: Hashes):
    """Start and end bytes, hashes and first words of a block's texts, laid end to end."""
    raw = b" ".join(texts)
    start, end, h = split_words(raw, hashes)
    begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    return raw, start, end, h, np.searchsorted(start, begin)


def piece_table(docs: DataFrame) -> DataFrame:
    """doc_id, tag (of the text), start, windows, route, pid, inner of every piece of every row."""
    rows = docs.select("doc_id", F.hash(F.col("text").cast("string")).alias("tag"), F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_byte, by_word = Hashes(_BYTE_BASE), Hashes(_WORD_BASE)
        for b in batches:
            texts = _raw(b.column(2))
            for lo, hi in blocks(texts):
                _, _, _, h, first = _block_words(texts[lo:hi], by_byte)
                text, start, windows, route, pid, inner = pieces(h, first, by_word)
                if len(text):
                    take = pa.array(text + lo)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(take), b.column(1).take(take), pa.array((start - first[text]).astype(np.int32)), pa.array(windows.astype(np.int32)),
                         pa.array(route.view(np.int64)), pa.array(pid.view(np.int64)), pa.array(inner)],
                        names=["doc_id", "tag", "start", "windows", "route", "pid", "inner"],
                    )

    return rows.mapInArrow(run, f"doc_id {kind}, tag int, start int, windows int, route long, pid long, inner boolean")


def _with_lists(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` (doc_id, tag, text) with their list of ``lists`` (doc_id, tag, ...); texts without one stay out of the shuffle."""
    keys = lists.select(F.col("doc_id").alias("k_id"), F.col("tag").alias("k_tag")).distinct()
    on = F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("tag") == F.col("k_tag"))
    if keys.count() <= BROADCAST_KEYS:  # 16 bytes a key; beyond the bound all texts go through the join
        docs = docs.join(F.broadcast(keys), on, "left_semi")
    renamed = lists.withColumnRenamed("doc_id", "k_id").withColumnRenamed("tag", "k_tag")
    return docs.join(renamed, on, how).drop("k_id", "k_tag")


def _tagged(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select("doc_id", F.hash(text).alias("tag"), text.alias("text"))


def repeated_windows(docs: DataFrame, found: DataFrame) -> DataFrame:
    """route, pid, offsets of the windows of the pieces ``found`` that occur again."""
    at = F.struct("doc_id", "tag", "start", "windows")
    different = stage(found.groupBy("route", "pid").agg(F.count(F.lit(1)).alias("weight"), F.min(at).alias("at"), F.max("inner").alias("inner")), "substring-pieces")
    routes = different.groupBy("route").agg(F.sum("weight").alias("all"), F.count(F.lit(1)).alias("kinds"))
    routes = routes.select("route", F.col("all"), F.col("kinds"))
    wanted = stage(different.join(routes, "route").where("all > 1 or inner").select("route", "pid", "weight", "at", "kinds"), "substring-wanted")
    total = wanted.agg(F.sum(F.col("at.windows") + WINDOW)).first()[0] or 0
    shards = max(1, -(-int(total) // SHARD_WORDS))

    # The words of one copy of each wanted piece.
    one = F.struct(F.col("at.start").alias("start"), F.col("at.windows").alias("windows"), "route", "pid", "weight", (F.col("kinds") > HOT_PIECES).alias("hot"))
    lists = stage(wanted.select("at.doc_id", "at.tag", one.alias("p")).groupBy("doc_id", "tag").agg(F.collect_list("p").alias("ps")), "substring-lists")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_byte, by_word = Hashes(_BYTE_BASE), Hashes(_WORD_BASE)
        for b in batches:
            for raw, ps in zip(_raw(b.column("text")), b.column("ps")):
                start, end, h = split_words(raw, by_byte)
                out = []
                for p in ps.as_py():
                    s, n = p["start"], p["windows"]
                    if p["hot"]:  # single windows, spread by their own hash
                        at = np.arange(s, s + n)
                        for k, x in zip(at.tolist(), by_word.ranges(h, at, at + WINDOW).view(np.int64).tolist()):
                            out.append((x, p["route"], p["pid"], k - s, p["weight"], raw[start[k]:end[k + WINDOW - 1]]))
                    else:
                        out.append((p["route"], p["route"], p["pid"], -1, p["weight"], raw[start[s]:end[s + n + WINDOW - 2]]))
                if out:
                    spread, route, pid, offset, weight, words = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(spread, pa.int64()), pa.array(route, pa.int64()), pa.array(pid, pa.int64()), pa.array(offset, pa.int32()), pa.array(weight, pa.int64()), pa.array(words, pa.binary())],
                        names=["spread", "route", "pid", "offset", "weight", "words"],
                    )

    texts = _with_lists(_tagged(docs), lists, "inner")
    cuts = texts.select("text", "ps").mapInArrow(cut, "spread long, route long, pid long, offset int, weight long, words binary")
    # A repeated row cuts its pieces again: one copy of each counts, its weight has them all.
    cuts = stage(cuts.dropDuplicates(["route", "pid", "offset"]), "substring-cuts")
    hot = cuts.where("offset >= 0")
    # No nulls among the 64-bit keys: pandas would turn the column into doubles.
    indexed = cuts.where("offset < 0").select(F.lit(False).alias("hot"), "spread", "route", "pid", "weight", "words")
    hot_windows = hot.groupBy("spread").agg(F.sum("weight").alias("weight"), F.min("words").alias("words"))
    zero = F.lit(0).cast("long")
    indexed = indexed.unionByName(hot_windows.select(F.lit(True).alias("hot"), "spread", zero.alias("route"), zero.alias("pid"), "weight", "words"))

    def search(part: pd.DataFrame) -> pd.DataFrame:
        by_byte = Hashes(_BYTE_BASE)
        part = part.sort_values("words", kind="stable")
        got = covered([split_words(x, by_byte)[2] for x in part["words"]], part["weight"].to_numpy(np.int64))
        some = np.fromiter(map(len, got), np.int64, len(got)) > 0
        out = part.loc[some, ["hot", "spread", "route", "pid"]].reset_index(drop=True)
        out["offsets"] = [x.tolist() for x, s in zip(got, some) if s]
        return out

    shard = F.pmod(F.xxhash64("spread"), F.lit(shards)).cast("int").alias("shard")
    reported = stage(indexed.groupBy(shard).applyInPandas(search, "hot boolean, spread long, route long, pid long, offsets array<int>"), "substring-reported")
    plain = reported.where("not hot").select("route", "pid", "offsets")
    hot_hit = reported.where("hot").select("spread")
    again = hot.select("spread", "route", "pid", "offset").join(hot_hit, "spread").groupBy("route", "pid").agg(F.collect_set("offset").alias("offsets"))
    return plain.unionByName(again)


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, joined by one space) for every row."""
    found = stage(piece_table(docs), "substring-found")
    repeats = stage(repeated_windows(docs, found), "substring-repeats")
    spans = found.select("doc_id", "tag", "start", "route", "pid").join(repeats, ["route", "pid"]).select("doc_id", "tag", "start", "offsets")
    lists = stage(spans.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("start", "offsets")).alias("ps")), "substring-spans")
    rows = _tagged(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_removed long, kept binary"

    def cut(with_lists: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                texts = _raw(b.column("text"))
                lists = b.column("ps") if with_lists else [None] * len(texts)
                n, gone, kept = [], [], []
                for raw, ps in zip(texts, lists):
                    words = raw.split()
                    n.append(len(words))
                    if ps is not None and (ps := ps.as_py()):
                        mark = np.zeros(len(words) + 1, np.int64)
                        at = np.concatenate([np.asarray(p["offsets"]) + p["start"] for p in ps])
                        np.add.at(mark, at, 1)
                        np.add.at(mark, at + WINDOW, -1)
                        stay = np.cumsum(mark)[:-1] == 0
                        words = [w for w, s in zip(words, stay.tolist()) if s]
                    gone.append(n[-1] - len(words))
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary())], names=["doc_id", "n_words", "n_removed", "kept"])

        return run

    keys = lists.select(F.col("doc_id").alias("k_id"), F.col("tag").alias("k_tag"))
    on = F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("tag") == F.col("k_tag"))
    clean = rows.join(F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys, on, "left_anti").select("doc_id", "text").mapInArrow(cut(False), schema)
    return clean.unionByName(_with_lists(rows, lists, "inner").select("doc_id", "text", "ps").mapInArrow(cut(True), schema))


def query(spark, sf_dir: str) -> DataFrame:
    out = dedup_substrings(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), win AS (
  SELECT rid, i, list_aggregate(ws[i:i + 34], 'string_agg', ' ') AS words FROM (SELECT rid, ws, unnest(range(1, len(ws) - 33)) AS i FROM w)
), again AS (
  SELECT words FROM win GROUP BY words HAVING count(*) > 1
), gone AS (
  SELECT rid, list(DISTINCT p) AS ps FROM (SELECT rid, unnest(range(i, i + 35)) AS p FROM win SEMI JOIN again USING (words)) GROUP BY rid
), kept AS (
  SELECT doc_id, ws, [x for x, i in ws if NOT list_contains(coalesce(ps, []), i)] AS stay FROM w LEFT JOIN gone USING (rid)
)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - len(stay))::BIGINT AS n_removed,
       sha256(coalesce(list_aggregate(stay, 'string_agg', ' '), '')) AS kept_sha256
FROM kept
"""
