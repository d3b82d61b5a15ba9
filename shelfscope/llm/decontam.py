"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of the benchmark's words over all documents.
2. Randomised SVD of the TF-IDF matrix of all passages (documents and items):
   every task adds up its share of A'(A G) for a fixed random G; the sum gives
   the leading right singular vectors by a single-view (Nystrom) decomposition.
3. Every text is searched in windows of the items' lengths, a quarter window
   apart: a window whose latent vector has enough cosine and enough projection on
   an item's is a candidate. So is a place where an item's answer stands, which
   needs no latent vector: a copy with its answer is never missed by the gate. The
   rank grows with the square root of the number of items.
4. A candidate counts if a window little longer than the item has a longest
   common subsequence of ``LCS`` of the item's words, or of ``LCS_ANSWER`` with
   the item's answer (its last ``ANSWER_WORDS`` words) in one piece.

Defined results
---------------
* words are runs of letters and digits, lower case. Null or wordless texts and
  items take no part; such documents stay.
* null doc_id or item_id: reported as null. Items with equal texts are all reported.
* repeated rows: each is searched. Empty tables: no hits, all documents stay.
* ``clean_documents`` returns the input's columns, whatever their names.

Scale
-----
Texts are split into words once and written as word ids; three passes over these
whole lists, no shuffle of documents. The benchmark is the reference set that is broadcast: its size is checked against
``MAX_BENCHMARK_BYTES`` and an error raised beyond. All matrices have the size
of its vocabulary times the rank; they are summed in two rounds over salts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscope.llm.common import documents, stage

#: The rank up to RANK_ITEMS items; it grows with the square root of their number beyond.
RANK, RANK_ITEMS, EXTRA = 64, 400, 8
PASSAGE = 64
CELL = 8
COSINE, PROJECTION = 0.45, 0.45
LCS, LCS_ANSWER, ANSWER_WORDS = 0.8, 0.6, 5
#: A match may spread over this many times the item's words.
SPREAD = 1.25
MAX_BENCHMARK_BYTES = 64 << 20
#: The words' vectors are broadcast too; the rank grows with the number of items.
MAX_VECTOR_BYTES = 512 << 20
#: Candidates whose subsequences are computed at once, and the base of the answers' hashes.
MANY_PAIRS = 4096
HASH = np.uint64(0x9E3779B97F4A7C15)
#: Words whose vectors are worked on at once.
BLOCK_WORDS = 200_000
#: Items that a block's windows are compared with at once.
BLOCK_ITEMS = 1024
SALTS = 64
TERM_BLOCK = 1024

_FIND = re.compile(r"\w+").findall


def words_of(text: str | None) -> list[str]:
    return _FIND(text.lower()) if text else []


def lcs_length(masks: dict, n: int, words: list) -> int:
    """Longest common subsequence by bit-parallel rows; ``masks`` has the positions of each of the item's n words."""
    full = (1 << n) - 1
    v = full
    for w in words:
        m = masks.get(w)
        if m is not None:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


@dataclass(frozen=True)
class Item:
    item_id: object
    #: Texts, or their numbers in the vocabulary.
    words: list

    @property
    def masks(self) -> dict:
        out: dict = {}
        for i, w in enumerate(self.words):
            out[w] = out.get(w, 0) | 1 << i
        return out

    def matches(self, region: list) -> tuple[float, bool] | None:
        """Best LCS share and whether the answer stands there, of the windows of ``region``; None if it is no match."""
        n, masks = len(self.words), self.masks
        if lcs_length(masks, n, region) < LCS_ANSWER * n:
            return None
        width = math.ceil(n * SPREAD)
        answer = answer_of(self)
        k = len(answer)
        best, answered = 0.0, False
        for at in range(max(1, len(region) - n // 2)):
            if region[at] not in masks:
                continue
            part = region[at:at + width]
            share = lcs_length(masks, n, part) / n
            said = any(part[i:i + k] == answer for i in range(len(part) - k + 1))
            if share >= LCS or share >= LCS_ANSWER and said:
                if (share, said) > (best, answered):
                    best, answered = share, said
                if best == 1.0:
                    break
        return (best, answered) if best else None


def read_items(benchmark: DataFrame) -> list[Item]:
    """The benchmark's items; raises if it is too large to be a broadcast reference set."""
    size = benchmark.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    if size > MAX_BENCHMARK_BYTES:
        raise ValueError(f"the benchmark has {size} bytes of text; split it into runs of {MAX_BENCHMARK_BYTES}")
    rows = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null").collect()
    items = [Item(r["item_id"], words_of(r["text"])) for r in rows]
    return sorted((x for x in items if x.words), key=lambda x: (x.item_id is None, x.item_id if x.item_id is not None else 0, x.words))


def _coded(get, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word ids of a column of texts, one after the other (-1: not in the vocabulary), and each text's number of words."""
    texts = [words_of(x.as_py()) for x in column]
    count = np.fromiter(map(len, texts), np.int64, len(texts))
    parts = [np.fromiter(map(get, words, repeat(-1)), np.int32, len(words)) for words in texts]
    return np.concatenate([np.empty(0, np.int32), *parts]), count


def word_ids(docs: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """doc_id, ids: every text's words as numbers, written once for the passes that follow."""
    given = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = given.value.get
        for b in batches:
            for lo, hi in _runs(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False), BLOCK_WORDS * 8):
                ids, count = _coded(get, b.column(1)[lo:hi])
                ends = np.concatenate([[0], np.cumsum(count)])
                yield pa.RecordBatch.from_arrays([b.column(0)[lo:hi], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))], names=["doc_id", "ids"])

    return stage(rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>"), "decontam-ids")


def _runs(size: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of neighbours whose sizes sum up to ``most``, or are one alone."""
    lo, total = 0, 0
    for i, x in enumerate(size.tolist()):
        if total and total + x > most:
            yield lo, i
            lo, total = i, 0
        total += x
    if lo < len(size):
        yield lo, len(size)


def _lists(column) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Texts of a column of id lists in runs of bounded size: number of the first text, ids, words a text."""
    count = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ids, ends = column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(count)])
    for lo, hi in _runs(count, BLOCK_WORDS):
        yield lo, ids[ends[lo]:ends[hi]], count[lo:hi]


def _padded(ids: np.ndarray, count: np.ndarray, width: int, unknown: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``width`` words, a text beginning at a row of its own, and each text's number of rows."""
    rows = -(-count // width)
    flat = np.full(int(rows.sum()) * width, unknown, np.int32)
    shift = np.cumsum(rows) * width - rows * width - np.cumsum(count) + count
    flat[np.arange(len(ids)) + np.repeat(shift, count)] = np.where(ids < 0, unknown, ids)
    return flat.reshape(-1, width), rows


def _row_sums(rows: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Sum of the vectors of each row's words; the last vector is that of unknown words, zero."""
    total = vectors[rows[:, 0]]
    for j in range(1, rows.shape[1]):
        total += vectors[rows[:, j]]
    return total


def document_frequencies(ids: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """In how many texts of a ``word_ids`` table each word stands, and how many texts there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(size + 1, np.int64), 0
        for b in batches:
            n += b.num_rows
            for _, own, count in _lists(b.column(0)):
                key = np.repeat(np.arange(len(count)) * size, count)[own >= 0] + own[own >= 0]
                key.sort()
                df[:-1] += np.bincount(key[np.flatnonzero(np.diff(key, prepend=-1))] % size, minlength=size)
        df[-1] = n
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["term", "df"])

    got = ids.select("ids").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toPandas()
    df = np.zeros(size + 1)
    df[got["term"].to_numpy(np.int64)] = got["df"].to_numpy(float)
    return df[:-1], int(df[-1])


def _sketch(rows: np.ndarray, idf: np.ndarray, g: np.ndarray, z: np.ndarray) -> None:
    """Add A'(A g) to z for passages, one a row of word ids (unknown: the vocabulary's size); rows of A are unit TF-IDF vectors."""
    t, width = len(idf), rows.shape[1]
    rows = rows[(rows < t).any(axis=1)]
    if not len(rows):
        return
    ordered = np.sort(rows, axis=1)
    new = np.ones(ordered.shape, bool)
    new[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
    at = np.flatnonzero(new)
    tf, term, row = np.diff(at, append=ordered.size), ordered.reshape(-1)[at], at // width
    known = term < t
    tf, term, row = tf[known], term[known], row[known]
    val = tf * idf[term]
    norm = np.sqrt(np.bincount(row, val**2, len(rows)))
    y = _row_sums(rows, np.vstack([g * idf[:, None], np.zeros((1, g.shape[1]))]).astype(np.float32)) / norm[:, None].astype(np.float32)
    val = (val / norm[row]).astype(np.float32)
    order = np.argsort(term, kind="stable")
    term = term[order]
    start = np.flatnonzero(np.diff(term, prepend=-1))
    z[term[start]] += np.add.reduceat(y[row[order]] * val[order, None], start, axis=0)


def singular_vectors(ids: DataFrame, items: list[Item], vocabulary: dict[str, int], idf: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Leading right singular vectors (words x rank) of the TF-IDF passages of texts and items, either half the weight."""
    t = len(vocabulary)
    width = min(t, rank + EXTRA)
    g = np.random.default_rng(7).standard_normal((t, width)).astype(np.float32)
    if g.nbytes > MAX_VECTOR_BYTES:
        raise ValueError(f"the words' vectors take {g.nbytes} bytes; split the benchmark into runs of {MAX_VECTOR_BYTES}")
    given = ids.sparkSession.sparkContext.broadcast((idf, g))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, g = given.value
        z, passages = np.zeros(g.shape), 0
        for b in batches:
            for _, own, count in _lists(b.column(0)):
                rows, n = _padded(own, count, PASSAGE, t)
                passages += int(n.sum())
                for lo in range(0, len(rows), BLOCK_WORDS // PASSAGE):
                    _sketch(rows[lo:lo + BLOCK_WORDS // PASSAGE], idf, g, z)
        salt = TaskContext.get().partitionId() % SALTS
        # Blocks of words that no text of the task holds are left out.
        parts = [(i, z[i * TERM_BLOCK:(i + 1) * TERM_BLOCK]) for i in range(-(-len(z) // TERM_BLOCK))]
        parts = [(i, p) for i, p in parts if i == 0 or p.any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in parts], pa.int32()), pa.array([salt] * len(parts), pa.int32()), pa.array([passages] * len(parts), pa.int64()), pa.array([p.tobytes() for _, p in parts], pa.binary())],
            names=["block", "salt", "n", "z"],
        )

    def add(part: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x) for x in part["z"])
        return pd.DataFrame({"block": part["block"].iloc[:1], "salt": part["salt"].iloc[:1], "n": [part["n"].sum()], "z": [total.tobytes()]})

    schema = "block int, salt int, n long, z binary"
    sums = ids.select("ids").mapInArrow(run, schema).groupBy("block", "salt").applyInPandas(add, schema)
    found = {r["block"]: r for r in sums.groupBy("block").applyInPandas(add, schema).collect()}
    own = np.zeros((t, width))
    for x in items:
        _sketch(np.array([[vocabulary[w] for w in x.words]]), idf, g, own)
    z = own / len(items)
    if found and found[0]["n"]:
        for i, r in found.items():
            z[i * TERM_BLOCK:(i + 1) * TERM_BLOCK] += np.frombuffer(r["z"]).reshape(-1, width) / found[0]["n"]
    # A'A ~ z (g'z)^-1 z': eigenvectors of the approximation, by a square root with a small shift.
    core = g.T.astype(float) @ z
    values, turn = np.linalg.eigh((core + core.T) / 2)
    ok = values > values.max() * 1e-10
    u, _, _ = np.linalg.svd(z @ (turn[:, ok] / np.sqrt(values[ok])), full_matrices=False)
    return u[:, :rank].astype(np.float32)


def answer_of(item: Item) -> list:
    return item.words[-ANSWER_WORDS:]


@dataclass(frozen=True)
class Index:
    """What a search needs: items as word ids and by window length, words' weighted latent vectors and a last one of zeros."""

    items: list[Item]
    vocabulary: dict[str, int]
    vectors: np.ndarray
    classes: list[tuple[int, np.ndarray, np.ndarray]]
    #: Items by their answers.
    answers: dict[tuple[int, ...], list[int]]


def rank_of(n_items: int) -> int:
    return max(RANK, math.ceil(RANK * math.sqrt(n_items / RANK_ITEMS)))


def build_index(docs: DataFrame, benchmark: DataFrame, rank: int | None = None) -> tuple[Index, DataFrame] | None:
    """The index of the benchmark's items, and the ``word_ids`` table of the documents."""
    items = read_items(benchmark)
    if not items:
        return None
    rank = rank_of(len(items)) if rank is None else rank
    vocabulary = {w: i for i, w in enumerate(sorted({w for x in items for w in x.words}))}
    ids = word_ids(docs, vocabulary)
    df, n = document_frequencies(ids, len(vocabulary))
    idf = np.log((1.0 + n) / (1.0 + df)) + 0.05
    vectors = singular_vectors(ids, items, vocabulary, idf, rank) * idf[:, None].astype(np.float32)
    return index_of(items, vocabulary, vectors), ids


def index_of(items: list[Item], vocabulary: dict[str, int], vectors: np.ndarray) -> Index:
    items = [Item(x.item_id, [vocabulary[w] for w in x.words]) for x in items]
    latent = np.stack([vectors[x.words].sum(0) for x in items])
    length = [max(2 * CELL, 1 << (len(x.words) - 1).bit_length()) for x in items]
    classes = [(c, np.flatnonzero(np.array(length) == c), latent[np.array(length) == c]) for c in sorted(set(length))]
    answers: dict[tuple[int, ...], list[int]] = {}
    for i, x in enumerate(items):
        answers.setdefault(tuple(answer_of(x)), []).append(i)
    return Index(items, vocabulary, np.vstack([vectors, np.zeros((1, vectors.shape[1]), vectors.dtype)]), classes, answers)


def _answers(index: Index, flat: np.ndarray, begin: np.ndarray, count: np.ndarray) -> dict[tuple[int, int], list[int]]:
    """Ends of the places where an item's answer stands in a text, by (text, item)."""
    said: dict[tuple[int, int], list[int]] = {}
    for k in sorted({len(x) for x in index.answers}):
        # Hashes of all runs of k words by one product and sum a word; equal ones are compared.
        keys = np.array([x for x in index.answers if len(x) == k], np.uint64)
        total, wanted = np.zeros(max(0, len(flat) - k + 1), np.uint64), np.zeros(len(keys), np.uint64)
        for j in range(k):
            total = total * HASH + flat[j:j + len(total)].astype(np.uint64)
            wanted = wanted * HASH + keys[:, j]
        wanted.sort()
        place = np.minimum(np.searchsorted(wanted, total), len(wanted) - 1)
        at = np.flatnonzero(wanted[place] == total)
        text = np.searchsorted(begin, at, "right") - 1
        for p, d in zip(at.tolist(), text.tolist()):
            q = p - int(begin[d]) + k
            if q <= count[d]:
                for item in index.answers.get(tuple(flat[p:p + k].tolist()), ()):
                    said.setdefault((d, item), []).append(q)
    return said


def _may_match(index: Index, flat: np.ndarray, lo: np.ndarray, hi: np.ndarray, item: np.ndarray, width: int) -> np.ndarray:
    """Do the words from lo to hi have LCS_ANSWER of the item's words in order? Bit-parallel for all pairs at once, items of up to 64 words."""
    ok = np.zeros(len(lo), bool)
    unknown = len(index.vocabulary)
    masks = np.zeros(unknown + 1, np.uint64)
    order = np.argsort(item, kind="stable")
    for a in range(0, len(order), MANY_PAIRS):
        part = order[a:a + MANY_PAIRS]
        at = lo[part, None] + np.arange(3 * width)
        words = np.where(at < hi[part, None], flat[np.minimum(at, len(flat) - 1)], unknown)
        m = np.empty(words.shape, np.uint64)
        n = np.empty(len(part), np.uint64)
        cuts = np.flatnonzero(np.diff(item[part], prepend=-1))
        for b, e in zip(cuts, [*cuts[1:], len(part)]):
            x = index.items[item[part[b]]]
            for w, bits in x.masks.items():
                masks[w] = bits
            m[b:e], n[b:e] = masks[words[b:e]], len(x.words)
            masks[x.words] = 0
        full = np.uint64(2**64 - 1) >> (np.uint64(64) - n)
        v = full.copy()
        for column in np.ascontiguousarray(m.T):
            u = v & column
            v = ((v + u) | (v - u)) & full
        ok[part] = n - np.bitwise_count(v) >= LCS_ANSWER * n
    return ok


def search(index: Index, ids: np.ndarray, count: np.ndarray) -> Iterator[tuple[int, int, float, float, bool]]:
    """(text, item, cosine, LCS share, answer found) of every match in texts of ``count`` words each."""
    if not (ids >= 0).any():
        return
    cells, n_cells = _padded(ids, count, CELL, len(index.vocabulary))
    flat = cells.reshape(-1)
    end = np.cumsum(n_cells)
    begin = end - n_cells
    sums = np.zeros((len(cells) + 1, index.vectors.shape[1]))
    np.cumsum(_row_sums(cells, index.vectors), axis=0, dtype=float, out=sums[1:])
    said = _answers(index, flat, begin * CELL, count)
    for width, which, latent in index.classes:
        span, step = width // CELL, max(1, width // CELL // 4)
        windows = -(-n_cells // step)
        text = np.repeat(np.arange(len(count)), windows)
        lo = begin[text] + (np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)) * step
        size = np.sqrt((latent**2).sum(1))
        if not size.max() > 0:
            continue
        # The projection on each item in units of its length; a window shorter than PROJECTION of every item reaches none.
        scaled = (latent / np.maximum(size, 1e-12)[:, None] ** 2).T
        least = PROJECTION * size[size > 0].min() * (1 - 1e-5)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for a in range(0, len(lo), 65_536):
            s = (sums[np.minimum(lo[a:a + 65_536] + span, end[text[a:a + 65_536]])] - sums[lo[a:a + 65_536]]).astype(np.float32)
            own = np.sqrt((s**2).sum(1))
            able = np.flatnonzero(own >= least)
            s, own = s[able], own[able]
            for k in range(0, len(which), BLOCK_ITEMS):
                projection = s @ scaled[:, k:k + BLOCK_ITEMS]
                i, j = np.divmod(np.flatnonzero(projection >= PROJECTION), projection.shape[1])
                cosine = projection[i, j] * size[k + j] / own[i]
                near = cosine >= COSINE
                found.append((able[i[near]] + a, which[k + j[near]], cosine[near]))
        at, item, cosine = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, int),) * 3
        pair = text[at] * len(index.items) + item
        pairs, number = np.unique(pair, return_inverse=True)
        best_cosine = np.zeros(len(pairs))
        np.maximum.at(best_cosine, number, cosine)
        word = lo[at] * CELL
        first, last = begin[text[at]] * CELL, begin[text[at]] * CELL + count[text[at]]
        if width <= 64 and len(at):
            able = _may_match(index, flat, np.maximum(first, word - width), np.minimum(last, word + 2 * width), item, width)
            number, word, first = number[able], word[able], first[able]
        places: dict[int, list[int]] = {}
        for x, w in zip(number.tolist(), (word - first).tolist()):
            places.setdefault(x, []).append(w)
        tried = {divmod(int(pairs[x]), len(index.items)): (float(best_cosine[x]), w) for x, w in places.items()}
        own_items = set(which.tolist())
        for d, i in said:
            if i in own_items and (d, i) not in tried:
                x = int(np.searchsorted(pairs, d * len(index.items) + i))
                hit = x < len(pairs) and pairs[x] == d * len(index.items) + i
                tried[d, i] = (float(best_cosine[x]) if hit else 0.0, [])
        for (d, i), (cosine_, at_words) in tried.items():
            words = flat[begin[d] * CELL:begin[d] * CELL + count[d]]
            # Up to the end of the answer, by the match's widest spread: nothing of a copy lies outside.
            n = math.ceil(len(index.items[i].words) * SPREAD)
            regions = [(max(0, p - n), p + n) for p in said.get((d, i), ())] + [(max(0, w - width), w + 2 * width) for w in at_words]
            best = None
            for a, b in regions:
                got = index.items[i].matches(words[a:b].tolist())
                if got and (best is None or got > best):
                    best = got
                if best and best[0] == 1.0:
                    break
            if best:
                yield d, i, cosine_, best[0], best[1]


def contaminated(docs: DataFrame, benchmark: DataFrame, rank: int | None = None) -> DataFrame:
    """doc_id, item_id, cosine, lcs, answer: one row for each item that a document holds."""
    built = build_index(docs, benchmark, rank)
    names = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {names[0]}, item_id {names[1]}, cosine double, lcs double, answer boolean"
    if built is None:
        return docs.sparkSession.createDataFrame([], schema)
    given = docs.sparkSession.sparkContext.broadcast(built[0])
    item_type = pa.int64() if names[1] == "bigint" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = given.value
        for b in batches:
            found = [(b.column(0)[lo + d].as_py(), x.items[i].item_id, c, s, a) for lo, ids, count in _lists(b.column(1)) for d, i, c, s, a in search(x, ids, count)]
            if found:
                doc, item, c, s, a = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, b.schema.field(0).type), pa.array(item, item_type), pa.array(c), pa.array(s), pa.array(a)], names=["doc_id", "item_id", "cosine", "lcs", "answer"]
                )

    return built[1].mapInArrow(run, schema)


def clean_documents(docs: DataFrame, benchmark: DataFrame, rank: int | None = None) -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns as they are."""
    built = build_index(docs, benchmark, rank)
    if built is None:
        return docs
    given = docs.sparkSession.sparkContext.broadcast(built[0])
    text_at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = given.value
        for b in batches:
            clean = np.ones(b.num_rows, bool)
            texts = b.column(text_at)
            for lo, hi in _runs(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), BLOCK_WORDS * 8):
                for d, *_ in search(x, *_coded(x.vocabulary.get, texts[lo:hi])):
                    clean[lo + d] = False
            yield b.filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
