"""Language-model scores from a subword lattice.

The pieces of an existing public vocabulary weigh every segmentation of a word;
a forward recursion in log space sums them all, so a word's probability is the
marginal over its segmentations. Piece scores start from the vocabulary's own
(score -r becomes a weight 1/(1+r)) and are refitted by expectation
maximisation on the different words of the training documents.

A word seen in training also has an edge of its own over the whole lattice:
P(word) = max(c - d, 0) / N + (d V / N) * P_lattice(word), with absolute
discount d; the end of a text is one more known token. P sums to one over all
texts. Texts are independent draws of their tokens.

Defined results
---------------
* null, empty or blank text: one token, the end.
* null doc_id: hashed as the empty text, so such rows train.
* repeated rows: each counts and is scored. Empty table: empty result.
* letters that no piece covers fall back to byte pieces; nothing is unscorable.
* other columns, whatever their names, are ignored.

Scale
-----
The text is read once. Each task cuts its documents into chunks (by dictionary
size) and writes, per chunk, its dictionary with training counts and, per
document, positions in that dictionary. Counts are summed over dictionaries, so
a word of every document is one row a chunk. The lattice is run once for each
different word. Values travel back to the chunks by a join on the word and a
cogroup on the chunk. Only the piece counts (as many as the vocabulary has) and
one row of totals reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscope.llm.common import documents, stage, text_or_empty

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MODULUS, HELD_OUT = 7, 2
DISCOUNT = 0.7
EM_ROUNDS = 2
#: Added to every expected piece count.
PIECE_PRIOR = 0.1
#: Different words after which a chunk is closed.
CHUNK_WORDS = 500_000
#: Bytes beyond which a word's lattice is run alone.
LONG_WORD = 192

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1


def read_vocabulary(path: str = VOCABULARY) -> tuple[list[bytes], np.ndarray]:
    """Pieces as bytes, every single byte included, and their starting log weights."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    found: dict[bytes, float] = {}
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            continue
        piece = sp.id_to_piece(i)
        raw = bytes([int(piece[3:5], 16)]) if sp.is_byte(i) else piece.encode()
        found[raw] = max(found.get(raw, -np.inf), -np.log1p(-min(sp.get_score(i), 0.0)))
    for b in range(256):
        found.setdefault(bytes([b]), -np.log1p(len(found)))
    lp = np.fromiter(found.values(), float, len(found))
    return list(found), lp - np.logaddexp.reduce(lp)


class Lattice:
    """Forward and backward recursions over many words at once.

    Words are byte strings of equal length in a block. From each start, the spans
    that still begin a piece are grown byte by byte; they are looked up by a
    polynomial hash in a direct-address table, confirmed by the full 64 bits.
    """

    START = "▁".encode()

    def __init__(self, pieces: list[bytes], log_weights: np.ndarray):
        self.pieces = {p: i for i, p in enumerate(pieces)}
        self.lp = np.asarray(log_weights, float)
        self.longest = max(map(len, pieces))
        prefixes = list(dict.fromkeys(p[:n] for p in pieces for n in range(1, len(p) + 1)))
        # The piece that each prefix is, -1 if it only begins one; the last entry stands for "no prefix".
        self.piece = np.array([self.pieces.get(p, -1) for p in prefixes] + [-1], np.int32)
        h = np.zeros(len(prefixes) + 1, np.uint64)
        for i, p in enumerate(prefixes):
            x = 0
            for b in p:
                x = (x * _MULTIPLIER + b + 1) & 0xFFFFFFFFFFFFFFFF
            h[i] = x
        self.hash, none = h, len(prefixes)
        slot = self._slot(h[:-1])
        # Two tables hold up to two prefixes a slot; the few beyond go to a dictionary.
        self.tables = [np.full(1 << 20, none, np.int32) for _ in range(2)]
        self.none, self.more = none, {}
        for i, s in enumerate(slot.tolist()):
            for t in self.tables:
                if t[s] == none:
                    t[s] = i
                    break
            else:
                self.more[int(h[i])] = i

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return ((h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(44)).astype(np.int64)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Prefix of each hash, ``none`` where there is none."""
        slot = self._slot(h)
        out = self.tables[0][slot]
        miss = np.flatnonzero(self.hash[out] != h)
        if len(miss):
            second = self.tables[1][slot[miss]]
            out[miss] = np.where(self.hash[second] == h[miss], second, self.none)
        for key, i in self.more.items():
            out[h == np.uint64(key)] = i
        return out

    def _edges(self, words: list[bytes], width: int):
        """(start, end, rows, pieces) of all edges, starts ascending; words have the same length ``width``."""
        m = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), width).T.astype(np.uint64) + np.uint64(1)
        base = np.uint64(_MULTIPLIER)
        for i in range(width):
            alive, h = np.arange(len(words)), np.zeros(len(words), np.uint64)
            for j in range(i + 1, min(width, i + self.longest) + 1):
                h = h * base + m[j - 1, alive]
                got = self._find(h)
                ok = got != self.none
                if not ok.all():
                    alive, h, got = alive[ok], h[ok], got[ok]
                if not len(alive):
                    break
                piece = self.piece[got]
                is_piece = np.flatnonzero(piece >= 0)
                if len(is_piece):
                    yield i, j, alive[is_piece], piece[is_piece]

    def _groups(self, words: list[bytes], cells: int = 400_000):
        """Indices of words of equal length, in blocks of bounded size."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lengths, kind="stable")
        at = 0
        while at < len(order):
            width = int(lengths[order[at]])
            end = int(np.searchsorted(lengths[order], width, "right"))
            step = max(1, cells // width)
            for lo in range(at, end, step):
                yield order[lo:min(end, lo + step)], width
            at = end

    def log_probability(self, words: list[bytes], counts: np.ndarray | None = None, weights: np.ndarray | None = None) -> np.ndarray:
        """Natural log of each word's marginal probability; adds expected piece counts to ``counts`` if given."""
        words = [self.START + w for w in words]
        out = np.empty(len(words))
        for rows, width in self._groups(words):
            if width > LONG_WORD:
                for r in rows:
                    out[r] = self._one(words[r], counts, 1.0 if weights is None else weights[r])
                continue
            block = [words[r] for r in rows]
            edges = list(self._edges(block, width))
            a = np.full((width + 1, len(block)), -np.inf)
            a[0] = 0.0
            # Starts ascend, so a[i] is complete before an edge leaves from it.
            for i, j, at, piece in edges:
                a[j, at] = np.logaddexp(a[j, at], a[i, at] + self.lp[piece])
            out[rows] = a[width]
            if counts is not None:
                b = np.full((width + 1, len(block)), -np.inf)
                b[width] = 0.0
                w = np.ones(len(block)) if weights is None else weights[rows]
                for i, j, at, piece in reversed(edges):
                    through = self.lp[piece] + b[j, at]
                    b[i, at] = np.logaddexp(b[i, at], through)
                    counts += np.bincount(piece, w[at] * np.exp(a[i, at] + through - a[width, at]), len(counts))
        return out

    def _one(self, word: bytes, counts: np.ndarray | None, weight: float) -> float:
        n = len(word)
        a, edges = [-np.inf] * (n + 1), []
        a[0] = 0.0
        for j in range(1, n + 1):
            into = [(i, self.pieces[p]) for i in range(max(0, j - self.longest), j) if (p := word[i:j]) in self.pieces]
            terms = np.array([a[i] + self.lp[p] for i, p in into])
            top = terms.max()
            a[j] = float(top + np.log(np.exp(terms - top).sum()))
            edges.append(into)
        if counts is not None:
            b = [-np.inf] * (n + 1)
            b[n] = 0.0
            for j in range(n, 0, -1):
                for i, p in edges[j - 1]:
                    through = self.lp[p] + b[j]
                    b[i] = float(np.logaddexp(b[i], through))
                    counts[p] += weight * np.exp(a[i] + through - a[n])
        return a[n]


@lru_cache(maxsize=4)
def _vocabulary(path: str):
    return read_vocabulary(path)


def _pack(values: np.ndarray) -> bytes:
    """Small non-negative integers in as few bytes each as the largest needs; the first byte tells how many."""
    top = int(values.max(initial=0))
    kind = np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32
    return bytes([np.dtype(kind).itemsize]) + values.astype(kind).tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"u{raw[0]}", offset=1).astype(np.int64)


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def chunk_table(docs: DataFrame, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """Rows of two kinds: a chunk's dictionary (word, idx, n_train) and its documents (gaps of positions, and counts, packed)."""
    text = F.col("text").cast("string")
    held = F.crc32(F.encode(text_or_empty("doc_id"), "utf-8")) % MODULUS == HELD_OUT
    rows = docs.select("doc_id", held.alias("held_out"), text.alias("text"))
    kind = rows.schema["doc_id"].dataType
    schema = f"chunk long, doc_id {kind.simpleString()}, held_out boolean, n_tokens long, ids binary, tfs binary, idx int, word string, n_train long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 24
        seen: dict[bytes, int] = {}
        train: list[int] = []
        out: list[tuple] = []
        id_type = None

        def flush():
            nonlocal chunk, seen, train, out
            if out:
                ids, held_out, n, at, tf = zip(*out)
                k = len(out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(k, chunk)), pa.array(ids, id_type), pa.array(held_out), pa.array(n, pa.int64()), pa.array(at, pa.binary()), pa.array(tf, pa.binary()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.string()), pa.nulls(k, pa.int64())],
                    names=["chunk", "doc_id", "held_out", "n_tokens", "ids", "tfs", "idx", "word", "n_train"],
                )
                words = list(seen)
                for lo in range(0, len(words), 50_000):
                    part = words[lo:lo + 50_000]
                    k = len(part)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(k, chunk)), pa.nulls(k, id_type), pa.nulls(k, pa.bool_()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary()), pa.array(np.arange(lo, lo + k, dtype=np.int32)), pa.array(part, pa.binary()).cast(pa.string()), pa.array(train[lo:lo + k], pa.int64())],
                        names=["chunk", "doc_id", "held_out", "n_tokens", "ids", "tfs", "idx", "word", "n_train"],
                    )
            chunk, seen, train, out = chunk + 1, {}, [], []

        for b in batches:
            id_type = b.schema.field(0).type
            for i in range(b.num_rows):
                words = _words(b.column(2)[i].as_py())
                is_held = b.column(1)[i].as_py()
                own = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int32, len(words))
                train.extend([0] * (len(seen) - len(train)))
                ids, tf = np.unique(own, return_counts=True)
                if not is_held:
                    for x, c in zip(ids.tolist(), tf.tolist()):
                        train[x] += c
                out.append((b.column(0)[i].as_py(), is_held, len(words) + 1, _pack(np.diff(ids, prepend=0)), _pack(tf)))
                if len(seen) >= chunk_words:
                    yield from flush()
        yield from flush()

    return rows.mapInArrow(run, schema)


def fit_pieces(words: DataFrame, vocabulary: str = VOCABULARY, rounds: int = EM_ROUNDS) -> np.ndarray:
    """Log weights of the vocabulary's pieces after EM over ``words`` (column word, distinct)."""
    pieces, lp = _vocabulary(vocabulary)
    spark = words.sparkSession
    for _ in range(rounds):
        given = spark.sparkContext.broadcast(lp)

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lattice = Lattice(_vocabulary(vocabulary)[0], given.value)
            counts = np.zeros(len(given.value))
            for b in batches:
                lattice.log_probability(b.column(0).cast(pa.binary()).to_pylist(), counts)
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["piece", "n"])

        got = words.select("word").mapInArrow(expect, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).toPandas()
        counts = np.full(len(pieces), PIECE_PRIOR)
        counts[got["piece"].to_numpy(dtype=np.int64)] += got["n"].to_numpy(dtype=float)
        # Sums over tasks arrive in any order: rounding makes reruns agree.
        counts = np.round(counts, 6)
        lp = np.log(counts) - np.log(counts.sum())
        given.unpersist()
    return lp


def lattice_scores(words: DataFrame, lp: np.ndarray, vocabulary: str = VOCABULARY) -> DataFrame:
    """``words`` (word, c) with ``lattice``, the natural log of the marginal probability."""
    given = words.sparkSession.sparkContext.broadcast(lp)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(_vocabulary(vocabulary)[0], given.value)
        for b in batches:
            got = lattice.log_probability(b.column(0).cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got)], names=["word", "c", "lattice"])

    return words.select("word", "c").mapInArrow(run, "word string, c long, lattice double")


def score(docs: DataFrame, vocabulary: str = VOCABULARY, discount: float = DISCOUNT, rounds: int = EM_ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10) for every row."""
    table = stage(chunk_table(docs), "lm-chunks")
    texts = table.where("word is null")
    entries = table.where("word is not null").select("word", "chunk", "idx", "n_train")
    ends = texts.where("not held_out").count()
    counts = stage(entries.groupBy("word").agg(F.sum("n_train").alias("c")), "lm-counts")
    n, v = counts.where("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("c")).first()
    n, v = int(n) + ends, int(v) + (ends > 0)
    lp = fit_pieces(counts.where("c > 0"), vocabulary, rounds)
    scored = stage(lattice_scores(counts, lp, vocabulary), "lm-words")
    values = entries.select("word", "chunk", "idx").join(scored, "word").select("chunk", "idx", "c", "lattice")

    def terms(c: np.ndarray, lattice: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base = np.log10((c + 1) / (n + v + 1))
        if not n:
            return base, lattice / np.log(10)
        whole = np.log(np.maximum(c - discount, 1e-300) / n)
        whole[c == 0] = -np.inf
        return base, np.logaddexp(whole, np.log(discount * v / n) + lattice) / np.log(10)

    kind = table.schema["doc_id"].dataType.simpleString()

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        c = np.zeros(len(right), np.int64)
        c[right["idx"]] = right["c"]
        lattice = np.zeros(len(right))
        lattice[right["idx"]] = right["lattice"]
        base, full = terms(c, lattice)
        end_c = np.array([ends])
        end_base = np.log10((ends + 1) / (n + v + 1))
        end = np.log10(max(ends - discount, 1e-300) / n) if n and ends else 0.0
        known, bases, scores = [], [], []
        for ids, tfs in zip(left["ids"], left["tfs"]):
            at, tf = np.cumsum(_unpack(ids)), _unpack(tfs)
            known.append(int(tf[c[at] > 0].sum()) + int(end_c[0] > 0))
            bases.append(float((tf * base[at]).sum() + end_base))
            scores.append(float((tf * full[at]).sum() + end))
        return pd.DataFrame({
            "doc_id": left["doc_id"], "held_out": left["held_out"], "n_tokens": left["n_tokens"], "n_known": known,
            "train_tokens": n, "base_score": bases, "score": scores,
        })

    # Renamed: both sides come from the chunk table, and a cogroup needs them told apart.
    values = values.withColumnRenamed("chunk", "value_chunk")
    schema = "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    # The id travels as a string: a null among 64-bit ids would turn them into doubles in pandas.
    scored_texts = (
        texts.select("chunk", F.col("doc_id").cast("string").alias("doc_id"), "held_out", "n_tokens", "ids", "tfs").groupBy("chunk")
        .cogroup(values.groupBy("value_chunk")).applyInPandas(run, schema)
    )
    return scored_texts.withColumn("doc_id", F.col("doc_id").cast(kind))


def query(spark, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir))


ORACLE = None
