"""Best-fit packing of tokenised documents into sequences of a fixed number of tokens (operator 13).

Method: pattern packing by non-negative least squares. Documents become token
ids, and only those longer than a sequence are cut, into full pieces and a
rest. The histogram of the pieces' lengths (at most one row per length) is all
that the fit needs: patterns of two and three lengths that fill a sequence to
the last token are enumerated, repeat counts are fitted to the histogram by
non-negative least squares (coordinate descent; a long piece left over costs
more than a short one), rounded, and what is left of the histogram is packed by
best fit, again as patterns with repeat counts. The plan says which ranks of a
length go to which sequences, so its size depends on the sequence's length and
not on the corpus, and each piece finds its place by its own rank.

Ranks within a length need no sort: a piece is numbered within its task and
length as it is made, and the tasks' counts are added up.

Defined results:

* a null text is an empty one; an empty text has the end id only: one piece of length 1;
* ``doc_id`` is carried as it is: nulls and repeated rows are packed row by row;
* white space outside ASCII is left to the tokenizer, as is a special token's string
  in a text (it becomes the special id, the library's default);
* a text's length is not bounded; its words are encoded once each;
* an empty table gives no rows; further columns are ignored, so no name can clash;
* equal lengths are interchangeable: sequence numbers follow the input's splits.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfscope.llm.common import documents, stage, text_or_empty

SEQUENCE = 2048
#: The id that ends a document.
END_ID = 0
#: Texts are encoded in blocks of about so many bytes, and a task remembers so many words.
BLOCK_BYTES = 4 << 20
WORDS_KEPT = 600_000
#: Stands between words that are encoded in one call; words that hold it are encoded one by one.
MARK, SPACED = b"\x01", b" \x01 "
#: Words that need no Unicode rules (nor hold a special token), what others of ASCII hold, and the parts that the
#: vocabulary's pre-tokenizer cuts from plain words, each of which a space ends: fixed values of word_bpe_49k.json,
#: as is its mark of a word's end.
PLAIN = re.compile(rb"(?!.*<\|)[\x21-\x7e]+").fullmatch
ODD = re.compile(rb"[\x00-\x1f\x7f]|<\|").search
PARTS = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9 ]+| ").findall
WORD_END = "</w>"
#: Three-length patterns tried for a longest length, evenly spread over those that fill a sequence.
TRIPLES = 8
#: Rounds of coordinate descent.
SWEEPS = 25


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Ragged:
    """Lists of ids under growing numbers."""

    def __init__(self):
        self.ids, self.starts, self.sizes = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, ids: np.ndarray, sizes: np.ndarray, order: np.ndarray | None = None) -> None:
        """Append the lists, the i-th of them as the ``order[i]``-th of the new ones."""
        starts = len(self.ids) + np.cumsum(sizes) - sizes
        if order is not None:
            back = np.argsort(order)
            starts, sizes = starts[back], sizes[back]
        self.starts, self.sizes, self.ids = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, sizes]), np.concatenate([self.ids, ids])

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists' ids one after the other, and where each list ends."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[numbers] - (ends - sizes), sizes)
        at += np.arange(len(at))
        return self.ids[at], ends


class Numbers(dict):
    """Keys numbered in the order in which they are first asked for; ``fresh`` are those since it was last emptied."""

    def __init__(self, first: bytes):
        super().__init__({first: 0})
        self.fresh: list[bytes] = []

    def __missing__(self, key: bytes) -> int:
        number = self[key] = len(self)
        self.fresh.append(key)
        return number

    def of(self, keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))


class WordEncoder:
    """Token ids of texts by a tokenizer whose tokens never span white space.

    Each different word is encoded once, and a text's ids are those of its words
    one after the other. A word of printable ASCII is lower-cased and cut as the
    tokenizer's normalizer and pre-tokenizer do, so that words that differ in case
    or punctuation share parts, and its parts go to the vocabulary's model; every
    other word goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.model = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.model.normalizer, self.model.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit()
        (self.mark,) = self.tokenizer.encode(MARK.decode(), add_special_tokens=False).ids
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.forget(True)

    def forget(self, parts: bool) -> None:
        if parts:
            self.parts, self.part_numbers = Ragged(), Numbers(b" ")  # a word's end, without ids
            self.parts.add(np.empty(0, np.uint32), np.zeros(1, np.int64))
        self.words, self.numbers = Ragged(), Numbers(b"")  # no word is empty: this one stands for the document's end
        self.words.add(np.array([END_ID], np.uint32), np.ones(1, np.int64))

    def plain_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words one after the other, and how many each has. All are cut in one go."""
        numbers = self.part_numbers.of(PARTS(b" ".join([*words, b""]).lower()))
        new, self.part_numbers.fresh = self.part_numbers.fresh, []
        made, sizes = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for at in range(0, len(new), 1000):
            (found,) = self.model.encode_batch_fast([b" ".join(new[at:at + 1000]).decode()], add_special_tokens=False)
            made.append(np.array(found.ids, np.uint32))
            sizes.append(np.diff(np.flatnonzero(self.ends[made[-1]]), prepend=-1))
        self.parts.add(np.concatenate(made), np.concatenate(sizes))
        ids, ends = self.parts.take(numbers)
        return ids, np.diff(ends[numbers == 0], prepend=0)

    def learn(self, words: list[bytes]) -> None:
        """The ids of the words that were numbered last."""
        ascii_ = np.fromiter(map(bytes.isascii, words), bool, len(words))
        at = np.flatnonzero(ascii_)
        plain = [words[i] for i in at.tolist()]
        if ODD(b" ".join(plain)):
            kept = np.fromiter((PLAIN(w) is not None for w in plain), bool, len(plain))
            at = at[kept]
            plain = [words[i] for i in at.tolist()]
        made, order = [self.plain_ids(plain)], [at]
        others = np.ones(len(words), bool)
        others[at] = False
        rest = np.flatnonzero(others).tolist()
        # Between two words stands a mark that is a token of its own; a word that holds it goes alone.
        for many, one_by_one in ((500, False), (1, True)):
            part = [i for i in rest if (MARK in words[i]) == one_by_one]
            for first in range(0, len(part), many):
                some = [words[i] for i in part[first:first + many]]
                text = (SPACED.join(some) + (b"" if one_by_one else SPACED)).decode("utf-8", "replace")
                (found,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
                ids = np.array(found.ids, np.uint32)
                ends = np.array([len(ids)]) if one_by_one else np.flatnonzero(ids == self.mark) - np.arange(len(some))
                made.append((ids if one_by_one else ids[ids != self.mark], np.diff(ends, prepend=0)))
            order.append(np.array(part, np.int64))
        self.words.add(np.concatenate([ids for ids, _ in made]), np.concatenate([sizes for _, sizes in made]), np.concatenate(order))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids, each text ended by the end id, and the number of ids of each text."""
        if len(self.numbers) > WORDS_KEPT:
            self.forget(len(self.part_numbers) > WORDS_KEPT)
        words, last = [], []
        for t in texts:
            words += t.split()
            last.append(len(words))
            words.append(b"")
        try:
            numbers = self.numbers.of(words)
            if self.numbers.fresh:
                new, self.numbers.fresh = self.numbers.fresh, []
                self.learn(new)
        except BaseException:
            self.forget(True)  # the worker's next task must not find numbers without ids
            raise
        ids, ends = self.words.take(numbers)
        return ids, np.diff(ends[last], prepend=0)


_ENCODERS: dict[str, WordEncoder] = {}


def encoder_of(path: str) -> WordEncoder:
    """One encoder for a Python worker: what a task has learned serves the worker's next task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def numbered(lengths: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The number of each element among those of its length, after ``seen`` (by length), which is brought up to date."""
    order = np.argsort(lengths, kind="stable")
    found, first, counts = np.unique(lengths[order], return_index=True, return_counts=True)
    out = np.empty(len(lengths), np.int64)
    out[order] = np.arange(len(lengths)) - np.repeat(first, counts) + np.repeat(seen[found], counts)
    seen[found] += counts
    return out


def pieces(docs: DataFrame, sequence: int = SEQUENCE, vocabulary: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit), ids_crc32, and the
    piece's task and its number among the task's pieces of its length."""
    path = vocabulary or default_vocabulary()
    rows = docs.select("doc_id", text_or_empty().cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def blocks(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            texts, at, size = b.column(1).to_pylist(), 0, 0
            for i, t in enumerate(texts):
                size += len(t)
                if size >= BLOCK_BYTES or i + 1 == len(texts):
                    yield b.column(0).slice(at, i + 1 - at), texts[at:i + 1]
                    at, size = i + 1, 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen = encoder_of(path), np.zeros(sequence + 1, np.int64)
        task = TaskContext.get().partitionId()
        for names, texts in blocks(batches):
            ids, sizes = encoder.encode(texts)
            n = -(-sizes // sequence)
            doc = np.repeat(np.arange(len(sizes)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * sequence
            length = np.minimum(sequence, sizes[doc] - start)
            ends = np.cumsum(length) * 4
            data = ids.astype("<u4").tobytes()
            offsets = np.concatenate([[0], ends])
            view = memoryview(data)
            crc = [zlib.crc32(view[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays([
                names.take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length, pa.int32()),
                pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data)]),
                pa.array(crc, pa.int64()), pa.array(np.full(len(doc), task), pa.int32()), pa.array(numbered(length, seen)),
            ], ["doc_id", "piece", "start", "length", "ids", "ids_crc32", "task", "number"])

    return rows.mapInArrow(run, f"doc_id {kind}, piece int, start long, length int, ids binary, ids_crc32 long, task int, number long")


def patterns(counts: np.ndarray, triples: int = TRIPLES) -> list[tuple[int, ...]]:
    """Two and three lengths of ``counts`` (pieces by length) whose sum is the sequence's length, longest first."""
    sequence = len(counts) - 1
    have = counts > 0
    out: list[tuple[int, ...]] = []
    for a in np.flatnonzero(have[:sequence])[::-1].tolist():
        rest = sequence - a
        if rest <= a and have[rest]:
            out.append((a, rest))
        low = max(-(-rest // 2), 1)
        b = np.arange(low, min(a, rest - 1) + 1)
        b = b[have[b] & have[rest - b]] if len(b) else b
        if len(b) > triples:
            b = b[np.linspace(0, len(b) - 1, triples).astype(int)]
        out += [(a, x, rest - x) for x in b.tolist()]
    return out


def fit(counts: np.ndarray, found: list[tuple[int, ...]], sweeps: int = SWEEPS) -> list[float]:
    """Repeat counts x >= 0 of the patterns that minimise the weighted squares of what they leave of the histogram.

    Coordinate descent on sum over lengths of length * (count - used)^2.
    """
    left = counts.astype(float).tolist()
    x = [0.0] * len(found)
    weight = [sum(p.count(v) * v for v in p) for p in found]  # sum of multiplicity^2 * length over different lengths
    for _ in range(sweeps):
        moved = 0.0
        for i, p in enumerate(found):
            step = max(-x[i], sum(v * left[v] for v in p) / weight[i])
            if step:
                x[i] += step
                moved = max(moved, abs(step))
                for v in p:
                    left[v] -= step
        if moved < 0.01:
            break
    return x


def best_fit(left: np.ndarray, repeats) -> None:
    """Pack what ``left`` (pieces by length) holds: ``repeats(pattern, times)`` for each filled sequence's lengths.

    The longest length left is filled up by one or two that fill it exactly, or else
    by the longest that fits, and the pattern is repeated while its lengths last:
    as many steps as there are lengths, whatever the number of pieces.
    """
    sequence = len(left) - 1
    top = sequence
    while True:
        while top and not left[top]:
            top -= 1
        if not top:
            return
        used = {top: 1}
        room = sequence - top
        free = left.copy()
        free[top] -= 1
        while room:
            if free[room] > 0:
                take, times = room, 1
            else:
                fits = np.flatnonzero(free[1:room + 1] > 0) + 1
                if not len(fits):
                    break
                two = fits[(free[room - fits] > 0) & ((2 * fits != room) | (free[fits] > 1))] if len(fits) > 1 or 2 * fits[0] == room else fits[:0]
                take = int(two[-1] if len(two) else fits[-1])
                times = 1 if len(two) else min(room // take, int(free[take]))
            used[take] = used.get(take, 0) + times
            free[take] -= times
            room -= take * times
        n = min(int(left[v]) // m for v, m in used.items())
        for v, m in used.items():
            left[v] -= n * m
        repeats(used, n)


def packing_plan(counts: np.ndarray) -> np.ndarray:
    """Rows (length, first rank, ranks, times, first sequence, offset), sorted: rank first + i of a length, i < ranks,
    goes to sequence first sequence + i mod times at offset + (i div times) * length."""
    left = counts.astype(np.int64).copy()
    taken = np.zeros_like(left)
    rows, sequences = [], 0

    def repeats(used: dict[int, int], n: int) -> None:
        nonlocal sequences
        offset = 0
        for v, m in used.items():
            rows.append((v, int(taken[v]), n * m, n, sequences, offset))
            taken[v] += n * m
            offset += v * m
        sequences += n

    full = len(left) - 1
    if left[full]:
        n = int(left[full])
        left[full] = 0
        repeats({full: 1}, n)
    found = patterns(left)
    x = fit(left, found)
    for i in sorted(range(len(found)), key=lambda i: -x[i]):
        if x[i] < 0.5:
            break
        used = {v: found[i].count(v) for v in found[i]}
        n = min([int(x[i] + 0.5), *(int(left[v]) // m for v, m in used.items())])
        if n:
            for v, m in used.items():
                left[v] -= n * m
            repeats(used, n)
    best_fit(left, repeats)
    return np.array(sorted(rows), np.int64).reshape(-1, 6)


def place(made: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """The pieces (a written table) without their ids, with sequence_id and offset."""
    counts = stage(made.groupBy("length", "task").agg((F.max("number") + 1).alias("n")), "pack-counts")
    histogram = np.zeros(sequence + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most a row per length
        histogram[r["length"]] = r["n"]
    plan = packing_plan(histogram)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # The plan's size is bounded by the sequence's length.
    shared = made.sparkSession.sparkContext.broadcast(plan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, _, times, base, offset = shared.value.T
        keys = (length << 50) + first
        for b in batches:
            v, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = np.searchsorted(keys, (v.astype(np.int64) << 50) + rank, "right") - 1
            i = rank - first[at]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(base[at] + i % times[at]), pa.array(offset[at] + i // times[at] * v)],
                [*b.schema.names[:-1], "sequence_id", "offset"])

    rows = made.drop("ids").join(ranks, ["length", "task"])
    rows = rows.select(*made.drop("ids").columns, (F.col("before") + F.col("number")).alias("rank"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def sequences(made: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, n_tokens, ids (bytes as in ``pieces``), and its parts (doc_id, piece, offset, length)."""
    key = ["task", "length", "number"]
    parts = placed.join(made.select(*key, "ids"), key)
    held = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    rows = parts.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), held.alias("p"))
    ids = F.expr("unhex(array_join(transform(p, x -> hex(x.ids)), ''))")
    return rows.select("sequence_id", "n_tokens", ids.alias("ids"),
                       F.transform("p", lambda x: F.struct(x["doc_id"].alias("doc_id"), x["piece"].alias("piece"), x["offset"].alias("offset"), x["length"].alias("length"))).alias("parts"))


def pack(docs: DataFrame, sequence: int = SEQUENCE, vocabulary: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(pieces with their ids, the pieces' places); ``sequences`` puts them together."""
    made = stage(pieces(docs, sequence, vocabulary), "pack-pieces")
    return made, place(made, sequence)


def query(spark, sf_dir: str) -> DataFrame:
    _, placed = pack(documents(spark, sf_dir))
    return placed.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")
