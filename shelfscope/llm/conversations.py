"""Conversation structure repair by a grammar-compressed min-plus recursion (operator 12).

A repaired conversation is an optional system row and then any number of
user/assistant pairs, as role initials ``(s?(ua)+)?``. Each row is kept, gets
another role or goes, rows without text may come in, and the cheapest edits are
wanted, of equal ones those whose initials (D, I, K, R) come first in ASCII.

Method. A row is one of 16 symbols: its role's initial (s, u, a, other) and its first
fault (none, blank, duplicate, truncated). Conversations in the order of their turns
are cut into segments of at most 1,024 rows, and a segment is a string of symbols;
equal strings, most of them, are treated once for all conversations. Re-Pair rounds
replace the most frequent pairs of neighbouring symbols, counted over all strings,
by new symbols, so that rules are shared across conversations. A symbol's 4 x 4
matrix over the automaton's states (nothing yet, s, u, a) holds for each pair of
states the cheapest cost and its edits as a rope; a rule's matrix is the min-plus
product of its two symbols' matrices, made bottom-up, and a string's matrix is the
product over what the rules leave of it. Segments of a conversation are folded from
left to right, and the chosen edits go back to their rows.

Two strings of edits of one segment at equal cost are never prefixes of one another
(both hold one letter for each row, and inserts cost), so the least string of a
product is made of least strings.

Scale. Rows are range-sorted by conversation and turn, so a conversation of any
length is spread over partitions; what meets in one task is a row per 1,024 rows, the
edits' string (one byte a row and state: the result's own column) and, since SHA-256
is sequential, the conversation's text as a stream of segments that is never held
whole. Conversations of one segment need neither.

Defined results:

* nulls of role and text, and of conv_id and turn in the damage's key, are one space;
  a null conv_id is a conversation; null turns come first;
* rows of one turn go by role, SHA-256 of the text and input order; a repeat follows its row;
* equal texts are found by SHA-256;
* an empty text is blank; a text of any length is kept whole;
* a conversation without rows after damage has zeros, an empty audit and the hash of the empty string;
* an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscope.llm.common import stage

#: A segment closes at so many rows or characters of text.
SEGMENT_ROWS, SEGMENT_CHARS = 1024, 4 << 20
#: Rounds of Re-Pair, and rules that a round makes at most.
ROUNDS, PAIRS = 6, 8
#: Costs of the edits; a truncated row that stays adds one.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
STATES = range(4)  # nothing yet, after s, after u, after a
ENDS = (0, 3)
#: The states from which a role's initial may come, and the state after it.
MOVES = {"s": ((0,), 1), "u": ((0, 1, 3), 2), "a": ((2,), 3)}
OK, BLANK, DUPLICATE, CUT = range(4)
FIRST_SYMBOL, FIRST_RULE = ord("A"), 0x100
ROLE_CLASSES = "sua"

ROWS = "conv_id {kind}, part long, seg long, n_rows long, symbols string, blank long, duplicate long, truncated long, illegal long, " \
       "first_turn long, last_turn long, turns long, first_role string, last_role string"


# ---- rows -------------------------------------------------------------------------------


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, place (input order), copy: the rows after damage by the checksum of ``conv_id:turn``."""
    def spaced(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    base = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), spaced("role").alias("role"), spaced("text").alias("text"),
                       F.monotonically_increasing_id().alias("place"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return base.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), "place",
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def segments(damaged: DataFrame) -> DataFrame:
    """The conversations in order, cut into segments (a written table): symbols, counts and the rows themselves."""
    rows = damaged.withColumn("digest", F.sha2("text", 256))
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "place", "copy")
    same = ["conv_id", "role", "digest"]
    # Written first: its size is known when Spark chooses the join.
    again = stage(rows.groupBy(*same).agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "talk-repeats")
    hit = F.col("r.conv_id").eqNullSafe(F.col("a.conv_id")) & (F.col("r.role") == F.col("a.role")) & (F.col("r.digest") == F.col("a.digest"))
    rows = rows.withColumn("own", order).alias("r").join(again.alias("a"), hit, "left")
    bare = F.regexp_replace("text", r"[\x20\x09-\x0D]+\z", "")
    fault = (F.when(bare == "", F.lit(BLANK)).when(F.coalesce(F.col("own") > F.col("first"), F.lit(False)), F.lit(DUPLICATE))
             .when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), F.lit(CUT)).otherwise(F.lit(OK)))
    rows = rows.select("r.conv_id", "turn", "r.role", "text", "r.digest", "place", "copy", fault.alias("fault"))
    sort = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "digest", "place", "copy"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, *sort).sortWithinPartitions(*sort).drop("digest", "place", "copy")
    kind = rows.schema["conv_id"].dataType.simpleString()
    fields = ROWS.format(kind=kind).split(", ") + ["roles array<string>", "texts array<string>"]
    names = [f.split(" ")[0] for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seg = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        size = 0
        for b in batches:
            out = []
            for row in zip(*[c.to_pylist() for c in b.columns]):
                if held and (row[0] != held[0][0] or len(held) >= SEGMENT_ROWS or size >= SEGMENT_CHARS):
                    out.append(_segment(part, seg, held))
                    seg, held, size = seg + 1, [], 0
                held.append(row)
                size += len(row[3])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, t in zip(zip(*out), _types(b.schema.field(0).type))], names)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(_segment(part, seg, held), _types(b.schema.field(0).type))], names)

    return stage(rows.mapInArrow(run, ", ".join(fields)), "talk-segments")


def _types(conv: pa.DataType) -> list[pa.DataType]:
    n, s = pa.int64(), pa.string()
    return [conv, n, n, n, s, n, n, n, n, n, n, n, s, s, pa.list_(s), pa.list_(s)]


def _segment(part: int, seg: int, rows: list[tuple]) -> tuple:
    conv, turns, roles, texts, faults = rows[0][0], *[[r[i] for r in rows] for i in range(1, 5)]
    initials = [r[:1] for r in roles]
    known = [t for t in turns if t is not None]
    symbols = "".join(chr(FIRST_SYMBOL + 4 * (ROLE_CLASSES.find(c) if c else 3) % 16 + f) for c, f in zip(initials, faults))
    return (conv, part, seg, len(rows), symbols, faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT),
            sum(map(illegal, initials, initials[1:])), known[0] if known else None, known[-1] if known else None, len(set(known)),
            initials[0], initials[-1], roles, texts)


def illegal(first: str, then: str) -> bool:
    return first + then not in ("su", "ua", "au")


# ---- matrices ---------------------------------------------------------------------------


class Rope:
    """A string of edits that is put together only where two of equal cost are compared or the result is wanted."""

    __slots__ = ("left", "right", "flat")

    def __init__(self, left: "Rope | None" = None, right: "Rope | None" = None, flat: str | None = None):
        self.left, self.right, self.flat = left, right, flat

    def text(self) -> str:
        if self.flat is None:
            out, todo = [], [self]
            while todo:
                x = todo.pop()
                if x.flat is None:
                    todo += [x.right, x.left]
                else:
                    out.append(x.flat)
            self.flat, self.left, self.right = "".join(out), None, None
        return self.flat


Cell = tuple  # (cost, Rope)
Matrix = list  # Matrix[from state][to state]: Cell or None


def least(a: Cell | None, b: Cell | None) -> Cell | None:
    if a is None or b is None:
        return a or b
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return a if a[1].text() <= b[1].text() else b


def product(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product: ropes are joined only for the cheapest way, all of them where several cost the same."""
    out = []
    for row in a:
        line = []
        for r in STATES:
            ways = [(row[q][0] + b[q][r][0], q) for q in STATES if row[q] and b[q][r]]
            best = min(ways, default=(None, None))[0]
            cell = None
            for cost, q in ways:
                if cost == best:
                    cell = least(cell, (cost, Rope(row[q][1], b[q][r][1])))
            line.append(cell)
        out.append(line)
    return out


def inserts() -> Matrix:
    """Any number of inserted rows: never more than two, a third would come back to a state it has left."""
    out: Matrix = [[(0, Rope(flat="")) if p == q else None for q in STATES] for p in STATES]
    for _ in range(2):
        for p in STATES:
            for role in "ua":
                before, after = MOVES[role]
                for q in before:
                    if out[p][q]:
                        out[p][after] = least(out[p][after], (out[p][q][0] + INSERT, Rope(out[p][q][1], Rope(flat="I"))))
    return out


def terminal(role: str, fault: int) -> Matrix:
    """A row's edits, after any inserts before it."""
    out: Matrix = [[(DELETE, Rope(flat="D")) if p == q else None for q in STATES] for p in STATES]
    if fault in (OK, CUT):
        extra = TRUNCATED if fault == CUT else 0
        for new in "ua":
            for q in MOVES[new][0]:
                out[q][MOVES[new][1]] = least(out[q][MOVES[new][1]], (REROLE + extra, Rope(flat="R")))
        if role in MOVES:
            for q in MOVES[role][0]:
                out[q][MOVES[role][1]] = least(out[q][MOVES[role][1]], (extra, Rope(flat="K")))
    return product(inserts(), out)


def matrices(rules: list[str]) -> dict[str, Matrix]:
    """The matrix of every symbol: terminals first, then the rules in the order they were made."""
    out = {chr(FIRST_SYMBOL + 4 * c + f): terminal((ROLE_CLASSES + "?")[c], f) for c in range(4) for f in range(4)}
    for i, pair in enumerate(rules):
        out[chr(FIRST_RULE + i)] = product(out[pair[0]], out[pair[1]])
    return out


def grammar(strings: DataFrame, rounds: int = ROUNDS, pairs: int = PAIRS) -> tuple[list[str], DataFrame]:
    """Re-Pair over all strings (symbols, n): the rules' pairs, and the strings with ``short``, what the rules leave of them.

    A round takes the most frequent pairs that cannot overlap one another. Rules
    are at most ``rounds * pairs``, whatever the input.
    """
    rules: list[str] = []
    work = strings.withColumn("short", F.col("symbols"))
    for _ in range(rounds):
        two = F.expr("transform(sequence(1, length(short) - 1), i -> substring(short, i, 2))")
        found = work.where("length(short) > 1").select("n", F.explode(two).alias("pair")).groupBy("pair").agg(F.sum("n").alias("n"))
        chosen: list[str] = []
        for r in found.where("n > 1").orderBy(F.desc("n"), "pair").limit(4 * pairs).collect():
            p = r["pair"]
            if len(chosen) < pairs and p[0] != p[1] and all(p[0] != c[1] and p[1] != c[0] for c in chosen) or not chosen:
                chosen.append(p)
        if not chosen:
            break
        short = F.col("short")
        for p in chosen:
            short = F.replace(short, F.lit(p), F.lit(chr(FIRST_RULE + len(rules))))
            rules.append(p)
        work = work.withColumn("short", short)
    return rules, work


def string_matrix(short: str, known: dict[str, Matrix]) -> Matrix:
    out = known[short[0]]
    for c in short[1:]:
        out = product(out, known[c])
    return out


CELLS = "array<struct<cost:long,edits:string>>"


def evaluated(strings: DataFrame, rules: list[str]) -> DataFrame:
    """symbols, cells: each string's matrix, row by row (a null cost where there is no way)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = matrices(rules)
        kind = pa.list_(pa.struct([("cost", pa.int64()), ("edits", pa.string())]))
        for b in batches:
            cells = []
            for short in b.column(1).to_pylist():
                m = string_matrix(short, known)
                cells.append([{"cost": c[0], "edits": c[1].text()} if c else {"cost": None, "edits": None} for row in m for c in row])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cells, kind)], ["symbols", "cells"])

    return strings.select("symbols", "short").mapInArrow(run, f"symbols string, cells {CELLS}")


# ---- conversations ----------------------------------------------------------------------

SUMMARY = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def fold(held: list[dict]) -> list[dict]:
    """The segments of one conversation, in order: each one's edits and first state, and the summary with the last."""
    ways: list[Cell | None] = [(0, Rope(flat="")), None, None, None]
    came: list[list[int]] = []
    for s in held:
        cells = [[(c["cost"], Rope(flat=c["edits"])) if c["cost"] is not None else None for c in s["cells"][4 * p:4 * p + 4]] for p in STATES]
        new, back = [], []
        for r in STATES:
            best = None
            for q in STATES:
                if ways[q] and cells[q][r]:
                    way = (ways[q][0] + cells[q][r][0], Rope(ways[q][1], cells[q][r][1]))
                    if best is None or least(best[0], way) is way:
                        best = way, q
            new.append(best and best[0])
            back.append(best[1] if best else -1)
        ways = new
        came.append(back)
    tail = inserts()
    ends = [((ways[q][0] + tail[q][e][0], Rope(ways[q][1], tail[q][e][1])), q, tail[q][e][1].text()) for q in STATES for e in ENDS if ways[q] and tail[q][e]]
    (cost, whole), state, last = ends[0]
    for way, q, t in ends[1:]:
        if least((cost, whole), way) is way:
            (cost, whole), state, last = way, q, t
    out = []
    for s, back in zip(reversed(held), reversed(came)):
        before = back[state]
        edits = s["cells"][4 * before + state]["edits"]
        out.append({"conv_id": s["conv_id"], "part": s["part"], "seg": s["seg"], "state": before, "edits": edits + (last if not out else ""),
                    "n_segments": len(held), "audit": None, **dict.fromkeys(SUMMARY)})
        state = before
    out.reverse()
    turns = [(s["first_turn"], s["last_turn"], s["turns"]) for s in held if s["turns"]]
    shared = sum(a[1] == b[0] for a, b in zip(turns, turns[1:]))
    gaps = turns[-1][1] - turns[0][0] + 1 - (sum(t[2] for t in turns) - shared) if turns else 0
    crossed = sum(illegal(a["last_role"], b["first_role"]) for a, b in zip(held, held[1:]))
    out[-1] |= {"audit": whole.text(), "gaps": gaps, "cost": cost, "illegal": sum(s["illegal"] for s in held) + crossed,
                **{c: sum(s[c] for s in held) for c in ("blank", "duplicate", "truncated")}}
    return out


def edits_of(cut: DataFrame) -> DataFrame:
    """For each segment (part, seg) its edits and the state before it; with a conversation's last one its summary."""
    strings = stage(cut.groupBy("symbols").agg(F.count(F.lit(1)).alias("n")), "talk-strings")
    rules, work = grammar(strings)
    cells = stage(evaluated(work, rules), "talk-cells")
    rows = cut.drop("roles", "texts").join(cells, "symbols").drop("symbols")
    parts = int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "part", "seg")
    kind = rows.schema["conv_id"].dataType.simpleString()
    fields = f"conv_id {kind}, part long, seg long, state int, edits string, n_segments long, audit string, " + ", ".join(f"{c} long" for c in SUMMARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for b in batches:
            schema = pa.schema([("conv_id", b.schema.field("conv_id").type), ("part", pa.int64()), ("seg", pa.int64()), ("state", pa.int32()), ("edits", pa.string()),
                                ("n_segments", pa.int64()), ("audit", pa.string()), *[(c, pa.int64()) for c in SUMMARY]])
            out = []
            for row in b.to_pylist():
                if held and row["conv_id"] != held[0]["conv_id"]:
                    out += fold(held)
                    held = []
                held.append(row)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if held:
            yield pa.RecordBatch.from_pylist(fold(held), schema)

    return rows.mapInArrow(run, fields)


def repaired_rows(roles: list[str], texts: list[str], edits: str, state: int) -> list[tuple[str, str]]:
    """A segment's rows after its edits, starting in ``state``."""
    out, at = [], 0
    for e in edits:
        if e == "D":
            at += 1
            continue
        if e == "K":
            role = roles[at]
        else:
            role = "assistant" if state == 2 else "user"
        out.append((role, "" if e == "I" else texts[at]))
        at += e != "I"
        state = MOVES[role[0]][1]
    return out


def repair(rows: DataFrame) -> DataFrame:
    """The repaired conversations by segment: conv_id, part, seg, messages (role, text), edits, n_segments, and
    with a conversation's last segment its audit and summary. A conversation without rows after damage has none."""
    cut = segments(damage(rows))
    found = edits_of(cut)
    joined = found.join(cut.select("part", "seg", "roles", "texts"), ["part", "seg"])
    kind = joined.schema["conv_id"].dataType.simpleString()
    keep = ["conv_id", "part", "seg", "edits", "n_segments", "audit", *SUMMARY]
    fields = f"conv_id {kind}, part long, seg long, edits string, n_segments long, audit string, " + ", ".join(f"{c} long" for c in SUMMARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        message = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        for b in batches:
            columns = [b.column(c).to_pylist() for c in ("roles", "texts", "edits", "state")]
            made = [[{"role": r, "text": t} for r, t in repaired_rows(*row)] for row in zip(*columns)]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(made, message)], [*keep, "messages"])

    return joined.select(*keep, "state", "roles", "texts").mapInArrow(run, f"{fields}, messages array<struct<role:string,text:string>>")


def hashed(fixed: DataFrame) -> DataFrame:
    """One row per conversation: its summary, audit and the SHA-256 of its ``role:text`` lines."""
    lines = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "\n")
    rows = stage(fixed.select("conv_id", "part", "seg", "n_segments", "audit", *SUMMARY, F.size("messages").alias("n"), lines.alias("lines")), "talk-lines")
    names = ["conv_id", *SUMMARY, "audit", "repaired_sha256"]
    one = rows.where("n_segments = 1").withColumn("repaired_sha256", F.sha2("lines", 256)).select(*names)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = rows.where("n_segments > 1").repartition(parts, "conv_id").sortWithinPartitions("conv_id", "part", "seg")
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, empty = hashlib.sha256(), True
        for b in batches:
            out = []
            for row in b.to_pylist():
                if row["n"]:
                    digest.update(("" if empty else "\n").encode() + row["lines"].encode())
                    empty = False
                if row["audit"] is not None:
                    out.append({**{c: row[c] for c in names[:-1]}, "repaired_sha256": digest.hexdigest()})
                    digest, empty = hashlib.sha256(), True
            if out:
                yield pa.RecordBatch.from_pylist(out, pa.schema([(c, b.schema.field(c).type) for c in names[:-1]] + [(names[-1], pa.string())]))

    streamed = many.mapInArrow(run, f"conv_id {kind}, " + ", ".join(f"{c} long" for c in SUMMARY) + ", audit string, repaired_sha256 string")
    return one.unionByName(streamed)


def repair_summary(rows: DataFrame) -> DataFrame:
    """conv_id of every conversation with its faults, cost, audit and hash."""
    every = rows.select("conv_id").distinct()
    found = hashed(repair(rows)).withColumnRenamed("conv_id", "found")
    out = every.join(found, F.col("conv_id").eqNullSafe(F.col("found")), "left")
    return out.select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in SUMMARY], F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    return repair_summary(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def _oracle() -> str:
    """DuckDB SQL of ``query``: a recursion over rows. A state is its cost in eight digits followed by its edits,
    so that the least string is the cheapest way and, at equal cost, the least edits."""

    def add(way: str, cost, letters: str) -> str:
        return f"(lpad((left({way}, 8)::INTEGER + {cost})::VARCHAR, 8, '0') || substr({way}, 9) || '{letters}')"

    def when(test: str, *ways: str) -> str:
        return ", ".join(f"CASE WHEN {test} THEN {w} END" for w in ways)

    opened = f"""b0, b1,
        least(b2, {add('b0', INSERT, 'I')}, {add('b1', INSERT, 'I')}, {add('b3', INSERT, 'I')}) AS b2,
        least(b3, {add('b2', INSERT, 'I')}, {add('b0', 2 * INSERT, 'II')}, {add('b1', 2 * INSERT, 'II')}) AS b3"""
    stays = "f IN ('', 't')"
    rerole = f"{REROLE} + more"
    user = [add(b, rerole, "R") for b in ("b0", "b1", "b3")]
    kept = [add(b, "more", "K") for b in ("b0", "b1", "b3")]
    return rf"""
WITH RECURSIVE crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, row_number() OVER () AS place,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
kinds AS (
    SELECT keyed.*, xor(list_reduce([4294967295] || list_transform(string_split(k, ''), lambda x: ascii(x)::BIGINT),
        lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 20 AS kind FROM keyed CROSS JOIN crc),
damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, place,
        unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM kinds WHERE kind <> 0),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), place, copy) AS i,
        trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM damaged),
rows AS (
    SELECT conv_id, turn, role, text, i, left(role, 1) AS r,
        CASE WHEN bare = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
             WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS f,
        left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) AS before
    FROM placed),
ways AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS i, '00000000' AS b0, NULL::VARCHAR AS b1, '00000002I' AS b2, '00000004II' AS b3 FROM rows
    UNION ALL
    SELECT conv_id, i, {opened} FROM (
        SELECT w.conv_id, r.i, {add('b0', DELETE, 'D')} AS b0,
            least({add('b1', DELETE, 'D')}, {when(stays + " AND r = 's'", add('b0', 'more', 'K'))}) AS b1,
            least({add('b2', DELETE, 'D')}, {when(stays, *user)}, {when(stays + " AND r = 'u'", *kept)}) AS b2,
            least({add('b3', DELETE, 'D')}, {when(stays, add('b2', rerole, 'R'))}, {when(stays + " AND r = 'a'", add('b2', 'more', 'K'))}) AS b3
        FROM ways w JOIN (SELECT *, (f = 't')::INTEGER AS more FROM rows) r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = w.i + 1)),
ended AS (
    SELECT conv_id, least(b0, b3) AS best FROM ways QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
edits AS (
    SELECT conv_id, unnest(string_split(substr(best, 9), '')) AS e, generate_subscripts(string_split(substr(best, 9), ''), 1) AS p FROM ended WHERE length(best) > 8),
steps AS (
    SELECT conv_id, e, p, count(*) FILTER (e <> 'I') OVER w AS i, count(*) FILTER (e <> 'D') OVER w AS o
    FROM edits WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
made AS (
    SELECT s.conv_id, s.o, s.e, CASE WHEN s.e = 'I' THEN '' ELSE r.text END AS text, r.role,
        coalesce(max(CASE WHEN s.o = 1 AND s.e = 'K' AND r.r = 's' THEN 1 END) OVER (PARTITION BY s.conv_id), 0) AS system
    FROM steps s LEFT JOIN rows r ON s.conv_id IS NOT DISTINCT FROM r.conv_id AND s.i = r.i WHERE s.e <> 'D'),
texts AS (
    SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (o - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY o) AS t
    FROM made GROUP BY conv_id),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (f = 'b') AS blank, count(*) FILTER (f = 'd') AS duplicate,
        count(*) FILTER (f = 't') AS truncated, count(*) FILTER (i > 1 AND before || r NOT IN ('su', 'ua', 'au')) AS illegal
    FROM rows GROUP BY conv_id),
every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT every.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
    coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(left(best, 8)::BIGINT, 0) AS cost,
    coalesce(substr(best, 9), '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM every LEFT JOIN counts ON every.conv_id IS NOT DISTINCT FROM counts.conv_id
    LEFT JOIN ended ON every.conv_id IS NOT DISTINCT FROM ended.conv_id LEFT JOIN texts ON every.conv_id IS NOT DISTINCT FROM texts.conv_id
"""


ORACLE = _oracle()
