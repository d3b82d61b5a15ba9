"""Conversation repair against a recursion over single rows."""

import hashlib
import re
import sys
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pytest

from shelfscope.llm import conversations as talk

sys.setrecursionlimit(20_000)
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def damaged(rows):
    """conv_id -> rows (turn, role, text) after damage, in order."""
    held = defaultdict(list)
    for place, (conv, turn, role, text) in enumerate(rows):
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        held[conv] += [] if kind == 0 else [(turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text, place)] * (1 + (kind == 3))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest(), r[3])
    return {c: [r[:3] for r in sorted(v, key=key)] for c, v in held.items()}


def brute(rows):
    out = []
    for conv, kept in damaged(rows).items():
        seen, faults = set(), []
        for _, role, text in kept:
            bare = text.strip(" \t\n\x0b\x0c\r")
            faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
            seen.add((role, text))

        @lru_cache(None)
        def best(i, state, fresh=0):
            """(cost, edits) from row i on; ``fresh`` counts the inserts just made."""
            ways = [(0, "")] if i == len(kept) and state in (0, 3) else []
            step = lambda cost, letter, then: (then[0] + cost, letter + then[1])
            if fresh < 3:
                ways += [step(2, "I", best(i, MOVES[state, r], fresh + 1)) for r in "ua" if (state, r) in MOVES]
            if i < len(kept):
                ways.append(step(3, "D", best(i + 1, state)))
                if faults[i] not in ("b", "d") or not faults[i]:
                    more = faults[i] == "t"
                    ways += [step(2 + more, "R", best(i + 1, MOVES[state, r])) for r in "ua" if (state, r) in MOVES]
                    if (state, kept[i][1][:1]) in MOVES:
                        ways.append(step(0 + more, "K", best(i + 1, MOVES[state, kept[i][1][:1]])))
            return min(ways, default=(10**9, ""))

        cost, audit = best(0, 0)
        state, at, lines = 0, 0, []
        for e in audit:
            if e != "D":
                role = kept[at][1] if e == "K" else "assistant" if state == 2 else "user"
                state = MOVES[state, role[0]]
                lines.append(role + ":" + ("" if e == "I" else kept[at][2]))
            at += e != "I"
        turns = [r[0] for r in kept if r[0] is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(kept, kept[1:])]
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
                    sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r[c] for c in ("conv_id", *talk.SUMMARY, "audit", "repaired_sha256")) for r in df.collect()), key=str)


ODD = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Yes."), (1, 2, "assistant", "Yes."), (1, 5, "user", "cut of"),
    (2, None, "user", None), (2, None, None, "text."), (2, 3, "", "x!"), (2, 3, "tool", "y \t"), (None, 1, "user", "q."), (None, 1, "assistant", "é. \x0b"),
    (3, 7, "user", " \n"), (4, None, None, None), (5, -3, "system", "a."), (5, 0, "system", "a."), (6, 1, "User", "b."), (6, 1, "user", "b."),
    (7, 0, "user", "z" * 100_000), (7, 1, "assistant", ". " * 50_000), *[(c, t, "user", "gone.") for c in range(100, 160) for t in (0,)],
]


def test_odd_rows(spark):
    df = spark.createDataFrame([(*r, 1, "s", 2) for r in ODD], "conv_id long, turn long, role string, text string, part int, symbols string, copy int")
    assert rows_of(talk.repair_summary(df)) == brute(ODD)
    assert talk.repair_summary(df.limit(0)).count() == 0


@pytest.mark.parametrize("segment", [3, 1024])
def test_random_conversations_and_a_long_one(spark, monkeypatch, segment):
    monkeypatch.setattr(talk, "SEGMENT_ROWS", segment)
    rng = np.random.default_rng(11)
    rows = []
    for conv in range(120):
        for turn in range(int(rng.integers(1, 9)) if conv else 300):
            turn += int(rng.integers(0, 2)) * (conv % 5 == 0)
            rows.append((conv, turn if conv % 7 else int(rng.integers(0, 50)), str(rng.choice(["system", "user", "assistant", "tool"], p=[.1, .4, .4, .1])),
                         str(rng.choice(["one.", "two!", "cut", " ", "three?", f"own {turn}."]))))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    rows = [tuple(r) for r in df.collect()]  # ties go by input order
    assert rows_of(talk.repair_summary(df)) == brute(rows)


def test_query_on_the_test_conversations(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    assert rows_of(talk.query(spark, sf)) == brute(rows)


def test_rules_give_the_matrix_of_single_rows():
    """Products over rules and over their rows agree; rules are shared."""
    rng = np.random.default_rng(2)
    for _ in range(30):
        text = "".join(chr(talk.FIRST_SYMBOL + c) for c in rng.integers(0, 16, 12))
        rules = [text[:2], chr(talk.FIRST_RULE) + text[2]]
        flat = lambda m: [(c[0], c[1].text()) if c else None for row in m for c in row]
        short = text.replace(rules[0], chr(talk.FIRST_RULE)).replace(rules[1], chr(talk.FIRST_RULE + 1))
        assert flat(talk.string_matrix(short, talk.matrices(rules))) == flat(talk.string_matrix(text, talk.matrices([])))


def test_grammar_shortens_repeated_structure(spark):
    strings = spark.createDataFrame([("EIEIEIEI", 50), ("AEIEI", 20), ("P", 3)], "symbols string, n long")
    rules, work = talk.grammar(strings)
    assert "EI" in rules and all(len(r["short"]) < len(r["symbols"]) for r in work.where("n > 3").collect())
