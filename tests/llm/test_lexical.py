"""Ranked search against scores computed one by one."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from shelfscope.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=10):
    held = [(d, Counter(split(t))) for d, t in docs if split(t)]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in held:
            m = 10 + 90 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(split(text)) if t in c)
            if s > 0:
                scores.append((-s, d is None, d))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scores)[:k])]
    return out


def rows(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(lexical, "SHARD_BYTES", 4000)
    monkeypatch.setattr(lexical, "BLOCK", 4)
    monkeypatch.setattr(lexical, "QUERY_BLOCK", 3)


def corpus(n, seed=3):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(300)]
    p = 1 / np.arange(1, 301)
    texts = [" ".join(rng.choice(words, rng.integers(0, 60), p=p / p.sum())) for _ in range(n)]
    return [(i, t) for i, t in enumerate(texts + texts[:n // 3])], [(i, " ".join(rng.choice(words, 12, p=p / p.sum()))) for i in range(8)]


def test_search_against_all_scores(spark, small):
    docs, items = corpus(400)
    found = lexical.search(lexical.build_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)), spark.createDataFrame(items, "item_id long, text string"))
    assert rows(found) == sorted(brute(docs, items), key=str)


def test_odd_rows(spark, small):
    docs = [(1, "Straße ÀB1 don't x"), (1, "Straße ÀB1 don't x"), (2, None), (3, ""), (None, "x y_z naïve\x7fx"), (4, "... \t"), (5, "x " * 5000 + "rare"), (None, None), (6, "日本 日本x")]
    items = [(1, "straße t"), (1, "straße t"), (None, "rare X"), (2, None), (3, "unknown"), (4, "日本 rare"), (5, "")]
    d = spark.createDataFrame([(*r, 1, "t", 2) for r in docs], "doc_id long, text string, shard int, term string, df int")
    q = spark.createDataFrame([(*r, 1, "t") for r in items], "item_id long, text string, query int, terms string")
    assert rows(lexical.search(lexical.build_index(d), q)) == sorted(brute(docs, [items[0], *items[2:]]), key=str)
    none = d.limit(0)
    assert lexical.search(lexical.build_index(none), q).count() == 0
    assert lexical.search(lexical.build_index(d), q.limit(0)).count() == 0


def test_blocks_that_cannot_matter_stay_compressed(small):
    """A common term's blocks: rejected by bound, without a loss."""
    n = 3000
    docs = [b"common" + b" rare" * (i % 100 == 0) + b" filler" * (i % 7) for i in range(n)]
    (_, *batches) = lexical.shard_batches(0, list(range(n)), docs)
    found = {r["term"]: r for b in batches for r in b.to_pylist()}
    lengths = np.array([len(lexical.terms_of(d)) for d in docs])
    impact = lambda tf, m: 10**9 * tf // (1000 * tf + 8 * (10 + 90 * m * n // int(lengths.sum())))
    lists = [lexical.PostingList(w, found[t], impact) for t, w in (("common", 3), ("rare", 4000))]
    got, scores = lexical.search_shard(lists, lengths, 10, window=64)
    truth = np.array([3 * impact(1, lengths[i]) + 4000 * impact(1, lengths[i]) * (i % 100 == 0) for i in range(n)])
    least = np.sort(truth)[-10]
    assert sorted(got) == np.flatnonzero(truth >= least).tolist() and (truth[got] == scores).all()
    # Ten rare documents are known after 900 documents; from then on the common term's blocks are only bounds.
    assert len(lists[0].open) < 0.35 * len(lists[0].last)


def test_lists_round_trip_in_every_width():
    rng = np.random.default_rng(5)
    for top in (200, 60_000, 3_000_000):
        docs = [np.unique(rng.integers(0, top, n)) for n in (1, 130, 128, 700)]
        term = np.repeat(np.arange(4), [len(d) for d in docs])
        doc = np.concatenate(docs)
        tf = rng.integers(1, top, len(doc))
        n = rng.integers(1, 50, top)
        made = lexical.encode_lists(term, doc, tf, n[doc])
        for t in range(4):
            row = {c: v[o[t]:o[t + 1]] for c, (o, v) in made.items() if o is not None}
            row["data"] = row["data"].tobytes()
            x = lexical.PostingList(1, row, lambda a, b: 10**9 * a // (1000 * a + 8 * b))
            got = [x.block(i, n) for i in range(len(x.last))]
            assert np.concatenate([d for d, _ in got]).tolist() == docs[t].tolist()
            assert [int(s.max()) for _, s in got] == x.block_max.tolist()
