"""Operators of the llm package against brute force on small tables."""

import collections
import glob
import math
import os
import sys
import zlib

import duckdb
import numpy as np
import pytest
import xxhash

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from shelfscope.llm import decontam, html_text, lines, lm, mixing, quality, simhash, substring, token_counts, topk  # noqa: E402
from shelfscope.llm.common import connected_components  # noqa: E402
from shelfscope.llm.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, source="s"):
    return spark.createDataFrame([(i, t, "en", source, None if t is None else len(t)) for i, t in enumerate(texts)], DOC_SCHEMA)


def smallest_reachable(ids, edges):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_sql(spark, scratch, key):
    out = f"{scratch}/llm_{key}"
    QUERIES[key](spark, SF).write.mode("overwrite").parquet(out)
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    con.execute(f"CREATE TABLE o AS {ORACLES[key]}")
    con.execute(f"CREATE VIEW s AS SELECT * FROM read_parquet('{out}/*.parquet')")
    cols = ", ".join(sorted(r[0] for r in con.execute("DESCRIBE o").fetchall()))
    assert con.execute("SELECT count(*) FROM s").fetchone() == con.execute("SELECT count(*) FROM o").fetchone()
    assert con.execute(f"SELECT count(*) FROM (SELECT {cols} FROM s EXCEPT ALL SELECT {cols} FROM o)").fetchone()[0] == 0


def test_components_of_paths_stars_and_cycles(spark):
    rng = np.random.default_rng(3)
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 140)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    edges += [tuple(int(x) for x in rng.integers(300, 400, 2)) for _ in range(60)]
    edges = [e for e in edges if e[0] != e[1]]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == smallest_reachable({x for e in edges for x in e}, edges)


def test_mix_comes_near_its_targets(spark):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(["w"] * int(rng.integers(1, 60))), "en", f"s{i % 4}" if i % 7 else "s0", 0) for i in range(3000)]
    got = mixing.mix_plan(spark.createDataFrame(rows, DOC_SCHEMA)).collect()
    taken, target = collections.Counter(), {}
    for r in got:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    total = sum(r["size"] for r in got)
    assert abs(sum(target.values()) - 1.5 * total) < 1e-6 * total
    for s, t in target.items():
        assert abs(taken[s] - t) <= 120
    again = mixing.mix_plan(spark.createDataFrame(rows[::-1], DOC_SCHEMA)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in got) == sorted((r["doc_id"], r["taken"]) for r in again)


def test_mix_rows_are_in_order_of_finish(spark):
    docs = docs_of(spark, [" ".join(["w"] * (i % 9 + 1)) for i in range(200)])
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix_plan(docs).collect()}
    rows = mixing.mix(docs).collect()
    assert collections.Counter(r["doc_id"] for r in rows) == collections.Counter({k: v for k, v in plan.items() if v})
    finish = [r["mix_finish"] for r in rows]
    assert finish == sorted(finish)


def test_lines_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choice(vocabulary, 40)) for _ in range(60)]
    texts = []
    for i in range(120):
        own = [base[int(rng.integers(60))] for _ in range(3)]
        if i % 2:
            words = own[0].split()
            words[int(rng.integers(40))] = "edited"
            own[0] = " ".join(words)
        texts.append("\n".join(own + ["", f"own line {i} " + " ".join(rng.choice(vocabulary, 5))]))
    docs = docs_of(spark, texts)

    def norm(x):
        return " ".join(x.lower().split())

    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    table = lines.line_table(docs)
    keys = {r["key"]: r["fp"] & (2**64 - 1) for r in lines.fingerprints(table).collect()}
    text_of = {r["key"]: r["line"] for r in lines._texts(docs, table, spark.createDataFrame([(k,) for k in keys], "key long")).collect()}
    want = []
    ks = sorted(keys)
    for i, a in enumerate(ks):
        for b in ks[i + 1:]:
            if (keys[a] ^ keys[b]).bit_count() <= 3:
                n = max(len(text_of[a]), len(text_of[b]))
                if lev(text_of[a], text_of[b]) <= math.floor(n * 0.2 + 1e-9):
                    want.append((a, b))
    assert want
    group = smallest_reachable(ks, want)
    for crowd in (1, 32):
        links = lines.links(docs, table, crowd=crowd)
        found = [(r["a"], r["b"]) for r in links.collect()]
        assert smallest_reachable(ks, found) == group
    by_line = {v: k for k, v in text_of.items()}
    seen, expect = set(), {}
    for i, t in enumerate(texts):
        kept = []
        for x in t.split("\n"):
            g = group[by_line[norm(x)]] if norm(x) else None
            if g is None or g not in seen:
                kept.append(x)
            seen.add(g)
        expect[i] = "\n".join(kept)
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in lines.dedup_lines(docs).collect()}
    assert {k: v[0] for k, v in got.items()} == expect
    assert all(len(t) == n for t, n in got.values())


def test_long_lines_are_compared_by_words_and_counted_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(lines, "CHUNK", 64)
    words = [f"word{i}" for i in range(400)]
    near = words[:200] + ["changed"] + words[201:]
    docs = docs_of(spark, [" ".join(words), " ".join(near), "something else entirely"])
    bits = {}
    for w in (words, near):
        h = [r[0] & (2**64 - 1) for r in spark.createDataFrame([(x,) for x in sorted(set(w))], "w string").selectExpr("xxhash64(w)").collect()]
        bits[" ".join(w)] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    got = {r["fp"] & (2**64 - 1) for r in lines.line_table(docs).collect()}
    assert set(bits.values()) <= got
    if (bits[" ".join(words)] ^ bits[" ".join(near)]).bit_count() <= 3:
        assert [r["text"] for r in lines.dedup_lines(docs).orderBy("doc_id").collect()][1] == ""


def test_line_candidates_reach_edited_lines(spark):
    """One changed word in twelve, one typing error in a short line, a line without spaces: compared and linked."""
    rng = np.random.default_rng(8)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))

    def word():
        return "".join(rng.choice(letters, int(rng.integers(4, 9))))

    base, edited = [], []
    for i in range(150):
        words = [word() for _ in range((12, 5, 40)[i % 3])]
        if i % 10 == 9:
            words = ["".join(words)]
        base.append(" ".join(words))
        at = int(rng.integers(len(words)))
        if i % 3 == 1 or len(words) == 1:
            words[at] = words[at][:2] + "#" + words[at][3:]
        else:
            words[at] = word()
        edited.append(" ".join(words))
    docs = docs_of(spark, base + edited)
    got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(docs, distance=None).collect()}
    assert [got[i] for i in range(150)] == base
    assert sum(got[150 + i] == "" for i in range(150)) >= 143
    out = spark.createDataFrame([(0, base[0]), (1, edited[0])], "doc_id long, text string")
    assert [r["text"] for r in lines.dedup_lines(out, distance=None).orderBy("doc_id").collect()] == [base[0], ""]


def test_line_query_recall_on_the_test_pages(spark):
    """Of all pairs of short lines with that edit similarity, found without any gate, the query's candidates hold 0.9."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    table = lines.sketch_table(docs).cache()
    keys = table.select("key").distinct()
    texts = lines._texts(docs, table, keys).where("length(line) <= 300").cache()
    a, b = texts.selectExpr("key a", "line x"), texts.selectExpr("key b", "line y")
    close = "a < b and least(length(x), length(y)) >= 0.8 * greatest(length(x), length(y)) - 1"
    pairs = a.join(b, on=a.a < b.b).where(close).where("levenshtein(x, y, cast(floor(greatest(length(x), length(y)) * 0.2 + 1e-9) as int)) >= 0")
    want = [(r["a"], r["b"]) for r in pairs.select("a", "b").collect()]
    group = {r["node"]: r["root"] for r in lines.line_groups(docs, table, distance=None).collect()}
    found = sum(a in group and group[a] == group.get(b) for a, b in want)
    assert len(want) > 10 and found >= 0.9 * len(want), (found, len(want))


def test_quality_finds_planted_grades(spark):
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(500)]
    rows, grades = [], []
    for i in range(2400):
        w = list(rng.choice(words, 60))
        g = [2, 2, 0, 1][i % 4]
        if g == 0:
            w[5], w[25] = "vile", "nasty"
        if g == 1:
            w = [x.upper() + "!!" for x in w]
        rows.append((i, " ".join(w), "en", "s", 0))
        grades.append((i, g))
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    model = quality.fit(docs, spark.createDataFrame(grades[:1600], "doc_id long, grade int"))
    assert (np.diff(model.thresholds) > 0).all()
    got = {r["doc_id"]: r for r in quality.score_documents(docs, model).collect()}
    held = [(got[i], g) for i, g in grades[1600:]]
    assert np.mean([r["kept"] == (g == 2) for r, g in held]) > 0.97
    mean = [np.mean([r["expected_grade"] for r, g in held if g == k]) for k in range(3)]
    assert mean[0] < mean[1] < mean[2]
    kept = quality.filter_documents(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["kept"]}


PAGE = """<html><body class="has-sidebar"><header><h1>Site</h1></header><div id="cookie-notice">We use cookies</div>
<div class="wrap"><div class="content"><h1>Title &amp; all</h1><p>Para one is here &#8212; with   enough text to be counted.<p>Second para
<a href=x>link</a> more &lt;text&gt; for the thing, and on it goes.</p><ul><li>first item of it<li>second item</ul></div>
<div class="sidebar"><a href=1>one</a><a href=2>two</a></div><div id="comments"><p>Great article I really love this so much, a very long comment.</p></div></div>
<form><p>sign up</p></form><script>var a = "<p>no</p>";</script><style>p{}</style><footer>foot</footer></body></html>"""


def test_html_main_text():
    assert html_text.extract(PAGE) == "\n".join([
        "Title & all", "Para one is here — with enough text to be counted.", "Second para link more <text> for the thing, and on it goes.",
        "first item of it", "second item",
    ])
    assert html_text.extract(None) == html_text.extract("") == html_text.extract("<p></p>") == ""
    assert html_text.extract("just text &amp") == "just text &"
    deep = "<div>" * 5000 + "<p>deep text</p>" + "</div>" * 5000
    assert html_text.extract(deep) == "deep text"


LONG = ["A long paragraph of the story, which goes on for quite some time before it ends with the number " + x + "." for x in ("one", "two", "three", "four", "five", "six")]


def test_html_content_is_not_the_article_tag():
    parts = [f"<article><p>{a}</p><p>{b}</p></article>" for a, b in zip(LONG[::2], LONG[1::2])]
    page = "<html><body><nav><a href=x>menu</a></nav><main><h1>The title</h1>" + "".join(parts) + "</main><footer>foot</footer></body></html>"
    assert html_text.extract(page) == "\n".join(["The title"] + LONG)
    # One part is larger than all others together; the last has one long paragraph and a short one.
    page = page.replace("<article>", "<article>" + "".join(f"<p>{x}</p>" for x in LONG), 1).replace("</article></main>", "<p>Short end.</p></article></main>")
    assert html_text.extract(page) == "\n".join(["The title"] + LONG + LONG + ["Short end."])
    # The article element is a teaser of a few words: the text stands elsewhere.
    page = "<body><div><article><p>Teaser.</p></article></div><div>" + "".join(f"<p>{x}</p>" for x in LONG) + "</div></body>"
    assert html_text.extract(page) == "\n".join(LONG)


@pytest.mark.parametrize("opening", [
    '<div id="top">', '<div class="content has-sidebar">', '<div class="layout no-sidebar">', '<section class="post comment-enabled">', '<div class="post with_comments">',
    '<div class="page-header-menu">', '<div class="overlay">',
])
@pytest.mark.parametrize("article", ["article", "div"])
def test_html_layout_classes_do_not_cut_the_article(opening, article):
    body = "".join(f"<p>{x}</p>" for x in LONG)
    aside = '<div class="sidebar"><p>Side text that is not the story.</p></div><div id="comments"><p>First! What a long comment this is, it never ends.</p></div>'
    page = f"<body>{opening}<{article}><h1>The title</h1>{body}<div class=ad><p>Buy this thing now, it is cheap.</p></div></{article}>{aside}</{opening.split()[0][1:]}></body>"
    assert html_text.extract(page) == "\n".join(["The title"] + LONG)


def test_html_articles_of_the_test_pages(spark):
    import html
    import re

    rows = {r["page_id"]: r["text"] for r in QUERIES["op4_html_text"](spark, SF).collect()}
    for page, raw in duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall():
        article = re.search(r"<article>(.*?)</article>", raw, re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1|h2|li|ul|div)>", article)]
        assert rows[page] == "\n".join(b for b in blocks if b)


def _repeated(texts, window=substring.WINDOW):
    count = collections.Counter(tuple(w[i:i + window]) for w in map(str.split, texts) for i in range(len(w) - window + 1))
    out = []
    for w in map(str.split, texts):
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append([x for i, x in enumerate(w) if i not in gone])
    return out


@pytest.mark.parametrize("hot", [4096, 2])
def test_substrings_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(substring, "HOT_PIECES", hot)
    monkeypatch.setattr(substring, "SHARD_WORDS", 3000)
    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in range(200)]
    shared = list(rng.choice(words, 300))
    texts = ["The " * 90, "a b " * 60, "", "few words", " ".join(shared[:40])]
    for i in range(40):
        t = list(rng.choice(words, int(rng.integers(10, 300))))
        if i % 2:
            at, n = int(rng.integers(0, 200)), int(rng.integers(30, 100))
            t[5:5] = shared[at:at + n]
        if i % 5 == 0:
            t = list(shared)
            t[int(rng.integers(300))] = "edit"
        texts.append(" ".join(t))
    texts += texts[-3:]
    docs = docs_of(spark, texts)
    got = {r["doc_id"]: r for r in substring.dedup_substrings(docs).collect()}
    for i, want in enumerate(_repeated(texts)):
        assert got[i]["kept"] == " ".join(want).encode()
        assert got[i]["n_removed"] == len(texts[i].split()) - len(want)


def test_fm_index_counts():
    rng = np.random.default_rng(4)
    text = rng.integers(1, 5, 500)
    text[::50] = 0
    index = substring.FMIndex(text, np.ones(500, np.int64))
    for _ in range(200):
        n, at = int(rng.integers(1, 12)), int(rng.integers(0, 480))
        p = text[at:at + n]
        if (p == 0).any():
            continue
        lo, hi = np.array([0]), np.array([500])
        for s in p[::-1]:
            lo, hi = index.step(np.array([s]), lo, hi)
        assert hi[0] - lo[0] == sum((text[i:i + n] == p).all() for i in range(500 - n + 1) if len(text[i:i + n]) == n)


def test_top_k_with_ties_and_shards(spark):
    rng = np.random.default_rng(6)
    rows = [(int(i), [float(x) for x in rng.integers(-3, 4, 6) / 8]) for i in range(400)]
    rows += [(7, [0.5] * 6), (7, [0.5] * 6), (None, [0.9] * 6), (1000, None), (1001, [None] * 6), (1002, [float("nan")] * 6), (1003, [float("inf")] * 6), (1020, [1.0, 2.0]), (1040, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in topk.top_k(df, k=5, shard_rows=70, block_queries=8).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    x = [(i, v, [math.floor(64 * c) for c in v]) for i, (_, v) in enumerate(rows) if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    for u, _, q in x:
        vid = rows[u][0]
        if vid is None or vid % topk.QUERY_EVERY:
            continue
        c = sorted((-int(np.dot(q, y)), rows[w][0] is None, rows[w][0] or 0) for w, _, y in x if w != u and len(y) == len(q))[:5]
        assert sorted(got.get(vid, [])) == [(n + 1, None if none else i, -s) for n, (s, none, i) in enumerate(c)]


def test_top_k_of_huge_vectors_is_exact():
    q, x = np.array([[2.0**40, 3.0]]), np.array([[2.0**20, 1.0], [2.0**20, -1.0]])
    assert topk._inner(q, x).tolist() == [[2**60 + 3, 2**60 - 3]]


def test_decontamination_finds_copies_and_paraphrases(spark):
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(2000)]
    items = [list(rng.choice(words, 30)) for _ in range(12)]
    texts, want = [], set()
    for i in range(80):
        t = list(rng.choice(words, 300))
        if i % 4 == 0:
            k = i // 4 % 12
            copy = list(items[k])
            if i % 8 == 0:
                for at in (3, 9, 15, 20):
                    copy[at] = "other"
            t[100:100] = copy
            want.add((i, k))
        texts.append(" ".join(t))
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)] + [(99, None), (98, "")], "item_id long, text string")
    docs = docs_of(spark, texts)
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, bench).collect()}
    assert got == want
    assert {r["doc_id"] for r in decontam.clean_documents(docs, bench).collect()} == set(range(80)) - {d for d, _ in want}


def test_copies_with_their_answer_need_no_latent_gate(spark, monkeypatch):
    monkeypatch.setattr(decontam, "COSINE", 2.0)
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(2000)]
    items = [list(rng.choice(words, n)) for n in (3, 6, 17, 30, 61)]
    texts = []
    for i in range(40):
        copy = list(items[i % 5])
        for at in range(0, len(copy) - decontam.ANSWER_WORDS, 3):
            copy[at] = "other"
        t = list(rng.choice(words, 300))
        t[7 * i:7 * i] = copy
        texts.append(" ".join(t))
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    docs = docs_of(spark, texts + ["nothing"])
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, bench).collect()}
    assert got >= {(i, i % 5) for i in range(40)}
    assert decontam.rank_of(12) == decontam.rank_of(400) == decontam.RANK < decontam.rank_of(4000) < decontam.rank_of(40_000)


def test_lcs_and_singular_vectors(spark):
    def slow(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last, row = row, [0]
            for j, y in enumerate(b, 1):
                row.append(last[j - 1] + 1 if x == y else max(last[j], row[-1]))
        return row[-1]

    rng = np.random.default_rng(0)
    for _ in range(50):
        a, b = ([f"{x}" for x in rng.integers(0, 6, n)] for n in (12, 30))
        assert decontam.lcs_length(decontam.Item(0, a).masks, 12, b) == slow(a, b)


def _slow_fingerprint(text):
    w = text.encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_against_all_pairs(spark):
    texts = [r[0] for r in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()] + ["", "one", "one two", "ÀB C d", None]
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs_of(spark, texts)).collect()}
    fps = {i: _slow_fingerprint(t or "") for i, t in enumerate(texts)}
    assert {i: r["fp"] & (2**64 - 1) for i, r in got.items()} == fps
    edges = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2]
    assert {i: r["component_id"] for i, r in got.items()} == smallest_reachable(fps, edges)


@pytest.mark.parametrize("crowd", [3, 64])
def test_simhash_links_in_crowds(spark, crowd):
    rng = np.random.default_rng(11)
    fps = {0, 1, 3, 2**63 - 1}
    for center in (12345678901234567, 999):
        for _ in range(150):
            x = center
            for b in rng.integers(0, 63, int(rng.integers(0, 5))):
                x ^= 1 << int(b)
            fps.add(x)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    found = [(r["a"], r["b"]) for r in simhash.links(df, crowd=crowd).collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in found)
    want = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 2]
    assert smallest_reachable(fps, found) == smallest_reachable(fps, want)


def _tokens(texts, version="byte_bpe_50k"):
    enc = token_counts._encoding(token_counts.VERSIONS[version])
    return [len(enc.encode_ordinary(t)) if t else 0 for t in texts]


def test_rollup_batches(spark, scratch):
    store = token_counts.Rollup(spark, f"{scratch}/rollup")
    schema = "doc_id long, op string, source string, lang string, text string"
    v = {"byte_bpe_50k": token_counts.VERSIONS["byte_bpe_50k"]}

    def totals():
        return {(r["source"], r["lang"]): (r["n_docs"], r["n_tokens"]) for r in store.totals().collect()}

    first = spark.createDataFrame([(1, "insert", "a", "en", "one two"), (2, "insert", "a", "en", None), (3, "insert", None, "de", "drei"), (None, "insert", "a", "en", "x y z")], schema)
    assert store.apply("b1", first, v)
    n = _tokens(["one two", None, "drei", "x y z"])
    want = {("a", "en"): (3, n[0] + n[1] + n[3]), (None, "de"): (1, n[2])}
    assert totals() == want
    assert not store.apply("b1", first, v)
    assert totals() == want
    # A batch that failed before its marker leaves data that nobody reads.
    os.makedirs(f"{scratch}/rollup/deltas/9-lost")
    open(f"{scratch}/rollup/commits/1", "w").close()  # and one that died at it, a number
    assert totals() == want
    assert store.apply("b2", spark.createDataFrame([(1, "revise", "b", "en", "one two three"), (3, "delete", None, None, None), (77, "delete", "a", "en", "gone")], schema), v)
    assert totals() == {("a", "en"): (2, n[1] + n[3]), ("b", "en"): (1, _tokens(["one two three"])[0])}
    assert store.apply("b3", spark.createDataFrame([], schema), v)
    assert {(r["doc_id"], r["n_tokens"]) for r in store.entries().collect()} == {(1, _tokens(["one two three"])[0]), (2, 0)}


def test_rollup_query_counts_all_documents(spark):
    docs = duckdb.sql(f"SELECT doc_id, text, source, lang FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    first, want = {}, collections.Counter()
    for _, text, _, _ in docs:
        first.setdefault(text, True)
    seen = set()
    import re

    clean = [re.sub(r"[\x20\x09-\x0D]+", " ", t.strip(" ")) for _, t, _, _ in docs]
    for (_, text, source, lang), *counts in zip(docs, *[_tokens(clean, v) for v in token_counts.VERSIONS]):
        if text not in seen:
            for v, n in zip(token_counts.VERSIONS, counts):
                want[source, lang, v, "docs"] += 1
                want[source, lang, v, "tokens"] += n
        seen.add(text)
    got = collections.Counter()
    for r in QUERIES["op9_token_rollup"](spark, SF).collect():
        got[r["source"], r["lang"], r["version"], "docs"], got[r["source"], r["lang"], r["version"], "tokens"] = r["n_docs"], r["n_tokens"]
    assert got == want and len({k[2] for k in got}) == 2


def test_rollup_of_two_writers(spark, scratch, monkeypatch):
    """A batch that another writer commits meanwhile counts once; a different one is worked out anew."""
    schema = "doc_id long, op string, source string, lang string, text string"
    v = {"byte_bpe_50k": token_counts.VERSIONS["byte_bpe_50k"]}
    one = spark.createDataFrame([(1, "insert", "a", "en", "one two")], schema)
    two = spark.createDataFrame([(1, "insert", "b", "en", "one two three")], schema)
    write = token_counts.Rollup._write

    def racing(store, other):
        def run(self, *args):
            if self is store and other:
                token_counts.Rollup(spark, store.path).apply(*other.pop(), v)
            write(self, *args)

        monkeypatch.setattr(token_counts.Rollup, "_write", run)

    store = token_counts.Rollup(spark, f"{scratch}/rollup-same")
    racing(store, [("b1", one)])
    assert not store.apply("b1", one, v)
    assert [tuple(r) for r in store.totals().select("n_docs", "n_tokens").collect()] == [(1, _tokens(["one two"])[0])]
    store = token_counts.Rollup(spark, f"{scratch}/rollup-other")
    racing(store, [("b2", two)])
    assert store.apply("b1", one, v)
    assert [tuple(r) for r in store.totals().select("source", "n_docs").collect()] == [("a", 1)]
    assert [b for _, b, _ in store._committed()] == ["b2", "b1"]


def test_lattice_sums_all_segmentations():
    pieces = [b"a", b"b", b"ab", b"ba", b"aba", "▁".encode()[:1], "▁".encode()[1:2], "▁".encode()[2:], "▁".encode(), "▁a".encode()]
    lp = np.log(np.arange(1, len(pieces) + 1) / 55)
    lattice = lm.Lattice(pieces, lp)
    table = dict(zip(pieces, lp))

    def total(s):
        return 1.0 if not s else sum(math.exp(table[s[:n]]) * total(s[n:]) for n in range(1, len(s) + 1) if s[:n] in table)

    words = [b"a", b"ab", b"aba", b"abab", b"bbbb", b"abaabbab", b"a" * 300]
    counts, alone = np.zeros(len(pieces)), np.zeros(len(pieces))
    got = lattice.log_probability(words[:-1], counts)
    assert np.allclose(got, [math.log(total(lm.Lattice.START + w)) for w in words[:-1]])
    assert np.allclose([lattice._one(lm.Lattice.START + w, alone, 1.0) for w in words[:-1]], got)
    assert np.allclose(counts, alone)
    assert np.isfinite(lattice.log_probability(words)[-1])


def test_lm_scores(spark):
    texts = [r[0] for r in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet' ORDER BY doc_id LIMIT 60").fetchall()] + ["", None, "qqqq zzzzx " + "y" * 400]
    got = {r["doc_id"]: r for r in lm.score(docs_of(spark, texts), rounds=1).collect()}
    words = [(t or "").encode().lower().split() for t in texts]
    train = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 7 != 2]
    c = collections.Counter(w for i in train for w in words[i])
    n, v, ends = sum(c.values()) + len(train), len(c) + 1, len(train)
    for i, w in enumerate(words):
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (i not in train, len(w) + 1, n)
        assert r["n_known"] == sum(x in c for x in w) + 1
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w) + math.log10((ends + 1) / (n + v + 1))
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert r["score"] < 0 and math.isfinite(r["score"])
    assert got[len(texts) - 1]["score"] < got[len(texts) - 2]["score"]


def test_no_operator_swallows_import_errors_or_uses_local_checkpoints():
    root = os.path.dirname(os.path.abspath(lm.__file__))
    for path in [*glob.glob(f"{root}/*.py"), os.path.join(os.path.dirname(os.path.dirname(root)), "corpus_pipeline.py")]:
        text = open(path).read()
        assert "ImportError" not in text and "localCheckpoint" not in text and "ModuleNotFoundError" not in text
