"""Latent retrieval: sketch and singular vectors against dense ones, search against every window, answers and subsequences by plain loops."""

import numpy as np
import pytest

pytest.importorskip("shelfscope.llm")

from shelfscope.llm import decontam  # noqa: E402


def _texts(rng, n, vocabulary, longest=300):
    # Topics: a text's words come from a part of the vocabulary, and a fifth from anywhere.
    out = []
    for _ in range(n):
        topic = rng.integers(0, 8)
        size = int(rng.integers(0, longest))
        own = rng.integers(0, vocabulary // 8, size) + topic * (vocabulary // 8)
        out.append([f"w{x}" for x in np.where(rng.random(size) < 0.2, rng.integers(0, vocabulary + 40, size), own)])
    return out


def _dense(rows, idf):
    """Unit TF-IDF rows of lists of word ids; ids beyond the vocabulary are unknown."""
    a = np.zeros((len(rows), len(idf)))
    for r, ids in zip(a, rows):
        for i in ids:
            if 0 <= i < len(idf):
                r[i] += idf[i]
        size = np.linalg.norm(r)
        if size:
            r /= size
    return a


def _ids(texts, vocabulary):
    return np.array([vocabulary.get(w, -1) for t in texts for w in t], np.int32), np.array([len(t) for t in texts])


def _passages(texts, vocabulary):
    return [[vocabulary.get(w, -1) for w in t[i:i + decontam.PASSAGE]] for t in texts for i in range(0, len(t), decontam.PASSAGE)]


def test_sketch_against_dense_product():
    rng = np.random.default_rng(1)
    vocabulary = {f"w{i}": i for i in range(120)}
    texts = _texts(rng, 50, 120) + [[], ["unknown"] * 70]
    idf, g = rng.random(120) + 0.1, rng.standard_normal((120, 9)).astype(np.float32)
    z = np.zeros(g.shape)
    rows, n = decontam._padded(*_ids(texts, vocabulary), decontam.PASSAGE, 120)
    assert n.tolist() == [-(-len(t) // decontam.PASSAGE) for t in texts]
    decontam._sketch(rows, idf, g, z)
    a = _dense(_passages(texts, vocabulary), idf)
    assert np.allclose(z, a.T @ (a @ g), atol=1e-3)


def test_singular_vectors_against_dense_svd(spark):
    rng = np.random.default_rng(2)
    size = 60
    vocabulary = {f"w{i}": i for i in range(size)}
    texts = _texts(rng, 200, size)
    items = [decontam.Item(i, [w for w in t[:40] if w in vocabulary]) for i, t in enumerate(_texts(rng, 12, size)) if len(t) > 40]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)] + [(500, None), (None, "")], "doc_id long, text string").repartition(5)
    ids = decontam.word_ids(docs, vocabulary)
    assert sorted((r["doc_id"], list(r["ids"])) for r in ids.where("doc_id < 500").collect()) == [(i, [vocabulary.get(w, -1) for w in t]) for i, t in enumerate(texts)]
    df, n = decontam.document_frequencies(ids, size)
    assert n == 202 and df.tolist() == [sum(w in t for t in texts) for w in vocabulary]
    idf = np.log((1.0 + n) / (1.0 + df)) + 0.05
    u = decontam.singular_vectors(ids, items, vocabulary, idf, rank=size)
    a, b = _dense(_passages(texts, vocabulary), idf), _dense([[vocabulary[w] for w in x.words] for x in items], idf)
    values, v = np.linalg.eigh(a.T @ a / len(a) + b.T @ b / len(b))
    values, v = values[::-1], v[:, ::-1]
    assert values[5] > values[-1] * 2
    # The sketch is as wide as the vocabulary here, so the leading space is the exact one.
    assert np.linalg.norm(v[:, :6].T @ u[:, :6].astype(float), 2) > 0.999
    assert np.abs(np.diag(v[:, :3].T @ u[:, :3])).min() > 0.99


def _index(texts, items, rank):
    vocabulary = {w: i for i, w in enumerate(sorted({w for x in items for w in x.words}))}
    df = np.array([sum(w in set(t) for t in texts) for w in vocabulary])
    idf = np.log((1.0 + len(texts)) / (1.0 + df)) + 0.05
    a = _dense(_passages(texts, vocabulary), idf)
    b = _dense([[vocabulary[w] for w in x.words] for x in items], idf)
    _, v = np.linalg.eigh(a.T @ a / len(a) + b.T @ b / len(b))
    return vocabulary, decontam.index_of(items, vocabulary, (v[:, ::-1][:, :rank] * idf[:, None]).astype(np.float32))


@pytest.mark.parametrize("length", [(3, 20), (20, 60), (70, 140)])
def test_search_against_every_window(length):
    rng = np.random.default_rng(3)
    texts = [t for t in _texts(rng, 70, 400, 260)]
    items = [decontam.Item(i, [f"w{x}" for x in rng.integers(0, 400, rng.integers(*length))]) for i in range(20)]
    for d in range(0, 60, 2):
        copy = list(items[d % 20].words)
        for p in rng.choice(len(copy), int(len(copy) * (0, 0.1, 0.18, 0.3)[d // 2 % 4]), replace=False):
            copy[p] = "other"
        at = int(rng.integers(0, len(texts[d]) + 1))
        texts[d] = texts[d][:at] + copy + texts[d][at:]
    texts += [[], items[0].words, items[1].words[:2]]
    vocabulary, index = _index(texts, items, 64)
    got = {(d, i): (share, said) for d, i, _, share, said in decontam.search(index, *_ids(texts, vocabulary))}
    want = {(d, x.item_id): m for d, t in enumerate(texts) for x in items if t and (m := x.matches(t))}
    # What is reported is a match of the whole text, and hardly one is missed by the latent gate.
    assert set(got) <= set(want) and len(want) >= 15
    assert len(set(got) & set(want)) >= 0.9 * len(want)
    # A copy with its answer needs no latent vector: none is missed.
    assert {k for k, m in want.items() if m[1]} <= set(got)
    assert {k for k in got if got[k][0] > want[k][0]} == set()


def test_subsequence_bound_and_answers_by_plain_loops():
    rng = np.random.default_rng(5)
    items = [decontam.Item(i, [f"w{x}" for x in rng.integers(0, 30, n)]) for i, n in enumerate([1, 4, 5, 33, 63, 64])]
    texts = [[f"w{x}" for x in rng.integers(0, 34, n)] for n in (0, 3, 64, 200, 500)] + [items[3].words + items[4].words]
    vocabulary, index = _index(texts, items, 20)
    ids, count = _ids(texts, vocabulary)
    cells, n = decontam._padded(ids, count, decontam.CELL, len(vocabulary))
    begin = (np.cumsum(n) - n) * decontam.CELL
    said = decontam._answers(index, cells.reshape(-1), begin, count)
    want = {}
    for d, t in enumerate(texts):
        for x in items:
            answer = decontam.answer_of(x)
            ends = [p + len(answer) for p in range(len(t) - len(answer) + 1) if t[p:p + len(answer)] == answer]
            if ends:
                want[d, x.item_id] = ends
    assert said == want and (5, 3) in want
    pairs = [(d, x.item_id, p) for d, t in enumerate(texts) for x in items for p in range(0, len(t), 7)]
    lo = np.array([begin[d] + p for d, _, p in pairs])
    hi = np.array([min(begin[d] + p + 192, begin[d] + count[d]) for d, _, p in pairs])
    ok = decontam._may_match(index, cells.reshape(-1), lo, hi, np.array([i for _, i, _ in pairs]), 64)
    slow = [decontam.lcs_length(items[i].masks, len(items[i].words), texts[d][p:p + 192]) >= decontam.LCS_ANSWER * len(items[i].words) for d, i, p in pairs]
    assert ok.tolist() == slow and 0 < sum(slow) < len(slow)
