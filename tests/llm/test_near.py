import random

import numpy as np
import pyarrow as pa
import pytest

from starload.llm import near_dup, setsketch
from starload.llm.components import connected
from starload.llm.near_dup import near_duplicates, one_of_each
from starload.llm.vector_dup import near_vectors
from starload.llm.words import shingle_sets, words_of


def _components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_components_against_union_find(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(300, 360)] + [(0, i) for i in range(100)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    want = _components(361, links)
    assert all(got.get(i, i) == want[i] for i in range(361))
    assert connected(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_sketch_registers_estimate_and_merge():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 63, 800, dtype=np.uint64)
    for share in (0.5, 0.85, 1.0):
        b = np.concatenate([a[: int(800 * share)], rng.integers(0, 1 << 63, 800 - int(800 * share), dtype=np.uint64)])
        r = setsketch.sketch([np.unique(a), np.unique(b), np.unique(np.concatenate([a, b]))])
        assert (setsketch.merge(r[0], r[1]) == r[2]).all()
        want = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        got = setsketch.similarity(r[:1], r[1:2], np.array([800.0]), np.array([800.0]))[0]
        assert abs(got - want) < 0.16
    small = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (1, 2, 9)]
    r = setsketch.sketch([*small, np.zeros(0, np.uint64)])
    assert (r[:3] > 0).all() and not r[3].any()


def _near_copies(rng, groups, copies, length, edits):
    out = []
    for g in range(groups):
        base = [f"w{g}x{rng.randrange(5000)}" for _ in range(length)]
        out.append(" ".join(base))
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randrange(edits + 1)):
                w[rng.randrange(length)] = f"n{rng.randrange(10**6)}"
            out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("percent", "chunk"), [(85, 1024), (80, 16)])
def test_near_duplicates_against_brute_force(spark, docs_of, percent, chunk, monkeypatch):
    monkeypatch.setattr(near_dup, "CHUNK", chunk)
    rng = random.Random(9)
    texts = _near_copies(rng, 6, 45, 120, 5) + ["same text here", "Same TEXT here", "", None, "  \n", "same text here", "a b c d e", "a b c d e f"]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = list(zip(ids, texts, strict=True))
    sets = shingle_sets(words_of(pa.array([t or "" for t in texts], pa.large_string()), lower=True), 5)
    links = []
    for i in range(len(texts)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                links.append((ids[i], ids[j]))
    want = _components(len(texts), links)
    got = {r.doc_id: r for r in near_duplicates(docs_of(rows), percent=percent).collect()}
    assert len(got) == len(rows)
    for k, i in enumerate(ids):
        assert (got[i].component_id, got[i].n_shingles, got[i].kept) == (want[i], len(sets[k]), want[i] == i)


def test_near_duplicates_odd_rows(spark, docs_of):
    rows = [(7, "one two three four five six"), (7, "one two three four five six"), (None, "One two three four five six"), (7, "another text"), (None, "alone"), (None, None)]
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs_of(rows)).collect()), key=str)
    assert got == sorted([(7, 7, True), (7, 7, True), (None, 7, False), (7, 7, True), (None, None, True), (None, None, True)], key=str)
    kept = one_of_each(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(7, rows[0][1]), (7, "another text"), (None, "alone"), (None, None)], key=str)
    assert near_duplicates(docs_of([])).count() == 0 and one_of_each(docs_of([])).count() == 0


VECTORS = "vec_id long, embedding array<float>, label int, links string, root long"


def _vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0, "x", 1) for i, v in rows], VECTORS)


def _brute_vectors(x, threshold=0.9):
    y = x / np.linalg.norm(x, axis=1)[:, None]
    near = y @ y.T >= threshold
    np.fill_diagonal(near, False)
    return near


def test_vectors_odd_rows(spark):
    rows = [(4, [1, 0]), (2, [2, 0]), (2, [2, 0]), (9, [0, 1]), (5, None), (6, [0, 0]), (7, [1, None]), (8, [1, float("nan")]), (10, [1, float("inf")]), (11, [1, 0, 0]), (12, []), (None, [1, 0.01])]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in near_vectors(_vectors(spark, rows)).collect()), key=str)
    alone = [(i, 0, i, True) for i in (9, 5, 6, 7, 8, 10, 11, 12)]
    assert got == sorted([(4, 3, 2, False), (2, 3, 2, True), (2, 3, 2, True), (None, 3, 2, False), *alone], key=str)
    assert near_vectors(_vectors(spark, [])).count() == 0


@pytest.mark.parametrize("chunk", [1024, 32])
def test_vector_recall_against_brute_force(spark, chunk, monkeypatch):
    """Pairs from 0.9 up, spread over all similarities: no false link, at least nine tenths of the links found."""
    from starload.llm import vector_dup

    monkeypatch.setattr(vector_dup, "CHUNK", chunk)
    rng = np.random.default_rng(11)
    base = rng.standard_normal((700, 64))
    base /= np.linalg.norm(base, axis=1)[:, None]
    noise = rng.standard_normal((500, 64))
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    cos = rng.uniform(0.85, 1.0, (500, 1))
    close = cos * base[:500] + np.sqrt(1 - cos**2) * noise
    crowd = base[0] + 0.02 * rng.standard_normal((150, 64))
    x = np.concatenate([base, close, crowd]).astype(np.float32).astype(np.float64)
    near = _brute_vectors(x)
    got = {r.vec_id: r for r in near_vectors(_vectors(spark, list(enumerate(x.tolist())))).collect()}
    want = near.sum(axis=1)
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= want).all() and found.sum() >= 0.9 * want.sum()
    single = slice(0, 1200)
    assert found[single].sum() >= 0.9 * want[single].sum()
    roots = _components(len(x), np.argwhere(near).tolist())
    assert np.mean([got[i].component_id == roots[i] for i in range(len(x))]) > 0.9
