import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from starload.llm import substring_dedup
from starload.llm.fm_index import FMIndex, repeated_windows, suffixes
from starload.llm.substring_dedup import remove_repeats


def test_suffix_order():
    s = np.array([2, 1, 2, 1, 3, 0, 1, 2, 0])
    order = suffixes(s)
    assert [s[i:].tolist() for i in order] == sorted(s[i:].tolist() for i in range(len(s)))


def test_segments_longer_than_the_sorted_depth(monkeypatch):
    """Segments of windows of 70 words have up to 132 words; those here are alike for longer than the least depth."""
    rng = np.random.default_rng(5)
    one = [f"w{i}" for i in rng.integers(2, size=100)]
    texts = [one + [f"x{i}"] + one[:75] for i in rng.permutation(12)] + [[f"y{i}", *one[1:]] for i in range(4)]
    depths = []

    class Seen(FMIndex):
        def __init__(self, symbols, size, depth):
            order = suffixes(symbols, depth)
            want = sorted(tuple(symbols[i : i + 132].tolist()) for i in range(len(symbols)))
            depths.append([tuple(symbols[i : i + 132].tolist()) for i in order] == want)
            super().__init__(symbols, size, depth)

    monkeypatch.setattr(substring_dedup, "FMIndex", Seen)
    rows = [t[a : a + 132] for t in texts for a in (0, 20)]
    batch = pa.record_batch({"key": pa.array([7] * len(rows)), "segment": pa.array(range(len(rows))), "copies": pa.array([1] * len(rows)), "hot": pa.array([False] * len(rows)), "words": pa.array([" ".join(r).encode() for r in rows], pa.binary())})
    got = np.concatenate([b.column("mask").to_numpy() for b in substring_dedup._search(70)(iter([batch]))]).view(np.uint64)
    count = Counter(tuple(r[i : i + 70]) for r in rows for i in range(len(r) - 69))
    assert depths == [True]
    assert got.tolist() == [sum(1 << i for i in range(len(r) - 69) if count[tuple(r[i : i + 70])] > 1) for r in rows]


def test_repeated_windows_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(60):
        size, top = int(rng.integers(2, 9)), int(rng.integers(2, 6))
        pool = [rng.integers(1, top, rng.integers(1, 20)).tolist() for _ in range(4)]
        parts = [sum((pool[rng.integers(4)] for _ in range(rng.integers(1, 4))), []) for _ in range(rng.integers(1, 9))]
        symbols, start, stop = [], [], []
        for p in parts:
            start.append(len(symbols))
            symbols += p
            stop.append(len(symbols))
            symbols.append(0)
        s = np.array(symbols, np.int64)
        count = Counter(tuple(s[i : i + size]) for a, b in zip(start, stop, strict=True) for i in range(a, b - size + 1))
        want = np.zeros(len(s), bool)
        for a, b in zip(start, stop, strict=True):
            for i in range(a, b - size + 1):
                want[i] = count[tuple(s[i : i + size])] > 1
        got = repeated_windows(FMIndex(s, top + 1), s, np.array(start), np.array(stop), size, probe=int(rng.integers(1, 5)))
        assert (got == want).all()


def _brute(rows, size):
    count = Counter()
    for _, t in rows:
        w = (t or "").encode().split()
        count.update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if count[tuple(w[k : k + size])] > 1:
                gone[k : k + size] = [True] * size
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest(), (kept.decode() if any(gone) else (t or ""))))
    return out


def _corpus():
    rng = random.Random(2)
    word = lambda: f"w{rng.randrange(10**6)}"
    own = lambda n: [word() for _ in range(n)]
    passages = [own(n) for n in (12, 13, 40, 90)]
    rows = []
    for i in range(120):
        w = own(rng.randrange(40))
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p) // 2)
            w += p[a : a + rng.randrange(8, len(p))] + own(rng.randrange(30))
        rows.append((i, " ".join(w)))
    rows += [(200, "same " * 80), (201, "a b c " * 30), (202, None), (203, ""), (204, "  \n\t "), (None, "x " + " ".join(passages[2])), (205, " ".join(own(70))), (205, " ".join(own(70)))]
    rows += [(206, rows[0][1] + " tail"), (207, " ".join(own(30_000)))]
    return rows + [rows[-1], rows[3], (300, rows[3][1])]


@pytest.mark.parametrize(("size", "part", "most"), [(12, 16_384, 50_000), (12, 8, 50_000), (12, 16_384, 2), (35, 16_384, 50_000)])
def test_remove_repeats_against_brute_force(spark, docs_of, size, part, most, monkeypatch):
    """With large and with tiny index parts, and with nearly all minimizers too frequent for one."""
    monkeypatch.setattr(substring_dedup, "PART_ROWS", part)
    monkeypatch.setattr(substring_dedup, "MOST", most)
    rows = _corpus()
    got = remove_repeats(docs_of(rows), size=size).collect()
    want = _brute(rows, size)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in got), key=str) == sorted(want, key=str)
    for r in got:
        assert sum(s.length for s in r.removed) == r.n_removed


def test_remove_repeats_empty_and_carry(spark, docs_of):
    assert remove_repeats(docs_of([])).count() == 0
    got = remove_repeats(docs_of([(1, "a b"), (1, "a b")]), carry=True).collect()
    assert [(r.doc_id, r.document.lang, r.document.marks, r.kept_text) for r in got] == [(1, "en", "x", "a b")] * 2
    with pytest.raises(ValueError, match="size"):
        remove_repeats(docs_of([]), size=3)
