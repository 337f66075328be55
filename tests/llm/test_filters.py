import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starload.llm import decontamination, quality
from starload.llm.decontamination import SHINGLE, Items, Running, leaks, weighted_shingles, weighted_similarity, window_size, without_leaks
from starload.llm.quality import fit, good_documents, score, terms
from starload.llm.words import words_of

ITEMS = "item_id long, text string, doc_id long, similarity string"


def _items(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], ITEMS)


def test_fingerprints_are_bit_majorities():
    h = np.random.default_rng(1).integers(0, 1 << 63, 700, dtype=np.uint64)
    for size in (1, 2, 9, 300):
        got = Running(h).prints(size, 3, 5, 10**9)
        for k, at in enumerate(range(3, 700 - size + 1, 5)):
            bits = [sum(int(x) >> b & 1 for x in h[at : at + size]) * 2 > size for b in range(64)]
            assert int(got[k]) == sum(1 << b for b, on in enumerate(bits) if on)


def test_window_sizes_leave_room_for_the_stride():
    for n in range(1, 400):
        size = window_size(n)
        assert size == n if n < 10 else 0.6 * n <= size <= 0.8 * n


def test_all_fingerprints_within_the_radius_are_found():
    rng = np.random.default_rng(7)
    prints = rng.integers(0, 1 << 63, 50, dtype=np.uint64)
    near = [decontamination._near_values(prints, k) for k in range(4)]
    for _ in range(400):
        i = int(rng.integers(50))
        x = int(prints[i])
        for b in rng.choice(64, decontamination.RADIUS, replace=False):
            x ^= 1 << int(b)
        assert any(i in which[bound[v] : bound[v + 1]] for k, (bound, which) in enumerate(near) for v in [x >> 16 * k & 0xFFFF])


def _corpus():
    rng = random.Random(3)
    own = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    items = [(i, " ".join(own(rng.randrange(12, 60)))) for i in range(40)] + [(90, "just three words"), (91, None), (92, ""), (93, " ".join(own(700)))]
    items += [(94, items[0][1])]
    rows = []
    for i in range(80):
        w = own(rng.randrange(5, 400))
        item = items[rng.randrange(40)][1].split()
        if i % 3 == 0:
            if i % 2:
                item[rng.randrange(len(item))] = "other"
            w += item + own(rng.randrange(50))
        rows.append((i, "  ".join(w).upper() if i % 4 == 0 else "\n".join(w)))
    rows += [(100, "so just THREE words here"), (101, None), (102, ""), (103, " ".join(own(9)) + " " + items[-2][1]), (None, items[1][1]), (0, rows[0][1])]
    return items, rows


def _brute(items, rows, threshold=0.8):
    out = {}
    for k, (_, text) in enumerate(rows):
        d = words_of(pa.array([text or ""], pa.large_string()), lower=True)
        for i, item in items:
            w = words_of(pa.array([item or ""], pa.large_string()), lower=True)
            n = len(w.hash)
            mine = weighted_shingles(w.hash, w.end - w.start) if n else None
            best = max((weighted_similarity(mine, weighted_shingles(d.hash[a : a + n], (d.end - d.start)[a : a + n])) for a in range(len(d.hash) - n + 1)), default=0) if n else 0
            if best >= threshold:
                out[k, i] = best
    return out


@pytest.mark.parametrize("block", [2000, 9])
def test_leaks_against_brute_force(spark, docs_of, block, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_ITEMS", block)
    items, rows = _corpus()
    want = _brute(items, rows)
    assert len(want) > 15
    got = sorted(((r.doc_id, r.item_id, round(r.similarity, 9)) for r in leaks(docs_of(rows), _items(spark, items)).collect()), key=str)
    assert got == sorted(((rows[k][0], i, round(s, 9)) for (k, i), s in want.items()), key=str)
    clean = without_leaks(docs_of(rows), _items(spark, items))
    assert clean.columns == docs_of(rows).columns
    bad = {k for k, _ in want}
    assert sorted((str(r.doc_id) for r in clean.collect())) == sorted(str(r[0]) for k, r in enumerate(rows) if k not in bad)


def test_leaks_empty(spark, docs_of):
    assert leaks(docs_of([]), _items(spark, [(1, "a b c")])).count() == 0
    assert leaks(docs_of([(1, "a b c")]), _items(spark, [])).count() == 0
    assert without_leaks(docs_of([(1, "a b c")]), _items(spark, [])).count() == 1


def test_matches_give_places():
    index = Items([(5, "p q r s t u v w x y z aa bb")])
    text = pa.array(["", "a b p q r s t u v w x y z aa bb c p q r s t u v w x y z aa bb"], pa.large_string())
    assert index.matches(text, 0.8) == [(1, 5, 1.0, 2, 13)]


def test_cut_off_and_changed_copies_are_all_found():
    """Every place of the threshold, windows cut by the text's ends included, whatever the phase of the fingerprints."""
    rng = random.Random(11)
    own = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    items = [(i, " ".join(own(n))) for i, n in enumerate([9, 12, 20, 20, 35, 50, 50, 55, 55, 59] * 4)]
    texts = []
    for k in range(600):
        item = items[k % 40][1].split()
        n = len(item)
        kept = max(SHINGLE, -(-n * (81 + k % 20) // 100))
        if k % 3 == 0:  # cut off by the document's end, or its start
            texts.append(own(rng.randrange(40)) + item[:kept] if k % 2 else item[n - kept :] + own(rng.randrange(40)))
        elif k % 3 == 1:  # nothing but a cut-off item
            texts.append(item[:kept] if k % 2 else item[n - kept :])
        else:  # a changed word, a lost one or one more, anywhere
            at = rng.randrange(n)
            item[at : at + rng.randrange(2)] = own(rng.randrange(2))
            texts.append(own(rng.randrange(60)) + item + own(rng.randrange(60)))
    want = set()
    ws = [words_of(pa.array([i], pa.large_string()), lower=True) for _, i in items]
    mine = [weighted_shingles(w.hash, w.end - w.start) for w in ws]
    for k, t in enumerate(texts):
        d = words_of(pa.array([" ".join(t)], pa.large_string()), lower=True)
        i, n = k % 40, len(ws[k % 40].hash)
        spans = {(max(0, a), min(len(t), a + n)) for a in range(1 - n, len(t))}
        if any(weighted_similarity(mine[i], weighted_shingles(d.hash[a:b], (d.end - d.start)[a:b])) >= 0.8 for a, b in spans):
            want.add((k, i))
    assert len(want) > 300
    found = {m[:2] for m in Items(items).matches(pa.array([" ".join(t) for t in texts], pa.large_string()), 0.8)}
    assert found == want


LABELS = "doc_id long, quality int, toxic int, label string"


def test_quality_on_the_held_out_fold(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    out = score(docs, fit(docs, labels))
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == docs.count()
    held = [(got[r.doc_id], r.quality) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(g.held_out and 0 <= g.score <= 1 and g.predicted == (g.score >= 0.7) for g, _ in held)
    assert np.mean([g.predicted == y for g, y in held]) > 0.97
    assert np.mean([g.predicted for g, y in held if y == 1]) > 0.99


def _toy():
    good = [(i, f"The old mill number {i} stood by the river, and nobody went there after dark any more.") for i in range(40)]
    bad = [(100 + i, f"BUY!! NOW!! {i} *** $$$ CHEAP!! ###") for i in range(40)]
    return good + bad, [(i, 1, 0, "x") for i, _ in good] + [(i, 0, 0, "x") for i, _ in bad]


def test_quality_odd_rows(spark, docs_of):
    rows, labels = _toy()
    labelled = spark.createDataFrame([*labels, (1, None, None, "x"), (None, 1, 0, "x"), (3, 1, 1, "x")], LABELS)
    model = fit(docs_of(rows), labelled)
    share = model.share
    odd = [(None, "The new mill stood by the sea, and nobody went there."), (7, None), (7, ""), (7, "WIN!! $$$ NOW!!"), (7, "The mill " * 40_000)]
    got = score(docs_of(odd), model).collect()
    assert [round(r.score, 6) for r in got[1:3]] == [round(share, 6)] * 2
    assert got[0].predicted == 1 and got[0].held_out is False and got[3].predicted == 0
    kept = good_documents(docs_of(odd), model, least=0.7)
    assert kept.columns == docs_of(odd).columns
    assert sum(r.text == odd[3][1] for r in kept.collect()) == 0
    none = fit(docs_of(rows), spark.createDataFrame([], LABELS))
    assert {r.score for r in score(docs_of(odd), none).collect()} == {0.5}
    assert score(docs_of([]), model).count() == 0
    assert fit(docs_of([]), labelled).share == 0.5


def test_documents_without_evidence_stay(spark, docs_of):
    rows, labels = _toy()
    none = fit(docs_of(rows), spark.createDataFrame([], LABELS))
    assert good_documents(docs_of(rows), none).count() == len(rows)
    bad = fit(docs_of(rows), spark.createDataFrame([(i, 0, t, x) for i, _, t, x in labels], LABELS))
    assert bad.share == 0.0
    assert sorted(str(r.text) for r in good_documents(docs_of([*rows[:4], (7, None), (8, "")]), bad).collect()) == ["", "None"]


def test_held_out_labels_are_not_learnt(spark, docs_of):
    rows, labels = _toy()
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q, t, x) for i, q, t, x in labels]
    one = fit(docs_of(rows), spark.createDataFrame(labels, LABELS))
    two = fit(docs_of(rows), spark.createDataFrame(turned, LABELS))
    assert (one.labels == two.labels).all() and np.allclose(one.axes, two.axes)


def test_terms_of_an_array_slice():
    text = pa.array(["x", "Some text 12", ""], pa.large_string())
    assert (terms(text.slice(1)) == terms(pa.array(["Some text 12", ""], pa.large_string()))).all()


def test_held_out_fold_is_the_checksum(spark):
    rows = spark.range(300).select(F.col("id").alias("doc_id"))
    for r in rows.select("doc_id", quality.held_out().alias("h")).collect():
        assert r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
