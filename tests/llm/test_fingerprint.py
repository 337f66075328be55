import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starload.llm import fingerprint as fp
from starload.llm.fingerprint import differences, edit_fingerprints, paragraphs, sketches, version_differences, written


def _digests(text):
    return set(paragraphs(pa.array([text], pa.large_string())).value.tolist())


def _likeness(a, b):
    a, b = _digests(a), _digests(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def _texts(seed, n):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(200)] + ["é", "the", "a"]
    out = ["".join(rng.choice(words) + rng.choice([" ", " ", " ", "\n", "\n\n"]) for _ in range(rng.choice([0, 1, 5, 60, 400]))) for _ in range(n)]
    return out + out[:3] + ["same line\n" * 50, "same line\n" * 48, "", " \n "]


def test_differences_against_sets():
    texts = _texts(5, 60)
    pairs = [(a, b) for a in texts[::3] for b in texts[::4]]
    old, new = (paragraphs(pa.array(list(x), pa.large_string())) for x in zip(*pairs, strict=True))
    got = differences(old, new)
    for i, (a, b) in enumerate(pairs):
        part = lambda d: set(d.value[d.first[i] : d.first[i + 1]].tolist())  # noqa: E731, B023
        assert part(got.removed) == _digests(a) - _digests(b) and part(got.added) == _digests(b) - _digests(a)
        assert got.likeness[i] == pytest.approx(_likeness(a, b))
    assert got.cells.min() == fp.CELLS and got.cells.max() > fp.CELLS  # the small ones came apart at once, the large ones were tried again


def test_differences_that_never_come_apart(monkeypatch):
    monkeypatch.setattr(fp, "TRIES", 1)
    one, none = (paragraphs(pa.array([t], pa.large_string())) for t in ("\n".join(f"line {k}" for k in range(500)), ""))
    with pytest.raises(ValueError, match="do not come apart"):
        differences(one, none)


def test_repeated_paragraphs_count_each():
    assert len(_digests("a b\n" * 7)) == 7 and _digests("a b\n" * 5) < _digests("a b\n" * 7)


def _brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    out = []
    for k, (i, t, _) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        new = t[: len(t) - half] + nxt[:half]
        own, changed = ((written(sketches(paragraphs(pa.array([x], pa.large_string())), np.array([fp.CELLS])))[0]) for x in (t, new))
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), own, changed, round(_likeness(t, new), 9), round(_likeness(t, nxt), 9)))
    return sorted(out, key=str)


def _got(df):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in df.collect()), key=str)


@pytest.mark.parametrize("shuffles", ["1", "7", "40"])
def test_edit_fingerprints_against_brute_force(spark, docs_of, shuffles):
    texts = _texts(8, 50)
    rows = list(zip(random.Random(1).sample(range(-50, 500), len(texts)), texts, strict=True)) + [(1000, None), (None, "no id"), (None, None), (1001, "x " * 40_000), (1002, "x"), (1002, "y y"), (1002, "y y")]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = docs_of(rows)
        hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
        assert _got(edit_fingerprints(docs)) == _brute([tuple(r) for r in hashed])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_edit_fingerprints_small_tables(spark, docs_of):
    assert edit_fingerprints(docs_of([])).count() == 0
    one = edit_fingerprints(docs_of([(3, "abcd")])).collect()
    assert [(r.n_chars, r.edited_sha256, r.near_next) for r in one] == [(4, hashlib.sha256(b"abab").hexdigest(), 1.0)]
    equal = edit_fingerprints(docs_of([(1, "one\ntwo"), (2, "one\ntwo"), (3, "other")])).collect()
    assert len({r.fingerprint for r in equal}) == 2 and {r.near_next for r in equal if r.doc_id == 1} == {1.0}


def test_version_differences_of_given_pairs(spark):
    pairs = spark.createDataFrame([(1, "a\nb\nc", "a\nc\nd", "keep"), (2, None, "", None), (3, "x", None, "k")], "id long, before string, after string, removed string")
    got = {r.id: r for r in version_differences(pairs, "before", "after").collect()}
    u = lambda values: {v & (1 << 64) - 1 for v in values}
    assert u(got[1].removed) == _digests("b") and u(got[1].added) == _digests("d") and got[1].likeness == pytest.approx(0.5)
    assert (got[2].likeness, got[3].likeness, len(got[3].removed)) == (1.0, 0.0, 1)
    assert got[1].before == "a\nb\nc"
