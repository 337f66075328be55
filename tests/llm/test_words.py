import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from starload.llm.words import shingle_sets, windows, words_of

TEXT = st.text(alphabet="ab AB\t\n\x0b\r\xa0é\x00", max_size=60)


@settings(max_examples=80, deadline=None)
@given(st.lists(TEXT, max_size=8))
def test_words_are_runs_of_other_bytes(texts):
    w = words_of(pa.array(texts, pa.large_string()), lower=True)
    want = [[x.encode() for x in re.findall(r"[^\x20\x09-\x0D]+", t)] for t in texts]
    got = [w.text(a, b) for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
    assert got == want
    flat = [re.sub(b"[A-Z]", lambda m: m[0].lower(), x) for row in want for x in row]
    seen = {}
    for word, h in zip(flat, w.hash.tolist(), strict=True):
        assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, max_size=5))
def test_shingle_sets(texts):
    sets = shingle_sets(words_of(pa.array(texts, pa.large_string())), 3)
    for t, s in zip(texts, sets, strict=True):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        want = {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())
        assert len(s) == len(want) and (np.diff(s.astype(object)) > 0).all()


def test_a_slice_of_an_array_and_long_texts():
    texts = ["zz yy"] + ["ab cd " * 300_000] + ["ab cd"]
    w = words_of(pa.array(texts, pa.large_string()).slice(1))
    assert w.first.tolist() == [0, 600_000, 600_002]
    assert w.hash[0] == w.hash[-2] and w.hash[1] == w.hash[-1]
    pairs = windows(w.hash, 2)
    assert pairs[0] == pairs[-1] == pairs[2]
