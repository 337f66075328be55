import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starload.llm import rans, token_counts
from starload.llm.packing import first_fit_decreasing, pack, padding
from starload.llm.token_file import read_tokens, write_tokens
from starload.llm.tokens import Cache, encoder, vocabulary_path

ODD = [
    "", " ", "  ", "a  b\n\n c\t d 　x\xa0 y", "  lead", "trail  ", "\x1c!\x1c a", "it's I'll 'tis", "a\r\n b\x85c", "\n\n\nx", "<|endoftext|> x",
    "123 45,6 %%% é", "don't-stop", "naïve—x", "x²y", "aб", "straße,###", "a1b2", "!'s", "a\n", "\nb c", "x​y z﻿ q\x00",
]


def _plain(text):
    e = encoder(vocabulary_path())
    return e.tokenizer.encode(text, add_special_tokens=False).ids


def _ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_units_give_the_ids_of_whole_texts():
    e = encoder(vocabulary_path())
    for t in ODD:
        assert _ids(e.encode([t])[0]) == _plain(t), repr(t)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abtsre' \n\t\xa0 1#.é́", max_size=30))
def test_units_on_random_texts(text):
    assert _ids(encoder(vocabulary_path()).encode([text])[0]) == _plain(text)


def test_cache_generations():
    made = []
    c = Cache(lambda k: made.append(k) or k.encode(), 2)
    for k in "abc":
        assert c[k] == k.encode()
    c.turn()
    assert not c and c["a"] == b"a" and made == ["a", "b", "c"]


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab s'\n1#", max_size=40), st.lists(st.tuples(st.integers(0, 45), st.integers(0, 9), st.text(alphabet="a s'\n1", max_size=5)), max_size=5))
def test_tree_edits_equal_a_new_tree(text, edits):
    e = encoder(vocabulary_path())
    tree = token_counts.Tree(text, e)
    for at, gone, new in edits:
        tree.edit(at, gone, new)
    fresh = token_counts.Tree(tree.text, e)
    assert tree.total == len(_plain(tree.text)) and tree.chars[1] == len(tree.text)
    assert [x for c in tree.chunks for x in c] == [x for c in fresh.chunks for x in c]


@pytest.mark.parametrize(
    "text, edit",
    [("we'r here", (4, 0, "e")), ("we'v here", (4, 0, "e")), ("we'l here", (4, 0, "l")), ("we'rxxe here", (4, 2, "")), ("we're here", (4, 1, "")), ("a   x", (4, 0, " ")), ("a   x", (4, 1, " "))],
)
def test_edits_two_characters_behind_a_boundary(text, edit):
    e = encoder(vocabulary_path())
    tree = token_counts.Tree(text, e)
    tree.edit(*edit)
    fresh = token_counts.Tree(tree.text, e)
    assert [x for c in tree.chunks for x in c] == [x for c in fresh.chunks for x in c]


def test_an_edit_encodes_a_few_leaves_only():
    tree = token_counts.Tree("some words here and " * 2000, encoder(vocabulary_path()))
    tree.edit(20_000, 3, "xyz")
    assert tree.encoded < 12 and tree.leaves > 7000


def test_edited_counts(spark, docs_of):
    rows = [(1, "one two"), (1, "one two"), (None, "x y"), (2, None), (3, ""), (4, "word " * 5000)]
    edits = spark.createDataFrame([(1, 1, 3, 0, " and"), (1, 2, 0, 99, ""), (None, 1, 0, 1, "z"), (3, 1, 5, 5, "new text"), (4, 1, 700, 10, None)], "doc_id long, number int, position long, removed long, inserted string")
    got = token_counts.edited_counts(token_counts.with_edits(docs_of(rows), edits)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = {1: "", None: "z y", 2: "", 3: "new text", 4: ("word " * 5000)[:700] + ("word " * 5000)[710:]}[r.doc_id]
        assert (r.n_tokens_edited, r.n_chars_edited) == (len(_plain(want)), len(want))
    assert token_counts.edited_counts(token_counts.with_edits(docs_of([]), edits)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 65_536, 70_000])
def test_rans_round_trip(n):
    ids = np.minimum(np.random.default_rng(n).zipf(1.3, n), 50_256).astype(np.uint32)
    image = rans.encode(ids, [None, 7], np.array([n // 2, n - n // 2]))
    back = rans.decode(image)
    assert (back.ids == ids).all() and back.doc_ids == [None, 7] and back.lengths.tolist() == [n // 2, n - n // 2]
    if n > 1:
        damaged = bytearray(image)
        damaged[-5] ^= 1
        with pytest.raises(ValueError):
            rans.decode(bytes(damaged))


ROWS = [(5, "b c"), (3, None), (4, ""), (None, "null id"), (9, "long " * 3000), (5, "b c"), (1, "a")]


def test_token_files(spark, docs_of, workdir):
    write_tokens(docs_of(ROWS), f"{workdir}/t", image_ids=50)
    got = read_tokens(spark, f"{workdir}/t").orderBy("start").collect()
    ordered = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [r[0] for r in ordered]
    start = 0
    for r, (_, text) in zip(got, ordered, strict=True):
        ids = np.array([*_plain(text or ""), 2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    write_tokens(docs_of([]), f"{workdir}/e")
    assert read_tokens(spark, f"{workdir}/e").count() == 0


def test_first_fit_decreasing_against_brute_force():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 50, 300):
        sizes = rng.integers(1, 101, n)
        where, offset = first_fit_decreasing(sizes, 100)
        bins = []
        for i in np.argsort(-sizes, kind="stable"):
            k = next((b for b, used in enumerate(bins) if used + sizes[i] <= 100), len(bins))
            if k == len(bins):
                bins.append(0)
            assert (where[i], offset[i]) == (k, bins[k])
            bins[k] += sizes[i]


def test_pack(spark, docs_of):
    pieces = pack(docs_of(ROWS), capacity=64, group_docs=3)
    got = pieces.collect()
    by_sequence, by_doc = {}, {}
    for p in got:
        by_sequence.setdefault(p.sequence_id, []).append(p)
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 64
    assert sum(p.length for p in got) == sum(len(_plain(t or "")) + 1 for _, t in ROWS)
    long = sorted((p.start, p.length, p.ids_crc32) for p in by_doc[9, len(_plain("long " * 3000)) + 1])
    ids = np.array([*_plain("long " * 3000), 0], "<u4")
    assert long == [(s, len(ids[s : s + 64]), zlib.crc32(ids[s : s + 64].tobytes())) for s in range(0, len(ids), 64)]
    assert len(by_doc[5, 3]) == 2  # a repeated row is packed twice
    assert pack(docs_of([])).count() == 0


def test_packing_leaves_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pieces = pack(docs)
    assert padding(pieces).first().padding < 0.02
    assert pieces.agg(F.sum("length")).first()[0] == sum(len(_plain(r.text)) + 1 for r in docs.collect())


def test_words_of_letters_and_a_mark_equal_the_library():
    e = encoder(vocabulary_path())
    for word in ["word", "word.", "Straße,", "ñandú!", "it's", "a1", "a..", "'s", "x\ny", "ʯ-", "б.", "ab²", "z'"]:
        assert _ids(e.words[word]) == _plain(" " + word), word


def test_reading_token_files_leaves_the_session_as_it_was(spark, workdir):
    write_tokens(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"), f"{workdir}/s")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert read_tokens(spark, f"{workdir}/s").count() == 2
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
