import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starload.llm.tokens import encoder, vocabulary_path

DOC = "doc_id long, text string, lang string, source string, n_chars long, text_hash string, `group` int"


def _prose(rng, n):
    out = []
    for k in range(n):
        w = "".join(rng.choice(["ta", "re", "min", "ol", "da", "su", "ke", "vi"]) for _ in range(rng.randrange(1, 4)))
        out.append(w.capitalize() if k % 9 == 0 else w + ("." if k % 9 == 8 else ""))
    return out


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(4)
    good = [_prose(rng, rng.randrange(60, 200)) for _ in range(60)]
    passage, item = _prose(rng, 60), _prose(rng, 40)
    for i in (3, 9, 20):
        good[i] = good[i][:20] + [f"Before{i}"] + passage + [f"After{i}"] + good[i][20:]
    good[15] = good[15][:30] + item + good[15][30:]
    near = [" ".join(good[30][:-1] + ["other"]), " ".join(good[30])]
    junk = [" ".join(w.upper() + rng.choice(["!!", "***", "$$$"]) for w in _prose(rng, 80)) for _ in range(60)]
    texts = [" ".join(g) for g in good] + junk + near
    rows = [(i, t, "en", "s", len(t), "x", 1) for i, t in enumerate(texts)]
    rows += [(rows[40][0], rows[40][1], "en", "s", 5, "x", 1), (500, None, None, None, None, None, None), (501, "", "en", "s", 0, "x", 1), (None, " ".join(_prose(rng, 90)), None, None, 7, None, None)]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, DOC).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(60)] + [(i, 0, 0) for i in range(60, 78)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item)), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, {"passage": passage, "item": item}


def test_stages(spark, corpus):
    path, rows, parts = corpus
    text = {r[0]: r[1] for r in rows}
    docs = spark.read.parquet(f"{path}/documents.parquet")
    after = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(f"{path}/stage-{name}")
        docs = spark.read.parquet(f"{path}/stage-{name}")
        after[name] = docs.collect()
    ids = lambda name: sorted((r.doc_id for r in after[name]), key=str)
    good = [*range(60), 40, 120, 121]
    assert set(ids("quality")) == {*good, 500, 501, None} and len(ids("quality")) == len(good) + 3
    assert ids("near_duplicates") == sorted([*range(60), 500, 501, None], key=str)
    cut = {r.doc_id: r for r in after["repeated_passages"]}
    assert set(cut) == {*range(60), 500, 501, None}
    for i, r in cut.items():
        if i in (3, 9, 20):
            w = text[i].split()
            assert r.text == " ".join(w[:21] + w[81:]) and r.n_chars == len(r.text)
        else:
            assert r.text == text[i] and (i is None or i == 40 or r.n_chars == (None if text[i] is None else len(text[i])))
    assert ids("benchmark_leaks") == sorted([i for i in cut if i != 15], key=str)
    pieces = corpus_pipeline.packing(spark, docs, path)
    e = encoder(vocabulary_path())
    want = sum(len(e.encode([r.text or ""])[0]) // 4 + 1 for r in after["benchmark_leaks"])
    assert pieces.agg(F.sum("length")).first()[0] == want
    assert corpus_pipeline.run(spark, path).agg(F.sum("length")).first()[0] == want


def test_stages_of_an_empty_table(spark, corpus):
    path, _, _ = corpus
    docs = spark.createDataFrame([], DOC)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
        assert docs.count() == 0


def test_stage_order_and_sql():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_passages", "benchmark_leaks", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None
