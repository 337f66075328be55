import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs_of(spark):
    """Documents of (doc_id, text) pairs, with an extra column that clashes with working names."""

    def make(rows):
        out = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOC)
        clash = {c: "x" for c in ("text_hash", "key", "segment", "root", "digest", "score", "group", "row", "marks")}
        from pyspark.sql import functions as F

        return out.withColumns({c: F.lit(v) for c, v in clash.items()})

    return make


def words(text):
    return (text or "").encode().split()
