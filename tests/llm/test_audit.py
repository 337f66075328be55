import random
import re
from collections import Counter
from itertools import permutations

import pytest

from starload.llm.filter_audit import audit

DOC = "doc_id long, text string, lang string, hash string, failed string, part string, rows string, good string"
LABEL = "doc_id long, quality int, toxic int, part string"


def brute(docs, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    fails = []
    for i, t, lang in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {"A"} if len(words) < 200 else set()
        f |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        f |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t) else set()
        f |= {"D"} if re.search("[#$%&*|]", t) else set()
        f |= {"E"} if i is not None and least[t] < i else set()
        fails.append((lang or "", f, i in good and i is not None, i in toxic and i is not None))
    out = {}
    shapley = Counter()
    for part in {f[0] for f in fails}:
        here = [f for f in fails if f[0] == part]
        for order in permutations("ABCDE"):
            for step, name in enumerate(order):
                gone = [bool(f[1] & set(order[:step])) for f in here]
                hit = [name in f[1] for f in here]
                removed = [f for f, g, h in zip(here, gone, hit, strict=True) if h and not g]
                shapley[part, name] += len(removed)
                out[part, "".join(order), step + 1] = [
                    sum(not g and not h for g, h in zip(gone, hit, strict=True)), len(removed), sum(g and h for g, h in zip(gone, hit, strict=True)),
                    sum(f[1] == {name} for f in here), sum(f[2] for f in removed), sum(f[3] for f in removed),
                ]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def _got(spark, docs, labels):
    d = spark.createDataFrame([(i, t, lang, "x", "x", "x", "x", "x") for i, t, lang in docs], DOC)
    rows = audit(d, spark.createDataFrame([(*x, "x") for x in labels], LABEL)).collect()
    assert len({(r.part, r.filter_order, r.step) for r in rows}) == len(rows)
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows}


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_against_brute_force(spark, seed):
    rng = random.Random(seed)
    texts = [" ".join(rng.choice(["aa", "Bb", "C", "d#", f"w{rng.randrange(400)}"]) for _ in range(rng.choice([3, 150, 200, 260]))) for _ in range(25)]
    texts += [" ".join(f"w{k}" for k in range(n)) + tail for n in (199, 200) for tail in ("", " ", "\n&", " ABCDEFGHIJ" * 6)] + ["é" * 97 + "ABC", "é" * 96 + "ABCD", "\x0b \t", "", None]
    docs = [(i, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in rng.sample(range(400), 150)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i, _, _ in docs if rng.random() < 0.6] + [(9999, 1, 1)]
    assert _got(spark, docs, labels) == brute(docs, labels)


def test_audit_odd_rows(spark):
    long = "word " * 100_000 + "end"
    docs = [(5, "same", "en"), (5, "same", "en"), (5, "same", "de"), (3, "same", "de"), (None, "same", "en"), (None, None, "en"), (7, "", None), (8, None, ""), (9, long, "en"), (10, long, "en"), (11, "same", "fr")]
    labels = [(5, 0, 0), (5, 1, None), (None, 1, 1), (10, 1, 1), (10, 1, 1), (8, None, 1)]
    assert _got(spark, docs, labels) == brute(docs, labels)
    assert _got(spark, [], labels) == {} and _got(spark, docs, []) == brute(docs, [])
