import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from starload.llm import prefix_trie as trie
from starload.llm.prefix_trie import SlotTable, prefix_trie

COLUMNS = "conv_id long, turn long, role string, text string, depth long, n long, owner string, x1 string"


def _table(spark, rows):
    return spark.createDataFrame([(c, k, r, t, 9, 9, "x", "x") for c, k, r, t in rows], COLUMNS)


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [x[1:] for x in sorted(v)] for c, v in own.items()}
    nodes, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        seq = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
        ends[seq].append(c)
        for d in range(len(seq) + 1):
            nodes[seq[:d]].append(c)
    children = defaultdict(list)
    for node in nodes:
        if node:
            children[node[:-1]].append(node)
    out = {}
    for node in sorted(nodes, key=len, reverse=True):
        leaves = sum(out[k]["n_leaves"] for k in children[node]) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        saved = (len(nodes[node]) - 1) * words + sum(out[k]["saved_tokens"] for k in children[node])
        out[node] = {
            "conv_id": min(nodes[node]), "depth": len(node), "parent_conv_id": min(nodes[node[:-1]]) if node else None, "n_convs": len(nodes[node]),
            "n_children": len(children[node]), "n_leaves": leaves, "saved_tokens": saved, "ends_sha256": hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        }
    return sorted(out.values(), key=str)


def _got(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(({n: r[n] for n in names} for r in df.collect()), key=str)


def _random_rows(seed, convs=60, longest=9):
    rng = random.Random(seed)
    openings = [[("user", "hello there"), ("assistant", "how can I help"), ("user", "a b  c\td"), (None, None)], [("user", "x"), ("user", "x")]]
    rows = []
    for c in rng.sample(range(2 * convs), convs):
        turns = list(rng.choice(openings))[: rng.randrange(5)] if rng.random() < 0.7 else []
        turns += [(rng.choice(["user", "assistant", None]), rng.choice(["yes", "no thanks", "", None, "one two three"])) for _ in range(rng.randrange(longest))]
        rows += [(c, k, r, t) for k, (r, t) in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("shard", "block"), [(65_536, 65_536), (12, 3), (0, 2)])
def test_trie_against_brute_force(spark, shard, block, monkeypatch):
    # the small bounds cut the trie in its middle or put all of it in the top, and let running values cross blocks
    monkeypatch.setattr(trie, "SHARD", shard)
    monkeypatch.setattr(trie, "BLOCK", block)
    rows = _random_rows(shard + block)
    assert _got(prefix_trie(_table(spark, rows))) == brute(rows)


def test_trie_odd_rows(spark):
    long = "w " * 50_000
    rows = [(20, None, "user", "first"), (20, 1, "user", "second"), (21, 0, None, None), (22, 5, "a", "bc"), (23, 5, "ab", "c"), (None, 1, "user", "nobody"), (40, 1, "u", long), (61, 0, "u", "x"), (-5, 0, "u", "y")]
    assert _got(prefix_trie(_table(spark, rows))) == brute([r for r in rows if r[0] != -5] + [(-5, 0, "u", "y")])
    assert prefix_trie(_table(spark, [])).count() == 0 and prefix_trie(_table(spark, [(None, 1, "u", "x")])).count() == 0


def test_trie_copies_of_one_conversation(spark):
    rows = [(c, k, "user", f"turn {k}") for c in range(300) for k in range(4)]
    assert _got(prefix_trie(_table(spark, rows))) == brute(rows)


def test_trie_turnless_conversations(spark):
    """A conversation with fewer turns than are taken from a family's absent first is turnless, and only the root's member."""
    rows = [(c, 0, "user", f"t{c}") for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4]
    got = _got(prefix_trie(_table(spark, rows)))
    assert got == brute(rows) and len(got) == 1 and got[0]["n_leaves"] == 1


def test_slots_are_minimal_and_perfect():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 5000):
        keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        assert sorted(SlotTable(keys).slots(keys).tolist()) == list(range(len(keys)))
