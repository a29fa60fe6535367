"""The prefix trie against a plain version, and its contraction on chains, stars and random trees."""

import brute
import numpy as np
import pytest
from odd_rows import as_set
from pyspark.sql import functions as F

from runtrail.llm import trie
from runtrail.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, k1 long, conv string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def odd_turns():
    rows = []
    for conv in [0, 1, 2, 3, 7, 100, 101, 117, 250, 251, -5, -120, 900]:
        n = abs(conv) % 7 + (conv % 3)
        rows += [(conv, t, "user" if t % 2 else "assistant", f"text {t} of {conv // 100}") for t in range(n)]
    rows += [(300 + i, t, "user", f"same {t}") for i in range(40) for t in range(4)]  # copies
    rows += [(400, t, "user", "long " * (t % 5)) for t in range(700)]  # one long conversation
    rows += [(401, t, "user", "same text")  for t in range(0, 12)] + [(500, 5, "user", "tie")] * 9  # ties, repeated rows
    rows += [(600, None, "system", "null turn"), (600, 1, None, "no role"), (600, 2, "user", None), (601, 0, "", ""), (601, 1, None, None)]
    rows += [(None, 1, "user", "of no conversation"), (700, 1, "ab", "c"), (701, 1, "a", "bc"), (800, 0, "user", "é😀" * 50000)]
    return rows


def query(frame):
    turns = trie.ordered_turns(frame)
    conv = F.col("conv")
    return trie.prefix_trie(*trie.rebuilt_turns(turns, conv - conv % 100, F.crc32(conv.cast("string").cast("binary")) % 6, 5))


def test_trie_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_IDS", 7)
    rows = odd_turns()
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    assert as_set(query(frame), *COLUMNS) == sorted(brute.trie(brute.rebuilt(rows)), key=str)
    assert query(frame.limit(0)).count() == 0


def test_query_equals_the_plain_version(spark):
    found = QUERIES["op11_prefix_trie"](spark, SMALL)
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert as_set(found, *COLUMNS) == sorted(brute.trie(brute.rebuilt(rows)), key=str)


@pytest.mark.parametrize("shape", ["chain", "star", "broom", "random"])
def test_subtree_totals(spark, shape, monkeypatch):
    n = 400
    rng = np.random.default_rng(4)
    parent = {
        "chain": lambda i: i - 1, "star": lambda i: 0, "broom": lambda i: i - 1 if i < 200 else 199,
        "random": lambda i: int(rng.integers(max(0, i - 6), i)),
    }[shape]
    parents = {i: parent(i) for i in range(1, n)}
    expected = {i: i + 1 for i in range(n)}
    for i in range(n - 1, 0, -1):
        expected[parents[i]] += expected[i]
    count = {i: 0 for i in range(n)}
    for p in parents.values():
        count[p] += 1
    rows = [(i, -i, parents.get(i), -parents[i] if i else None, count[i], i + 1) for i in range(n)]
    nodes = spark.createDataFrame(rows, "k1 long, k2 long, p1 long, p2 long, n_children long, weight long")
    rounds, plain = [], trie.written
    monkeypatch.setattr(trie, "written", lambda frame, purpose: rounds.append(purpose) or plain(frame, purpose))
    found = {r.k1: r.weight for r in trie.subtree_totals(nodes, ["weight"]).collect()}
    assert found == expected
    # Far fewer rounds than the tree is deep.
    assert rounds.count("trie-round") <= 30
