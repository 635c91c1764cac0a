"""Operator 13 against a plain dictionary of prefixes, with containers of every size."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from edcohort.llm import prefix_trie as P
from edcohort.llm.queries import ORACLE, QUERIES
from tests.oracle_harness import compare, duck

from .data import SF, needs_tables

SCHEMA = "conv_id long, turn long, role string, text string, conv string, depth string, h1 int, c long, b long, top string"


def turn_id(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows):
    """Rows are (conv_id, turn, role, text)."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs[c].append(((turn is not None, turn or 0), turn_id(role, text)[:32], role, text))
    for v in convs.values():
        v.sort()
    members, ends, size = defaultdict(list), defaultdict(list), {}
    for c, own in convs.items():
        h, base = zlib.crc32(str(c).encode()) % 9, c - int(np.fmod(c, 5))
        turns = [x[2:] for x in convs.get(base, [])[:h] + own[h:]]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            size[tuple(turns[:d])] = len(turns[d - 1][1].encode()) if d else 0
        ends[tuple(turns)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * size[p]
    sha = lambda x: hashlib.sha256(",".join(map(str, sorted(x))).encode()).hexdigest()
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], sha(ends[p])) for p, m in members.items()), key=repr)


def trie(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", "y", 1, 2, 3, "z") for r in rows], SCHEMA)
    turns = P.ordered_turns(df)
    conv = F.col("conv")
    out = P.prefix_trie(*P.with_heads_of(turns, conv - conv % 5, F.crc32(conv.cast("string").cast("binary")) % 9, 8), **kw)
    return sorted(map(tuple, out.collect()), key=repr)


def talks(seed=0, n=60):
    rng = np.random.default_rng(seed)
    out = []
    for c in rng.choice(3 * n, n, replace=False).tolist():
        for t in range(int(rng.integers(1, 14))):
            out.append((c, t, "user" if t % 2 == 0 else "bot", f"é{rng.choice(3)}" if t < 9 else f"own {c % 7}"))
    return out


@pytest.mark.parametrize("container", [0, 7, 10**6])
def test_containers_of_all_sizes(spark, container):
    rows = talks()
    assert trie(spark, rows, container=container) == brute(rows)


@needs_tables
def test_query(spark):
    res = compare(spark, duck(SF), SF, "op13_burst_trie", QUERIES["op13_burst_trie"], ORACLE["op13_burst_trie"])
    assert res["status"] == "OK", res
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, QUERIES["op13_burst_trie"](spark, SF).collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("container", [2, 500])
def test_awkward_rows(spark, container):
    rows = talks(3, 20) + [(None, 0, "user", "of nobody"), (7, None, "user", "first"), (7, None, None, None), (7, 3, "user", None), (7, 3, "user", None),
                           (7, 3, "", "x" * 200_000), (-7, 0, "user", "é"), (-10, 1, "user", "é"), (1001, 0, "a", "b"), (1002, 0, "a:b", ""), (1003, 0, "", "a:b")]
    assert trie(spark, rows, container=container) == brute(rows)


def test_empty_table(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 1, "a", "b")]) == []
    only = next(c for c in range(6, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    assert trie(spark, [(only, 1, "a", "b")]) == brute([(only, 1, "a", "b")])  # its turn goes, there is nothing to start with


def test_conversation_very_often_and_very_long(spark, monkeypatch):
    """A third of the conversations are equal, one holds a third of all turns: heads all along, in several blocks."""
    monkeypatch.setattr(P, "BLOCK", 16)
    monkeypatch.setattr(P, "IDS", 32)
    rows = [(c, t, "user", f"same {t}") for c in range(0, 600, 2) for t in range(6)] + [(1000, t, "bot", f"long {t % 11}") for t in range(1500)] + talks(5, 40)
    assert trie(spark, rows, container=50) == brute(rows)
