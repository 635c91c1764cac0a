"""Operator 8 against a plain best-fit and its invariants."""

from collections import defaultdict

import numpy as np
import pytest

from edcohort.llm import packing as P

from .data import awkward, documents, empty, needs_tables


def check(pieces, lengths, capacity):
    """Every token of every row is in one piece; no bin is too full or holds a source or cluster twice."""
    bins, have = defaultdict(list), defaultdict(list)
    for r in pieces:
        have[r.doc_id].append(r)
        if r.bin >= 0:
            bins[r.shard, r.bin].append(r)
    got = sorted((d, sum(r.n_tokens for r in v)) for d, v in have.items() if d is not None)
    want = defaultdict(int)
    for d, n in lengths:
        if d is not None:
            want[d] += n
    assert got == sorted(want.items())
    for v in bins.values():
        v.sort(key=lambda r: r.bin_offset)
        assert [r.bin_offset for r in v] == np.cumsum([0, *[r.n_tokens for r in v[:-1]]]).tolist()
        assert sum(r.n_tokens for r in v) <= capacity and all(r.n_tokens > 0 for r in v)
        sources = [r.source for r in v if r.source is not None]
        assert len(set(sources)) == len(sources) and len({r.cluster for r in v}) == len(v)


@needs_tables
@pytest.mark.parametrize("capacity", [100, 2048])
def test_documents(spark, capacity):
    df = documents(spark)
    out = P.pack(df, capacity=capacity, shard_docs=60).collect()
    check(out, [(r.doc_id, len(r.text.split())) for r in df.collect()], capacity)


def test_tightest_compatible_bin():
    """The order of bins, and the search in it, against trying all bins."""
    rng = np.random.default_rng(3)
    bins, plain = P.Bins(50), []
    for _ in range(600):
        size, source, cluster = int(rng.integers(1, 51)), 1 << int(rng.choice(6, p=[.5, .1, .1, .1, .1, .1])), 1 << int(rng.integers(0, 40))
        b, at = bins.place(size, source, cluster)
        fits = [(p["free"], k) for k, p in enumerate(plain) if p["free"] >= size and not p["s"] & source and not p["c"] & cluster]
        if fits:
            k = min(fits)[1]
        else:
            k = len(plain)
            plain.append({"free": 50, "s": 0, "c": 0})
        assert (b, at) == (k, 50 - plain[k]["free"])
        plain[k]["free"] -= size
        plain[k]["s"] |= source
        plain[k]["c"] |= cluster


def test_awkward_rows(spark):
    df, rows = awkward(spark)
    out = P.pack(df, capacity=16).collect()
    check(out, [(r[0], len((r[1] or "").split())) for r in rows], 16)
    assert sorted([r.doc_id for r in out if r.bin < 0]) == [2, 3, 4]
    assert len({r.copy for r in out if r.doc_id == 1}) == 2
    assert P.pack(empty(spark)).collect() == []


def test_row_repeated_very_often(spark):
    df = spark.range(1000).selectExpr("7L AS doc_id", "'a b c' AS text", "'s' AS source")
    out = P.pack(df, capacity=10, shard_docs=100).collect()
    assert len(out) == 1000 and len({(r.shard, r.bin) for r in out}) == 1000 and len({r.copy for r in out}) == 1000
    assert len({r.shard for r in out}) > 3


def test_given_lengths_and_clusters(spark):
    df = spark.createDataFrame([(i, "", f"s{i}", i // 2) for i in range(40)], "doc_id long, text string, source string, c long")
    out = P.pack(df, cluster_col="c", length=df.doc_id % 5 + 1, capacity=8).collect()
    check(out, [(i, i % 5 + 1) for i in range(40)], 8)
