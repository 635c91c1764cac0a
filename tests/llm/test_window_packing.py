"""Operator 12 against plain encoding, all combinations and the conditions of a least-squares solution."""

import zlib
from collections import defaultdict
from itertools import combinations_with_replacement

import numpy as np
import pytest

from edcohort.llm import window_packing as W
from edcohort.llm.queries import QUERIES, tokenizer_path

from .data import SF, awkward, documents, empty, needs_tables

pytest.importorskip("public_tokenizers")


def encoded(texts, end=0):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    return [np.array([*t.encode(x or "", add_special_tokens=False).ids, end], "<u4") for x in texts]


def check(pieces, rows, window):
    """Each token of each row is in one piece, pieces hold these tokens, sequences are gapless and little is padded."""
    docs, own = defaultdict(list), defaultdict(list)
    for p in pieces:
        docs[p.row].append(p)
        own[p.sequence_id].append(p)
    got = []
    for v in docs.values():
        v.sort(key=lambda p: p.start)
        assert [p.start for p in v] == np.cumsum([0, *[p.length for p in v[:-1]]]).tolist()
        assert all(p.length == len(p.ids) // 4 > 0 and p.doc_tokens == sum(q.length for q in v) for p in v)
        got.append((v[0].doc_id, b"".join(bytes(p.ids) for p in v)))
    assert sorted(got, key=repr) == sorted([(r[0], x.tobytes()) for r, x in zip(rows, encoded([r[1] for r in rows]), strict=True)], key=repr)
    padded = 0
    for v in own.values():
        v.sort(key=lambda p: p.offset)
        assert [p.offset for p in v] == np.cumsum([0, *[p.length for p in v[:-1]]]).tolist()
        used = sum(p.length for p in v)
        assert used <= window
        padded += window - used if used & (used - 1) else 0
    assert padded == 0
    return len(own)


@needs_tables
@pytest.mark.parametrize("window, shard", [(1024, 1 << 23), (100, 5000)])
def test_documents(spark, window, shard):
    df = documents(spark).repartition(2)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    pieces = W.pack_windows(df, tokenizer_path=tokenizer_path(), window=window, shard_tokens=shard).collect()
    assert check(pieces, rows, window) <= sum(p.length for p in pieces) / window * (1.01 if window == 1024 else 1.2) + 22


@needs_tables
def test_query(spark):
    got = QUERIES["op12_least_squares_packing"](spark, SF).collect()
    rows = documents(spark).collect()
    ids = {r.doc_id: x for r, x in zip(rows, encoded([r.text for r in rows]), strict=True)}
    assert all(r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) and r.doc_tokens == len(ids[r.doc_id]) for r in got)
    assert sum(r.length for r in got) == sum(map(len, ids.values()))


def test_awkward_rows(spark):
    df, rows = awkward(spark)
    check(W.pack_windows(df, tokenizer_path=tokenizer_path(), window=64).collect(), rows, 64)
    assert W.pack_windows(empty(spark), tokenizer_path=tokenizer_path()).collect() == []


def test_row_repeated_very_often(spark):
    df = spark.range(3000).selectExpr("7L AS doc_id", "'a b c' AS text")
    pieces = W.pack_windows(df, tokenizer_path=tokenizer_path(), window=64, shard_docs=500).collect()
    check(pieces, [(7, "a b c")] * 3000, 64)


def test_sequences(spark):
    pieces = W.pack_windows(documents(spark).limit(40), tokenizer_path=tokenizer_path(), window=256).collect()
    df = spark.createDataFrame(pieces)
    out = {r.sequence_id: r for r in W.sequences(df, window=256, pad=9).collect()}
    for s, r in out.items():
        own = b"".join(bytes(p.ids) for p in sorted((p for p in pieces if p.sequence_id == s), key=lambda p: p.offset))
        n = len(own) // 4
        assert r.n_tokens == n and bytes(r.ids) == own + (b"" if n & (n - 1) == 0 else b"\x09\0\0\0" * (256 - n))
    open_ = spark.createDataFrame([(1, 0, 3, b"abcd" * 3)], "sequence_id long, offset long, length long, ids binary")
    assert bytes(W.sequences(open_, window=5, pad=1).first().ids) == b"abcd" * 3 + b"\x01\0\0\0" * 2


def test_combinations():
    rng = np.random.default_rng(0)
    for window, depth in ((30, 3), (24, 4), (17, 2), (9, 1)):
        present = rng.random(window + 1) < .7
        present[window] = True
        want = sorted((0,) * (depth - n) + c for n in range(1, depth + 1)
                      for c in combinations_with_replacement([k for k in range(1, window + 1) if present[k]], n) if sum(c) == window)
        assert sorted(map(tuple, W.combinations(window, depth, present).tolist())) == want
    assert len(W.combinations(10, 3, np.zeros(11, bool))) == 0


def test_repeats_are_the_least_squares_solution():
    """Conditions of optimality: no number below zero, no slope below zero, no slope where a number is above zero."""
    rng = np.random.default_rng(1)
    histogram = np.append(rng.integers(0, 40, 24), 0)
    histogram[0] = 0
    shapes = W.combinations(24, 3, histogram > 0)
    x = W.repeats(shapes, histogram, rounds=20_000)
    a = np.zeros((25, len(shapes)))
    for k, s in enumerate(shapes):
        np.add.at(a[:, k], s[s > 0], 1)
    w = (np.arange(25) / 24) ** 2
    slope = a.T @ (w * (a @ x - histogram))
    assert (x >= 0).all() and slope.min() > -.05 and np.abs(slope[x > .05]).max() < .05
    times = W.rounded(x, shapes, histogram)
    assert (a @ times <= histogram).all() and (a @ times) @ np.arange(25) > .7 * histogram @ np.arange(25)


@pytest.mark.parametrize("seed", range(6))
def test_greedy_part(seed):
    rng = np.random.default_rng(seed)
    pieces = [(k, 5, int(rng.integers(1, 64))) for k in range(int(rng.integers(0, 90)))]
    bins, rooms = W.best_fit(pieces, 64), []
    for _, _, n in sorted(pieces, key=lambda p: (-p[2], p[0])):  # the tightest room, by trying all
        fit = [r for r in rooms if r >= n]
        if fit:
            rooms.remove(min(fit))
        rooms.append((min(fit) if fit else 64) - n)
    assert sorted(64 - sum(p[2] for p in b) for b in bins) == sorted(rooms)
    sizes = [sum(p[2] for p in b) for b in W.filled(bins, 64)]
    assert sum(sizes) == sum(p[2] for p in pieces) and all(n == 64 or n & (n - 1) == 0 for n in sizes) and sum(n < 64 for n in sizes) <= 6
