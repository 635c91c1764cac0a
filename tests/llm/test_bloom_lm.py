"""Operator 9: base score against plain counts, filter against true counts, held-out likelihood."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from edcohort.llm import bloom_lm as B
from edcohort.llm import textops as T

from .data import awkward, documents, empty, needs_tables


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")), None]


def held(d):
    return zlib.crc32(b"" if d is None else str(d).encode()) % 5 == 1


def brute(rows):
    c = Counter(t for d, text in rows if not held(d) for t in tokens(text))
    n, v = sum(c.values()), len(c)
    out = []
    for d, text in rows:
        w = tokens(text)
        out.append((d, held(d), len(w), sum(c[t] > 0 for t in w), n, sum(math.log10((c[t] + .5) / (n + .5 * (v + 1))) for t in w)))
    return sorted(out, key=repr)


def agree(df, rows, **kw):
    out = B.score(df, **kw).collect()
    got = sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in out], key=repr)
    want = brute(rows)
    assert sorted([g[:5] for g in got], key=repr) == sorted([w[:5] for w in want], key=repr)
    assert sorted(g[5] for g in got) == pytest.approx(sorted(w[5] for w in want), rel=1e-9)
    assert all(np.isfinite(r.score) and r.score <= 0 for r in out)
    return out


@needs_tables
@pytest.mark.parametrize("frequent", [B.FREQUENT_WORDS, 300])
def test_documents(spark, frequent):
    """With all words broadcast, and with most of them joined."""
    df = documents(spark)
    out = agree(df, [(r.doc_id, r.text) for r in df.collect()], frequent_words=frequent)
    test = [r for r in out if r.held_out]
    assert sum(r.score for r in test) > sum(r.base_score for r in test)


@pytest.mark.parametrize("frequent", [B.FREQUENT_WORDS, 3, 0])
def test_awkward_rows(spark, frequent):
    df, rows = awkward(spark)
    agree(df, [r[:2] for r in rows], frequent_words=frequent)


def test_no_rows_and_no_training_rows(spark):
    assert B.score(empty(spark)).collect() == []
    d = next(d for d in range(100) if held(d))
    out = B.score(spark.createDataFrame([(d, "a b")], "doc_id long, text string")).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in out] == [(3, 0, 0)]


def test_levels():
    c = np.arange(1, 5000)
    level = B.levels(c)
    assert level[0] == 1 and (np.diff(level) >= 0).all() and (np.diff(level) <= 1).all()
    assert (np.abs(np.log(B._VALUES[level] / c)) <= math.log(B.BASE) + 1e-9).all()
    assert B._VALUES[0] == 0 and (B._VALUES[B.levels(np.array([1, 2]))] == [1, 2]).all()


@needs_tables
def test_filter_holds_quantised_counts(spark):
    df = documents(spark).select("text")
    true, pairs = Counter(), Counter()
    for r in df.collect():
        h, = [x[2] for x in T.hashed_docs(__import__("pyarrow").array([r.text]))]
        h = np.append(h, np.uint64(B.END))
        true.update(h.tolist())
        pairs.update(B._pairs(h).tolist())
    model, _ = B.fit(df)
    f = model.filter
    for counts, start, least in ((true, f.first, 1), (pairs, f.least, 2)):
        h = np.array(list(counts), np.uint64)
        c = np.array(list(counts.values()))
        want = np.where(c >= least, B._VALUES[B.levels(c)], 0)
        got = f.value(h, start)
        assert (got >= want).all(), "a Bloom filter never misses an entry"
        assert (got == want).mean() > 0.95
    other = T.mix(np.arange(20000, dtype=np.uint64))
    assert (f.value(other, 1) > 0).mean() < 0.05


@needs_tables
def test_bounded_filter(spark):
    df = documents(spark).select("text")
    model, _ = B.fit(df, max_entries=5000)
    assert model.filter.bits.nbytes * 8 <= 2 * 5000 * B.BITS_PER_ENTRY + 64 * 2 * model.filter.buckets


def scores(df, **kw):
    """Scores by row, and the kind of filter that a bound of ``kw`` gives."""
    return sorted([(r.doc_id, r.n_tokens, r.n_known, r.base_score, r.score) for r in B.score(df, **kw).collect()], key=repr)


@needs_tables
def test_filter_over_the_bound_loses_nothing(spark):
    """The segments as a table hold what the broadcast holds, so scores do not depend on the bound."""
    df = documents(spark)
    model, _ = B.fit(df.select("text"), max_entries=5000)
    assert model.filter.least == 2 and model.filter.first == 1 and not len(model.filter.bits)
    for a, b in zip(scores(df), scores(df, max_entries=5000), strict=True):
        assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:], rel=1e-9)


@pytest.mark.parametrize("frequent", [B.FREQUENT_WORDS, 3])
def test_awkward_rows_over_the_bound(spark, frequent):
    df, rows = awkward(spark)
    agree(df, [r[:2] for r in rows], frequent_words=frequent, max_entries=0)
    a, b = scores(df, frequent_words=frequent), scores(df, frequent_words=frequent, max_entries=0)
    assert [x[:3] for x in a] == [x[:3] for x in b] and [x[4] for x in a] == pytest.approx([x[4] for x in b], rel=1e-9)
