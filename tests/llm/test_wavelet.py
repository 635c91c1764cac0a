"""Operator 1: exact round trip, and rank, select, access against NumPy."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from edcohort.llm import wavelet as W
from edcohort.llm.queries import tokenizer_path

from .data import awkward, documents, empty, needs_tables, thue_morse

pytest.importorskip("public_tokenizers")


def direct(df):
    """(doc_id, start, n_tokens, crc) by encoding each text on its own; null ids first, then by id and text hash."""
    rows = [(r[0], r[1]) for r in df.selectExpr("doc_id", "coalesce(text, '') AS text").orderBy("doc_id", F.xxhash64("text")).collect()]
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    out, start = [], 0
    for d, text in rows:
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 2], "<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


def got(df, tmp_path, **kw):
    out = W.round_trip(df, tokenizer_path=tokenizer_path(), out=str(tmp_path / "w"), **kw)
    return sorted([(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in out.collect()], key=repr)


@needs_tables
def test_documents(spark, tmp_path):
    df = documents(spark)
    assert got(df, tmp_path, shard_tokens=5000, partitions=3) == direct(df)


def test_awkward_rows(spark, tmp_path):
    df, _ = awkward(spark, [(30, " lead", "", ""), (31, "trail ", "", ""), (32, "a  b  c  d", "", ""), (33, "it's  don't\n\n x", "", "")])
    assert got(df, tmp_path) == direct(df)


def test_empty_table(spark, tmp_path):
    assert got(empty(spark), tmp_path) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab1'. \n\t é中!s$ "), max_size=25), min_size=1, max_size=6))
def test_encoder_is_the_tokenizer(texts):
    e = W.encoder_for(tokenizer_path(), 2)
    ids, n = e.encode(texts)
    want = [[*e.tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert ids.tolist() == [i for w in want for i in w] and n.tolist() == [len(w) for w in want]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=1500))
def test_matrix(values):
    ids = np.array(values, np.uint32)
    w, ends = W.from_bytes(W.to_bytes(W.Wavelet.build(ids), np.array([len(ids)])))
    assert w.decode().tolist() == values and ends.tolist() == [len(ids)]
    for i in range(0, len(values), max(1, len(values) // 7)):
        assert w.access(i) == values[i]
    for v in (0, 1, 7, 40, 63, 64):
        at = np.flatnonzero(ids == v)
        assert w.count(v) == len(at)
        assert w.count(v, len(ids) // 3, len(ids) // 2) == ((at >= len(ids) // 3) & (at < len(ids) // 2)).sum()
        assert [w.locate(v, k) for k in range(-1, len(at) + 1)] == [-1, *at.tolist(), -1]


def test_long_text_in_stretches(monkeypatch):
    monkeypatch.setattr(W, "CHUNK", 50)
    e = W.Encoder(tokenizer_path(), 2)
    texts = ["word " * 100 + "end", "x" * 300, "a b\nc " * 60 + "z", "", "two  gaps " * 20]
    ids, n = e.encode(texts)
    assert ids.tolist() == [i for t in texts for i in [*e.tokenizer.encode(t, add_special_tokens=False).ids, 2]]
    assert n.sum() == len(ids)


def test_words_with_one_hash(spark, tmp_path):
    words = [w for n in (64, 1024, 4096) for w in thue_morse(n)]
    df = spark.createDataFrame([(k, f"x {w} y {w}") for k, w in enumerate(words)], "doc_id long, text string").coalesce(1)
    assert got(df, tmp_path) == direct(df)


def test_pieces_are_compared_by_bytes(monkeypatch):
    """With a hash that knows only lengths, ids are still the tokenizer's."""
    real = W.T.run_hashes

    def poor(*a):
        s, e, _, p = real(*a)
        return s, e, (e - s).astype(np.uint64), p
    monkeypatch.setattr(W.T, "run_hashes", poor)
    e = W.Encoder(tokenizer_path(), 2)
    rng = np.random.default_rng(0)
    for _ in range(3):
        texts = [" ".join("".join(rng.choice(list("abcé"), rng.integers(1, 80))) for _ in range(30)) for _ in range(20)]
        ids, _ = e.encode(texts)
        assert ids.tolist() == [i for t in texts for i in [*e.tokenizer.encode(t, add_special_tokens=False).ids, 2]]
