"""Long words with one polynomial hash stay apart in every operator that hashes words."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from edcohort.llm import textops as T
from edcohort.llm.bloom_lm import score
from edcohort.llm.jaccard_join import jaccard_components
from edcohort.llm.quality import quality

from .data import thue_morse

PAIRS = [thue_morse(n) for n in (1024, 2048, 4096)]
COLUMNS = "doc_id long, text string, lang string, source string"


def test_hashes_differ():
    for lower in (True, False):
        assert all(T.word_hash(a, lower) != T.word_hash(b, lower) for a, b in PAIRS)
    assert T.word_hash("AbC" * 500) == T.word_hash("aBc" * 500) != T.word_hash("AbC" * 500, lower=False)


@pytest.mark.parametrize("size", [0, 1, 7, 8, 9, 64, 65, 200])
def test_same_bytes(size):
    rng = np.random.default_rng(size)
    a = T.spaced_out(rng.integers(0, 256, 4000).astype(np.uint8))
    b = a.copy()
    at = np.arange(0, 3500, 211)
    for k in range(0, len(at), 2):
        if size:
            b[at[k] + k * 37 % size] ^= 1
    n = np.full(len(at), size)
    want = [a[p:p + size].tolist() == b[p:p + size].tolist() for p in at]
    assert T.same_bytes(a, at, n, b, at, n).tolist() == want
    assert not T.same_bytes(a, at, n, b, at, n + 1).any()


def test_shingles_of_a_very_long_word():
    text = "x " + "ab" * 700_000 + " y"
    assert [len(h) for _, _, h, _ in T.hashed_docs(pa.array([text]))] == [3]


def test_quality(spark):
    df = spark.createDataFrame([(k, f"{a} x y {b} x y", "en", "s") for k, (a, b) in enumerate(PAIRS)], COLUMNS)
    assert {r.n_repeat_words for r in quality(df).collect()} == {0}


def test_jaccard(spark):
    df = spark.createDataFrame([(2 * k + i, f"{w} a b c d", "en", "s") for k, p in enumerate(PAIRS) for i, w in enumerate(p)], COLUMNS)
    assert all(r.component_id == r.doc_id for r in jaccard_components(df).collect())


def test_language_model(spark):
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 5 == 1)
    train = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 5 != 1)
    for a, b in PAIRS:
        df = spark.createDataFrame([(train, f"{a} common", "en", "s"), (held, f"{b} common", "en", "s")], COLUMNS)
        got = {r.doc_id: r for r in score(df).collect()}
        assert got[train].n_known == 3 and got[held].n_known == 2
