"""Operator 3: held-out accuracy, features against plain counts, awkward rows."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from edcohort.llm import toxicity as X

from .data import awkward, empty, needs_tables


@needs_tables
def test_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    out = X.score(spark.read.parquet(f"{sf}/documents.parquet"), labels := spark.read.parquet(f"{sf}/labels.parquet")).toPandas()
    assert len(out) == 1000 and out.score.between(0, 1).all() and ((out.score >= .5) == (out.predicted == 1)).all()
    m = out.merge(labels.toPandas(), on="doc_id")
    m = m[m.held_out]
    pos, neg = m[m.toxic == 1].score.to_numpy(), m[m.toxic == 0].score.to_numpy()
    auc = np.mean([(p > neg).mean() + (p == neg).mean() / 2 for p in pos])
    assert auc > 0.88 and (m.predicted == m.toxic).mean() > 0.93


def test_counts():
    texts = pa.array(["You are an IDIOT, you 1diot!! Sooo WOW?", None, "", "she hates a m0ron that I know from far away, you"])
    seed, you = X._hashes(X.INSULTS), X._hashes(X.SECOND_PERSON)
    none = np.empty(0, np.uint64)
    c = X.count_features(texts, seed, you, none, none)
    k = {n: c[:, i].tolist() for i, n in enumerate(X.COUNTS)}
    assert k["words"] == [8, 0, 0, 11] and k["seed"] == [2, 0, 0, 1] and k["you"] == [2, 0, 0, 1]
    assert k["near"] == [2, 0, 0, 0] and k["bang"] == [2, 0, 0, 0] and k["caps"][0] == 2 and k["mixed"] == [1, 0, 0, 1] and k["repeat"] == [1, 0, 0, 0]
    assert k["bytes"][1:3] == [0, 0]


def test_long_text_in_blocks(monkeypatch):
    text = "you idiot " * 5000
    seed, you, none = X._hashes(X.INSULTS), X._hashes(X.SECOND_PERSON), np.empty(0, np.uint64)
    whole = X.count_features(pa.array([text, "x"]), seed, you, none, none)
    monkeypatch.setattr(X.T, "SLICE_BYTES", 1000)
    cut = X.count_features(pa.array([text, "x"]), seed, you, none, none)
    near = X.COUNTS.index("near")
    assert np.array_equal(np.delete(whole, near, 1), np.delete(cut, near, 1)) and abs(whole[0, near] - cut[0, near]) < 60


@pytest.mark.parametrize("labels", [[], [(1, 1), (5, 1), (7, None)], [(k, int(k % 2)) for k in range(300, 420)]])
def test_awkward_rows(spark, labels):
    df, rows = awkward(spark, [(k, "you stupid loser" if k % 2 else "a kind and calm text", "en", "a") for k in range(300, 420)])
    lab = spark.createDataFrame([(d, 0, y) for d, y in labels], "doc_id long, quality int, toxic int")
    out = X.score(df, lab, trees=3).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= .5) for r in out)
    if len(labels) > 100:
        got = {r.doc_id: r.predicted for r in out}
        assert got[301] == 1 and got[300] == 0
    if not labels:
        assert {r.score for r in out} == {0.0}
    assert X.score(empty(spark), lab, trees=2).collect() == []


def test_an_id_in_a_third_of_the_rows(spark, monkeypatch):
    """The sample has one row of each labelled id, however often it occurs."""
    rows = [(i, f"you stupid fool {i}" if i % 2 else f"a calm and friendly note {i}") for i in range(1, 200)] + [(1, f"text number {k}") for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 200)], "doc_id long, toxic int")
    seen, real = [], X.learn_lexicons
    monkeypatch.setattr(X, "learn_lexicons", lambda sample: seen.append(sample.count()) or real(sample))
    out = X.score(docs, labels, trees=5).collect()
    assert len(out) == len(rows) and seen == [sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(1, 200))]
