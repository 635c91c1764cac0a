"""Operator 2 against plain Python counts and distances."""

import re
from collections import Counter

import numpy as np
import pytest

from edcohort.llm import quality as Q

from .data import awkward, documents, empty, needs_tables


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    repeat = {i + k for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for k in range(3)}
    base = len(words) < 50 or 100 * len(repeat) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeat), base


def key(r):
    return r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


@needs_tables
def test_counts_of_documents(spark):
    df = documents(spark)
    want = [(r.doc_id, *brute_counts(r.text)) for r in df.collect()]
    assert sorted(map(key, Q.quality(df).collect())) == sorted(want)


def test_awkward_rows(spark):
    df, rows = awkward(spark)
    out = Q.quality(df).collect()
    assert sorted(map(key, out), key=repr) == sorted([(r[0], *brute_counts(r[1])) for r in rows], key=repr)
    assert all(not r.kept for r in out if r.base_failed)
    assert set(Q.keep_good(df).columns) == set(df.columns)


def test_empty_table(spark):
    assert Q.quality(empty(spark)).collect() == []


def js(p, q):
    p, q = np.asarray(p, float) / sum(p), np.asarray(q, float) / sum(q)
    m = (p + q) / 2
    part = lambda v: float(np.sum(np.where(v > 0, v * np.log2(np.where(v > 0, v, 1) / np.where(m > 0, m, 1)), 0)))
    return max(0.0, (part(p) + part(q)) / 2) ** 0.5


def test_distance(spark):
    p, q = [1, 0, 5, 4], [2, 2, 0, 6]
    df = spark.createDataFrame([([x / sum(p) for x in p], [x / sum(q) for x in q])], "p array<double>, q array<double>")
    got = df.select(Q.js_distance(df.p, df.q).alias("d")).first().d
    assert got == pytest.approx(js(p, q))
    assert df.select(Q.js_distance(df.p, df.p).alias("d")).first().d == pytest.approx(0)


def test_junk_goes_and_prose_stays(spark):
    rng = np.random.default_rng(1)
    common = Q.COMMON_WORDS["en"]
    prose = lambda: " ".join(rng.choice(common) if rng.random() < .5 else "w" + "".join(rng.choice(list("abcdefgh"), 5)) for _ in range(200)) + "."
    rows = [(i, prose(), "en") for i in range(60)]
    rows += [(100 + i, prose().upper().replace(" ", "!! "), "en") for i in range(3)] + [(200 + i, prose().replace(" ", "%%% ").replace("a", "$"), "en") for i in range(3)]
    out = {r.doc_id: r.kept for r in Q.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(out[i] for i in range(60)) and not any(v for k, v in out.items() if k >= 100)


def histograms(text):
    """(characters by class, words by bin) of a text, by plain Python."""
    kinds = {**{c: "lower" for c in "abcdefghijklmnopqrstuvwxyz"}, **{c: "upper" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}, **{c: "digit" for c in "0123456789"},
             " ": "space", "\t": "space", **{c: "newline" for c in "\n\r\x0b\x0c"}, **{c: "sentence" for c in Q.SENTENCE}, **{c: "symbol" for c in Q.SYMBOLS}}
    n = Counter(kinds.get(c, "other_ascii" if ord(c) < 128 else "non_ascii") for c in text or "")
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = Counter(re.findall(r"[^\x20\x09-\x0D]+", lower))
    known = [w[x] for x in Q.WORDS]
    return [n[c] for c in Q.CLASSES], [*known, sum(w.values()) - sum(known)]


def brute_kept(rows):
    """rows: (doc_id, text, lang) -> (kept, distances) by plain Python: references from all texts that pass, made once more without far ones."""
    docs = [(d, lang, *histograms(t), brute_counts(t)) for d, t, lang in rows]

    def judge(refs):
        out = []
        for _, lang, chars, words, counts in docs:
            dc = dw = 0.0
            if lang in refs:
                dc = js(chars, refs[lang][0]) if sum(chars) >= 200 else 0.0
                dw = js(words, refs[lang][1]) if counts[0] >= 50 else 0.0
            r = counts[0] ** -.5 if counts[0] else None
            far = r is not None and ((dc > .15 + .3 * r and dw > .22 + .6 * r) or dc > .3 + .8 * r or dw > .4 + .8 * r)
            out.append((far, dc, dw))
        return out

    def refs(far):
        out = {}
        for (_, lang, chars, words, counts), f in zip(docs, far, strict=True):
            if not counts[5] and not f and lang is not None:
                have = out.setdefault(lang, [np.zeros(len(chars)), np.zeros(len(words))])
                have[0] += chars
                have[1] += words
        return out

    verdicts = judge(refs([f for f, _, _ in judge(refs([False] * len(docs)))]))
    return [(d[0], not d[4][5] and not f, dc, dw) for d, (f, dc, dw) in zip(docs, verdicts, strict=True)]


@needs_tables
def test_verdicts_of_documents(spark):
    df = documents(spark)
    want = {d: rest for d, *rest in brute_kept([(r.doc_id, r.text, r.lang) for r in df.collect()])}
    for r in Q.quality(df).collect():
        kept, dc, dw = want[r.doc_id]
        assert r.kept == kept and r.char_distance == pytest.approx(dc, abs=1e-9) and r.word_distance == pytest.approx(dw, abs=1e-9)
    assert len({k for k, _, _ in want.values()}) == 2


def test_verdicts_on_labels(spark):
    """On the labelled texts of a larger table: nearly all junk goes and nearly no prose."""
    import os
    sf = "/root/testdata/sf0.01"
    if not os.path.isdir(sf):
        pytest.skip("driver tables not present")
    q = Q.quality(spark.read.parquet(f"{sf}/documents.parquet")).where("not base_failed").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    got = {(r.quality, r.kept): r["count"] for r in q.groupBy("quality", "kept").count().collect()}
    assert got.get((0, True), 0) <= .05 * sum(n for (v, _), n in got.items() if not v) and got.get((1, False), 0) <= .01 * sum(n for (v, _), n in got.items() if v)
