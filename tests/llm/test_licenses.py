"""Operator 7: alignment against brute force, and known notices."""

from functools import lru_cache

from hypothesis import given, settings
from hypothesis import strategies as st

from edcohort.llm import licenses as L

from .data import awkward, empty


def lcs(a, b):
    @lru_cache(None)
    def go(i, j):
        if i == len(a) or j == len(b):
            return 0
        return 1 + go(i + 1, j + 1) if a[i] == b[j] else max(go(i + 1, j), go(i, j + 1))
    return go(0, 0)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=60))
def test_longest_increasing(values):
    got = [values[i] for i in L.increasing(values)]
    assert all(x < y for x, y in zip(got, got[1:], strict=False))
    best = [0] * len(values)
    for i, v in enumerate(values):
        best[i] = 1 + max([best[j] for j in range(i) if values[j] < v], default=0)
    assert len(got) == max(best, default=0)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcdefgh"), max_size=14), st.lists(st.sampled_from("abcdefgh"), max_size=10))
def test_alignment_is_a_common_subsequence(text, template):
    pairs = L.align(text, template)
    assert all(text[i] == template[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
    assert len(pairs) <= lcs(tuple(text), tuple(template))


def test_distinct_words_give_the_longest_common_subsequence():
    template = [f"w{i}" for i in range(30)]
    text = ["x", *template[:10], "y", *template[14:22], "z", "w3", *template[25:]]
    text.remove("w3") if text.count("w3") > 1 else None
    assert len(L.align(text, template)) == lcs(tuple(text), tuple(template))


def test_notices(spark):
    mit = L.TEMPLATES["mit"]
    rows = [(1, f"Some code.\n{mit}\nMore."), (2, mit.replace("Software", "Program").upper()), (3, " ".join(mit.split()[::2])),
            (4, "foo Licensed under the\nApache License, Version 2.0. bar"), (5, "Licensed under the Apache something else"), (6, "all the rights are reserved " * 40),
            (7, "x " * 500 + "Released under the MIT License." + " y" * 500)]
    out = {r.doc_id: r for r in L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1].license == "mit" and out[1].coverage == 1.0 and (out[1].first_word, out[1].last_word) == (2, 1 + len(L.words_of(mit)))
    assert out[2].license == "mit" and 0.9 < out[2].coverage < 1
    assert out[3].license != "mit" and out[5].license is None
    assert out[4].license == "apache-2.0-short" and (out[4].first_word, out[4].last_word) == (1, 7)
    assert out[7].license == "mit-short" and out[7].first_word == 500


def test_filter_loses_nothing(spark):
    """The hash filter keeps every pair of text and template that alignment covers."""
    names = sorted(L.TEMPLATES)
    texts = [" ".join(w for k, w in enumerate(L.words_of(L.TEMPLATES[n])) if k % step) for n in names for step in (5, 6, 9)]
    import pyarrow as pa
    s = L.Scanner(L.TEMPLATES, 80)
    fits = s.candidates(pa.array(texts))
    for row, text in zip(fits, texts, strict=True):
        every = {r[0] for r in s.scan(text, range(len(names)))}
        assert every == {r[0] for r in s.scan(text, row.nonzero()[0])}


def test_repeated_notices(spark):
    """A notice two and three times in a long text, side by side, apart, and with a word changed in each copy."""
    filler = " ".join(f"x{i}" for i in range(3000))
    rows, want = [], {}
    for name in ("mit", "all-rights-reserved", "gpl-3.0-short", "apache-2.0-notice"):
        for times in (2, 3):
            for between in ("", filler):
                notice, k = L.TEMPLATES[name], len(rows)
                rows.append((k, f"{filler} " + f" {between} ".join([notice] * times) + f" {filler}"))
                want[k] = (name, 1.0, len(L.words_of(notice)))
    gpl = L.TEMPLATES["gpl-3.0-short"].replace("License", "Licence")
    rows += [(100, f"{gpl} {gpl} {filler} {gpl}"), (101, f"{gpl} {filler} {gpl.replace('work', 'text')} {gpl}")]
    want |= {k: ("gpl-3.0-short", 11 / 12, 12) for k in (100, 101)}
    out = L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.license, r.coverage, r.last_word - r.first_word + 1 if r.license else 0) for r in out} == want


def test_awkward_rows(spark):
    df, rows = awkward(spark, [(40, "All rights reserved.", "en", "a")])
    out = L.scan_licenses(df).collect()
    assert sorted([(r.doc_id, r.license) for r in out], key=repr) == sorted([(r[0], "all-rights-reserved" if r[0] == 40 else None) for r in rows], key=repr)
    assert L.scan_licenses(empty(spark)).collect() == []
    assert {r.license for r in L.scan_licenses(df, {}).collect()} == {None}
