"""Operator 5 against all pairs in plain Python."""

import re

import numpy as np
import pytest

from edcohort.llm import jaccard_join as J

from .data import awkward, documents, empty, needs_tables


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute(rows):
    """Expected multiset of (doc_id, n_shingles, component_id)."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted([(d, len(s), least.get(find(i), d)) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))], key=repr)


def got(df, **kw):
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in J.jaccard_components(df, **kw).collect()], key=repr)


@needs_tables
def test_documents_match_all_pairs(spark):
    df = documents(spark)
    assert got(df) == brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])


def test_awkward_rows(spark):
    df, rows = awkward(spark)
    assert got(df) == brute([r[:2] for r in rows])


def test_empty_table(spark):
    assert got(empty(spark)) == []


def edited_copies(n_groups=3, copies=30, words=120, seed=5):
    """Groups of edited copies of an original: most link with it, few with each other."""
    rng = np.random.default_rng(seed)
    out, k = [], 0
    for g in range(n_groups):
        base = [f"g{g}w{i}" for i in range(words)]
        out.append((k, " ".join(base)))
        k += 1
        for _ in range(copies):
            w = list(base)
            for at in rng.choice(words, int(rng.integers(1, 5)), replace=False):
                w[at] = f"e{rng.integers(1 << 30)}"
            out.append((k, " ".join(w)))
            k += 1
    # a common passage in texts that are otherwise different
    passage = " ".join(f"shared{i}" for i in range(30))
    out += [(k + i, passage + " " + " ".join(f"own{i}x{j}" for j in range(int(rng.integers(4, 40))))) for i in range(40)]
    order = rng.permutation(len(out))
    return [(int(i), out[o][1]) for i, o in enumerate(order)]


@pytest.mark.parametrize(("short", "limit", "rounds", "block"), [
    (16, J.SHARED_LIMIT, 3, J.PAIR_BLOCK), (2, J.SHARED_LIMIT, 3, J.PAIR_BLOCK), (2, J.SHARED_LIMIT, 1, 5), (16, 0, 3, 1), (10**6, J.SHARED_LIMIT, 3, 7)])
def test_groups_of_edited_copies(spark, monkeypatch, short, limit, rounds, block):
    """Every way through: full comparison, hub rounds, shared tokens by join, long lists in bands and blocks."""
    monkeypatch.setattr(J, "PAIR_BLOCK", block)
    monkeypatch.setattr(J, "SHORT_LIST", short)
    monkeypatch.setattr(J, "HUB_ROUNDS", rounds)
    rows = edited_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(df, shared_limit=limit) == brute(rows)


def test_long_lists_meet_each_pair_once(spark, monkeypatch):
    """Blocks and bands of a list give the pairs of a plain comparison, at sizes on the edge of a band too."""
    monkeypatch.setattr(J, "PAIR_BLOCK", 4)
    sizes = [int(n) for n in np.unique(np.round(4 * 1.25 ** np.arange(0, 18, .5)))] + [4, 5, 5, 80, 100, 125, 1000, 1250]
    rows = [(t, k, n, k % 3, k % 5, len(sizes)) for t in (1, 2) for k, n in enumerate(sizes)]
    lists = spark.createDataFrame(rows, "token long, cls long, n long, pos long, label long, many long")
    got = {(r.a, r.b) for r in J.all_pairs_left(lists, 80).collect()}
    monkeypatch.setattr(J, "PAIR_BLOCK", 10**6)
    want = {(r.a, r.b) for r in J.all_pairs_left(lists, 80).collect()}
    assert got == want and len(want) > 30


def test_one_of_each_group_stays(spark):
    rows = edited_copies(2, 10)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in J.keep_one_per_component(df).collect()}
    assert kept == {c for _, _, c in brute(rows)}


def test_exact_threshold(spark):
    """8 common of 10 shingles in all links, 7 of 10 does not."""
    a = [f"w{i}" for i in range(13)]  # 9 shingles
    rows = [(1, " ".join(a)), (2, " ".join(a[:12] + ["x"])), (3, " ".join(a[:11] + ["y", "z"]))]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    assert brute(rows)[1][2] == 1 and brute(rows)[2][2] == 3


def brute_links(rows):
    sets = [shingles(t) for _, t in rows]
    link = lambda a, b: bool(a) and bool(b) and 100 * len(a & b) >= 80 * len(a | b)
    return sorted([(d, sum(link(a, b) for j, b in enumerate(sets) if i != j)) for i, ((d, _), a) in enumerate(zip(rows, sets, strict=True))], key=repr)


def got_links(df, **kw):
    return sorted([(r.doc_id, r.n_links) for r in J.jaccard_components(df, links=True, **kw).collect()], key=repr)


@pytest.mark.parametrize("block", [J.BLOCK_CLASSES, 4])
def test_links_of_each_document(spark, monkeypatch, block):
    """Links inside a component count too: in one block, and block against block."""
    monkeypatch.setattr(J, "BLOCK_CLASSES", block)
    monkeypatch.setattr(J, "SLICE_TOKENS", 50)
    rows = edited_copies(2, 20)
    rows += [(1000 + i, rows[i][1]) for i in range(12)] + [rows[3]]
    assert max(n for _, n in brute_links(rows)) > 10
    assert got_links(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == brute_links(rows)


def test_links_of_awkward_rows(spark):
    df, rows = awkward(spark)
    assert got_links(df) == brute_links([r[:2] for r in rows])
    assert got_links(empty(spark)) == []


@needs_tables
def test_links_of_documents(spark):
    df = documents(spark)
    assert got_links(df) == brute_links([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])


def test_one_row_of_groups_with_equal_ids(spark):
    """Equal rows, one id with near-equal texts or with two groups, and groups without an id."""
    text = lambda g, *, last="": " ".join(f"{g}{i}" for i in range(60)) + last
    rows = [(1, text("a")), (1, text("a")), (1, text("a", last=" x")), (2, text("a")), (1, text("b")), (3, text("b")),
            (None, text("c")), (None, text("c")), (None, text("c", last=" y")), (None, text("d")), (4, text("e")), (4, text("e")),
            (5, ""), (5, ""), (6, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, _k_th string")
    out = J.keep_one_per_component(df)
    assert out.columns == df.columns
    out = out.collect()
    assert sorted([r.doc_id for r in out], key=repr) == sorted([1, 1, None, None, 4, 5, 5, 6], key=repr)
    assert sorted(r.text.split()[0][0] for r in out if r.text) == ["a", "b", "c", "d", "e"]
