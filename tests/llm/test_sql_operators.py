"""Operators 4, 6 and 10 against their SQL, and on awkward rows."""

import hashlib
import re

import pytest
from tests.oracle_harness import compare, duck

from edcohort.llm import decontaminate as D
from edcohort.llm import line_dedup as L
from edcohort.llm import snapshots as S
from edcohort.llm.queries import ORACLE, QUERIES

from .data import LONG, SF, awkward, empty, needs_tables


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    res = compare(spark, duck(SF), SF, name, QUERIES[name], ORACLE[name])
    assert res["status"] == "OK", res


# ------------------------------------------------------------------ line dedup
def brute_lines(rows, min_sites):
    """rows: (doc_id, text, source) -> texts after removal."""
    sites, first = {}, {}
    for d, t, s in rows:
        for p, line in enumerate((t or "").split("\n") if t is not None else []):
            k = line.strip(" \t\r\x0b\x0c")
            if k:
                sites.setdefault(k, set())
                if s is not None:
                    sites[k].add(s)
                at = ((d is not None, d), p)
                first[k] = min(first.get(k, at), at)
    out = []
    for d, t, s in rows:
        if t is None:
            out.append((d, None))
            continue
        keep = [line for p, line in enumerate(t.split("\n"))
                if len(sites.get(line.strip(" \t\r\x0b\x0c"), ())) < min_sites or first[line.strip(" \t\r\x0b\x0c")] == ((d is not None, d), p)]
        out.append((d, "\n".join(keep)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_sites", [1, 2, 3, 7, 40])
def test_lines_near_the_threshold(spark, min_sites):
    rows = [(d, "\n".join(["everywhere", f"own {d}", f" mod {d % 3}", "", f"some {d % 7}", "everywhere"]), f"s{d % 60}" if d % 11 else None) for d in range(120)]
    rows += [(200, None, "s1"), (201, "", "s2")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    out = sorted([(r.doc_id, r.text) for r in L.dedup_lines(df, chars_col=None, min_sites=min_sites).collect()], key=repr)
    assert out == brute_lines(rows, min_sites)


def test_lines_of_awkward_rows(spark, monkeypatch):
    extra = [(20 + i, f"menu home about\ntext number {i}", "en", f"x{i}") for i in range(6)] + [(None, "menu home about", "en", "z")]
    df, rows = awkward(spark, extra)
    want = []
    for d, t, _, s in rows:
        text = t
        if t and "menu" in t and d is not None and d != 20 or t == "menu home about" and d is not None:
            text = t.replace("menu home about\n", "")
        want.append((d, text, len(text or "")))
    # the null id sorts first, so its row keeps the line
    want = [(d, t.replace("menu home about\n", "") if d == 20 else t, len(t.replace("menu home about\n", "")) if d == 20 else n) for d, t, n in want]
    for small in (L.SMALL, 0):
        monkeypatch.setattr(L, "SMALL", small)
        monkeypatch.setattr(L, "BROADCAST_BYTES", small)
        got = L.dedup_lines(df)
        assert got.columns == df.columns
        assert sorted([(r.doc_id, r.text, r.n_chars) for r in got.collect()], key=repr) == sorted(want, key=repr)
    assert L.dedup_lines(empty(spark)).collect() == []


def test_many_line_numbers_are_not_broadcast(spark):
    """Few documents with very many lines to remove go past the broadcast by their size in bytes."""
    boiler = "\n".join(f"line {k}" for k in range(3000))
    rows = [(i, boiler + f"\nown {i}", f"site{i}") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = lambda out: out._jdf.queryExecution().optimizedPlan().toString()
    wide = L.dedup_lines(df, chars_col=None)
    assert "strategy=broadcast" in plan(wide)
    old, L.BROADCAST_BYTES = L.BROADCAST_BYTES, 4 * 3000 * 5 - 1
    try:
        narrow = L.dedup_lines(df, chars_col=None)
        assert "strategy=broadcast" not in plan(narrow)
        assert sorted(r.text for r in narrow.collect()) == sorted([boiler + "\nown 0", *[f"own {i}" for i in range(1, 6)]])
    finally:
        L.BROADCAST_BYTES = old


# -------------------------------------------------------------- decontamination
def tokens(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_hits(text, items):
    w, hit, names = tokens(text), set(), set()
    for item, body in items:
        b = tokens(body)
        n = min(13, len(b))
        windows = {tuple(b[i:i + n]) for i in range(len(b) - n + 1)} if n else set()
        for p in range(len(w) - n + 1):
            if tuple(w[p:p + n]) in windows:
                hit |= set(range(p, p + n))
                if item is not None:
                    names.add(str(item))
    sha = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
    return len(w), len(hit), len(names), sha, len(hit) > 0 and 20 * len(hit) >= len(w)


ITEMS = [(10, LONG.upper()), (9, "one"), (9, "one"), (None, "another TEXT"), (11, None), (12, "..."), (13, "x y"), (7, LONG)]


@pytest.mark.parametrize("block", [D.BLOCK_WINDOWS, 3])
def test_hits_of_awkward_rows(spark, monkeypatch, block):
    monkeypatch.setattr(D, "BLOCK_WINDOWS", block)
    df, rows = awkward(spark)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in D.contamination(df, items).collect()]
    assert sorted(got, key=repr) == sorted([(r[0], *brute_hits(r[1], ITEMS)) for r in rows], key=repr)
    kept = D.remove_documents(df, items)
    assert kept.columns == df.columns
    assert sorted([r.doc_id for r in kept.collect()], key=repr) == sorted([r[0] for r in rows if not brute_hits(r[1], ITEMS)[-1]], key=repr)


def test_no_items_and_no_documents(spark):
    df, rows = awkward(spark)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert not any(r.contaminated for r in D.contamination(df, items.limit(0)).collect())
    assert D.contamination(empty(spark), items).collect() == []


def test_spans_are_cut_out(spark):
    items = spark.createDataFrame([(1, LONG)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"Before it: {LONG.title()}, and after."), (2, "clean,  text")], "doc_id long, text string")
    out = {r.doc_id: r.text for r in D.remove_spans(docs, items).collect()}
    assert out == {1: "Before it, and after.", 2: "clean,  text"}


# ------------------------------------------------------------------- snapshots
def brute_snapshots(rows):
    convs = {}
    for c, t, r, x in {(c, -1 if t is None else t, r or "", x or "") for c, t, r, x in rows}:
        convs.setdefault(c, []).append((t, r, x))
    convs = {c: sorted(v) for c, v in convs.items()}
    out = []
    for c, v in convs.items():
        # a strict prefix ends where a turn number ends
        longer = any(w[:len(v)] == v and len(w) > len(v) and w[len(v)][0] > v[-1][0] for w in convs.values())
        twins = [d for d, w in convs.items() if w == v]
        named = [d for d in twins if d is not None]
        if not longer and c == (min(named) if named else None):
            out.append((c, len(v), len(twins)))
    return sorted(out, key=repr)


def test_snapshots(spark):
    rows = []
    for c in range(30):
        n = c % 7 + 1
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"chat {c // 15} turn {t}") for t in range(n)]
    rows += [(100, t, "user", f"long {t}") for t in range(2500)] + [(101, t, "user", f"long {t}") for t in range(1700)]
    rows += [(102, t, "user", f"long {t}") for t in range(2500)] + [(103, 0, "user", None), (104, None, None, "x"), (None, 0, "user", "y"), (None, 0, "user", "y")]
    rows += rows[:5]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS n", "2 AS h1", "3 AS conv", "4 AS block")
    got = S.render_maximal(df.repartition(4)).collect()
    assert sorted({(r.conv_id, r.n_turns, r.n_copies) for r in got}, key=repr) == brute_snapshots(rows)
    text = "".join(r.text for r in sorted((r for r in got if r.conv_id == 100), key=lambda r: r.part))
    assert text == "".join(f"<|user|>\nlong {t}\n<|end|>\n" for t in range(2500))
    assert S.render_maximal(df.limit(0)).collect() == []
