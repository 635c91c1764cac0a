"""Operator 5: exact Jaccard self-join on word n-grams with several global token orders.

Two sets with Jaccard similarity of at least t share a token among the first
n - ceil(t n) + 1 tokens of either, under *every* global order of the tokens.  So a pair is
a candidate only if its prefixes meet under order A (frequent tokens last, ties by hash),
and under orders B and C (two hash permutations); only then its overlap is counted.

Steps, all on classes of documents with equal sets (copies never meet each other):

1. ``class_rows``: one pass hashes each text to its shingle set and emits (doc, set size,
   class = hash of the set), and tokens frequent within a batch with their counts.
2. The most frequent tokens (bounded table, broadcast) define order A; any order is valid,
   the table only decides how selective the filter is.
3. A second pass emits the prefix postings (token, class).  Tokens with more than one class
   are *shared*; only their posting lists are kept.
4. Hub rounds: in each posting list (by size band) classes are compared with a few hubs
   only, never with each other.  Linked classes are merged (``components``).
   Before sets are made, pairs must also share enough prefix tokens.
5. What is left is done in full: every pair of a posting list whose classes still have
   different labels, after the filters.  A pair inside one component need not be checked,
   as it cannot change the components.  No list is capped.
6. On demand (``links``) the links of each document are counted: all pairs of classes inside
   each component, blocks of them against blocks, by matrix products.  Pairs are not rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import bounded, few, freeze, keyed, on_keys, without
from .components import components

#: Entries of the frequent-token table that orders tokens (12 bytes each, broadcast).
FREQUENT_LIMIT = 1_000_000
#: Shared tokens up to which they are broadcast (8 bytes each); beyond, they are joined.
SHARED_LIMIT = 2_000_000
#: A batch reports tokens that it holds in at least this many classes, one less if it is small.
BATCH_MIN = 3
SMALL_BATCH = 1000
#: Tokens counted together.
COUNT_TOKENS = 2_000_000
#: Turns at most, and pairs per row of the posting lists up to which all pairs are compared.
HUB_ROUNDS = 3
PAIRS_PER_ROW = 8
#: Classes of a posting list up to which all its pairs are compared at once.
SHORT_LIST = 16
#: Classes, and shingles of them, in a block of a component, about; shingles of a matrix slice.
BLOCK_CLASSES = 1024
BLOCK_TOKENS = 1_000_000
SLICE_TOKENS = 4096


def prefix_length(n, percent: int):
    """n - ceil(percent n / 100) + 1, in integers."""
    full = percent * n + 99
    return n - (full - full % 100) / 100 + 1 if isinstance(n, Column) else n - full // 100 + 1


def _classes(batch: pa.RecordBatch, shingle: int) -> Iterator[tuple[int, list[np.ndarray], list[int]]]:
    """(first row, sets, class ids) for slices of a batch with columns doc_id, th, text."""
    for i, j, h, at in T.hashed_docs(batch.column("text")):
        at = at.tolist()
        sets = [T.shingle_set(h[at[k]:at[k + 1]], shingle) for k in range(j - i)]
        ids = [xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else 0 for s in sets]
        yield i, sets, ids


def _int64(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def class_rows(docs: DataFrame, shingle: int) -> DataFrame:
    """Rows (doc_id, th, n_shingles, cls) of documents and (token, df) of frequent tokens."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in T.tidied(batches):
            sizes, classes, first, tokens, held = [], [], set(), [], 0
            for _, sets, ids in _classes(b, shingle):
                sizes += map(len, sets)
                classes += ids
                for s, c in zip(sets, ids, strict=True):
                    if c not in first:
                        first.add(c)
                        tokens.append(s)
                        held += len(s)
                if held >= COUNT_TOKENS:
                    yield from often(tokens, len(first), b)
                    first, tokens, held = set(), [], 0
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("th"), pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()),
                 pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names=names)
            yield from often(tokens, len(first), b)

    def often(tokens, docs, b):
        """Tokens that occur in several of these classes."""
        if not tokens:
            return
        every = np.concatenate(tokens)
        every.sort()
        edge = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        count = np.diff(np.append(edge, len(every)))
        keep = count >= BATCH_MIN - (docs < SMALL_BATCH)
        m = int(keep.sum())
        if m:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(m, b.column("doc_id").type), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()),
                 pa.nulls(m, pa.int64()), pa.array(_int64(every[edge[keep]])), pa.array(count[keep])], names=names)

    names = ["doc_id", "th", "n_shingles", "cls", "token", "df"]
    return docs.mapInArrow(run, f"doc_id {id_type}, th long, n_shingles long, cls long, token long, df long")


def frequent_tokens(rows: DataFrame, limit: int = FREQUENT_LIMIT):
    """Sorted (tokens, weights) of at most ``limit`` tokens; the bound on the count rises until they fit."""
    total = freeze(rows.where("token is not null").groupBy("token").agg(F.sum("df").alias("df")).where("df >= 4"))
    least = 4
    while total.where(F.col("df") >= least).count() > limit:
        least *= 2
    got = total.where(F.col("df") >= least).toArrow()
    token = np.asarray(got["token"], dtype=np.int64).view(np.uint64)
    weight = np.asarray(got["df"], dtype=np.int64)
    order = np.argsort(token)
    return token[order], np.minimum(weight[order], 2**31 - 1).astype(np.int32)


def _weights(tokens: np.ndarray, table) -> np.ndarray:
    known, weight = table
    if not len(known):
        return np.zeros(len(tokens), np.int32)
    at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
    return np.where(known[at] == tokens, weight[at], 0)


def _prefixes(sets: list[np.ndarray], table, percent: int) -> list[np.ndarray]:
    """Prefix of each sorted set under order A."""
    if not sets:
        return []
    w = _weights(np.concatenate(sets), table)
    out, at = [], 0
    for s in sets:
        own = w[at:at + len(s)]
        at += len(s)
        p = prefix_length(len(s), percent) if len(s) else 0
        if own.any():
            out.append(s[np.argsort(own, kind="stable")[:p]])  # s ascends, so ties go by hash
        else:
            out.append(s[:p])
    return out


def postings(docs: DataFrame, table, shingle: int, percent: int, tokens: np.ndarray | None = None) -> DataFrame:
    """(token, cls, n, pos): the prefix of each class under order A, with the set's size and the
    position; only the given (sorted) ``tokens``, if any are given."""
    sent = docs.sparkSession.sparkContext.broadcast((table, tokens))

    def run(batches):
        for b in T.tidied(batches):
            table, tokens = sent.value
            for _, sets, ids in _classes(b, shingle):
                fresh = {c: s for c, s in zip(ids, sets, strict=True) if len(s)}
                if not fresh:
                    continue
                pre = _prefixes(list(fresh.values()), table, percent)
                token = np.concatenate(pre)
                many = [len(p) for p in pre]
                cols = [_int64(token), np.repeat(np.fromiter(fresh, np.int64), many),
                        np.repeat(np.array([len(s) for s in fresh.values()], np.int64), many),
                        np.concatenate([np.arange(m) for m in many])]
                if tokens is not None:
                    at = np.minimum(np.searchsorted(tokens, token), max(len(tokens) - 1, 0))
                    keep = tokens[at] == token if len(tokens) else np.zeros(len(token), bool)
                    cols = [c[keep] for c in cols]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["token", "cls", "n", "pos"])

    return docs.select("text").mapInArrow(run, "token long, cls long, n long, pos long")


def whole_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(cls, tokens): the sorted set of each document as bytes."""
    def run(batches):
        for b in T.tidied(batches):
            for _, sets, ids in _classes(b, shingle):
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                                                 names=["cls", "tokens"])

    return docs.select("text").mapInArrow(run, "cls long, tokens binary")


def _permuted_prefix(s: np.ndarray, key: int, percent: int) -> np.ndarray:
    return s[np.argsort(T.mix(s ^ np.uint64(key)))[:prefix_length(len(s), percent)]]


#: Orders B and C.
ORDER_KEYS = (0x9FB21C651E98DF25, 0xA0761D6478BD642F)


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """The size filter, the filters of orders B and C, then the exact overlap."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    for key in ORDER_KEYS:
        if not len(np.intersect1d(_permuted_prefix(x, key, percent), _permuted_prefix(y, key, percent), assume_unique=True)):
            return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def prefixes_meet(pairs: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose prefixes under order A share enough: of two sets, the overlap is at most the
    common prefix tokens plus what lies behind the prefix of the one whose prefix ends first."""
    def side(c, x):
        return prefixes.select(F.col("cls").alias(c), F.col("n").alias(f"n{x}"), F.col("tokens").alias(f"t{x}"))
    both = F.size(F.array_intersect("t1", "t2"))
    behind = F.greatest(*[F.col(n) - prefix_length(F.col(n), percent) for n in ("n1", "n2")])
    return (few(pairs.join(side("a", 1), "a"), pairs.count()).join(side("b", 2), "b")
            .where(both + behind >= overlap_needed(F.col("n1"), F.col("n2"), percent)).select("a", "b"))


def verify(pairs: DataFrame, docs: DataFrame, docs_cls: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that link.  Sets are made only of one document of each class
    that occurs in a pair."""
    rows = pairs.count()
    pairs = few(pairs, rows)
    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    one = docs_cls.join(wanted, "cls", "left_semi").groupBy("cls").agg(F.min(F.struct("doc_id", "th")).alias("k"))
    one = bounded(freeze(few(one.select("k.*"), 2 * rows)))
    sets = freeze(whole_sets(docs.join(one, on_keys(docs, one, "doc_id", "th"), "left_semi"), shingle))
    left = sets.select(F.col("cls").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("cls").alias("b"), F.col("tokens").alias("y"))

    def run(batches):
        for batch in T.tidied(batches):
            keep = [linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
                    for x, y in zip(batch.column("x"), batch.column("y"), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # some hundred pairs a task: their sets are large, and counting the overlap takes its time
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return few(both, 50 * rows).mapInArrow(run, "a long, b long")


def _ordered(a, b):
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def overlap_needed(n1, n2, percent: int):
    """Least overlap of linked sets: ceil(percent (n1 + n2) / (100 + percent))."""
    return F.ceil(percent * (n1 + n2) / F.lit(100 + percent) - F.lit(1e-9))


def may_meet(n1, pos1, n2, pos2, percent: int):
    """Whether a shared token at these positions under order A can be the first common token of
    linked sets: sizes fit, and it lies within the first n - overlap + 1 tokens of either."""
    need = overlap_needed(n1, n2, percent)
    return (100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)) & (pos1 <= n1 - need) & (pos2 <= n2 - need)


def labelled(lists: DataFrame, labels: DataFrame | None) -> tuple[DataFrame, int]:
    """The posting lists that hold classes of different labels, with the labels; and their rows."""
    if labels is None:
        q = lists.withColumn("label", F.col("cls"))
    else:
        q = lists.join(labels.withColumnRenamed("vertex", "cls"), "cls", "left")
        q = q.withColumn("label", F.coalesce("label", "cls"))
    still = q.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("many"))
    still = still.where("lo <> hi").select("token", "many")
    q = freeze(q.join(still, "token").select("token", "cls", "n", "pos", "own", "label", "many"))
    rows = q.count()
    return few(q, rows), rows


def size_band(percent: int, n: str = "n") -> Column:
    """log of the set size, in units of the largest ratio of sizes that link."""
    return F.log(n) / F.lit(float(np.log(100.0 / percent)) if percent < 100 else 1.0)


def pairs_left(lists: DataFrame, percent: int) -> int:
    """About how many pairs with different labels a full comparison of these posting lists would
    meet (repeats included): those of one size band, at positions where sets of equal size can
    meet first."""
    near = lists.where(F.col("pos") <= F.col("n") - overlap_needed(F.col("n"), F.col("n"), percent))
    near = near.withColumn("band", F.floor(size_band(percent)))
    by_label = near.groupBy("token", "band", "label").agg(F.count("*").cast("double").alias("c"))
    by_token = by_label.groupBy("token", "band").agg(F.sum("c").alias("t"), F.sum(F.col("c") * F.col("c")).alias("s"))
    got = by_token.agg(F.sum((F.col("t") * F.col("t") - F.col("s")) / 2)).first()
    return int(got[0] or 0)


def hub_pairs(lists: DataFrame, percent: int, turn: int) -> DataFrame:
    """Each class of an open posting list with the hub of its list and size band.  First that is the
    class with the smallest share of prefix tokens of its own: the original of a group of edited
    copies has hardly any, so it is close to all of them.  Later turns shift the bands, then
    take a hub by a random order."""
    rows = lists.withColumn("band", F.floor(size_band(percent) + (turn % 2) / 2))
    carry = ["cls", "label", "n", "pos"]
    order = F.xxhash64(F.lit(turn), "cls")
    best = F.struct("own", order, *carry) if turn < 2 else F.struct(order, *carry)
    hubs = rows.groupBy("token", "band").agg(F.min(best).alias("hub"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    paired = rows.join(hubs.where("lo <> hi").drop("lo", "hi"), ["token", "band"])
    fits = may_meet(F.col("n"), F.col("pos"), F.col("hub.n"), F.col("hub.pos"), percent)
    return paired.where((F.col("label") != F.col("hub.label")) & fits).select(*_ordered(F.col("cls"), F.col("hub.cls"))).distinct()


#: Classes of a posting list that one task compares with others of it; a longer list is cut into blocks of about so many.
PAIR_BLOCK = 2000


def all_pairs_left(lists: DataFrame, percent: int) -> DataFrame:
    """All pairs of a posting list with different labels that may meet there.

    Lists of more than ``PAIR_BLOCK`` classes are cut: by size band, as sets of bands further apart than one never link, and
    one side by a hash into blocks, each of which meets the whole other side.  So no task holds a whole list, and every pair is
    met once: in the band of its second class and the block of its first."""
    keep = ("cls", "n", "pos", "label")
    x = lists.select("token", "many", *[F.col(c).alias(f"x_{c}") for c in keep])
    y = lists.select("token", "many", *[F.col(c).alias(f"y_{c}") for c in keep])
    pair = ((F.col("x_cls") < F.col("y_cls")) & (F.col("x_label") != F.col("y_label"))
            & may_meet(F.col("x_n"), F.col("x_pos"), F.col("y_n"), F.col("y_pos"), percent))
    short = F.col("many") <= PAIR_BLOCK
    ids = [F.col("x_cls").alias("a"), F.col("y_cls").alias("b")]
    met = x.where(short).drop("many").join(y.where(short).drop("many"), "token").where(pair).select(*ids)
    band = lambda n, more=0.0: F.floor(size_band(percent, n) + more)
    blocks = F.ceil(F.col("many") / PAIR_BLOCK).cast("int")
    first = x.where(~short).withColumn("block", F.pmod(F.xxhash64(F.lit(5), "x_cls"), blocks).cast("int"))
    first = first.withColumn("band", F.explode(F.sequence(band("x_n", -1.000001), band("x_n", 1.000001)))).drop("many")
    second = y.where(~short).withColumn("band", band("y_n"))
    second = second.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).drop("many")
    long = first.join(second, ["token", "band", "block"]).where(pair).select(*ids)
    return met.union(long).distinct()


def link_classes(lists: DataFrame, check, percent: int) -> DataFrame:
    """(vertex, label) of all classes that link with another.

    Short posting lists are compared in full at once.  In long ones hub rounds go on while a full
    comparison would meet more pairs than a few per row of the lists that are still open; then,
    or after ``HUB_ROUNDS``, all pairs that are left in them are compared too."""
    still, rows = labelled(lists, None)
    short = still.where(F.col("many") <= SHORT_LIST)
    still = still.where(F.col("many") > SHORT_LIST)
    done = freeze(few(all_pairs_left(short, percent).union(hub_pairs(still, percent, 0)), SHORT_LIST * rows).distinct())
    links = freeze(check(done))
    labels = components(links)
    for turn in range(1, HUB_ROUNDS + 1):
        still, rows = labelled(still.drop("label", "many"), labels)
        if not rows:
            break
        last = pairs_left(still, percent) <= PAIRS_PER_ROW * rows or turn == HUB_ROUNDS
        new = all_pairs_left(still, percent) if last else hub_pairs(still, percent, turn)
        new = freeze(new.join(done, ["a", "b"], "left_anti"))
        links = freeze(links.union(check(new)))
        labels = components(links)
        if last:
            break
        done = done.union(new)
    return labels


def overlaps(xs: list[np.ndarray], ys: list[np.ndarray] | None = None) -> np.ndarray:
    """Common tokens of each set of ``xs`` with each of ``ys``; without ``ys`` of each two of ``xs`` (the
    diagonal then means nothing)."""
    tx = np.concatenate(xs)
    if ys is None:
        every, many = np.unique(tx, return_counts=True)
        common = every[many > 1]
    else:
        common = np.intersect1d(tx, np.concatenate(ys))

    def cells(sets):
        token = np.concatenate(sets)
        at = np.searchsorted(common, token)
        hit = np.flatnonzero(common[np.minimum(at, len(common) - 1)] == token)
        hit = hit[np.argsort(at[hit], kind="stable")]
        return np.repeat(np.arange(len(sets)), [len(s) for s in sets])[hit], at[hit]

    def matrix(sets, owner, at, lo):
        a, z = np.searchsorted(at, [lo, lo + SLICE_TOKENS])
        out = np.zeros((len(sets), min(SLICE_TOKENS, len(common) - lo)), np.float32)
        out[owner[a:z], at[a:z] - lo] = 1
        return out

    out = np.zeros((len(xs), len(xs if ys is None else ys)))
    if len(common):
        x = cells(xs)
        y = None if ys is None else cells(ys)
        for lo in range(0, len(common), SLICE_TOKENS):
            mx = matrix(xs, *x, lo)
            out += mx @ (mx if y is None else matrix(ys, *y, lo)).T
    return out


def links_of_classes(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(cls, links): for each class of ``members`` (cls, label, n, copies; frozen) the documents of other
    classes of its component that link with it.  A component is dealt into blocks by hash, as many as its
    classes and shingles ask for; a task compares two blocks.  Small components go to tasks together."""
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK_CLASSES, F.sum("n") / BLOCK_TOKENS)).cast("int")
    parts = members.groupBy("label").agg(F.count("*").alias("many"), blocks.alias("blocks")).where("many > 1").select("label", "blocks")
    bins = max(1, -(-(members.agg(F.sum("n")).first()[0] or 0) // BLOCK_TOKENS))
    m = members.join(parts, "label").withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    m = m.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    m = m.select("label", "cls", "copies", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                 F.pmod(F.xxhash64("label"), F.lit(bins)).alias("bin"))

    def run(t: pa.Table) -> pa.Table:
        label, cls, copies, own, i, j = (t[c].to_numpy() for c in ("label", "cls", "copies", "own", "i", "j"))
        tokens = [np.frombuffer(x.as_buffer(), np.uint64) for c in t["tokens"].chunks for x in c]
        order = np.lexsort((own, label))
        total = np.zeros(len(order), np.int64)
        for rows in np.split(order, np.flatnonzero(np.diff(label[order])) + 1):
            x, y = rows[own[rows] == i[rows]], rows[own[rows] != i[rows]]
            within = i[rows[0]] == j[rows[0]]
            if not len(x) or not (within or len(y)):
                continue
            xs, ys = [tokens[k] for k in x], [tokens[k] for k in y]
            both = overlaps(xs, None if within else ys)
            if within:
                y, ys = x, xs
            size = np.add.outer([len(s) for s in xs], [len(s) for s in ys])
            link = 100 * both >= percent * (size - both)
            if within:
                np.fill_diagonal(link, False)
            else:
                total[y] += link.T @ copies[x]
            total[x] += link @ copies[y]
        return pa.Table.from_arrays([pa.array(cls), pa.array(total)], names=["cls", "links"])

    found = m.join(sets, "cls").groupBy("bin", "i", "j").applyInArrow(run, "cls long, links long")
    return found.groupBy("cls").agg(F.sum("links").alias("links"))


def jaccard_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                       percent: int = 80, shared_limit: int = SHARED_LIMIT, links: bool = False, group: bool = False) -> DataFrame:
    """(doc_id, th, n_shingles, component_id) for each row of ``docs``; with ``links`` also n_links, the
    number of other rows that link with it; with ``group`` also grp, a number that tells components of
    one ``component_id`` apart (null without words).

    Words are runs outside U+0020 and U+0009-U+000D after lower-casing A-Z; a document's set
    is its distinct ``shingle``-word shingles (fewer words: the whole sequence).  Documents
    link when 100 * intersection >= ``percent`` * union; ``component_id`` is the smallest id
    reachable by links.  Null and empty texts have n_shingles 0, no links and their own id; rows with a
    null id take part, but a null is never the smallest id unless it is the only one.  Repeated
    rows give repeated results; an empty table gives no rows.  Sets are 64-bit hashes."""
    keys = keyed(docs, id_col=id_col, text_col=text_col)
    rows = freeze(class_rows(keys, shingle))
    table = frequent_tokens(rows)
    docs_cls = rows.where("cls is not null").select("doc_id", "th", "n_shingles", "cls")
    post = postings(keys, table, shingle, percent)
    shared = post.groupBy("token").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo <> hi").select("token")
    shared = freeze(shared)
    if shared.count() <= shared_limit:
        tokens = np.sort(np.asarray(shared.toArrow()["token"], dtype=np.int64).view(np.uint64))
        lists = freeze(postings(keys, table, shingle, percent, tokens).distinct())
    else:
        lists = freeze(post.distinct().join(shared, "token", "left_semi"))
    prefixes = freeze(lists.groupBy("cls").agg(F.first("n").alias("n"), F.collect_list("token").alias("tokens")))
    length = prefix_length(F.col("n"), percent)
    own = prefixes.select("cls", F.floor(F.try_divide(100 * (length - F.size("tokens")), length)).alias("own"))
    lists = freeze(lists.join(own, "cls"))

    def check(pairs):
        return verify(freeze(prefixes_meet(pairs, prefixes, percent)), keys, docs_cls, shingle, percent)

    labels = link_classes(lists, check, percent)
    by_class = docs_cls.where("n_shingles > 0").groupBy("cls").agg(F.min("doc_id").alias("least"))
    by_class = by_class.join(labels.withColumnRenamed("vertex", "cls"), "cls", "left")
    by_class = freeze(by_class.select("cls", "least", F.coalesce("label", "cls").alias("label")))
    whole = by_class.groupBy("label").agg(F.min("least").alias("component_id"))
    named = by_class.join(whole, "label").select("cls", "component_id", F.col("label").alias("grp"))
    out = docs_cls.join(named, (docs_cls["cls"] == named["cls"]) & (docs_cls["n_shingles"] > 0), "left")
    out = out.select(docs_cls["cls"], "doc_id", "th", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
                     *["grp"] * group)
    if not links:
        return out.drop("cls")
    members = docs_cls.where("n_shingles > 0").groupBy("cls").agg(
        F.count("*").alias("copies"), F.first("n_shingles").alias("n"), F.min(F.struct("doc_id", "th")).alias("k"))
    members = freeze(members.join(labels.withColumnRenamed("vertex", "cls"), "cls", "left"))
    joined = members.where("label is not null")
    one = bounded(freeze(joined.select("k.*")))
    sets = whole_sets(keys.join(one, on_keys(keys, one, "doc_id", "th"), "left_semi"), shingle).dropDuplicates(["cls"])
    counts = members.select("cls", "copies").join(links_of_classes(joined, sets, percent), "cls", "left")
    counts = freeze(counts.select("cls", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    out = out.join(counts.withColumnRenamed("cls", "c"), (F.col("cls") == F.col("c")) & (F.col("n_shingles") > 0), "left")
    return out.select("doc_id", "th", "n_shingles", "component_id", *["grp"] * group, F.coalesce("n_links", F.lit(0)).alias("n_links"))


def keep_one_per_component(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs`` with one row of each group of near copies: the one with the smallest id (a null is the
    greatest), of one id the text with the smallest hash, and one of equal rows.  Rows without words stay."""
    found = freeze(jaccard_components(docs, id_col=id_col, text_col=text_col, group=True, **kw).where("grp is not null").select("doc_id", "th", "grp"))
    rows = found.groupBy("grp", "doc_id", "th").agg(F.count("*").alias("many"))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", "many")
    stay = rows.groupBy("grp").agg(F.min(first).alias("s"))
    other = ~(F.col("doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("th") == F.col("s.th")))
    drop = freeze(rows.join(stay, "grp").where(other).select("doc_id", "th"))
    out = without(docs, drop, id_col=id_col, text_col=text_col)
    twice = freeze(stay.where("s.many > 1").select("s.doc_id", "s.th"))
    if twice.isEmpty():
        return out
    keys = bounded(twice.select(F.col("doc_id").alias("_k_id"), F.col("th").alias("_k_th")))
    equal = out.join(keys, out[id_col].eqNullSafe(keys["_k_id"]) & (F.xxhash64(out[text_col]) == keys["_k_th"]), "left_semi")
    return without(out, twice, id_col=id_col, text_col=text_col).union(equal.dropDuplicates([id_col, text_col]))
