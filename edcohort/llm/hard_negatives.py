"""Operator 11: hard negatives by segment summaries.

Each vector is cut into 1, 2, 4, ... equal segments, down to segments of ``SHORTEST`` components, and
the mean and the deviation of each segment are stored.  Over a segment of L components the inner
product of two vectors is L * mean * mean plus a rest of at most L * deviation * deviation either way, so the
sums over the segments bound the score from both sides, the finer the closer.  A search goes
through its rows in chunks: pairs whose bounds miss the windows in question, or fall short
of the best found so far, leave at the first level that shows it; what is left is scored exactly.

Two searches run, both dealt by Spark as blocks of anchors against blocks of rows of bounded size:
the positives of each anchor among the rows of its label, then, with the windows that the positives
give, the negatives among the others.  Each task keeps a few rows for each anchor and window,
and a last ranking joins the tasks' results.

Scores are integers: components become ``floor(scale * x)``, and products are exact at any size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded, freeze

#: Components in the shortest segments.
SHORTEST = 4
#: Anchors, and rows, that one task gets (about).
ANCHORS, ROWS = 1024, 4096
#: Pairs still open, as a part of all, from which a level is computed for all pairs of a chunk at once.
DENSE = 0.1
#: Products of norms below which doubles hold each score exactly; scores of others stay within LIMIT either way.
EXACT, LIMIT = 1 << 52, 1 << 62
#: Relative error allowed for summaries, which are stored as 32-bit numbers.
MARGIN = 1e-5


def segment_counts(dims: int) -> list[int]:
    """Segments of a vector at each level."""
    return [1 << k for k in range(max(1, dims // SHORTEST).bit_length())]


def summaries(x: np.ndarray) -> np.ndarray:
    """For each vector, level by level: the scaled mean of each segment, then its scaled deviation.
    The scale is the root of the segment's length, so that products of these need no more factors."""
    parts = []
    for n in segment_counts(x.shape[1]):
        at = np.arange(n) * x.shape[1] // n
        long = np.diff(np.append(at, x.shape[1]))
        total = np.add.reduceat(x, at, axis=1) if x.shape[1] else np.zeros((len(x), n))
        mean = total / np.maximum(long, 1)
        rest = x - np.repeat(mean, long, axis=1)
        deviation = np.sqrt(np.add.reduceat(rest * rest, at, axis=1)) if x.shape[1] else mean
        parts += [mean * np.sqrt(long), deviation]
    return np.concatenate(parts, axis=1)


def matrix(column, dims: int, kind=np.float64) -> np.ndarray:
    """A list column as rows of a matrix; shorter lists are filled with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.asarray(column.value_lengths())
    out = np.zeros((len(column), dims), kind)
    owner = np.repeat(np.arange(len(column)), size)
    out[owner, np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)] = np.asarray(column.flatten(), kind)
    return out


class Side:
    """The anchors or the rows of a block."""

    def __init__(self, table: pa.Table, dims: int, scale: float):
        self.vectors = np.floor(scale * matrix(table["vector"], dims))
        with np.errstate(over="ignore"):
            self.norm = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        self.summary = matrix(table["summary"], 2 * sum(segment_counts(dims)))
        self.rid, self.label = np.asarray(table["rid"]), np.asarray(table["label"])

    def scores(self, other: Side, i: np.ndarray, j: np.ndarray, exact: bool, dense: bool) -> np.ndarray:
        """Products of the vectors i with the other side's vectors j."""
        if not exact:  # too large for doubles: integers of any size, kept within LIMIT
            left, right = ([[int(v) for v in x] for x in y.vectors.tolist()] for y in (self, other))
            return np.array([max(-LIMIT, min(LIMIT, sum(map(int.__mul__, left[p], right[q]))))
                             for p, q in zip(i.tolist(), j.tolist(), strict=True)], np.int64)
        if dense:
            return (self.vectors @ other.vectors.T)[i, j].astype(np.int64)
        return np.einsum("ij,ij->i", self.vectors[i], other.vectors[j]).astype(np.int64)

    def part(self, rows: slice) -> Side:
        out = object.__new__(Side)
        for name, value in vars(self).items():
            setattr(out, name, value[rows])
        return out


def bounds(a: Side, r: Side, i: np.ndarray | None, j: np.ndarray | None, level: slice):
    """(middle, spread) of the scores at one level, for the pairs (i, j) or for all."""
    mean = slice(level.start, (level.start + level.stop) // 2)
    dev = slice(mean.stop, level.stop)
    if i is None:
        slack = MARGIN * a.norm[:, None] * r.norm[None, :] + 1
        return a.summary[:, mean] @ r.summary[:, mean].T, a.summary[:, dev] @ r.summary[:, dev].T + slack
    slack = MARGIN * a.norm[i] * r.norm[j] + 1
    return (np.einsum("ij,ij->i", a.summary[i, mean], r.summary[j, mean]),
            np.einsum("ij,ij->i", a.summary[i, dev], r.summary[j, dev]) + slack)


def search(anchors: Side, rows: Side, low: np.ndarray, high: np.ndarray, k: int, same_label: bool, first: int = 64) -> np.ndarray:
    """The ``k`` best rows of each anchor and window, as (anchor, window, row, score), in order.

    Windows are integers (anchors x windows) ``low`` to ``high``, empty where low > high.  Among equal
    scores the earlier row wins.  A row is never its own partner."""
    windows = low.shape[1]
    exact = float(anchors.norm.max(initial=0)) * float(rows.norm.max(initial=0)) < EXACT
    floor = low.copy()  # the least score that still counts
    best, at, step = np.empty((0, 4), np.int64), 0, first
    while at < len(rows.rid):
        r = rows.part(slice(at, at + step))
        open_ = floor <= high
        alive = (anchors.label[:, None] == r.label[None, :]) == same_label
        alive &= (anchors.rid[:, None] != r.rid[None, :]) & open_.any(axis=1)[:, None]
        # what is wanted, over all windows of an anchor
        least = np.where(open_, floor, LIMIT).min(axis=1, initial=LIMIT).astype(float)
        most = np.where(open_, high, -LIMIT).max(axis=1, initial=-LIMIT).astype(float)
        at_column = 0
        for n in segment_counts(anchors.vectors.shape[1]) if exact else ():
            level = slice(at_column, at_column + 2 * n)
            at_column = level.stop
            if alive.mean() >= DENSE:
                middle, spread = bounds(anchors, r, None, None, level)
                alive &= (middle + spread >= least[:, None]) & (middle - spread <= most[:, None])
            else:
                i, j = np.nonzero(alive)
                middle, spread = bounds(anchors, r, i, j, level)
                alive[i, j] = (middle + spread >= least[i]) & (middle - spread <= most[i])
        i, j = np.nonzero(alive)
        score = anchors.scores(r, i, j, exact, alive.mean() >= DENSE)
        found = [best]
        for v in range(windows):
            ok = (score >= floor[i, v]) & (score <= high[i, v])
            found.append(np.column_stack([i[ok], np.full(int(ok.sum()), v), j[ok] + at, score[ok]]))
        found = np.concatenate(found)
        key = found[:, 0] * windows + found[:, 1]
        order = np.lexsort((found[:, 2], -found[:, 3], key))
        found, key = found[order], key[order]
        place = np.arange(len(key)) - np.searchsorted(key, key)
        best = found[place < k]
        last = found[place == k - 1]  # full: only a better score counts from now on
        floor[last[:, 0], last[:, 1]] = last[:, 3] + 1
        at, step = at + step, min(2 * step, 1024)
    return best


def _sorted_by_id(table: pa.Table) -> pa.Table:
    return table.sort_by([("id", "ascending"), ("rid", "ascending")])  # nulls come last


def windows_of(scores: list[list[int]], low: int, high: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Integers from ``low`` % to ``high`` % of each score; empty windows beyond the scores given."""
    lo, hi = np.full((len(scores), width), 1, np.int64), np.zeros((len(scores), width), np.int64)
    for r, own in enumerate(scores):
        for c, s in enumerate(own):
            lo[r, c], hi[r, c] = -(-low * s // 100), high * s // 100
    return lo, hi


def mine(vectors: DataFrame, anchor: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         scale: float = 1.0, n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95,
         anchor_block: int = ANCHORS, row_block: int = ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each row with ``anchor`` true
    and each of its ``n_positives`` best other rows of its label, the ``n_negatives`` best rows of other labels that score
    ``low`` to ``high`` percent of the positive.

    Rows with a null label or vector, or with a null or non-finite component, take no part.  Ties go by smaller id; null ids
    come last.  Rows count one by one, so a repeated row is an anchor, a positive
    and a negative as often as it occurs.  Vectors of different lengths are filled with zeros; scores beyond
    2**62 either way stay there.  ``anchor`` may name any column.  An empty table gives no rows."""
    element = vectors.schema[vector_col].dataType.elementType
    kind = "float" if isinstance(element, T.FloatType) else "double"
    id_kind, label_kind = (vectors.schema[c].dataType.simpleString() for c in (id_col, label_col))
    v = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast(f"array<{kind}>").alias("vector"),
                       F.coalesce(anchor, F.lit(False)).alias("is_anchor"))
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    v = v.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", odd))
    dims = v.agg(F.max(F.size("vector"))).first()[0] or 0

    def summarise(batches):
        for b in batches:
            s = summaries(np.floor(scale * matrix(b.column("vector"), dims))).astype(np.float32)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(s.ravel()), s.shape[1]).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*b.columns, lists], names=[*b.schema.names, "summary"])

    v = v.mapInArrow(summarise, f"id {id_kind}, label {label_kind}, vector array<{kind}>, is_anchor boolean, summary array<float>")
    v = freeze(v.withColumn("rid", F.monotonically_increasing_id()))
    n_rows, n_anchors = v.agg(F.count("*"), F.count_if("is_anchor")).first()
    blocks = lambda n, size: F.greatest(F.lit(1), F.ceil(n / size)).cast("int")
    deal = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "rid"), n).cast("int")

    # positives: a label with many rows is cut into blocks of its own, small ones share a bucket
    labels = v.groupBy(F.col("label").alias("l")).agg(F.count("*").alias("n"), F.count_if("is_anchor").alias("m"))
    buckets = max(1, -(-n_rows // row_block))
    hot = F.col("n") > row_block
    labels = freeze(labels.where("m > 0").select(
        "l", F.when(~hot, F.pmod(F.xxhash64("l"), F.lit(buckets))).cast("int").alias("bucket"), F.when(hot, F.col("l")).alias("own"),
        F.when(hot, blocks(F.col("n"), row_block)).otherwise(1).alias("rbs"),
        F.when(hot, blocks(F.col("m"), anchor_block)).otherwise(1).alias("abs")))
    key = ["bucket", "own", "ab", "rb"]
    d = v.join(bounded(labels), F.col("label") == F.col("l"))
    ranks = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    rows = d.withColumn("rb", deal(F.col("rbs"), 1)).withColumn("ab", ranks(F.col("abs")))
    some = d.where("is_anchor").withColumn("ab", deal(F.col("abs"), 2)).withColumn("rb", ranks(F.col("rbs")))
    used = ["rid", "id", "label", "vector", "summary"]
    as_new = lambda df, *names: df.select(*[F.col(c).alias(c) for c in names])  # noqa: E731  both sides come from one table

    def positives(anchors: pa.Table, table: pa.Table) -> pa.Table:
        table = _sorted_by_id(table)
        mine, theirs = Side(anchors, dims, scale), Side(table, dims, scale)
        every = np.full((len(mine.rid), 1), LIMIT)
        got = search(mine, theirs, -every, every, n_positives, True)
        return pa.table({"a": pa.array(mine.rid[got[:, 0]], pa.int64()), "id": table["id"].take(pa.array(got[:, 2])),
                         "rid": pa.array(theirs.rid[got[:, 2]], pa.int64()), "score": pa.array(got[:, 3], pa.int64())})

    found = some.select(*key, *used).groupBy(*key).cogroup(as_new(rows, *key, *used).groupBy(*key)).applyInArrow(
        positives, f"a long, id {id_kind}, rid long, score long")
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "rid"))
    found = found.withColumn("place", place).where(F.col("place") <= n_positives)
    found = found.groupBy("a").agg(F.array_sort(F.collect_list(F.struct("place", "id", "score"))).alias("positives"))

    # negatives: blocks of anchors against blocks of all rows
    abs_, rbs = max(1, -(-n_anchors // anchor_block)), max(1, -(-n_rows // row_block))
    some = v.where("is_anchor").join(found, F.col("rid") == F.col("a"))
    some = some.withColumn("ab", deal(F.lit(abs_), 2)).withColumn("rb", ranks(F.lit(rbs)))
    rows = v.withColumn("rb", deal(F.lit(rbs), 1)).withColumn("ab", ranks(F.lit(abs_)))

    def negatives(anchors: pa.Table, table: pa.Table) -> pa.Table:
        table = _sorted_by_id(table)
        mine, theirs = Side(anchors, dims, scale), Side(table, dims, scale)
        given = anchors["positives"].to_pylist()
        got = search(mine, theirs, *windows_of([[p["score"] for p in x] for x in given], low, high, n_positives), n_negatives, False)
        own = [given[i][w] for i, w in got[:, :2].tolist()]
        return pa.table({
            "a": pa.array(mine.rid[got[:, 0]], pa.int64()), "w": pa.array(got[:, 1], pa.int32()),
            "anchor_id": anchors["id"].take(pa.array(got[:, 0])),
            "positive_id": pa.array([p["id"] for p in own], anchors["id"].type),
            "positive_score": pa.array([p["score"] for p in own], pa.int64()),
            "negative_id": table["id"].take(pa.array(got[:, 2])), "rid": pa.array(theirs.rid[got[:, 2]], pa.int64()),
            "negative_score": pa.array(got[:, 3], pa.int64())})

    schema = (f"a long, w int, anchor_id {id_kind}, positive_id {id_kind}, positive_score long, negative_id {id_kind}, rid long, "
              "negative_score long")
    some = some.select("ab", "rb", *used, "positives").groupBy("ab", "rb")
    found = some.cogroup(as_new(rows, "ab", "rb", *used).groupBy("ab", "rb")).applyInArrow(negatives, schema)
    place = F.row_number().over(Window.partitionBy("a", "w").orderBy(F.col("negative_score").desc(),
                                                                     F.col("negative_id").asc_nulls_last(), "rid"))
    found = found.withColumn("rank", place).where(F.col("rank") <= n_negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
