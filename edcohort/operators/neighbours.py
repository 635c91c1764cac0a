"""Exact nearest-neighbour imputation.

Distances are Euclidean on standardised columns with missing cells at the mean.  A missing cell
becomes the mean of the observed values of the ``k`` nearest other rows, weighted by 1 / (distance
+ 1e-6); with none observed it stays missing.  Distances that agree to nine places tie; ties go by row order.

Rows with equal vectors are one *point* (its first k + 1 rows are enough for any neighbour list).
Points lie in the cells of a k-means fit; a query searches its own cell first, which bounds the
distance of its k-th neighbour, and then every cell that the triangle inequality does not rule out, so
the result is exact whatever the cells are.  Cells are searched in blocks of bounded size (points
by queries), each block gives only its nearest rows, and no pair list is ever built.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import reliable_checkpoint
from .impute import METHODS, impute_indicator
from .ordinal import global_ordinal

#: Points and queries of one block, and cells at most (their centres are sent to all tasks).
BLOCK = 2000
#: Queries of a block that are measured together.
QUERIES = 250
MAX_CELLS = 256
#: Rows that are compared with all centres together, and blocks of one task, about.
PLACED, BLOCKS = 1024, 64
EPSILON = 1e-6
#: Distances that agree in so many places tie.
PLACES = 9


def _points(df: DataFrame, columns: Sequence[str], keep: int) -> tuple[DataFrame, DataFrame]:
    """(rows: rid, v, x; members: the first ``keep`` rows of each point, with cid, its first rid)."""
    stats = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
                   *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    z = []
    for i, c in enumerate(columns):
        m, s = stats[f"m{i}"], stats[f"s{i}"]
        z.append(F.lit(0.0) if m is None else (F.coalesce(F.col(c).cast("double"),
                                                          F.lit(float(m))) - F.lit(float(m))) / F.lit(float(s or 1.0)))
    rows = reliable_checkpoint(df.select("rid", F.array(*z).alias("v"), F.array(*[F.col(c).cast("double") for c in columns]).alias("x")))
    first = Window.partitionBy("v").orderBy("rid")   # a group limit runs before the shuffle
    members = rows.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= keep).drop("_n")
    return rows, members


def nearest_of(v: np.ndarray, x: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, point, distance) of the ``keep`` nearest points of each query, ties by position.  A matrix product gives all distances
    nearly; what could be among the nearest by these is measured exactly."""
    xx, vv = (x * x).sum(axis=1), (v * v).sum(axis=1)
    near = vv[:, None] + xx[None, :] - 2 * (v @ x.T)
    k = min(keep, len(x)) - 1
    slack = 1e-8 * (1 + vv + xx.max())
    i, j = np.nonzero(near <= (np.partition(near, k, axis=1)[:, k] + slack)[:, None])
    d = np.round(np.sqrt(((x[j] - v[i]) ** 2).sum(axis=1)), PLACES)
    order = np.lexsort((j, d, i))
    i, j, d = i[order], j[order], d[order]
    first = np.arange(len(i)) - np.searchsorted(i, i) < keep
    return i[first], j[first], d[first]


def _nearest(points: DataFrame, queries: DataFrame, sizes: dict[int, int], asked: dict[int, int], keep: int) -> DataFrame:
    """(cid, rid, d): the ``keep`` nearest members of each query within the given cells, block by block.
    ``points`` (cell, v, rid), ``queries`` (cell, v, cid)."""
    def blocks(counts):
        return F.element_at(F.create_map(*[F.lit(x) for c, n in counts.items() for x in (c, -(-n // BLOCK))]), F.col("cell"))

    p = points.withColumn("salt", F.pmod(F.xxhash64("rid"), blocks(sizes)).cast("int"))
    p = p.where(F.col("cell").isin(list(asked))).withColumn("chunk", F.explode(F.sequence(F.lit(0), blocks(asked) - 1)))
    q = queries.withColumn("chunk", F.pmod(F.xxhash64("cid"), blocks(asked)).cast("int"))
    q = q.withColumn("salt", F.explode(F.sequence(F.lit(0), blocks(sizes) - 1)))

    def block(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"cid": [], "rid": [], "d": []})
        a = a.sort_values("rid")
        x, rid = np.stack(a["v"].to_numpy()), a["rid"].to_numpy()
        v, cid = np.stack(b["v"].to_numpy()), b["cid"].to_numpy()
        parts = [nearest_of(v[at:at + QUERIES], x, keep) for at in range(0, len(v), QUERIES)]
        i, j, d = (np.concatenate([p[c] + (at * QUERIES if c == 0 else 0) for at, p in enumerate(parts)]) for c in range(3))
        return pd.DataFrame({"cid": cid[i], "rid": rid[j], "d": d})

    keys = ["cell", "salt", "chunk"]
    # a task gets a bounded number of blocks, however many there are
    n = -(-sum(-(-sizes[c] // BLOCK) * -(-asked[c] // BLOCK) for c in asked) // BLOCKS)
    if n > 1:
        n = max(n, points.sparkSession.sparkContext.defaultParallelism)
        p, q = p.repartition(n, *keys), q.repartition(n, *keys)
    return p.groupBy(*keys).cogroup(q.groupBy(*keys)).applyInPandas(block, "cid long, rid long, d double")


def _pieces(batches):
    """The batches in pieces of at most ``PLACED`` rows."""
    for b in batches:
        for at in range(0, len(b), PLACED):
            yield b.iloc[at:at + PLACED]


def nearest_rows(df: DataFrame, columns: Sequence[str], k: int) -> tuple[DataFrame, DataFrame]:
    """(rows: rid, cid, x; near: cid, ns) with ns the k + 1 nearest rows (d, rid, x) of each point that has a
    row with missing cells."""
    rows, members = _points(df, columns, k + 1)
    members = reliable_checkpoint(members.withColumn("cid", F.min("rid").over(Window.partitionBy("v"))))
    distinct = members.where("rid = cid")
    n = distinct.count()
    cells = int(min(MAX_CELLS, max(1, np.sqrt(n))))
    centres = np.zeros((1, len(columns)))
    if cells > 1:
        fit = KMeans(k=cells, maxIter=5, seed=42, featuresCol="f").fit(distinct.select(array_to_vector("v").alias("f")))
        centres = np.array(fit.clusterCenters())

    def place(batches):
        for b in _pieces(batches):
            d = np.sqrt(((np.stack(b["v"].to_numpy())[:, None, :] - centres[None]) ** 2).sum(axis=2))
            yield b.assign(cell=d.argmin(axis=1), far=d.min(axis=1))

    members = reliable_checkpoint(members.mapInPandas(place, "rid long, v array<double>, x array<double>, cid long, cell int, far double"))
    got = members.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("r")).collect()   # a row per cell
    sizes, radius = {r["cell"]: r["n"] for r in got}, {r["cell"]: r["r"] for r in got}
    open_points = rows.where(F.exists("x", lambda c: c.isNull())).select("v").distinct()
    queries = reliable_checkpoint(members.where("rid = cid").join(open_points, "v", "left_semi").select("cell", "v", "cid"))
    count = lambda q: {r["cell"]: r["count"] for r in q.groupBy("cell").count().collect()}  # noqa: E731  a row per cell
    points = members.select("cell", "v", "rid")
    best = Window.partitionBy("cid").orderBy("d", "rid")
    first = _nearest(points, queries, sizes, count(queries), k + 1)
    first = reliable_checkpoint(first.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1).drop("_n"))
    limit = first.groupBy("cid").agg(F.when(F.count("*") > k, F.max("d")).alias("limit"))

    reach = np.array([radius.get(c, -np.inf) for c in range(len(centres))])

    def widen(batches):
        for b in _pieces(batches):
            v = np.stack(b["v"].to_numpy())
            own, top = b["cell"].to_numpy(), b["limit"].to_numpy(float)
            d = np.sqrt(((v[:, None, :] - centres[None]) ** 2).sum(axis=2))
            fits = np.isnan(top)[:, None] | (d - reach[None] <= top[:, None] + 10.0 ** -PLACES)
            i, c = np.nonzero(fits & (reach[None] >= 0) & (np.arange(len(centres))[None] != own[:, None]))
            yield pd.DataFrame({"cell": c.astype(np.int32), "v": b["v"].to_numpy()[i], "cid": b["cid"].to_numpy()[i]})

    more = reliable_checkpoint(queries.join(limit, "cid", "left").mapInPandas(widen, "cell int, v array<double>, cid long"))
    asked = count(more)
    if asked:
        first = first.union(_nearest(points, more, sizes, asked, k + 1))
    top = first.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1)
    ns = top.join(members.select("rid", "x"), "rid").groupBy("cid").agg(
        F.array_sort(F.collect_list(F.struct("d", "rid", "x"))).alias("ns"))   # k + 1 at most
    ids = members.where("rid = cid").select("v", "cid")
    return rows.join(ids, "v").select("rid", "cid", "x"), ns


def impute_knn(df: DataFrame, columns: Sequence[str], *, keys: Sequence[str] = ("patient", "anchor"), k: int = 10) -> DataFrame:
    """``df`` with the missing cells of ``columns`` filled from the k nearest rows; ``keys`` order the rows."""
    base = reliable_checkpoint(global_ordinal(df, order_by=list(keys), name="rid"))
    rows, near = nearest_rows(base, columns, k)
    others = F.slice(F.filter("ns", lambda n: n["rid"] != F.col("rid")), 1, k)
    j = rows.join(near, "cid").select("rid", others.alias("ns"))
    def filled(i):
        known = F.filter("ns", lambda n: n["x"][i].isNotNull())
        weight = lambda n: 1 / (n["d"] + EPSILON)
        value = F.aggregate(known, F.lit(0.0), lambda s, n: s + weight(n) * n["x"][i])
        return F.try_divide(value, F.aggregate(known, F.lit(0.0), lambda s, n: s + weight(n))).alias(f"_k{i}")

    cells = [filled(i) for i in range(len(columns))]
    j = j.select("rid", *cells)
    out = base.join(j, "rid", "left")
    return out.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"_k{i}")) for i, c in enumerate(columns)}).drop(
        "rid", *[f"_k{i}" for i in range(len(columns))])


def impute_complex(df: DataFrame, columns: Sequence[str], **kw) -> DataFrame:
    """Presence indicators (I3), then I5."""
    return impute_knn(impute_indicator(df, columns), columns, **kw)


METHODS["KNN"] = impute_knn
METHODS["complex"] = impute_complex
