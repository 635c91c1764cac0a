"""Chained regressions (I7, MICE) from the moments of each pattern of missing cells.

Every imputed cell is a linear function of the observed cells of its row: the regressions are linear, and so is a chain
of them.  So all that a regression needs, the second moments of the completed table over the rows where its target is
observed, follows from the moments of the *observed* cells of each pattern of missing columns, and those
never change: one aggregate over the rows serves all rounds and columns.  The chain then runs on the patterns' small
matrices, on the driver while they are few, else as one small job per regression over the table of patterns; either way
the numbers are those of a chain over the rows.  Only the coefficients go back to the rows.

A regression is the Bayesian ridge of the source's imputer (precisions of noise and weights estimated by evidence).  Columns are
done from the fewest missing cells to the most, starting from column means, until no column's imputed cells move by more
than ``tol`` of its standard deviation (root mean square), or ``max_rounds`` times.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint

#: Numbers in the patterns' matrices up to which the driver holds them (32 MB).
DRIVER_NUMBERS = 4_000_000
#: Patterns that a task adds up at a time.
TASK_PATTERNS = 4096


def bayesian_ridge(gram: np.ndarray, target: int, *, max_iter: int = 300, tol: float = 1e-3) -> np.ndarray:
    """Weights over (1, columns) that predict column ``target`` (1-based in the moment matrix ``gram`` of (1, columns)); 0 for
    the target itself."""
    n = gram[0, 0]
    others = np.array([i for i in range(1, len(gram)) if i != target], np.int64)
    out = np.zeros(len(gram))
    if not n:
        return out
    mean = gram[0] / n
    centred = gram - n * np.outer(mean, mean)
    xx, xy, yy = centred[np.ix_(others, others)], centred[others, target], max(centred[target, target], 0.0)
    values, vectors = np.linalg.eigh(xx)
    values, along = np.maximum(values, 0), vectors.T @ xy
    alpha, lam, old = 1 / (yy / n + np.finfo(float).eps), 1.0, None
    coef = np.zeros(len(others))
    for _ in range(max_iter):
        coef = vectors @ (along / (values + lam / alpha))
        rest = max(yy - 2 * coef @ xy + coef @ xx @ coef, 0.0)
        gamma = (alpha * values / (lam + alpha * values)).sum()
        lam = (gamma + 2e-6) / (coef @ coef + 2e-6)
        alpha = (n - gamma + 2e-6) / (rest + 2e-6)
        if old is not None and np.abs(old - coef).sum() < tol:
            break
        old = coef
    coef = vectors @ (along / (values + lam / alpha))
    out[others] = coef
    out[0] = mean[target] - mean[others] @ coef
    return out


class Patterns:
    """Patterns of missing columns, the moments of their observed cells, and the map from (1, observed cells) to the
    completed row that the chain so far stands for."""

    def __init__(self, missing: np.ndarray, moments: np.ndarray):
        self.missing, self.moments = missing, moments  # (p, d) booleans, (p, d + 1, d + 1)
        p, d = missing.shape
        self.maps = np.zeros((p, d + 1, d + 1))
        self.maps[:, 0, 0] = 1
        i, j = np.nonzero(~missing)
        self.maps[i, j + 1, j + 1] = 1

    def replace(self, column: int, weights: np.ndarray) -> float:
        """Impute the column anew; returns the sum of the squared changes of its cells."""
        own = np.flatnonzero(self.missing[:, column])
        new = np.einsum("i,pij->pj", weights, self.maps[own])
        moved = new - self.maps[own, column + 1]
        self.maps[own, column + 1] = new
        return float(np.einsum("pi,pij,pj->", moved, self.moments[own], moved))

    def replay(self, steps: Sequence[tuple[int, np.ndarray]]) -> float:
        moved = 0.0
        for column, weights in steps:
            moved = self.replace(column, weights)
        return moved

    def gram(self, column: int) -> np.ndarray:
        """Moments of the completed rows in which the column is observed."""
        own = ~self.missing[:, column]
        return np.einsum("pij,pjk,plk->il", self.maps[own], self.moments[own], self.maps[own])


@dataclass
class Chain:
    """A fitted chain: the means that start it, its regressions in order, and the moves of each round and column."""
    columns: list[str]
    means: np.ndarray
    steps: list[tuple[int, np.ndarray]] = field(default_factory=list)
    moves: list[tuple[int, str, float]] = field(default_factory=list)
    rounds: int = 0
    converged: bool = False


def _moments(df: DataFrame, columns: Sequence[str], means: np.ndarray) -> DataFrame:
    """(pattern, moments): per pattern of missing columns the sums of the products of (1, observed cells less their means)."""
    d = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    schema, width = "pattern binary, moments binary", len(columns) + 1

    def table(sums):
        return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.binary()),
                                           pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["pattern", "moments"])

    def of_rows(batches):
        for b in batches:
            x = np.column_stack([np.asarray(c.to_numpy(zero_copy_only=False), float) for c in b.columns]) - means
            missing = np.isnan(x)
            x = np.column_stack([np.ones(len(x)), np.where(missing, 0, x)])
            kinds, which = np.unique(missing, axis=0, return_inverse=True)
            order = np.argsort(which.ravel(), kind="stable")
            ends = np.searchsorted(which.ravel()[order], np.arange(len(kinds) + 1))
            yield table({np.packbits(k).tobytes(): x[order[a:z]].T @ x[order[a:z]]
                         for k, a, z in zip(kinds, ends[:-1], ends[1:], strict=True)})

    def added(batches):  # sorted by pattern
        last, total = None, None
        done = {}
        for b in batches:
            for pattern, data in zip(b.column("pattern").to_pylist(), b.column("moments").to_pylist(), strict=True):
                value = np.frombuffer(data).reshape(width, width)
                if pattern != last:
                    if last is not None:
                        done[last] = total
                    last, total = pattern, value
                else:
                    total = total + value
            if len(done) >= TASK_PATTERNS:
                yield table(done)
                done = {}
        if last is not None:
            done[last] = total
        yield table(done)

    return d.mapInArrow(of_rows, schema).repartition("pattern").sortWithinPartitions("pattern").mapInArrow(added, schema)


def _patterns(rows, n_columns: int) -> Patterns:
    missing = np.array([np.unpackbits(np.frombuffer(p, np.uint8))[:n_columns] for p, _ in rows], bool).reshape(-1, n_columns)
    moments = np.array([np.frombuffer(m).reshape(n_columns + 1, -1) for _, m in rows]).reshape(len(rows), n_columns + 1, n_columns + 1)
    return Patterns(missing, moments)


def _over_table(patterns: DataFrame, n_columns: int, steps, column: int) -> tuple[np.ndarray, float]:
    """(moments for the next regression of ``column``, sum of squared changes of the last step), over the table of patterns."""
    def run(batches):
        gram, moved = np.zeros((n_columns + 1, n_columns + 1)), 0.0
        for b in batches:
            rows = list(zip(b.column("pattern").to_pylist(), b.column("moments").to_pylist(), strict=True))
            for at in range(0, len(rows), TASK_PATTERNS):
                p = _patterns(rows[at:at + TASK_PATTERNS], n_columns)
                moved += p.replay(steps)
                gram = gram + p.gram(column)
        yield pa.RecordBatch.from_arrays([pa.array([gram.tobytes()], pa.binary()), pa.array([moved])], names=["gram", "moved"])

    got = patterns.mapInArrow(run, "gram binary, moved double").collect()  # one small matrix per partition
    return sum(np.frombuffer(r.gram).reshape(n_columns + 1, -1) for r in got), sum(r.moved for r in got)


def fit_chain(df: DataFrame, columns: Sequence[str], *, max_rounds: int = 10, tol: float = 1e-3,
              driver_numbers: int = DRIVER_NUMBERS) -> Chain:
    """The chain of regressions of ``columns``; those without any value take no part."""
    cells = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns]
    stats = df.agg(F.count("*"), *[f(x) for x in cells for f in (F.count, F.avg, F.stddev_pop)]).first()
    n_rows, counts, means, sds = stats[0], stats[1::3], stats[2::3], stats[3::3]
    used = [i for i, n in enumerate(counts) if n]
    chain = Chain([columns[i] for i in used], np.array([means[i] for i in used], float))
    gaps = [n_rows - counts[i] for i in used]
    order = sorted((k for k in range(len(used)) if gaps[k]), key=lambda k: (gaps[k], k))
    if not order:
        chain.converged = True
        return chain
    table = reliable_checkpoint(_moments(df, chain.columns, chain.means))
    d = len(used)
    local = None
    if table.count() * (d + 1) ** 2 <= driver_numbers:
        local = _patterns([tuple(r) for r in table.collect()], d)
    gram = None
    for chain.rounds in range(1, max_rounds + 1):
        largest = 0.0
        for at, k in enumerate(order):
            if local is None and gram is None:
                gram, _ = _over_table(table, d, [], k)
            weights = bayesian_ridge(local.gram(k) if local is not None else gram, k + 1)
            chain.steps.append((k, weights))
            if local is not None:
                moved = local.replace(k, weights)
            else:
                gram, moved = _over_table(table, d, chain.steps, order[(at + 1) % len(order)])
            move = (max(moved, 0.0) / gaps[k]) ** 0.5
            chain.moves.append((chain.rounds, chain.columns[k], move))
            largest = max(largest, move / (sds[used[k]] or 1.0))
        if largest < tol:
            chain.converged = True
            break
    return chain


def apply_chain(df: DataFrame, chain: Chain) -> DataFrame:
    """``df`` with the missing cells of the chain's columns (as doubles) filled; other columns are untouched."""
    place = [df.columns.index(c) for c in chain.columns]
    kinds = ", ".join(f"`{f.name}` {'double' if f.name in chain.columns else f.dataType.simpleString()}" for f in df.schema.fields)
    d, means, steps = len(place), chain.means, chain.steps
    df = df.withColumns({c: F.col(c).cast("double") for c in chain.columns})

    def run(batches):
        maps: dict[bytes, np.ndarray] = {}
        for b in batches:
            x = np.column_stack([np.asarray(b.column(i).to_numpy(zero_copy_only=False), float)
                                 for i in place]) - means if d else np.zeros((b.num_rows, 0))
            missing = np.isnan(x)
            filled = np.column_stack([np.ones(len(x)), np.where(missing, 0, x)])
            kinds_, which = np.unique(missing, axis=0, return_inverse=True)
            for i, kind in enumerate(kinds_):
                name = np.packbits(kind).tobytes()
                if name not in maps:
                    if len(maps) >= TASK_PATTERNS:
                        maps.clear()
                    p = Patterns(kind[None], np.zeros((1, d + 1, d + 1)))
                    p.replay(steps)
                    maps[name] = p.maps[0]
                rows = np.flatnonzero(which.ravel() == i)
                x[rows] = np.where(kind, (filled[rows] @ maps[name].T)[:, 1:], x[rows])
            columns = list(b.columns)
            for j, i in enumerate(place):
                columns[i] = pa.array(np.where(missing[:, j], x[:, j] + means[j],
                                               np.asarray(columns[i].to_numpy(zero_copy_only=False), float)))
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)

    return df.mapInArrow(run, kinds) if d else df


def impute_chained(df: DataFrame, columns: Sequence[str], **kw) -> DataFrame:
    """``df`` with the missing cells of ``columns`` (nulls and NaN) imputed by chained regressions.  A column without any value stays
    empty and predicts nothing; without other columns, cells get the mean."""
    return apply_chain(df, fit_chain(df, columns, **kw))
