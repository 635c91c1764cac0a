"""Boosted trees as arrays: tree SHAP attribution (M13) and scores of prefixes of the rounds.

The attribution is path-dependent tree SHAP with node counts as cover.  A leaf's share of a
coalition's value is a product over the features on its path: 1 or 0 for known features (the row
passes their splits or not), the cover ratio of their splits for the others; so the Shapley value
of a feature is a sum over the coefficients of one small polynomial per leaf.  Base + values =
the model margin.

The tree arrays are model parameters (bounded by the number of nodes) and are
shipped with the function; rows are processed in Arrow batches by
``mapInPandas`` and never leave their partition.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tree_arrays(model) -> list[dict]:
    """Flatten each tree of a fitted GBT model into arrays (feature, threshold,
    left, right, value, cover, weight); continuous splits only."""
    out = []
    for tree, w in zip(model.trees, model.treeWeights):
        feat, thr, left, right, val, cover = [], [], [], [], [], []
        stack = [(tree._java_obj.rootNode(), None, None)]
        while stack:
            node, parent, side = stack.pop()
            i = len(val)
            val.append(float(node.prediction()))
            cover.append(float(node.impurityStats().count()))
            if parent is not None:
                (left if side == "L" else right)[parent] = i
            if node.getClass().getSimpleName() == "InternalNode":
                split = node.split()
                if split.getClass().getSimpleName() != "ContinuousSplit":
                    raise ValueError("only continuous splits are supported")
                feat.append(int(split.featureIndex()))
                thr.append(float(split.threshold()))
                left.append(-1)
                right.append(-1)
                stack.append((node.rightChild(), i, "R"))
                stack.append((node.leftChild(), i, "L"))
            else:
                feat.append(-1)
                thr.append(0.0)
                left.append(-1)
                right.append(-1)
        out.append({"feature": np.array(feat), "threshold": np.array(thr), "left": np.array(left),
                    "right": np.array(right), "value": np.array(val), "cover": np.array(cover), "weight": float(w)})
    return out


def _leaves(tree: dict):
    """(value, [(feature, threshold, goes left, cover ratio)...]) of each leaf."""
    todo = [(0, [])]
    while todo:
        node, path = todo.pop()
        if tree["feature"][node] < 0:
            yield tree["value"][node], path
            continue
        for child, is_left in ((tree["left"][node], True), (tree["right"][node], False)):
            ratio = tree["cover"][child] / tree["cover"][node]
            todo.append((child, [*path, (tree["feature"][node], tree["threshold"][node], is_left, ratio)]))


def shapley_values(x: np.ndarray, trees: list[dict]) -> tuple[np.ndarray, float]:
    """(values of each row and feature, base value) of the weighted sum of trees."""
    n, d = x.shape
    out, base = np.zeros((n, d)), 0.0
    for tree in trees:
        for value, path in _leaves(tree):
            known, ratio = {}, {}   # per feature on the path: does the row pass, share of cover
            for f, threshold, is_left, r in path:
                passes = (x[:, f] <= threshold) == is_left
                known[f] = known[f] & passes if f in known else passes
                ratio[f] = ratio.get(f, 1.0) * r
            w, m = tree["weight"] * value, len(known)
            base += w * math.prod(ratio.values())
            for i in known:
                # coefficients, by size of the coalition, of the product over the other features
                c = [np.ones(n)]
                for j in known:
                    if j != i:
                        z, o = ratio[j], known[j]
                        c = [(c[k] * z if k < len(c) else 0) + (c[k - 1] * o if k else 0) for k in range(len(c) + 1)]
                size = sum(c[k] * (math.factorial(k) * math.factorial(m - 1 - k) / math.factorial(m)) for k in range(m))
                out[:, i] += w * (known[i] - ratio[i]) * size
    return out, base


def tree_values(x: np.ndarray, tree: dict) -> np.ndarray:
    """Weighted prediction of one tree for each row."""
    node = np.zeros(len(x), np.int64)
    rows = np.arange(len(x))
    while (inner := tree["feature"][node] >= 0).any():
        at = node[inner]
        left = x[rows[inner], tree["feature"][at]] <= tree["threshold"][at]
        node[inner] = np.where(left, tree["left"][at], tree["right"][at])
    return tree["weight"] * tree["value"][node]


def prefix_scores(model, data: DataFrame, prefixes: Sequence[int], *, columns: Sequence[str],
                  features_col: str = "features") -> DataFrame:
    """``columns`` of ``data``, ``n_trees`` and the probability ``p`` of the first ``n_trees`` rounds, for each
    of ``prefixes``: without row sampling the first rounds of a long fit are those of a short one."""
    trees, wanted = tree_arrays(model), sorted(set(prefixes))
    kinds = [f"{c} {data.schema[c].dataType.simpleString()}" for c in columns]

    def run(batches):
        for pdf in batches:
            x = np.stack(pdf["_x"].to_numpy()) if len(pdf) else np.zeros((0, 1))
            margin, done = np.zeros(len(pdf)), 0
            for n in wanted:
                for t in trees[done:n]:
                    margin = margin + tree_values(x, t)
                done = max(done, min(n, len(trees)))
                yield pdf[list(columns)].assign(n_trees=n, p=1 / (1 + np.exp(-2 * margin)))

    x = data.select(*columns, vector_to_array(F.col(features_col)).alias("_x"))
    return x.mapInPandas(run, schema=", ".join([*kinds, "n_trees int", "p double"]))


def attribution(model, data: DataFrame, feature_names: Sequence[str], *, key: str,
                features_col: str = "features") -> DataFrame:
    """Long table (key, feature, contribution) plus one '_base' row per key
    and one '_margin' row (base + contributions)."""
    trees = tree_arrays(model)
    names = list(feature_names)
    key_type = data.schema[key].dataType.simpleString()

    def run(batches):
        for pdf in batches:
            x = np.stack(pdf["_x"].to_numpy()) if len(pdf) else np.zeros((0, len(names)))
            c, base = shapley_values(x, trees)
            ids = pdf[key].to_numpy()
            long = pd.DataFrame({key: np.repeat(ids, len(names)),
                                 "feature": np.tile(names, len(ids)),
                                 "contribution": c.reshape(-1)})
            extra = pd.DataFrame({key: np.concatenate([ids, ids]),
                                  "feature": ["_base"] * len(ids) + ["_margin"] * len(ids),
                                  "contribution": np.concatenate([np.full(len(ids), base),
                                                                  base + c.sum(axis=1)])})
            yield pd.concat([long, extra], ignore_index=True)

    x = data.select(key, vector_to_array(F.col(features_col)).alias("_x"))
    return x.mapInPandas(run, schema=f"{key} {key_type}, feature string, contribution double")
