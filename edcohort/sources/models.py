"""Fitted-model store (S9): MLlib persistence by algorithm type."""

from __future__ import annotations

from pyspark.ml.classification import (GBTClassificationModel, LogisticRegressionModel,
                                       MultilayerPerceptronClassificationModel,
                                       RandomForestClassificationModel)

MODEL_TYPES = {
    "gbt": GBTClassificationModel,
    "gbt_leafwise": GBTClassificationModel,
    "logistic": LogisticRegressionModel,
    "random_forest": RandomForestClassificationModel,
    "neural_net": MultilayerPerceptronClassificationModel,
}


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str, kind: str):
    if kind not in MODEL_TYPES:
        raise ValueError(f"unknown model type {kind!r}; expected one of {sorted(MODEL_TYPES)}")
    return MODEL_TYPES[kind].load(path)
