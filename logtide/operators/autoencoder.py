"""Autoencoder: full-batch training as sums over the cluster, scoring as expressions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.functions.patterns import NUMERIC_FEATURES
from logtide.functions.quantiles import exact_quantile


def layer_sizes(inputs: int) -> list[int]:
    """d, d/2, d/4, d/2, d"""
    if not inputs:
        raise ValueError("the autoencoder needs at least one input column")
    return [inputs, inputs // 2, inputs // 4, inputs // 2, inputs]


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def _sum(parts: Sequence[Column]) -> Column:
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total


def _bound(value: Column, then) -> Column:
    """`then(value)`, with the value computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


@dataclass
class Autoencoder:
    """Weights per layer (outputs x inputs) and biases."""

    columns: list[str]
    weights: list[np.ndarray]
    biases: list[np.ndarray]
    losses: list[float] = field(default_factory=list)
    threshold: float | None = None

    @classmethod
    def initial(cls, columns: Sequence[str] = NUMERIC_FEATURES, seed: int = 0) -> Autoencoder:
        """Uniform in +-1/sqrt(inputs of the layer)."""
        rng = np.random.default_rng(seed)
        sizes = layer_sizes(len(columns))
        weights, biases = [], []
        for inputs, outputs in zip(sizes, sizes[1:], strict=False):
            bound = 1 / np.sqrt(max(inputs, 1))
            weights.append(rng.uniform(-bound, bound, (outputs, inputs)))
            biases.append(rng.uniform(-bound, bound, outputs))
        return cls(list(columns), weights, biases)

    def parameters(self) -> np.ndarray:
        return np.concatenate([p.ravel() for pair in zip(self.weights, self.biases) for p in pair])

    def replaced(self, flat: np.ndarray) -> Autoencoder:
        weights, biases, at = [], [], 0
        for w, b in zip(self.weights, self.biases, strict=True):
            weights.append(flat[at : at + w.size].reshape(w.shape))
            biases.append(flat[at + w.size : at + w.size + b.size])
            at += w.size + b.size
        return Autoencoder(self.columns, weights, biases, list(self.losses), self.threshold)

    def outputs(self, x: np.ndarray) -> list[np.ndarray]:
        """The input and what each layer makes of it."""
        found = [x]
        last = len(self.weights) - 1
        for i, (w, b) in enumerate(zip(self.weights, self.biases, strict=True)):
            z = found[-1] @ w.T + b
            found.append(_sigmoid(z) if i == last else np.maximum(z, 0))
        return found

    def gradient(self, x: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, float]:
        """Summed gradient and squared error of the rows, each counted `share` times."""
        outputs = self.outputs(x)
        last, y = len(self.weights) - 1, outputs[-1]
        error = y - x
        delta = 2 * error * y * (1 - y) * share[:, None]
        parts: list[np.ndarray] = []
        for i in range(last, -1, -1):
            parts = [(delta.T @ outputs[i]).ravel(), delta.sum(axis=0), *parts]
            delta = (delta @ self.weights[i]) * (outputs[i] > 0)
        return np.concatenate(parts), float((error**2 * share[:, None]).sum())

    def error(self) -> Column:
        """Mean squared reconstruction error of a row as a column expression.

        Each layer is bound to a lambda variable, so that it is computed once a row. An
        input that is NULL or no number gives NULL.
        """
        x = F.array(*[F.col(c).cast("double") for c in self.columns])
        last = len(self.weights) - 1

        def squares(given: Column, made: Column) -> Column:
            parts = [F.pow(given[i] - made[i], F.lit(2.0)) for i in range(len(self.columns))]
            return _sum(parts) / len(self.columns)

        def layer(i: int, given: Column, value: Column) -> Column:
            outputs = []
            for weights, bias in zip(self.weights[i].tolist(), self.biases[i].tolist(), strict=True):
                z = _sum([value[j] * w for j, w in enumerate(weights)]) + bias
                z = F.greatest(F.lit(-700.0), F.least(F.lit(700.0), z)) if i == last else z
                outputs.append(1 / (1 + F.exp(-z)) if i == last else F.greatest(z, F.lit(0.0)))
            made = F.array(*outputs)
            after = squares if i == last else lambda g, m: layer(i + 1, g, m)
            return _bound(made, lambda m: after(given, m))

        missing = _sum([F.col(c).cast("double") for c in self.columns])
        found = _bound(x, lambda v: layer(0, v, v))
        return F.when(missing.isNotNull() & ~F.isnan(missing) & (F.abs(missing) < float("inf")), found)

    def label(
        self, table: DataFrame, percentile: float = 90, threshold: float | None = None,
        label: str = "autoencoder_label",
    ) -> DataFrame:
        """1 where the error is above the percentile of this very batch (or a stored threshold)."""
        scored = table.withColumn("_error", self.error())
        if threshold is None:
            threshold = exact_quantile(scored, "_error", percentile / 100)
        flag = F.coalesce(F.col("_error") > threshold, F.lit(False)).cast("int")
        return scored.withColumn(label, flag).drop("_error")


def train_autoencoder(
    table: DataFrame,
    columns: Sequence[str] = NUMERIC_FEATURES,
    epochs: int = 20,
    learning_rate: float = 1e-3,
    seed: int = 0,
) -> Autoencoder:
    """Full-batch Adam. Each epoch is one job: every partition returns one row of
    summed gradients, so only as many numbers as the model has reach the driver."""
    columns = list(columns)
    model = Autoencoder.initial(columns, seed)
    vectors = (
        table.dropna(subset=columns)
        .groupBy(*[F.col(c).cast("double").alias(c) for c in columns])
        .agg(F.count(F.lit(1)).cast("double").alias("_w"))
        .persist()
    )
    try:
        rows = vectors.agg(F.sum("_w")).first()[0]
        if not rows:
            raise ValueError("no rows to train on")
        flat = model.parameters()
        mean, spread = np.zeros_like(flat), np.zeros_like(flat)
        for epoch in range(1, epochs + 1):
            model = model.replaced(flat)
            gradient, loss = epoch_sums(vectors, model)
            gradient, loss = gradient / (rows * len(columns)), loss / (rows * len(columns))
            model.losses.append(loss)
            mean = 0.9 * mean + 0.1 * gradient
            spread = 0.999 * spread + 0.001 * gradient**2
            step = (mean / (1 - 0.9**epoch)) / (np.sqrt(spread / (1 - 0.999**epoch)) + 1e-8)
            flat = flat - learning_rate * step
        return model.replaced(flat)
    finally:
        vectors.unpersist()


def epoch_sums(vectors: DataFrame, model: Autoencoder) -> tuple[np.ndarray, float]:
    """Gradient and squared error summed over all rows, each counted `_w` times."""
    size = model.parameters().size
    columns = model.columns

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, any_rows = np.zeros(size + 1), False
        for batch in batches:
            if len(batch):
                any_rows = True
                gradient, error = model.gradient(
                    batch[columns].to_numpy(dtype="float64"), batch["_w"].to_numpy()
                )
                total += np.append(gradient, error)
        if any_rows:
            yield pd.DataFrame({"i": np.arange(size + 1), "part": total})

    sums = vectors.mapInPandas(partial, "i int, part double").groupBy("i").agg(F.sum("part"))
    found = np.zeros(size + 1)
    for i, total in sums.collect():
        found[i] = total
    return found[:-1], float(found[-1])
