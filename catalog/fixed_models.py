"""Detectors with parameters set by rule, so that SQL can repeat their scores."""

from __future__ import annotations

import numpy as np
import pandas as pd

from logtide.functions.patterns import NUMERIC_FEATURES
from logtide.operators.autoencoder import Autoencoder, layer_sizes
from logtide.operators.iforest import IsolationForest, average_path

SAMPLE_SIZE = 256
# (feature, cut, leaf size when below or equal, next split or leaf size) per tree
TREES = [
    ("entropy_tokens", 3.3, 20, ("event_count", 1.0, 200, 36)),
    ("avg_msg_length", 40.0, 30, ("failed_auth_count", 0.0, 190, 36)),
    ("event_count", 2.0, ("avg_msg_length", 105.5, 246, 6), 4),
]


def fixed_forest() -> IsolationForest:
    rows = []
    for tree, split in enumerate(TREES):
        nodes: list[list] = []
        _add(nodes, split, 0)
        rows += [[tree, i, *node] for i, node in enumerate(nodes)]
    names = ["tree", "node", "feature", "threshold", "low", "high", "path"]
    return IsolationForest(pd.DataFrame(rows, columns=names), list(NUMERIC_FEATURES), SAMPLE_SIZE)


def _add(nodes: list[list], split, depth: int) -> int:
    at = len(nodes)
    nodes.append([-1, 0.0, -1, -1, 0.0])
    if isinstance(split, tuple):
        name, cut, low, high = split
        nodes[at][:2] = [NUMERIC_FEATURES.index(name), cut]
        nodes[at][2] = _add(nodes, low, depth + 1)
        nodes[at][3] = _add(nodes, high, depth + 1)
    else:
        nodes[at][4] = depth + float(average_path(split))
    return at


def _path_sql(split, depth: int = 0) -> str:
    if not isinstance(split, tuple):
        return repr(depth + float(average_path(split)))
    name, cut, low, high = split
    return (
        f"CASE WHEN {name} <= {cut!r} THEN {_path_sql(low, depth + 1)} "
        f"ELSE {_path_sql(high, depth + 1)} END"
    )


def forest_sql() -> str:
    depth = " + ".join(f"({_path_sql(split)})" for split in TREES)
    return f"-pow(2.0, -(({depth}) / {len(TREES)}) / {float(average_path(SAMPLE_SIZE))!r})"


def fixed_autoencoder() -> Autoencoder:
    sizes = layer_sizes(len(NUMERIC_FEATURES))
    weights, biases = [], []
    for layer, (inputs, outputs) in enumerate(zip(sizes, sizes[1:], strict=False)):
        o, i = np.indices((outputs, inputs))
        weights.append(((layer + 2 * o + 3 * i) % 5 - 1) / 50)
        biases.append((np.arange(outputs) % 3 - 1) / 10)
    return Autoencoder(list(NUMERIC_FEATURES), weights, biases)


def autoencoder_sql(source: str) -> str:
    """Common tables `layer0` .. `layer3` and `errors` over `source`."""
    model = fixed_autoencoder()
    inputs, previous, parts = list(NUMERIC_FEATURES), source, []
    last = len(model.weights) - 1
    for layer, (w, b) in enumerate(zip(model.weights, model.biases, strict=True)):
        cells = []
        for j in range(len(b)):
            z = " + ".join(f"{x}::DOUBLE * {float(v)!r}::DOUBLE" for x, v in zip(inputs, w[j], strict=True))
            z = f"({z} + {float(b[j])!r}::DOUBLE)"
            cells.append(
                f"1.0::DOUBLE / (1 + exp(-{z})) AS n{layer}_{j}"
                if layer == last
                else f"greatest({z}, 0) AS n{layer}_{j}"
            )
        parts.append(f"layer{layer} AS (SELECT *, {', '.join(cells)} FROM {previous})")
        inputs, previous = [f"n{layer}_{j}" for j in range(len(b))], f"layer{layer}"
    squares = " + ".join(
        f"pow({name} - {out}, 2)" for name, out in zip(NUMERIC_FEATURES, inputs, strict=True)
    )
    parts.append(f"errors AS (SELECT *, ({squares}) / {len(inputs)} AS err FROM {previous})")
    return ",\n".join(parts)


def gradient_sql(source: str) -> str:
    """`WITH` tables and a SELECT of i, mean: derivatives of the squared error by each parameter.

    Parameters count layer by layer, weights row by row before biases; the last row is
    the squared error itself. Means over rows, as sums depend on how many there are.
    """
    model = fixed_autoencoder()
    last = len(model.weights) - 1
    values = [list(NUMERIC_FEATURES)]
    values += [[f"n{layer}_{j}" for j in range(len(b))] for layer, b in enumerate(model.biases)]
    ys = values[-1]
    first = [f"2 * ({y} - {x}) * {y} * (1 - {y}) AS d{last}_{j}" for j, (y, x) in enumerate(zip(ys, values[0], strict=True))]
    parts = [f"delta{last} AS (SELECT *, {', '.join(first)} FROM errors)"]
    for layer in range(last - 1, -1, -1):
        weights = model.weights[layer + 1]
        cells = []
        for i, value in enumerate(values[layer + 1]):
            back = " + ".join(f"d{layer + 1}_{j} * {float(w)!r}::DOUBLE" for j, w in enumerate(weights[:, i]))
            cells.append(f"CASE WHEN {value} > 0 THEN {back} ELSE 0 END AS d{layer}_{i}")
        parts.append(f"delta{layer} AS (SELECT *, {', '.join(cells)} FROM delta{layer + 1})")
    sums = []
    for layer, biases in enumerate(model.biases):
        sums += [f"avg(d{layer}_{j} * {x})" for j in range(len(biases)) for x in values[layer]]
        sums += [f"avg(d{layer}_{j})" for j in range(len(biases))]
    sums.append(f"avg(err * {len(values[0])})")
    listed = f"SELECT unnest(range({len(sums)}))::INT AS i, unnest([{', '.join(sums)}]) AS mean FROM delta0"
    return f"{autoencoder_sql(source)}, {', '.join(parts)} SELECT i, round(mean, 5) + 0.0 AS mean FROM ({listed})"
