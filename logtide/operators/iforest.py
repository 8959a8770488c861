"""Isolation forest: trees grown in parallel from small samples, scored anywhere."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logtide.functions.patterns import NUMERIC_FEATURES
from logtide.functions.quantiles import exact_quantile

NODE_SCHEMA = "tree int, node int, feature int, threshold double, low int, high int, path double"
EULER_GAMMA = 0.5772156649015329


def average_path(n):
    """Mean depth of an unsuccessful search among n points."""
    n = np.asarray(n, dtype="float64")
    big = np.maximum(n, 3)
    usual = 2 * (np.log(big - 1) + EULER_GAMMA) - 2 * (big - 1) / big
    return np.where(n <= 1, 0.0, np.where(n <= 2, 1.0, usual))


@dataclass
class IsolationForest:
    """Fitted trees as rows: at most `trees * (2 * sample_size - 1)` of them."""

    nodes: pd.DataFrame
    columns: list[str]
    sample_size: int
    threshold: float | None = None

    def score(self) -> Column:
        """Normality in (-1, 0); lower is more anomalous."""
        trees = [
            group.sort_values("node")[["feature", "threshold", "low", "high", "path"]].to_numpy().T
            for _, group in self.nodes.groupby("tree")
        ]
        usual = float(average_path(self.sample_size))

        @F.pandas_udf("double")
        def normality(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in batches:
                points = np.column_stack([c.to_numpy(dtype="float64") for c in columns])
                depth = np.zeros(len(points))
                for tree in trees:
                    depth += _path_lengths(tree, points)
                yield pd.Series(-np.exp2(-depth / len(trees) / max(usual, 1e-12)))

        return normality(*[F.col(c).cast("double") for c in self.columns])

    def label(self, table: DataFrame, label: str = "isolation_forest_label") -> DataFrame:
        scored = table.withColumn("_normality", self.score())
        flag = (F.col("_normality") < self.threshold).cast("int")
        return scored.withColumn(label, flag).drop("_normality")


def _path_lengths(tree: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Walk all points down one tree, a level per step."""
    feature, low, high = (tree[i].astype("int64") for i in (0, 2, 3))
    at = np.zeros(len(points), dtype="int64")
    inner = np.flatnonzero(feature[at] >= 0)
    while inner.size:
        here = at[inner]
        smaller = points[inner, feature[here]] <= tree[1][here]
        at[inner] = np.where(smaller, low[here], high[here])
        inner = inner[feature[at[inner]] >= 0]
    return tree[4][at]


def _grow(sample: np.ndarray, max_depth: int, rng: np.random.Generator) -> list[tuple]:
    """Random splits until points are alone, equal or at the depth limit."""
    nodes: list[list] = [[-1, 0.0, -1, -1, 0.0]]
    waiting = [(0, sample, 0)]
    while waiting:
        node, points, depth = waiting.pop()
        lowest, highest = points.min(axis=0), points.max(axis=0)
        usable = np.flatnonzero(lowest < highest)
        if depth >= max_depth or len(points) <= 1 or not usable.size:
            nodes[node][4] = depth + float(average_path(len(points)))
            continue
        feature = int(rng.choice(usable))
        cut = float(rng.uniform(lowest[feature], highest[feature]))
        if cut >= highest[feature]:  # neighbouring doubles leave nothing in between
            cut = float(lowest[feature])
        left = points[:, feature] <= cut
        children = [len(nodes), len(nodes) + 1]
        nodes[node][:4] = [feature, cut, *children]
        for child, part in zip(children, (points[left], points[~left]), strict=True):
            nodes.append([-1, 0.0, -1, -1, 0.0])
            waiting.append((child, part, depth + 1))
    return [tuple(node) for node in nodes]


def tree_samples(
    table: DataFrame, keys: Sequence[str], columns: Sequence[str], rows: int,
    trees: int, sample_size: int, seed: int,
) -> DataFrame:
    """`sample_size` rows per tree, drawn by hashes of (keys, seed).

    The draw depends on no partitioning. Every row is a candidate of each tree with the
    same small chance, which leaves a few more per tree than needed, so ranking sees a
    bounded number and not the table. The trees of a row are found by skipping: hashes
    give the number of trees up to the next that takes it. Most rows skip all trees and
    are gone after one hash, so only candidates become rows of trees.
    """
    wanted = min(sample_size, rows)
    share = min(1.0, (wanted + 12 * wanted**0.5 + 50) / max(rows, 1))
    # 53 bits, so that the comparison is exact in double precision.
    draw = F.shiftrightunsigned(F.xxhash64(*keys, "tree", F.lit(seed)), 11)
    if share >= 1:  # a few hundred rows, each a candidate of every tree
        taking = F.sequence(F.lit(0), F.lit(trees - 1))
        some = table
    else:
        first = _skipped(keys, seed, F.lit(0), share)
        some = table.withColumn("_first", first).filter(F.col("_first") < trees)
        taking = _taking(keys, seed, share, trees)
    candidates = some.select(*keys, *columns, F.explode(taking).alias("tree")).withColumn("_draw", draw)
    ranked = Window.partitionBy("tree").orderBy("_draw", *keys)
    return (
        candidates.withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") <= wanted)
        .select("tree", "_rank", *[F.col(c).cast("double").alias(c) for c in columns])
    )


def _skipped(keys: Sequence[str], seed: int, step: Column, share: float) -> Column:
    """How many trees are passed before the next that takes the row: geometric by inversion."""
    bits = F.shiftrightunsigned(F.xxhash64(*keys, F.lit(seed), F.lit("skip"), step), 11)
    uniform = (bits + F.lit(0.5)) / F.lit(float(2**53))
    return F.floor(F.log(uniform) / F.lit(math.log1p(-share)))


def _taking(keys: Sequence[str], seed: int, share: float, trees: int) -> Column:
    """All trees that take a row, from the first (`_first`) on."""

    def step(held: Column, i: Column) -> Column:
        found = held[F.size(held) - 1] + 1 + _skipped(keys, seed, i, share)
        return F.concat(held, F.array(found))

    # A row is taken again and again until its trees are used up, so steps past the end
    # add numbers that are left out.
    every = F.aggregate(
        F.sequence(F.lit(1), F.lit(trees - 1)),
        F.array(F.col("_first")),
        lambda held, i: F.when(held[F.size(held) - 1] < trees, step(held, i)).otherwise(held),
    )
    return F.filter(every, lambda t: t < trees)


def fit_isolation_forest(
    table: DataFrame,
    keys: Sequence[str] = ("window_start",),
    columns: Sequence[str] = NUMERIC_FEATURES,
    contamination: float = 0.1,
    trees: int = 100,
    sample_size: int = 256,
    seed: int = 0,
) -> IsolationForest:
    """Grow the trees, then set the threshold to the contamination quantile of all scores."""
    columns = list(columns)
    known = table.dropna(subset=columns)
    rows = known.count()
    if rows == 0:
        raise ValueError("no rows to fit on")
    psi = min(sample_size, rows)
    max_depth = int(np.ceil(np.log2(max(psi, 2))))

    def grow(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        sample = group.sort_values("_rank")[columns].to_numpy(dtype="float64")
        nodes = _grow(sample, max_depth, np.random.default_rng([seed, int(key[0])]))
        out = pd.DataFrame(nodes, columns=["feature", "threshold", "low", "high", "path"])
        out.insert(0, "node", np.arange(len(out)))
        out.insert(0, "tree", int(key[0]))
        return out

    samples = tree_samples(known, keys, columns, rows, trees, sample_size, seed)
    # Bounded by construction: trees * (2 * psi - 1) rows of seven numbers.
    nodes = samples.groupBy("tree").applyInPandas(grow, NODE_SCHEMA).toPandas()
    forest = IsolationForest(nodes, columns, psi)
    scores = known.select(forest.score().alias("score"))
    forest.threshold = exact_quantile(scores, "score", contamination)
    return forest
