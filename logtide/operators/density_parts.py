"""Density noise in many real dimensions, by parts of space with margins.

Neighbouring cells cannot be listed in eight dimensions. Here space is cut at medians,
each time along the axis in which a part is widest, until a part holds a bounded number
of points or is no wider than the radius allows. A point belongs to one part and visits
every other part whose box it is within the radius of, so all neighbours of a point meet
it at home. Parts count neighbours and are done independently; a second pass brings the
cores of the margins to the points that are not settled.

Dense cells, so small that all their points are neighbours, need no counting: their
points are cores. Only points of sparse cells look around.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.functions.patterns import NUMERIC_FEATURES
from logtide.session import stored

#: Points that a part should hold at most, and cuts one below the other.
PART_POINTS, DEPTH = 4000, 40
#: Points of a part that meet as one group.
CHUNK = 16_000
#: Distances computed at once.
STEP = 4_000_000


def _vectors(points: DataFrame, dims: Sequence[str], eps: float, min_samples: int) -> DataFrame:
    """Distinct vectors x with weight w, and whether their cell is dense; stored."""
    known = points.dropna(subset=list(dims)).select(*[F.col(c).cast("double").alias(c) for c in dims])
    vectors = known.groupBy(*dims).agg(F.count(F.lit(1)).alias("w"))
    # Slightly under the exact width, so that rounding never breaks the promise of a cell.
    width = eps / math.sqrt(len(dims)) * (1 - 1e-9)
    cell = F.array(*[F.floor(F.col(c) / width) for c in dims])
    vectors = vectors.select(F.array(*dims).alias("x"), "w", cell.alias("cell"))
    dense = vectors.groupBy("cell").agg((F.sum("w") >= min_samples).alias("dense"))
    return stored(vectors.join(dense, "cell").drop("cell").withColumn("id", F.xxhash64("x")), "vectors")


def parts_of(vectors: DataFrame, dims: int, eps: float, most: int = PART_POINTS) -> DataFrame:
    """Vectors with `part`, once for every part they belong to or visit; `home` marks the former.

    Level by level every part larger than `most` points of its own is cut at the median of
    its widest axis. A point goes to both sides if it is within `eps` of the cut. A part that
    is narrower than the margin on both sides of a cut would only be copied, so it stays.
    """
    table = vectors.withColumns({"part": F.lit("").cast("string"), "home": F.lit(True)})
    for level in range(DEPTH):
        own = F.when(F.col("home"), 1)
        sizes = [F.sum(own).alias("n")]
        for i in range(dims):
            value = F.when(F.col("home"), F.col("x")[i])
            sizes += [F.min(value).alias(f"a{i}"), F.max(value).alias(f"b{i}")]
            sizes.append(F.percentile_approx(value, 0.5, 1000).alias(f"m{i}"))
        # One row per part.
        spans = F.array(*[F.struct((F.col(f"b{i}") - F.col(f"a{i}")).alias("span"), F.lit(i).alias("axis"), F.col(f"m{i}").alias("cut"), F.col(f"b{i}").alias("top")) for i in range(dims)])
        widest = F.array_max(spans).alias("widest")
        cuts = table.groupBy("part").agg(*sizes).filter(F.col("n") > most).select("part", widest)
        # Values equal to the cut go left, so the largest value cannot be one.
        cuts = cuts.filter(F.col("widest.span") > 4 * eps).select(
            "part", F.col("widest.axis").alias("axis"), F.when(F.col("widest.cut") < F.col("widest.top"), F.col("widest.cut")).alias("cut")
        )
        cuts = stored(cuts.filter("cut IS NOT NULL"), "cuts")
        if cuts.isEmpty():
            break
        at = F.get("x", F.col("axis"))
        sides = F.array(
            F.when(at <= F.col("cut") + eps, F.struct(F.lit("l").alias("side"), (at <= F.col("cut")).alias("in"))),
            F.when(at >= F.col("cut") - eps, F.struct(F.lit("r").alias("side"), (at > F.col("cut")).alias("in"))),
        )
        uncut = F.array(F.struct(F.lit("").alias("side"), F.lit(True).alias("in")))
        sides = F.when(F.col("cut").isNull(), uncut).otherwise(F.array_compact(sides))
        table = table.join(cuts, "part", "left").select(
            "x", "w", "dense", "id", "part", "home", F.explode(sides).alias("to")
        )
        table = table.select(
            "x", "w", "dense", "id", F.concat("part", "to.side").alias("part"), (F.col("home") & F.col("to.in")).alias("home")
        )
        if level % 8 == 7:
            table = stored(table, "parts")
    return stored(table, "parts")


def _close(one: np.ndarray, other: np.ndarray, eps: float) -> np.ndarray:
    """Whether the rows of one are within eps of the rows of the other; sums in order of axes."""
    total = np.zeros((len(one), len(other)))
    for i in range(one.shape[1]):
        total += (one[:, i, None] - other[None, :, i]) ** 2
    return np.sqrt(total) <= eps


def _matrix(table: pa.Table, dims: int) -> np.ndarray:
    return table["x"].combine_chunks().flatten().to_numpy().reshape(-1, dims)


def _meet(probes: DataFrame, targets: DataFrame) -> DataFrame:
    """Probes and targets of a part in chunks of bounded size, each pair of chunks a group.

    Most parts are one chunk. A part that could not be cut, as all of it lies within a few
    radii, may hold any number of points; its chunks meet each other pair by pair.
    """
    sizes = targets.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    every = F.sequence(F.lit(0), F.col("chunks") - 1)
    own = F.pmod("id", F.col("chunks")).cast("int")

    def dealt(table: DataFrame, probe: bool, mine: str, other: str) -> DataFrame:
        placed = table.join(sizes, "part").withColumns({mine: own, other: F.explode(every)})
        return placed.select("part", "i", "j", F.lit(probe).alias("probe"), "id", "x", "w", "dense")

    return dealt(probes, True, "i", "j").unionByName(dealt(targets, False, "j", "i")).groupBy("part", "i", "j")


def _around(dims: int, eps: float):
    """Weight of the targets near each probe, and whether one of them is dense."""

    def run(table: pa.Table) -> pa.Table:
        x, w = _matrix(table, dims), table["w"].to_numpy()
        dense, probe = (table[c].to_numpy() for c in ("dense", "probe"))
        todo, others = np.flatnonzero(probe), np.flatnonzero(~probe)
        weight, by_dense = np.zeros(len(todo), np.int64), np.zeros(len(todo), bool)
        step = max(1, STEP // max(len(others), 1))
        for a in range(0, len(todo), step):
            near = _close(x[todo[a : a + step]], x[others], eps)
            weight[a : a + step] = near @ w[others]
            by_dense[a : a + step] = (near & dense[others]).any(axis=1)
        return pa.table({"x": table["x"].take(todo), "near": weight, "by_dense": by_dense})

    return run


def _summed(groups, size: int, eps: float) -> DataFrame:
    found = groups.applyInArrow(_around(size, eps), "x array<double>, near long, by_dense boolean")
    return found.groupBy("x").agg(F.sum("near").alias("near"), F.max("by_dense").alias("by_dense"))


def noise_vectors(
    points: DataFrame,
    eps: float = 0.5,
    min_samples: int = 5,
    dims: Sequence[str] = NUMERIC_FEATURES,
    most: int = PART_POINTS,
) -> DataFrame:
    """Distinct vectors (column `x`) that are neither core nor within `eps` of a core."""
    size = len(dims)
    table = parts_of(_vectors(points, dims, eps, min_samples), size, eps, most)
    around = stored(_summed(_meet(table.filter("home AND NOT dense"), table), size, eps), "around")
    core = F.col("near") >= min_samples
    # What is open looks for cores of sparse cells; its own part and the margins hold them.
    cores = table.join(around.filter(core).select("x"), "x", "left_semi")
    open_cases = around.filter(~core & ~F.col("by_dense")).select("x")
    probes = table.filter("home").join(open_cases, "x", "left_semi")
    reached = _summed(_meet(probes, cores), size, eps).filter("near > 0").select("x")
    return open_cases.join(reached, "x", "left_anti")


def label_noise(
    points: DataFrame,
    eps: float = 0.5,
    min_samples: int = 5,
    dims: Sequence[str] = NUMERIC_FEATURES,
    label: str = "dbscan_label",
    most: int = PART_POINTS,
) -> DataFrame:
    """Add `label`: 1 for noise, 0 otherwise. A point with a missing value is noise."""
    noise = noise_vectors(points, eps, min_samples, dims, most).select(F.col("x").alias("_x"), F.lit(1).alias("_noise"))
    known = points.withColumn("_x", F.array(*[F.col(c).cast("double") for c in dims]))
    missing = F.exists("_x", lambda v: v.isNull())
    flag = F.when(missing, 1).otherwise(F.coalesce("_noise", F.lit(0)))
    return known.join(noise, "_x", "left").withColumn(label, flag).select(*points.columns, label)
