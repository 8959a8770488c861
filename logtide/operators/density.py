"""Density noise labels (DBSCAN) as grouping and equi-joins.

Only the noise flag is wanted, so no clusters are built. Identical vectors are
collapsed to one with a weight. Space is cut into cells so small that all points
of a cell are neighbours: a cell of `min_samples` points is dense and needs no
pair at all. Only points of sparse cells, fewer than `min_samples` per cell, look
around, so the number of pairs is linear in the number of vectors.

Whole-number columns are cells by themselves; the others are cut to a width of
eps / sqrt(number of such columns).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.functions.patterns import NUMERIC_FEATURES
from logtide.session import stored

WHOLE = [n for n in NUMERIC_FEATURES if n not in ("avg_msg_length", "entropy_tokens")]
REAL = ["avg_msg_length", "entropy_tokens"]


class Grid:
    """Cells, their neighbour offsets and the distance test for one setting."""

    def __init__(self, whole: Sequence[str], real: Sequence[str], eps: float):
        self.whole, self.real, self.eps = list(whole), list(real), eps
        self.dims = [*self.whole, *self.real]
        # Slightly under the exact width, so that rounding never breaks "all
        # points of a cell are neighbours".
        self.width = eps / math.sqrt(max(len(self.real), 1)) * (1 - 1e-9)
        self.cell = [f"_c{i}" for i in range(len(self.dims))]

    def with_cells(self, table: DataFrame) -> DataFrame:
        places = {}
        for name, column in zip(self.cell, self.dims, strict=True):
            at = F.col(column)
            inside = at if column in self.whole else F.floor(at / self.width)
            places[name] = inside.cast("bigint")
        return table.withColumns(places)

    def offsets(self) -> list[tuple[int, ...]]:
        """Cell steps that can lead to a point within eps; the zero step is one."""
        exact = math.floor(self.eps)
        reach = math.floor(self.eps / self.width) + 1
        found = [((), 0.0)]
        for i in range(len(self.dims)):
            is_whole = i < len(self.whole)
            limit = exact if is_whole else reach
            steps = []
            for prefix, squared in found:
                for step in range(-limit, limit + 1):
                    gap = abs(step) if is_whole else max(abs(step) - 1, 0) * self.width
                    if squared + gap * gap <= self.eps**2 * (1 + 1e-9):
                        steps.append(((*prefix, step), squared + gap * gap))
            found = steps
        return [steps for steps, _ in found]

    def looking_around(self, probes: DataFrame) -> DataFrame:
        """`probes` once per neighbouring cell, with dims renamed to `_p<i>`."""
        moving = [i for i in range(len(self.dims)) if any(o[i] for o in self.offsets())]
        steps = F.array(
            *[F.array(*[F.lit(o[i]) for i in moving]) for o in self.offsets()]
        )
        step = F.col("_step")
        targets = [
            (F.col(name) + F.get(step, F.lit(moving.index(i))) if i in moving else F.col(name)).alias(name)
            for i, name in enumerate(self.cell)
        ]
        own = [F.col(d).alias(f"_p{i}") for i, d in enumerate(self.dims)]
        return probes.select(*own, *self.cell, F.explode(steps).alias("_step")).select(
            *[f"_p{i}" for i in range(len(self.dims))], *targets
        )

    def near(self) -> Column:
        """Whether a renamed probe and a joined point are within eps."""
        squares = [
            (F.col(d).cast("double") - F.col(f"_p{i}")) ** 2 for i, d in enumerate(self.dims)
        ]
        total = squares[0]
        for square in squares[1:]:
            total = total + square
        return F.sqrt(total) <= self.eps

    def probe_dims(self) -> list[Column]:
        return [F.col(f"_p{i}").alias(d) for i, d in enumerate(self.dims)]


def _neighbourhoods(points: DataFrame, grid: Grid, min_samples: int):
    """(vectors with cell and `_dense`, sparse vectors with what lies around them)

    Both are stored, as what follows reads them several times.
    """
    vectors = grid.with_cells(
        points.dropna(subset=grid.dims).groupBy(*grid.dims).agg(F.count(F.lit(1)).alias("_w"))
    )
    cells = vectors.groupBy(*grid.cell).agg((F.sum("_w") >= min_samples).alias("_dense"))
    vectors = stored(vectors.join(cells, grid.cell), "vectors")
    sparse = vectors.filter(~F.col("_dense"))
    pairs = grid.looking_around(sparse).join(vectors, grid.cell).filter(grid.near())
    around = (
        pairs.groupBy(*[f"_p{i}" for i in range(len(grid.dims))])
        .agg((F.sum("_w") >= min_samples).alias("_core"), F.max("_dense").alias("_by_dense"))
        .select(*grid.probe_dims(), "_core", "_by_dense")
    )
    return vectors, stored(grid.with_cells(around), "around")


def core_points(
    points: DataFrame,
    eps: float = 0.5,
    min_samples: int = 5,
    whole: Sequence[str] = WHOLE,
    real: Sequence[str] = REAL,
) -> DataFrame:
    """Distinct vectors with at least `min_samples` points, themselves included, within eps."""
    grid = Grid(whole, real, eps)
    vectors, around = _neighbourhoods(points, grid, min_samples)
    dense = vectors.filter("_dense").select(*grid.dims)
    return dense.unionByName(around.filter("_core").select(*grid.dims))


def noise_vectors(
    points: DataFrame,
    eps: float = 0.5,
    min_samples: int = 5,
    whole: Sequence[str] = WHOLE,
    real: Sequence[str] = REAL,
) -> DataFrame:
    """Distinct vectors that are neither core nor within eps of a core."""
    grid = Grid(whole, real, eps)
    _, around = _neighbourhoods(points, grid, min_samples)
    cores = around.filter("_core").select(*grid.dims, *grid.cell)
    open_cases = around.filter(~F.col("_core") & ~F.col("_by_dense"))
    reached = (
        grid.looking_around(open_cases)
        .join(cores, grid.cell)
        .filter(grid.near())
        .select(*grid.probe_dims())
        .distinct()
    )
    return open_cases.select(*grid.dims).join(reached, grid.dims, "left_anti")


def label_noise(
    points: DataFrame,
    eps: float = 0.5,
    min_samples: int = 5,
    whole: Sequence[str] = WHOLE,
    real: Sequence[str] = REAL,
    label: str = "dbscan_label",
) -> DataFrame:
    """Add `label`: 1 for noise, 0 otherwise. A point with a missing value is noise."""
    dims = [*whole, *real]
    noise = noise_vectors(points, eps, min_samples, whole, real).withColumn("_noise", F.lit(1))
    missing = F.lit(False)
    for name in dims:
        missing = missing | F.col(name).isNull()
    return (
        points.join(noise, dims, "left")
        .withColumn(label, F.when(missing, 1).otherwise(F.coalesce("_noise", F.lit(0))))
        .select(*points.columns, label)
    )


def label_against_cores(
    points: DataFrame,
    cores: DataFrame,
    eps: float = 0.5,
    whole: Sequence[str] = WHOLE,
    real: Sequence[str] = REAL,
    label: str = "dbscan_label",
) -> DataFrame:
    """Noise against stored core points: 1 where none of them is within eps.

    A point in a cell that holds a core is settled by that; only the others,
    once per distinct vector, are compared with the cores around them.
    """
    grid = Grid(whole, real, eps)
    known = grid.with_cells(cores.select(*grid.dims))
    vectors = grid.with_cells(points.dropna(subset=grid.dims).select(*grid.dims).distinct())
    unsettled = stored(
        vectors.join(known.select(*grid.cell).distinct(), grid.cell, "left_anti"), "unsettled"
    )
    reached = (
        grid.looking_around(unsettled)
        .join(known, grid.cell)
        .filter(grid.near())
        .select(*grid.probe_dims())
        .distinct()
    )
    noise = (
        unsettled.select(*grid.dims)
        .join(reached, grid.dims, "left_anti")
        .withColumn("_noise", F.lit(1))
    )
    missing = F.lit(False)
    for name in grid.dims:
        missing = missing | F.col(name).isNull()
    return (
        points.join(noise, grid.dims, "left")
        .withColumn(label, F.when(missing, 1).otherwise(F.coalesce("_noise", F.lit(0))))
        .select(*points.columns, label)
    )
