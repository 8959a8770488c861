"""Drift against a stored profile of the past, without reading the past again.

A profile holds a quantile sketch per feature and day. Sketches of any days are merged;
edges of bins and the shares in them follow from the merged sketch. New rows are compared
with it through their own sketch, so a check reads the new rows once and a few kilobytes.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a sketch; the error of a share falls with it.
SKETCH_SIZE = 800


def share_error(size: int = SKETCH_SIZE) -> float:
    """How far the share below a value may be off, in 99 of 100 cases."""
    return 2.446 / size**0.9433


def profile(table: DataFrame, columns: Sequence[str], time: str, size: int = SKETCH_SIZE) -> DataFrame:
    """day, feature, rows (with a value) and sketch, one row per day and feature."""
    sketches = [F.struct(F.count(c).alias("rows"), F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(size)).alias("sketch")).alias(c) for c in columns]
    days = table.groupBy(F.to_date(time).alias("day")).agg(*sketches)
    each = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c)["rows"].alias("rows"), F.col(c)["sketch"].alias("sketch")) for c in columns])
    return days.select("day", F.inline(each))


def merged(days: DataFrame) -> DataFrame:
    """feature, rows and sketch over all given days; features without a value are left out."""
    known = days.filter("rows > 0")
    return known.groupBy("feature").agg(F.sum("rows").alias("rows"), F.kll_merge_agg_double("sketch").alias("sketch"))


def edges_of(past: DataFrame, bins: int = 10) -> dict[str, list[float]]:
    """Per feature the quantiles of a `merged` profile that cut it into bins of equal shares."""
    cuts = [F.kll_sketch_get_quantile_double("sketch", F.lit(i / bins)) for i in range(1, bins)]
    # A few numbers per feature.
    return {r.feature: sorted(set(r.cuts)) for r in past.select("feature", F.array(*cuts).alias("cuts")).collect()}


def _shares(sketch: str, edges: Sequence[float]) -> Column:
    """Shares of the bins that `edges` cut, each from an edge up to below the next."""
    # Ranks include the value itself, so the number just below an edge is asked for.
    below = [F.kll_sketch_get_rank_double(sketch, F.lit(math.nextafter(e, -math.inf))) for e in edges]
    return F.array(*[b - a for a, b in pairwise([F.lit(0.0), *below, F.lit(1.0)])])


def drift(
    past: DataFrame, now: DataFrame, edges: dict[str, Sequence[float]] | None = None, floor: float = 1e-6
) -> DataFrame:
    """feature, psi, ks and the shares `expected` and `actual` of two `merged` profiles.

    `edges` cut the values of a feature; without them the past's quantiles do. Empty
    shares count as `floor`. KS is the largest gap at an edge. Features of `edges` that one
    of the profiles lacks are left out.
    """
    edges = edges_of(past) if edges is None else edges
    both = past.select("feature", F.col("sketch").alias("_past")).join(
        now.select("feature", F.col("sketch").alias("_now")), "feature"
    )
    nothing = F.lit(None).cast("array<double>")

    def shares(sketch: str) -> Column:
        return F.coalesce(nothing, *[F.when(F.col("feature") == f, _shares(sketch, e)) for f, e in edges.items()])

    cut = both.select("feature", shares("_past").alias("expected"), shares("_now").alias("actual"))

    def least(value: Column) -> Column:
        return F.greatest(value, F.lit(floor))

    terms = F.zip_with("expected", "actual", lambda e, a: (least(a) - least(e)) * F.log(least(a) / least(e)))
    # Gaps of the distribution functions are running sums of the gaps of the bins.
    running = F.aggregate(
        F.zip_with("expected", "actual", lambda e, a: a - e),
        F.struct(F.lit(0.0).alias("at"), F.lit(0.0).alias("most")),
        lambda h, g: F.struct((h["at"] + g).alias("at"), F.greatest(h["most"], F.abs(h["at"] + g)).alias("most")),
    )
    total = F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)
    found = cut.filter("expected IS NOT NULL")
    return found.select("feature", total.alias("psi"), running["most"].alias("ks"), "expected", "actual")
