"""Exact quantiles without putting all values into one task."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Distinct values the last step may sort in one task; 8-byte values and counts.
BRACKET_LIMIT = 200_000


def exact_quantile(table: DataFrame, column: str, q: float, limit: int = BRACKET_LIMIT) -> float:
    """The `q` quantile of `column` with linear interpolation between ranks.

    Values are collapsed to counts. While more than `limit` distinct values
    could hold the wanted ranks, an approximate quantile narrows the bracket;
    counting below it keeps the answer exact whatever the approximation says.
    NULLs are ignored; without any value the result is NaN.
    """
    stored = (
        table.select(F.col(column).cast("double").alias("v"))
        .groupBy("v")
        .agg(F.count(F.lit(1)).alias("n"))
        .persist()
    )
    # Filtering what is stored keeps the filter from running the scores again.
    counts = stored.filter("v IS NOT NULL")
    try:
        rows, distinct, low, high = counts.agg(
            F.sum("n"), F.count(F.lit(1)), F.min("v"), F.max("v")
        ).first()
        if not rows:
            return math.nan
        position = q * (rows - 1)
        first, last = math.floor(position), math.ceil(position)
        below = 0
        while distinct > limit:
            inside = counts.filter(F.col("v").between(low, high))
            cuts = inside.select(
                F.approx_percentile(
                    "v", [i / 64 for i in range(1, 64)], 10_000
                )
            ).first()[0]
            # Halving the bracket as well makes every round narrow it.
            edges = sorted({low, high, low + (high - low) / 2, *cuts})
            narrowed = _narrow(counts, edges, first, last)
            if narrowed[:2] == (low, high):
                raise ArithmeticError(f"no value between {low} and {high} splits the bracket")
            low, high, below, distinct = narrowed
        return _interpolate(counts, low, high, below, position)
    finally:
        stored.unpersist()


def _narrow(counts: DataFrame, edges: list[float], first: int, last: int):
    """The tightest pair of edges around both ranks, with the rows below it."""
    sums = counts.agg(
        *[F.sum(F.when(F.col("v") < edge, F.col("n")).otherwise(0)) for edge in edges],
        *[F.sum(F.when(F.col("v") <= edge, F.col("n")).otherwise(0)) for edge in edges],
    ).first()
    under, upto = sums[: len(edges)], sums[len(edges) :]
    start = max(i for i in range(len(edges)) if under[i] <= first)
    stop = min(i for i in range(len(edges)) if upto[i] > last)
    low, high = edges[start], edges[stop]
    distinct = counts.filter(F.col("v").between(low, high)).count()
    return low, high, under[start], distinct


def _interpolate(counts: DataFrame, low: float, high: float, below: int, position: float) -> float:
    # The bracket holds a bounded number of distinct values: one task may sort it.
    upto = F.sum("n").over(Window.orderBy("v")) + below
    ranked = counts.filter(F.col("v").between(low, high)).select("v", upto.alias("upto"))
    first, last = math.floor(position), math.ceil(position)
    a, b = ranked.agg(
        F.min(F.when(F.col("upto") > first, F.col("v"))),
        F.min(F.when(F.col("upto") > last, F.col("v"))),
    ).first()
    return a if a == b else a + (b - a) * (position - first)
