"""Overlapping windows from panes, and windows rolled up from stored sketches.

A pane is as long as the largest span that divides both the width and the slide of a
window, so every window is a whole number of panes and its features follow from theirs.
Events are aggregated once, per pane; only panes and counts of values per pane are copied
to the windows they lie in, not events.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.functions import fields as X
from logtide.functions import patterns as P
from logtide.operators.windows import DISTINCT, EVENT_COLUMNS, counted_values, summed_values

#: log2 of the number of registers of a distinct-count sketch.
SKETCH_BITS = 12


def _micros(seconds: float) -> int:
    return round(seconds * 1_000_000)


def _with_pane(events: DataFrame, pane: int) -> DataFrame:
    """Events that have a time, with the number of their pane since the epoch."""
    at = F.unix_micros("timestamp")
    number = F.floor((at - F.pmod(at, F.lit(pane))) / F.lit(pane)).cast("bigint")
    return events.select(*EVENT_COLUMNS).withColumn("_pane", number).filter(F.col("timestamp").isNotNull())


def _windows_of(pane: int, width: int, slide: int) -> Column:
    """Starts of the windows that a pane lies in, counted in panes since the epoch."""
    number, wide, step = F.col("_pane"), width // pane, slide // pane
    last = number - F.pmod(number, F.lit(step))
    # A pause between windows leaves some panes out.
    first = last - (wide - 1) // step * step
    starts = F.sequence(first, last, F.lit(step))
    return F.filter(starts, lambda s: number - s < wide)


def sliding_features(
    events: DataFrame,
    window_seconds: float,
    slide_seconds: float,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The features of every window that holds an event; windows start each `slide_seconds`.

    Starts are multiples of the slide since the epoch. Events without a time have no window.
    """
    wanted = list(columns or P.FEATURE_COLUMNS)
    width, slide = _micros(window_seconds), _micros(slide_seconds)
    pane = math.gcd(width, slide)
    placed = _with_pane(events, pane)
    message = F.col("message")

    def phrase(text: str) -> Column:
        return F.count_if(X.has_phrase(message, text))

    sums = placed.groupBy("_pane").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.sum(F.length(message)).alias("_length"),
        F.count(message).alias("_messages"),
        phrase(P.FAILED_AUTH_PHRASE).alias("failed_auth_count"),
        phrase(P.INVALID_USER_PHRASE).alias("invalid_user_count"),
    )
    start = F.explode(_windows_of(pane, width, slide)).alias("_start")
    found = (
        sums.select(start, *[c for c in sums.columns if c != "_pane"])
        .groupBy("_start")
        .agg(
            *[F.sum(c).alias(c) for c in ("event_count", "failed_auth_count", "invalid_user_count")],
            (F.sum("_length") / F.sum("_messages")).alias("avg_msg_length"),
        )
    )
    distinct = [c for c in DISTINCT if c in wanted]
    tokens = "entropy_tokens" in wanted
    if distinct or tokens:
        counts = counted_values(placed, ["_pane"], distinct, tokens)
        counts = counts.select(start, "facet", "value", "n").groupBy("_start", "facet", "value")
        values = summed_values(counts.agg(F.sum("n").alias("n")), ["_start"], distinct, tokens)
        found = found.join(values, "_start", "left")
    at = F.col("_start") * pane
    found = found.withColumns({"window_start": F.timestamp_micros(at), "window_end": F.timestamp_micros(at + width)})
    return found.select(*wanted)


# --- distinct counts that can be merged ---------------------------------------


def distinct_sketches(events: DataFrame, window_seconds: float, bits: int = SKETCH_BITS) -> DataFrame:
    """Per window a sketch of its messages, hosts and processes, to be stored and merged.

    A sketch takes at most about 2 ** bits bytes, however many values it has seen.
    """
    width = _micros(window_seconds)
    sketches = [F.hll_sketch_agg(c, bits).alias(name) for name, c in DISTINCT.items()]
    found = _with_pane(events, width).groupBy("_pane").agg(*sketches)
    return found.select(F.timestamp_micros(F.col("_pane") * width).alias("window_start"), *DISTINCT)


def merge_sketches(sketches: DataFrame, window_seconds: float) -> DataFrame:
    """Sketches of wider windows from those of windows that divide them, without the events."""
    width = _micros(window_seconds)
    at = F.unix_micros("window_start")
    start = F.timestamp_micros(at - F.pmod(at, F.lit(width))).alias("window_start")
    return sketches.groupBy(start).agg(*[F.hll_union_agg(name).alias(name) for name in DISTINCT])


def estimated_counts(sketches: DataFrame) -> DataFrame:
    """Estimates of the distinct counts; `relative_error` says how far off they usually are."""
    return sketches.select("window_start", *[F.hll_sketch_estimate(name).alias(name) for name in DISTINCT])


def relative_error(bits: int = SKETCH_BITS) -> float:
    """Three standard errors of a sketch, as a share of the count."""
    return 3 * 1.04 / math.sqrt(2**bits)
