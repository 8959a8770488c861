"""Standardization, other windows, drift and detection quality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from logtide.functions.patterns import NUMERIC_FEATURES
from logtide.operators.windows import with_window_start


def standardize(table: DataFrame, columns: Sequence[str] = NUMERIC_FEATURES) -> DataFrame:
    """(x - mean) / population deviation; columns without spread are only centred.

    Mean and deviation come as one scalar subquery of a single row.
    """
    stats = table.agg(
        F.struct(
            *[F.avg(c).alias(f"m_{c}") for c in columns],
            *[F.stddev_pop(c).alias(f"s_{c}") for c in columns],
        )
    ).scalar()
    scaled = {}
    for c in columns:
        spread = F.col("_stats")[f"s_{c}"]
        scaled[c] = (F.col(c) - F.col("_stats")[f"m_{c}"]) / F.when(spread > 0, spread).otherwise(1)
    return table.withColumn("_stats", stats).withColumns(scaled).drop("_stats")


def sliding_counts(
    events: DataFrame, window_seconds: int, slide_seconds: int, keys: Sequence[str] = ()
) -> DataFrame:
    """Events per overlapping window (and `keys`)."""
    window = F.window("timestamp", f"{window_seconds} seconds", f"{slide_seconds} seconds")
    return (
        events.groupBy(window.alias("_w"), *keys)
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select(
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            *keys,
            "event_count",
        )
    )


def sessions(events: DataFrame, keys: Sequence[str], gap_seconds: int) -> DataFrame:
    """Runs of events per key with no pause longer than `gap_seconds`, as `session_window`.

    One key may hold any share of the events, so its events are never sorted in
    one task. Each is put into a slot of the length of the gap. Events of one slot
    always belong together, so slots are summed first, with map-side combine, and
    ordered in chunks of a bounded number of slots.
    """
    gap = gap_seconds * 1_000_000
    at = F.unix_micros("timestamp")
    slots = (
        events.filter(F.col("timestamp").isNotNull())
        .groupBy(*keys, F.floor(at / F.lit(gap)).alias("_slot"))
        .agg(
            F.min(at).alias("_first"),
            F.max(at).alias("_last"),
            F.count(F.lit(1)).alias("_n"),
        )
    )
    # Within chunks of slots first: what lies between the first and the last run of a
    # chunk is complete. Only those two per chunk are put in order over the whole key.
    slots = slots.withColumn("_chunk", F.floor(F.col("_slot") / CHUNK_SLOTS))
    in_chunk = Window.partitionBy(*keys, "_chunk")
    runs = (
        _numbered_runs(slots, in_chunk.orderBy("_slot"), gap)
        .groupBy(*keys, "_chunk", "_run")
        .agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"), F.sum("_n").alias("_n"))
        .withColumn("_runs", F.max("_run").over(in_chunk))
    )
    at_edge = (F.col("_run") == 1) | (F.col("_run") == F.col("_runs"))
    columns = [*keys, "_first", "_last", "_n"]
    merged = (
        _numbered_runs(runs.filter(at_edge).select(*columns), Window.partitionBy(*keys).orderBy("_first"), gap)
        .groupBy(*keys, "_run")
        .agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"), F.sum("_n").alias("_n"))
        .select(*columns)
    )
    return runs.filter(~at_edge).select(*columns).unionByName(merged).select(
        *keys,
        F.timestamp_micros("_first").alias("session_start"),
        F.timestamp_micros(F.col("_last") + gap).alias("session_end"),
        F.col("_n").alias("event_count"),
    )


#: Slots of a key that one task puts in order.
CHUNK_SLOTS = 10_000


def _numbered_runs(spans: DataFrame, order: WindowSpec, gap: int) -> DataFrame:
    """`_run` numbers the spans of a window without a longer pause, from 1."""
    pause = F.col("_first") - F.lag("_last").over(order)
    fresh = spans.withColumn("_new", F.when(pause <= gap, 0).otherwise(1))
    return fresh.withColumn("_run", F.sum("_new").over(order)).drop("_new")


def psi(
    table: DataFrame, value: str, is_current: Column, edges: Sequence[float], floor: float = 1e-6
) -> DataFrame:
    """Population stability index of `value` between the current and the earlier rows.

    `edges` cut the range into bins; empty shares count as `floor`.
    """
    cuts = F.lit(0)
    for edge in edges:
        cuts = cuts + (F.col(value) >= edge).cast("int")
    bins = F.array(*[F.lit(i) for i in range(len(edges) + 1)])
    counted = (
        table.filter(F.col(value).isNotNull())
        .select(cuts.alias("bin"), is_current.alias("_now"))
        .groupBy("bin")
        .agg(
            F.count_if(~F.col("_now")).alias("expected"),
            F.count_if("_now").alias("actual"),
        )
    )
    # One row per bin from here on.
    every = counted.agg(F.sum("expected").alias("_e"), F.sum("actual").alias("_a")).select(
        F.explode(bins).alias("bin"), "_e", "_a"
    )
    share_e = F.greatest(F.try_divide(F.coalesce("expected", F.lit(0)), "_e"), F.lit(floor))
    share_a = F.greatest(F.try_divide(F.coalesce("actual", F.lit(0)), "_a"), F.lit(floor))
    return every.join(counted, "bin", "left").agg(
        F.sum((share_a - share_e) * F.log(share_a / share_e)).alias("psi")
    )


def ks_statistic(table: DataFrame, value: str, is_current: Column, slices: int = 64) -> DataFrame:
    """Largest gap between the two distribution functions of `value`, exactly.

    Values are counted, then cut into slices with about as many different values each,
    whatever their range. Counts are summed within a slice and over the few slices. No
    task sorts all values, and a value with most rows is one count.
    """
    counts = (
        table.filter(F.col(value).isNotNull())
        .groupBy(F.col(value).alias("_v"))
        .agg(F.count_if(~is_current).alias("_e"), F.count_if(is_current).alias("_a"))
    )
    shares = [i / slices for i in range(1, slices)]
    # As many numbers as there are slices; any edges give the same result.
    edges = sorted(set(counts.agg(F.approx_percentile("_v", shares)).first()[0] or []))
    place = F.lit(0)
    for edge in edges:
        place = place + (F.col("_v") > edge).cast("int")
    counts = counts.withColumn("_slice", place)
    per_slice = counts.groupBy("_slice").agg(F.sum("_e").alias("se"), F.sum("_a").alias("sa"))
    # At most `slices` rows, so one task may sum them up.
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    starts = per_slice.select(
        "_slice",
        F.coalesce(F.sum("se").over(earlier), F.lit(0)).alias("_be"),
        F.coalesce(F.sum("sa").over(earlier), F.lit(0)).alias("_ba"),
        F.sum("se").over(everything).alias("_te"),
        F.sum("sa").over(everything).alias("_ta"),
    )
    upto = Window.partitionBy("_slice").orderBy("_v")
    gap = F.abs(
        F.try_divide(F.col("_be") + F.sum("_e").over(upto), "_te")
        - F.try_divide(F.col("_ba") + F.sum("_a").over(upto), "_ta")
    )
    return counts.join(F.broadcast(starts), "_slice").select(gap.alias("_gap")).agg(F.max("_gap").alias("ks"))


def precision_recall_at_k(
    scored: DataFrame, score: str, truth: str, k: int, key: str
) -> DataFrame:
    """Share of true rows among the `k` highest scores, and of all true rows found there."""
    top = scored.orderBy(F.desc(score), key).limit(k)
    found = top.agg(F.count(F.lit(1)).alias("_k"), F.count_if(F.col(truth) == 1).alias("_hits"))
    positives = scored.agg(F.count_if(F.col(truth) == 1)).scalar()
    return found.withColumn("_all", positives).select(
        F.when(F.col("_k") > 0, F.col("_hits") / F.col("_k")).alias("precision_at_k"),
        F.when(F.col("_all") > 0, F.col("_hits") / F.col("_all")).alias("recall_at_k"),
    )


def detection_rates(table: DataFrame, label: str, truth: str) -> DataFrame:
    """Detected share of the true rows, flagged share of the others."""
    flagged, true = F.col(label) == 1, F.col(truth) == 1
    positives, negatives = F.count_if(true), F.count_if(~true)
    return table.agg(
        F.when(positives > 0, F.count_if(flagged & true) / positives).alias("detection_rate"),
        F.when(negatives > 0, F.count_if(flagged & ~true) / negatives).alias("false_positive_rate"),
    )


def mean_time_to_detect(
    events: DataFrame, incident: str, started: Column, detected: Column, ts: str = "timestamp"
) -> DataFrame:
    """Mean seconds from the first `started` event of an incident to its first
    `detected` event at or after that; undetected incidents do not count.

    The first start comes first: a detection before it is no detection.
    """
    at = F.unix_micros(ts)
    starts = events.groupBy(incident).agg(F.min(F.when(started, at)).alias("_start"))
    # Detections per time are enough: repeats at one time change no minimum.
    hits = events.filter(detected).groupBy(incident, at.alias("_hit")).agg(F.lit(1).alias("_one"))
    delays = (
        hits.join(starts, incident)
        .filter(F.col("_hit") >= F.col("_start"))
        .groupBy(incident)
        .agg((F.min("_hit") - F.first("_start")).alias("_delay"))
    )
    return delays.agg(
        F.count(F.lit(1)).alias("detected_incidents"),
        (F.avg("_delay") / 1_000_000).alias("mean_seconds_to_detect"),
    )


def correlate(
    events: DataFrame,
    anomalies: DataFrame,
    keys: Sequence[str],
    window_seconds: float = 60,
    origin=None,
) -> DataFrame:
    """Events of anomalous windows per `keys`, with the windows they touch.

    Events are counted per window and key before they meet the anomalies.
    """
    counted = (
        with_window_start(events, window_seconds, origin)
        .groupBy("window_start", *keys)
        .agg(F.count("timestamp").alias("_n"))
    )
    flagged = anomalies.select("window_start").distinct()
    return (
        counted.join(flagged, "window_start", "left_semi")
        .groupBy(*keys)
        .agg(
            F.sum("_n").alias("event_count"),
            F.count(F.lit(1)).alias("anomalous_windows"),
        )
    )
