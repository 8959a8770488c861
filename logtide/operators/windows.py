"""Tumbling-window features over events.

In batch, sums over events and counts of their values are aggregated each for itself and
joined by window, so a feature costs what it needs. Values and tokens are counted per
(window, value) first, combined on the map side, so a window or a token holding most of
the rows spreads over all tasks. No window is ever collected into one list.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.functions import fields as X
from logtide.functions import patterns as P

MESSAGE, HOST, PROCESS, TOKEN = 0, 1, 2, 3
#: What the features of events are made of.
EVENT_COLUMNS = ("timestamp", "host", "process", "message")


def first_timestamp(events: DataFrame) -> Column:
    """The earliest timestamp, as a scalar subquery (no join, no driver action)."""
    return events.agg(F.min("timestamp")).scalar()


def with_window_start(
    events: DataFrame, window_seconds: float = 60, origin: datetime | Column | None = None
) -> DataFrame:
    """Add `window_start`, NULL for events without a time.

    Window k is [origin + k*w, origin + (k+1)*w). Without an `origin` it is the
    earliest timestamp of the whole input, which costs one more scan of that
    column: pass it where it is known, or keep parsed events in Parquet.
    """
    if origin is None:
        start = first_timestamp(events)
    elif isinstance(origin, Column):
        start = origin
    else:
        start = F.lit(origin).cast("timestamp")
    # Integer microseconds throughout: dividing doubles would misplace edges.
    at = F.unix_micros("timestamp")
    into = F.pmod(at - F.col("_origin"), F.lit(_micros(window_seconds)))
    return (
        events.withColumn("_origin", F.unix_micros(start))
        .withColumn("window_start", F.timestamp_micros(at - into))
        .drop("_origin")
    )


def _micros(window_seconds: float) -> int:
    return round(window_seconds * 1_000_000)


def window_end(window_seconds: float) -> Column:
    return F.timestamp_micros(F.unix_micros("window_start") + _micros(window_seconds))


def assign_windows(
    events: DataFrame, window_seconds: float = 60, origin: datetime | Column | None = None
) -> DataFrame:
    """Events that have a time, with the bounds of their window."""
    return (
        with_window_start(events, window_seconds, origin)
        .withColumn("window_end", window_end(window_seconds))
        .filter(F.col("timestamp").isNotNull())
    )


def entropy_of(total: Column, weighted_log: Column) -> Column:
    """Shannon entropy in bits from sum(c) and sum(c * log2(c)); 0 without tokens."""
    bits = F.log2(total) - weighted_log / total
    return F.greatest(F.coalesce(bits, F.lit(0.0)), F.lit(0.0))


def window_features(
    events: DataFrame,
    window_seconds: float = 60,
    origin: datetime | Column | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per non-empty window, with bounds and the eight features, or `columns` of them.

    Counts, lengths and phrases are sums over events, one partial row per window and
    task. Distinct counts and entropy explode events, once for all that are asked for.
    """
    wanted = list(columns or P.FEATURE_COLUMNS)
    placed = with_window_start(events, window_seconds, origin)
    message = F.col("message")

    def phrase(text: str) -> Column:
        return F.coalesce(F.sum(F.when(X.has_phrase(message, text), 1)), F.lit(0)).cast("bigint")

    # Events without a time have no window. Their row is dropped by its count: a filter
    # on the time would be pushed below the parser and run it twice.
    direct = placed.groupBy("window_start").agg(
        F.count("timestamp").alias("event_count"),
        (F.sum(F.length(message)) / F.count(message)).alias("avg_msg_length"),
        phrase(P.FAILED_AUTH_PHRASE).alias("failed_auth_count"),
        phrase(P.INVALID_USER_PHRASE).alias("invalid_user_count"),
    )
    found = direct.filter("event_count > 0")
    distinct = [c for c in DISTINCT if c in wanted]
    if distinct or "entropy_tokens" in wanted:
        counts = value_counts(placed, ["window_start"], distinct, "entropy_tokens" in wanted)
        found = found.join(counts, "window_start", "left")
    return found.withColumn("window_end", window_end(window_seconds)).select(*wanted)


#: Counted feature to the column it counts.
DISTINCT = {"unique_messages": "message", "distinct_hosts": "host", "distinct_processes": "process"}


def counted_values(
    events: DataFrame, keys: Sequence[str], distinct: Sequence[str] = tuple(DISTINCT), tokens: bool = True
) -> DataFrame:
    """How often each value occurs per `keys`: `facet`, `value`, `n`; one pass over the events.

    Messages are told apart by their 128-bit MD5, so no message text is shuffled. Every
    key is kept, by NULL values if it has no others.
    """
    facets_of = {"unique_messages": MESSAGE, "distinct_hosts": HOST, "distinct_processes": PROCESS}
    values = []
    for name in distinct:
        value = F.col(DISTINCT[name])
        value = F.base64(F.unhex(F.md5(value))) if name == "unique_messages" else value
        values.append(F.struct(F.lit(facets_of[name]).cast("tinyint").alias("facet"), value.alias("value")))
    parts = [F.array(*values)] if values else []
    if tokens:
        kind = F.lit(TOKEN).cast("tinyint").alias("facet")
        words = F.transform(X.tokens(F.col("message")), lambda t: F.struct(kind, t.alias("value")))
        # A NULL keeps the key of events without a token.
        none = F.array(F.struct(kind, F.lit(None).cast("string").alias("value")))
        parts += [F.coalesce(words, none)] if values else [F.coalesce(words, none), none]
    exploded = events.select(*keys, F.inline(F.concat(*parts)))
    return exploded.groupBy(*keys, "facet", "value").agg(F.count("value").alias("n"))


def summed_values(counts: DataFrame, keys: Sequence[str], distinct: Sequence[str], tokens: bool) -> DataFrame:
    """Distinct counts and token entropy per `keys` from `counted_values`."""
    present = F.col("value").isNotNull()
    found = [
        F.count_if(present & (F.col("facet") == i)).alias(name)
        for i, name in enumerate(DISTINCT)
        if name in distinct
    ]
    if tokens:
        n = F.when((F.col("facet") == TOKEN) & present, F.col("n"))
        found.append(entropy_of(F.sum(n), F.sum(n * F.log2(n))).alias("entropy_tokens"))
    return counts.groupBy(*keys).agg(*found)


def value_counts(events: DataFrame, keys: Sequence[str], distinct: Sequence[str], tokens: bool) -> DataFrame:
    """The asked distinct counts and entropy per `keys`."""
    return summed_values(counted_values(events, keys, distinct, tokens), keys, distinct, tokens)


def token_entropy(table: DataFrame, keys: list[str], text: str = "message") -> DataFrame:
    """Entropy of the pooled tokens of `text` per `keys`; 0 for a key without tokens.

    A key without any token is kept by one NULL token row, which counts nothing.
    """
    words = table.select(*keys, F.explode_outer(X.tokens(F.col(text))).alias("token"))
    counts = words.groupBy(*keys, "token").agg(F.count("token").alias("n"))
    n = F.when(F.col("n") > 0, F.col("n"))
    return counts.groupBy(*keys).agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("token_count"),
        entropy_of(F.sum(n), F.sum(n * F.log2(n))).alias("entropy_tokens"),
    )


def feature_statistics(features: DataFrame, window_seconds: float = 60) -> DataFrame:
    """One row: windows in total, with and without data, and ranges of three features.

    Windows in total follow from the first and last start, as both hold data.
    """
    width = _micros(window_seconds)
    span = F.unix_micros(F.max("window_start")) - F.unix_micros(F.min("window_start"))
    filled = F.count(F.lit(1))
    total = F.coalesce((span / width).cast("bigint") + 1, F.lit(0).cast("bigint"))
    ranges = []
    for name in ("event_count", "avg_msg_length", "entropy_tokens"):
        ranges += [F.min(name).alias(f"min_{name}"), F.max(name).alias(f"max_{name}")]
    return features.agg(
        total.alias("total_windows"),
        filled.alias("filled_windows"),
        (total - filled).alias("empty_windows"),
        *ranges,
    )
