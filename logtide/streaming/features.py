"""Parsing, tumbling features, sessions and correlation on streams."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from logtide.functions import fields as X
from logtide.functions import patterns as P
from logtide.operators.parse import harmonize, parse_lines
from logtide.operators.windows import HOST, MESSAGE, PROCESS, TOKEN, entropy_of


def parse_stream(
    lines: DataFrame, default_year: int | None = None, compat: bool = True
) -> DataFrame:
    """Events of a line stream. Lines are not numbered: a stream has no last line."""
    return harmonize(parse_lines(lines, default_year, compat))


def stream_features(
    events: DataFrame,
    window_seconds: int = 60,
    origin: datetime | None = None,
    late: str = "10 minutes",
) -> DataFrame:
    """The batch features per closed window, in append mode.

    Windows start at `origin` (the epoch by default), as the earliest time of a
    stream is not known. Two aggregations are chained: the first keeps one counter per
    window and distinct value, so state of a busy window is spread over all tasks, and
    distinct counts and entropy stay exact. A value is kept as 16 bytes, its kind and 120
    bits of its MD5, beside the 8 bytes of its window; no text is stored. State is
    dropped once the watermark, `late` behind the newest event, passes the window.
    """
    placed = events.select(
        _start(window_seconds, origin).alias("window_start"), "message", "host", "process"
    ).withWatermark("window_start", _closing(window_seconds, late))
    message = F.col("message")
    facts = {
        "length": F.length(message),
        "failed": X.has_phrase(message, P.FAILED_AUTH_PHRASE),
        "invalid": X.has_phrase(message, P.INVALID_USER_PHRASE),
    }

    def value(facet: int, of: Column, known: bool = False) -> Column:
        kinds = {"length": "int", "failed": "boolean", "invalid": "boolean"}
        facts_of = [(facts[n] if known else F.lit(None)).cast(kind).alias(n) for n, kind in kinds.items()]
        return F.struct(_key(facet, of).alias("key"), *facts_of)

    values = F.array(value(MESSAGE, message, True), value(HOST, F.col("host")), value(PROCESS, F.col("process")))
    tokens = F.transform(F.coalesce(X.tokens(message), F.array().cast("array<string>")), lambda t: value(TOKEN, t))
    # Events without a time have no rows. A filter would be pushed below the parser and run it twice.
    rows = placed.select("window_start", F.inline(F.when(F.col("window_start").isNotNull(), F.concat(values, tokens))))
    counts = rows.groupBy("window_start", "key").agg(
        F.count(F.lit(1)).alias("n"), *[F.max(name).alias(name) for name in facts]
    )
    return _features(counts).select(
        "window_start",
        F.timestamp_micros(F.unix_micros("window_start") + window_seconds * 1_000_000).alias("window_end"),
        *P.NUMERIC_FEATURES,
    )


def _micros_of(origin: datetime | None) -> int:
    since = origin or datetime(1970, 1, 1)
    return round(since.replace(tzinfo=since.tzinfo or UTC).timestamp() * 1_000_000)


def _start(window_seconds: int, origin: datetime | None) -> Column:
    at = F.unix_micros("timestamp")
    return F.timestamp_micros(at - F.pmod(at - F.lit(_micros_of(origin)), F.lit(window_seconds * 1_000_000)))


def _closing(window_seconds: int, late: str) -> str:
    """How far the starts of windows must be behind: a window closes `late` after its end."""
    return f"{late} {window_seconds} seconds"


def _key(facet: int, value: Column) -> Column:
    """The kind of a value and 15 bytes of its digest; the kind alone for NULL."""
    kind = F.lit(bytes([facet]))
    return F.coalesce(F.concat(kind, F.substring(F.unhex(F.md5(value)), 2, 15)), kind)


def _features(counts: DataFrame) -> DataFrame:
    """Features per window from (`window_start`, `key`, `n`, facts of messages)."""
    n, present = F.col("n"), F.octet_length("key") > 1

    def of(facet: int) -> Column:
        return F.substring("key", 1, 1) == F.lit(bytes([facet]))

    def total(condition: Column, amount: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, amount)), F.lit(0))

    one = F.lit(1).cast("bigint")
    tokens = F.when(of(TOKEN), n)
    return counts.groupBy("window_start").agg(
        total(of(MESSAGE), n).alias("event_count"),
        total(of(MESSAGE) & present, one).alias("unique_messages"),
        total(of(HOST) & present, one).alias("distinct_hosts"),
        total(of(PROCESS) & present, one).alias("distinct_processes"),
        (F.sum(F.col("length") * n) / F.sum(F.when(F.col("length").isNotNull(), n))).alias("avg_msg_length"),
        total(F.col("failed"), n).alias("failed_auth_count"),
        total(F.col("invalid"), n).alias("invalid_user_count"),
        entropy_of(F.sum(tokens), F.sum(tokens * F.log2(n))).alias("entropy_tokens"),
    )


# --- sessions and correlation ----------------------------------------------------


def stream_sessions(
    events: DataFrame, keys: Sequence[str], gap_seconds: int, late: str = "10 minutes"
) -> DataFrame:
    """Closed sessions per key in append mode: the batch sessions, each once it has ended.

    A session is open while events may still join it, that is until the watermark, `late`
    behind the newest event, passes its end. Later events are dropped. Events of a key are
    merged into sessions within each task first (a session default of `build_session`), so
    a busy key moves as spans, not as events.
    """
    session = F.session_window("timestamp", f"{gap_seconds} seconds")
    grouped = events.withWatermark("timestamp", late).groupBy(session.alias("_s"), *keys)
    return grouped.agg(F.count(F.lit(1)).alias("event_count")).select(
        *keys, F.col("_s.start").alias("session_start"), F.col("_s.end").alias("session_end"), "event_count"
    )


def stream_correlation(
    events: DataFrame,
    anomalies: DataFrame,
    keys: Sequence[str],
    window_seconds: int = 60,
    origin: datetime | None = None,
    late: str = "10 minutes",
) -> DataFrame:
    """Events per key of the windows that a stream of `anomalies` (`window_start`) names.

    Rows `window_start`, keys, `event_count` in append mode; their sums per key are the
    batch correlation. Both streams are reduced to their windows before they meet, and both
    have watermarks, so the state holds a row per open window and key, and no events.
    """
    start = _micros_of(origin) % (window_seconds * 1_000_000)
    width, offset = f"{window_seconds} seconds", f"{start} microseconds"

    def windows_of(table: DataFrame, time: str, by: Sequence[str]) -> GroupedData:
        window = F.window(time, width, startTime=offset).alias("window")
        return table.withWatermark(time, late).groupBy(window, *by)

    counted = windows_of(events, "timestamp", keys).agg(F.count(F.lit(1)).alias("event_count"))
    flagged = windows_of(anomalies, "window_start", []).agg(F.count(F.lit(1)).alias("_flags"))
    return counted.join(flagged, "window").select(F.col("window.start").alias("window_start"), *keys, "event_count")
