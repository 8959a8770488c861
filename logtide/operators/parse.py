"""Lines to normalized events: one event per line, none dropped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.functions import fields as X
from logtide.functions import patterns as P


def parse_lines(
    lines: DataFrame,
    default_year: int | None = None,
    compat: bool = True,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Normalize `lines` (`line`, optionally `source_file`, `line_number`).

    The result has the 16 event columns plus `line_format`, after the columns
    named in `keep`. Everything is a narrow projection, so it runs the same on
    batch and streaming input and unused columns are pruned away.

    `compat=True` keeps the established output: `source_file` is the constant
    `unknown`, and a syslog process keeps its `[pid]`. `compat=False` reports the
    real file, splits the pid off and adds `pid` and `syslog_host`.
    """
    line = F.col("line")
    fmt = F.col("line_format")
    source = F.col("source_file") if "source_file" in lines.columns else F.lit("unknown")
    number = F.col("line_number") if "line_number" in lines.columns else F.lit(None)

    # Each step computes what later ones use more than once, so that no pattern
    # is evaluated twice for a line. Format and time pass through a one-element
    # `inline`: plain projections would be substituted into every filter on the
    # result, pattern by pattern, and be evaluated again there.
    time, shape = F.col("_time"), F.col("_shape")
    timed = (
        lines.select(
            *keep,
            line,
            source.alias("_file"),
            number.cast("bigint").alias("line_number"),
            X.line_format(line).alias("_format"),
        )
        .select("*", X.time_text(line, F.col("_format")).alias("_time"))
        .select("*", X.time_shape(time).alias("_shape"))
        .select(
            "*",
            X.time_parts(time, shape).alias("_parts"),
            X.offset_text(time, shape).alias("_offset_text"),
        )
    )
    settled = F.struct(
        F.col("_format").alias("line_format"),
        X.wall_clock(F.col("_parts"), shape, default_year).alias("_clock"),
        X.offset_minutes(F.col("_offset_text")).alias("_offset"),
    )
    raw = timed.select(*keep, line, "_file", "line_number", F.inline(F.array(settled))).select(
        "*",
        X.message_text(line, fmt).alias("_message"),
        X.level_text(line, fmt).alias("_level"),
        X.service_name(line, fmt).alias("_service"),
        X.syslog_host(line, fmt).alias("syslog_host"),
    )
    has_message = F.col("_message") != ""
    hits = (
        F.when(fmt == "access", F.array(F.regexp_extract(line, P.ACCESS_LINE, 1)))
        .when(fmt == "fallback", X.ipv4_hits(line))
        .when(has_message, X.ipv4_hits(F.col("_message")))
    )
    pieces = raw.select(
        "*",
        F.when(has_message, F.col("_message")).otherwise(line).alias("message"),
        F.when(has_message, X.port_number(F.col("_message"))).alias("peer_port"),
        hits.alias("_hits"),
    )
    first, second = F.get("_hits", F.lit(0)), F.get("_hits", F.lit(1))
    checked = pieces.select(
        "*",
        X.spaced_words(F.col("message")).alias("_words"),
        X.is_valid_ipv4(first).alias("ip_src_valid"),
        X.is_valid_ipv4(second).alias("ip_dst_valid"),
    ).select(
        "*",
        F.when(F.col("_offset").isNotNull(), F.col("_clock")).alias("_wall"),
        X.tag_names(F.col("_words")).alias("_tags"),
    )

    wall = F.col("_wall")
    # Minutes are added as whole microseconds: exact and free of session zones.
    shift = F.col("_offset").cast("bigint") * 60_000_000
    columns = {
        "timestamp": F.timestamp_micros(F.unix_micros(wall) - shift),
        "source_file": F.lit("unknown") if compat else F.col("_file"),
        "level": X.normal_level(F.col("_level")),
        "indicator_tags_list": X.as_tag_list(F.col("_tags")),
        "ip_src": F.when(F.col("ip_src_valid"), first).otherwise(""),
        "ip_dst": F.when(F.col("ip_dst_valid"), second).otherwise(""),
        "service": F.col("_service"),
        "message": F.col("message"),
        "peer_port": F.col("peer_port"),
        "line_number": F.col("line_number"),
        "ip_src_valid": F.col("ip_src_valid"),
        "ip_dst_valid": F.col("ip_dst_valid"),
        "message_raw": F.col("message"),
        "day_of_week": F.date_format(wall, "EEEE"),
        "hour_of_day": F.hour(wall),
        "is_weekend": F.coalesce(F.weekday(wall) >= 5, F.lit(False)),
    }
    if not compat:
        process = F.regexp_extract("_service", P.PROCESS_ID, 1)
        has_pid = F.col("_service").rlike(P.PROCESS_ID)
        columns["service"] = F.when(has_pid, process).otherwise(F.col("_service"))
        columns["pid"] = F.when(
            has_pid, F.regexp_extract("_service", P.PROCESS_ID, 2).try_cast("bigint")
        )
        columns["syslog_host"] = F.col("syslog_host")
    return checked.select(
        *keep, *[value.alias(name) for name, value in columns.items()], "line_format"
    )


def harmonize(events: DataFrame) -> DataFrame:
    """Ready events for windowing: UTC timestamp, `process`, `host`, `message`.

    A column that is already there is kept, so tables from elsewhere pass too.
    """
    have = set(events.columns)
    out = events
    if "timestamp" in have:
        out = out.withColumn("timestamp", F.col("timestamp").try_cast("timestamp"))
    if "service" in have and "process" not in have:
        out = out.withColumn("process", F.col("service"))
    if "source_file" in have and "host" not in have:
        host = F.col("source_file")
        if "syslog_host" in have:
            host = F.coalesce("syslog_host", host)
        out = out.withColumn("host", host)
    if "message_raw" in have and "message" not in have:
        out = out.withColumn("message", F.col("message_raw"))
    return out


def parse_statistics(events: DataFrame) -> DataFrame:
    """One row: matched and fallback lines, rows, valid timestamps and their share."""
    valid = F.count("timestamp")
    rows = F.count(F.lit(1))
    return events.agg(
        F.count_if(F.col("line_format") != "fallback").alias("matched_lines"),
        F.count_if(F.col("line_format") == "fallback").alias("fallback_lines"),
        rows.alias("total_rows"),
        valid.alias("valid_timestamps"),
        F.when(rows > 0, 100.0 * valid / rows).alias("valid_timestamp_percent"),
    )
