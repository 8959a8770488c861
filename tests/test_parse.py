from datetime import datetime

import pytest
from pyspark.sql import functions as F

from logtide.functions import fields as X
from logtide.operators.parse import harmonize, parse_lines, parse_statistics


def parse(spark, *lines, **settings):
    table = spark.createDataFrame([(line,) for line in lines], "line string")
    settings.setdefault("default_year", 2024)
    out = parse_lines(table, keep=["line"], **settings).withColumn(
        "timestamp", F.col("timestamp").cast("string")
    )
    found = {row.line: row for row in out.collect()}
    return [found[line] for line in lines]


def test_syslog(spark):
    (row,) = parse(
        spark, "Feb 3 21:14:05 edge7 vpn[311]: error: no route from 203.0.113.9 port 5151 tunnel down"
    )
    assert row.line_format == "syslog"
    assert row.service == "vpn[311]"
    assert (row.ip_src, row.ip_src_valid, row.ip_dst, row.ip_dst_valid) == ("203.0.113.9", True, "", False)
    assert (row.peer_port, row.indicator_tags_list) == (5151, ["error"])
    assert row.timestamp == "2024-02-03 21:14:05"
    assert row.source_file == "unknown"


def test_access_log_keeps_line_and_discards_offset(spark):
    (row,) = parse(
        spark, '1.2.3.4 - - [10/Oct/2000:13:55:36 -0700] "GET /a HTTP/1.1" 200 5 "-" "x"'
    )
    assert (row.line_format, row.timestamp) == ("access", "2000-10-10 13:55:36")
    assert row.message == row.line and row.peer_port is None
    assert (row.ip_src, row.ip_dst) == ("1.2.3.4", "")


def test_windows_event(spark):
    (row,) = parse(
        spark,
        "TimeGenerated: 2024-01-06 10:00:00, EventID: 4625, Level: Warning, Source: Security, "
        "Message: login failed",
    )
    assert (row.line_format, row.level, row.service) == ("windows", "WARNING", "Security")
    assert row.indicator_tags_list == ["error", "security"]
    assert (row.day_of_week, row.is_weekend) == ("Saturday", True)


def test_generic_time_of_the_lines_own_zone(spark):
    (row,) = parse(spark, "2024-01-01T00:00:00.5+05:30 [err] disk")
    assert (row.line_format, row.level) == ("generic", "ERROR")
    assert row.timestamp == "2023-12-31 18:30:00.5"
    assert (row.hour_of_day, row.day_of_week) == (0, "Monday")


def test_generic_bare_level_is_message(spark):
    (row,) = parse(spark, "2024-01-01 00:00:00 ERROR disk")
    assert (row.level, row.message) == ("INFO", "ERROR disk")


def test_fallback(spark):
    (row,) = parse(spark, "job WARN at 10.0.0.1 to 256.1.1.1")
    assert row.line_format == "fallback" and row.timestamp is None
    assert (row.level, row.ip_src, row.ip_dst) == ("WARNING", "10.0.0.1", "")
    assert (row.day_of_week, row.hour_of_day, row.is_weekend) == (None, None, False)


@pytest.mark.parametrize(
    ("message", "source", "target"),
    [
        ("x 256.1.1.1 y 10.0.0.2", "", "10.0.0.2"),
        ("x 01.2.3.4", "", ""),
        ("é1.2.3.4 and 5.6.7.8", "5.6.7.8", ""),
    ],
)
def test_addresses(spark, message, source, target):
    (row,) = parse(spark, f"2024-01-01 00:00:00 {message}")
    assert (row.ip_src, row.ip_dst) == (source, target)


@pytest.mark.parametrize(
    ("message", "port"),
    [
        ("at 10:30", 30), ("GET /1/x port 80", 1), ("PORT 80", None), ("Port: 81", 81),
        ("port 99999999999999999999", None), ("support 1", 1),
    ],
)
def test_ports(spark, message, port):
    (row,) = parse(spark, f"2024-01-01 00:00:00 {message}")
    assert row.peer_port == port


@pytest.mark.parametrize(
    ("line", "expected"),
    [
        ("Jun  9 01:02:03 h p: m", "2024-06-09 01:02:03"),
        ("september 9 1:2:3 h p: m", "2024-09-09 01:02:03"),
        ("Sept 9 01:02:03 h p: m", "2024-09-09 01:02:03"),
        ("Feb 29 01:02:03 h p: m", "2024-02-29 01:02:03"),
        ("Feb 30 01:02:03 h p: m", None),
        ("Dec 10 24:00:00 h p: m", None),
        ("Dec 10 01:02:60 h p: m", None),
        ("Foo 10 01:02:03 h p: m", None),
        ("2024-01-01 00:00:00Z x", "2024-01-01 00:00:00"),
        ("2024-01-01T00:00:00-0130 x", "2024-01-01 01:30:00"),
        ("2024-01-01T00:00:00+23:59 x", "2023-12-31 00:01:00"),
        ("2024-01-01T00:00:00+24:00 x", None),
        ("2024-02-30 00:00:00 x", None),
        ("2024-01-01 00:00:00.123456789 x", "2024-01-01 00:00:00.123456"),
        ('1.2.3.4 - - [31/Feb/2024:01:02:03 +0000] "GET /a H" 2 5 "-" "x"', None),
        ('1.2.3.4 - - [2024-01-02 03:04:05] "GET /a H" 2 5 "-" "x"', "2024-01-02 03:04:05"),
    ],
)
def test_times(spark, line, expected):
    (row,) = parse(spark, line)
    assert row.timestamp == expected
    assert (row.day_of_week is None) == (expected is None)


def test_feb_29_needs_a_leap_year(spark):
    (row,) = parse(spark, "Feb 29 01:02:03 h p: m", default_year=2025)
    assert row.line_format == "syslog" and row.timestamp is None


def test_tags_are_whole_words(spark):
    rows = parse(
        spark, "it is OK, login_failed", "ok: Disconnect! Attention", "éerror errors", "auth-failure"
    )
    assert [r.indicator_tags_list for r in rows] == [
        ["success"], ["warning", "success", "network"], [], ["error", "security"],
    ]


def test_levels(spark):
    words = ["emerg", "Alert", "err", "warn", "notice", "trace", "Audit"]
    rows = parse(spark, *[f"2024-01-01 00:00:00 [{w}] x" for w in words])
    assert [r.level for r in rows] == [
        "CRITICAL", "CRITICAL", "ERROR", "WARNING", "INFO", "DEBUG", "AUDIT",
    ]


def test_empty_message_keeps_line(spark):
    (row,) = parse(spark, "2024-01-01 00:00:00 [warn]")
    assert row.message == "2024-01-01 00:00:00 [warn]" and row.peer_port is None


def test_real_names_without_compat(spark):
    table = spark.createDataFrame(
        [("a.log", "Dec 10 07:07:45 web1 sshd[12]: hi"), ("b.log", "plain")],
        "source_file string, line string",
    )
    rows = harmonize(parse_lines(table, 2024, compat=False)).orderBy("source_file").collect()
    assert [(r.host, r.process, r.pid) for r in rows] == [("web1", "sshd", 12), ("b.log", "", None)]


def test_one_event_per_line_and_statistics(spark):
    lines = ["Dec 10 07:07:45 h p: m", "plain", "2024-01-01 00:00:00 x", "Foo 1 1:1:1 h p: m"]
    table = spark.createDataFrame([(line,) for line in lines], "line string")
    row = parse_statistics(parse_lines(table, 2024)).first()
    assert row.asDict() == {
        "matched_lines": 3, "fallback_lines": 1, "total_rows": 4, "valid_timestamps": 2,
        "valid_timestamp_percent": 50.0,
    }


def test_harmonize_casts_text_times(spark):
    table = spark.createDataFrame(
        [("2024-01-01T00:00:00+00:00", "s", "m"), ("junk", "s", "m")],
        "timestamp string, service string, message_raw string",
    )
    rows = harmonize(table).collect()
    assert [r.timestamp for r in rows] == [datetime(2024, 1, 1), None]
    assert (rows[0].process, rows[0].message) == ("s", "m")


def test_strip_and_clean(spark):
    row = spark.createDataFrame([("　\x1c a b\t ",)], "v string").select(
        X.strip(F.col("v")).alias("s"),
        X.clean_utf8(F.expr("cast(X'6F6B20FFFE206C696E65' AS string)")).alias("c"),
    ).first()
    assert (row.s, row.c) == ("a b", "ok  line")


def test_filter_does_not_run_patterns_twice(spark):
    table = spark.createDataFrame([("x",)], "line string")
    plan = parse_lines(table, 2024).filter("level = 'ERROR'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("RLIKE(line") <= 4
