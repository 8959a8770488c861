import math
import random
import re
from collections import Counter
from datetime import datetime, timedelta

import pytest

from logtide.functions.patterns import FEATURE_COLUMNS
from logtide.operators.parse import harmonize, parse_lines
from logtide.operators.windows import (
    assign_windows,
    feature_statistics,
    token_entropy,
    window_features,
)

SCHEMA = "timestamp timestamp, host string, process string, message string"


def test_small_window_by_hand(spark):
    """Four events: tokens disk x3, full x2, ok, again over seven places."""
    start = datetime(2022, 5, 6, 7, 8, 9)
    rows = [("n1", "io", "disk full"), ("n1", "io", "disk full"), ("n2", "io", "disk ok"), ("n2", "net", "again")]
    events = spark.createDataFrame(
        [(start + timedelta(seconds=10 * i), *row) for i, row in enumerate(rows)], SCHEMA
    )
    (row,) = window_features(events, 40).collect()
    assert row[2:9] == (4, 3, 2, 2, 7.5, 0, 0)
    shares = [3 / 7, 2 / 7, 1 / 7, 1 / 7]
    assert row.entropy_tokens == pytest.approx(-sum(p * math.log2(p) for p in shares))
    assert (row.window_start, row.window_end) == (start, start + timedelta(seconds=40))


def test_lines_to_features_by_hand(spark):
    lines = [
        "Mar  3 04:05:06 gate sshd[11]: Failed password for root from 10.1.2.3 port 999 ssh2",
        "Mar  3 04:05:20 gate sshd[12]: Invalid user bob from 10.1.2.4",
        "Mar  3 04:05:50 gate sshd[12]: Failed password for invalid user bob from 10.1.2.4 port 1 ssh2",
    ]
    table = spark.createDataFrame([(line,) for line in lines], "line string")
    (row,) = window_features(harmonize(parse_lines(table, 2024))).collect()
    messages = [line.split(": ", 1)[1] for line in lines]
    assert row[2:6] == (3, 3, 1, 2)
    assert row.avg_msg_length == pytest.approx(sum(map(len, messages)) / 3)
    assert (row.failed_auth_count, row.invalid_user_count) == (2, 2)


def test_single_features_explode_nothing(spark):
    events = spark.createDataFrame([(datetime(2024, 1, 1), "h", "p", "m n")], SCHEMA)
    wanted = ["window_start", "event_count", "avg_msg_length", "failed_auth_count"]
    table = window_features(events, columns=wanted)
    assert table.columns == wanted and table.first().event_count == 1
    assert "Generate" not in table._jdf.queryExecution().optimizedPlan().toString()


def brute_force(rows, width):
    rows = [r for r in rows if r[0] is not None]
    start = min(r[0] for r in rows)
    groups = {}
    for row in rows:
        groups.setdefault((row[0] - start) // timedelta(seconds=width), []).append(row)
    out = {}
    for k, group in groups.items():
        messages = [m for *_, m in group if m is not None]
        counts = Counter(t for m in messages for t in re.findall(r"\w+", m.lower()))
        total = sum(counts.values())
        entropy = -sum(c / total * math.log2(c / total) for c in counts.values()) if total else 0.0
        out[start + k * timedelta(seconds=width)] = (
            len(group), len(set(messages)), len({h for _, h, _, _ in group if h is not None}),
            len({p for _, _, p, _ in group if p is not None}),
            sum(map(len, messages)) / len(messages) if messages else None,
            sum("failed password" in m.lower() for m in messages),
            sum("invalid user" in m.lower() for m in messages), entropy,
        )
    return out


@pytest.mark.parametrize("width", [60, 7, 0.5])
def test_random_events_with_one_hot_window(spark, width):
    rng = random.Random(3)
    words = ["été", "Failed password", "INVALID user", "x_1", "中文 字", "!!", "a b a", "", None]
    rows = []
    for i in range(600):
        # A third of all events fall into one second.
        offset = 1000.25 if i % 3 == 0 else rng.uniform(0, 4000)
        when = datetime(2024, 2, 28, 23, 50) + timedelta(seconds=offset)
        text = rng.choice(words)
        message = None if text is None else f"{text} {rng.choice(words) or ''}".strip()
        rows.append(
            (None if i % 50 == 1 else when, rng.choice(["a", "b", None]), rng.choice("pqr"), message)
        )
    events = spark.createDataFrame(rows, SCHEMA)
    expected = brute_force(rows, width)
    found = {r.window_start: tuple(r)[2:] for r in window_features(events, width).collect()}
    assert found.keys() == expected.keys()
    for key, values in expected.items():
        assert found[key] == pytest.approx(values), key
    assert sum(v[0] for v in found.values()) == sum(r[0] is not None for r in rows)


def test_origin_and_edges(spark):
    base = datetime(2024, 1, 1)
    times = [base - timedelta(microseconds=1), base, base + timedelta(seconds=60)]
    events = spark.createDataFrame([(t, "h", "p", "m") for t in times], SCHEMA)
    starts = [r.window_start for r in assign_windows(events, 60, base).orderBy("timestamp").collect()]
    assert starts == [base - timedelta(seconds=60), base, base + timedelta(seconds=60)]


def test_no_times_give_the_empty_table(spark):
    events = spark.createDataFrame([(None, "h", "p", "m")], SCHEMA)
    features = window_features(events)
    assert features.columns == FEATURE_COLUMNS and features.count() == 0
    assert window_features(events.limit(0)).count() == 0


def test_statistics_count_empty_windows(spark):
    base = datetime(2024, 1, 1)
    events = spark.createDataFrame(
        [(base + timedelta(seconds=s), "h", "p", "m n") for s in (0, 1, 600)], SCHEMA
    )
    row = feature_statistics(window_features(events)).first()
    assert (row.total_windows, row.filled_windows, row.empty_windows) == (11, 2, 9)
    assert (row.min_event_count, row.max_event_count, row.max_entropy_tokens) == (1, 2, 1.0)


def test_token_entropy_keeps_keys_without_tokens(spark):
    table = spark.createDataFrame([(1, "a b"), (1, "a c"), (2, "!!"), (3, None)], "k int, message string")
    rows = {r.k: (r.token_count, r.entropy_tokens) for r in token_entropy(table, ["k"]).collect()}
    assert rows == {1: (4, 1.5), 2: (0, 0.0), 3: (0, 0.0)}
