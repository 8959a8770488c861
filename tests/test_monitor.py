import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logtide.functions import patterns as P
from logtide.operators import monitor, panes, profiles
from logtide.operators.windows import window_features


def test_standardize(spark):
    table = spark.createDataFrame([(1.0, 5), (3.0, 5)], "a double, b int")
    rows = sorted(tuple(r) for r in monitor.standardize(table, ["a", "b"]).collect())
    assert rows == [(-1.0, 0.0), (1.0, 0.0)]


@pytest.mark.parametrize("chunk", [10_000, 1, 3])
def test_sessions_equal_brute_force(spark, monkeypatch, chunk):
    """One key holds most rows; small chunks cut its sessions."""
    monkeypatch.setattr(monitor, "CHUNK_SLOTS", chunk)
    rng = random.Random(5)
    base = datetime(2024, 1, 1)
    rows = [("hot" if i % 3 else f"k{i % 5}", base + timedelta(seconds=rng.choice([60, 1, 30]) * rng.randint(0, 300)))
            for i in range(400)]
    expected = []
    for key in {k for k, _ in rows}:
        session = []
        for when in sorted(t for k, t in rows if k == key):
            if session and when - session[-1] > timedelta(seconds=60):
                expected.append((key, session[0], session[-1] + timedelta(seconds=60), len(session)))
                session = []
            session.append(when)
        expected.append((key, session[0], session[-1] + timedelta(seconds=60), len(session)))
    table = spark.createDataFrame(rows, "k string, timestamp timestamp")
    assert sorted(map(tuple, monitor.sessions(table, ["k"], 60).collect())) == sorted(expected)
    spark_own = table.groupBy(F.session_window("timestamp", "60 seconds"), "k").count().count()
    assert spark_own == len(expected)


def test_drift(spark):
    rng = random.Random(2)
    old, new = [rng.gauss(0, 1) for _ in range(300)], [rng.gauss(0.5, 1) for _ in range(200)]
    table = spark.createDataFrame([(v, False) for v in old] + [(v, True) for v in new], "v double, now boolean")
    gap = max(abs(sum(x <= v for x in old) / 300 - sum(x <= v for x in new) / 200) for v in old + new)
    for slices in (1, 7, 64):
        found = monitor.ks_statistic(table, "v", F.col("now"), slices).first().ks
        assert found == pytest.approx(gap)
    hot = table.withColumn("v", F.when(F.col("v") < 0.8, 0.0).otherwise(F.col("v")))
    below = sum(x < 0.8 for x in old) / 300, sum(x < 0.8 for x in new) / 200
    assert monitor.ks_statistic(hot, "v", F.col("now")).first().ks >= abs(below[0] - below[1]) - 1e-12
    assert monitor.psi(table, "v", F.col("now"), [-1, 0, 1]).first().psi > 0.05
    same = table.withColumn("v", F.lit(0.0))
    assert monitor.psi(same, "v", F.col("now"), [-1, 0, 1]).first().psi == pytest.approx(0)


def test_quality(spark):
    rows = [(i, float(i), int(i >= 7), int(i % 2)) for i in range(10)]
    table = spark.createDataFrame(rows, "id int, score double, truth int, label int")
    assert tuple(monitor.precision_recall_at_k(table, "score", "truth", 4, "id").first()) == (0.75, 1.0)
    rates = monitor.detection_rates(table, "label", "truth").first()
    assert rates.detection_rate == pytest.approx(2 / 3) and rates.false_positive_rate == pytest.approx(3 / 7)


def test_time_to_detect(spark):
    base = datetime(2024, 1, 1)
    rows = [(1, 0, "hit"), (1, 5, "start"), (1, 9, "hit"), (1, 30, "hit"), (2, 0, "start"), (3, 1, "start"), (3, 1, "hit")]
    table = spark.createDataFrame([(i, base + timedelta(seconds=s), e) for i, s, e in rows], "i int, timestamp timestamp, e string")
    row = monitor.mean_time_to_detect(table, "i", F.col("e") == "start", F.col("e") == "hit").first()
    assert tuple(row) == (2, 2.0)


def test_correlate(spark):
    base = datetime(2024, 1, 1)
    events = spark.createDataFrame(
        [(base + timedelta(seconds=s), k) for s, k in [(0, "a"), (1, "a"), (61, "b"), (125, "a")]],
        "timestamp timestamp, service string",
    )
    flagged = spark.createDataFrame([(base,), (base + timedelta(seconds=120),)], "window_start timestamp")
    rows = monitor.correlate(events, flagged, ["service"]).collect()
    assert [tuple(r) for r in rows] == [("a", 3, 2)]


def test_sliding_features_are_those_of_each_window(spark):
    """Panes give what filtering the events of every window gives, nulls and gaps included."""
    rng = random.Random(3)
    base = datetime(2024, 1, 1)
    rows = []
    for _ in range(300):
        when = base + timedelta(seconds=rng.randint(-2000, 4000), microseconds=rng.randint(0, 999_999))
        said = rng.choice([None, "", "a b", "Failed password for invalid user x", "a a a"])
        rows.append((when if rng.random() < 0.95 else None, rng.choice(["h", None]), rng.choice(["p", "q"]), said))
    events = spark.createDataFrame(rows, "timestamp timestamp, host string, process string, message string").cache()
    for width, slide in ((300, 120), (100, 250), (60, 60)):
        found = {r.window_start: r for r in panes.sliding_features(events, width, slide).collect()}
        first, n = base.timestamp() // slide * slide, 0
        for k in range(-2000 // slide - width // slide - 2, 4000 // slide + 2):
            start = datetime.fromtimestamp(first + k * slide)
            end = start + timedelta(seconds=width)
            own = events.filter((F.col("timestamp") >= F.lit(start)) & (F.col("timestamp") < F.lit(end)))
            if not [r for r in rows if r[0] is not None and start <= r[0] < end]:
                assert start not in found
                continue
            n += 1
            if n % 9 and width != 100:
                continue
            one = window_features(own, 100_000, datetime(2000, 1, 1)).first()
            row = found[start]
            assert row.window_end == end
            for name in P.NUMERIC_FEATURES:
                a, b = row[name], one[name]
                assert a == b or abs(a - b) < 1e-9, (name, start)
        assert len(found) == n


def test_merged_sketches_count_within_their_bound(spark):
    rows = [(datetime(2024, 1, 1) + timedelta(seconds=i), f"h{i % 7}", None, f"m{i * i % 5003}") for i in range(20_000)]
    events = spark.createDataFrame(rows, "timestamp timestamp, host string, process string, message string")
    small = panes.distinct_sketches(events, 60)
    merged = panes.estimated_counts(panes.merge_sketches(small, 86_400)).first()
    exact = len({r[3] for r in rows})
    assert abs(merged.unique_messages - exact) <= panes.relative_error() * exact
    assert (merged.distinct_hosts, merged.distinct_processes) == (7, 0)


def test_stored_profiles_give_the_drift_of_the_rows(spark):
    rng = random.Random(9)
    base = datetime(2024, 1, 1)
    rows = [(base + timedelta(hours=i % 240), rng.gauss(0, 1) + (i % 240 >= 120) * 0.5, float(i % 4), None) for i in range(24_000)]
    table = spark.createDataFrame(rows, "ts timestamp, v double, w double, x double").cache()
    days = profiles.profile(table, ["v", "w", "x"], "ts")
    assert days.count() == 30
    past = profiles.merged(days.filter("day < '2024-01-06'")).cache()
    now = profiles.merged(days.filter("day >= '2024-01-06'"))
    assert {r.feature: r.rows for r in past.collect()} == {"v": 12_000, "w": 12_000}
    found = {r.feature: r for r in profiles.drift(past, now).collect()}
    edges = profiles.edges_of(past)
    late = F.col("ts") >= F.lit(base + timedelta(hours=120))
    for name in ("v", "w"):
        exact = monitor.psi(table, name, late, edges[name]).first().psi
        assert abs(found[name].psi - exact) < 0.1 * exact + 0.01
        for edge, share in zip(edges[name], found[name].expected, strict=False):
            own = [r[1 if name == "v" else 2] for r in rows if r[0] < base + timedelta(hours=120)]
            lower = max([e for e in edges[name] if e < edge], default=-100)
            assert abs(share - sum(lower <= v < edge for v in own) / len(own)) <= 2 * profiles.share_error()
    assert found["v"].psi > 0.2 and found["w"].psi < 0.01
    assert abs(found["v"].ks - monitor.ks_statistic(table, "v", late).first().ks) < 0.05
