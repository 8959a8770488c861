from pathlib import Path
from datetime import datetime

from pyspark.sql import functions as F

from logtide.operators import monitor
from logtide.operators.parse import harmonize, parse_lines
from logtide.operators.windows import window_features
from logtide.plans.anomaly import AnomalyPlan
from logtide.session import scratch_path
from logtide.sources.lines import read_lines, stream_lines
from logtide.streaming.features import parse_stream, stream_correlation, stream_features, stream_sessions
from logtide.streaming.scoring import write_labels

ORIGIN = datetime(2024, 1, 1, 0, 0, 7)


def write_lines(path):
    lines = [
        f"2024-01-01 0{i // 60 % 3}:{i % 60:02d}:{i * 7 % 60:02d}.{i:06d} [info] Failed password for u{i % 5} {'x' * (i % 9)}"
        for i in range(400)
    ]
    path.mkdir()
    for part in range(3):
        (path / f"{part}.log").write_text("\n".join([*lines[part::3], "  ", "no time"]) + "\n")
    (path / "end.log").write_text("2031-01-01 00:00:00 end\n")


def test_closed_windows_equal_the_batch(spark, tmp_path):
    write_lines(tmp_path / "in")
    source = str(tmp_path / "in")
    stream = stream_features(parse_stream(stream_lines(spark, source)), 60, ORIGIN)
    (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", scratch_path(spark, "progress"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
        .awaitTermination()
    )
    found = sorted(spark.read.parquet(str(tmp_path / "out")).collect())
    events = harmonize(parse_lines(read_lines(spark, source)))
    batch = window_features(events, 60, ORIGIN).filter("window_start < '2030-01-01'")
    expected = sorted(batch.collect())
    assert len(found) == len(expected) > 100
    for a, b in zip(found, expected, strict=True):
        assert a[:-1] == b[:-1] and abs(a[-1] - b[-1]) < 1e-9

    plan = AnomalyPlan(epochs=1).fit(batch.cache()).keep_for_streams(batch)
    stream = stream_features(parse_stream(stream_lines(spark, source)), 60, ORIGIN)
    writer = write_labels(stream, plan.registry, str(tmp_path / "labels"), scratch_path(spark, "p"))
    writer.trigger(availableNow=True).start().awaitTermination()
    labels = spark.read.parquet(str(tmp_path / "labels"))
    mine = {(r.window_start, r.dbscan_label, r.isolation_forest_label) for r in labels.collect()}
    theirs = {
        (r.window_start, r.dbscan_label, r.isolation_forest_label) for r in plan.label(batch).collect()
    }
    assert mine == theirs


def test_micro_batches_leave_no_scratch(spark, tmp_path):
    write_lines(tmp_path / "in")
    batch = window_features(harmonize(parse_lines(read_lines(spark, str(tmp_path / "in")))), 60, ORIGIN).cache()
    registry = AnomalyPlan(epochs=1).fit(batch).keep_for_streams(batch).registry
    batch.repartition(3).write.parquet(str(tmp_path / "features"))
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "features"))

    def left() -> set[str]:
        return {p.name for p in Path(spark.conf.get("spark.checkpoint.dir")).iterdir()}

    before = left()
    writer = write_labels(stream, registry, str(tmp_path / "labels"), str(tmp_path / "progress"))
    writer.trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(str(tmp_path / "labels")).select("batch_id").distinct().count() == 3
    assert left() == before


def test_blank_records_stay(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_text(" a \n\n")
    stream = stream_lines(spark, str(tmp_path / "in"))
    run = stream.writeStream.format("memory").queryName("blank_records").trigger(availableNow=True).start()
    run.awaitTermination()
    assert sorted(r.line for r in spark.table("blank_records").collect()) == ["", "a"]


def run_to(stream, sink, progress):
    writer = stream.writeStream.format("parquet").option("checkpointLocation", progress)
    writer.trigger(availableNow=True).start(sink).awaitTermination()


def test_state_keys_hold_no_text(spark, tmp_path):
    write_lines(tmp_path / "in")
    progress = str(tmp_path / "progress")
    stream = stream_features(parse_stream(stream_lines(spark, str(tmp_path / "in"))), 60, ORIGIN, late="100000 days")
    run_to(stream, str(tmp_path / "out"), progress)
    state = spark.read.format("statestore").option("operatorId", 1).load(progress)
    rows = state.select("key.*", "value.*").collect()
    assert {c for c in state.select("key.*").columns} == {"window_start", "key"}
    assert len(rows) > 1000 and max(len(r.key) for r in rows) == 16
    kinds = {f.dataType.simpleString() for f in state.select("value.*").schema.fields}
    assert kinds <= {"bigint", "int", "boolean"}


def test_closed_sessions_equal_the_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    rows = [(f"k{i % 3}", i * i * 7 % 5000) for i in range(120)] + [("k0", 0), ("k9", 4999)]
    lines = [f"2024-01-01 {s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d} {k}" for k, s in rows]
    for part in range(3):
        (folder / f"{part}.log").write_text("\n".join(lines[part::3]) + "\n")
    (folder / "end.log").write_text("2031-01-01 00:00:00 end\n")
    source = str(folder)
    keyed = parse_stream(stream_lines(spark, source)).select("timestamp", F.element_at(F.split("message", " "), -1).alias("who"))
    run_to(stream_sessions(keyed, ["who"], 60), str(tmp_path / "out"), str(tmp_path / "p"))
    events = harmonize(parse_lines(read_lines(spark, source)))
    events = events.select("timestamp", F.element_at(F.split("message", " "), -1).alias("who"))
    expected = monitor.sessions(events.filter("timestamp < '2030-01-01'"), ["who"], 60)
    found = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))


def test_late_events_join_no_closed_session(spark, tmp_path):
    folder, progress = tmp_path / "in", str(tmp_path / "p")
    folder.mkdir()
    for number, said in enumerate(["00:00:00", "02:00:00", "00:00:10", "04:00:00"]):
        (folder / f"{number}.log").write_text(f"2024-01-01 {said} x\n")
        stream = parse_stream(stream_lines(spark, str(folder))).select("timestamp", F.lit("x").alias("who"))
        run_to(stream_sessions(stream, ["who"], 60), str(tmp_path / "out"), progress)
    found = spark.read.parquet(str(tmp_path / "out")).orderBy("session_start").collect()
    assert [(r.session_start.hour, r.event_count) for r in found] == [(0, 1), (2, 1)]


def test_streamed_correlation_equals_the_batch(spark, tmp_path):
    write_lines(tmp_path / "in")
    source = str(tmp_path / "in")
    events = harmonize(parse_lines(read_lines(spark, source))).withColumn("who", F.length("message") % 3)
    flagged = window_features(events, 60, ORIGIN).filter("event_count % 2 = 1").select("window_start")
    flagged = flagged.filter("window_start < '2030-01-01'")
    end = spark.sql("SELECT timestamp'2031-01-01 00:00:00' AS window_start")
    flagged.unionByName(flagged).unionByName(end).write.parquet(str(tmp_path / "flagged"))
    stream = parse_stream(stream_lines(spark, source)).withColumn("who", F.length("message") % 3)
    anomalies = spark.readStream.schema(flagged.schema).parquet(str(tmp_path / "flagged"))
    run_to(stream_correlation(stream, anomalies, ["who"], 60, ORIGIN), str(tmp_path / "out"), str(tmp_path / "p"))
    sums = F.sum("event_count").alias("event_count"), F.count(F.lit(1)).alias("anomalous_windows")
    found = spark.read.parquet(str(tmp_path / "out")).groupBy("who").agg(*sums)
    expected = monitor.correlate(events, flagged, ["who"], 60, ORIGIN)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    assert found.count() == 3
