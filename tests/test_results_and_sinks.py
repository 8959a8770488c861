import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from logtide.operators import flows, results
from logtide.operators.parse import parse_lines
from logtide.sinks import files, tables


@pytest.fixture(scope="module")
def database(spark):
    tables.use_namespace(spark, "sink_tests")
    tables.use_namespace(spark, "sink_tests")
    yield "sink_tests"
    spark.sql("USE default")


def test_time_of_day_shows_fraction_only_if_any(spark):
    table = spark.createDataFrame(
        [(datetime(2024, 1, 1, 1, 2, 3), datetime(2024, 1, 1, 1, 2, 4, 50))],
        "window_start timestamp, window_end timestamp",
    )
    row = results.split_date_time(table).first()
    assert (str(row.date), row.start_time, row.end_time) == ("2024-01-01", "01:02:03", "01:02:04.000050")


def test_summaries(spark):
    table = spark.createDataFrame([(1, "a"), (0, "b"), (1, None)], "ensemble_anomaly int, s string")
    assert tuple(results.label_summary(table).first()) == (3, 2)
    assert [tuple(r) for r in results.value_counts(table, "ensemble_anomaly").collect()] == [(1, 2), (0, 1)]
    assert results.value_counts(table, "s").count() == 2
    assert results.numeric_columns(table).columns == ["ensemble_anomaly"]
    assert results.head(table, 1, "ensemble_anomaly").first().s == "b"
    assert results.count_where(table, F.col("ensemble_anomaly") == 1).first()[0] == 2
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        results.result_columns(table)


def test_events_survive_csv_and_json(spark, tmp_path):
    lines = ['2024-01-01 00:00:00.123456 [err] say "a,b" failed login', "plain \\ text"]
    events = parse_lines(spark.createDataFrame([(x,) for x in lines], "line string"), 2024)
    files.save_output(events, str(tmp_path), "logs")
    back = spark.read.schema(events.schema).json(str(tmp_path / "logs.json"))
    assert sorted(map(str, back.collect())) == sorted(map(str, events.collect()))
    text = spark.read.csv(str(tmp_path / "logs.csv"), header=True, escape='"')
    assert sorted(r.message for r in text.collect()) == sorted(r.message for r in events.collect())
    tags = {r.indicator_tags_list for r in text.collect()}
    assert tags == {'["error","security"]', "[]"}
    assert text.filter("timestamp LIKE '%00:00:00.123456Z'").count() == 1


def test_append_counts_and_checks_columns(spark, database):
    tables.create_table(spark, "plain", "a INT, b STRING")
    assert tables.append(spark.createDataFrame([("x", 1)], "b string, a int"), "plain") == 1
    assert tables.append(spark.range(3).selectExpr("cast(id AS int) AS a"), "plain") == 3
    assert spark.table("plain").filter("b IS NULL").count() == 3
    with pytest.raises(ValueError, match="zzz"):
        tables.append(spark.range(1).selectExpr("id AS zzz"), "plain")
    done = tables.run_statement(spark, "INSERT INTO plain SELECT a, b FROM plain WHERE a = %s", [1])
    assert done.first().affected_rows == 2
    assert tables.run_statement(spark, "SELECT count(*) AS n FROM plain").first().n == 6
    assert tables.run_statement(spark, "CREATE TABLE IF NOT EXISTS p2 (a INT) USING parquet").first()[0] == -1


def test_inserts_with_named_columns(spark, database):
    tables.create_table(spark, "named", "a INT, b INT")
    assert tables.run_statement(spark, "INSERT INTO named (b, a) VALUES (1, 2), (3, 4)").first()[0] == 2
    assert tables.run_statement(spark, "insert into named(b) SELECT 5").first()[0] == 1
    rows = sorted(map(str, spark.table("named").collect()))
    assert rows == ["Row(a=2, b=1)", "Row(a=4, b=3)", "Row(a=None, b=5)"]
    for statement in ("INSERT OVERWRITE named SELECT 1, 2", "INSERT INTO named PARTITION (a = 1) SELECT 2"):
        with pytest.raises(ValueError):
            tables.run_statement(spark, statement)


def test_table_from_csv(spark, database, tmp_path):
    (tmp_path / "t.csv").write_text("a,b,c\n1,x,\n2,yy,3\n")
    assert tables.create_table_from_csv(spark, str(tmp_path / "t.csv"), "made", ["c", "b", "a"]) == [
        ("a", "INTEGER"), ("b", "VARCHAR(12)"), ("c", "DOUBLE PRECISION"),
    ]
    assert sorted(map(tuple, spark.table("made").collect())) == [(1, "x", None), (2, "yy", 3.0)]
    assert tables.column_types_option([("a", "TEXT"), ("b", "INTEGER")]) == "a TEXT, b INTEGER"


def test_keyed_table_keeps_the_last_version(spark, database):
    tables.create_keyed_table(spark, "keyed", "id STRING, v INT")
    first = spark.createDataFrame([("a", 2), ("b", 1), ("a", 1)], "id string, v int")
    assert tables.append_keyed(first, "keyed", ["v"]) == 2
    tables.append_keyed(spark.createDataFrame([("b", 0), ("c", 3)], "id string, v int"), "keyed", ["v"])
    for _ in range(2):
        rows = sorted(map(tuple, tables.read_keyed(spark, "keyed").collect()))
        assert rows == [("a", 2), ("b", 0), ("c", 3)]
        tables.compact_keyed(spark, "keyed")
        assert spark.table("keyed").count() == 3


def test_keyed_load_follows_the_order_not_the_files(spark, database, tmp_path):
    (tmp_path / "a.csv").write_text("id,v,at,rest\n1,last,9,x\n2,only,1,x\n")
    (tmp_path / "b.csv").write_text("id,v,at,rest\n1,first,1,x\n" + "".join(f"{i},z,1,x\n" for i in range(3, 500)))
    tables.create_keyed_table(spark, "loaded", "id INT, v STRING")
    assert tables.load_csv_keyed(spark, str(tmp_path), "loaded", ["at"], columns=["v"]) == 499
    found = {r.id: r.v for r in tables.read_keyed(spark, "loaded").collect()}
    assert (found[1], found[2], found[499]) == ("last", "only", "z")


def test_ids(spark):
    table = spark.range(100)
    assert tables.with_uuid(table.withColumnRenamed("id", "n")).select("id").distinct().count() == 100
    named = table.withColumnRenamed("id", "n")
    once, again = (tables.with_uuid(named, ["n"]).orderBy("n").collect() for _ in range(2))
    assert once == again and len({r.id for r in once}) == 100
    assert all(len(r.id) == 36 for r in once)


def test_absent_connector(spark):
    options = tables.wide_column_options("ks", "t")
    with pytest.warns(RuntimeWarning):
        assert not tables.append_remote(spark.range(1), "org.apache.spark.sql.cassandra", options, "warn")
    with pytest.raises(Exception):
        tables.append_remote(spark.range(1), "org.apache.spark.sql.cassandra", options)
    url = tables.jdbc_options("db", "logs", "writer", "secret")
    assert url["url"] == "jdbc:postgresql://db:5432/logs" and url["user"] == "writer"


def test_flow_features(spark):
    table = spark.createDataFrame(
        [("10.0.0.1", "1.2.3.4", 1, 2, "é", "Sent", "3G"), ("10.0.0.1", "1.2.3.4", 1, 2, None, "Sent", "4G")],
        "src_ip string, dst_ip string, src_port int, dst_port int, payload string, direction string, "
        "traffic_type string",
    )
    rows = flows.flow_features(table).collect()
    assert tuple(rows[0]) == ([10, 0, 0, 1], [1, 2, 3, 4], 1, 2, 2, 0)
    assert rows[1].payload_length == 0
    assert {r.direction_packets for r in flows.flow_totals(table).collect()} == {2}
    listed = flows.flow_listing(table, "p", "r").collect()
    assert {(r.src_port, r.dst_port, r.proxy_ip, r.reverse_proxy_ip) for r in listed} == {(1, 2, "p", "r")}


def test_a_killed_compaction_loses_nothing(spark, database, monkeypatch):
    tables.create_keyed_table(spark, "kept", "id INT, v INT", buckets=4)
    for v in range(3):
        rows = spark.range(60).selectExpr("cast(id AS int) AS id", f"cast({v} AS int) AS v")
        tables.append_keyed(rows.filter(f"id % 3 >= {v}"), "kept", ["v"])
    expected = sorted((i, i % 3) for i in range(60))

    def read():
        return sorted(map(tuple, tables.read_keyed(spark, "kept").collect()))

    def killed(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(tables, "append", killed)
        with pytest.raises(KeyboardInterrupt):
            tables.compact_keyed(spark, "kept")
    assert read() == expected
    with monkeypatch.context() as patch:
        patch.setattr(tables, "_drop_generations", killed)
        with pytest.raises(KeyboardInterrupt):
            tables.compact_keyed(spark, "kept")
    assert read() == expected and spark.table("kept").count() > 60
    assert tables.compact_keyed(spark, "kept") == 4
    assert read() == expected and spark.table("kept").count() == 60
    # Only buckets with new versions are written again.
    assert tables.compact_keyed(spark, "kept") == 0
    tables.append_keyed(spark.createDataFrame([(7, 9)], "id int, v int"), "kept", ["v"])
    assert tables.compact_keyed(spark, "kept") == 1
    assert (7, 9) in read() and spark.table("kept").count() == 60


def test_a_key_is_read_from_its_bucket(spark, database):
    tables.create_keyed_table(spark, "pruned", "id BIGINT, v INT", buckets=8)
    tables.append_keyed(spark.range(100).selectExpr("id", "cast(id AS int) AS v"), "pruned", ["v"])
    assert tables.read_key(spark, "pruned", 42).first().v == 42
    assert tables.read_key(spark, "pruned", 420).count() == 0
    files = spark.table("pruned").filter("id = 42").select("_metadata.file_path").distinct().count()
    row = tables.read_key(spark, "pruned", 42)
    plan = row._jdf.queryExecution().toString()
    assert files == 1 and "PartitionFilters: [isnotnull(_bucket" in plan


def test_update_and_delete_rewrite_only_touched_partitions(spark, database):
    tables.create_table(spark, "parted", "id INT, said STRING, p STRING", ["p"])
    rows = [(i, f"s{i}", ["a", "b'c", None, "d/e"][i % 4]) for i in range(40)]
    tables.append(spark.createDataFrame(rows, "id int, said string, p string"), "parted")

    def files():
        found = spark.table("parted").select("p", "_metadata.file_path").distinct().collect()
        return {(r.p, r.file_path) for r in found}

    before = files()
    update = "UPDATE parted SET said = concat(said, ', (x', ')'), id = id + %s WHERE id >= %s AND p = 'b''c'"
    assert tables.run_statement(spark, update, [100, 20]).first()[0] == 5
    changed = {i: (i + 100, f"s{i}, (x)") if i >= 20 and p == "b'c" else (i, s) for i, s, p in rows}
    assert sorted((r.id, r.said) for r in spark.table("parted").collect()) == sorted(changed.values())
    assert {p for p, _ in files() - before} == {"b'c"}
    assert tables.run_statement(spark, "DELETE FROM parted WHERE p IS NULL OR (p = 'a' AND id < 8)").first()[0] == 12
    left = sorted(v[0] for i, v in changed.items() if rows[i][2] is not None and not (rows[i][2] == "a" and i < 8))
    assert sorted(r.id for r in spark.table("parted").collect()) == left
    assert tables.run_statement(spark, "DELETE FROM parted WHERE id = 10000").first()[0] == 0
    tables.append(spark.createDataFrame([(1, "new", "b'c")], "id int, said string, p string"), "parted")
    assert spark.table("parted").count() == len(left) + 1
    assert tables.run_statement(spark, "DELETE FROM parted").first()[0] == len(left) + 1
    assert spark.table("parted").count() == 0
    tables.create_table(spark, "whole", "a INT")
    for statement in ("UPDATE whole SET a = 1", "DELETE FROM whole", "UPDATE parted SET p = 'z'", "UPDATE parted SET q = 1"):
        with pytest.raises(ValueError):
            tables.run_statement(spark, statement)


def test_a_batch_is_added_once(spark, database, tmp_path, monkeypatch):
    tables.create_batch_table(spark, "batches", "id BIGINT")
    rows = spark.range(5)
    assert tables.append_batch(rows, "batches", "one", 0) == 5
    assert tables.append_batch(rows, "batches", "one", 0) == 0
    assert tables.append_batch(rows, "batches", "it's", 0) == 5
    assert tables.append_batch(rows.filter("id < 0"), "batches", "one", 1) == 0
    assert tables.append_batch(rows, "batches", "one", 1) == 0
    assert spark.table("batches").count() == 10
    # A stream that fails behind its append runs the batch again.
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    append, failed = tables.append_batch, []

    def failing(batch, table, writer, number):
        append(batch, table, writer, number)
        if number == 1 and not failed:
            failed.append(number)
            raise RuntimeError("killed")

    monkeypatch.setattr(tables, "append_batch", failing)
    for _ in range(2):
        query = tables.append_stream(stream, "batches", "stream", str(tmp_path / "progress"))
        try:
            query.trigger(availableNow=True).start().awaitTermination()
        except Exception as error:
            assert "killed" in str(error)
    assert failed and sorted(r.id for r in spark.table("batches").filter("_writer = 'stream'").collect()) == list(range(5))


def test_json_arrays(spark, tmp_path):
    rows = [(i, None if i % 2 else f'"{i}", [é]') for i in range(9)]
    files.write_json_array(spark.createDataFrame(rows, "a int, b string").repartition(3), str(tmp_path / "j"))
    parts = sorted((tmp_path / "j").glob("part-*"))
    assert len(parts) == 3
    found = [row for part in parts for row in json.loads(part.read_text())]
    assert sorted((r["a"], r["b"]) for r in found) == rows
    files.write_json_array(spark.createDataFrame([], "a int").coalesce(1), str(tmp_path / "none"))
    assert [json.loads(p.read_text()) for p in (tmp_path / "none").glob("part-*")] in ([], [[]])
