import csv
import io
import random
from contextlib import contextmanager

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from logtide.operators.numbering import number_lines
from logtide.plans.log_features import LogFeaturePlan, features_from_files
from logtide.sinks.files import write_csv
from logtide.sources import records
from logtide.sources.lines import lines_per_file, read_lines, replay, stream_lines, unreadable_files
from logtide.sources.records import as_columns, csv_records
from logtide.sources.tables import infer_columns, read_csv, read_feature_csv, run_query


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a.log").write_bytes(b"  one \r\n\r\n\t\nok \xff\xfe line\rthree")
    (tmp_path / "b").write_text("x\ny\n")
    for name in ("deep", "day=2024-01-01"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "c.log").write_text("hidden\n")
    return tmp_path


def test_folder_and_file(spark, folder):
    lines = read_lines(spark, str(folder))
    assert sorted(r.line for r in lines.collect()) == ["ok  line", "one", "three", "x", "y"]
    counts = {r.source_file.split("/")[-1]: r.line_count for r in lines_per_file(lines).collect()}
    assert counts == {"a.log": 3, "b": 2}
    assert read_lines(spark, str(folder / "b")).count() == 2
    numbered = read_lines(spark, str(folder), numbered=True)
    assert [r.line for r in replay(numbered, 4).collect()] == ["one", "ok  line", "three", "x"]
    assert [r.line for r in replay(lines, 2, "line").collect()] == ["ok  line", "one"]
    with pytest.raises(ValueError, match="line_number"):
        replay(lines, 2)


def test_stream_takes_the_files_of_the_folder_only(spark, folder, tmp_path_factory):
    out = tmp_path_factory.mktemp("stream")
    query = stream_lines(spark, str(folder)).select("line").writeStream.format("parquet")
    query = query.option("checkpointLocation", str(out / "progress")).trigger(availableNow=True)
    query.start(str(out / "lines")).awaitTermination()
    lines = [r.line for r in spark.read.parquet(str(out / "lines")).collect() if r.line]
    assert sorted(lines) == ["ok  line", "one", "three", "x", "y"]


def test_files_and_folders_together(spark, folder):
    paths = [str(folder / "deep"), str(folder / "b"), str(folder / "day=2024-01-01" / "c.log")]
    assert sorted(r.line for r in read_lines(spark, paths).collect()) == ["hidden", "hidden", "x", "y"]
    (folder / "with space").mkdir()
    assert read_lines(spark, str(folder / "with space")).count() == 0
    (folder / "with space" / "a b.log").write_text("spaced\n")
    assert [r.line for r in read_lines(spark, str(folder / "with space")).collect()] == ["spaced"]


def test_other_files_are_not_read(spark, folder):
    (folder / "deep" / "broken.gz").write_bytes(b"no gzip at all")
    assert read_lines(spark, str(folder)).count() == 5
    with pytest.raises(Exception):
        read_lines(spark, str(folder / "deep")).count()
    with pytest.warns(RuntimeWarning, match="unreadable"):
        lines = read_lines(spark, str(folder / "deep"), skip_unreadable=True)
    assert [r.line for r in lines.collect()] == ["hidden"]
    found = unreadable_files(spark, str(folder / "deep")).collect()
    assert [r.source_file.rsplit("/", 1)[-1] for r in found] == ["broken.gz"]


def test_hidden_files_are_reported(spark, tmp_path):
    (tmp_path / "_old.log").write_text("gone\n")
    (tmp_path / "new.log").write_text("here\n")
    with pytest.warns(RuntimeWarning, match="1 hidden"):
        assert [r.line for r in read_lines(spark, str(tmp_path)).collect()] == ["here"]


def test_missing_path_warns_or_raises(spark, folder):
    missing = str(folder / "nothing")
    with pytest.warns(RuntimeWarning):
        assert read_lines(spark, missing, on_missing="warn").count() == 0
    with pytest.warns(RuntimeWarning):
        assert read_lines(spark, [missing, str(folder / "b")], on_missing="warn").count() == 2
    with pytest.raises(FileNotFoundError):
        read_lines(spark, missing)
    with pytest.warns(RuntimeWarning):
        assert LogFeaturePlan(spark, on_missing="warn").from_folder(missing).run().count() == 0


def test_line_numbers_of_split_files(spark, tmp_path):
    (tmp_path / "big.log").write_text("".join(f"\nline {i}\n" for i in range(1, 3001)))
    (tmp_path / "small.log").write_text("line 1\n\n\nline 2\n")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "2000")
    try:
        lines = read_lines(spark, str(tmp_path), numbered=True)
        rows = lines.collect()
    finally:
        spark.conf.set(key, before)
    assert len(rows) == 3002
    assert all(r.line == f"line {r.line_number}" for r in rows)


def test_numbers_in_chunks_of_a_hot_group(spark):
    rows = spark.range(5000).selectExpr("id * 3 AS pos", "if(id % 3 = 0, 'hot', concat('f', id % 7)) AS source_file")
    found = number_lines(rows, (rows.pos / 500).cast("bigint"), "pos").collect()
    expected = {}
    for row in sorted(found, key=lambda r: r.pos):
        expected[row.source_file] = expected.get(row.source_file, 0) + 1
        assert row.line_number == expected[row.source_file]


def test_union_of_files(spark, tmp_path):
    (tmp_path / "a").write_text("2024-01-01 00:00:00 one\n")
    (tmp_path / "b").write_text("2024-01-01 00:00:30 two\n")
    (row,) = features_from_files(spark, [str(tmp_path / "a"), str(tmp_path / "b")]).collect()
    assert row.event_count == 2


def test_stored_events_give_the_same_features(spark, tmp_path):
    (tmp_path / "a").write_text("2024-01-01 00:00:00 one\nplain\n2024-01-01 00:01:00 two\n")
    plan = LogFeaturePlan(spark).from_file(str(tmp_path / "a"))
    direct = sorted(plan.run().collect())
    assert sorted(plan.store_events(str(tmp_path / "events")).run().collect()) == direct
    assert len(direct) == 2


def test_csv(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b,c\n1,x,2.5\n2,,3\n")
    table = read_csv(spark, str(path), ["c", "a"])
    assert table.columns == ["a", "c"] and table.dtypes == [("a", "int"), ("c", "double")]
    with pytest.raises(ValueError, match="nope"):
        read_csv(spark, str(path), ["nope"])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_csv(spark, str(tmp_path / "none.csv"))


def test_csv_keeps_quoted_text(spark, tmp_path):
    rows = [(1, 'GET "/a, b"'), (2, "two\nlines"), (3, "NA"), (4, "back\\slash")]
    table = spark.createDataFrame(rows, "id int, said string")
    write_csv(table, str(tmp_path / "t"))
    read = read_csv(spark, str(tmp_path / "t"))
    found = sorted(map(tuple, read.collect()))
    assert found == [(1, rows[0][1]), (2, rows[1][1]), (3, None), (4, rows[3][1])]
    assert read.dtypes == [("id", "int"), ("said", "string")]


@contextmanager
def small_splits(spark, size):
    """Cut files into splits of a few bytes."""
    names = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "10"}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.mark.parametrize(("size", "sent"), [(700, 500_000), (90, 0)])
def test_one_csv_file_is_read_by_many_tasks(spark, tmp_path, monkeypatch, size, sent):
    monkeypatch.setattr(records, "SENT_SPLITS", sent)
    rng, rows = random.Random(size), []
    texts = ["a", "", '"', "a,b", "x\ny", '"q"\n\n"', "é ", " ", '","', "one\ntwo\n" * 40, ",", "'"]
    for name, end in (("a", "\n"), ("b", "\r\n"), ("c", "\n")):
        own = [(str(i), rng.choice(texts), rng.choice(texts)) for i in range(120 if name != "c" else 0)]
        with open(tmp_path / f"{name}.csv", "w", newline="") as file:
            csv.writer(file, lineterminator=end).writerows([("id", "te,xt", 'o"x'), *own])
        rows += own
    with small_splits(spark, size):
        found = as_columns(csv_records(spark, str(tmp_path)), ["id", "te,xt", 'o"x'])
        assert found.rdd.getNumPartitions() > 3 or not sent
        assert sorted(tuple(x or "" for x in r) for r in found.collect()) == sorted(rows)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", '"', "\n", ",", '""', "b\n\n", " "]), max_size=5), min_size=1, max_size=5))
def test_state_behind_lines(fields):
    """A line ends inside a quoted text exactly where the record goes on."""
    values = ["".join(f) for f in fields]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerow(values)
    lines = out.getvalue()[:-1].split("\n")
    state, states = False, []
    for line in lines:
        state = records.ends_inside(line, state)
        states.append(state)
    assert states == [True] * (len(lines) - 1) + [False]


def test_quotes_inside_plain_fields_open_nothing():
    assert not records.ends_inside('5" disk,6" disk,7"', False)
    assert records.ends_inside('5" disk,"open', False)
    assert not records.ends_inside('still open",x"', True)


def test_csv_keeps_outer_white_space(spark, tmp_path):
    rows = [(1, " a "), (2, "\nb\n"), (3, "\tc")]
    write_csv(spark.createDataFrame(rows, "id int, said string"), str(tmp_path / "t"))
    assert sorted(map(tuple, read_csv(spark, str(tmp_path / "t")).collect())) == rows


FEATURE_HEAD = (
    "window_start,window_end,event_count,unique_messages,distinct_hosts,distinct_processes,"
    "avg_msg_length,failed_auth_count,invalid_user_count,entropy_tokens\n"
)


def test_feature_csv_is_strict(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text(FEATURE_HEAD + "2023-03-04 05:06:07,2023-03-04 05:07:07,9,8,2,3,41.5,1,0,3.25\n")
    assert read_feature_csv(spark, str(path)).first().event_count == 9
    path.write_text(FEATURE_HEAD + "junk,2023-03-04 05:07:07,9,8,2,3,41.5,1,0,3.25\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_feature_csv(spark, str(path)).collect()


def test_feature_csv_is_read_by_name(spark, tmp_path):
    path = tmp_path / "f.csv"
    swapped = FEATURE_HEAD.replace("window_start,window_end", "window_end,window_start")
    path.write_text(swapped + "2023-03-04 05:07:07,2023-03-04 05:06:07,9,8,2,3,41.5,1,0,3.25\n")
    row = read_feature_csv(spark, str(path)).first()
    assert row.window_start < row.window_end
    path.write_text("window_start\n2023-03-04 05:07:07\n")
    with pytest.raises(ValueError, match="window_end"):
        read_feature_csv(spark, str(path))


def test_query_parameters(spark):
    spark.range(5).createOrReplaceTempView("five")
    assert run_query(spark, "SELECT id FROM five WHERE id > %s AND id < %s", [1, 3]).first().id == 2
    assert run_query(spark, "SELECT 'a%s' AS x, 7 % 4 AS y").first() == ("a%s", 3)
    assert run_query(spark, "SELECT 'it''s %s' AS x, 7 %% 4 AS y, %s AS z", [9]).first() == ("it's %s", 3, 9)


def test_inferred_types(spark):
    rows = [
        ("1", "1", "1.5", "True", "abc", "", "z" * 300, "5000000000"),
        ("-2", None, "2", "False", None, None, "y", "1"),
    ]
    table = spark.createDataFrame(
        rows, "a string, b string, c string, d string, e string, f string, g string, h string"
    )
    assert dict(infer_columns(table)) == {
        "a": "INTEGER", "b": "DOUBLE PRECISION", "c": "DOUBLE PRECISION", "d": "VARCHAR(15)",
        "e": "VARCHAR(13)", "f": "DOUBLE PRECISION", "g": "TEXT", "h": "BIGINT",
    }
