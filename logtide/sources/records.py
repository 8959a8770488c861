"""Records of CSV files whose quoted texts hold line breaks, read by many tasks.

A split of a file starts at a line, but that line may lie inside a quoted text. What a
split leaves open depends on what it starts with, so every split first says in what state
it ends for either start. These answers, two bits a split, are composed in order of the
splits of a file and tell how each split really starts. Then each split puts its own
lines together; only records that cross its borders move to be joined.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logtide.session import stored

#: Splits whose start states are sent to all tasks (three numbers each); more are joined by shuffle.
SENT_SPLITS = 500_000
WHOLE, HEAD, TAIL = 0, 1, 2
_CLOSE = re.compile(r'[^"]*+(?:""[^"]*+)*+"')


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted text is open behind the line. Only a field's first character opens one."""
    at, n = 0, len(line)
    while True:
        if inside or (at < n and line[at] == '"'):
            closed = _CLOSE.match(line, at + (not inside))
            if closed is None:
                return True
            at, inside = closed.end(), False
        at = line.find(",", at) + 1
        if not at:
            return False


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, split (its first byte) and line, in order within a split. Records end with \\n or \\r\\n."""
    raw = spark.read.option("lineSep", "\n").text(path)
    return raw.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value"
    )


def _runs(file: pa.Array, split: pa.Array) -> list[tuple[int, int]]:
    """Row ranges of one file and split each."""
    f, s = file.to_numpy(), split.to_numpy()
    edges = [0, *(((f[1:] != f[:-1]) | (s[1:] != s[:-1])).nonzero()[0] + 1).tolist()]
    return list(zip(edges, [*edges[1:], len(f)], strict=True)) if len(f) else []


STATES = ["file", "split", "part", "outside", "inside"]


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split, and where a batch ends in its middle per part of it, the state behind it for both starts."""
    part = 0
    for batch in batches:
        for a, b in _runs(batch.column(0), batch.column(1)):
            lines = batch.column(2).slice(a, b - a)
            marked = lines.filter(pc.match_substring(lines, '"')).to_pylist()
            outside, inside = False, True
            for line in marked:
                outside, inside = ends_inside(line, outside), ends_inside(line, inside)
            part += 1
            own = [batch.column(0)[a].as_py(), batch.column(1)[a].as_py(), part, outside, inside]
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in own], names=STATES)


def split_starts(lines: DataFrame) -> DataFrame:
    """file, split, open (whether it starts inside a quoted text) and ends (whether it ends so)."""
    states = lines.mapInArrow(_states, "file long, split long, part long, outside boolean, inside boolean")
    order = Window.partitionBy("file").orderBy("split", "part")
    # Behind a part whose end does not depend on its start all is known: from there on only
    # the parts that turn the state around count.
    fixed = F.col("outside") == F.col("inside")
    turns = F.sum(F.when(F.col("outside") & ~F.col("inside"), 1).otherwise(0)).over(order)
    known = F.when(fixed, F.struct(F.col("outside").alias("state"), F.col("_turns").alias("turns")))
    last = F.last(known, ignorenulls=True).over(order)
    base = F.coalesce(F.col("_last.state").cast("int"), F.lit(0))
    since = F.col("_turns") - F.coalesce(F.col("_last.turns"), F.lit(0))
    after = states.withColumn("_turns", turns).withColumn("_last", last)
    after = after.withColumn("ends", (base + since) % 2 == 1)
    after = after.withColumn("open", F.coalesce(F.lag("ends").over(order), F.lit(False)))
    return after.groupBy("file", "split").agg(F.min_by("open", "part").alias("open"), F.max_by("ends", "part").alias("ends"))


PARTS = "file long, split long, part int, first boolean, record string"


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records of each split, the end of one begun before it and the start of one that goes on."""
    now, held, inside, first = None, [], False, True

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * 5
        types = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["file", "split", "part", "first", "record"])

    for batch in batches:
        rows: list[tuple] = []
        for a, b in _runs(batch.column(0), batch.column(1)):
            key = (batch.column(0)[a].as_py(), batch.column(1)[a].as_py())
            if key != now:
                if held:
                    rows.append((*now, HEAD if head else TAIL, first and now[1] == 0, "\n".join(held)))
                now, held, first = key, [], True
                inside = head = batch.column(3)[a].as_py()
            for line in batch.column(2).slice(a, b - a).to_pylist():
                held.append(line)
                inside = ends_inside(line, inside) if '"' in line else inside
                if not inside:
                    rows.append((*now, HEAD if head else WHOLE, first and now[1] == 0, "\n".join(held)))
                    held, head, first = [], False, False
        yield batch_of(rows)
    if held:
        yield batch_of([(*now, HEAD if head else TAIL, first and now[1] == 0, "\n".join(held))])


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """record: every record of the CSV files at `path` but their headers, as text.

    A record may hold line breaks in quoted texts, which stay as they are, and may cross any
    number of splits. Empty lines between records are left out. A file is read three times: for the states of its
    splits, for what crosses their borders, which takes only splits that start or end open,
    and for the records.
    """
    lines = _lines(spark, path)
    starts = stored(split_starts(lines), "split-starts")
    few = starts.count() <= SENT_SPLITS

    def parts(some: DataFrame) -> DataFrame:
        some = some.select("file", "split", "open")
        if few:
            placed = lines.join(F.broadcast(some), ["file", "split"])
        else:
            numbered = lines.withColumn("_row", F.monotonically_increasing_id()).join(some, ["file", "split"])
            placed = numbered.repartition("file", "split").sortWithinPartitions("file", "split", "_row")
        return placed.select("file", "split", "value", "open").mapInArrow(_put_together, PARTS)

    border = stored(parts(starts.filter("open OR ends")).filter(F.col("part") != WHOLE), "split-borders")
    # A record is named by the split that begins it. Of the splits, not of the texts, a few
    # numbers each are put in order.
    order = Window.partitionBy("file").orderBy("split", F.col("part"))
    named = border.select("file", "split", "part").withColumn(
        "begin", F.last(F.when(F.col("part") == TAIL, F.col("split")), ignorenulls=True).over(order)
    )
    joined = (
        border.join(named, ["file", "split", "part"])
        .groupBy("file", "begin")
        .agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "part", "record"))), lambda x: x["record"]), "\n").alias("record"),
            F.max("first").alias("first"),
        )
    )
    whole = parts(starts).filter(F.col("part") == WHOLE)
    every = whole.select("first", "record").unionByName(joined.select("first", "record"))
    record = F.regexp_replace("record", "\r$", "")
    return every.filter(~F.col("first")).select(record.alias("record")).filter("record != ''")


def as_columns(records: DataFrame, names: list[str]) -> DataFrame:
    """The fields of `record` as texts, under these names."""
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    row = F.from_csv("record", schema, {"escape": '"', "multiLine": "true"})
    return records.select(row.alias("_row")).select("_row.*")
