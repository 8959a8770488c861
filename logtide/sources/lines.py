"""Log lines from files and folders, in batch and as a stream."""

from __future__ import annotations

import re
import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from logtide.functions import fields as X
from logtide.operators.numbering import number_lines

LINE_SCHEMA = "source_file string, line string"


def _clean(raw: DataFrame, value: Column, extra: Sequence[Column] = ()) -> DataFrame:
    """Decoded, stripped lines."""
    return raw.select(*extra, X.strip(X.clean_utf8(value)).alias("line"))


def read_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    numbered: bool = False,
    on_missing: str = "error",
    skip_unreadable: bool = False,
) -> DataFrame:
    """Non-blank lines of a file, of the files directly in a folder, or of many of both.

    Several paths give the union of their lines. Subfolders are left alone, whatever
    their names. A missing path raises, or is warned about and left out with
    `on_missing="warn"`. Names that start with `_` or `.` are left out with a warning.
    `skip_unreadable` goes on without files that cannot be read, with a warning that names
    `unreadable_files`. `numbered=True` adds `line_number` per file, in the order of
    arrival within it, at the price of a shuffle.

    Spark lists the folders itself; of the files it finds only those wanted are read.
    """
    wanted = [paths] if isinstance(paths, str) else list(paths)
    found = [place for path in wanted if (place := _place(spark, path, on_missing)) is not None]
    if not found:
        schema = LINE_SCHEMA + (", line_number bigint" if numbered else "")
        return spark.createDataFrame([], schema)
    if skip_unreadable:
        warnings.warn("unreadable files are left out; unreadable_files lists them", RuntimeWarning, stacklevel=2)
    raw = _listed(spark.read.option("ignoreCorruptFiles", skip_unreadable), "text", found)
    extra = [F.col("_metadata.file_path").alias("source_file")]
    if numbered:
        extra.append(F.col("_metadata.file_block_start").alias("_block"))
    lines = _clean(raw, F.col("value"), extra).filter(F.col("line") != "")
    if not numbered:
        return lines
    # Within one split the id only grows, so it orders the lines of a split.
    placed = lines.withColumn("_row", F.monotonically_increasing_id())
    return number_lines(placed, F.col("_block"), "_row").select(
        "source_file", "line", "line_number"
    )


def unreadable_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """source_file of files that hold bytes but of which no line can be read."""
    wanted = [paths] if isinstance(paths, str) else list(paths)
    found = [_place(spark, path, "error") for path in wanted]
    name = F.col("_metadata.file_path").alias("source_file")
    listed = _listed(spark.read, "binaryFile", found).filter("length > 0").select(name)
    read = _listed(spark.read.option("ignoreCorruptFiles", True), "text", found)
    return listed.join(read.select(name).distinct(), "source_file", "left_anti")


def _listed(reader: DataFrameReader, kind: str, found: Sequence[tuple[str, str, bool]]) -> DataFrame:
    """What `reader` reads of the files and, of folders, of the files directly in them."""
    files = [name for _, name, is_folder in found if not is_folder]
    folders = [name for _, name, is_folder in found if is_folder]
    # The path is known before a file is opened, so Spark drops the others unread.
    file = _plain(F.col("_metadata.file_path"))
    own = file.isin([_plain_text(x) for x in files]) if files else F.lit(False)
    if folders:
        own = own | F.regexp_replace(file, "/[^/]*$", "").isin([_plain_text(x).rstrip("/") for x in folders])
    # Without this option Spark would take `name=value` subfolders for partitions and
    # leave out the files beside them.
    reader = reader.option("recursiveFileLookup", True).format(kind)
    return reader.load([path for path, _, _ in found]).filter(own)


def _plain(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "file:/")


def _plain_text(path: str) -> str:
    return re.sub("^file:/+", "file:/", path)


def _folder(spark: SparkSession, path: str):
    """The path as Hadoop sees it, with its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(place), system


def _place(spark: SparkSession, path: str, on_missing: str) -> tuple[str, str, bool] | None:
    """The path to read, as it is named in rows, and whether it is a folder; None if missing is fine."""
    place, system = _folder(spark, path)
    if not system.exists(place):
        if on_missing == "error":
            raise FileNotFoundError(f"no log file or folder at {path}")
        warnings.warn(f"no log file or folder at {path}", RuntimeWarning, stacklevel=3)
        return None
    is_folder = system.getFileStatus(place).isDirectory()
    if is_folder:
        # Only hidden names come to the driver. Spark's own writers leave markers; others
        # are worth a word.
        hidden = spark._jvm.org.apache.hadoop.fs.Path(place, "[_.]*")
        names = [x.getPath().getName() for x in system.globStatus(hidden) or [] if x.isFile()]
        strange = [x for x in names if not _is_marker(x)]
        if strange:
            warnings.warn(f"{len(strange)} hidden files left out in {path}", RuntimeWarning, stacklevel=3)
    return place.toString(), place.toUri().toString(), is_folder


def _is_marker(name: str) -> bool:
    return name.startswith(("_SUCCESS", "_committed", "_started")) or name.endswith(".crc")


def lines_per_file(lines: DataFrame) -> DataFrame:
    return lines.groupBy("source_file").agg(F.count(F.lit(1)).alias("line_count"))


ARRIVAL = ("source_file", "line_number")


def replay(lines: DataFrame, max_logs: int, order_by: str | Column | Sequence[str] = ARRIVAL) -> DataFrame:
    """The first `max_logs` records of a batch in order of arrival, as the bounded receiver takes them.

    That is the order of the files by name and of the lines within a file, so `lines` must be
    numbered (`read_lines(numbered=True)`), unless another order is given.
    """
    order = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    lacking = [c for c in order if isinstance(c, str) and c not in lines.columns]
    if lacking:
        raise ValueError(f"lines have no {', '.join(lacking)} to tell their order of arrival")
    return lines.orderBy(*order).limit(max_logs)


def stream_lines(spark: SparkSession, path: str, **options) -> DataFrame:
    """New files directly in a folder as a stream of records. Blank records stay."""
    place, _ = _folder(spark, path)
    # See `_listed`; files further down are pruned by their path.
    raw = spark.readStream.options(recursiveFileLookup=True, **options).text(path)
    file = F.col("_metadata.file_path")
    own = raw.filter(F.regexp_replace(_plain(file), "/[^/]*$", "") == _plain_text(place.toUri().toString()).rstrip("/"))
    return _clean(own, F.col("value"), [file.alias("source_file")])


def stream_topic(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Records of a Kafka topic; needs the Kafka package on the class path."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
        .load()
    )
    return _clean(raw, F.col("value").cast("string"), [F.col("topic").alias("source_file")])
