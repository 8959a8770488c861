"""Helpers of the operators: stored intermediates, whole texts and Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words: the space and the ASCII controls tab to carriage return.
SEPARATORS = " \t\n\x0b\x0c\r"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of text that one vectorised step looks at; only its arrays grow with this.
STEP_BYTES = 4_000_000


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder all executors share.

    `spark.checkpoint.dir` names that folder; where it is unset the warehouse, which
    is shared as well, takes its place. The path goes when the session ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    base = base or spark.conf.get("spark.sql.warehouse.dir") + "/scratch"
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def stored(table: DataFrame, name: str, parts: str | None = None) -> DataFrame:
    """`table` written to the shared folder and read back, in folders per value of `parts`.

    It cuts the lineage, survives lost executors and is computed once. The shuffles
    behind it are not needed any more, so Spark is told to remove their files.
    """
    spark = table.sparkSession
    path = shared_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        writer = table.write.option("compression", "zstd")
        (writer.partitionBy(parts) if parts else writer).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    result = spark.read.schema(table.schema).parquet(path)
    result.scratch = path
    return result


def discard(*tables: DataFrame, part: str = "") -> None:
    """Remove stored tables, or the folder `part` of them, that nothing will read again."""
    for table in tables:
        spark = table.sparkSession
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{table.scratch}/{part}".rstrip("/"))
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(column: str = "text") -> Column:
    """The text as it is, a null counting as empty."""
    return F.coalesce(F.col(f"`{column}`"), F.lit(""))


def words(text: Column) -> Column:
    """Maximal runs of characters that are no separator."""
    return F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def partitions_for(table: DataFrame) -> int:
    """Shuffle partitions of the session; a cluster sets them to suit its data."""
    return int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def column_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets) of a string or binary array without nulls, not copied."""
    if pa.types.is_string(array.type) or pa.types.is_binary(array.type):
        kind = np.int32
    else:
        kind = np.int64
    buffers = array.buffers()
    if buffers[1] is None or not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(buffers[1], kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def steps(offsets: np.ndarray, most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `most` bytes; a row is never cut."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def map_arrow(
    table: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    return table.mapInArrow(function, schema)


def plain_batch(columns: dict[str, pa.Array | np.ndarray]) -> pa.RecordBatch:
    arrays = {k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()}
    return pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))
