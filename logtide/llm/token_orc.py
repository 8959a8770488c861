"""Token ids in ORC files, in ascending order of document ids.

Each file holds one range of ids, so its stripes and row groups have narrow bounds. The
`ids` column is an array of integers, which ORC writes with run lengths and bit packing;
row indexes and Bloom filters on `doc_id` let readers skip stripes and row groups. Files
split by stripes, so readers work in parallel.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logtide.llm.bpe import vocabulary
from logtide.llm.quick_tokens import encoder
from logtide.llm.shared import column_bytes, partitions_for, plain_batch, steps, whole_text

SCHEMA = "doc_id long, part int, start_in_part long, n_tokens long, ids array<int>"


def write_tokens(
    docs: DataFrame, vocabulary_path: str, out: str, end_id: int = 2, parts: int | None = None
) -> None:
    """Encode every whole text, append `end_id` and write ORC files in order of `doc_id`.

    A null text is empty and has the end id only. Rows with a null id come first, rows
    that repeat an id follow each other, each a row of its own. No documents give no
    rows. Other columns of `docs` do not matter.
    """
    name = vocabulary(docs, vocabulary_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, tail = encoder(SparkFiles.get(name)), np.array([end_id], "<u4").tobytes()
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            _, offsets = column_bytes(batch.column(1))
            for first, last in steps(offsets):
                ids = [encode(x) + tail for x in batch.column(1).slice(first, last - first).to_pylist()]
                sizes = np.array([len(x) // 4 for x in ids], np.int64)
                ends = np.cumsum(sizes)
                values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                bounds = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                yield plain_batch(
                    {
                        "doc_id": batch.column(0).slice(first, last - first),
                        "part": np.full(last - first, part, np.int32),
                        "start_in_part": before + ends - sizes,
                        "n_tokens": sizes,
                        "ids": pa.ListArray.from_arrays(bounds, values),
                    }
                )
                before += int(ends[-1])

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        whole_text().alias("text"),
        F.monotonically_increasing_id().alias("row"),  # so that a repeated id can be split
    )
    ordered = rows.repartitionByRange(parts or 2 * partitions_for(docs), "doc_id", "row")
    ordered = ordered.sortWithinPartitions("doc_id", "row").select("doc_id", "text")
    writer = ordered.mapInArrow(run, SCHEMA).write.format("orc")
    writer = writer.option("orc.create.index", "true").option("orc.row.index.stride", "2000")
    writer = writer.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
    writer.option("compression", "snappy").save(out)


def read_tokens(spark: SparkSession, path: str, doc_ids: Sequence[int] | None = None) -> DataFrame:
    """The written rows. With `doc_ids`, stripes and row groups without them are skipped."""
    rows = spark.read.schema(SCHEMA).orc(path)
    return rows if doc_ids is None else rows.filter(F.col("doc_id").isin(list(doc_ids)))


def token_starts(tokens: DataFrame) -> DataFrame:
    """`tokens` with `start`: the number of ids of all documents before.

    Only a row per file is summed in order; the rows keep their places in the files.
    """
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("_total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    # A row per file: small whatever the tables are.
    placed = tokens.join(F.broadcast(bases), "part")
    return placed.withColumn("start", F.col("_base") + F.col("start_in_part")).drop("_base")


def checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids read from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            bounds = (ids.offsets.to_numpy()).astype(np.int64)
            raw = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<u4")
            sums = [zlib.crc32(raw[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=False)]
            yield plain_batch(
                {
                    "doc_id": batch.column(0),
                    "start": batch.column(1),
                    "n_tokens": batch.column(2),
                    "ids_crc32": np.array(sums, np.int64),
                }
            )

    rows = token_starts(tokens).select("doc_id", "start", "n_tokens", "ids")
    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
