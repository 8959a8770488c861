"""Line numbers without a global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def number_lines(
    lines: DataFrame,
    chunk: Column,
    position: str | Column,
    group: str = "source_file",
) -> DataFrame:
    """Add `line_number`, 1-based per `group`, in the order (`chunk`, `position`).

    `chunk` cuts a group into ordered pieces of bounded size: the byte offset of
    a file split, or a key divided by a constant. One file may hold any share of
    the rows, since rows are shuffled once by (group, chunk) and only the chunk
    sizes, one row per chunk, are summed up per group.
    """
    pos = F.col(position) if isinstance(position, str) else position
    # Keys without NULL join by plain equality, which keeps the windows' partitioning:
    # lines are shuffled once, chunk sizes are counted before that.
    named = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    placed = lines.withColumns({"_group": named, "_chunk": F.coalesce(chunk.cast("bigint"), F.lit(-1))})
    before = Window.partitionBy("_group").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_group", "_chunk")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_group", "_chunk", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_group", "_chunk").orderBy(pos)
    numbered = placed.withColumn("_rank", F.row_number().over(inside))
    return (
        numbered.join(offsets, ["_group", "_chunk"])
        .withColumn("line_number", F.col("_before") + F.col("_rank"))
        .select(*lines.columns, "line_number")
    )
