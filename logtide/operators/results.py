"""Shaping and summarizing the table of labelled windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtide.functions import patterns as P
from logtide.functions.fields import time_of_day


def split_date_time(results: DataFrame) -> DataFrame:
    """`date`, `start_time`, `end_time` in place of the window bounds."""
    return (
        results.withColumn("date", F.to_date("window_start"))
        .withColumn("start_time", time_of_day(F.col("window_start")))
        .withColumn("end_time", time_of_day(F.col("window_end")))
        .drop("window_start", "window_end")
    )


def result_columns(results: DataFrame) -> DataFrame:
    """The 15 stored columns in order; a missing one raises."""
    return results.select(*P.RESULT_COLUMNS)


def numeric_columns(table: DataFrame) -> DataFrame:
    """Only the columns of a numeric type."""
    return table.select(
        *[f.name for f in table.schema.fields if isinstance(f.dataType, T.NumericType)]
    )


def head(table: DataFrame, n: int, order_by: str | Sequence[str | Column]) -> DataFrame:
    """The first `n` rows by `order_by`; a bounded top-n per task, no full sort."""
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    return table.orderBy(*keys).limit(n)


def with_label(table: DataFrame, label: str = "ensemble_anomaly", value: int = 1) -> DataFrame:
    return table.filter(F.col(label) == value)


def count_rows(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("count"))


def count_where(table: DataFrame, condition: Column) -> DataFrame:
    return table.agg(F.count_if(condition).alias("count"))


def label_summary(table: DataFrame, label: str = "ensemble_anomaly") -> DataFrame:
    """Total rows and labelled rows."""
    return table.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.coalesce(F.sum(label), F.lit(0)).alias("total_anomalies"),
    )


def value_counts(table: DataFrame, column: str) -> DataFrame:
    """Frequency of each value, most frequent first. NULLs are left out."""
    counts = table.groupBy(column).agg(F.count(column).alias("count"))
    return counts.filter(F.col("count") > 0).orderBy(F.desc("count"), column)
