"""Majority vote over the three detectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOTERS = ("isolation_forest_label", "dbscan_label", "autoencoder_label")


def ensemble_vote(table: DataFrame, needed: int = 2) -> DataFrame:
    votes = sum((F.col(name) for name in VOTERS), F.lit(0))
    return table.withColumn("ensemble_anomaly", (votes >= needed).cast("int"))


def attach_labels(
    features: DataFrame, *labels: DataFrame, key: str = "window_start"
) -> DataFrame:
    """Append label tables to the features by key, not by position."""
    out = features
    for table in labels:
        out = out.join(table, key, "left")
    return out
