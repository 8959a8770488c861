"""Labels for a stream of window features, from stored models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from logtide.operators.ensemble import ensemble_vote
from logtide.operators.registry import ModelRegistry
from logtide.session import scratch_scope


def label_with_stored(features: DataFrame, registry: ModelRegistry) -> DataFrame:
    """All four labels, by stored trees, core points, weights and thresholds."""
    forest, noise, encoder = (
        registry.get(name) for name in ("isolation_forest", "dbscan", "autoencoder")
    )
    if encoder.threshold is None or noise.cores is None:
        raise ValueError("scoring a stream needs a stored error threshold and core points")
    labelled = encoder.label(forest.label(features), threshold=encoder.threshold)
    return ensemble_vote(noise.label(labelled))


def write_labels(
    features: DataFrame, registry: ModelRegistry, path: str, checkpoint: str
) -> DataStreamWriter:
    """A writer putting each labelled micro-batch into its own folder of `path`.

    A batch that is run again after a failure replaces its folder, so every window
    is stored once.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            label_with_stored(batch, registry).write.mode("overwrite").parquet(
                f"{path}/batch_id={batch_id}"
            )

    return (
        features.writeStream.outputMode("append")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
    )
