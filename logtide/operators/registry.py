"""Fitted detectors by name, in memory or as Parquet in a shared folder."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from logtide.operators.autoencoder import Autoencoder, layer_sizes
from logtide.operators.density import label_against_cores, label_noise
from logtide.operators.iforest import IsolationForest

NAMES = ("isolation_forest", "dbscan", "autoencoder")


@dataclass
class DensityNoise:
    """Re-fits on the data it labels, or compares with stored core points."""

    eps: float = 0.5
    min_samples: int = 5
    cores: DataFrame | None = None

    def label(self, table: DataFrame) -> DataFrame:
        if self.cores is None:
            return label_noise(table, self.eps, self.min_samples)
        return label_against_cores(table, self.cores, self.eps)


@dataclass
class ModelRegistry:
    models: dict = field(default_factory=dict)

    def add(self, name: str, model) -> None:
        if name not in NAMES:
            raise KeyError(f"unknown model {name}; known are {', '.join(NAMES)}")
        self.models[name] = model

    def get(self, name: str):
        """The model, or None where there is none."""
        return self.models.get(name)

    def predict(self, table: DataFrame, name: str) -> DataFrame:
        """`table` with the label column of the named model."""
        if name not in self.models:
            raise KeyError(f"no model {name}")
        return self.models[name].label(table)

    def save(self, spark: SparkSession, path: str) -> None:
        for name, model in self.models.items():
            _WRITERS[name](spark, model, f"{path}/{name}")


def _save_forest(spark: SparkSession, forest: IsolationForest, path: str) -> None:
    spark.createDataFrame(forest.nodes).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    setting = [(forest.columns, forest.sample_size, float(forest.threshold))]
    spark.createDataFrame(
        setting, "columns array<string>, sample_size int, threshold double"
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/setting")


def _load_forest(spark: SparkSession, path: str) -> IsolationForest:
    setting = spark.read.parquet(f"{path}/setting").first()
    nodes = spark.read.parquet(f"{path}/nodes").toPandas()
    return IsolationForest(nodes, list(setting.columns), setting.sample_size, setting.threshold)


def _save_autoencoder(spark: SparkSession, model: Autoencoder, path: str) -> None:
    row = [(model.columns, model.parameters().tolist(), [float(x) for x in model.losses], model.threshold)]
    spark.createDataFrame(
        row,
        "columns array<string>, parameters array<double>, losses array<double>, threshold double",
    ).coalesce(1).write.mode("overwrite").parquet(path)


def _load_autoencoder(spark: SparkSession, path: str) -> Autoencoder:
    row = spark.read.parquet(path).first()
    sizes = layer_sizes(len(row.columns))
    shapes = list(zip(sizes[1:], sizes, strict=False))
    blank = Autoencoder(
        list(row.columns),
        [np.zeros(shape) for shape in shapes],
        [np.zeros(shape[0]) for shape in shapes],
        list(row.losses),
        row.threshold,
    )
    return blank.replaced(np.array(row.parameters))


def _save_density(spark: SparkSession, model: DensityNoise, path: str) -> None:
    setting = spark.createDataFrame(
        [(model.eps, model.min_samples, model.cores is not None)],
        "eps double, min_samples int, has_cores boolean",
    )
    setting.coalesce(1).write.mode("overwrite").parquet(f"{path}/setting")
    if model.cores is not None:
        model.cores.write.mode("overwrite").parquet(f"{path}/cores")


def _load_density(spark: SparkSession, path: str) -> DensityNoise:
    setting = spark.read.parquet(f"{path}/setting").first()
    cores = spark.read.parquet(f"{path}/cores") if setting.has_cores else None
    return DensityNoise(setting.eps, setting.min_samples, cores)


_WRITERS = {
    "isolation_forest": _save_forest,
    "autoencoder": _save_autoencoder,
    "dbscan": _save_density,
}
_READERS = {
    "isolation_forest": _load_forest,
    "autoencoder": _load_autoencoder,
    "dbscan": _load_density,
}


def load_model(spark: SparkSession, path: str, name: str):
    """One saved model."""
    if name not in _READERS:
        raise KeyError(f"unknown model {name}; known are {', '.join(NAMES)}")
    return _READERS[name](spark, f"{path}/{name}")


def load_registry(spark: SparkSession, path: str, names=NAMES) -> ModelRegistry:
    return ModelRegistry({name: load_model(spark, path, name) for name in names})


