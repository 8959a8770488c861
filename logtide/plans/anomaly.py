"""Window features to labelled and stored results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from logtide.functions.quantiles import exact_quantile
from logtide.operators.autoencoder import train_autoencoder
from logtide.operators.density import core_points
from logtide.operators.ensemble import ensemble_vote
from logtide.operators.iforest import fit_isolation_forest
from logtide.operators.registry import DensityNoise, ModelRegistry
from logtide.operators.results import result_columns, split_date_time
from logtide.sinks.tables import append_results


class AnomalyPlan:
    """Fits the three detectors on features and labels windows by majority vote."""

    def __init__(
        self,
        contamination: float = 0.1,
        eps: float = 0.5,
        min_samples: int = 5,
        epochs: int = 20,
        percentile: float = 90,
        seed: int = 0,
        keys: Sequence[str] = ("window_start",),
    ):
        self.contamination = contamination
        self.eps = eps
        self.min_samples = min_samples
        self.epochs = epochs
        self.percentile = percentile
        self.seed = seed
        self.keys = tuple(keys)
        self.registry = ModelRegistry()

    def fit(self, features: DataFrame) -> AnomalyPlan:
        """Train on `features`, which is read several times: store or cache it before."""
        self.registry.add(
            "isolation_forest",
            fit_isolation_forest(
                features, self.keys, contamination=self.contamination, seed=self.seed
            ),
        )
        self.registry.add("dbscan", DensityNoise(self.eps, self.min_samples))
        self.registry.add(
            "autoencoder", train_autoencoder(features, epochs=self.epochs, seed=self.seed)
        )
        return self

    def keep_for_streams(self, features: DataFrame) -> AnomalyPlan:
        """Also fix the error threshold and core points, as streams cannot re-fit."""
        encoder, noise = self.registry.get("autoencoder"), self.registry.get("dbscan")
        errors = features.select(encoder.error().alias("error"))
        encoder.threshold = exact_quantile(errors, "error", self.percentile / 100)
        noise.cores = core_points(features, self.eps, self.min_samples)
        return self

    def label(self, features: DataFrame) -> DataFrame:
        """Features with the three labels and the vote; density is re-fitted on them."""
        forest = self.registry.get("isolation_forest")
        encoder = self.registry.get("autoencoder")
        noise = DensityNoise(self.eps, self.min_samples)
        # Noise, which joins, comes last: the others look for thresholds below it.
        labelled = noise.label(encoder.label(forest.label(features), self.percentile))
        return ensemble_vote(labelled)


def shape_results(labelled: DataFrame) -> DataFrame:
    """Labelled windows as the 15 stored columns."""
    return result_columns(split_date_time(labelled))


def store_results(labelled: DataFrame, table: str = "anomaly_results") -> int:
    """Shape and append to the result table; returns the number of rows."""
    return append_results(shape_results(labelled), table)
