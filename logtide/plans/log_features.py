"""Log lines to window features."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from logtide.operators.parse import harmonize, parse_lines
from logtide.operators.windows import EVENT_COLUMNS, window_features
from logtide.session import stored
from logtide.sources.lines import read_lines


class LogFeaturePlan:
    """Collects sources, then parses and windows all of their lines together.

        plan = LogFeaturePlan(spark, window_seconds=60)
        features = plan.from_folder("/logs").run()
    """

    def __init__(
        self,
        spark: SparkSession,
        window_seconds: float = 60,
        default_year: int | None = None,
        compat: bool = True,
        origin: datetime | None = None,
        on_missing: str = "error",
    ):
        self.spark = spark
        self.window_seconds = window_seconds
        self.default_year = default_year
        self.compat = compat
        self.origin = origin
        self.on_missing = on_missing
        self._paths: list[str] = []
        self._lines: list[DataFrame] = []
        self._events: DataFrame | None = None
        self._feature_events: DataFrame | None = None

    def from_file(self, path: str) -> LogFeaturePlan:
        self._paths.append(path)
        return self

    from_folder = from_file

    def from_lines(self, lines: DataFrame) -> LogFeaturePlan:
        """A table of `source_file`, `line` from elsewhere, such as a message queue."""
        self._lines.append(lines.select("source_file", "line"))
        return self

    def lines(self, numbered: bool = False) -> DataFrame:
        tables = list(self._lines)
        if self._paths or not tables:
            tables.append(read_lines(self.spark, self._paths, numbered, self.on_missing))
        union = tables[0]
        for table in tables[1:]:
            union = union.unionByName(table, allowMissingColumns=True)
        return union

    def parse(self, numbered: bool = False) -> DataFrame:
        """Normalized events. Numbering lines costs a shuffle, so it is off by default."""
        return harmonize(parse_lines(self.lines(numbered), self.default_year, self.compat))

    def store_events(self, path: str) -> LogFeaturePlan:
        """Write the parsed events as Parquet and go on from there.

        Lines are then parsed once: the earliest time is read from one column, and
        every later use reads only the columns it needs.
        """
        self.parse().write.mode("overwrite").parquet(path)
        self._events = self.spark.read.parquet(path)
        return self

    def run(self) -> DataFrame:
        """Features. Lines are parsed once: without a known origin the columns that features
        need are stored first, as the earliest time has to be found before the first window.
        """
        events = self._events if self._events is not None else self.parse()
        if self._events is None and self.origin is None:
            if self._feature_events is None:
                self._feature_events = stored(events.select(*EVENT_COLUMNS), "events")
            events = self._feature_events
        return window_features(events, self.window_seconds, self.origin)


def features_from_files(
    spark: SparkSession, paths: Sequence[str], window_seconds: float = 60, **settings
) -> DataFrame:
    """Features over the union of several files."""
    plan = LogFeaturePlan(spark, window_seconds, **settings)
    for path in paths:
        plan.from_file(path)
    return plan.run()
