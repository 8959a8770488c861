"""Labelled windows by fixed rules, in Spark and as SQL common tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.derived import LINES_SQL, PARSED_SQL, YEAR, features_sql, log_lines
from catalog.fixed_models import autoencoder_sql, fixed_autoencoder, fixed_forest, forest_sql
from logtide.functions import patterns as P
from logtide.functions.quantiles import exact_quantile
from logtide.operators.density import label_noise
from logtide.operators.ensemble import ensemble_vote
from logtide.operators.parse import harmonize, parse_lines
from logtide.operators.windows import EVENT_COLUMNS, window_features
from logtide.session import stored


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_lines(log_lines(spark, sf_dir), default_year=YEAR, keep=["event_id"])


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harmonize(parsed(spark, sf_dir))


def rounded(features: DataFrame) -> DataFrame:
    """Six digits, since engines add up doubles in different orders."""
    return features.withColumns(
        {n: F.round(n, 6) for n in ("avg_msg_length", "entropy_tokens") if n in features.columns}
    )


def stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events parsed once, however often they are used."""
    return stored(events(spark, sf_dir), "events")


def features(spark: SparkSession, sf_dir: str, columns=None, known: DataFrame | None = None) -> DataFrame:
    if known is None:
        known = stored(events(spark, sf_dir).select(*EVENT_COLUMNS), "events")
    return rounded(window_features(known, columns=columns))


def stored_features(spark: SparkSession, sf_dir: str, known: DataFrame | None = None) -> DataFrame:
    """Features written once, for detectors that read them several times."""
    return stored(features(spark, sf_dir, known=known), "features")


def forest_with_threshold(table: DataFrame):
    forest = fixed_forest()
    scores = table.select(forest.score().alias("score"))
    forest.threshold = exact_quantile(scores, "score", 0.1)
    return forest


def labelled(spark: SparkSession, sf_dir: str, known: DataFrame | None = None) -> DataFrame:
    table = stored_features(spark, sf_dir, known)
    forest = forest_with_threshold(table)
    voted = label_noise(fixed_autoencoder().label(forest.label(table)))
    return ensemble_vote(voted).select(*P.FEATURE_COLUMNS, *P.LABEL_COLUMNS)


PARSED_CTE = f"WITH {LINES_SQL}, {PARSED_SQL}"
FEATURES_CTE = f"{PARSED_CTE}, {features_sql()}"

_WHOLE = [n for n in P.NUMERIC_FEATURES if n not in ("avg_msg_length", "entropy_tokens")]
_SAME = " AND ".join(f"a.{n} = b.{n}" for n in _WHOLE)
_NEAR = (
    "sqrt(pow(a.avg_msg_length - b.avg_msg_length, 2) + "
    "pow(a.entropy_tokens - b.entropy_tokens, 2)) <= 0.5"
)
_DIMS = ", ".join(P.NUMERIC_FEATURES)
_A_DIMS = ", ".join(f"a.{n}" for n in P.NUMERIC_FEATURES)

NOISE_SQL = f"""
vectors AS (SELECT {_DIMS}, count(*) AS w, floor(avg_msg_length / 0.5) AS cx,
                   floor(entropy_tokens / 0.5) AS cy FROM features GROUP BY {_DIMS}),
around AS (SELECT v.*, cx + dx AS nx, cy + dy AS ny
           FROM vectors v, (SELECT unnest([-1, 0, 1]) AS dx), (SELECT unnest([-1, 0, 1]) AS dy)),
cores AS (SELECT {_A_DIMS}, any_value(a.cx) AS cx, any_value(a.cy) AS cy
          FROM around a JOIN vectors b ON {_SAME} AND a.nx = b.cx AND a.ny = b.cy
          WHERE {_NEAR} GROUP BY {_A_DIMS} HAVING sum(b.w) >= 5),
reached AS (SELECT DISTINCT {_A_DIMS}
            FROM around a JOIN cores b ON {_SAME} AND a.nx = b.cx AND a.ny = b.cy WHERE {_NEAR}),
noise AS (SELECT f.*, CASE WHEN r.event_count IS NULL THEN 1 ELSE 0 END AS dbscan_label
          FROM features f LEFT JOIN reached r USING ({_DIMS}))
"""

LABELLED_SQL = f"""
{NOISE_SQL},
scored AS (SELECT *, {forest_sql()} AS normality FROM noise),
{autoencoder_sql("scored")},
cuts AS (SELECT quantile_cont(normality, 0.1) AS low, quantile_cont(err, 0.9) AS high FROM errors),
voters AS (
  SELECT window_start, window_end, {_DIMS}, normality, err,
         CASE WHEN normality < low THEN 1 ELSE 0 END AS isolation_forest_label,
         dbscan_label, CASE WHEN err > high THEN 1 ELSE 0 END AS autoencoder_label
  FROM errors, cuts),
labelled AS (
  SELECT *, CASE WHEN isolation_forest_label + dbscan_label + autoencoder_label >= 2
                 THEN 1 ELSE 0 END AS ensemble_anomaly FROM voters)
"""
LABELLED_CTE = f"{FEATURES_CTE}, {LABELLED_SQL}"
