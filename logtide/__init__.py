"""Security-log analytics as Spark DataFrame, SQL and Structured Streaming jobs."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job, so that executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from logtide.plans.anomaly import AnomalyPlan  # noqa: E402
from logtide.plans.log_features import LogFeaturePlan, features_from_files  # noqa: E402
from logtide.session import build_session  # noqa: E402

__all__ = ["AnomalyPlan", "LogFeaturePlan", "build_session", "features_from_files"]
