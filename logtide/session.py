"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app_name: str = "logtide", master: str | None = None, **conf) -> SparkSession:
    """A session in UTC with adaptive execution; `conf` wins over the defaults."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder all executors share; it goes when the session ends.

    `spark.checkpoint.dir` names the folder. Where it is unset the warehouse, which is
    shared as well, takes its place.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or spark.conf.get("spark.sql.warehouse.dir") + "/scratch"
    path = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    for names in _open_scopes:
        names.append(path)
    return path


_open_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession):
    """Remove all scratch paths made inside, such as those of one micro-batch."""
    made: list[str] = []
    _open_scopes.append(made)
    try:
        yield
    finally:
        _open_scopes.remove(made)
        for path in made:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stored(table, name: str = "stored"):
    """`table` written to the shared folder and read back.

    This cuts the lineage: the rows are computed once however often they are used
    and survive the loss of executors. `checkpoint()` would compute them twice and
    give up reading single columns.
    """
    spark = table.sparkSession
    path = scratch_path(spark, name)
    table.write.parquet(path)
    return spark.read.schema(table.schema).parquet(path)
