"""CSV and table sources."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtide.functions import patterns as P
from logtide.sources.records import as_columns, csv_records

FEATURE_SCHEMA = (
    "window_start timestamp, window_end timestamp, event_count bigint, unique_messages bigint, "
    "distinct_hosts bigint, distinct_processes bigint, avg_msg_length double, "
    "failed_auth_count bigint, invalid_user_count bigint, entropy_tokens double"
)
LABEL_SCHEMA = ", ".join(f"{name} int" for name in P.LABEL_COLUMNS)


def read_texts(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A CSV with a header as texts, missing ones as NULL; quoted line breaks are kept.

    `columns` selects by name and keeps the file's order. Large files are read by many
    tasks, although records may span lines and splits.
    """
    # Only the first record of one file is read for the names.
    names = spark.read.csv(path, header=True, escape='"', multiLine=True).columns
    unknown = [name for name in columns or () if name not in names]
    if unknown:
        raise ValueError(f"no such columns in {path}: {', '.join(unknown)}")
    wanted = [name for name in names if not columns or name in set(columns)]
    table = as_columns(csv_records(spark, path), names)
    return table.select(*[missing_as_null(F.col(f"`{name}`")).alias(name) for name in wanted])


def read_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    schema: str | None = None,
) -> DataFrame:
    """A CSV with a header, typed. `columns` selects by name and keeps the file's order.

    Types come from the texts, which reads the file twice, or from a `schema`, whose
    names are looked up in the header; a text that does not fit its type raises.
    """
    if schema is None:
        texts = read_texts(spark, path, columns)
        return typed(texts, infer_columns(texts))
    fields = [f for f in T._parse_datatype_string(schema).fields if not columns or f.name in set(columns)]
    texts = read_texts(spark, path, [f.name for f in fields])
    return texts.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields])


def read_feature_csv(spark: SparkSession, path: str, labelled: bool = False) -> DataFrame:
    """Stored features (with labels, if `labelled`) by column name; a malformed value raises."""
    return read_csv(spark, path, schema=f"{FEATURE_SCHEMA}, {LABEL_SCHEMA}" if labelled else FEATURE_SCHEMA)


_MARKS = re.compile(r"""('(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*"|`[^`]*`)|%s|%%""", re.S)


def with_marks(statement: str, params: Sequence | None) -> str:
    """`%s` marks outside quotes as Spark's; `%%` is a percent sign. Without `params` nothing changes."""
    if not params:
        return statement

    def mark(found: re.Match) -> str:
        if found.group(1) is not None:
            return found.group(1).replace("%%", "%")
        return "?" if found.group(0) == "%s" else "%"

    return _MARKS.sub(mark, statement)


def run_query(spark: SparkSession, query: str, params: Sequence | None = None) -> DataFrame:
    """Rows of a SELECT over registered tables; `%s` marks take `params` in order."""
    return spark.sql(with_marks(query, params), args=list(params or []))


def read_remote_query(
    spark: SparkSession, url: str, query: str, user: str, password: str, **options
) -> DataFrame:
    """Rows of a query run by a remote database over JDBC; its driver must be present."""
    settings = {"url": url, "query": query, "user": user, "password": password, **options}
    return spark.read.format("jdbc").options(**settings).load()


def infer_columns(texts: DataFrame) -> list[tuple[str, str]]:
    """(column, database type) of string columns, from one aggregation over all of them.

    Whole numbers without gaps become INTEGER, or BIGINT past 32 bits, other numbers
    DOUBLE PRECISION. The rest takes the longest text, a gap counting as `nan`: VARCHAR with ten spare
    characters below 255, TEXT from there on. Truth values are such texts, too.
    """
    checks = []
    for i, name in enumerate(texts.columns):
        value = missing_as_null(F.col(f"`{name}`"))
        checks += [
            F.count(value).alias(f"known{i}"),
            F.count_if(value.isNull()).alias(f"gaps{i}"),
            F.count(value.try_cast("bigint")).alias(f"whole{i}"),
            F.count(value.try_cast("int")).alias(f"short{i}"),
            F.count_if(value.rlike(r"^\s*[+-]?\d+\s*$")).alias(f"digits{i}"),
            F.count(value.try_cast("double")).alias(f"numbers{i}"),
            F.max(F.coalesce(F.length(value), F.lit(3))).alias(f"longest{i}"),
        ]
    found = texts.agg(*checks).first() if checks else None
    types = []
    for i, name in enumerate(texts.columns):
        known, gaps = found[f"known{i}"], found[f"gaps{i}"]
        if known and not gaps and found[f"whole{i}"] == known == found[f"digits{i}"]:
            types.append((name, "INTEGER" if found[f"short{i}"] == known else "BIGINT"))
        elif found[f"numbers{i}"] == known:
            types.append((name, "DOUBLE PRECISION"))
        elif found[f"longest{i}"] < 255:
            types.append((name, f"VARCHAR({found[f'longest{i}'] + 10})"))
        else:
            types.append((name, "TEXT"))
    return types


def typed(texts: DataFrame, types: Sequence[tuple[str, str]]) -> DataFrame:
    """Text columns as Spark's types for the database types given."""
    return texts.select(*[F.col(f"`{name}`").cast(spark_type(kind)).alias(name) for name, kind in types])


def spark_type(kind: str) -> str:
    return {"INTEGER": "INT", "BIGINT": "BIGINT", "DOUBLE PRECISION": "DOUBLE"}.get(kind, "STRING")


def missing_as_null(value):
    return F.when(~value.isin(P.MISSING_TEXTS), value)
