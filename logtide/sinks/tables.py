"""Table sinks: Spark tables, JDBC targets and keyed tables."""

from __future__ import annotations

import re
import uuid
import warnings
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from logtide.functions import patterns as P
from logtide.sources.tables import infer_columns, read_csv, read_texts, spark_type, typed, with_marks

# The columns of the three result tables.
RESULT_DDL = (
    "date DATE, start_time STRING, end_time STRING, event_count INT, unique_messages INT, "
    "distinct_hosts INT, distinct_processes INT, avg_msg_length DOUBLE, failed_auth_count INT, "
    "invalid_user_count INT, entropy_tokens DOUBLE, isolation_forest_label INT, "
    "dbscan_label INT, autoencoder_label INT, ensemble_anomaly INT"
)
ANOMALY_DDL = (
    "id STRING, timestamp TIMESTAMP, source STRING, event_count INT, avg_message_length FLOAT, "
    "entropy FLOAT, isolation_forest_label INT, one_class_svm_label INT, dbscan_label INT, "
    "ensemble_anomaly INT"
)
SCORED_DDL = (
    "id STRING, event_count INT, unique_messages INT, distinct_hosts INT, "
    "distinct_processes INT, avg_msg_length DOUBLE, failed_auth_count INT, "
    "invalid_user_count INT, entropy_tokens DOUBLE, isolation_forest_label INT, "
    "isolation_forest_score DOUBLE, one_class_svm_label INT, one_class_svm_score DOUBLE, "
    "dbscan_label INT, dbscan_score DOUBLE, ensemble_anomaly INT"
)


# --- namespaces and plain tables ---------------------------------------------


def use_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the database if it is absent and make it the current one."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")
    spark.sql(f"USE {name}")


def create_table(
    spark: SparkSession, table: str, ddl: str, partition_by: Sequence[str] = ()
) -> None:
    """Create a Parquet table if it is absent."""
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet{parts}")


def append(rows: DataFrame, table: str) -> int:
    """Append by column name and return the number of rows, counted while writing.

    Columns the table has and `rows` lacks become NULL; unknown ones raise.
    """
    spark = rows.sparkSession
    target = spark.table(table).schema
    unknown = [c for c in rows.columns if c not in target.names]
    if unknown:
        raise ValueError(f"{table} has no columns {', '.join(unknown)}")
    shaped = rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
    )
    count = Observation()
    shaped.observe(count, F.count(F.lit(1)).alias("rows")).write.insertInto(table)
    return count.get["rows"]


def append_results(results: DataFrame, table: str = "anomaly_results") -> int:
    """Append shaped results to their table, created if absent.

    Spark tables have no serial column; a remote database assigns its own key.
    """
    create_table(results.sparkSession, table, RESULT_DDL)
    return append(results.select(*P.RESULT_COLUMNS), table)


_NAME = r"((?:`[^`]+`|\w+)(?:\.(?:`[^`]+`|\w+))*)"
_INSERT = re.compile(
    rf"INSERT\s+INTO\s+(?:TABLE\s+)?{_NAME}\s*(?:\(([^()]*)\)\s*)?((?:SELECT|VALUES|WITH|FROM|TABLE)\b.*)",
    re.I | re.S,
)


_UPDATE = re.compile(rf"UPDATE\s+{_NAME}\s+SET\b(.*?)(?:\bWHERE\b(.*))?", re.I | re.S)
_DELETE = re.compile(rf"DELETE\s+FROM\s+{_NAME}\s*(?:\bWHERE\b(.*))?", re.I | re.S)


def run_statement(spark: SparkSession, statement: str, params: Sequence | None = None):
    """Rows of a SELECT, or one row `affected_rows` for any other statement.

    `INSERT INTO table [(columns)] query` runs the query and counts what it appends;
    other forms of INSERT raise, as their rows could not be counted. `UPDATE table SET
    column = value, ... [WHERE condition]` and `DELETE FROM table [WHERE condition]` rewrite
    the partitions that hold such rows (see `change_rows`). Statements that change no rows
    report -1.
    """
    text = with_marks(statement.strip().rstrip(";"), params)
    args = list(params or [])
    if re.match(r"(SELECT|WITH)\b", text, re.I):
        return spark.sql(text, args=args)
    insert = _INSERT.fullmatch(text)
    update, delete = _UPDATE.fullmatch(text), _DELETE.fullmatch(text)
    if insert:
        table, named, query = insert.groups()
        target = spark.table(table).columns
        columns = [x.strip().strip("`") for x in named.split(",")] if named else target
        affected = append(spark.sql(query, args=args).toDF(*columns), table)
    elif re.match(r"INSERT\b", text, re.I):
        raise ValueError("only INSERT INTO table [(columns)] query reports its rows")
    elif update:
        table, said, where = update.groups()
        affected = change_rows(spark, table, where, _assignments(said), args)
    elif delete:
        affected = change_rows(spark, delete.group(1), delete.group(2), None, args)
    else:
        spark.sql(text, args=args)
        affected = -1
    return spark.createDataFrame([(affected,)], "affected_rows bigint")


_PIECES = re.compile(r"""'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*"|`[^`]*`|[(),]|[^'"`(),]+""", re.S)


def _assignments(said: str) -> dict[str, str]:
    """Column to expression; commas in brackets and quotes separate nothing."""
    parts, depth = [""], 0
    for piece in _PIECES.findall(said):
        depth += (piece == "(") - (piece == ")")
        if piece == "," and not depth:
            parts.append("")
        else:
            parts[-1] += piece
    found = dict(part.split("=", 1) for part in parts)
    return {name.strip().strip("`"): value.strip() for name, value in found.items()}


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _spec(values: dict) -> str:
    """A partition as SQL names it."""
    said = {n: "NULL" if v is None else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'" for n, v in values.items()}
    return "PARTITION (" + ", ".join(f"`{n}` = {v}" for n, v in said.items()) + ")"


def _new_folder(spark: SparkSession, table: str) -> str:
    """A path in the table's folder that no reader of the folder looks into."""
    place = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first().data_type
    return f"{place}/_written/{uuid.uuid4().hex}"


def change_rows(
    spark: SparkSession, table: str, where: str | None, sets: dict[str, str] | None, args: Sequence = ()
) -> int:
    """Update (by `sets`, column to SQL expression) or delete the rows that `where` selects.

    Only partitions that hold such rows are read again and written, each to a new folder;
    then the table is pointed to it partition by partition. A partition is always either
    old or new, whenever the job is killed. Returns the number of rows changed, counted
    while writing. Raises for tables without partitions and for updated partition columns.
    """
    parts = _partition_columns(spark, table)
    if not parts:
        raise ValueError(f"{table} has no partitions; UPDATE and DELETE rewrite partitions")
    columns = spark.table(table).columns
    unknown = [c for c in sets or {} if c not in columns]
    if unknown:
        raise ValueError(f"{table} has no columns {', '.join(unknown)}")
    if set(parts) & set(sets or {}):
        raise ValueError("a partition column cannot be updated")
    # Marks are bound in the order in which they stand in the statement.
    chosen = [f"({value}) AS _set{i}" for i, value in enumerate((sets or {}).values())]
    chosen.append(f"coalesce(({where or 'true'}), false) AS _hit")
    marked = spark.sql(f"SELECT *, {', '.join(chosen)} FROM {table}", args=list(args))
    touched = [row.asDict() for row in marked.filter("_hit").select(*parts).distinct().collect()]
    if not touched:
        return 0
    same = [reduce(and_, [F.col(c).eqNullSafe(F.lit(v)) for c, v in values.items()]) for values in touched]
    number = F.coalesce(*[F.when(one, i) for i, one in enumerate(same)])
    rows = marked.filter(reduce(or_, same)).withColumn("_number", number)
    kinds = {f.name: f.dataType for f in spark.table(table).schema.fields}
    named = {name: f"_set{i}" for i, name in enumerate(sets or {})}
    values = [
        F.when(F.col("_hit"), F.col(named[c]).cast(kinds[c])).otherwise(F.col(c)).alias(c) if c in named else F.col(c)
        for c in columns
        if c not in parts
    ]
    count = Observation()
    rows = rows.observe(count, F.count_if("_hit").alias("rows"))
    rows = rows if sets is not None else rows.filter(~F.col("_hit"))
    folder = _new_folder(spark, table)
    rows.select(*values, "_number").write.partitionBy("_number").parquet(folder)
    for i, partition in enumerate(touched):
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_number={i}")
        spec = _spec(partition)
        old = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {spec}").filter("col_name = 'Location'").first().data_type
        if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
            spark.sql(f"ALTER TABLE {table} {spec} SET LOCATION '{place.toString()}'")
        else:
            spark.sql(f"ALTER TABLE {table} DROP {spec}")
        gone = spark._jvm.org.apache.hadoop.fs.Path(old)
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    spark.catalog.refreshTable(table)
    return count.get["rows"]


# --- appends of streams ---------------------------------------------------------


def create_batch_table(spark: SparkSession, table: str, ddl: str) -> None:
    """A table whose partitions are the micro-batches that were added to it."""
    create_table(spark, table, f"{ddl}, _writer STRING, _batch BIGINT", ["_writer", "_batch"])


def append_batch(rows: DataFrame, table: str, writer: str, batch: int) -> int:
    """Add the rows of a micro-batch, unless that batch of that writer is in the table.

    The list of partitions is the ledger: rows are written aside and become a partition in
    one step of the catalog. A batch that is run again adds nothing, and one that was killed
    before that step has left nothing that readers see. Returns the number of rows added.
    """
    spark = rows.sparkSession
    spec = _spec({"_writer": writer, "_batch": batch})
    if not spark.sql(f"SHOW PARTITIONS {table} {spec}").isEmpty():
        return 0
    fields = [f for f in spark.table(table).schema.fields if f.name not in ("_writer", "_batch")]
    count, folder = Observation(), _new_folder(spark, table)
    shaped = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
    shaped.observe(count, F.count(F.lit(1)).alias("rows")).write.parquet(folder)
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {spec} LOCATION '{folder}'")
    return count.get["rows"]


def append_stream(rows: DataFrame, table: str, writer: str, checkpoint: str) -> DataStreamWriter:
    """A stream writer that adds every micro-batch to a batch table once.

    `writer` names the query; it must stay the same when the query goes on from its
    checkpoint, and differ between queries that add to one table.
    """

    def store(batch: DataFrame, number: int) -> None:
        append_batch(batch, table, writer, number)

    return rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)


# --- tables made from CSV -----------------------------------------------------


def create_table_from_csv(
    spark: SparkSession, path: str, table: str, columns: Sequence[str] | None = None
) -> list[tuple[str, str]]:
    """Create `table` with types inferred from a CSV and append its rows.

    Returns the (column, database type) pairs the table definition follows.
    """
    texts = read_texts(spark, path, columns)
    types = infer_columns(texts)
    create_table(spark, table, ", ".join(f"`{name}` {spark_type(kind)}" for name, kind in types))
    append(typed(texts, types), table)
    return types


def column_types_option(types: Sequence[tuple[str, str]]) -> str:
    """Value of the JDBC option `createTableColumnTypes`."""
    return ", ".join(f"{name} {kind}" for name, kind in types)


# --- remote databases ---------------------------------------------------------


def jdbc_options(
    host: str, database: str, user: str, password: str, port: int = 5432, batch_size: int = 5_000
) -> dict[str, str]:
    """Options of a JDBC table; who connects is for the caller to say."""
    return {
        "url": f"jdbc:postgresql://{host}:{port}/{database}",
        "driver": "org.postgresql.Driver",
        "user": user,
        "password": password,
        "batchsize": str(batch_size),
    }


def wide_column_options(
    keyspace: str, table: str, host: str = "127.0.0.1", port: int = 9042
) -> dict[str, str]:
    return {
        "keyspace": keyspace,
        "table": table,
        "spark.cassandra.connection.host": host,
        "spark.cassandra.connection.port": str(port),
    }


def append_remote(
    rows: DataFrame, source: str, options: dict[str, str], on_missing: str = "error"
) -> bool:
    """Append to a remote table. Without its connector: raise, or warn and skip the rows.

    Returns whether the rows were written. Errors of a present connector always raise.
    """
    try:
        rows.write.format(source).options(**options).mode("append").save()
    except (PySparkException, Py4JJavaError) as error:
        absent = "DATA_SOURCE_NOT_FOUND" in str(error) or "ClassNotFoundException" in str(error)
        if not absent or on_missing == "error":
            raise
        warnings.warn(f"no connector for {source}; rows not written", RuntimeWarning, stacklevel=2)
        return False
    return True


# --- keyed tables ---------------------------------------------------------------


def with_uuid(rows: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """Add the key `id`: random, or derived from columns so that a rerun repeats it."""
    if by is None:
        return rows.withColumn("id", F.uuid())
    digest = F.md5(F.to_json(F.struct(*by)))
    dashed = F.regexp_replace(digest, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return rows.withColumn("id", dashed)


def as_anomalies(results: DataFrame, source: str) -> DataFrame:
    """Labelled windows in the columns of the anomaly table."""
    return with_uuid(results, ["window_start"]).select(
        "id",
        F.col("window_start").alias("timestamp"),
        F.lit(source).alias("source"),
        F.col("event_count").cast("int").alias("event_count"),
        F.col("avg_msg_length").cast("float").alias("avg_message_length"),
        F.col("entropy_tokens").cast("float").alias("entropy"),
        F.col("isolation_forest_label").cast("int").alias("isolation_forest_label"),
        F.lit(None).cast("int").alias("one_class_svm_label"),
        F.col("dbscan_label").cast("int").alias("dbscan_label"),
        F.col("ensemble_anomaly").cast("int").alias("ensemble_anomaly"),
    )


#: Hash buckets of a keyed table, if not said otherwise.
BUCKETS = 32


def create_keyed_table(spark: SparkSession, table: str, ddl: str, key: str = "id", buckets: int = BUCKETS) -> None:
    """A table of row versions: the given columns and the time of the write.

    Its partitions are hash buckets of the key, so that reads of a key and compactions
    touch one bucket, and generations: 0 takes new versions, others hold compacted ones.
    """
    create_table(
        spark, table, f"{ddl}, _written TIMESTAMP, _bucket INT, _generation BIGINT", ["_bucket", "_generation"]
    )
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('logtide.key' = '{key}', 'logtide.buckets' = '{buckets}')")


def _bucket_of(spark: SparkSession, table: str, value: Column, key: str) -> Column:
    """The bucket of a key in the type that the table stores it in."""
    buckets = spark.sql(f"SHOW TBLPROPERTIES {table} ('logtide.buckets')").first().value
    kind = spark.table(table).schema[key].dataType
    return F.pmod(F.xxhash64(value.cast(kind)), F.lit(int(buckets))).cast("int")


def append_keyed(rows: DataFrame, table: str, order_by: Sequence[str], key: str = "id") -> int:
    """Insert or replace by key: append row versions. Costs the new rows only.

    Of rows with one key the last in `order_by` counts, wherever it was read. Returns
    the number of keys written. Writes to one table follow each other.
    """
    spark = rows.sparkSession
    last = last_per_key(rows, key, order_by)
    target = spark.table(table).columns
    named = last.select(*[c for c in last.columns if c in target])
    bucket = _bucket_of(spark, table, F.col(key), key)
    placed = named.withColumns({"_written": F.current_timestamp(), "_bucket": bucket, "_generation": F.lit(0)})
    return append(placed.repartition("_bucket"), table)


def load_csv_keyed(
    spark: SparkSession,
    path: str,
    table: str,
    order_by: Sequence[str],
    key: str = "id",
    columns: Sequence[str] | None = None,
) -> int:
    """Load a CSV file or folder into a keyed table; `columns` selects by name."""
    wanted = None if columns is None else list(dict.fromkeys([*columns, key, *order_by]))
    return append_keyed(read_csv(spark, path, wanted), table, order_by, key)


_VERSION = ("_written", "_bucket", "_generation")


def read_keyed(spark: SparkSession, table: str, key: str = "id") -> DataFrame:
    """The last version per key. It is a combinable maximum, so hot keys do no harm."""
    return last_per_key(spark.table(table), key, ["_written"]).drop(*_VERSION)


def read_key(spark: SparkSession, table: str, value, key: str = "id") -> DataFrame:
    """The last version of one key, from its bucket alone."""
    of = F.col("_bucket") == _bucket_of(spark, table, F.lit(value), key)
    rows = spark.table(table).filter(of & (F.col(key) == F.lit(value)))
    return last_per_key(rows, key, ["_written"]).drop(*_VERSION)


def compact_keyed(spark: SparkSession, table: str, key: str = "id") -> int:
    """Leave one version per key, so that reads stop paying for history.

    Buckets without new versions are left alone. The others are written as a new generation
    first and lose the old ones then. In between both are there, and as rows of a key are
    told apart by the time of their write, readers see the same rows: whenever this is
    killed, nothing is lost, and the next run goes on. Returns the number of buckets written.
    """
    names = [row.partition for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    held: dict[int, list[int]] = {}
    for name in names:
        bucket, generation = (int(part.split("=")[1]) for part in name.split("/"))
        held.setdefault(bucket, []).append(generation)
    todo = {b: sorted(g) for b, g in held.items() if g != [max(g)] or g == [0]}
    if not todo:
        return 0
    rows = spark.table(table).filter(F.col("_bucket").isin(list(todo)))
    # Buckets count generations for themselves; one number above all serves them all.
    newest = max(g[-1] for g in todo.values()) + 1
    latest = last_per_key(rows, key, ["_written"]).withColumn("_generation", F.lit(newest))
    append(latest.repartition("_bucket"), table)
    _drop_generations(spark, table, todo)
    return len(todo)


def _drop_generations(spark: SparkSession, table: str, old: dict[int, list[int]]) -> None:
    for bucket, generations in old.items():
        for generation in generations:
            spec = _spec({"_bucket": bucket, "_generation": generation})
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {spec}")


def last_per_key(rows: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """Rows left after replacing by key in the given order."""
    latest = rows.groupBy(F.col(key).alias("_key")).agg(
        F.max_by(F.struct(*rows.columns), F.struct(*order_by)).alias("_row")
    )
    return latest.select("_row.*")
