"""Run registered queries against their SQL: python -m catalog.compare [sf_dir] [name ...]"""

from __future__ import annotations

import math
import sys
import tempfile
import time
import traceback

import duckdb

from catalog.queries import ORACLES, QUERIES
from logtide.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, float):
        return repr(round(value, 6) + 0.0)
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(row[i]) for i in order) for row in rows)


def compare(spark, connection, name: str, sf_dir: str) -> str:
    found = QUERIES[name](spark, sf_dir)
    mine = canonical(found.columns, [tuple(row) for row in found.collect()])
    if name not in ORACLES:
        return f"rows only ({len(mine[1])})"
    result = connection.execute(ORACLES[name])
    theirs = canonical([d[0] for d in result.description], result.fetchall())
    if mine[0] != theirs[0]:
        return f"COLUMNS DIFFER {mine[0]} {theirs[0]}"
    if mine[1] != theirs[1]:
        extra = list(set(mine[1]) - set(theirs[1]))[:2]
        lacking = list(set(theirs[1]) - set(mine[1]))[:2]
        return f"ROWS DIFFER {len(mine[1])} {len(theirs[1])} extra {extra} lacking {lacking}"
    return f"ok ({len(mine[1])})"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
           "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="compare-")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    failed = 0
    for name in names:
        started = time.time()
        try:
            outcome = compare(spark, connection, name, sf_dir)
        except Exception:
            outcome = "ERROR " + traceback.format_exc(limit=-3)[-1500:]
        failed += not outcome.startswith(("ok", "rows only"))
        print(f"{name}: {outcome} {time.time() - started:.1f}s", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
