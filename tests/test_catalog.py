"""Registered queries against their SQL on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog.compare import compare, oracle_connection

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_sql_has_its_query():
    assert set(oracle_sql()) <= set(queries())


FAST = [
    "s1_read_lines", "s5_csv_scan", "p6_fallback_documents", "p13_indicator_tags",
    "p15_line_number", "p17_parse_statistics", "l3_half_open_range", "f1_window_assignment",
    "f7_document_entropy", "f9_no_times_no_windows", "f11_window_features", "m3_density_noise",
    "m6_ensemble_vote", "r1_date_time_split", "k1_events_csv", "k7_inferred_types",
    "k9_upsert_by_key", "k12_affected_rows", "t2_stream_features", "n1_flow_features",
    "n2_flow_totals", "x1_standardize", "x3_sessions", "x4_drift_ks", "x9_anomalous_services",
]


@pytest.mark.parametrize("name", FAST)
def test_query_equals_sql(spark, connection, name):
    assert compare(spark, connection, name, SF_DIR).startswith("ok")
