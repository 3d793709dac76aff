"""A spread of queries against their SQL at the smallest scale."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_DIR
from tools.check_oracle import compare

NAMES = [
    "dim_calendar_month",
    "fct_exposure",
    "claim_financial_state_cumulative",
    "property_exposure_attributes",
    "loss_triangle",
    "loss_triangle_pooled",
    "ldf_observations",
    "claim_triangle_cumulative_v1",
    "mart_indicated_rate_change_pure_premium",
    "change_log",
    "auto_premium",
    "develop_ultimates",
]


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    _, message = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF_DIR)
    assert message.startswith("ok")


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 168
