"""Rows are dealt once for each key they are joined on."""

import glob
import re

import pytest
from pyspark.sql import functions as F

from ratewright.session import materialize, scratch_path
from ratewright.sources import rest
from ratewright.sources.sample_tables import SampleBook
from tests.conftest import SF_DIR
from tests.test_plans import exchanges


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def keys(df):
    """The columns that the exchanges of a plan hash on."""
    return [re.sub(r"#\d+L?", "", key) for key in exchanges(df)]


@pytest.mark.parametrize("name", ["raw_policy_coverage", "raw_policy_risk_unit", "raw_premium_transaction"])
def test_order_lines_are_dealt_once(spark, no_broadcast, name):
    """They are grouped and meet their policies where they lie."""
    found = keys(getattr(SampleBook(spark, SF_DIR), name)())
    assert len(found) == 2 and all("linenumber" not in key and "slot" not in key for key in found)


def test_vehicles_are_dealt_once_more_for_their_part(spark, no_broadcast):
    found = keys(SampleBook(spark, SF_DIR).raw_vehicle())
    assert sum("pk" in key or "partkey" in key for key in found) == 2  # the vehicles and the parts
    assert sum("policy_id" in key for key in found) == 2  # their terms and states; they lie by their order


def test_exposure_months_lie_with_their_unit(book, no_broadcast):
    assert not any("coverage_id" in key for key in keys(book.earned_exposure_month))
    assert sum("coverage_id" in key for key in keys(book.earned_exposure_month_by_coverage)) == 1


@pytest.mark.parametrize("name", ["auto_exposure_attributes", "property_exposure_attributes"])
def test_rated_coverages_are_not_dealt_again(book, no_broadcast, name):
    assert not any("coverage_id" in key for key in keys(getattr(book, name)))


def test_exposure_months_are_the_same_by_either_key(book):
    one, other = book.earned_exposure_month, book.earned_exposure_month_by_coverage
    assert one.count() == other.count() and one.exceptAll(other).count() == 0


@pytest.mark.parametrize("name", ["raw_policy", "raw_policy_coverage", "raw_claim_transaction", "raw_driver_vehicle_assignment"])
def test_bases_of_a_load_are_dealt_before_its_columns_are_made(spark, name):
    """The copies lie as the writer wants them, one file to a bucket, and hold the same rows."""
    raw = SampleBook(spark, SF_DIR, keep=True, buckets=5)
    plain = rest.conformed(getattr(raw, name)(), name)
    dealt = {key: rest.conformed(df, name) for key, df in raw.lying_by(name).items()}
    assert set(dealt) == set(rest.LAYOUT[name])
    root = scratch_path(spark, "dealt")
    rest.write_at_rest(root, name, plain, 5, dealt)
    back = rest.source_at_rest(spark, root)
    for key in rest.LAYOUT[name]:
        files = glob.glob(f"{rest._path(root, name, key)}/*.parquet")
        assert len(files) == 5 and all(".zstd." in f for f in files)
        found = back(name, key)
        assert found.exceptAll(plain).count() == plain.exceptAll(found).count() == 0


def test_a_kept_table_is_packed_tightly(spark):
    path = materialize(spark.range(9), "packed").inputFiles()
    assert path and all(".zstd." in f for f in path)


def test_a_hot_key_is_found_without_counting_every_key(spark):
    even = spark.range(4000).withColumn("k", F.col("id") % 1000)
    one = even.withColumn("k", F.when(F.col("id") < 3000, 7).otherwise(F.col("id")))
    none = even.withColumn("k", F.when(F.col("id") < 3000, F.lit(None).cast("bigint")).otherwise(F.col("id")))
    assert not rest.is_hot(even, "k", 16) and rest.is_hot(one, "k", 16) and rest.is_hot(none, "k", 16)
    assert not rest.is_hot(even.where("false"), "k", 16)
