"""Physical plans stay free of the operations that do not scale."""

import re

import pytest

import __spark_entry__ as entry
from ratewright.plans.queries import BUILDS, build_queries, resting_book
from ratewright.session import RUNTIME_CONF, scratch_path, shared_dir, size_to
from ratewright.sources import rest
from ratewright.sources.sample_source import sample_partitions, sample_shuffles
from ratewright.sources.sample_tables import SampleBook
from tests.conftest import SF_DIR

LARGE = [
    "coverage_month",
    "earned_exposure_month",
    "earned_premium_month",
    "fct_exposure",
    "claim_financial_state_period",
    "claim_valuation_snapshot",
    "claim_snapshot",
    "loss_triangle",
    "fct_exposure_attribute",
    "claim_triangle_versions",
    "mart_indicated_rate_change_pure_premium",
    "mart_reconciliation_by_segment",
    "relationships_report",
    "running_premium_balance",
    "contract_report_core",
]


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", LARGE)
def test_no_nested_loop_no_python(book, name):
    plan = plan_of(BUILDS[name](book))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan


def test_months_expand_after_the_last_exchange(book):
    """The exposure months are produced and summed without another shuffle."""
    tree = plan_of(book.earned_exposure_month).split("\n\n")[0]
    above = tree[: tree.index("Generate")]
    assert "Exchange" not in above and above.count("HashAggregate") == 2


@pytest.mark.parametrize("name", ["auto_exposure_attributes", "property_exposure_attributes"])
def test_factors_expand_after_the_last_exchange(book, name):
    """Attributes meet coverages, then months and factors are listed: no exploded row is shuffled."""
    tree = plan_of(getattr(book, name)).split("\n\n")[0]
    above = tree[: tree.index("Generate", tree.index("Generate") + 1)]  # above the months
    assert "Exchange" not in above


@pytest.mark.parametrize("name", ["auto_exposure_attributes", "property_exposure_attributes"])
def test_a_key_is_made_once_a_month(book, name):
    """The hash of an exposure is computed below the list of its factors, not for each of them."""
    tree = getattr(book, name)._jdf.queryExecution().executedPlan().toString()
    factors = next(line for line in tree.splitlines() if "Generate inline" in line)
    assert re.search(r"\), \[exposure_id#\d+\], false", factors)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(df):
    """Keys of the exchanges of a plan."""
    return re.findall(r"Exchange\n(?:.*\n)*?Arguments: ([a-z]+partitioning\([^)]*\)|\S+)", plan_of(df))


def test_tables_at_rest_join_without_exchange(spark, no_broadcast):
    rested = resting_book(spark, SF_DIR)
    assert exchanges(rested.earned_premium_month) == []
    assert exchanges(rested.premium_earning_segments) == []
    pairs = rested.stg_claim_transaction.join(rested.stg_claim.select("claim_id", "policy_id"), "claim_id")
    assert exchanges(pairs) == []
    # the policy join needs none; only the risk units are met on another key
    assert all("risk_unit_id" in key for key in exchanges(rested.coverage_active_period))
    assert exchanges(rested.stg_vehicle.join(rested.stg_policy.select("policy_id"), "policy_id")) == []


def test_results_at_rest_are_the_same(spark, book):
    rested = resting_book(spark, SF_DIR)
    for name in ("claim_triangle_cumulative", "ldf_weighted", "fct_ultimate_loss"):
        same = lambda b, n=name: sorted(map(str, getattr(b, n).collect()))
        assert same(rested) == same(book)
    assert rested.fct_exposure.count() == book.fct_exposure.count()


def test_a_table_with_a_hot_key_lies_without_buckets(spark):
    root = scratch_path(spark, "hot")
    claims = rest.conformed(
        spark.range(4000).selectExpr("*", *[f"CAST(NULL AS STRING) AS `{c}`" for c in rest.schemas.RAW["raw_claim"].names if c != "claim_id"],
                                     "IF(id < 3000, 'fleet', CAST(id AS STRING)) AS claim_id"),
        "raw_claim",
    )
    rest.write_at_rest(root, "raw_claim", claims, buckets=16)
    back = rest.source_at_rest(spark, root)("raw_claim")
    assert back.count() == 4000 and "Bucketed: true" not in plan_of(back)
    with pytest.raises(KeyError):
        rest.source_at_rest(spark, root)("no_such")


def test_tables_at_rest_are_registered_again(spark):
    """A new session knows the files and the manifest only."""
    root = scratch_path(spark, "again")
    rows = spark.range(100).selectExpr("CAST(id AS STRING) AS claim_id", "1 AS n")
    full = rest.conformed(rows.selectExpr("*", *[f"CAST(NULL AS STRING) AS `{c}`" for c in rest.schemas.RAW["raw_claim"].names if c != "claim_id"]), "raw_claim")
    rest.write_at_rest(root, "raw_claim", full, buckets=4)
    spark.sql(f"DROP TABLE {rest._table_name(root, 'raw_claim', 'claim_id')}")
    back = rest.source_at_rest(spark, root)("raw_claim")
    assert back.count() == 100 and exchanges(back.groupBy("claim_id").count()) == []


def test_buckets_and_shuffles_grow_with_the_input(spark):
    root = scratch_path(spark, "sized")
    for name, rows in (("orders", 1_000), ("lineitem", 1_000_000)):
        spark.range(rows).selectExpr("uuid() AS u").coalesce(1).write.parquet(f"{root}/{name}.parquet")
    worth = sample_partitions(spark, root)
    assert worth >= 8 and sample_partitions(spark, SF_DIR) == 1
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    try:
        assert int(size_to(spark, 4 * worth).conf.get("spark.sql.shuffle.partitions")) == 4 * worth
        assert size_to(spark, 1).conf.get("spark.sql.shuffle.partitions") == "8"  # the caller's
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_tasks_stay_small_on_larger_inputs(spark):
    """Neither a split of a file nor a merged shuffle partition grows with the input."""
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")
    before = {k: spark.conf.get(k) for k in keys}
    root = scratch_path(spark, "split")
    spark.range(0, 6_000_000, 1, 1).selectExpr("xxhash64(id) AS k").write.option("parquet.block.size", 1 << 20).parquet(root)
    try:
        size_to(spark, 1)
        splits = spark.read.parquet(root).rdd.getNumPartitions()
        assert splits >= 5  # 48 MB in one file
        assert int(spark.conf.get(keys[1])) <= 1 << 20
        spark.conf.set(f"ratewright.{keys[2]}", "4m")  # a caller's smaller splits stand
        assert int(size_to(spark, 1).conf.get(keys[2])) == 4 << 20
        for name in ("orders", "lineitem"):
            spark.read.parquet(root).limit(600_000).coalesce(1).write.parquet(f"{root}_tables/{name}.parquet")
        assert sample_shuffles(spark, f"{root}_tables") > 2 * sample_partitions(spark, f"{root}_tables")
    finally:
        spark.conf.unset(f"ratewright.{keys[2]}")
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_load_derives_its_bases_once(spark):
    kept = SampleBook(spark, SF_DIR, keep=True)
    for name in ("raw_policy_coverage", "raw_claim", "raw_vehicle"):
        df = getattr(kept, name)()
        assert "l_orderkey" not in plan_of(df)  # the order lines are not read again
        plain = getattr(SampleBook(spark, SF_DIR), name)()
        assert df.dtypes == plain.dtypes and df.exceptAll(plain).count() == plain.exceptAll(df).count() == 0


def test_only_needed_columns_are_scanned(book):
    plan = plan_of(book.claim_triangle_cumulative)
    assert "c_nationkey" not in plan


def test_every_query_has_sql():
    own = set(build_queries())
    assert own <= set(entry.queries()) and own <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_session_settings(spark):
    for key, value in RUNTIME_CONF.items():
        assert spark.conf.get(key) == value
    assert shared_dir(spark) == shared_dir(spark)
    assert not re.search(r"/$", shared_dir(spark))
