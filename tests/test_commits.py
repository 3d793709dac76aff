"""Uploads at the same time, loads run again, balances of crowded days, all segmentation versions at once."""

import random
from decimal import Decimal
from multiprocessing.pool import ThreadPool

import pytest
from pyspark.sql import functions as F

from ratewright.functions.segments import by_versions, segmentation_config
from ratewright.operators import governance, rules, triangle
from ratewright.session import materialize, scratch_path
from ratewright.sources import tables
from tests.conftest import d
from tests.test_plans import plan_of

EXPENSE = "pricing_version string, state string, fixed_expense_per_exposure double"


def expenses(spark, *values):
    return spark.createDataFrame([(f"p{i}", "ALL", float(v)) for i, v in enumerate(values)], EXPENSE)


def register(spark, root):
    return {r.version_sequence: r for r in tables.read_governance(spark, root, "assumption_version").collect()}


def test_two_uploads_at_the_same_time_get_two_sequences(spark):
    root = scratch_path(spark, "race")
    with ThreadPool(2) as pool:
        ids = pool.map(lambda v: governance.upload_assumption(root, "expense_assumption", expenses(spark, v), f"author {v}"), [1, 2])
    rows = register(spark, root)
    assert sorted(rows) == [1, 2] and {r.assumption_set_id for r in rows.values()} == set(ids)
    assert rows[2].previous_assumption_set_id == rows[1].assumption_set_id
    current = governance.current_assumption(spark, root, "expense_assumption").first()
    assert rows[2].uploaded_by == f"author {current.fixed_expense_per_exposure:.0f}"


def test_the_loser_of_a_race_compares_with_the_winner(spark, monkeypatch):
    root = scratch_path(spark, "loser")
    governance.upload_assumption(root, "expense_assumption", expenses(spark, 1, 2), "ann")
    real, once = governance._create_if_absent, []

    def late(session, path, text):
        if not once:  # between the comparison and the commit another upload comes in
            once.append(1)
            governance.upload_assumption(root, "expense_assumption", expenses(spark, 1, 5), "bob")
        return real(session, path, text)

    monkeypatch.setattr(governance, "_create_if_absent", late)
    mine = governance.upload_assumption(root, "expense_assumption", expenses(spark, 1, 7), "cy")
    rows = register(spark, root)
    assert [rows[k].uploaded_by for k in sorted(rows)] == ["ann", "bob", "cy"]
    log = tables.read_governance(spark, root, "assumption_change_log").where(F.col("assumption_set_id") == mine).collect()
    assert [(r.old_value, r.new_value) for r in log] == [("5", "7")] and rows[3].change_count == 1


def test_an_upload_that_died_leaves_the_old_version_or_a_complete_one(spark, monkeypatch):
    root = scratch_path(spark, "died")
    first = governance.upload_assumption(root, "expense_assumption", expenses(spark, 1), "ann")
    monkeypatch.setattr(governance, "_create_if_absent", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        governance.upload_assumption(root, "expense_assumption", expenses(spark, 2), "ann")
    assert governance.current_assumption(spark, root, "expense_assumption").first().fixed_expense_per_exposure == 1
    assert sorted(register(spark, root)) == [1]
    monkeypatch.undo()
    monkeypatch.setattr(governance, "copy_register", lambda *a: 1 / 0)  # committed, copies not made
    with pytest.raises(ZeroDivisionError):
        governance.upload_assumption(root, "expense_assumption", expenses(spark, 3), "ann")
    assert governance.current_assumption(spark, root, "expense_assumption").first().fixed_expense_per_exposure == 3
    monkeypatch.undo()
    governance.copy_register(spark, root)
    governance.copy_register(spark, root)
    rows = register(spark, root)
    assert sorted(rows) == [1, 2] and rows[2].previous_assumption_set_id == first
    assert tables.read_governance(spark, root, "pipeline_run_metadata").count() == 2


def test_a_batch_run_again_changes_nothing(spark):
    path = scratch_path(spark, "batches")
    frame = lambda n: spark.range(n).withColumn("load_batch_id", F.lit("?"))
    read = lambda: {(r.load_batch_id, r.n) for r in tables.read_batches(spark, path, frame(0).schema).groupBy("load_batch_id").agg(F.count("*").alias("n")).collect()}  # noqa: E731, E501
    assert read() == set()
    assert tables.load_batch(frame(3), path, "a=1/x y") == 3 and tables.load_batch(frame(2), path, "b") == 2
    before = spark.read.parquet(path).inputFiles()
    assert tables.load_batch(frame(3), path, "a=1/x y") == 3
    assert sorted(spark.read.parquet(path).inputFiles()) == sorted(before)
    assert read() == {("a=1/x y", 3), ("b", 2)}
    assert tables.load_batch(frame(5), path, "b", replace=True) == 5 and read() == {("a=1/x y", 3), ("b", 5)}
    assert tables.load_batch(frame(0), path, "b", replace=True) == 0 and read() == {("a=1/x y", 3)}


def test_a_load_that_died_is_not_seen_and_can_be_run(spark, monkeypatch):
    path = scratch_path(spark, "died")
    tables.load_batch(spark.range(1), path, "a")
    spark.range(9).write.parquet(f"{path}/load_batch_id=b")  # rows without a marker
    schema = spark.range(0).withColumn("load_batch_id", F.lit("")).schema
    assert tables.read_batches(spark, path, schema).count() == 1
    assert tables.load_batch(spark.range(4), path, "b") == 4
    assert tables.read_batches(spark, path, schema).count() == 5


@pytest.fixture
def small_slices(spark):
    """Slices as a large table would have: small ones are not put together."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_balance_of_a_crowded_day(spark, small_slices, monkeypatch):
    written = []
    monkeypatch.setattr(rules, "materialize", lambda df, name: written.append(materialize(df, name)) or written[-1])
    rng = random.Random(1)
    rows = [(f"{i:06d}", "hot", d("2020-01-05"), rng.randint(-900, 1000)) for i in range(6000)]
    rows += [(f"x{i}", f"c{i % 50}", d(f"2020-01-{1 + i % 9:02d}"), rng.randint(-50, 90)) for i in range(900)]
    rows += [("000000a", "hot", d("2020-01-04"), 7), ("000001a", "hot", d("2020-01-06"), -3)]
    rng.shuffle(rows)
    df = spark.createDataFrame(
        [(t, c, day, Decimal(v)) for t, c, day, v in rows],
        "transaction_id string, coverage_id string, transaction_date date, premium_change decimal(18,2)",
    )
    expected, balance = {}, {}
    for t, c, day, v in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        balance[c] = balance.get(c, 0) + v
        expected[t] = max(balance[c], 0)
    result = rules.running_premium_balance(df)
    assert {r.transaction_id: int(r.cumulative_premium) for r in result.collect()} == expected
    crowded = written[0].where("coverage_id = 'hot'").groupBy("slice").count().collect()
    assert len(crowded) > 3 and max(r["count"] for r in crowded) < 3000
    # the crowded day lies in several slices, and every window over movements is within one
    tree = plan_of(result)
    windows = [line for line in tree.splitlines() if "sum(" in line and "windowspecdefinition" in line]
    assert windows and all("slice" in w for w in windows)


def test_versions_of_the_config_from_one_aggregation(spark, book):
    whole = book.claim_triangle_versions
    for version in ("v1", "v2", "v3"):
        alone = triangle.claim_triangle_from_events(
            book.fct_claim, book.fct_claim_transaction, book.priced_policy, book.params.as_of, book.params.calendar_start, version
        )
        own = whole.where(F.col("segmentation_version") == version).select(*alone.columns)
        assert sorted(map(str, own.collect())) == sorted(map(str, alone.collect()))


def test_versions_of_equal_flags_unused_columns_and_nulls(spark):
    finest = spark.createDataFrame(
        [("CA", "std", "suv", 1, 10), ("CA", None, "suv", 1, 5), ("TX", "std", None, 1, 1)],
        "state_grp string, risk_class_grp string, vehicle_segment_grp string, k int, v bigint",
    )
    config = spark.createDataFrame(
        [("a", 0, 0, 0), ("b", 0, 1, 0), ("c", 0, 1, 0), ("d", 1, 0, 1)], segmentation_config(spark).schema
    )
    got = {tuple(r) for r in by_versions(finest, config, ["k"], ["v"]).collect()}
    assert got == {
        ("a", "ALL", "ALL", "ALL", 1, 16),
        *((v, "ALL", c, "ALL", 1, n) for v in "bc" for c, n in (("std", 11), (None, 5))),
        ("d", "CA", "ALL", "suv", 1, 15), ("d", "TX", "ALL", None, 1, 1),
    }
