import pytest
from pyspark.sql import functions as F

from ratewright.operators import governance, review
from ratewright.sources import tables
from ratewright.session import scratch_path

EXPENSE = "pricing_version string, state string, fixed_expense_per_exposure double"


def expenses(spark, rows):
    return spark.createDataFrame(rows, EXPENSE)


def test_upload_registers_versions_and_logs_changes(spark):
    root = scratch_path(spark, "gov")
    first = governance.upload_assumption(root, "expense_assumption", expenses(spark, [("p1", "ALL", 50.0)]), "ann")
    second = governance.upload_assumption(
        root, "expense_assumption", expenses(spark, [("p1", "ALL", 55.0), ("p2", "ALL", None)]), "ann", comment="up"
    )
    register = tables.read_governance(spark, root, "assumption_version")
    rows = {r.version_sequence: r for r in register.collect()}
    assert rows[1].assumption_set_id == first and rows[1].previous_assumption_set_id is None
    assert rows[2].assumption_set_id == second and rows[2].previous_assumption_set_id == first
    assert (rows[2].source_row_count, rows[2].change_count, rows[2].version_label) == (2, 2, "auto_v2")
    log = tables.read_governance(spark, root, "assumption_change_log").where(F.col("assumption_set_id") == second)
    changes = {(r.change_type, r.row_key, r.column_name): (r.old_value, r.new_value) for r in log.collect()}
    assert changes[("updated", "p1|ALL", "FIXED_EXPENSE_PER_EXPOSURE")] == ("50", "55")
    assert changes[("added", "p2|ALL", "__row__")] == (
        None,
        '{"FIXED_EXPENSE_PER_EXPOSURE":null,"PRICING_VERSION":"p2","STATE":"ALL"}',
    )
    assert governance.current_assumption(spark, root, "expense_assumption").count() == 2
    assert tables.read_governance(spark, root, "pipeline_run_metadata").count() == 2


def test_removed_rows_and_summary(spark):
    old = expenses(spark, [("p1", "ALL", 50.0), ("p1", "CA", 51.0)])
    new = expenses(spark, [("p1", "ALL", 50.0)])
    log = governance.change_log(old, new, ["PRICING_VERSION", "STATE"], "s", "t", "f", "2020-01-01 00:00:00")
    (row,) = log.collect()
    assert (row.change_type, row.row_key, row.new_value) == ("removed", "p1|CA", None)
    assert [(r.change_type, r.change_count) for r in governance.change_summary(log).collect()] == [("removed", 1)]


def test_duplicate_keys_are_rejected(spark):
    twice = expenses(spark, [("p1", "ALL", 1.0), ("p1", "ALL", 2.0)])
    with pytest.raises(ValueError, match="p1|ALL"):
        governance.require_unique_keys(twice, ["PRICING_VERSION", "STATE"])
    with pytest.raises(ValueError, match="missing key columns"):
        governance.normalized_rows(twice, ["NO_SUCH"])
    with pytest.raises(ValueError, match="unsupported"):
        governance.key_columns("nope")


def test_sinks_report_rows_and_keep_schema(spark):
    df = expenses(spark, [("p1", "ALL", 1.0), ("p1", "CA", None)])
    path = scratch_path(spark, "t")
    assert tables.overwrite_table(df, path) == 2
    assert tables.overwrite_table(df.limit(1), path) == 1 and spark.read.parquet(path).count() == 1
    assert tables.append_table(df, path) == 2 and spark.read.parquet(path).count() == 3
    csv = scratch_path(spark, "c")
    tables.write_csv(df, csv)
    assert spark.read.option("header", True).schema(EXPENSE).csv(csv).exceptAll(df).count() == 0


def test_review_is_written_by_segment(spark, book):
    path = scratch_path(spark, "review")
    review.write_review(review.review_triangles(book.claim_triangle_cumulative, 6), path)
    back = spark.read.parquet(path)
    assert back.count() == 21 and "dev_6" in back.columns
