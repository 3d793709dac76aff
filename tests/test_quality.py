"""The checks pass on sound tables and find planted faults."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ratewright.operators import quality
from ratewright.plans.queries import _checks

EXPECTED_FAILURES = {
    "incurred_link_ratios_at_least_one",
    "selected_method_loss_coverage",
    "selected_method_claim_count_coverage",
    "cdf_rising_incurred",
}


def test_named_checks_on_the_book(book):
    """Only the checks whose findings are real on this data report rows."""
    names = [
        "claim_snapshot_population",
        "claim_snapshot_reconciles",
        "coverage_month_reconciles",
        "earned_premium_reconciles_to_net_written",
        "triangle_reconciles_to_snapshot",
        *EXPECTED_FAILURES,
    ]
    checks = _checks(book)
    failing = {n for n in names if checks[n][1](book).limit(1).count()}
    assert failing == EXPECTED_FAILURES


def test_population_check_finds_missing_claims(book):
    short = book.claim_valuation_snapshot.where(
        "not (coverage_code = 'AUTO_BI' and valuation_date = '2001-12-31')"
    )
    rows = quality.claim_snapshot_population(book.fct_claim, book.valuation_dates, short).collect()
    assert [r.valuation_date.isoformat() for r in rows] == ["2001-12-31"]
    assert rows[0].actual_claim_count < rows[0].expected_claim_count


def test_snapshot_check_finds_wrong_amounts(book):
    off = book.claim_snapshot.withColumn(
        "incurred", F.when(F.col("valuation_date") == "1999-06-30", F.col("incurred") + 1).otherwise(F.col("incurred"))
    )
    rows = quality.claim_snapshot_reconciles(
        book.claim_financial_events, book.valuation_dates, off, book.params.as_of
    ).collect()
    assert [r.valuation_date.isoformat() for r in rows] == ["1999-06-30"]


def test_triangle_check_finds_a_changed_cell(book):
    off = book.claim_triangle_cumulative.withColumn(
        "cumulative_paid",
        F.when(F.col("development") == 3, F.col("cumulative_paid") + Decimal("0.01")).otherwise(F.col("cumulative_paid")),
    )
    rows = quality.triangle_reconciles_to_snapshot(book.claim_snapshot_year_end, book.priced_policy, off).collect()
    assert rows and {r.development for r in rows} == {3}


def test_premium_check_finds_lost_month(book):
    lost = book.earned_premium_month.where("calendar_month <> '1998-03-01'")
    assert quality.earned_premium_reconciles_to_net_written(book.stg_premium_transaction, lost).count() > 0


@pytest.mark.parametrize(
    "check, failing",
    [
        (lambda t: quality.not_null(t, "k"), 1),
        (lambda t: quality.unique(t, "k"), 1),  # "a" twice; NULL does not count
        (lambda t: quality.accepted_values(t, "v", [1, 2]), 1),  # NULL passes
        (lambda t: quality.expression_is_true(t, "v < 3"), 1),
        (lambda t: quality.accepted_range(t, "v", 1, 3), 0),
        (lambda t: quality.accepted_range(t, "v", 1, 3, inclusive=False), 2),
        (lambda t: quality.unique_combination(t, ["k", "v"]), 0),
        (lambda t: quality.relationships(t, "k", t.where("v = 2"), "k"), 1),  # "c" has no parent
    ],
)
def test_generic_checks(spark, check, failing):
    table = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("c", None)], "k string, v int")
    assert check(table).count() == failing


def test_cdf_and_ultimate_checks_find_faults(book):
    cdf = book.cdf("paid").withColumn("cdf", F.when(F.col("development") == 2, 0.5).otherwise(F.col("cdf")))
    assert quality.cdf_below_one(cdf).count() == 1
    assert quality.cdf_rising(cdf).count() == 1
    low = book.ultimate_chain_ladder("paid").withColumn("ultimate_loss", F.col("ultimate_loss") / 10)
    below = quality.ultimate_below_latest(low, book.claim_triangle_cumulative, "ultimate_loss", "cumulative_paid")
    assert below.count() == low.count()
