"""A valuation within a year: partial cells stay out of factors and are developed by their age in months."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ratewright.operators import ldf, quality, triangle, ultimate
from ratewright.operators.ldf import MEASURES
from ratewright.plans.queries import book_for
from tests.conftest import SF_DIR, d

SEG = ("ALL", "ALL", "ALL")
SEGMENT = "state_grp string, risk_class_grp string, vehicle_segment_grp string"


def cells(spark, rows):
    """(accident year, age in months, paid)"""
    return spark.createDataFrame(
        [(*SEG, ay, (age - 1) // 12, age, Decimal(paid), Decimal(paid), paid) for ay, age, paid in rows],
        f"{SEGMENT}, accident_year int, development int, age_months int, cumulative_paid decimal(18,2), "
        "cumulative_incurred decimal(18,2), cumulative_claim_count bigint",
    )


# valued at 2021-03-31: three, two and one whole years, and a diagonal of partial cells
MARCH = [(2018, 12, 100), (2018, 24, 150), (2018, 36, 165), (2018, 39, 166), (2019, 12, 120), (2019, 24, 200),
         (2019, 27, 204), (2020, 12, 80), (2020, 15, 95), (2021, 3, 20)]


def test_no_ratio_touches_a_partial_cell(spark):
    raw = {(r.accident_year, r.development): r.link_ratio_paid for r in ldf.ldf_raw(cells(spark, MARCH)).collect()}
    assert raw == {(2018, 0): 1.5, (2018, 1): 1.1, (2018, 2): None, (2019, 0): pytest.approx(5 / 3), (2019, 1): None,
                   (2020, 0): None}
    weighted = {r.development: r.weighted_ldf_paid for r in ldf.ldf_weighted(cells(spark, MARCH)).collect()}
    assert weighted == {0: pytest.approx(350 / 220), 1: 1.1}
    assert {r.development for r in ldf.ldf_last3_weighted(cells(spark, MARCH)).collect()} == {0, 1, 2}


def factors(spark, *values):
    return spark.createDataFrame([(*SEG, dev, f) for dev, f in values], f"{SEGMENT}, development int, cdf double")


def test_the_developed_share_grows_evenly_between_year_ends(spark):
    got = {r.age_months: r.cdf for r in ldf.cdf_by_month(factors(spark, (0, 2.0), (1, 1.25))).collect()}
    assert sorted(got) == list(range(1, 25))
    assert got[12] == 2.0 and got[24] == 1.25
    assert got[6] == pytest.approx(4.0) and got[3] == pytest.approx(8.0)  # from nothing at birth
    assert got[18] == pytest.approx(1 / 0.65)  # half way from 0.5 to 0.8


def test_no_factor_past_the_last_one_or_over_a_gap(spark):
    gap = {r.age_months for r in ldf.cdf_by_month(factors(spark, (0, 2.0), (2, 1.1))).collect()}
    assert gap == {*range(1, 13), 36}
    held = {r.age_months: r.cdf for r in ldf.cdf_by_month(factors(spark, (0, 2.0), (1, 1.1)), hold_tail=True).collect()}
    assert max(held) == 35 and {held[a] for a in range(24, 36)} == {1.1}


def test_ultimates_of_partial_cells(spark):
    curve = ldf.cdf_by_month(factors(spark, (0, 1.75), (1, 1.1), (2, 1.0)))
    got = {r.accident_year: r.ultimate_loss for r in ultimate.ultimate_chain_ladder(cells(spark, MARCH), curve, "paid").collect()}
    share = lambda low, high: low + (high - low) * 3 / 12
    assert got == {
        2019: pytest.approx(204 / share(1 / 1.1, 1.0)),
        2020: pytest.approx(95 / share(1 / 1.75, 1 / 1.1)),
        2021: pytest.approx(20 / share(0.0, 1 / 1.75)),
    }  # 2018 is 39 months old: no factor there


def test_a_year_end_has_no_partial_cells(spark, book):
    cells = book.claim_triangle_cumulative
    assert cells.where("age_months <> 12 * (development + 1)").count() == 0
    for m in MEASURES:
        whole = book.cdf(m).withColumn("age_months", F.col("development") * 12 + 12).select("age_months", "cdf")
        months = {r.age_months: r.cdf for r in book.cdf_by_month(m).collect()}
        assert {r.age_months: r.cdf for r in whole.collect()} == {a: c for a, c in months.items() if a % 12 == 0}


@pytest.mark.parametrize("as_of", [date(2001, 6, 30), date(2001, 1, 31)])
def test_both_triangle_routes_agree_within_a_year(spark, as_of):
    book = book_for(spark, SF_DIR, as_of=as_of)
    short = sorted(map(str, book.claim_triangle_cumulative.collect()))
    slow = triangle.claim_triangle_cumulative(book.claim_snapshot_year_end, book.priced_policy)
    assert short == sorted(map(str, slow.select(*book.claim_triangle_cumulative.columns).collect()))
    partial = book.claim_triangle_cumulative.where("age_months % 12 <> 0")
    assert {(r.accident_year, r.age_months) for r in partial.collect()} == {
        (y, (as_of.year - y) * 12 + as_of.month) for y in range(1995, as_of.year + 1) if (y, as_of.month) != (2001, 1)
    } | {(r.accident_year, r.age_months) for r in partial.where("accident_year = 2001").collect()}
    checks = quality.triangle_reconciles_to_snapshot(
        book.claim_snapshot_year_end, book.priced_policy, book.claim_triangle_cumulative
    )
    assert checks.count() == 0
    # the factors are those of the year end before
    before = book_for(spark, SF_DIR, as_of=date(as_of.year - 1, 12, 31))
    same = lambda b: sorted(map(str, b.ldf_raw.collect()))
    assert same(book) == same(before)
    ultimates = {r.accident_year: r.ultimate_loss for r in book.ultimate_chain_ladder("paid").collect()}
    latest = {r.accident_year: r for r in ultimate.latest_diagonal(book.claim_triangle_cumulative, "cumulative_paid", "age_months").collect()}
    curve = {r.age_months: r.cdf for r in book.cdf_by_month("paid").collect()}
    assert ultimates == {
        y: pytest.approx(float(r.cumulative_paid) * curve[r.age_months]) for y, r in latest.items() if r.age_months in curve
    }
    assert d("2001-01-01").year in ultimates or as_of.month == 1
