"""Small cases with answers worked out by hand."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ratewright.functions.dates import completed_age
from ratewright.functions.intervals import explode_months
from ratewright.functions.money import div_round
from ratewright.functions.text import general_number
from ratewright.operators import claims, controls, exposure, ldf, pricing, rules, triangle
from ratewright.params import Params
from tests.conftest import d

CAL = (date(2019, 1, 1), date(2022, 1, 1))
AS_OF = date(2020, 3, 31)


def months_of(spark, start, end):
    df = spark.createDataFrame([(d(start), d(end))], "s date, e date")
    split = explode_months(df, "s", "e", *CAL)
    m = F.col("calendar_month")
    days = F.datediff(F.least(F.col("e"), F.add_months(m, 1)), F.greatest(F.col("s"), m))
    return [(r.m.isoformat(), r.n) for r in split.select(m.alias("m"), days.alias("n")).orderBy("m").collect()]


@pytest.mark.parametrize(
    "start, end, expected",
    [
        ("2020-01-15", "2020-03-10", [("2020-01-01", 17), ("2020-02-01", 29), ("2020-03-01", 9)]),
        ("2020-01-15", "2020-01-15", [("2020-01-01", 0)]),
        ("2020-02-01", "2020-02-01", []),
        ("2020-02-01", "2020-03-01", [("2020-02-01", 29)]),
        ("2020-03-10", "2020-01-15", []),
        ("2018-11-20", "2019-01-05", [("2019-01-01", 4)]),  # before the calendar
        ("2021-12-20", "2022-02-01", [("2021-12-01", 12)]),  # after the calendar
    ],
)
def test_month_split(spark, start, end, expected):
    assert months_of(spark, start, end) == expected


def test_month_split_equals_inequality_join(spark):
    starts = spark.range(0, 600, 1).select(F.date_add(F.lit("2018-12-01").cast("date"), (F.col("id") * 2).cast("int")).alias("s"))
    df = starts.withColumn("e", F.date_add("s", (F.crc32(F.col("s").cast("string")) % 120 - 10).cast("int")))
    cal = spark.range(36).select(F.add_months(F.lit(CAL[0]), F.col("id").cast("int")).alias("m"))
    theta = df.join(cal, (F.col("m") < F.col("e")) & (F.add_months("m", 1) > F.col("s"))).select("s", "e", "m")
    ours = explode_months(df, "s", "e", *CAL, name="m").select("s", "e", "m")
    assert ours.exceptAll(theta).count() == 0 and theta.exceptAll(ours).count() == 0 and ours.count() > 600


def claim_tables(spark, claim_rows, moves):
    c = spark.createDataFrame(
        [(cid, "P", "R", "C", d(loss), d(rep), "t", "c") for cid, loss, rep in claim_rows],
        "claim_id string, policy_id string, risk_unit_id string, coverage_id string, loss_date date, "
        "reported_date date, claim_type string, cause_code string",
    )
    t = spark.createDataFrame(
        [(cid, d(on), *[Decimal(x) for x in (paid, reserve, 0, 0, 0, paid + reserve)]) for cid, on, paid, reserve in moves],
        "claim_id string, transaction_date date, " + ", ".join(f"{x} decimal(18,2)" for x in claims.CHANGES),
    )
    policy = spark.createDataFrame([("P", "prod", "lob")], "policy_id string, product_id string, line_of_business string")
    coverage = spark.createDataFrame([("C", "code")], "coverage_id string, coverage_code string")
    return c, t, policy, coverage


def snapshot_of(spark, claim_rows, moves, as_of=AS_OF):
    c, t, policy, coverage = claim_tables(spark, claim_rows, moves)
    events = claims.claim_financial_events(c, t)
    cumulative = claims.claim_financial_state_cumulative(events, as_of)
    period = claims.claim_financial_state_period(cumulative)
    return cumulative, claims.claim_valuation_snapshot(period, c, policy, coverage, as_of, CAL[0])


def test_reported_only_claim(spark):
    _, snap = snapshot_of(spark, [("a", "2020-01-10", "2020-01-20")], [("a", "2020-02-05", 100, 50)])
    rows = {r.valuation_date.isoformat(): r for r in snap.collect()}
    assert sorted(rows) == ["2020-01-31", "2020-02-29", "2020-03-31"]
    first = rows["2020-01-31"]
    assert first.is_reported_only_state and not first.has_financial_activity and first.cumulative_paid_loss == 0
    assert rows["2020-02-29"].cumulative_incurred_loss == 150


def test_same_day_events_make_one_state(spark):
    cumulative, _ = snapshot_of(
        spark, [("a", "2020-01-10", "2020-01-20")], [("a", "2020-01-20", 10, 0), ("a", "2020-01-20", 5, 0)]
    )
    (row,) = cumulative.collect()
    assert row.financial_transaction_count == 2 and row.has_reported_anchor == 1 and row.cumulative_paid_loss == 15


def test_event_on_valuation_date_counts(spark):
    _, snap = snapshot_of(spark, [("a", "2020-01-10", "2020-01-31")], [("a", "2020-01-31", 7, 0)])
    assert snap.where("valuation_date = '2020-01-31'").first().cumulative_paid_loss == 7


def test_events_after_as_of_are_hidden(spark):
    cumulative, snap = snapshot_of(spark, [("a", "2020-01-10", "2020-01-20")], [("a", "2020-04-01", 9, 0)])
    assert cumulative.count() == 1
    assert snap.agg(F.max("cumulative_paid_loss")).first()[0] == 0


def test_development_ages(spark):
    _, snap = snapshot_of(spark, [("a", "2020-02-10", "2020-02-15")], [])
    row = claims.claim_development(snap).where("valuation_date = '2020-03-31'").first()
    ages = (
        row.development_age_monthly,
        row.development_age_quarterly,
        row.development_age_half_year,
        row.development_age_annual,
    )
    assert ages == (2, 3, 3, 3)


@pytest.mark.parametrize("as_of", [date(2020, 3, 31), date(2021, 8, 31), date(2021, 12, 31)])
def test_triangle_routes_agree(spark, as_of):
    """Gaps, late reports, payments before the report, and a loss that precedes all valuations."""
    claim_rows = [
        ("a", "2020-01-10", "2020-01-20"),
        ("b", "2020-02-28", "2020-07-01"),
        ("c", "2020-12-31", "2021-01-01"),
        ("d", "2021-03-15", "2021-02-01"),  # reported before its loss
        ("e", "2020-01-05", "2020-06-30"),
    ]
    moves = [
        ("a", "2020-01-25", 100, 50),
        ("a", "2020-09-30", 20, -50),
        ("b", "2020-03-02", 30, 0),
        ("c", "2021-06-30", 70, 10),
        ("d", "2021-02-10", 5, 5),
        ("e", "2019-12-15", 1, 1),  # before the first accident month
        ("zz", "2020-05-05", 1, 1),  # no such claim
    ]
    c, t, policy, coverage = claim_tables(spark, claim_rows, moves)
    events = claims.claim_financial_events(c, t)
    period = claims.claim_financial_state_period(claims.claim_financial_state_cumulative(events, as_of))
    snap = claims.claim_valuation_snapshot(period, c, policy, coverage, as_of, CAL[0])
    direct = triangle.loss_triangle(claims.claim_development(snap))
    short = triangle.loss_triangle_from_events(c, t, policy, coverage, as_of, CAL[0])
    assert direct.columns == short.columns
    assert direct.exceptAll(short).count() == 0 and short.exceptAll(direct).count() == 0
    assert direct.count() > 0


def cells(spark, rows):
    return spark.createDataFrame(
        [("ALL", "ALL", "ALL", ay, dev, Decimal(p), Decimal(i), n) for ay, dev, p, i, n in rows],
        "state_grp string, risk_class_grp string, vehicle_segment_grp string, accident_year int, development int, "
        "cumulative_paid decimal(18,2), cumulative_incurred decimal(18,2), cumulative_claim_count bigint",
    )


def test_last3_needs_three_years(spark):
    two = cells(spark, [(2018, 0, 10, 10, 1), (2018, 1, 20, 20, 2), (2019, 0, 10, 10, 1), (2019, 1, 30, 30, 2)])
    by_dev = {r.development: r.last3_ldf_paid for r in ldf.ldf_last3_weighted(two).collect()}
    assert by_dev == {0: 1.0, 1: 1.0}
    four = two.unionByName(
        cells(spark, [(2017, 0, 1, 1, 1), (2017, 1, 9, 9, 1), (2020, 0, 20, 20, 1), (2020, 1, 30, 30, 1)])
    )
    by_dev = {r.development: r.last3_ldf_paid for r in ldf.ldf_last3_weighted(four).collect()}
    assert by_dev[0] == pytest.approx(80 / 40)  # 2017 is left out


def test_cdf_is_backward_product(spark):
    selected = spark.createDataFrame(
        [("ALL", "ALL", "ALL", dev, f) for dev, f in ((0, 1.5), (1, 1.2), (2, 1.1))],
        "state_grp string, risk_class_grp string, vehicle_segment_grp string, development int, selected_ldf_paid double",
    )
    got = {r.development: r.cdf for r in ldf.cdf(selected, "paid").collect()}
    assert got == {0: pytest.approx(1.98), 1: pytest.approx(1.32), 2: pytest.approx(1.1)}


def test_tail_factor_keeps_last_development(spark):
    tri = cells(spark, [(2018, 0, 10, 10, 1), (2018, 1, 20, 20, 1), (2019, 0, 10, 10, 1)])
    selection = spark.createDataFrame(
        [("ALL", "ALL", "ALL", "paid", dev, "avg", None) for dev in (0, 1)],
        "state_grp string, risk_class_grp string, vehicle_segment_grp string, triangle_type string, development int, "
        "method string, ldf double",
    )
    parts = (ldf.ldf_avg(ldf.ldf_raw(tri)), ldf.ldf_weighted(tri), ldf.ldf_last3_weighted(tri))
    without = ldf.ldf_selected(selection, *parts, "paid")
    assert [r.development for r in without.collect()] == [0]
    tail = {r.development: r.selected_ldf_paid for r in ldf.ldf_selected(selection, *parts, "paid", 1.05).collect()}
    assert tail == {0: 2.0, 1: 1.05}


def test_indicated_premium(spark):
    pp = spark.createDataFrame(
        [("ALL", "ALL", "ALL", 2020, 1.0, 0.1, 1000.0)],
        "state_grp string, risk_class_grp string, vehicle_segment_grp string, accident_year int, "
        "total_earned_exposure double, trended_frequency double, trended_severity double",
    )
    expense = spark.createDataFrame(
        [("p1", "ALL", 50.0, 0.2, 0.05, 0.05), ("p2", "ALL", 0.0, 0.0, 0.0, 0.0)],
        "pricing_version string, state_grp string, fixed_expense_per_exposure double, variable_expense_ratio double, "
        "ulae_ratio double, profit_ratio double",
    )
    assert pricing.fct_indicated_premium(pp, expense).count() == 2
    (row,) = pricing.fct_indicated_premium(pp, expense, "p1").collect()
    assert row.indicated_premium == pytest.approx(206.666667)


@pytest.mark.parametrize("gap, status", [(0.0, "PASS"), (0.01, "PASS"), (0.03, "WARN"), (0.06, "FAIL"), (-0.03, "WARN")])
def test_tolerance_status(spark, gap, status):
    row = spark.range(1).select(
        controls.control_status(F.lit(gap), F.lit(0.0), F.lit(0.01), F.lit(0.000001)).alias("s")
    )
    assert row.first().s == status


@pytest.mark.parametrize("at, age", [("2020-06-14", 39), ("2020-06-15", 40)])
def test_age_at_birthday(spark, at, age):
    row = spark.createDataFrame([(d("1980-06-15"), d(at))], "b date, a date")
    assert row.select(completed_age(F.col("b"), F.col("a")).alias("n")).first().n == age


def test_div_round_is_half_away_from_zero(spark):
    rows = spark.createDataFrame([(5, 2), (-5, 2), (4, 3), (-4, 3), (1, 0)], "a bigint, b bigint")
    assert [r.x for r in rows.select(div_round(F.col("a"), F.col("b")).alias("x")).collect()] == [3, -3, 1, -1, None]


VALUES = [1.02, 100.0, 0.03, 1234567.55, 123456789.12345, 9.9999999999, 0.0001, 0.00001234, 1e10, 1e22, -2.5, 0.0,
          9999999999.0, 99999999999.0, 1e-7, 0.1 + 0.2]


def test_general_number_matches_ten_significant_digits(spark):
    got = spark.createDataFrame([(v,) for v in VALUES], "v double").select(general_number(F.col("v")).alias("t"))
    assert [r.t for r in got.collect()] == [f"{v:.10g}" for v in VALUES]


def test_earned_premium_of_refund(spark):
    tx = spark.createDataFrame(
        [("P", "C", d("2020-01-01"), Decimal("366.00")), ("P", "C", d("2020-07-01"), Decimal("-184.00"))],
        "policy_id string, coverage_id string, transaction_date date, premium_change decimal(18,2)",
    )
    cover = spark.createDataFrame([("C", d("2021-01-01"))], "coverage_id string, expiration_date date")
    rows = exposure.earned_premium_month(tx, cover, *CAL).orderBy("calendar_month").collect()
    assert [float(r.earned_premium) for r in rows] == [31, 29, 31, 30, 31, 30] + [0] * 6


def test_policy_exposure_loses_a_day_per_year_end(spark):
    policies = spark.createDataFrame(
        [
            ("1", "CA", "t", "suv", d("2019-07-01"), d("2020-07-01"), None, 12, Decimal("366.00")),
            ("2", "CA", "t", "suv", d("2020-03-01"), d("2020-09-01"), d("2020-03-01"), 6, Decimal("10.00")),
        ],
        "policy_id string, state string, risk_class string, vehicle_segment string, effective_date date, "
        "expiration_date date, cancellation_date date, term_months int, written_premium decimal(18,2)",
    )
    got = {r.calendar_year: r for r in exposure.policy_exposure(policies).collect()}
    assert float(got[2019].total_earned_premium) == 183 and float(got[2020].total_earned_premium) == 182
    assert float(got[2019].total_earned_exposure) == pytest.approx(0.5, abs=1e-6)


def test_running_balance_and_primary_driver(spark):
    tx = spark.createDataFrame(
        [("1", "C", d("2020-01-01"), Decimal("10")), ("2", "C", d("2020-01-01"), Decimal("5")),
         ("3", "C", d("2020-02-01"), Decimal("-20")), ("4", "C", d("2020-03-01"), Decimal("8"))],
        "transaction_id string, coverage_id string, transaction_date date, premium_change decimal(18,2)",
    )
    got = [float(r.cumulative_premium) for r in rules.running_premium_balance(tx).orderBy("transaction_id").collect()]
    assert got == [10, 15, 0, 3]
    assigned = spark.createDataFrame(
        [("v1", "1", "OCCASIONAL", "d1"), ("v1", "2", "PRIMARY", "d2"), ("v2", "3", "OCCASIONAL", "d3"),
         ("v2", "4", "OCCASIONAL", "d4")],
        "vehicle_id string, assignment_id string, assignment_type string, driver_id string",
    )
    assert {r.vehicle_id: r.driver_id for r in rules.primary_driver(assigned).collect()} == {"v1": "d2", "v2": "d3"}


def test_as_of_must_be_month_end():
    with pytest.raises(ValueError):
        Params(as_of=date(2023, 12, 30))
