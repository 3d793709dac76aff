"""The pricing models as plain SQL: inequality joins, distinct counts, one branch per grain."""

from oracle.tables import AS_OF, END_DAY, FIRST_DAY

SEG = "state_grp, risk_class_grp, vehicle_segment_grp"


def micros(cents: str, part: str, whole: str) -> str:
    """cents * part / whole in millionths, rounded half away from zero."""
    return (
        f"sign({cents})::BIGINT * ((2 * abs({cents}) * ({part}) * 10000 + ({whole})) // nullif(2 * ({whole}), 0))"
    )


def seg(version: str) -> str:
    state, tier, vehicle = {"v1": (1, 1, 0), "v2": (1, 0, 0), "v3": (0, 0, 0)}[version]
    return (
        f"{'state' if state else repr('ALL')} AS state_grp, {'risk_class' if tier else repr('ALL')} AS risk_class_grp, "
        f"{'vehicle_segment' if vehicle else repr('ALL')} AS vehicle_segment_grp"
    )


def grain_branch(grain: str, keys: str, period: str, shown: str, source: str) -> str:
    return f"""
        SELECT '{grain}' AS triangle_grain, {keys}, {period} AS accident_period,
               date_diff('month', {period}, valuation_month) + 1 AS development_age_months,
               max(valuation_date) AS valuation_date, count(DISTINCT claim_id) AS cumulative_reported_claim_count,
               sum(cumulative_paid_loss) AS cumulative_paid_loss, sum(cumulative_case_reserve) AS cumulative_case_reserve,
               sum(cumulative_paid_expense) AS cumulative_paid_expense,
               sum(cumulative_case_expense) AS cumulative_case_expense, sum(cumulative_recovery) AS cumulative_recovery,
               sum(cumulative_incurred_loss) AS cumulative_incurred_loss
        FROM {source} WHERE {shown} AND date_diff('month', {period}, valuation_month) + 1 > 0 GROUP BY ALL"""


def triangle(keys: str, source: str) -> str:
    return " UNION ALL ".join(
        grain_branch(g, keys, p, s, source)
        for g, p, s in [
            ("monthly", "accident_month", "true"),
            ("quarterly", "accident_quarter", "is_quarter_end"),
            ("half_year", "accident_half_year", "is_half_year_end"),
            ("annual", "accident_year", "is_year_end"),
        ]
    )


def pricing_triangle(version: str) -> str:
    return f"""
        SELECT {seg(version)}, year(accident_date)::INTEGER AS accident_year,
               (year(valuation_date) - year(accident_date))::INTEGER AS development,
               (date_diff('month', date_trunc('year', accident_date), valuation_date) + 1)::INTEGER AS age_months,
               valuation_date,
               sum(cumulative_paid) AS cumulative_paid, sum(incurred) AS cumulative_incurred,
               count(DISTINCT claim_id) AS cumulative_claim_count
        FROM x_year_end_snapshot s LEFT JOIN x_priced p ON p.policy_id = s.policy_id GROUP BY ALL"""


def selected(measure: str, suffix: str) -> str:
    return f"""
        SELECT {', '.join('s.' + c for c in SEG.split(', '))}, s.development,
               CASE s.method WHEN 'avg' THEN a.avg_ldf_{suffix} WHEN 'weighted' THEN w.weighted_ldf_{suffix}
                    WHEN 'last3_weighted' THEN l.last3_ldf_{suffix} WHEN 'other' THEN s.ldf END AS selected_ldf_{suffix}
        FROM x_stg_ldf s JOIN x_ldf_avg a USING ({SEG}, development) JOIN x_ldf_weighted w USING ({SEG}, development)
        JOIN x_ldf_last3 l USING ({SEG}, development) WHERE s.triangle_type = '{measure}'"""


def cdf(measure: str, suffix: str) -> str:
    """Plain product over later developments, by self-join."""
    return f"""
        SELECT {', '.join('a.' + c for c in SEG.split(', '))}, a.development, product(b.selected_ldf_{suffix}) AS cdf
        FROM x_selected_{measure} a JOIN x_selected_{measure} b
          ON (a.state_grp, a.risk_class_grp, a.vehicle_segment_grp)
             = (b.state_grp, b.risk_class_grp, b.vehicle_segment_grp) AND b.development >= a.development
        GROUP BY ALL"""


def by_month(measure: str) -> str:
    """The developed share at an age between two year ends lies on the straight line between theirs; at birth it is 0."""
    return f"""
        WITH shares AS (
            SELECT {SEG}, (development + 1) * 12 AS age, 1 / cdf AS share, cdf FROM x_cdf_{measure}
            UNION ALL SELECT DISTINCT {SEG}, 0, 0.0::DOUBLE, NULL::DOUBLE FROM x_cdf_{measure})
        SELECT {SEG}, (a.age + m)::INTEGER AS age_months,
               CASE WHEN m = 12 THEN b.cdf ELSE 1 / (a.share * (12 - m) / 12 + b.share * m / 12) END AS cdf
        FROM shares a JOIN shares b USING ({SEG}), range(1, 13) AS r(m) WHERE b.age = a.age + 12"""


def ultimate(measure: str, column: str, value: str) -> str:
    return f"""
        SELECT {SEG}, t.accident_year, t.{column}::DOUBLE * c.cdf AS {value}
        FROM x_triangle t JOIN x_month_{measure} c USING ({SEG}, age_months)
        WHERE NOT EXISTS (SELECT 1 FROM x_triangle later WHERE later.accident_year = t.accident_year
                          AND (later.state_grp, later.risk_class_grp, later.vehicle_segment_grp)
                              = (t.state_grp, t.risk_class_grp, t.vehicle_segment_grp)
                          AND later.valuation_date > t.valuation_date)"""


STG_SEG = "state AS state_grp, risk_class AS risk_class_grp, vehicle_segment AS vehicle_segment_grp"
MEASURES = [("paid", "cumulative_paid", "paid"), ("incurred", "cumulative_incurred", "incurred"),
            ("claim_count", "cumulative_claim_count", "cnt")]

MODELS = {
    "x_months": f"""
        SELECT m::DATE AS month_start, last_day(m::DATE) AS month_end, (m + INTERVAL 1 MONTH)::DATE AS next_month_start
        FROM range({FIRST_DAY}, {END_DAY}, INTERVAL 1 MONTH) r(m)""",
    "x_valuations": f"""
        SELECT month_end AS valuation_date, month_start AS valuation_month, year(month_start) AS calendar_year,
               quarter(month_start) AS calendar_quarter, month(month_start) AS calendar_month,
               month(month_start) % 3 = 0 AS is_quarter_end, month(month_start) % 6 = 0 AS is_half_year_end,
               month(month_start) = 12 AS is_year_end
        FROM x_months WHERE month_end <= {AS_OF}
          AND month_start >= (SELECT date_trunc('month', min(loss_date)) FROM x_raw_claim)""",
    "x_active": """
        SELECT c.coverage_id, c.policy_id, c.risk_unit_id, p.product_id, p.line_of_business, p.primary_state,
               p.underwriting_tier, r.risk_unit_type, r.exposure_unit, c.coverage_code, c.coverage_family,
               c.effective_date AS coverage_effective_date, c.expiration_date AS scheduled_expiration_date,
               least(c.expiration_date, coalesce(p.cancellation_date, c.expiration_date)) AS actual_expiration_date
        FROM x_raw_policy_coverage c JOIN x_raw_policy p ON p.policy_id = c.policy_id
        JOIN x_raw_policy_risk_unit r ON r.risk_unit_id = c.risk_unit_id""",
    "x_coverage_month": """
        SELECT c.* EXCLUDE (coverage_effective_date, scheduled_expiration_date, actual_expiration_date),
               m.month_start AS calendar_month, greatest(coverage_effective_date, month_start) AS exposure_start,
               least(actual_expiration_date, next_month_start) AS exposure_end,
               least(actual_expiration_date, next_month_start) - greatest(coverage_effective_date, month_start)
                   AS active_days
        FROM x_active c JOIN x_months m
          ON m.month_start < c.actual_expiration_date AND m.next_month_start > c.coverage_effective_date""",
    "x_earned_exposure": """
        SELECT policy_id, risk_unit_id, coverage_id, calendar_month,
               sum(active_days)::BIGINT / 365.25::DOUBLE AS earned_exposure
        FROM x_coverage_month GROUP BY ALL""",
    "x_earning_segments": """
        SELECT t.transaction_id, t.policy_id, t.coverage_id, t.transaction_type,
               t.transaction_date AS earning_start_date, c.expiration_date AS earning_end_date, t.premium_change,
               c.expiration_date - t.transaction_date AS earning_days
        FROM x_raw_premium_transaction t JOIN x_raw_policy_coverage c ON c.coverage_id = t.coverage_id""",
    "x_earned_premium": f"""
        SELECT policy_id, coverage_id, month_start AS calendar_month,
               sum({micros("(premium_change * 100)::BIGINT",
                           "least(earning_end_date, next_month_start) - greatest(earning_start_date, month_start)",
                           "earning_days")})::BIGINT / 1000000.0::DOUBLE AS earned_premium
        FROM x_earning_segments JOIN x_months
          ON month_start < earning_end_date AND next_month_start > earning_start_date
        GROUP BY ALL""",
    "x_fct_exposure": """
        SELECT md5(concat_ws('-', e.risk_unit_id, e.coverage_id, e.calendar_month)) AS exposure_id, e.policy_id,
               e.risk_unit_id, e.coverage_id, e.calendar_month, p.product_id, p.line_of_business, r.risk_unit_type,
               r.exposure_unit, c.coverage_code, c.coverage_family, e.earned_exposure,
               coalesce(pr.earned_premium, 0) AS earned_premium
        FROM x_earned_exposure e
        LEFT JOIN x_earned_premium pr ON pr.coverage_id = e.coverage_id AND pr.calendar_month = e.calendar_month
        JOIN x_raw_policy p ON p.policy_id = e.policy_id
        JOIN x_raw_policy_risk_unit r ON r.risk_unit_id = e.risk_unit_id
        JOIN x_raw_policy_coverage c ON c.coverage_id = e.coverage_id""",
    "x_policy_years": """
        SELECT p.*, y.y AS calendar_year,
               least(expiration_date, coalesce(cancellation_date, expiration_date)) AS ends,
               greatest(least(least(expiration_date, coalesce(cancellation_date, expiration_date)),
                              make_date(y.y, 12::BIGINT, 31::BIGINT))
                        - greatest(effective_date, make_date(y.y, 1::BIGINT, 1::BIGINT)), 0) AS days
        FROM x_priced p CROSS JOIN (
            SELECT unnest(range(year(min(effective_date)), year(max(effective_date)) + 1)) AS y FROM x_priced) y
        WHERE effective_date <= make_date(y.y, 12::BIGINT, 31::BIGINT)
          AND least(expiration_date, coalesce(cancellation_date, expiration_date))
              >= make_date(y.y, 1::BIGINT, 1::BIGINT)""",
    **{
        f"x_policy_exposure_{v}": f"""
        SELECT {seg(v)}, calendar_year::INTEGER AS calendar_year,
               sum((2 * term_months * days * 1000000 + 12 * (ends - effective_date))
                   // nullif(24 * (ends - effective_date), 0))::BIGINT / 1000000.0::DOUBLE AS total_earned_exposure,
               sum({micros("(written_premium * 100)::BIGINT", "days", "(ends - effective_date)")})::BIGINT
                   / 1000000.0::DOUBLE AS total_earned_premium
        FROM x_policy_years GROUP BY ALL"""
        for v in ("v1", "v3")
    },
    "x_events": """
        SELECT claim_id, reported_date AS event_date, 0::DECIMAL(18,2) AS paid_loss_change,
               0::DECIMAL(18,2) AS case_reserve_change, 0::DECIMAL(18,2) AS paid_expense_change,
               0::DECIMAL(18,2) AS case_expense_change, 0::DECIMAL(18,2) AS recovery_change,
               0::DECIMAL(18,2) AS incurred_loss_change, 'REPORTED_ANCHOR' AS event_type FROM x_raw_claim
        UNION ALL
        SELECT claim_id, transaction_date, paid_loss_change, case_reserve_change, paid_expense_change,
               case_expense_change, recovery_change, incurred_loss_change, 'FINANCIAL_TRANSACTION'
        FROM x_raw_claim_transaction""",
    "x_state": f"""
        SELECT *, paid + reserve + paid_exp + case_exp - recov AS calculated,
               lead(event_date) OVER (PARTITION BY claim_id ORDER BY event_date) AS next_date
        FROM (
            SELECT claim_id, event_date, max((event_type = 'REPORTED_ANCHOR')::INTEGER) AS has_reported_anchor,
                   count(*) FILTER (event_type = 'FINANCIAL_TRANSACTION') AS n,
                   sum(paid_loss_change) AS d_paid, sum(case_reserve_change) AS d_reserve,
                   sum(paid_expense_change) AS d_paid_exp, sum(case_expense_change) AS d_case_exp,
                   sum(recovery_change) AS d_recov, sum(incurred_loss_change) AS d_incurred,
                   sum(count(*) FILTER (event_type = 'FINANCIAL_TRANSACTION')) OVER w AS total_n,
                   sum(sum(paid_loss_change)) OVER w AS paid, sum(sum(case_reserve_change)) OVER w AS reserve,
                   sum(sum(paid_expense_change)) OVER w AS paid_exp, sum(sum(case_expense_change)) OVER w AS case_exp,
                   sum(sum(recovery_change)) OVER w AS recov, sum(sum(incurred_loss_change)) OVER w AS incurred
            FROM x_events WHERE event_date <= {AS_OF} GROUP BY claim_id, event_date
            WINDOW w AS (PARTITION BY claim_id ORDER BY event_date))""",
    "x_snapshot": """
        SELECT v.*, c.claim_id, c.policy_id, c.risk_unit_id, c.coverage_id, p.product_id, p.line_of_business,
               k.coverage_code, c.loss_date, c.reported_date, c.claim_type, c.cause_code,
               s.total_n = 0 AS is_reported_only_state, s.total_n > 0 AS has_financial_activity,
               s.total_n::BIGINT AS cumulative_financial_transaction_count, s.paid AS cumulative_paid_loss,
               s.reserve AS cumulative_case_reserve, s.paid_exp AS cumulative_paid_expense,
               s.case_exp AS cumulative_case_expense, s.recov AS cumulative_recovery,
               s.incurred AS cumulative_incurred_loss, s.calculated AS calculated_cumulative_incurred
        FROM x_state s JOIN x_valuations v ON v.valuation_date >= s.event_date
             AND v.valuation_date < coalesce(s.next_date, DATE '9999-12-31')
        JOIN x_raw_claim c ON c.claim_id = s.claim_id JOIN x_raw_policy p ON p.policy_id = c.policy_id
        JOIN x_raw_policy_coverage k ON k.coverage_id = c.coverage_id""",
    "x_development": """
        SELECT *, date_diff('month', accident_month, valuation_month) + 1 AS development_age_monthly,
               date_diff('month', accident_quarter, valuation_month) + 1 AS development_age_quarterly,
               date_diff('month', accident_half_year, valuation_month) + 1 AS development_age_half_year,
               date_diff('month', accident_year, valuation_month) + 1 AS development_age_annual
        FROM (SELECT *, date_trunc('month', loss_date)::DATE AS accident_month,
                     date_trunc('quarter', loss_date)::DATE AS accident_quarter,
                     make_date(year(loss_date), if(month(loss_date) <= 6, 1, 7), 1::BIGINT) AS accident_half_year,
                     date_trunc('year', loss_date)::DATE AS accident_year FROM x_snapshot)""",
    "x_claim_snapshot": """
        SELECT v.valuation_date, v.is_year_end, s.claim_id, c.policy_id, c.loss_date AS accident_date,
               s.event_date AS transaction_date, s.paid AS cumulative_paid, s.reserve AS case_reserve,
               s.incurred AS incurred
        FROM x_state s JOIN x_raw_claim c ON c.claim_id = s.claim_id
        JOIN x_valuations v ON s.event_date <= v.valuation_date
        QUALIFY row_number() OVER (PARTITION BY s.claim_id, v.valuation_date ORDER BY s.event_date DESC) = 1""",
    "x_year_end_snapshot": f"SELECT * FROM x_claim_snapshot WHERE is_year_end OR valuation_date = {AS_OF}",
    "x_loss_triangle": triangle("product_id, line_of_business, coverage_code", "x_development"),
    "x_pooled_development": """
        SELECT d.*, m.development_pool_id, m.pool_level FROM x_development d
        JOIN x_development_pool_mapping m ON (m.line_of_business, m.product_id, m.coverage_code)
             = (d.line_of_business, d.product_id, d.coverage_code)""",
    "x_pooled": triangle("development_pool_id, pool_level, line_of_business", "x_pooled_development"),
    "x_triangle": pricing_triangle("v3"),
    "x_triangle_v1": pricing_triangle("v1"),
    "x_triangle_versions": " UNION ALL ".join(
        f"SELECT '{v}' AS segmentation_version, * FROM ({pricing_triangle(v)})" for v in ("v1", "v2", "v3")
    ),
    "x_state_period": """
        SELECT claim_id, event_date AS valid_from_date, coalesce(next_date, DATE '9999-12-31') AS valid_to_date
        FROM x_state""",
    "x_stg_ldf": f"""
        SELECT segmentation_version, triangle_type, {STG_SEG}, development, ldf, method, description
        FROM x_ldf_selection_table WHERE segmentation_version = 'v3'""",
    "x_stg_trend": f"""
        SELECT segmentation_version, trend_type, {STG_SEG}, annual_trend, effective_from, effective_to, description
        FROM x_trend_selection WHERE segmentation_version = 'v3'""",
    **{
        f"x_stg_selected_{k}": f"""
        SELECT segmentation_version, {STG_SEG}, accident_year, ultimate AS ultimate_{k}, method, comment
        FROM x_selected_ultimate WHERE type = '{k}' AND segmentation_version = 'v3'"""
        for k in ("loss", "claim_count")
    },
    **{
        f"x_stg_selection_{k}": f"""
        SELECT segmentation_version, {STG_SEG}, accident_year, method AS selected_method, comment
        FROM x_ultimate_selection WHERE type = '{k}' AND segmentation_version = 'v3'"""
        for k in ("loss", "claim_count")
    },
    # cells valued when an accident year is 12, 24, ... months old; ratios compare whole years only
    "x_year_ends": "SELECT * FROM x_triangle WHERE age_months IN (SELECT unnest(range(12, 1200, 12)))",
    "x_ldf_raw": f"""
        SELECT {SEG}, accident_year, development,
               lead(cumulative_paid) OVER w::DOUBLE / nullif(cumulative_paid, 0)::DOUBLE AS link_ratio_paid,
               lead(cumulative_incurred) OVER w::DOUBLE / nullif(cumulative_incurred, 0)::DOUBLE AS link_ratio_incurred,
               lead(cumulative_claim_count) OVER w::DOUBLE / nullif(cumulative_claim_count, 0)::DOUBLE AS link_ratio_cnt
        FROM x_year_ends WINDOW w AS (PARTITION BY {SEG}, accident_year ORDER BY development)""",
    "x_ldf_avg": f"""
        SELECT {SEG}, development, coalesce(avg(link_ratio_paid), 1) AS avg_ldf_paid,
               coalesce(avg(link_ratio_incurred), 1) AS avg_ldf_incurred, coalesce(avg(link_ratio_cnt), 1) AS avg_ldf_cnt
        FROM x_ldf_raw GROUP BY ALL""",
    "x_pairs": f"""
        SELECT {SEG}, a.accident_year, a.development, a.cumulative_paid AS p0, b.cumulative_paid AS p1,
               a.cumulative_incurred AS i0, b.cumulative_incurred AS i1, a.cumulative_claim_count AS n0,
               b.cumulative_claim_count AS n1
        FROM x_year_ends a JOIN x_year_ends b USING ({SEG}, accident_year) WHERE b.age_months = a.age_months + 12""",
    "x_ldf_weighted": f"""
        SELECT {SEG}, development, coalesce(sum(p1)::DOUBLE / nullif(sum(p0), 0)::DOUBLE, 1) AS weighted_ldf_paid,
               coalesce(sum(i1)::DOUBLE / nullif(sum(i0), 0)::DOUBLE, 1) AS weighted_ldf_incurred,
               coalesce(sum(n1)::DOUBLE / nullif(sum(n0), 0)::DOUBLE, 1) AS weighted_ldf_cnt
        FROM x_pairs GROUP BY ALL""",
    "x_ldf_last3": f"""
        SELECT {SEG}, d.development,
               CASE WHEN k = 3 THEN coalesce(lp, 1) ELSE 1 END AS last3_ldf_paid,
               CASE WHEN k = 3 THEN coalesce(li, 1) ELSE 1 END AS last3_ldf_incurred,
               CASE WHEN k = 3 THEN coalesce(ln, 1) ELSE 1 END AS last3_ldf_cnt
        FROM (SELECT DISTINCT {SEG}, development FROM x_year_ends) d
        LEFT JOIN (SELECT {SEG}, development, count(*) AS k, sum(p1)::DOUBLE / nullif(sum(p0), 0)::DOUBLE AS lp,
                          sum(i1)::DOUBLE / nullif(sum(i0), 0)::DOUBLE AS li,
                          sum(n1)::DOUBLE / nullif(sum(n0), 0)::DOUBLE AS ln
                   FROM (SELECT * FROM x_pairs QUALIFY row_number() OVER
                         (PARTITION BY {SEG}, development ORDER BY accident_year DESC) <= 3) GROUP BY ALL) a
          USING ({SEG}, development)""",
    **{f"x_selected_{m}": selected(m, s) for m, _, s in MEASURES},
    **{f"x_cdf_{m}": cdf(m, s) for m, _, s in MEASURES},
    **{f"x_month_{m}": by_month(m) for m, _, _ in MEASURES},
    **{
        f"x_ultimate_{m}": ultimate(m, c, "ultimate_claim_count" if m == "claim_count" else "ultimate_loss")
        for m, c, _ in MEASURES
    },
    "x_fct_ultimate_loss": f"""
        SELECT {SEG}, accident_year, 'Chain_ladder_incurred' AS method, ultimate_loss FROM x_ultimate_incurred
        UNION ALL SELECT {SEG}, accident_year, 'Chain_ladder_paid', ultimate_loss FROM x_ultimate_paid
        UNION ALL SELECT {SEG}, accident_year, method, ultimate_loss FROM x_stg_selected_loss""",
    "x_fct_ultimate_count": f"""
        SELECT {SEG}, accident_year, 'Chain_ladder' AS method, ultimate_claim_count FROM x_ultimate_claim_count
        UNION ALL SELECT {SEG}, accident_year, method, ultimate_claim_count FROM x_stg_selected_claim_count""",
    "x_fct_selected_loss": f"""
        SELECT s.segmentation_version, {SEG}, accident_year, c.ultimate_loss, s.selected_method AS method, s.comment
        FROM x_stg_selection_loss s JOIN x_fct_ultimate_loss c USING ({SEG}, accident_year)
        WHERE c.method = s.selected_method""",
    "x_fct_selected_count": f"""
        SELECT s.segmentation_version, {SEG}, accident_year, c.ultimate_claim_count, s.selected_method AS method,
               s.comment
        FROM x_stg_selection_claim_count s JOIN x_fct_ultimate_count c USING ({SEG}, accident_year)
        WHERE c.method = s.selected_method""",
    "x_freq_sev": f"""
        SELECT c.state_grp, c.risk_class_grp, c.vehicle_segment_grp, c.accident_year, c.method AS claim_count_method,
               l.method AS loss_method, e.total_earned_exposure,
               c.ultimate_claim_count / nullif(e.total_earned_exposure, 0) AS frequency,
               l.ultimate_loss / nullif(c.ultimate_claim_count, 0) AS severity
        FROM x_fct_selected_count c JOIN x_fct_selected_loss l USING ({SEG}, accident_year)
        LEFT JOIN x_policy_exposure_v3 e ON (e.state_grp, e.risk_class_grp, e.vehicle_segment_grp, e.calendar_year)
             = (c.state_grp, c.risk_class_grp, c.vehicle_segment_grp, c.accident_year)""",
    "x_trend_mid": """
        SELECT *, effective_from + round((effective_to - effective_from) / 2.0)::INTEGER + 182 AS mid FROM x_stg_trend""",
    "x_trended": f"""
        SELECT {SEG}, accident_year, total_earned_exposure,
               frequency * power(1 + coalesce(f.annual_trend, 0), greatest(coalesce(
                   year(f.mid) + dayofyear(f.mid) / 365.25::DOUBLE - (accident_year + 0.5::DOUBLE), 0), 0))
                   AS trended_frequency,
               severity * power(1 + coalesce(s.annual_trend, 0), greatest(coalesce(
                   year(s.mid) + dayofyear(s.mid) / 365.25::DOUBLE - (accident_year + 0.5::DOUBLE), 0), 0))
                   AS trended_severity
        FROM x_freq_sev
        LEFT JOIN (SELECT {SEG}, annual_trend, mid FROM x_trend_mid WHERE trend_type = 'frequency') f USING ({SEG})
        LEFT JOIN (SELECT {SEG}, annual_trend, mid FROM x_trend_mid WHERE trend_type = 'severity') s USING ({SEG})""",
    "x_indicated": f"""
        SELECT {SEG}, (pp * (1 + ulae_ratio) + fixed_expense_per_exposure)
                      / (1 - variable_expense_ratio - profit_ratio) AS indicated_premium
        FROM (SELECT {SEG}, sum(trended_frequency * trended_severity * total_earned_exposure)
                            / nullif(sum(total_earned_exposure), 0) AS pp FROM x_trended GROUP BY ALL)
        JOIN x_expense_assumption e ON e.state = state_grp""",
    "x_auto_attributes": """
        WITH d AS (
            SELECT e.exposure_id, v.*, a.date_of_birth, a.prior_accidents, a.prior_violations, a.credit_tier,
                   year(p.effective_date) - year(a.date_of_birth)
                     - (strftime(p.effective_date, '%m%d') < strftime(a.date_of_birth, '%m%d'))::INTEGER AS age,
                   CASE WHEN v.model_year IS NOT NULL THEN greatest(year(p.effective_date) - v.model_year, 0) END AS vehicle_age
            FROM x_fct_exposure e JOIN x_raw_policy p ON p.policy_id = e.policy_id
            JOIN x_raw_policy_risk_unit r ON r.risk_unit_id = e.risk_unit_id AND r.risk_unit_type = 'vehicle'
            JOIN x_raw_vehicle v ON v.vehicle_id = r.source_risk_unit_id
            JOIN x_raw_driver_vehicle_assignment g ON g.vehicle_id = v.vehicle_id AND g.policy_id = e.policy_id
                 AND g.assignment_type = 'PRIMARY'
            JOIN x_raw_driver a ON a.driver_id = g.driver_id
            WHERE e.line_of_business = 'personal_auto')
        SELECT exposure_id, 'RF_STATE' AS factor_id, NULL::DOUBLE AS value_numeric, garaging_state AS value_string FROM d
        UNION ALL SELECT exposure_id, 'RF_DRIVER_AGE', age, NULL FROM d
        UNION ALL SELECT exposure_id, 'RF_PRIOR_ACCIDENTS', prior_accidents, NULL FROM d
        UNION ALL SELECT exposure_id, 'RF_PRIOR_VIOLATIONS', prior_violations, NULL FROM d
        UNION ALL SELECT exposure_id, 'RF_CREDIT_TIER', NULL, credit_tier FROM d
        UNION ALL SELECT exposure_id, 'RF_VEHICLE_AGE', vehicle_age, NULL FROM d
        UNION ALL SELECT exposure_id, 'RF_VEHICLE_TYPE', NULL, vehicle_type FROM d
        UNION ALL SELECT exposure_id, 'RF_ANNUAL_MILEAGE', annual_mileage, NULL FROM d
        UNION ALL SELECT exposure_id, 'RF_USAGE', NULL, usage FROM d""",
    "x_property_attributes": """
        WITH d AS (
            SELECT e.exposure_id, l.*, CASE WHEN l.year_built IS NOT NULL THEN greatest(year(p.effective_date) - l.year_built, 0) END AS building_age
            FROM x_fct_exposure e JOIN x_raw_policy p ON p.policy_id = e.policy_id
            JOIN x_raw_policy_risk_unit r ON r.risk_unit_id = e.risk_unit_id
                 AND r.risk_unit_type = 'property_location'
            JOIN x_raw_property_location l ON l.location_id = r.source_risk_unit_id
            WHERE e.line_of_business = 'commercial_property')
        SELECT exposure_id, 'RF_STATE' AS factor_id, NULL::DOUBLE AS value_numeric, state AS value_string FROM d
        UNION ALL SELECT exposure_id, 'RF_OCCUPANCY', NULL, occupancy FROM d
        UNION ALL SELECT exposure_id, 'RF_CONSTRUCTION_TYPE', NULL, construction_type FROM d
        UNION ALL SELECT exposure_id, 'RF_BUILDING_AGE', building_age, NULL FROM d
        UNION ALL SELECT exposure_id, 'RF_PROTECTION_CLASS', protection_class, NULL FROM d
        UNION ALL SELECT exposure_id, 'RF_TIV', round(total_insured_value)::DOUBLE, NULL FROM d""",
    "x_attributes": "SELECT * FROM x_auto_attributes UNION ALL SELECT * FROM x_property_attributes",
    "x_model_version": """
        SELECT product_id || '_v1' AS model_version_id, product_id, line_of_business, 1 AS version_number,
               min(effective_date) AS effective_start_date, max(expiration_date) AS effective_end_date,
               'active' AS status
        FROM x_raw_policy GROUP BY product_id, line_of_business""",
    "x_control_totals": f"""
        WITH latest AS (SELECT max(valuation_date) AS d FROM x_year_end_snapshot),
        m AS (
            SELECT 'written_premium_to_earned_premium_total' AS metric_name,
                   (SELECT sum(written_premium)::DOUBLE FROM x_priced) AS source_value,
                   (SELECT sum((total_earned_premium * 1000000)::BIGINT)::BIGINT / 1000000.0::DOUBLE
                    FROM x_policy_exposure_v3) AS target_value
            UNION ALL SELECT 'written_exposure_to_earned_exposure_total',
                   (SELECT sum(term_months)::BIGINT / 12.0::DOUBLE FROM x_priced),
                   (SELECT sum((total_earned_exposure * 1000000)::BIGINT)::BIGINT / 1000000.0::DOUBLE
                    FROM x_policy_exposure_v3)
            UNION ALL SELECT 'latest_cumulative_paid_total',
                   (SELECT sum(cumulative_paid)::DOUBLE FROM x_year_end_snapshot, latest WHERE valuation_date = d),
                   (SELECT sum(cumulative_paid)::DOUBLE FROM x_triangle, latest WHERE valuation_date = d)
            UNION ALL SELECT 'latest_cumulative_incurred_total',
                   (SELECT sum(incurred)::DOUBLE FROM x_year_end_snapshot, latest WHERE valuation_date = d),
                   (SELECT sum(cumulative_incurred)::DOUBLE FROM x_triangle, latest WHERE valuation_date = d)
            UNION ALL SELECT 'latest_claim_count_total',
                   (SELECT count(DISTINCT claim_id)::DOUBLE FROM x_year_end_snapshot, latest WHERE valuation_date = d),
                   (SELECT sum(cumulative_claim_count)::DOUBLE FROM x_triangle, latest WHERE valuation_date = d))
        SELECT metric_name, source_value, target_value, target_value - source_value AS absolute_difference,
               (target_value - source_value) / nullif(abs(source_value), 0) AS percentage_difference FROM m""",
    "x_assumption_impact": f"""
        SELECT {SEG}, accident_year, l.method AS selected_loss_method, c.method AS selected_claim_count_method,
               l.ultimate_loss AS selected_ultimate_loss, bl.ultimate_loss AS chain_ladder_ultimate_loss,
               l.ultimate_loss - bl.ultimate_loss AS loss_method_impact,
               c.ultimate_claim_count AS selected_ultimate_claim_count,
               bc.ultimate_claim_count AS chain_ladder_ultimate_claim_count,
               c.ultimate_claim_count - bc.ultimate_claim_count AS claim_count_method_impact,
               tf.annual_trend AS selected_frequency_trend, ts.annual_trend AS selected_severity_trend
        FROM x_fct_selected_loss l FULL JOIN x_fct_selected_count c USING ({SEG}, accident_year)
        LEFT JOIN (SELECT * FROM x_fct_ultimate_loss WHERE method = 'Chain_ladder_incurred') bl
          USING ({SEG}, accident_year)
        LEFT JOIN (SELECT * FROM x_fct_ultimate_count WHERE method = 'Chain_ladder') bc USING ({SEG}, accident_year)
        LEFT JOIN (SELECT {SEG}, annual_trend FROM x_stg_trend WHERE trend_type = 'frequency') tf USING ({SEG})
        LEFT JOIN (SELECT {SEG}, annual_trend FROM x_stg_trend WHERE trend_type = 'severity') ts USING ({SEG})""",
    "x_latest": f"""
        SELECT * FROM x_triangle
        QUALIFY row_number() OVER (PARTITION BY {SEG}, accident_year ORDER BY age_months DESC) = 1""",
}
