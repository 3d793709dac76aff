"""The expected result of every query as one SQL statement."""

from __future__ import annotations

import re

from oracle.compose import compose
from oracle.models import MEASURES, MODELS, SEG, STG_SEG
from oracle.tables import AS_OF, TABLES
from ratewright.operators import contracts
from ratewright.operators.quality import CONTRACT, UNIQUE_COMBINATIONS
from ratewright.operators.triangle import STEP_MONTHS
from ratewright.plans.perturb import CONTESTED, FAULTS, PERTURBED
from ratewright.plans.present import digits

PARTS = {**TABLES, **MODELS}
for _t, (_replaced, _twice) in PERTURBED.items():
    _own = "x_state_period" if _t == "claim_financial_state_period" else f"x_{_t}"
    _swaps = ", ".join(f"{e} AS {c}" for c, e in _replaced.items())
    PARTS[f"x_bent_{_t}"] = f"SELECT * REPLACE ({_swaps}) FROM {_own}"
    PARTS[f"x_broken_{_t}"] = f"SELECT * FROM x_bent_{_t}" + (
        f" UNION ALL SELECT * FROM x_bent_{_t} WHERE {_twice}" if _twice else ""
    )
CELLS = (
    "cumulative_paid_loss cumulative_case_reserve cumulative_paid_expense cumulative_case_expense "
    "cumulative_recovery cumulative_incurred_loss"
)
CHANGES = (
    "paid_loss_change case_reserve_change paid_expense_change case_expense_change recovery_change incurred_loss_change"
)


def q(sql: str, dates: str = "", numbers: str = "", times: str = "") -> str:
    """Wrap a statement: dates as ISO text, listed numbers as rounded doubles."""
    swaps = [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in dates.split()]
    swaps += [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in times.split()]
    swaps += [
        f"round_even(CAST({c} AS DOUBLE) * 1e{digits(c)}, 0) / 1e{digits(c)} AS {c}" for c in numbers.split()
    ]
    replaced = f" REPLACE ({', '.join(swaps)})" if swaps else ""
    return compose(PARTS, f"SELECT *{replaced} FROM ({sql}) result")


AUDIT = "EXCLUDE (load_batch_id, ingested_at)"
TERM = "effective_date expiration_date"
LDF = {m: s for m, _, s in MEASURES}
POLICY_DATES = "effective_date expiration_date cancellation_date"
TRIANGLE = (f"SELECT * FROM x_triangle", "valuation_date", "cumulative_paid cumulative_incurred")
LOSS_TRIANGLE_DATES = "accident_period valuation_date"

ORACLE: dict[str, str] = {}


_GIVEN: dict[str, tuple[str, str, str, str]] = {}


def add(name: str, sql: str, dates: str = "", numbers: str = "", times: str = "") -> None:
    ORACLE[name] = q(sql, dates, numbers, times)
    _GIVEN[name] = (sql, dates, numbers, times)


# ---- sources and sinks
add(
    "read_raw_table",
    """SELECT claim_id::VARCHAR AS claim_id, policy_id::VARCHAR AS policy_id, risk_unit_id::VARCHAR AS risk_unit_id,
       coverage_id::VARCHAR AS coverage_id, * EXCLUDE (claim_id, policy_id, risk_unit_id, coverage_id)
       FROM x_raw_claim""",
    "loss_date reported_date", times="ingested_at",
)
add("read_assumption_table", "SELECT * FROM x_ldf_selection_table", numbers="ldf")
add("read_governance_table", "SELECT * FROM x_assumption_version", times="uploaded_at")
add("stamp_load_metadata", "SELECT load_batch_id, ingested_at, count(*) AS row_count FROM x_raw_policy GROUP BY ALL",
    times="ingested_at")
add("overwrite_table",
    "SELECT 'raw_claim' AS table_name, count(*) AS rows_written, count(*) AS rows_read FROM x_raw_claim")
add("append_table", """SELECT transaction_type, count(*) AS row_count, sum(premium_change) AS premium_change
    FROM x_raw_premium_transaction GROUP BY ALL""", numbers="premium_change")
add(
    "csv_table",
    """SELECT coverage_id::VARCHAR AS coverage_id, policy_id::VARCHAR AS policy_id,
       risk_unit_id::VARCHAR AS risk_unit_id, * EXCLUDE (coverage_id, policy_id, risk_unit_id)
       FROM x_raw_policy_coverage""",
    TERM, "limit_amount deductible_amount written_premium", "ingested_at",
)
ORACLE["upper_case_headers"] = compose(
    PARTS,
    """SELECT driver_id AS "DRIVER_ID", policy_id AS "POLICY_ID", driver_sequence AS "DRIVER_SEQUENCE",
       strftime(date_of_birth, '%Y-%m-%d') AS "DATE_OF_BIRTH", gender AS "GENDER", years_licensed AS "YEARS_LICENSED",
       prior_accidents AS "PRIOR_ACCIDENTS", prior_violations AS "PRIOR_VIOLATIONS",
       marital_status AS "MARITAL_STATUS", credit_tier AS "CREDIT_TIER", source_system AS "SOURCE_SYSTEM"
       FROM x_raw_driver""",
)
add("concat_with_schema", """
    SELECT vehicle_id, NULL::BIGINT AS location_id, policy_id, model_year, NULL::INTEGER AS year_built, usage,
           NULL::VARCHAR AS occupancy FROM x_raw_vehicle
    UNION ALL
    SELECT NULL, location_id, policy_id, NULL, year_built, NULL, occupancy FROM x_raw_property_location""")

# ---- staging
add("stg_policy", f"SELECT * {AUDIT} RENAME (status AS policy_status) FROM x_raw_policy", POLICY_DATES)
add("stg_policy_risk_unit", f"SELECT * {AUDIT} RENAME (status AS policy_risk_unit_status) FROM x_raw_policy_risk_unit",
    TERM)
add("stg_policy_coverage", f"SELECT * {AUDIT} FROM x_raw_policy_coverage", TERM,
    "limit_amount deductible_amount written_premium")
add("stg_premium_transaction", f"SELECT * {AUDIT} FROM x_raw_premium_transaction", "transaction_date",
    "premium_change cumulative_premium")
add("stg_claim", f"SELECT * {AUDIT} FROM x_raw_claim", "loss_date reported_date")
add("stg_claim_transaction", f"SELECT * {AUDIT} FROM x_raw_claim_transaction", "transaction_date", CHANGES)
add("stg_vehicle", f"SELECT * {AUDIT} FROM x_raw_vehicle")
add("stg_driver", f"SELECT * {AUDIT} FROM x_raw_driver", "date_of_birth")
add("stg_driver_vehicle_assignment", f"SELECT * {AUDIT} FROM x_raw_driver_vehicle_assignment", TERM)
add("stg_property_location", f"SELECT * {AUDIT} FROM x_raw_property_location", numbers="total_insured_value")
add("stg_ldf_selection_table", "SELECT * FROM x_stg_ldf", numbers="ldf")
for _k, _value in (("loss", "ultimate_loss"), ("claim_count", "ultimate_claim_count")):
    add(f"stg_selected_ultimate_{_k}", f"SELECT * FROM x_stg_selected_{_k}", numbers=_value)
    add(f"stg_ultimate_selection_{_k}", f"SELECT * FROM x_stg_selection_{_k}")
add("stg_trend_selection", "SELECT * FROM x_stg_trend", "effective_from effective_to", "annual_trend")
add("stg_expense_assumption", "SELECT * RENAME (state AS state_grp) FROM x_expense_assumption",
    numbers="fixed_expense_per_exposure variable_expense_ratio ulae_ratio profit_ratio target_loss_ratio")
add("stg_rate_level_history",
    f"""SELECT filing_id, effective_date, {STG_SEG}, rate_change_pct, cumulative_factor FROM x_rate_level_history""",
    "effective_date", "rate_change_pct cumulative_factor")
add("stg_assumption_version", "SELECT * FROM x_assumption_version", times="uploaded_at")
add("stg_pipeline_run_metadata", """
    SELECT 'meta-' || assumption_set_id AS pipeline_run_metadata_id, dag_id, dag_run_id, task_id, assumption_set_id,
           assumption_type, file_name, version_sequence, version_label, uploaded_at AS registered_at
    FROM x_assumption_version""", times="registered_at")

# ---- calendar and parameters
_EDGES = "(SELECT min(effective_date) AS lo, max(effective_date) AS hi FROM x_raw_policy)"
_DAYS = f"""(SELECT unnest(generate_series(make_date(year(lo) - 1, 1::BIGINT, 1::BIGINT)::TIMESTAMP,
    make_date(year(hi) + 3, 1::BIGINT, 1::BIGINT) - INTERVAL 1 DAY, INTERVAL 1 DAY))::DATE AS d FROM {_EDGES})"""
add("dim_date", f"""
    SELECT d AS date_day, year(d) AS calendar_year, quarter(d) AS calendar_quarter, month(d) AS calendar_month,
           day(d) AS calendar_day, date_trunc('month', d)::DATE AS month_start,
           date_trunc('quarter', d)::DATE AS quarter_start, date_trunc('year', d)::DATE AS year_start,
           if(month(d) <= 6, 1, 2) AS half_year FROM {_DAYS}""",
    "date_day month_start quarter_start year_start")
add("dim_calendar_month", f"""
    SELECT DISTINCT date_trunc('month', d)::DATE AS month_start, last_day(d) AS month_end,
           (date_trunc('month', d) + INTERVAL 1 MONTH)::DATE AS next_month_start, year(d) AS calendar_year,
           month(d) AS calendar_month, quarter(d) AS calendar_quarter, month(d) IN (3, 6, 9, 12) AS is_quarter_end,
           month(d) IN (6, 12) AS is_half_year_end, month(d) = 12 AS is_year_end FROM {_DAYS}""",
    "month_start month_end next_month_start")
add("valuation_dates", "SELECT * FROM x_valuations", "valuation_date valuation_month")
add("generate_years", f"SELECT DISTINCT year(d) AS calendar_year FROM {_DAYS}, {_EDGES} e WHERE d BETWEEN lo AND hi")
_SEGMENTS = """
    SELECT segmentation_version, if(use_state = 1, state, 'ALL') AS state_grp,
           if(use_risk_class = 1, risk_class, 'ALL') AS risk_class_grp,
           if(use_vehicle_segment = 1, vehicle_segment, 'ALL') AS vehicle_segment_grp, count(*) AS policies
    FROM x_priced, x_config GROUP BY ALL"""
add("segmentation_grouping", _SEGMENTS)
add("actual_end_date", """SELECT policy_id, if(cancellation_date < expiration_date, cancellation_date, expiration_date)
    AS actual_end_date FROM x_raw_policy""", "actual_end_date")

# ---- core
add("dim_policy", f"SELECT * EXCLUDE (load_batch_id, ingested_at, term_months) RENAME (status AS policy_status) "
    "FROM x_raw_policy", POLICY_DATES)
add("dim_risk_unit", f"SELECT * {AUDIT} RENAME (status AS policy_risk_unit_status) FROM x_raw_policy_risk_unit", TERM)
add("dim_coverage", "SELECT * EXCLUDE (load_batch_id, ingested_at, written_premium) FROM x_raw_policy_coverage", TERM,
    "limit_amount deductible_amount")
add("fct_claim", "SELECT * EXCLUDE (load_batch_id, ingested_at, coverage_code) FROM x_raw_claim",
    "loss_date reported_date")
add("fct_claim_transaction", f"SELECT * {AUDIT} FROM x_raw_claim_transaction", "transaction_date", CHANGES)
add("fct_premium_transaction", f"SELECT * {AUDIT} RENAME (cumulative_premium AS source_cumulative_premium) "
    "FROM x_raw_premium_transaction", "transaction_date", "premium_change source_cumulative_premium")
add("fct_exposure", "SELECT * FROM x_fct_exposure", "calendar_month", "earned_exposure earned_premium")
add("surrogate_key", """SELECT coverage_id, calendar_month,
    md5(risk_unit_id || '-' || coverage_id || '-' || strftime(calendar_month, '%Y-%m-%d')) AS exposure_id
    FROM x_earned_exposure""", "calendar_month")

# ---- exposure
_ACTIVE = "coverage_effective_date scheduled_expiration_date actual_expiration_date"
add("coverage_active_period", "SELECT * FROM x_active", _ACTIVE)
add("coverage_active_period_within_parents", """
    SELECT a.* REPLACE (
        greatest(a.coverage_effective_date, p.effective_date, r.effective_date) AS coverage_effective_date,
        least(a.actual_expiration_date, p.expiration_date, r.expiration_date) AS actual_expiration_date)
    FROM x_active a JOIN x_raw_policy p ON p.policy_id = a.policy_id
    JOIN x_raw_policy_risk_unit r ON r.risk_unit_id = a.risk_unit_id""", _ACTIVE)
add("coverage_month", "SELECT * FROM x_coverage_month", "calendar_month exposure_start exposure_end")
add("earned_exposure_month", "SELECT * FROM x_earned_exposure", "calendar_month", "earned_exposure")
add("premium_earning_segments", "SELECT * FROM x_earning_segments", "earning_start_date earning_end_date",
    "premium_change")
add("earned_premium_month", "SELECT * FROM x_earned_premium", "calendar_month", "earned_premium")
add("priced_policy", "SELECT * FROM x_priced", POLICY_DATES, "written_premium")
for _v, _name in (("v3", "policy_exposure"), ("v1", "policy_exposure_v1")):
    add(_name, f"SELECT * FROM x_policy_exposure_{_v}", numbers="total_earned_exposure total_earned_premium")

# ---- claims
add("claim_financial_events", "SELECT * FROM x_events", "event_date", CHANGES)
_CUM = """paid AS cumulative_paid_loss, reserve AS cumulative_case_reserve, paid_exp AS cumulative_paid_expense,
    case_exp AS cumulative_case_expense, recov AS cumulative_recovery, incurred AS cumulative_incurred_loss,
    calculated AS calculated_cumulative_incurred"""
_CUM_COLUMNS = f"{CELLS} calculated_cumulative_incurred"
add("claim_financial_state_cumulative", f"""
    SELECT claim_id, event_date, has_reported_anchor, n AS financial_transaction_count,
           total_n::BIGINT AS cumulative_financial_transaction_count, d_paid AS paid_loss_change,
           d_reserve AS case_reserve_change, d_paid_exp AS paid_expense_change, d_case_exp AS case_expense_change,
           d_recov AS recovery_change, d_incurred AS incurred_loss_change, {_CUM}, total_n > 0 AS has_financial_activity
    FROM x_state""", "event_date", f"{CHANGES} {_CUM_COLUMNS}")
add("claim_financial_state_period", f"""
    SELECT claim_id, event_date AS valid_from_date, coalesce(next_date, DATE '9999-12-31') AS valid_to_date,
           next_date IS NULL AS is_current_state, total_n::BIGINT AS cumulative_financial_transaction_count,
           total_n = 0 AS is_reported_only_state, total_n > 0 AS has_financial_activity, {_CUM}
    FROM x_state""", "valid_from_date valid_to_date", _CUM_COLUMNS)
_SNAP_DATES = "valuation_date valuation_month loss_date reported_date"
add("claim_valuation_snapshot", "SELECT * FROM x_snapshot", _SNAP_DATES, _CUM_COLUMNS)
add("claim_development", "SELECT * FROM x_development",
    f"{_SNAP_DATES} accident_month accident_quarter accident_half_year accident_year", _CUM_COLUMNS)
add("claim_snapshot", "SELECT * EXCLUDE (is_year_end) FROM x_claim_snapshot",
    "valuation_date accident_date transaction_date", "cumulative_paid case_reserve incurred")

# ---- features
add("auto_exposure_attributes", "SELECT * FROM x_auto_attributes", numbers="value_numeric")
add("property_exposure_attributes", "SELECT * FROM x_property_attributes", numbers="value_numeric")
add("fct_exposure_attribute", "SELECT * FROM x_attributes", numbers="value_numeric")
add("dim_rating_factor", """
    SELECT factor_id, lower(replace(factor_id, 'RF_', '')) AS factor_name, 'exposure' AS entity_level,
           if(count(value_numeric) > 0, 'numeric', 'string') AS data_type, 'factor ' || factor_id AS description
    FROM x_attributes GROUP BY factor_id""")
add("dim_model_version", "SELECT * FROM x_model_version", "effective_start_date effective_end_date")
add("dim_bridge_model_version_factor", """
    SELECT DISTINCT m.model_version_id, f.factor_id, 'identity' AS transformation_id, 1 AS required_flag
    FROM (SELECT factor_id, 'personal_auto' AS lob FROM x_auto_attributes
          UNION ALL SELECT factor_id, 'commercial_property' FROM x_property_attributes) f
    JOIN x_model_version m ON m.line_of_business = f.lob""")

# ---- triangles
for _name in ("loss_triangle", "loss_triangle_from_snapshot"):
    add(_name, "SELECT * FROM x_loss_triangle", LOSS_TRIANGLE_DATES, CELLS)
for _grain in STEP_MONTHS:
    add(f"loss_triangle_{_grain}", f"SELECT * FROM x_loss_triangle WHERE triangle_grain = '{_grain}'",
        LOSS_TRIANGLE_DATES, CELLS)
add("loss_triangle_pooled", "SELECT * FROM x_pooled", LOSS_TRIANGLE_DATES, CELLS)
add("ldf_observations", """
    SELECT triangle_grain, product_id, line_of_business, coverage_code, accident_period,
           development_age_months AS development_age_from, age_to AS development_age_to,
           paid AS paid_loss_from, paid_to AS paid_loss_to,
           CASE WHEN paid > 0 THEN paid_to::DOUBLE / paid::DOUBLE END AS paid_link_ratio,
           spent AS paid_and_expense_loss_from, spent_to AS paid_and_expense_loss_to,
           CASE WHEN spent > 0 THEN spent_to::DOUBLE / spent::DOUBLE END AS paid_and_expense_link_ratio,
           incurred AS incurred_loss_from, incurred_to AS incurred_loss_to,
           CASE WHEN incurred > 0 THEN incurred_to::DOUBLE / incurred::DOUBLE END AS incurred_link_ratio,
           reported AS reported_claim_count_from, reported_to AS reported_claim_count_to,
           CASE WHEN reported > 0 THEN reported_to / reported::DOUBLE END AS reported_count_link_ratio
    FROM (
        SELECT *, lead(development_age_months) OVER w AS age_to, lead(paid) OVER w AS paid_to,
               lead(spent) OVER w AS spent_to, lead(incurred) OVER w AS incurred_to, lead(reported) OVER w AS reported_to
        FROM (SELECT triangle_grain, product_id, line_of_business, coverage_code, accident_period, development_age_months,
                     cumulative_paid_loss AS paid, cumulative_paid_loss + cumulative_paid_expense AS spent,
                     cumulative_incurred_loss AS incurred, cumulative_reported_claim_count AS reported
              FROM x_loss_triangle)
        WINDOW w AS (PARTITION BY triangle_grain, product_id, line_of_business, coverage_code, accident_period
                     ORDER BY development_age_months))
    WHERE age_to = development_age_months
        + CASE triangle_grain WHEN 'monthly' THEN 1 WHEN 'quarterly' THEN 3 WHEN 'half_year' THEN 6 ELSE 12 END""",
    "accident_period",
    "paid_loss_from paid_loss_to paid_link_ratio paid_and_expense_loss_from paid_and_expense_loss_to "
    "paid_and_expense_link_ratio incurred_loss_from incurred_loss_to incurred_link_ratio reported_count_link_ratio")
for _name in ("claim_triangle_cumulative", "claim_triangle_from_snapshot"):
    add(_name, *TRIANGLE)
add("claim_triangle_cumulative_v1", "SELECT * FROM x_triangle_v1", *TRIANGLE[1:])
add("claim_triangle_versions", "SELECT * FROM x_triangle_versions", *TRIANGLE[1:])
add("claim_triangle_incremental", f"""
    SELECT {SEG}, accident_year, development, cumulative_paid - lag(cumulative_paid) OVER w AS incremental_paid,
           cumulative_incurred - lag(cumulative_incurred) OVER w AS incremental_incurred,
           cumulative_claim_count - lag(cumulative_claim_count) OVER w AS incremental_claim_count
    FROM x_triangle WINDOW w AS (PARTITION BY {SEG}, accident_year ORDER BY development)""",
    numbers="incremental_paid incremental_incurred")

# ---- factors and ultimates
add("ldf_raw", "SELECT * FROM x_ldf_raw", numbers="link_ratio_paid link_ratio_incurred link_ratio_cnt")
for _name, _prefix in (("avg", "avg"), ("weighted", "weighted"), ("last3", "last3")):
    add("ldf_last3_weighted" if _name == "last3" else f"ldf_{_name}", f"SELECT * FROM x_ldf_{_name}",
        numbers=" ".join(f"{_prefix}_ldf_{s}" for s in LDF.values()))
for _m, _s in LDF.items():
    _value = "ultimate_claim_count" if _m == "claim_count" else "ultimate_loss"
    add(f"ldf_selected_{_m}", f"SELECT * FROM x_selected_{_m}", numbers=f"selected_ldf_{_s}")
    add(f"cdf_{_m}", f"SELECT * FROM x_cdf_{_m}", numbers="cdf")
    add(f"cdf_by_month_{_m}", f"SELECT * FROM x_month_{_m}", numbers="cdf")
    add(f"ultimate_{_m}_chain_ladder", f"SELECT * FROM x_ultimate_{_m}", numbers=_value)
add("fct_ultimate_loss", "SELECT * FROM x_fct_ultimate_loss", numbers="ultimate_loss")
add("fct_ultimate_claim_count", "SELECT * FROM x_fct_ultimate_count", numbers="ultimate_claim_count")
add("fct_selected_ultimate_loss", "SELECT * FROM x_fct_selected_loss", numbers="ultimate_loss")
add("fct_selected_ultimate_claim_count", "SELECT * FROM x_fct_selected_count", numbers="ultimate_claim_count")

# ---- pricing
add("fct_frequency_severity", "SELECT * FROM x_freq_sev", numbers="total_earned_exposure frequency severity")
_TRENDED = "total_earned_exposure trended_frequency trended_severity"
add("fct_frequency_severity_trended", "SELECT * FROM x_trended", numbers=_TRENDED)
add("fct_pure_premium", "SELECT *, trended_frequency * trended_severity AS pure_premium FROM x_trended",
    numbers=f"{_TRENDED} pure_premium")
add("fct_indicated_premium", "SELECT * FROM x_indicated", numbers="indicated_premium")
add("mart_indicated_rate_change_pure_premium", f"""
    SELECT {SEG}, indicated_premium, cumulative_factor, indicated_premium / cumulative_factor - 1
        AS indicated_rate_change
    FROM x_indicated JOIN (
        SELECT 'ALL' AS state_grp, 'ALL' AS risk_class_grp, 'ALL' AS vehicle_segment_grp,
               avg(cumulative_factor) AS cumulative_factor
        FROM (SELECT * FROM x_rate_level_history QUALIFY row_number() OVER (PARTITION BY state, risk_class,
              vehicle_segment ORDER BY effective_date DESC, filing_id DESC) = 1)) USING ({SEG})""",
    numbers="indicated_premium cumulative_factor indicated_rate_change")

# ---- controls
_TOTALS = "source_value target_value absolute_difference percentage_difference"
add("mart_control_totals_financial_summary", "SELECT * FROM x_control_totals", numbers=_TOTALS)
add("mart_control_tolerance_by_metric", """
    SELECT c.*, t.absolute_tolerance, t.percentage_tolerance,
           CASE WHEN abs(absolute_difference) <= absolute_tolerance
                 AND abs(coalesce(percentage_difference, 0)) <= percentage_tolerance THEN 'PASS'
                WHEN abs(absolute_difference) <= 5 * absolute_tolerance THEN 'WARN' ELSE 'FAIL' END AS control_status
    FROM x_control_totals c LEFT JOIN (VALUES
        ('written_premium_to_earned_premium_total', 0.01, 0.000001),
        ('written_exposure_to_earned_exposure_total', 0.000001, 0.000001),
        ('latest_cumulative_paid_total', 0.01, 0.000001), ('latest_cumulative_incurred_total', 0.01, 0.000001),
        ('latest_claim_count_total', 0.000001, 0.000001)) t(metric_name, absolute_tolerance, percentage_tolerance)
      ON t.metric_name = c.metric_name""",
    numbers=f"{_TOTALS} absolute_tolerance percentage_tolerance")
add("mart_reconciliation_by_segment", f"""
    WITH latest AS (SELECT max(valuation_date) AS d FROM x_year_end_snapshot),
    s AS (SELECT 'ALL' AS state_grp, 'ALL' AS risk_class_grp, 'ALL' AS vehicle_segment_grp,
                 sum(cumulative_paid) AS p, sum(incurred) AS i, count(DISTINCT claim_id) AS n
          FROM x_year_end_snapshot, latest WHERE valuation_date = d),
    t AS (SELECT {SEG}, sum(cumulative_paid) AS p, sum(cumulative_incurred) AS i,
                 sum(cumulative_claim_count)::BIGINT AS n
          FROM x_triangle, latest WHERE valuation_date = d GROUP BY ALL),
    e AS (SELECT {SEG}, sum(total_earned_exposure) AS x, sum(total_earned_premium) AS pr
          FROM x_policy_exposure_v3 GROUP BY ALL)
    SELECT {SEG}, s.p AS source_cumulative_paid, t.p AS target_cumulative_paid, t.p - s.p AS paid_difference,
           s.i AS source_cumulative_incurred, t.i AS target_cumulative_incurred, t.i - s.i AS incurred_difference,
           s.n AS source_claim_count, t.n AS target_claim_count, t.n - s.n AS claim_count_difference,
           e.x AS total_earned_exposure, e.pr AS total_earned_premium
    FROM s FULL JOIN t USING ({SEG}) FULL JOIN e USING ({SEG})""",
    numbers="source_cumulative_paid target_cumulative_paid paid_difference source_cumulative_incurred "
    "target_cumulative_incurred incurred_difference total_earned_exposure total_earned_premium")
_IMPACT = (
    "selected_ultimate_loss chain_ladder_ultimate_loss loss_method_impact selected_ultimate_claim_count "
    "chain_ladder_ultimate_claim_count claim_count_method_impact selected_frequency_trend selected_severity_trend"
)
add("mart_assumption_impact_reconciliation", "SELECT * FROM x_assumption_impact", numbers=_IMPACT)
add("assumption_impact_without_baseline", """SELECT * REPLACE (NULL::DOUBLE AS chain_ladder_ultimate_loss,
    NULL::DOUBLE AS loss_method_impact) FROM x_assumption_impact""", numbers=_IMPACT)
add("mart_reserve_pricing_movement_attribution", f"""
    SELECT b.*, i.indicated_premium, trended_pure_premium - base_pure_premium AS trend_impact_on_pure_premium,
           indicated_premium - trended_pure_premium AS expense_and_profit_impact, r.l AS reserve_loss_method_impact,
           r.c AS reserve_claim_count_method_impact
    FROM (SELECT {SEG}, sum(f.total_earned_exposure) AS total_earned_exposure,
                 sum(frequency * severity * f.total_earned_exposure) / sum(f.total_earned_exposure)
                     AS base_pure_premium,
                 sum(trended_frequency * trended_severity * t.total_earned_exposure) / sum(t.total_earned_exposure)
                     AS trended_pure_premium
          FROM x_freq_sev f JOIN x_trended t USING ({SEG}, accident_year) GROUP BY ALL) b
    LEFT JOIN x_indicated i USING ({SEG})
    LEFT JOIN (SELECT {SEG}, sum(loss_method_impact) AS l, sum(claim_count_method_impact) AS c
               FROM x_assumption_impact GROUP BY ALL) r USING ({SEG})""",
    numbers="total_earned_exposure base_pure_premium trended_pure_premium indicated_premium "
    "trend_impact_on_pure_premium expense_and_profit_impact reserve_loss_method_impact "
    "reserve_claim_count_method_impact")
add("mart_incurred_coverage", f"""
    SELECT {SEG}, development, CASE WHEN r.k AND s.k THEN 'matched' WHEN r.k THEN 'missing_selected'
                                    ELSE 'extra_selected' END AS status
    FROM (SELECT DISTINCT {SEG}, development, true AS k FROM x_ldf_raw WHERE link_ratio_incurred IS NOT NULL) r
    FULL JOIN (SELECT DISTINCT {SEG}, development, true AS k FROM x_selected_incurred) s USING ({SEG}, development)""")

# ---- review and governance
_DEVS = range(7)
add("review_triangles", f"""
    SELECT {SEG}, t.name AS triangle, accident_year,
           {', '.join(f'sum(CASE WHEN development = {d} THEN t.v END) AS dev_{d}' for d in _DEVS)}
    FROM x_triangle, LATERAL (VALUES ('cumulative_paid', cumulative_paid::DOUBLE),
        ('cumulative_reported', cumulative_incurred::DOUBLE),
        ('cumulative_claim_count', cumulative_claim_count::DOUBLE)) t(name, v) GROUP BY ALL""",
    numbers=" ".join(f"dev_{d}" for d in _DEVS))
add("review_triangle_cells_shifted", f"""
    SELECT {SEG}, t.name AS triangle, accident_year, development, t.v AS value
    FROM (SELECT * REPLACE (development + 9 AS development) FROM x_triangle), LATERAL (VALUES
        ('cumulative_paid', cumulative_paid::DOUBLE), ('cumulative_reported', cumulative_incurred::DOUBLE),
        ('cumulative_claim_count', cumulative_claim_count::DOUBLE)) t(name, v)""", numbers="value")
add("review_ultimates", f"""
    SELECT {SEG}, accident_year, p.ultimate_loss AS paid_ultimate_loss, r.ultimate_loss AS reported_ultimate_loss,
           c.ultimate_claim_count AS reported_ultimate_claim_count
    FROM x_ultimate_incurred r FULL JOIN x_ultimate_paid p USING ({SEG}, accident_year)
    LEFT JOIN x_ultimate_claim_count c USING ({SEG}, accident_year)""",
    numbers="paid_ultimate_loss reported_ultimate_loss reported_ultimate_claim_count")
_BY_METHOD = f"""
    SELECT {SEG}, accident_year, method, max(l) AS ultimate_loss, max(c) AS ultimate_claim_count
    FROM (SELECT {SEG}, accident_year, method, ultimate_loss AS l, NULL::DOUBLE AS c FROM x_fct_ultimate_loss
          UNION ALL SELECT {SEG}, accident_year, method, NULL, ultimate_claim_count FROM x_fct_ultimate_count)
    GROUP BY ALL"""
add("ultimate_candidates_by_method", _BY_METHOD, numbers="ultimate_loss ultimate_claim_count")
_WIDE = [("ultimate_loss", m) for m in
         ("BF", "Cape_cod", "Chain_ladder_incurred", "Chain_ladder_paid", "Judgement")]
_WIDE += [("ultimate_claim_count", m) for m in ("BF", "Cape_cod", "Chain_ladder", "Judgement")]
add("review_ultimate_candidates", f"""
    SELECT {SEG}, accident_year, {', '.join(f"max({v}) FILTER (method = '{m}') AS {v}_{m}" for v, m in _WIDE)}
    FROM ({_BY_METHOD}) GROUP BY ALL""", numbers=" ".join(f"{v}_{m}" for v, m in _WIDE))
_UNLISTED = [*_WIDE[:5], ("ultimate_loss", "Expected_loss"), *_WIDE[5:]]
add("review_ultimate_candidates_unlisted", f"""
    SELECT {SEG}, accident_year, {', '.join(f"max({v}) FILTER (method = '{m}') AS {v}_{m}" for v, m in _UNLISTED)}
    FROM (SELECT * FROM ({_BY_METHOD}) UNION ALL
          SELECT {SEG}, accident_year, 'Expected_loss', ultimate_loss * 2, NULL::DOUBLE
          FROM x_fct_ultimate_loss WHERE method = 'BF') GROUP BY ALL""",
    numbers=" ".join(f"{v}_{m}" for v, m in _UNLISTED))
add("review_frequency_severity", f"SELECT {SEG}, accident_year, frequency, severity FROM x_freq_sev",
    numbers="frequency severity")
add("ultimate_selection_template", """
    SELECT 'v3' AS segmentation_version, type, state_grp AS state, risk_class_grp AS risk_class,
           vehicle_segment_grp AS vehicle_segment, accident_year, NULL::VARCHAR AS method, NULL::VARCHAR AS comment
    FROM (SELECT state_grp, risk_class_grp, vehicle_segment_grp, accident_year, 'loss' AS type FROM x_fct_ultimate_loss
          UNION SELECT state_grp, risk_class_grp, vehicle_segment_grp, accident_year, 'claim_count'
          FROM x_fct_ultimate_count)""")
add("segment_index", f"""
    SELECT *, row_number() OVER (ORDER BY state_grp, risk_class_grp, vehicle_segment_grp)::INTEGER AS segment_number
    FROM (SELECT DISTINCT {SEG} FROM ({_SEGMENTS}))""")
ORACLE["normalized_values"] = compose(PARTS, """
    SELECT segmentation_version AS "SEGMENTATION_VERSION", type AS "TYPE", state AS "STATE", risk_class AS "RISK_CLASS",
           vehicle_segment AS "VEHICLE_SEGMENT", accident_year::VARCHAR AS "ACCIDENT_YEAR", method AS "METHOD",
           printf('%.10g', ultimate) AS "ULTIMATE", comment AS "COMMENT",
           segmentation_version || '|' || type || '|' || state || '|' || risk_class || '|' || vehicle_segment || '|'
               || accident_year || '|' || method AS "ROW_KEY"
    FROM x_selected_ultimate""")
add("duplicate_keys", """
    SELECT segmentation_version || '|' || type || '|' || state || '|' || risk_class || '|' || vehicle_segment || '|'
           || accident_year AS row_key, count(*) AS row_count
    FROM x_selected_ultimate GROUP BY 1 HAVING count(*) > 1""")


def _selection_key(alias: str) -> str:
    columns = ("segmentation_version", "triangle_type", "state", "risk_class", "vehicle_segment", "development")
    return " || '|' || ".join(f"{alias}.{c}" for c in columns)


def _selection_json(alias: str) -> str:
    """Compact JSON with sorted upper-case names and explicit nulls."""
    columns = ("description", "development", "ldf", "method", "risk_class", "segmentation_version", "state",
               "triangle_type", "vehicle_segment")
    def value(c: str) -> str:
        text = f"printf('%.10g', {alias}.ldf)" if c == "ldf" else f"{alias}.{c}"
        return f"""'"{c.upper()}":' || coalesce('"' || {text} || '"', 'null')"""
    return "'{' || " + " || ',' || ".join(value(c) for c in columns) + " || '}'"


_CHANGES = f"""
    SELECT 'ldf_selection-2' AS assumption_set_id, 'ldf_selection' AS assumption_type,
           'ldf_selection_table.xlsx' AS file_name, c.* FROM (
        SELECT {_selection_key('n')} AS row_key, 'added' AS change_type, '__row__' AS column_name,
               NULL::VARCHAR AS old_value, {_selection_json('n')} AS new_value
        FROM x_ldf_selection_table n WHERE {_selection_key('n')} NOT IN (SELECT {_selection_key('o')} FROM x_previous_ldf o)
        UNION ALL
        SELECT {_selection_key('o')}, 'removed', '__row__', {_selection_json('o')}, NULL
        FROM x_previous_ldf o WHERE {_selection_key('o')} NOT IN (SELECT {_selection_key('n')} FROM x_ldf_selection_table n)
        UNION ALL
        SELECT {_selection_key('n')}, 'updated', 'LDF', printf('%.10g', o.ldf), printf('%.10g', n.ldf)
        FROM x_ldf_selection_table n JOIN x_previous_ldf o ON {_selection_key('n')} = {_selection_key('o')}
        WHERE n.ldf IS DISTINCT FROM o.ldf) c"""
add("change_log", _CHANGES)
add("change_summary", f"SELECT change_type, count(*) AS change_count FROM ({_CHANGES}) GROUP BY ALL")
add("stg_assumption_change_log", f"SELECT *, TIMESTAMP '2002-01-01' AS changed_at FROM ({_CHANGES})", times="changed_at")
add("next_version", """
    SELECT assumption_type, max(version_sequence) + 1 AS version_sequence,
           arg_max(assumption_set_id, version_sequence) AS previous_assumption_set_id
    FROM x_assumption_version GROUP BY assumption_type""")
add("register_version", """
    SELECT * EXCLUDE (uploaded_at) FROM x_assumption_version
    UNION ALL
    SELECT 'trend_selection-3', 'trend_selection', 'trend_selection.xlsx', 'TREND_SELECTION',
           max(version_sequence) + 1, 'auto_v' || (max(version_sequence) + 1), 'uploaded', 'actuary', 'review', 2, 0,
           arg_max(assumption_set_id, version_sequence), NULL, NULL, NULL
    FROM x_assumption_version WHERE assumption_type = 'trend_selection'""")

_UPLOAD = """'uploaded' AS status, 'actuary' AS uploaded_by, {note} AS upload_comment, 'review' AS dag_id"""
add("upload_assumption", f"""
    WITH a AS (SELECT {_selection_key('n')} AS row_key, {_selection_json('n')} AS new_value FROM x_previous_ldf n),
    c AS ({_CHANGES})
    SELECT 1::BIGINT AS version_sequence, 'auto_v1' AS version_label, NULL::BIGINT AS previous_sequence,
           'auto_v1' AS metadata_label, {_UPLOAD.format(note="'first'")},
           (SELECT count(*) FROM a) AS source_row_count, (SELECT count(*) FROM a) AS change_count, row_key,
           'added' AS change_type, '__row__' AS column_name, NULL::VARCHAR AS old_value, new_value FROM a
    UNION ALL
    SELECT 2, 'auto_v2', 1, 'auto_v2', {_UPLOAD.format(note="'second'")}, (SELECT count(*) FROM x_ldf_selection_table),
           (SELECT count(*) FROM c), row_key, change_type, column_name, old_value, new_value FROM c""")
add("load_batch_rerun", """
    SELECT if(transaction_id % 2 = 0, 'batch 1', 'batch/2') AS load_batch_id, transaction_type, count(*) AS row_count,
           sum(premium_change) AS premium_change FROM x_raw_premium_transaction GROUP BY ALL""", numbers="premium_change")

# ---- rules
add("coverage_term_factor", """SELECT coverage_id, (expiration_date - effective_date) / 365.25::DOUBLE AS term_factor
    FROM x_raw_policy_coverage""", numbers="term_factor")
add("invalid_terms", """SELECT policy_id, effective_date, effective_date AS expiration_date FROM x_raw_policy
    WHERE cancellation_date IS NOT NULL""", TERM)
add("risk_exposure_window", f"""
    SELECT r.risk_unit_id, r.policy_id, r.effective_date AS exposure_start, e AS exposure_end,
           greatest((e - r.effective_date) / 365.25::DOUBLE, 0) AS exposure_years
    FROM (SELECT r.*, least(p.expiration_date, coalesce(p.cancellation_date, p.expiration_date), r.expiration_date,
                            {AS_OF}) AS e
          FROM x_raw_policy_risk_unit r JOIN x_raw_policy p ON p.policy_id = r.policy_id) r""",
    "exposure_start exposure_end", "exposure_years")
add("severity_trend_factor", """SELECT claim_id, power(1.06::DOUBLE, greatest(year(loss_date) - 1995, 0)) AS trend_factor
    FROM x_raw_claim""", numbers="trend_factor")
add("coverage_terms", """
    SELECT claim_id, (ultimate_cents * 7 / 100.0)::DECIMAL(18,2) AS ground_up,
           least(greatest((ultimate_cents * 7 / 100.0)::DECIMAL(18,2) - deductible_amount, 0), limit_amount) AS net_loss
    FROM x_claimed c JOIN x_raw_policy_coverage k ON k.coverage_id = c.coverage_id""", numbers="ground_up net_loss")
add("claim_status", "SELECT claim_id, claim_status FROM x_raw_claim")
_TIER = """CASE underwriting_tier WHEN 'preferred' THEN 0.85 WHEN 'standard' THEN 1.0 WHEN 'nonstandard' THEN 1.25
    WHEN 'high_risk' THEN 1.7 END::DOUBLE"""
add("auto_premium", f"""
    SELECT coverage_id, coverage_code, f AS pricing_factor,
           round(CASE coverage_code WHEN 'AUTO_BI' THEN 420 WHEN 'AUTO_PD' THEN 180 WHEN 'AUTO_COLL' THEN 310
                      ELSE 170 END * f * days / 365.25::DOUBLE, 2) AS rated_premium
    FROM (SELECT c.coverage_id, c.coverage_code, c.expiration_date - c.effective_date AS days,
                 CASE primary_state WHEN 'CA' THEN 1.1 WHEN 'TX' THEN 1.0 WHEN 'FL' THEN 1.2 WHEN 'NY' THEN 1.25
                      WHEN 'IL' THEN 1.05 WHEN 'PA' THEN 0.95 WHEN 'OH' THEN 0.9 WHEN 'GA' THEN 1.0
                      WHEN 'NC' THEN 0.9 WHEN 'MI' THEN 1.3 END::DOUBLE
                 * (CASE WHEN age < 25 THEN 1.25 WHEN age >= 50 THEN 0.9 ELSE 1.0 END::DOUBLE
                    * (1 + 0.08::DOUBLE * least(prior_accidents, 5)))
                 * CASE vehicle_type WHEN 'sedan' THEN 1.0 WHEN 'suv' THEN 1.15 WHEN 'truck' THEN 1.2
                        ELSE 1.45 END::DOUBLE
                 * CASE usage WHEN 'commute' THEN 1.05 WHEN 'pleasure' THEN 0.9 ELSE 1.15 END::DOUBLE
                 * CASE WHEN deductible_amount = 0 THEN 1.0 ELSE 0.9 END::DOUBLE
                 * CASE WHEN limit_amount = 100000 THEN 1.25 ELSE 1.0 END::DOUBLE
                 * {_TIER} * power(1.04::DOUBLE, greatest(year(p.effective_date) - 1995, 0)) AS f
          FROM x_raw_policy_coverage c
          JOIN (SELECT * FROM x_raw_policy WHERE line_of_business = 'personal_auto') p ON p.policy_id = c.policy_id
          JOIN x_raw_vehicle v ON v.vehicle_id = c.risk_unit_id
          JOIN (SELECT d.*, q.effective_date AS e, year(q.effective_date) - year(d.date_of_birth)
                    - (strftime(q.effective_date, '%m%d') < strftime(d.date_of_birth, '%m%d'))::INTEGER AS age
                FROM x_raw_driver d JOIN x_raw_policy q ON q.policy_id = d.policy_id) d ON d.policy_id = c.policy_id)""",
    numbers="pricing_factor rated_premium")
add("property_premium", f"""
    SELECT coverage_id, coverage_code, f AS pricing_factor,
           round(limit_amount::DOUBLE * if(coverage_code = 'BUILDING', 0.0025, 0.0018)::DOUBLE * f * days
                 / 365.25::DOUBLE, 2) AS rated_premium
    FROM (SELECT c.coverage_id, c.coverage_code, c.limit_amount, c.expiration_date - c.effective_date AS days,
                 CASE occupancy WHEN 'office' THEN 0.9 WHEN 'retail' THEN 1.0 WHEN 'warehouse' THEN 1.1
                      ELSE 1.25 END::DOUBLE
                 * CASE construction_type WHEN 'frame' THEN 1.15 WHEN 'masonry' THEN 1.0
                        WHEN 'noncombustible' THEN 0.9 ELSE 0.8 END::DOUBLE
                 * CASE state WHEN 'FL' THEN 1.1 WHEN 'TX' THEN 1.05 WHEN 'GA' THEN 1.03 ELSE 1.0 END::DOUBLE
                 * {_TIER} * power(1.035::DOUBLE, greatest(year(p.effective_date) - 1995, 0)) AS f
          FROM x_raw_policy_coverage c JOIN x_raw_policy p ON p.policy_id = c.policy_id
          JOIN x_raw_property_location l ON l.location_id = c.risk_unit_id)""",
    numbers="pricing_factor rated_premium")
add("cancellation_refund", """
    SELECT m.coverage_id, m.policy_id, c.cancellation_date,
           (-((2 * sum(m.change * (c.expiration_date - c.cancellation_date) * 10000 // (c.expiration_date - m.d))
               + 10000) // 20000) / 100.0)::DECIMAL(18,2) AS refund
    FROM x_money_in m JOIN x_cover c ON c.coverage_id = m.coverage_id WHERE c.cancellation_date IS NOT NULL
    GROUP BY ALL""", "cancellation_date", "refund")
add("running_premium_balance", """SELECT transaction_id, coverage_id, transaction_date, premium_change,
    greatest(sum(premium_change) OVER (PARTITION BY coverage_id ORDER BY transaction_date, transaction_id), 0)
        AS cumulative_premium FROM x_raw_premium_transaction""", "transaction_date",
    "premium_change cumulative_premium")
_PCT = "(2 * ({0}) * {1} + {2}) // (2 * {2})"
add("develop_ultimates", f"""
    WITH s AS (
        SELECT c.claim_id, c.is_auto, p.step, c.reported_date + 30 * p.month AS d,
               {_PCT.format("c.ultimate_cents", "p.paid", 100)} AS paid,
               {_PCT.format("c.ultimate_cents", "p.reserve", 100)} AS reserve
        FROM x_claimed c JOIN (VALUES
            (true, 0, 0, 0, 85), (true, 1, 1, 20, 65), (true, 2, 3, 50, 35), (true, 3, 6, 80, 20),
            (true, 4, 12, 100, 0), (false, 0, 0, 0, 90), (false, 1, 3, 10, 85), (false, 2, 6, 30, 65),
            (false, 3, 12, 65, 35), (false, 4, 24, 100, 0)) p(is_auto, step, month, paid, reserve)
          ON p.is_auto = c.is_auto
        WHERE c.reported_date + 30 * p.month <= {AS_OF}),
    m AS (SELECT *, paid - coalesce(lag(paid) OVER w, 0) AS dp, reserve - coalesce(lag(reserve) OVER w, 0) AS dr,
                 {_PCT.format("reserve", 8, 100)}
                     - coalesce(lag({_PCT.format("reserve", 8, 100)}) OVER w, 0) AS de
          FROM s WINDOW w AS (PARTITION BY claim_id ORDER BY step)),
    n AS (SELECT *, {_PCT.format("dp", 10, 100)} AS pe, {_PCT.format("dp", "if(is_auto, 5, 3)", 100)} AS rc FROM m)
    SELECT claim_id, step, if(step = 0, 'RESERVE_SET', 'PAYMENT') AS transaction_type, d AS transaction_date,
           dp / 100.0 AS paid_loss_change, dr / 100.0 AS case_reserve_change, pe / 100.0 AS paid_expense_change,
           de / 100.0 AS case_expense_change, rc / 100.0 AS recovery_change, (dp + dr + pe + de - rc) / 100.0
               AS incurred_loss_change FROM n""", "transaction_date", CHANGES)
def _first_driver(source: str) -> str:
    return f"""SELECT vehicle_id, coalesce(max_by(driver_id, assignment_id) FILTER (assignment_type = 'PRIMARY'),
                                min_by(driver_id, assignment_id)) AS driver_id FROM {source} GROUP BY vehicle_id"""


add("primary_driver", _first_driver("x_raw_driver_vehicle_assignment"))
add("primary_driver_contested", _first_driver(f"""(
    SELECT vehicle_id, driver_id, assignment_id, {CONTESTED['own']} AS assignment_type
    FROM x_raw_driver_vehicle_assignment
    UNION ALL SELECT vehicle_id, driver_id + 1, assignment_id + 1000000000, {CONTESTED['later']}
    FROM x_raw_driver_vehicle_assignment
    UNION ALL SELECT vehicle_id, driver_id + 2, assignment_id - 1000000000, {CONTESTED['earlier']}
    FROM x_raw_driver_vehicle_assignment)"""))


# ---- quality
def _rows(parts: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{rule}' AS rule, ({count}) AS failing_rows" for t, rule, count in parts
    )


def _values(values: list) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


add("not_null_report", _rows([
    (t, c, f"SELECT count(*) FROM x_{t} WHERE {c} IS NULL") for t, k in CONTRACT.items() for c in k.required]))
add("unique_report", _rows([
    (t, c, f"SELECT count(*) FROM (SELECT {c} FROM x_{t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)")
    for t, k in CONTRACT.items() for c in [k.key, *k.unique_keys]]))
add("accepted_values_report", _rows([
    (t, c, f"SELECT count(*) FROM x_{t} WHERE {c} NOT IN ({_values(v)})")
    for t, k in CONTRACT.items() for c, v in k.accepted.items()]))
add("relationships_report", _rows([
    (t, c, f"SELECT count(DISTINCT {c}) FROM x_{t} WHERE {c} NOT IN (SELECT {key} FROM x_{parent})")
    for t, k in CONTRACT.items() for c, (parent, key) in k.references.items()]))
add("expression_report", _rows([
    (t, name, f"SELECT count(*) FROM x_{t} WHERE NOT ({e})")
    for t, k in CONTRACT.items() for name, e in k.expressions.items()]))
add("unique_combination_report", _rows([
    (t, "+".join(c), f"SELECT count(*) FROM (SELECT 1 FROM x_{t} GROUP BY {', '.join(c)} HAVING count(*) > 1)")
    for t, c in UNIQUE_COMBINATIONS.items()]))

def _contract(contract: dict, names: dict[str, str]) -> str:
    """Every rule of a contract by a query of its own: plain filters, grouped keys and missing parents."""
    rows = []
    for t, k in contract.items():
        table = names[t]
        for c in k.required:
            rows.append((t, "not_null", c, f"SELECT count(*) FROM {table} WHERE {c} IS NULL"))
        for c, v in k.accepted.items():
            rows.append((t, "accepted_values", c, f"SELECT count(*) FROM {table} WHERE {c} NOT IN ({_values(v)})"))
        for name, e in k.expressions.items():
            rows.append((t, "expression", name, f"SELECT count(*) FROM {table} WHERE NOT ({e})"))
        for c, (low, high, inclusive) in k.ranges.items():
            sides = [f"{c} {'<' if inclusive else '<='} {low}"] if low is not None else []
            sides += [f"{c} {'>' if inclusive else '>='} {high}"] if high is not None else []
            rows.append((t, "accepted_range", c, f"SELECT count(*) FROM {table} WHERE {' OR '.join(sides)}"))
        for c in filter(None, [k.key, *k.unique_keys]):
            rows.append((t, "unique", c, f"""SELECT count(*) FROM (SELECT {c} FROM {table} WHERE {c} IS NOT NULL
                GROUP BY {c} HAVING count(*) > 1)"""))
        for cs in k.combinations:
            rows.append((t, "unique_combination", "+".join(cs), f"""SELECT count(*) FROM (SELECT 1 FROM {table}
                GROUP BY {', '.join(cs)} HAVING count(*) > 1)"""))
        for c, (parent, key) in k.references.items():
            rows.append((t, "relationships", c, f"""SELECT count(DISTINCT {c}) FROM {table}
                WHERE {c} NOT IN (SELECT {key} FROM {names[parent]} WHERE {key} IS NOT NULL)"""))
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{check}' AS check_name, '{rule}' AS rule, ({count}) AS failing_rows"
        for t, check, rule, count in rows
    )


_CHANGE_ROWS = "x_change_rows"
PARTS[_CHANGE_ROWS] = _CHANGES
PARTS["x_metadata_rows"] = "SELECT 'meta-' || assumption_set_id AS pipeline_run_metadata_id, * FROM x_assumption_version"
_PLAIN = {t: f"x_{t}" for t in [*contracts.RAW_CONTRACT, *contracts.ASSUMPTION_CONTRACT, *contracts.SEED_CONTRACT]}
add("contract_report_raw", _contract(contracts.RAW_CONTRACT, _PLAIN))
add("contract_report_assumptions", _contract(contracts.ASSUMPTION_CONTRACT, _PLAIN))
add("contract_report_seeds", _contract(contracts.SEED_CONTRACT, _PLAIN))
add("contract_report_governance", _contract(contracts.GOVERNANCE_CONTRACT, {
    "assumption_version": "x_assumption_version", "assumption_change_log": _CHANGE_ROWS,
    "pipeline_run_metadata": "x_metadata_rows"}))
PARTS["x_core_exposure"] = "SELECT * FROM x_fct_exposure"
add("contract_report_core", _contract(contracts.CORE_CONTRACT, {
    "dim_policy": "x_raw_policy", "dim_risk_unit": "x_raw_policy_risk_unit", "dim_coverage": "x_raw_policy_coverage",
    "fct_premium_transaction": "x_raw_premium_transaction", "fct_claim": "x_raw_claim",
    "fct_claim_transaction": "x_raw_claim_transaction", "fct_exposure": "x_core_exposure"}))
add("contract_report_exposure", _contract(contracts.EXPOSURE_CONTRACT, {
    "coverage_active_period": "x_active", "coverage_month": "x_coverage_month",
    "earned_exposure_month": "x_earned_exposure", "premium_earning_segments": "x_earning_segments",
    "earned_premium_month": "x_earned_premium"}))
add("contract_report_claims",
    _contract(contracts.CLAIM_CONTRACT, {"claim_financial_state_period": "x_state_period"}))
add("contract_report_raw_perturbed", _contract(
    contracts.RAW_CONTRACT, {t: f"x_broken_{t}" for t in contracts.RAW_CONTRACT}))
_LOADED = {"raw_premium_transaction": contracts.RAW_CONTRACT["raw_premium_transaction"]}
add("observed_load_report", f"""
    WITH lies AS (SELECT count(*) AS rows_in_table FROM x_broken_raw_premium_transaction)
    SELECT check_name, rule, failing_rows, rows_in_table FROM lies, (
        SELECT 'rows' AS check_name, 'written' AS rule, (SELECT rows_in_table FROM lies) AS failing_rows
        UNION ALL SELECT check_name, rule, failing_rows
        FROM ({_contract(_LOADED, {t: f"x_broken_{t}" for t in contracts.RAW_CONTRACT})})
        WHERE check_name IN ('not_null', 'accepted_values', 'expression', 'accepted_range'))""")
for _name, _source in (("state_period_faults", "x_state_period"),
                       ("state_period_faults_perturbed", "x_broken_claim_financial_state_period")):
    add(_name, f"""
    WITH d AS (SELECT claim_id, valid_from_date, valid_to_date, count(*) AS row_count FROM {_source} GROUP BY ALL)
    SELECT * FROM (
        SELECT *, CASE WHEN valid_to_date <= valid_from_date THEN 'empty' WHEN row_count > 1 THEN 'repeated'
                       WHEN valid_from_date < covered_to_date THEN 'overlap'
                       WHEN valid_from_date > covered_to_date THEN 'gap' END AS fault
        FROM (SELECT d.claim_id, d.valid_from_date, d.valid_to_date, d.row_count,
                     max(e.valid_to_date) AS covered_to_date
              FROM d LEFT JOIN d e ON e.claim_id = d.claim_id
               AND (e.valid_from_date, e.valid_to_date) < (d.valid_from_date, d.valid_to_date) GROUP BY ALL))
    WHERE fault IS NOT NULL""", "valid_from_date valid_to_date covered_to_date")
add("accepted_range_report", _rows([
    ("coverage_month", rule, f"SELECT count(*) FROM x_coverage_month WHERE {bad}") for rule, bad in (
        ("days_1_to_31", "active_days NOT BETWEEN 1 AND 31"), ("full_months", "active_days NOT BETWEEN 28 AND 31"),
        ("above_zero", "active_days <= 0"))]))
add("effective_date_valid", f"""SELECT policy_id, effective_date FROM x_raw_policy WHERE effective_date IS NULL
    OR effective_date < DATE '1996-01-01' OR effective_date > {AS_OF}""", "effective_date")
add("month_end_failures", """SELECT policy_id, effective_date FROM x_raw_policy
    WHERE month(effective_date + 1) = month(effective_date)""", "effective_date")
add("not_null_failures", "SELECT policy_id FROM x_raw_policy WHERE cancellation_date IS NULL")
add("unique_failures", """SELECT coverage_id, count(*) AS row_count FROM x_raw_premium_transaction
    GROUP BY coverage_id HAVING count(*) > 1""")
add("accepted_values_failures",
    "SELECT policy_id, underwriting_tier FROM x_raw_policy WHERE underwriting_tier = 'high_risk'")
add("relationships_failures", """SELECT coverage_id, count(*) AS row_count FROM x_raw_policy_coverage
    WHERE coverage_id NOT IN (SELECT coverage_id FROM x_raw_claim) GROUP BY coverage_id""")
add("expression_failures", """SELECT transaction_id, premium_change FROM x_raw_premium_transaction
    WHERE premium_change < 0""", numbers="premium_change")

_STATE_DATES = "event_date"
add("valuation_date_not_month_end",
    "SELECT * EXCLUDE (is_year_end) FROM x_year_end_snapshot WHERE valuation_date <> last_day(valuation_date)",
    "valuation_date accident_date transaction_date", "cumulative_paid case_reserve incurred")
add("claim_cumulative_incurred_reconciles", """
    SELECT claim_id, event_date, incurred AS cumulative_incurred_loss, calculated AS calculated_cumulative_incurred,
           calculated - incurred AS incurred_difference FROM x_state WHERE abs(calculated - incurred) > 0.01""",
    "event_date", "cumulative_incurred_loss calculated_cumulative_incurred incurred_difference")
add("claim_snapshot_population", """
    SELECT valuation_date, e.n AS expected_claim_count, a.n AS actual_claim_count
    FROM (SELECT valuation_date, count(DISTINCT claim_id) AS n FROM x_valuations
          JOIN x_raw_claim ON reported_date <= valuation_date GROUP BY ALL) e
    LEFT JOIN (SELECT valuation_date, count(DISTINCT claim_id) AS n FROM x_snapshot GROUP BY ALL) a
      USING (valuation_date)
    WHERE e.n <> coalesce(a.n, 0)""", "valuation_date")
add("coverage_parent_bounds", """
    SELECT c.coverage_id, greatest(c.effective_date, p.effective_date, r.effective_date) AS expected_effective_date,
           c.expiration_date AS expected_scheduled_expiration_date,
           least(c.expiration_date, p.expiration_date, coalesce(p.cancellation_date, p.expiration_date),
                 r.expiration_date) AS expected_actual_expiration_date,
           a.coverage_effective_date, a.scheduled_expiration_date, a.actual_expiration_date
    FROM x_raw_policy_coverage c JOIN x_raw_policy p ON p.policy_id = c.policy_id
    JOIN x_raw_policy_risk_unit r ON r.policy_id = c.policy_id AND r.risk_unit_id = c.risk_unit_id
    LEFT JOIN x_active a ON a.coverage_id = c.coverage_id
    WHERE expected_actual_expiration_date > expected_effective_date
      AND (a.coverage_id IS NULL OR a.coverage_effective_date <> expected_effective_date
           OR a.scheduled_expiration_date <> expected_scheduled_expiration_date
           OR a.actual_expiration_date <> expected_actual_expiration_date)""",
    "expected_effective_date expected_scheduled_expiration_date expected_actual_expiration_date "
    "coverage_effective_date scheduled_expiration_date actual_expiration_date")
add("coverage_month_reconciles", """
    SELECT a.coverage_id, a.actual_expiration_date - a.coverage_effective_date AS expected_active_days,
           coalesce(m.n, 0)::BIGINT AS monthly_active_days
    FROM x_active a LEFT JOIN (SELECT coverage_id, sum(active_days) AS n FROM x_coverage_month GROUP BY ALL) m
      USING (coverage_id)
    WHERE a.actual_expiration_date - a.coverage_effective_date <> coalesce(m.n, 0)""")
add("earned_exposure_reconciles", """
    SELECT policy_id, risk_unit_id, coverage_id, e.x AS earned_exposure, d.x AS expected_exposure
    FROM (SELECT policy_id, risk_unit_id, coverage_id, sum(earned_exposure) AS x FROM x_earned_exposure GROUP BY ALL) e
    JOIN (SELECT policy_id, risk_unit_id, coverage_id, sum(active_days) / 365.25 AS x FROM x_coverage_month
          GROUP BY ALL) d USING (policy_id, risk_unit_id, coverage_id)
    WHERE abs(e.x - d.x) > 0.00001""", numbers="earned_exposure expected_exposure")
_EARNED = "(SELECT coverage_id, sum(earned_premium) AS x FROM x_earned_premium GROUP BY ALL)"
add("earned_premium_reconciles_to_segments", f"""
    SELECT coverage_id, coalesce(s.x, 0) AS expected_earned_premium, coalesce(e.x, 0) AS actual_earned_premium
    FROM (SELECT coverage_id, sum(premium_change * earning_days / nullif(earning_end_date - earning_start_date, 0)) AS x
          FROM x_earning_segments GROUP BY ALL) s FULL JOIN {_EARNED} e USING (coverage_id)
    WHERE abs(coalesce(s.x, 0) - coalesce(e.x, 0)) > 0.01""", numbers="expected_earned_premium actual_earned_premium")
add("earned_premium_reconciles_to_net_written", f"""
    SELECT coverage_id, coalesce(s.x, 0) AS net_written_premium, coalesce(e.x, 0) AS earned_premium
    FROM (SELECT coverage_id, sum(premium_change) AS x FROM x_raw_premium_transaction GROUP BY ALL) s
    FULL JOIN {_EARNED} e USING (coverage_id)
    WHERE abs(coalesce(s.x, 0) - coalesce(e.x, 0)) > 0.02""", numbers="net_written_premium earned_premium")
add("claim_snapshot_reconciles", f"""
    SELECT valuation_date, e.p AS expected_cumulative_paid, e.i AS expected_incurred, e.n AS expected_claim_count,
           a.p AS actual_cumulative_paid, a.i AS actual_incurred, a.n AS actual_claim_count
    FROM (SELECT valuation_date, sum(paid_loss_change) AS p, sum(incurred_loss_change) AS i,
                 count(DISTINCT claim_id) AS n
          FROM x_valuations JOIN x_events ON event_date <= valuation_date GROUP BY ALL) e
    FULL JOIN (SELECT valuation_date, sum(cumulative_paid) AS p, sum(incurred) AS i, count(DISTINCT claim_id) AS n
               FROM x_claim_snapshot GROUP BY ALL) a USING (valuation_date)
    WHERE coalesce(e.p, 0) <> coalesce(a.p, 0) OR coalesce(e.i, 0) <> coalesce(a.i, 0)
       OR coalesce(e.n, 0) <> coalesce(a.n, 0)""", "valuation_date",
    "expected_cumulative_paid expected_incurred actual_cumulative_paid actual_incurred")
_WRITTEN = "(SELECT sum(written_premium)::DOUBLE AS wp, sum(term_months) / 12.0 AS we FROM x_priced)"
# whole millionths, so that the sums do not depend on the order of the rows
_EARN = """(SELECT sum((total_earned_premium * 1000000)::BIGINT)::BIGINT / 1000000.0::DOUBLE AS ep,
    sum((total_earned_exposure * 1000000)::BIGINT)::BIGINT / 1000000.0::DOUBLE AS ee FROM x_policy_exposure_v3)"""
add("policy_exposure_within_policy_totals", f"""
    SELECT wp AS expected_written_premium, ep AS actual_earned_premium, we AS expected_exposure,
           ee AS actual_earned_exposure FROM {_WRITTEN} w, {_EARN} e WHERE wp < ep OR we < ee""",
    numbers="expected_written_premium actual_earned_premium expected_exposure actual_earned_exposure")
add("policy_exposure_aggregation_consistent", f"""
    SELECT ee AS overall_exposure, ep AS overall_earned_premium, re AS reaggregated_exposure,
           rp AS reaggregated_earned_premium
    FROM {_EARN} e, (SELECT sum(x) AS re, sum(p) AS rp FROM (SELECT calendar_year, sum(total_earned_exposure) AS x,
                     sum(total_earned_premium) AS p FROM x_policy_exposure_v3 GROUP BY ALL)) r
    WHERE abs(ee - re) > 0.000001 OR abs(ep - rp) > 0.000001""",
    numbers="overall_exposure overall_earned_premium reaggregated_exposure reaggregated_earned_premium")
add("earned_premium_within_written", f"""SELECT ep AS earned_premium, wp AS written_premium
    FROM {_WRITTEN} w, {_EARN} e WHERE ep > wp""", numbers="earned_premium written_premium")
add("policy_exposure_not_negative", """SELECT * FROM x_policy_exposure_v3
    WHERE total_earned_exposure < 0 OR total_earned_premium < 0""",
    numbers="total_earned_exposure total_earned_premium")
add("triangle_reconciles_to_snapshot", f"""
    SELECT {SEG}, accident_year, development, age_months, valuation_date,
           e.cumulative_paid AS expected_cumulative_paid,
           e.cumulative_incurred AS expected_cumulative_incurred, e.cumulative_claim_count AS expected_claim_count,
           a.cumulative_paid AS actual_cumulative_paid, a.cumulative_incurred AS actual_cumulative_incurred,
           a.cumulative_claim_count AS actual_claim_count
    FROM (SELECT 'ALL' AS state_grp, 'ALL' AS risk_class_grp, 'ALL' AS vehicle_segment_grp,
                 year(loss_date) AS accident_year, year(valuation_date) - year(loss_date) AS development,
                 (year(valuation_date) - year(loss_date)) * 12 + month(valuation_date) AS age_months, valuation_date,
                 sum(cumulative_paid_loss) AS cumulative_paid, sum(cumulative_incurred_loss) AS cumulative_incurred,
                 count(*) AS cumulative_claim_count
          FROM x_snapshot WHERE is_year_end OR valuation_date = {AS_OF} GROUP BY ALL) e
    FULL JOIN x_triangle a USING ({SEG}, accident_year, development, age_months, valuation_date)
    WHERE e.cumulative_paid IS DISTINCT FROM a.cumulative_paid
       OR e.cumulative_incurred IS DISTINCT FROM a.cumulative_incurred
       OR e.cumulative_claim_count IS DISTINCT FROM a.cumulative_claim_count""", "valuation_date",
    "expected_cumulative_paid expected_cumulative_incurred actual_cumulative_paid actual_cumulative_incurred")
for _name, _column, _share in (("triangle_paid_not_decreasing", "cumulative_paid", 1.0),
                               ("triangle_incurred_not_collapsing", "cumulative_incurred", 0.9)):
    add(_name, f"""
    SELECT * FROM (SELECT *, lag({_column}) OVER (PARTITION BY {SEG}, accident_year ORDER BY development)
                       AS prev_{_column} FROM x_triangle)
    WHERE {_column} < prev_{_column} * {_share}""", "valuation_date",
        f"cumulative_paid cumulative_incurred prev_{_column}")


def _share_check(column: str, share: float) -> str:
    return f"""SELECT count(*) AS total_rows, count(*) FILTER ({column} >= 1) AS valid_rows FROM x_ldf_raw
        WHERE {column} IS NOT NULL HAVING count(*) > 0
        AND count(*) FILTER ({column} >= 1) / count(*)::DOUBLE < {share}"""


add("paid_link_ratios_at_least_one", _share_check("link_ratio_paid", 1.0))
add("incurred_link_ratios_at_least_one", _share_check("link_ratio_incurred", 0.9))
add("last3_defaults_to_one", f"""
    SELECT * FROM x_ldf_last3 WHERE ({SEG}, development) NOT IN
        (SELECT ({SEG}, development) FROM x_pairs GROUP BY {SEG}, development HAVING count(*) >= 3)
      AND (last3_ldf_paid <> 1 OR last3_ldf_incurred <> 1 OR last3_ldf_cnt <> 1)""",
    numbers="last3_ldf_paid last3_ldf_incurred last3_ldf_cnt")
for _k, _t in (("loss", "x_fct_ultimate_loss"), ("claim_count", "x_fct_ultimate_count")):
    add(f"selected_method_{_k}_coverage", f"""SELECT DISTINCT {SEG}, accident_year FROM {_t}
        EXCEPT SELECT {SEG}, accident_year FROM x_stg_selection_{_k}""")
for _m, _s in LDF.items():
    _column = "cumulative_" + _m
    _value = "ultimate_claim_count" if _m == "claim_count" else "ultimate_loss"
    _floor = "cumulative_claim_count" if _m == "claim_count" else "cumulative_paid"
    add(f"selected_ldf_coverage_{_m}", f"""SELECT DISTINCT {SEG}, development FROM x_ldf_raw
        WHERE link_ratio_{_s} IS NOT NULL EXCEPT SELECT {SEG}, development FROM x_selected_{_m}""")
    add(f"ldf_not_positive_{_m}", f"SELECT * FROM x_selected_{_m} WHERE selected_ldf_{_s} <= 0",
        numbers=f"selected_ldf_{_s}")
    add(f"cdf_below_one_{_m}", f"SELECT * FROM x_cdf_{_m} WHERE cdf < 1", numbers="cdf")
    add(f"cdf_rising_{_m}", f"""SELECT * FROM (SELECT *, lag(cdf) OVER (PARTITION BY {SEG} ORDER BY development)
        AS prev_cdf FROM x_cdf_{_m}) WHERE cdf > prev_cdf""", numbers="cdf prev_cdf")
    add(f"ultimate_equals_latest_{_m}", f"""
        SELECT {SEG}, u.accident_year, u.{_value}, l.{_column}, c.cdf FROM x_ultimate_{_m} u
        JOIN x_latest l USING ({SEG}, accident_year) LEFT JOIN x_month_{_m} c USING ({SEG}, age_months)
        WHERE coalesce(c.cdf, 1) = 1 AND abs(u.{_value} - l.{_column}) > 0.000001""",
        numbers=f"{_value} cdf" + ("" if _m == "claim_count" else f" {_column}"))
    add(f"ultimate_below_latest_{_m}", f"""
        SELECT {SEG}, accident_year, u.{_value}, l.{_floor} FROM x_ultimate_{_m} u
        JOIN x_latest l USING ({SEG}, accident_year) WHERE u.{_value} < l.{_floor}""",
        numbers=_value + ("" if _m == "claim_count" else f" {_floor}"))


def _report() -> str:
    warns = ["triangle_incurred_not_collapsing", "incurred_link_ratios_at_least_one", "cdf_below_one_incurred",
             "cdf_rising_incurred"]
    severity = dict.fromkeys(warns, "warn")
    names = [
        "valuation_date_not_month_end",
        "claim_cumulative_incurred_reconciles",
        "claim_snapshot_population",
        "coverage_parent_bounds",
        "coverage_month_reconciles",
        "earned_exposure_reconciles",
        "earned_premium_reconciles_to_segments",
        "earned_premium_reconciles_to_net_written",
        "claim_snapshot_reconciles",
        "policy_exposure_within_policy_totals",
        "policy_exposure_aggregation_consistent",
        "earned_premium_within_written",
        "policy_exposure_not_negative",
        "triangle_reconciles_to_snapshot",
        "triangle_paid_not_decreasing",
        "triangle_incurred_not_collapsing",
        "paid_link_ratios_at_least_one",
        "incurred_link_ratios_at_least_one",
        "last3_defaults_to_one",
        "selected_method_loss_coverage",
        "selected_method_claim_count_coverage",
        *[f"{check}_{measure}"
          for check in ("selected_ldf_coverage", "ldf_not_positive", "cdf_below_one", "cdf_rising",
                        "ultimate_equals_latest", "ultimate_below_latest")
          for measure in ("paid", "incurred", "claim_count")],
    ]
    rows = " UNION ALL ".join(
        f"SELECT '{n}' AS check_name, '{severity.get(n, 'error')}' AS severity, "
        f"(SELECT count(*) FROM ({ORACLE[n]})) AS failing_rows" for n in names
    )
    return f"""SELECT *, CASE WHEN failing_rows = 0 THEN 'PASS' WHEN severity = 'warn' THEN 'WARN' ELSE 'FAIL' END
        AS status FROM ({rows})"""


ORACLE["quality_report"] = _report()

# the same statements at a valuation that is no year end
MID_YEAR = (
    "valuation_dates claim_triangle_cumulative claim_triangle_from_snapshot claim_triangle_incremental "
    "ldf_raw ldf_avg ldf_weighted ldf_last3_weighted ldf_selected_paid ldf_selected_incurred ldf_selected_claim_count "
    "cdf_paid cdf_incurred cdf_claim_count cdf_by_month_paid cdf_by_month_incurred cdf_by_month_claim_count "
    "ultimate_paid_chain_ladder ultimate_incurred_chain_ladder ultimate_claim_count_chain_ladder "
    "fct_ultimate_loss fct_ultimate_claim_count fct_selected_ultimate_loss fct_selected_ultimate_claim_count "
    "fct_frequency_severity fct_pure_premium fct_indicated_premium mart_indicated_rate_change_pure_premium "
    "mart_control_totals_financial_summary mart_control_tolerance_by_metric mart_reconciliation_by_segment "
    "triangle_reconciles_to_snapshot triangle_paid_not_decreasing ultimate_below_latest_paid"
).split()
for _name in MID_YEAR:
    ORACLE[f"{_name}_mid_year"] = ORACLE[_name].replace(AS_OF, "DATE '2001-06-30'")
for _name, _fault in FAULTS.items():
    _bent = f"x_faulty_{_name}"
    PARTS[_bent] = _fault.broken_sql()
    _sql, *_formats = _GIVEN[_name]
    ORACLE[f"{_name}_faulty"] = q(re.sub(rf"\b{_fault.part}\b", _bent, _sql), *_formats)
# tables at rest carry text identifiers, as the contract declares them
for _name in "claim_triangle_cumulative mart_indicated_rate_change_pure_premium policy_exposure".split():
    ORACLE[f"{_name}_at_rest"] = ORACLE[_name]
ORACLE["earned_premium_month_at_rest"] = f"""SELECT * REPLACE (policy_id::VARCHAR AS policy_id, coverage_id::VARCHAR
    AS coverage_id) FROM ({ORACLE["earned_premium_month"]})"""
