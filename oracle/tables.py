"""Insurance tables from the test tables: the same integer rules, written as SQL."""

AS_OF = "DATE '2001-12-31'"
FIRST_DAY = "DATE '1994-01-01'"
END_DAY = "DATE '2004-01-01'"

STATES = "['CA','TX','FL','NY','IL','PA','OH','GA','NC','MI']"


def cents(expr: str) -> str:
    return f"CAST(({expr}) / 100.0 AS DECIMAL(18,2))"


TABLES = {
    "x_terms": """
        SELECT o_orderkey AS policy_id, o_custkey AS insured_id, o_orderdate::DATE AS effective_date,
               CASE WHEN o_orderkey % 20 < 13 THEN 6 ELSE 12 END AS term_months,
               (o_orderdate::DATE + to_months(CASE WHEN o_orderkey % 20 < 13 THEN 6 ELSE 12 END))::DATE
                   AS expiration_date,
               CASE WHEN o_orderkey % 12 = 0
                    THEN (o_orderdate::DATE + (1 + o_orderkey % 150)::INTEGER) END AS cancellation_date,
               o_orderkey % 7 < 5 AS is_auto
        FROM orders""",
    "x_lines": """
        SELECT l_orderkey AS policy_id, l_linenumber AS line, min(l_partkey) AS pk,
               sum(floor(l_extendedprice)::BIGINT)::BIGINT AS cents,
               l_orderkey * 100 + l_linenumber AS coverage_id,
               l_orderkey * 10 + l_linenumber % 2 AS risk_unit_id
        FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "x_cover": """
        SELECT l.*, t.* EXCLUDE (policy_id),
               CASE WHEN is_auto THEN ['AUTO_BI','AUTO_PD','AUTO_COLL','AUTO_COMP'][line % 4 + 1]
                    ELSE ['BUILDING','BUSINESS_PERSONAL_PROPERTY'][line % 2 + 1] END AS coverage_code,
               least(expiration_date, coalesce(cancellation_date, expiration_date)) AS end_date
        FROM x_lines l JOIN x_terms t ON l.policy_id = t.policy_id""",
    "x_units": """
        SELECT u.*, t.* EXCLUDE (policy_id) FROM (
            SELECT l_orderkey AS policy_id, l_linenumber % 2 AS slot, min(l_partkey) AS pk,
                   l_orderkey * 10 + l_linenumber % 2 AS risk_unit_id
            FROM lineitem GROUP BY l_orderkey, l_linenumber % 2) u
        JOIN x_terms t ON u.policy_id = t.policy_id""",
    "x_claimed": """
        SELECT *, loss_date + (1 + pk % 10)::INTEGER AS reported_date
        FROM (SELECT *, effective_date + ((pk * 31 + line) % (end_date - effective_date))::INTEGER AS loss_date,
                     50000 + (pk * 7919) % 2000000 AS ultimate_cents, coverage_id AS claim_id
              FROM x_cover WHERE (policy_id * 7 + line) % 9 = 0)""",
    "x_raw_policy": f"""
        SELECT policy_id, CASE WHEN is_auto THEN 'PA' ELSE 'CP' END || policy_id AS policy_number, insured_id,
               CASE WHEN is_auto THEN 'pa_standard' ELSE 'cp_standard' END AS product_id,
               CASE WHEN is_auto THEN 'personal_auto' ELSE 'commercial_property' END AS line_of_business,
               effective_date, expiration_date, cancellation_date,
               CASE WHEN cancellation_date IS NOT NULL THEN 'cancelled'
                    WHEN expiration_date <= {AS_OF} THEN 'expired' ELSE 'active' END AS status,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'preferred' WHEN 'BUILDING' THEN 'standard'
                    WHEN 'HOUSEHOLD' THEN 'standard' WHEN 'FURNITURE' THEN 'nonstandard'
                    WHEN 'MACHINERY' THEN 'high_risk' END AS underwriting_tier,
               {STATES}[c_nationkey % 10 + 1] AS primary_state, term_months,
               CASE WHEN is_auto THEN 'policy_admin_auto_sim' ELSE 'policy_admin_property_sim' END AS source_system,
               'batch-1' AS load_batch_id, TIMESTAMP '2002-01-01' AS ingested_at
        FROM x_terms JOIN customer ON insured_id = c_custkey""",
    "x_raw_policy_risk_unit": """
        SELECT risk_unit_id, policy_id, CASE WHEN is_auto THEN 'vehicle' ELSE 'property_location' END AS risk_unit_type,
               risk_unit_id AS source_risk_unit_id, effective_date, expiration_date, 'active' AS status,
               CASE WHEN is_auto THEN 'car_year' ELSE 'location_year' END AS exposure_unit,
               CASE WHEN is_auto THEN 'policy_admin_auto_sim' ELSE 'policy_admin_property_sim' END AS source_system,
               'batch-1' AS load_batch_id, TIMESTAMP '2002-01-01' AS ingested_at
        FROM x_units""",
    "x_raw_policy_coverage": f"""
        SELECT coverage_id, policy_id, risk_unit_id, coverage_code,
               CASE coverage_code WHEN 'AUTO_BI' THEN 'bodily_injury' WHEN 'AUTO_PD' THEN 'property_damage_liability'
                    WHEN 'AUTO_COLL' THEN 'collision' WHEN 'AUTO_COMP' THEN 'comprehensive'
                    ELSE lower(coverage_code) END AS coverage_family,
               effective_date, expiration_date,
               {cents("CASE WHEN coverage_code = 'AUTO_BI' THEN 10000000 WHEN is_auto THEN 5000000 "
                      "WHEN coverage_code = 'BUILDING' THEN 25000000 + (pk * 104729) % 775000000 "
                      "ELSE (25000000 + (pk * 104729) % 775000000) * 3 // 4 END")} AS limit_amount,
               {cents("CASE WHEN coverage_code IN ('AUTO_COLL', 'AUTO_COMP') THEN 50000 WHEN is_auto THEN 0 "
                      "WHEN coverage_code = 'BUILDING' THEN 1000000 ELSE 500000 END")} AS deductible_amount,
               {cents("cents")} AS written_premium,
               CASE WHEN is_auto THEN 'policy_admin_auto_sim' ELSE 'policy_admin_property_sim' END AS source_system,
               'batch-1' AS load_batch_id, TIMESTAMP '2002-01-01' AS ingested_at
        FROM x_cover""",
    "x_endorsed": """
        SELECT *, effective_date + (90 + policy_id % 60)::INTEGER AS endorsed_on,
               CASE WHEN line % 4 = 0 AND effective_date + (90 + policy_id % 60)::INTEGER < end_date
                    THEN cents // 10 END AS extra
        FROM x_cover""",
    "x_money_in": """
        SELECT coverage_id, policy_id, 1 AS step, 'NEW_BUSINESS' AS kind, effective_date AS d, 'new_policy' AS reason,
               cents AS change FROM x_endorsed
        UNION ALL
        SELECT coverage_id, policy_id, 2, 'ENDORSEMENT', endorsed_on, 'coverage_change', extra
        FROM x_endorsed WHERE extra IS NOT NULL""",
    "x_money": """
        SELECT * FROM x_money_in
        UNION ALL
        SELECT m.coverage_id, m.policy_id, 3, 'CANCELLATION', c.cancellation_date, 'pro_rata_cancellation_refund',
               -sum(m.change * (c.expiration_date - c.cancellation_date) // (c.expiration_date - m.d))::BIGINT
        FROM x_money_in m JOIN x_cover c ON m.coverage_id = c.coverage_id
        WHERE c.cancellation_date IS NOT NULL
        GROUP BY m.coverage_id, m.policy_id, c.cancellation_date""",
    "x_raw_premium_transaction": f"""
        SELECT coverage_id * 10 + step AS transaction_id, policy_id, coverage_id, kind AS transaction_type,
               d AS transaction_date, reason AS transaction_reason, {cents("change")} AS premium_change,
               {cents("greatest(sum(change) OVER (PARTITION BY coverage_id ORDER BY d, step), 0)")}
                   AS cumulative_premium,
               'billing_sim' AS source_system, 'batch-1' AS load_batch_id, TIMESTAMP '2002-01-01' AS ingested_at
        FROM x_money""",
    "x_raw_claim": f"""
        SELECT claim_id, policy_id, risk_unit_id, coverage_id, coverage_code, loss_date, reported_date,
               CASE coverage_code WHEN 'AUTO_BI' THEN 'bodily_injury' WHEN 'AUTO_PD' THEN 'property_damage'
                    WHEN 'AUTO_COLL' THEN 'collision'
                    WHEN 'AUTO_COMP' THEN if(pk % 2 = 0, 'weather', 'theft')
                    WHEN 'BUILDING' THEN if(pk % 2 = 0, 'fire', 'wind_hail')
                    ELSE if(pk % 2 = 0, 'water', 'theft') END AS claim_type,
               CASE coverage_code WHEN 'AUTO_COMP' THEN if(pk % 2 = 0, 'weather', 'theft')
                    WHEN 'BUILDING' THEN if(pk % 2 = 0, 'fire', 'weather')
                    WHEN 'BUSINESS_PERSONAL_PROPERTY' THEN if(pk % 2 = 0, 'water', 'theft')
                    ELSE 'at_fault' END AS cause_code,
               CASE WHEN (reported_date + to_months(if(is_auto, 12, 24)))::DATE <= {AS_OF}
                    THEN 'closed' ELSE 'open' END AS claim_status,
               CASE WHEN is_auto THEN 'claims_admin_auto_sim' ELSE 'claims_admin_property_sim' END AS source_system,
               'batch-1' AS load_batch_id, TIMESTAMP '2002-01-01' AS ingested_at
        FROM x_claimed""",
    "x_steps": """
        SELECT c.claim_id, p.step, c.reported_date + 30 * p.month AS d,
               c.ultimate_cents * p.paid // 100 AS paid, c.ultimate_cents * p.reserve // 100 AS reserve
        FROM x_claimed c JOIN (VALUES
            (true, 0, 0, 0, 85), (true, 1, 1, 20, 65), (true, 2, 3, 50, 35), (true, 3, 6, 80, 20),
            (true, 4, 12, 100, 0), (false, 0, 0, 0, 90), (false, 1, 3, 10, 85), (false, 2, 6, 30, 65),
            (false, 3, 12, 65, 35), (false, 4, 24, 100, 0)) p(is_auto, step, month, paid, reserve)
          ON p.is_auto = c.is_auto""",
    "x_moves": """
        SELECT claim_id, step, d,
               paid - coalesce(lag(paid) OVER w, 0) AS paid,
               reserve - coalesce(lag(reserve) OVER w, 0) AS reserve,
               reserve * 8 // 100 - coalesce(lag(reserve * 8 // 100) OVER w, 0) AS case_expense
        FROM x_steps WINDOW w AS (PARTITION BY claim_id ORDER BY step)""",
    "x_raw_claim_transaction": f"""
        SELECT claim_id * 10 + step AS transaction_id, claim_id,
               if(step = 0, 'RESERVE_SET', 'PAYMENT') AS transaction_type, d AS transaction_date,
               {cents("paid")} AS paid_loss_change, {cents("reserve")} AS case_reserve_change,
               {cents("paid // 10")} AS paid_expense_change, {cents("case_expense")} AS case_expense_change,
               {cents("paid * 5 // 100")} AS recovery_change,
               {cents("paid + reserve + paid // 10 + case_expense - paid * 5 // 100")} AS incurred_loss_change,
               'claims_admin_transaction_sim' AS source_system, 'batch-1' AS load_batch_id,
               TIMESTAMP '2002-01-01' AS ingested_at
        FROM x_moves""",
    "x_raw_vehicle": """
        SELECT u.risk_unit_id AS vehicle_id, u.policy_id, u.slot + 1 AS vehicle_sequence,
               (year(u.effective_date) - u.pk % 15)::INTEGER AS model_year,
               ['Toyota','Toyota','Ford','Ford'][p_size % 4 + 1] AS make,
               ['Camry','RAV4','F-150','Mustang'][p_size % 4 + 1] AS model,
               ['sedan','suv','truck','sports'][p_size % 4 + 1] AS vehicle_type, p.primary_state AS garaging_state,
               (4000 + (u.pk * 37) % 21000)::INTEGER AS annual_mileage,
               ['commute','pleasure','business'][u.pk % 3 + 1] AS usage, (u.pk % 2)::INTEGER AS safety_device_flag,
               'policy_admin_auto_sim' AS source_system, 'batch-1' AS load_batch_id,
               TIMESTAMP '2002-01-01' AS ingested_at
        FROM x_units u JOIN part ON p_partkey = u.pk JOIN x_raw_policy p ON p.policy_id = u.policy_id
        WHERE u.is_auto""",
    "x_raw_driver": """
        SELECT policy_id * 10 + 1 AS driver_id, policy_id, 1 AS driver_sequence,
               effective_date - (6600 + (insured_id * 97) % 18000)::INTEGER AS date_of_birth,
               ['F','M','X'][insured_id % 3 + 1] AS gender,
               ((insured_id * 97) % 18000 // 365)::INTEGER AS years_licensed,
               (insured_id % 3)::INTEGER AS prior_accidents, (insured_id % 4)::INTEGER AS prior_violations,
               ['single','married','divorced'][insured_id % 3 + 1] AS marital_status,
               ['A','B','C','D'][insured_id % 4 + 1] AS credit_tier, 'policy_admin_auto_sim' AS source_system,
               'batch-1' AS load_batch_id, TIMESTAMP '2002-01-01' AS ingested_at
        FROM x_terms WHERE is_auto""",
    "x_raw_driver_vehicle_assignment": """
        SELECT risk_unit_id AS assignment_id, policy_id, policy_id * 10 + 1 AS driver_id, risk_unit_id AS vehicle_id,
               'PRIMARY' AS assignment_type, effective_date, expiration_date,
               'policy_admin_auto_sim' AS source_system, 'batch-1' AS load_batch_id,
               TIMESTAMP '2002-01-01' AS ingested_at
        FROM x_units WHERE is_auto""",
    "x_raw_property_location": f"""
        SELECT u.risk_unit_id AS location_id, u.policy_id, u.slot + 1 AS location_sequence, p.primary_state AS state,
               'Z' || (u.pk % 1000) AS zip_code,
               ['office','retail','warehouse','manufacturing'][u.pk % 4 + 1] AS occupancy,
               ['frame','masonry','noncombustible','fire_resistive'][u.pk // 4 % 4 + 1] AS construction_type,
               (1950 + u.pk % 45)::INTEGER AS year_built, (1 + u.pk % 10)::INTEGER AS protection_class,
               {cents("25000000 + (u.pk * 104729) % 775000000")} AS total_insured_value,
               'policy_admin_property_sim' AS source_system, 'batch-1' AS load_batch_id,
               TIMESTAMP '2002-01-01' AS ingested_at
        FROM x_units u JOIN x_raw_policy p ON p.policy_id = u.policy_id WHERE NOT u.is_auto""",
    # pricing view of a policy
    "x_priced": """
        SELECT p.policy_id, p.primary_state AS state, p.underwriting_tier AS risk_class,
               coalesce((SELECT arg_min(v.vehicle_type, v.vehicle_sequence) FROM x_raw_vehicle v
                         WHERE v.policy_id = p.policy_id), 'NA') AS vehicle_segment,
               p.effective_date, p.expiration_date, p.cancellation_date, p.term_months,
               coalesce(c.premium, 0)::DECIMAL(18,2) AS written_premium
        FROM x_raw_policy p
        LEFT JOIN (SELECT policy_id, sum(written_premium) AS premium FROM x_raw_policy_coverage GROUP BY ALL) c
          ON c.policy_id = p.policy_id""",
    # assumption tables
    "x_config": """SELECT * FROM (VALUES ('v1', 1, 1, 0), ('v2', 1, 0, 0), ('v3', 0, 0, 0))
        t(segmentation_version, use_state, use_risk_class, use_vehicle_segment)""",
    "x_segment_years": f"""
        SELECT segmentation_version, if(use_state = 1, p.state, 'ALL') AS state,
               if(use_risk_class = 1, p.risk_class, 'ALL') AS risk_class,
               if(use_vehicle_segment = 1, p.vehicle_segment, 'ALL') AS vehicle_segment,
               year(c.loss_date)::INTEGER AS accident_year, count(*) AS claims,
               sum(c.ultimate_cents)::BIGINT AS cents
        FROM x_claimed c JOIN x_priced p ON p.policy_id = c.policy_id CROSS JOIN x_config
        WHERE c.reported_date <= {AS_OF} GROUP BY ALL""",
    "x_ldf_selection_table": """
        SELECT segmentation_version, t.triangle_type, state, risk_class, vehicle_segment,
               2001 - accident_year AS development,
               CASE WHEN (2001 - accident_year + t.i) % 4 = 3 THEN 1.02::DOUBLE END AS ldf,
               ['weighted','avg','last3_weighted','other'][(2001 - accident_year + t.i) % 4 + 1] AS method,
               'initial selection' AS description
        FROM x_segment_years, (VALUES ('paid', 0), ('incurred', 1), ('claim_count', 2)) t(triangle_type, i)""",
    "x_selected_ultimate": """
        SELECT segmentation_version, k.type, state, risk_class, vehicle_segment, accident_year, m.method,
               if(k.type = 'loss', (cents * m.pct // 100) / 100.0::DOUBLE, (claims + m.i)::DOUBLE) AS ultimate,
               'derived' AS comment
        FROM x_segment_years, (VALUES ('loss'), ('claim_count')) k(type),
             (VALUES ('BF', 0, 100), ('Cape_cod', 1, 102), ('Judgement', 2, 105)) m(method, i, pct)""",
    "x_ultimate_selection": """
        SELECT segmentation_version, k.type, state, risk_class, vehicle_segment, accident_year,
               if(k.type = 'loss',
                  ['BF','Cape_cod','Judgement','Chain_ladder_incurred','Chain_ladder_paid'][accident_year % 5 + 1],
                  ['BF','Cape_cod','Judgement','Chain_ladder'][accident_year % 4 + 1]) AS method,
               'derived' AS comment
        FROM x_segment_years, (VALUES ('loss'), ('claim_count')) k(type)
        WHERE accident_year > (SELECT min(accident_year) FROM x_segment_years)""",
    "x_segments": "SELECT DISTINCT segmentation_version, state, risk_class, vehicle_segment FROM x_segment_years",
    "x_trend_selection": """
        SELECT segmentation_version, t.trend_type, state, risk_class, vehicle_segment, t.annual_trend::DOUBLE
                   AS annual_trend, DATE '2002-01-01' AS effective_from, DATE '2002-12-31' AS effective_to,
               'derived' AS description
        FROM x_segments, (VALUES ('frequency', 0.04), ('severity', 0.05)) t(trend_type, annual_trend)""",
    "x_expense_assumption": """
        SELECT DISTINCT 'p1' AS pricing_version, state, 50.0::DOUBLE AS fixed_expense_per_exposure,
               0.2::DOUBLE AS variable_expense_ratio, 0.05::DOUBLE AS ulae_ratio, 0.05::DOUBLE AS profit_ratio,
               0.7::DOUBLE AS target_loss_ratio FROM x_segments""",
    "x_rate_level_history": """
        SELECT concat_ws('-', 'F', state, risk_class, vehicle_segment, k.k) AS filing_id,
               make_date((1998 + k.k)::BIGINT, 1::BIGINT, 1::BIGINT) AS effective_date, state, risk_class, vehicle_segment,
               k.k / 100.0::DOUBLE AS rate_change_pct, (100 + 3 * k.k + n % 7) / 100.0::DOUBLE AS cumulative_factor
        FROM (SELECT state, risk_class, vehicle_segment, count(*) AS n FROM x_priced GROUP BY ALL),
             (VALUES (1), (2), (3)) k(k)""",
    "x_development_pool_mapping": """
        SELECT DISTINCT 'LOB_' || line_of_business AS development_pool_id, 'line_of_business' AS pool_level,
               line_of_business, product_id, coverage_code
        FROM x_raw_policy_coverage c JOIN x_raw_policy p ON p.policy_id = c.policy_id
        UNION ALL
        SELECT DISTINCT 'AUTO_PHYSICAL_DAMAGE', 'coverage_group', line_of_business, product_id, coverage_code
        FROM x_raw_policy_coverage c JOIN x_raw_policy p ON p.policy_id = c.policy_id
        WHERE coverage_code IN ('AUTO_COLL', 'AUTO_COMP')""",
    "x_previous_ldf": """
        SELECT * REPLACE (ldf - 0.01 AS ldf) FROM x_ldf_selection_table WHERE development > 0
        UNION ALL
        SELECT * REPLACE (development + 100 AS development) FROM x_ldf_selection_table WHERE development = 2""",
    "x_table_rows": """
        SELECT 'ldf_selection' AS assumption_type, 'ldf_selection_table.xlsx' AS file_name,
               'LDF_SELECTION_TABLE' AS target_table_name, count(*) AS n FROM x_ldf_selection_table
        UNION ALL SELECT 'selected_ultimate', 'selected_ultimate.xlsx', 'SELECTED_ULTIMATE', count(*)
        FROM x_selected_ultimate
        UNION ALL SELECT 'ultimate_selection', 'ultimate_selection.xlsx', 'ULTIMATE_SELECTION', count(*)
        FROM x_ultimate_selection
        UNION ALL SELECT 'trend_selection', 'trend_selection.xlsx', 'TREND_SELECTION', count(*)
        FROM x_trend_selection
        UNION ALL SELECT 'expense_assumption', 'expense_assumption.xlsx', 'EXPENSE_ASSUMPTION', count(*)
        FROM x_expense_assumption""",
    "x_assumption_version": """
        SELECT assumption_type || '-' || s.s AS assumption_set_id, assumption_type, file_name, target_table_name,
               s.s::BIGINT AS version_sequence, 'auto_v' || s.s AS version_label, 'uploaded' AS status,
               TIMESTAMP '2002-01-01' AS uploaded_at, 'actuary' AS uploaded_by, NULL::VARCHAR AS upload_comment,
               n AS source_row_count, if(s.s = 1, n, 0) AS change_count,
               CASE WHEN s.s = 2 THEN assumption_type || '-1' END AS previous_assumption_set_id,
               'pricing' AS dag_id, 'run-' || s.s AS dag_run_id, 'upload' AS task_id
        FROM x_table_rows, (VALUES (1), (2)) s(s)""",
}
