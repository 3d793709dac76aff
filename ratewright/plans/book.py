"""The pricing lineage of one book of business.

Every attribute is a lazy DataFrame built from the ones it depends on. Two small
results feed many consumers, the pricing triangle and the policy exposure; they
are written once to the shared folder and read back (see ``materialize``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewright.functions.segments import FINEST, segmentation_config
from ratewright.operators import calendar, claims, controls, core, exposure, features, ldf, pricing, triangle, ultimate
from ratewright.params import Params
from ratewright.session import materialize
from ratewright.sources import rest, schemas, staging, tables


class Book:
    def __init__(
        self,
        spark: SparkSession,
        source: Callable[[str], DataFrame],
        params: Params,
        by_key: Callable[[str, str], DataFrame] | None = None,
    ) -> None:
        """``by_key(name, key)`` gives the copy of a table that lies by a key, where tables have several."""
        self.spark = spark
        self.source = source
        self.params = params
        self.by_key = by_key or (lambda name, key: source(name))

    @classmethod
    def at_rest(cls, spark: SparkSession, root: str, params: Params | None = None) -> Book:
        """A book whose tables were written by ``rest.write_at_rest``."""
        read = rest.source_at_rest(spark, root)
        return cls(spark, read, params or Params(), read)

    @classmethod
    def from_tables(cls, spark: SparkSession, root: str, params: Params | None = None, fmt: str = "parquet") -> Book:
        """A book whose input tables lie below one folder."""

        def read(name: str) -> DataFrame:
            for registry, reader in (
                (schemas.RAW, tables.read_raw),
                (schemas.ASSUMPTIONS, tables.read_assumption),
                (schemas.GOVERNANCE, tables.read_governance),
                (schemas.SEEDS, tables.read_seed),
            ):
                if name in registry:
                    return reader(spark, root, name, fmt)
            raise KeyError(f"unknown table {name!r}")

        return cls(spark, read, params or Params())

    # ---- staging ----------------------------------------------------------------

    @cached_property
    def stg_policy(self) -> DataFrame:
        return staging.stg_policy(self.source("raw_policy"))

    @cached_property
    def stg_policy_risk_unit(self) -> DataFrame:
        return staging.stg_policy_risk_unit(self.source("raw_policy_risk_unit"))

    @cached_property
    def stg_policy_coverage(self) -> DataFrame:
        return staging.stg_policy_coverage(self.source("raw_policy_coverage"))

    @cached_property
    def stg_policy_coverage_by_coverage(self) -> DataFrame:
        """The same rows, lying by coverage where that copy exists."""
        return staging.stg_policy_coverage(self.by_key("raw_policy_coverage", "coverage_id"))

    @cached_property
    def stg_premium_transaction(self) -> DataFrame:
        return staging.stg_premium_transaction(self.source("raw_premium_transaction"))

    @cached_property
    def stg_claim(self) -> DataFrame:
        return staging.stg_claim(self.source("raw_claim"))

    @cached_property
    def stg_claim_transaction(self) -> DataFrame:
        return staging.stg_claim_transaction(self.source("raw_claim_transaction"))

    @cached_property
    def stg_vehicle(self) -> DataFrame:
        return staging.stg_vehicle(self.source("raw_vehicle"))

    @cached_property
    def stg_driver(self) -> DataFrame:
        return staging.stg_driver(self.source("raw_driver"))

    @cached_property
    def stg_driver_vehicle_assignment(self) -> DataFrame:
        return staging.stg_driver_vehicle_assignment(self.source("raw_driver_vehicle_assignment"))

    @cached_property
    def stg_property_location(self) -> DataFrame:
        return staging.stg_property_location(self.source("raw_property_location"))

    @property
    def _version(self) -> str:
        return self.params.segmentation_version

    @cached_property
    def stg_ldf_selection_table(self) -> DataFrame:
        return staging.stg_ldf_selection_table(self.source("ldf_selection_table"), self._version)

    @cached_property
    def stg_selected_ultimate_loss(self) -> DataFrame:
        return staging.stg_selected_ultimate_loss(self.source("selected_ultimate"), self._version)

    @cached_property
    def stg_selected_ultimate_claim_count(self) -> DataFrame:
        return staging.stg_selected_ultimate_claim_count(self.source("selected_ultimate"), self._version)

    @cached_property
    def stg_ultimate_selection_loss(self) -> DataFrame:
        return staging.stg_ultimate_selection_loss(self.source("ultimate_selection"), self._version)

    @cached_property
    def stg_ultimate_selection_claim_count(self) -> DataFrame:
        return staging.stg_ultimate_selection_claim_count(self.source("ultimate_selection"), self._version)

    @cached_property
    def stg_trend_selection(self) -> DataFrame:
        return staging.stg_trend_selection(self.source("trend_selection"), self._version)

    @cached_property
    def stg_expense_assumption(self) -> DataFrame:
        return staging.stg_expense_assumption(self.source("expense_assumption"))

    @cached_property
    def stg_rate_level_history(self) -> DataFrame:
        return staging.stg_rate_level_history(self.source("rate_level_history"))

    # ---- core -------------------------------------------------------------------

    @cached_property
    def dim_policy(self) -> DataFrame:
        return core.dim_policy(self.stg_policy)

    @cached_property
    def dim_risk_unit(self) -> DataFrame:
        return core.dim_risk_unit(self.stg_policy_risk_unit)

    @cached_property
    def dim_coverage(self) -> DataFrame:
        return core.dim_coverage(self.stg_policy_coverage)

    @cached_property
    def fct_claim(self) -> DataFrame:
        return core.fct_claim(self.stg_claim)

    @cached_property
    def fct_claim_transaction(self) -> DataFrame:
        return core.fct_claim_transaction(self.stg_claim_transaction)

    @cached_property
    def fct_premium_transaction(self) -> DataFrame:
        return core.fct_premium_transaction(self.stg_premium_transaction)

    @cached_property
    def dim_calendar_month(self) -> DataFrame:
        bounds = calendar.calendar_bounds(self.spark, self.params.calendar_start, self.params.calendar_end)
        return calendar.dim_calendar_month(bounds)

    # ---- exposure ---------------------------------------------------------------

    @cached_property
    def coverage_active_period(self) -> DataFrame:
        return exposure.coverage_active_period(self.stg_policy_coverage, self.stg_policy, self.stg_policy_risk_unit)

    def _coverage_month(self, periods: DataFrame) -> DataFrame:
        return exposure.coverage_month(periods, self.params.calendar_start, self.params.calendar_end)

    @cached_property
    def coverage_month(self) -> DataFrame:
        return self._coverage_month(self.coverage_active_period)

    @cached_property
    def coverage_month_by_coverage(self) -> DataFrame:
        """The same rows, hashed by coverage before the months are listed."""
        return self._coverage_month(self.coverage_active_period.repartition("coverage_id"))

    @cached_property
    def coverage_month_by_unit(self) -> DataFrame:
        """The same rows, hashed by risk unit as the earned exposure is."""
        return self._coverage_month(self.coverage_active_period.repartition("risk_unit_id"))

    @cached_property
    def earned_exposure_month(self) -> DataFrame:
        return self._earned_exposure(self.coverage_active_period, "risk_unit_id")  # as the periods lie after their joins

    @cached_property
    def earned_exposure_month_by_coverage(self) -> DataFrame:
        """The same rows, hashed by coverage, for joins on it."""
        return self._earned_exposure(self.coverage_active_period, "coverage_id")

    def _earned_exposure(self, periods: DataFrame, key: str) -> DataFrame:
        # hashing the periods before they expand keeps the months off the network
        return exposure.earned_exposure_month(self._coverage_month(periods.repartition(key)))

    @cached_property
    def premium_earning_segments(self) -> DataFrame:
        return exposure.premium_earning_segments(self.stg_premium_transaction, self.stg_policy_coverage_by_coverage)

    @cached_property
    def earned_premium_month(self) -> DataFrame:
        return exposure.earned_premium_month(
            self.stg_premium_transaction,
            self.stg_policy_coverage_by_coverage,
            self.params.calendar_start,
            self.params.calendar_end,
        )

    @cached_property
    def fct_exposure(self) -> DataFrame:
        return core.fct_exposure(
            self.earned_exposure_month_by_coverage,
            self.earned_premium_month,
            self.dim_policy,
            self.dim_risk_unit,
            self.dim_coverage,
        )

    @cached_property
    def priced_policy(self) -> DataFrame:
        return exposure.priced_policy(self.stg_policy, self.stg_policy_coverage, self.stg_vehicle)

    @cached_property
    def policy_exposure(self) -> DataFrame:
        return materialize(exposure.policy_exposure(self.priced_policy, self._version), "policy_exposure")

    # ---- features ---------------------------------------------------------------

    @cached_property
    def auto_exposure_attributes(self) -> DataFrame:
        return features.auto_exposure_attributes(
            self.coverage_active_period,
            self.dim_policy,
            self.dim_risk_unit,
            self.stg_vehicle,
            self.stg_driver_vehicle_assignment,
            self.stg_driver,
            self.params.calendar_start,
            self.params.calendar_end,
        )

    @cached_property
    def property_exposure_attributes(self) -> DataFrame:
        return features.property_exposure_attributes(
            self.coverage_active_period,
            self.dim_policy,
            self.dim_risk_unit,
            self.stg_property_location,
            self.params.calendar_start,
            self.params.calendar_end,
        )

    @cached_property
    def fct_exposure_attribute(self) -> DataFrame:
        return features.fct_exposure_attribute(self.auto_exposure_attributes, self.property_exposure_attributes)

    # ---- claims -----------------------------------------------------------------

    @cached_property
    def valuation_dates(self) -> DataFrame:
        return calendar.valuation_dates(self.dim_calendar_month, self.fct_claim, self.params.as_of)

    @cached_property
    def claim_financial_events(self) -> DataFrame:
        return claims.claim_financial_events(self.fct_claim, self.fct_claim_transaction)

    @cached_property
    def claim_financial_state_cumulative(self) -> DataFrame:
        return claims.claim_financial_state_cumulative(self.claim_financial_events, self.params.as_of)

    @cached_property
    def claim_financial_state_period(self) -> DataFrame:
        return claims.claim_financial_state_period(self.claim_financial_state_cumulative)

    @cached_property
    def claim_valuation_snapshot(self) -> DataFrame:
        return claims.claim_valuation_snapshot(
            self.claim_financial_state_period,
            self.fct_claim,
            self.dim_policy,
            self.dim_coverage,
            self.params.as_of,
            self.params.calendar_start,
        )

    @cached_property
    def claim_development(self) -> DataFrame:
        return claims.claim_development(self.claim_valuation_snapshot)

    # ---- product triangle ---------------------------------------------------------

    @cached_property
    def loss_triangle(self) -> DataFrame:
        return triangle.loss_triangle_from_events(
            self.fct_claim,
            self.fct_claim_transaction,
            self.dim_policy,
            self.dim_coverage,
            self.params.as_of,
            self.params.calendar_start,
        )

    @cached_property
    def loss_triangle_pooled(self) -> DataFrame:
        return triangle.loss_triangle_pooled(self.loss_triangle, self.source("development_pool_mapping"))

    @cached_property
    def ldf_observations(self) -> DataFrame:
        return triangle.ldf_observations(self.loss_triangle)

    # ---- pricing triangle and chain ladder ------------------------------------------

    @cached_property
    def claim_snapshot(self) -> DataFrame:
        """Position of every claim at every month end, for review."""
        return claims.claim_snapshot(
            self.claim_financial_state_cumulative, self.fct_claim, self.params.as_of, self.params.calendar_start
        )

    @cached_property
    def claim_snapshot_year_end(self) -> DataFrame:
        """The valuations of the pricing triangle; several controls read it, so it is written once."""
        return materialize(
            claims.claim_snapshot(
                self.claim_financial_state_cumulative,
                self.fct_claim,
                self.params.as_of,
                self.params.calendar_start,
                year_end_only=True,
            ),
            "claim_snapshot_year_end",
        )

    @cached_property
    def claim_triangle_cumulative(self) -> DataFrame:
        return materialize(
            triangle.claim_triangle_from_events(
                self.fct_claim,
                self.fct_claim_transaction,
                self.priced_policy,
                self.params.as_of,
                self.params.calendar_start,
                self._version,
            ),
            "claim_triangle_cumulative",
        )

    @cached_property
    def claim_triangle_versions(self) -> DataFrame:
        """The pricing triangle under every version of the segmentation config, from one aggregation."""
        finest = triangle.claim_triangle_from_events(
            self.fct_claim,
            self.fct_claim_transaction,
            self.priced_policy,
            self.params.as_of,
            self.params.calendar_start,
            FINEST,
        )
        return triangle.claim_triangle_versions(finest, segmentation_config(self.spark))

    @cached_property
    def claim_triangle_incremental(self) -> DataFrame:
        return triangle.claim_triangle_incremental(self.claim_triangle_cumulative)

    @cached_property
    def ldf_raw(self) -> DataFrame:
        return ldf.ldf_raw(self.claim_triangle_cumulative)

    @cached_property
    def ldf_avg(self) -> DataFrame:
        return ldf.ldf_avg(self.ldf_raw)

    @cached_property
    def ldf_weighted(self) -> DataFrame:
        return ldf.ldf_weighted(self.claim_triangle_cumulative)

    @cached_property
    def ldf_last3_weighted(self) -> DataFrame:
        return ldf.ldf_last3_weighted(self.claim_triangle_cumulative)

    def ldf_selected(self, measure: str) -> DataFrame:
        return ldf.ldf_selected(
            self.stg_ldf_selection_table,
            self.ldf_avg,
            self.ldf_weighted,
            self.ldf_last3_weighted,
            measure,
            self.params.tail_factor,
        )

    def cdf(self, measure: str) -> DataFrame:
        return ldf.cdf(self.ldf_selected(measure), measure)

    def cdf_by_month(self, measure: str) -> DataFrame:
        return ldf.cdf_by_month(self.cdf(measure), hold_tail=self.params.tail_factor is not None)

    def ultimate_chain_ladder(self, measure: str) -> DataFrame:
        return ultimate.ultimate_chain_ladder(self.claim_triangle_cumulative, self.cdf_by_month(measure), measure)

    # ---- marts ------------------------------------------------------------------

    @cached_property
    def fct_ultimate_loss(self) -> DataFrame:
        return ultimate.fct_ultimate_loss(
            self.ultimate_chain_ladder("incurred"), self.ultimate_chain_ladder("paid"), self.stg_selected_ultimate_loss
        )

    @cached_property
    def fct_ultimate_claim_count(self) -> DataFrame:
        return ultimate.fct_ultimate_claim_count(
            self.ultimate_chain_ladder("claim_count"), self.stg_selected_ultimate_claim_count
        )

    @cached_property
    def fct_selected_ultimate_loss(self) -> DataFrame:
        return ultimate.fct_selected_ultimate_loss(self.stg_ultimate_selection_loss, self.fct_ultimate_loss)

    @cached_property
    def fct_selected_ultimate_claim_count(self) -> DataFrame:
        return ultimate.fct_selected_ultimate_claim_count(
            self.stg_ultimate_selection_claim_count, self.fct_ultimate_claim_count
        )

    @cached_property
    def fct_frequency_severity(self) -> DataFrame:
        return pricing.fct_frequency_severity(
            self.fct_selected_ultimate_claim_count, self.fct_selected_ultimate_loss, self.policy_exposure
        )

    @cached_property
    def fct_frequency_severity_trended(self) -> DataFrame:
        return pricing.fct_frequency_severity_trended(self.fct_frequency_severity, self.stg_trend_selection)

    @cached_property
    def fct_pure_premium(self) -> DataFrame:
        return pricing.fct_pure_premium(self.fct_frequency_severity_trended)

    @cached_property
    def fct_indicated_premium(self) -> DataFrame:
        return pricing.fct_indicated_premium(
            self.fct_pure_premium, self.stg_expense_assumption, self.params.pricing_version
        )

    @cached_property
    def mart_indicated_rate_change_pure_premium(self) -> DataFrame:
        return pricing.mart_indicated_rate_change_pure_premium(
            self.fct_indicated_premium, self.stg_rate_level_history, self._version
        )

    # ---- controls ---------------------------------------------------------------

    @cached_property
    def mart_control_totals_financial_summary(self) -> DataFrame:
        return controls.mart_control_totals_financial_summary(
            self.priced_policy, self.policy_exposure, self.claim_snapshot_year_end, self.claim_triangle_cumulative
        )

    @cached_property
    def mart_control_tolerance_by_metric(self) -> DataFrame:
        return controls.mart_control_tolerance_by_metric(self.mart_control_totals_financial_summary)

    @cached_property
    def mart_reconciliation_by_segment(self) -> DataFrame:
        return controls.mart_reconciliation_by_segment(
            self.claim_snapshot_year_end,
            self.priced_policy,
            self.claim_triangle_cumulative,
            self.policy_exposure,
            self._version,
        )

    @cached_property
    def mart_assumption_impact_reconciliation(self) -> DataFrame:
        return controls.mart_assumption_impact_reconciliation(
            self.fct_selected_ultimate_loss,
            self.fct_selected_ultimate_claim_count,
            self.fct_ultimate_loss,
            self.fct_ultimate_claim_count,
            self.stg_trend_selection,
            self.params.baseline_loss_method,
            self.params.baseline_count_method,
        )

    @cached_property
    def mart_reserve_pricing_movement_attribution(self) -> DataFrame:
        return controls.mart_reserve_pricing_movement_attribution(
            self.fct_frequency_severity,
            self.fct_frequency_severity_trended,
            self.fct_indicated_premium,
            self.mart_assumption_impact_reconciliation,
        )

    @cached_property
    def mart_incurred_coverage(self) -> DataFrame:
        return controls.mart_incurred_coverage(self.ldf_raw, self.ldf_selected("incurred"))
