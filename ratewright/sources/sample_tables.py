"""Adapter: an order-entry star schema read as an insurance book.

Orders become policies, order lines become coverages, and integer rules on their
keys derive vehicles, drivers, locations, premium movements, claims and claim
payments. Every rule is deterministic integer arithmetic, so another engine can
evaluate it and get the same cents.
"""

from __future__ import annotations

from datetime import date
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewright.functions.dates import actual_end, day
from ratewright.functions.money import div_floor, from_cents
from ratewright.params import Params
from ratewright.session import materialize
from ratewright.sources import rest, schemas
from ratewright.sources.tables import concat_with_schema, stamp_load_metadata

SAMPLE_PARAMS = Params(as_of=date(2001, 12, 31), calendar_start=date(1994, 1, 1), calendar_end=date(2004, 1, 1))

# Fixed values.
STATES = ["CA", "TX", "FL", "NY", "IL", "PA", "OH", "GA", "NC", "MI"]
TIER_BY_MARKET = {
    "AUTOMOBILE": "preferred",
    "BUILDING": "standard",
    "HOUSEHOLD": "standard",
    "FURNITURE": "nonstandard",
    "MACHINERY": "high_risk",
}
AUTO_COVERAGE_CODES = ["AUTO_BI", "AUTO_PD", "AUTO_COLL", "AUTO_COMP"]
PROPERTY_COVERAGE_CODES = ["BUILDING", "BUSINESS_PERSONAL_PROPERTY"]
COVERAGE_FAMILY = {
    "AUTO_BI": "bodily_injury",
    "AUTO_PD": "property_damage_liability",
    "AUTO_COLL": "collision",
    "AUTO_COMP": "comprehensive",
    "BUILDING": "building",
    "BUSINESS_PERSONAL_PROPERTY": "business_personal_property",
}
VEHICLE_TYPES = ["sedan", "suv", "truck", "sports"]
USAGES = ["commute", "pleasure", "business"]
OCCUPANCIES = ["office", "retail", "warehouse", "manufacturing"]
CONSTRUCTIONS = ["frame", "masonry", "noncombustible", "fire_resistive"]
# month after report, cumulative paid %, outstanding reserve %
AUTO_PATTERN = [(0, 0, 85), (1, 20, 65), (3, 50, 35), (6, 80, 20), (12, 100, 0)]
PROPERTY_PATTERN = [(0, 0, 90), (3, 10, 85), (6, 30, 65), (12, 65, 35), (24, 100, 0)]

LOAD_BATCH = "batch-1"
INGESTED_AT = "2002-01-01 00:00:00"


def pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def lookup(mapping: dict[str, str], key: Column) -> Column:
    expr = F.when(F.lit(False), F.lit(None).cast("string"))
    for k, v in mapping.items():
        expr = expr.when(key == k, v)
    return expr


def _is_auto(order_key: Column) -> Column:
    return order_key % 7 < 5


class SampleBook:
    """Raw insurance tables derived from one directory of test tables."""

    def __init__(
        self, spark: SparkSession, sf_dir: str, params: Params = SAMPLE_PARAMS, keep: bool = False,
        buckets: int = rest.BUCKETS,
    ) -> None:
        """``keep`` writes the bases that many tables are derived from once, for a load of all tables in ``buckets``."""
        self.spark = spark
        self.dir = sf_dir.rstrip("/")
        self.params = params
        self.keep = keep
        self.buckets = buckets

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        return materialize(df, name) if self.keep else df

    def _dealt(self, df: DataFrame, name: str, key: str) -> DataFrame:
        """The bases of a table dealt by its key as the table will have it, if one is given."""
        return df.repartition(self.buckets, F.col(key).cast(schemas.RAW[name][key].dataType)) if key else df

    def lying_by(self, name: str) -> dict[str, DataFrame]:
        """The copies of a raw table for a load, dealt before its columns are made: the bases are narrower."""
        dealt = {
            "raw_policy", "raw_policy_risk_unit", "raw_policy_coverage", "raw_premium_transaction", "raw_claim",
            "raw_claim_transaction", "raw_driver", "raw_driver_vehicle_assignment",
        }
        return {key: getattr(self, name)(key) for key in rest.LAYOUT.get(name, ()) if name in dealt}

    @cache  # noqa: B019 - plans only; one schema lookup per table
    def _source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def _stamp(self, df: DataFrame) -> DataFrame:
        return stamp_load_metadata(df, LOAD_BATCH, INGESTED_AT)

    # ---- shared bases -----------------------------------------------------

    @cache  # noqa: B019
    def _policy_terms(self) -> DataFrame:
        """Key, dates and line of business; needs no customer."""
        ok = F.col("o_orderkey")
        term = F.when(ok % 20 < 13, 6).otherwise(12)
        effective = F.col("o_orderdate").cast("date")
        return (
            self._source("orders")
            .select(
                ok.alias("policy_id"),
                F.col("o_custkey").alias("insured_id"),
                effective.alias("effective_date"),
                term.alias("term_months"),
                F.add_months(effective, term).alias("expiration_date"),
                F.when(ok % 12 == 0, F.date_add(effective, (1 + ok % 150).cast("int"))).alias("cancellation_date"),
                _is_auto(ok).alias("is_auto"),
            )
        )

    def _lines_by_order(self) -> DataFrame:
        """The order lines, hashed by order once: they are grouped in place and meet their policy in place."""
        return (
            self._source("lineitem")
            .select("l_orderkey", "l_linenumber", "l_partkey", F.floor("l_extendedprice").cast("bigint").alias("cents"))
            .repartition("l_orderkey")
        )

    @cache  # noqa: B019
    def _lines(self) -> DataFrame:
        """One row per (order, line number); the pair repeats in the source."""
        return (
            self._lines_by_order()
            .groupBy("l_orderkey", "l_linenumber")
            .agg(
                F.min("l_partkey").alias("pk"),
                F.sum("cents").alias("cents"),
            )
            .select(
                F.col("l_orderkey").alias("policy_id"),
                F.col("l_linenumber").alias("line"),
                "pk",
                "cents",
                (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("coverage_id"),
                (F.col("l_orderkey") * 10 + F.col("l_linenumber") % 2).alias("risk_unit_id"),
            )
        )

    @cache  # noqa: B019
    def _covered_lines(self) -> DataFrame:
        code = F.when(F.col("is_auto"), pick(AUTO_COVERAGE_CODES, F.col("line") % 4)).otherwise(
            pick(PROPERTY_COVERAGE_CODES, F.col("line") % 2)
        )
        covered = self._lines().join(self._policy_terms(), "policy_id").withColumn("coverage_code", code)
        return self._kept(covered, "covered_lines")

    @cache  # noqa: B019
    def _risk_bases(self) -> DataFrame:
        units = (
            self._lines_by_order()
            .groupBy(F.col("l_orderkey").alias("policy_id"), (F.col("l_linenumber") % 2).alias("slot"))
            .agg(F.min("l_partkey").alias("pk"))
            .withColumn("risk_unit_id", F.col("policy_id") * 10 + F.col("slot"))
        )
        return self._kept(units.join(self._policy_terms(), "policy_id"), "risk_bases")

    @cache  # noqa: B019
    def claim_bases(self) -> DataFrame:
        """Claimed coverages with their dates and ultimate in cents."""
        ok, line, pk = F.col("policy_id"), F.col("line"), F.col("pk")
        days = F.datediff(actual_end(F.col("expiration_date"), F.col("cancellation_date")), F.col("effective_date"))
        loss_date = F.date_add(F.col("effective_date"), ((pk * 31 + line) % days).cast("int"))
        return (
            self._covered_lines()
            .where((ok * 7 + line) % 9 == 0)
            .withColumn("loss_date", loss_date)
            .withColumn("reported_date", F.date_add(F.col("loss_date"), (1 + pk % 10).cast("int")))
            .withColumn("ultimate_cents", 50_000 + (pk * 7919) % 2_000_000)
            .withColumn("claim_id", F.col("coverage_id"))
        )

    # ---- raw tables -------------------------------------------------------

    @cache  # noqa: B019
    def raw_policy(self, dealt_by: str = "") -> DataFrame:
        customer = self._source("customer").select(
            F.col("c_custkey").alias("insured_id"), "c_nationkey", "c_mktsegment"
        )
        status = (
            F.when(F.col("cancellation_date").isNotNull(), "cancelled")
            .when(F.col("expiration_date") <= day(self.params.as_of), "expired")
            .otherwise("active")
        )
        auto = F.col("is_auto")
        return self._stamp(
            self._dealt(self._policy_terms().join(customer, "insured_id"), "raw_policy", dealt_by)
            .select(
                "policy_id",
                F.concat(F.when(auto, "PA").otherwise("CP"), F.col("policy_id").cast("string")).alias("policy_number"),
                "insured_id",
                F.when(auto, "pa_standard").otherwise("cp_standard").alias("product_id"),
                F.when(auto, "personal_auto").otherwise("commercial_property").alias("line_of_business"),
                "effective_date",
                "expiration_date",
                "cancellation_date",
                status.alias("status"),
                lookup(TIER_BY_MARKET, F.col("c_mktsegment")).alias("underwriting_tier"),
                pick(STATES, F.col("c_nationkey") % 10).alias("primary_state"),
                "term_months",
                F.when(auto, "policy_admin_auto_sim").otherwise("policy_admin_property_sim").alias("source_system"),
            )
        )

    @cache  # noqa: B019
    def raw_policy_risk_unit(self, dealt_by: str = "") -> DataFrame:
        auto = F.col("is_auto")
        return self._stamp(
            self._dealt(self._risk_bases(), "raw_policy_risk_unit", dealt_by).select(
                "risk_unit_id",
                "policy_id",
                F.when(auto, "vehicle").otherwise("property_location").alias("risk_unit_type"),
                F.col("risk_unit_id").alias("source_risk_unit_id"),
                "effective_date",
                "expiration_date",
                F.lit("active").alias("status"),
                F.when(auto, "car_year").otherwise("location_year").alias("exposure_unit"),
                F.when(auto, "policy_admin_auto_sim").otherwise("policy_admin_property_sim").alias("source_system"),
            )
        )

    @cache  # noqa: B019
    def raw_policy_coverage(self, dealt_by: str = "") -> DataFrame:
        code = F.col("coverage_code")
        insured_value = 25_000_000 + (F.col("pk") * 104_729) % 775_000_000
        limit_cents = (
            F.when(code == "AUTO_BI", F.lit(10_000_000).cast("bigint"))
            .when(F.col("is_auto"), F.lit(5_000_000).cast("bigint"))
            .when(code == "BUILDING", insured_value)
            .otherwise(div_floor(insured_value * 3, 4))
        )
        deductible_cents = (
            F.when(code.isin("AUTO_COLL", "AUTO_COMP"), 50_000)
            .when(F.col("is_auto"), 0)
            .when(code == "BUILDING", 1_000_000)
            .otherwise(500_000)
        ).cast("bigint")
        return self._stamp(
            self._dealt(self._covered_lines(), "raw_policy_coverage", dealt_by).select(
                "coverage_id",
                "policy_id",
                "risk_unit_id",
                "coverage_code",
                lookup(COVERAGE_FAMILY, code).alias("coverage_family"),
                "effective_date",
                "expiration_date",
                from_cents(limit_cents).alias("limit_amount"),
                from_cents(deductible_cents).alias("deductible_amount"),
                from_cents(F.col("cents")).alias("written_premium"),
                F.when(F.col("is_auto"), "policy_admin_auto_sim")
                .otherwise("policy_admin_property_sim")
                .alias("source_system"),
            )
        )

    @cache  # noqa: B019
    def raw_premium_transaction(self, dealt_by: str = "") -> DataFrame:
        ok, cents = F.col("policy_id"), F.col("cents")
        end = actual_end(F.col("expiration_date"), F.col("cancellation_date"))
        endorsed_on = F.date_add(F.col("effective_date"), (90 + ok % 60).cast("int"))
        endorsed = (F.col("line") % 4 == 0) & (endorsed_on < end)
        term_days = F.datediff(F.col("expiration_date"), F.col("effective_date"))
        endorsed_days = F.datediff(F.col("expiration_date"), endorsed_on)
        remaining = F.datediff(F.col("expiration_date"), F.col("cancellation_date"))
        endorsement_cents = F.when(endorsed, div_floor(cents, 10)).otherwise(F.lit(0).cast("bigint"))
        refund = div_floor(cents * remaining, term_days) + F.when(
            endorsed, div_floor(endorsement_cents * remaining, endorsed_days)
        ).otherwise(F.lit(0).cast("bigint"))

        def entry(step: int, kind: str, when: Column, change: Column, balance: Column, reason: str) -> Column:
            return F.struct(
                F.lit(step).alias("step"),
                F.lit(kind).alias("transaction_type"),
                when.alias("transaction_date"),
                F.lit(reason).alias("transaction_reason"),
                change.alias("change"),
                F.greatest(balance, F.lit(0).cast("bigint")).alias("balance"),
            )

        gross = cents + endorsement_cents
        entries = F.array(
            entry(1, "NEW_BUSINESS", F.col("effective_date"), cents, cents, "new_policy"),
            F.when(endorsed, entry(2, "ENDORSEMENT", endorsed_on, endorsement_cents, gross, "coverage_change")),
            F.when(
                F.col("cancellation_date").isNotNull(),
                entry(
                    3, "CANCELLATION", F.col("cancellation_date"), -refund, gross - refund,
                    "pro_rata_cancellation_refund",
                ),
            ),
        )
        return self._stamp(
            self._dealt(self._covered_lines(), "raw_premium_transaction", dealt_by)
            .select("policy_id", "coverage_id", F.explode(F.array_compact(entries)).alias("t"))
            .select(
                (F.col("coverage_id") * 10 + F.col("t.step")).alias("transaction_id"),
                "policy_id",
                "coverage_id",
                "t.transaction_type",
                "t.transaction_date",
                "t.transaction_reason",
                from_cents(F.col("t.change")).alias("premium_change"),
                from_cents(F.col("t.balance")).alias("cumulative_premium"),
                F.lit("billing_sim").alias("source_system"),
            )
        )

    @cache  # noqa: B019
    def raw_claim(self, dealt_by: str = "") -> DataFrame:
        even = F.col("pk") % 2 == 0
        code = F.col("coverage_code")
        claim_type = (
            F.when(code == "AUTO_BI", "bodily_injury")
            .when(code == "AUTO_PD", "property_damage")
            .when(code == "AUTO_COLL", "collision")
            .when(code == "AUTO_COMP", F.when(even, "weather").otherwise("theft"))
            .when(code == "BUILDING", F.when(even, "fire").otherwise("wind_hail"))
            .otherwise(F.when(even, "water").otherwise("theft"))
        )
        cause_code = (
            F.when(code.isin("AUTO_BI", "AUTO_PD", "AUTO_COLL"), "at_fault")
            .when(code == "AUTO_COMP", F.when(even, "weather").otherwise("theft"))
            .when(code == "BUILDING", F.when(even, "fire").otherwise("weather"))
            .otherwise(F.when(even, "water").otherwise("theft"))
        )
        closes = F.add_months(F.col("reported_date"), F.when(F.col("is_auto"), 12).otherwise(24))
        return self._stamp(
            self._dealt(self.claim_bases(), "raw_claim", dealt_by).select(
                "claim_id",
                "policy_id",
                "risk_unit_id",
                "coverage_id",
                "coverage_code",
                "loss_date",
                "reported_date",
                claim_type.alias("claim_type"),
                cause_code.alias("cause_code"),
                F.when(closes <= day(self.params.as_of), "closed").otherwise("open").alias("claim_status"),
                F.when(F.col("is_auto"), "claims_admin_auto_sim")
                .otherwise("claims_admin_property_sim")
                .alias("source_system"),
            )
        )

    @cache  # noqa: B019
    def raw_claim_transaction(self, dealt_by: str = "") -> DataFrame:
        ultimate = F.col("ultimate_cents")

        def steps(pattern: list[tuple[int, int, int]]) -> Column:
            """The pattern as constants: step, day, and paid and reserve % now and before."""
            rows, paid_before, reserve_before = [], 0, 0
            for step, (month, paid, reserve) in enumerate(pattern):
                values = {
                    "step": step,
                    "days": 30 * month,
                    "paid": paid,
                    "paid_before": paid_before,
                    "reserve": reserve,
                    "reserve_before": reserve_before,
                }
                rows.append(F.struct(*[F.lit(v).alias(k) for k, v in values.items()]))
                paid_before, reserve_before = paid, reserve
            return F.array(*rows)

        def share(pct: str) -> Column:
            return div_floor(ultimate * F.col(f"s.{pct}"), 100)

        def expense(pct: str) -> Column:
            return div_floor(share(pct) * 8, 100)

        pattern = F.when(F.col("is_auto"), steps(AUTO_PATTERN)).otherwise(steps(PROPERTY_PATTERN))
        moves = (
            self._dealt(self.claim_bases(), "raw_claim_transaction", dealt_by)
            .select("claim_id", "reported_date", "ultimate_cents", F.explode(pattern).alias("s"))
            .select(
                "claim_id",
                F.struct(
                    F.col("s.step").alias("step"),
                    F.date_add("reported_date", F.col("s.days")).alias("on"),
                    (share("paid") - share("paid_before")).alias("paid"),
                    (share("reserve") - share("reserve_before")).alias("reserve"),
                    (expense("reserve") - expense("reserve_before")).alias("case_expense"),
                ).alias("t"),
            )
        )
        paid_expense = div_floor(F.col("t.paid"), 10)
        recovery = div_floor(F.col("t.paid") * 5, 100)
        incurred = F.col("t.paid") + F.col("t.reserve") + paid_expense + F.col("t.case_expense") - recovery
        return self._stamp(
            moves.select(
                (F.col("claim_id") * 10 + F.col("t.step")).alias("transaction_id"),
                "claim_id",
                F.when(F.col("t.step") == 0, "RESERVE_SET").otherwise("PAYMENT").alias("transaction_type"),
                F.col("t.on").alias("transaction_date"),
                from_cents(F.col("t.paid")).alias("paid_loss_change"),
                from_cents(F.col("t.reserve")).alias("case_reserve_change"),
                from_cents(paid_expense).alias("paid_expense_change"),
                from_cents(F.col("t.case_expense")).alias("case_expense_change"),
                from_cents(recovery).alias("recovery_change"),
                from_cents(incurred).alias("incurred_loss_change"),
                F.lit("claims_admin_transaction_sim").alias("source_system"),
            )
        )

    @cache  # noqa: B019
    def raw_vehicle(self) -> DataFrame:
        pk = F.col("pk")
        part = self._source("part").select(F.col("p_partkey").alias("pk"), "p_size")
        state = self.raw_policy().select("policy_id", "primary_state")
        make_models = [("Toyota", "Camry"), ("Toyota", "RAV4"), ("Ford", "F-150"), ("Ford", "Mustang")]
        kind = F.col("p_size") % 4
        return self._stamp(
            self._risk_bases()
            .where("is_auto")
            .join(state, "policy_id")
            .join(part, "pk")
            .select(
                F.col("risk_unit_id").alias("vehicle_id"),
                "policy_id",
                (F.col("slot") + 1).alias("vehicle_sequence"),
                (F.year("effective_date") - pk % 15).cast("int").alias("model_year"),
                pick([m for m, _ in make_models], kind).alias("make"),
                pick([m for _, m in make_models], kind).alias("model"),
                pick(VEHICLE_TYPES, kind).alias("vehicle_type"),
                F.col("primary_state").alias("garaging_state"),
                (4000 + (pk * 37) % 21_000).cast("int").alias("annual_mileage"),
                pick(USAGES, pk % 3).alias("usage"),
                (pk % 2).cast("int").alias("safety_device_flag"),
                F.lit("policy_admin_auto_sim").alias("source_system"),
            )
        )

    @cache  # noqa: B019
    def raw_driver(self, dealt_by: str = "") -> DataFrame:
        cust = F.col("insured_id")
        return self._stamp(
            self._dealt(self._policy_terms().where("is_auto"), "raw_driver", dealt_by)
            .select(
                (F.col("policy_id") * 10 + 1).alias("driver_id"),
                "policy_id",
                F.lit(1).alias("driver_sequence"),
                F.date_sub(F.col("effective_date"), (6600 + (cust * 97) % 18_000).cast("int")).alias("date_of_birth"),
                pick(["F", "M", "X"], cust % 3).alias("gender"),
                div_floor((cust * 97) % 18_000, 365).cast("int").alias("years_licensed"),
                (cust % 3).cast("int").alias("prior_accidents"),
                (cust % 4).cast("int").alias("prior_violations"),
                pick(["single", "married", "divorced"], cust % 3).alias("marital_status"),
                pick(["A", "B", "C", "D"], cust % 4).alias("credit_tier"),
                F.lit("policy_admin_auto_sim").alias("source_system"),
            )
        )

    @cache  # noqa: B019
    def raw_driver_vehicle_assignment(self, dealt_by: str = "") -> DataFrame:
        return self._stamp(
            self._dealt(self._risk_bases().where("is_auto"), "raw_driver_vehicle_assignment", dealt_by)
            .select(
                F.col("risk_unit_id").alias("assignment_id"),
                "policy_id",
                (F.col("policy_id") * 10 + 1).alias("driver_id"),
                F.col("risk_unit_id").alias("vehicle_id"),
                F.lit("PRIMARY").alias("assignment_type"),
                "effective_date",
                "expiration_date",
                F.lit("policy_admin_auto_sim").alias("source_system"),
            )
        )

    @cache  # noqa: B019
    def raw_property_location(self) -> DataFrame:
        pk = F.col("pk")
        state = self.raw_policy().select("policy_id", "primary_state")
        return self._stamp(
            self._risk_bases()
            .where("not is_auto")
            .join(state, "policy_id")
            .select(
                F.col("risk_unit_id").alias("location_id"),
                "policy_id",
                (F.col("slot") + 1).alias("location_sequence"),
                F.col("primary_state").alias("state"),
                F.concat(F.lit("Z"), (pk % 1000).cast("string")).alias("zip_code"),
                pick(OCCUPANCIES, pk % 4).alias("occupancy"),
                pick(CONSTRUCTIONS, div_floor(pk, 4) % 4).alias("construction_type"),
                (1950 + pk % 45).cast("int").alias("year_built"),
                (1 + pk % 10).cast("int").alias("protection_class"),
                from_cents(25_000_000 + (pk * 104_729) % 775_000_000).alias("total_insured_value"),
                F.lit("policy_admin_property_sim").alias("source_system"),
            )
        )

    def all_risk_units(self) -> DataFrame:
        """Vehicles and locations stacked; each lacks columns of the other."""
        return concat_with_schema(
            [self.raw_vehicle(), self.raw_property_location()],
            ["vehicle_id", "location_id", "policy_id", "model_year", "year_built", "usage", "occupancy"],
        )
