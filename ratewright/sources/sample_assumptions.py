"""Assumption, rate and seed tables derived from the test book.

The pricing chain needs tables that people normally fill in. Here they follow
from the book by fixed rules, so they cover exactly its segments and years.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.functions.dates import day
from ratewright.functions.money import div_floor
from ratewright.functions.segments import all_versions
from ratewright.operators.exposure import priced_policy
from ratewright.operators.governance import ASSUMPTION_TYPES
from ratewright.session import materialize
from ratewright.sources import staging
from ratewright.sources.sample_tables import INGESTED_AT, SampleBook, pick

# Fixed values.
LDF_METHODS = ["weighted", "avg", "last3_weighted", "other"]
TRIANGLE_TYPES = ["paid", "incurred", "claim_count"]
LOSS_SELECTIONS = ["BF", "Cape_cod", "Judgement", "Chain_ladder_incurred", "Chain_ladder_paid"]
COUNT_SELECTIONS = ["BF", "Cape_cod", "Judgement", "Chain_ladder"]
JUDGEMENT_METHODS = ["BF", "Cape_cod", "Judgement"]
LOSS_PERCENT = [100, 102, 105]
TRENDS = {"frequency": 0.04, "severity": 0.05}
_RAW_SEGMENT = ["state", "risk_class", "vehicle_segment"]


class SampleAssumptions:
    def __init__(self, book: SampleBook) -> None:
        self.book = book
        self.year = book.params.as_of.year
        self._segment_years: DataFrame | None = None

    def priced_policy(self) -> DataFrame:
        b = self.book
        return priced_policy(
            staging.stg_policy(b.raw_policy()),
            staging.stg_policy_coverage(b.raw_policy_coverage()),
            staging.stg_vehicle(b.raw_vehicle()),
        )

    def segment_years(self) -> DataFrame:
        """Reported claims and their ultimate cents per version, segment and accident year."""
        if self._segment_years is None:
            owned = [f"own_{c}" for c in _RAW_SEGMENT]
            owner = self.priced_policy().select(
                "policy_id", *[F.col(c).alias(o) for c, o in zip(_RAW_SEGMENT, owned)]
            )
            claims = (
                self.book.claim_bases()
                .where(F.col("reported_date") <= day(self.book.params.as_of))
                .select("policy_id", F.year("loss_date").alias("accident_year"), "ultimate_cents")
            )
            rows = claims.join(owner, "policy_id").select(
                "accident_year", "ultimate_cents", F.inline(all_versions(owned, _RAW_SEGMENT))
            )
            years = rows.groupBy("segmentation_version", *_RAW_SEGMENT, "accident_year").agg(
                F.count(F.lit(1)).alias("claims"), F.sum("ultimate_cents").alias("cents")
            )
            self._segment_years = materialize(years, "segment_years")
        return self._segment_years

    def ldf_selection_table(self) -> DataFrame:
        development = F.lit(self.year) - F.col("accident_year")
        types = F.array(
            *[
                F.struct(F.lit(t).alias("triangle_type"), F.lit(i).alias("shift"))
                for i, t in enumerate(TRIANGLE_TYPES)
            ]
        )
        method = pick(LDF_METHODS, (F.col("development") + F.col("shift")) % 4)
        return (
            self.segment_years()
            .select("segmentation_version", *_RAW_SEGMENT, development.alias("development"), F.inline(types))
            .withColumn("method", method)
            .select(
                "segmentation_version",
                "triangle_type",
                *_RAW_SEGMENT,
                "development",
                F.when(F.col("method") == "other", 1.02).alias("ldf"),
                "method",
                F.lit("initial selection").alias("description"),
            )
        )

    def selected_ultimate(self) -> DataFrame:
        entries = []
        for i, (method, percent) in enumerate(zip(JUDGEMENT_METHODS, LOSS_PERCENT)):
            loss = div_floor(F.col("cents") * percent, 100) / F.lit(100.0)
            count = (F.col("claims") + i).cast("double")
            for kind, value in (("loss", loss), ("claim_count", count)):
                entries.append(
                    F.struct(F.lit(kind).alias("type"), F.lit(method).alias("method"), value.alias("ultimate"))
                )
        return (
            self.segment_years()
            .select("segmentation_version", *_RAW_SEGMENT, "accident_year", F.inline(F.array(*entries)))
            .select(
                "segmentation_version",
                "type",
                *_RAW_SEGMENT,
                "accident_year",
                "method",
                "ultimate",
                F.lit("derived").alias("comment"),
            )
        )

    def ultimate_selection(self) -> DataFrame:
        """A method for every year but the oldest one of the book."""
        years = self.segment_years()
        oldest = years.agg(F.min("accident_year")).scalar()
        ay = F.col("accident_year")
        entries = F.array(
            F.struct(F.lit("loss").alias("type"), pick(LOSS_SELECTIONS, ay % 5).alias("method")),
            F.struct(F.lit("claim_count").alias("type"), pick(COUNT_SELECTIONS, ay % 4).alias("method")),
        )
        return (
            years.where(ay > oldest)
            .select("segmentation_version", *_RAW_SEGMENT, "accident_year", F.inline(entries))
            .select(
                "segmentation_version",
                "type",
                *_RAW_SEGMENT,
                "accident_year",
                "method",
                F.lit("derived").alias("comment"),
            )
        )

    def _segments(self) -> DataFrame:
        return self.segment_years().select("segmentation_version", *_RAW_SEGMENT).distinct()

    def trend_selection(self) -> DataFrame:
        kinds = F.array(
            *[F.struct(F.lit(k).alias("trend_type"), F.lit(v).alias("annual_trend")) for k, v in TRENDS.items()]
        )
        return (
            self._segments()
            .select("*", F.inline(kinds))
            .select(
                "segmentation_version",
                "trend_type",
                *_RAW_SEGMENT,
                "annual_trend",
                day(f"{self.year + 1}-01-01").alias("effective_from"),
                day(f"{self.year + 1}-12-31").alias("effective_to"),
                F.lit("derived").alias("description"),
            )
        )

    def expense_assumption(self) -> DataFrame:
        return (
            self._segments()
            .select("state")
            .distinct()
            .select(
                F.lit("p1").alias("pricing_version"),
                "state",
                F.lit(50.0).alias("fixed_expense_per_exposure"),
                F.lit(0.20).alias("variable_expense_ratio"),
                F.lit(0.05).alias("ulae_ratio"),
                F.lit(0.05).alias("profit_ratio"),
                F.lit(0.70).alias("target_loss_ratio"),
            )
        )

    def rate_level_history(self) -> DataFrame:
        """Three yearly filings per segment; the level depends on its policy count."""
        k = F.col("filing")
        return (
            self.priced_policy()
            .groupBy(*_RAW_SEGMENT)
            .agg(F.count(F.lit(1)).alias("policies"))
            .select("*", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("filing"))
            .select(
                F.concat_ws("-", F.lit("F"), *_RAW_SEGMENT, k.cast("string")).alias("filing_id"),
                F.make_date(F.lit(self.year - 3) + k, F.lit(1), F.lit(1)).alias("effective_date"),
                *_RAW_SEGMENT,
                (k / F.lit(100.0)).alias("rate_change_pct"),
                ((100 + 3 * k + F.col("policies") % 7) / F.lit(100.0)).alias("cumulative_factor"),
            )
        )

    def development_pool_mapping(self) -> DataFrame:
        """A pool per line of business, and one for physical damage to vehicles."""
        policy = self.book.raw_policy().select("policy_id", "line_of_business", "product_id")
        products = (
            self.book.raw_policy_coverage()
            .select("policy_id", "coverage_code")
            .join(policy, "policy_id")
            .select("line_of_business", "product_id", "coverage_code")
            .distinct()
        )
        damage = F.col("coverage_code").isin("AUTO_COLL", "AUTO_COMP")
        pools = F.array_compact(
            F.array(
                F.struct(
                    F.concat(F.lit("LOB_"), F.col("line_of_business")).alias("development_pool_id"),
                    F.lit("line_of_business").alias("pool_level"),
                ),
                F.when(
                    damage,
                    F.struct(
                        F.lit("AUTO_PHYSICAL_DAMAGE").alias("development_pool_id"),
                        F.lit("coverage_group").alias("pool_level"),
                    ),
                ),
            )
        )
        return products.select(F.inline(pools), "line_of_business", "product_id", "coverage_code")

    def rating_factor(self, attributes: DataFrame) -> DataFrame:
        """The factors that the exposures really carry."""
        return attributes.groupBy("factor_id").agg(F.count("value_numeric").alias("numbers")).select(
            "factor_id",
            F.lower(F.replace(F.col("factor_id"), F.lit("RF_"), F.lit(""))).alias("factor_name"),
            F.lit("exposure").alias("entity_level"),
            F.when(F.col("numbers") > 0, "numeric").otherwise("string").alias("data_type"),
            F.concat(F.lit("factor "), F.col("factor_id")).alias("description"),
        )

    def model_version(self) -> DataFrame:
        return (
            self.book.raw_policy()
            .groupBy("product_id", "line_of_business")
            .agg(F.min("effective_date").alias("starts"), F.max("expiration_date").alias("ends"))
            .select(
                F.concat(F.col("product_id"), F.lit("_v1")).alias("model_version_id"),
                "product_id",
                "line_of_business",
                F.lit(1).alias("version_number"),
                F.col("starts").alias("effective_start_date"),
                F.col("ends").alias("effective_end_date"),
                F.lit("active").alias("status"),
            )
        )

    def bridge_model_version_factor(self, auto: DataFrame, property_: DataFrame) -> DataFrame:
        """Each line's model uses the factors found on that line's exposures."""
        models = self.model_version().select("model_version_id", "line_of_business")
        factors = auto.select("factor_id", F.lit("personal_auto").alias("line_of_business")).unionByName(
            property_.select("factor_id", F.lit("commercial_property").alias("line_of_business"))
        )
        return (
            factors.distinct()
            .join(models, "line_of_business")
            .select(
                "model_version_id",
                "factor_id",
                F.lit("identity").alias("transformation_id"),
                F.lit(1).alias("required_flag"),
            )
        )

    # ---- assumption history ---------------------------------------------------

    def previous_ldf_selection(self) -> DataFrame:
        """An earlier version: no development 0, an extra row, other stated factors."""
        now = self.ldf_selection_table()
        kept = now.where("development > 0").withColumn("ldf", F.col("ldf") - 0.01)
        dropped_since = now.where("development = 2").withColumn("development", F.col("development") + 100)
        return kept.unionByName(dropped_since)

    def table(self, assumption_type: str) -> DataFrame:
        return getattr(self, ASSUMPTION_TYPES[assumption_type].table.lower())()

    def assumption_version(self) -> DataFrame:
        """Two registered uploads of every assumption type."""
        counted = reduce(
            DataFrame.unionByName,
            [
                self.table(t.name)
                .agg(F.count(F.lit(1)).alias("rows"))
                .select(
                    F.lit(t.name).alias("assumption_type"),
                    F.lit(t.file_name).alias("file_name"),
                    F.lit(t.table).alias("target_table_name"),
                    "rows",
                )
                for t in ASSUMPTION_TYPES.values()
            ],
        )
        seq = F.col("version_sequence")
        name = F.col("assumption_type")
        none = F.lit(None).cast("string")
        return counted.select(
            "*", F.explode(F.array(F.lit(1).cast("bigint"), F.lit(2).cast("bigint"))).alias("version_sequence")
        ).select(
            F.concat_ws("-", name, seq.cast("string")).alias("assumption_set_id"),
            "assumption_type",
            "file_name",
            "target_table_name",
            "version_sequence",
            F.concat(F.lit("auto_v"), seq.cast("string")).alias("version_label"),
            F.lit("uploaded").alias("status"),
            F.lit(INGESTED_AT).cast("timestamp").alias("uploaded_at"),
            F.lit("actuary").alias("uploaded_by"),
            none.alias("upload_comment"),
            F.col("rows").alias("source_row_count"),
            F.when(seq == 1, F.col("rows")).otherwise(0).cast("bigint").alias("change_count"),
            F.when(seq == 2, F.concat(name, F.lit("-1"))).alias("previous_assumption_set_id"),
            F.lit("pricing").alias("dag_id"),
            F.concat(F.lit("run-"), seq.cast("string")).alias("dag_run_id"),
            F.lit("upload").alias("task_id"),
        )

    def pipeline_run_metadata(self) -> DataFrame:
        return self.assumption_version().select(
            F.concat(F.lit("meta-"), F.col("assumption_set_id")).alias("pipeline_run_metadata_id"),
            "dag_id",
            "dag_run_id",
            "task_id",
            "assumption_set_id",
            "assumption_type",
            "file_name",
            "version_sequence",
            "version_label",
            F.col("uploaded_at").alias("registered_at"),
        )
