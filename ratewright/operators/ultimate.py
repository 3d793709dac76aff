"""Chain-ladder, candidate and selected ultimates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.functions.segments import SEGMENT
from ratewright.operators.ldf import MEASURES

YEAR_KEYS = [*SEGMENT, "accident_year"]


def latest_diagonal(triangle: DataFrame, *columns: str) -> DataFrame:
    """Most developed cell of each accident year, be it a whole year's or a partial one."""
    return triangle.groupBy(*YEAR_KEYS).agg(
        F.max("development").alias("development"), *[F.max_by(c, "development").alias(c) for c in columns]
    )


def ultimate_chain_ladder(triangle: DataFrame, by_month: DataFrame, measure: str) -> DataFrame:
    """Latest diagonal times the CDF at its age in months; an age without a CDF has no ultimate."""
    column = MEASURES[measure][0]
    name = "ultimate_claim_count" if measure == "claim_count" else "ultimate_loss"
    return (
        latest_diagonal(triangle, column, "age_months")
        .join(by_month, [*SEGMENT, "age_months"])
        .select(*YEAR_KEYS, (F.col(column).cast("double") * F.col("cdf")).alias(name))
    )


def _candidates(value: str, chain_ladder: dict[str, DataFrame], judgement: DataFrame) -> DataFrame:
    stacked = judgement.select(*YEAR_KEYS, "method", value)
    for method, df in chain_ladder.items():
        stacked = df.select(*YEAR_KEYS, F.lit(method).alias("method"), value).unionByName(stacked)
    return stacked


def fct_ultimate_loss(incurred_cl: DataFrame, paid_cl: DataFrame, judgement: DataFrame) -> DataFrame:
    return _candidates(
        "ultimate_loss", {"Chain_ladder_paid": paid_cl, "Chain_ladder_incurred": incurred_cl}, judgement
    )


def fct_ultimate_claim_count(count_cl: DataFrame, judgement: DataFrame) -> DataFrame:
    return _candidates("ultimate_claim_count", {"Chain_ladder": count_cl}, judgement)


def _select(selection: DataFrame, candidates: DataFrame, value: str) -> DataFrame:
    chosen = selection.withColumnRenamed("selected_method", "method")
    return chosen.join(candidates, [*YEAR_KEYS, "method"]).select(
        "segmentation_version", *YEAR_KEYS, value, "method", "comment"
    )


def fct_selected_ultimate_loss(selection: DataFrame, candidates: DataFrame) -> DataFrame:
    return _select(selection, candidates, "ultimate_loss")


def fct_selected_ultimate_claim_count(selection: DataFrame, candidates: DataFrame) -> DataFrame:
    return _select(selection, candidates, "ultimate_claim_count")
