"""Review extracts for the actuary: wide triangles, ultimates, templates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewright.functions.segments import SEGMENT
from ratewright.operators.ultimate import YEAR_KEYS

# Fixed values.
LOSS_METHODS = ["BF", "Cape_cod", "Chain_ladder_incurred", "Chain_ladder_paid", "Judgement"]
COUNT_METHODS = ["BF", "Cape_cod", "Chain_ladder", "Judgement"]
_TRIANGLES = {
    "cumulative_paid": "cumulative_paid",
    "cumulative_reported": "cumulative_incurred",
    "cumulative_claim_count": "cumulative_claim_count",
}


def review_triangle_cells(triangle: DataFrame) -> DataFrame:
    """The cells of the review triangles in long form, whatever their development."""
    return triangle.select(
        *YEAR_KEYS,
        "development",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("triangle"), F.col(c).cast("double").alias("value"))
                    for name, c in _TRIANGLES.items()
                ]
            )
        ),
    )


def review_triangles(triangle: DataFrame, at_least: int = 0) -> DataFrame:
    """Accident year by development, one row per segment, triangle and year.

    There is a column for every development up to the greatest in the data, which
    one small job looks up, and for those up to ``at_least`` in any case.
    """
    long = review_triangle_cells(triangle)
    greatest = triangle.agg(F.max("development").alias("d")).first().d
    developments = list(range(max(at_least, greatest or 0) + 1))
    wide = long.groupBy(*SEGMENT, "triangle", "accident_year").pivot("development", developments).agg(F.sum("value"))
    return wide.withColumnsRenamed({str(d): f"dev_{d}" for d in developments})


def review_ultimates(paid_cl: DataFrame, incurred_cl: DataFrame, count_cl: DataFrame) -> DataFrame:
    reported = incurred_cl.withColumnRenamed("ultimate_loss", "reported_ultimate_loss")
    paid = paid_cl.withColumnRenamed("ultimate_loss", "paid_ultimate_loss")
    counts = count_cl.withColumnRenamed("ultimate_claim_count", "reported_ultimate_claim_count")
    return (
        reported.join(paid, YEAR_KEYS, "full")
        .join(counts, YEAR_KEYS, "left")
        .select(*YEAR_KEYS, "paid_ultimate_loss", "reported_ultimate_loss", "reported_ultimate_claim_count")
        .orderBy(*YEAR_KEYS)
    )


def ultimate_candidates_by_method(losses: DataFrame, counts: DataFrame) -> DataFrame:
    """Loss and count candidates side by side, one row per method."""
    stacked = losses.unionByName(counts, allowMissingColumns=True)
    return (
        stacked.groupBy(*YEAR_KEYS, "method")
        .agg(
            F.max("ultimate_loss").alias("ultimate_loss"),
            F.max("ultimate_claim_count").alias("ultimate_claim_count"),
        )
        .orderBy(*YEAR_KEYS, "method")
    )


def review_ultimate_candidates(losses: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per accident year with a column for each method's loss and count.

    The usual methods have their columns in any case; any other method in the
    candidates, of which there are a few typed names, has its own as well.
    """
    by_method = ultimate_candidates_by_method(losses, counts)
    offered_methods = {
        value: [*usual, *sorted(r.method for r in df.select("method").distinct().collect() if r.method not in usual)]
        for value, usual, df in (
            ("ultimate_loss", LOSS_METHODS, losses),
            ("ultimate_claim_count", COUNT_METHODS, counts),
        )
    }
    methods = sorted({m for offered in offered_methods.values() for m in offered})
    wide = (
        by_method.groupBy(*YEAR_KEYS)
        .pivot("method", methods)
        .agg(
            F.first("ultimate_loss", ignorenulls=True).alias("ultimate_loss"),
            F.first("ultimate_claim_count", ignorenulls=True).alias("ultimate_claim_count"),
        )
    )
    columns = [
        F.col(f"{m}_{value}").alias(f"{value}_{m}")
        for value, offered in offered_methods.items()
        for m in offered
    ]
    return wide.select(*YEAR_KEYS, *columns)


def review_frequency_severity(frequency_severity: DataFrame) -> DataFrame:
    return frequency_severity.select(*YEAR_KEYS, "frequency", "severity").orderBy(*YEAR_KEYS)


def ultimate_selection_template(losses: DataFrame, counts: DataFrame, version: str) -> DataFrame:
    """Every accident year with a candidate, with blank method and comment to fill in."""
    years = (
        losses.select(*YEAR_KEYS, F.lit("loss").alias("type"))
        .union(counts.select(*YEAR_KEYS, F.lit("claim_count").alias("type")))
        .distinct()
    )
    blank = F.lit(None).cast("string")
    return years.select(
        F.lit(version).alias("segmentation_version"),
        "type",
        F.col("state_grp").alias("state"),
        F.col("risk_class_grp").alias("risk_class"),
        F.col("vehicle_segment_grp").alias("vehicle_segment"),
        "accident_year",
        blank.alias("method"),
        blank.alias("comment"),
    ).orderBy("state", "risk_class", "vehicle_segment", "type", "accident_year")


def segment_index(df: DataFrame) -> DataFrame:
    """Distinct segments, numbered in order.

    The numbering runs in one task over distinct segments only, whose number is
    bounded by the products of the rating levels.
    """
    order = Window.orderBy(*SEGMENT)
    return df.select(*SEGMENT).distinct().withColumn("segment_number", F.row_number().over(order))


def write_review(df: DataFrame, path: str) -> None:
    """One folder per segment, without a loop over segments."""
    df.repartition(*SEGMENT).write.mode("overwrite").partitionBy(*SEGMENT).parquet(path)
