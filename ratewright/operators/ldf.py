"""Link ratios, development factors and cumulative development factors.

Everything here works on the pricing triangle: segment x accident year x year of
development. That table is small whatever the size of the book.

Factors come from whole years only. A valuation within a year leaves a last diagonal of
partial cells (``age_months`` not a multiple of 12): a ratio into or out of such a cell
would measure fewer months than its neighbours. ``cdf_by_month`` gives the factors that
develop those cells to ultimate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ratewright.functions.money import ratio
from ratewright.functions.segments import SEGMENT

# measure -> (triangle column, suffix of the factor columns)
MEASURES = {
    "paid": ("cumulative_paid", "paid"),
    "incurred": ("cumulative_incurred", "incurred"),
    "claim_count": ("cumulative_claim_count", "cnt"),
}
_CELL = [*SEGMENT, "development"]


def _by_development() -> WindowSpec:
    return Window.partitionBy(*SEGMENT, "accident_year").orderBy("development")


def whole_years(triangle: DataFrame) -> DataFrame:
    """The cells valued at the end of a development year; all, if no cell tells its age."""
    return triangle.where("age_months % 12 = 0") if "age_months" in triangle.columns else triangle


def ldf_raw(triangle: DataFrame) -> DataFrame:
    """Ratio of the next cell to this one, per accident year."""
    by_dev = _by_development()
    return whole_years(triangle).select(
        *SEGMENT,
        "accident_year",
        "development",
        *[ratio(F.lead(c).over(by_dev), F.col(c)).alias(f"link_ratio_{s}") for c, s in MEASURES.values()],
    )


def ldf_avg(raw: DataFrame) -> DataFrame:
    """Straight average per development; 1 where no ratio exists."""
    return raw.groupBy(*_CELL).agg(
        *[F.coalesce(F.avg(f"link_ratio_{s}"), F.lit(1.0)).alias(f"avg_ldf_{s}") for _, s in MEASURES.values()]
    )


def development_pairs(triangle: DataFrame) -> DataFrame:
    """Cells that have a successor exactly one development later, with both values."""
    by_dev = _by_development()
    ahead = {f"next_{c}": F.lead(c).over(by_dev) for c, _ in MEASURES.values()}
    return whole_years(triangle).withColumns({**ahead, "next_development": F.lead("development").over(by_dev)}).where(
        F.col("next_development") == F.col("development") + 1
    )


def _volume_factors(pairs: DataFrame, prefix: str) -> DataFrame:
    return pairs.groupBy(*_CELL).agg(
        F.count(F.lit(1)).alias("ay_count"),
        *[ratio(F.sum(f"next_{c}"), F.sum(c)).alias(f"{prefix}_ldf_{s}") for c, s in MEASURES.values()],
    )


def ldf_weighted(triangle: DataFrame) -> DataFrame:
    """Volume-weighted factor; developments without a successor have no row."""
    factors = _volume_factors(development_pairs(triangle), "weighted")
    return factors.select(
        *_CELL,
        *[
            F.coalesce(f"weighted_ldf_{s}", F.lit(1.0)).alias(f"weighted_ldf_{s}")
            for _, s in MEASURES.values()
        ],
    )


def ldf_last3_weighted(triangle: DataFrame) -> DataFrame:
    """Volume-weighted over the three latest accident years; 1 with fewer than three."""
    latest = Window.partitionBy(*_CELL).orderBy(F.col("accident_year").desc())
    recent = development_pairs(triangle).withColumn("nth", F.row_number().over(latest)).where("nth <= 3")
    factors = _volume_factors(recent, "last3")
    return (
        whole_years(triangle)
        .select(*_CELL)
        .distinct()
        .join(factors, _CELL, "left")
        .select(
            *_CELL,
            *[
                F.when(F.col("ay_count") == 3, F.coalesce(f"last3_ldf_{s}", F.lit(1.0)))
                .otherwise(1.0)
                .alias(f"last3_ldf_{s}")
                for _, s in MEASURES.values()
            ],
        )
    )


def ldf_selected(
    selection: DataFrame,
    avg: DataFrame,
    weighted: DataFrame,
    last3: DataFrame,
    measure: str,
    tail_factor: float | None = None,
) -> DataFrame:
    """The factor chosen per development: avg, weighted, last3_weighted or a stated value.

    A development without a weighted factor (the last one) drops out, unless
    ``tail_factor`` gives it a value.
    """
    s = MEASURES[measure][1]
    chosen = selection.where(F.col("triangle_type") == measure).select(*_CELL, "method", "ldf")
    joined = (
        chosen.join(avg.select(*_CELL, f"avg_ldf_{s}"), _CELL)
        .join(last3.select(*_CELL, f"last3_ldf_{s}"), _CELL)
        .join(weighted.select(*_CELL, f"weighted_ldf_{s}"), _CELL, "inner" if tail_factor is None else "left")
    )
    by_method = (
        F.when(F.col("method") == "avg", F.col(f"avg_ldf_{s}"))
        .when(F.col("method") == "weighted", F.col(f"weighted_ldf_{s}"))
        .when(F.col("method") == "last3_weighted", F.col(f"last3_ldf_{s}"))
        .when(F.col("method") == "other", F.col("ldf"))
    )
    if tail_factor is not None:
        by_method = F.when(F.col(f"weighted_ldf_{s}").isNull(), F.lit(float(tail_factor))).otherwise(by_method)
    return joined.select(*_CELL, by_method.alias(f"selected_ldf_{s}"))


def cdf(selected: DataFrame, measure: str) -> DataFrame:
    """Product of the selected factors from this development to the last.

    A missing factor is skipped. A factor at or below zero has no logarithm; the
    quality checks reject it before it gets here.
    """
    factor = F.col(f"selected_ldf_{MEASURES[measure][1]}")
    later = Window.partitionBy(*SEGMENT).orderBy(F.col("development").desc())
    return selected.select(*_CELL, F.exp(F.sum(F.ln(factor)).over(later)).alias("cdf"))


def cdf_by_month(cdf: DataFrame, hold_tail: bool = False) -> DataFrame:
    """The factor to ultimate at every age in months, from the factors at whole years.

    The developed share 1 / CDF is taken to grow evenly between two year ends, and from
    nothing over the first year, so a factor at 12 (development + 1) months is the given
    one. Ages past the last factor have none, and neither have those on the way to a year
    end without one; with ``hold_tail`` the last factor serves the year after it too.
    """
    by_dev = Window.partitionBy(*SEGMENT).orderBy("development")
    start = F.when(F.col("development") == 0, 0.0).when(
        F.lag("development").over(by_dev) == F.col("development") - 1, 1 / F.lag("cdf").over(by_dev)
    )
    last = F.lead("development").over(by_dev).isNull()
    months = F.when(last & F.lit(hold_tail), 23).otherwise(12)
    month = F.col("month")
    even = 1 / (F.col("start") + (1 / F.col("cdf") - F.col("start")) * month / 12)
    return (
        cdf.select(*_CELL, "cdf", start.alias("start"), months.alias("months"))
        .withColumn("month", F.explode(F.sequence(F.lit(1), F.col("months"))))
        .select(
            *SEGMENT,
            (F.col("development") * 12 + month).cast("int").alias("age_months"),
            F.when(month >= 12, F.col("cdf")).otherwise(even).alias("cdf"),
        )
        .where("cdf IS NOT NULL")
    )
