"""Loss triangles in long form.

Two routes give the same cells. ``loss_triangle`` sums a claim development table
(claims x months). ``loss_triangle_from_events`` never builds that table: it adds
each movement to the first cell that can see it and accumulates the small cell
table, so its cost follows the transactions instead of claims times months.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewright.functions import dates as D
from ratewright.functions.money import from_cents, ratio_if_positive, to_cents
from ratewright.functions.segments import SEGMENT, by_versions, segment_columns, version_flags
from ratewright.operators.calendar import first_accident_month
from ratewright.operators.claims import AMOUNTS, CHANGES, CUMULATIVE, claim_attributes

COUNT = "cumulative_reported_claim_count"
PRODUCT_KEYS = ["product_id", "line_of_business", "coverage_code"]
POOL_KEYS = ["development_pool_id", "pool_level", "line_of_business"]
STEP_MONTHS = {"monthly": 1, "quarterly": 3, "half_year": 6, "annual": 12}
_TOTAL = "decimal(28,2)"


def _finish(cells: DataFrame, keys: list[str]) -> DataFrame:
    valued = F.last_day(F.add_months("accident_period", F.col("development_age_months") - 1))
    return cells.select(
        "triangle_grain",
        *keys,
        "accident_period",
        "development_age_months",
        valued.alias("valuation_date"),
        COUNT,
        *CUMULATIVE,
    )


def loss_triangle(development: DataFrame, keys: list[str] = PRODUCT_KEYS) -> DataFrame:
    """All four grains from one pass over the development table.

    A cell fixes one valuation date and the development table has one row per
    claim and valuation date, so counting rows counts distinct claims.
    """

    def cell(grain: str, period: str, age: str, shown: Column) -> Column:
        entry = F.struct(
            F.lit(grain).alias("triangle_grain"),
            F.col(period).alias("accident_period"),
            F.col(age).alias("development_age_months"),
        )
        return F.when(shown & (F.col(age) > 0), entry)

    cells = F.array_compact(
        F.array(
            cell("monthly", "accident_month", "development_age_monthly", F.lit(True)),
            cell("quarterly", "accident_quarter", "development_age_quarterly", F.col("is_quarter_end")),
            cell("half_year", "accident_half_year", "development_age_half_year", F.col("is_half_year_end")),
            cell("annual", "accident_year", "development_age_annual", F.col("is_year_end")),
        )
    )
    placed = development.select(*keys, *[to_cents(F.col(c)).alias(c) for c in CUMULATIVE], F.inline(cells))
    summed = placed.groupBy("triangle_grain", *keys, "accident_period", "development_age_months").agg(
        F.count(F.lit(1)).alias(COUNT), *[F.sum(c).alias(c) for c in CUMULATIVE]
    )
    return _finish(summed.withColumns({c: from_cents(F.col(c), _TOTAL) for c in CUMULATIVE}), keys)


def loss_triangle_pooled(triangle: DataFrame, pool_mapping: DataFrame) -> DataFrame:
    """Triangle by development pool; a coverage may belong to several pools.

    Every measure adds up over products, and once a product has a cell it has
    one at each later age, so pooling the finished cells equals pooling claims.
    The join meets the small cell table, never the claims, whose few product
    keys would otherwise be hot.
    """
    pooled = triangle.join(pool_mapping, PRODUCT_KEYS).groupBy(
        "triangle_grain", *POOL_KEYS, "accident_period", "development_age_months"
    )
    measures = [F.sum(c).cast(triangle.schema[c].dataType).alias(c) for c in [COUNT, *CUMULATIVE]]
    return _finish(pooled.agg(*measures), POOL_KEYS)


def claim_movements(claims: DataFrame, transactions: DataFrame, as_of: date, calendar_start: date) -> DataFrame:
    """Per claim and month: the amounts that moved, in cents, and the claim itself once.

    Months before the first valuation count as the first one, which sees them all.

    ``reported`` is 1 in the claim's first month and 0 after, so its running sum
    counts claims. Transactions collapse to months on the map side before the
    join, which bounds what one claim can bring to it.
    """
    first = F.greatest(first_accident_month(claims), D.month_start(D.day(calendar_start)))

    def seen_from(day: str) -> Column:
        return F.greatest(D.month_start(F.col(day)), first).alias("event_month")

    moved = (
        transactions.where(F.col("transaction_date") <= D.day(as_of))
        .groupBy("claim_id", seen_from("transaction_date"))
        .agg(*[F.coalesce(F.sum(to_cents(F.col(c))), F.lit(0)).alias(a) for c, a in zip(CHANGES, AMOUNTS)])
    )
    anchors = claims.where(F.col("reported_date") <= D.day(as_of)).select(
        "claim_id",
        seen_from("reported_date"),
        *[F.lit(0).cast("bigint").alias(a) for a in AMOUNTS],
    )
    nth = F.row_number().over(Window.partitionBy("claim_id").orderBy("event_month"))
    return moved.unionByName(anchors).withColumn("reported", (nth == 1).cast("bigint"))


def accumulate_cells(
    movements: DataFrame,
    keys: list[str],
    grains: list[str],
    as_of: date,
) -> DataFrame:
    """Triangle cells from monthly movements.

    ``movements`` has ``keys``, ``loss_date``, ``event_month``, ``reported`` and
    the amounts. Each movement enters at the first valuation of its grain that
    can see it; a running sum over ages then carries it to all later ones. Every
    accident period has a cell at each age from its first movement to ``as_of``.
    """
    last_month = F.add_months(D.month_start(F.date_add(D.day(as_of), 1)), -1)
    loss = F.col("loss_date")
    period_start = {
        "monthly": D.month_start(loss),
        "quarterly": D.quarter_start(loss),
        "half_year": D.half_year_start(loss),
        "annual": D.year_start(loss),
    }

    def entry(grain: str) -> Column:
        step, start = STEP_MONTHS[grain], period_start[grain]
        months = D.month_boundaries(start, F.col("event_month")) + 1
        # first multiple of the step at or after the entry, at least one step
        age = F.greatest(F.ceil(months / step).cast("int") * step, F.lit(step))
        return F.struct(
            F.lit(grain).alias("triangle_grain"),
            start.alias("accident_period"),
            age.alias("development_age_months"),
        )

    placed = movements.select(*keys, "reported", *AMOUNTS, F.inline(F.array(*[entry(g) for g in grains])))
    row = ["triangle_grain", *keys, "accident_period"]
    deltas = placed.groupBy(*row, "development_age_months").agg(
        F.sum("reported").alias("reported"), *[F.sum(a).alias(a) for a in AMOUNTS]
    )
    # the cell table is small from here on: periods x ages x keys
    step = F.create_map(*[F.lit(x) for g in grains for x in (g, STEP_MONTHS[g])])[F.col("triangle_grain")]
    oldest = D.month_boundaries(F.col("accident_period"), last_month) + 1
    by_age = Window.partitionBy(*row).orderBy("development_age_months")
    following = F.lead("development_age_months").over(by_age)
    until = F.coalesce(following - F.col("step"), F.floor(oldest / F.col("step")).cast("int") * F.col("step"))
    running = by_age.rowsBetween(Window.unboundedPreceding, 0)
    totals = deltas.withColumn("step", step).withColumns(
        {
            "until": until,
            COUNT: F.sum("reported").over(running),
            **{f"cumulative_{a}": F.sum(a).over(running) for a in AMOUNTS},
        }
    )
    first_age = F.col("development_age_months")
    ages = F.when(first_age <= F.col("until"), F.sequence(first_age, F.col("until"), F.col("step")))
    cells = totals.select(
        *row,
        F.explode(ages).alias("development_age_months"),
        COUNT,
        *[from_cents(F.col(c), _TOTAL).alias(c) for c in CUMULATIVE],
    )
    return _finish(cells, keys)


def loss_triangle_from_events(
    claims: DataFrame,
    transactions: DataFrame,
    policy: DataFrame,
    coverage: DataFrame,
    as_of: date,
    calendar_start: date,
) -> DataFrame:
    """The product triangle at all four grains, straight from transactions."""
    attributes = claim_attributes(claims, policy, coverage).select("claim_id", "loss_date", *PRODUCT_KEYS)
    movements = claim_movements(claims, transactions, as_of, calendar_start).join(attributes, "claim_id")
    return accumulate_cells(movements, PRODUCT_KEYS, list(STEP_MONTHS), as_of)


def ldf_observations(triangle: DataFrame) -> DataFrame:
    """Link ratios between consecutive ages of the same accident period.

    The later cell is the next row of the period; the pair counts only when it
    lies exactly one step ahead, so a gap in the ages gives no pair.
    """
    keys = ["triangle_grain", *PRODUCT_KEYS, "accident_period"]
    by_age = Window.partitionBy(*keys).orderBy("development_age_months")
    measures = {
        "paid": F.col("cumulative_paid_loss"),
        "paid_and_expense": F.col("cumulative_paid_loss") + F.col("cumulative_paid_expense"),
        "incurred": F.col("cumulative_incurred_loss"),
        "count": F.col(COUNT),
    }
    names = {
        "paid": ("paid_loss", "paid_link_ratio"),
        "paid_and_expense": ("paid_and_expense_loss", "paid_and_expense_link_ratio"),
        "incurred": ("incurred_loss", "incurred_link_ratio"),
        "count": ("reported_claim_count", "reported_count_link_ratio"),
    }
    ahead = {f"{m}_to": F.lead(c).over(by_age) for m, c in measures.items()}
    now = {f"{m}_from": c for m, c in measures.items()}
    step = F.create_map(*[F.lit(x) for item in STEP_MONTHS.items() for x in item])[F.col("triangle_grain")]
    pairs = triangle.withColumns(
        {**now, **ahead, "age_to": F.lead("development_age_months").over(by_age)}
    ).where(F.col("age_to") == F.col("development_age_months") + step)
    outputs = []
    for m, (amount, link) in names.items():
        start, end = F.col(f"{m}_from"), F.col(f"{m}_to")
        outputs += [
            start.alias(f"{amount}_from"),
            end.alias(f"{amount}_to"),
            ratio_if_positive(end, start).alias(link),
        ]
    return pairs.select(
        *keys,
        F.col("development_age_months").alias("development_age_from"),
        F.col("age_to").alias("development_age_to"),
        *outputs,
    )


# ---- pricing triangle: accident year x whole years of development ---------------


def claim_triangle_cumulative(snapshot: DataFrame, policies: DataFrame, version: str = "v3") -> DataFrame:
    """Segment, accident year and years of development, from a claim snapshot.

    ``age_months`` counts from the start of the accident year to the valuation. At a
    year end it is a multiple of 12 and ``development`` the completed years since any
    loss of the year. At another valuation all claims of the year still share one
    partial cell, in the development year that is under way.
    """
    owner = policies.select("policy_id", "state", "risk_class", "vehicle_segment")
    development = (F.year("valuation_date") - F.year("accident_date")).cast("int")
    return (
        snapshot.join(owner, "policy_id", "left")
        .select(
            *segment_columns(version),
            F.year("accident_date").alias("accident_year"),
            development.alias("development"),
            (development * 12 + F.month("valuation_date")).alias("age_months"),
            "valuation_date",
            "claim_id",
            "cumulative_paid",
            "incurred",
        )
        .groupBy(*SEGMENT, "accident_year", "development", "age_months", "valuation_date")
        .agg(
            F.sum("cumulative_paid").cast(_TOTAL).alias("cumulative_paid"),
            F.sum("incurred").cast(_TOTAL).alias("cumulative_incurred"),
            # one row per claim and valuation date, so rows are distinct claims
            F.count("claim_id").alias("cumulative_claim_count"),
        )
    )


def claim_triangle_from_events(
    claims: DataFrame,
    transactions: DataFrame,
    policies: DataFrame,
    as_of: date,
    calendar_start: date,
    version: str = "v3",
) -> DataFrame:
    """The pricing triangle without a claim snapshot: year ends and ``as_of``.

    At a year-end valuation the completed years of development are the years
    between accident year and valuation year, i.e. annual age / 12 - 1. Where
    ``as_of`` is no year end, its valuation is a last diagonal of partial cells, so
    every claim reported by then is in the triangle; ``age_months`` tells them apart.
    """
    attributes = claims.select("claim_id", "policy_id", "loss_date")
    if any(version_flags(version)):
        owner = policies.select("policy_id", *segment_columns(version))
        attributes = attributes.join(owner, "policy_id", "left")
    else:  # one pooled segment: no policy attribute is needed
        attributes = attributes.withColumns({c: F.lit("ALL") for c in SEGMENT})
    movements = claim_movements(claims, transactions, as_of, calendar_start).join(attributes, "claim_id")
    cells = accumulate_cells(movements, SEGMENT, ["annual"], as_of)
    year_ends = cells.select(
        *SEGMENT,
        F.year("accident_period").alias("accident_year"),
        (F.col("development_age_months") / 12 - 1).cast("int").alias("development"),
        F.col("development_age_months").cast("int").alias("age_months"),
        "valuation_date",
        F.col("cumulative_paid_loss").alias("cumulative_paid"),
        F.col("cumulative_incurred_loss").alias("cumulative_incurred"),
        F.col(COUNT).alias("cumulative_claim_count"),
    )
    if as_of.month == 12:
        return year_ends
    accident_year = F.year("loss_date")
    latest = movements.groupBy(*SEGMENT, accident_year.alias("accident_year")).agg(
        (F.lit(as_of.year) - F.first(accident_year)).cast("int").alias("development"),
        ((F.lit(as_of.year) - F.first(accident_year)) * 12 + as_of.month).cast("int").alias("age_months"),
        F.first(D.day(as_of)).alias("valuation_date"),
        *[
            from_cents(F.sum(AMOUNTS[CUMULATIVE.index(c)]), _TOTAL).alias(name)
            for c, name in (
                ("cumulative_paid_loss", "cumulative_paid"),
                ("cumulative_incurred_loss", "cumulative_incurred"),
            )
        ],
        F.sum("reported").alias("cumulative_claim_count"),
    )
    return year_ends.unionByName(latest)


def claim_triangle_versions(finest: DataFrame, config: DataFrame) -> DataFrame:
    """The pricing triangle of every segmentation version, from the triangle of the finest segments.

    Once a segment has a cell it has one at every later valuation, so sums of finest
    cells are the cells of any coarser segment.
    """
    keys = ["accident_year", "development", "age_months", "valuation_date"]
    sums = ["cumulative_paid", "cumulative_incurred", "cumulative_claim_count"]
    rolled = by_versions(finest, config, keys, sums)
    return rolled.select(
        "segmentation_version",
        *SEGMENT,
        *keys,
        *[F.col(c).cast(finest.schema[c].dataType).alias(c) for c in sums],
    )


def claim_triangle_incremental(triangle: DataFrame) -> DataFrame:
    """Change since the previous development; NULL in the first cell."""
    by_dev = Window.partitionBy(*SEGMENT, "accident_year").orderBy("development")
    return triangle.select(
        *SEGMENT,
        "accident_year",
        "development",
        *[
            (F.col(f"cumulative_{m}") - F.lag(f"cumulative_{m}").over(by_dev)).alias(f"incremental_{m}")
            for m in ("paid", "incurred", "claim_count")
        ],
    )
