"""Rating attributes of an exposure, one row per factor."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewright.functions.dates import completed_age
from ratewright.functions.intervals import explode_months
from ratewright.functions.keys import surrogate_key

_NUMBER = "decimal(38,0)"  # whole numbers; a fraction rounds half up


def _number(value: Column) -> tuple[Column, Column]:
    return value.cast(_NUMBER), F.lit(None).cast("string")


def _text(value: Column) -> tuple[Column, Column]:
    return F.lit(None).cast(_NUMBER), value.cast("string")


# the columns that make a monthly exposure, and its id
_EXPOSURE = ["policy_id", "risk_unit_id", "coverage_id", "calendar_month"]


def _attributes_by_month(
    periods: DataFrame,
    rated: DataFrame,
    factors: dict[str, tuple[Column, Column]],
    calendar_start: date,
    calendar_end: date,
) -> DataFrame:
    """Rated coverage periods listed month by month and factor by factor.

    ``rated`` has the attributes of (policy, risk unit). They meet the coverage while it
    is still one row; months and then factors are listed after the last exchange, so no
    exploded row is ever shuffled. Equal months of one coverage become one in place, as a
    coverage row lies with its risk unit; where the join has dealt the rows so, the hash on
    the unit costs no exchange.
    """
    own = periods.select("policy_id", "risk_unit_id", "coverage_id", "coverage_effective_date", "actual_expiration_date")
    covered = own.join(rated, ["policy_id", "risk_unit_id"]).repartition("risk_unit_id")
    months = explode_months(covered, "coverage_effective_date", "actual_expiration_date", calendar_start, calendar_end)
    attributes = [c for c in rated.columns if c not in _EXPOSURE]
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("factor_id"), number.alias("value_numeric"), text.alias("value_string")
            )
            for name, (number, text) in factors.items()
        ]
    )
    # the key is made once a month: beside the factors it would be made again for each of them
    keyed = months.select(*_EXPOSURE, *attributes).distinct().select(
        surrogate_key("risk_unit_id", "coverage_id", "calendar_month").alias("exposure_id"), *attributes
    )
    return keyed.select("exposure_id", F.inline(entries))


def auto_exposure_attributes(
    periods: DataFrame,
    policy: DataFrame,
    risk_unit: DataFrame,
    vehicle: DataFrame,
    assignment: DataFrame,
    driver: DataFrame,
    calendar_start: date,
    calendar_end: date,
) -> DataFrame:
    """Driver and vehicle factors of the monthly exposures of personal auto coverage periods."""
    inception = F.col("policy_effective_date")
    holder = policy.where(F.col("line_of_business") == "personal_auto").select(
        "policy_id", F.col("effective_date").alias("policy_effective_date")
    )
    unit = risk_unit.where(F.col("risk_unit_type") == "vehicle").select(
        "risk_unit_id", F.col("source_risk_unit_id").alias("vehicle_id")
    )
    car = vehicle.select("vehicle_id", "garaging_state", "model_year", "vehicle_type", "annual_mileage", "usage")
    primary = assignment.where(F.col("assignment_type") == "PRIMARY").select(
        "policy_id", "vehicle_id", "driver_id", "assignment_id"
    )
    person = driver.select("driver_id", "date_of_birth", "prior_accidents", "prior_violations", "credit_tier")
    rated = (
        primary.join(holder, "policy_id")
        .join(person, "driver_id")
        .join(unit.join(car, "vehicle_id"), "vehicle_id")
        .select(
            "policy_id",
            "risk_unit_id",
            "assignment_id",  # two primary drivers of one vehicle stay two sets of factors
            "garaging_state",
            "vehicle_type",
            "annual_mileage",
            "usage",
            "prior_accidents",
            "prior_violations",
            "credit_tier",
            completed_age(F.col("date_of_birth"), inception).alias("driver_age"),
            _age(F.year(inception), F.col("model_year")).alias("vehicle_age"),
        )
    )
    return _attributes_by_month(
        periods.where(F.col("line_of_business") == "personal_auto"),
        rated,
        {
            "RF_STATE": _text(F.col("garaging_state")),
            "RF_DRIVER_AGE": _number(F.col("driver_age")),
            "RF_PRIOR_ACCIDENTS": _number(F.col("prior_accidents")),
            "RF_PRIOR_VIOLATIONS": _number(F.col("prior_violations")),
            "RF_CREDIT_TIER": _text(F.col("credit_tier")),
            "RF_VEHICLE_AGE": _number(F.col("vehicle_age")),
            "RF_VEHICLE_TYPE": _text(F.col("vehicle_type")),
            "RF_ANNUAL_MILEAGE": _number(F.col("annual_mileage")),
            "RF_USAGE": _text(F.col("usage")),
        },
        calendar_start,
        calendar_end,
    )


def property_exposure_attributes(
    periods: DataFrame,
    policy: DataFrame,
    risk_unit: DataFrame,
    location: DataFrame,
    calendar_start: date,
    calendar_end: date,
) -> DataFrame:
    """Building factors of the monthly exposures of commercial property coverage periods."""
    holder = policy.where(F.col("line_of_business") == "commercial_property").select(
        "policy_id", F.col("effective_date").alias("policy_effective_date")
    )
    unit = risk_unit.where(F.col("risk_unit_type") == "property_location").select(
        "risk_unit_id", F.col("source_risk_unit_id").alias("location_id")
    )
    site = location.select(
        "location_id",
        "state",
        "occupancy",
        "construction_type",
        "year_built",
        "protection_class",
        "total_insured_value",
    )
    building_age = _age(F.year("policy_effective_date"), F.col("year_built"))
    lines = periods.where(F.col("line_of_business") == "commercial_property")
    # the policy of a coverage counts, whichever policy its unit names
    pairs = lines.select("policy_id", "risk_unit_id").distinct()
    return _attributes_by_month(
        lines,
        # the pairs are narrow, so they travel to the policies and back, and the site meets them last
        pairs.join(holder, "policy_id").join(unit.join(site, "location_id"), "risk_unit_id"),
        {
            "RF_STATE": _text(F.col("state")),
            "RF_OCCUPANCY": _text(F.col("occupancy")),
            "RF_CONSTRUCTION_TYPE": _text(F.col("construction_type")),
            "RF_BUILDING_AGE": _number(building_age),
            "RF_PROTECTION_CLASS": _number(F.col("protection_class")),
            "RF_TIV": _number(F.col("total_insured_value")),
        },
        calendar_start,
        calendar_end,
    )


def _age(year: Column, since: Column) -> Column:
    """Whole years, at least 0; unknown where either year is."""
    return F.when(year.isNotNull() & since.isNotNull(), F.greatest(year - since, F.lit(0)))


def fct_exposure_attribute(auto: DataFrame, property_: DataFrame) -> DataFrame:
    return auto.unionByName(property_)


def dim_rating_factor(src: DataFrame) -> DataFrame:
    return src.select("factor_id", "factor_name", "entity_level", "data_type", "description")


def dim_model_version(src: DataFrame) -> DataFrame:
    return src.select(
        "model_version_id",
        "product_id",
        "line_of_business",
        "version_number",
        "effective_start_date",
        "effective_end_date",
        "status",
    )


def dim_bridge_model_version_factor(src: DataFrame) -> DataFrame:
    return src.select("model_version_id", "factor_id", "transformation_id", "required_flag")
