"""Deterministically broken copies of sound tables, so that checks have something to find.

Expressions are plain SQL over the sample's integer ids and mean the same to any engine:
column replacements, and the rows that occur once more.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PERTURBED: dict[str, tuple[dict[str, str], str]] = {
    "raw_policy": (
        {
            "underwriting_tier": "CASE WHEN policy_id % 97 = 0 THEN 'unknown' ELSE underwriting_tier END",
            "primary_state": "CASE WHEN policy_id % 89 = 0 THEN NULL ELSE primary_state END",
            "expiration_date": "CASE WHEN policy_id % 83 = 0 THEN effective_date ELSE expiration_date END",
        },
        "policy_id % 79 = 0",
    ),
    "raw_policy_risk_unit": (
        {"policy_id": "CASE WHEN policy_id % 101 = 0 THEN -policy_id ELSE policy_id END"},
        "policy_id % 73 = 0",
    ),
    "raw_policy_coverage": (
        {
            "coverage_code": "CASE WHEN coverage_id % 103 = 0 THEN NULL ELSE coverage_code END",
            "policy_id": "CASE WHEN coverage_id % 107 = 0 THEN NULL ELSE policy_id END",
        },
        "",
    ),
    "raw_premium_transaction": (
        {
            "coverage_id": "CASE WHEN transaction_id % 109 = 0 THEN -1 ELSE coverage_id END",
            "cumulative_premium": "CASE WHEN transaction_id % 113 = 0 THEN -1 ELSE cumulative_premium END",
            "transaction_type": "CASE WHEN transaction_id % 127 = 0 THEN 'OTHER' ELSE transaction_type END",
        },
        "transaction_id % 131 = 0",
    ),
    "raw_claim": (
        {
            "reported_date": "CASE WHEN claim_id % 17 = 0 THEN loss_date - INTERVAL 1 DAY ELSE reported_date END",
            "coverage_id": "CASE WHEN claim_id % 19 = 0 THEN -claim_id ELSE coverage_id END",
        },
        "claim_id % 23 = 0",
    ),
    "raw_claim_transaction": (
        {
            "paid_loss_change": "CASE WHEN transaction_id % 29 = 0 THEN -1 ELSE paid_loss_change END",
            "claim_id": "CASE WHEN transaction_id % 31 = 0 THEN -1 ELSE claim_id END",
        },
        "",
    ),
    "raw_vehicle": ({"vehicle_sequence": "CASE WHEN policy_id % 137 = 0 THEN 0 ELSE vehicle_sequence END"}, "policy_id % 139 = 0"),
    "raw_driver": ({"credit_tier": "CASE WHEN policy_id % 149 = 0 THEN 'Z' ELSE credit_tier END"}, ""),
    "raw_driver_vehicle_assignment": (
        {"driver_id": "CASE WHEN policy_id % 151 = 0 THEN NULL ELSE driver_id END"},
        "policy_id % 157 = 0",
    ),
    "raw_property_location": (
        {"protection_class": "CASE WHEN policy_id % 163 = 0 THEN 11 ELSE protection_class END"},
        "",
    ),
    # an overlap with the next period, a gap before it, an empty and a repeated period
    "claim_financial_state_period": (
        {
            "valid_to_date": "CASE WHEN valid_to_date >= DATE '9000-01-01' THEN valid_to_date "
            "WHEN claim_id % 11 = 0 THEN valid_to_date + INTERVAL 40 DAY "
            "WHEN claim_id % 13 = 0 THEN valid_to_date - INTERVAL 1 DAY "
            "WHEN claim_id % 17 = 0 THEN valid_from_date ELSE valid_to_date END"
        },
        "claim_id % 19 = 0",
    ),
}

# kinds of three assignments of every vehicle: by policy none, one, two or three of them are PRIMARY
CONTESTED = {
    "own": "CASE WHEN policy_id % 5 < 2 THEN 'OCCASIONAL' ELSE 'PRIMARY' END",
    "later": "CASE WHEN policy_id % 3 = 0 THEN 'PRIMARY' ELSE 'OCCASIONAL' END",
    "earlier": "CASE WHEN policy_id % 7 < 4 THEN 'PRIMARY' ELSE 'OCCASIONAL' END",
}


def contested(assignments: DataFrame) -> DataFrame:
    """Three assignments of every vehicle, to different drivers, that compete for the primary driver."""
    shifts = {"own": (0, 0), "later": (1, 1_000_000_000), "earlier": (2, -1_000_000_000)}
    rows = None
    for name, (driver, assignment) in shifts.items():
        some = assignments.select(
            "vehicle_id",
            (F.col("driver_id") + driver).alias("driver_id"),
            (F.col("assignment_id") + assignment).alias("assignment_id"),
            F.expr(CONTESTED[name]).alias("assignment_type"),
        )
        rows = some if rows is None else rows.unionByName(some)
    return rows


def _replaced(df: DataFrame, replaced: dict[str, str]) -> DataFrame:
    return df.select(
        *[F.expr(replaced.get(f.name, f"`{f.name}`")).cast(f.dataType).alias(f.name) for f in df.schema]
    )


def perturbed(df: DataFrame, name: str) -> DataFrame:
    replaced, twice = PERTURBED[name]
    rows = _replaced(df, replaced)
    return rows.unionByName(rows.where(twice)) if twice else rows


@dataclass(frozen=True)
class Fault:
    """One input of a check, broken on its way into the check; all else is as it was.

    ``reads`` names the book's attribute or method, ``part`` the same table in the other
    engine, whose columns ``sql_replaced`` names where they are called otherwise there.
    """

    reads: str
    part: str
    replaced: dict[str, str] = field(default_factory=dict)
    without: str = "FALSE"
    sql_replaced: dict[str, str] = field(default_factory=dict)

    def broken(self, df: DataFrame) -> DataFrame:
        return _replaced(df.where(f"NOT ({self.without})"), self.replaced)

    def broken_sql(self) -> str:
        swaps = ", ".join(f"{e} AS {c}" for c, e in (self.sql_replaced or self.replaced).items())
        return f"SELECT *{f' REPLACE ({swaps})' if swaps else ''} FROM {self.part} WHERE NOT ({self.without})"


class Faulty:
    """A book that hands out one broken table."""

    def __init__(self, book, fault: Fault) -> None:
        self._book, self._fault = book, fault

    def __getattr__(self, name: str):
        found = getattr(self._book, name)
        if name != self._fault.reads:
            return found
        return (lambda *a: self._fault.broken(found(*a))) if callable(found) else self._fault.broken(found)


def _more(column: str, key: str, by: str = "1") -> dict[str, str]:
    return {column: f"{column} + CASE WHEN {key} = 0 THEN {by} ELSE 0 END"}


FAULTS: dict[str, Fault] = {
    "valuation_date_not_month_end": Fault(
        "claim_snapshot_year_end",
        "x_year_end_snapshot",
        {"valuation_date": "CASE WHEN claim_id % 53 = 0 THEN CAST(valuation_date - INTERVAL 1 DAY AS DATE) ELSE valuation_date END"},
    ),
    "claim_cumulative_incurred_reconciles": Fault(
        "claim_financial_state_cumulative",
        "x_state",
        _more("cumulative_incurred_loss", "claim_id % 29"),
        sql_replaced=_more("incurred", "claim_id % 29"),
    ),
    "claim_snapshot_population": Fault(
        "claim_valuation_snapshot", "x_snapshot", without="claim_id % 31 = 0 AND valuation_date >= DATE '2000-01-01'"
    ),
    "coverage_parent_bounds": Fault(
        "coverage_active_period",
        "x_active",
        {
            "actual_expiration_date": "CASE WHEN coverage_id % 37 = 0 THEN CAST(actual_expiration_date - INTERVAL 1 DAY "
            "AS DATE) ELSE actual_expiration_date END"
        },
        without="coverage_id % 41 = 0",
    ),
    "coverage_month_reconciles": Fault("coverage_month", "x_coverage_month", _more("active_days", "coverage_id % 41", "-1")),
    "earned_exposure_reconciles": Fault(
        "earned_exposure_month", "x_earned_exposure", _more("earned_exposure", "coverage_id % 43", "0.5")
    ),
    "earned_premium_reconciles_to_segments": Fault(
        "earned_premium_month", "x_earned_premium", _more("earned_premium", "coverage_id % 47")
    ),
    "earned_premium_reconciles_to_net_written": Fault(
        "earned_premium_month", "x_earned_premium", without="coverage_id % 47 = 0"
    ),
    "claim_snapshot_reconciles": Fault(
        "claim_snapshot", "x_claim_snapshot", without="claim_id % 31 = 0 AND valuation_date = DATE '1999-06-30'"
    ),
    "policy_exposure_within_policy_totals": Fault(
        "policy_exposure", "x_policy_exposure_v3", {"total_earned_premium": "total_earned_premium * 2"}
    ),
    "earned_premium_within_written": Fault(
        "policy_exposure", "x_policy_exposure_v3", {"total_earned_premium": "total_earned_premium * 2"}
    ),
    "policy_exposure_not_negative": Fault(
        "policy_exposure",
        "x_policy_exposure_v3",
        {"total_earned_premium": "total_earned_premium * CASE WHEN calendar_year % 2 = 0 THEN -1 ELSE 1 END"},
    ),
    "triangle_reconciles_to_snapshot": Fault(
        "claim_triangle_cumulative", "x_triangle", _more("cumulative_paid", "development % 3"), without="accident_year = 1997"
    ),
    "triangle_paid_not_decreasing": Fault(
        "claim_triangle_cumulative",
        "x_triangle",
        {"cumulative_paid": "CASE WHEN development = 3 THEN 1 ELSE cumulative_paid END"},
    ),
    "triangle_incurred_not_collapsing": Fault(
        "claim_triangle_cumulative",
        "x_triangle",
        {"cumulative_incurred": "CASE WHEN development = 2 THEN 1 ELSE cumulative_incurred END"},
    ),
    "paid_link_ratios_at_least_one": Fault(
        "ldf_raw",
        "x_ldf_raw",
        {"link_ratio_paid": "CASE WHEN development = 0 THEN link_ratio_paid / 100 ELSE link_ratio_paid END"},
    ),
    "last3_defaults_to_one": Fault("ldf_last3_weighted", "x_ldf_last3", {"last3_ldf_paid": "last3_ldf_paid + 0.5"}),
}
for _m, _s in (("paid", "paid"), ("incurred", "incurred"), ("claim_count", "cnt")):
    _value = "ultimate_claim_count" if _m == "claim_count" else "ultimate_loss"
    _factor = f"selected_ldf_{_s}"
    FAULTS |= {
        f"selected_ldf_coverage_{_m}": Fault("ldf_selected", f"x_selected_{_m}", without="development = 1"),
        f"ldf_not_positive_{_m}": Fault("ldf_selected", f"x_selected_{_m}", {_factor: f"{_factor} - 2"}),
        f"cdf_below_one_{_m}": Fault("cdf", f"x_cdf_{_m}", {"cdf": "cdf / 10"}),
        f"cdf_rising_{_m}": Fault("cdf", f"x_cdf_{_m}", {"cdf": "CASE WHEN development = 1 THEN cdf * 9 ELSE cdf END"}),
        f"ultimate_equals_latest_{_m}": Fault("cdf_by_month", f"x_month_{_m}", {"cdf": "cdf - cdf + 1"}),
        f"ultimate_below_latest_{_m}": Fault("ultimate_chain_ladder", f"x_ultimate_{_m}", {_value: f"{_value} / 100"}),
    }
