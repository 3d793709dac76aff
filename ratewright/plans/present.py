"""Plain result columns, comparable across engines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Decimals kept of each double; money and large values keep fewer than ratios.
DIGITS = {
    "ultimate_loss": 2,
    "paid_ultimate_loss": 2,
    "reported_ultimate_loss": 2,
    "selected_ultimate_loss": 2,
    "chain_ladder_ultimate_loss": 2,
    "loss_method_impact": 2,
    "reserve_loss_method_impact": 2,
    "severity": 4,
    "trended_severity": 4,
    "pure_premium": 4,
    "base_pure_premium": 4,
    "trended_pure_premium": 4,
    "indicated_premium": 4,
    "indicated_rate_change": 4,
    "trend_impact_on_pure_premium": 4,
    "expense_and_profit_impact": 4,
    "rated_premium": 2,
}
DEFAULT_DIGITS = 6


def digits(column: str) -> int:
    if column.startswith("ultimate_loss"):
        return DIGITS["ultimate_loss"]
    return DIGITS.get(column, DEFAULT_DIGITS)


def present(df: DataFrame) -> DataFrame:
    """Dates and times as ISO text, decimals as doubles, doubles rounded."""
    columns = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            scale = 10.0 ** digits(f.name)
            c = F.rint(c * scale) / scale
        columns.append(c.alias(f.name))
    return df.select(*columns)
