"""Text form of values for comparing assumption tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DIGITS = 10


def general_number(x: Column) -> Column:
    """A double with ten significant digits and no trailing zeros.

    Plain notation for exponents -4 to 9, scientific outside that range.
    """
    magnitude = F.floor(F.log10(F.abs(x)))
    # rounding can carry into the next power of ten (9.9999999999 -> 10)
    carried = F.round(F.abs(x) / F.pow(F.lit(10.0), magnitude), _DIGITS - 1) >= 10
    exponent = (magnitude + F.when(carried, 1).otherwise(0)).cast("int")
    digits = F.round(x / F.pow(F.lit(10.0), exponent), _DIGITS - 1)
    mantissa = _trim(digits.cast("decimal(12,9)"))
    power = F.lpad(F.abs(exponent).cast("string"), 2, "0")
    scientific = F.concat(mantissa, F.when(exponent < 0, "e-").otherwise("e+"), power)
    scale = F.pow(F.lit(10.0), exponent).cast("decimal(16,5)")
    plain = _trim((digits.cast("decimal(12,9)") * scale).cast("decimal(38,14)"))
    return (
        F.when(x == 0, "0")
        .when((exponent < -4) | (exponent >= _DIGITS), scientific)
        .otherwise(plain)
    )


def _trim(decimal: Column) -> Column:
    """Drop trailing zeros after the point, and the point if nothing follows."""
    return F.regexp_replace(F.regexp_replace(decimal.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")


def normalize_value(column: Column, dtype: T.DataType) -> Column:
    """NULL stays NULL; dates and times in ISO form; numbers trimmed; text stripped."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(column), general_number(column.cast("double")))
    if isinstance(dtype, T.DateType):
        return F.date_format(column, "yyyy-MM-dd")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")
    if isinstance(dtype, T.DecimalType):
        return _trim(column)
    return F.trim(column.cast("string"))
