"""Text keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*columns: str) -> Column:
    """Stable hash of a column combination; NULL differs from the empty string."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("<null>")) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def natural_key(*columns: Column) -> Column:
    """Readable row key ``a|b|c``; NULL reads as the empty string."""
    return F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in columns])
