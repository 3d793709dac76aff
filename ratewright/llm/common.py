"""Helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ratewright.session import materialize, scratch_path

__all__ = ["arrow_rows", "materialize", "scratch_path", "table", "with_columns"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def with_columns(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """``batch`` with further columns; an input column of the same name gives way."""
    kept = [name for name in batch.schema.names if name not in columns]
    arrays = [batch.column(batch.schema.get_field_index(name)) for name in kept]
    return pa.RecordBatch.from_arrays([*arrays, *columns.values()], names=[*kept, *columns])


def arrow_rows(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    return df.mapInArrow(function, schema)
