"""Table readers and writers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewright.sources import schemas


def _read(spark: SparkSession, root: str, name: str, schema: T.StructType, fmt: str) -> DataFrame:
    reader = spark.read.schema(schema)
    path = f"{root.rstrip('/')}/{name}"
    if fmt == "csv":
        return reader.option("header", True).csv(path)
    if fmt == "parquet":
        return reader.parquet(path)
    if fmt == "orc":
        return reader.orc(path)
    raise ValueError(f"unsupported format {fmt!r}")


def _lookup(registry: Mapping[str, T.StructType], name: str) -> T.StructType:
    if name not in registry:
        raise KeyError(f"unknown table {name!r}; known: {', '.join(sorted(registry))}")
    return registry[name]


def read_raw(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    return _read(spark, root, name, _lookup(schemas.RAW, name), fmt)


def read_assumption(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    return _read(spark, root, name, _lookup(schemas.ASSUMPTIONS, name), fmt)


def read_governance(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    return _read(spark, root, name, _lookup(schemas.GOVERNANCE, name), fmt)


def read_seed(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    return _read(spark, root, name, _lookup(schemas.SEEDS, name), fmt)


def stamp_load_metadata(df: DataFrame, batch_id: str, ingested_at: datetime | str) -> DataFrame:
    """Attach the audit columns of one load."""
    return df.withColumns(
        {"load_batch_id": F.lit(batch_id), "ingested_at": F.lit(ingested_at).cast("timestamp")}
    )


def overwrite_table(df: DataFrame, path: str) -> int:
    """Replace a table and report the rows written, counted during the write."""
    seen = Observation("rows_written")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def append_table(df: DataFrame, path: str) -> int:
    seen = Observation("rows_appended")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return seen.get["rows"]


BATCH = "load_batch_id"
_COMMITS = "_commits"  # readers of the table pass over names that start so


def committed_batches(spark: SparkSession, path: str) -> DataFrame:
    """(load_batch_id, row_count) of the loads that came to their end."""
    schema = T.StructType([T.StructField(BATCH, T.StringType()), T.StructField("row_count", T.LongType())])
    return table_or_empty(spark, f"{path}/{_COMMITS}", schema).where("row_count IS NOT NULL")


def load_batch(df: DataFrame, path: str, batch_id: str, replace: bool = False) -> int:
    """Put one batch of rows into a table; running it again changes nothing.

    A batch has its own partition. A run that died left no commit marker, so the next
    run of the batch overwrites what it wrote; other batches are not touched. A batch
    with a marker is left alone, unless ``replace`` says that it is to be written anew:
    its marker goes first, so no reader sees an old marker over new rows. Returns the
    rows of the batch.
    """
    spark = df.sparkSession
    part = f"{BATCH}={quote(batch_id, safe='')}"

    def mark(rows: int | None) -> None:
        spark.createDataFrame([(rows,)], "row_count bigint").write.mode("overwrite").parquet(f"{path}/{_COMMITS}/{part}")

    done = committed_batches(spark, path).where(F.col(BATCH) == batch_id).first()  # one row
    if done and not replace:
        return done.row_count
    if done:
        mark(None)
    seen = Observation("rows_loaded")
    rows = df.drop(BATCH).observe(seen, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("overwrite").parquet(f"{path}/{part}")
    written = seen.get["rows"]
    mark(written)
    return written


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of committed batches; a load that is under way or died is not seen."""
    done = committed_batches(spark, path).select(BATCH)
    return table_or_empty(spark, path, schema).join(done, BATCH, "left_semi").select(*schema.names)


def table_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet table at ``path``, or no rows where there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def upper_case_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def concat_with_schema(frames: Iterable[DataFrame], columns: list[str]) -> DataFrame:
    """Stack frames by name; a column a frame lacks reads NULL."""
    frames = list(frames)
    if not frames:
        raise ValueError("at least one frame is needed")
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    missing = [c for c in columns if c not in stacked.columns]
    return stacked.withColumns({c: F.lit(None).cast("string") for c in missing}).select(*columns)
