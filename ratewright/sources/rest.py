"""Raw tables at rest: bucketed and sorted by the keys they are joined on.

A load pays once for dealing a table by its key; every later join or aggregation on that
key then reads matching buckets and needs no exchange. A table that is joined on two keys
lies twice. A bucket cannot be split while it is read, so a copy whose commonest key would make one bucket much larger than the
others is written without buckets: its joins shuffle, and adaptive execution splits them.

The manifest says how each copy lies; a new session registers the tables from it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewright.session import CODEC
from ratewright.sources import schemas

BUCKETS = 64
HOT_FACTOR = 8  # a key may fill this many average buckets
_MANIFEST = "_layout"


# The keys each table lies by; the first copy is the table itself.
LAYOUT: dict[str, tuple[str, ...]] = {
    "raw_policy": ("policy_id",),
    "raw_policy_risk_unit": ("risk_unit_id",),
    "raw_policy_coverage": ("policy_id", "coverage_id"),
    "raw_premium_transaction": ("coverage_id",),
    "raw_claim": ("claim_id",),
    "raw_claim_transaction": ("claim_id",),
    "raw_vehicle": ("policy_id",),
    "raw_driver": ("policy_id",),
    "raw_driver_vehicle_assignment": ("policy_id",),
    "raw_property_location": ("policy_id",),
}


def _table_name(root: str, name: str, key: str) -> str:
    return f"rest_{hashlib.md5(root.encode()).hexdigest()[:12]}_{name}_by_{key}"


def _path(root: str, name: str, key: str) -> str:
    first = name not in LAYOUT or LAYOUT[name][0] == key
    return f"{root}/{name}" if first else f"{root}/{name}_by_{key}"


def is_hot(df: DataFrame, key: str, buckets: int) -> bool:
    """Whether one key has more than ``HOT_FACTOR`` average buckets of rows.

    No key has more rows than its bucket, so keys are counted only where a bucket is that large.
    """
    counted = df.groupBy(F.pmod(F.hash(key), F.lit(buckets))).agg(F.count(F.lit(1)).alias("n"))
    found = counted.agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()  # one row
    most = HOT_FACTOR * max(found.rows or 0, buckets) // buckets
    if (found.most or 0) <= most:
        return False
    return bool(df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).limit(1).count())


def _write_bucketed(df: DataFrame, path: str, table: str, key: str, buckets: int) -> None:
    """Write rows that lie by ``key`` in as many partitions as there are buckets."""
    (
        df.write.mode("errorifexists")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .option("compression", CODEC)
        .saveAsTable(table)
    )


def write_at_rest(
    root: str, name: str, df: DataFrame, buckets: int = BUCKETS, by_key: dict[str, DataFrame] | None = None
) -> None:
    """Write every copy of one table; tables without a layout are written plainly.

    ``by_key`` has the same rows where they lie by a key already, in as many partitions.
    """
    spark = df.sparkSession
    rows = []
    for key in LAYOUT.get(name, ()):
        hot = is_hot(df, key, buckets)
        path = _path(root, name, key)
        if hot:
            df.write.mode("errorifexists").option("compression", CODEC).parquet(path)
        else:
            lies = (by_key or {}).get(key) or df.repartition(buckets, key)
            _write_bucketed(lies, path, _table_name(root, name, key), key, buckets)
        rows.append((name, key, 0 if hot else buckets))
    if not rows:
        df.write.mode("errorifexists").option("compression", CODEC).parquet(f"{root}/{name}")
        rows.append((name, "", 0))
    spark.createDataFrame(rows, "name string, key string, buckets int").write.mode("append").parquet(
        f"{root}/{_MANIFEST}"
    )


def source_at_rest(spark: SparkSession, root: str) -> Callable[..., DataFrame]:
    """``source(name, key=None)``: the copy of a table that lies by ``key``, else the table itself."""
    lies = {(r.name, r.key): r.buckets for r in spark.read.parquet(f"{root}/{_MANIFEST}").collect()}  # one row a copy

    def read(name: str, key: str | None = None) -> DataFrame:
        if name not in schemas.ALL:
            raise KeyError(f"unknown table {name!r}")
        own = LAYOUT[name][0] if name in LAYOUT else ""
        chosen = key if (name, key) in lies else own
        path, schema = _path(root, name, chosen), schemas.ALL[name]
        buckets = lies.get((name, chosen), 0)
        if not buckets:
            return spark.read.schema(schema).parquet(path)
        table = _table_name(root, name, chosen)
        if not spark.catalog.tableExists(table):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            spark.sql(
                f"CREATE TABLE {table} ({columns}) USING parquet "
                f"CLUSTERED BY ({chosen}) SORTED BY ({chosen}) INTO {buckets} BUCKETS LOCATION '{path}'"
            )
        return spark.table(table)

    return read


def conformed(df: DataFrame, name: str) -> DataFrame:
    """The declared columns of a table in their declared types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.ALL[name]])
