"""Pricing segments: which policy attributes a segmentation version keeps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEGMENT = ["state_grp", "risk_class_grp", "vehicle_segment_grp"]

# Version, use state, use risk class, use vehicle segment.
SEGMENTATION_CONFIG = [
    ("v1", 1, 1, 0),
    ("v2", 1, 0, 0),
    ("v3", 0, 0, 0),
]

_CONFIG_SCHEMA = "segmentation_version string, use_state int, use_risk_class int, use_vehicle_segment int"


def segmentation_config(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SEGMENTATION_CONFIG, _CONFIG_SCHEMA)


def version_flags(version: str | tuple[int, int, int]) -> tuple[int, int, int]:
    """The flags of a version; flags themselves are taken as they are."""
    if isinstance(version, tuple):
        return version
    for name, *flags in SEGMENTATION_CONFIG:
        if name == version:
            return tuple(flags)
    raise ValueError(f"unknown segmentation version {version!r}")


def segmentation_grouping(column: Column, flag: Column | int) -> Column:
    """Keep the value where the flag is set, else the pooled level 'ALL'."""
    f = F.lit(flag) if isinstance(flag, int) else flag
    return F.when(f == 1, column).otherwise(F.lit("ALL"))


def all_versions(sources: list[str], names: list[str] = SEGMENT) -> Column:
    """Array with one entry per version: its name and the three grouping columns."""
    return F.array(
        *[
            F.struct(
                F.lit(version).alias("segmentation_version"),
                *[segmentation_grouping(F.col(s), flag).alias(n) for s, flag, n in zip(sources, flags, names)],
            )
            for version, *flags in SEGMENTATION_CONFIG
        ]
    )


def segment_columns(
    version: str | tuple[int, int, int],
    state: str = "state",
    risk_class: str = "risk_class",
    vehicle_segment: str = "vehicle_segment",
) -> list[Column]:
    """The three grouping columns of one version.

    The flags are constants of the run, so they are resolved here and the
    optimizer drops the policy columns that the version does not use.
    """
    sources = [state, risk_class, vehicle_segment]
    return [
        segmentation_grouping(F.col(source), flag).alias(name)
        for source, flag, name in zip(sources, version_flags(version), SEGMENT)
    ]


FINEST = (1, 1, 1)


def by_versions(finest: DataFrame, config: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """``sums`` of a finest-segment table by ``keys`` for every version of the ``config`` relation.

    The config's rows become the GROUPING SETS of one aggregation: the table is read and
    shuffled once for all versions, with rows combined on the map side. Versions of equal
    flags share a set. The result has the version, the three grouping columns, the keys
    and the sums.
    """
    versions = config.select(
        "segmentation_version", *[F.col(f"use_{c}").cast("int").alias(c) for c in ("state", "risk_class", "vehicle_segment")]
    ).collect()  # the rows of the configuration
    sets = sorted({tuple(n for n, use in zip(SEGMENT, row[1:]) if use == 1) for row in versions})
    # a column that a set leaves out has its bit set in the grouping id, the first column the highest
    ids = [(row[0], sum((use != 1) << (2 - i) for i, use in enumerate(row[1:]))) for row in versions]
    spark = finest.sparkSession
    names = spark.createDataFrame(ids, "segmentation_version string, version_set bigint")
    columns = [*SEGMENT, *keys]
    grouped = finest.groupingSets([[F.col(c) for c in (*s, *keys)] for s in sets], *[F.col(c) for c in columns]).agg(
        *[F.sum(c).alias(c) for c in sums],
        F.shiftright(F.grouping_id(), len(keys)).cast("bigint").alias("version_set"),
    )
    pooled = [
        segmentation_grouping(F.col(n), (F.col("version_set").bitwiseAND(1 << (2 - i)) == 0).cast("int")).alias(n)
        for i, n in enumerate(SEGMENT)
    ]
    return grouped.join(names, "version_set").select("segmentation_version", *pooled, *keys, *sums)
