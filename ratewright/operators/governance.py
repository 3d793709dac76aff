"""Assumption versions: change log, version register and run metadata."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewright.functions.keys import natural_key
from ratewright.functions.text import normalize_value
from ratewright.sources import schemas
from ratewright.sources.tables import overwrite_table, table_or_empty, upper_case_headers

ROW_MARK = "__row__"


@dataclass(frozen=True)
class AssumptionType:
    name: str
    table: str
    file_name: str
    keys: tuple[str, ...]


_SEGMENT_KEYS = ("STATE", "RISK_CLASS", "VEHICLE_SEGMENT")

# Assumption type, table, workbook and natural key.
ASSUMPTION_TYPES = {
    t.name: t
    for t in [
        AssumptionType(
            "ldf_selection",
            "LDF_SELECTION_TABLE",
            "ldf_selection_table.xlsx",
            ("SEGMENTATION_VERSION", "TRIANGLE_TYPE", *_SEGMENT_KEYS, "DEVELOPMENT"),
        ),
        AssumptionType(
            "selected_ultimate",
            "SELECTED_ULTIMATE",
            "selected_ultimate.xlsx",
            ("SEGMENTATION_VERSION", "TYPE", *_SEGMENT_KEYS, "ACCIDENT_YEAR", "METHOD"),
        ),
        AssumptionType(
            "ultimate_selection",
            "ULTIMATE_SELECTION",
            "ultimate_selection.xlsx",
            ("SEGMENTATION_VERSION", "TYPE", *_SEGMENT_KEYS, "ACCIDENT_YEAR"),
        ),
        AssumptionType(
            "trend_selection",
            "TREND_SELECTION",
            "trend_selection.xlsx",
            ("SEGMENTATION_VERSION", "TREND_TYPE", *_SEGMENT_KEYS),
        ),
        AssumptionType(
            "expense_assumption", "EXPENSE_ASSUMPTION", "expense_assumption.xlsx", ("PRICING_VERSION", "STATE")
        ),
    ]
}


def key_columns(assumption_type: str) -> list[str]:
    if assumption_type not in ASSUMPTION_TYPES:
        raise ValueError(
            f"unsupported assumption type {assumption_type!r}; valid: {', '.join(sorted(ASSUMPTION_TYPES))}"
        )
    return list(ASSUMPTION_TYPES[assumption_type].keys)


def normalized_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Upper-case headers, every value as text, and the natural row key."""
    upper = upper_case_headers(df)
    missing = [k for k in keys if k not in upper.columns]
    if missing:
        raise ValueError(f"missing key columns: {missing}")
    text = upper.select(*[normalize_value(F.col(f.name), f.dataType).alias(f.name) for f in upper.schema])
    return text.withColumn("ROW_KEY", natural_key(*[F.col(k) for k in keys]))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Natural keys that occur more than once."""
    rows = normalized_rows(df, keys).groupBy("ROW_KEY").agg(F.count(F.lit(1)).alias("row_count"))
    return rows.where("row_count > 1").select(F.col("ROW_KEY").alias("row_key"), "row_count")


def require_unique_keys(df: DataFrame, keys: list[str]) -> None:
    sample = [r.row_key for r in duplicate_keys(df, keys).limit(5).collect()]  # five keys for the message
    if sample:
        raise ValueError(f"duplicate natural keys {keys}; for example: {', '.join(sample)}")


def _row_json(columns: list[str], side: str) -> Column:
    ordered = [F.col(f"{side}.{c}").alias(c) for c in sorted(columns)]
    return F.to_json(F.struct(*ordered), {"ignoreNullFields": "false"})


def change_log(
    previous: DataFrame,
    current: DataFrame,
    keys: list[str],
    assumption_set_id: str,
    assumption_type: str,
    file_name: str,
    changed_at: datetime | str,
) -> DataFrame:
    """Rows added and removed, and cells updated, between two versions of a table.

    One full outer join on the natural key; the cells that differ come from an
    array of the compared columns, so no column costs a scan of its own.
    """
    old_rows, new_rows = normalized_rows(previous, keys), normalized_rows(current, keys)
    old_columns = [c for c in old_rows.columns if c != "ROW_KEY"]
    new_columns = [c for c in new_rows.columns if c != "ROW_KEY"]
    old = old_rows.select("ROW_KEY", F.struct(*old_columns).alias("old"))
    new = new_rows.select("ROW_KEY", F.struct(*new_columns).alias("new"))

    def entry(kind: str, column: str, before: Column, after: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("change_type"),
            F.lit(column).alias("column_name"),
            before.alias("old_value"),
            after.alias("new_value"),
        )

    none = F.lit(None).cast("string")
    updates = []
    for c in new_columns:
        before = F.col(f"old.{c}") if c in old_columns else none
        after = F.col(f"new.{c}")
        updates.append(F.when(~before.eqNullSafe(after), entry("updated", c, before, after)))
    changes = (
        F.when(F.col("old").isNull(), F.array(entry("added", ROW_MARK, none, _row_json(new_columns, "new"))))
        .when(F.col("new").isNull(), F.array(entry("removed", ROW_MARK, _row_json(old_columns, "old"), none)))
        .otherwise(F.array_compact(F.array(*updates)))
    )
    return (
        old.join(new, "ROW_KEY", "full")
        .select("ROW_KEY", F.inline(changes))
        .select(
            F.lit(assumption_set_id).alias("assumption_set_id"),
            F.lit(assumption_type).alias("assumption_type"),
            F.lit(file_name).alias("file_name"),
            F.col("ROW_KEY").alias("row_key"),
            "change_type",
            "column_name",
            "old_value",
            "new_value",
            F.lit(changed_at).cast("timestamp").alias("changed_at"),
        )
    )


def change_summary(changes: DataFrame) -> DataFrame:
    """Number of changes by type."""
    return changes.groupBy("change_type").agg(F.count(F.lit(1)).alias("change_count"))


def next_version(register: DataFrame, assumption_type: str) -> DataFrame:
    """One row: the next sequence number of a type and the set it follows."""
    own = register.where(F.col("assumption_type") == assumption_type)
    return own.agg(
        (F.coalesce(F.max("version_sequence"), F.lit(0)) + 1).cast("bigint").alias("version_sequence"),
        F.max_by("assumption_set_id", "version_sequence").alias("previous_assumption_set_id"),
    )


def version_row(
    register: DataFrame,
    assumption_type: str,
    assumption_set_id: str,
    row_count: int,
    change_count: int,
    author: str,
    uploaded_at: datetime | str,
    comment: str | None = None,
    version_label: str | None = None,
    dag_id: str | None = None,
    dag_run_id: str | None = None,
    task_id: str | None = None,
) -> DataFrame:
    """The register entry of a new version."""
    kind = ASSUMPTION_TYPES[assumption_type]
    label = F.lit(version_label) if version_label else F.concat(F.lit("auto_v"), F.col("version_sequence"))
    values = {
        "assumption_set_id": F.lit(assumption_set_id),
        "assumption_type": F.lit(assumption_type),
        "file_name": F.lit(kind.file_name),
        "target_table_name": F.lit(kind.table),
        "version_sequence": F.col("version_sequence"),
        "version_label": label,
        "status": F.lit("uploaded"),
        "uploaded_at": F.lit(uploaded_at),
        "uploaded_by": F.lit(author),
        "upload_comment": F.lit(comment),
        "source_row_count": F.lit(row_count),
        "change_count": F.lit(change_count),
        "previous_assumption_set_id": F.col("previous_assumption_set_id"),
        "dag_id": F.lit(dag_id),
        "dag_run_id": F.lit(dag_run_id),
        "task_id": F.lit(task_id),
    }
    schema = schemas.GOVERNANCE["assumption_version"]
    return next_version(register, assumption_type).select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in schema]
    )


def run_metadata_row(version: DataFrame, metadata_id: str) -> DataFrame:
    """Run metadata that points at a register entry."""
    return version.select(
        F.lit(metadata_id).alias("pipeline_run_metadata_id"),
        "dag_id",
        "dag_run_id",
        "task_id",
        "assumption_set_id",
        "assumption_type",
        "file_name",
        "version_sequence",
        "version_label",
        F.col("uploaded_at").alias("registered_at"),
    )


# ---- the upload as a commit --------------------------------------------------------

_ATTEMPTS = 20
_COMMITS = "version_commits"


def _create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file; False if it exists. The file system decides, so one of two writers wins."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        out = files.create(target, False)
    except Py4JJavaError as failed:
        if "FileAlreadyExistsException" not in failed.java_exception.getClass().getName():
            raise
        return False
    out.write(bytearray(text.encode()))
    out.close()
    return True


def commit_log(spark: SparkSession, root: str) -> DataFrame:
    """The register of versions, one committed file each. Copies follow it."""
    schema = schemas.GOVERNANCE["assumption_version"]
    try:
        rows = spark.read.schema(schema).json(f"{root}/{_COMMITS}/*")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return rows.where("assumption_set_id IS NOT NULL")


def upload_assumption(
    root: str,
    assumption_type: str,
    new: DataFrame,
    author: str,
    comment: str | None = None,
    version_label: str | None = None,
    dag_id: str | None = None,
    dag_run_id: str | None = None,
    task_id: str | None = None,
    uploaded_at: datetime | None = None,
) -> str:
    """Commit a new version of an assumption table below ``root``; returns its set id.

    Each version is written to its own folder and the register names it. The data comes
    first, then the version is committed by creating the file of its sequence number,
    which exactly one of several uploads at the same time can do. The others find a new
    current version, compare with that one and try the next number. The change log lies
    under its set's id and is in place before the commit; a log without a committed set
    means nothing. Register and metadata tables are copies by set id, made afterwards: what
    a job that died has not copied, the next upload copies. So a job that dies part way
    either changes nothing or leaves a complete version.
    """
    spark = new.sparkSession
    kind, keys = ASSUMPTION_TYPES[assumption_type], key_columns(assumption_type)
    require_unique_keys(new, keys)
    set_id = str(uuid.uuid4())
    at = uploaded_at or datetime.now(timezone.utc).replace(tzinfo=None)
    row_count = overwrite_table(new, _of_set(root, kind.table.lower(), set_id))
    for _ in range(_ATTEMPTS):
        register = commit_log(spark, root)
        previous = _current(register, root, assumption_type)
        changes = change_log(
            new.limit(0) if previous is None else previous, new, keys, set_id, assumption_type, kind.file_name, at
        )
        change_count = overwrite_table(
            changes.drop("assumption_set_id"), _of_set(root, "assumption_change_log", set_id)
        )
        version = version_row(
            register, assumption_type, set_id, row_count, change_count, author, at, comment, version_label,
            dag_id, dag_run_id, task_id,
        )
        row = version.select("version_sequence", F.to_json(F.struct("*")).alias("text")).first()  # one row
        if _create_if_absent(spark, f"{root}/{_COMMITS}/{assumption_type}/{row.version_sequence:09d}.json", row.text):
            copy_register(spark, root)
            return set_id
    raise RuntimeError(f"{assumption_type}: {_ATTEMPTS} other uploads came first")


def _of_set(root: str, table: str, set_id: str) -> str:
    return f"{root}/{table}/assumption_set_id={set_id}"


def copy_register(spark: SparkSession, root: str) -> None:
    """Bring the register and metadata tables up to the committed versions; running it again changes nothing."""
    committed = commit_log(spark, root)
    held = table_or_empty(spark, f"{root}/assumption_version", schemas.GOVERNANCE["assumption_version"])
    missing = committed.join(held, "assumption_set_id", "left_anti").select(*committed.columns)
    for row in missing.collect():  # the versions since the last upload
        version = spark.createDataFrame([row], committed.schema)
        metadata = run_metadata_row(version, str(uuid.uuid5(uuid.NAMESPACE_OID, row.assumption_set_id)))
        for df, table in ((metadata, "pipeline_run_metadata"), (version, "assumption_version")):
            overwrite_table(df.drop("assumption_set_id"), _of_set(root, table, row.assumption_set_id))


def current_assumption(spark: SparkSession, root: str, assumption_type: str) -> DataFrame | None:
    """The committed current version of an assumption table, if there is one."""
    return _current(commit_log(spark, root), root, assumption_type)


def _current(register: DataFrame, root: str, assumption_type: str) -> DataFrame | None:
    set_id = next_version(register, assumption_type).first().previous_assumption_set_id  # one row
    if set_id is None:
        return None
    return register.sparkSession.read.parquet(_of_set(root, ASSUMPTION_TYPES[assumption_type].table.lower(), set_id))
