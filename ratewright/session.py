"""Session defaults and the shared folder that cuts long lineages."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
PARTITION_BYTES = 4 << 20  # of compressed input to a bucket of a table at rest
SHUFFLE_BYTES = 1 << 20  # of compressed input to a shuffle partition: coverages list their months after a shuffle
SPLIT_BYTES = 8 << 20  # of a file to a task: one that combines before a shuffle holds every key it reads
CODEC = "zstd"  # of written tables: hashes and keys take about half the room they take with snappy
_PARTITIONS = "spark.sql.shuffle.partitions"
_SPLIT = "spark.sql.files.maxPartitionBytes"
_CALLERS = "ratewright."


# Settings that a running session accepts.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # split a join partition that one key fills, even where that costs a shuffle
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # bounds what a Python worker holds of its input
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    # a join on (coverage, month) may reuse rows already hashed on coverage
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators are planned for to a session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def partitions_for(spark: SparkSession, paths: list[str], size: int = PARTITION_BYTES) -> int:
    """How many partitions of ``size`` the files below ``paths`` are worth; their sizes come from the file system."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    found = [jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    sizes = [p.getFileSystem(conf).getContentSummary(p).getLength() for p in found if p.getFileSystem(conf).exists(p)]
    return max(1, -(-sum(sizes) // size))


def size_to(spark: SparkSession, partitions: int) -> SparkSession:
    """Let shuffles have at least ``partitions`` partitions, and keep them and the splits of files small.

    Rows multiply after a shuffle here (a coverage lists its months, a month its factors), so
    the bytes that adaptive execution goes by say little about the memory of a task. A
    caller's larger number of partitions and smaller splits stand; a smaller input goes back
    to the caller's number.
    """

    def callers(key: str) -> str:
        own = spark.conf.get(_CALLERS + key, None) or spark.conf.get(key)
        spark.conf.set(_CALLERS + key, own)
        return own

    spark.conf.set(_PARTITIONS, str(max(int(callers(_PARTITIONS)), partitions)))
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(callers(_SPLIT))
    spark.conf.set(_SPLIT, str(min(split, SPLIT_BYTES)))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(SHUFFLE_BYTES))
    return spark


def build_session(app_name: str = "ratewright", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are planned for."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a single-machine session without that setting falls back to a
    temporary folder; on a cluster the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="ratewright-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, never reused path below the shared folder."""
    return f"{shared_dir(spark)}/ratewright/{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and continue from the files.

    Used where several consumers share one upstream. A written table survives
    lost executors, keeps column pruning for each consumer, and gives the
    planner the true size, so a join broadcasts it only when it is small.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
