"""Session set-up and the shared scratch folder.

Tables that cut lineage are written below the folder the cluster names in
``spark.checkpoint.dir``, so they outlive any executor.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}


def build_session(app_name: str = "tallyferry", **conf: str) -> SparkSession:
    """A session with the settings this library is tuned for; ``conf`` wins.

    Keys are given with underscores for dots, e.g. ``spark_master="local[8]"``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """This application's folder inside the shared checkpoint folder."""
    root = spark.conf.get(_CHECKPOINT_CONF, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                f"{_CHECKPOINT_CONF} is not set: name a folder every executor can reach"
            )
        # Local runs such as tests only: one JVM, so its own folder is shared enough.
        app = spark.sparkContext.applicationId
        if app not in _local_roots:
            _local_roots[app] = tempfile.mkdtemp(prefix="tallyferry-")
        root = _local_roots[app]
    return f"{root.rstrip('/')}/tallyferry/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one written table."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Unlike ``checkpoint()`` the result keeps column pruning and pushdown.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_scratch(spark: SparkSession) -> None:
    """Delete every table this application wrote to the scratch folder."""
    clear_folder(spark, scratch_root(spark))


def hadoop_path(spark: SparkSession, path: str):
    """The Hadoop ``Path`` and its ``FileSystem``, for metadata operations only."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = hadoop_path(spark, path)
    return fs.exists(jpath)


def clear_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder and what is in it, if it exists."""
    jpath, fs = hadoop_path(spark, path)
    fs.delete(jpath, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct children of a directory; empty when it is absent."""
    jpath, fs = hadoop_path(spark, path)
    if not fs.exists(jpath):
        return []
    return [status.getPath().getName() for status in fs.listStatus(jpath)]


def file_count(spark: SparkSession, path: str) -> int:
    """Data files at any depth below a folder; hidden ones are no data."""
    jpath, fs = hadoop_path(spark, path)
    files, found = fs.listFiles(jpath, True), 0
    while files.hasNext():
        found += not files.next().getPath().getName().startswith(("_", "."))
    return found


def partitions_for(df: DataFrame, target_mb: int = 256) -> int | None:
    """How many shuffle partitions ``df`` needs, or None when the session's number will do.

    Uses the sizes of the tables it reads. None, also when they are unknown, lets
    adaptive execution coalesce.
    """
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = (estimated_bytes(df) or 0) // (target_mb * 1024 * 1024)
    return wanted if wanted > configured else None


def estimated_bytes(df: DataFrame) -> int | None:
    """Sum of the sizes of the tables that ``df`` reads: file sizes or catalog statistics, no scan.

    None when no table's size is known, as for rows in memory or behind a
    database connection, where the optimizer's default stands for "unknown".
    """
    unknown = int(df.sparkSession.conf.get("spark.sql.defaultSizeInBytes", str(2**63 - 1)))
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    known = [s for s in sizes if s < unknown]
    return sum(known) if known else None
