"""Sessions, the shared work folder and the input views."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

Setup = Callable[[SparkSession], None]

# Stored input bytes per shuffle partition, unless the session sets PARTITION_SETTING. For very large inputs a larger
# size is worth setting: the blocks between all map and reduce tasks grow with the square of their number.
PARTITION_BYTES = 128 << 20
PARTITION_SETTING = "spark.slipway.partitionBytes"
# Spark takes a size it does not know for the largest number there is.
UNKNOWN_BYTES = 1 << 60


def settings_of(parent: SparkSession) -> dict[str, str]:
    """The settings that ``parent`` was given since its start."""
    initial = parent.newSession()
    # Most often there are none. One comparison in the JVM tells, which is far quicker than fetching all settings.
    if parent._jsparkSession.conf().getAllAsJava().equals(initial._jsparkSession.conf().getAllAsJava()):
        return {}
    defaults = initial.conf.getAll
    return {key: value for key, value in parent.conf.getAll.items() if defaults.get(key) != value}


def open_session(
    parent: SparkSession,
    conf: Mapping[str, str] | None = None,
    setup: Setup | None = None,
    inherited: Mapping[str, str] | None = None,
) -> SparkSession:
    """A session with its own temp views and settings on the parent's context.

    It starts from the ``inherited`` settings, by default those of the parent, and then takes ``conf``. Temp views are
    not shared between sessions, so ``setup`` registers whatever the work in this session needs to see. The catalog,
    the cache and global temp views are shared.
    """
    session = parent.newSession()
    if inherited is None:
        inherited = settings_of(parent)
    for key, value in {**inherited, **(conf or {})}.items():
        session.conf.set(key, value)
    if setup is not None:
        setup(session)
    return session


# Where the session's default file system keeps what is not for long.
DEFAULT_ROOT = "/tmp/slipway"


def work_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, else one on the default file system.

    On a cluster whose default file system is each machine's own, the setting is needed.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    path = file_path(spark, DEFAULT_ROOT)
    default = spark._jvm.org.apache.hadoop.fs.FileSystem.get(spark.sparkContext._jsc.hadoopConfiguration())
    return default.makeQualified(path).toString()


def work_path(spark: SparkSession, label: str) -> str:
    """A path below the work folder that nothing else uses."""
    return f"{work_root(spark)}/slipway/{label}-{uuid.uuid4().hex}"


def partitions_for(df: DataFrame) -> int:
    """How many shuffle partitions the data that ``df`` reads calls for; never fewer than its session is set to.

    It grows with the input, one partition for each ``spark.slipway.partitionBytes`` bytes. Sources whose size Spark does
    not know, such as rows from the driver, do not count.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    read = sum(size for size in sizes if size < UNKNOWN_BYTES)
    default = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(df.sparkSession.conf.get(PARTITION_SETTING, str(PARTITION_BYTES)))
    return max(default, -(-read // size))


def size_shuffles(df: DataFrame) -> DataFrame:
    """Let the shuffles of ``df`` begin with as many partitions as its input calls for.

    Adaptive execution joins partitions that turn out small, but cannot add any. The setting is its session's, so this
    is for a session that runs one query.
    """
    df.sparkSession.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", partitions_for(df))
    return df


def file_path(spark: SparkSession, path: str) -> Any:
    """``path`` as Spark itself takes it."""
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: Any) -> Any:
    """The file system that Spark itself uses for the path."""
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that is no longer needed."""
    location = file_path(spark, path)
    file_system(spark, location).delete(location, True)


def register_views(session: SparkSession, folder: str, names: Iterable[str]) -> None:
    """Make ``<folder>/<name>.parquet`` readable as the temp view ``<name>``. Nothing is read but the schema."""
    for name in names:
        session.read.parquet(f"{folder}/{name}.parquet").createOrReplaceTempView(name)


def table_views(spark: SparkSession, folder: str, names: Iterable[str]) -> Setup:
    """The same as a setup for many sessions: the schemas are read once, here."""
    paths = {name: f"{folder}/{name}.parquet" for name in names}
    schemas = {name: spark.read.parquet(path).schema for name, path in paths.items()}

    def setup(session: SparkSession) -> None:
        for name, path in paths.items():
            session.read.schema(schemas[name]).parquet(path).createOrReplaceTempView(name)

    return setup
