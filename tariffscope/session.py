"""Session settings and written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # narrow rows shrink much in a shuffle: partitions of the default 64 MB take gigabytes in a task's hash table
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # joined partitions are not split again: few to begin with would grow with the input, and with them the tables in a task's memory
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "400",
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Java does not compile longer methods; beyond, Spark generates short ones for each operator instead of one for all
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

#: Temporary folders of local sessions without the setting, by application.
_own_folders: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every job here relies on."""
    for key, value in _DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tariffscope") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by spark.checkpoint.dir.

    Only a local master may fall back to a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or _own_folders.get(spark.sparkContext.applicationId)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tariffscope-")
    # a running session doesn't take this setting
    return _own_folders.setdefault(spark.sparkContext.applicationId, folder)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with a table that survives lost executors, and gives the planner the
    real size of the data for later joins.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def package_on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Enough for a local master and for executors that see the same path; elsewhere pass the package with
    ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))
