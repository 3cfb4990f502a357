"""Session helpers: a local session for tests and bench, shared scratch tables, and the package on the executors."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: the work folder of local sessions; a cluster names its own in spark.checkpoint.dir
LOCAL_WORK_DIR = os.environ.get("COURTSIDE_WORK_DIR", "/tmp/courtside-work")
#: whether the shuffle files of a query are removed when it ends
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", work_dir: str = LOCAL_WORK_DIR) -> SparkSession:
    """Single-JVM session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("courtside")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", work_dir)
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. A local session without one, as in a smoke test, gets the local work folder."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = LOCAL_WORK_DIR
    return folder.rstrip("/")


def hadoop_path(spark: SparkSession, path: str):
    """A path of the JVM and its file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, system = hadoop_path(spark, path)
    return system.exists(hadoop)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run has used. It is removed when the driver ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    hadoop, system = hadoop_path(spark, path)
    system.deleteOnExit(hadoop)
    return path


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that are run inside, such as writes, remove their shuffle files when they end. Nothing reads these again, but they would
    fill the disks until the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage through a written table in the shared folder, so a lost executor re-reads instead of recomputing."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Makes this package importable on the executors, once per application, wherever the driver was started."""
    context = spark.sparkContext
    if getattr(context, "_courtside_shipped", False):
        return
    root = Path(__file__).resolve().parent
    # the driver serves the file to the executors itself
    archive = os.path.join(tempfile.mkdtemp(prefix="courtside-code-"), "courtside_code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, str(Path(root.name) / source.relative_to(root)))
    context.addPyFile(archive)
    context._courtside_shipped = True
