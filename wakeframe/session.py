"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("wakeframe")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    (tests, one machine) a folder of our own is made and set.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0]
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="wakeframe-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system the path names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession):
    """Within the block, a query's shuffle files go when the query has ended.

    Without it they stay until the driver happens to collect its garbage, and a
    job of many written stages fills the disks.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


@contextmanager
def small_batches(spark: SparkSession, size: int = BATCH_BYTES):
    """Within the block, Python workers of a query get at most about ``size`` bytes at a time, or one row.

    By default a batch is bounded by 10,000 rows and 64 MB. Each core holds one in its
    executor's memory outside the heap and another in its worker, and workers keep
    what a large batch took.
    """
    before = spark.conf.get(ARROW_BYTES)
    spark.conf.set(ARROW_BYTES, str(size))
    try:
        yield
    finally:
        spark.conf.set(ARROW_BYTES, before)


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    Later passes read only the columns they need and do not depend on the
    executors that computed the rows. The table stays until the folder is
    cleaned; ``Stages`` deletes earlier.
    """
    return Stages(df.sparkSession).keep(df, name)


class Stages:
    """Written tables of one job, deleted one by one as they are used up."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def keep(self, df: DataFrame, name: str = "stage") -> DataFrame:
        path = fresh_path(self.spark, name)
        with shuffles_released(self.spark), small_batches(self.spark):
            df.write.parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(kept)] = (kept, path)
        return kept

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that nothing reads any more; others' tables are left alone."""
        for table in tables:
            known = self.paths.pop(id(table), None)
            if known:
                folder = self.spark._jvm.org.apache.hadoop.fs.Path(known[1])
                folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
