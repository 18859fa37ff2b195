"""Tables written to the folder that driver and executors share, to cut lineage."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or in tests a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def new_path(spark: SparkSession, kind: str = "cut") -> str:
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries run in here remove their shuffle files when they end, as nothing reads them again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def cut(df: DataFrame, *by: str) -> DataFrame:
    """Write a table to the shared folder, partitioned by some columns, and read it back: lineage ends there and lost executors cost nothing."""
    path = new_path(df.sparkSession)
    with _shuffles_removed(df.sparkSession):
        df.write.partitionBy(*by).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def discard(df: DataFrame | None) -> None:
    """Delete the files of a table from `cut` that nothing reads any more; of other tables nothing."""
    path = getattr(df, "_written", None)
    if path:
        sc = df.sparkSession.sparkContext
        at = sc._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)
