"""Intermediate tables in the shared folder: plans that read one several times do its work once, and a lost executor loses none."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor sees; a temporary one only where the cluster names none."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="convmill-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def fresh_path(spark: SparkSession) -> str:
    """A path of its own in the shared folder; what is there is removed at the end of the driver's process."""
    path = f"{shared_dir(spark)}/convmill-records-{uuid.uuid4().hex}"

    def remove() -> None:
        if spark.sparkContext._jsc is not None:
            with contextlib.suppress(Exception):
                there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(there, True)

    atexit.register(remove)
    return path


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table of its own, removed at the end of the driver's process."""
    path = fresh_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
