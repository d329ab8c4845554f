"""Writing records: JSON lines by split, metrics, and an append-only task table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.commits import Commits
from ..functions.durable import written


def save(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A folder of JSON lines in UTF-8; null fields are written as null."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def save_lines(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """As ``save``; a row that has no JSON form (null, or a number that JSON can't write) is left out, and their number is returned."""
    line = F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)), {"ignoreNullFields": "false"})
    odd = [F.coalesce(F.isnan(F.col(f"`{c}`")) | (F.abs(F.col(f"`{c}`")) == float("inf")), F.lit(False)) for c, t in df.dtypes if t in ("double", "float")]
    bad = line.isNull()
    for o in odd:
        bad = bad | o
    seen = Observation()
    df.select(line.alias("value"), bad.alias("bad")).observe(seen, F.count(F.when(F.col("bad"), 1)).alias("skipped")).where("NOT bad").select("value").write.mode(mode).text(path)
    return seen.get["skipped"]


def save_splits(df: DataFrame, path: str, column: str = "split", mode: str = "overwrite") -> None:
    """One folder a split; a split without rows gets none."""
    df.write.mode(mode).option("ignoreNullFields", "false").partitionBy(column).json(path)


def save_metrics(report: DataFrame, path: str) -> None:
    """A report of a few rows, one object a line in one file."""
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


_TASKS = "append string, folder string, first bigint, count bigint"


def _numbered(tasks: DataFrame) -> DataFrame:
    """``tasks`` with ``at`` from 0 in order of their text. Each partition's offset is the number of rows in those before it, so no task holds all rows."""
    some = written(tasks.where("task_details IS NOT NULL").select("task_details").repartitionByRange("task_details").sortWithinPartitions("task_details").select("task_details", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = some.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first")).select("part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off"))
    return some.join(F.broadcast(offsets), "part").select((F.col("at") - F.col("first") + F.col("off")).cast("bigint").alias("at"), "task_details", F.lit("pending").alias("status"), F.current_timestamp().alias("created_at"))


def append_tasks(spark: SparkSession, path: str, tasks: DataFrame, append: str | None = None, most_tries: int = 1000) -> DataFrame:
    """Appends task_details as pending tasks with ids from the greatest one on, and returns the rows added.

    Rows are written first, numbered from 0, into a folder that nobody reads; a commit then gives the folder its first id. A writer that finds its
    number taken takes the next one, so ids of several writers have neither gaps nor repeats. ``append`` names the append: one that was
    committed before, as when a job is run again, adds nothing and gives the rows of then. An empty table adds nothing.
    """
    append = append or uuid.uuid4().hex
    log = Commits(spark, path, _TASKS)
    folder = f"rows-{uuid.uuid4().hex}"
    count = None
    for _ in range(most_tries):
        number, last = log.latest()
        if number and not log.entries().where(F.col("append") == append).isEmpty():
            break
        if count is None:
            _numbered(tasks).write.parquet(f"{path}/rows/folder={folder}")
            count = spark.read.parquet(f"{path}/rows/folder={folder}").count()
        if log.commit(number + 1, {"append": append, "folder": folder, "first": last["first"] + last["count"] if last else 1, "count": count}):
            break
    else:
        raise RuntimeError(f"no commit after {most_tries} tries")
    return tasks_of(spark, path, append)


def tasks_of(spark: SparkSession, path: str, append: str | None = None) -> DataFrame:
    """id, task_details, status and created_at of all tasks that were committed, or of one append."""
    entries = Commits(spark, path, _TASKS).entries()
    entries = entries if append is None else entries.where(F.col("append") == append)
    rows = spark.read.schema("at bigint, task_details string, status string, created_at timestamp, folder string").parquet(f"{path}/rows")
    return rows.join(entries.select("folder", "first"), "folder").select((F.col("first") + F.col("at")).alias("id"), "task_details", "status", "created_at")
