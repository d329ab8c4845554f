"""A durable cache of tool results: calls met before are looked up, the others executed once, kept with the run that last used them, and
the least recently used ones of a tool leave when it has too many."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.commits import Commits
from ..functions.durable import written
from ..functions.names import fresh
from .toolcalls import Registry, default_registry

#: Results kept for one tool.
MOST = 1000
_ROW = "digest string, name string, result string, made bigint, used bigint"


def digest_of(name: Column, arguments: Column) -> Column:
    """What a call is known by: its name and arguments, in whatever order they were written."""
    return F.sha2(F.to_json(F.struct(name.alias("name"), F.array_sort(F.map_entries(arguments)).alias("arguments")), {"ignoreNullFields": "false"}), 256)


class Memo:
    def __init__(self, path: str, most: int = MOST, age: int | None = None) -> None:
        """``most``: results kept a tool; ``age``: runs after which a result is worked out anew."""
        self.path, self.most, self.age = path.rstrip("/"), most, age

    def known(self, spark) -> tuple[int, DataFrame]:
        """The number of the last run, and the results kept by it."""
        number, last = Commits(spark, self.path, "folder string").latest()
        return number, spark.read.schema(_ROW).parquet(f"{self.path}/{last['folder']}") if last else spark.createDataFrame([], _ROW)

    def execute(self, called: DataFrame, registry: Registry | None = None) -> DataFrame:
        """``called`` (name, arguments) plus ``result`` and ``cached``: whether it was known before. Null arguments count as none.

        A run that another one overtook merges its results with those of the other. Results are kept as they are told, errors too.
        """
        spark, registry = called.sparkSession, registry or default_registry()
        digest, = fresh(called, "digest", also=["result", "cached"])
        arguments = F.coalesce("arguments", F.create_map().cast("map<string,string>"))
        keyed = called.withColumn(digest, digest_of(F.col("name"), arguments))
        number, known = self.known(spark)
        current = known if self.age is None else known.where(F.col("made") > number - self.age)
        distinct = written(keyed.select(F.col(digest).alias("digest"), "name", arguments.alias("arguments")).dropDuplicates(["digest"]))
        hits = distinct.join(current.select("digest", "result", "made"), "digest").select("digest", "name", "result", "made", F.lit(True).alias("cached"))
        new = distinct.join(current, "digest", "left_anti").select("digest", "name", registry.execute(F.col("name"), F.col("arguments")).alias("result"), F.lit(number + 1).cast("bigint").alias("made"), F.lit(False).alias("cached"))
        told = written(hits.unionByName(new))
        self._keep(spark, told)
        told = told.select(F.col("digest").alias(digest), "result", "cached")
        return keyed.join(told, digest, "left").drop(digest)

    def _keep(self, spark, told: DataFrame) -> None:
        log = Commits(spark, self.path, "folder string")
        while True:
            number, known = self.known(spark)
            mine = told.select("digest", "name", "result", "made", F.lit(number + 1).cast("bigint").alias("used"))
            merged = known.unionByName(mine).groupBy("digest").agg(F.max_by(F.struct("name", "result", "made", "used"), F.struct("used", "made")).alias("r")).select("digest", "r.*")
            # The rank's limit is taken in each partition first, so a tool with many calls doesn't meet in one task.
            rank = F.row_number().over(Window.partitionBy("name").orderBy(F.desc("used"), F.desc("made"), "digest"))
            folder = f"results-{uuid.uuid4().hex}"
            merged.withColumn("rank", rank).where(F.col("rank") <= self.most).drop("rank").write.parquet(f"{self.path}/{folder}")
            if log.commit(number + 1, {"folder": folder}):
                return
