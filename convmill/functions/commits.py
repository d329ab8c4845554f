"""A numbered log of commits beside a table: the next number goes to whoever creates it first, the others see that and try again.

A commit is a folder with one entry, moved to its number by a rename that must not replace anything; what stands there is read back, so a writer
knows whether it is its own. That needs a file system whose rename is atomic (HDFS, local disks); plain object stores have none.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


class Commits:
    def __init__(self, spark: SparkSession, path: str, entry: str) -> None:
        """``entry``: the schema of an entry's fields, in Spark's words."""
        self.spark, self.path, self.entry = spark, f"{path.rstrip('/')}/commits", entry
        self._fs_package = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, name: str = ""):
        return self._fs_package.Path(f"{self.path}/{name}" if name else self.path)

    @property
    def _fs(self):
        return self._path().getFileSystem(self._conf)

    def numbers(self) -> list[int]:
        if not self._fs.exists(self._path()):
            return []
        return sorted(int(s.getPath().getName()) for s in self._fs.listStatus(self._path()) if s.getPath().getName().isdigit())

    def read(self, number: int) -> dict | None:
        """The entry of a commit; null where it has none."""
        at = self._path(f"{number:012d}/entry.json")
        if not self._fs.exists(at):
            return None
        stream = self._fs.open(at)
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def latest(self) -> tuple[int, dict | None]:
        """The greatest number and its entry; 0 before the first commit."""
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else (0, None)

    def entries(self) -> DataFrame:
        """One row a commit."""
        schema = f"number bigint, {self.entry}"
        return self.spark.read.schema(schema).json(f"{self.path}/[0-9]*") if self.numbers() else self.spark.createDataFrame([], schema)

    def commit(self, number: int, entry: dict) -> bool:
        """Whether ``entry`` is now the commit of that number."""
        mark = uuid.uuid4().hex
        made = self._path(f".{mark}")
        stream = self._fs.create(self._path(f".{mark}/entry.json"), False)
        stream.write(bytearray(json.dumps({"number": number, "mark": mark, **entry}).encode()))
        stream.close()
        once = self.spark.sparkContext._gateway.new_array(getattr(self._fs_package, "Options$Rename"), 1)
        once[0] = getattr(self._fs_package, "Options$Rename").NONE
        try:
            self._fs_package.FileContext.getFileContext(made.toUri(), self._conf).rename(made, self._path(f"{number:012d}"), once)
        except Py4JJavaError as error:
            if "AlreadyExists" not in str(error.java_exception.getClass().getName()) and not self._fs.exists(self._path(f"{number:012d}")):
                raise
        found = self.read(number)
        self._fs.delete(made, True)
        return found is not None and found["mark"] == mark
